"""Hard negatives, importance resampling and license scans against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import hard_negatives, importance, license_scan

from .conftest import AWKWARD

# --- hard negatives

VECTORS = "vec_id long, vector array<double>, label int"


def mined(df, anchors, **more):
    got = defaultdict(list)
    for r in hard_negatives.hard_negatives(df, anchors, **more).orderBy("anchor_id", "positive_id", "rank").collect():
        got[r.anchor_id, r.positive_id, r.positive_score].append((r["rank"], r.negative_id, r.negative_score))
    return dict(got)


def plainly_mined(rows, is_anchor, positives=5, negatives=10):
    rows = [(i, np.array(v), x) for i, v, x in rows]
    out = {}
    for a, v, x in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-int(v @ w), i, y) for i, w, y in rows if i != a)
        for s, p, _ in [r for r in scored if r[2] == x][:positives]:
            fits = [(i, -n) for n, i, y in scored if y != x and 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            if fits:
                out[a, p, -s] = [(k, i, n) for k, (i, n) in enumerate(fits, 1)]
    return out


def test_hard_negatives_like_brute_force(spark):
    rng = np.random.default_rng(1)
    data = rng.integers(-60, 60, (500, 9)).astype(float)
    data[100:260] = data[100]  # a third of all rows are one vector
    rows = [(i, v.tolist(), int(i % 4)) for i, v in enumerate(data)]
    broken = [(900, None, 1), (920, [1.0, None] + [1.0] * 7, 1), (940, [float("inf")] * 9, 1), (960, [1.0] * 9, None), (None, [1.0] * 9, 1), (980, [1.0] * 4, 1), (990, [], 1)]
    df = spark.createDataFrame(rows + broken, VECTORS).withColumns({"id": F.lit("mine"), "window": F.lit(1), "dim": F.lit(0)})
    got = mined(df, df.filter("vec_id % 20 = 0 OR vec_id >= 900"), block_rows=64, pack_rows=7, wave_bytes=2000)
    plain = plainly_mined(rows, lambda i: i % 20 == 0)
    assert got == plain and len(plain) > 50


def test_hard_negatives_with_few_rows_ties_and_repeats(spark):
    rows = [(1, [10.0, 0.0], 0), (2, [10.0, 0.0], 0), (3, [5.0, 1.0], 1), (3, [5.0, 1.0], 1), (4, [5.0, 0.0], 2), (5, [-9.0, 0.0], 0), (6, [0.0, 7.0], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df, df.filter("vec_id = 1")) == {(1, 2, 100): [(1, 3, 50), (2, 3, 50), (3, 4, 50)]}
    assert mined(df, df.filter("vec_id = 4")) == {}  # no other row of its label
    named = df.withColumn("label", F.concat(F.lit("x"), F.col("label")))
    assert mined(named, named.filter("vec_id = 1")) == mined(df, df.filter("vec_id = 1"))
    assert mined(df.limit(0), df) == {} == mined(df, df.limit(0))


def test_an_anchor_that_repeats_is_asked_once(spark):
    df = spark.createDataFrame([(1, [3.0, 0.0], 0), (1, [2.0, 0.0], 0), (2, [10.0, 0.0], 0), (3, [5.0, 0.0], 1)], VECTORS)
    assert mined(df, df.filter("vec_id = 1")) == {(1, 2, 20): [(1, 3, 10)]}


@pytest.mark.parametrize("share", [-1.0, 0.0, 0.3, 0.7, 0.95])
def test_no_pair_over_the_threshold_is_pruned(share):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(300, 20)) * np.exp(-np.arange(20) / 3) * 200).round()
    queries = vectors[:40] + rng.integers(-3, 3, (40, 20))
    exact = queries @ vectors.T
    bars = share * np.sort(exact, axis=1)[:, -1]
    q, r, score = hard_negatives.Block.of(vectors).at_least(queries, bars)
    assert set(zip(q.tolist(), r.tolist(), strict=True)) == set(map(tuple, np.argwhere(exact >= bars[:, None]).tolist()))
    assert (score == exact[q, r]).all()


def test_high_thresholds_leave_postings_out(monkeypatch):
    """The lists are read as prefixes: what norms cover is never added up."""
    rng = np.random.default_rng(3)
    block = hard_negatives.Block.of((rng.normal(size=(1000, 32)) * np.exp(-np.arange(32) / 6) * 100).round())
    query = block.vectors[:1][:, np.argsort(block.dims)]
    rest = hard_negatives.suffix_norms(query[:, block.dims])[:, 0]
    read = lambda bar: sum(int((block.norms[s] >= bar / rest[s]).sum()) for s in range(len(rest) - 1) if rest[s])
    best = float((block.vectors @ query[0, block.dims]).max())
    assert read(0.9 * best) < read(0.3 * best) / 2 and read(-1.0) == 8 * 1000


def test_no_task_gives_more_than_its_best(spark):
    """A hot vector is met by every query; a task still gives k rows of a window at most."""
    df = spark.createDataFrame([(i, [4.0, 1.0], i % 2) for i in range(2000)], VECTORS).repartition(4)
    index = hard_negatives._index(df.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), F.size("vector").alias("dim"), F.col("vector").alias("v")), 100)
    asked = spark.createDataFrame([(0, 0, [4.0, 1.0], 2, [(7, 0.0, 99.0, 0.0)])], "id long, label long, v array<double>, dim int, windows array<struct<window long, low double, high double, bar double>>")
    found = hard_negatives._scanned(index, hard_negatives._packs(asked, 10), 10, False, 1 << 20).collect()
    assert 10 <= len(found) <= 40 and {(r.window, r.score) for r in found} == {(7, 17)}


# --- importance resampling


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)]


def plainly_weighed(rows, targets, buckets):
    code = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(code(f) for _, t in rows for f in plain_features(t)[1])
    t = Counter(code(f) for text in targets for f in plain_features(text)[1])
    total = lambda c: sum(c.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * total(s) / ((s[b] + 1) * total(t))))
    out = []
    for key, text in rows:
        words, own = plain_features(text)
        out.append((key, len(words), len(own), sum(gain(code(f)) for f in own) // len(own) if own else 0))
    return out


def weighed(df, target, **more):
    return [tuple(r) for r in importance.importance_weights(df, target, **more).collect()]


def test_weights_like_plain_python(awkward, documents):
    rows = [*((r[0], r[1]) for r in AWKWARD), (20, "Ünï code—words x_y 12ab É e"), (21, "the Cat, the cat; THE cat\x00dog")]
    df = documents(rows).withColumns({"k": F.lit(1), "buckets": F.lit("x"), "weight": F.lit(1), "n_words": F.lit(0)})
    targets = ["the cat sat", None, "", "Shared line of text"]
    aimed = documents(list(enumerate(targets)))
    for buckets in (50, 10_000):
        assert Counter(weighed(df, aimed, buckets=buckets)) == Counter(plainly_weighed(rows, targets, buckets))
    assert weighed(documents([]), aimed) == []
    assert Counter(weighed(df, documents([]))) == Counter(plainly_weighed(rows, [], 10_000))


@pytest.mark.parametrize("size", [1, 7, 30])
@pytest.mark.parametrize("longest", [1, 2, 3])
def test_features_do_not_depend_on_pieces(size, longest):
    text = "One two, three four-five. " * 9 + "x" * 50 + " É " + "last words"
    whole, cut = list(importance.feature_crcs(text, longest)), list(importance.feature_crcs(text, longest, size))
    assert len(whole) == 1 and len(cut) > 5
    assert Counter(np.concatenate([c for _, c in cut]).tolist()) == Counter(whole[0][1].tolist()) and sum(n for n, _ in cut) == whole[0][0]
    words = plain_features(text)[0]
    assert Counter(whole[0][1].tolist()) == Counter(zlib.crc32(" ".join(words[i : i + n]).encode()) for n in range(1, longest + 1) for i in range(len(words) - n + 1))


def plainly_drawn(rows, share, least_words, seed):
    """(key, rank) from (key, n_words, weight)."""
    scored = []
    for key, words, weight in rows:
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        scored.append((-(weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))), key is None, key or 0, words))
    enough = sorted(x for x in scored if x[3] >= least_words)
    return [(None if null else key, i) for i, (_, null, key, _) in enumerate(enough[: len(enough) * share[0] // share[1]], 1)]


@pytest.mark.parametrize("share", [(25, 100), (1, 1), (0, 1), (1, 1000)])
def test_draw_like_plain_python(spark, share):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 40)), int(rng.integers(-900, 900))) for i in range(300)]
    rows += [(7777, 30, 100)] * 200 + [(None, 25, 0), (None, 25, 0)]  # a key that repeats, and null ones
    df = spark.createDataFrame(rows, "doc_id long, n_words long, weight long")
    got = importance.draw(df, key="doc_id", share=share, least_words=20, seed=7).collect()
    assert len(got) == len(rows)
    assert sorted((r["rank"], r.doc_id) for r in got if r["rank"] is not None) == [(i, k) for k, i in plainly_drawn(rows, share, 20, 7)]
    assert importance.draw(df.limit(0), key="doc_id", share=share, least_words=20, seed=7).count() == 0


def test_resampled_rows_look_like_the_target(documents):
    rng = np.random.default_rng(6)
    make = lambda words: " ".join(rng.choice(words, 30))
    near, far = [f"near{i}" for i in range(40)], [f"far{i}" for i in range(40)]
    rows = [(i, make(near if i % 4 == 0 else far)) for i in range(400)]
    drawn = importance.resample(documents(rows), documents([(i, make(near)) for i in range(50)]))
    kept = [r.doc_id for r in drawn.collect()]
    assert len(kept) == 100 and drawn.columns == documents([]).columns
    assert sum(i % 4 == 0 for i in kept) > 60


# --- license scans

MIT = license_scan.TEMPLATES["mit-text"]


def places(text, templates):
    return license_scan.scan_text(text, tuple(templates.items()))[1]


def test_template_regions():
    t = {"a": 'one two <<beginOptional>>maybe <<beginOptional>>more<<endOptional>><<endOptional>> three <<var words="0..2">> four <<var match="x|y z">> end'}
    for text, n in [("one two three four x end", 6), ("one two maybe three four y z end", 8), ("one two maybe more three a b four x end", 10), ("ONE-two... Three (four) X\nend", 6)]:
        assert places(text, t) == [("a", 0, n)], text
    for text in ("one two three a b c four x end", "one two more three four x end", "one two three four end", "one two three four y end", "one three four x end", "one two three four x ends", "xone two three four x end", "one twos three four x end", ""):
        assert places(text, t) == [], text
    assert places("say one two three four x end. one two one two three four x end", t) == [("a", 1, 7), ("a", 9, 15)]
    assert license_scan.mandatory_words(license_scan.parse(t["a"])) == 6


def test_overlapping_templates_and_longest_runs():
    t = {"short": "the license", "long": 'the license <<beginOptional>>version<<endOptional>> <<var words="0..1">>'}
    assert places("under the License version 2 only", t) == [("short", 1, 3), ("long", 1, 5)]


@pytest.mark.parametrize("template", ["one", "", '<<var words="0..2">> one two', "one <<beginOptional>>x<<endOptional>> two", "one two <<beginOptional>> x", "one two x <<endOptional>>", "one two <<odd>> x"])
def test_bad_templates_are_errors(template):
    with pytest.raises(ValueError):
        license_scan.compile_template("t", template)


def filled(template):
    """A text that a template accepts, with all optional regions."""
    text = re.sub(r"<<(?:begin|end)Optional>>", " ", template)
    text = re.sub(r'<<var words="(\d+)\.\.(\d+)">>', lambda m: " ".join(["filler"] * int(m[2])), text)
    return re.sub(r'<<var match="([^"|]*)[^"]*">>', r"\1", text)


def test_every_license_is_found_in_its_text_and_lost_with_a_word_less():
    for label, template in license_scan.TEMPLATES.items():
        text = filled(template)
        assert label in {x for x, _, _ in places(f"Copyright (c) someone. {text} and so on", license_scan.TEMPLATES)}, label
        words = text.split()
        assert label not in {x for x, _, _ in places(" ".join(words[:1] + words[2:]), {label: template})}, label
    changed = filled(MIT).replace("without restriction", "with restriction")
    assert places(changed, {"mit-text": MIT}) == []


def test_automata_like_regular_expressions():
    """The same templates as patterns over joined words, on texts made of their words."""
    rng = np.random.default_rng(7)
    t = {"a": 'p q <<beginOptional>>r<<endOptional>> <<var words="1..2">> s', "b": 'q p <<var match="r|s s">> <<beginOptional>>p q<<endOptional>>'}
    patterns = {k: re.compile(license_scan.template_pattern(license_scan.parse(v)) + " ") for k, v in t.items()}
    hits = Counter()
    for _ in range(3000):
        text = " ".join(rng.choice(list("pqrs"), rng.integers(1, 14)))
        found = {label for label, _, _ in places(text, t)}
        assert found == {k for k, p in patterns.items() if p.search(f" {text} ")}, text
        hits.update(found)
    assert min(hits[k] for k in t) > 100


def test_awkward_rows_are_scanned(awkward, documents):
    rows = license_scan.license_places(awkward.withColumns({"k": F.lit(1), "places": F.lit(2), "n_words": F.lit(3)})).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter((r[0], len(plain_features(r[1])[0])) for r in AWKWARD)
    assert license_scan.license_places(documents([])).count() == 0
    far = "filler é " * 200_000 + filled(MIT)
    (r,) = license_scan.license_places(documents([(1, far)])).collect()
    assert [(p.label, p.first_word) for p in r.places] == [("mit-text", 400_000)]
