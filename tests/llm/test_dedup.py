"""Exact dedup, line dedup and the n-gram join against plain Python versions."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import exact_dedup, line_dedup, ngram_join, shingles
from geoloom.llm.components import connected_components
from geoloom.llm.prefix_tree import CLASS_BITS, PrefixTree, beginning, prefix_lengths, ranked
from geoloom.llm.shingles import shingle_sets

from .conftest import AWKWARD


def test_exact_duplicates_of_awkward_rows(awkward):
    rows = exact_dedup.exact_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    empties = [r for r in rows if r.doc_id in (3, 4) or (r.doc_id is None and r.group_size == 3)]
    assert {r.keep_id for r in empties} == {4} and all(r.group_size == 3 for r in empties)
    twice = [r for r in rows if r.doc_id == 2]
    assert sorted(r.kept for r in twice) == [False, True] and {r.group_size for r in twice} == {2}
    assert sum(r.kept for r in rows) == len({t or "" for _, t in AWKWARD})


def test_exact_duplicates_need_the_whole_text(documents):
    same = "p" * 100
    rows = exact_dedup.exact_duplicates(documents([(1, same + "a"), (2, same + "b"), (3, same + "a")])).collect()
    assert {(r.doc_id, r.keep_id) for r in rows} == {(1, 3), (2, 2), (3, 3)}


def test_empty_tables(documents, spark):
    none = documents([])
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert line_dedup.drop_shared_lines(none).count() == 0
    assert ngram_join.near_duplicate_components(none).count() == 0


def test_clashing_columns_pass_through(documents):
    docs = documents([(1, "some shared line\na"), (2, "some shared line\nb")]).withColumn("keep_id", F.lit(9)).withColumn("node", F.lit(1)).withColumn("place", F.lit(2)).withColumn("n_lines", F.lit("x"))
    assert exact_dedup.exact_duplicates(docs).count() == 2
    assert {(r.doc_id, r.text, r.node) for r in line_dedup.drop_shared_lines(docs).collect()} == {(1, "some shared line\na", 1), (2, "b", 1)}
    assert ngram_join.keep_first_of_each(docs).columns == docs.columns


def plain_lines(rows, least=10, many=2):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(doc)
    order = lambda d: (d is None, d or 0)
    first = {k: min(v, key=order) for k, v in holders.items() if len(v) >= many}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if key(x) not in first or first[key(x)] == doc]
        out.append((doc, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return Counter(out)


@pytest.mark.parametrize("many", [2, 3])
def test_line_dedup_like_plain_python(documents, many):
    rng = random.Random(5)
    pool = [f"Line number {i} é" for i in range(12)] + ["", "short", "  Line number 3 É ", "LINE NUMBER 4 é\t"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.choice([1, 5, 150])))) for i in range(30)] + AWKWARD
    got = line_dedup.drop_shared_lines(documents(rows), min_documents=many)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == plain_lines(rows, many=many)


def plain_components(rows, words, num, den):
    def grams(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" ")
        w = [x for x in w if x]
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    reach = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        reach[find(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in reach.items()}
    return Counter((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def mutated(rng, words, rate):
    return [rng.choice("abcdefgh") * 3 + str(rng.random())[:6] if rng.random() < rate else w for w in words]


@pytest.mark.parametrize(("words", "num", "den"), [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_ngram_join_like_plain_python(documents, words, num, den):
    rng = random.Random(11)
    rows = list(AWKWARD[:-1])
    doc = 100
    for size in (1, 2, 3, 5, 9, 12, 20, 40, 90, 400):
        for _ in range(3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
            for rate in (0, 0, 0.005, 0.02, 0.04, 0.1):
                text = mutated(rng, base, rate)
                cut = rng.choice([0, 0, size // 12])
                rows.append((doc, " ".join(text[cut:])))
                doc += 1
    rng.shuffle(rows)
    got = ngram_join.near_duplicate_components(documents(rows).repartition(3), words=words, num=num, den=den)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == plain_components(rows, words, num, den)


def test_ngram_join_over_several_blocks(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(mutated(rng, base[: rng.choice([120, 120, 118, 100, 60])], rng.choice([0.01, 0.03, 0.06])))) for i in range(90)]
    got = ngram_join.near_duplicate_components(documents(rows), words=2, num=9, den=10)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == plain_components(rows, 2, 9, 10)


def related_sets(rng, many, size, rate):
    """Sets that share most of a common base, and as many that share little of it."""
    base = rng.integers(0, 2**63, size, np.uint64) * np.uint64(2)
    out = []
    for k in range(many):
        new = rng.random(size) < (rate if k % 2 else 0.7)
        out.append(np.unique(np.where(new, rng.integers(0, 2**63, size, np.uint64), base)))
    return list({s.tobytes(): s for s in out}.values())


def plain_groups(sets, num, den):
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                root = [root[j] if r == root[i] else r for r in root]
    return root


def same_groups(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5), (1, 2), (1, 5), (1, 1)])
def test_prefix_tree_finds_every_group(num, den):
    rng = np.random.default_rng(1)
    class_of = rng.integers(0, 6, 1 << CLASS_BITS).astype(np.uint8)
    for size, rate in ((5, 0.1), (60, 0.03), (300, 0.06)):
        sets = related_sets(rng, 40, size, rate)
        sizes = np.array([len(s) for s in sets])
        plain = plain_groups(sets, num, den)
        for frequent_first in (False, True):
            assert same_groups(PrefixTree(ranked(sets, class_of, frequent_first=frequent_first), sizes).groups(num, den).tolist(), plain)
        known = np.array([p if k % 3 else len(sets) + k for k, p in enumerate(plain)])  # some known before
        assert same_groups(PrefixTree(ranked(sets, class_of), sizes).groups(num, den, known).tolist(), plain)
        heads = [beginning(s, prefix_lengths(len(s), num, den)[0], class_of) for s in sets]
        left = PrefixTree(ranked(heads, class_of), sizes).groups(num, den).tolist()
        assert all(left[i] == left[plain[i]] for i in range(len(sets)))  # beginnings never part what is linked


def test_beginnings_of_unlike_sets_are_pruned():
    """Sets that share a passage and nothing else leave the tree before their whole sets are read."""
    rng = np.random.default_rng(3)
    class_of = np.zeros(1 << CLASS_BITS, np.uint8)
    passage = rng.integers(0, 2**63, 20, np.uint64)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 2**63, 300, np.uint64)])) for _ in range(50)]
    heads = [beginning(s, prefix_lengths(len(s), 9, 10)[0], class_of) for s in sets]
    assert sum(len(np.intersect1d(heads[0], h)) > 0 for h in heads) > 1
    assert len(set(PrefixTree(ranked(heads, class_of), np.array([len(s) for s in sets])).groups(9, 10).tolist())) == 50


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5), (1, 2), (1, 5)])
def test_linked_sets_share_an_ngram_of_their_beginnings(num, den):
    rng = np.random.default_rng(2)
    class_of = rng.integers(0, 4, 1 << CLASS_BITS).astype(np.uint8)
    for size in (*range(1, 40), 150, 700, 5000):
        for _ in range(4):
            grams = np.unique(rng.integers(0, 2**63, size, np.uint64) * np.uint64(2))
            keep = -(-size * num // den)  # a subset that just reaches the threshold
            other = np.sort(rng.permutation(grams)[:keep])
            (sought, _), (_, found) = prefix_lengths(len(grams), num, den), prefix_lengths(len(other), num, den)
            assert np.intersect1d(beginning(grams, sought, class_of), beginning(other, found, class_of)).size, size


@pytest.mark.parametrize(("words", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_very_long_texts_are_joined_whole(documents, monkeypatch, words, num, den):
    """Sets of thousands of n-grams at the threshold, and texts longer than a piece."""
    monkeypatch.setattr(shingles, "PIECE_BYTES", 5000)
    rng = random.Random(4)
    rows, doc = [], 0
    for size in (2300, 2600, 9000):
        base = [f"w{rng.randrange(10**7)}" for _ in range(size)]
        for part in (1, num / den + 0.002, num / den - 0.002, 0.5):
            rows.append((doc, " ".join(base[: int(size * part)])))
            doc += 1
        for rate in (0.01, 0.02, 0.03, 0.04):
            rows.append((doc, " ".join(mutated(rng, base, rate))))
            doc += 1
    got = ngram_join.near_duplicate_components(documents(rows), words=words, num=num, den=den)
    plain = plain_components(rows, words, num, den)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == plain and len({c for _, _, c in plain}) > 6


def test_a_passage_that_all_share_links_nothing(documents):
    """Documents that hold the same passage and own text: none is linked, and no place is large."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join([*(f"w{rng.randrange(10**7)}" for _ in range(90)), passage])) for i in range(300)] + [(1000 + i, f"{passage} {i}") for i in range(40)]
    got = ngram_join.near_duplicate_components(documents(rows), words=3, num=9, den=10)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == plain_components(rows, 3, 9, 10)


def test_null_keys_and_repeated_keys_keep_their_own_texts(documents):
    base = [f"w{i}" for i in range(50)]
    rows = [(None, " ".join([*base, str(i)])) for i in range(30)] + [(7, " ".join([*base, "x"])), (7, "something else entirely here"), (8, "something else entirely here")]
    got = ngram_join.near_duplicate_components(documents(rows), words=3, num=9, den=10)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == plain_components(rows, 3, 9, 10)


def test_shingles_of_bytes():
    texts = [b"", b"a", b"A b\tC  d", "é É é".encode(), b" x "]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sets = list(shingle_sets(raw, np.cumsum([0, *map(len, texts)]), 2))
    assert [len(s) for s in sets] == [0, 1, 3, 2, 1]
    again = list(shingle_sets(np.frombuffer(b"q a B c D", np.uint8), np.array([0, 1, 9]), 2))
    assert again[1].tolist() == sets[2].tolist()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    rng = random.Random(1)
    rng.shuffle(links)
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 300: 300, 301: 300}


def test_op10_digest(spark, sf_dir):
    rows = exact_dedup.op10_exact_dedup(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(r.text_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest() for r in rows) and len(rows) == len(texts)


def test_copies_in_many_partitions_are_one_row_of_a_place(spark, monkeypatch):
    """A text in each of 200 partitions beside near copies of it: places hold distinct sets alone."""
    common = " ".join(f"word{i}" for i in range(60))
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, common).when(F.col("id") < 20, F.concat(F.lit(f"{common} tail"), F.col("id"))).otherwise(F.concat(F.lit("own text "), F.col("id"))).alias("text")).repartition(200)
    largest, plain = [], ngram_join._grouped
    monkeypatch.setattr(ngram_join, "_grouped", lambda small, *a, **k: (largest.append(small.groupBy("place").count().agg(F.max("count")).first()[0]), plain(small, *a, **k))[1])
    rows = {r.doc_id: r.component_id for r in ngram_join.near_duplicate_components(df).collect()}
    assert len(largest) == 1 and largest[0] <= 11  # the text and its ten near copies
    assert {rows[i] for i in range(0, 400, 2)} == {0} == {rows[i] for i in range(1, 20, 2)} and all(rows[i] == i for i in range(21, 400, 2))
