"""Sharding, search, WARC, language ID, sampling, chat formatting, packing and the pipeline."""

import base64
import hashlib
import io
import struct
import time
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from geoloom.llm import chat_format, language_id, packing, sharding, subword_sampling, vector_search, warc
from geoloom.llm.common import fresh_path

from .conftest import AWKWARD

tokenizers = pytest.importorskip("public_tokenizers")
BPE, PIECES = tokenizers.path("word_bpe_49k.json"), tokenizers.path("piece_bpe_32k.model")


# --- sharding


def dealt(df, **more):
    return sharding.shuffle_to_shards(df, shards=8, **more).collect()


def test_shards_are_even_gapless_and_whole(corpus):
    rows = dealt(corpus, seed=3)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in corpus.select("doc_id").collect())
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    order = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.3 and order != sorted(order)


def test_shards_depend_on_seed_not_on_layout(corpus):
    at = lambda rows: {r.doc_id: (r.shard, r.slot) for r in rows}
    assert at(dealt(corpus, seed=3)) == at(dealt(corpus.repartition(5), seed=3)) != at(dealt(corpus, seed=4))


def test_one_repeated_key_is_split(documents):
    rows = dealt(documents([(7, "x" * 99)] * 500 + [(i, "y") for i in range(30)]), bucket_bytes=1000, least_buckets=4)
    counts = Counter(r.shard for r in rows)
    assert len(rows) == 530 and max(counts.values()) - min(counts.values()) <= 1
    assert len({(r.shard, r.slot) for r in rows}) == 530


def test_awkward_rows_are_sharded(awkward, documents):
    rows = dealt(awkward.withColumn("shard", F.lit("mine")).withColumn("__x", F.lit(1)))
    assert len(rows) == len(AWKWARD) and {r["size"] for r in rows if r.doc_id == 3} == {1}
    assert dealt(documents([])) == []


def plain_order(rows, seed, buckets):
    """The shuffled order by plain Python, from the hashes of Spark alone: (doc_id, text) rows with
    their scatter and order hashes."""
    out, scattered = [], defaultdict(list)
    for r in rows:
        scattered[r.scatter % buckets].append(r)
    for b in sorted(scattered):
        own = sorted(scattered[b], key=lambda r: r.order)
        at = np.arange(len(own))
        np.random.default_rng([seed, b, 0]).shuffle(at)
        out += [own[i].doc_id for i in at]
    return out


def test_shards_like_a_plain_two_pass_shuffle(corpus):
    seed, buckets = 5, 16
    hashed = corpus.select("doc_id", F.xxhash64(F.lit(seed), "doc_id", "text").alias("scatter"), F.xxhash64(F.lit(seed + 1), "doc_id", "text").alias("order")).collect()
    plain = plain_order(hashed, seed, buckets)
    rows = sorted(dealt(corpus, seed=seed, least_buckets=buckets), key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in rows] == plain
    assert [r.shard for r in rows] == [i * 8 // len(plain) for i in range(len(plain))]


def test_runs_of_several_buckets(corpus, monkeypatch):
    """More buckets than runs: positions go on through the buckets of a run."""
    plain = [(r.doc_id, r.shard, r.slot) for r in dealt(corpus, seed=2, least_buckets=4096)]
    assert Counter(d for d, _, _ in plain) == Counter(r.doc_id for r in corpus.select("doc_id").collect())
    for s in range(8):
        slots = sorted(slot for _, shard, slot in plain if shard == s)
        assert slots == list(range(len(slots)))


def test_op1_query(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = sharding.op1_sharding(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s])) for s in range(8))


def test_written_shards_are_in_order(spark, corpus):
    path = fresh_path(spark, "shards")
    sharding.write_shards(sharding.shuffle_to_shards(corpus, shards=3), path)
    back = spark.read.parquet(path)
    assert back.count() == corpus.count() and {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}


# --- search


def test_top_k_like_brute_force(spark):
    rng = np.random.default_rng(0)
    data = rng.integers(-40, 40, (400, 6)).astype(float)
    data[50:150] = data[50]  # a third of near ties
    rows = [(i, v.tolist()) for i, v in enumerate(data)] + [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (None, [1.0] * 6), (903, [1.0] * 5), (904, [])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = defaultdict(list)
    for r in vector_search.exact_top_k(df, df.filter("vec_id % 20 = 0 or vec_id > 900"), rows_per_block=64, queries_per_pack=7, wave_bytes=1500).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    scores = data @ data.T
    for q in range(0, 400, 20):
        plain = sorted(((-int(s), i) for i, s in enumerate(scores[q]) if i != q))[:5]
        assert got.pop(q) == [(i, -s) for s, i in plain]
    assert not got


def test_top_k_with_few_rows_and_repeats(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 1.0])], "vec_id long, vector array<double>")
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in vector_search.exact_top_k(df, df).collect()}
    assert got == {(1, 1, 2, 5), (2, 1, 1, 5), (2, 2, 1, 5)}
    assert vector_search.exact_top_k(df.limit(0), df).count() == 0 == vector_search.exact_top_k(df, df.limit(0)).count()


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for spread in (3, 300, 40_000):
        vectors = rng.integers(-spread, spread, (300, 5)).astype(float)
        queries = rng.integers(-spread, spread, (20, 5)).astype(float)
        grid = vector_search.Grid.around(vectors)
        lower, upper = vector_search.bounds(grid.boxes(grid.codes(vectors)), queries)
        exact = queries @ vectors.T
        assert ((lower <= exact) & (exact <= upper)).all()
        assert spread > 3 or (lower == upper).all()


def test_an_outlier_widens_its_own_cell_only():
    rng = np.random.default_rng(6)
    vectors, queries = rng.integers(-900, 900, (5000, 4)).astype(float), rng.integers(-900, 900, (20, 4)).astype(float)
    width = lambda v: np.subtract(*vector_search.bounds(vector_search.Grid.around(v).boxes(vector_search.Grid.around(v).codes(v)), queries)[::-1])
    far = vectors.copy()
    far[17] = 1e9
    assert np.median(width(far)) <= 1.1 * np.median(width(vectors))


def test_rows_of_one_vector_are_told_apart_by_their_ids():
    """A vector that many rows share leaves k rows per query in a task, however many they are."""
    vectors = np.tile([[3.0, 4.0]], (20_000, 1))
    found = vector_search._Bounded(np.array([-1, -2]), np.array([[1.0, 1.0], [-1.0, 2.0]]), 5)
    for i in range(0, 20_000, 4000):
        grid = vector_search.Grid.around(vectors[i : i + 4000])
        found.add(grid, grid.codes(vectors[i : i + 4000]), np.arange(i, i + 4000), np.arange(i, i + 4000))
    out = found.given_out()
    assert sorted(zip(out["query_id"].to_pylist(), out["id"].to_pylist(), strict=True)) == [(q, i) for q in (-2, -1) for i in range(5)]


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_a_task_gives_out_what_reaches_its_best_bounds(monkeypatch, held):
    rng = np.random.default_rng(8)
    vectors, asked = rng.integers(-300, 300, (4000, 6)).astype(float), rng.integers(-300, 300, (30, 6)).astype(float)
    found = vector_search._Bounded(np.arange(-30, 0), asked, 3)
    pairs = []
    for i in range(0, 4000, 500):
        grid = vector_search.Grid.around(vectors[i : i + 500])
        found.add(grid, grid.codes(vectors[i : i + 500]), np.arange(i, i + 500), np.arange(i, i + 500))
        if found.size() > held:
            pairs.append(found.given_out())
    pairs.append(found.given_out())
    got = {(q, r) for b in pairs for q, r in zip(b["query_id"].to_pylist(), b["row"].to_pylist(), strict=True)}
    best = np.argsort(-(asked @ vectors.T), axis=1, kind="stable")[:, :3]
    assert {(q - 30, int(r)) for q in range(30) for r in best[q]} <= got and (held == 50 or len(got) < 30 * 4000 / 20)


def test_codes_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(300)], "id long, v array<double>").withColumns({"dim": F.lit(2), "row": F.col("id")})
    blocks = vector_search._approximated(df, 64)
    plan = vector_search._scanned(blocks, df.filter("id < 5"), 2, 4, 1 << 20)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_few_exact_vectors_are_read(spark, monkeypatch):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.integers(-2000, 2000, (3000, 16)).astype(float))], "vec_id long, vector array<double>")
    reads, plain = [], vector_search.exact_scores
    monkeypatch.setattr(vector_search, "exact_scores", lambda pairs, *more: (reads.append(pairs.count()), plain(pairs, *more))[1])
    got = vector_search.exact_top_k(df.withColumn("row", F.lit(1)).withColumn("dim", F.lit("x")), df.filter("vec_id % 50 = 0"), rows_per_block=512)
    assert got.count() == 60 * 5 and reads[0] == 60 * 5 and sum(reads) < 60 * 3000 / 100
    assert all(n <= 60 * 5 * 2**i for i, n in enumerate(reads))  # never more than twice the strict order of bounds


# --- WARC

PAGES = [(3, "http://a/x?y=é\r\n", "same é"), (1, None, "same é"), (2, "u", None), (5, "u", ""), (None, "u", "same é"), (9, "u", "own"), (1, "w", "same é"), (8, "u", "\r\n\r\nWARC/1.1\r\n" * 50)]


def test_warc_round_trip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(0)).repartition(2)
    back = warc.read_archives(warc.write_archives(df, fresh_path(spark, "warc"), package_bytes=500), records_per_range=2).collect()
    said = Counter((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in back)
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {"same é": 1, "": 2, "own": 9, PAGES[-1][2]: 8}
    plain = Counter()
    for page, _, html in PAGES:
        f = first[html or ""]
        plain[page, "response" if page == f else "revisit", None if page == f else f, len((html or "").encode()), digest(html)] += 1
    assert said == plain
    assert {r.payload for r in back if r.page_id == 8} == {PAGES[-1][2]}


def test_short_payloads_are_all_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    back = warc.read_archives(warc.write_archives(df, fresh_path(spark, "warc"), least_revisit_bytes=3)).collect()
    assert {r.record_type for r in back} == {"response"}
    assert warc.write_archives(df.limit(0), fresh_path(spark, "warc")).count() == 0


def test_two_attempts_of_a_task_never_share_a_file(spark, tmp_path):
    """A late attempt that gets the rows in another order leaves the committed packages as they are."""
    rows = [{"page": i, "url": None, "body": f"body {i} " * 40, "first": None, "revisit": False} for i in range(60)]
    schema = pa.schema([("page", pa.int64()), ("url", pa.string()), ("body", pa.string()), ("first", pa.int64()), ("revisit", pa.bool_())])

    def attempt(name, own):
        return [r for b in warc.write_packages(iter([pa.RecordBatch.from_pylist(own, schema)]), f"file://{tmp_path}", "000000", name, package_bytes=700, date="1970-01-01T00:00:00Z") for r in b.to_pylist()]

    committed, late = attempt("1", rows), attempt("2", rows[::-1])
    assert len(committed) > 1 and not {r["path"] for r in committed} & {r["path"] for r in late}
    back = warc.read_archives(spark.createDataFrame(committed, "path string, records long")).collect()
    assert sorted((r.page_id, r.payload) for r in back) == [(r["page"], r["body"]) for r in rows]


def repacked(path, compression, without=()):
    """The package again, its members stored or compressed, some left out."""
    with zipfile.ZipFile(path) as z:
        members = [(i, z.read(i)) for i in z.namelist() if i not in without]
    with zipfile.ZipFile(path, "w", compression) as z:
        for name, data in members:
            z.writestr(name, data)


@pytest.mark.parametrize(("compression", "without", "said"), [(zipfile.ZIP_DEFLATED, (), "compressed"), (zipfile.ZIP_STORED, ("archive",), "no member"), (zipfile.ZIP_STORED, ("index",), "no member")])
def test_packages_that_can_not_be_read_are_errors(spark, tmp_path, compression, without, said):
    (row,) = warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w").collect()
    repacked(row.path.removeprefix("file://"), compression, [{"archive": warc.ARCHIVE, "index": warc.INDEX}[x] for x in without])
    with pytest.raises(Exception, match=said):
        warc.read_archives(spark.createDataFrame([row])).collect()


def test_every_written_record_must_come_back(spark, tmp_path):
    (row,) = warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w").collect()
    assert row.records == len(PAGES) and warc.read_archives(spark.createDataFrame([(row.path,)], "path string")).count() == len(PAGES)
    with pytest.raises(Exception, match="9 records were written"):
        warc.read_archives(spark.createDataFrame([(row.path, 9)], "path string, records long")).collect()


def test_runs_of_records_side_by_side():
    assert list(warc.runs([(5, 2), (7, 3), (11, 1), (12, 1), (13, 4)], most=2)) == [(5, [2, 3]), (11, [1, 1]), (13, [4])]
    assert list(warc.runs([])) == []


def test_very_long_pages_and_many_reading_tasks(spark):
    df = spark.createDataFrame([(i, "u", ("é" * 700_000 if i == 0 else "x") + str(i)) for i in range(50)], "page_id long, url string, html string")
    back = warc.read_archives(warc.write_archives(df, fresh_path(spark, "warc")), records_per_range=5)
    assert back.rdd.getNumPartitions() >= 4 and {(r.page_id, r.payload) for r in back.collect()} == {(r.page_id, r.html) for r in df.collect()}


def opened(data, tmp_path):
    (tmp_path / "x.zip").write_bytes(data)
    return pafs.LocalFileSystem().open_input_file(str(tmp_path / "x.zip"))


def test_directory_with_comment_and_compressed_member(tmp_path):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"aaa", zipfile.ZIP_DEFLATED)
        z.writestr(warc.ARCHIVE, b"0123456789")
        z.comment = b"c" * 300
    with opened(out.getvalue(), tmp_path) as f:
        members = {m.name: m for m in warc.central_directory(f)}
        assert not members["a"].stored and f.read_at(4, warc.data_offset(f, members[warc.ARCHIVE]) + 3) == b"3456"


def test_zip64_directory(tmp_path):
    """Sizes, offset and count as ZIP64 fields, as in a package beyond 4 GB."""
    name, body = warc.ARCHIVE.encode(), b"payload"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, zlib.crc32(body), 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    pad = b"\0" * 11
    extra = struct.pack("<HHB", 0x9999, 1, 0) + struct.pack("<HHQQQ", 1, 24, len(body), len(body), len(pad))
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, zlib.crc32(body), 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(pad) + len(local) + len(body)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    with opened(pad + local + body + central + end64 + locator + end, tmp_path) as f:
        (m,) = warc.central_directory(f)
        assert (m.name, m.stored, m.size) == (name.decode(), True, 7) and f.read_at(7, warc.data_offset(f, m)) == body


@pytest.mark.parametrize("damage", [lambda b: b[:50], lambda b: b.replace(b"PK\x01\x02", b"PK\x01\x00"), lambda b: b""])
def test_damaged_packages_are_errors(tmp_path, damage):
    with opened(damage(warc.package([(1, b"x" * 99)])), tmp_path) as f, pytest.raises(ValueError):
        warc.central_directory(f)


# --- language ID


def test_language_id_on_held_out_documents(spark, sf_dir):
    rows = {r.doc_id: r for r in language_id.op5_language_id(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert all(rows[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    held = [d for d in docs if rows[d.doc_id].held_out]
    right = sum(rows[d.doc_id].lang_pred == d.lang for d in held)
    assert held and right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def plain_buckets(text):
    """Buckets of a text's n-grams by plain Python, without the module's own functions."""
    letters = "".join(ch if ch.isalpha() else " " for ch in text.lower())
    padded = f" {' '.join(letters.split())} " if letters.split() else " "
    out = []
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            h = n * 0x9E3779B1 & 0xFFFFFFFF
            for ch in padded[i : i + n]:
                h = (h ^ ord(ch)) * 0x85EBCA6B & 0xFFFFFFFF
                h ^= h >> 15
            if padded[i : i + n] != " ":
                out.append(h % (1 << 16))
    return out


def plain_counts(texts):
    return Counter(b for t in texts for b in plain_buckets(t))


def test_answers_like_plain_naive_bayes(documents):
    rng = np.random.default_rng(3)
    words = {"x": ["alpha", "beta", "gamma", "délta"], "y": ["alfa", "bêta", "gama", "delt"], "z": ["αλφα", "βητα", "alpha"]}
    make = lambda lang, n: " ".join(rng.choice(words[lang], n)) + "! 12 "
    learn = [(i, make(lang, 30), lang) for i, lang in enumerate("xyzxyyx")]
    asked = [(100 + i, make(lang, n), None) for i, (lang, n) in enumerate([("x", 1), ("y", 1), ("z", 2), ("x", 9), ("y", 40)])]
    counts = {lang: plain_counts([t for _, t, own in learn if own == lang]) for lang in "xyz"}
    total = {lang: sum(c.values()) + 0.5 * (1 << 16) for lang, c in counts.items()}
    for r in language_id.predict(documents(asked), language_id.train(documents(learn))).collect():
        logs = {lang: sum(np.log((counts[lang][b] + 0.5) / total[lang]) for b in plain_buckets(r.text)) for lang in "xyz"}
        best = max(logs, key=logs.get)
        assert r.lang_pred == best and abs(r.score - 1 / sum(np.exp(v - logs[best]) for v in logs.values())) < 1e-9


def test_blocks_of_languages_answer_like_one(documents, corpus, monkeypatch):
    """Whatever the blocks, the best language, ties included, and the posterior are the same."""
    model = language_id.train(corpus)
    asked = corpus.filter("doc_id % 5 = 0").unionByName(documents([(-1, None), (-2, ""), (-3, "12 !")]))
    answers = lambda m: {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.predict(asked, m).collect()}
    one = answers(model)
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 1)
    several = language_id.train(corpus)
    assert model.blocks == 1 and several.blocks > 2 and answers(several) == one and one[-1] == ("und", 0.0)
    tied = language_id.train(documents([(i, "same words", f"l{i}") for i in range(6)]))
    (r,) = language_id.predict(documents([(1, "words")]), tied).collect()
    assert tied.blocks == 6 and r.lang_pred == "l0" and abs(r.score - 1 / 6) < 1e-9


def spoken(spark, n):
    """Two documents in each of n languages, whose words tell them apart."""
    word = F.translate((F.col("id") % n).cast("string"), "0123456789", "abcdefghij")
    return spark.range(2 * n).select((F.col("id") + 1).alias("doc_id"), F.concat(F.lit("word "), word).alias("text"), F.concat(F.lit("l"), F.col("id") % n).alias("lang"))


def test_thousands_of_languages_are_all_learned(spark):
    """A task counts a block of languages at once and hands their counts on; so does the driver."""
    model = language_id.train(spoken(spark, 5000))
    assert model.blocks == 79 and model.counts.filter(F.col("bucket") == language_id.ROWS).agg(F.count("l"), F.sum("n")).first()[:] == (5000, 10_000)
    assert 20 < len(model.block(7).languages) < 130


def test_hundreds_of_languages_are_told_apart(spark, monkeypatch):
    df = spoken(spark, 150)
    asked = df.withColumn("text", F.repeat(F.concat("text", F.lit(" ")), 3))
    answers = lambda m: {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language_id.predict(asked, m).collect()}
    model = language_id.train(df)
    found = answers(model)
    assert model.blocks == 3 and len(found) == 300
    assert sum(found[i + 1][0] == f"l{i % 150}" for i in range(300)) > 270
    monkeypatch.setattr(language_id, "BLOCK_LANGUAGES", 150)
    whole = language_id.train(df)
    assert whole.blocks == 1 and answers(whole) == found


def test_training_counts_and_long_texts(documents, monkeypatch):
    docs = [(1, "abc def ghi " * 40, "x"), (2, "zzz yyy", "y"), (3, None, "x"), (4, "q", None)]
    model = language_id.train(documents(docs), smoothing=0.5).block(0)
    assert model.languages == ("x", "y")
    counts = plain_counts([docs[0][1]])
    total = sum(counts.values()) + 0.5 * language_id.BUCKETS
    assert all(abs(model.log_probability[0, b] - np.log((n + 0.5) / total)) < 1e-9 for b, n in counts.items())
    whole = model.scores([docs[0][1]])
    monkeypatch.setattr(language_id, "PIECE", 37)
    assert np.allclose(model.scores([docs[0][1]]), whole)


def test_unknown_language_and_awkward_rows(awkward, documents):
    model = language_id.train(awkward.filter("doc_id < 3"))
    rows = language_id.predict(awkward.withColumn("score", F.lit("x")), model).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} == {3, 4, None, 5, 6} and all(r.score == 0 for r in rows if r.lang_pred == "und")
    nothing = language_id.train(documents([]))
    assert {r.lang_pred for r in language_id.predict(awkward, nothing).collect()} == {"und"}


# --- sampled segmentations


@pytest.fixture(scope="module")
def vocabulary():
    return subword_sampling.Vocabulary(PIECES)


@pytest.fixture(scope="module")
def piece_logs():
    """Pieces by text with their log probabilities, read from the model without the module under test."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    weights = [1 / (r + 2) for r in range(len(plain))]
    by_byte = {int(model.id_to_piece(i)[3:5], 16): i for i in range(model.vocab_size()) if model.is_byte(i)}
    return {model.id_to_piece(i): (i, np.log(w / sum(weights))) for i, w in zip(plain, weights, strict=True)}, by_byte


def every_segmentation(text, piece_logs):
    """All ways to write " " + text as pieces, a run of spaces only at a piece's start, with the
    normalised log probability of each."""
    pieces, by_byte = piece_logs
    shown = "▁" + text.replace("▁", "\0").replace(" ", "▁")
    least = min(log for _, log in pieces.values())
    ways = [[] for _ in range(len(shown) + 1)]
    ways[0] = [((), 0.0)]
    for i in range(len(shown)):
        for j in range(i + 1, len(shown) + 1):
            part = shown[i:j]
            if "▁" in part.lstrip("▁"):
                continue
            if part in pieces:
                steps = [((pieces[part][0],), pieces[part][1])]
            elif j == i + 1:
                raw = part.replace("\0", "▁").encode()
                steps = [(tuple(by_byte[b] for b in raw), least * len(raw))]
            else:
                steps = []
            ways[j] += [(ids + more, log + extra) for ids, log in ways[i] for more, extra in steps]
    total = np.logaddexp.reduce([log for _, log in ways[-1]])
    return {ids: log - total for ids, log in ways[-1]}


def samples(texts, k, vocabulary, seeds=None):
    seeds = np.arange(len(texts), dtype=np.uint64) * np.uint64(7919) if seeds is None else seeds
    out = defaultdict(list)
    for rows, ids, n, log, inclusion in subword_sampling.sample_segmentations(texts, seeds, k, vocabulary):
        at = np.concatenate([[0], np.cumsum(n)])
        for i, r in enumerate(rows.tolist()):
            out[r].append((tuple(ids[at[i] : at[i + 1]].tolist()), log[i], inclusion[i]))
    return out


def test_samples_follow_the_distribution(vocabulary, piece_logs):
    full = every_segmentation("the cat", piece_logs)
    assert abs(sum(map(np.exp, full.values())) - 1) < 1e-9
    n = 8000
    got = samples(["the cat"] * n, 3, vocabulary)
    assert all(len({s for s, _, _ in got[i]}) == 3 for i in range(n))
    assert all(abs(full[s] - log) < 1e-9 for i in range(n) for s, log, _ in got[i])
    first, pair = Counter(got[i][0][0] for i in range(n)), Counter((got[i][0][0], got[i][1][0]) for i in range(n))
    a, b = sorted(full, key=full.get)[:-3:-1]
    p, q = np.exp(full[a]), np.exp(full[b])
    assert abs(first[a] / n - p) < 0.02 and abs(pair[a, b] / n - p * q / (1 - p)) < 0.02
    # inverse inclusion weights make sums over samples unbiased
    assert abs(np.mean([sum(np.exp(log - inc) for _, log, inc in got[i]) for i in range(n)]) - 1) < 0.02


@pytest.mark.parametrize(("text", "k"), [("an", 50), ("the", 50), ("document", 50), ("a  b", 200), ("x▁é", 50), ("", 3)])
def test_all_segmentations_come_when_k_is_large(vocabulary, piece_logs, text, k):
    full = every_segmentation(text, piece_logs) if text else {(): 0.0}
    for got in samples([text] * 5, k, vocabulary).values():
        assert len(got) == len({s for s, _, _ in got}) == min(k, len(full))
        assert all(abs(full[s] - log) < 1e-9 for s, log, _ in got)
        assert all(inc == 0 for _, _, inc in got) or len(full) > k


def test_what_is_left_is_exact_to_the_smallest_share(vocabulary, piece_logs):
    """Paths are taken best first until almost nothing is left; the rest stays exact."""
    full = every_segmentation("document", piece_logs)
    lattices = subword_sampling.Lattices(["▁document"], vocabulary)
    paths = {}

    def go(node, path, log):
        if lattices.end[node]:
            paths[tuple(path)] = log
        else:
            a, logs = lattices.edges_of(node)
            for e, x in enumerate(logs, a):
                go(int(lattices.to[e]), [*path, e], log + x)

    go(0, [], 0.0)
    assert len(paths) == len(full) and np.allclose(sorted(paths.values()), sorted(full.values()))
    order = sorted(paths, key=paths.get, reverse=True)
    taken = subword_sampling.Elsewhere(lattices, 0, list(order[0]))
    for n, path in enumerate(order[1:], 1):
        assert np.isclose(taken.left, np.logaddexp.reduce([paths[p] for p in order[n:]]), rtol=1e-9)
        assert tuple(taken.sample(np.uint64(n))) in order[n:]
        taken.take(list(path))
    assert taken.left == -np.inf
    sizes = np.array([len(p) for p in order])
    rest = lattices.rest(np.concatenate([np.array(p) for p in order]), np.cumsum(sizes) - sizes, sizes)
    assert np.isclose(rest[0], np.logaddexp.reduce([paths[p] for p in order[1:]]), rtol=1e-9)


def test_op6_query(spark, sf_dir, piece_logs):
    rows = subword_sampling.op6_subword_sampling(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    coded = {(r.doc_id, r.sample): r for r in subword_sampling.encode_sampled(docs.withColumn("ids", F.lit(0)).withColumn("sample", F.lit("x")), model=PIECES, k=2, seed=20240506).collect()}
    assert len(rows) == len(coded) and {r.doc_id for r in rows} == set(texts)
    log_of = {i: log for i, log in piece_logs[0].values()}
    least = min(log_of.values())
    for r in rows:
        own = coded[r.doc_id, r.sample]
        assert (r.n_ids, r.ids_crc32, r.log_prob) == (len(own.ids), zlib.crc32(np.array(own.ids, "<u4").tobytes()), own.log_prob)
        assert r.decoded_crc32 == zlib.crc32(texts[r.doc_id].encode())
    pairs = defaultdict(dict)
    for (doc, sample), r in coded.items():
        pairs[doc][sample] = r
    for both in pairs.values():  # the two samples differ, and their weights as the pieces' weights do
        if len(both) == 2:
            assert both[1].ids != both[2].ids
            plain = [sum(log_of.get(i, least) for i in r.ids) for r in (both[1], both[2])]
            assert abs((plain[0] - plain[1]) - (both[1].log_prob - both[2].log_prob)) < 1e-6 * (1 + abs(plain[0]))


def test_sampled_encoding_decodes_to_the_text(spark, awkward, corpus):
    docs = awkward.unionByName(corpus.limit(20)).unionByName(awkward.filter("doc_id = 1").select(F.lit(77).cast("long").alias("doc_id"), F.lit("日本 \n\n𝒳  é ▁a▁ b").alias("text"), "lang", "source", "n_chars"))
    coded = subword_sampling.encode_sampled(docs, model=PIECES, k=2)
    texts = {(r.doc_id, r.text or "") for r in docs.collect()}
    back = subword_sampling.decode(coded, model=PIECES).collect()
    assert {(r.doc_id, r.decoded) for r in back} == texts
    again = {(r.doc_id, r.sample): r.ids for r in subword_sampling.encode_sampled(corpus.limit(20).repartition(3), model=PIECES, k=2).collect()}
    assert all(again[r.doc_id, r.sample] == r.ids for r in back if (r.doc_id, r.sample) in again and r.doc_id not in {d for d, _ in AWKWARD})
    assert subword_sampling.encode_sampled(docs.limit(0), model=PIECES).count() == 0


# --- chat formatting

HOSTILE = ["", "\\", "\\e", "</turn>", "### assistant: x</turn>\n", "a\\", "</turn", "\\b\\h", "###", "##", "\n### user: y", ": : ", "é</turn>\\c"]


def test_chat_round_trip_of_hostile_texts(spark):
    rows = [(c, t, role, HOSTILE[(c + t) % len(HOSTILE)]) for c in range(len(HOSTILE)) for t, role in enumerate(["user", "assistant", "sys:tem###", "assistant"])]
    rows += [(90, None, None, None), (90, 1, "assistant", None), (91, 0, "assistant", "plain"), (91, 0, "assistant", "plain"), (None, 0, "user", "x")]
    out = chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))).collect()
    assert all(r.round_trip for r in out)
    by = defaultdict(list)
    for c, t, role, text in rows:
        by[c].append(((t is not None, t or 0), role or "", text or ""))
    for r in out:
        assert [(t.role, t.text) for t in r.turns] == [(a, b) for _, a, b in sorted(by[r.conv_id])]
        learned = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        if r.escape_level:
            learned = [x.replace("\\e", "</turn>").replace("\\h", "###").replace("\\b", "\\") for x in learned]
        assert learned == [t.text for t in r.turns if t.role == "assistant"]
    assert {r.escape_level for r in out if r.conv_id == 91} == {0}


def test_very_long_turns_come_back(spark):
    long = "### a </turn> \\ é\n" * 20_000
    (row,) = chat_format.format_chats(spark.createDataFrame([(1, 0, "user", long), (1, 1, "assistant", long)], "conv_id long, turn long, role string, text string")).collect()
    assert row.round_trip and [t.text for t in row.turns] == [long, long]


def test_spans_and_learned_text_agree_at_both_levels(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"é text {i} " * (i % 4)) for i in range(40)]
    rows += [(2, i, "assistant" if i % 3 else "us:er", f"\\h ### {i}</turn>\n\n") for i in range(20)] + [(2, 3, "assistant", None)] * 3
    for r in chat_format.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        assert r.escape_level == r.conv_id - 1 and r.round_trip
        cut = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert "".join(cut) == r.loss_text and len(cut) == sum(t.role == "assistant" for t in r.turns)
        plain = [x[3] or "" for x in sorted((x for x in rows if x[0] == r.conv_id and x[2] == "assistant"), key=lambda x: (x[1], x[3] or ""))]
        assert [c if r.escape_level == 0 else c.replace("\\e", "</turn>").replace("\\h", "###").replace("\\b", "\\") for c in cut] == plain


def test_many_turns_take_time_in_proportion(spark):
    def seconds(n):
        rows = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("a text of some length, number "), F.col("id").cast("string")).alias("text"))
        began = time.perf_counter()
        (r,) = chat_format.format_chats(rows).select("round_trip", F.size("loss_spans").alias("spans"), F.char_length("loss_text").alias("chars"), F.sha2("loss_text", 256)).collect()
        assert r.round_trip and r.spans == n // 2
        return time.perf_counter() - began

    seconds(100)
    half, whole = seconds(25_000), seconds(50_000)
    assert whole < 2 * half + 3, (half, whole)


def test_no_chats(spark):
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# --- packing


def test_best_fit_like_plain_python():
    lengths = np.random.default_rng(0).integers(1, 65, 700)
    window, offset, opened = packing.best_fit_decreasing(lengths, 64)
    rooms = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [r for r in rooms if r >= lengths[i]]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - lengths[i])
        else:
            rooms.append(64 - lengths[i])
    assert opened == len(rooms)
    left = np.full(opened, 64)
    np.subtract.at(left, window, lengths)
    assert sorted(left) == sorted(rooms) and (offset + lengths <= 64).all()


def test_packed_ids_are_the_tokenizers(awkward, corpus, documents):
    from tokenizers import Tokenizer

    odd = documents([(1001, "a\x01b \x1c c"), (1002, "it's I'LL no break"), (1003, "ΑΣ ΣΑΣ. <|endoftext|> é")])
    docs = corpus.unionByName(odd)
    plain = {r.doc_id: [*Tokenizer.from_file(BPE).encode(r.text, add_special_tokens=False).ids, 2] for r in docs.collect()}
    pieces = packing.pack_tokens(docs, tokenizer=BPE, capacity=512).collect()
    got, filled = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) <= 512 and p.doc_tokens == len(plain[p.doc_id])
        got[p.doc_id].append((p.start, p.ids))
        filled[p.sequence_id].append((p.offset, p.length))
    for doc, parts in got.items():
        parts.sort()
        assert [i for _, ids in parts for i in ids] == plain[doc] and [s for s, _ in parts] == list(range(0, len(plain[doc]), 512))
    for spans in filled.values():
        spans.sort()
        assert all(a + n == b for (a, n), (b, _) in zip([(0, 0), *spans], spans)) and sum(spans[-1]) <= 512
    assert sum(map(len, plain.values())) > 0.95 * 512 * (len(filled) - docs.rdd.getNumPartitions())
    rows = packing.pack_tokens(awkward, tokenizer=BPE).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(d for d, _ in AWKWARD) and {tuple(r.ids) for r in rows if r.doc_id in (3, 4, 5)} == {(2,)}
    assert packing.pack_tokens(awkward.limit(0), tokenizer=BPE).count() == 0


def test_op9_query(spark, sf_dir):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    filled, got = defaultdict(list), defaultdict(list)
    for r in packing.op9_packing(spark, sf_dir).collect():
        filled[r.sequence_id].append((r.offset, r.length))
        got[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    assert set(got) == set(texts)
    for doc, pieces in got.items():
        ids, at = np.array([*plain.encode(texts[doc], add_special_tokens=False).ids, 2], "<u4"), 0
        for start, length, crc, n in sorted(pieces):
            assert (start, n, crc) == (at, len(ids), zlib.crc32(ids[at : at + length].tobytes()))
            at += length
        assert at == len(ids)
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096


def test_packing_leaves_other_columns_out(awkward):
    clash = awkward.withColumns({"ids": F.lit("x"), "start": F.lit(1), "__pk_text": F.lit(2), "sequence_id": F.lit(None)})
    rows = packing.pack_tokens(clash, tokenizer=BPE).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(d for d, _ in AWKWARD)


def test_packing_checksum(corpus):
    pieces = packing.pack_tokens(corpus, tokenizer=BPE)
    ids = {(r.doc_id, r.start): zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in pieces.collect()}
    finish = (packing.id_checksums, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    rows = packing.pack_tokens(corpus, tokenizer=BPE, finish=finish).collect()
    assert {(r.doc_id, r.start): r.ids_crc32 for r in rows} == ids and sum(r.length for r in rows) == sum(p.length for p in pieces.collect())
