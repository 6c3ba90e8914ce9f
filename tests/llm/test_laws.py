"""What SQL can say about operators whose rows it cannot make: laws of shards, packings and held-out rows."""

import duckdb
import pytest

from geoloom.llm import language_id, packing, sharding

pytest.importorskip("public_tokenizers")


def ask(df, sf_dir, sql):
    """Rows of SQL over the result r and the table documents."""
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    con.register("r", df.toArrow())
    return con.sql(sql).fetchall()


def test_law_of_shards(spark, sf_dir):
    rows = sharding.op1_sharding(spark, sf_dir)
    sql = """WITH s AS (SELECT shard, count(*) AS n, count(DISTINCT slot) AS slots, min(slot) AS low, max(slot) AS high FROM r GROUP BY shard)
      SELECT (SELECT count(*) FROM documents d FULL JOIN r USING (doc_id) WHERE d.doc_id IS NULL OR r.doc_id IS NULL OR r.size <> octet_length(encode(coalesce(d.text, ''))) + 1),
             count(*), max(n) - min(n) <= 1, bool_and(n = slots AND low = 0 AND high = n - 1), (SELECT count(*) FROM r WHERE law <> 'rows' OR grown_shard IS NOT NULL) FROM s"""
    assert ask(rows, sf_dir, sql) == [(0, 8, True, True, 0)]


def test_law_of_packings(spark, sf_dir):
    rows = packing.op9_packing(spark, sf_dir)
    sql = """WITH p AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY doc_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r),
      q AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY sequence_id ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled FROM r),
      d AS (SELECT doc_id, sum(length) AS n, min(doc_tokens) AS low, max(doc_tokens) AS high FROM r GROUP BY doc_id)
      SELECT (SELECT count(*) FROM p WHERE start <> before), (SELECT count(*) FROM q WHERE "offset" <> filled), (SELECT count(*) FROM d WHERE n <> low OR n <> high OR n < 1),
             (SELECT count(*) FROM documents LEFT JOIN d USING (doc_id) WHERE d.n IS NULL), (SELECT max(n) <= 4096 FROM (SELECT sum(length) AS n FROM r GROUP BY sequence_id)), (SELECT count(*) FROM r WHERE length < 1)"""
    assert ask(rows, sf_dir, sql) == [(0, 0, 0, 0, True, 0)]


def test_law_of_held_out_rows(spark, sf_dir):
    sql = """WITH RECURSIVE steps AS (SELECT range AS b, range AS c, 0 AS k FROM range(256) UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
      crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8), x AS (SELECT doc_id, hex(encode(doc_id::VARCHAR)) AS x FROM documents),
      h AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)), lambda c, y: xor(t[xor(c & 255, y) + 1], c >> 8)), 4294967295::BIGINT) AS h FROM x, crc)
      SELECT count(*) = (SELECT count(*) FROM documents), bool_and(held_out = (h % 4 = 2)), bool_and(score BETWEEN 0 AND 1), bool_and(lang_pred IN (SELECT lang FROM documents) OR lang_pred = 'und') FROM r JOIN h USING (doc_id)"""
    assert ask(language_id.op5_language_id(spark, sf_dir), sf_dir, sql) == [(True, True, True, True)]
