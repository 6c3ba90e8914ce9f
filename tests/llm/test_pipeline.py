"""The pipeline's stages against plain versions, each on its own input."""

from collections import Counter

import corpus_pipeline as pipeline
from geoloom.llm.common import written

from .conftest import AWKWARD
from .test_dedup import plain_components, plain_lines


def test_stages_chain_and_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "packing"]
    kept = written(pipeline.STAGES[0][1](spark, docs, sf_dir), "t")
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
    lines = written(pipeline.STAGES[1][1](spark, kept, sf_dir), "t")
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert lines.columns == columns and Counter((r.doc_id, r.text) for r in lines.collect()) == Counter((d, t) for d, t, _, _ in plain_lines(rows).elements())
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    near = written(pipeline.STAGES[2][1](spark, lines, sf_dir), "t")
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    assert near.columns == columns and {r.doc_id for r in near.collect()} == {d for d, _, c in plain_components(rows, 5, 4, 5) if d == c}
    packed = pipeline.STAGES[3][1](spark, near, sf_dir)
    whole = Counter()
    for p in packed.collect():
        whole[p.doc_id, p.doc_tokens] += p.length
    assert {d for d, _ in whole} == {r.doc_id for r in near.collect()} and all(n == got for (_, n), got in whole.items())


def test_awkward_documents_run_through(spark, documents, tmp_path):
    documents(AWKWARD).write.parquet(str(tmp_path / "documents.parquet"))
    rows = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == {1, 2, 7, 8, None}
    documents([]).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert pipeline.run(spark, str(tmp_path / "none")).count() == 0
