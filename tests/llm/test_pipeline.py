import hashlib
import re

import corpus_pipeline
from threadmill.llm import near_dedup, pii, quality


def test_stages_act(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "pii", "packing"]
    outs = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
        assert out.columns == docs.columns
        outs.append((docs, out))
        docs = out
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in outs[0])
    model = quality.train(outs[0][0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keep = {r.doc_id for r in quality.score(outs[0][0], model).filter("keep").collect()}
    assert set(after) == keep and 0 < len(keep) < len(before)
    norm = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0d]", "", t or "").encode()).hexdigest()
    texts = [norm(r.text) for r in outs[1][1].collect()]
    assert len(texts) == len(set(texts)) == len({norm(r.text) for r in outs[1][0].collect()})
    assert outs[2][1].count() == near_dedup.classes(outs[2][0]).filter("kept").count()
    assert not any(pii.find(r.text or "") for r in outs[3][1].collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    docs = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        assert docs.count() == 0


def test_stages_take_nulls_repeats_and_clashing_columns(spark, sf_dir):
    prose = "The old house stood by the river and the people came to see it in the summer when the days were long. " * 3
    rows = [(1, prose), (1, prose), (2, prose.replace(" ", "  ")), (3, prose + "It was good."), (None, prose + "Write to a@b.cd now."), (5, None), (6, ""), (7, "word " * 4000)]
    docs = spark.createDataFrame([(i, t, "en", None, 1, 2, 3, "k", 4, 5) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row long, node long, _row string, _kept_id long, by long")
    schema = docs.schema
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, sf_dir).collect()
        assert all(tuple(r)[2:] == ("en", None, 1, 2, 3, "k", 4, 5) for r in out), name
        if name != "pii":
            assert all(tuple(r) in before for r in out), name
        docs = spark.createDataFrame(out, schema)
        if name == "exact_dedup":
            texts = ["".join((r.text or "").split()) for r in out]
            assert len(texts) == len(set(texts))
        if name == "near_dedup":
            assert sum((r.text or "").startswith("The old") for r in out) <= 1
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sorted({(p.doc_id is None, p.doc_id or 0) for p in pieces}) == sorted({(r.doc_id is None, r.doc_id or 0) for r in docs.collect()})


def test_queries_run_over_whole_tables(spark, sf_dir):
    from threadmill.llm.queries import QUERIES

    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name, query in QUERIES.items():
        assert query(spark, sf_dir).count() >= n, name
