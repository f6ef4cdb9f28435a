"""The pipeline's stages and their order."""

import corpus_pipeline
from deskpulse.llm import bpe_tree
from deskpulse.llm.queries import ORACLES, QUERIES


def test_stages_on_whole_table(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs, ids = documents, [{r["doc_id"] for r in documents.collect()}]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == documents.columns
        ids.append({r["doc_id"] for r in docs.collect()})
    assert all(after <= before for before, after in zip(ids, ids[1:]))
    assert len(ids[1]) < len(ids[0]) and len(ids[2]) < len(ids[1]) and ids[3] == ids[2] and ids[5] == ids[4]
    texts = bpe_tree.decode_ids(docs).select("doc_id", "text").collect()
    clean = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(r["text"] == clean[r["doc_id"]] or "[SECRET]" in r["text"] for r in texts)


def test_run_gives_ids(spark, sf_dir):
    df = corpus_pipeline.run(spark, sf_dir)
    assert df.columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    assert df.count() > 0


def test_every_operator_has_a_query():
    assert [int(n.split("_")[0][2:]) for n in QUERIES] == list(range(1, 11))
    assert set(ORACLES) <= set(QUERIES)


def test_every_query_counts_all_rows(spark, sf_dir):
    def rows(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").count()

    for name in ("op3_quality_classifier", "op8_secret_scan"):
        assert QUERIES[name](spark, sf_dir).count() == rows("documents")
