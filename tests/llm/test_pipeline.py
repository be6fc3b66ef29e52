import corpus_pipeline
from colsieve.llm import queries


def test_stages_in_order(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = stage(spark, docs, small).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        after = [r.doc_id for r in docs.collect()]
        assert set(after) <= before and len(after) == len(set(after))
        kept.append(len(after))
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.7 * kept[0]
    mixed = corpus_pipeline.run(spark, small).collect()
    assert sorted(r.doc_id for r in mixed) == sorted(after)


def test_stages_take_awkward_rows(spark, clashing, no_docs, small):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, small).columns == clashing.columns
        assert stage(spark, no_docs, small).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, clashing, small).count() == clashing.count()


def test_ten_queries_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
