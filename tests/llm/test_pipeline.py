import corpus_pipeline
from tests.llm.conftest import texts_of
from voltmart.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_only_shrink(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.columns == docs.columns, name
        ids = {i for i, _ in texts_of(after)}
        assert ids <= {i for i, _ in texts_of(docs)}
        sizes.append(after.count())
        docs = spark.createDataFrame(after.collect(), after.schema)
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in texts_of(docs)}


def test_run_gives_the_packed_rows(spark):
    found = corpus_pipeline.run(spark, SF_DIR).toPandas()
    assert (found.ids.map(len) == 4 * found.length).all() and sorted(found.sequence_id) == list(range(len(found)))


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
