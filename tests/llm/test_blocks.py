"""Blocks of benchmark words: counted in every script, and equal to one block."""

from tests.llm.conftest import rows_of
from voltmart.llm import decontaminate


def test_words_of_any_script_fill_blocks(spark, odd_docs):
    words = [f"слово{i} λέξη{i} w{i}" for i in range(400)]
    items = spark.createDataFrame([(f"i{k}", " ".join(words[k * 10 : k * 10 + 10])) for k in range(40)], "item_id string, text string")
    docs = spark.createDataFrame(
        [(i, "Начало. " + " ".join(words[i * 7 : i * 7 + 9]).upper().lower() + " end") for i in range(40)] + [(1, None), (None, "")] * 2,
        "doc_id long, text string",
    ).repartition(3)
    assert len(decontaminate.automata(items, 13, 10**6, "item_id", "text")) == 1
    assert len(decontaminate.automata(items, 13, 200, "item_id", "text")) == 6  # 1,200 words
    columns = ["doc_id", "text_hash", "n_words", "n_hit", "spans", "items", "longest"]
    one, many = (rows_of(decontaminate.scan(docs, items, block_words=n), *columns) for n in (10**6, 200))
    assert one == many and sum(r[3] > 0 for r in one) >= 30


def test_equal_rows_are_rows_each(spark):
    items = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(13)))], "item_id string, text string")
    docs = spark.range(20_000).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'x ' || concat_ws(' ', transform(sequence(0, 12), i -> 'w' || i)) AS text")
    found = decontaminate.verdicts(decontaminate.scan(docs, items))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.filter("contaminated AND n_hit = 13 AND n_words = 14").count() == 20_000
