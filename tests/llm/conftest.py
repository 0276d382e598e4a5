import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, tag int, key long, spans string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns whose names the operators use inside."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["ta", "ri", "no", "él", "SU", "ka"]) for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(60))
    rows = [
        (0, "", "en"), (1, None, "en"), (2, " \t\n ", None), (3, "Één woord", "nl"), (4, passage, "en"),
        (5, "Intro. " + passage + " end.", "en"), (6, passage, "en"), (6, passage, "en"), (None, passage, "en"),
        (None, None, None), (7, "#$%& ###", "en"), (8, "line one\n" * 40, "en"), (9, "a" * 700, "en"),
        (10, " ".join(word() for _ in range(6000)), "es"), (11, "Licensed under CC BY-NC 4.0.", "en"),
    ]
    rows += [(100 + i, " ".join(word() for _ in range(rng.randint(1, 90))), "es") for i in range(25)]
    rows = [(i, t, lang, "s", 1, 2, 3, 4, "x") for i, t, lang in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)


def texts_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
