import os

import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that clash with names the operators use inside.
CLASHING = "_maybe string, _p int, key bigint, node bigint, row string, gone string, `a.b` string, score double"
LINE = "the quick brown fox jumps over the lazy dog while seven wizards brew ale number {}"


def edge_rows():
    """Nulls in every column, empty and very long texts, copies, ties and a repeated row."""
    body = "\n".join(LINE.format(f"{k} {'abcdefgh'[k % 8]}") for k in range(12))
    long = " ".join(f"word{k % 977}x{k}" for k in range(40_000))
    texts = {
        1: None, 2: "", 3: " \n\t\n ", 4: body, 5: body, 6: body.replace("fox", "cat", 1), 7: long,
        8: "!!! ###", 9: "ein kurzer satz", 10: body, 11: "a\n\nb", 12: "é" * 5000, 13: "a b c " * 400,
    }
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None) for i, t in texts.items()]
    return [*rows, rows[3], (None, body, None, None, 5), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def clashing(spark, edge):
    names = [c.strip().split(" ") for c in CLASHING.split(",")]
    return edge.selectExpr("*", *[f"cast(1 as {kind}) as {name}" for name, kind in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def learn_dir(sf_dir):
    """Data with enough labelled documents to learn from."""
    return os.path.join(os.path.dirname(sf_dir), "sf0.01")
