import random

import pytest

EXTRA = "n long, row long, key string, a long, b long, h long, component long, size long, start long, block long, slot long, words long, spans string, epoch long, score double, predicted int, kept boolean, held_out boolean, vec string, digest string, band int, others string, pieces string, partly boolean, uid long"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, stock: int = 4000) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(["ka", "lo", "mi", "re", "su", "ti", "vo", "ne"]) for _ in range(1 + draw.randrange(stock) % 5)) + str(draw.randrange(stock)) for _ in range(n)]


def edge_rows() -> list[tuple]:
    long_text = " ".join(prose(1, 60_000))
    plain = " ".join(prose(2, 120))
    return [
        (1, plain, "en", "s1", 10),
        (1, plain, "en", "s1", 10),  # the same row again
        (2, plain, "en", "s1", 10),  # an equal text
        (3, None, "en", "s1", None),
        (4, "", None, "s2", 0),
        (5, " \t\n\x0b ", "fr", None, 5),
        (6, long_text, "en", "s2", None),
        (7, "one", "de", "s2", 3),
        (8, "Ünï çødé ☃ 漢字 \U0001f600\nzwei drei", "de", "s3", 3),
        (None, plain, "en", "s1", 10),
        (None, None, None, None, None),
    ]


@pytest.fixture(scope="session")
def edges(spark):
    """Documents with nulls in every column, empty, blank and very long texts, ties and repeated rows, and columns named like the operators' own."""
    rows = spark.createDataFrame(edge_rows(), DOCS).repartition(3)
    names = [x.split() for x in EXTRA.split(", ")]
    return rows.selectExpr("*", *[f"cast(null as {kind}) as {name}" for name, kind in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark, folder):
    """Documents of the smallest tables, in memory as well: (DataFrame, {doc_id: row})."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return docs, {r["doc_id"]: r for r in docs.collect()}
