import zlib

import pytest
from conftest import DOCS

from llm.language import identify_language, learn_dictionaries, letters


def test_letters():
    assert letters("Hé!! 12 _x") == " hé x " and letters("12 ?! _") == "" and letters("") == "" and letters("²½") == ""


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    own = rows[rows.held_out]
    assert (own.lang_pred == own.lang).mean() > 0.97
    assert rows.score.between(0, 1).all() and set(rows.lang_pred) == {"en", "de", "fr", "es"}
    assert (rows[~rows.rejected].lang_pred == rows[~rows.rejected].lang).mean() >= (rows.lang_pred == rows.lang).mean()


def test_held_out_languages_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = docs.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 'zz' else lang end as lang", "'q' as source")
    key = lambda d: {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify_language(d).collect()}
    assert key(docs) == key(hidden)


def test_parts_in_another_language_decide(spark):
    """Whole texts are judged: a short beginning doesn't outweigh the rest."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    some = {r["lang"]: r["t"] for r in docs.where("length(text) > 1500").groupBy("lang").agg({"text": "max"}).withColumnRenamed("max(text)", "t").collect()}
    mixed = docs.unionByName(spark.createDataFrame([(10**6, some["de"][:200] + " " + some["fr"] * 40, None, None, None)], DOCS))
    assert identify_language(mixed).where("doc_id = 1000000").first()["lang_pred"] == "fr"


@pytest.mark.parametrize("margin", [0.005, 0.5])
def test_edges(edges, empty, margin):
    rows = identify_language(edges, reject_margin=margin).collect()
    assert len(rows) == edges.count()
    for r in rows:
        blank = r["doc_id"] in (3, 4, 5)
        assert not blank or (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
        assert 0 <= r["score"] <= 1
    assert identify_language(empty).count() == 0
    assert {r["lang_pred"] for r in identify_language(edges.selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}


def test_every_language_and_every_chosen_document_is_learned(spark):
    """Each document gives an equal share, from somewhere in its whole text; few and short documents make a language, too."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"first {'same ' * 300}" + f"{chr(97 + k // 26)}{chr(97 + k % 26)}zz " * 300, "long", "", 0) for k, i in enumerate(ids[:150])]
    rows += [(i, "kurz ja", "tiny", "", 0) for i in ids[150:153]]
    found = learn_dictionaries(spark.createDataFrame(rows, DOCS), "doc_id", "text", "lang", 30_000, 200)
    assert set(found) == {"long", "tiny"} and len(found["long"]) <= 150 * 200
    assert len([k for k in range(150) if f"{chr(97 + k // 26)}{chr(97 + k % 26)}zz".encode() in found["long"]]) > 30
    docs = spark.createDataFrame([*rows, (ids[200], "kurz ja kurz ja", None, "", 0)], DOCS)
    assert identify_language(docs, dictionary_bytes=30_000).where(f"doc_id = {ids[200]}").first()["lang_pred"] == "tiny"
