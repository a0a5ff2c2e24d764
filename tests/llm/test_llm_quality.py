import zlib

import numpy as np
import pyarrow as pa

from llm.quality import FEATURES, AttentionModel, passage_features, score_quality

LABELS = "doc_id long, quality int, toxic int"


def test_passages():
    features, begin = passage_features(pa.array(["a b " * 40, "", None, "x" * 1000, " \n ", "Hi!! YOU!!"]))
    assert begin.tolist() == [0, 2, 3, 4, 5, 6, 7] and features.shape == (7, FEATURES)
    assert not features[2].any() and not features[3].any() and not features[5].any()
    assert np.isfinite(features).all() and features[0].any()
    again, _ = passage_features(pa.array(["Hi!! YOU!!"]))
    assert (again[0] == features[6]).all()


def test_gradients_are_the_slopes():
    draw = np.random.default_rng(1)
    model = AttentionModel(encoded=5, gates=3)
    x, begin, y = draw.standard_normal((9, FEATURES)) * 0.2, np.array([0, 3, 4, 9]), np.array([1.0, 0.0, 1.0])
    weight = np.array([0.5, 1.0, 0.25])

    def loss():
        s = model.forward(x, begin)["score"]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    gradients = model.gradients(x, begin, y, weight)
    for name, value in model.p.items():
        flat, slope = value.reshape(-1), gradients[name].reshape(-1)
        for k in range(0, len(flat), max(1, len(flat) // 5)):
            old = flat[k]
            flat[k] = old + 1e-5
            high = loss()
            flat[k] = old - 1e-5
            low = loss()
            flat[k] = old
            assert abs((high - low) / 2e-5 - slope[k]) < 1e-6


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = score_quality(docs, labels).join(labels, "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]).all()
    own = rows[rows.held_out]
    good, bad = own[own.quality == 1].score.to_numpy(), own[own.quality == 0].score.to_numpy()
    assert (good[:, None] > bad).mean() > 0.98
    assert ((own.score >= 0.3) == (own.quality == 1)).mean() > 0.95
    assert ((own.predicted == 1) == (own.score >= 0.3)).all()


def test_only_the_text_and_the_learning_fold_count(spark, folder):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 then 1 - quality else quality end as quality", "toxic")
    plain = {r["doc_id"]: r["score"] for r in score_quality(docs, labels).collect()}
    blind = docs.selectExpr("doc_id", "text", "'xx' as lang", "'yy' as source")
    assert plain == {r["doc_id"]: r["score"] for r in score_quality(blind, turned).collect()}


def test_edges(spark, edges, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (6, 0, None), (7, 2, 0), (8, 0, 0), (8, 0, 0)], LABELS)
    rows = score_quality(edges, labels).collect()
    assert len(rows) == edges.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1 and all(r["held_out"] for r in rows if r["doc_id"] is None)
    assert score_quality(empty, labels).count() == 0
    assert {r["score"] for r in score_quality(edges, labels.where("false")).collect()} == {0.5}
