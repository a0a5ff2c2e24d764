from collections import Counter

import pytest
from conftest import DOCS, prose
from pyspark.sql import functions as F

import corpus_pipeline
from llm.mixing import mix_sources, mixed_documents, permuted, running_total


def water(sizes: dict, weights=(5, 2, 1), ratio=1.5, cap=2.0) -> dict:
    """Targets by the rule as it is told: cut what is above a cap, share the excess among the others, again and again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, rest = {}, set(names)
    while True:
        left = ratio * sum(sizes.values()) - sum(full.values())
        total = sum(weight[s] for s in rest)
        share = {s: left * weight[s] / total for s in rest}
        over = {s for s in rest if share[s] > cap * sizes[s]}
        if not over:
            return full | share
        full |= {s: cap * sizes[s] for s in over}
        rest -= over


def test_permutations_are_onto(spark):
    for n in (1, 2, 3, 17, 256, 1000):
        rows = spark.range(n).select(permuted(F.col("id"), F.lit(n), 3, F.lit(7)).alias("p"), permuted(F.col("id"), F.lit(n), 4, F.lit(7)).alias("q")).collect()
        assert sorted(r["p"] for r in rows) == sorted(r["q"] for r in rows) == list(range(n))
        assert n < 17 or [r["p"] for r in rows] != [r["q"] for r in rows] != list(range(n))


def test_running_totals(spark):
    rows = [(g, k // 7, k, (k * 13) % 5) for g in ("a", None) for k in range(50)]
    found = running_total(spark.createDataFrame(rows, "g string, c long, k long, v long"), ["g"], "c", ["k"], "v", "t").collect()
    assert len(found) == 100 and all(r["t"] == sum((j * 13) % 5 for j in range(r["k"])) for r in found)


def words(text):
    return (text or "").encode().split()


@pytest.fixture(scope="module")
def mixed(small):
    docs, rows = small
    return rows, {r["doc_id"]: r for r in mix_sources(docs).taken().collect()}


def test_targets_and_words_taken(mixed):
    rows, found = mixed
    sizes = {}
    for r in rows.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    target, taken = water(sizes), {}
    assert set(found) == set(rows)
    for i, r in found.items():
        source = rows[i]["source"]
        assert r["size"] == len(words(rows[i]["text"])) and r["source_size"] == sizes[source]
        assert abs(r["target"] - target[source]) < 1e-6 * target[source] and 0 <= r["taken"] <= 2 * r["size"]
        taken[source] = taken.get(source, 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 130 for s in sizes)  # about a block


def test_reruns_agree(small, mixed):
    docs, _ = small
    again = {r["doc_id"]: r for r in mix_sources(docs.repartition(7)).taken().collect()}
    assert again == mixed[1]


def test_slots(small):
    docs, _ = small
    mix = mix_sources(docs, block=16, shard=32)
    slots = mix.slots.toPandas()
    assert sorted(slots.slot) == list(range(len(slots))) and (slots.shard == slots.slot // 32).all()
    # Every block once in an epoch, epochs filled in order; counts per shard vary as draws do.
    assert not slots.duplicated(["sid", "epoch", "block"]).any() and slots.epoch.max() <= 1
    twice = slots[slots.epoch == 1].sid.unique()
    blocks = mix.documents.groupBy("sid").agg(F.max("source_size").alias("n")).toPandas().set_index("sid").n
    for sid in twice:
        assert (slots[(slots.sid == sid) & (slots.epoch == 0)].block.nunique()) == -(-blocks[sid] // 16)
    counts = slots.groupby(["shard", "sid"]).size().unstack(fill_value=0)
    assert counts.to_numpy().std(axis=0).max() > 0.5


def test_words_of_the_mixed_documents(small):
    docs, rows = small
    mix = mix_sources(docs)
    taken = {r["doc_id"]: r["taken"] for r in mix.taken().collect()}
    found = mixed_documents(docs, mix).collect()
    total = {}
    for r in found:
        assert r["source"] == rows[r["doc_id"]]["source"]
        own, part = words(rows[r["doc_id"]]["text"]), words(r["text"])
        rest = iter(own)
        assert all(w in rest for w in part)  # in order
        assert len(part) < len(own) or r["text"] == rows[r["doc_id"]]["text"]
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + len(part)
    assert total == {i: n for i, n in taken.items() if n}


def test_plans_hold_no_python(small):
    docs, _ = small
    mix = mix_sources(docs)
    for frame in (mix.taken(), mixed_documents(docs, mix)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_edges(spark, edges, empty):
    mix = mix_sources(edges)
    rows = mix.taken().collect()
    assert len(rows) == edges.count() and all(r["taken"] <= 2 * r["size"] for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert len(by_id[1]) == 2 and len(by_id[None]) == 2 and all(by_id[k][0]["taken"] == 0 for k in (3, 4, 5))
    assert by_id[5][0]["source_size"] == 0 and by_id[5][0]["target"] == 0  # a null source without a word, but for the null row
    kept = mixed_documents(edges, mix)
    assert kept.columns == edges.columns and {r["doc_id"] for r in kept.collect()} <= {2, 6, 7, 8}
    assert mix_sources(empty).taken().count() == 0 and mixed_documents(empty, mix_sources(empty)).count() == 0
    blank = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", "b", 0)], DOCS)
    assert sorted((r["doc_id"], r["taken"], r["target"]) for r in mix_sources(blank).taken().collect()) == [(1, 0, 0.0), (2, 0, 0.0)]


def test_one_source_holds_most_words(spark):
    docs = spark.createDataFrame([(k, " ".join(prose(k, 200)), None, "a" if k < 80 else f"s{k % 4}", 0) for k in range(90)], DOCS)
    rows = mix_sources(docs, block=32).taken().collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = r["source_size"]
    target, taken = water(sizes), {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 33 for s in sizes)


def test_rows_with_repeated_and_null_ids_are_mixed(spark):
    text = [" ".join(prose(100 + k, 150 + 40 * k)) for k in range(6)]
    ids = [(1, 0), (1, 0), (2, 1), (2, 2), (None, 3), (None, 3), (None, 4), (5, 5)]
    rows = [(i, text[t], "en", "a", len(text[t])) for i, t in ids]
    found = [corpus_pipeline.mix(spark, spark.createDataFrame(rows, DOCS).repartition(n), "") for n in (3, 5)]
    found = [Counter(tuple(r) for r in f.collect()) for f in found]
    # Every row whole in the first epoch, and half of all words again.
    assert not Counter(rows) - found[0] and found[0] == found[1]
    total = sum(len(words(r[1])) for r in rows)
    assert abs(sum(n * len(words(r[1])) for r, n in found[0].items()) - 1.5 * total) <= 130
