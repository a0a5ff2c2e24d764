import random

import numpy as np
import pytest
from conftest import DOCS, prose

from llm import decontaminate
from llm.decontaminate import answer_at, benchmark_hits, masks_of, randomised_svd, subsequence

ITEMS = "item_id long, text string, part string, doc_id long, space string"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(row[-1], last[j + 1]))
    return row[-1]


def test_subsequences():
    draw = random.Random(3)
    for _ in range(300):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(1, 90))] for _ in range(2))
        assert subsequence(masks_of(np.array(a)), b) == longest(a, b)


def test_answers():
    assert answer_at("What is it? It is a cat.") == 3 and answer_at("one two three four five six seven eight") == 6 and answer_at("word") == 0


def test_singular_vectors(spark):
    draw = np.random.default_rng(4)
    dense = draw.standard_normal((300, 8)) @ draw.standard_normal((8, 700)) + 0.01 * draw.standard_normal((300, 700))
    scale = draw.uniform(0.5, 2, 300)
    columns = np.arange(700, dtype="<i4").tobytes()
    rows = [(bytearray(columns), bytearray(r.astype("<f4").tobytes()), float(s)) for r, s in zip(dense, scale)]
    found = randomised_svd(spark.createDataFrame(rows, "columns binary, vals binary, scale double").repartition(5), 700, 8, 12)
    _, _, exact = np.linalg.svd(dense * scale[:, None], full_matrices=False)
    assert found.shape == (700, 8)
    overlap = np.linalg.svd(exact[:8] @ found, compute_uv=False)
    assert overlap.min() > 0.999


def items():
    out = {}
    for k in range(60):
        w = prose(9000 + k, 20 + k % 50)
        cut = len(w) * 2 // 3
        out[k] = " ".join(w[:cut]).capitalize() + ". " + " ".join(w[cut:]).capitalize() + "."
    out[60] = " ".join(prose(9500, 400))  # a long item
    return out


@pytest.fixture(scope="module")
def planted():
    """doc_id -> (text, the item in it or None): whole, a fifth reworded, half of all before the answer reworded, signs changed, clean."""
    draw, docs = random.Random(8), {}
    for k, text in items().items():
        around = prose(k, 30 + 11 * k % 700)
        for kind in ("whole", "fifth", "half", "signs"):
            words = text.split()
            if kind in ("fifth", "half"):
                share, to = (5, len(words)) if kind == "fifth" else (2, len(words) * 2 // 3)
                for p in draw.sample(range(to), to // share):
                    words[p] = f"other{draw.randrange(10**6)}"
            if kind == "signs":
                words = [w.upper() + draw.choice(["&&&", "!!", ",", ""]) for w in words]
            at = draw.randrange(len(around))
            docs[len(docs)] = (" ".join(around[:at] + words + around[at:]), k if k != 60 or kind != "half" else None, kind)
    for k in range(200):
        docs[len(docs)] = (" ".join(prose(20000 + k, 20 + 5 * k)), None, "clean")
    # Half an item is not the item.
    for k in range(0, 30, 3):
        docs[len(docs)] = (" ".join(prose(30000 + k, 80) + items()[k].split()[: len(items()[k].split()) // 3]), None, "clean")
    return docs


def test_planted_passages(spark, planted):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, (t, _, _) in planted.items()], DOCS).repartition(5)
    bench = spark.createDataFrame([(k, t, None, None, None) for k, t in items().items()], ITEMS)
    found = {(r["doc_id"], r["item_id"]): r for r in benchmark_hits(docs, bench).collect()}
    wanted = {(i, k): kind for i, (_, k, kind) in planted.items() if k is not None}
    assert not [p for p in found if p not in wanted and planted[p[0]][2] == "clean"]
    for kind, least in (("whole", 1.0), ("signs", 1.0), ("fifth", 0.95), ("half", 0.9)):
        own = [p for p, x in wanted.items() if x == kind]
        assert sum(p in found for p in own) >= least * len(own), kind
    assert all(found[p]["common"] == 1 for p, x in wanted.items() if x == "whole" and p[1] != 60)


def test_blocks_of_items_find_the_same(spark, planted):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, (t, _, kind) in planted.items() if kind in ("whole", "clean")], DOCS)
    bench = spark.createDataFrame([(k, t, None, None, None) for k, t in items().items()], ITEMS)
    key = lambda b: {(r["doc_id"], r["item_id"]) for r in benchmark_hits(docs, bench, block=b).collect()}
    assert key(10) == key(256)


def test_recall_against_brute_force(spark, small, folder):
    docs, rows = small
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    flat = lambda t: " " + " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()) + " "
    held = {i: flat(r["text"]) for i, r in rows.items()}
    wanted = {(i, b["item_id"]) for b in bench.collect() for i in held if flat(b["text"]) in held[i]}
    found = {(r["doc_id"], r["item_id"]) for r in benchmark_hits(docs, bench).collect()}
    assert wanted and len(wanted & found) >= 0.9 * len(wanted)


def test_answers_of_their_own(spark):
    w = prose(1, 40)
    docs = spark.createDataFrame([(1, " ".join(w[:24] + prose(2, 10)), "", "", 0), (2, " ".join(w[:24] + ["forty", "two"]), "", "", 0)], DOCS)
    bench = spark.createDataFrame([(5, " ".join(w), "forty two")], "item_id long, text string, reply string")
    assert {r["doc_id"] for r in benchmark_hits(docs, bench, answer_col="reply").collect()} == {2}


def test_edges(spark, edges, empty):
    none = spark.createDataFrame([], ITEMS)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None), (None, "a b", None, None, None), (3, "one", None, None, None), (3, "one", None, None, None)], ITEMS)
    copy = spark.createDataFrame([(9, " ".join(prose(2, 120)), None, None, None)], ITEMS)
    assert benchmark_hits(edges, none).count() == 0 and benchmark_hits(empty, copy).count() == 0
    assert {(r["doc_id"], r["item_id"]) for r in benchmark_hits(edges, odd).collect()} == {(7, 3)}
    assert {(r["doc_id"], r["item_id"]) for r in benchmark_hits(edges, copy).collect()} == {(1, 9), (2, 9)}


def test_items_in_many_documents(spark):
    """Words of an item that leaked into a third of the documents are common words themselves, in part or all of them."""
    leaked, rare = " ".join(prose(70, 36)), items()[3]
    docs = [(k, " ".join(prose(50000 + k, 20 + k % 60)), "en", "s", 1) for k in range(1200)]
    docs = [(i, f"{t} {leaked}" if i % 3 == 0 else f"{t} {rare}" if i == 7 else t, *rest) for i, t, *rest in docs]
    bench = spark.createDataFrame([(1, leaked, None, None, None), (2, rare, None, None, None)], ITEMS)
    found = {(r["doc_id"], r["item_id"]) for r in benchmark_hits(spark.createDataFrame(docs, DOCS).repartition(4), bench).collect()}
    assert found == {(i, 1) for i, *_ in docs if i % 3 == 0} | {(7, 2)}


def test_short_items_are_found_whole_only(spark):
    texts = ["they asked What is the capital of France? today", "what was the name of the capital city of france then", "the capital is of what france", "is the capital of france", "nothing of it"]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCS)
    bench = spark.createDataFrame([(1, "What is the capital of France?", None, None, None)], ITEMS)
    assert {r["doc_id"] for r in benchmark_hits(docs, bench).collect()} == {0}


def test_search_space_is_of_all_passages(spark, monkeypatch):
    item = " ".join(prose(70, 36))
    docs = spark.range(0, 6000, 1, 4).selectExpr("id AS doc_id", f"concat('{item.split()[0]} ', id) AS text")
    bench = spark.createDataFrame([(1, item, None, None, None)], ITEMS)
    rows = []
    monkeypatch.setattr(decontaminate, "randomised_svd", lambda matrix, *rest: rows.append(matrix.count()) or randomised_svd(matrix, *rest))
    assert benchmark_hits(docs, bench).count() == 0 and rows == [6001]


def test_passages_are_weighed_and_multiplied_in_one_worker(spark, monkeypatch, capsys):
    """Two steps of a stage took two workers for each of an executor's tasks."""
    bench = spark.createDataFrame([(1, " ".join(prose(70, 36)), None, None, None)], ITEMS)
    steps, summed = [], decontaminate._summed
    monkeypatch.setattr(decontaminate, "_summed", lambda parts, kind: parts.explain() or steps.append(capsys.readouterr().out.count("MapInArrow")) or summed(parts, kind))
    benchmark_hits(spark.createDataFrame([(k, " ".join(prose(k, 50)), "en", "s", 1) for k in range(20)], DOCS), bench)
    assert steps == [1, 1]


def test_counts_in_bins_lose_no_stretch():
    units = decontaminate.Units.of([(k, t, None) for k, t in items().items()] + [(99, "four short words here", None)])
    search = decontaminate.Search(units, np.ones(len(units.features), np.float32), np.ones((len(units.features), 1), np.float32), decontaminate.LIMITS)
    draw = np.random.default_rng(5)
    texts = [np.concatenate([draw.integers(0, 3, draw.integers(0, 90)), units.words[k][: draw.integers(1, 97)], np.zeros(draw.integers(0, 40), int)]) for k in draw.integers(0, len(units.words), 60)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    begin, n = decontaminate.halves(first)
    at, feature = units.matched(np.concatenate(texts))
    half, unit = (x.ravel() for x in np.indices((int(begin[-1]), len(units.words))))
    text = np.searchsorted(begin, half, side="right") - 1
    where = at, feature, first, text, first[text] + (half - begin[text]) * decontaminate.HALF, unit
    enough, possible = search.enough(*where), search.possible(*where)
    assert enough.any() and not (enough & ~possible).any() and not possible.all()
