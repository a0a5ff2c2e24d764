import random

import numpy as np
import pyarrow as pa
from conftest import DOCS, prose
from plain import linked_components, shingles

from llm import text as T
from llm.graph import components
from llm.ngram_jaccard import _pack, _unpack, ngram_jaccard_components


def held(result) -> dict:
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in result.collect()}


def wanted(texts: dict) -> dict:
    sets = {i: shingles(t) for i, t in texts.items()}
    found = linked_components(sets)
    return {i: (len(sets[i]), found[i]) for i in sets}


def test_words_and_shingles_are_pythons():
    texts = ["a b  c\td\ne f", "", None, "A É b", "x", " \x0b\x0c ", "b" * 50 + " end", "tail "]
    raw, bounds = T.buffers(pa.array(texts))
    starts, ends, first = T.words(T.lowered(raw), bounds)
    got = [bytes(T.lowered(raw)[a:b]) for a, b in zip(starts, ends)]
    for k, t in enumerate(texts):
        assert got[first[k] : first[k + 1]] == (t or "").encode().lower().split()
    values, begin = T.shingle_sets(pa.array(texts))
    assert [int(x) for x in np.diff(begin)] == [len(shingles(t)) for t in texts]


def test_words_of_neighbouring_texts_do_not_join():
    _, begin = T.shingle_sets(pa.array(["one", "two", "three"]))
    assert np.diff(begin).tolist() == [1, 1, 1]
    a, _ = T.shingle_sets(pa.array(["x y", "one"]))
    b, _ = T.shingle_sets(pa.array(["one"]))
    assert a[-1] == b[0]


def test_packed_counts_come_back():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 48, 5000, dtype=np.uint64).repeat(2))
    values, counts = _unpack(_pack(keys))
    assert (values == np.unique(keys)).all() and (counts == 2).all()


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(201, 260)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    assert found == {**{k: 0 for k in range(61)}, **{k: 200 for k in range(200, 260)}}


def test_small_tables(small):
    docs, rows = small
    assert held(ngram_jaccard_components(docs)) == wanted({i: r["text"] for i, r in rows.items()})


def test_near_copies_chains_and_shared_passages(spark):
    """Chains of near copies, a large group of copies with changes, a passage in very many documents, pairs right at the bound."""
    draw, texts = random.Random(5), {}
    passage, base = " ".join(prose(3, 60)), prose(4, 100)
    for k in range(150):  # one passage, otherwise unlike
        own = prose(100 + k, 30 + k % 90)
        texts[len(texts)] = " ".join(own[:10]) + " " + passage + " " + " ".join(own[10:])
    for k in range(150):  # near copies: some words changed, so that many pairs are close to the bound
        own = list(base)
        for _ in range(draw.randrange(1, 4)):
            own[draw.randrange(len(own))] = f"w{draw.randrange(10**6)}"
        texts[len(texts)] = " ".join(own)
    walk = prose(6, 120)
    for k in range(40):  # a chain whose ends have nothing in common
        walk = walk[2:] + prose(1000 + k, 2)
        texts[len(texts)] = " ".join(walk)
    for k in range(5):
        texts[len(texts)] = " ".join(prose(7, 1 + k))
    # 8 of 10 shingles in common: linked; 80 of 101: not.
    a = prose(8, 13)
    texts[len(texts)], texts[len(texts) + 1] = " ".join(a), " ".join(a[:-1] + ["other"])
    ids = list(texts)
    draw.shuffle(ids)
    named = {i * 3: texts[k] for k, i in zip(texts, ids)}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in named.items()], DOCS)
    assert held(ngram_jaccard_components(docs)) == wanted(named)


def test_edges(edges, empty):
    found = {r["doc_id"]: r for r in ngram_jaccard_components(edges).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6, 7, 8}
    assert found[1]["component_id"] == found[2]["component_id"] == found[2]["copy_of"] == 1
    assert [found[k]["n_shingles"] for k in (3, 4, 5, 7)] == [0, 0, 0, 1]
    assert all(found[k]["component_id"] == k for k in (3, 4, 5, 6, 7, 8))
    assert found[6]["n_shingles"] > 50_000
    assert ngram_jaccard_components(empty).count() == 0


def test_a_filled_row_counts_where_an_id_also_has_an_empty_one(spark):
    text = " ".join(prose(5, 40))
    docs = spark.createDataFrame([(2, None, "", "", 0), (2, text, "", "", 0), (1, text, "", "", 0), (3, "", "", "", 0), (3, None, "", "", 0)], DOCS)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard_components(docs).collect()}
    assert found == {1: (36, 1), 2: (36, 1), 3: (0, 3)}
