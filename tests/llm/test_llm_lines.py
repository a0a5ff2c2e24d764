import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from conftest import DOCS, prose
from plain import Union, overlaps

from llm.line_dedup import characters, dedup_lines, line_shingles, lines


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def wanted(docs: dict[int, str]) -> dict:
    places = [(i, n, lower(x)) for i, t in docs.items() for n, x in enumerate((t or "").split("\n")) if x.strip()]
    texts = sorted({x for _, _, x in places})
    sets = {k: frozenset(x[p : p + 8] for p in range(max(1, len(x) - 7))) for k, x in enumerate(texts)}
    union = Union(sets)
    for (a, b), n in overlaps(sets).items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            union.join(a, b)
    name, groups = {x: k for k, x in enumerate(texts)}, defaultdict(list)
    for i, n, x in places:
        groups[union.find(name[x])].append((i, n))
    return {p: min(g) for g in groups.values() for p in g}


def found(frame) -> dict:
    rows = frame.collect()
    assert all(r["kept"] == ((r["doc_id"], r["line_no"]) == (r["first_doc"], r["first_line"])) for r in rows)
    return {(r["doc_id"], r["line_no"]): (r["first_doc"], r["first_line"]) for r in rows}


def test_lines_and_shingles():
    texts = ["Ab\n\ncd é\n", "", None, "\n\n", "x", "漢字" * 9 + "\U0001f600\U0001f601", " \t\nlast"]
    codes, bounds = characters(pa.array(texts))
    text, number, starts, ends = lines(codes, bounds)
    got = [(t, n, "".join(map(chr, codes[a:b]))) for t, n, a, b in zip(text, number, starts, ends)]
    assert got == [(t, n, lower(x)) for t, s in enumerate(texts) for n, x in enumerate((s or "").split("\n")) if x.strip()]
    hashes, begin, whole = line_shingles(codes, starts, ends)
    for (_, _, x), a, b in zip(got, begin[:-1], begin[1:]):
        assert b - a == max(1, len(x) - 7) and len(np.unique(hashes[a:b])) == len({x[p : p + 8] for p in range(max(1, len(x) - 7))})
    assert len(set(whole.tolist())) == len({x for _, _, x in got})


def test_recall_on_the_small_tables(small):
    docs, rows = small
    want, have = wanted({i: r["text"] for i, r in rows.items()}), found(dedup_lines(docs))
    assert set(want) == set(have)
    moved = [p for p in want if want[p] != p]
    assert sum(have[p] == want[p] for p in moved) >= 0.95 * len(moved)
    assert all(have[p] == p for p in want if want[p] == p)  # nothing that stands alone is dropped


def test_large_groups_and_chains(spark):
    draw, docs = random.Random(1), defaultdict(list)
    base = " ".join(prose(1, 30))
    for k in range(600):
        x = list(base)
        for _ in range(draw.randrange(3)):
            x[draw.randrange(len(x))] = draw.choice("qxyzj")
        docs[k % 97].append("".join(x))
    walk = " ".join(prose(2, 25))
    for k in range(30):
        walk = walk[6:] + " ".join(prose(50 + k, 3))[:6]
        docs[100 + k].append(walk)
    for k in range(300):
        docs[draw.randrange(130)].append("the very same line" if k % 2 else " ".join(prose(300 + k, 12)))
    texts = {i: "\n".join(x) for i, x in docs.items()}
    want = wanted(texts)
    have = found(dedup_lines(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], DOCS).repartition(4)))
    assert set(want) == set(have)
    assert sum(have[p] == want[p] for p in want) >= 0.97 * len(want)


def test_edges(edges, empty):
    rows = dedup_lines(edges).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 6, 7, 8}
    assert [(r["first_doc"], r["kept"]) for r in rows if r["doc_id"] == 2] == [(1, False)]
    assert sorted(r["line_no"] for r in rows if r["doc_id"] == 8) == [0, 1]
    assert dedup_lines(empty).count() == 0
