import hashlib
import re
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import llm.fill_middle as middle
from llm.fill_middle import FORMS, _strings, fill_middle, fill_middle_digests, put_back, rearrange, restored, unit_ends
from llm.text import buffers

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
sha = lambda text: hashlib.sha256(text.encode()).hexdigest()


def plainly(ident, text):
    text = text or ""
    units = UNITS.findall(text)
    assert "".join(units) == text
    digest = hashlib.sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return ident, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return ident, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return ident, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TEXTS = st.text(alphabet=" \t\nab<P>SM☃é\x0b\x85 ", max_size=20)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXTS, st.integers(0, 30), st.integers(0, 30), st.integers(0, 2)), max_size=6), st.sampled_from([1, 3, 1 << 20]))
def test_scatter_and_gather(rows, window):
    raw, bounds = buffers(pa.array([r[0] for r in rows], pa.string()))
    ends, first = unit_ends(raw, bounds)
    cuts, forms, want = [], [], []
    for k, (text, a, b, form) in enumerate(rows):
        units = UNITS.findall(text)
        own = [int(bounds[k]), *ends[first[k] : first[k + 1]].tolist()]
        assert len(own) == len(units) + 1 and own == [int(bounds[k]) + len("".join(units[:j]).encode()) for j in range(len(units) + 1)]
        a, b = sorted((a % len(own), b % len(own)))
        form = 0 if any(m.decode() in text for m in middle.MARKS) else form
        p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
        cuts.append((own[a], own[b]))
        forms.append(form)
        want.append([text, f"<P>{p}<S>{s}<M>{m}", f"<S>{s}<P>{p}<M>{m}"][form])
    forms = np.array(forms, dtype=np.int64)
    before, middle._WINDOW = middle._WINDOW, window
    try:
        out, places = rearrange(raw, bounds, np.array(cuts, dtype=np.int64).reshape(-1, 2), forms)
        assert _strings(out, places).to_pylist() == want
        assert _strings(*put_back(out, places, forms)).to_pylist() == [r[0] for r in rows]
    finally:
        middle._WINDOW = before


def test_marks_over_two_texts_are_none():
    raw, bounds = buffers(pa.array(["x<", "P>", "<S", ">", "<M>"]))
    assert middle._holds_mark(raw, bounds).tolist() == [False, False, False, False, True]


@pytest.mark.parametrize("output", ["<P>a<S>b", "<P>a<M>b<S>c", "a<P>b<S>c<M>d", "<P>a<S>b<M>c<M>"])
def test_damaged_outputs_are_refused(output):
    raw, bounds = buffers(pa.array([output]))
    with pytest.raises(ValueError):
        put_back(raw, bounds, np.array([FORMS.index("psm")]))


def test_small_tables(spark, small):
    docs, rows = small
    have = {r["doc_id"]: r for r in restored(fill_middle(docs.repartition(3))).collect()}
    assert len(have) == len(rows)
    for i, row in rows.items():
        assert tuple(have[i])[:-1] == plainly(i, row["text"]) and have[i]["restored"] == (row["text"] or "")
    assert {r["form"] for r in have.values()} == set(FORMS)


def test_edges(spark, edges, empty):
    marked = edges.select("doc_id", "text").unionAll(spark.createDataFrame([(k, t) for k in range(100, 130) for t in ("a <P> b", "a < P> b ", " <M> ")], "doc_id long, text string"))
    want = sorted((plainly(r["doc_id"], r["text"]) for r in marked.collect()), key=repr)
    have = fill_middle(edges).unionAll(fill_middle(marked.where("doc_id >= 100")))
    assert sorted((tuple(r) for r in have.collect()), key=repr) == want
    done = [SimpleNamespace(**r.asDict()) for r in fill_middle_digests(edges).collect()]
    assert sorted(r.restored_sha256 for r in done) == sorted(sha(r["text"] or "") for r in edges.collect())
    assert fill_middle(empty).count() == 0 and fill_middle_digests(empty).count() == 0
