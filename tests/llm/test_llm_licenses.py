import numpy as np
import pyarrow as pa
import pytest
from conftest import DOCS, prose

from llm import text as T
from llm.licenses import TEMPLATES, bands_for, floor_similarity, scan_licenses


def test_bands_guarantee_the_probability():
    for contained in (0.6, 0.8, 1.0):
        s = floor_similarity(contained)
        b = bands_for(s, 0.999)
        assert 1 - (1 - s) ** b >= 0.999 > 1 - (1 - s) ** (b - 1) - 1e-3


def _plain_words(text):
    return T.plained(np.frombuffer(text.encode(), np.uint8)).tobytes().split()


def _contained(text, template):
    """Most of the template's shingles in any stretch of the template's length, and a half more."""
    t, w = _plain_words(template), _plain_words(text)
    size = min(5, len(t))
    want = {tuple(t[k : k + size]) for k in range(len(t) - size + 1)}
    have = [tuple(w[k : k + size]) for k in range(len(w) - size + 1)]
    n = len(t) + len(t) // 2
    return max((len(want & set(have[k : k + n])) / len(want) for k in range(max(1, len(have) - n + 1))), default=0)


def test_whole_changed_and_cut_templates(spark):
    docs, k = {}, 0
    for name, text in TEMPLATES.items():
        for change in ("whole", "upper", "changed", "half", "near"):
            words = text.split()
            if change == "upper":
                words = [x.upper() for x in words]
            if change == "changed" and len(words) >= 40:
                words[len(words) // 2] = "otherwise"
            if change == "half":
                words = words[: max(2, len(words) // 2)]
            if change == "near" and len(words) >= 100:
                words[20], words[60] = "different", "wording"
            around = prose(k, 40 + 7 * k % 90)
            docs[k] = " ".join(around[: k % 31] + words + around[k % 31 :])
            k += 1
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs.items()], DOCS)
    found = {(r["doc_id"], r["template"]): r for r in scan_licenses(rows).collect()}
    for i, t in docs.items():
        for name, template in TEMPLATES.items():
            share = _contained(t, template)
            if (i, name) in found:
                assert found[i, name]["contained"] >= 0.8
            assert (share < 0.8) or (i, name) in found, (i, name, share)
    clean = spark.createDataFrame([(k, " ".join(prose(500 + k, 300)), "en", "s", 1) for k in range(20)], DOCS)
    assert scan_licenses(clean).count() == 0


def test_small_tables_agree_with_a_plain_search(small):
    docs, rows = small
    found = {(r["doc_id"], r["template"]) for r in scan_licenses(docs).collect()}
    wanted = {(i, n) for i, r in rows.items() for n, t in TEMPLATES.items() if len(_plain_words(t)) < 20 and b" ".join(_plain_words(t)) in b" ".join(_plain_words(r["text"]))}
    assert wanted and wanted <= found


def test_short_notices_are_found_whole(spark):
    texts = {
        1: "All rights reserved.", 2: "x all RIGHTS reserved, y. All rights reserved", 3: "all rights", 4: "reserved all rights", 5: "",
        6: "all all rights reserved", 7: "rights reserved", 8: None, 9: "notice", 10: "all rights notice reserved",
    }
    rows = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts.items()], DOCS).coalesce(1)
    short = {"rights": "All rights reserved.", "one": "Notice"}
    found = {(r["doc_id"], r["template"]): (r["contained"], r["first_word"], r["windows"]) for r in scan_licenses(rows, templates=short).collect()}
    assert found == {
        (1, "rights"): (1.0, 0, 1), (2, "rights"): (1.0, 1, 2), (6, "rights"): (1.0, 1, 1),
        (9, "one"): (1.0, 0, 1), (10, "one"): (1.0, 2, 1),
    }


def test_edges(edges, empty):
    assert scan_licenses(edges).count() == 0
    assert scan_licenses(empty).count() == 0
    assert scan_licenses(edges, templates={}).count() == 0
    with pytest.raises(ValueError):
        scan_licenses(edges, templates={"short": "..."})
    assert pa.array([]).null_count == 0
