import os

import public_tokenizers
import pytest
from plain import linked_components, shingles
from tokenizers import Tokenizer

import corpus_pipeline
from llm.quality import score_quality


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows before and after each stage."""
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        assert k == 4 or after.columns == columns
        seen.append((name, docs, after))
        docs = after
    return seen


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_stages_do_what_a_plain_version_does(spark, folder, stages):
    assert len(stages) == 5
    _, before, after = stages[0]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rejected = ids(score_quality(before, labels).where("predicted = 0"))
    assert rejected and ids(after) == ids(before) - rejected
    _, before, after = stages[1]
    found = linked_components({r["doc_id"]: shingles(r["text"]) for r in before.collect()})
    assert ids(after) == set(found.values()) and len(set(found.values())) < len(found)
    _, before, after = stages[2]
    flat = lambda t: " " + " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()) + " "
    items = [flat(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leaks = {r["doc_id"] for r in before.collect() if any(x in flat(r["text"]) for x in items)}
    assert ids(before) - ids(after) == leaks
    _, before, after = stages[3]
    size = lambda d: sum(len(r["text"].encode().split()) for r in d.collect())
    assert abs(size(after) - 1.5 * size(before)) < 130 * 20 and all(r["n_chars"] == len(r["text"]) for r in after.collect())
    _, before, after = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r["doc_id"], len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1) for r in before.collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in after.collect()) == want


def test_run(spark, folder, stages):
    key = lambda d: sorted(tuple(r) for r in d.select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    assert key(corpus_pipeline.run(spark, folder)) == key(stages[4][2])


def test_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13


NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def staged(spark, folder, docs, tmp_path):
    """The rows after each stage, written and read again."""
    out = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        out.append(docs)
    return out


def test_edges(spark, folder, edges, tmp_path):
    """Nulls, repeats and columns with the operators' own names: what each stage keeps, by id and text."""
    before = [(r["doc_id"], r["text"]) for r in edges.collect()]
    judged = score_quality(edges, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert len(judged) == len(before)
    after = staged(spark, folder, edges, tmp_path)
    assert all(a.columns == edges.columns for a in after[:4])
    kept = [[(r["doc_id"], r["text"]) for r in a.collect()] for a in after[:4]]
    rejected = sorted(r["doc_id"] is None or r["doc_id"] for r in judged if not r["predicted"])
    assert sorted(i is None or i for i, _ in before) == sorted([i is None or i for i, _ in kept[0]] + rejected)
    # Rows 1, 1, 2 and one without an id have the same text: one of them stays, the smallest id.
    texts = [t for _, t in kept[0] if t and t.split()]
    assert sorted(t for _, t in kept[1] if t and t.split()) == sorted(set(texts))
    for text in set(texts):
        own = [i for i, t in kept[0] if t == text]
        assert [i for i, t in kept[1] if t == text] == [min(own, key=lambda i: (i is None, i))]
    assert sorted(map(repr, kept[1])) == sorted(map(repr, kept[2])) and len(kept[0]) > len(kept[1])
    assert after[4].count() == after[3].count()


def test_rows_without_an_id_are_filtered_like_any_other(spark, folder, small, tmp_path):
    _, rows = small
    leak = spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    found = {r["doc_id"]: r["predicted"] for r in score_quality(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    bad = next(r["text"] for i, r in rows.items() if found[i] == 0 and len(r["text"].split()) > 30)
    good = next(r["text"] for i, r in rows.items() if found[i] == 1 and r["lang"] == "en" and len(r["text"].split()) > 200)
    labelled = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    free = next(i for i in rows if i not in labelled)
    # The rows that the classifier learns from stay as they are, so that it judges the odd ones as it does those.
    odd = [(None, bad), (None, f"{good} {leak} {good[::2]}"), (None, good + " tail"), (None, good + " tail"), (free, good), (free, bad)]
    table = spark.createDataFrame([*[tuple(r) for r in rows.values()], *[(i, t, "en", "s", len(t)) for i, t in odd]], "doc_id long, text string, lang string, source string, n_chars long")
    after = [[r["text"] for r in a.collect()] for a in staged(spark, folder, table.repartition(4), tmp_path)[:3]]
    assert bad not in after[0] and after[0].count(good) == 1 + sum(r["text"] == good for r in rows.values())
    assert sum(t in (good, good + " tail") for t in after[1]) == 1
    added = f"{good} {leak} {good[::2]}"
    assert added in after[1] and added not in after[2]


def test_empty_tables(spark, folder, empty, tmp_path):
    assert [a.count() for a in staged(spark, folder, empty, tmp_path)] == [0] * 5


def test_scratch_of_a_stage_goes_with_the_next(spark, folder, tmp_path):
    docs, left = spark.read.parquet(f"{folder}/documents.parquet").limit(80), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        assert not any(os.path.exists(p) for p in left)
        left = list(corpus_pipeline._LEFT)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert not left


def test_scratch_stays_while_rows_come_from_it(spark, folder, small):
    """A stage called again, or on rows that were not written, deleted what these had yet to read."""
    docs = small[0].limit(80)
    first, again = (corpus_pipeline.mix(spark, docs, folder) for _ in range(2))
    rows = first.count()
    assert corpus_pipeline.token_files(spark, again, folder).count() == rows > 80
