import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm import token_files
from llm.token_files import Encoder, framed, masked, payload_of, read_records, read_token_files, token_index, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_units_give_the_ids_of_whole_texts():
    coder, draw = Encoder(PATH), random.Random(2)
    parts = ["a", "b c", " ", "  ", "\n", " \n", "\x1c", "\x85", "é", "1", "!", "<|endoftext|>", "'s", " x", "\t", "漢", "Ⅷ", "​", " ", "  ", "　 "]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(14)))
        assert coder.encode(text) == coder.plain(text), text


def test_marks_at_the_end_of_units():
    coder, draw = Encoder(PATH), random.Random(3)
    parts = ["word", "é", "²", "漢", "3", "'", "'s", "!", "|>", "<|endoftext", "<|endoftext|>", ",", "\n", "ǅ", "͏", "Ⅷ", "—", " ", " ", " "]
    for _ in range(6000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(14)))
        assert coder.encode(text) == coder.plain(text), text
    assert coder.stem("word!?") == "word" and coder.stem("<|endoftext|>") == "<|endoftext|>" and coder.stem("漢,") == "漢,"


def test_a_full_memory_keeps_its_first_units(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 64)
    coder = Encoder(PATH)
    coder.encode(" the of and")
    for k in range(200):
        text = f" the of and word{k} other{k}, word{k}"
        assert coder.encode(text) == coder.plain(text)
        assert {"the", "of", "and"} <= coder.units.keys() and len(coder.units) < 70


def test_frames():
    record = framed(b"hello")
    assert len(record) == 8 + 4 + 5 + 4 and masked(b"") == 0xA282EAD8
    assert payload_of(memoryview(record), 0) == (b"hello", len(record))
    for at in range(len(record)):
        broken = bytearray(record)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            payload_of(memoryview(bytes(broken)), 0)


def test_round_trip(spark, small, tokenizer):
    docs, rows = small
    manifest = write_token_files(docs.repartition(5), PATH)
    found = {r["doc_id"]: r for r in token_index(manifest).collect()}
    ids = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in read_token_files(manifest).collect()}
    start = 0
    for i in sorted(rows):
        want = [*tokenizer.encode(rows[i]["text"] or "", add_special_tokens=False).ids, 0]
        assert ids[i] == want
        assert (found[i]["start"], found[i]["n_tokens"], found[i]["ids_crc32"]) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)
    assert len(found) == len(rows)
    # Any record by itself, through the offset index.
    file = manifest.first()
    picks = [file["records"] - 1, 0]
    first = sorted(rows)[: file["records"]]
    assert [x.tolist() for x in read_records(file["folder"], file["file"], file["width"], picks)] == [ids[first[-1]], ids[first[0]]]


def test_edges(edges, empty, tokenizer):
    rows = [r.asDict() for r in token_index(write_token_files(edges, PATH)).collect()]
    assert len(rows) == edges.count()
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    starts = np.cumsum([0, *(r["n_tokens"] for r in rows)])
    assert [r["start"] for r in rows] == starts[:-1].tolist()
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)] == [1, 1]
    assert token_index(write_token_files(empty, PATH)).count() == 0
