import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
from orderloom.llm import records as rec
from orderloom.llm.checksums import BLOCK, Crc32c
from orderloom.llm.common import open_store

from .frames import clashing, docs

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


def plain_crc32c(data):
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def plain_tokens(rows):
    """(doc_id, text) encoded one whole text at a time, in ascending order of ids."""
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_checksums():
    crc, pick = Crc32c(), random.Random(1)
    assert crc.of([b"123456789"])[0] == 0xE3069283
    data = [pick.randbytes(n) for n in [4, 5, 8, 9, 12, 255, 256, 257, 3000]]
    assert crc.of(data).tolist() == [plain_crc32c(d) for d in data]
    for extra in (0, 1, 3, 4, 5):
        long = pick.randbytes(BLOCK * 2 + extra)
        assert crc.of([long])[0] == _by_table(long)


def _by_table(data):
    table = [plain_step(i) for i in range(256)]
    crc = 0xFFFFFFFF
    for byte in data:
        crc = (crc >> 8) ^ table[(crc ^ byte) & 255]
    return crc ^ 0xFFFFFFFF


def plain_step(value):
    for _ in range(8):
        value = (value >> 1) ^ (0x82F63B78 if value & 1 else 0)
    return value


def test_query_on_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = contract.queries()["op3_token_records"](spark, SF_DIR).collect()
    assert sorted(map(tuple, found)) == plain_tokens(map(tuple, rows))


def test_encoding_word_by_word_equals_whole_texts():
    with open(PATH, encoding="utf-8") as f:
        encoder = rec.Encoder(f.read())
    tokenizer, pick = Tokenizer.from_file(PATH), random.Random(3)
    pieces = list("aAZéÉ́ΣσςİıßǅŔfi…—'’!?0９①  　\x85\x1c​한글") + [
        " ", "  ", "\n", ".", ",", "a.", "b,", "it's.", "9,", "\t", "\x0b", "\r", "<|endoftext|>", "<|startoftext|>", "'s", "'ll", "é", "\U0001f600",
    ]
    texts = ["".join(pick.choice(pieces) for _ in range(pick.randrange(40))) for _ in range(3000)]
    got = [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(pa.array(texts))]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_rows_and_shuffled_reads(spark):
    texts = [None, "", "Hello, world!", "same same", "same same", "long " * 300_000, " \n"]
    df = clashing(docs(spark, texts)).repartition(3)
    manifest = rec.write_records(df, PATH)
    expected = plain_tokens(enumerate(texts))
    assert sorted(map(tuple, rec.read_tokens(manifest).collect())) == expected
    mixed = rec.shuffled(manifest, seed=5).collect()
    assert [r.doc_id for r in mixed] == [r.doc_id for r in rec.shuffled(manifest, seed=5).collect()]
    assert [r.doc_id for r in mixed] != sorted(r.doc_id for r in mixed)
    crc = {r.doc_id: zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) for r in mixed}
    assert crc == {e[0]: e[3] for e in expected}
    rows = [(None, "b"), (None, "b"), (2, "x"), (2, "x"), (-5, "y z")]
    repeated = spark.createDataFrame(rows, "doc_id long, text string")
    got = rec.read_tokens(rec.write_records(repeated, PATH)).orderBy("start").collect()
    assert list(map(tuple, got)) == plain_tokens(rows)
    assert rec.read_tokens(rec.write_records(repeated.limit(0), PATH)).count() == 0
    assert rec.shuffled(rec.write_records(repeated.limit(0), PATH)).count() == 0


def test_damage_is_found(spark):
    manifest = rec.write_records(docs(spark, ["some words here"] * 5), PATH)
    shard = manifest.first()
    store, root = open_store(shard.folder)
    path = f"{root}/{shard.name}.rec"
    data = bytearray(store.open_input_file(path).read())
    for at in (0, 9, 30, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 1
        with store.open_output_stream(path) as f:
            f.write(bytes(bad))
        with pytest.raises(Exception, match="damaged"):
            rec.read_tokens(manifest).collect()


def test_forms_of_a_word_are_kept_once():
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    encoder, tokenizer = rec.Encoder(spec), Tokenizer.from_str(spec)
    texts = ["Word word WORD, word. (Word) ÄB äb", "WORD <|endoftext|> <|ENDOFTEXT|>, Äb. .. , a.b.", "", None]
    ids = encoder.encode(pa.array(texts))
    plain = [tokenizer.encode(text or "", add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(own, "<u2").tolist() for own in ids] == plain
    assert b"word" in encoder._known
    assert not any(w.isascii() and b"<|" not in w and w != w.lower() for w in encoder._known)


def test_plain_words_go_to_the_model_and_closing_marks_are_cut(monkeypatch):
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    encoder, tokenizer = rec.Encoder(spec), Tokenizer.from_str(spec)
    whole, packed = [], encoder._packed
    monkeypatch.setattr(encoder, "_packed", lambda texts: whole.extend(texts) or packed(texts))
    pick = random.Random(7)
    ends = ["", ".", ",", "$$$", "'", "'.", '")', "|>", "<|", "...", "'s", "9!", "²!"]
    words = ["".join(pick.choices(rec.PLAIN_LETTERS, k=pick.randrange(1, 15))) for _ in range(4000)]
    words += [w + pick.choice(ends) for w in words]
    words += ["x<|endoftext|>", "é<|startoftext|>..", "o̸=", "a≠", "ǅ.", "İ!", "º.", "ª", "µ,"]
    texts = [" ".join(pick.sample(words, 50)) for _ in range(400)] + words[-9:]
    got = [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(pa.array(texts))]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    # No word of letters alone, with closing marks or without, was encoded as a text of its own.
    assert not [t for t in whole if t.rstrip(rec.CLOSING_MARKS) and not t.rstrip(rec.CLOSING_MARKS).strip(rec.PLAIN_LETTERS) and "<|" not in t]


def test_other_normalizers_keep_words_whole():
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    assert rec.byte_letters(spec)[ord("a")] == "a"
    assert rec.byte_letters(spec.replace('"NFC"', '"NFKD"')) is None
    assert rec.byte_letters(spec.replace("<|endoftext|>", "end")) is None
