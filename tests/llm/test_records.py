import glob
import io
import os
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from revlens.llm import records
from revlens.llm.common import fresh_folder

PATH = records.vocabulary()
ODD = ["", None, " ", "\n", "a", " a", "a ", "a  b", "a   b", "x\ny", "x\n\ny", "x\n\n\ny", "x \ny\n z", "tab\t x \t y\t\tz", "\0 nul\0",
       "don't we'll 'tis x'S", "Ünï.,cöde!! 北京。 ﬁ 2nd 3.14 a1b2", "<|endoftext|> x<|endoftext|>", "a b 　c\x1cd \x1f e\x85f",
       "end.\n\n", "end. \n", "z" * 3000, "word " * 4000, "ɐbɐ,, ɐ.", "Ǆ,x", "a,\n,b", "!!! ...", " x  y"]


def bitwise_crc32c(data):
    crc = 0xFFFFFFFF
    for b in data:
        crc ^= b
        for _ in range(8):
            crc = (crc >> 1) ^ (0x82F63B78 if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def ids_of(tok, text, end=0):
    return [*tok.encode(text or "", add_special_tokens=False).ids, end]


def test_crc32c_is_the_bitwise_one():
    rnd = random.Random(1)
    messages = [rnd.randbytes(4 * n) for n in (1, 2, 3, 15, 16, 17, 31, 32, 33, 64, 100, 257, 1000)]
    rnd.shuffle(messages)
    assert records.crc32c(messages).tolist() == [bitwise_crc32c(m) for m in messages]
    assert records.crc32c([bytes(32)]).tolist() == [0x8A9136AA]  # published check value: 32 zero bytes
    assert records.crc32c([]).tolist() == []
    assert records.masked(np.array([0x8A9136AA], np.uint32))[0] == ((0x8A9136AA >> 15 | 0x8A9136AA << 17) + 0xA282EAD8) % 2**32


def test_encoder_equals_the_tokenizer_on_whole_texts(tok, spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()] + [t or "" for t in ODD]
    enc = records.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        for text, raw in zip(texts, enc.encode([t or "" for t in texts]), strict=True):
            assert np.frombuffer(raw, "<u2").tolist() == ids_of(tok, text), text


@given(st.lists(st.text(alphabet="aB, .'\n\t é1!\0", max_size=12), max_size=6))
@settings(max_examples=400, deadline=None)
def test_encoder_on_random_texts(texts):
    enc = records.encoder(PATH)
    enc.known = {}
    for text, raw in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == ids_of(enc.tok, text), text


def test_a_small_memory_and_wide_ids_give_the_same(tok, monkeypatch):
    texts = [t or "" for t in ODD] * 3
    monkeypatch.setattr(records, "TOGETHER", 50)
    monkeypatch.setattr(records, "CACHE", 5)
    enc = records.Encoder(PATH, end_id=100_000)
    assert [np.frombuffer(raw, "<u4").tolist() for raw in enc.encode(texts)] == [ids_of(tok, t, 100_000) for t in texts]


def test_frames_by_hand():
    payload = records.payload(-5, struct.pack("<3H", 1, 2, 0), 2)
    assert payload == struct.pack("<qBBHI3HH", -5, 1, 2, 0, 3, 1, 2, 0, 0)
    assert records.opened(payload) == (-5, struct.pack("<3I", 1, 2, 0)) and records.n_ids(payload) == 3
    assert records.opened(records.payload(None, struct.pack("<I", 70_000), 4)) == (None, struct.pack("<I", 70_000))
    data = records.frames([payload, payload[:16]])
    assert struct.unpack_from("<Q", data)[0] == len(payload) and data[12:12 + len(payload)] == payload
    mask = lambda c: ((c >> 15 | c << 17) + 0xA282EAD8) % 2**32
    assert struct.unpack_from("<I", data, 8)[0] == mask(bitwise_crc32c(data[:8]))
    assert struct.unpack_from("<I", data, 12 + len(payload))[0] == mask(bitwise_crc32c(payload))
    assert [p for block in records.scan(io.BytesIO(data), "x") for p in block] == [payload, payload[:16]]


def test_small_reads_and_damage(monkeypatch):
    payloads = [records.payload(i, struct.pack(f"<{i + 1}I", *range(i + 1)), 4) for i in range(20)]
    data = records.frames(payloads)
    monkeypatch.setattr(records, "TOGETHER", 7)
    assert [p for block in records.scan(io.BytesIO(data), "x") for p in block] == payloads
    monkeypatch.setattr(records, "TOGETHER", 1 << 20)
    for at in range(0, len(data), 3):
        bad = bytearray(data)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            list(records.scan(io.BytesIO(bytes(bad)), "x"))
    for size in (len(data) - 1, len(data) - 30, 5):
        with pytest.raises(ValueError):
            list(records.scan(io.BytesIO(data[:size]), "x"))
    index = records.index_bytes(np.array([(0, 16, 0), (32, 20, 1)], records.ENTRY))
    assert records.read_index(index, "x")["offset"].tolist() == [0, 32]
    for at in range(len(index)):
        bad = bytearray(index)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.read_index(bytes(bad), "x")


def check(rows, docs, tok):
    want, at = [], 0
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = ids_of(tok, text)
        want.append((doc_id, len(ids)))
        at += len(ids)
    rows = sorted(rows, key=lambda r: r.start)
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in rows]
    assert [r.start for r in rows] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [r.doc_id for r in rows] == [i for i, _ in want]  # ascending ids
    assert sorted((str(r.doc_id), i) for r, i in zip(rows, ids, strict=True)) == sorted((str(i), ids_of(tok, t)) for i, t in docs)


def test_round_trip_in_many_files(spark, make_docs, tok):
    rnd = random.Random(2)
    docs = [(rnd.randrange(400), rnd.choice(ODD)) for _ in range(300)] + [(7, "hot")] * 150 + [(None, None)] * 50 + [(None, "x")]
    rnd.shuffle(docs)
    folder = fresh_folder(spark, "test-records")
    made = records.write(make_docs(docs), folder, file_rows=40)
    files = made.orderBy("number").collect()
    assert len(files) > 5 and max(f.records for f in files) < 120  # one id in no file alone
    assert [f.base for f in files] == np.cumsum([0, *[f.ids for f in files]])[:-1].tolist()
    rows = records.read(spark, folder).collect()
    check(rows, docs, tok)
    index = {(r.file, r.record): r for r in records.index(spark, folder).collect()}
    assert len(index) == len(docs)
    one, two = (records.read_shuffled(spark, folder, seed).collect() for seed in (1, 2))
    same = lambda rs: sorted((r.start, r.doc_id or -1, bytes(r.ids)) for r in rs)
    assert same(one) == same(rows) == same(two)
    assert [r.start for r in one] != [r.start for r in two] != sorted(r.start for r in rows)
    assert [(r.place, r.start) for r in one] == sorted((r.place, r.start) for r in one)


def test_a_damaged_or_missing_file_raises(spark, make_docs):
    folder = fresh_folder(spark, "test-records")
    records.write(make_docs([(i, "some text") for i in range(50)]), folder)
    [path] = glob.glob(folder.removeprefix("file:") + "/*.rec")
    data = bytearray(open(path, "rb").read())
    data[len(data) // 2] ^= 1
    with open(path, "wb") as f:
        f.write(bytes(data))
    with pytest.raises(Exception, match="checksum|record"):
        records.read(spark, folder).collect()
    with pytest.raises(Exception, match="checksum|record"):
        records.read_shuffled(spark, folder).collect()


def test_files_outside_the_manifest_are_not_read(spark, make_docs):
    folder = fresh_folder(spark, "test-records")
    records.write(make_docs([(1, "a")]), folder)
    [path] = glob.glob(folder.removeprefix("file:") + "/*.rec")
    with open(os.path.join(os.path.dirname(path), "part-000000-lost.rec"), "wb") as f:
        f.write(b"left by a task that was lost")
    assert records.read(spark, folder).count() == 1


def test_edge_cases(spark, make_docs):
    folder = fresh_folder(spark, "test-records")
    assert records.write(make_docs([]), folder).collect() == []
    assert records.read(spark, folder).collect() == records.read_shuffled(spark, folder).collect() == []
    folder = fresh_folder(spark, "test-records")
    docs = make_docs([(None, None), (3, "a")]).withColumns({c: F.lit("x") for c in ("row", "ids", "start", "number", "base")})
    records.write(docs, folder)
    assert [(r.doc_id, r.start, len(r.ids)) for r in records.read(spark, folder).orderBy("start").collect()] == [(None, 0, 4), (3, 1, 8)]


def test_query_against_the_tokenizer(spark, sf_small, tok):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows, at = E.queries()["op13_records"](spark, sf_small).orderBy("start").collect(), 0
    assert [r.doc_id for r in rows] == sorted(docs)
    for r in rows:
        ids = np.asarray(ids_of(tok, docs[r.doc_id]), "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
