import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revlens.llm import packing

PATH = packing.vocabulary("word_bpe_49k.json")
ODD = ["İstanbul ISTANBUL's don't  x\t y　z é ́a ﬁ Ǆ 北京 ΣΑΣ don't.. !!...a1b2 <|endoftext|>x", "", " ", None,
       "\n\n a", "a\x0bb\x1cc", "Ünï.,cöde'S 'RE 're", "K Å", "word " * 5000, "z" * 3000, "a, b. c,. d.. é, ×, a×, 1, _, x. ɐ, İ, y", "end. ", "a,\n b.\n"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def test_encoder_equals_the_tokenizer_on_whole_texts(tok, spark, sf_small):
    texts = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").limit(60).collect()] + [t or "" for t in ODD]
    enc = packing.Encoder(PATH)
    for _ in range(2):  # the second time from memory
        for text, raw in zip(texts, enc.encode(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_first_fit_decreasing_is_the_plain_scan():
    rnd = random.Random(5)
    for n in (1, 2, 3, 40, 333):
        sizes = np.array([rnd.randint(1, 100) for _ in range(n)])
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        free, want = [], {}
        for i in np.argsort(-sizes, kind="stable"):
            k = next((k for k, f in enumerate(free) if f >= sizes[i]), len(free))
            if k == len(free):
                free.append(100)
            want[i] = (k, 100 - free[k])
            free[k] -= sizes[i]
        assert [(int(bins[i]), int(offsets[i])) for i in range(n)] == [want[i] for i in range(n)]


def check(rows, docs, tok, length):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc_id, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.asarray(ids[at:at + r.length], "<u4").tobytes()
            assert len(part) == 4 * r.length and zlib.crc32(part) == r.ids_crc32
            if "ids" in r:
                assert list(r.ids) == ids[at:at + r.length]
            at += r.length
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return len(by_seq)


def test_round_trip_and_padding(spark, sf_small, make_docs, tok):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(10_000 + i, t) for i, t in enumerate(ODD)]
    rows = packing.pack(make_docs(docs), with_ids=True).collect()
    n = check(rows, docs, tok, 2048)
    assert sum(r.length for r in rows) > 0.97 * 2048 * (n - 1)


def test_many_groups(make_docs, tok):
    docs = [(i, "a b c " * (i % 40)) for i in range(400)]
    check(packing.pack(make_docs(docs), length=64, group_size=50).collect(), docs, tok, 64)


def test_edge_cases(make_docs):
    assert packing.pack(make_docs([])).collect() == []
    rows = packing.pack(make_docs([(None, None), (3, "a"), (3, "a")])
                        .withColumns({c: F.lit("x") for c in ("row", "grp", "length", "offset")})).collect()
    assert sorted((r.doc_id or -1, r.doc_tokens) for r in rows) == [(-1, 1), (3, 2), (3, 2)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_a_small_memory_gives_the_same(tok, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 4)
    monkeypatch.setattr(packing, "TOGETHER", 40)
    texts = [t or "" for t in ODD] * 2
    for text, raw in zip(texts, packing.Encoder(PATH).encode(texts), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
