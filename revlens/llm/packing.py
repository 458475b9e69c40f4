"""Packing: first-fit decreasing with a tournament tree of bin capacities.

Every document becomes its token ids and one end id.  Documents longer than
a sequence are cut into full sequences and a rest; the rests are dealt into
random groups of about ``group_size`` and each group is packed on its own by
first-fit decreasing, where a tournament tree over the bins' free capacity
finds the first bin that fits in logarithmic time.

Only (document, start, length) travels between the two steps; the token
ids stay with the task that made them unless ``with_ids`` asks for them.

Defined results: a null text counts as empty and gives the end id alone;
repeated rows are packed as often as they occur; ties in length go by
position in the scan; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, ship

CACHE = 500_000  # remembered words of one Python worker; when full they are set aside once, and what comes again is taken back
LONG = 64        # longer words are not remembered
TOGETHER = 1 << 21  # characters encoded in one go
MARKS = ".,;:!?#$%&*"  # no letter, number or apostrophe: never part of a letter word's piece


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space, lower-cases, and never joins across
    white space or between letters and marks.  So a text's ids are its
    words' ids in a row, a word of letters and closing marks has the ids of
    its lower-case letters and of its marks, and what comes again is looked
    up."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok, self.known, self.letters, self.marks = Tokenizer.from_file(path), {"": b""}, {}, {"": b""}
        self.old, self.old_letters = {}, {}  # the memory before the last one was full
        self.lone = re.compile("[,.](?<![a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f][,.])(?= )")

    def _ids(self, word: str) -> bytes:
        return np.asarray(self.tok.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _letter_words(self, words: list[str]) -> None:
        """Remember the ids of lower-case letter words, many in one call."""
        for at in range(0, len(words), 2000):
            part = words[at:at + 2000]
            made = self.tok.encode(" ".join(part), add_special_tokens=False)
            ids, word = np.asarray(made.ids, "<u4").tobytes(), np.asarray(made.word_ids, np.int64)
            ends = [0, *(np.flatnonzero(np.diff(word)) + 1).tolist(), len(word)]
            if len(ends) - 1 == len(part):
                self.letters.update((w, ids[4 * i:4 * j]) for w, i, j in zip(part, ends, ends[1:], strict=False))
            else:  # a letter whose lower case is more than a letter
                self.letters.update((w, self._ids(w)) for w in part)

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        split, out = {}, {w: self.old[w] for w in words & self.old.keys()}
        words = words.difference(out)
        plain = [w for w in words if w.isascii() and w.isalpha()]  # no marks to part from
        lower = list(map(str.lower, plain))
        for w in words.difference(plain):
            core = w.rstrip(MARKS)
            # U+0130 lower-cases to a letter and a mark, which joins the marks after it.
            if core.isalpha() and (core.isascii() or max(core) < "\u0250" and "\u0130" not in core):
                split[w] = (core.lower(), w[len(core):])
            else:
                out[w] = self._ids(w)
        cores = {c for c, _ in split.values()}.union(lower).difference(self.letters)
        self.letters.update((c, self.old_letters[c]) for c in cores & self.old_letters.keys())
        self._letter_words(list(cores.difference(self.letters)))
        out.update(zip(plain, map(self.letters.__getitem__, lower), strict=True))
        for w, (core, tail) in split.items():
            if tail not in self.marks:
                self.marks[tail] = self._ids(tail)
            out[w] = self.letters[core] + self.marks[tail]
        return out

    def _words(self, text: str) -> list[str]:
        """What stands between spaces, a comma or full stop between a letter and a space on its own."""
        text = text.replace("\n", " ")
        if not self.lone.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size == 0 or size + len(texts[end]) <= TOGETHER):
                size, end = size + len(texts[end]), end + 1
            split = list(map(self._words, texts[at:end]))
            words = set().union(*split)
            new = words.difference(self.known)
            made = self._learn(new)
            self.known.update(made)
            for words in split:
                yield b"".join(map(self.known.__getitem__, words))
            for w in made:
                if len(w) > LONG:
                    del self.known[w]
            if max(len(self.known), len(self.letters), len(self.marks)) > CACHE:
                self.old, self.old_letters = self.known, self.letters
                self.known, self.letters, self.marks = {"": b""}, {}, {"": b""}
            at = end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every item; each is at most ``capacity`` long."""
    n = len(sizes)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [capacity] * (2 * leaves)  # the winner of a node: the most free room below it
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pieces(docs: DataFrame, path: str, length: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row for each stretch of at most ``length`` ids of a document."""
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            out = []
            for doc_id, ids in zip(batch["doc_id"], enc.encode([t or "" for t in batch["text"]]), strict=True):
                raw = ids + end
                n = len(raw) // 4
                for at in range(0, n, length):
                    part = raw[4 * at:4 * (at + length)]
                    out.append((doc_id, at, len(part) // 4, zlib.crc32(part), n)
                               + ((np.frombuffer(part, "<u4").astype(np.int32),) if with_ids else ()))
            cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
            made = pd.DataFrame(out, columns=cols)
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInPandas(run, schema)


def pack(docs: DataFrame, *, path: str | None = None, length: int = 2048, end_id: int = 1,
         group_size: int = 4096, with_ids: bool = False) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``length`` ids.

    Returns a row for each piece: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset (and ids with ``with_ids``).
    """
    ship(docs.sparkSession)
    path = path or vocabulary("word_bpe_49k.json")
    # The row number is stored once, so groups stay the same when a task runs again.
    made = cut(pieces(docs, path, length, end_id, with_ids).withColumn("row", F.monotonically_increasing_id()))
    full = made.where(F.col("length") == length)
    rest = made.where(F.col("length") < length)
    groups = max(1, -(-rest.count() // group_size))

    def place(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("row", ignore_index=True)
        bins, offsets = first_fit_decreasing(batch["length"].to_numpy(), length)
        batch["sequence_id"] = (batch["grp"].astype("int64") * (1 << 20) + bins) * 2
        batch["offset"] = offsets
        return batch.drop(columns=["row", "grp"])

    ids = ", ids array<int>" * with_ids
    schema = f"doc_id long, start long, length long, ids_crc32 long, doc_tokens long{ids}, sequence_id long, offset long"
    packed = (rest.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int"))
              .groupBy("grp").applyInPandas(place, schema))
    alone = full.withColumns({"sequence_id": full["row"] * 2 + 1, "offset": F.lit(0).cast("long")})
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    return packed.select(order).unionByName(alone.select(order))
