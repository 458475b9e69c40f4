"""Token-ID / binary output: length-delimited binary records.

A data file is a run of frames, one a document (little-endian):

    uint64 length | uint32 masked crc32c of these 8 bytes | payload | uint32 masked crc32c of the payload

and a payload is int64 document id, uint8 1 if that id is given (0: null),
uint8 bytes of a token id (2 where the vocabulary allows it, else 4), two zero
bytes, uint32 number of token ids, the token ids, and zeros up to a whole word.  Each data file has an index file beside it:
8 bytes ``MAGIC``, uint64 number of records, then for each record uint64
offset of its frame, uint64 payload length and uint64 ids before it in the
file, and a masked crc32c of all these entries.  A mask rotates a checksum
and adds a constant, so that checksums of data that holds checksums stay
sound.

``write`` range-partitions documents by id (ties and null ids by row number,
so no id is held by one task alone); every task encodes, frames and writes one
file.  A task that runs again writes files of another name; only the files
of the rows that Spark commits stand in the manifest table, and readers go by
the manifest, so lost executors and speculative copies leave no trace in it.

``read`` streams the files in order and checks both checksums of every frame;
``read_shuffled`` draws a random order from the index files and fetches every
record by its offset.

Defined results: a null text counts as empty and gives the end id alone; null
ids come first; repeated rows are written one by one; ties in id go by row
number; an empty table gives an empty manifest and reads back empty; texts of
any length are encoded whole; extra columns are ignored; a damaged or
truncated file raises.  ``docs`` should come from files (or ``common.cut``):
row numbers must be the same when a task runs again.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship

MAGIC = b"RLINDEX1"
ENTRY = np.dtype([("offset", "<u8"), ("length", "<u8"), ("first", "<u8")])
HEAD = struct.Struct("<qBBHI")     # payload: document id, whether it is given, bytes of a token id, 0, token ids
CACHE = 700_000                    # remembered pieces of one Python worker; cut down to the last texts' when full
LONG = 64                          # longer pieces are not remembered
TOGETHER = 1 << 22                 # bytes framed, or characters encoded, in one go
FILE_ROWS = 16_384


# ---- checksums ----------------------------------------------------------------------------------------------

POLYNOMIAL = 0x82F63B78  # fixed value: Castagnoli, reflected
MASK_DELTA = 0xA282EAD8  # fixed value of the masking rule
LANE = 16                # words of one lane


@lru_cache(maxsize=1)
def _tables() -> np.ndarray:
    """Four tables of 256: the state's bytes advanced by one word of zeros."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    made = [one]
    for _ in range(3):
        made.append(one[made[-1] & 255] ^ (made[-1] >> 8))
    return np.stack(made[::-1])  # byte 0 of the state is the farthest from the end


def _advance(state: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (table[0][state & 255] ^ table[1][(state >> 8) & 255]
            ^ table[2][(state >> 16) & 255] ^ table[3][state >> 24])


@lru_cache(maxsize=64)
def _jump(level: int) -> np.ndarray:
    """Tables that advance a state by LANE * 2**level words of zeros."""
    if level:
        half = _jump(level - 1)
        return np.stack([_advance(t, half) for t in half])
    made = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * i) for i in range(4)])
    for _ in range(LANE):
        made = _advance(made, _tables())
    return made


def crc32c(messages: list[bytes]) -> np.ndarray:
    """crc32c of many messages of whole words (at least one each).

    Messages are padded in front to whole lanes (zeros leave a zero state as
    it is), all lanes are run side by side a word at a time, and the lanes of
    a message are joined in pairs, the left one advanced over the right."""
    if not messages:
        return np.zeros(0, np.uint32)
    size = 4 * LANE
    lanes = np.array([-(-len(m) // size) for m in messages], np.int64)
    padded = np.frombuffer(bytearray(b"".join(x for m, k in zip(messages, lanes.tolist(), strict=True)
                                              for x in (bytes(k * size - len(m)), m))), "<u4")
    ends = np.cumsum(lanes)
    starts = ends * LANE - np.array([len(m) // 4 for m in messages], np.int64)
    padded[starts] ^= np.uint32(0xFFFFFFFF)
    table, state = _tables(), np.zeros(len(padded) // LANE, np.uint32)
    for column in np.ascontiguousarray(padded.reshape(-1, LANE).T):
        state = _advance(state ^ column, table)
    owner = np.repeat(np.arange(len(messages)), lanes)
    back = np.repeat(ends, lanes) - 1 - np.arange(len(state))  # lanes to the right
    level = 0
    while len(state) > len(messages):
        state = np.where(back & 1, _advance(state, _jump(level)), state)
        back >>= 1
        first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (back[1:] != back[:-1])])
        state, owner, back, level = np.bitwise_xor.reduceat(state, first), owner[first], back[first], level + 1
    return ~state


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK_DELTA)


# ---- frames -------------------------------------------------------------------------------------------------

def payload(doc_id: int | None, ids: bytes, width: int) -> bytes:
    head = HEAD.pack(doc_id or 0, doc_id is not None, width, 0, len(ids) // width)
    return head + ids + bytes(-len(ids) % 4)


def opened(payload: bytes) -> tuple[int | None, bytes]:
    """(document id, token ids as uint32) of a payload."""
    doc_id, given, width, _, n = HEAD.unpack_from(payload)
    ids = payload[HEAD.size:HEAD.size + n * width]
    return doc_id if given else None, np.frombuffer(ids, "<u2").astype("<u4").tobytes() if width == 2 else ids


def n_ids(payload: bytes) -> int:
    return HEAD.unpack_from(payload)[-1]


def frames(payloads: list[bytes]) -> bytes:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    heads, tails = masked(crc32c(lengths)).astype("<u4").tobytes(), masked(crc32c(payloads)).astype("<u4").tobytes()
    return b"".join(x for i, (n, p) in enumerate(zip(lengths, payloads, strict=True))
                    for x in (n, heads[4 * i:4 * i + 4], p, tails[4 * i:4 * i + 4]))


def _check(where: str, lengths: list[bytes], heads: list[bytes], payloads: list[bytes], tails: list[bytes]) -> None:
    for name, got, want in (("length", lengths, heads), ("payload", payloads, tails)):
        bad = np.flatnonzero(masked(crc32c(got)) != np.frombuffer(b"".join(want), "<u4"))
        if len(bad):
            raise ValueError(f"{where}: {name} checksum of record {bad[0]} of this block does not hold")


def scan(stream, where: str) -> Iterator[list[bytes]]:
    """Checked payloads of a data file, in blocks."""
    rest, done = b"", False
    while not done:
        more = stream.read(TOGETHER)
        done = not more
        data, at, parts = rest + more, 0, ([], [], [], [])
        while at + 12 <= len(data):
            n = int.from_bytes(data[at:at + 8], "little")
            if at + 16 + n > len(data):
                if n % 4 or n < HEAD.size:
                    raise ValueError(f"{where}: no record length")
                break
            for part, x, y in zip(parts, (0, 8, 12, 12 + n), (8, 12, 12 + n, 16 + n), strict=True):
                part.append(data[at + x:at + y])
            at += 16 + n
            if n % 4 or n < HEAD.size:
                raise ValueError(f"{where}: no record length")
        rest = data[at:]
        if parts[0]:
            _check(where, *parts)
            yield parts[2]
    if rest:
        raise ValueError(f"{where}: {len(rest)} bytes of an unfinished record")


def fetch(file, where: str, offset: int, length: int) -> bytes:
    """The checked payload of the record at ``offset``."""
    file.seek(offset)
    data = file.read(16 + length)
    if len(data) < 16 + length or int.from_bytes(data[:8], "little") != length:
        raise ValueError(f"{where}: no record of {length} bytes at {offset}")
    _check(where, [data[:8]], [data[8:12]], [data[12:-4]], [data[-4:]])
    return data[12:-4]


def index_bytes(entries: np.ndarray) -> bytes:
    body = entries.tobytes()
    return MAGIC + struct.pack("<Q", len(entries)) + body + masked(crc32c([body])).astype("<u4").tobytes()


def read_index(data: bytes, where: str) -> np.ndarray:
    n = int.from_bytes(data[8:16], "little")
    if data[:8] != MAGIC or len(data) != 20 + n * ENTRY.itemsize:
        raise ValueError(f"{where}: no index file")
    if masked(crc32c([data[16:-4]]))[0] != int.from_bytes(data[-4:], "little"):
        raise ValueError(f"{where}: index checksum does not hold")
    return np.frombuffer(data[16:-4], ENTRY)


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder that driver and tasks share."""
    from pyarrow import fs
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    return fs.FileSystem.from_uri(uri)


# ---- token ids ----------------------------------------------------------------------------------------------

class Encoder:
    """Ids of whole texts as little-endian bytes, by a byte-level vocabulary of
    the tokenizers library; two bytes an id if all ids (``end_id`` too) fit.

    Its pieces never span a single space or line break between two
    characters that are no white space: the space begins the next piece, the
    line break is a piece, and so is a mark between a letter and white space.
    So a text's ids are those of its lines' words and marks in a row, and what
    comes again is looked up.  Texts with other white space are cut only
    where that holds."""

    def __init__(self, path: str, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.single = re.compile(r"(?<=\S)[ \n](?=\S)")
        # White space but space and line break, and the mark of the fast cuts.
        self.odd = re.compile("[\0\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
        # Letters to every version of the tables; a mark between one and white space is a piece of its own.
        letter = "[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]"
        self.joined = re.compile(rf"[,.](?<!{letter}[,.])(?=[ \n])")
        self.word = re.compile(f" {letter}+")
        self.width = 2 if max(self.tok.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.end = end_id.to_bytes(self.width, "little")
        self.known: dict[str, bytes] = {}

    def _learn(self, new: set[str]) -> None:
        """Remember pieces: a space and letters many in one call (each is a
        word of the tokenizer), all others one by one."""
        words = [w for w in new if self.word.fullmatch(w)]
        rest, kind, width = list(new.difference(words)), f"<u{self.width}", self.width
        for at in range(0, len(words), 1000):
            part = words[at:at + 1000]
            made = self.tok.encode("".join(part), add_special_tokens=False)
            ids, word = np.array(made.ids, kind).tobytes(), np.array(made.word_ids, np.int64)
            ends = [0, *((np.flatnonzero(np.diff(word)) + 1) * width).tolist(), len(ids)]
            if len(ends) == len(part) + 1:
                self.known.update((w, ids[i:j]) for w, i, j in zip(part, ends, ends[1:], strict=False))
            else:
                rest += part
        many = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        self.known.update((w, np.array(e.ids, kind).tobytes()) for w, e in zip(rest, many(rest, add_special_tokens=False), strict=True))

    def _pieces(self, text: str) -> list[str]:
        """Pieces whose ids in a row are the text's."""
        if not text:
            return []
        alone = not any(x in text for x in ("  ", "\n\n", " \n", "\n ")) and text == text.strip(" \n")
        if alone and not self.odd.search(text):
            if not self.joined.search(text):
                text = text.replace(", ", "\0, ").replace(". ", "\0. ").replace(".\n", "\0.\n")
            return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        out, at, before = [], 0, ""
        for cut in self.single.finditer(text):
            out.append(before + text[at:cut.start()])
            at, before = cut.end(), cut.group()
            if before == "\n":
                out.append("\n")
                before = ""
        return [*out, before + text[at:]]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of every text and the end id."""
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size == 0 or size + len(texts[end]) <= TOGETHER):
                size, end = size + len(texts[end]), end + 1
            split = list(map(self._pieces, texts[at:end]))
            words = set().union(*split)
            new = words.difference(self.known)
            self._learn(new)
            for pieces in split:
                yield b"".join(map(self.known.__getitem__, pieces)) + self.end
            if len(self.known) > CACHE:
                self.known = {w: self.known[w] for w in words if len(w) <= LONG}
            else:
                for w in new:
                    if len(w) > LONG:
                        del self.known[w]
            at = end


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end_id: int = 0) -> Encoder:
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


# ---- jobs ---------------------------------------------------------------------------------------------------

MANIFEST = "number int, file string, records long, ids long, bytes long"


def write(docs: DataFrame, folder: str, *, tokenizer: str | None = None, end_id: int = 0,
          file_rows: int = FILE_ROWS) -> DataFrame:
    """Encode ``docs(doc_id, text)`` and write data and index files below
    ``folder`` in ascending doc_id; returns the manifest (stored there too):
    file number and name, records, ids, bytes and ``base``, the ids before it."""
    spark, tokenizer = docs.sparkSession, tokenizer or vocabulary()
    folder = folder.rstrip("/")
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = entries = None
        offset = ids = 0
        number = TaskContext.get().partitionId()
        name = f"part-{number:06d}-{uuid.uuid4().hex}"
        enc = encoder(tokenizer, end_id)
        fs, root = filesystem(folder)
        kept = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(root, recursive=True)
                out = fs.open_output_stream(f"{root}/{name}.rec")
            payloads, size = [], 0
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, raw in zip(batch.column(0).to_pylist(), enc.encode(texts), strict=True):
                payloads.append(payload(doc_id, raw, enc.width))
                kept.append((offset, len(payloads[-1]), ids))
                offset, ids, size = offset + 16 + len(payloads[-1]), ids + len(raw) // enc.width, size + len(raw)
                if size > TOGETHER:
                    out.write(frames(payloads))
                    payloads, size = [], 0
            out.write(frames(payloads))
        if out is not None:
            out.close()
            entries = np.array(kept, ENTRY)
            with fs.open_output_stream(f"{root}/{name}.idx") as index:
                index.write(index_bytes(entries))
            yield pa.RecordBatch.from_pylist([{"number": number, "file": name, "records": len(kept), "ids": ids,
                                               "bytes": offset}],
                                             schema=pa.schema([("number", pa.int32()), ("file", pa.string()),
                                                               ("records", pa.int64()), ("ids", pa.int64()),
                                                               ("bytes", pa.int64())]))

    files = max(1, -(-docs.count() // file_rows))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("row")]
    made = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, MANIFEST)
    made.write.parquet(f"{folder}/files")
    made = spark.read.schema(MANIFEST).parquet(f"{folder}/files")
    # Ids before a file: those of earlier blocks of files and of earlier files of its block.
    block = F.floor(F.col("number") / 1024)
    totals = made.groupBy(block.alias("block")).agg(F.sum("ids").alias("block_ids"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for 1024 files
    inside = Window.partitionBy("block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    base = (made.withColumn("block", block)
            .join(F.broadcast(totals.select("block", F.coalesce(F.sum("block_ids").over(earlier), F.lit(0)).alias("before"))), "block")
            .withColumn("base", F.col("before") + F.coalesce(F.sum("ids").over(inside), F.lit(0)))
            .select("number", "file", "records", "ids", "bytes", "base"))
    base.write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST + ", base long").parquet(f"{folder.rstrip('/')}/manifest")


ROWS = "doc_id long, start long, ids binary"
ARROW_ROWS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def _rows(payloads: list[bytes], starts: list[int]) -> pa.RecordBatch:
    parts = [opened(p) for p in payloads]
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int64()), pa.array(starts, pa.int64()),
                                       pa.array([ids for _, ids in parts], pa.binary())], schema=ARROW_ROWS)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian
    uint32) of every record, one task a file, every checksum checked."""
    folder = folder.rstrip("/")
    files = manifest(spark, folder)
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                where, ids, seen = f"{root}/{row['file']}.rec", row["base"], 0
                with fs.open_input_stream(where) as stream:
                    for payloads in scan(stream, where):
                        starts = []
                        for p in payloads:
                            starts.append(ids)
                            ids += n_ids(p)
                        seen += len(payloads)
                        yield _rows(payloads, starts)
                if seen != row["records"] or ids - row["base"] != row["ids"]:
                    raise ValueError(f"{where}: {seen} records, the manifest has {row['records']}")

    n = max(1, files.count())
    return files.repartitionByRange(n, "number").mapInArrow(run, ROWS)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """file, record, offset, length and start of every record, from the index files alone."""
    folder = folder.rstrip("/")
    files = manifest(spark, folder)
    ship(spark)
    schema = pa.schema([("file", pa.string()), ("record", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()),
                        ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                where = f"{root}/{row['file']}.idx"
                with fs.open_input_stream(where) as stream:
                    entries = read_index(stream.read(), where)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["file"]] * len(entries), pa.string()), pa.array(np.arange(len(entries))),
                     *[pa.array(entries[c].astype(np.int64)) for c in ("offset", "length")],
                     pa.array(entries["first"].astype(np.int64) + row["base"])], schema=schema)

    n = max(1, files.count())
    return files.repartitionByRange(n, "number").mapInArrow(run, "file string, record long, offset long, length long, start long")


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """The rows of ``read`` and their ``place`` in an order drawn from ``seed``
    (equal draws by place in the files): records are fetched by offset."""
    folder = folder.rstrip("/")
    ship(spark)
    draw = F.xxhash64(F.lit(seed), "start")
    # The order is that of (draw, start); tasks take ranges of it.
    order = index(spark, folder).withColumn("place", draw).sort("place", "start")
    schema = ARROW_ROWS.append(pa.field("place", pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for batch in batches:
            rows, got, at, size, files = batch.to_pylist(), [], 0, 0, {}
            try:
                for i, row in enumerate(rows):
                    where = f"{root}/{row['file']}.rec"
                    if where not in files:
                        if len(files) >= 64:
                            files.pop(next(iter(files))).close()
                        files[where] = fs.open_input_file(where)
                    got.append(fetch(files[where], where, row["offset"], row["length"]))
                    size += row["length"]
                    if size > TOGETHER or i + 1 == len(rows):
                        part = _rows(got, [r["start"] for r in rows[at:i + 1]])
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r["place"] for r in rows[at:i + 1]], pa.int64())],
                                                         schema=schema)
                        got, at, size = [], i + 1, 0
            finally:
                for f in files.values():
                    f.close()

    return order.mapInArrow(run, ROWS + ", place long")
