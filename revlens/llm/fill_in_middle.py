"""Fill-in-middle transformation: SWAR select over UTF-8 words.

Texts are cut after their k-th unit without decoding them.  The UTF-8 bytes
of a batch are viewed as uint64 words; the bytes that end a unit are marked
arithmetically, one marker bit a byte; ``bitwise_count`` and a cumulative
sum give the marks before every word, a binary search in that sum the word
of the k-th mark, and a select inside the word its byte.  All cuts of a batch
are found together.

Two cuts split a text into prefix, middle and suffix; the form of a row and
its cuts come from a hash of its id, so a task that runs again gives the same
rows and no state is kept.

Defined results: a null text counts as empty; an empty text, a text that
holds a sentinel and the share of rows that the hash leaves out stay plain;
a null id hashes like no digits; repeated rows are transformed one by one; an
empty table gives no rows; texts of any length are cut whole; a byte that is
no valid UTF-8 belongs to the unit before it (or starts the text); extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from .common import ship

SENTINELS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
UNITS = ("code_point", "line", "byte")
TOGETHER = 1 << 23  # bytes of text cut in one go
EACH = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)


def unit_ends(words: np.ndarray, unit: str) -> np.ndarray:
    """Bit 0 of each byte that ends a unit, for uint64 words of UTF-8 bytes."""
    if unit == "byte":
        return np.full_like(words, EACH)
    if unit == "line":
        x = words ^ (EACH * np.uint64(ord("\n")))
        return ~(((x & LOW7) + LOW7) | x | LOW7) >> np.uint64(7)
    # A byte 10xxxxxx continues a code point; one ends where the next byte does not continue it.
    starts = ((words >> np.uint64(7)) & ~(words >> np.uint64(6)) & EACH) ^ EACH
    return (starts >> np.uint64(8)) | (np.append(starts[1:], np.uint64(1)) << np.uint64(56))


class Units:
    """Rank and select over the unit ends of texts that lie end to end."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, unit: str = "code_point"):
        padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
        padded[:len(data)] = data
        self.ends = unit_ends(padded.view("<u8"), unit)
        # A text's last byte ends its last unit, whatever follows it.
        last = bounds[1:][bounds[1:] > bounds[:-1]] - 1
        np.bitwise_or.at(self.ends, last >> 3, np.uint64(1) << (8 * (last & 7)).astype(np.uint64))
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Unit ends among the bytes before ``at``."""
        below = (np.uint64(1) << (8 * (at & 7)).astype(np.uint64)) - np.uint64(1)
        return self.before[at >> 3] + np.bitwise_count(self.ends[at >> 3] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte offset after the k-th unit end (k from 1)."""
        word = np.searchsorted(self.before, k) - 1
        left = (k - self.before[word]).astype(np.uint64)
        upto = self.ends[word] * EACH  # byte i: the marks of bytes 0 to i
        reached = ((upto | HIGH) - left * EACH) & HIGH
        return 8 * word + 9 - np.bitwise_count(reached)


def draws(ids: list, seed: str) -> np.ndarray:
    """Four unsigned 32-bit numbers an id: the head of sha256(seed + decimal id)."""
    made = b"".join(hashlib.sha256(f"{seed}{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(made, ">u4").reshape(-1, 4).astype(np.int64)


def cuts(data: np.ndarray, bounds: np.ndarray, h: np.ndarray, unit: str) -> tuple[np.ndarray, ...]:
    """(units, units before either cut, byte offsets of the cuts) of every text."""
    units = Units(data, bounds, unit)
    rank = units.rank(bounds)
    n = rank[1:] - rank[:-1]
    a, b = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    first, second = np.minimum(a, b), np.maximum(a, b)

    def place(k):
        return np.where(k > 0, units.select(np.maximum(rank[:-1] + k, 1)), bounds[:-1])

    return n, first, second, place(first), place(second)


def _blocks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``TOGETHER`` bytes; one text at least."""
    at = 0
    while at < len(bounds) - 1:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + TOGETHER, "right")) - 1)
        yield at, end
        at = end


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a text column, nulls as empty texts."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), bounds


def transform(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", unit: str = "code_point",
              sentinels: tuple[str, str, str] = SENTINELS, seed: str = "1:", fim_percent: int = 90,
              spm_percent: int = 20) -> DataFrame:
    """id, n (units), form (plain, psm or spm), prefix_units, middle_units
    (null if plain) and output of every row: one pass, no shuffle."""
    if unit not in UNITS:
        raise ValueError(f"unit is one of {UNITS}")
    if not all(sentinels) or len(set(sentinels)) < 3:
        raise ValueError("three different sentinels are needed")
    p, s, m = (x.encode() for x in sentinels)
    schema = pa.schema([(id_column, pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_units", pa.int64()),
                        ("middle_units", pa.int64()), ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _texts(batch.column(1))
            for at, end in _blocks(bounds):
                own = bounds[at:end + 1] - bounds[at]
                part = data[bounds[at]:bounds[end]]
                ids = batch.column(0).slice(at, end - at)
                h = draws(ids.to_pylist(), seed)
                n, first, second, i, j = cuts(part, own, h, unit)
                raw, forms, out = part.tobytes(), [], []
                for lo, x, y, hi, h3, h4 in zip(own[:-1].tolist(), i.tolist(), j.tolist(), own[1:].tolist(),
                                                h[:, 2].tolist(), h[:, 3].tolist(), strict=True):
                    text = raw[lo:hi]
                    if not text or h3 % 100 >= fim_percent or p in text or s in text or m in text:
                        forms.append("plain")
                        out.append(text)
                    elif h4 % 100 < spm_percent:
                        forms.append("spm")
                        out.append(b"".join((s, raw[y:hi], p, raw[lo:x], m, raw[x:y])))
                    else:
                        forms.append("psm")
                        out.append(b"".join((p, raw[lo:x], s, raw[y:hi], m, raw[x:y])))
                plain = np.array([f == "plain" for f in forms])
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n), pa.array(forms, pa.string()), pa.array(first, mask=plain),
                     pa.array(second - first, mask=plain), pa.array(out, pa.binary()).view(pa.string())], schema=schema)

    ship(docs.sparkSession)
    return docs.select(docs[id_column].cast("long"), docs[text_column].cast("string")).mapInArrow(
        run, f"`{id_column}` long, n long, form string, prefix_units long, middle_units long, output string")


def rebuild(output: bytes, form: str, p: bytes, s: bytes, m: bytes) -> bytes:
    """The text that ``output`` was made from."""
    if form == "plain":
        return output
    one, two = (p, s) if form == "psm" else (s, p)
    if not output.startswith(one):
        raise ValueError(f"no {form} output: the first sentinel is missing")
    head, found, rest = output[len(one):].partition(two)
    tail, also, middle = rest.partition(m)
    if not (found and also):
        raise ValueError(f"no {form} output: a sentinel is missing")
    return head + middle + tail if form == "psm" else tail + middle + head


def restore(made: DataFrame, *, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``made`` with the column ``restored``, rebuilt from output and form alone."""
    p, s, m = (x.encode() for x in sentinels)
    at, form_at = made.columns.index("output"), made.columns.index("form")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _texts(batch.column(at))
            for i, j in _blocks(bounds):
                forms = batch.column(form_at).slice(i, j - i).to_pylist()
                raw, own = data[bounds[i]:bounds[j]].tobytes(), (bounds[i:j + 1] - bounds[i]).tolist()
                out = [rebuild(raw[x:y], f, p, s, m) for x, y, f in zip(own[:-1], own[1:], forms, strict=True)]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary()).view(pa.string())],
                                                 names=[*part.schema.names, "restored"])

    ship(made.sparkSession)
    return made.mapInArrow(run, StructType([*made.schema.fields, StructField("restored", StringType())]))


SQL = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
k AS (
  SELECT doc_id, t, n, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS a, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (
  SELECT doc_id, t, n, form, least(a, b) AS i, greatest(a, b) - least(a, b) AS m,
         substr(t, 1, least(a, b)) AS prefix, substr(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
         substr(t, greatest(a, b) + 1) AS suffix FROM k)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN m END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""
