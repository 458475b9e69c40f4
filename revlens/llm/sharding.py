"""Sharding: minimax contiguous partition of equal-text groups.

Groups of equal texts are atoms.  They stand in one fixed order (by the
digest of the text) and their sizes are turned into prefix sums inside
Spark.  The smallest shard capacity for which a greedy left-to-right fill
needs at most ``shards`` shards is found by binary search, and the order is
cut there.

The prefix sums never leave the cluster as a whole.  The driver holds an
index of at most ``index_size`` buckets ``(lowest prefix, highest prefix,
groups)``.  A lookup that such a bucket cannot answer exactly gives a lower
and an upper answer, so the binary search brackets the capacity; only the
buckets that a cut can still fall into are read again at a finer
resolution, until every lookup on the way is exact.  The driver's memory is
bounded by ``index_size`` at any number of groups.

With the optimal capacity fixed, each cut is placed as near to the mean of
what remains as that capacity allows, so sizes are near equal also where
one large group alone forces the capacity up.

Defined results: a null text counts as the empty text (size 8, CRC 0) and
falls in its group; repeated rows each take a slot of their own; rows of
equal ``doc_id`` and text are interchangeable; a null ``doc_id`` is an
ordinary value; an empty table gives no rows; further columns are ignored;
with fewer groups than shards the rest of the shards stay empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

OVERHEAD = 8


class PrefixIndex:
    """Bucketed prefix sums: sorted, disjoint (lowest, highest, groups)."""

    def __init__(self, rows):
        self.rows = sorted((int(a), int(b), int(n)) for a, b, n in rows)
        self.lo = [r[0] for r in self.rows]
        self.hi = [r[1] for r in self.rows]
        self.total = self.hi[-1]
        self.open: set[int] = set()  # buckets that left a lookup open

    def floor(self, x: int, upper: bool = False) -> int:
        """Largest prefix <= x (0 if none); a bound of it if the index cannot tell."""
        k = bisect_right(self.lo, x) - 1
        if k < 0:
            return 0
        if self.hi[k] <= x:
            return self.hi[k]
        if self.rows[k][2] > 2:
            self.open.add(k)
            return x if upper else self.lo[k]
        return self.lo[k]

    def ceil(self, x: int) -> int:
        """Smallest prefix >= x; an upper bound of it if the index cannot tell."""
        if x <= 0:
            return 0
        k = bisect_left(self.hi, x)
        if k == len(self.hi):
            return self.total
        if self.lo[k] >= x:
            return self.lo[k]
        if self.rows[k][2] > 2:
            self.open.add(k)
        return self.hi[k]

    def path(self, capacity: int, shards: int, upper: bool) -> list[int]:
        """Greedy fill: where each shard ends."""
        out, at = [], 0
        for _ in range(shards):
            at = max(at, self.floor(at + capacity, upper))
            out.append(at)
        return out

    def least(self, low: int, shards: int, upper: bool) -> int:
        """Binary search: the smallest capacity whose greedy fill reaches the end."""
        high = self.total
        while low < high:
            mid = (low + high) // 2
            if self.path(mid, shards, upper)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def between(self, a: int, b: int) -> set[int]:
        """Buckets of more than two groups that meet [a, b]."""
        first, last = bisect_left(self.hi, a), bisect_right(self.lo, b)
        return {k for k in range(first, last) if self.rows[k][2] > 2}


def _place(index: PrefixIndex, capacity: int, shards: int) -> list[int]:
    """Cuts of a fill within ``capacity``, each near the mean of the rest."""
    need = [index.total] * (shards + 1)  # need[j]: where shard j must have come to
    for j in range(shards, 0, -1):
        need[j - 1] = index.ceil(need[j] - capacity)
    cuts, at = [], 0
    for j in range(1, shards):
        most = max(at, index.floor(at + capacity))
        want = at + (index.total - at) // (shards - j + 1)
        below, above = max(at, index.floor(want)), index.ceil(want)
        near = above if above <= most and above - want < want - below else below
        at = max(min(near, most), min(need[j], most))
        cuts.append(at)
    return cuts


def _buckets(groups: DataFrame, ranges: list[tuple[int, int]], index_size: int) -> list:
    """Index rows of the prefixes in ``ranges`` (both ends included), each cut in two at least."""
    fair = max(1, sum(b - a + 1 for a, b in ranges) // max(1, index_size))
    key, first = F.lit(None).cast("long"), 0
    cond = F.lit(False)
    for a, b in ranges:
        inside, width = F.col("gend").between(a, b), max(1, min(fair, (b - a + 1) // 2))
        cond = cond | inside
        key = F.when(inside, F.lit(first) + F.floor((F.col("gend") - a) / F.lit(width))).otherwise(key)
        first += (b - a) // width + 1
    agg = groups.where(cond).groupBy(key.alias("k")).agg(F.min("gend"), F.max("gend"), F.count("*"))
    return [tuple(r)[1:] for r in agg.collect()]


def find_cuts(groups: DataFrame, total: int, largest: int, shards: int, index_size: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, shards - 1 cut positions) over ``groups(gend)``."""
    index = PrefixIndex(_buckets(groups, [(0, total)], index_size))

    def refine(open_: set[int]) -> PrefixIndex:
        ranges: list[tuple[int, int]] = []
        for k in sorted(open_):
            a, b, _ = index.rows[k]
            if ranges and k - 1 in open_:
                ranges[-1] = (ranges[-1][0], b)
            else:
                ranges.append((a, b))
        fresh = [r for i in range(0, len(ranges), 32) for r in _buckets(groups, ranges[i:i + 32], index_size)]
        return PrefixIndex([r for k, r in enumerate(index.rows) if k not in open_] + fresh)

    base = max(largest, -(-total // shards))
    while True:
        low, high = index.least(base, shards, True), index.least(base, shards, False)
        reach = zip(index.path(low, shards, False), index.path(high, shards, True), strict=True)
        open_ = set().union(*(index.between(a, b) for a, b in reach))
        if low == high and not open_:
            break
        index = refine(open_)
    while True:
        index.open.clear()
        cuts = _place(index, high, shards)
        near = {k + d for k in index.open for d in (-1, 0, 1)}
        open_ = {k for k in near if 0 <= k < len(index.rows) and index.rows[k][2] > 2}
        if not index.open:
            return high, cuts
        index = refine(open_)


def shard(docs: DataFrame, shards: int = 24, *, salts: int = 256, bins: int = 4096,
          index_size: int = 16384) -> DataFrame:
    """Assign every row of ``docs(doc_id, text)`` to a shard.

    Returns doc_id, size, text_crc32, law (``bytes``), shard, slot,
    grown_shard (null under this law), capacity (the minimax capacity).

    A group of copies is dealt over ``salts`` cells, so no task holds more
    than a cell of it; the cells (a digest and two sums) are ordered inside
    ``bins`` hash ranges of the digest, and the ranges' totals (one row
    each) are broadcast.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("g"))
    cell = Window.partitionBy("g", "salt").orderBy("doc_id")
    rows = cut(rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
               .withColumn("rn", F.row_number().over(cell)))
    cells = (rows.groupBy("g", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
             .withColumn("bin", F.pmod(F.xxhash64("g"), F.lit(bins)).cast("int")))
    by_cell = Window.partitionBy("bin").orderBy("g", "salt").rowsBetween(Window.unboundedPreceding, 0)
    by_group = Window.partitionBy("bin").orderBy("g")
    cells = cut(cells.select(
        "g", "salt", "bin", "n",
        (F.sum("n").over(by_cell) - F.col("n")).alias("rows0"),
        F.sum("b").over(by_group).alias("gend"),
        F.sum("b").over(Window.partitionBy("bin", "g")).alias("gsize"),
        (F.min("salt").over(Window.partitionBy("bin", "g")) == F.col("salt")).alias("first")))
    totals = cells.groupBy("bin").agg(F.max(F.col("rows0") + F.col("n")).alias("n"), F.max("gend").alias("b"))
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # over at most `bins` rows
    offsets = totals.select("bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row_off"),
                            F.coalesce(F.sum("b").over(before), F.lit(0)).alias("byte_off"))
    placed = cut(cells.join(F.broadcast(offsets), "bin").select(
        "g", "salt", (F.col("rows0") + F.col("row_off")).alias("rows0"),
        (F.col("gend") + F.col("byte_off")).alias("gend"), "gsize", "first"))
    groups = placed.where("first")
    total, largest = groups.agg(F.max("gend"), F.max("gsize")).first()
    if total is None:
        capacity, cuts, starts = 0, [0] * (shards - 1), {}
    else:
        capacity, cuts = find_cuts(groups, total, largest, shards, index_size)
    which = sum((F.when(F.col("gend") > c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    placed = placed.withColumn("shard", which)
    if total is not None:
        starts = dict(placed.groupBy("shard").agg(F.min("rows0")).collect())  # one row for each shard
    start = F.element_at(F.array(*[F.lit(int(starts.get(s, 0))) for s in range(shards)]), F.col("shard") + 1)
    placed = placed.select(F.col("g").alias("pg"), F.col("salt").alias("ps"), "shard",
                           (F.col("rows0") - start).cast("long").alias("slot0"))
    return (rows.join(placed, (F.col("g") == F.col("pg")) & (F.col("salt") == F.col("ps")))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("slot0") + F.col("rn") - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.lit(int(capacity)).cast("long").alias("capacity")))
