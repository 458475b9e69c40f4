"""N-gram Jaccard join: count-vector R-tree over shingle sets.

A document is the set of its distinct five-word shingles (as 64-bit
hashes).  Two documents link when the Jaccard similarity of their sets
reaches 0.8; a component is what links reach.

1. Documents with equal sets are one node, known by the set's hash.
   Copies never meet one another again.
2. Lists: sets that link share one of the first ``n - ceil(0.8 n) + 1``
   shingles of any common order.  The order puts shingles that more than
   one in ``HOT_SHARE`` documents hold last (there are at most ``HOT_SHARE``
   times the mean set size of those, at any corpus size), then goes by
   hash, so what many documents share makes no list of otherwise different
   documents.  Lists of such shingles remain for groups of near copies
   only; they are summed before the shuffle and joined as a skewed key.
3. Shingles are hashed into ``GROUPS`` groups; a node's group counts are a
   point.  The sum of coordinate minima of two points bounds their overlap
   from above; pairs below the overlap that 0.8 asks for are dropped.
4. Every list is first joined with its smallest node only.  Most lists are
   then inside one component and done.  The rest is joined whole, between
   different components, through an R-tree: the list's points are packed
   into leaves with their bounding boxes, leaf pairs are pruned by the
   minima of the boxes' upper corners, and what survives is bounded pair
   by pair, large sets with finer groups as well.  Long lists are dealt
   into pairs of blocks first; lists of the same nodes are joined once.
   Nodes with such a partner go on, never the pairs: a task gets the whole
   sets of its nodes and verifies pairs where it finds them, as long as
   the two are in different components, so links stay fewer than nodes.
5. Links are verified on the whole sets; components follow by label
   propagation with pointer jumping.

No link between different texts is lost: a pair of nodes left unverified
either shares no list, or fails a bound, or is in one component already.

Defined results: a null text and a text without words have no shingles and
link with nothing (component: the own id); with fewer than five words the
whole sequence is one shingle; repeated rows are copies of one node; rows
that share an id but not the text are separate nodes; a null id is never
the smallest of a component unless all its ids are null; an empty table
gives no rows; texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship

WORDS = 5
GROUPS = 64
FINE = 512              # sets from this size on also have finer groups, one for four shingles
HOT_SHARE, HOT_LEAST = 8000, 32
COUNT_FLUSH = 1 << 22  # shingles counted at once in a task
SLOTS = 1 << 23        # bits of the filter for nodes whose sets are wanted: 1 MB, of any number of nodes
BLOCK, LEAF = 2048, 32
TASK_ROWS, TASK_BYTES = 20_000, 1 << 24  # of lists that are joined, and of lists with sets that are verified, in one task
REMEMBER = 1 << 19     # pairs a task remembers as not linked
OPEN = ["key", "i", "j", "own", "node", "comp", "near"]
STRETCH = 1 << 20      # bytes hashed in one go
TOGETHER = 1 << 21     # characters whose sets are made in one go


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# A word's hash is a polynomial in a fixed odd base over random values of its bytes, modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15 * 8 + 5 & (1 << 64) - 1
_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) <= n:
        made = [np.ones(max(n, STRETCH) + 1, np.uint64) for _ in range(2)]
        for out, base in zip(made, (_BASE, pow(_BASE, -1, 1 << 64)), strict=True):
            out[1:] = base
            np.cumprod(out, out=out)
        if n > STRETCH:
            return made[0], made[1]
        _POWERS[:] = made
    return _POWERS[0], _POWERS[1]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of ``data`` (split at ASCII white space), about ``STRETCH`` bytes at a time."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.concatenate(([True], _SPACE[raw], [True]))
    starts, ends = np.flatnonzero(edge[:-1] & ~edge[1:]), np.flatnonzero(~edge[:-1] & edge[1:])
    out, k = np.empty(len(starts), np.uint64), 0
    while k < len(starts):
        at = starts[k]
        last = max(k + 1, int(np.searchsorted(ends, at + STRETCH, side="right")))
        up, down = _powers(int(ends[last - 1] - at))
        part = raw[at:ends[last - 1]]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[part] * up[:len(part)], dtype=np.uint64)))
        a, b = starts[k:last] - at, ends[k:last] - at
        out[k:last] = (sums[b] - sums[a]) * down[a]
        k = last
    return starts, _mix(out)


class Sets:
    """Shingle sets of some texts: sorted, distinct, one after the other."""

    def __init__(self, texts: list[str | None]):
        data = [(t or "").encode("utf-8", "replace") for t in texts]
        begins = np.concatenate(([0], np.cumsum([len(d) + 1 for d in data], dtype=np.int64)))
        where, flat = word_hashes(b" ".join(data).lower())  # bytes: lowers A-Z only
        starts = np.searchsorted(where, begins)
        counts = np.diff(starts)
        whole = _mix(_combine(flat, WORDS))
        parts = []
        for i, n in enumerate(counts.tolist()):
            at = starts[i]
            if n >= WORDS:
                s = np.sort(whole[at:at + n - WORDS + 1])
                parts.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
            else:
                parts.append(_mix(_combine(flat[at:at + n], n)) if n else s_none)
        self.n = np.array([len(p) for p in parts], np.int64)
        self.all = np.concatenate(parts) if parts else s_none
        self.starts = np.concatenate(([0], np.cumsum(self.n)))
        self.doc = np.repeat(np.arange(len(parts)), self.n)
        # Two independent 64-bit hashes of every set: sums of its hashes, mixed.
        self.node = _mix(self._sums(self.all) + self.n.astype(np.uint64)).view(np.int64)
        self.check = _mix(self._sums(_mix(self.all ^ np.uint64(0x5851F42D4C957F2D)))).view(np.int64)

    def _sums(self, x: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def of(self, i: int) -> np.ndarray:
        return self.all[self.starts[i]:self.starts[i + 1]]


s_none = np.empty(0, np.uint64)


def _combine(h: np.ndarray, size: int) -> np.ndarray:
    """One hash for every ``size`` words in a row."""
    out = np.full(max(0, len(h) - size + 1), size, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - size + 1 + i] if len(out) else out
    return out


def in_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, Sets]]:
    """The rows and their sets, so many at a time as ``TOGETHER`` characters allow."""
    for batch in batches:
        size = batch["text"].str.len().fillna(0).to_numpy(np.int64)
        group = np.cumsum(size) // TOGETHER
        for start, end in zip(*(lambda e: (np.concatenate(([0], e)), np.concatenate((e, [len(batch)]))))(
                np.flatnonzero(np.diff(group)) + 1), strict=True):
            rows = batch.iloc[start:end]
            if len(rows):
                yield rows, Sets(rows["text"].tolist())


def _required(n_a, n_b):
    """Least overlap of two linked sets: 100 overlap >= 80 union."""
    return -(-4 * (n_a + n_b) // 9)


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))


def row_key(docs: DataFrame) -> Column:
    """What tells the rows of ``docs`` apart: a hash of id and text."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"])


def fine_groups(s: np.ndarray) -> bytes:
    """Counts of a large set in nested groups: a power of two of them, a quarter of its size or more."""
    groups = 1 << (len(s) // 4 - 1).bit_length()
    return np.bincount((s >> np.uint64(40)).astype(np.int64) % groups, minlength=groups).astype("<u4").tobytes()


def fine_bound(x: np.ndarray, y: np.ndarray, n: np.ndarray, fine: list[bytes | None]) -> np.ndarray:
    """Which index pairs still allow a link by the finer groups of both, folded to the coarser of the two."""
    keep = np.ones(len(x), bool)
    size = np.array([len(f) // 4 if f else 0 for f in fine])
    for ga in np.unique(size[size > 0]):
        for gb in np.unique(size[size > 0]):
            at = np.flatnonzero((size[x] == ga) & (size[y] == gb))
            g = min(ga, gb)
            folded = {}
            for i in np.unique(np.concatenate((x[at], y[at]))).tolist():
                folded[i] = np.frombuffer(fine[i], "<u4").reshape(-1, g).sum(0, dtype=np.int64)
            if folded:
                rows = np.stack(list(folded.values()))
                place = dict(zip(folded, range(len(folded)), strict=True))
                px, py = (np.fromiter(map(place.__getitem__, v[at].tolist()), np.int64, len(at)) for v in (x, y))
                step = max(1, (1 << 22) // int(g))
                for k in range(0, len(at), step):
                    low = np.minimum(rows[px[k:k + step]], rows[py[k:k + step]]).sum(1)
                    keep[at[k:k + step]] = low >= _required(n[x[at[k:k + step]]], n[y[at[k:k + step]]])
    return keep


def fits(n_a: int, n_b: int, f_a: bytes | None, f_b: bytes | None) -> bool:
    """Whether the finer groups of both, if there are any, still allow a link."""
    if f_a is None or f_b is None:
        return True
    g = min(len(f_a), len(f_b)) // 4
    x, y = (np.frombuffer(f, "<u4").reshape(-1, g).sum(0, dtype=np.int64) for f in (f_a, f_b))
    return bool(np.minimum(x, y).sum() >= _required(n_a, n_b))


def sketch(docs: DataFrame) -> DataFrame:
    """Node, set size and group counts of every document; and counts of
    shingles that a task saw in several nodes (rows with ``shingle``)."""

    def counted(held: list[np.ndarray]) -> pd.DataFrame:
        ids, c = np.unique(np.concatenate(held), return_counts=True)
        ids, c = ids[c > 1], c[c > 1]
        out = pd.DataFrame({"shingle": ids.view(np.int64), "c": c.astype(np.int64)}).reindex(columns=cols)
        return out.astype({k: "Int64" for k in cols[:5]}).assign(vec=None, fine=None)

    cols = ["doc_id", "row_key", "n", "node", "check", "vec", "fine", "shingle", "c"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, seen = [], 0, set()
        for rows, sets in in_chunks(batches):
            group = sets.doc * GROUPS + (sets.all >> np.uint64(40)).astype(np.int64) % GROUPS
            vec = np.bincount(group, minlength=len(rows) * GROUPS).reshape(len(rows), GROUPS)
            out = pd.DataFrame({"doc_id": rows["doc_id"].astype("Int64"), "row_key": rows["row_key"], "n": sets.n,
                                "node": sets.node, "check": sets.check})
            out["vec"] = pd.Series([v if n else None for v, n in zip(vec, sets.n, strict=True)], index=out.index, dtype=object)
            out["fine"] = pd.Series([fine_groups(sets.of(i)) if n >= FINE else None for i, n in enumerate(sets.n.tolist())],
                                    index=out.index, dtype=object)
            yield out.assign(shingle=pd.array([pd.NA] * len(out), "Int64"), c=pd.array([pd.NA] * len(out), "Int64"))
            for i, node in enumerate(sets.node.tolist()):
                if sets.n[i] and node not in seen:
                    seen.add(node)
                    held.append(sets.of(i))
                    size += len(held[-1])
            if size > COUNT_FLUSH:
                yield counted(held)
                held, size = [], 0
        if held:
            yield counted(held)

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), row_key(docs).alias("row_key"))
    return rows.mapInPandas(run, "doc_id long, row_key long, n long, node long, check long, vec array<int>, fine binary, shingle long, c long")


def list_keys(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """(key, node, hot) of the shingles under which a node is listed."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common, seen = shared.value, set()
        for _, sets in in_chunks(batches):
            often = np.zeros(len(sets.all), bool)
            if len(common):
                often = common[np.minimum(np.searchsorted(common, sets.all), len(common) - 1)] == sets.all
            chosen = []
            for i, (node, n) in enumerate(zip(sets.node.tolist(), sets.n.tolist(), strict=True)):
                if not n or node in seen:
                    continue
                seen.add(node)
                at = sets.starts[i]
                first = np.argsort(often[at:at + n], kind="stable")[:n - -(-4 * n // 5) + 1]
                chosen.append(first + at)
            if chosen:
                at = np.concatenate(chosen)
                yield pd.DataFrame({"key": sets.all[at].view(np.int64), "node": sets.node[sets.doc[at]], "hot": often[at]})

    return _read(docs).mapInPandas(run, "key long, node long, hot boolean")


def listed(keys: DataFrame) -> DataFrame:
    """(key, node, leader, members) of the lists of two nodes or more, every node once in a list.

    Copies read by different tasks come with the same (key, node) several times."""
    whole = Window.partitionBy("key")
    cold = (keys.where(~F.col("hot")).select("key", "node").repartition("key").dropDuplicates(["key", "node"])  # one exchange by key
            .withColumns({"leader": F.min("node").over(whole), "members": F.count("*").over(whole)}))
    warm = keys.where("hot").select("key", "node").distinct()
    heads = warm.groupBy(F.col("key").alias("k")).agg(F.min("node").alias("leader"), F.count("*").alias("members"))
    warm = warm.join(heads, warm["key"] == heads["k"]).select("key", "node", "leader", "members")
    return cold.unionByName(warm).where("members > 1")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, set) of the wanted nodes and of a few more: the filter that
    goes to the tasks has a fixed size, whoever joins by node is exact."""
    slot = F.pmod("node", F.lit(SLOTS))
    filled = (wanted.groupBy(F.floor(slot / 64).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(node, {SLOTS}) % 64 AS int))")).alias("bits"))
              .toPandas())
    words = np.zeros(SLOTS // 64, np.int64)
    words[filled["word"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(words.view(np.uint64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        may, seen = shared.value, set()
        for _, sets in in_chunks(batches):
            at = sets.node % SLOTS
            wanted_here = np.flatnonzero((may[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool) & (sets.n > 0))
            out = []
            for i in wanted_here.tolist():
                node = int(sets.node[i])
                if node not in seen:
                    seen.add(node)
                    out.append((node, sets.of(i).tobytes()))
            if out:
                yield pd.DataFrame(out, columns=["node", "set"])

    # Dealt by node once: the two joins below read the same exchange.
    return _read(docs).mapInPandas(run, "node long, set binary").repartition("node").dropDuplicates(["node"])


def bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and group counts allow a link."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("vec").alias("v_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("vec").alias("v_b"))
    low = F.aggregate(F.zip_with("v_a", "v_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    need = F.ceil(4 * (F.col("n_a") + F.col("n_b")) / 9)
    near = cut(pairs.join(a, "a").join(b, "b").where(5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b"))
               .where(low >= need).select("a", "b", "n_a", "n_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = [fits(*r) for r in zip(batch["n_a"], batch["n_b"], batch["f_a"], batch["f_b"], strict=True)]
            yield batch.loc[keep, ["a", "b"]]

    large = nodes.where(F.col("fine").isNotNull())
    a, b = (large.select(F.col("node").alias(x), F.col("fine").alias(f"f_{x}")) for x in "ab")
    return near.join(a, "a", "left").join(b, "b", "left").mapInPandas(run, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= 80 * (len(x) + len(y) - both)


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs of nodes whose whole sets link."""
    sets = sets_of(docs, pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["s_a"], batch["s_b"], strict=True):
                keep.append(linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
            yield batch.loc[keep, ["a", "b"]]

    a = sets.select(F.col("node").alias("a"), F.col("set").alias("s_a"))
    b = sets.select(F.col("node").alias("b"), F.col("set").alias("s_b"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "s_a", "s_b").mapInPandas(run, "a long, b long")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp): comp is the smallest node that links reach."""
    links = cut(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut(nodes.join(links.select(F.col("a").alias("node")).distinct(), "node", "left_semi")
                 .select("node", F.col("node").alias("comp")))
    while True:
        near = (links.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("c")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c")))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "c").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("comp").alias("far"))
        moved = cut(step.join(jump, "to").select("node", F.col("comp").alias("was"), F.least("to", "far").alias("comp")))
        labels = moved.select("node", "comp")
        if moved.where("was <> comp").isEmpty():
            break
    alone = nodes.join(labels, "node", "left_anti").select("node", F.col("node").alias("comp"))
    return labels.unionByName(alone)


def tree_pairs(n: np.ndarray, vec: np.ndarray, comp: np.ndarray, side: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """R-tree self-join of points: index pairs of different components whose bounds allow a link.

    ``side`` (0/1), if given, admits pairs across the two sides only."""
    order = np.lexsort((vec[:, 1], vec[:, 0] // 4, n // 16))  # packing order of the leaves
    leaves = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
    upper = np.stack([vec[leaf].max(0) for leaf in leaves])
    low_n, high_n = np.array([n[x].min() for x in leaves]), np.array([n[x].max() for x in leaves])
    out_a, out_b = [], []
    for i, leaf in enumerate(leaves):
        sizes = (5 * high_n[i:] >= 4 * low_n[i]) & (5 * high_n[i] >= 4 * low_n[i:])
        room = np.minimum(upper[i], upper[i:]).sum(1) >= _required(low_n[i], low_n[i:])
        for j in np.flatnonzero(sizes & room) + i:
            other = leaves[j]
            low = np.minimum(vec[leaf][:, None, :], vec[other][None, :, :]).sum(2)
            big, small = np.maximum(n[leaf][:, None], n[other]), np.minimum(n[leaf][:, None], n[other])
            ok = (low >= _required(n[leaf][:, None], n[other])) & (5 * small >= 4 * big) & (comp[leaf][:, None] != comp[other])
            if side is not None:
                ok &= side[leaf][:, None] != side[other]
            x, y = np.nonzero(ok if j > i else np.triu(ok, 1))
            out_a.append(leaf[x])
            out_b.append(other[y])
    return np.concatenate(out_a), np.concatenate(out_b)


def open_rows(lists: DataFrame, comps: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of lists that span several components, as far as an R-tree finds them a partner.

    One row a list, block pair and node, so never more than the lists hold;
    the pairs themselves stay in the task.  ``near`` is the smallest
    component of the list.  The leader's pairs have all been tried."""
    rows = (lists.where("members > 2 AND node <> leader").select("key", "node", (F.col("members") - 1).alias("members"))
            .join(comps, "node"))
    # Lists of the same nodes (a passage shared whole) are one list: the one with the smallest key.
    same = [F.bit_xor(F.xxhash64("node")).alias("s"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("t")]
    several = (rows.groupBy("key").agg(F.min("comp").alias("near"), F.max("comp").alias("far"), F.count("*").alias("m"), *same)
               .where("near <> far").groupBy("s", "t", "m").agg(F.min(F.struct("key", "near")).alias("one")).select("one.*", "m"))
    # Dealt by the list: one row of it tells what its rows weigh, and they learn their parts as they learn ``near``.
    several, task = parted(cut(several), F.col("m") * F.ceil(F.col("m") / BLOCK), TASK_ROWS)
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = (rows.join(several, "key").withColumns({"blocks": blocks, "own": own})
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}))
    rows = cut(rows.select(*OPEN, task.alias("task")))
    points = of_tasks(rows, nodes.select("node", "n", "vec", "fine"))

    def run(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out = [group.iloc[:0].assign(n=0)]
        n, vec = own["n"].to_numpy(), np.stack(own["vec"].to_numpy())
        at = pd.Index(own["nd"]).get_indexer(group["node"])
        for part, x, y in listed_pairs(group.assign(at=at), n, vec, own["fine"].tolist()):
            kept = part.iloc[np.union1d(x, y)]
            out.append(kept.assign(n=n[kept["at"].to_numpy()]))
        return pd.concat(out)[[*OPEN, "n"]]

    return (rows.groupBy("task").cogroup(points.groupBy("to"))
            .applyInPandas(run, rows.select(*OPEN, F.lit(0).cast("long").alias("n")).schema))


def parted(rows: DataFrame, weight: Column, room: int) -> tuple[DataFrame, Column]:
    """``rows`` with ``parts``, and the task of a row that has ``near``, ``parts``, ``key``, ``i`` and ``j``:
    lists with the same ``near`` come together, in parts of about ``room``."""
    total = F.sum(weight)
    tasks = max(1, -(-(rows.agg(total.alias("w")).first()["w"] or 0) // room))
    large = cut(rows.groupBy("near").agg(F.ceil(total / room).alias("parts")).where("parts > 1"))  # at most ``tasks`` rows
    part = F.pmod(F.xxhash64("key", "i", "j"), F.coalesce("parts", F.lit(1).cast("long")))
    return rows.join(large, "near", "left"), F.pmod(F.xxhash64("near", part), F.lit(tasks))


def dealt(rows: DataFrame, weight: Column, room: int) -> DataFrame:
    """``rows`` with a task, stored: both sides of a cogroup read them."""
    made, task = parted(rows, weight, room)
    return cut(made.select(*rows.columns, task.alias("task")))


def of_tasks(rows: DataFrame, load: DataFrame) -> DataFrame:
    """``load`` by node, once for every task (``to``) whose rows name the node (``nd``)."""
    wanted = rows.select(F.col("task").alias("to"), F.col("node").alias("nd")).distinct()
    return wanted.join(load, F.col("nd") == load["node"]).drop("node")


def listed_pairs(group: pd.DataFrame, n: np.ndarray, vec: np.ndarray, fine: list[bytes | None],
                 root=lambda comp: comp) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Every list (or block pair of one) with the index pairs that the bounds allow a link; ``at`` is a row's place in the points."""
    for (_, i, j), part in group.groupby(["key", "i", "j"], sort=False):
        comp = np.array([root(c) for c in part["comp"].tolist()])
        if (comp == comp[0]).all():
            continue
        side = (part["own"].to_numpy() == i).astype(np.int8) if i != j else None
        at = part["at"].to_numpy()
        x, y = tree_pairs(n[at], vec[at], comp, side)
        ok = fine_bound(x, y, n[at], [fine[k] for k in at.tolist()])
        yield part, x[ok], y[ok]


def open_links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) among ``rows`` that join different components.

    A task gets its lists and, once each, the sets of their nodes.  It
    verifies a pair only while both ends are in different components, as
    far as it has seen, so it gives fewer links than it has nodes."""
    rows = dealt(rows, 8 * F.col("n") + 400, TASK_BYTES)
    sets = of_tasks(rows, sets_of(docs, rows.select("node").distinct()))

    def run(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        held = [np.frombuffer(v, np.uint64) for v in own["set"]]
        vec = np.stack([np.bincount((v >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS) for v in held])
        n, fine = np.array([len(v) for v in held]), [fine_groups(v) if len(v) >= FINE else None for v in held]
        at = pd.Index(own["nd"]).get_indexer(group["node"])
        parent: dict[int, int] = {}
        failed: set[tuple[int, int]] = set()
        out = []

        def root(c: int) -> int:
            while (up := parent.get(c, c)) != c:
                parent[c] = c = parent.get(up, up)
            return c

        for part, x, y in listed_pairs(group.assign(at=at), n, vec, fine, root):
            ids, comp, place = part["node"].tolist(), part["comp"].tolist(), part["at"].tolist()
            for i, j in zip(x.tolist(), y.tolist(), strict=True):
                a, b = min(ids[i], ids[j]), max(ids[i], ids[j])
                ra, rb = root(comp[i]), root(comp[j])
                if ra == rb or (a, b) in failed:
                    continue
                if linked(held[place[i]], held[place[j]]):
                    parent[ra] = rb
                    out.append((a, b))
                else:
                    if len(failed) >= REMEMBER:  # only spares a second look
                        failed.clear()
                    failed.add((a, b))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy("task").cogroup(sets.groupBy("to")).applyInPandas(run, "a long, b long")


def _joined(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, copies and comp (the component's smallest node) of every row."""
    ship(docs.sparkSession)
    made = cut(sketch(docs))
    each = made.where(F.col("node").isNotNull()).select("doc_id", "row_key", "n", "node", "check")
    nodes = cut(made.where("n > 0").groupBy("node", "check", "n").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("vec").alias("vec"), F.max("fine").alias("fine")))
    often = max(HOT_LEAST, nodes.count() // HOT_SHARE)
    hot = (made.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("c").alias("c"))
           .where(F.col("c") >= often).select("shingle").toPandas()["shingle"].to_numpy().astype(np.int64))
    keys = cut(list_keys(docs, np.sort(hot.view(np.uint64))))
    lists = cut(listed(keys))

    star = lists.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    tried = cut(bounded(star, nodes))
    links = cut(verified(docs, tried))
    comps = cut(components(nodes.select("node"), links))
    left = cut(open_rows(lists, comps, nodes))
    if not left.isEmpty():
        more = cut(open_links(docs, left))
        comps = cut(components(nodes.select("node"), links.unionByName(more)))

    smallest = comps.join(nodes, "node").groupBy("comp").agg(F.min("rep").alias("component_id"))
    found = (comps.join(smallest, "comp").join(nodes.select("node", "copies"), "node")
             .select(F.col("node").alias("nd"), "component_id", "copies", "comp"))
    linked = each.where("n > 0").join(found, each["node"] == found["nd"])
    empty = each.where("n = 0").withColumns({"component_id": F.col("doc_id"), "copies": F.lit(1).cast("long"),
                                             "comp": F.lit(None).cast("long")})
    cols: list[str | Column] = ["doc_id", "row_key", F.col("n").alias("n_shingles"), "component_id", "copies", "comp"]
    return linked.select(*cols).unionByName(empty.select(*cols))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and copies (rows with an equal set) of every document."""
    return _joined(docs).select("doc_id", "n_shingles", "component_id", "copies")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (before null).

    Rows without words stay; rows equal in id and text stay once."""
    rows = _joined(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))
    kept = (rows.where("n_shingles > 0").groupBy("comp").agg(first.alias("first")).select(F.col("first.row_key").alias("keep"))
            .unionByName(rows.where("n_shingles = 0").select(F.col("row_key").alias("keep")).distinct()))
    keyed = docs.select(row_key(docs).alias("keep"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return (keyed.join(kept, "keep").groupBy("keep").agg(F.first("row").alias("row"))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
