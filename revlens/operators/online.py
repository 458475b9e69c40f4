"""MOD-8: averaged perceptron and SGD with log loss by iterative parameter
mixing.

Rows are dealt to ``shards`` by a hash of their id and ordered in a shard by
another, once, and stored as packed records of many rows (``deal``; fits can share
them).  In a pass every shard starts from the same
weights and takes its rows one after the other; the next pass starts from the
mean of the shards' final weights.  Shards and order depend on ids and seed
alone, so the number of partitions changes nothing but the order of a sum
(weights agree to about 1e-9).  A shard's records are read as a stream; a task
holds one of them and a few vectors of the vocabulary's width, the driver two.

Rows with a null label, weight or vector are left out; repeated ids are rows like any
other (ordered by their content); an empty table or a single class is an error.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from . import blocksum as B

COUNTS = -1  # block of (rows, loss, shards)
PACKED = "shard int, n int, y binary, weight binary, ends binary, idx binary, val binary"
PACKED_ENTRIES = 1 << 18  # entries of a packed record, as long as it has more than one row


@dataclass
class Linear:
    weights: np.ndarray  # the last one is the intercept
    losses: list[float]

    def score(self, rows: DataFrame, features: str = "features") -> Column:
        """Margin of a row; positive means class 1."""
        shared = rows.sparkSession.sparkContext.broadcast(self.weights)

        @F.pandas_udf("double")
        def margin(idx: pd.Series, val: pd.Series) -> pd.Series:
            w = shared.value
            return pd.Series([None if i is None else float(w[i] @ v) + w[-1] for i, v in zip(idx, val)], dtype="float64")

        return margin(*B.sparse_entries(features))


class _Shard:
    """State of one pass over one shard."""

    def __init__(self, start: np.ndarray):
        self.w, self.b = start[:-1].copy(), float(start[-1])
        self.rows, self.loss = 0, 0.0

    def end(self) -> np.ndarray:
        return np.append(self.w, self.b)

    def out(self) -> Iterator[pd.DataFrame]:
        yield from B.records(self.end())
        yield pd.DataFrame({"block": [COUNTS], "vals": [np.array([self.rows, self.loss, 1.0])]})


class _Perceptron(_Shard):
    """A mistake adds the row; ``early`` weighs each addition by the rows before
    it, so that the sum of the weights over all rows is rows * end - early."""

    def __init__(self, start: np.ndarray, done: int):
        super().__init__(start)
        self.early, self.early_b = np.zeros(len(self.w)), 0.0

    def steps(self, y, weight, ends, idx, val):
        w, early, b, early_b, rows, loss = self.w, self.early, self.b, self.early_b, self.rows, self.loss
        at = 0
        for up, c, end in zip(y, weight, ends):
            i, v = idx[at:end], val[at:end]
            at = end
            sign = 1.0 if up > 0 else -1.0
            margin = sign * (float(w[i] @ v) + b)
            if margin <= 0:
                loss -= margin
                add = sign * c
                w[i] += add * v
                b += add
                early[i] += rows * add * v
                early_b += rows * add
            rows += 1
        self.b, self.early_b, self.rows, self.loss = b, early_b, rows, loss

    def out(self):
        yield from super().out()
        size = len(self.w) + 1
        yield from B.records(self.rows * self.end() - np.append(self.early, self.early_b), B.blocks_of(size))


class _LogLoss(_Shard):
    """Steps of 1 / (alpha (t0 + t)); the L2 shrinking is kept as a factor."""

    ALPHA, FIRST = 1e-4, 10.0

    def __init__(self, start: np.ndarray, done: int):
        super().__init__(start)
        self.scale, self.done = 1.0, done

    def steps(self, y, weight, ends, idx, val):
        w, b, scale, rows, loss, exp, log1p = self.w, self.b, self.scale, self.rows, self.loss, math.exp, math.log1p
        alpha, first, done, at = self.ALPHA, 1.0 / self.FIRST, self.done, 0
        for up, c, end in zip(y, weight, ends):
            i, v = idx[at:end], val[at:end]
            at = end
            old = w[i]
            margin = scale * float(old @ v) + b
            small = exp(-abs(margin))  # of the sizes below 1, so that none overflows
            signed = margin if up > 0 else -margin
            loss += c * (log1p(small) if signed > 0 else log1p(small) - signed)
            p = 1 / (1 + small) if margin > 0 else small / (1 + small)
            rate = 1.0 / (first + alpha * (done + rows))
            scale *= 1.0 - rate * alpha
            if scale < 1e-6:
                w *= scale
                scale = 1.0
                old = w[i]
            pull = rate * c * (p - up)
            w[i] = old - pull / scale * v
            b -= pull
            rows += 1
        self.b, self.scale, self.rows, self.loss = b, scale, rows, loss

    def end(self):
        return np.append(self.w * self.scale, self.b)


def dealt(rows: DataFrame, key: str, label: str, features: str, shards: int, seed: int) -> DataFrame:
    """Rows by shard, in order, with balanced class weights."""
    y = F.col(label).cast("double")
    rows = rows.where(y.isNotNull() & F.col(features).isNotNull())
    n = {r["y"]: r["n"] for r in rows.groupBy(y.alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(n) != {0.0, 1.0}:
        raise ValueError(f"two classes 0 and 1 wanted, found {sorted(n)}")
    idx, val = B.sparse_entries(features)
    total = n[0.0] + n[1.0]
    return (rows.select(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(shards)).cast("int").alias("shard"),
                        F.xxhash64(F.lit(seed + 1), key).alias("place"), y.alias("y"),
                        F.when(y == 0, total / (2.0 * n[0.0])).otherwise(total / (2.0 * n[1.0])).alias("weight"),
                        idx.alias("idx"), val.alias("val"))
            .repartition("shard").sortWithinPartitions("shard", "place", "y", "idx", "val"))


@dataclass
class Dealt:
    """The packed rows of a deal and, one number a shard, its rows: the steps of a pass."""
    packed: DataFrame
    sizes: dict[int, int]


def _flat(column: pa.ListArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(bounds of the rows, all their entries) of a list column."""
    return np.asarray(column.offsets) - column.offsets[0].as_py(), np.asarray(column.flatten(), dtype=kind)


def _packed(batches: Iterator[pa.RecordBatch], entries: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a shard as one record, in their order."""
    names = [c.split()[0] for c in PACKED.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, y, weight = (np.asarray(batch.column(c)) for c in ("shard", "y", "weight"))
        (bounds, idx), (_, val) = _flat(batch.column("idx"), "int32"), _flat(batch.column("val"), "float64")
        start = 0
        while start < len(shard):
            # As many rows as have one shard and together at most so many entries; one at least.
            most = int(np.searchsorted(bounds, bounds[start] + entries, "right")) - 1
            end = max(start + 1, min(most, int(np.searchsorted(shard, shard[start], "right"))))
            a, b = bounds[start], bounds[end]
            cells = [int(shard[start]), end - start, y[start:end].tobytes(), weight[start:end].tobytes(),
                     (bounds[start + 1:end + 1] - a).astype("int64").tobytes(), idx[a:b].tobytes(), val[a:b].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, [pa.int32()] * 2 + [pa.binary()] * 5)], names=names)
            start = end


def deal(rows: DataFrame, key: str = "review_id", label: str = "label", features: str = "features",
         shards: int = 64, seed: int = 42, entries: int = PACKED_ENTRIES) -> Dealt:
    """The rows dealt and stored for one fit or several."""
    checkpoint_dir(rows.sparkSession)
    made = dealt(rows, key, label, features, shards, seed).select("shard", "y", "weight", "idx", "val")
    # Records keep their task and their place in it: a shard lies whole and in order in one partition.
    packed = made.mapInArrow(lambda batches: _packed(batches, entries), PACKED).checkpoint()
    return Dealt(packed, {r["shard"]: r["n"] for r in packed.groupBy("shard").agg(F.sum("n").alias("n")).collect()})


def _pass(rows: DataFrame, start: np.ndarray, kind: Callable, epoch: int, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    shared = rows.sparkSession.sparkContext.broadcast(start)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for f in frames:
            for shard, y, weight, ends, idx, val in zip(f["shard"], f["y"], f["weight"], f["ends"], f["idx"], f["val"]):
                if shard != now:
                    if state is not None:
                        yield from state.out()
                    now, state = shard, kind(shared.value, epoch * sizes[shard])
                state.steps(np.frombuffer(y).tolist(), np.frombuffer(weight).tolist(), np.frombuffer(ends, "int64").tolist(),
                            np.frombuffer(idx, "int32").astype("int64"), np.frombuffer(val))
        if state is not None:
            yield from state.out()

    try:
        return B.summed(rows.mapInPandas(run, B.BLOCK))
    finally:
        shared.unpersist()


def _fit(rows: DataFrame | Dealt, width: int, kind: Callable, max_passes: int, tol: float, patience: int, **deals) -> Linear:
    stored = rows if isinstance(rows, Dealt) else deal(rows, **deals)
    size = width + 1
    w, total, steps = np.zeros(size), np.zeros(size), 0.0
    losses: list[float] = []
    best, stale = math.inf, 0
    for epoch in range(max_passes):
        got = _pass(stored.packed, w, kind, epoch, stored.sizes)
        n, loss, used = got[COUNTS]
        w = B.matrix_of(got, (size,)) / used
        if kind is _Perceptron:
            total += B.matrix_of(got, (size,), B.blocks_of(size))
            steps += n
        losses.append(loss / n)
        stale = stale + 1 if losses[-1] > best - tol else 0
        best = min(best, losses[-1])
        if stale >= patience:
            break
    return Linear(total / steps if kind is _Perceptron else w, losses)


def averaged_perceptron(rows: DataFrame | Dealt, width: int, max_passes: int = 25, tol: float = 1e-3, patience: int = 5,
                        key: str = "review_id", label: str = "label", features: str = "features",
                        shards: int = 64, seed: int = 42) -> Linear:
    """Perceptron with balanced classes; the model is the mean of the weights
    over every row of every pass.  Rows that ``deal`` made need no key, label, features, shards and seed."""
    return _fit(rows, width, _Perceptron, max_passes, tol, patience, key=key, label=label, features=features, shards=shards, seed=seed)


def sgd_log_loss(rows: DataFrame | Dealt, width: int, max_passes: int = 35, tol: float = 1e-3, patience: int = 5,
                 key: str = "review_id", label: str = "label", features: str = "features",
                 shards: int = 64, seed: int = 42) -> Linear:
    """Logistic regression (L2, 1e-4) by stochastic gradient steps, balanced classes."""
    return _fit(rows, width, _LogLoss, max_passes, tol, patience, key=key, label=label, features=features, shards=shards, seed=seed)
