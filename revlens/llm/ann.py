"""Approximate nearest neighbours: shifted space-filling curves.

Vectors are projected several times (seeded orthonormal directions, a random
shift); each projection is put on a Hilbert curve.  Along each curve the
rows are range-partitioned into ``windows`` key windows of equal depth, a
query searches its own window and ``reach`` windows on either side of every
curve, and the windows' results merge by exact distance.

Equal vectors are one class: only a class's smallest ids can be among the
nearest, so a vector shared by a third of all rows costs one class.  Windows
are searched in tiles of bounded size (rows and queries are both dealt), so
no task holds a window.

Recall against size: the windows hold a fixed share of the rows, so recall
does not fall as the table grows; the price is work in proportion to
queries x rows x share, as a stated query set against all rows has.  The
share is a parameter: vectors without structure need a large one.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part; vectors of different length are searched apart;
repeated ids stand for one row each; with fewer candidates than ``k`` all
of them are returned; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship

BITS, DIMS, TIE = 8, 6, 15  # a curve key has BITS * DIMS bits, and TIE bits of the id's hash below them
DEPTH = 64  # least rows of a window


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer cells (rows x dims, ``bits`` bits each), after Skilling."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[:, i] & q) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(on, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def curve_keys(vectors: np.ndarray, curves: int, seed: int) -> np.ndarray:
    """Keys (rows x curves).  Directions and shifts depend on seed, curve and vector length alone."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    dim = vectors.shape[1]
    dims = min(DIMS, dim)
    out = np.empty((len(vectors), curves), np.int64)
    for c in range(curves):
        rng = np.random.default_rng([seed, c, dim])
        axes = np.linalg.qr(rng.standard_normal((dim, dims)))[0]
        shift = rng.random(dims)
        scaled = unit @ axes * np.sqrt(dim) / 3  # about -1..1 for vectors without structure
        levels = np.floor((np.tanh(scaled) / 2 + 0.5) * ((1 << BITS) - 1) + shift)
        out[:, c] = hilbert_keys(np.clip(levels, 0, (1 << BITS) - 1), BITS)
    return out


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(rows: DataFrame, most: int) -> DataFrame:
    """Equal vectors as one row: h, dim, vec, and their ``most`` smallest ids."""
    first = Window.partitionBy("h", "vec").orderBy("vec_id")
    few = (rows.withColumn("h", F.xxhash64("vec")).withColumn("rn", F.row_number().over(first))
           .where(F.col("rn") <= most))  # limited inside each task before the shuffle
    return (few.groupBy("h", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
            .select("h", F.size("vec").alias("dim"), "vec", "ids", F.col("ids")[0].alias("cid")))


def search(table: DataFrame, is_query: Column, *, id_column: str = "vec_id", vector_column: str = "embedding", k: int = 10,
           curves: int = 4, windows: int = 16, reach: int = 3, tile: int = 8192, seed: int = 11) -> DataFrame:
    """The ``k`` nearest rows found for every row with ``is_query``: query_id, rank, vec_id, score."""
    ship(table.sparkSession)
    rows = (table.select(table[id_column].cast("long").alias("vec_id"), table[vector_column].alias("e"),
                         F.coalesce(is_query, F.lit(False)).alias("q"))
            .where(usable(F.col("e")) & F.col("vec_id").isNotNull())
            .select("vec_id", "q", F.transform("e", lambda x: x.cast("double") + F.lit(0.0)).alias("vec")))
    most = k + 1

    def with_keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = np.empty((len(batch), curves), np.int64)
            dims = batch["dim"].to_numpy()
            for d in np.unique(dims):
                own = dims == d
                keys[own] = curve_keys(np.stack(batch["vec"].to_numpy()[own]), curves, seed)
            # rows that share a cell of every curve are dealt on by hash, so windows keep their depth
            tie = pd.util.hash_array(batch["cid"].to_numpy()).astype(np.int64) & ((1 << TIE) - 1)
            yield batch.assign(keys=list(keys << TIE | tie[:, None]))

    hashed = rows.select("vec_id", "q", F.xxhash64("vec").alias("h"), "vec")
    asked = hashed.where("q").select(F.col("h").alias("qh"), F.col("vec").alias("qvec"), F.col("vec_id").alias("query_id"))
    members = asked.groupBy("qh", "qvec").agg(F.lit(True).alias("asked"))
    made = classes(rows, most)
    made = made.join(members, (made["h"] == members["qh"]) & (made["vec"] == members["qvec"]), "left")
    made = cut(made.select("cid", "dim", "vec", "ids", F.col("asked").isNotNull().alias("asked"))
               .mapInPandas(with_keys, "cid long, dim int, vec array<double>, ids array<long>, asked boolean, keys array<long>"))

    # Depth of each curve: window borders are quantiles of its keys, one small row for each (dim, curve).
    per_curve = made.select("dim", F.posexplode("keys").alias("curve", "key"))
    at = [i / windows for i in range(1, windows)]
    borders = {(r.dim, r.curve): r.b for r in per_curve.groupBy("dim", "curve")
               .agg(F.percentile_approx("key", at, 10_000).alias("b")).collect()}
    counts = {r.dim: (r.n, r.asked) for r in made.groupBy("dim").agg(
        F.count("*").alias("n"), F.count_if("asked").alias("asked")).collect()}
    if not counts:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def placed(dim: Column, curve: Column, key: Column) -> Column:
        out = F.lit(0)
        for (d, c), b in borders.items():
            n = max(1, min(windows, counts[d][0] // DEPTH))  # a small table has fewer, deeper windows
            b = [b[i * windows // n - 1] for i in range(1, n)]
            w = sum((F.when(key >= int(v), 1).otherwise(0) for v in b), F.lit(0))
            out = F.when((dim == d) & (curve == c), w).otherwise(out)
        return out.cast("int")

    def parts(rows_of) -> Column:
        """Into how many tiles a window of each vector length is dealt."""
        out = F.lit(1)
        for d, n in counts.items():
            out = F.when(F.col("dim") == d, max(1, -(-int(rows_of(*n)) // tile))).otherwise(out)
        return out

    c_parts = parts(lambda n, asked: n / windows)
    q_parts = parts(lambda n, asked: asked * (2 * reach + 1) / windows)
    keyed = (made.select("*", F.posexplode("keys").alias("curve", "key"))
             .withColumn("window", placed(F.col("dim"), F.col("curve"), F.col("key"))))

    def dealt(df: DataFrame, own: Column, other: Column, names: tuple[str, str]) -> DataFrame:
        """Each row in one part of its own side, and in every part of the other's."""
        return (df.withColumn(names[0], F.pmod(F.xxhash64("cid"), own).cast("int"))
                .withColumn(names[1], F.explode(F.sequence(F.lit(0), other - 1))))

    key = ["dim", "curve", "window", "c_part", "q_part"]
    cands = dealt(keyed, c_parts, q_parts, ("c_part", "q_part")).select(*key, "cid", "vec")
    queries = keyed.where("asked").withColumn("window", F.explode(F.sequence(
        F.greatest(F.col("window") - reach, F.lit(0)), F.least(F.col("window") + reach, F.lit(windows - 1)))))
    queries = dealt(queries, q_parts, c_parts, ("q_part", "c_part")).select(*key, "cid", "vec")

    def near(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(c):
            cand, ids = np.stack(c["vec"].to_numpy()), c["cid"].to_numpy()
            norm = (cand ** 2).sum(1)
            for start in range(0, len(q), 256):
                part = q.iloc[start:start + 256]
                own = np.stack(part["vec"].to_numpy())
                d2 = norm - 2 * own @ cand.T  # without the query's own norm: same order
                n = min(most + 4, len(ids))
                top = np.argpartition(d2, n - 1, axis=1)[:, :n]
                exact = np.sqrt(((cand[top] - own[:, None, :]) ** 2).sum(2))
                for row, qid in enumerate(part["cid"].to_numpy()):
                    best = np.lexsort((ids[top[row]], exact[row]))[:most]
                    out += [(qid, ids[top[row, j]], exact[row, j]) for j in best]
        return pd.DataFrame(out, columns=["qc", "cid", "d"])

    found = queries.groupBy(*key).cogroup(cands.groupBy(*key)).applyInPandas(near, "qc long, cid long, d double")
    best = Window.partitionBy("qc").orderBy("d", "cid")
    merged = (found.groupBy("qc", "cid").agg(F.min("d").alias("d"))
              .withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= most))
    ids = made.select(F.col("cid").alias("fc"), "ids")
    lists = (merged.join(ids, merged["cid"] == ids["fc"])
             .select("qc", F.explode("ids").alias("vec_id"), "d").groupBy("qc")
             .agg(F.sort_array(F.collect_list(F.struct("d", "vec_id"))).alias("near")))  # at most (k + 1)^2 ids
    heads = (made.where("asked").select(F.col("cid").alias("qcid"), F.xxhash64("vec").alias("hh"), F.col("vec").alias("hvec")))
    lists = lists.join(heads, lists["qc"] == heads["qcid"]).select("hh", "hvec", F.slice("near", 1, 2 * most).alias("near"))
    mine = asked.join(lists, (asked["qh"] == lists["hh"]) & (asked["qvec"] == lists["hvec"]))
    return (mine.select("query_id", F.posexplode(F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.vec_id").alias("vec_id"),
                    F.col("col.d").alias("score")))
