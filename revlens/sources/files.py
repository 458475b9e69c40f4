"""File sources and sinks (SRC-1/2, SRC-3/4/5, SRC-8, SRC-10, TOP-7).

Explicit schemas (no inference pass), ``PERMISSIVE`` parsing with a
corrupt-record column for JSON, and provenance from the hidden
``_metadata`` column for multi-file batch reads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import rules as R
from ..functions.text import natural_id_key, normalize_id

REVIEW_SCHEMA = "id string, text string, rating double, _corrupt_record string"


def read_reviews_jsonl(spark: SparkSession, path: str, required=("text", "rating")) -> DataFrame:
    """SRC-1: JSON-lines reviews, read with one explicit schema.  A required
    column that no row of the files has raises; a column is there if any row
    has it, which one aggregate over all rows tells.

    SRC-2: rows without an id get one from their file, their place in it and
    their content, so equal reviews stay apart and a second read agrees."""
    raw = spark.read.schema(REVIEW_SCHEMA).option("mode", "PERMISSIVE").json(path)
    wanted = [c for c in ("id", "text", "rating") if c in required or c == "id"]
    seen = raw.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in wanted]).first()
    missing = [c for c in required if not seen[c]]
    if missing:
        raise ValueError(f"Expected columns {sorted(required)}, none of the rows has {missing}")
    return raw.withColumn("id", F.coalesce(F.col("id"), row_id(F.col("text"), F.col("rating").cast("string"))))


def row_id(*content) -> Column:
    """Id of a file row: file, split, row within the split, and the content."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start").cast("string"),
             F.monotonically_increasing_id().cast("string")]
    return F.md5(F.concat_ws("|", *place, *[F.coalesce(c, F.lit("")) for c in content]))


def read_labels_csv(spark: SparkSession, path: str, labels=K.ISSUE_LABELS) -> DataFrame:
    """SRC-3: labelled CSV read as all-string columns (coerced later)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_batches(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """SRC-4: every batch file of a folder with provenance: source file
    name, modification time and the row's position inside its file.

    Columns go by name: files of one header are read together, and the
    reads are united by name, so a column that a file lacks is null there.
    Files without an ``id`` column contribute no rows.  The driver sees one
    row for each distinct header, never the files' rows."""
    lines = (spark.read.option("pathGlobFilter", pattern).text(folder)
             .where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("at"), "value"))
    heads = (lines.groupBy("path").agg(F.min_by("value", "at").alias("head"))
             .groupBy("head").agg(F.collect_list("path").alias("paths")).collect())
    frames = []
    for row in sorted(heads, key=lambda r: min(r["paths"])):
        df = (spark.read.option("header", True).csv(row["paths"])
              .select("*", F.col("_metadata.file_name").alias("source_file"),
                      F.col("_metadata.file_modification_time").alias("source_mtime"),
                      # position in read order: split start, then row within the split
                      F.struct(F.col("_metadata.file_block_start").alias("block"),
                               F.monotonically_increasing_id().alias("row")).alias("row_order")))
        if "id" in df.columns:
            frames.append(df.where(F.col("id").isNotNull()))
    if not frames:
        schema = ("id string, source_file string, source_mtime timestamp, "
                  "row_order struct<block: bigint, row: bigint>")
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_readable(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of ``paths`` that is there and has a ``text`` column."""
    for path in paths:
        try:
            raw = spark.read.option("header", True).csv(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        if "text" in [c.strip().lower() for c in raw.columns]:
            return raw
    raise ValueError(f"none of {paths} is a CSV table with a text column")


def read_review_pool(spark: SparkSession, path: str | list[str], labels=K.ISSUE_LABELS) -> DataFrame:
    """SRC-5/6/7: the whole review pool of the first readable source:
    case-insensitive headers, blank texts dropped, rating
    clamp(round(x), 1, 5) with 3 for junk, flags to 0/1, ids for rows
    without one.  ``pool_page`` cuts a page."""
    raw = first_readable(spark, [path] if isinstance(path, str) else path)
    raw = raw.select(*[F.col(f"`{c}`").alias(c.strip().lower()) for c in raw.columns],
                     row_id(F.lit("")).alias("_made_id"))
    df = raw
    text = F.trim(F.coalesce(F.col("text"), F.lit("")))
    rid = F.coalesce(F.nullif(F.trim(F.col("id")), F.lit("")), F.col("_made_id")) if "id" in df.columns else F.col("_made_id")
    flags = {lb: (R.normalized_flag(F.col(lb)) if lb in df.columns else F.lit(0)) for lb in labels}
    return df.where(text != "").select(
        rid.alias("id"), R.normalized_rating(F.col("rating") if "rating" in df.columns else F.lit(None)).alias("rating"),
        text.alias("text"), F.create_map(*[x for lb in labels for x in (F.lit(lb), flags[lb])]).alias("issue_flags"))


def pool_page(pool: DataFrame, limit: int = 3000, most: int = 3000) -> DataFrame:
    """TOP-7: one page of the pool in natural order of the ids; the page
    size is clamped to 1..``most``."""
    keys = natural_id_key(normalize_id(F.col("id")))
    return pool.orderBy(*keys).limit(max(1, min(most, int(limit))))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """SRC-8: result sink (parquet/csv/json), optionally partitioned."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def export_predictions(df: DataFrame, only_flagged: bool = False, limit: int | None = None) -> DataFrame:
    """SRC-10: prediction export with renamed columns, optional non-POSITIVE
    filter and an explicit row cap chosen by the caller."""
    out = df.select(F.col("review_id").alias("id"), "text", F.col("label").alias("classic_label"),
                    F.col("probability").alias("classic_probability"), F.col("confidence").alias("classic_confidence"),
                    F.col("reason").alias("fallback_reason"), "issue_summary", "issue_count", "risk_score")
    if only_flagged:
        out = out.where(F.col("classic_label") != "POSITIVE")
    return out.limit(limit) if limit else out
