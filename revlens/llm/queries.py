"""The ``opN_*`` queries: each operator over its whole table.

``QUERIES`` maps names to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` has
the DuckDB twin of those that SQL can express.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import (ann, decontam, fill_in_middle, filter_audit, lang_id, license_scan, ngram_join, packing, pii, records,
               sharding, token_counts, url_filter)
from .common import fresh_folder, table

PII_KEY = "revlens.pii.key"  # session setting that holds the pseudonym key


def pii_key(spark) -> str:
    return spark.conf.get(PII_KEY, "documented default key")


def op1_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors["vec_id"] % 100 == 0)


def op2_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


def op3_language(spark, sf_dir):
    docs, made = lang_id.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return (docs.select("doc_id", lang_id.held_out(docs["doc_id"]).alias("held_out"), made.alias("m"))
            .select("doc_id", "held_out", "m.lang_pred", "m.score", F.map_keys("m.languages").alias("languages"),
                    F.map_values("m.languages").alias("proportions")))


def op4_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.col("pii_counts")
    return pii.pseudonymise(docs, pii_key(spark)).select(
        "doc_id", "text", *[F.coalesce(n[k], F.lit(0)).alias(f"n_{k}") for k in pii.KINDS])


def op5_license_scan(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark, sf_dir):
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_decontam(spark, sf_dir):
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("hamming")


def op9_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.as_of(url_filter.page_captures(pages), url_filter.page_list(pages))


def op10_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), packing.vocabulary("word_bpe_49k.json"))


def op11_fill_in_middle(spark, sf_dir):
    made = fill_in_middle.restore(fill_in_middle.transform(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
                       F.col("middle_units").alias("middle_chars"),
                       *[F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")])


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_records(spark, sf_dir):
    folder = fresh_folder(spark, "records")
    records.write(table(spark, sf_dir, "documents"), folder)
    return records.read(spark, folder).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_sharding": op2_sharding,
    "op3_language": op3_language,
    "op4_pii": op4_pii,
    "op5_license_scan": op5_license_scan,
    "op6_ngram_join": op6_ngram_join,
    "op7_packing": op7_packing,
    "op8_decontam": op8_decontam,
    "op9_url_filter": op9_url_filter,
    "op10_token_counts": op10_token_counts,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_filter_audit": op12_filter_audit,
    "op13_records": op13_records,
}
ORACLES = {"op8_decontam": decontam.SQL, "op9_url_filter": url_filter.SQL, "op11_fill_in_middle": fill_in_middle.SQL,
           "op12_filter_audit": filter_audit.sql()}
