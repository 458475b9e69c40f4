"""Headline-query benchmark.

Runs a representative query of each operator family on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line.  Each query is fully executed into a no-op sink
(no collect); a warm-up query runs first so JVM start-up is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from revlens.session import get_session  # noqa: E402
from revlens.plans.registry import QUERIES, load_all  # noqa: E402

HEADLINE = [
    "label_distribution",     # reviews view + keyword rules + stage-1 + distribution
    "triage_cascade",         # full triage cascade, issue resolution, risk
    "attention_queue",        # top-k over the cascade
    "mismatch_by_segment",    # pre-aggregate + star-schema join
    "lexicon_scores",         # four lexicon folds per review
    "negation_tags",          # closed-form negation tagging
    "binary_metrics",         # conditional-count metrics
    "label_thresholds",       # histogram threshold tuning
    "bootstrap_ci",           # Poisson bootstrap, 200 replicates
    "batch_merge_dedup",      # max_by newest-non-null dedup
    "tfidf_doc_stats",        # relational TF-IDF on whole documents
    "ngram_perplexity",       # bigram LM train/test
    "event_window_counts",    # streaming twin: windowed counts
]


def spread_copy(spark, sf_dir: str, parts: int) -> str:
    """A copy of the tables in ``parts`` files each, as a cluster's input has
    them; the given files have one row group and would be one task."""
    import glob
    import tempfile
    out = tempfile.mkdtemp(prefix="bench-tables-")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        spark.read.parquet(path).repartition(parts).write.parquet(f"{out}/{os.path.basename(path)}")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1].split(",") if len(sys.argv) > 1 else HEADLINE
    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    load_all()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    sf_dir = spread_copy(spark, sf_dir, int(cpus))
    QUERIES["data_overview"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]} s", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
