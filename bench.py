"""Time the headline queries once each and print one JSON line.

``BENCH_SF_DIR`` names the tables (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` an optional comma-separated choice. Results are written to the no-op sink, so all columns are computed.
"""

from __future__ import annotations

import json
import os
import time

from catalog.queries import QUERIES
from siftwork import build_session

HEADLINE = (
    "quality_rules", "pii_mask_all", "filter_report_by_source", "curate_documents", "exact_line_dedup",
    "exact_doc_dedup", "minhash_signature", "fuzzy_dedup", "html_extract", "lang_id", "english_filter",
    "quality_score", "quality_eval", "tokenize_docs", "pack_sequences",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = build_session(
        f"local[{cpus}]", "siftwork-bench",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    if "curate_documents" in seconds:
        result["curated_documents_per_second"] = round(documents / seconds["curate_documents"], 1)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
