"""Headline queries at BENCH_SF_DIR on local[BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from paperloom.plans import catalog
from paperloom.session import build_session

QUERIES = [
    "facet_counts", "papers_list", "compliance_gate", "report_summary", "faculty_profile", "report_jobs", "report_rows", "suggest_title", "suggest_author",
    "papers_visible", "issues_visible", "directory_enrich", "pii_redact", "intake_dispositions", "intake_contract", "doi_year_title",
    "extraction_cascade", "low_confidence_gate", "routing", "store_flatten", "paper_versions", "current_state", "patch_update", "audit_events", "rate_limit",
    "ttl_dedup", "keyword_web", "keyword_weighted", "keyword_stemmed", "headline", "semantic_topk", "hybrid_search", "search_requests", "rrf_fuse",
    "route_batch", "store_batch",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "paperloom-bench", f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load()
    catalog.QUERIES["papers_count"](spark, sf_dir).collect()  # start the JVM's code paths and the page cache
    seconds = {}
    for name in QUERIES:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
