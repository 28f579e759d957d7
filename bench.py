"""Time the headline queries; prints one JSON line.

Each query is run twice and the second run is timed. The stored tables (staging, enriched,
documents, ...) are written during the first run, as the jobs that build them would be; those jobs
are timed by themselves, in one run each.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from ratesheet.operators import documents, enrichment, retrieval  # noqa: E402
from ratesheet.operators.staging import stage_transform  # noqa: E402
from ratesheet.plans import catalog, views  # noqa: E402
from ratesheet.session import build_session, shared_dir  # noqa: E402
from ratesheet.sources import sinks  # noqa: E402

HEADLINE = [
    "stage_transform", "enrich", "enrich_legacy", "parse_description", "explain_codes_join",
    "top_drugs", "form_distribution", "price_trend", "strength_vs_price", "avg_price_by_drug",
    "data_summary", "load_typed", "drug_document", "page_envelopes", "extract_records",
    "sensor_process", "sensor_daily", "validate_records", "error_rate", "topk_search",
    "batch_topk", "clustered_topk", "prompt_context", "conversation_context",
]


def writers(spark, sf_dir: str) -> dict:
    """The jobs that fill tables; each run writes a new one."""
    fresh = lambda name: shared_dir(spark, "bench", name)
    enriched = lambda: enrichment.enrich(views.staging(spark, sf_dir), views.run_ts())
    described = lambda: documents.doc_metadata(views.typed_prices(spark, sf_dir))
    return {
        "write_staging": lambda: sinks.write_staging(
            stage_transform(views.nadac_raw(spark, sf_dir)), fresh("staging"), "one"
        ),
        "write_enriched": lambda: sinks.write_enriched(
            enriched(), fresh("enriched"), "one", by="effective_quarter"
        ),
        "build_store": lambda: retrieval.build_store(described(), fresh("store")),
        "build_index": lambda: retrieval.build_index(
            views.vectors(spark, sf_dir), fresh("index"), n_lists=20
        ),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    rates: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    for name, write in writers(spark, sf_dir).items() if names == HEADLINE else []:
        start = time.perf_counter()
        write()
        seconds[name] = round(time.perf_counter() - start, 3)
    if "enrich" in seconds:
        rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        rates["enrich_rows_per_sec"] = round(rows / seconds["enrich"])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                **rates,
            }
        )
    )


if __name__ == "__main__":
    main()
