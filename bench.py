"""Time the headline queries; prints one JSON line.

``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) names the tables, ``$BENCH_CPUS`` the local cores,
``$BENCH_RUNS`` the timed runs per query (median) after one warm-up. Index publishing and link
ranks are timed as queries of their own; searches then read the published index.
"""

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pagelode.catalog import queries as catalog  # noqa: E402
from pagelode.session import build_session, fresh_path  # noqa: E402
from pagelode.sources import index_store, tables  # noqa: E402


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        app_name="bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def noop(name):
        catalog.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()

    def publish():
        index_store.publish_index(tables.corpus_documents(spark, folder), fresh_path(spark, "bench-index"))

    # Shared tables the searches read, made outside the timings.
    jobs = {
        "build_postings": lambda: noop("build_postings"),
        "publish_index": publish,
        "pagerank_k10": lambda: noop("pagerank_k10"),
        "search_text": lambda: noop("search_text"),
        "search_text_rank": lambda: noop("search_text_rank"),
        "search_batch": lambda: noop("search_batch"),
        "search_fulltext": lambda: noop("search_fulltext"),
        "page_extract": lambda: noop("page_extract"),
    }
    seconds = {}
    for name, job in jobs.items():
        job()
        timed = []
        for _ in range(runs):
            started = time.perf_counter()
            job()
            timed.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timed), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
