"""Time the headline queries: one warm-up, then the median of three runs.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from agrolume.checks import QUERIES
from agrolume.session import local_session

HEADLINE = (
    "viabilidade_all", "raio_x_all", "dossie_all", "janela_all", "auditoria_all",
    "list_pam", "list_agrofit", "risk_mode", "top_pests",
    "fold_text", "clean_html", "to_number", "dedupe_last", "pivot_variables", "unpivot_dec", "resolve_cultura",
    "job_pam", "job_zarc", "job_precos_mensal", "job_sementes_producao", "upsert_merge",
    "resolve_cultura_by_words", "auditoria_stored", "list_pam_stored", "list_zarc_stored", "read_any_gzip",
)
RUNS = 3


def run_once(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        run_once(spark, name, folder)
        times[name] = round(statistics.median(run_once(spark, name, folder) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
