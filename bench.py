"""Time the batch job, the warehouse queries, the stream and the model; print one JSON line.

The folder is ``$BENCH_SF_DIR`` and the thread count ``$BENCH_CPUS``. Queries run twice and the
better time counts, so that code generation is not measured over again; jobs that write run once.
Deriving postings from the order tables is test-data preparation and reported apart, as setup.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hirelens import catalogue, schemas  # noqa: E402
from hirelens.plans import gold, medallion, salary_model, warehouse  # noqa: E402
from hirelens.session import fresh_folder, local_session  # noqa: E402
from hirelens.sources import driver_tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def clock(run, repeat: int = 1) -> float:
    times = []
    for _ in range(repeat):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("bench", CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    consume(spark.range(1000).groupBy("id").count())
    times: dict[str, float] = {}

    landed = fresh_folder(spark, "bench-raw")
    setup = clock(lambda: driver_tables.postings(spark, SF_DIR).write.parquet(landed))
    raw = spark.read.schema(schemas.EVENT).parquet(landed)
    rows = raw.count()
    lakehouse = medallion.Lakehouse(spark, fresh_folder(spark, "bench-lake"), raw=lambda: raw)
    times["bronze_to_silver"] = clock(lambda: medallion.run(lakehouse, "bronze-to-silver"))
    times["silver_to_gold"] = clock(lambda: medallion.run(lakehouse, "silver-to-gold"))

    for name, query in warehouse.QUERIES.items():
        times[name] = clock(lambda query=query: consume(query(lakehouse.table)), 2)
    silver_rows = lakehouse.table("silver")
    aggregates = {
        "gold_top_skills": gold.top_skills,
        "gold_salary_by_role_city": gold.salary_by_role_city,
        "gold_remote_trends": gold.remote_trends,
        "gold_company_hiring": gold.company_hiring,
    }
    for name, build in aggregates.items():
        times[name] = clock(lambda build=build: consume(build(silver_rows)), 2)

    context = catalogue.context(spark, SF_DIR)
    context.landed_messages()
    times["stream_bronze_job"] = clock(lambda: context.bronze())
    train, _ = salary_model.split(salary_model.prepare(silver_rows))
    times["ml_fit_rf"] = clock(lambda: salary_model.fit(train))

    print(
        json.dumps(
            {
                "metric": "total time of batch job, queries, stream and model",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "postings": rows,
                "setup_sec": setup,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
