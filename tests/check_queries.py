"""Run registered queries against their check SQL: check_queries.py [sf_dir] [name ...]."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from tests.checking import connect, differences  # noqa: E402


def main(sf_dir: str, names: list[str]) -> None:
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            mine = fn(spark, sf_dir).toArrow()
            took = time.time() - start
            start = time.time()
            if name in sql:
                problem = differences(mine, con.sql(sql[name]).to_arrow_table())
            else:
                problem = "" if mine.num_rows else "no rows"
            state = problem or ("ok" if name in sql else "rows only")
            print(f"{name:28s} {took:6.2f}s {time.time() - start:6.2f}s "
                  f"{mine.num_rows:7d} {state}", flush=True)
        except Exception as error:  # show every query's problem
            problem = str(error)[:1500]
            print(f"{name:28s} ERROR {problem}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
