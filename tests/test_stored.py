"""The stored layout of scored accounts: the same rows, read in part."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from acctrisk.operators import report
from acctrisk.sources import stored
from tests.test_insights import risk_frame


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def many(spark, rows=20_000):
    """Nine of ten accounts in one tier, some without a tier."""
    tier = (F.when(F.col("id") % 10 > 0, "Low").when(F.col("id") % 20 == 0, "High")
            .when(F.col("id") % 30 == 10, F.lit(None).cast("string")).otherwise("Medium"))
    return spark.range(rows).select(
        F.col("id").alias("account_id"), tier.alias("risk_tier"), (F.col("id") * 7).alias("arr"),
        F.concat(F.lit("name "), F.col("id")).alias("account_name"))


def test_same_rows_types_and_order(frame, tmp_path):
    risk = risk_frame(frame)
    back = stored.store_risk(risk, str(tmp_path / "risk"))
    assert back.schema.names == risk.schema.names
    assert [f.dataType for f in back.schema] == [f.dataType for f in risk.schema]
    assert sorted(back.collect(), key=lambda r: r.account_id) == risk.collect()


def test_reports_agree(frame, tmp_path):
    risk = risk_frame(frame)
    back = stored.store_risk(risk, str(tmp_path / "risk"))
    for of in (report.tier_counts, report.arr_by_tier, report.heatmap, report.top_accounts,
               report.signal_breakdown, lambda x: report.counts_by_tier(x, "plan_tier")):
        assert sorted(map(str, of(back).collect())) == sorted(map(str, of(risk).collect()))


def test_tiers_prune_folders_and_reports_read_their_columns(spark, tmp_path):
    back = stored.store_risk(many(spark), str(tmp_path / "risk"))
    some = report.filter_accounts(back, ["High", "Medium"], min_arr=10).select("account_id")
    plan = plan_of(some)
    assert "PartitionFilters: [risk_tier" in plan and "account_name" not in plan
    files = {f.rsplit("risk_tier=", 1)[1].split("/")[0] for f in some.select(
        F.input_file_name().alias("f")).distinct().toPandas()["f"]}
    assert files == {"High", "Medium"}
    assert "ReadSchema: struct<>" in plan_of(report.tier_counts(back))
    assert "ReadSchema: struct<arr:bigint>" in plan_of(report.arr_by_tier(back))


def test_files_hold_ranges_of_accounts(spark, tmp_path):
    stored.write_risk(many(spark), str(tmp_path / "risk"))
    ranges = {}
    for path in glob.glob(str(tmp_path / "risk" / "risk_tier=Low" / "*.parquet")):
        ids = pq.read_table(path, columns=["account_id"], partitioning=None)["account_id"]
        ids = ids.to_pylist()
        assert ids == sorted(ids)
        ranges[ids[0]] = ids[-1]
    starts = sorted(ranges)
    assert all(ranges[a] < b for a, b in zip(starts, starts[1:]))


def test_null_tier_repeated_rows_and_no_rows(spark, tmp_path):
    rows = many(spark, 100).union(many(spark, 100))
    back = stored.store_risk(rows, str(tmp_path / "a"))
    assert back.count() == 200 and back.where("risk_tier is null").count() == 4  # 10 and 70, twice
    assert back.exceptAll(rows).count() == 0
    none = stored.store_risk(rows.limit(0), str(tmp_path / "b"))
    assert none.columns == rows.columns and none.count() == 0
