"""Back-test of weight settings against labels derived from the strongest signals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctrisk import fixed
from acctrisk.functions.columns import is_true, rnd, sql_text
from acctrisk.functions.lineage import materialise
from acctrisk.operators.scoring import SCORE_COLUMNS, fill_defaults


def _column(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def ground_truth(risk: DataFrame) -> DataFrame:
    """Add the labels expected_high and expected_low; an account may get both or neither."""
    mood = _column(risk, "csm_sentiment", "string")
    rivals = F.length(F.coalesce(_column(risk, "competitor_mentions", "string"), F.lit(""))) > 0
    champion = _column(risk, "champion_status", "string")
    nps = F.coalesce(_column(risk, "nps_score", "bigint"), F.lit(5))
    old_sdk = is_true(_column(risk, "sdk_version", "string").startswith("v3"))
    tickets = F.coalesce(_column(risk, "total_tickets", "bigint"), F.lit(0))
    return risk.withColumns({
        "expected_high": (
            is_true(mood == "negative") | rivals | is_true(champion == "lost")
            | (nps <= 3) | (old_sdk & (tickets > 5))),
        "expected_low": (
            (mood.isNull() | (mood == "positive")) & ~rivals
            & (champion.isNull() | (champion == "active")) & (nps >= 9)),
    })


# From the best account down, as in the scored frame: ties go to the higher composite score.
_ORDER = (F.desc, "score"), (F.desc, "composite"), (F.asc, "account_id")


def _order() -> list[Column]:
    return [direction(name) for direction, name in _ORDER]


def _scored(risk: DataFrame, configs: Mapping[str, Sequence[float]]) -> DataFrame:
    """One row per account and configuration: config, account_id, label (1 high, 2 low), score.

    The rows are range-sorted and written with ``slice``, the number of the range they lie in, as
    the back-test passes over them several times. The labelled accounts, ten narrow columns, are
    written first, so that the scoring below them runs once.
    """
    options = ", ".join(
        f"named_struct('config', {sql_text(name)}, " + ", ".join(
            f"'{c}', {float(w)}D" for c, w in zip(SCORE_COLUMNS, weights, strict=True)) + ")"
        for name, weights in configs.items())
    labelled = materialise(ground_truth(fill_defaults(risk)).select(
        "account_id",
        F.expr("int(expected_high) + 2 * int(expected_low)").alias("label"),
        F.coalesce(_column(risk, "composite_risk_score", "double"), F.lit(0.0)).alias("composite"),
        *SCORE_COLUMNS,
    ))
    score = " + ".join(f"{c} * w.{c}" for c in SCORE_COLUMNS)
    scored = labelled.withColumn("w", F.expr(f"explode(array({options}))")).select(
        "w.config", "account_id", "label", "composite", F.expr(score).alias("score"))
    return materialise(scored.sort("config", *_order()).withColumn(
        "slice", F.spark_partition_id()))


def _n_high() -> Column:
    return F.count_if(F.col("label") % 2 == 1)


def _high_in_top_k(scored: DataFrame) -> DataFrame:
    """Per configuration: K and how many of the K best accounts are expected high.

    K is the number of expected-high accounts. Rows are counted per slice of the sorted table; a
    running count over the slices finds the one that holds the cut, and only its rows are ranked.
    """
    in_order = Window.partitionBy("config").orderBy("slice")
    slices = scored.groupBy("config", "slice").agg(
        F.count(F.lit(1)).alias("n"), _n_high().alias("n_high"))
    running = slices.withColumns({
        "upto": F.sum("n").over(in_order), "high_upto": F.sum("n_high").over(in_order),
        "k": F.greatest(F.lit(1), F.sum("n_high").over(Window.partitionBy("config")))})
    before = F.col("upto") - F.col("n")
    # one row per configuration
    cut = running.filter((F.col("upto") >= F.col("k")) & (before < F.col("k"))).select(
        "config", "slice", "k", (F.col("high_upto") - F.col("n_high")).alias("high_above"),
        (F.col("k") - before).alias("rest"))
    place = F.row_number().over(Window.partitionBy("config").orderBy(*_order()))
    partial = (
        scored.join(F.broadcast(cut), ["config", "slice"]).withColumn("place", place)
        .filter(F.col("place") <= F.col("rest"))
        .groupBy("config").agg(_n_high().alias("high_partial"))
    )
    return cut.join(partial, "config", "left").select(
        "config", "k",
        (F.col("high_above") + F.coalesce("high_partial", F.lit(0))).alias("high_in_top"))


def weight_metrics(
    risk: DataFrame,
    configs: Mapping[str, Sequence[float]] | None = None,
    flag_from: float = 0.60,
) -> DataFrame:
    """Separation, precision at K and recall of each weight setting, all settings in one pass."""
    scored = _scored(risk, configs or fixed.WEIGHT_CONFIGS)
    per_score = scored.groupBy("config", "score").agg(
        F.count(F.lit(1)).alias("n"),
        _n_high().alias("n_high"),
        F.count_if(F.col("label") >= 2).alias("n_low"),
    )
    # decimal sums do not depend on the order of the rows
    score = F.rint(F.col("score") * F.lit(1e9)).cast("decimal(20,0)")

    def mean(count: str) -> Column:
        total = F.sum(score * F.col(count)).cast("double")
        return F.when(F.sum(count) > 0, total / F.sum(count) / F.lit(1e9))

    flagged = F.sum(F.when(F.col("score") >= flag_from, F.col("n_high")).otherwise(0))
    totals = per_score.groupBy("config").agg(
        mean("n_high").alias("high_mean"),
        mean("n_low").alias("low_mean"),
        F.sum("n_high").alias("n_expected_high"),
        F.sum("n_low").alias("n_expected_low"),
        F.when(F.sum("n_high") > 0, flagged / F.sum("n_high")).alias("recall"),
    )
    zero = F.lit(0.0)
    return totals.join(_high_in_top_k(scored), "config").select(
        "config",
        rnd(F.coalesce(F.col("high_mean") - F.col("low_mean"), zero), 4).alias("separation"),
        rnd(F.col("high_in_top") / F.col("k"), 4).alias("precision_at_k"),
        rnd(F.coalesce("recall", zero), 4).alias("recall"),
        rnd(F.coalesce("high_mean", zero), 4).alias("avg_high_score"),
        rnd(F.coalesce("low_mean", zero), 4).alias("avg_low_score"),
        "n_expected_high",
        "n_expected_low",
    )


def weight_verdict(
    metrics: DataFrame,
    current: str = fixed.CURRENT_CONFIG,
    order: Sequence[str] = tuple(fixed.WEIGHT_CONFIGS),
) -> DataFrame:
    """Best setting, rank of the current one and whether that is good enough.

    Tied settings share their average rank; the first of the best ones wins.
    """
    place = F.array_position(F.array(*[F.lit(name) for name in order]), F.col("config"))
    # one row per setting
    ranked = metrics.select(
        "config", "separation", place.alias("place"),
        (F.rank().over(Window.orderBy(F.desc("separation")))
         + (F.count(F.lit(1)).over(Window.partitionBy("separation")) - 1) / F.lit(2.0)
         ).alias("rank"),
    )
    mine = F.max(F.when(F.col("config") == current, F.col("rank")))
    return ranked.agg(
        F.max(F.struct("separation", -F.col("place"), "config"))["config"].alias("best_config"),
        F.floor(mine).cast("bigint").alias("current_rank"),
        (mine <= 2).alias("is_optimal"),
    )
