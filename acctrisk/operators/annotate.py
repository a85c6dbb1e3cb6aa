"""Annotations as relations: model output is validated, defaulted and joined like any table."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctrisk import fixed
from acctrisk.functions.columns import is_true, missing_text
from acctrisk.operators.scoring import AT_RISK

ANALYSIS_SCHEMA = T.StructType([
    T.StructField("sentiment", T.StringType()),
    T.StructField("risk_score", T.DoubleType()),
    T.StructField("competitor_mentions", T.ArrayType(T.StringType())),
    T.StructField("champion_status", T.StringType()),
    T.StructField("key_concerns", T.ArrayType(T.StringType())),
    T.StructField("recommended_actions", T.ArrayType(T.StringType())),
    T.StructField("summary", T.StringType()),
])

# type names a VARIANT field may have to pass as a field of the schema
_TEXT_LIST = r"^ARRAY<(STRING|VOID)>$"
_NUMBER = r"^(BIGINT|DOUBLE|DECIMAL.*|FLOAT|BOOLEAN)$"


def _field_checks() -> tuple[list[Column], list[Column]]:
    """Per field: is a given value unusable, and the value with its default filled in."""
    bad, values = [], []
    for spec in ANALYSIS_SCHEMA:
        path = f"$.{spec.name}"
        raw = F.try_variant_get("v", path, "variant")
        kind = F.schema_of_variant(raw)
        value = F.try_variant_get("v", path, spec.dataType.simpleString())
        default = fixed.ANALYSIS_DEFAULTS[spec.name]
        if isinstance(spec.dataType, T.DoubleType):
            # numeric text counts as a number, anything outside 0..1 does not pass
            usable = (kind.rlike(_NUMBER) | (kind == "STRING")) & value.between(0.0, 1.0)
            fallback = F.lit(default)
        elif isinstance(spec.dataType, T.ArrayType):
            usable = kind.rlike(_TEXT_LIST) & ~F.exists(value, lambda x: x.isNull())
            fallback = F.array().cast(spec.dataType)
        else:
            usable = kind == "STRING"
            fallback = F.lit(default)
        bad.append(raw.isNotNull() & ~is_true(usable))
        values.append(F.coalesce(value, fallback).alias(spec.name))
    return bad, values


def parse_analyses(responses: DataFrame, text_column: str = "response_json") -> DataFrame:
    """Validated note analyses from raw JSON text.

    A missing field takes its default. One unusable field, an explicit null included, turns the
    whole record into defaults; so does text that is not a JSON object.
    """
    keys = [c for c in responses.columns if c != text_column]
    bad, values = _field_checks()
    parsed = responses.withColumn("v", F.try_parse_json(text_column))
    rejected = bad[0]
    for check in bad[1:]:
        rejected = rejected | check
    parsed = parsed.withColumn("v", F.when(~rejected, F.col("v")))
    return parsed.select(*keys, *values)


def account_analyses(responses: DataFrame) -> DataFrame:
    """One validated analysis per account: the last response in ``seq`` order."""
    last = responses.groupBy("account_id").agg(
        F.max(F.struct("seq", "response_json"))["response_json"].alias("response_json"))
    return parse_analyses(last)


def note_entities(notes: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """Note names, ids, dates and writers: external values win, extracted ones fill the blanks.

    ``notes``: note_idx, account_id, account_name (both from the text). ``external``: note_idx,
    account_id, account_name, date_str, csm_name. Notes of several files are told apart by the
    column ``file``, which both then have. If the external relation does not hold exactly
    one row per note it cannot be aligned and is ignored as a whole.
    """
    blank = F.lit("")
    if external is None:
        return notes.withColumns({"date_str": blank, "csm_name": blank})
    keys = [c for c in ("file", "note_idx") if c in notes.columns and c in external.columns]
    if "file" in notes.columns and "file" not in keys:
        raise ValueError("notes come from files, external entities lack the column file")
    per_note = external.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct("account_id", "account_name", "date_str", "csm_name")).alias("x"),
    )
    paired = notes.select(*keys, F.lit(True).alias("known")).join(per_note, keys, "full")
    unaligned = paired.filter(F.coalesce("n", F.lit(0)) != 1).union(
        paired.filter(F.col("known").isNull()))
    aligned = unaligned.agg((F.count(F.lit(1)) == 0).alias("ok"))
    x = F.when(F.col("ok"), F.col("x"))
    return (
        notes.join(per_note.select(*keys, "x"), keys, "left")
        .withColumn("ok", aligned.scalar())
        .withColumn("x", x)
        .select(
            *[c for c in notes.columns if c not in ("account_id", "account_name")],
            F.coalesce(F.col("x.account_id"), F.col("account_id")).alias("account_id"),
            F.coalesce(missing_text(F.col("x.account_name")), F.col("account_name"), blank)
            .alias("account_name"),
            F.coalesce("x.date_str", blank).alias("date_str"),
            F.coalesce("x.csm_name", blank).alias("csm_name"),
        )
    )


# Batches of a task that the function works on at the same time.
IN_FLIGHT = 5


def batch_annotate(
    rows: DataFrame,
    annotate: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
    partitions: int | None = None,
    in_flight: int = IN_FLIGHT,
    error_column: str | None = None,
) -> DataFrame:
    """Apply a user function to bounded Arrow batches of rows, in every task at once.

    The function gets and returns one pandas frame per batch (spark.sql.execution.arrow.
    maxRecordsPerBatch rows at most). It mostly waits for a service, so a task keeps up to
    ``in_flight`` batches going, in threads; results come in the order of the batches, and no more
    than those are held. The function has to be safe to call from several threads.

    A batch that fails stops the query, unless ``error_column`` names a text column of the schema:
    then its rows come back with the columns that they share with the schema, the error in that
    column and null in the others. Rows of other batches have null there.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = kind.names
    if error_column is not None and error_column not in names:
        raise ValueError(f"the schema lacks {error_column}")

    def outcome(batch: pd.DataFrame, call: Future) -> pd.DataFrame:
        try:
            found = call.result()
            if error_column is not None and error_column not in found:
                found = found.assign(**{error_column: None})
        except Exception as error:
            if error_column is None:
                raise
            none = pd.Series([None] * len(batch), dtype=object)
            told = pd.Series([f"{type(error).__name__}: {error}"] * len(batch), dtype=object)
            found = pd.DataFrame({
                c: told if c == error_column else
                batch[c].reset_index(drop=True) if c in batch else none for c in names})
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as pool:
            going: deque[tuple[pd.DataFrame, Future]] = deque()
            try:
                for batch in batches:
                    going.append((batch, pool.submit(annotate, batch)))
                    if len(going) == in_flight:
                        yield outcome(*going.popleft())
                while going:
                    yield outcome(*going.popleft())
            finally:
                for _, call in going:
                    call.cancel()

    spread = rows if partitions is None else rows.repartition(partitions)
    return spread.mapInPandas(run, kind)


def briefing_payload(risk: DataFrame) -> DataFrame:
    """Each High or Medium account as one JSON object, missing values as null."""
    record = F.struct(*[F.col(c) for c in risk.columns])
    return risk.filter(F.col("risk_tier").isin(AT_RISK)).select(
        "account_id",
        F.to_json(record, {"ignoreNullFields": "false"}).alias("payload"),
    )


def with_explanations(risk: DataFrame, explanations: DataFrame | None = None) -> DataFrame:
    """Add the explanation of at-risk accounts; the others get the fixed low-risk text.

    ``explanations``: account_id, risk_explanation, one row per account.
    """
    low = F.lit(fixed.LOW_RISK_EXPLANATION)
    if explanations is None:
        return risk.withColumn("risk_explanation", low)
    supplied = explanations.select("account_id", F.col("risk_explanation").alias("x"))
    return (
        risk.join(supplied, "account_id", "left")
        .withColumn("risk_explanation", F.when(
            F.col("risk_tier").isin(AT_RISK), F.coalesce("x", low)).otherwise(low))
        .drop("x")
    )
