"""Compare a registered query with its check SQL: columns, rows and values."""

from __future__ import annotations

import math

import duckdb

from acctrisk.plans.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def rows_of(table) -> list[tuple]:
    """Rows of an Arrow table, columns by name, in a fixed order."""
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns, strict=True))


def kinds_of(table) -> dict[str, str]:
    """Column types, with differences of representation evened out."""
    same = {"large_string": "string", "large_binary": "binary"}
    return {f.name: same.get(str(f.type), str(f.type)) for f in table.schema}


def differences(spark_table, check_table) -> str:
    """Empty when both tables hold the same columns and rows."""
    if sorted(spark_table.column_names) != sorted(check_table.column_names):
        return f"columns {sorted(spark_table.column_names)} / {sorted(check_table.column_names)}"
    mine, check = kinds_of(spark_table), kinds_of(check_table)
    kinds = {n: (mine[n], check[n]) for n in mine if mine[n] != check[n]}
    if kinds:
        return f"types {kinds}"
    a, b = rows_of(spark_table), rows_of(check_table)
    if len(a) != len(b):
        return f"row counts {len(a)} / {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        x, y = wrong[0]
        names = sorted(spark_table.column_names)
        cells = [(n, p[:200], q[:200]) for n, p, q in zip(names, x, y) if p != q]
        return f"{len(wrong)} of {len(a)} rows differ, e.g. {cells}"
    return ""
