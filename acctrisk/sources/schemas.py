"""Schemas of the input files."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


ACCOUNTS = _schema(
    ("account_id", T.LongType()), ("account_name", T.StringType()), ("arr", T.LongType()),
    ("contract_end_date", T.DateType()), ("plan_tier", T.StringType()),
    ("industry", T.StringType()), ("csm_name", T.StringType()), ("region", T.StringType()),
)
USAGE = _schema(
    ("account_id", T.LongType()), ("month", T.StringType()), ("api_calls", T.LongType()),
    ("content_entries_created", T.LongType()), ("active_users", T.LongType()),
    ("workflows_triggered", T.LongType()), ("sdk_version", T.StringType()),
)
# resolution_time_hours may hold anything and is read as text first
TICKETS = _schema(
    ("ticket_id", T.StringType()), ("account_id", T.LongType()), ("created_date", T.DateType()),
    ("priority", T.StringType()), ("status", T.StringType()),
    ("resolution_time_hours", T.StringType()),
)
NPS = _schema(
    ("account_id", T.LongType()), ("score", T.LongType()), ("verbatim_comment", T.StringType()),
)
