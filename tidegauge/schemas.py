"""Column layouts of the tables and of their JSON Lines wire form."""

from __future__ import annotations

from pyspark.sql import types as T

CONTEXT = ("run_id", "target_id", "host", "tier", "resource_id", "collector_id")

_TAGS = T.MapType(T.StringType(), T.StringType())
_FIELDS = T.MapType(T.StringType(), T.VariantType())


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


_TEXT, _INT, _REAL, _TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

#: Packed point table.
POINTS = _struct(
    ts=_TIME, contract_version=_INT, run_id=_TEXT, target_id=_TEXT, host=_TEXT, resource_id=_TEXT,
    tier=_TEXT, collector_id=_TEXT, measurement=_TEXT, series_key=_TEXT, tags=_TAGS,
    fields=_FIELDS,
)
#: Narrow series table.
SERIES = _struct(
    ts=_TIME, contract_version=_INT, run_id=_TEXT, target_id=_TEXT, host=_TEXT, tier=_TEXT,
    measurement=_TEXT, field=_TEXT, value=_REAL, kind=_TEXT, unit=_TEXT, series_key=_TEXT,
    tags=_TAGS,
)
#: Legacy metric table.
METRICS = _struct(
    ts=_TIME, run_id=_TEXT, host=_TEXT, tier=_TEXT, source=_TEXT, metric=_TEXT, value=_REAL
)
#: Event table.
EVENTS = _struct(
    ts=_TIME, run_id=_TEXT, target_id=_TEXT, host=_TEXT, tier=_TEXT, source=_TEXT, level=_TEXT,
    error_code=_TEXT, subsystem=_TEXT, message=_TEXT, collector_id=_TEXT,
)

# Wire names that differ from the column names here.
WIRE_NAMES = {"resource_id": "azure_resource_id"}


def wire_schema(table: T.StructType) -> T.StructType:
    """Wire layout of a table: wire names, and the timestamp as text."""
    return T.StructType([
        T.StructField(
            WIRE_NAMES.get(f.name, f.name), T.StringType() if f.name == "ts" else f.dataType
        )
        for f in table.fields
    ])


#: Platform metric table, pre-aggregated per minute.
PLATFORM_METRICS = _struct(
    time_generated=_TIME, metric_name=_TEXT, resource=_TEXT, average=_REAL, maximum=_REAL,
    total=_REAL,
)
#: Diagnostic log table; the suffixes tell text from numbers.
DIAGNOSTICS = _struct(
    time_generated=_TIME, category=_TEXT, resource=_TEXT, db_s=_TEXT, host_s=_TEXT, ip_s=_TEXT,
    user_s=_TEXT, event_class_s=_TEXT, event_subclass_s=_TEXT, is_aad_auth_s=_TEXT,
    sql_text_s=_TEXT, query_time_d=_REAL, lock_time_d=_REAL, rows_sent_d=_REAL,
    rows_examined_d=_REAL, error_code_d=_REAL,
)
#: Control-plane activity table.
ACTIVITY = _struct(
    time_generated=_TIME, resource_provider=_TEXT, operation_name=_TEXT, activity_status=_TEXT,
    activity_substatus=_TEXT, caller=_TEXT, caller_ip=_TEXT, resource_group=_TEXT,
    resource_id=_TEXT, correlation_id=_TEXT,
)

# Platform column names as exported, in the order of the layouts above.
PLATFORM_NAMES = {
    "metrics": [
        "TimeGenerated", "MetricName", "Resource", "Average", "Maximum", "Total",
    ],
    "diagnostics": [
        "TimeGenerated", "Category", "Resource", "db_s", "host_s", "ip_s", "user_s",
        "event_class_s", "event_subclass_s", "is_aad_auth_s", "sql_text_s", "query_time_d",
        "lock_time_d", "rows_sent_d", "rows_examined_d", "error_code_d",
    ],
    "activity": [
        "TimeGenerated", "ResourceProvider", "OperationNameValue", "ActivityStatusValue",
        "ActivitySubstatusValue", "Caller", "CallerIpAddress", "ResourceGroup", "_ResourceId",
        "CorrelationId",
    ],
}
PLATFORM_TABLES = {
    "metrics": PLATFORM_METRICS, "diagnostics": DIAGNOSTICS, "activity": ACTIVITY,
}
