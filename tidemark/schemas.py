"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "percentage": T.DecimalType(5, 2),
    "duration": T.DayTimeIntervalType(),
}


def struct(spec: str) -> T.StructType:
    """``"name type, name type"`` as a schema; needs no running session."""
    fields = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Raw feeds, field names as the producers write them.
ALPHA_DOCUMENT = struct(
    """_id string, serial_number bigint, record_id bigint, INTERACTION_ID bigint,
    SUPPORT_CATEGORY string, AGENT_PSEUDO_NAME string, CONTACT_DATE string,
    INTERACTION_STATUS string, INTERACTION_TYPE string, TYPE_OF_CUSTOMER string,
    INTERACTION_DURATION int, TOTAL_TIME int, STATUS_OF_CUSTOMER_INCIDENT string,
    RESOLVED_IN_FIRST_CONTACT string, SOLUTION_TYPE string, RATING int"""
)
BETA_RECORD = struct(
    """SUPPORT_IDENTIFIER string, CONTACT_REGARDING string, AGENT_CODE string,
    DATE_OF_INTERACTION string, STATUS_OF_INTERACTION string, TYPE_OF_INTERACTION string,
    CUSTOMER_TYPE string, CONTACT_DURATION string, AFTER_CONTACT_WORK_TIME string,
    INCIDENT_STATUS string, FIRST_CONTACT_SOLVE string, TYPE_OF_RESOLUTION string,
    SUPPORT_RATING string, TIME_STAMP string"""
)
TOPIC_MESSAGE = struct("offset bigint, value string")
PARTITION_MESSAGE = struct("partition int, offset bigint, value string")
GAMMA_OBJECT = struct(
    """TICKET_IDENTIFIER string, SUPPORT_CATEGORY string, AGENT_NAME string,
    DATE_OF_CALL string, CALL_STATUS string, CALL_TYPE string, TYPE_OF_CUSTOMER string,
    DURATION string, WORK_TIME string, TICKET_STATUS string,
    RESOLVED_IN_FIRST_CONTACT string, RESOLUTION_CATEGORY string, RATING string"""
)

# Conformed fact, in stored order.
FACT_COLUMNS = [
    "source_id",
    "source_record_id",
    "source_system_identifier",
    "agent_id",
    "interaction_date",
    "support_area_id",
    "interaction_status",
    "interaction_type",
    "customer_type_id",
    "handle_time",
    "work_time",
    "first_contact_resolution",
    "query_status",
    "solution_type",
    "customer_rating",
    "dag_run_id",
]
# The columns without which a row is invalid.
REQUIRED_COLUMNS = [
    "agent_id",
    "interaction_date",
    "support_area_id",
    "interaction_status",
    "interaction_type",
    "customer_type_id",
    "handle_time",
    "work_time",
    "first_contact_resolution",
    "query_status",
    "solution_type",
    "customer_rating",
]
VERSION_COLUMNS = ["is_active", "start_date", "end_date"]

RUN_LOG = struct(
    """dag_run_id bigint, run_key string, source_id int, dag_run_status string,
    run_start_date timestamp_ntz, run_end_date timestamp_ntz, batch_count bigint,
    insert_count bigint, update_count bigint, duplicate_count bigint, valid_count bigint,
    validity_percentage percentage, run_duration duration,
    source_checkpoint bigint"""
)
ATTEMPT_FIELDS = ["run_key", "source_id", "dag_run_status", "run_start_date", "run_end_date"]
RUN_HISTORY = struct(
    """run_id bigint, script_name string, input_value int, records_generated bigint,
    start_time timestamp_ntz, end_time timestamp_ntz, duration double, status string,
    error_message string, log_file string"""
)
TRAIL = struct("status string, op_ts timestamp_ntz, seq int")
# One published batch: its run-log row (the duration follows from its ends), the
# statuses it went through, and the state it left.
COMMIT = T.StructType(
    [
        *[f for f in RUN_LOG.fields if f.name != "run_duration"],
        T.StructField("trail", T.ArrayType(TRAIL)),
        T.StructField("last_ids", T.MapType(T.StringType(), T.LongType())),
        T.StructField("buckets", T.ArrayType(struct("table string, bucket int, seq bigint"))),
        T.StructField("bucket_count", T.IntegerType()),
        T.StructField("positions", T.MapType(T.StringType(), T.LongType())),
    ]
)
# One try at a batch that is not published: its run-log columns and statuses so far.
ATTEMPT = T.StructType(
    [*[f for f in RUN_LOG.fields if f.name in ATTEMPT_FIELDS], T.StructField("trail", T.ArrayType(TRAIL))]
)
