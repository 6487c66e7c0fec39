"""The three feeds, described once.

Every pipeline operator is driven by a ``FeedSpec``; there is one pipeline, not
one per feed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import temporal as tm
from tidemark.functions import values as v


@dataclass(frozen=True)
class FeedSpec:
    """How one feed is keyed, hashed, typed and conformed.

    ``position`` is the column the checkpoint advances on. ``newest_first`` ranks
    the copies of a key within a batch; the first in that order is kept. ``typed``
    turns landed text into stored columns and ``conformed`` turns stored columns
    into fact columns; a column missing from either is carried over by name. A feed with
    ``partition`` has a checkpoint for each of that column's values. ``place`` names the columns
    of a rank that is nothing but the row's place: its file's, and last its number, which is that
    of ``monotonically_increasing_id``.
    """

    source: str
    natural_key: str
    raw: T.StructType
    position: str
    rank: tuple[Callable[[], Column], ...]
    hash_columns: tuple[str, ...]
    typed: dict[str, Callable[[], Column]]
    lookups: dict[str, str]
    conformed: dict[str, Callable[[], Column]]
    partition: str | None = None
    place: tuple[str, ...] = ()

    @property
    def fields(self) -> list[str]:
        """Stored business columns in landing order."""
        return [c for c in self.hash_columns if c not in self.unstored]

    @property
    def unstored(self) -> set[str]:
        """Hashed at landing but not kept in the versioned store."""
        return {"time_stamp"}


def _copy(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _lower(schema: T.StructType) -> tuple[str, ...]:
    return tuple(name.lower() for name in schema.fieldNames())


ALPHA = FeedSpec(
    source="CLIENT_ALPHA",
    natural_key="interaction_id",
    raw=schemas.ALPHA_DOCUMENT,
    position="serial_number",
    rank=(lambda: F.desc("serial_number"), lambda: F.desc("hash_key")),
    hash_columns=_lower(schemas.ALPHA_DOCUMENT)[3:],
    typed={
        "contact_date": lambda: tm.parse_ts_dmy("contact_date"),
        "interaction_duration": lambda: v.cast_numeric("interaction_duration"),
        "total_time": lambda: v.cast_numeric("total_time"),
        "resolved_in_first_contact": lambda: v.normalise_boolean(
            "resolved_in_first_contact", "YES", "NO"
        ),
        "rating": lambda: v.cast_numeric("rating"),
    },
    lookups={
        "agent_id": "agent_pseudo_name",
        "support_area_id": "support_category",
        "customer_type_id": "type_of_customer",
    },
    conformed={
        "interaction_date": _copy("contact_date"),
        "handle_time": _copy("interaction_duration"),
        "work_time": lambda: v.work_time_from_total("total_time", "interaction_duration"),
        "first_contact_resolution": _copy("resolved_in_first_contact"),
        "query_status": _copy("status_of_customer_incident"),
        "customer_rating": lambda: v.rating_halve("rating"),
    },
)

BETA = FeedSpec(
    source="CLIENT_BETA",
    natural_key="support_identifier",
    raw=schemas.BETA_RECORD,
    position="topic_offset",
    rank=(
        lambda: tm.parse_ts_created("time_stamp").desc_nulls_last(),
        lambda: F.desc("topic_offset"),
        lambda: F.desc("hash_key"),
    ),
    hash_columns=_lower(schemas.BETA_RECORD),
    typed={
        "date_of_interaction": lambda: tm.parse_ts_compact("date_of_interaction"),
        "first_contact_solve": lambda: v.normalise_boolean("first_contact_solve", "TRUE", "FALSE"),
        "support_rating": lambda: v.cast_numeric("support_rating"),
    },
    lookups={
        "agent_id": "agent_code",
        "support_area_id": "contact_regarding",
        "customer_type_id": "customer_type",
    },
    conformed={
        "interaction_date": _copy("date_of_interaction"),
        "interaction_status": _copy("status_of_interaction"),
        "interaction_type": _copy("type_of_interaction"),
        "handle_time": lambda: tm.duration_to_seconds("contact_duration"),
        "work_time": lambda: tm.duration_to_seconds("after_contact_work_time"),
        "first_contact_resolution": _copy("first_contact_solve"),
        "query_status": _copy("incident_status"),
        "solution_type": _copy("type_of_resolution"),
        "customer_rating": _copy("support_rating"),
    },
)

# The same messages from a topic of several partitions. Offsets say nothing across
# partitions; of copies created at the same time the one of highest offset is kept.
BETA_PARTITIONED = replace(
    BETA,
    partition="topic_partition",
    rank=(*BETA.rank[:2], lambda: F.desc("topic_partition"), *BETA.rank[2:]),
)

GAMMA = FeedSpec(
    source="CLIENT_GAMMA",
    natural_key="ticket_identifier",
    raw=schemas.GAMMA_OBJECT,
    position="file_seq",
    rank=(lambda: F.asc("file_seq"), lambda: F.asc("file_name"), lambda: F.asc("row_id")),
    hash_columns=_lower(schemas.GAMMA_OBJECT),
    typed={
        "date_of_call": lambda: tm.parse_ts_mdy_compact("date_of_call"),
        "duration": lambda: v.cast_numeric("duration"),
        "work_time": lambda: v.cast_numeric("work_time"),
        "resolved_in_first_contact": lambda: v.normalise_boolean(
            "resolved_in_first_contact", "1", "0"
        ),
    },
    lookups={
        "agent_id": "agent_name",
        "support_area_id": "support_category",
        "customer_type_id": "type_of_customer",
    },
    conformed={
        "interaction_date": _copy("date_of_call"),
        "interaction_status": _copy("call_status"),
        "interaction_type": _copy("call_type"),
        "handle_time": _copy("duration"),
        "first_contact_resolution": _copy("resolved_in_first_contact"),
        "query_status": _copy("ticket_status"),
        "solution_type": _copy("resolution_category"),
        "customer_rating": lambda: v.rating_from_label("rating"),
    },
    place=("file_seq", "file_name", "row_id"),
)

FEEDS = {spec.source: spec for spec in (ALPHA, BETA, GAMMA)}
