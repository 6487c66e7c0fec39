"""SQL building blocks for the oracles, written apart from the operators."""

from __future__ import annotations

from tidemark.checks import carriers as c
from tidemark.sources import seeds

OPEN_END = "TIMESTAMP '9999-12-31 23:59:59'"

HASHED = {
    "alpha": [
        "interaction_id",
        "support_category",
        "agent_pseudo_name",
        "contact_date",
        "interaction_status",
        "interaction_type",
        "type_of_customer",
        "interaction_duration",
        "total_time",
        "status_of_customer_incident",
        "resolved_in_first_contact",
        "solution_type",
        "rating",
    ],
    "beta": [
        "support_identifier",
        "contact_regarding",
        "agent_code",
        "date_of_interaction",
        "status_of_interaction",
        "type_of_interaction",
        "customer_type",
        "contact_duration",
        "after_contact_work_time",
        "incident_status",
        "first_contact_solve",
        "type_of_resolution",
        "support_rating",
        "time_stamp",
    ],
    "gamma": [
        "ticket_identifier",
        "support_category",
        "agent_name",
        "date_of_call",
        "call_status",
        "call_type",
        "type_of_customer",
        "duration",
        "work_time",
        "ticket_status",
        "resolved_in_first_contact",
        "resolution_category",
        "rating",
    ],
}
RAW = {"alpha": c.alpha(True), "beta": c.beta(True), "gamma": c.gamma(True)}
KEY = {"alpha": "interaction_id", "beta": "support_identifier", "gamma": "ticket_identifier"}
RANK = {
    "alpha": "serial_number DESC",
    "beta": "try_strptime(time_stamp, '%Y/%m/%d %H:%M:%S') DESC NULLS LAST, topic_offset DESC",
    "gamma": "file_seq, " + ", ".join(c.GAMMA_ORDER),
}
# (is in the first batch, source id)
FIRST = {
    "alpha": f"ts < TIMESTAMP '{c.EVENT_CUT}'",
    "beta": f"sent < TIMESTAMP '{c.ORDER_CUT}'",
    "gamma": f"l_shipdate < TIMESTAMP '{c.SHIP_CUT}'",
}
SOURCE = {"alpha": (1, "CLIENT_ALPHA"), "beta": (2, "CLIENT_BETA"), "gamma": (3, "CLIENT_GAMMA")}


def md5_of(columns: list[str]) -> str:
    return "md5(concat_ws('||', " + ", ".join(f"CAST({x} AS VARCHAR)" for x in columns) + "))"


def latest(feed: str, where: str = "TRUE") -> str:
    """Raw rows of a feed, hashed, one per key."""
    return f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, {md5_of(HASHED[feed])} AS hash_key,
               row_number() OVER (PARTITION BY {KEY[feed]} ORDER BY {RANK[feed]}) AS rn
        FROM ({RAW[feed]}) r WHERE {where}) q
    WHERE rn = 1"""


def words(column: str, yes: str, no: str) -> str:
    return f"CASE WHEN {column} ILIKE '{yes}' THEN TRUE WHEN {column} ILIKE '{no}' THEN FALSE END"


def seconds(column: str) -> str:
    parts = [f"TRY_CAST(string_split({column}, ':')[{i}] AS INT)" for i in (1, 2, 3)]
    return f"({parts[0]} * 3600 + {parts[1]} * 60 + {parts[2]})"


def _values(blocks: dict[str, str]) -> str:
    rows, number = [], 0
    for source, (_, block) in enumerate(blocks.items(), 1):
        for name in seeds.names(block):
            number += 1
            rows.append(f"({number}, '{name}', {source})")
    return ", ".join(rows)


DIMS = f"""
    src(source_id, source_name) AS (VALUES (1, 'CLIENT_ALPHA'), (2, 'CLIENT_BETA'), (3, 'CLIENT_GAMMA')),
    agents(agent_id, pseudo_code, source_id) AS (VALUES {_values(seeds.AGENTS)}),
    areas(support_area_id, support_area_name, source_id) AS (VALUES {_values(seeds.SUPPORT_AREAS)}),
    kinds(customer_type_id, customer_type_name, source_id) AS (VALUES {_values(seeds.CUSTOMER_TYPES)})"""

_CONFORM = {
    "alpha": {
        "agent": "agent_pseudo_name",
        "area": "support_category",
        "kind": "type_of_customer",
        "interaction_date": "try_strptime(contact_date, '%d/%m/%Y %H:%M:%S')",
        "interaction_status": "interaction_status",
        "interaction_type": "interaction_type",
        "handle_time": "interaction_duration",
        "work_time": "total_time - interaction_duration",
        "first_contact_resolution": words("resolved_in_first_contact", "YES", "NO"),
        "query_status": "status_of_customer_incident",
        "solution_type": "solution_type",
        "customer_rating": "CAST(ceil(rating / 2.0) AS INT)",
    },
    "beta": {
        "agent": "agent_code",
        "area": "contact_regarding",
        "kind": "customer_type",
        "interaction_date": "try_strptime(date_of_interaction, '%Y%m%d%H%M%S')",
        "interaction_status": "status_of_interaction",
        "interaction_type": "type_of_interaction",
        "handle_time": seconds("contact_duration"),
        "work_time": seconds("after_contact_work_time"),
        "first_contact_resolution": words("first_contact_solve", "TRUE", "FALSE"),
        "query_status": "incident_status",
        "solution_type": "type_of_resolution",
        "customer_rating": "TRY_CAST(support_rating AS INT)",
    },
    "gamma": {
        "agent": "agent_name",
        "area": "support_category",
        "kind": "type_of_customer",
        "interaction_date": "try_strptime(date_of_call, '%m%d%Y%H%M%S')",
        "interaction_status": "call_status",
        "interaction_type": "call_type",
        "handle_time": "TRY_CAST(duration AS INT)",
        "work_time": "TRY_CAST(work_time AS INT)",
        "first_contact_resolution": words("resolved_in_first_contact", "1", "0"),
        "query_status": "ticket_status",
        "solution_type": "resolution_category",
        "customer_rating": "CASE rating WHEN 'WORST' THEN 1 WHEN 'BAD' THEN 2 WHEN 'NEUTRAL' THEN 3"
        " WHEN 'GOOD' THEN 4 WHEN 'BEST' THEN 5 END",
    },
}
REQUIRED = [
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
VALID = " AND ".join(f"{x} IS NOT NULL" for x in REQUIRED)


def conformed(feed: str, rows: str, run: int = 1) -> str:
    """``rows`` (a subquery of raw rows) as conformed rows; needs DIMS in scope."""
    m = _CONFORM[feed]
    number, name = SOURCE[feed]
    key = KEY[feed]
    plain = ", ".join(f"{m[x]} AS {x}" for x in REQUIRED if x in m)
    return f"""
    SELECT {number} AS source_id, CAST({key} AS BIGINT) AS source_record_id,
           concat_ws('-', '{name}', CAST({key} AS VARCHAR)) AS source_system_identifier,
           agent_id, support_area_id, customer_type_id, {plain}, CAST({run} AS BIGINT) AS dag_run_id
    FROM ({rows}) w
    LEFT JOIN agents a ON a.pseudo_code = w.{m["agent"]} AND a.source_id = {number}
    LEFT JOIN areas b ON b.support_area_name = w.{m["area"]} AND b.source_id = {number}
    LEFT JOIN kinds k ON k.customer_type_name = w.{m["kind"]} AND k.source_id = {number}"""
