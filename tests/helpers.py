"""Row builders for the three feeds, in their raw form."""

from __future__ import annotations

import gzip
import json
from datetime import datetime
from pathlib import Path

T1, T2, T3 = (datetime(2026, 1, d) for d in (1, 2, 3))
OPEN = datetime(9999, 12, 31, 23, 59, 59)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def document(serial: int, interaction: int, **changes) -> dict:
    base = {
        "_id": f"{serial}-{interaction}",
        "serial_number": serial,
        "record_id": interaction,
        "INTERACTION_ID": interaction,
        "SUPPORT_CATEGORY": "ORDER ISSUES",
        "AGENT_PSEUDO_NAME": "JDOE",
        "CONTACT_DATE": "01/01/2021 00:00:00",
        "INTERACTION_STATUS": "COMPLETED",
        "INTERACTION_TYPE": "CALL",
        "TYPE_OF_CUSTOMER": "PRIME MEMBER",
        "INTERACTION_DURATION": 120,
        "TOTAL_TIME": 150,
        "STATUS_OF_CUSTOMER_INCIDENT": "RESOLVED",
        "RESOLVED_IN_FIRST_CONTACT": "YES",
        "SOLUTION_TYPE": "SELF-HELP OPTION",
        "RATING": 9,
    }
    return base | changes


def write_documents(folder: Path, name: str, documents: list[dict]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(json.dumps(d) for d in documents))


def message(identifier, **changes) -> str:
    base = {
        "SUPPORT_IDENTIFIER": identifier,
        "CONTACT_REGARDING": "RIDE ISSUES",
        "AGENT_CODE": "IGONZALEZ",
        "DATE_OF_INTERACTION": "20210401101500",
        "STATUS_OF_INTERACTION": "INTERACTION COMPLETED",
        "TYPE_OF_INTERACTION": "CHAT",
        "CUSTOMER_TYPE": "COMMUTER",
        "CONTACT_DURATION": "0:02:00",
        "AFTER_CONTACT_WORK_TIME": "00:01:05",
        "INCIDENT_STATUS": "RESOLVED",
        "FIRST_CONTACT_SOLVE": "TRUE",
        "TYPE_OF_RESOLUTION": "SELF-HELP OPTION",
        "SUPPORT_RATING": "4",
        "TIME_STAMP": "2024/01/01 03:00:00",
    } | changes
    body = "".join(f"<{k}>{'' if v is None else v}</{k}>" for k, v in base.items())
    return f"<RECORD>{body}</RECORD>"


OBJECT_HEADER = [
    "TICKET_IDENTIFIER",
    "SUPPORT_CATEGORY",
    "AGENT_NAME",
    "DATE_OF_CALL",
    "CALL_STATUS",
    "CALL_TYPE",
    "TYPE_OF_CUSTOMER",
    "DURATION",
    "WORK_TIME",
    "TICKET_STATUS",
    "RESOLVED_IN_FIRST_CONTACT",
    "RESOLUTION_CATEGORY",
    "RATING",
]


def ticket(identifier, **changes) -> dict:
    values = [
        identifier,
        "HOME SERVICES",
        "STHOMPSON",
        "12312021230405",
        "COMPLETED",
        "CALL",
        "NEW CUSTOMER",
        "120",
        "30",
        "RESOLVED",
        "1",
        "SELF-HELP OPTION",
        "BEST",
    ]
    return dict(zip(OBJECT_HEADER, values)) | changes


def write_object(folder: Path, sequence: int, tickets: list[dict]) -> Path:
    """A gzip object named and quoted as the producer does it."""
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{sequence:10d}_client_gamma_support_data_20240101_120000.csv.gz"
    lines = [OBJECT_HEADER] + [[t[c] for c in OBJECT_HEADER] for t in tickets]
    quoted = "\n".join("|".join(f'"{"" if v is None else v}"' for v in line) for line in lines)
    with gzip.open(path, "wt") as out:
        out.write(quoted + "\n")
    return path
