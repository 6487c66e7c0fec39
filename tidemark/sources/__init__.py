"""Incremental scans of the three feeds, table reads, sinks and reference rows."""

from tidemark.sources.documents import has_new_documents, scan_documents_since  # noqa: F401
from tidemark.sources.objects import (  # noqa: F401
    has_new_objects,
    list_objects,
    object_sequence,
    order_files_by_sequence,
    scan_csv_objects_since,
    union_files,
)
from tidemark.sources.sinks import (  # noqa: F401
    route_partition,
    sink_append,
    sink_overwrite,
)
from tidemark.sources.tables import jdbc_subquery_scan, subquery_scan  # noqa: F401
from tidemark.sources.topic import (  # noqa: F401
    has_partition_lag,
    has_topic_lag,
    next_positions,
    parse_xml_records,
    partition_lag,
    scan_partitions_since,
    scan_topic_since,
    topic_reader,
)
