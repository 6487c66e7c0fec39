"""Column expressions: keys and hashes, time parsing, value normalisation, metrics."""

from tidemark.functions.keys import (  # noqa: F401
    bucket_of,
    null_safe_hash,
    row_hash,
    source_identifier,
)
from tidemark.functions.metrics import (  # noqa: F401
    coalesce_metrics,
    interval_epoch_seconds,
    run_duration,
    validity_percentage,
)
from tidemark.functions.temporal import (  # noqa: F401
    duration_to_seconds,
    parse_ts,
    parse_ts_compact,
    parse_ts_created,
    parse_ts_dmy,
    parse_ts_mdy_compact,
)
from tidemark.functions.values import (  # noqa: F401
    cast_numeric,
    empty_to_null,
    normalise_boolean,
    rating_from_label,
    rating_halve,
    rename_columns,
    scd_defaults,
    tag_run,
    work_time_from_total,
)
