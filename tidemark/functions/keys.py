"""Row hashes, source identifiers and storage buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators that the stored hashes and identifiers use.
HASH_SEPARATOR = "||"
IDENTIFIER_SEPARATOR = "-"


def row_hash(columns: list[str]) -> Column:
    """MD5 over the text of ``columns``; NULL fields are skipped.

    Skipping means ``(a, NULL, b)`` and ``(a, b, NULL)`` hash alike. Stored hashes
    depend on that, so it is the default; see ``null_safe_hash``.
    """
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[F.col(c).cast("string") for c in columns]))


def null_safe_hash(columns: list[str]) -> Column:
    """Variant of ``row_hash`` in which a NULL field keeps its place.

    Present fields carry a ``v`` prefix and absent ones are a bare ``n``, so no
    text value can pass for a NULL.
    """
    fields = [
        F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns
    ]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *fields))


def source_identifier(source: str | Column, natural_key: str) -> Column:
    """``<SOURCE>-<natural id>``; only the source when the id is NULL."""
    name = F.lit(source) if isinstance(source, str) else source
    return F.concat_ws(IDENTIFIER_SEPARATOR, name, F.col(natural_key).cast("string"))


def bucket_of(key: str, buckets: int) -> Column:
    """Storage bucket of a key: stable across runs, uniform over distinct keys."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
