"""Where a feed's versioned tables live between batches.

Plain Parquet has no MERGE, so a batch never changes a file in place:

* active versions sit in hash buckets of their identifier. A batch rewrites only the
  buckets its changed keys fall into, into a folder of its own number;
* versions it closes go to the same folder under slot ``CLOSED`` and are never touched
  again, so the cost of a batch does not grow with history;
* one small commit row, written last, says which folder holds each bucket now. Every
  output of the batch becomes visible with it. A run that dies before leaves the old
  state in force, and its retry has the same number and replaces the same folders.

Where a table format with MERGE is installed, this module is the part to replace.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import bucket_of
from tidemark.functions.values import ts_literal
from tidemark.schemas import ATTEMPT, COMMIT

CLOSED = -1
SLOT = "slot"
IDENTIFIER = "source_system_identifier"
REBUCKETED = "REBUCKETED"


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders a glob matches, in name order; asks the file system of the path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().toString() for status in found or [])


def _digest(run_key: str) -> str:
    return hashlib.sha256(run_key.encode()).hexdigest()


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer knows to be empty, so that joins with it vanish."""
    nothing = spark.range(1).where(F.lit(False))
    return nothing.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass
class Commit:
    """The state after one batch: which folder holds each bucket, and the counters.

    ``seq`` numbers the published batches of a feed; it is also their ``dag_run_id``.
    """

    seq: int = 0
    run_key: str | None = None
    source_checkpoint: int | None = None
    last_ids: dict[str, int] = field(default_factory=dict)
    buckets: dict[tuple[str, int], int] = field(default_factory=dict)
    bucket_count: int | None = None
    positions: dict[int, int] = field(default_factory=dict)

    def as_row(self) -> dict:
        entries = [(table, bucket, seq) for (table, bucket), seq in sorted(self.buckets.items())]
        positions = {str(p): offset for p, offset in self.positions.items()}
        return {
            "last_ids": self.last_ids,
            "buckets": entries,
            "bucket_count": self.bucket_count,
            "positions": positions,
        }


class FeedState:
    """Reads and publishes the tables of one feed below ``root``."""

    def __init__(self, spark: SparkSession, root: str, source: str, buckets: int = 8):
        self.spark = spark
        self.root = root
        self.folder = f"{root.rstrip('/')}/{source}"
        self.source = source
        self.bucket_count = buckets

    # -- commits ---------------------------------------------------------------

    def latest(self) -> Commit:
        """The last published commit. Only the newest commit file is opened.

        Rows lie by a hash modulo the number of buckets, so a feed stored with another
        number cannot be read or continued with this one.
        """
        published = matching_paths(self.spark, f"{self.folder}/commits/*/*.json")
        if not published:
            return Commit(bucket_count=self.bucket_count)
        row = self.spark.read.schema(COMMIT).json(published[-1]).first()
        if row.bucket_count not in (None, self.bucket_count):
            raise ValueError(f"{self.source} is stored in {row.bucket_count} buckets, not {self.bucket_count}")
        return Commit(
            row.dag_run_id,
            row.run_key,
            row.source_checkpoint,
            dict(row.last_ids),
            {(b.table, b.bucket): b.seq for b in row.buckets},
            self.bucket_count,
            {int(p): offset for p, offset in (row.positions or {}).items()},
        )

    def publish(self, run: DataFrame, seq: int, run_key: str) -> None:
        """Write the commit row: one file, so it is there whole or not at all.

        Its folder is named after the number and the run key. A number that another
        writer has published is refused.
        """
        if matching_paths(self.spark, f"{self.folder}/commits/{seq:012d}*/*.json"):
            raise RuntimeError(f"batch {seq} of {self.source} is already published")
        row = run.select(COMMIT.names).coalesce(1)
        row.write.mode("overwrite").json(f"{self.folder}/commits/{seq:012d}-{_digest(run_key)}")

    def published_as(self, run_key: str) -> int | None:
        """The number under which a run key was published, by the names of commits alone."""
        found = matching_paths(self.spark, f"{self.folder}/commits/*-{_digest(run_key)}/*.json")
        return int(found[0].split("/")[-2].split("-")[0]) if found else None

    def commits(self) -> DataFrame:
        """Every published commit row."""
        published = matching_paths(self.spark, f"{self.folder}/commits/*/*.json")
        if not published:
            return empty_table(self.spark, COMMIT)
        return self.spark.read.schema(COMMIT).json(published)

    def _delete(self, pattern: str) -> int:
        found = matching_paths(self.spark, pattern)
        for name in found:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return len(found)

    def clear(self, seq: int) -> None:
        """Delete what a batch left that died under this number before it was published.

        The next batch of the number need not write the same tables, and its commit
        would publish the rest as well.
        """
        if matching_paths(self.spark, f"{self.folder}/commits/{seq:012d}*/*.json"):
            raise RuntimeError(f"batch {seq} of {self.source} is already published")
        self._delete(f"{self.folder}/versions/*/{seq:012d}")
        self._delete(f"{self.folder}/batches/{seq:012d}")

    # -- attempts --------------------------------------------------------------

    def attempt(self) -> str:
        """A folder for the rows of one try. They are for the run log, never read as state."""
        return f"{self.folder}/attempts/{uuid.uuid4().hex}"

    def note(self, attempt: str, row: dict) -> None:
        """Add a row to a try. Rows are not changed: the one with the longest trail holds."""
        shown = self.spark.createDataFrame([tuple(row[name] for name in ATTEMPT.names)], ATTEMPT)
        shown.coalesce(1).write.mode("overwrite").json(f"{attempt}/{len(row['trail']):03d}")

    def forget(self, attempt: str) -> None:
        """A published batch stands in the commits; its try need not be kept."""
        self._delete(attempt)

    def attempts(self) -> DataFrame:
        """Every row of every try that did not end in a commit."""
        found = matching_paths(self.spark, f"{self.folder}/attempts/*/*/*.json")
        if not found:
            return empty_table(self.spark, ATTEMPT)
        return self.spark.read.schema(ATTEMPT).json(found)

    # -- tables ----------------------------------------------------------------

    def rebucket(self, buckets: int, at: datetime) -> FeedState:
        """The feed laid out in another number of buckets, published as a commit of its own.

        All active versions are written once more; closed ones stay where they are. Until
        the commit is there the old layout is in force, afterwards only the new one can be
        opened. Returns the feed as it is then.
        """
        before, other = self.latest(), FeedState(self.spark, self.root, self.source, buckets)
        if not before.seq:
            return other
        seq = before.seq + 1
        self.clear(seq)
        after: dict[tuple[str, int], int] = {}
        for table in sorted({table for table, _ in before.buckets}):
            rows = self.spark.read.parquet(*self._active_paths(before, table))
            self.replace_buckets(seq, table, rows.withColumn(SLOT, bucket_of(IDENTIFIER, buckets)))
            for found in matching_paths(self.spark, f"{self._versions(table, seq)}/{SLOT}=*"):
                after[table, int(found.rsplit("=", 1)[1])] = seq
        key = f"{self.source} in {buckets} buckets, {seq}"
        laid = Commit(seq, key, before.source_checkpoint, before.last_ids, after, buckets, before.positions)
        row = {
            "dag_run_id": seq,
            "run_key": key,
            "dag_run_status": REBUCKETED,
            "run_start_date": at,
            "run_end_date": at,
            "source_checkpoint": before.source_checkpoint,
            "trail": [],
            **laid.as_row(),
        }
        values = [tuple(row.get(name) for name in COMMIT.names)]
        self.publish(self.spark.createDataFrame(values, COMMIT), seq, key)
        return other

    def batch_path(self, seq: int, name: str) -> str:
        return f"{self.folder}/batches/{seq:012d}/{name}"

    def drop(self, seq: int, *names: str) -> None:
        """Delete what a running batch has put down for itself and needs no more."""
        for name in names:
            self._delete(self.batch_path(seq, name))

    def _versions(self, table: str, seq: int | str) -> str:
        number = seq if isinstance(seq, str) else f"{seq:012d}"
        return f"{self.folder}/versions/{table}/{number}"

    def _active_paths(self, commit: Commit, table: str, only: set[int] | None = None) -> list[str]:
        return [
            f"{self._versions(table, seq)}/{SLOT}={bucket}"
            for (name, bucket), seq in commit.buckets.items()
            if name == table and (only is None or bucket in only)
        ]

    def active(
        self, commit: Commit, table: str, schema: T.StructType, only: set[int] | None = None
    ) -> DataFrame:
        """Active versions, from all buckets or only those named."""
        paths = self._active_paths(commit, table, only)
        if not paths:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def closed(self, commit: Commit, table: str, schema: T.StructType) -> DataFrame:
        """Closed versions of every published batch."""
        found = self._published(commit, self._versions(table, "*") + f"/{SLOT}={CLOSED}")
        if not found:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*found)

    def _published(self, commit: Commit, pattern: str) -> list[str]:
        """Matching folders ``.../<seq>/<name>`` of batches up to the commit."""
        folders = matching_paths(self.spark, pattern)
        return [f for f in folders if int(f.split("/")[-2]) <= commit.seq]

    def table(self, commit: Commit, table: str, schema: T.StructType) -> DataFrame:
        """All versions of a table, active and closed."""
        return self.active(commit, table, schema).unionByName(self.closed(commit, table, schema))

    def replace_buckets(self, seq: int, table: str, versions: DataFrame) -> None:
        """Write a batch's versions; each row names its bucket, or CLOSED, in ``slot``.

        The rebalance hint gathers a slot into few files and cuts a large one up, so
        neither thousands of small files nor one huge task results.
        """
        (
            versions.hint("rebalance", F.col(SLOT))
            .write.partitionBy(SLOT)
            .mode("overwrite")
            .parquet(self._versions(table, seq))
        )

    def met(
        self, commit: Commit, table: str, schema: T.StructType, slots: set[int], landing: DataFrame, key: str, shown: list[str]
    ) -> DataFrame:
        """The active versions a landing may meet: those in the buckets of its keys."""
        return self.active(commit, table, schema, slots)

    def supersede(
        self,
        commit: Commit,
        seq: int,
        table: str,
        fresh: DataFrame,
        closing: DataFrame,
        as_of: datetime,
        slots: set[int],
        key: Column,
    ) -> None:
        """Write the touched buckets anew, with ``fresh``, and the versions closed on the way.

        ``closing`` may repeat an identifier, as rows without a readable key share one. The
        left side is never replicated, and when the batch is small Spark broadcasts it and
        the store is not shuffled for the join.
        """
        active = self.active(commit, table, T.StructType(fresh.schema.fields), slots)
        hit = closing.select(IDENTIFIER, F.lit(True).alias("_hit")).distinct()
        matched = F.col("_hit").isNotNull()
        stamped = active.join(hit, IDENTIFIER, "left").withColumns(
            {
                "is_active": ~matched,
                "end_date": F.when(matched, ts_literal(as_of)).otherwise(F.col("end_date")),
            }
        )
        rows = stamped.select(active.columns).unionByName(fresh.select(active.columns))
        slot = F.when(F.col("is_active"), bucket_of(IDENTIFIER, self.bucket_count)).otherwise(CLOSED)
        self.replace_buckets(seq, table, rows.withColumn(SLOT, slot))

    def opened(self, seq: int, table: str, schema: T.StructType) -> DataFrame | None:
        """What a running batch has opened, where that is stored apart from older versions."""
        return None

    def note_closed(self, seq: int, closing: DataFrame, record: str, as_of: datetime) -> None:
        """Told which persisted versions, by their ids in ``record``, a running batch closes.

        Here closed versions are stored with their ends, so there is nothing to note.
        """

    def sweep(self, commit: Commit) -> int:
        """Delete bucket folders that ``commit`` no longer points to; returns how many.

        Only folders older than the commit go: closed versions stay, and so does
        anything a running batch may be writing. Readers of older commits must be done.
        """
        live = {(t, seq, b) for (t, b), seq in commit.buckets.items()}
        removed = 0
        for found in matching_paths(self.spark, f"{self.folder}/versions/*/*/{SLOT}=*"):
            table, number, slot = found.split("/")[-3:]
            bucket = int(slot.split("=")[1])
            old = int(number) < commit.seq and bucket != CLOSED
            if old and (table, int(number), bucket) not in live:
                removed += self._delete(found)
        return removed

    def landings(self, commit: Commit) -> list[str]:
        """The landing folder of each published batch, oldest first."""
        return self._published(commit, f"{self.folder}/batches/*/landing")

    def batches(self, commit: Commit, name: str, schema: T.StructType) -> DataFrame:
        """A per-batch output (landing, CDC, stage) of every published batch."""
        found = self._published(commit, f"{self.folder}/batches/*/{name}")
        if not found:
            return empty_table(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*found)
