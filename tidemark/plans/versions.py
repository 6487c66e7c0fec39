"""A feed whose batches only append, and whose numbers are taken atomically.

Each try at a batch writes into a folder of its own; what it writes are the rows it opened,
for every table. The commit of a batch is one small file named after its number alone, made
only if it is not there yet. So of two writers that worked on the same number one is
published and the other refused, and a reader never sees a folder no commit names. A batch also
notes the ids of the persisted versions it closes. End dates and active flags are derived at
read, from these notes or, for errors and rows without a key, from the keys
(``operators.versions``).
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.values import OPEN_END, ts_literal
from tidemark.operators.marks import MOST_PARTS, marked, read_marks, write_marks
from tidemark.operators.versions import KEY, RUN, current_of, delta_since, open_ended, versions_at_read
from tidemark.plans.state import Commit, FeedState, _digest, empty_table, matching_paths
from tidemark.schemas import COMMIT, VERSION_COLUMNS
from tidemark.sources.sinks import create_absent, read_text, sink_overwrite

CLOSED, CLOSED_MARKS = "closed", "closed_marks"
# Tables whose rows name the persisted version that they are or come from.
RECORD = {"persisted": "prs_record_id", "fact": "source_record_id"}
LOGGED = T.StructType([*COMMIT.fields, T.StructField("folder", T.StringType())])


class AlreadyPublished(RuntimeError):
    """Another writer has published the number this batch was written for."""


class VersionLog(FeedState):
    """Reads and publishes the append-only tables of one feed below ``root``.

    ``buckets`` is not used: there is nothing to be rewritten.
    """

    def __init__(self, spark: SparkSession, root: str, source: str, buckets: int = 1):
        super().__init__(spark, root, source, buckets)
        self._own: dict[int, str] = {}

    # -- commits ---------------------------------------------------------------

    def _commit_file(self, seq: int) -> str:
        return f"{self.folder}/log/{seq:012d}.json"

    def latest(self) -> Commit:
        """The last published commit; only its file is opened."""
        found = matching_paths(self.spark, f"{self.folder}/log/*.json")
        if not found:
            return Commit(bucket_count=self.bucket_count)
        row = json.loads(read_text(self.spark, found[-1]))
        return Commit(
            row["dag_run_id"],
            row["run_key"],
            row.get("source_checkpoint"),
            dict(row.get("last_ids") or {}),
            positions={int(p): offset for p, offset in (row.get("positions") or {}).items()},
        )

    def publish(self, run: DataFrame, seq: int, run_key: str) -> None:
        """Make the commit file if the number is free, else refuse and drop what was written."""
        self._mark(self.latest().run_key)  # where a writer died between its file and its mark
        row = run.withColumn("folder", F.lit(self._own.get(seq))).select(LOGGED.names)
        text = row.select(F.to_json(F.struct(*LOGGED.names))).first()[0]
        if not create_absent(self.spark, self._commit_file(seq), text):
            if seq in self._own:
                self._delete(f"{self.folder}/batches/{self._own.pop(seq)}")
            raise AlreadyPublished(f"batch {seq} of {self.source} is already published")
        self._own.pop(seq, None)
        self._mark(run_key)

    def _mark(self, run_key: str | None) -> None:
        if run_key is not None:
            create_absent(self.spark, f"{self.folder}/keys/{_digest(run_key)}", run_key)

    def published_as(self, run_key: str) -> int | None:
        """The number under which a run key was published.

        Marks tell whether there is one; only then the commits are read for it.
        """
        last = self.latest()
        if last.run_key == run_key:
            return last.seq
        if not matching_paths(self.spark, f"{self.folder}/keys/{_digest(run_key)}"):
            return None
        return self.commits().where(F.col("run_key") == run_key).first()["dag_run_id"]

    def commits(self) -> DataFrame:
        found = matching_paths(self.spark, f"{self.folder}/log/*.json")
        if not found:
            return empty_table(self.spark, LOGGED)
        return self.spark.read.schema(LOGGED).json(found)

    def clear(self, seq: int) -> None:
        """Begin a try at ``seq`` in a fresh folder.

        Folders of tries at numbers that were published by others are deleted: no commit
        can name them any more. A living writer of the same number is left alone.
        """
        if matching_paths(self.spark, self._commit_file(seq)):
            raise AlreadyPublished(f"batch {seq} of {self.source} is already published")
        kept = set(self._folders(seq - 1))
        for found in matching_paths(self.spark, f"{self.folder}/batches/*"):
            name = found.rsplit("/", 1)[1]
            if int(name.split("-")[0]) < seq and name not in kept:
                self._delete(found)
        self._own[seq] = f"{seq:012d}-{uuid.uuid4().hex}"

    def rebucket(self, buckets: int, at: datetime) -> FeedState:
        raise NotImplementedError("an append-only feed has no buckets")

    def sweep(self, commit: Commit) -> int:
        return 0

    # -- tables ----------------------------------------------------------------

    def _folders(self, seq: int) -> list[str]:
        """Names of the published batches' folders up to ``seq``, oldest first.

        A number has one folder, unless a try died or lost; then its commit is asked.
        """
        by: dict[int, list[str]] = {}
        for found in matching_paths(self.spark, f"{self.folder}/batches/*"):
            name = found.rsplit("/", 1)[1]
            by.setdefault(int(name.split("-")[0]), []).append(name)
        out = []
        for number in sorted(n for n in by if n <= seq):
            names = by[number]
            if len(names) > 1:
                names = [json.loads(read_text(self.spark, self._commit_file(number)))["folder"]]
            out += names
        return out

    def batch_path(self, seq: int, name: str) -> str:
        own = self._own.get(seq)
        return f"{self.folder}/batches/{own or self._folders(seq)[-1]}/{name}"

    def _outputs(self, commit: Commit, name: str) -> list[str]:
        there = {f.split("/")[-2]: f for f in matching_paths(self.spark, f"{self.folder}/batches/*/{name}")}
        return [there[f] for f in self._folders(commit.seq) if f in there]

    def log(self, commit: Commit, table: str, schema: T.StructType) -> DataFrame:
        """Every version as it was opened, with its key, without its end."""
        fields = [f for f in schema.fields if f.name not in ("is_active", "end_date")]
        stored = T.StructType([*fields, T.StructField(KEY, T.StringType())])
        found = self._outputs(commit, table)
        return self.spark.read.schema(stored).parquet(*found) if found else empty_table(self.spark, stored)

    def table(self, commit: Commit, table: str, schema: T.StructType) -> DataFrame:
        log = self.log(commit, table, schema)
        closed, marks = self._outputs(commit, CLOSED), self._outputs(commit, CLOSED_MARKS)
        if table not in RECORD or len(closed) < len(self._outputs(commit, "persisted")):
            return versions_at_read(log).select(schema.names)
        return self._ended(log, commit.seq, RECORD[table], closed, marks).select(schema.names)

    def _ended(self, log: DataFrame, last: int, record: str, closed: list[str], marks: list[str]) -> DataFrame:
        """The log with ``end_date`` and ``is_active``, from what the batches noted to close.

        The last run's versions are open, and so is a version that no mark names; where the marks
        of many batches are too many parts to look up, all older rows are joined. Rows without
        a natural key share the source's name for a key where they have one, and close each
        other by it; these are lined up by run.
        """
        keyless = F.col(KEY).eqNullSafe(F.lit(self.source))
        keyed, newest = log.where(~keyless), F.col(RUN).eqNullSafe(F.lit(last))
        older, parts = keyed.where(~newest), [part for path in marks for part in read_marks(self.spark, path)]
        ends = self.spark.read.schema("_record bigint, end_date timestamp_ntz").parquet(*closed) if closed else None
        out = open_ended(keyed.where(newest)).unionByName(versions_at_read(log.where(keyless)))
        if len(parts) <= MOST_PARTS:
            split = marked(older, record, parts, "_closed")
            out = out.unionByName(open_ended(split.where("NOT _closed").drop("_closed")))
            older = split.where("_closed").drop("_closed")
        if not parts:
            return out
        met = older.join(ends, F.col(record) == F.col("_record"), "left").drop("_record")
        open_ = F.col("end_date").isNull()
        return out.unionByName(met.withColumns({"is_active": open_, "end_date": F.coalesce("end_date", ts_literal(OPEN_END))}))

    def active(self, commit: Commit, table: str, schema: T.StructType, only: set[int] | None = None) -> DataFrame:
        return self.table(commit, table, schema).where("is_active")

    def closed(self, commit: Commit, table: str, schema: T.StructType) -> DataFrame:
        return self.table(commit, table, schema).where("NOT is_active")

    def met(
        self, commit: Commit, table: str, schema: T.StructType, slots: set[int], landing: DataFrame, key: str, shown: list[str]
    ) -> DataFrame:
        """The active versions of the landed keys: only the columns asked for are read."""
        log = self.log(commit, table, schema).select(*shown, KEY, "dag_run_id")
        keys = landing.select(F.col(key).cast("string").alias(KEY))
        return current_of(log, keys).select(*shown, F.lit(True).alias("is_active"))

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
        """Append what the batch opened. What it closes follows from the keys and ``note_closed``."""
        kept = [c for c in fresh.columns if c not in VERSION_COLUMNS or c == "start_date"]
        sink_overwrite(fresh.select(*kept, key.cast("string").alias(KEY)), self.batch_path(seq, table))

    def opened(self, seq: int, table: str, schema: T.StructType) -> DataFrame | None:
        return self.spark.read.schema(schema).parquet(self.batch_path(seq, table))

    def note_closed(self, seq: int, closing: DataFrame, record: str, as_of: datetime) -> None:
        """The ids and the end of the versions a batch closes, and the ids once more as marks."""
        ids = closing.select(F.col(record).alias("_record"))
        path = self.batch_path(seq, CLOSED)
        sink_overwrite(ids.withColumn("end_date", ts_literal(as_of)), path)
        write_marks(self.spark.read.schema(ids.schema).parquet(path), "_record", self.batch_path(seq, CLOSED_MARKS))

    def delta(self, since: int, table: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
        """Versions that the batches after ``since`` opened and closed, for figures kept as a state."""
        opened, closed = delta_since(self.log(self.latest(), table, schema), since)
        return opened.select(schema.names), closed.select(schema.names)

    def landings(self, commit: Commit) -> list[str]:
        return self._outputs(commit, "landing")

    def batches(self, commit: Commit, name: str, schema: T.StructType) -> DataFrame:
        found = self._outputs(commit, name)
        return self.spark.read.schema(schema).parquet(*found) if found else empty_table(self.spark, schema)
