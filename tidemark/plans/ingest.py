"""One batch of one feed, from raw rows to the versioned fact.

The classified batch is written once, before anything that depends on it, and every
later step reads that snapshot: closing old versions cannot change what the batch was
classified as, and a retry after a crash repeats the same work.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.feeds import FeedSpec
from tidemark.functions.keys import bucket_of, row_hash, source_identifier
from tidemark.functions.metrics import run_duration
from tidemark.functions.values import OPEN_END, cast_numeric, scd_defaults, tag_run
from tidemark.operators import audit
from tidemark.operators.conform import conform, type_landing
from tidemark.operators.dedup import dedup_by_rank
from tidemark.operators.filters import CHANGED, filter_active, filter_merge_type
from tidemark.operators.keys import surrogate_key
from tidemark.operators.marks import count_marks, marked, read_marks, write_marks
from tidemark.operators.merge import merge_classify, merge_counts, merge_type
from tidemark.operators.quality import error_rows, validate_required, without_match
from tidemark.plans.state import IDENTIFIER, REBUCKETED, Commit, FeedState
from tidemark.schemas import ATTEMPT, COMMIT, RUN_LOG, VERSION_COLUMNS, struct
from tidemark.sources.sinks import sink_overwrite
from tidemark.sources.topic import CORRUPT, next_positions

PERSISTED, FACT, ERRORS = "persisted", "fact", "errors"
IDS = {PERSISTED: "prs_record_id", FACT: "fact_id", ERRORS: "data_error_id"}
LANDING_ID = "landing_id"

_VERSION = "is_active boolean, start_date timestamp_ntz, end_date timestamp_ntz"
FACT_SCHEMA = struct(
    "fact_id bigint, source_id int, source_record_id bigint, source_system_identifier string,"
    " agent_id int, interaction_date timestamp_ntz, support_area_id int,"
    " interaction_status string, interaction_type string, customer_type_id int,"
    " handle_time int, work_time int, first_contact_resolution boolean, query_status string,"
    f" solution_type string, customer_rating int, dag_run_id bigint, is_valid boolean, {_VERSION}"
)
ERROR_SCHEMA = struct(
    "data_error_id bigint, dag_run_id bigint, source_id int, error_type string,"
    f" error_description string, source_system_identifier string, source_record_id bigint, {_VERSION}"
)


@dataclass(frozen=True)
class BatchResult:
    """What a batch did. ``seq`` is 0 for an empty batch, which changes nothing."""

    seq: int
    batch_count: int = 0
    insert_count: int = 0
    update_count: int = 0
    duplicate_count: int = 0
    valid_count: int = 0
    checkpoint: int | None = None
    replayed: bool = False


class StageFailed(RuntimeError):
    """A stage broke; ``status`` is what the run log would show."""

    def __init__(self, status: str, trail: list[str]):
        super().__init__(status)
        self.status = status
        self.trail = trail


def _keyed(batch: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows with their natural key read.

    Keys that cannot be read stay apart by their text, although all become NULL; only rows
    without any key form one group.
    """
    read = cast_numeric(spec.natural_key, "bigint")
    unread = F.when(read.isNull(), F.col(spec.natural_key).cast("string"))
    return batch.withColumns({"_unread": unread, spec.natural_key: read})


def _hashed(batch: DataFrame, spec: FeedSpec) -> DataFrame:
    return batch.withColumn("hash_key", row_hash(list(spec.hash_columns)))


def _landed(kept: DataFrame, spec: FeedSpec) -> DataFrame:
    return kept.select(spec.position, *spec.hash_columns, "hash_key")


def land(batch: DataFrame, spec: FeedSpec) -> DataFrame:
    """Hash the raw rows and keep one per natural key."""
    keyed = _keyed(_hashed(batch, spec), spec)
    kept = dedup_by_rank(keyed, [spec.natural_key, "_unread"], [r() for r in spec.rank])
    return _landed(kept, spec)


def with_place(scanned: DataFrame, spec: FeedSpec) -> DataFrame | None:
    """Stored rows with ``_place``, one number that grows as the feed's rank does.

    Of a file the rows that one task has read are numbered in a row; the driver lines up these
    spans, which are as many as files. None where a row has no number. Rows that share their
    place have the same one.
    """
    *file, number = spec.place
    # The upper bits of ``monotonically_increasing_id`` are the task's.
    tasked = scanned.withColumn("_task", F.shiftright(number, 33))
    spans = tasked.groupBy(*file, "_task").agg(F.min(number).alias("_from"), F.max(number).alias("_to"))
    found = [tuple(r) for r in spans.collect()]
    if any(span[-1] is None for span in found):
        return None
    found.sort(key=lambda span: [(v is not None, v) for v in span])
    shifts, total = [], 0
    for *_, first, last in found:
        shifts.append(total - first)
        total += last - first + 1
    # An Arrow table becomes a local relation, whose size Spark knows.
    named = [*file, "_task"]
    columns = {f"_{c}": pa.array([span[i] for span in found]) for i, c in enumerate(named)}
    lined = scanned.sparkSession.createDataFrame(pa.table(columns | {"_shift": pa.array(shifts, pa.int64())}))
    kinds = {c: spans.schema[c].dataType for c in named}
    lined = lined.select(*[F.col(f"_{c}").cast(kinds[c]).alias(f"_{c}") for c in named], "_shift")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in file] + [F.col("_task") == F.col("__task")]
    return tasked.join(lined, same).select(*scanned.columns, (F.col(number) + F.col("_shift")).alias("_place"))


def persisted_schema(typed: DataFrame) -> T.StructType:
    """Schema of the versioned store: the typed landing row with its keys and interval."""
    head = f"{IDS[PERSISTED]} bigint, source_id int, dag_run_id bigint, {IDENTIFIER} string"
    return T.StructType(struct(head).fields + typed.schema.fields + struct(_VERSION).fields)


def _slots(when: Column, buckets: int) -> Column:
    """Buckets of the rows ``when`` picks: at most as many values as there are buckets.

    Of a single bucket no row's hash is asked.
    """
    if buckets == 1:
        return F.array_compact(F.array(F.max(F.when(when, F.lit(0)))))
    return F.collect_set(F.when(when, bucket_of(IDENTIFIER, buckets)))


class _Run:
    """The stages of one batch. Each writes what the next one reads."""

    def __init__(self, state: FeedState, spec: FeedSpec, dims, before: Commit, run, as_of):
        self.state, self.spec, self.dims = state, spec, dims
        self.before, self.as_of = before, as_of
        self.seq = before.seq + 1
        self.source_id, self.dag_run_id, self.run_key = run
        self.after = replace(
            before,
            seq=self.seq,
            run_key=self.run_key,
            last_ids=dict(before.last_ids),
            buckets=dict(before.buckets),
            positions=dict(before.positions),
        )
        self.counts: dict[str, int] = {}
        self.schemas: dict[str, T.StructType] = {}

    def _stored(self, name: str) -> DataFrame:
        path = self.state.batch_path(self.seq, name)
        return self.state.spark.read.schema(self.schemas[name]).parquet(path)

    def _write(self, name: str, df: DataFrame) -> DataFrame:
        """Store one output of the batch and hand back the stored rows."""
        sink_overwrite(df, self.state.batch_path(self.seq, name))
        self.schemas[name] = df.schema
        return self._stored(name)

    def source_to_landing(self, batch: DataFrame) -> None:
        spec, seen = self.spec, Observation()
        # A maximum, or whether a count is zero, stays right when Spark repeats a task.
        checked = CORRUPT in batch.columns
        unreadable = F.col(CORRUPT).isNotNull() if checked else F.lit(False)
        watched = batch.observe(
            seen,
            F.max(spec.position).alias("top"),
            F.count_if(unreadable).alias("unreadable"),
        )
        readable = watched.where(~unreadable)
        if spec.place:
            self._land_by_place(readable)
        else:
            self._write_landing(land(readable, spec))
        if seen.get["unreadable"]:  # messages are parsed again only when one is broken
            self._write("rejected", batch.where(unreadable).select(spec.position, CORRUPT))
        top = seen.get["top"]
        known = [c for c in (top, self.before.source_checkpoint) if c is not None]
        self.after.source_checkpoint = max(known) if known else None
        if spec.partition:  # one row per partition; only the two columns are read
            for p, top in next_positions(batch, spec.partition, spec.position).collect():
                self.after.positions[p] = max(top, self.after.positions.get(p, top))

    def _write_landing(self, landed: DataFrame) -> DataFrame:
        return self._write("landing", surrogate_key(landed, LANDING_ID))

    def _land_by_place(self, batch: DataFrame) -> None:
        """As ``land``, by rows that are stored first and then stay where they are.

        A key's first row is found from keys and places alone, as a minimum that is combined
        before the shuffle. The rows it is are marked, and only these are read on.
        """
        spec, marks = self.spec, self.state.batch_path(self.seq, "firsts")
        scanned = self._write("scanned", batch)
        placed = with_place(scanned, spec)
        landed = None
        if placed is not None:
            keyed = _keyed(placed.select(spec.natural_key, "_place"), spec)
            firsts = keyed.groupBy(spec.natural_key, "_unread").agg(F.min("_place").alias("_place"))
            write_marks(firsts, "_place", marks)
            found = read_marks(self.state.spark, marks)
            kept = marked(placed, "_place", found, "_first").where("_first")
            landed = self._write_landing(_landed(_keyed(_hashed(kept, spec), spec), spec))
        # Where rows share a place, a mark names several; then they are ranked one by one.
        if landed is None or landed.count() != count_marks(self.state.spark, marks):
            self._write_landing(land(scanned, spec))
        self.state.drop(self.seq, "scanned", "firsts")

    def _typed(self, landing: DataFrame, *more: str) -> DataFrame:
        spec = self.spec
        identifier = source_identifier(spec.source, spec.natural_key)
        return type_landing(landing, spec, *more).withColumn(IDENTIFIER, identifier)

    def _classified(self, active: DataFrame) -> DataFrame:
        """The typed landing rows with their class.

        Only what rows meet is looked up by key, and only rows that meet something are moved.
        """
        key, record, path = self.spec.natural_key, IDS[PERSISTED], self.state.batch_path(self.seq, "meeting")
        landing = self._stored("landing")
        if not self.before.seq:
            return merge_classify(self._typed(landing), active, key)
        stored = filter_active(active).select(key, record, F.col("hash_key").alias("prs_hash_key"))
        met = self._write("met", stored.join(landing.select(key, LANDING_ID), key).drop(key))
        write_marks(met, LANDING_ID, path)
        split = marked(landing, LANDING_ID, read_marks(self.state.spark, path), "_met")
        hit = self._typed(split.where("_met"), LANDING_ID).join(met, LANDING_ID).drop(LANDING_ID)
        rest = self._typed(split.where("NOT _met")).withColumns(
            {record: F.lit(None).cast("bigint"), "prs_hash_key": F.lit(None).cast("string")}
        )
        rows = hit.unionByName(rest).withColumnRenamed("hash_key", "lnd_hash_key")
        return rows.withColumn("merge_type", merge_type(record))

    def landing_to_persisted(self) -> None:
        state, spec, buckets = self.state, self.spec, self.state.bucket_count
        typed = self._typed(self._stored("landing"))
        landed = typed.agg(F.count(F.lit(1)).alias("n"), _slots(F.lit(True), buckets).alias("s"))
        landed = landed.first()
        schema = persisted_schema(typed.drop(IDENTIFIER))
        shown = [spec.natural_key, IDS[PERSISTED], "hash_key"]
        active = state.met(self.before, PERSISTED, schema, set(landed["s"]), typed, spec.natural_key, shown)
        classified = self._classified(active)
        snapshot = self._write(
            "classified",
            self._numbered(classified.withColumnRenamed(IDS[PERSISTED], "matched_id"), PERSISTED),
        )
        state.drop(self.seq, "met", "meeting")

        changed = F.col("merge_type").isin(*CHANGED)
        found = merge_counts(
            snapshot,
            _slots(changed, buckets).alias("s"),
            F.max(IDS[PERSISTED]).alias("last"),
        ).first()
        self.counts["batch_count"] = landed["n"]
        for kind in ("insert_count", "update_count", "duplicate_count"):
            self.counts[kind] = found[kind]

        fresh = tag_run(
            filter_merge_type(snapshot).withColumnRenamed("lnd_hash_key", "hash_key"),
            self.source_id,
            self.dag_run_id,
        )
        self.fresh = scd_defaults(fresh, self.as_of).select(schema.names)
        closing = filter_merge_type(snapshot, "UPDATE")
        key = F.col(spec.natural_key)
        self._replace(PERSISTED, closing, self.fresh, set(found["s"]), found["last"], key)
        state.note_closed(self.seq, closing, "matched_id", self.as_of)

    def persisted_to_cdc(self) -> None:
        """The rows this run made active.

        Where the batch's own folder of the store holds them and nothing else, they are read
        from there. Else they are written, from what is at hand, so the store is not read.
        """
        kept = [c for c in self.fresh.columns if c not in ("hash_key", "is_active", "end_date")]
        opened = self.state.opened(self.seq, PERSISTED, self.fresh.select(kept).schema)
        rows = self.fresh.select(kept) if opened is None else opened
        cdc = rows.withColumnRenamed(IDS[PERSISTED], "cdc_record_id")
        self.cdc = self._write("cdc", cdc) if opened is None else cdc

    def cdc_to_stage(self) -> None:
        state, buckets = self.state, self.state.bucket_count
        stage = validate_required(conform(self.cdc, self.spec, self.dims))
        stored = self._write("stage", self._numbered(self._numbered(stage, FACT), ERRORS))

        invalid = ~F.col("is_valid")
        found = stored.agg(
            F.count_if("is_valid").alias("valid"),
            _slots(F.lit(True), buckets).alias("touched"),
            _slots(invalid, buckets).alias("s"),
            F.max(IDS[FACT]).alias("last_fact"),
            F.max(F.when(invalid, F.col(IDS[ERRORS]))).alias("last_error"),
        ).first()
        self.counts["valid_count"] = found["valid"]
        self.touched, self.last_fact = set(found["touched"]), found["last_fact"]
        if found["s"]:
            failing = error_rows(stored, IDS[ERRORS])
            fresh = scd_defaults(failing, self.as_of).select(ERROR_SCHEMA.names)
            self._replace(ERRORS, failing, fresh, set(found["s"]), found["last_error"], F.col(IDENTIFIER))

    def stage_to_fact(self) -> None:
        """Every stage row is appended; a fact its identifier still holds is closed."""
        stored = self._stored("stage")
        fresh = scd_defaults(stored, self.as_of).select(FACT_SCHEMA.names)
        self._replace(FACT, stored, fresh, self.touched, self.last_fact, F.col(IDENTIFIER))

    def _numbered(self, df: DataFrame, table: str) -> DataFrame:
        """New record ids; the frame is written as it is, and read from there by all."""
        return surrogate_key(df, IDS[table], self.before.last_ids.get(table, 0))

    def _replace(
        self,
        table: str,
        closing: DataFrame,
        fresh: DataFrame,
        slots: set[int],
        last_id: int | None,
        key: Column,
    ) -> None:
        self.state.supersede(self.before, self.seq, table, fresh, closing, self.as_of, slots, key)
        for slot in slots:
            self.after.buckets[(table, slot)] = self.seq
        if last_id is not None:
            self.after.last_ids[table] = last_id

    def finalise(self, started: datetime, finished: datetime, trail: list[tuple]) -> None:
        row = {
            "dag_run_id": self.dag_run_id,
            "run_key": self.run_key,
            "source_id": self.source_id,
            "run_start_date": started,
            "source_checkpoint": self.after.source_checkpoint,
            "trail": trail,
            **self.counts,
            **self.after.as_row(),
        }
        known = T.StructType([f for f in COMMIT.fields if f.name in row])
        values = [tuple(row[name] for name in known.names)]
        run = audit.close_counted(self.state.spark.createDataFrame(values, known), finished)
        self.state.publish(run, self.seq, self.run_key)


def _wall_clock() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ingest_batch(
    state: FeedState,
    spec: FeedSpec,
    batch: DataFrame,
    dims: dict[str, DataFrame],
    run_key: str,
    as_of: datetime,
    clock: Callable[[], datetime] = _wall_clock,
) -> BatchResult:
    """Take one batch through every layer and publish the result.

    ``as_of`` stamps every version the batch opens or closes. A batch whose run key was
    published before, by whichever run, is not applied again. An empty batch changes nothing.
    """
    before = state.latest()
    applied = state.published_as(run_key)
    if applied is not None:
        return BatchResult(applied, checkpoint=before.source_checkpoint, replayed=True)
    if batch.isEmpty():
        return BatchResult(0, checkpoint=before.source_checkpoint)

    source = dims["sources"].where(F.col("source_name") == spec.source).first()
    if source is None:
        raise ValueError(f"no source is named {spec.source}")
    run = (source["source_id"], before.seq + 1, run_key)
    stages = _Run(state, spec, dims, before, run, as_of)
    state.clear(stages.seq)
    started = clock()
    steps: list[tuple[str, datetime]] = [(audit.STARTED, started)]
    attempt = state.attempt()
    shown = {"run_key": run_key, "source_id": source["source_id"], "run_start_date": started}

    def note(status: str, ended: datetime) -> None:
        trail = [(s, at, i) for i, (s, at) in enumerate(steps)]
        state.note(attempt, shown | {"dag_run_status": status, "run_end_date": ended, "trail": trail})

    note(audit.STARTED, OPEN_END)
    work = [
        lambda: stages.source_to_landing(batch),
        stages.landing_to_persisted,
        stages.persisted_to_cdc,
        stages.cdc_to_stage,
        stages.stage_to_fact,
    ]

    def publish() -> None:
        finished = clock()
        trail = [(s, at, i) for i, (s, at) in enumerate([*steps, (audit.SUCCESS, finished)])]
        stages.finalise(started, finished, trail)

    for done, stage in enumerate([*work, publish]):
        try:
            stage()
        except Exception as problem:
            trail = audit.run_status_trail(done, failed=True)
            steps.append((trail[-1], clock()))
            note(*steps[-1])
            raise StageFailed(trail[-1], trail) from problem
        if done < len(work):
            steps.append((audit.run_status_trail(done + 1)[done + 1], clock()))
    state.forget(attempt)
    return BatchResult(stages.seq, **stages.counts, checkpoint=stages.after.source_checkpoint)


def scan_since(state: FeedState, initial: int) -> int:
    """Checkpoint to scan from: the last published one, or ``initial`` for a new feed."""
    checkpoint = state.latest().source_checkpoint
    return initial if checkpoint is None else checkpoint


def fact_versions(state: FeedState) -> DataFrame:
    return state.table(state.latest(), FACT, FACT_SCHEMA)


def error_versions(state: FeedState) -> DataFrame:
    return state.table(state.latest(), ERRORS, ERROR_SCHEMA)


def persisted_versions(state: FeedState, spec: FeedSpec) -> DataFrame:
    commit = state.latest()
    landing = state.spark.read.parquet(state.landings(commit)[-1])
    return state.table(commit, PERSISTED, persisted_schema(type_landing(landing, spec)))


def stage_rows(state: FeedState) -> DataFrame:
    """Conformed rows of every published batch, before versioning."""
    columns = T.StructType([f for f in FACT_SCHEMA.fields if f.name not in VERSION_COLUMNS])
    return state.batches(state.latest(), "stage", columns)


def run_log(state: FeedState) -> DataFrame:
    """Every published run, and of each other run key its last try, STARTED or FAILED.

    A run gets its number when it is published. A key that failed and was published later
    is shown as published only.
    """
    published = state.commits().where(F.col("dag_run_status") != REBUCKETED)
    tries = without_match(state.attempts(), published, "run_key")
    newest = F.max_by(F.struct(*ATTEMPT.names), F.struct("run_start_date", F.size("trail")))
    last = tries.groupBy("run_key").agg(newest.alias("t")).select("t.*")
    runs = published.unionByName(last, allowMissingColumns=True)
    return runs.withColumn("run_duration", run_duration()).select(RUN_LOG.names)


def status_trail(state: FeedState) -> DataFrame:
    """Every status of every published run, in order of ``seq``."""
    return state.commits().select("run_key", F.inline("trail"))


def failed_trail(state: FeedState) -> DataFrame:
    """Every status of every try that was not published, with the time the try began."""
    longest = F.max_by("trail", F.size("trail")).alias("trail")
    tries = state.attempts().groupBy("run_key", "run_start_date").agg(longest)
    return tries.select("run_key", "run_start_date", F.inline("trail"))
