"""History and KPIs kept up batch by batch, next to the whole computation."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_versions import log_of
from tidemark.operators import kpi_state, reporting
from tidemark.operators.history import history_from_changes, history_increment, redone_versions, stale_versions
from tidemark.operators.versions import active_of, delta_since

START = datetime(2026, 1, 1)
# The tables that keep a history of their rows, and their keys.
TABLES = {
    "sources": "source_id",
    "customer_types": "customer_type_id",
    "support_areas": "support_area_id",
    "agents": "agent_id",
    "layers": "layer_id",
    "load_strategies": "load_strategy_id",
    "table_catalog": "table_id",
    "field_dictionary": "field_id",
    "dag_runs": "dag_run_id",
}


def changes_of(spark, seed, key, n=120):
    """Changes with ties in time, several operations a key, and one busy key."""
    rng = random.Random(seed)
    rows = [
        (rng.choice([1, 1, 1, 2, 3, rng.randint(4, 9)]), rng.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]),
         START + timedelta(seconds=rng.randint(0, 300)), seq, f"v{seq}")
        for seq in range(n)
    ]
    return spark.createDataFrame(rows, f"{key} bigint, op string, op_ts timestamp_ntz, seq bigint, name string")


def plain(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("table", sorted(TABLES))
def test_two_batches_equal_one_run(spark, table):
    key = TABLES[table]
    changes = changes_of(spark, len(table), key)
    whole = history_from_changes(changes, key)
    late = F.pmod(F.xxhash64("seq", F.lit(table)), F.lit(3)) == 0
    first = history_from_changes(changes.where(~late), key)
    assert plain(history_increment(first, changes.where(late), key).select(whole.columns)) == plain(whole)


def test_changes_in_order_touch_open_versions_only(spark):
    changes = changes_of(spark, 5, "k")
    edge = F.lit(START + timedelta(seconds=200))
    first = history_from_changes(changes.where(F.col("op_ts") < edge), "k")
    new = changes.where(F.col("op_ts") >= edge)
    stale = stale_versions(first, new, "k")
    assert 0 < stale.count() <= 9 and stale.where("NOT is_active").count() == 0
    assert redone_versions(first, new, "k").count() == stale.count() + new.count()


def test_nothing_new_and_nothing_old(spark):
    changes = changes_of(spark, 6, "k")
    whole, none = history_from_changes(changes, "k"), changes.limit(0)
    assert plain(history_increment(whole, none, "k")) == plain(whole)
    assert plain(history_increment(history_from_changes(none, "k"), changes, "k")) == plain(whole)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_a_delta_leads_from_one_state_to_the_next(spark, seed):
    rows = [(k, r, START + timedelta(days=r), v) for k, r, v in log_of(seed)]
    log = spark.createDataFrame(rows, "version_key string, dag_run_id bigint, start_date timestamp_ntz, v int")
    shown = ["version_key", "dag_run_id", "v"]
    for since in (0, 3, 7):
        opened, closed = delta_since(log, since)
        before = plain(active_of(log.where(F.col("dag_run_id") <= since)).select(shown).fillna("-"))
        for row in plain(closed.select(shown).fillna("-")):
            before.remove(row)
        assert sorted(before + plain(opened.select(shown).fillna("-"))) == plain(active_of(log).select(shown).fillna("-"))


VIEW = (
    "interaction_date timestamp_ntz, pseudo_code string, query_status string, customer_type_name string,"
    " support_area_name string, first_contact_resolution boolean, handle_time int, customer_rating int"
)


def interactions(seed, n):
    rng = random.Random(seed)
    return [
        (START + timedelta(hours=rng.randint(0, 90)), rng.choice(["JDOE", "ASMITH", None]), rng.choice(["OPEN", "DONE"]),
         rng.choice(["PRIME", None]), rng.choice(["ORDERS", "BILLS"]), rng.choice([True, False, None]),
         rng.choice([None, rng.randint(0, 2_000_000_000)]), rng.choice([None, 1, 5]))
        for _ in range(n)
    ]


def test_a_state_follows_updates_and_deletes(spark):
    now, rng = interactions(1, 80), random.Random(2)
    state = kpi_state.interaction_state(spark.createDataFrame(now, VIEW))
    for batch in range(3):
        gone = [now.pop(rng.randrange(len(now))) for _ in range(25)]
        come = interactions(10 + batch, 12)
        now += come
        state = kpi_state.fold(state, spark.createDataFrame(come, VIEW), spark.createDataFrame(gone, VIEW))
    view = spark.createDataFrame(now, VIEW)
    assert plain(kpi_state.interaction_state(view).na.fill("-")) == plain(state.na.fill("-"))
    assert kpi_state.kpi_interactions(state).first() == reporting.kpi_interactions(view).first()
    for whole, groups in (
        (reporting.query_status_counts, ["query_status"]),
        (reporting.interactions_per_agent, ["pseudo_code"]),
        (reporting.interactions_by_type_area, ["customer_type_name", "support_area_name"]),
        (reporting.interaction_volume_over_time, ["interaction_day"]),
    ):
        assert plain(kpi_state.interactions_by(state, *groups).na.fill("-")) == plain(whole(view).na.fill("-"))
    rest = spark.createDataFrame(now, VIEW)
    assert kpi_state.fold(state, rest.limit(0), rest).count() == 0
