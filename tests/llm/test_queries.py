"""The registered queries next to their SQL, and the pipeline next to plain Python."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from tests.llm.test_operators import linked_pages
from tidemark.llm.common import table
from tidemark.llm.queries import ORACLES, QUERIES
from verify import compare, connect

DATA = "/root/testdata/sf0.001"
NATIVE = ("op4_line_dedup", "op6_personal_data", "op10_url_verdicts")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_next_to_its_sql(spark, con, name):
    verdict, _ = compare(spark, con, DATA, name)
    assert verdict.startswith("ok"), verdict


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_point.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_linked_pages_next_to_their_sql(spark, tmp_path):
    path = tmp_path / "pages.parquet"
    linked_pages(spark).toPandas().to_parquet(path)
    verdict, _ = compare(spark, connect(str(tmp_path)), str(tmp_path), "op10_url_verdicts")
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_pipeline_stages(spark, tmp_path):
    docs, columns = table(spark, DATA, "documents"), None
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        columns = columns or docs.columns
        assert out.columns == columns
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        rows = {r.doc_id: r for r in docs.collect()}
        assert rows and all(before[i] == r for i, r in rows.items()) and docs.count() == len(rows)
        before = rows
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in last} == set(before)
    got = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, last))


CLASHES = ("_id", "_id_", "_at", "best", "row", "shard", "slot", "place", "first", "pos", "key", "size", "label", "score", "kept")


def test_stages_bear_clashing_columns(spark, tmp_path):
    docs = table(spark, DATA, "documents").limit(60).withColumns({n: F.lit(n) for n in CLASHES})
    docs = docs.unionByName(docs.limit(2)).unionByName(docs.limit(1).withColumns({c: F.lit(None).cast(t) for c, t in docs.dtypes}))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert last.count() == docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), DATA).count() == 0


def shards_of(spark, docs, folder, weights, monkeypatch):
    """doc_ids by shard and slot after the last two stages, and the order that was written."""
    whole = corpus_pipeline.mix
    monkeypatch.setattr(corpus_pipeline, "mix", lambda docs: whole(docs, weights))
    corpus_pipeline.mixing(spark, docs, DATA).write.parquet(str(folder / "mixed"))
    monkeypatch.setattr(corpus_pipeline, "mix", whole)
    mixed = spark.read.parquet(str(folder / "mixed"))
    order = [r.doc_id for p in sorted((folder / "mixed").glob("part-*.parquet")) for r in spark.read.parquet(str(p)).collect()]
    sharded = corpus_pipeline.sharding(spark, mixed, DATA).orderBy("shard", "slot").collect()
    return sharded, order


def test_the_mix_is_seen_in_the_shards(spark, tmp_path, monkeypatch):
    rows = [(i, f"text {i} " + "x" * (i % 13), f"s{i % 3}") for i in range(240)]
    rows += [(1000 + i, "the same", "s0") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    text, found = {r[0]: r[1] for r in rows}, []
    for n, weights in enumerate(({"s0": 6, "s1": 3, "s2": 1}, {"s0": 1, "s1": 3, "s2": 6})):
        (tmp_path / str(n)).mkdir()
        sharded, order = shards_of(spark, docs, tmp_path / str(n), weights, monkeypatch)
        # Equal texts stand at the place of the first; all else is the order of the mix.
        first = {}
        for place, i in enumerate(order):
            first.setdefault(text[i], place)
        assert [r.doc_id for r in sharded] == sorted(order, key=lambda i: (first[text[i]], order.index(i)))
        sizes = [sum(r.size for r in sharded if r.shard == s) for s in range(corpus_pipeline.SHARDS)]
        assert max(sizes) - min(sizes) <= 2 * max(len(t) + 1 for t in text.values()) * 5
        found.append([r.doc_id for r in sharded])
    assert found[0] != found[1] and sorted(found[0]) == sorted(found[1]) == sorted(text)
