"""Every registered query against its SQL twin on the smallest given tables."""

from pathlib import Path

import pytest

duckdb = pytest.importorskip("duckdb")

from broadsheet.plans.catalog import REGISTRY  # noqa: E402
from broadsheet.plans.oracle import ORACLE  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables not present")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def test_every_twin_belongs_to_a_query():
    assert set(ORACLE) <= set(REGISTRY)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, duck, name):
    df = REGISTRY[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for costly in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
        assert costly not in plan
    names = sorted(df.columns)
    got = sorted(repr(tuple(r[n] for n in names)) for r in df.collect())
    assert got
    if name not in ORACLE:
        return
    twin = duck.sql(ORACLE[name])
    types = {n: str(t) for n, t in zip(twin.columns, twin.types, strict=True)}
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    expected = [dict(zip(twin.columns, row, strict=True)) for row in twin.fetchall()]
    assert got == sorted(repr(tuple(r[n] for n in names)) for r in expected)


@pytest.mark.parametrize("name", ["by_keyword", "records_union", "index_rebuild", "positional_rank"])
def test_sources_never_shuffle_the_records(spark, name):
    """The source dimension is broadcast after a check of its size, in any session."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = REGISTRY[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin" in plan
    for line in plan.splitlines():
        assert not ("hashpartitioning(source_id" in line), line
