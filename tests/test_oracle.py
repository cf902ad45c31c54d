"""Every registered query against its SQL, run by another engine on the same files."""

import compare
import pytest
from messages import executed_of

import __spark_entry__ as entry_points
from notice_lake.registry.oracle import ORACLE
from notice_lake.registry.queries import QUERIES

# No Python workers, no pairing of everything with everything.
NOT_WANTED = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin")

# None may be found: two dates and times with one 32-bit key are rare.
MAY_BE_EMPTY = {"key_collisions"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = compare.connect(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = compare.duck_bag(duck, ORACLE[name])
    assert sorted(df.columns) == sorted(columns)
    found = compare.spark_bag(df)
    assert found == expected
    assert found or name in MAY_BE_EMPTY
    plan = executed_of(df)
    for operator in NOT_WANTED:
        assert operator not in plan


def test_every_sql_has_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(ORACLE) <= set(entry_points.oracle_sql())
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert [r.notices for r in rows] == sorted((r.notices for r in rows), reverse=True)
    assert sum(r.notices for r in rows) == 940


@pytest.mark.parametrize("name", ["silver_notices", "typed_notices", "late_messages"])
def test_results_do_not_depend_on_the_session_zone(spark, duck, sf_dir, session_conf, name):
    session_conf("spark.sql.session.timeZone", "America/Los_Angeles")
    found = compare.spark_bag(QUERIES[name](spark, sf_dir))
    assert found == compare.duck_bag(duck, ORACLE[name])[1]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("name", ["fact_notices", "silver_irregular"])
def test_results_do_not_depend_on_ansi_mode(spark, duck, sf_dir, session_conf, name, ansi):
    session_conf("spark.sql.ansi.enabled", ansi)
    found = compare.spark_bag(QUERIES[name](spark, sf_dir))
    assert found == compare.duck_bag(duck, ORACLE[name])[1]
