import pytest
from messages import deliveries, message_table
from pyspark.sql import functions as F

from notice_lake.functions.keys import surrogate_key
from notice_lake.operators import checks, quality
from notice_lake.operators.layers import DIMENSIONS, dimension, fact, silver
from notice_lake.plans import reports
from notice_lake.schemas import GOLD, NOTICE_FIELDS
from notice_lake.sources.synthetic import irregular, notices


@pytest.fixture(scope="module")
def gold(spark, sf_dir):
    parsed = silver(notices(spark, sf_dir)).cache()
    tables = {name: dimension(parsed, name) for name in DIMENSIONS}
    tables["fact_notices"] = fact(parsed)
    yield tables
    parsed.unpersist()


def test_gold_built_from_one_silver_is_consistent(gold):
    assert checks.primary_key_violations(gold).isEmpty()
    assert checks.foreign_key_violations(gold).isEmpty()
    assert all(r.orphan_keys == 0 and r.orphan_rows == 0 for r in checks.orphan_counts(gold).collect())
    for name, contract in GOLD.items():
        if contract.required:
            table = gold[name]
            assert checks.not_null_violations(table, contract.required, table.columns[:1]).isEmpty()


def test_orphans_carry_their_row_counts(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,)], "k int")
    assert [tuple(r) for r in checks.orphan_keys(child, "k", parent, "k").collect()] == [(1, 2)]


def test_duplicate_deliveries(spark):
    df = deliveries(spark, [(0, 1, 1), (0, 1, 2), (0, 2, 3), (1, 1, 1)])
    assert [tuple(r) for r in checks.duplicate_deliveries(df).collect()] == [("t", 0, 1, 2)]


def test_checks_need_a_table_with_a_contract(spark):
    with pytest.raises(ValueError):
        checks.primary_key_violations({"other": spark.range(1)})


def test_empty_tables(spark):
    empty = silver(message_table(spark, []))
    rows = checks.parse_null_pct(empty).collect()
    assert [r.field for r in rows] == list(NOTICE_FIELDS)
    assert all(r.total == 0 and r.null_pct is None for r in rows)
    counters = reports.parse_quality(empty).first()
    assert tuple(counters) == (0, None, None, None)
    report = quality.expectation_report(empty, quality.NOTICE_EXPECTATIONS).collect()
    assert all((r.passed, r.failed) == (0, 0) for r in report)


def test_consumer_lag_of_an_unread_partition(spark):
    ends = spark.createDataFrame(
        [("t", 0, 5), ("t", 1, 7)], "kafka_topic string, kafka_partition int, end_offset bigint"
    )
    found = checks.consumer_lag(deliveries(spark, [(0, 2, 1), (0, 1, 0)]), ends)
    assert {(r.kafka_partition, r.latest_offset, r.lag) for r in found.collect()} == {(0, 2, 2), (1, None, 7)}


def test_malformed_agrees_with_the_parser(spark, sf_dir):
    messages = irregular(spark, sf_dir)
    by_text = checks.malformed_payloads(messages)
    by_parse = silver(messages, issues=True).filter("parse_issue in ('null payload', 'no known label')")
    columns = ["kafka_topic", "kafka_partition", "kafka_offset"]
    left = by_text.select(*columns, F.col("reason"))
    right = by_parse.select(*columns, F.col("parse_issue").alias("reason"))
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_quarantine_splits_the_input(spark, sf_dir):
    parsed = silver(irregular(spark, sf_dir), issues=True)
    bad, good = quality.quarantined(parsed), quality.accepted(parsed)
    assert bad.count() > 0 and good.count() > 0
    together = bad.drop("parse_issue").unionByName(good)
    assert together.exceptAll(parsed.drop("parse_issue")).isEmpty()
    assert together.count() == parsed.count()


class TestExpect:
    @property
    def rules(self):
        return {"positive": "id > 0", "small": F.col("id") < 3}

    def frame(self, spark):
        return spark.createDataFrame([(0,), (1,), (2,), (3,), (None,)], "id int")

    def test_warn_keeps_rows(self, spark):
        assert quality.expect(self.frame(spark), self.rules).count() == 5

    def test_drop_keeps_rows_meeting_all(self, spark):
        kept = quality.expect(self.frame(spark), self.rules, action="drop")
        assert sorted(r.id for r in kept.collect()) == [1, 2]

    def test_fail_stops(self, spark):
        with pytest.raises(Exception, match="expectation (positive|small) not met"):
            quality.expect(self.frame(spark), self.rules, action="fail").collect()
        fine = self.frame(spark).filter("id in (1, 2)")
        assert quality.expect(fine, self.rules, action="fail").count() == 2

    def test_observed_counts_are_those_before_the_drop(self, spark):
        from pyspark.sql import Observation

        seen = Observation("rules")
        quality.expect(self.frame(spark), self.rules, action="drop", observe=seen).collect()
        assert seen.get == {"rows": 5, "positive": 2, "small": 2}

    def test_report(self, spark):
        rows = quality.expectation_report(self.frame(spark), self.rules).collect()
        assert [tuple(r) for r in rows] == [("positive", 3, 2), ("small", 3, 2)]

    def test_unknown_action(self, spark):
        with pytest.raises(ValueError):
            quality.expect(self.frame(spark), self.rules, action="ignore")


def test_key_collisions_of_the_contract_key(spark):
    """The 32-bit key skips NULLs, so these two dates and times share one."""
    rows = spark.createDataFrame(
        [("a", None), (None, "a"), ("a", None), ("b", "c")], "GRB_DATE string, GRB_TIME string"
    )
    keyed = rows.withColumn("timing_sk", surrogate_key("GRB_DATE", "GRB_TIME"))
    found = checks.key_reuse(keyed, "timing_sk", ["GRB_DATE", "GRB_TIME"]).collect()
    assert [(r.variants, r.row_count) for r in found] == [(2, 3)]


def test_stalled_offsets(spark):
    schema = "kafka_topic string, kafka_partition int, latest_offset long, end_offset long"
    earlier = [("t", 0, 5, 10), ("t", 1, 5, 10), ("t", 2, 9, 10), ("t", 3, None, 4), ("t", 4, None, 4)]
    later = [("t", 0, 5, 12), ("t", 1, 6, 12), ("t", 2, 9, 10), ("t", 3, None, 5), ("t", 4, 3, 5), ("t", 5, None, 2)]
    found = checks.stalled_offsets(spark.createDataFrame(earlier, schema), spark.createDataFrame(later, schema))
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(0, 5, 12, 2), (3, None, 5, 1), (5, None, 2, 2)]
