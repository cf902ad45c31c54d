"""Reports kept by streams against recomputation: aggregates by levels, null shares with a watermark."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from notice_lake.operators.layers import fact, silver
from notice_lake.plans import reports
from notice_lake.schemas import BRONZE
from notice_lake.sources.synthetic import notices
from notice_lake.sources.tables import read_files
from notice_lake.streaming import fan_out, maintained, null_shares, segments
from notice_lake.streaming.hops import append_to_files

CASTS = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in BRONZE]


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_reports_equal_recomputation_after_many_batches_and_a_retry(spark, sf_dir, tmp_path):
    batches, out = 10, str(tmp_path / "out")
    messages = notices(spark, sf_dir).selectExpr(*CASTS).withColumn("_k", F.pmod("kafka_offset", F.lit(batches))).cache()
    parts = {"silver": silver(messages), "bronze": messages}
    parts["fact_notices"] = fact(parts["silver"])
    some = {t: df.withColumn("_k", F.pmod("kafka_offset", F.lit(batches))) for t, df in parts.items()}
    names = ["accuracy_by_algorithm", "activity_by_partition", "latest_by_partition", "parse_quality"]
    tables = {t: df.cache() for t, df in some.items()}
    for k in range(batches):
        for _ in range(2 if k in (5, 7) else 1):  # 7 completes a segment of level 1
            for name in names:
                report = maintained.REPORTS[name]
                maintained.add(tables[report.table].where(F.col("_k") == k), f"{out}/reports/{name}", report, k)
    fan_out.commit(spark, out, batches - 1)
    expected = {
        "accuracy_by_algorithm": reports.accuracy_by_algorithm(tables["fact_notices"]),
        "activity_by_partition": reports.activity_by_partition(tables["fact_notices"]),
        "latest_by_partition": reports.latest_by_partition(messages),
        "parse_quality": reports.parse_quality(tables["silver"]),
    }
    for name in names:
        found = fan_out.read_report(spark, out, name)
        assert found.columns == expected[name].columns
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in expected[name].collect()] or bag(found) == bag(expected[name])
        folders = {f.rsplit("/", 1)[0] for f in found.inputFiles()}
        assert len(folders) == len(segments.covering(batches)) == 3
    for df in (*tables.values(), messages):
        df.unpersist()


def test_reports_of_a_fan_out_survive_a_lost_batch(spark, sf_dir, tmp_path, monkeypatch):
    folder, out = tmp_path / "inbox", str(tmp_path / "out")
    messages = notices(spark, sf_dir).selectExpr(*CASTS)
    for k in range(2):
        messages.where(f"kafka_offset % 2 = {k}").coalesce(1).write.mode("append").parquet(str(folder))

    def go():
        stream = read_files(spark, str(folder), schema=BRONZE, streaming=True, max_files_per_trigger=1)
        return fan_out.start_fan_out(stream, out, str(tmp_path / "checkpoint"), keep_reports=True)

    with pytest.raises(ValueError, match="no batch"):
        fan_out.read_report(spark, out, "parse_quality")
    monkeypatch.setattr(fan_out, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        go().awaitTermination()
    monkeypatch.undo()
    run(go())
    parsed = silver(messages)
    assert bag(fan_out.read_report(spark, out, "parse_quality")) == bag(reports.parse_quality(parsed))
    assert bag(fan_out.read_report(spark, out, "accuracy_by_algorithm")) == bag(reports.accuracy_by_algorithm(fact(parsed)))
    for layer in ("bronze", "silver", "fact_notices"):
        assert bag(fan_out.read_report(spark, out, f"rows_of_{layer}")) == Counter({(layer, messages.count()): 1})


def test_merging_does_not_depend_on_how_rows_are_dealt(spark, tmp_path):
    """Empty batches, null keys and null values included."""
    report = maintained.Report("t", {"k": "k"}, {"n": ("count(*)", "sum"), "least": ("min(v)", "min"), "most": ("max(v)", "max")})
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *range(9)])) for _ in range(200)]
    table = spark.createDataFrame(rows, "k string, v int")
    for width, cuts in ((1, [0, 200]), (9, [0, 0, 5, 5, 60, 61, 61, 150, 199, 200])):
        folder = str(tmp_path / f"cuts{width}")
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            maintained.add(spark.createDataFrame(rows[a:b], table.schema), folder, report, k)
        found = maintained.read(spark, folder, report, len(cuts) - 1)
        assert bag(found) == bag(maintained.partial(table, report))


NOON = datetime(2024, 5, 1, 12)


def late_feed(seed, n):
    """Batches of a clock that goes on by half an hour, with rows up to five hours behind it and some without time."""
    rng = random.Random(seed)
    batches = []
    for k in range(n):
        rows = []
        for _ in range(30):
            back = rng.choice([0, 10, 50, 100, 300])
            at = None if rng.random() < 0.05 else NOON + timedelta(minutes=30 * k - back, microseconds=rng.randrange(10**6))
            rows.append((at, rng.choice(["x", None]), rng.choice(["y", "", None])))
        batches.append(rows)
    return batches


def plain_shares(batches, wait):
    counts, newest = {}, None
    for rows in batches:
        line = None if newest is None else newest - wait
        for at, a, b in rows:
            start = at and at.replace(minute=0, second=0, microsecond=0)
            late = bool(at and line and start + timedelta(hours=1) <= line)
            total = counts.setdefault(start, [0, 0, 0, 0])
            total[1] += late
            if not late:
                total[0] += 1
                total[2] += a is None
                total[3] += b is None
        newest = max([at for at, *_ in rows if at] + ([newest] if newest else []), default=None)
    return counts, newest - wait


@pytest.mark.parametrize("clock", ["timestamp", "timestamp_ntz"])
def test_null_shares_and_late_rows_equal_a_plain_version(spark, tmp_path, clock, session_conf):
    session_conf("spark.sql.session.timeZone", "America/Los_Angeles" if clock == "timestamp_ntz" else "UTC")
    batches, wait = late_feed(1, 10), timedelta(hours=1)
    out = str(tmp_path / "out")
    for k, rows in enumerate(batches):
        df = spark.createDataFrame([(str(at) if at else None, a, b) for at, a, b in rows], "at string, a string, b string")
        df = df.select(F.col("at").cast(clock).alias("kafka_timestamp"), "a", "b")
        for _ in range(2 if k in (4, 7) else 1):
            null_shares.write_batch(df, k, folder=out, fields=("a", "b"), unit="HOUR", wait="1 HOUR")
    counts, line = plain_shares(batches, wait)
    text = F.col("window_start").cast("string").alias("window_start")
    windows = null_shares.read_windows(spark, out, fields=("a", "b")).withColumn("window_start", text)
    expected = {(s and str(s), c[0], c[1], bool(s and s + timedelta(hours=1) <= line)) for s, c in counts.items()}
    assert {tuple(r) for r in windows.collect()} == expected
    assert any(c[1] for c in counts.values()) and any(r[3] for r in expected)
    shares = null_shares.read_null_shares(spark, out, fields=("a", "b")).withColumn("window_start", text)
    expected = {
        (s and str(s), f, c[0], c[i], round(100 * c[i] / c[0], 4) if c[0] else None)
        for s, c in counts.items() for f, i in (("a", 2), ("b", 3))
    }
    assert {tuple(r) for r in shares.collect()} == expected


def test_closed_windows_equal_those_of_the_engine(spark, tmp_path, session_conf):
    """The same files through Spark's own watermark and windows: equal rows per closed window, late rows dropped alike."""
    # One watermark for late rows and for closing; chained operators get that of the batch before for late rows.
    session_conf("spark.sql.streaming.statefulOperator.allowMultiple", "false")
    inbox, out = tmp_path / "inbox", str(tmp_path / "out")
    schema = "kafka_timestamp timestamp, a string, b string"
    for k, rows in enumerate(late_feed(2, 6)):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(inbox))
    stream = read_files(spark, str(inbox), schema=spark.createDataFrame([], schema).schema, streaming=True, max_files_per_trigger=1)
    run(null_shares.start_null_shares(stream, out, str(tmp_path / "c1"), fields=("a", "b")))
    counted = (
        stream.withWatermark("kafka_timestamp", "1 hour").groupBy(F.window("kafka_timestamp", "1 hour"))
        .agg(F.count("*").alias("total")).select(F.col("window.start").alias("window_start"), "total")
    )
    run(append_to_files(counted, str(tmp_path / "engine"), str(tmp_path / "c2")))
    ours = null_shares.read_windows(spark, out, fields=("a", "b")).where("closed AND total > 0").select("window_start", "total")
    assert bag(ours) == bag(spark.read.parquet(str(tmp_path / "engine")))
    assert ours.count() > 2


def test_unknown_unit_is_refused():
    with pytest.raises(ValueError, match="unit"):
        null_shares.report(("a",), "WEEK")
