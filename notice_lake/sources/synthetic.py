"""Test notices made by Spark from the ``events`` table, one per event.

The SQL texts run unchanged in Spark and in DuckDB, so both engines start from
the same messages. Values are invented; they show every trait the parser must
handle. ``{events}`` stands for the table to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NOTICES = """
SELECT
  CAST(user_id AS STRING) AS kafka_key,
  CASE WHEN event_id % 50 = 49 THEN NULL ELSE concat(
    'TITLE:            SYNTHETIC BURST NOTICE',
    chr(10), 'NOTICE_DATE:      ', substr(CAST(ts AS STRING), 1, 19), ' UT',
    chr(10), 'NOTICE_TYPE:      Synthetic burst ', event_type,
    chr(10), 'RECORD_NUM:       ', CAST(event_id % 97 AS STRING),
    CASE WHEN event_id % 50 = 7 THEN ''
         ELSE concat(chr(10), 'TRIGGER_NUM:      ', CAST(700000000 + user_id AS STRING)) END,
    chr(10), 'GRB_RA:           ', CAST((user_id * 7) % 360 AS STRING), '.250d (J2000),',
    chr(10), '                  ', CAST((user_id * 7) % 360 AS STRING), '.500d (current)',
    chr(10), 'GRB_DEC:          ', CASE WHEN user_id % 2 = 0 THEN '-' ELSE '+' END,
                                   CAST(user_id % 90 AS STRING), '.125d (J2000)',
    chr(10), 'GRB_ERROR:', CASE WHEN event_id % 50 = 11 THEN '   unknown [deg radius]'
                                WHEN event_id % 50 = 12 THEN '   '
                                ELSE concat(chr(160), '  ', CAST(event_id % 23 AS STRING),
                                            '.5 [deg radius, statistical only]') END,
    chr(10), 'GRB_DATE:         ', substr(CAST(ts AS STRING), 1, 10),
    chr(10), 'GRB_TIME:         ', substr(CAST(ts AS STRING), 12, 5), ':00 UT',
    chr(10), 'GRB_PHI:          ', CAST(event_id % 360 AS STRING), '.00 [deg]',
    chr(10), 'GRB_THETA:        ', CAST(event_id % 180 AS STRING), '.00 [deg]',
    chr(10), 'E_RANGE:          44.032 - 279.965 [keV]',
    chr(10), 'LOC_ALGORITHM:    ', CAST(4173 + event_id % 3 AS STRING), ' (version number of)',
    chr(10), 'SUN_POSTN:        ', CAST(event_id % 12 AS STRING), '.00d',
    chr(10), 'SUN_DIST:         ', CAST(event_id % 180 AS STRING), '.25 [deg]',
    chr(10), 'MOON_POSTN:       ', CAST(event_id % 28 AS STRING), '.00d',
    chr(10), 'MOON_DIST:        ', CAST(event_id % 175 AS STRING), '.75 [deg]',
    chr(10), 'MOON_ILLUM:       ', CAST(event_id % 100 AS STRING), ' [%]',
    chr(10), 'GAL_COORDS:       ', CAST(user_id % 360 AS STRING), '.10, ',
                                   CAST(user_id % 90 AS STRING), '.20 [deg]',
    chr(10), 'ECL_COORDS:       ', CAST(user_id % 360 AS STRING), '.30, ',
                                   CAST(user_id % 90 AS STRING), '.40 [deg]',
    chr(10), 'LC_URL:           http://example.org/lc/', CAST(event_id AS STRING), '.gif',
    chr(10), 'LOC_URL:          http://example.org/loc/', CAST(event_id AS STRING), '.fit',
    chr(10), 'COMMENTS:         first comment.',
    chr(10), 'COMMENTS:         second comment.',
    chr(10), 'COMMENTS:         third comment.') END AS kafka_value,
  'notices.synthetic' AS kafka_topic,
  CAST(event_id % 4 AS INT) AS kafka_partition,
  CAST(floor(event_id / 4) AS BIGINT) AS kafka_offset,
  ts AS kafka_timestamp
FROM {events}
"""

# The same feed after a bad day: some messages lost, some delivered twice, some
# stamped two days early. Every check finds something in it.
DAMAGED = """
SELECT kafka_key, kafka_value, kafka_topic, kafka_partition, kafka_offset,
       CASE WHEN (kafka_offset * 4 + kafka_partition) % 107 = 0
            THEN kafka_timestamp - INTERVAL '2' DAY ELSE kafka_timestamp END AS kafka_timestamp
FROM {notices} WHERE (kafka_offset * 4 + kafka_partition) % 101 <> 0
UNION ALL
SELECT kafka_key, kafka_value, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
FROM {notices} WHERE (kafka_offset * 4 + kafka_partition) % 103 = 0
"""

# Texts that break naive parsers: CRLF line ends, a label repeated out of sequence,
# forty comment lines in a row, no labels at all, blank comments, unknown labels, a
# label-like line in mixed case, leading blank lines, an indented first label, a second
# run of comments.
IRREGULAR = """
SELECT kafka_key,
  CASE (kafka_offset * 4 + kafka_partition) % 13
    WHEN 0 THEN replace(kafka_value, chr(10), chr(13) || chr(10))
    WHEN 1 THEN kafka_value || chr(10) || 'TITLE: second title'
    WHEN 2 THEN kafka_value || repeat(chr(10) || 'COMMENTS: more', 40)
    WHEN 3 THEN 'free text ' || kafka_key || chr(10) || 'without any label'
    WHEN 4 THEN kafka_value || chr(10) || 'COMMENTS:' || chr(10) || 'COMMENTS: last'
    WHEN 5 THEN kafka_value || chr(10) || 'FOO_BAR: extra ' || kafka_key || chr(10) || 'SIGNAL: a:b'
    WHEN 6 THEN kafka_value || chr(10) || 'Lowercase: goes on'
    WHEN 7 THEN kafka_value || chr(10) || 'COMMENTS:' || chr(10) || 'BACKGROUND: 5'
    WHEN 8 THEN chr(10) || chr(10) || kafka_value
    WHEN 9 THEN ' ABOVE: all' || chr(10) || kafka_value
    WHEN 10 THEN kafka_value || chr(10) || 'ODD_ONE: x' || chr(10) || 'COMMENTS: second run'
    ELSE kafka_value END AS kafka_value,
  kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
FROM {notices}
"""

# Dates with a month name and Sun and Moon positions with both coordinates, in every second
# message.
SHAPED = """
SELECT kafka_key,
  CASE WHEN kafka_offset % 2 = 0 THEN kafka_value ELSE
    replace(replace(kafka_value, '.00d', '.00d {{+06h 05m 05s}}  -23.42d {{-23d 25m 14s}}'),
      'NOTICE_DATE:      ' || substr(CAST(kafka_timestamp AS STRING), 1, 19),
      'NOTICE_DATE:      Sun ' || substr(CAST(kafka_timestamp AS STRING), 9, 2) || ' '
        || substr('JanFebMarAprMayJunJulAugSepOctNovDec',
                  CAST(substr(CAST(kafka_timestamp AS STRING), 6, 2) AS INT) * 3 - 2, 3) || ' '
        || substr(CAST(kafka_timestamp AS STRING), 3, 2) || ' '
        || substr(CAST(kafka_timestamp AS STRING), 12, 8)) END AS kafka_value,
  kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
FROM {notices}
"""


_EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dealt(spark.read.parquet(f"{sf_dir}/events.parquet").select(*_EVENT_COLUMNS))


def _dealt(table: DataFrame) -> DataFrame:
    """Events over the tasks of a shuffle, before they grow.

    A stored event takes some 20 bytes and becomes a text of 1.4 KB, so files that are one task's share of events hold
    many times one task's share of texts, and a file of one row group is one task at any size.
    """
    return table.repartition("event_id", "ts")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File stream over ``events``, one file or a folder.

    A file stream takes a folder or a pattern; this pattern fits the one path that ``events`` reads.
    """
    schema = events(spark, sf_dir).schema
    return _dealt(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def notices_from(table: DataFrame) -> DataFrame:
    """Bronze-shaped notices from an events DataFrame, batch or stream."""
    return table.sparkSession.sql(NOTICES, events=table)


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices_from(events(spark, sf_dir))


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DAMAGED, notices=notices(spark, sf_dir))


def irregular_from(table: DataFrame) -> DataFrame:
    return table.sparkSession.sql(IRREGULAR, notices=notices_from(table))


def irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    return irregular_from(events(spark, sf_dir))


def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SHAPED, notices=notices(spark, sf_dir))


def kafka_shaped(table: DataFrame) -> DataFrame:
    """Notices back in the column shape of the Kafka connector, with binary key and value."""
    return table.selectExpr(
        "CAST(kafka_key AS BINARY) AS key",
        "CAST(kafka_value AS BINARY) AS value",
        "kafka_topic AS topic",
        "kafka_partition AS partition",
        "kafka_offset AS offset",
        "kafka_timestamp AS timestamp",
        "0 AS timestampType",
    )
