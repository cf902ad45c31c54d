import pytest
from messages import message_table
from pyspark.sql import functions as F

from notice_lake.functions import notice_text as nt
from notice_lake.operators.layers import fact, silver
from notice_lake.schemas import NOTICE_FIELDS

NBSP = "\u00a0"


def parse(spark, text, **options):
    return silver(message_table(spark, [text]), **options).first()


@pytest.fixture(scope="module")
def parse_all(spark):
    """Parse many texts in one job: rows of silver and fact per text."""

    def run(texts):
        messages = message_table(spark, texts)
        parsed = silver(messages, issues=True).orderBy("kafka_offset").collect()
        measured = fact(silver(messages)).orderBy("kafka_offset").collect()
        return dict(zip(texts, zip(parsed, measured)))

    return run


def comments(n, text="i"):
    return "TITLE: t" + f"\nCOMMENTS: {text}" * n


EDGE_TEXTS = [
    ("TITLE: t\nCOMMENTS: a\nCOMMENTS: b", {"TITLE": "t", "COMMENTS": "a b"}),
    (comments(32), {"COMMENTS": " ".join("i" * 32)}),
    (comments(33), {"COMMENTS": " ".join("i" * 33)}),
    ("TITLE: t\nCOMMENTS: a\nCOMMENTS:\nLC_URL: u", {"COMMENTS": "a", "LC_URL": "u"}),
    ("TITLE: t\nCOMMENTS: a\nCOMMENTS:\nCOMMENTS: b", {"COMMENTS": "a b"}),
    ("TITLE: t\nCOMMENTS:\nCOMMENTS:  \nCOMMENTS: b", {"COMMENTS": "b"}),
    ("COMMENTS: a\nCOMMENTS: b", {"COMMENTS": "a b"}),
    ("TITLE: t\nCOMMENTS: a \n more\nCOMMENTS: b", {"COMMENTS": "a   more b"}),
    ("TITLE: t\nCOMMENTS:", {"COMMENTS": ""}),
    ("TITLE: t\nGRB_RA: 1\nTITLE: u", {"TITLE": "t", "GRB_RA": "1"}),
    ("GRB_TIME: 12:30:00 UT", {"GRB_TIME": "12:30:00 UT"}),
    ("GRB_RA: 1\n   2", {"GRB_RA": "1    2"}),
    ("GRB_RA: 1\nGRB_INTEN2: 5", {"GRB_RA": "1 GRB_INTEN2: 5"}),
    ("TITLE: t\n GRB_RA: 1", {"TITLE": "t  GRB_RA: 1", "GRB_RA": None}),
    ("TITLE: t\nFOO: x", {"TITLE": "t"}),
    ("TITLE: t\nGRB_ERROR:", {"GRB_ERROR": ""}),
    ("TITLE: t\r\nGRB_RA: 1\r", {"TITLE": "t", "GRB_RA": "1"}),
    ("TITLE: a\rb\r\nGRB_RA: 1", {"TITLE": "a\rb", "GRB_RA": "1"}),
    ("\n\nTITLE: t", {"TITLE": "t"}),
    (f"TITLE:{NBSP}t{NBSP}u", {"TITLE": "t u"}),
    ("TITLE", {"TITLE": None}),
    ("TITLE: t\n\tx", {"TITLE": "t \tx"}),
    ("", {"TITLE": None}),
]


def test_edge_texts(parse_all):
    rows = parse_all([text for text, _ in EDGE_TEXTS])
    for text, expected in EDGE_TEXTS:
        row = rows[text][0]
        assert {name: row[name] for name in expected} == expected, text
        absent = [n for n in NOTICE_FIELDS if f"{n}:" not in text]
        assert all(row[n] is None for n in absent), text


def test_null_payload_gives_null_fields_and_is_flagged(spark):
    row = parse(spark, None, issues=True)
    assert all(row[n] is None for n in NOTICE_FIELDS)
    assert row.parse_issue == "null payload"


def test_issues(parse_all):
    issues = {
        "TITLE: t\nCOMMENTS: a\nCOMMENTS: b": None,
        "COMMENTS: a\nCOMMENTS: b": None,
        "TITLE: t\nGRB_RA: 1\nTITLE: u": "repeated label",
        "TITLE: t\nCOMMENTS: a\nGRB_RA: 1\nCOMMENTS: b": "repeated label",
        "no label at all": "no known label",
        "FOO: x": "no known label",
        "": "no known label",
    }
    rows = parse_all(list(issues))
    assert {text: row.parse_issue for text, (row, _) in rows.items()} == issues


def test_very_long_runs_and_texts_are_taken_whole(spark):
    row = parse(spark, comments(20_000, "x" * 20) + "\n" + "y" * 100_000, issues=True)
    assert len(row.COMMENTS) == 20_000 * 21 - 1 + 1 + 100_000
    assert row.parse_issue is None


def entries(row):
    return [tuple(e) for e in row.rescued_fields]


RESCUED = {
    "TITLE: t\nFOO: x\nBAR:\nFOO: again\nSIGNAL: a:b\n c": [
        ("FOO", "x"), ("BAR", ""), ("FOO", "again"), ("SIGNAL", "a:b  c"),
    ],
    "odd start: 1\nTITLE: t": [("odd start", "1")],
    "TITLE: t": [],
    " FOO: a\nFOO: b": [("FOO", "a"), ("FOO", "b")],
    "TITLE: one\nCOMMENTS: a\nGRB_RA: 1\nCOMMENTS: b\nTITLE: two": [("COMMENTS", "b"), ("TITLE", "two")],
    "free text\nTITLE: t": [("", "free text")],
    " TITLE: t\nGRB_RA: 1": [("TITLE", "t")],
    "\n\nTITLE: t\nCOMMENTS: a\nCOMMENTS: b": [],
    "": [],
}


def test_rescued_entries_hold_whatever_no_column_does(spark):
    rows = silver(message_table(spark, list(RESCUED)), rescued=True).orderBy("kafka_offset").collect()
    assert {text: entries(row) for text, row in zip(RESCUED, rows)} == RESCUED
    assert parse(spark, None, rescued=True).rescued_fields is None


def test_evidence_is_kept_for_messages_with_an_issue_only(spark):
    bad = parse(spark, "TITLE: a\n b\nTITLE: c", evidence=True)
    assert bad.parse_issue == "repeated label" and bad.kafka_value == "TITLE: a\n b\nTITLE: c"
    assert bad.single_line_text == "TITLE: a  b\nTITLE: c" and entries(bad) == [("TITLE", "c")]
    good = parse(spark, "TITLE: a\nFOO: x", evidence=True)
    assert (good.parse_issue, good.kafka_value, good.single_line_text, good.rescued_fields) == (None,) * 4


def test_kept_text_is_one_line_per_label(spark):
    text = "TITLE: t\n wrapped\nCOMMENTS: a\nCOMMENTS: b\nLC_URL: u"
    kept = parse(spark, text, keep_text=True).single_line_text
    assert kept == "TITLE: t  wrapped\nCOMMENTS: a b\nLC_URL: u"
    assert parse(spark, "COMMENTS: a\nCOMMENTS: b", keep_text=True).single_line_text == "COMMENTS: a b"
    assert parse(spark, "TITLE: t", keep_text=True).single_line_text == "TITLE: t"
    assert parse(spark, None, keep_text=True).single_line_text is None


def test_label_pattern_is_a_parameter(spark):
    text = "TITLE: t\nGRB_INTEN2: 5"
    row = parse(spark, text, label="[A-Z0-9_]+", rescued=True)
    assert row.TITLE == "t"
    assert entries(row) == [("GRB_INTEN2", "5")]


def test_strip_label_mode(spark):
    row = parse(spark, "TITLE: t\nLC_URL: u\nCOMMENTS: a\nCOMMENTS: b", comments="strip_label")
    assert (row.LC_URL, row.COMMENTS) == ("u a b", None)
    with pytest.raises(ValueError):
        parse(spark, "TITLE: t", comments="other")


def test_measurements(parse_all):
    degrees = {
        "3.1 [deg]": 3.1, "3.1\t[deg]": 3.1, "  7 x": 7.0, "-2.5": -2.5, "1e2 x": 100.0,
        "+.5 x": 0.5, "12.5d x": None, "1.5f": None, "NaN": None, "Infinity": None, "-inf": None,
        "0x1p3": None, "n/a": None, "": None, "3.1[deg]": None,
    }
    rows = parse_all([f"TITLE: t\nGRB_ERROR: {error}" for error in degrees])
    assert [row.grb_error_deg for _, row in rows.values()] == list(degrees.values())
    assert parse_all(["TITLE: t"])["TITLE: t"][1].grb_error_deg is None


def test_record_number(parse_all):
    numbers = {"12": 12, "12.7": None, "x": None, "": None}
    rows = parse_all([f"RECORD_NUM: {number}" for number in numbers])
    assert [row.record_num for _, row in rows.values()] == list(numbers.values())


def test_text_helpers(spark):
    one = spark.range(1)
    text = F.lit("A: 1\n  2\nB: 3")
    assert one.select(nt.merge_wrapped(text)).first()[0] == "A: 1   2\nB: 3"
    assert one.select(nt.segments(text)).first()[0] == ["A: 1\n  2", "B: 3"]


def test_typed_shapes(spark):
    from notice_lake.operators.typed import typed_notice

    def typed(text):
        return typed_notice(silver(message_table(spark, [text]))).first()

    row = typed("NOTICE_DATE: Sun 23 Jun 24 13:18:22 UT\nSUN_POSTN: 91.27d {+06h 05m 05s}  +23.42d {+23d 25' 14\"}")
    assert str(row.notice_time) == "2024-06-23 13:18:22"
    assert (row.sun_position_deg, row.sun_position_dec_deg) == (91.27, 23.42)
    row = typed("NOTICE_DATE: 24/06/23 01:02:03\nMOON_POSTN: 5.00d\nGAL_COORDS: 12.10,-3.5 [deg]\nGRB_RA: NaN")
    assert str(row.notice_time) == "2024-06-23 01:02:03" and row.ra_deg is None
    assert (row.moon_position_deg, row.moon_position_dec_deg) == (5.0, None)
    assert (row.gal_lon_deg, row.gal_lat_deg) == (12.1, -3.5)
