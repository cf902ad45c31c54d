"""Column contracts of the layers, with their keys written down as data.

Open-source Spark parses no PRIMARY KEY / FOREIGN KEY clauses for file tables,
so the column part is a ``StructType`` and the keys feed the check operators.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Field labels of a notice, in column order.
NOTICE_FIELDS = (
    "TITLE", "NOTICE_DATE", "NOTICE_TYPE", "RECORD_NUM", "TRIGGER_NUM",
    "GRB_RA", "GRB_DEC", "GRB_ERROR", "GRB_DATE", "GRB_TIME",
    "GRB_PHI", "GRB_THETA", "E_RANGE", "LOC_ALGORITHM",
    "SUN_POSTN", "SUN_DIST", "MOON_POSTN", "MOON_DIST", "MOON_ILLUM",
    "GAL_COORDS", "ECL_COORDS", "LC_URL", "LOC_URL", "COMMENTS",
)

# Natural keys behind the three surrogate keys.
TIMING_KEY = ("GRB_DATE", "GRB_TIME")
SPATIAL_KEY = ("GRB_RA", "GRB_DEC", "GAL_COORDS")
SUN_MOON_KEY = ("SUN_POSTN", "MOON_POSTN")

# A message's position in the feed, and the total order "first seen" means.
DELIVERY_KEY = ("kafka_topic", "kafka_partition", "kafka_offset")
ARRIVAL_ORDER = ("kafka_timestamp", *DELIVERY_KEY)

DELIVERY_COLUMNS = (
    "kafka_key", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
)


_TYPES = {
    "binary": T.BinaryType(),
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def _struct(columns: str, required: tuple[str, ...] = ()) -> T.StructType:
    """Schema from ``name type, ...``; unlike DDL parsing it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType(
        [T.StructField(name, _TYPES[kind.lower()], name not in required) for name, kind in pairs]
    )


# Column names and types of the tables.
KAFKA_SOURCE = _struct(
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT,"
    " timestamp TIMESTAMP, timestampType INT"
)

BRONZE = _struct(
    "kafka_key STRING, kafka_value STRING, kafka_topic STRING, kafka_partition INT,"
    " kafka_offset BIGINT, kafka_timestamp TIMESTAMP"
)

SILVER = T.StructType(
    [BRONZE[name] for name in DELIVERY_COLUMNS]
    + [T.StructField(name, T.StringType()) for name in NOTICE_FIELDS]
)

DIM_EVENT_TIMING = _struct(
    "timing_sk INT, grb_date_raw STRING, grb_time_raw STRING, notice_date_raw STRING",
    required=("timing_sk",),
)

DIM_SPATIAL_COORDS = _struct(
    "spatial_sk INT, sun_moon_sk INT, right_ascension STRING, declination STRING,"
    " galactic_coords STRING, ecliptic_coords STRING",
    required=("sun_moon_sk",),
)

DIM_SUN_MOON_COORDS = _struct(
    "sun_moon_sk INT, sun_position STRING, moon_position STRING, moon_illumination STRING",
    required=("sun_moon_sk",),
)

FACT_NOTICES = _struct(
    "trigger_num BIGINT, record_num INT,"
    " kafka_key STRING, kafka_topic STRING, kafka_partition INT, kafka_offset BIGINT,"
    " kafka_timestamp TIMESTAMP,"
    " timing_sk INT, spatial_sk INT,"
    " notice_title STRING, notice_type STRING, loc_algorithm STRING, comments STRING,"
    " lightcurve_url STRING, location_url STRING,"
    " grb_error_deg DOUBLE, grb_phi_deg DOUBLE, grb_theta_deg DOUBLE,"
    " sun_dist_deg DOUBLE, moon_dist_deg DOUBLE"
)


# Type of a surrogate key by algorithm; the contracts above are for the first.
KEY_TYPES = {"hash": T.IntegerType(), "xxhash64": T.LongType(), "sha256": T.StringType()}


def contract(schema: T.StructType, *, algo: str = "hash", clock: T.DataType | None = None) -> T.StructType:
    """A table's columns with the key type of ``algo`` and, if given, the timestamp type of the feed.

    Kafka delivers timestamps with a zone; a feed kept in files may hold them without.
    """

    def kind(f: T.StructField) -> T.DataType:
        if f.name.endswith("_sk"):
            return KEY_TYPES[algo]
        return clock if clock is not None and f.dataType == T.TimestampType() else f.dataType

    return T.StructType([T.StructField(f.name, kind(f), f.nullable) for f in schema])


@dataclass(frozen=True)
class TableContract:
    """A gold table: columns, primary key and (column, parent, parent column) references."""

    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    references: tuple[tuple[str, str, str], ...] = field(default=())

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.schema if not f.nullable)


GOLD = {
    "dim_event_timing": TableContract(DIM_EVENT_TIMING, ("timing_sk",)),
    "dim_sun_moon_coords": TableContract(DIM_SUN_MOON_COORDS, ("sun_moon_sk",)),
    "dim_spatial_coords": TableContract(
        DIM_SPATIAL_COORDS,
        ("spatial_sk",),
        (("sun_moon_sk", "dim_sun_moon_coords", "sun_moon_sk"),),
    ),
    # The delivery key is a recommended uniqueness check, not a declared key.
    "fact_notices": TableContract(
        FACT_NOTICES,
        (),
        (
            ("timing_sk", "dim_event_timing", "timing_sk"),
            ("spatial_sk", "dim_spatial_coords", "spatial_sk"),
        ),
    ),
}
