import pytest
from pyspark.sql import functions as F

from notice_lake.functions.keys import surrogate_key

PAIRS = [(None, "a"), ("a", None), (None, None), ("a", "b"), ("1:a", ""), ("", "1:a"), ("a1:b", "c"), ("a", "b1:c")]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(PAIRS, "a string, b string")


def keys(pairs, algo):
    return [r.k for r in pairs.select(surrogate_key("a", F.col("b"), algo=algo).alias("k")).collect()]


def test_hash_contract(pairs):
    found = keys(pairs, "hash")
    assert found[2] == 42
    assert found[0] == found[1]


def test_hash_is_the_engine_hash(spark):
    # The value in Spark's own function documentation.
    key = surrogate_key(F.lit("Spark"), F.array(F.lit(123)), F.lit(2))
    assert spark.range(1).select(key).first()[0] == -1321691492


def test_xxhash64_skips_nulls_too(pairs):
    found = keys(pairs, "xxhash64")
    assert found[0] == found[1]


def test_sha256_tells_all_pairs_apart(pairs):
    assert len(set(keys(pairs, "sha256"))) == len(PAIRS)


def test_types(pairs):
    types = [
        pairs.select(surrogate_key("a", algo=algo).alias("k")).schema["k"].dataType.simpleString()
        for algo in ("hash", "xxhash64", "sha256")
    ]
    assert types == ["int", "bigint", "string"]


def test_unknown_algorithm():
    with pytest.raises(ValueError):
        surrogate_key("a", algo="md5")
