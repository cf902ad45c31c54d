import random
from collections import Counter, defaultdict

import pytest
from messages import START, deliveries

from notice_lake.operators.sequences import late_messages, offset_gaps


def brute_gaps(rows):
    by_partition = defaultdict(set)
    for p, o, _ in rows:
        by_partition[p].add(o)
    return {
        (p, a + 1, b - 1, b - a - 1)
        for p, offsets in by_partition.items()
        for a, b in zip(sorted(offsets), sorted(offsets)[1:])
        if b - a > 1
    }


def brute_late(rows):
    late = Counter()
    for p, o, m in rows:
        before = [m2 for p2, o2, m2 in rows if p2 == p and o2 < o]
        if before and m < max(before):
            late[(p, o, m, max(before))] += 1
    return late


def random_feed(seed, hot):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        partition = 0 if rng.random() < hot else rng.randrange(1, 5)
        offset = rng.choice([rng.randrange(60), rng.randrange(3000), 2**40 + rng.randrange(50)])
        rows.append((partition, offset, rng.randrange(1000)))
    rows += rng.choices(rows, k=100)
    rows += [rows[0]] * 150
    return rows


@pytest.mark.parametrize("block_bits", [1, 3, 20])
@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed, block_bits):
    rows = random_feed(seed, hot=0.5)
    df = deliveries(spark, rows)
    gaps = {
        (r.kafka_partition, r.gap_start, r.gap_end, r.missing)
        for r in offset_gaps(df, block_bits=block_bits).collect()
    }
    assert gaps == brute_gaps(rows)

    def minute(stamp):
        return int((stamp - START).total_seconds() // 60)

    late = {
        (r.kafka_partition, r.kafka_offset, minute(r.kafka_timestamp), minute(r.latest_before)): r.deliveries
        for r in late_messages(df, block_bits=block_bits).collect()
    }
    assert late == brute_late(rows)


def test_no_gap_in_a_complete_feed(spark):
    rows = [(p, o, o) for p in range(2) for o in range(100)]
    df = deliveries(spark, rows)
    assert offset_gaps(df, block_bits=3).isEmpty()
    assert late_messages(df, block_bits=3).isEmpty()
