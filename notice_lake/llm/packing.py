"""Packing by length: buckets that minimise padding, and batches of a token budget in each."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notice_lake.llm.common import stored, word_count


@dataclass(frozen=True)
class Packing:
    """``buckets``: how many lengths to pad to. ``batch_tokens``: padded tokens of a batch.

    ``docs_per_part``: documents of a bucket are numbered in parts of about this size, so that
    no task sees a whole bucket; at most one batch of each part is not full.
    """

    buckets: int = 16
    batch_tokens: int = 65_536
    docs_per_part: int = 50_000


def boundaries(histogram: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """The bucket lengths with the least padding, by dynamic programming.

    ``histogram`` has (length, documents, tokens) with tokens at most length times documents.
    Padding of a bucket is its length times its documents less their tokens. For the bucket that ends
    at ``j`` the best start is the lowest of straight lines at ``length[j]``, whose slopes fall from start to
    start; so one pass over their lower hull finds all, and the time is buckets times lengths.
    """
    rows = sorted(histogram)
    if not rows:
        return []
    length = [int(r[0]) for r in rows]
    count = [0, *accumulate(int(r[1]) for r in rows)]
    tokens = [0, *accumulate(int(r[2]) for r in rows)]
    n = len(rows)
    best: list[int | None] = [0] + [None] * n
    came: list[np.ndarray] = []
    for _ in range(min(buckets, n)):
        following, back = best.copy(), np.full(n + 1, -1)
        hull: list[tuple[int, int, int]] = []  # slope, height at 0, start
        at = 0
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                slope, height = -count[j - 1], best[j - 1] + tokens[j - 1]
                while len(hull) - at >= 2:
                    (m1, b1, _), (m2, b2, _) = hull[-2], hull[-1]
                    if (height - b1) * (m1 - m2) > (b2 - b1) * (m1 - slope):
                        break
                    hull.pop()
                hull.append((slope, height, j - 1))
            x = length[j - 1]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            slope, height, i = hull[at]
            cost = slope * x + height + x * count[j] - tokens[j]
            if following[j] is None or cost < following[j]:
                following[j], back[j] = cost, i
        best = following
        came.append(back)
    ends, j = [], n
    for back in reversed(came):
        if j and back[j] >= 0:
            ends.append(length[j - 1])
            j = int(back[j])
    return ends[::-1]


def pack(
    docs: DataFrame,
    packing: Packing = Packing(),
    doc_id: str = "doc_id",
    text: str = "text",
    tokens: str | None = None,
) -> DataFrame:
    """The batch of each document: ``doc_id``, ``n_tokens``, ``bucket_length``, ``batch_id``, ``slot``, ``padding``.

    Token counts come from the column ``tokens``, or are the words of ``text``. The
    driver sees the exact histogram, a row for each length that occurs: fewer than the root of twice all
    tokens. The boundaries are optimal for it. A batch holds
    as many documents as fit the budget padded to the bucket's length, and at least one,
    so a document longer than the budget is a batch alone and whole.

    Null and empty texts have 0 tokens and go to the smallest bucket. Equal rows get slots of
    their own. An empty table gives an empty result.
    """
    count = word_count(F.col(f"`{text}`")) if tokens is None else F.greatest(F.coalesce(F.col(f"`{tokens}`"), F.lit(0)), F.lit(0)).cast("long")
    rows = stored(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), count.alias("n_tokens"))
        .withColumn("length", F.greatest("n_tokens", F.lit(1).cast("long"))),
        "lengths",
    )
    histogram = [
        tuple(r) for r in rows.groupBy("length").agg(F.count("*"), F.sum("n_tokens")).collect()
    ]
    ends = boundaries(histogram, packing.buckets)
    bucket, parts = F.lit(None).cast("long"), F.lit(1)
    for low, end in reversed(list(zip([0, *ends], ends))):
        inside = sum(n for length, n, _ in histogram if low < length <= end)
        bucket = F.when(F.col("length") <= end, F.lit(end).cast("long")).otherwise(bucket)
        parts = F.when(F.col("length") <= end, math.ceil(inside / packing.docs_per_part)).otherwise(parts)
    rows = rows.withColumns({"bucket_length": bucket, "parts": parts})
    mixed = F.xxhash64("doc_id", "n_tokens")
    rows = rows.withColumn("part", F.pmod(mixed, F.col("parts")))
    place = F.row_number().over(
        Window.partitionBy("bucket_length", "part").orderBy(mixed, "doc_id", "n_tokens")
    ) - 1
    room = F.greatest(F.floor(F.lit(packing.batch_tokens) / F.col("bucket_length")), F.lit(1))
    rows = rows.withColumns({"place": place, "room": room})
    return rows.select(
        "doc_id", "n_tokens", "bucket_length",
        F.concat_ws("-", "bucket_length", "part", F.floor(F.col("place") / F.col("room"))).alias("batch_id"),
        F.pmod("place", "room").cast("long").alias("slot"),
        (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
    )
