"""Near-duplicate vectors: lattice hashing with E8 in several tables, checked by cosine."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.blocks import mixed
from notice_lake.llm.common import components, stored


@dataclass(frozen=True)
class Lattice:
    """``tables`` random projections to 8 dimensions, ``cells`` lattice points of each that a vector goes to.

    ``spread``: length of a lattice unit, in mean projected distances of two unit vectors at the
    least cosine. ``tile``: vectors compared at once; larger cells are cut into pairs of tiles.
    ``entries``: cell entries that one task holds, about.
    """

    cosine: float = 0.98
    tables: int = 8
    cells: int = 3
    spread: float = 2.8
    tile: int = 1000
    entries: int = 50_000
    seed: int = 8


def _nearest_d8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest two points of D8 (whole coordinates with an even sum), by flipping the worst coordinates."""
    near = np.round(x)
    error = x - near
    worst = np.argsort(-np.abs(error), axis=1)[:, :2]
    row = np.arange(len(x))
    step = np.where(error >= 0, 1.0, -1.0)
    odd = near.sum(axis=1) % 2 != 0
    first, second = near.copy(), near.copy()
    first[row[odd], worst[odd, 0]] += step[row[odd], worst[odd, 0]]
    second[row[odd], worst[odd, 1]] += step[row[odd], worst[odd, 1]]
    even = ~odd
    for k in (0, 1):
        second[row[even], worst[even, k]] += step[row[even], worst[even, k]]
    return first, second


def cells(x: np.ndarray, count: int) -> np.ndarray:
    """The nearest ``count`` (at most 4) of E8's points around each row, doubled to whole numbers.

    E8 is D8 together with D8 moved by one half in every coordinate.
    """
    points = [*_nearest_d8(x), *(p + 0.5 for p in _nearest_d8(x - 0.5))]
    both = np.stack(points, axis=1)
    order = np.argsort(((both - x[:, None, :]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :count]
    return np.round(2 * np.take_along_axis(both, order[:, :, None], axis=1)).astype(np.int64)


def codes(vectors: np.ndarray, options: Lattice) -> np.ndarray:
    """64-bit cell codes of unit vectors, ``tables`` times ``cells`` for each."""
    n, d = vectors.shape
    distance = math.sqrt(max(2 - 2 * options.cosine, 1e-12) * min(1.0, 8 / d))
    out = np.zeros((n, options.tables * options.cells), np.int64)
    for t in range(options.tables):
        random = np.random.Generator(np.random.PCG64([options.seed, t, d]))
        axes = np.linalg.qr(random.standard_normal((max(d, 8), 8)))[0][:d]
        points = cells(vectors @ axes / (distance * options.spread), options.cells)
        code = np.full(points.shape[:2], t + 1, np.uint64)
        for k in range(8):
            code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + points[:, :, k].astype(np.uint64))
        out[:, t * options.cells : (t + 1) * options.cells] = code.view(np.int64)
    return out


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, without null or non-finite components, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n members the smallest one that links reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _links(rows: pa.Table, options: Lattice) -> pa.Table:
    """Links inside the cells and tiles of one task, each in one cell only.

    Two vectors may share several cells; the one with the smallest code counts them.
    """
    rep, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
    code = rows["code"].to_numpy()
    group = np.stack([rows[c].to_numpy() for c in ("label", "dim", "code", "low", "high")])
    order = np.lexsort(group)
    change = np.any(np.diff(group[:, order], axis=1) != 0, axis=0)
    cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [len(order)]])
    part = rows["part"].to_numpy()
    vectors, all_codes = rows["embedding"].combine_chunks(), rows["codes"].combine_chunks()
    width = options.tables * options.cells
    every = all_codes.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a, e in zip(cuts[:-1], cuts[1:], strict=True):
        if e - a < 2:
            continue
        at = order[a:e]
        d = len(vectors[int(at[0])])
        unit = _matrix(vectors.take(pa.array(at)), d)
        close = np.triu(unit @ unit.T >= options.cosine, 1)
        if rows["low"][int(at[0])] != rows["high"][int(at[0])]:
            close &= part[at][:, None] != part[at][None, :]
        x, y = np.nonzero(close)
        own = np.zeros(len(x), bool)
        for s in range(0, len(x), 20_000):
            left, right = every[at[x[s : s + 20_000]]], every[at[y[s : s + 20_000]]]
            shared = (left[:, :, None] == right[:, None, :]).any(axis=2)
            first = np.where(shared, left, np.iinfo(np.int64).max).min(axis=1)
            own[s : s + 20_000] = first == code[at[0]]
        x, y = x[own], y[own]
        if len(x):
            n = len(at)
            links = np.bincount(x, copies[at[y]], n) + np.bincount(y, copies[at[x]], n)
            some = np.flatnonzero(links)
            out.append((rep[at[some]], links[some].astype(np.int64), rep[at[_roots(x, y, n)[some]]]))
    parts = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else ((), (), ()))]
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("rep", "links", "root"), parts, strict=True)})


def near_vectors(
    embeddings: DataFrame,
    options: Lattice = Lattice(),
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """Links between vectors of one label with a cosine of at least ``cosine``, in double precision.

    Returns ``vec_id``, ``n_links``, ``component_id`` (smallest id that links reach), ``kept`` (whether
    that is its own) and ``label``. A vector goes to the lattice points nearest to its projection, in each table,
    so two vectors meet where one's cell is the other's or next to it. Every pair
    that meets is compared exactly; a pair that meets nowhere is missed.

    Equal vectors go on as one with their number. Cells with more than ``tile`` vectors are cut into tiles,
    each pair of tiles in a task of its own, so a crowded cell is compared whole and in bounded pieces. Links
    are counted where they are found; of the pairs only a spanning set leaves a task.

    Vectors that are null or zero, or hold null or non-finite components, link with nothing, nor do
    rows with a null label or id, or vectors of different lengths. Repeated rows count as vectors of their
    own. An empty table gives an empty result.
    """
    rows = stored(
        embeddings.select(
            F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
            F.col(f"`{label}`").cast("long").alias("label"),
            F.col(f"`{vector}`").cast("array<float>" if "float" in dict(embeddings.dtypes)[vector] else "array<double>").alias("embedding"),
        ).withColumn("fit", F.coalesce(_usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))),
        "lattice-rows",
    )
    distinct = stored(
        rows.where("fit").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("embedding")),
        "lattice-vectors",
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch["dim"].to_numpy()
            for d in np.unique(dims):
                some = batch.take(pa.array(np.flatnonzero(dims == d)))
                own = codes(_matrix(some["embedding"], int(d)), options)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(some) + 1) * own.shape[1], pa.int32()), pa.array(own.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays([*some.columns, lists], [*some.schema.names, "codes"])

    kinds = ", ".join(f"{c} {t}" for c, t in distinct.dtypes)
    known = stored(distinct.mapInArrow(coded, f"{kinds}, codes array<bigint>"), "lattice-codes")
    entries = known.withColumn("code", F.explode(F.array_distinct("codes")))
    cell = ["label", "dim", "code"]
    sizes = entries.groupBy(*cell).agg(F.count("*").alias("n")).where("n > 1")
    sizes = stored(sizes.withColumn("tiles", F.ceil(F.col("n") / options.tile).cast("int")), "lattice-cells")
    total = sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("tiles")), F.lit(0))).first()[0]
    tasks = max(1, math.ceil(total / options.entries))
    placed = entries.join(sizes, cell).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    placed = placed.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")})
    placed = placed.withColumn("task", F.pmod(F.xxhash64(*cell, "low", "high"), F.lit(tasks)).cast("int")).drop("n", "tiles", "other")

    def of_task(found: pa.Table) -> pa.Table:
        return _links(found, options)

    links = stored(placed.groupBy("task").applyInArrow(of_task, "rep long, links long, root long"), "lattice-links")
    per_rep = links.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    by_vector = stored(
        distinct.join(per_rep, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label", "embedding",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        ),
        "lattice-result",
    )
    linked = by_vector.where("links > 0").withColumn("fit", F.lit(True))
    own = F.coalesce("component", "vec_id")
    return rows.join(linked, ["label", "embedding", "fit"], "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        (F.col("vec_id") == own).alias("kept"), "label",
    )
