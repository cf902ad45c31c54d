"""Fingerprints of documents: bottom-k sketches of their word shingles."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from notice_lake.llm.common import stored


@dataclass(frozen=True)
class Sketch:
    """``k`` smallest hashes (at least 2) of shingles of ``words`` words."""

    words: int = 5
    k: int = 128


#: A hash is two residues of 31 bits; word i of a shingle counts COEFFICIENTS[.][i] times, the number of words last.
PRIMES = (2_147_483_647, 2_147_483_629)
#: Hashes are below this.
SCALE = PRIMES[0] << 31


def coefficients(words: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(13)).integers(1, PRIMES[1], (2, words + 1))


def shingle_hashes(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts one after another, and where those of each text end.

    Words are stretches without white space, A-Z as a-z. A text with fewer words has the sequence of
    all its words for a shingle, one without words none.
    """
    number: dict[bytes, int] = {}
    ids: list[int] = []
    counts = []
    for text in texts:
        found = text.lower().split()
        counts.append(len(found))
        ids.extend([number.setdefault(w, len(number)) for w in found])
    digests = [hashlib.md5(w).digest() for w in number]
    vocabulary = np.frombuffer(b"".join(d[:8] for d in digests), ">u4").astype(np.int64).reshape(-1, 2)
    total = np.array(counts, np.int64)
    width = np.minimum(total, words)
    number_of = np.where(total > 0, total - width + 1, 0)
    ends = np.cumsum(number_of)
    of = np.repeat(np.arange(len(total)), number_of)
    at = np.arange(len(of)) - (ends - number_of)[of] + (np.cumsum(total) - total)[of]
    padded = np.array(ids + [0] * words, np.int64)
    value = np.zeros(len(of), np.int64)
    for which, prime in enumerate(PRIMES):
        factors = coefficients(words)[which]
        sums = width[of] * factors[words] % prime
        for i in range(words):
            share = vocabulary[:, which] % prime * factors[i] % prime
            sums += np.where(i < width[of], share[padded[at + i]], 0) if len(share) else 0
        value = (value << 31) + sums % prime
    return value, ends


def sketch_of(texts: list[bytes], sketch: Sketch) -> list[np.ndarray]:
    """The ``k`` smallest hashes of each text, ascending."""
    values, ends = shingle_hashes(texts, sketch.words)
    ends = [0, *ends.tolist()]
    return [np.unique(values[a:e])[: sketch.k] for a, e in zip(ends[:-1], ends[1:], strict=True)]


def _arrays(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in found])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *found])))


def fingerprint(docs: DataFrame, text: str = "text", sketch: Sketch = Sketch()) -> DataFrame:
    """``docs`` with the column ``sketch``: an ascending array of hashes, empty for a text that is null or has no words.

    A sketch is made where the text is read; nothing is shuffled. ``docs`` must not have a column ``sketch``.
    """

    def of_batches(batches):
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column(text).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, _arrays(sketch_of(texts, sketch))], names=[*batch.schema.names, "sketch"])

    schema = T.StructType([*docs.schema, T.StructField("sketch", T.ArrayType(T.LongType()))])
    return docs.mapInArrow(of_batches, schema)


def merge(a: Column, b: Column, sketch: Sketch = Sketch()) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, sketch.k)


def _seen(a: Column, b: Column, sketch: Sketch) -> tuple[Column, Column]:
    """Both sketches up to where both show all hashes of their texts. Sketches below ``k`` hashes show all there are."""

    def upto(x: Column) -> Column:
        return F.when(F.size(x) >= sketch.k, F.element_at(x, -1)).otherwise(F.lit(SCALE))

    least = F.least(upto(a), upto(b))
    return F.filter(a, lambda x: x < least), F.filter(b, lambda x: x < least)


def resemblance(a: Column, b: Column, sketch: Sketch = Sketch()) -> Column:
    """Estimate of shingles in both texts as a share of those in either; exact if each has fewer than ``k``.

    1 if both have none.
    """
    x, y = _seen(a, b, sketch)
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(x) + F.size(y) - both))


def containment(a: Column, b: Column, sketch: Sketch = Sketch()) -> Column:
    """Estimate of shingles in both texts as a share of those in the first; 1 if the first has none.

    Null if the second is so much longer that its sketch shows none of the hashes of the first.
    """
    x, y = _seen(a, b, sketch)
    share = F.when(F.size(x) > 0, F.size(F.array_intersect(x, y)) / F.size(x))
    return F.when(F.size(a) == 0, 1.0).otherwise(share)


def distinct(a: Column, sketch: Sketch = Sketch()) -> Column:
    """Estimate of the number of distinct shingles; exact below ``k``."""
    some = F.lit(float(sketch.k - 1)) * F.lit(float(SCALE)) / F.element_at(a, -1)
    return F.when(F.size(a) >= sketch.k, some).otherwise(F.size(a).cast("double"))


def as_text(a: Column) -> Column:
    """A sketch as a string, 16 hex digits per hash."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def merged(sketches: DataFrame, by: str, sketch: Sketch = Sketch()) -> DataFrame:
    """The sketch of all texts of each value of ``by``, from their sketches; null is a value.

    Equal hashes are combined per task, and of each value no task sends more than ``k`` hashes on, so
    neither a value nor a hash that a third of all rows have is a hot spot.
    """
    each = sketches.select(F.col(f"`{by}`").alias("_by"), F.explode_outer("sketch").alias("_hash"))
    once_each = each.groupBy("_by", "_hash").agg(F.lit(1).alias("_one"))
    smallest = Window.partitionBy("_by").orderBy(F.col("_hash").asc_nulls_last())
    return (
        once_each.withColumn("_rank", F.row_number().over(smallest)).where(F.col("_rank") <= sketch.k)
        .groupBy("_by").agg(F.array_sort(F.collect_list("_hash")).alias("sketch"))
        .select(F.col("_by").alias(by), "sketch")
    )


@dataclass(frozen=True)
class _Ranges:
    """Stretches of the order of documents. Ids are kept inverted, so that they ascend; those without an id come last."""

    ids: np.ndarray
    none: np.ndarray
    keys: np.ndarray
    #: The first of the parts that a stretch is dealt to; one more entry than stretches.
    parts: np.ndarray

    def place(self, doc_id: pa.Array, key: pa.Array, salt: pa.Array) -> pa.Array:
        """Of each row the part, in the last stretch that does not start after it; copies are dealt by ``salt``.

        And of rows at the start of a stretch, the first and last part of the stretch before, circularly.
        """
        none = np.asarray(doc_id.is_null())
        ids = ~np.asarray(doc_id.cast(pa.int64()).fill_null(0))
        keys = np.asarray(key)
        n = int((~self.none).sum())
        low = np.where(none, n, np.searchsorted(self.ids[:n], ids, "left"))
        high = np.where(none, len(self.ids), np.searchsorted(self.ids[:n], ids, "right"))
        at = low - 1
        # Where a stretch starts inside of an id, keys decide.
        for a, e in set(zip(low[low < high].tolist(), high[low < high].tolist(), strict=True)):
            rows = (low == a) & (high == e)
            at[rows] = a - 1 + np.searchsorted(self.keys[a:e], keys[rows], "right")
        width = self.parts[at + 1] - self.parts[at]
        part = self.parts[at] + np.asarray(salt) % width
        inside = (self.none[at] != none) | (self.keys[at] != keys) | (~none & (self.ids[at] != ids))
        before = (at - 1) % len(self.ids)
        low, high = pa.array(self.parts[before], mask=inside), pa.array(self.parts[before + 1] - 1, mask=inside)
        return pa.StructArray.from_arrays([pa.array(part), low, high], ["part", "low", "high"])


def _order() -> list[Column]:
    return [F.col("doc_id").desc_nulls_last(), F.col("key")]


def _stretches(rows: DataFrame, range_bytes: int) -> _Ranges:
    """Stretches of at most about ``range_bytes`` of text.

    Copies (equal id and text) whose texts are longer together are a stretch of their own, dealt to several parts.
    """
    weight = F.sum(F.octet_length("text") + 64)
    each = stored(rows.groupBy("doc_id", "key").agg(weight.alias("weight")), "fingerprint-ids")
    total = each.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    dealt = stored(
        each.repartitionByRange(max(1, math.ceil(total / range_bytes)), *_order()).withColumn("range", F.spark_partition_id()),
        "fingerprint-order",
    )
    before = Window.partitionBy("range").orderBy(*_order())
    starts = (
        dealt.withColumn("pieces", F.ceil(F.col("weight") / range_bytes).cast("long"))
        .withColumn("last", F.lag("pieces").over(before))
        .where("last IS NULL OR last > 1 OR pieces > 1")
        .select("doc_id", "key", "pieces").collect()
    )
    starts.sort(key=lambda r: (r.doc_id is None, -(r.doc_id or 0), r.key))
    parts = np.cumsum([0] + [r.pieces for r in starts])
    return _Ranges(
        ~np.array([r.doc_id or 0 for r in starts], np.int64),
        np.array([r.doc_id is None for r in starts], bool),
        np.array([r.key for r in starts], np.int64),
        parts,
    )


def _edited(rows: pa.Table, *, sketch: Sketch) -> pa.Table:
    """For the rows of one part and a row of the next one's start (``lent``): texts edited, and the sketches."""
    ids, keys, texts = (rows[c].to_pylist() for c in ("doc_id", "key", "text"))
    lent = rows["lent"].to_pylist()
    place = {x: i for i, x in reversed(list(enumerate(zip(ids, keys, lent, strict=True)))) if not x[2]}
    order = sorted(place, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
    own = [texts[place[x]] for x in order]
    more = [t for t, borrowed in zip(texts, lent, strict=True) if borrowed][:1]
    following = [*own, *more][1 : len(own) + 1] if own else []
    half = [len(t) // 2 for t in own]
    edited = [t[: len(t) - h] + x[:h] for t, h, x in zip(own, half, following, strict=True)]
    plain = sketch_of([t.encode() for t in [*own, *more]], sketch)
    changed = [t.encode() for t in edited]
    found = sketch_of(changed, sketch)
    at = {x: i for i, x in enumerate(order)}
    result = [at[x] for x in zip(ids, keys, lent, strict=True) if not x[2]]
    return pa.table(
        {
            "doc_id": pa.array([order[i][0] for i in result], rows.schema.field("doc_id").type),
            "n_chars": pa.array([len(own[i]) for i in result], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(changed[i]).hexdigest() for i in result], pa.string()),
            "sketch": _arrays([plain[i] for i in result]),
            "edited_sketch": _arrays([found[i] for i in result]),
            "next_sketch": _arrays([plain[i + 1] for i in result]),
        }
    )


def edited_fingerprints(docs: DataFrame, sketch: Sketch = Sketch(), range_bytes: int = 16_000_000) -> DataFrame:
    """Fingerprints of each text, of its edited text, and of the next document's text.

    Documents follow each other by descending ``doc_id`` (a whole number); after the last comes the first. The
    edited text has the last floor(n/2) of its n code points replaced by as many, or all, of the first of the next text.

    Returns a row per document: ``doc_id``, ``n_chars``, ``edited_sha256``, ``sketch``,
    ``edited_sketch``, ``next_sketch``. A null text counts as empty. Rows without an id come last. Among rows that share an id, order is by
    a 64-bit digest of the text, and rows equal in both have one place in the order, so all have the same next document.
    A document alone follows itself. An empty table gives an empty result.

    Texts are shuffled once, into stretches of the order of about ``range_bytes``; the first
    text of each stretch is also lent to the one before. A stretch is found from the starts of all stretches, which the driver
    holds (24 bytes per ``range_bytes`` of text). Copies that fill a stretch are dealt to several.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key"))
    ranges = _stretches(rows, range_bytes)

    @F.arrow_udf("part: long, low: long, high: long")
    def place(doc_id: pa.Array, key: pa.Array, salt: pa.Array) -> pa.Array:
        return ranges.place(doc_id, key, salt)

    placed = rows.withColumn("place", place("doc_id", "key", F.monotonically_increasing_id()))
    own = placed.select("doc_id", "text", "key", "place.part", F.lit(False).alias("lent"))
    starts = placed.where("place.low IS NOT NULL").groupBy("doc_id", "key")
    lent = starts.agg(*[F.any_value(c).alias(c.split(".")[-1]) for c in ("text", "place.low", "place.high")])
    lent = lent.select("doc_id", "text", "key", F.explode(F.sequence("low", "high")).alias("part"), F.lit(True).alias("lent"))
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("sketch", "edited_sketch", "next_sketch")],
        ]
    )
    dealt = own.unionByName(lent)

    def of_part(rows: pa.Table) -> pa.Table:
        return _edited(rows, sketch=sketch)

    return dealt.groupBy("part").applyInArrow(of_part, schema)
