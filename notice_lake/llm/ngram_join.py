"""Near duplicates: similarity join on word n-grams, exact at any threshold."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notice_lake.llm.blocks import Rolling, Texts, block_of, buckets_for, in_blocks, mixed, row_key
from notice_lake.llm.common import components, stored, stored_alone
from notice_lake.sources import scratch


@dataclass(frozen=True)
class NgramJoin:
    """``words`` of a shingle; ``percent``: least intersection in hundredths of the union.

    ``counted``: how many of four shingles take part in the count of documents by shingle.
    ``bits`` of the signature that bounds an overlap from above. In each round a document is compared with up to ``leaders``
    others, of two out of every ``group`` in a tile.
    """

    words: int = 5
    percent: int = 75
    block_bytes: int = 2_000_000
    counted: int = 3
    bits: int = 4096
    leaders: int = 4
    group: int = 16


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Order of a shingle that is not counted, or that one document has.
_UNCOUNTED, _ALONE = 255, 0
#: So many prefix shingles before one tell that a pair has met already.
_JUST_BEFORE = 4


def shingles(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the distinct shingles, and the text of each; sorted by text and digest.

    A text with fewer words has the sequence of all its words for a shingle.
    """
    data = _LOWER[texts.data]
    first = np.zeros(len(data) + 1, bool)
    first[texts.starts[texts.sizes > 0]] = True
    blank = np.concatenate([[True], _BLANK[data], [True]])
    begin = np.flatnonzero(~blank[1:-1] & (blank[:-2] | first[:-1]))
    first[len(data)] = True
    end = np.flatnonzero(~blank[1:-1] & (blank[2:] | first[1:])) + 1
    word = mixed(Rolling(data).digest(begin, end) + (end - begin).astype(np.uint64))
    of = np.searchsorted(texts.starts, begin, "right") - 1
    total = np.bincount(of, minlength=len(texts.starts))
    width = np.minimum(total, words)[of] if len(of) else of
    rank = np.arange(len(of)) - (np.cumsum(total) - total)[of] if len(of) else of
    whole = rank + width <= total[of] if len(of) else np.zeros(0, bool)
    at = np.flatnonzero(whole)
    value = width[at].astype(np.uint64)
    padded = np.concatenate([word, np.zeros(words, np.uint64)])
    for k in range(words):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) + np.where(k < width[at], padded[at + k], np.uint64(0)))
    of = of[at]
    order = np.lexsort((value, of))
    value, of = value[order], of[order]
    new = np.ones(len(value), bool)
    new[1:] = (np.diff(value) != 0) | (np.diff(of) != 0)
    return value[new], of[new]


def _names(values: np.ndarray, buckets: int, counted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The counted shingles of a block, each once, with their bucket and number of documents."""
    names, count = np.unique(values[(values & np.uint64(3)) < np.uint64(counted)], return_counts=True)
    bucket = ((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return names, bucket.astype(np.int32), count


_SENT = "bucket int, block int, names binary, at binary, more binary"
_ANSWER = "bucket int, block int, at binary, order binary"


def _send(rows: pa.Table, *, join: NgramJoin, buckets: int) -> pa.Table:
    """The block's counted shingles by bucket, and the counts above 1."""
    value, _ = shingles(Texts.of(rows["text"]), join.words)
    names, bucket, count = _names(value, buckets, join.counted)
    found = np.unique(bucket)
    block = rows["block"][0].as_py()
    out: dict[str, list] = {"names": [], "at": [], "more": []}
    for b in found:
        a, e = np.searchsorted(bucket, b), np.searchsorted(bucket, b, "right")
        often = np.flatnonzero(count[a:e] > 1)
        out["names"].append(names[a:e].astype(np.uint32).tobytes())
        out["at"].append(often.astype(np.uint32).tobytes())
        out["more"].append((count[a:e][often] - 1).astype(np.uint32).tobytes())
    return pa.table(
        {"bucket": pa.array(found, pa.int32()), "block": pa.array([block] * len(found), pa.int32())}
        | {c: pa.array(v, pa.binary()) for c, v in out.items()}
    )


def _count(sent: pa.Table) -> pa.Table:
    """For one bucket: the number of documents of each shingle, as steps of a quarter of a power of two.

    Blocks hear of the shingles that more than one document has.
    """
    own = [np.frombuffer(x, np.uint32) for x in sent["names"].to_pylist()]
    values = np.concatenate(own)
    weight = np.ones(len(values), np.int64)
    ends = np.cumsum([0] + [len(x) for x in own])
    for a, at, more in zip(ends[:-1], sent["at"].to_pylist(), sent["more"].to_pylist(), strict=True):
        weight[a + np.frombuffer(at, np.uint32)] += np.frombuffer(more, np.uint32)
    sorted_by = np.argsort(values, kind="stable")
    ranked = values[sorted_by]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=weight[sorted_by]) if len(group) else np.zeros(0)
    order = np.zeros(len(values), np.uint8)
    order[sorted_by] = np.where(total > 1, np.minimum(4 * np.log2(np.maximum(total, 1)), 254), 0)[group]
    rows = []
    for block, a, b in zip(sent["block"].to_pylist(), ends[:-1], ends[1:], strict=True):
        at = np.flatnonzero(order[a:b])
        if len(at):
            rows.append((block, at.astype(np.uint32).tobytes(), order[a:b][at].tobytes()))
    return pa.table(
        {
            "bucket": pa.array([sent["bucket"][0].as_py()] * len(rows), pa.int32()),
            "block": pa.array([r[0] for r in rows], pa.int32()),
            "at": pa.array([r[1] for r in rows], pa.binary()),
            "order": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


_SETS = "n_shingles long, sum_digest long, mix_digest long, prefix array<long>, place array<int>, bitmap array<long>, shingles array<long>"


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values).cast(kind))


def _sets(rows: pa.Table, answers: pa.Table, *, join: NgramJoin, buckets: int) -> pa.Table:
    """Per document: size and digest of its set; and if it can have links, its prefix, signature and set.

    In order of the number of documents, then of the digest, two sets that are
    similar enough share a shingle among the first of each: their prefixes. Shingles that one document
    has come first, so a document with enough of these has an empty prefix.
    """
    texts = Texts.of(rows["text"])
    n = len(rows)
    value, of = shingles(texts, join.words)
    names, bucket, _ = _names(value, buckets, join.counted)
    order = np.zeros(len(names), np.uint8)
    for b, at, o in zip(*(answers[c].to_pylist() for c in ("bucket", "at", "order")), strict=True):
        order[np.searchsorted(bucket, b) + np.frombuffer(at, np.uint32)] = np.frombuffer(o, np.uint8)
    each = np.full(len(value), _UNCOUNTED, np.uint8)
    counted = (value & np.uint64(3)) < np.uint64(join.counted)
    each[counted] = order[np.searchsorted(names, value[counted])]
    size = np.bincount(of, minlength=n).astype(np.int64)
    starts = np.cumsum(size) - size
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value)])
    mixes = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)))])
    ranked = np.lexsort((value, each, of))
    place = np.arange(len(value)) - starts[of]
    need = -(-join.percent * size // 100)
    take = (place < (size - need + 1)[of]) & (each[ranked] != _ALONE)
    taken = np.bincount(of[take], minlength=n)
    live = taken > 0
    in_set = live[of]
    bit = (value >> np.uint64(20)) % np.uint64(join.bits)
    words = join.bits // 64
    maps = np.zeros((n, words), np.uint64)
    np.bitwise_or.at(maps, (of[in_set], (bit[in_set] // np.uint64(64)).astype(int)), np.uint64(1) << (bit[in_set] % np.uint64(64)))
    prefix_ends = np.concatenate([[0], np.cumsum(taken)])
    set_ends = np.concatenate([[0], np.cumsum(np.where(live, size, 0))])
    map_ends = np.concatenate([[0], np.cumsum(np.where(live, words, 0))])
    long = pa.int64()
    return pa.table(
        {
            "doc_id": rows["doc_id"],
            "key": rows["key"],
            "n_shingles": pa.array(size),
            "sum_digest": pa.array((sums[starts + size] - sums[starts]).view(np.int64)),
            "mix_digest": pa.array((mixes[starts + size] - mixes[starts]).view(np.int64)),
            "prefix": _lists(value[ranked][take].view(np.int64), prefix_ends, long),
            "place": _lists(place[take], prefix_ends, pa.int32()),
            "bitmap": _lists(maps[live].reshape(-1).view(np.int64), map_ends, long),
            "shingles": _lists(value[in_set].view(np.int64), set_ends, long),
        }
    )


def _room(own: Column, other: Column, join: NgramJoin) -> Column:
    """Least intersection of two sets of these sizes that makes them similar enough."""
    return F.ceil(F.lit(join.percent) * (own + other) / F.lit(100 + join.percent))


def _bound(a: str, b: str) -> Column:
    """No more than so many shingles are in both sets, by the signatures."""
    missing = F.aggregate(
        F.zip_with(f"{a}.bitmap", f"{b}.bitmap", lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))),
        F.lit(0),
        lambda s, x: s + x,
    )
    return F.col(f"{a}.n") - missing


def possible(pairs: DataFrame, sets: DataFrame, join: NgramJoin) -> DataFrame:
    """The pairs ``a``, ``b`` whose signatures allow the needed overlap; of the sets only sizes and signatures move."""
    small = sets.select("rep", F.struct("n", "bitmap").alias("set"))
    rows = (
        pairs.join(small.select(F.col("rep").alias("a"), F.col("set").alias("x")), "a")
        .join(small.select(F.col("rep").alias("b"), F.col("set").alias("y")), "b")
    )
    enough = F.least(_bound("x", "y"), _bound("y", "x")) >= _room(F.col("x.n"), F.col("y.n"), join)
    return rows.where(enough).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, join: NgramJoin) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar enough, exactly."""
    packed = sets.select("rep", F.struct("n", "shingles").alias("set"))
    rows = (
        pairs.join(packed.select(F.col("rep").alias("a"), F.col("set").alias("x")), "a")
        .join(packed.select(F.col("rep").alias("b"), F.col("set").alias("y")), "b")
    )
    both = F.size(F.array_intersect("x.shingles", "y.shingles"))
    return rows.where(100 * both >= join.percent * (F.col("x.n") + F.col("y.n") - both)).select("a", "b")


def near_duplicates(
    docs: DataFrame, join: NgramJoin = NgramJoin(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Groups of documents linked by the Jaccard similarity of their word shingles.

    Returns ``doc_id``, ``n_shingles`` (size of the set) and ``component_id`` (smallest id that links
    reach, its own included), one row per input row.

    1. Blocks of documents count shingles by exchanging digests through buckets.
    2. Each document gets the prefix of its set in order of that count. Documents with a prefix that
       only they have can have no links and go no further. Equal sets go on as one.
    3. Sets that share a prefix shingle are candidates, in tiles of similar size. In rounds each is
       compared with some leaders that it meets most (two per group of a tile, by chance other ones in each round) and that
       it is not connected with; links found connect documents. Rounds go on until the links that one
       finds, times the sets of the largest part, are no more than all places: then what is apart from that part is so little
       that all candidates that are still apart can be compared.
    4. A candidate must have room for the needed overlap after the places of the shared shingle, and
       by the signatures' bit counts; then the sets are intersected exactly.

    No link between different sets is lost: what is skipped is within one component already.
    A document without words, or null, has an empty set and no links. Rows that share an id are
    one document with the links of all. Rows without an id link with nothing and have a null component.
    An empty table gives an empty result. Sets are of 64-bit digests.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(f"`{text}`"))), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / join.block_bytes))
    kind = dict(docs.dtypes)[doc_id]
    dealt = in_blocks(docs, doc_id, text, n).groupBy("block")

    def send(rows: pa.Table) -> pa.Table:
        return _send(rows, join=join, buckets=buckets_for(n))

    sent = dealt.applyInArrow(send, _SENT)
    # Stored, so that what the blocks send is gone before their sets are there; texts are shuffled once more for that.
    with scratch.made_inside() as spent:
        answers = stored(sent.groupBy("bucket").applyInArrow(_count, _ANSWER), "ngram-orders")
    with scratch.made_inside() as whole:
        all_sets = stored(
            dealt.cogroup(answers.groupBy("block")).applyInArrow(
                partial(_sets, join=join, buckets=buckets_for(n)), f"doc_id {kind}, key long, {_SETS}"
            ),
            "ngram-sets",
        )
    scratch.remove(docs.sparkSession, spent)
    digest = ["n_shingles", "sum_digest", "mix_digest"]
    classes = stored(
        all_sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*digest)
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min_by("key", "doc_id").alias("key")),
        "ngram-classes",
    )
    lead = classes.select("key", "rep")
    sets = stored(
        all_sets.where(F.size("prefix") > 0).join(lead, "key").where("doc_id = rep")
        .select("rep", F.col("n_shingles").alias("n"), "prefix", "place", "bitmap", "shingles"),
        "ngram-leads",
    )
    # The sets that can have links are written once more by now; of the others only names stay.
    named = stored(all_sets.select("doc_id", *digest), "ngram-documents")
    scratch.remove(docs.sparkSession, whole)
    # An id with unlike sets is one document; only such ids link classes besides the sets.
    spread = F.lit(False)
    for c in digest:
        spread = spread | (F.min(c) != F.max(c))
    several = stored(
        named.where("doc_id IS NOT NULL").groupBy("doc_id").agg(spread.alias("unlike")).where("unlike").select("doc_id"),
        "ngram-several",
    )
    same = stored(
        named.join(several, "doc_id").join(classes.select(*digest, "rep"), digest)
        .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b"),
        "ngram-same",
    )
    links = stored_alone(lambda: _links(sets, same, join), "ngram-links")
    ids = stored(
        links.join(several.select(F.col("doc_id").alias("rep")), "rep", "left_semi")
        .select(F.col("rep").alias("doc_id"), F.col("part").alias("of_id")),
        "ngram-ids",
    )
    # Of a class without copies and links the result is the id itself.
    groups = (
        classes.join(links, "rep", "left")
        .select(*digest, "rep", "copies", F.coalesce("part", "rep").alias("of_set"))
        .where("copies > 1 OR of_set <> rep").drop("rep", "copies")
    )
    rows = named.join(groups, digest, "left").join(ids, "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_id", "of_set", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"))


def _links(sets: DataFrame, same: DataFrame, join: NgramJoin) -> DataFrame:
    """Each set ``rep`` that has links, and the smallest that all links and ``same`` connect it with, ``part``.

    Tables of a round go when the next has made its own.
    """
    step = math.log(100 / join.percent)
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("int")
    with scratch.made_inside() as outdated:
        places = stored(
            sets.select("rep", "n", band.alias("band"), F.explode(F.arrays_zip("prefix", "place")).alias("p"))
            .select("rep", "n", "band", F.col("p.prefix").alias("shingle"), F.col("p.place").alias("place")),
            "ngram-places",
        )
    parts = None
    named = places.withColumn("part", F.col("rep"))
    number, count = 0, places.count()
    links = largest = count
    while links * largest > count:
        with scratch.made_inside() as used:
            live = stored_alone(lambda: _live(named), "ngram-live")
            more = stored_alone(lambda: _found(live, sets, number, join), "ngram-found")
        links = more.count()
        if links:
            with scratch.made_inside() as folders:
                parts = stored_alone(lambda: _joined_parts(parts, more), "ngram-parts")
                moved = live.withColumnRenamed("part", "old").join(parts, "rep", "left")
                named = stored(moved.withColumn("part", F.coalesce("part", "old")).drop("old", "among"), "ngram-named")
            scratch.remove(sets.sparkSession, outdated + used)
            outdated = folders
            largest = parts.groupBy("part").agg(F.count("*").alias("k")).agg(F.max("k")).first()[0]
        number += 1
    rest = verified(stored_alone(lambda: _apart(named, sets, join), "ngram-pairs"), sets, join)
    return _joined_parts(parts, rest.union(same))


def _found(live: DataFrame, sets: DataFrame, number: int, join: NgramJoin) -> DataFrame:
    """Links among documents and the leaders that they meet in a round; leaders that meet each other are linked twice."""
    return verified(stored(possible(_met(live, number, join), sets, join), "ngram-possible"), sets, join)


def _joined_parts(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """The part of each set that has links, after new links; ``parts`` has those of the sets that had some before."""
    if parts is None:
        return components(links).select(F.col("node").alias("rep"), F.col("component").alias("part"))
    between = links
    for x in "ab":
        ends = parts.select(F.col("rep").alias(x), F.col("part").alias(f"part_{x}"))
        between = between.join(ends, x, "left").withColumn(f"part_{x}", F.coalesce(f"part_{x}", x))
    merged = components(between.select(F.col("part_a").alias("a"), F.col("part_b").alias("b")).distinct())
    old = parts.join(merged, parts.part == merged.node, "left").select("rep", F.coalesce("component", "part").alias("part"))
    # A set without links until now is a part of its own.
    new = merged.join(parts, merged.node == parts.rep, "left_anti")
    return old.union(new.select("node", "component"))


def _in_tiles(named: DataFrame) -> DataFrame:
    """Sets in the tiles where they meet others: a set of size band k meets those of its own band and of the one below."""
    return named.withColumn("own", F.col("band")).withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))


def _live(named: DataFrame) -> DataFrame:
    """Places at shingles with sets that are not connected, and ``among`` how many. Parts only grow, so other places do not count in later rounds either."""
    parts = named.groupBy("shingle").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("among"))
    return named.join(stored(parts.where("low <> high").select("shingle", "among"), "ngram-apart"), "shingle")


def _met(live: DataFrame, number: int, join: NgramJoin) -> DataFrame:
    """Each document ``a`` with the leaders ``b`` it meets most, of those it is not connected with.

    Chance deals the members of a tile to groups of ``join.group`` at most, on average, and makes two of a group its leaders, so each
    document meets others than the rest of its tile does, and a tile of any size is many groups. A tile has as many groups as
    the places of its shingle fill, so its own members need no count.
    """
    tile = ["shingle", "band"]
    chance = F.xxhash64("rep", F.lit(number))
    group = F.pmod(chance, F.ceil(F.col("among") / join.group)).alias("group")
    # Dealt by group as well: a tile that many sets are in would stay one task.
    dealt = _in_tiles(live).select(*tile, "rep", "part", "n", group).repartition(*tile, "group")
    order = F.struct(F.xxhash64("rep", "shingle", F.lit(number)).alias("h"), "rep", "part", "n")
    within = Window.partitionBy(*tile, "group")
    leaders = dealt.withColumns({"low": F.min(order).over(within), "high": F.max(order).over(within)})
    each = (
        leaders.select("rep", "part", "n", F.explode(F.array_distinct(F.array("low", "high"))).alias("x"))
        .select("rep", "part", "n", F.col("x.rep").alias("leader"), F.col("x.part").alias("of"), F.col("x.n").alias("size"))
    )
    similar = 100 * F.least("n", "size") >= join.percent * F.greatest("n", "size")
    # Dealt once, by the document, for both counts and the join that follows: it has few rows, by its own prefix.
    met = (
        each.where((F.col("part") != F.col("of")) & similar).select("rep", "leader").repartition("rep")
        .groupBy("rep", "leader").agg(F.count("*").alias("times"))
        .groupBy("rep").agg(F.array_sort(F.collect_list(F.struct((-F.col("times")).alias("k"), "leader"))).alias("all"))
    )
    most = F.slice(F.transform("all", lambda x: x.leader), 1, join.leaders)
    return met.select(F.col("rep").alias("a"), F.explode(most).alias("b"))


def _apart(named: DataFrame, sets: DataFrame, join: NgramJoin) -> DataFrame:
    """All candidates that are not connected and that sizes, places and signatures allow.

    A pair leaves the join where its prefixes begin to share shingles: not where they also share one just before, from where
    it has left already, as all other conditions are weaker there. Signatures move with the places: without them, or folded to the
    size of the sets, a text that many sets have in part makes pairs by the square of their number.
    """
    rest = _live(named).join(sets.select("rep", "bitmap", "prefix"), "rep").where(F.array_contains("prefix", F.col("shingle")))
    at = F.array_position("prefix", F.col("shingle")).cast("int")
    first = F.greatest(at - _JUST_BEFORE, F.lit(1))
    rest = stored(rest.withColumn("earlier", F.slice("prefix", first, at - first)).drop("prefix"), "ngram-rest")
    x, y = rest.alias("x"), _in_tiles(rest).alias("y")
    need = _room(F.col("x.n"), F.col("y.n"), join)
    room = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    open_ = (
        F.when(F.col("x.part") == F.col("y.part"), False)
        .when((F.col("y.own") == F.col("x.band")) & (F.col("x.rep") > F.col("y.rep")), False)
        .when(F.least("x.n", "y.n") * 100 < F.greatest("x.n", "y.n") * join.percent, False)
        .when(room < need, False)
        .when(F.arrays_overlap("x.earlier", "y.earlier"), False)
        .otherwise(F.least(_bound("x", "y"), _bound("y", "x")) >= need)
    )
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.band") == F.col("y.band")) & open_)
    return pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
