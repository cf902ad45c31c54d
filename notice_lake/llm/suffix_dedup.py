"""Removal of long repeated strings, by suffixes sampled with a difference cover."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.blocks import (
    SENT,
    Outbox,
    Rolling,
    Texts,
    ask,
    block_of,
    buckets_for,
    in_blocks,
    row_key,
    share_of,
    short_digests,
)
from notice_lake.llm.common import stored


@dataclass(frozen=True)
class SuffixDedup:
    """``length``: bytes that make a repeat. ``block_bytes``: text of a block (a longer document is a block of its own).

    ``words``: a run of repeats with fewer words than so many, pieces of words at its ends included, stays.
    """

    length: int = 400
    block_bytes: int = 2_000_000
    words: int = 0


def difference_cover(length: int) -> tuple[int, np.ndarray]:
    """A period v of at most half of ``length``, and residues such that any two positions meet one.

    For all i and j there is d < v with (i + d) mod v and (j + d) mod v both among the
    residues. Colbourn and Ling's cover: 6r + 4 residues of the period 24r^2 + 36r + 13.
    Short lengths take every position.
    """
    r = -1
    while 24 * (r + 1) ** 2 + 36 * (r + 1) + 13 <= length // 2:
        r += 1
    if r < 0:
        return 1, np.zeros(1, np.int64)
    steps = [1] * r + [r + 1] + [2 * r + 1] * r + [4 * r + 3] * (2 * r + 1) + [2 * r + 2] * (r + 1) + [1] * r
    return 24 * r * r + 36 * r + 13, np.cumsum([0, *steps])


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from each start on, so many; and of each the index of its start."""
    of = np.repeat(np.arange(len(starts)), counts)
    return starts[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts), of


def _mask(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in an interval; intervals in order of their begin."""
    some = end > begin
    begin, end = begin[some], end[some]
    far = np.maximum.accumulate(end)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > far[:-1]
    change = np.zeros(size + 1, np.int8)
    change[begin[new]] = 1
    change[far[np.append(np.flatnonzero(new)[1:] - 1, len(far) - 1)] if len(far) else far] = -1
    return np.cumsum(change[:-1], dtype=np.int8).view(bool)


class _Block:
    """The repeat search in one block, up to the step whose answers are there."""

    def __init__(self, rows: pa.Table, side: pa.Table, dedup: SuffixDedup, buckets: int):
        self.side, self.dedup, self.buckets = side, dedup, buckets
        self.texts = texts = Texts.of(rows["text"])
        copies = _step(side, 0)
        first = dict(zip(copies["key"].to_pylist(), copies["first"].to_pylist(), strict=True))
        keys = rows["key"].to_pylist() if first else [0] * len(rows)
        role = np.array([first.get(k, 2) for k in keys], np.int8).reshape(len(rows))
        long = texts.sizes >= dedup.length
        self.copied = (role < 2) & long
        #: All copies of a text but one stay out of the search.
        active = (role != 0) & long
        self.starts, self.ends = texts.starts[active], (texts.starts + texts.sizes)[active]
        self.rolling = Rolling(texts.data)

    def sample(self) -> Outbox:
        """Names of the sampled suffixes: digests of the bytes that any match of full length shares from there."""
        self.period, cover = difference_cover(self.dedup.length)
        self.step, width = len(cover), self.dedup.length - self.period + 1
        room = np.maximum(self.ends - self.starts - width + 1, 0)
        longest = int(room.max(initial=0))
        pattern = (np.arange(-(-longest // self.period))[:, None] * self.period + cover).reshape(-1)
        counts = np.searchsorted(pattern, room)
        index, of = _spread(np.zeros(len(counts), np.int64), counts)
        self.sampled = self.starts[of] + pattern[index]
        self.begin, self.end = self.starts[of], self.ends[of]
        names = self.rolling.digest(self.sampled, self.sampled + width)
        return Outbox(share_of(names >> np.uint64(32), self.buckets), names)

    def triples(self, names: Outbox) -> Outbox:
        """Names of three sampled suffixes one period apart, for those whose names all occur again."""
        shared, _ = names.answered(_step(self.side, 1))
        self.shared = shared[names.place]
        n, both = len(self.sampled), self.shared.copy()
        for k in (1, 2):
            later = np.zeros(n, bool)
            if n > k * self.step:
                apart = self.sampled[k * self.step :] - self.sampled[: -k * self.step]
                later[: -k * self.step] = self.shared[k * self.step :] & (apart == k * self.period)
            both &= later
        width = self.dedup.length + self.period - 1
        both &= self.sampled + width <= self.end
        self.tripled = self.sampled[both]
        value = self.rolling.digest(self.tripled, self.tripled + width)
        short = short_digests(self.texts.data, self.tripled, self.tripled + width)
        return Outbox(share_of(short, self.buckets), value)

    def suffixes(self, triples: Outbox) -> Outbox:
        """All suffixes that may occur again and are not settled, by digests of their full length.

        A triple that occurs again settles the suffixes from its place up to one period on: they occur
        again, and are sent only from where the triple occurs first.
        """
        shared, lead = triples.answered(_step(self.side, 2))
        again = shared[triples.place]
        leading = np.zeros(len(again), bool)
        leading[triples.first[lead]] = True
        size = len(self.texts.data)
        at = self.tripled[again]
        self.known = _mask(size, at, at + self.period)
        at = self.tripled[again & ~leading]
        elsewhere = _mask(size, at, at + self.period)
        at, low = self.sampled[self.shared], self.begin[self.shared]
        last = self.end[self.shared] - self.dedup.length + 1
        possible = _mask(size, np.maximum(at - self.period + 1, low), np.minimum(at + 1, last))
        self.asked = np.flatnonzero(possible & ~elsewhere)
        end = self.asked + self.dedup.length
        value = self.rolling.digest(self.asked, end)
        bucket = share_of(short_digests(self.texts.data, self.asked, end), self.buckets)
        return Outbox(bucket, value, self.known[self.asked])

    def removed(self, suffixes: Outbox) -> np.ndarray:
        """Which bytes lie in a repeat."""
        shared, _ = suffixes.answered(_step(self.side, 3))
        found = self.known
        found[self.asked[shared[suffixes.place]]] = True
        edge = np.diff(found.view(np.int8), prepend=0, append=0)
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        covered = _mask(len(found), begin, end + self.dedup.length - 1)
        return covered | np.repeat(self.copied, self.texts.sizes)


def _step(side: pa.Table, step: int) -> pa.Table:
    return side.filter(pc.equal(side["step"], step))


#: The digests of each step, and their kind.
_KINDS = {1: np.uint32, 2: np.uint64, 3: np.uint64}


def _search(block: _Block, upto: int) -> Outbox:
    out = block.sample()
    for following in (block.triples, block.suffixes)[: upto - 1]:
        out = following(out)
    return out


def _ordered(rows: pa.Table) -> pa.Table:
    """The rows of a block in one order for all steps, whatever order the shuffle hands them over in.

    Which suffixes a block sends depends on which place of a triple comes first.
    """
    return rows.sort_by([("key", "ascending"), ("text", "ascending")])


def _send(rows: pa.Table, side: pa.Table, *, dedup: SuffixDedup, buckets: int, upto: int) -> pa.Table:
    rows = _ordered(rows)
    out = _search(_Block(rows, side, dedup, buckets), upto)
    number = rows["block"][0].as_py() if len(rows) else 0
    return out.rows(number, _KINDS[upto])


def _finish(rows: pa.Table, side: pa.Table, *, dedup: SuffixDedup, buckets: int, keep: tuple[str, ...], kept_text: bool) -> pa.Table:
    out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text")}
    if len(rows):
        rows = _ordered(rows)
        block = _Block(rows, side, dedup, buckets)
        removed = block.removed(_search(block, 3))
        for a, n in zip(block.texts.starts.tolist(), block.texts.sizes.tolist(), strict=True):
            gone = removed[a : a + n]
            data = block.texts.data[a : a + n]
            some = bool(gone.any())
            kept = data[~gone].tobytes() if some else data.tobytes()
            spans = []
            if some:
                edge = np.diff(gone.view(np.int8), prepend=0, append=0)
                ends = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)
                spans = [{"start": x, "end": y} for x, y in ends]
                if dedup.words:
                    spans = [x for x in spans if len(data[x["start"] : x["end"]].tobytes().split()) >= dedup.words]
                    gone = np.zeros(n, bool)
                    for x in spans:
                        gone[x["start"] : x["end"]] = True
                    kept = data[~gone].tobytes()
            out["n_bytes"].append(n)
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(len(spans))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["spans"].append(spans)
            out["kept_text"].append(kept.decode(errors="ignore") if kept_text else None)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span, pa.string())
    new = {c: pa.array(v, t) for (c, v), t in zip(out.items(), kinds, strict=True)}
    return pa.table({"doc_id": rows["doc_id"], **new, **{c: rows[c] for c in keep}})


def remove_repeats(
    docs: DataFrame,
    dedup: SuffixDedup = SuffixDedup(),
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
    kept_text: bool = False,
) -> DataFrame:
    """Removes each byte inside a string of ``length`` bytes that also starts anywhere else.

    Texts are UTF-8 bytes; matches never cross documents, overlaps count, and strings are
    judged on the input. With ``words``, runs of such bytes with too few words stay. The order of suffixes matters only up to ``length`` bytes and only as to which are
    equal, so a suffix is named by a digest and names are sorted inside buckets of digests:

    1. Suffixes at positions of a difference cover are sampled. Two equal strings
       of full length have a sampled suffix at the same distance in both, and share at least
       ``length`` minus the cover's period plus one bytes from there: its name.
       Names with no equal neighbour in sorted order are settled and go no further.
    2. Of the sampled suffixes that remain, triples one period apart are named, once, in place of a recursion. A triple that
       occurs again settles all suffixes from its place up to one period on.
    3. The suffixes around sampled ones that remain, sampled or not, are merged into one order by
       their full length, and neighbours are compared. Settled ones take part only from the first place.
    4. Each block marks the bytes that its repeated suffixes cover.

    Whole copies of a text (by SHA-256) go through the search once. A name found twice in
    a block is sent once, so a string that a third of all documents hold reaches a
    bucket once per block. Texts are shuffled once; all steps read the same shuffle. Triples and full
    suffixes are told apart by a 64-bit digest inside a bucket chosen by an independent one.

    Returns per document ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs), ``kept_sha256``, ``spans`` (byte offsets), ``kept_text`` (null unless asked for; a character
    of which some bytes are removed goes whole) and the columns ``keep``, which must not
    have the names of the others. A null text counts as empty: 0 bytes, nothing removed.
    Equal rows are copies of each other. An empty table gives an empty result.
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    ids = stored(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            row_key(doc_id, text).alias("key"),
            F.sha2(whole, 256).alias("sha"),
            F.octet_length(whole).cast("long").alias("n"),
        ),
        "suffix-ids",
    )
    size = ids.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = max(1, math.ceil(size / dedup.block_bytes))
    groups = stored(
        ids.where(F.col("n") >= dedup.length).groupBy("sha")
        .agg(F.min("doc_id").alias("lead"), F.count("*").alias("copies")).where("copies > 1"),
        "suffix-copies",
    )
    nothing = F.lit(None)
    side = stored(
        ids.join(groups, "sha").select(
            block_of(F.col("key"), n).alias("block"), F.lit(0).alias("step"), "key",
            F.col("doc_id").eqNullSafe(F.col("lead")).cast("tinyint").alias("first"),
            nothing.cast("int").alias("bucket"), nothing.cast("binary").alias("shared"),
            nothing.cast("binary").alias("lead"),
        ).distinct(),
        "suffix-side",
    )
    deal = in_blocks(docs, doc_id, text, n, keep).groupBy("block")
    for step, kind in _KINDS.items():
        send = partial(_send, dedup=dedup, buckets=buckets_for(n), upto=step)
        answers = ask(deal.cogroup(side.groupBy("block")).applyInArrow(send, SENT), kind)
        side = side.union(
            answers.select(
                "block", F.lit(step).alias("step"), nothing.cast("long").alias("key"),
                nothing.cast("tinyint").alias("first"), "bucket", "shared", "lead",
            )
        )
    kinds = dict(docs.dtypes)
    schema = ", ".join(
        [f"doc_id {kinds[doc_id]}", "n_bytes long, n_removed long, n_spans long, kept_sha256 string", "spans array<struct<start: long, end: long>>, kept_text string"]
        + [f"`{c}` {kinds[c]}" for c in keep]
    )
    finish = partial(_finish, dedup=dedup, buckets=buckets_for(n), keep=keep, kept_text=kept_text)
    return deal.cogroup(side.groupBy("block")).applyInArrow(finish, schema)
