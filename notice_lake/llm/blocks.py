"""Texts as byte arrays in blocks: rolling digests, and finding digests that occur more than once.

Spark deals documents to blocks by a hash and hands a task one block at a time. Inside a
block everything is array work on the texts' UTF-8 bytes. Blocks exchange digests through
buckets: a block sends each bucket its digests as one packed value, in an order that the
block can work out again, so the answer is two bits per digest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BASE = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_CODES = np.random.Generator(np.random.PCG64(20)).integers(0, 2**64, (2, 256), dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def in_blocks(docs: DataFrame, doc_id: str, text: str, n_blocks: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """``block``, ``key`` of id and text, ``doc_id``, ``text`` (empty for null) and the columns ``keep``."""
    key, whole = row_key(doc_id, text), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(
        block_of(key, n_blocks).alias("block"),
        key.alias("key"),
        F.col(f"`{doc_id}`").alias("doc_id"),
        whole.alias("text"),
        *[F.col(f"`{c}`") for c in keep],
    )


def row_key(doc_id: str, text: str) -> Column:
    """Tells apart rows that share an id, and spreads rows without one."""
    return F.xxhash64(F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit("")))


def block_of(key: Column, n_blocks: int) -> Column:
    return F.pmod(key, F.lit(n_blocks)).cast("int")


@dataclass
class Texts:
    """The bytes of several texts in one array."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, column: pa.ChunkedArray) -> Texts:
        array = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks] or [pa.array([], pa.large_binary())])
        ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
        raw = array.buffers()[2] if len(array) else None
        data = np.frombuffer(raw, np.uint8)[ends[0] : ends[-1]] if raw is not None else np.zeros(0, np.uint8)
        return cls(data, ends[:-1] - ends[0], np.diff(ends))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; one to one."""
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def _powers_of(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base modulo 2^32, and of its inverse; kept for the next block."""
    if which not in _powers or len(_powers[which][0]) < n:
        both = []
        for base in (_BASE[which], pow(_BASE[which], -1, 2**32)):
            p = np.full(n, base & 0xFFFFFFFF, np.uint32)
            p[:1] = 1
            both.append(np.multiply.accumulate(p))
        _powers[which] = (both[0], both[1])
    return _powers[which]


#: Moduli of ``Rolling``, the largest primes below 2^31.
_PRIMES = (2_147_483_647, 2_147_483_629)


def _prime_powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base modulo a prime, and of its inverse; kept for the next block."""
    key, prime = len(_BASE) + which, _PRIMES[which]
    if key not in _powers or len(_powers[key][0]) < n:
        base = _BASE[which] % prime
        both = []
        for factor in (base, pow(base, -1, prime)):
            p = np.ones(n, np.uint32)
            done, step = 1, factor
            while done < n:
                more = min(done, n - done)
                p[done : done + more] = p[:more].astype(np.uint64) * np.uint64(step) % np.uint64(prime)
                done, step = done + more, step * step % prime
            both.append(p)
        _powers[key] = (both[0], both[1])
    return _powers[key]


class Rolling:
    """64-bit digests of any stretches of an array of bytes: polynomials modulo two primes.

    Modulo a power of two, texts can be made that differ and have equal digests whatever the base.
    """

    def __init__(self, data: np.ndarray):
        self._sums, self._down = [], []
        for which, prime in enumerate(_PRIMES):
            up, down = _prime_powers(which, len(data) + 1)
            values = (_CODES[which] % np.uint64(prime))[data]
            values *= up[: len(data)]
            values %= np.uint64(prime)
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values, out=sums[1:])
            self._sums.append(sums)
            self._down.append(down)

    def digest(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = np.zeros(len(start), np.uint64)
        for sums, down, prime in zip(self._sums, self._down, _PRIMES, strict=True):
            values = sums[end] - sums[start]
            values %= np.uint64(prime)
            values *= down[start]
            values %= np.uint64(prime)
            found <<= np.uint64(31)
            found |= values
        return mixed(found)


def short_digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """32-bit digests, independent of those of ``Rolling``; they only choose a bucket."""
    up, down = _powers_of(1, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint32)
    values = _CODES[1].astype(np.uint32)[data]
    values *= up[: len(data)]
    np.cumsum(values, out=sums[1:])
    values = sums[end] - sums[start]
    values *= down[start]
    values ^= values >> np.uint32(16)
    values *= np.uint32(0x85EBCA6B)
    return values ^ (values >> np.uint32(13))


#: So many blocks share a bucket of digests: what they send it is at most about what one of them works with.
_PER_BUCKET = 4


def buckets_for(n_blocks: int) -> int:
    return -(-n_blocks // _PER_BUCKET)


def share_of(digest: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each 32-bit digest: equal ranges of digests."""
    bucket = (digest.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
    return bucket.astype(np.uint16 if buckets <= 1 << 16 else np.int32)


class Outbox:
    """Digests of a block for one exchange. Each is sent once, however often the block has it."""

    def __init__(self, bucket: np.ndarray, value: np.ndarray, known: np.ndarray | None = None):
        """``known``: entries that are known to occur more than once."""
        order = np.argsort(value, kind="stable")
        ranked, ranked_bucket = value[order], bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (ranked[1:] != ranked[:-1]) | (ranked_bucket[1:] != ranked_bucket[:-1])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        often = np.diff(np.append(first, len(order))) > 1
        if known is not None and len(first):
            often |= np.logical_or.reduceat(known[order], first)
        by_bucket = np.argsort(ranked_bucket[first], kind="stable")
        place = np.empty(len(first), np.int64)
        place[by_bucket] = np.arange(len(first))
        #: Of each entry, its place among what is sent.
        self.place = np.empty(len(order), np.int64)
        self.place[order] = place[group]
        #: Of each sent digest, the first entry that has it, and whether it occurs more than once.
        self.first, self.often = order[first][by_bucket], often[by_bucket]
        self.bucket, self.value = bucket[self.first], value[self.first]

    def _cuts(self) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.flatnonzero(np.diff(self.bucket.astype(np.int64), prepend=-1))
        return self.bucket[cuts], np.append(cuts, len(self.bucket))

    def rows(self, block: int, kind: type) -> pa.Table:
        buckets, cuts = self._cuts()
        value = self.value.astype(kind)
        pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.table(
            {
                "bucket": pa.array(buckets, pa.int32()),
                "block": pa.array(np.full(len(buckets), block), pa.int32()),
                "value": pa.array([value[a:b].tobytes() for a, b in pieces], pa.binary()),
                "often": pa.array([np.packbits(self.often[a:b]).tobytes() for a, b in pieces], pa.binary()),
            }
        )

    def answered(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Of each sent digest, whether it occurs more than once anywhere, and whether this block leads it."""
        shared, lead = self.often.copy(), np.ones(len(self.often), bool)
        buckets, cuts = self._cuts()
        at = dict(zip(buckets.tolist(), zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), strict=True))
        for b, yes, first in zip(*(answers[c].to_pylist() for c in ("bucket", "shared", "lead")), strict=True):
            a, e = at[b]
            shared[a:e] |= np.unpackbits(np.frombuffer(yes, np.uint8), count=e - a).view(bool)
            lead[a:e] = np.unpackbits(np.frombuffer(first, np.uint8), count=e - a).view(bool)
        return shared, lead


SENT = "bucket int, block int, value binary, often binary"
ANSWER = "bucket int, block int, shared binary, lead binary"


def answer(sent: pa.Table, kind: type) -> pa.Table:
    """For one bucket: sorts what all blocks sent, and compares neighbours.

    Tells each block which of its digests occur more than once, and which of these no block
    with a smaller number has.
    """
    sent = sent.sort_by("block")
    size = np.dtype(kind).itemsize
    pieces = sent["value"].to_pylist()
    values = np.frombuffer(b"".join(pieces), kind)
    counts = [len(x) // size for x in pieces]
    often = [np.unpackbits(np.frombuffer(o, np.uint8), count=n) for o, n in zip(sent["often"].to_pylist(), counts, strict=True)]
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    first = np.flatnonzero(new)
    total = np.diff(np.append(first, len(order)))
    if len(first):
        total = total + np.add.reduceat(np.concatenate(often)[order].astype(np.int64), first)
    shared, lead = np.empty(len(order), bool), np.empty(len(order), bool)
    shared[order] = np.repeat(total > 1, np.diff(np.append(first, len(order))))
    lead[order] = new
    ends = np.cumsum([0, *counts])
    rows = [
        (block, np.packbits(shared[a:b]).tobytes(), np.packbits(lead[a:b]).tobytes())
        for block, a, b in zip(sent["block"].to_pylist(), ends[:-1], ends[1:], strict=True)
        if shared[a:b].any()
    ]
    return pa.table(
        {
            "bucket": pa.array([sent["bucket"][0].as_py()] * len(rows), pa.int32()),
            "block": pa.array([r[0] for r in rows], pa.int32()),
            "shared": pa.array([r[1] for r in rows], pa.binary()),
            "lead": pa.array([r[2] for r in rows], pa.binary()),
        }
    )


def ask(sent: DataFrame, kind: type) -> DataFrame:
    def of_bucket(rows: pa.Table) -> pa.Table:
        return answer(rows, kind)

    return sent.groupBy("bucket").applyInArrow(of_bucket, ANSWER)
