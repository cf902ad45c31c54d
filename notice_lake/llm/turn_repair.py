"""Cheapest repair of the turn structure of conversations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.common import SPACE, stored

# States of a reader of ``(s?(ua)+)?``: nothing read, after s, after u, after a. All but after s and u may end.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: The state after the user or assistant turn that each state waits for.
_AFTER = (_USER, _USER, _ASSISTANT, _USER)
_WAITS_FOR = "uuau"
_END = (0, 6, 3, 0)

#: Symbols: a row that must go; a whole row by its initial (s, u, a, other); a truncated row likewise.
_MUST_GO, _INITIALS, _TRUNCATED = 0, "sua", 4
SYMBOLS = 9

KEEP, REROLE, DELETE, INSERT, LEFT_TRUNCATED = 0, 3, 4, 3, 3


def _kept(state: int, initial: str) -> int | None:
    """The state after a turn with this initial; none if it cannot come here."""
    if initial == "s" and state == _START:
        return _SYSTEM
    return _AFTER[state] if initial == _WAITS_FOR[state] else None


def _row_edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of the edits that take a row, letters ascending."""
    edits = [("D", DELETE, state)]
    if symbol != _MUST_GO:
        truncated, initial = divmod(symbol - 1, _TRUNCATED)
        more = LEFT_TRUNCATED * truncated
        kept = _kept(state, f"{_INITIALS} "[initial])
        if kept is not None:
            edits.append(("K", KEEP + more, kept))
        edits.append(("R", REROLE + more, _AFTER[state]))
    return edits


def _before(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Least costs to the end from each state before a row, from those after it."""
    taken = [min(c + costs[t] for _, c, t in _row_edits(symbol, q)) for q in range(4)]
    one = [min(taken[q], INSERT + taken[_AFTER[q]]) for q in range(4)]
    return tuple(min(taken[q], INSERT + one[_AFTER[q]]) for q in range(4))


class BlockTables:
    """Transitions of normalised cost vectors over every block of ``width`` symbols.

    A vector holds the least cost to the end from each of the four states, less the least of them. From any
    state any other's way can be followed at a bounded price, so few vectors occur. All are
    found from the vector at the end; a block's transition is put together from those of its symbols.
    """

    def __init__(self, width: int = 4):
        self.width = width
        self.vectors = [tuple(x - min(_END) for x in _END)]
        number = {self.vectors[0]: 0}
        step, add = [], []
        for vector in self.vectors:  # grows while new vectors are found
            for symbol in range(SYMBOLS):
                costs = _before(vector, symbol)
                least = min(costs)
                new = tuple(c - least for c in costs)
                if new not in number:
                    number[new] = len(self.vectors)
                    self.vectors.append(new)
                step.append(number[new])
                add.append(least)
        n = len(self.vectors)
        steps, adds = (np.array(x).reshape(n, SYMBOLS) for x in (step, add))
        self.step, self.add = steps.tolist(), adds.tolist()
        #: By vector after the block and the block's symbols, the first the highest digit.
        block, more = np.arange(n)[:, None], np.zeros((n, 1), np.int64)
        for _ in range(width):
            # One symbol further to the front.
            more = (more[:, None, :] + adds[block].transpose(0, 2, 1)).reshape(n, -1)
            block = steps[block].transpose(0, 2, 1).reshape(n, -1)
        self.block, self.more = block.tolist(), more.tolist()
        self._moves: dict[tuple[int, int, int], tuple[str, int]] = {}

    def _move(self, after: int, symbol: int, state: int) -> tuple[str, int]:
        """Letters of least cost, ASCII-least of these, from before a row in ``state`` to after it."""
        key = (after, symbol, state)
        if key not in self._moves:
            later, here = self.vectors[after], _before(self.vectors[after], symbol)
            letters, q = "", state
            while not letters or letters[-1] == "I":
                ways = [(x, c + later[t], t) for x, c, t in _row_edits(symbol, q)]
                ways.append(("I", INSERT + here[_AFTER[q]], _AFTER[q]))
                letter, _, q = min(w for w in ways if w[1] == here[q])
                letters += letter
            self._moves[key] = (letters, q)
        return self._moves[key]

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """Least cost, and the ASCII-least string of edits that has it.

        Blocks are looked up from the last to the first, which leaves the vector after each. A block is then
        expanded backward from that vector, so that the least cost to the end is known at every row, and read forward: at each
        row the first letter that loses nothing is taken, which is right for ties too.
        """
        vector, cost, end = 0, 0, len(symbols)
        pieces = []
        while end >= self.width:
            pieces.append((end - self.width, end, vector))
            code = 0
            for s in symbols[end - self.width : end]:
                code = code * SYMBOLS + s
            cost += self.more[vector][code]
            vector = self.block[vector][code]
            end -= self.width
        if end:
            pieces.append((0, end, vector))
            for s in reversed(symbols[:end]):
                cost += self.add[vector][s]
                vector = self.step[vector][s]
        cost += self.vectors[vector][_START]
        letters, state = [], _START
        for begin, end, vector in reversed(pieces):
            inner = [vector]
            for s in reversed(symbols[begin + 1 : end]):
                inner.append(self.step[inner[-1]][s])
            for s, after in zip(symbols[begin:end], reversed(inner), strict=True):
                some, state = self._move(after, s, state)
                letters.append(some)
        letters.append("I" * (_END[state] // INSERT))
        return cost, "".join(letters)


def roles(audit: str) -> Iterator[str | None]:
    """For each letter of an audit, the role of the turn that it leaves; none for a deletion.

    An odd number of turns starts with a system turn, all others take turns as user and assistant.
    """
    odd = (len(audit) - audit.count("D")) % 2
    place = 0
    for letter in audit:
        if letter == "D":
            yield None
        else:
            yield "system" if place < odd else ("user", "assistant")[(place - odd) % 2]
            place += 1


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` with faults, chosen by ``crc32("conv_id:turn") % 20``.

    0 drops a row, 1 empties its text, 2 takes out ``.``, ``!`` and ``?``, 3 repeats it, 4 makes its role user. A null counts
    as one space in the key, in role and in text; ``conv_id`` and ``turn`` stay null.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key) % 20).alias("fault"),
    )
    fault = F.col("fault")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("_copy")
    ).drop("_copy")


#: Types that conversation ids may have.
_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}

#: The order of a conversation's rows.
_ORDER = ("conv_id", "lead", "turn", "role", "digest")


def _in_order(rows: DataFrame) -> DataFrame:
    """Conversations whole in a partition, their rows in order. Sorting spills; no conversation is gathered into a row."""
    return rows.repartition("conv_id").sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in _ORDER])


def _symbols(turns: DataFrame) -> DataFrame:
    """Equal rows of a conversation as one: their number, faults, and whether their text came before."""
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    truncated = ~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")
    slim = stored(
        turns.select(
            "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), blank.alias("blank"), truncated.alias("truncated")
        )
        .groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.count("*").alias("copies")),
        "repair-rows",
    )
    # The first turn of each text; a null turn comes before all others.
    first = slim.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first"))
    first = stored(
        first.select(*[F.col(c).alias(f"of_{c}") for c in ("conv_id", "role", "digest")], F.col("first.turn").alias("of_turn"), F.lit(True).alias("new")),
        "repair-first",
    )
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("conv_id", "role", "digest", "turn")]
    return slim.join(first, same, "left").select(
        "conv_id", F.lit(1).alias("lead"), "turn", "role", "digest", "blank", "truncated", "copies", F.coalesce("new", F.lit(False)).alias("new")
    )


@dataclass
class _Case:
    """A conversation while its rows come by."""

    conv_id: int | None
    symbols: bytearray
    initials: str | None = None
    least: int | None = None
    last: int | None = None
    turns: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0

    def take(self, turn: int | None, role: str, blank: bool, truncated: bool, copies: int, new: bool) -> None:
        if turn is not None:
            if self.least is None:
                self.least = turn
            if turn != self.last:
                self.turns += 1
            self.last = turn
        initial = role[:1]
        if self.initials is not None and self.initials + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.illegal += copies - 1
        self.initials = initial
        again = copies - 1 if new else copies
        if blank:
            self.blank += copies
            self.symbols.extend(bytes([_MUST_GO]) * copies)
            return
        if new:
            place = _INITIALS.find(initial) if initial else -1
            self.truncated += truncated
            self.symbols.append(1 + (place if place >= 0 else len(_INITIALS)) + _TRUNCATED * truncated)
        self.duplicate += again
        self.symbols.extend(bytes([_MUST_GO]) * again)

    def result(self, tables: BlockTables) -> dict:
        cost, audit = tables.repair(bytes(self.symbols))
        gaps = 0 if self.least is None else self.last - self.least + 1 - self.turns
        return {
            "conv_id": self.conv_id, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate,
            "truncated": self.truncated, "illegal": self.illegal, "cost": cost, "audit": audit,
        }


def _audited(batches: Iterator[pa.RecordBatch], *, width: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    tables, case = BlockTables(width), None
    for batch in batches:
        done = []
        for conv_id, lead, *row in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "lead", "turn", "role", "blank", "truncated", "copies", "new")], strict=True):
            if not lead:
                if case is not None:
                    done.append(case.result(tables))
                case = _Case(conv_id, bytearray())
            else:
                case.take(*row)
        yield pa.RecordBatch.from_pylist(done, schema)
    if case is not None:
        yield pa.RecordBatch.from_pylist([case.result(tables)], schema)


def audits(turns: DataFrame, conversations: DataFrame, width: int = 4) -> DataFrame:
    """The faults of each conversation and its cheapest repair.

    ``turns`` has ``conv_id``, ``turn`` (whole number), ``role``, ``text``; the rows of a conversation come by turn,
    nulls first, then by role and by the text's SHA-256. ``conversations`` names in ``conv_id`` all to report on, repeats allowed, and must name
    those of ``turns``. Rows without ``conv_id`` are one conversation. A null role or text counts as empty.

    A row is blank (nothing but white space), else a duplicate (its role and text came before), else truncated (it
    does not end in ``.``, ``!`` or ``?``, white space aside). Edits: keep a row (K, 0), give it the role
    user or assistant (R, 3), delete it (D, 4; a must for blank ones and duplicates), insert an empty user or assistant turn
    anywhere (I, 3); a truncated row that stays costs 3 more. The roles must read ``(s?(ua)+)?`` by their initials.

    Returns ``conv_id``, ``gaps`` (turns missing between the least and the largest), ``blank``, ``duplicate``,
    ``truncated``, ``illegal`` (neighbours whose initials are not su, ua or au), ``cost``, ``audit`` (the letters of the
    cheapest edits in order, the ASCII-least of equally cheap ones). A conversation without rows has zeros and an empty audit.

    Texts are read once and stay where they are; what is shuffled is a digest and two flags per row. Duplicates are found by joining rows with
    the first of their text, so that a text in a third of all rows is spread by its turns. A conversation's rows then come by in order, one byte of each
    is kept, as the audit keeps one, and blocks of ``width`` symbols are looked up (``BlockTables``).
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    symbols = _symbols(rows)
    nothing = {f.name: f.dataType for f in symbols.schema if f.name not in ("conv_id", "lead")}
    heads = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("lead"), *[F.lit(None).cast(kind).alias(c) for c, kind in nothing.items()]
    )
    kind = dict(turns.dtypes)["conv_id"]
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in longs)}, audit string"
    arrow = pa.schema([("conv_id", _ARROW[kind]), *[(c, pa.int64()) for c in longs], ("audit", pa.string())])
    return _in_order(heads.unionByName(symbols)).mapInArrow(partial(_audited, width=width, schema=arrow), schema)


def _repaired(batches: Iterator[pa.RecordBatch], *, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    edits: Iterator[tuple[str, str | None]] = iter(())
    conv_id, place, more = None, 0, False

    def inserted(out: list[dict]) -> tuple[str, str | None] | None:
        """Writes the insertions that come now; the next edit of a row, if any is left."""
        nonlocal place
        for letter, role in edits:
            if letter != "I":
                return letter, role
            out.append({"conv_id": conv_id, "place": place, "role": role, "text": "", "edit": "I"})
            place += 1
        return None

    for batch in batches:
        out: list[dict] = []
        for own_id, lead, role, text, audit in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "lead", "role", "text", "audit")], strict=True):
            if not lead:
                if more:
                    inserted(out)
                conv_id, place, more = own_id, 0, True
                edits = zip(audit, roles(audit), strict=True)
                continue
            letter, given = inserted(out)
            if letter != "D":
                out.append({"conv_id": conv_id, "place": place, "role": role if letter == "K" else given, "text": text, "edit": letter})
                place += 1
        yield pa.RecordBatch.from_pylist(out, schema)
    if more:
        out = []
        inserted(out)
        yield pa.RecordBatch.from_pylist(out, schema)


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """The turns that the audits leave: ``conv_id``, ``place`` (from 0), ``role``, ``text``, ``edit`` (K, R or I).

    ``audited`` is what ``audits`` returned for these turns, best stored. Texts are shuffled once; each conversation's
    audit comes by before its rows. The rows of a conversation lie in one partition, in order.
    """
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    rows = turns.select("conv_id", F.lit(1).alias("lead"), F.col("turn").cast("long").alias("turn"), *text, F.lit(None).cast("string").alias("audit"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    none = [F.lit(None).cast(k).alias(c) for c, k in (("turn", "long"), ("role", "string"), ("text", "string"), ("digest", "binary"))]
    heads = audited.select("conv_id", F.lit(0).alias("lead"), "audit", *none)
    kind = dict(turns.dtypes)["conv_id"]
    arrow = pa.schema([("conv_id", _ARROW[kind]), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])
    schema = f"conv_id {kind}, place long, role string, text string, edit string"
    return _in_order(heads.unionByName(rows)).mapInArrow(partial(_repaired, schema=arrow), schema)


def _hashed(batches: Iterator[pa.RecordBatch], *, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    conv_id, digest = None, None
    for batch in batches:
        done = []
        for own_id, place, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text")], strict=True):
            if place == 0:
                if digest is not None:
                    done.append({"conv_id": conv_id, "repaired_sha256": digest.hexdigest()})
                conv_id, digest = own_id, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_pylist(done, schema)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": conv_id, "repaired_sha256": digest.hexdigest()}], schema)


def digests(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with ``repaired_sha256``: of each conversation's repaired turns as ``role:text``, joined by newlines.

    Rows are hashed as ``repaired`` passes them on, one after another; no conversation is put together.
    """
    kind = dict(turns.dtypes)["conv_id"]
    arrow = pa.schema([("conv_id", _ARROW[kind]), ("repaired_sha256", pa.string())])
    hashes = repaired(turns, audited).mapInArrow(partial(_hashed, schema=arrow), f"conv_id {kind}, repaired_sha256 string")
    hashes = hashes.withColumnRenamed("conv_id", "_of")
    whole = F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")
    joined = audited.join(hashes, audited.conv_id.eqNullSafe(hashes["_of"]), "left")
    return joined.select(*[audited[c] for c in audited.columns], whole)
