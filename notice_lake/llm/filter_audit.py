"""What each filter of a chain removes, in every order of the filters."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.common import SPACE, once, stored


@dataclass(frozen=True)
class Edge:
    """Applying filter ``letter`` to what the filters of state ``before`` have left.

    ``reaching`` orders lead from no filter to ``before``, ``leaving`` ones from ``after`` to all filters.
    """

    before: int
    letter: str
    after: int
    reaching: int
    leaving: int


def lattice(letters: str) -> list[Edge]:
    """The edges between the sets of filters applied so far, with the orders that pass over each.

    States are bit masks. Forward, a state is reached by all orders that reach the states one filter
    smaller; backward, it is left by all that leave those one filter larger.
    """
    full = (1 << len(letters)) - 1
    bits = {c: 1 << i for i, c in enumerate(letters)}
    reaching, leaving = [0] * (full + 1), [0] * (full + 1)
    reaching[0] = leaving[full] = 1
    for state in range(full + 1):
        for bit in bits.values():
            if not state & bit:
                reaching[state | bit] += reaching[state]
    for state in range(full, -1, -1):
        for bit in bits.values():
            if state & bit:
                leaving[state ^ bit] += leaving[state]
    return [
        Edge(state, c, state | bit, reaching[state], leaving[state | bit])
        for state in range(full + 1)
        for c, bit in bits.items()
        if not state & bit
    ]


def _constant(rows: list[dict], fields: str) -> Column:
    """Rows that depend on the filters only, as one literal."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{fields}>>")


def audit(
    rows: DataFrame, letters: str, fails: str = "fails", part: str = "part", measures: Mapping[str, str] = {}
) -> DataFrame:
    """Each step of each order of the filters, per part.

    ``fails`` holds a bit mask per row: bit i is set if the row fails the filter of letter i. ``measures``
    names further results by the column, a number per row, that is summed over the rows removed.

    Returns for each value of ``part``, each order and step: ``part``, ``filter_order``, ``step``,
    ``kept``, ``removed``, ``redundant`` (rows failing the filter that an earlier one removed),
    ``unique_fails`` (rows failing this filter only), the measures, and ``shapley``: what the
    filter removes, summed over all orders.

    Rows are counted per part and mask before any shuffle, so a hot part is no hot spot; from there on a part
    is one row. What survives a set of filters makes a state; the difference of two neighbouring states is
    what the edge between them removes. The results of all orders are read from these edges; the
    Shapley sum weighs an edge by the orders that pass over it, reaching times leaving. Sizes grow with
    the number of filters (2^n states, n! orders), not with the rows. An empty table has no parts.
    A null in ``fails`` counts as failing nothing, one in a measure as 0.
    """
    edges = lattice(letters)
    number = {(e.before, e.letter): i for i, e in enumerate(edges)}
    bits = {c: 1 << i for i, c in enumerate(letters)}
    full = (1 << len(letters)) - 1
    mask = F.coalesce(F.col(f"`{fails}`"), F.lit(0)).cast("int")
    values = {"n": F.lit(1), **{m: F.coalesce(F.col(f"`{c}`"), F.lit(0)) for m, c in measures.items()}}
    counted = rows.groupBy(F.col(f"`{part}`").alias("part"), mask.alias("mask")).agg(
        *[F.sum(v).cast("long").alias(f"sum_{m}") for m, v in values.items()]
    )
    survives = [F.col("mask").bitwiseAND(F.lit(state)) == 0 for state in range(full + 1)]
    states = counted.groupBy("part").agg(
        *[
            F.array(*[F.coalesce(F.sum(F.when(s, F.col(f"sum_{m}"))), F.lit(0).cast("long")) for s in survives]).alias(f"left_{m}")
            for m in values
        ]
    )
    path = _constant(
        [{"before": e.before, "after": e.after, "letter": e.letter, "orders": e.reaching * e.leaving} for e in edges],
        "before: int, after: int, letter: string, orders: long",
    )

    def gone(left: str) -> Column:
        return F.transform(path, lambda e: F.get(left, e.before) - F.get(left, e.after))

    removals = once(states, **{f"gone_{m}": gone(f"left_{m}") for m in values})

    def per_letter(value) -> Column:
        return F.create_map(*[x for c in letters for x in (F.lit(c), value(c))])

    def weighed(letter: str) -> Column:
        of_letter = F.filter(F.zip_with(path, "gone_n", lambda e, n: F.struct(e.letter, (e.orders * n).alias("x"))), lambda y: y.letter == letter)
        return F.aggregate(of_letter, F.lit(0).cast("long"), lambda s, y: s + y.x)

    sums = once(
        removals,
        shapley=per_letter(weighed),
        failing=per_letter(lambda c: F.get("gone_n", F.lit(number[0, c]))),
        unique_fails=per_letter(lambda c: F.get("gone_n", F.lit(number[full ^ bits[c], c]))),
    )
    steps = []
    for order in map("".join, permutations(letters)):
        state = 0
        for step, c in enumerate(order, 1):
            steps.append({"filter_order": order, "step": step, "letter": c, "edge": number[state, c], "after": state | bits[c]})
            state |= bits[c]
    at = sums.select("*", F.inline(_constant(steps, "filter_order: string, step: int, letter: string, edge: int, after: int")))
    removed = F.get("gone_n", F.col("edge"))
    return at.select(
        "part",
        "filter_order",
        "step",
        F.get("left_n", F.col("after")).alias("kept"),
        removed.alias("removed"),
        (F.element_at("failing", F.col("letter")) - removed).alias("redundant"),
        F.element_at("unique_fails", F.col("letter")).alias("unique_fails"),
        *[F.get(f"gone_{m}", F.col("edge")).alias(m) for m in measures],
        F.element_at("shapley", F.col("letter")).alias("shapley"),
    )


#: The filters of ``failures``.
LETTERS = "ABCDE"


@dataclass(frozen=True)
class Limits:
    """``words`` at least; ``distinct`` words in hundredths of all at least; ``upper`` A-Z in hundredths of characters at most."""

    words: int = 50
    distinct: int = 65
    upper: int = 5
    symbols: str = "#$%&*|"


def failures(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``part``, ``fails`` (bits of ``LETTERS``), ``good`` and ``toxic`` (0 or 1), a row per document.

    A: too few words. B: too few distinct words. C: too many capitals. D: a symbol. E: the text of a
    document with a smaller id, anywhere in the table. ``part`` is the source, empty for null. A null text counts as
    empty. A document without an id neither fails E nor makes others fail, and has no labels. Rows that share an id do not make
    each other fail. A document is good (toxic) if any label row of its id has quality (toxic) 1.

    Texts stay where they are read: what is shuffled is a digest per document. A row fails E if
    it is not the first of its text, so rows meet the first ones by text and id together, and a text that a third of
    all documents share is spread by its ids. No text is compared but by SHA-256.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")
    rows = once(docs.select("doc_id", "source", text.alias("text")), words=words)
    n = F.size("words")
    checks = (
        n < limits.words,
        100 * F.size(F.array_distinct("words")) < limits.distinct * n,
        100 * F.regexp_count("text", F.lit("[A-Z]")) > limits.upper * F.length("text"),
        F.col("text").rlike(f"[{limits.symbols}]"),
    )
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(checks)), F.lit(0))
    slim = stored(
        rows.select(
            "doc_id",
            F.coalesce("source", F.lit("")).alias("part"),
            F.unhex(F.sha2("text", 256)).alias("digest"),
            mask.alias("fails"),
        ),
        "audit-rows",
    )
    first = slim.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = stored(first.withColumn("is_first", F.lit(True)), "audit-first")
    marks = stored(
        labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
            *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))]
        ),
        "audit-labels",
    )
    again = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return slim.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left").select(
        "part",
        (F.col("fails") + F.when(again, 1 << len(checks)).otherwise(0)).alias("fails"),
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )
