"""Weak supervision over quality rules, in DataFrame expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.common import SPACE, once, stored

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"

#: ASCII digits and punctuation, as ranges.
_MARKS = "!-@\\[-`{-~"
#: Up to so many different repeated windows are looked up in a list, more are sorted.
_FEW = 16


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per document over its whole text; a null text counts as empty.

    Returns one row per input row: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, and for the rules ``n_lines``, ``n_distinct_words``,
    ``n_upper``, ``n_marks`` (ASCII digits and punctuation), ``n_symbol_words`` (words with a
    symbol), ``n_shouts`` (exclamation marks), ``n_stops`` (full stops).
    """
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), whole.alias("text"))
    rows = once(
        rows,
        words=F.filter(F.split("text", f"[{SPACE}]+"), lambda w: w != ""),
        lines=F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")),
    )
    n = F.size("words")

    def count_of(characters: str) -> Column:
        """How often a character of the class occurs."""
        return F.regexp_count("text", F.lit(f"[{characters}]")).cast("long")

    def count_of_one(character: str) -> Column:
        return (F.length("text") - F.length(F.replace("text", F.lit(character), F.lit("")))).cast("long")

    rows = once(
        rows,
        windows=F.transform(
            F.slice("words", 1, F.greatest(n - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        ),
    )
    rows = once(rows, sorted=F.sort_array("windows"))
    again = F.array_distinct(F.filter("sorted", lambda x, k: x == F.get("sorted", k - 1)))
    rows = once(rows, again=again)
    few = F.transform("windows", lambda x, i: F.when(F.array_contains("again", x), i))
    many = F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))
    # In order of (window, place), a repeated window stands next to its like.
    rows = once(rows, pairs=F.when(F.size("again") > _FEW, F.sort_array(many)))
    next_to_like = F.filter(
        "pairs",
        lambda x, k: (x.h == F.get("pairs", k - 1).h) | (x.h == F.get("pairs", k + 1).h),
    )
    places = (
        F.when(F.size("again") == 0, F.array().cast("array<int>"))
        .when(F.size("again") <= _FEW, F.array_compact(few))
        .otherwise(F.sort_array(F.transform(next_to_like, lambda x: x.i)))
    )
    rows = once(rows, repeated=places)
    # A repeated window covers three words, or as many as there are up to the next one.
    covered = F.aggregate(
        F.transform(
            "repeated",
            lambda i, k: F.least(F.lit(3), F.coalesce(F.get("repeated", k + 1) - i, F.lit(3))),
        ),
        F.lit(0),
        lambda a, x: a + x,
    )
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_words"),
        (F.length("text") - count_of_one(" ") - count_of(r"\x09-\x0D")).cast("long").alias("word_chars"),
        count_of(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        count_of("A-Z").alias("n_upper"),
        count_of(_MARKS).alias("n_marks"),
        # From its first symbol on, a word is one match.
        F.regexp_count("text", F.lit(f"[{SYMBOLS}][^{SPACE}]*")).cast("long").alias("n_symbol_words"),
        count_of_one("!").alias("n_shouts"),
        count_of_one(".").alias("n_stops"),
    )


def rules() -> dict[str, Column]:
    """Votes by name: 1 for good, 0 for bad, null where the rule abstains."""
    words, chars = F.col("n_words"), F.col("word_chars")

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, 0).when(good, 1)

    return {
        "length": vote(words < 20, words.between(50, 100_000)),
        "word_length": vote(
            (chars < 2 * words) | (chars > 15 * words), chars.between(3 * words, 11 * words)
        ),
        "symbols": vote(50 * F.col("n_symbols") > chars, 200 * F.col("n_symbols") < chars),
        "symbol_words": vote(
            10 * F.col("n_symbol_words") > words, 50 * F.col("n_symbol_words") < words
        ),
        "letters": vote(6 * F.col("n_marks") > chars, 12 * F.col("n_marks") < chars),
        "lines": vote(3 * F.col("n_dup_lines") > F.col("n_lines"), F.col("n_dup_lines") == 0),
        "repeats": vote(3 * F.col("n_repeat_words") > words, 20 * F.col("n_repeat_words") < words),
        "variety": vote(
            (words >= 20) & (8 * F.col("n_distinct_words") < words),
            3 * F.col("n_distinct_words") > words,
        ),
        "capitals": vote(4 * F.col("n_upper") > chars, 8 * F.col("n_upper") < chars),
        "shouts": vote(10 * F.col("n_shouts") > words, 50 * F.col("n_shouts") < words),
        "sentences": vote(
            (words >= 50) & (200 * F.col("n_stops") < words), 40 * F.col("n_stops") > words
        ),
    }


def estimate(
    counts: dict[tuple, int], rounds: int = 100, weight: float = 5.0
) -> tuple[float, list[tuple[float, float]]]:
    """Expectation-maximisation over vote patterns.

    Returns the share of good documents and, per rule, how likely its vote is bad given a
    good and given a bad document. A pattern holds 1, 0 or None per rule; rules err
    independently given the true class, and abstaining says nothing. ``weight`` votes at the start
    values steady rules that rarely vote. A bad vote is always likelier for bad documents,
    so no rule turns into its opposite. Without documents the start values come back.
    """
    width = len(next(iter(counts), ()))
    start = (0.02, 0.5)
    prior, errors = 0.9, [start] * width
    total = sum(counts.values())
    for _ in range(rounds if total else 0):
        good = 0.0
        bad_votes = [[weight * start[0], weight * start[1]] for _ in range(width)]
        voted = [[weight, weight] for _ in range(width)]
        for votes, n in counts.items():
            p = posterior(votes, prior, errors)
            good += n * p
            for j, v in enumerate(votes):
                if v is not None:
                    for c, share in enumerate((n * p, n * (1 - p))):
                        voted[j][c] += share
                        bad_votes[j][c] += share * (1 - v)
        prior = min(max(good / total, 0.02), 0.98)
        errors = []
        for (x, y), (n, m) in zip(bad_votes, voted, strict=True):
            if_good = min(max(x / n, 0.0005), 0.4)
            errors.append((if_good, min(max(y / m, 1.5 * if_good), 0.99)))
    return prior, errors


def evidence(errors: tuple[float, float]) -> tuple[float, float]:
    """What a good and a bad vote add to the log odds of good."""
    if_good, if_bad = errors
    return math.log((1 - if_good) / (1 - if_bad)), math.log(if_good / if_bad)


def posterior(votes: tuple, prior: float, errors: list[tuple[float, float]]) -> float:
    odds = math.log(prior / (1 - prior))
    for v, e in zip(votes, errors, strict=True):
        if v is not None:
            odds += evidence(e)[0 if v else 1]
    return 1 / (1 + math.exp(-odds))


def quality(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = 50,
    max_repeat_percent: int = 50,
    threshold: float = 0.5,
) -> DataFrame:
    """Posterior probability of good quality for each document, and the verdict.

    Rules vote or abstain on counts of the whole text; the accuracies of the rules
    and the share of good documents come from all documents by
    expectation-maximisation, and the posterior decides in place of a filter that
    wants every rule passed. The driver sees one row per vote pattern, at most 3 to
    the power of the number of rules. The text is read once; counts are stored.

    Null and empty texts have no words and fail the base. Equal rows give equal rows.
    An empty table gives an empty result. Other input columns are not looked at.
    """
    votes = rules()
    names = list(votes)
    rows = stored(
        measures(docs, doc_id, text).select("*", *[v.alias(f"vote_{k}") for k, v in votes.items()]),
        "quality",
    )
    columns = [f"vote_{k}" for k in names]
    counts = {
        tuple(r[:-1]): r[-1] for r in rows.groupBy(*columns).agg(F.count("*")).collect()
    }
    prior, errors = estimate(counts)
    odds = F.lit(math.log(prior / (1 - prior)))
    for column, e in zip(columns, errors or [(0.02, 0.5)] * len(names), strict=True):
        good, bad = evidence(e)
        odds = odds + F.when(F.col(column) == 1, good).when(F.col(column) == 0, bad).otherwise(0.0)
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    chance = 1 / (1 + F.exp(-odds))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (chance >= threshold)).alias("kept"),
        chance.alias("quality"),
    )
