"""URL filter: rules, and a ratio of two character language models, in DataFrame expressions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.common import ascii_lower, stored

_START, _END = "\x02", "\x03"

#: (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


@dataclass(frozen=True)
class UrlModel:
    """``order``: characters of context. ``fold``: one in so many judged URLs calibrates.

    ``alphabet``: size of the uniform distribution that the shortest context falls back on.
    """

    order: int = 4
    fold: int = 5
    alphabet: int = 256


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty for null and for URLs without ``://``."""
    found = F.coalesce(F.instr(url, "://"), F.lit(0)) > 0
    rest = F.substring_index(F.substring_index(F.when(found, F.substring(url, F.instr(url, "://") + 3, F.length(url))), "?", 1), "#", 1)
    host = F.substring_index(rest, "/", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def whole(url: Column) -> Column:
    """The URL with its host in lower case, from scheme to fragment; any other text as it stands, null as empty."""
    begin = F.instr(url, "://") + 3
    host = parts(url)[0]
    lowered = F.concat(F.substring(url, F.lit(1), begin - 1), host, F.substring(url, begin + F.length(host), F.length(url)))
    return F.coalesce(F.when(F.instr(url, "://") > 0, lowered).otherwise(url), F.lit(""))


def by_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, written as host and path, and its verdict; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def grams(texts: DataFrame, order: int) -> DataFrame:
    """Every character of ``text`` with the ``order`` characters before it, as rows ``gram``."""
    padded = F.concat(F.lit(_START * order), "text", F.lit(_END))
    # The characters are made once per text, as the one element of an outer array; each gram takes its few.
    each = F.transform(
        F.array(F.split(padded, "")),
        lambda chars: F.transform(
            F.sequence(F.lit(1), F.size(chars) - order), lambda i: F.array_join(F.slice(chars, i, order + 1), "")
        ),
    )
    return texts.withColumn("gram", F.explode(F.flatten(each))).drop("text")


def ratios(counts: DataFrame, wanted: DataFrame, model: UrlModel) -> DataFrame:
    """Log of accepted over rejected probability of each wanted gram, in millionths.

    ``counts`` has ``gram`` and its number in the two classes, ``yes`` and ``no``. The
    probability of a character after a context mixes what was seen there with the
    probability after the context shortened by one, in the proportion of
    characters seen to kinds of characters seen there; a context never seen leaves
    all to the shorter one.
    """
    rows = wanted.withColumns({f"p_{c}": F.lit(1.0 / model.alphabet) for c in ("yes", "no")})
    for k in range(model.order + 1):
        suffix = F.substring("gram", model.order + 1 - k, k + 1)
        context = F.substring("gram", model.order + 1 - k, k)
        seen = stored(
            counts.groupBy(suffix.alias("suffix"))
            .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")),
            "url-seen",
        )
        after = stored(
            seen.groupBy(F.substring("suffix", 1, k).alias("context")).agg(
                *[F.sum(c).alias(f"n_{c}") for c in ("yes", "no")],
                *[F.count(F.when(F.col(c) > 0, 1)).alias(f"t_{c}") for c in ("yes", "no")],
            ),
            "url-after",
        )
        rows = (
            rows.withColumn("suffix", suffix).withColumn("context", context)
            .join(seen, "suffix", "left").join(after, "context", "left")
            .na.fill(0, ["yes", "no", "n_yes", "n_no", "t_yes", "t_no"])
        )
        mixed = {
            f"p_{c}": F.when(
                F.col(f"n_{c}") > 0,
                (F.col(c) + F.col(f"t_{c}") * F.col(f"p_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}")),
            ).otherwise(F.col(f"p_{c}"))
            for c in ("yes", "no")
        }
        rows = rows.withColumns(mixed).select("gram", "p_yes", "p_no")
    return rows.select("gram", F.round(1e6 * F.log(F.col("p_yes") / F.col("p_no"))).cast("long").alias("ratio"))


def threshold(scores: DataFrame) -> float:
    """The score that splits judged URLs best, by the mean of the two classes' shares judged right.

    From a histogram of at most 401 steps; the middle of the best steps. 0, which allows what scores alike for both
    classes, if a class is missing or no step is better than one verdict for all.
    """
    step = F.least(F.greatest(F.round(F.col("score") * 20), F.lit(-200)), F.lit(200)).cast("int")
    found = {
        r["step"]: (r["yes"], r["no"])
        for r in scores.groupBy(step.alias("step")).agg(
            F.count(F.when(F.col("allowed"), 1)).alias("yes"),
            F.count(F.when(~F.col("allowed"), 1)).alias("no"),
        ).collect()
    }
    yes, no = (sum(v[i] for v in found.values()) for i in (0, 1))
    if not yes or not no:
        return 0.0
    best, at, kept, dropped = -1.0, [], yes, 0
    for k in range(-200, 202):  # allowed from step k on
        value = kept / yes + dropped / no
        if value > best + 1e-12:
            best, at = value, []
        if value > best - 1e-12:
            at.append(k)
        a, b = found.get(k, (0, 0))
        kept, dropped = kept - a, dropped + b
    if best < 1 + 1e-9:
        return 0.0
    return (at[len(at) // 2] - 0.5) / 20


def filter_urls(
    pages: DataFrame,
    rules=RULES,
    model: UrlModel = UrlModel(),
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Verdict on each URL: that of the longest rule that fits, else of two language models.

    The models read whole URLs, scheme, query string and fragment included; rules read host and path. They learn from
    all distinct URLs that rules allow and block;
    one in ``model.fold`` of these is left out of the counts and calibrates the
    threshold. A URL's score is the mean over its characters of the log ratio of
    the two probabilities. Ratios are whole millionths, so sums do not depend on their order.

    The number of different grams is bounded by the alphabet to the power of ``order + 1``;
    they are joined by shuffles, never broadcast by hint. A URL that many pages share is scored once.

    Null URLs and URLs without ``://`` have an empty host and path; the first are scored as the empty text, the others as
    they stand. Equal rows give equal rows. An empty table gives an empty result. Where the
    rules judge no URL at all, all scores are 0 and the verdict is ``allow``. Other input
    columns are not looked at.
    """
    host, path = parts(F.col(f"`{url}`"))
    text = whole(F.col(f"`{url}`")).alias("text")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), host.alias("host"), path.alias("path"), text)
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    # Grams carry a digest of their URL, not the URL: a long one would be as many copies of itself.
    rows = stored(rows.withColumns({"rule": rule, "ruled": verdict, "id": F.sha2("text", 256)}), "urls")
    texts = stored(
        rows.select("text", "id", "ruled").distinct()
        .withColumn("held", F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(model.fold)) == 0),
        "url-texts",
    )
    learned = (~F.col("held")) & F.col("ruled").isNotNull()
    each = stored(
        grams(texts.withColumn("class", F.when(learned, F.col("ruled"))).select("text", "class"), model.order)
        .groupBy("gram").agg(
            F.count(F.when(F.col("class") == "allow", 1)).alias("yes"),
            F.count(F.when(F.col("class") == "block", 1)).alias("no"),
        ),
        "url-grams",
    )
    table = stored(ratios(each.where("yes + no > 0"), each.select("gram"), model), "url-ratios")
    scored = stored(
        grams(texts, model.order).join(table, "gram")
        .groupBy("id", "ruled", "held")
        .agg((F.sum("ratio") / F.count("*") / 1e6).alias("score")),
        "url-scores",
    )
    cut = threshold(scored.where("held AND ruled IS NOT NULL").select("score", (F.col("ruled") == "allow").alias("allowed")))
    scores = stored(scored.select("id", "score"), "url-by-text")
    by_model = F.when(F.col("score") >= cut, "allow").otherwise("block")
    return (
        rows.join(scores, "id", "left")
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce("ruled", by_model).alias("verdict"),
            "score", F.lit(cut).alias("threshold"),
        )
    )
