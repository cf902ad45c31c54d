"""Toxicity: a linear classifier that is penalised when a change of identity terms changes a score.

Pairs come from the labelled sentences: one that names a group is paired with itself naming another, a neutral one that
names none with itself mentioning one. What the penalty sees is the features in which the two differ.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notice_lake.llm.blocks import Rolling, Texts, mixed

#: Terms of a group are swapped for one another. By language; a spelling stands in one group only.
IDENTITY_TERMS_BY_LANGUAGE = {
    "en": (
        ("women", "men"),
        ("woman", "man"),
        ("girls", "boys"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("black", "white", "asian", "latino"),
        ("gay", "straight", "lesbian", "bisexual"),
        ("immigrants", "natives"),
        ("disabled", "abled"),
        ("old", "young"),
    ),
    "de": (
        ("frauen", "männer"),
        ("frau", "mann"),
        ("mädchen", "jungen"),
        ("muslime", "christen", "juden", "buddhisten", "atheisten"),
        ("schwarze", "weiße", "asiaten"),
        ("schwule", "lesben", "heterosexuelle"),
        ("einwanderer", "einheimische"),
        ("behinderte", "nichtbehinderte"),
        ("alte", "junge"),
    ),
    "fr": (
        ("femmes", "hommes"),
        ("femme", "homme"),
        ("filles", "garçons"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
        ("noirs", "blancs", "asiatiques"),
        ("homosexuels", "hétérosexuels", "lesbiennes"),
        ("immigrés", "autochtones"),
        ("handicapés", "valides"),
        ("vieux", "jeunes"),
    ),
    "es": (
        ("mujeres", "hombres"),
        ("mujer", "hombre"),
        ("niñas", "niños"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
        ("negros", "blancos", "asiáticos"),
        ("homosexuales", "heterosexuales", "lesbianas"),
        ("inmigrantes", "nativos"),
        ("discapacitados", "capacitados"),
        ("viejos", "jóvenes"),
    ),
}
IDENTITY_TERMS = tuple(group for groups in IDENTITY_TERMS_BY_LANGUAGE.values() for group in groups)


@dataclass(frozen=True)
class Toxicity:
    """``sample_rows`` bounds the labelled rows that the fit sees, ``features`` their features.

    ``fold``: rows whose id has CRC-32 divisible by it teach nothing. ``fairness`` weighs the
    squared change of a score when identity terms are swapped or, with ``mentions``, when a neutral sentence without
    any mentions a group; ``ridge`` weighs the squared weights.
    ``levels``: how often a feature must occur for its further levels, and how often per byte of text.
    """

    sample_rows: int = 20_000
    features: int = 2_000
    fold: int = 5
    hash_bits: int = 20
    prefixes: tuple[int, ...] = (3, 4, 5, 6)
    levels: tuple[tuple[int, float], ...] = ((2, 0.0006), (3, 0.0015))
    fairness: float = 1.0
    ridge: float = 1e-4
    steps: int = 300
    slice_bytes: int = 2_000_000
    identity_terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS
    mentions: bool = True


@dataclass
class Model:
    bias: float
    feature: np.ndarray
    weight: np.ndarray
    options: Toxicity = field(default_factory=Toxicity)
    pairs: int = 0


_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(texts: Texts, options: Toxicity) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of each word and each word's beginnings, with repeats.

    Words are runs of letters, digits and bytes beyond ASCII, with A-Z lower-cased.
    """
    first = np.zeros(len(texts.data) + 1, bool)
    first[texts.starts[texts.sizes > 0]] = True
    first[-1] = True
    letter = np.concatenate([[False], _LETTER[texts.data], [False]])
    begin = np.flatnonzero(letter[1:-1] & (~letter[:-2] | first[:-1]))
    end = np.flatnonzero(letter[1:-1] & (~letter[2:] | first[1:])) + 1
    of = np.searchsorted(texts.starts, begin, "right") - 1
    rolling = Rolling(_LOWER[texts.data])
    shift = np.uint64(64 - options.hash_bits)
    owner, found = [of], [mixed(rolling.digest(begin, end) + np.uint64(1)) >> shift]
    for k in options.prefixes:
        longer = end - begin > k
        part = rolling.digest(begin[longer], begin[longer] + k)
        owner.append(of[longer])
        found.append(mixed(part + np.uint64(k + 1)) >> shift)
    return np.concatenate(owner), np.concatenate(found).astype(np.int64)


def _slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in runs of about ``size`` bytes of text; a longer text is a run of its own."""
    lengths = pc.binary_length(batch[column]).fill_null(0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(lengths) - 1) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(lengths)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def _text_array(values) -> Texts:
    return Texts.of(pa.chunked_array([values]))


def swap(text: str, groups: tuple[tuple[str, ...], ...]) -> str:
    """The text with each identity term replaced by the next of its group."""
    following = {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}
    if not following:
        return text
    pattern = re.compile(r"\b(" + "|".join(map(re.escape, following)) + r")\b", re.IGNORECASE)
    return pattern.sub(lambda m: following[m[0].lower()], text)


def mention(text: str, groups: tuple[tuple[str, ...], ...]) -> str:
    """The text with one identity term after it, chosen by a checksum of the text."""
    terms = [t for g in groups for t in g]
    return f"{text} {terms[zlib.crc32(text.encode()) % len(terms)]}" if terms else text


def _levels(texts: Texts, owner: np.ndarray, found: np.ndarray, options: Toxicity) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) pairs, of one to three levels each.

    Level 0 is for any feature present, levels 1 and 2 for one that makes up enough of
    the text: an insult that is said again says more than a word that happens to look like one.
    """
    bits = options.hash_bits
    both, count = np.unique((owner.astype(np.int64) << bits) | found, return_counts=True)
    owner, found = both >> bits, both & ((1 << bits) - 1)
    length = np.maximum(texts.sizes[owner], 1)
    out = [(owner, found)]
    for level, (least, share) in enumerate(options.levels, 1):
        some = (count >= least) & (count >= share * length)
        out.append((owner[some], found[some] + (level << bits)))
    owner = np.concatenate([o for o, _ in out])
    order = np.argsort(owner, kind="stable")
    return owner[order], np.concatenate([f for _, f in out])[order]


def fit(rows: list[tuple[int, list[int], list[int] | None, list[int] | None]], chosen: list[int], options: Toxicity) -> Model:
    """Weights by gradient descent with momentum and per-weight steps (Adam).

    Each row has a label, the places of its features in ``chosen``, and those that its
    counterfactual text loses and gains, or None twice if it has none.
    """
    n, k = len(rows), len(chosen)
    label = np.array([r[0] for r in rows], float)
    toxic = float(label.mean()) if n else 0.0
    bias = float(np.log((toxic + 0.001) / (1.001 - toxic)))
    weight = np.zeros(k)
    if not n or not k or toxic in (0.0, 1.0):
        return Model(bias, np.array(chosen, np.int64), weight, options)
    row = np.concatenate([np.full(len(r[1]), i) for i, r in enumerate(rows)]).astype(np.int64)
    col = np.concatenate([np.asarray(r[1], np.int64) for r in rows])
    swapped = [(i, r) for i, r in enumerate(rows) if r[2] is not None]
    pair = np.array([j for j, (_, r) in enumerate(swapped) for _ in (*r[2], *r[3])], np.int64)
    pair_col = np.array([c for _, r in swapped for c in (*r[2], *r[3])], np.int64)
    sign = np.array([s for _, r in swapped for s in (*[1.0] * len(r[2]), *[-1.0] * len(r[3]))])
    mean, square = np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, options.steps + 1):
        z = bias + np.bincount(row, weight[col], n)
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / n
        slope = np.bincount(col, error[row], k) + 2 * options.ridge * weight
        if swapped:
            change = np.bincount(pair, sign * weight[pair_col], len(swapped))
            pull = 2 * options.fairness * change / len(swapped)
            slope += np.bincount(pair_col, sign * pull[pair], k)
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weight -= move[:-1]
        bias -= float(move[-1])
    return Model(bias, np.array(chosen, np.int64), weight, options, len(swapped))


def _counterfactuals(part: pa.RecordBatch, with_term: np.ndarray, options: Toxicity) -> dict[int, str]:
    """By row the text that should score the same: terms swapped, or a group mentioned in a neutral text without any."""
    some, out = set(with_term.tolist()), {}
    neutral = part["_toxic"].to_numpy() == 0
    for i in range(len(part)):
        if i in some:
            out[i] = swap(part["text"][i].as_py(), options.identity_terms)
        elif options.mentions and options.identity_terms and neutral[i]:
            out[i] = mention(part["text"][i].as_py(), options.identity_terms)
    return out


def held_out(doc_id: Column, fold: int) -> Column:
    """Whether a row teaches nothing; a null id is held out."""
    rest = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(fold))
    return F.coalesce(rest == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, options: Toxicity, doc_id: str, text: str) -> Model:
    """Fits the classifier on at most ``sample_rows`` labelled rows, in order of a hash of the id.

    Their number bounds the broadcast of ids and what the driver collects: per row the
    chosen features, of which there are at most ``features``, and those in which its counterfactual differs. An id with several labels counts as toxic
    if one of them is; null labels do not count.
    """
    sample = (
        labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), options.fold))
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("_toxic"))
        .orderBy(F.md5(F.col("_id").cast("string")), "_id").limit(options.sample_rows)
    )
    spark = docs.sparkSession
    sample = spark.createDataFrame(sample.collect(), sample.schema)
    taught = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(
        F.broadcast(sample), "_id"
    ).select("_toxic", "text")
    width = (1 + len(options.levels)) << options.hash_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width), np.int64)
        for batch in batches:
            for part in _slices(batch, "text", options.slice_bytes):
                texts = _text_array(part["text"])
                owner, found = _levels(texts, *features(texts, options), options)
                toxic = part["_toxic"].to_numpy()[owner]
                for c in (0, 1):
                    total[c] += np.bincount(found[toxic == c], minlength=width)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], ["feature", "clean", "toxic"])

    counts = taught.mapInArrow(count, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    class_size = {r["_toxic"]: r["n"] for r in taught.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = class_size.get(0, 0), class_size.get(1, 0)
    share0, share1 = (F.col("clean") + 0.5) / (n0 + 1.0), (F.col("toxic") + 0.5) / (n1 + 1.0)
    # Information of a feature about the class, as in a G-test.
    gain = F.col("toxic") * F.log(share1 / share0) + F.col("clean") * F.log(share0 / share1)
    chosen = [r[0] for r in counts.where("toxic + clean >= 3").orderBy(F.desc(gain), "feature").limit(options.features).collect()]
    place = np.full(width, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    terms = pa.array([t for g in options.identity_terms for t in g], pa.string())
    plain = Toxicity(hash_bits=63, prefixes=())
    term_words = np.unique(features(_text_array(terms), plain)[1])

    def chosen_of(texts: Texts) -> list[list[int]]:
        owner, found = _levels(texts, *features(texts, options), options)
        at = place[found]
        owner, at = owner[at >= 0], at[at >= 0]
        return np.split(at, np.searchsorted(owner, np.arange(1, len(texts.sizes))))

    def naming(texts: Texts) -> np.ndarray:
        owner, words = features(texts, plain)
        return np.unique(owner[np.isin(words, term_words)])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, "text", options.slice_bytes // 2):
                texts = _text_array(part["text"])
                own = chosen_of(texts)
                other = _counterfactuals(part, naming(texts), options)
                del texts
                found = chosen_of(_text_array(pa.array(list(other.values()), pa.string()))) if other else []
                lost: list = [None] * len(own)
                gained: list = [None] * len(own)
                for i, new in zip(other, found, strict=True):
                    lost[i], gained[i] = np.setdiff1d(own[i], new), np.setdiff1d(new, own[i])
                kind = pa.list_(pa.int32())
                columns = [part["_toxic"], *(pa.array(c, kind) for c in (own, lost, gained))]
                yield pa.RecordBatch.from_arrays(columns, ["label", "own", "lost", "gained"])

    schema = "label int, own array<int>, lost array<int>, gained array<int>"
    described = taught.mapInArrow(describe, schema).collect()
    rows = [(r[0], list(r[1]), r[2], r[3]) for r in described]
    rows.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or [], r[3] or []))
    return fit(rows, chosen, options)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    options: Toxicity = Toxicity(),
    doc_id: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Chance that a document is toxic as ``labels.toxic`` marks it.

    Trains on labelled rows outside the held-out fold and scores every whole text. Features
    are words and their beginnings, by whether they occur and whether they occur often. Returns ``doc_id``, ``held_out``,
    ``score``, ``predicted`` and the columns ``keep``, which must not have the names of the others.

    A null or empty text has no features and gets the score of the bias. Without labels of both
    classes all scores are the share of toxic rows, 0.001 if there are none. Equal rows give equal rows.
    An empty table gives an empty result.
    """
    model = train(docs, labels, options, doc_id, text)
    width, bits = 1 + len(options.levels), options.hash_bits
    kept = [F.col(f"`{c}`") for c in keep]
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        held_out(F.col(f"`{doc_id}`"), options.fold).alias("held_out"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
        *kept,
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(width << bits)
        table[model.feature] = model.weight
        known = (table.reshape(width, -1) != 0).any(axis=0)
        for batch in batches:
            for part in _slices(batch, "_text", options.slice_bytes):
                texts = _text_array(part["_text"])
                owner, found = features(texts, options)
                some = known[found]
                owner, found = _levels(texts, owner[some], found[some], options)
                z = model.bias + np.bincount(owner, table[found], len(part))
                chance = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                columns = {"doc_id": part["doc_id"], "held_out": part["held_out"], "score": pa.array(chance)}
                columns["predicted"] = pa.array((chance >= 0.5).astype(np.int32))
                columns |= {c: part[c] for c in keep}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kinds = dict(docs.dtypes)
    schema = f"doc_id {kinds[doc_id]}, held_out boolean, score double, predicted int"
    schema += "".join(f", `{c}` {kinds[c]}" for c in keep)
    return rows.mapInArrow(score, schema)
