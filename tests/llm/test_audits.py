"""Filter audit, turn repair and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from notice_lake.llm import filter_audit, fingerprints, turn_repair
from notice_lake.llm.common import stored

# --- filter audit ---


def plain_audit(rows, letters):
    """Each order applied to each part's rows (mask, good), one after another."""
    found = {}
    for part in {p for p, _, _ in rows}:
        own = [(m or 0, g or 0) for p, m, g in rows if p == part]
        steps = {}
        for order in map("".join, permutations(letters)):
            left = own
            for k, c in enumerate(order, 1):
                bit = 1 << letters.index(c)
                gone, left = [x for x in left if x[0] & bit], [x for x in left if not x[0] & bit]
                failing = sum(bool(m & bit) for m, _ in own)
                steps[order, k] = (c, len(left), len(gone), failing - len(gone), sum(m == bit for m, _ in own), sum(g for _, g in gone))
        for (order, k), (c, *values) in steps.items():
            shapley = sum(v[2] for v in steps.values() if v[0] == c)
            found[part, order, k] = (*values, shapley)
    return found


@pytest.mark.parametrize("letters", ["A", "XYZ", "ABCD"])
def test_audit_equals_orders_applied_one_by_one(spark, letters):
    rnd = random.Random(len(letters))
    rows = [(rnd.choice("pq"), rnd.choice([None, *range(1 << len(letters))]), rnd.choice([None, 0, 1])) for _ in range(200)]
    df = spark.createDataFrame(rows, "part string, fails int, good int").withColumn("n", F.lit("x"))
    out = filter_audit.audit(df, letters, measures={"good_lost": "good"}).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in out}
    assert len(out) == len(found)
    assert found == plain_audit(rows, letters)


def test_paths_through_the_lattice():
    edges = filter_audit.lattice("ABCDE")
    assert len(edges) == 5 * 16
    # Each order passes one edge per filter.
    for c in "ABCDE":
        assert sum(e.reaching * e.leaving for e in edges if e.letter == c) == 120


def test_failures_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(5, 0, None), (5, 1, 0), (None, 1, 1), (6, None, 1)], "doc_id long, quality int, toxic int"
    ).withColumn("source", F.lit("clash"))
    rows = filter_audit.failures(odd_docs, labels).collect()
    assert len(rows) == 13
    # 2 is empty as 1 is null, 6 repeats 5, and 8 repeats 7. Rows that share the id 5, and those without one, do not fail E.
    assert sum(bool(r.fails & 16) for r in rows) == 3
    assert sum(r.good for r in rows) == 2 and sum(r.toxic for r in rows) == 1
    assert {r.part for r in rows} == {"", "a", "b", "c"}
    out = filter_audit.audit(filter_audit.failures(odd_docs, labels), "ABCDE")
    assert out.count() == 4 * 600
    assert filter_audit.audit(filter_audit.failures(no_docs, labels.limit(0)), "ABCDE").count() == 0


# --- turn repair ---


def plain_repair(symbols):
    """Cheapest first, then ASCII-least, over all edits."""
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, letters, i, roles = heapq.heappop(heap)
        if (i, roles[-1:]) in seen:
            continue
        seen.add((i, roles[-1:]))
        if i == len(symbols) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, letters
        ways = [(3, "I", 0, x) for x in "ua"]
        if i < len(symbols):
            ways.append((4, "D", 1, ""))
            if symbols[i]:
                cut, initial = divmod(symbols[i] - 1, 4)
                ways += [(3 + 3 * cut, "R", 1, x) for x in "ua"] + [(3 * cut, "K", 1, "sua?"[initial])]
        for price, letter, taken, role in ways:
            if re.fullmatch("s?(ua)*u?", roles + role):
                heapq.heappush(heap, (cost + price, letters + letter, i + taken, roles + role))


TABLES = {width: turn_repair.BlockTables(width) for width in (1, 3, 4)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, turn_repair.SYMBOLS - 1), max_size=14), st.sampled_from(sorted(TABLES)))
def test_blocks_give_the_cheapest_least_edits(symbols, width):
    assert TABLES[width].repair(bytes(symbols)) == plain_repair(symbols)


def plain_conversation(rows):
    """The result for one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    symbols, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        cut = re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) is None
        if not re.search(r"[^\x20\x09-\x0D]", text):
            symbols.append(0)
            counts["blank"] += 1
        elif (role, text) in seen:
            symbols.append(0)
            counts["duplicate"] += 1
        else:
            symbols.append(1 + ("sua".find(role[0]) if role and role[0] in "sua" else 3) + 4 * cut)
            counts["truncated"] += cut
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = plain_repair(symbols)
    total = len(audit) - audit.count("D")
    lines, left = [], iter(rows)
    for letter in audit:
        row = next(left) if letter != "I" else None
        if letter == "D":
            continue
        k = len(lines) - total % 2
        role = row[1] if letter == "K" else ("system" if k < 0 else "user" if k % 2 == 0 else "assistant")
        lines.append(f"{role}:{row[2] if row else ''}")
    return (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def repaired_of(turns, conversations):
    out = turn_repair.digests(turns, stored(turn_repair.audits(turns, conversations), "test-audits"))
    rows = out.collect()
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


TURNS = "conv_id long, turn long, role string, text string"


def test_repair_of_odd_conversations(spark):
    rnd = random.Random(5)
    rows = [
        (c, rnd.choice([None, 0, 1, 2, 3, 9]), rnd.choice(["system", "user", "assistant", "tool", "", " "]), rnd.choice(["Yes.", "no", "", " \n", "Why? \n", "long " * 5000 + "."]))
        for c in [None, *range(40)] for _ in range(rnd.randrange(1, 9))
    ]
    rows += rows[:60]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(7) for c in ("lead", "digest", "audit", "place", "copies", "new")})
    plain = {}
    for c, *row in rows:
        plain.setdefault(c, []).append(tuple(row))
    assert repaired_of(df, df) == {c: plain_conversation(own) for c, own in plain.items()}


def test_damage_and_conversations_without_rows(spark):
    rows = [(c, t, r, x) for c in range(60) for t, (r, x) in enumerate([("user", "Is it? Yes!"), ("assistant", None), (None, "So."), ("system", "A. B")])]
    rows += [(None, None, None, None), (100, 1, "user", "only")]
    df = spark.createDataFrame(rows, TURNS)
    import zlib

    plain = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        plain[c] += [(t, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    assert repaired_of(turn_repair.damaged(df), df) == {c: plain_conversation(own) for c, own in plain.items()}
    nothing = df.limit(0)
    assert repaired_of(turn_repair.damaged(nothing), nothing) == {}
    empty = hashlib.sha256().hexdigest()
    assert repaired_of(nothing, df.where("conv_id < 2")) == {c: (0, 0, 0, 0, 0, 0, "", empty) for c in (0, 1)}


def test_a_long_conversation_is_repaired_in_pieces(spark):
    rows = spark.range(30_000).select(
        F.lit(1).alias("conv_id"), "id", F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("turn "), "id", F.lit(".")).alias("text")
    ).withColumnRenamed("id", "turn")
    audited = stored(turn_repair.audits(rows, rows), "test-long")
    row = audited.first()
    assert row.cost == 3 * 10_000 and set(row.audit) <= set("KRI")
    kept = turn_repair.repaired(rows, audited)
    roles = [r.role for r in kept.orderBy("place").select("role").collect()]
    assert roles == ["user", "assistant"] * (len(roles) // 2)
    assert kept.where("edit <> 'I'").count() == 30_000


# --- fingerprints ---


def plain_sketch(text, words=5, k=128):
    values, _ = fingerprints.shingle_hashes([text.encode()], words)
    return sorted(set(values.tolist()))[:k]


def plain_shingles(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(found[i : i + words]) for i in range(max(len(found) - words + 1, min(len(found), 1)))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAb \n\tÄé", max_size=60), min_size=1, max_size=5))
def test_shingles_and_their_hashes(texts):
    values, ends = fingerprints.shingle_hashes([t.encode() for t in texts], 3)
    hash_of = {}
    for text, a, e in zip(texts, [0, *ends[:-1]], ends, strict=True):
        alone, _ = fingerprints.shingle_hashes([text.encode()], 3)
        assert alone.tolist() == values[a:e].tolist()
        shingles = plain_shingles(text, 3)
        assert len(set(alone.tolist())) == len(shingles)
        if len(shingles) == 1:
            assert hash_of.setdefault(*shingles, alone[0]) == alone[0]
    assert all(0 <= v < fingerprints.SCALE for v in values.tolist())


def plain_edits(rows):
    """By id: code points, edited text, next text; rows that share an id and a text have one place."""
    order = list({(i, t or ""): None for i, t in rows})
    assert len({i for i, _ in order}) == len(order)
    order.sort(key=lambda x: (x[0] is None, -(x[0] or 0)))
    out = {}
    for (i, t), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        h = len(t) // 2
        out[i] = (len(t), t[: len(t) - h] + following[:h], t, following)
    return out


@pytest.mark.parametrize("range_bytes", [300, 20_000, 16_000_000])
def test_edited_fingerprints_in_ranges_of_any_size(spark, range_bytes):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(["Red", "green", "blé", "naïve", "x"], k=rnd.randrange(0, 60)))) for i in rnd.sample(range(-500, 500), 80)]
    rows += [(7_000, None), (None, "nobody's text, twice"), (None, "nobody's text, twice"), (9_000, "often " * 9)] + [(9_000, "often " * 9)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("key", "part", "lent", "sketch", "range", "weight", "low", "id")})
    out = fingerprints.edited_fingerprints(df.repartition(5), range_bytes=range_bytes).collect()
    assert len(out) == len(rows)
    plain = plain_edits(rows)
    for r in out:
        n, edited, own, following = plain[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert [r.sketch, r.edited_sketch, r.next_sketch] == [plain_sketch(t) for t in (own, edited, following)]


def test_edited_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    out = fingerprints.edited_fingerprints(odd_docs, range_bytes=10_000).collect()
    assert len(out) == 13 and sum(r.n_chars == 0 for r in out) == 3
    assert len({tuple(r.sketch) for r in out if r.doc_id in (5, 6)}) == 1
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    alone = fingerprints.edited_fingerprints(odd_docs.where("doc_id = 7")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"shortshor").hexdigest()


def test_estimates(spark):
    words = [f"w{i}" for i in range(6_000)]
    texts = {"a": words[:4_000], "b": words[2_000:], "c": words[:100], "d": words[50:120], "e": []}
    pairs = [(x, y, " ".join(texts[x]), " ".join(texts[y])) for x in texts for y in texts]
    df = spark.createDataFrame(pairs, "x string, y string, tx string, ty string")
    df = fingerprints.fingerprint(df, "tx").withColumnRenamed("sketch", "a")
    df = fingerprints.fingerprint(df, "ty").withColumnRenamed("sketch", "b")
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        "*", fingerprints.resemblance(a, b).alias("r"), fingerprints.containment(a, b).alias("c"), fingerprints.distinct(a).alias("n"),
        fingerprints.merge(a, b).alias("m"),
    ).collect()
    for row in rows:
        one, two = plain_shingles(row.tx), plain_shingles(row.ty)
        exact = len(one) < 128 and len(two) < 128
        jaccard = len(one & two) / len(one | two) if one | two else 1
        assert row.r == pytest.approx(jaccard, abs=1e-9 if exact else 0.12)
        if row.c is not None:
            assert row.c == pytest.approx(len(one & two) / len(one) if one else 1, abs=1e-9 if exact else 0.15)
        assert row.n == pytest.approx(len(one), rel=1e-9 if len(one) < 128 else 0.3)
        assert row.m == sorted({*row.a, *row.b})[:128]


def test_merged_sketches_are_those_of_all_texts_together(spark, odd_docs, no_docs):
    made = fingerprints.fingerprint(odd_docs.select("doc_id", "source", "text"))
    out = {r.source: r.sketch for r in fingerprints.merged(made, "source").collect()}
    plain = {}
    for r in odd_docs.collect():
        plain.setdefault(r.source, set()).update(plain_sketch(r.text or "", k=10**6))
    assert out == {s: sorted(v)[:128] for s, v in plain.items()}
    assert fingerprints.merged(fingerprints.fingerprint(no_docs), "source").count() == 0
