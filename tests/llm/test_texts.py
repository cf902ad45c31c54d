"""Operators on documents against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import tempfile
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notice_lake.llm import common, ngram_join
from notice_lake.llm.blocks import answer
from notice_lake.llm.common import components, stored
from notice_lake.llm.mixing import Mix, mix_sources
from notice_lake.llm.ngram_join import NgramJoin, near_duplicates
from notice_lake.llm.packing import Packing, boundaries, pack
from notice_lake.llm.quality_rules import estimate, measures, posterior, quality
from notice_lake.llm.suffix_dedup import _KINDS, SuffixDedup, _send, difference_cover, remove_repeats
from notice_lake.sources import files, scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def smallest(nodes, links):
    """Smallest reachable node of each, by brute force."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    links += [(k, k + 1) for k in range(100, 140)] + [(200, k) for k in range(201, 230)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    links = [x for x in links if x[0] != x[1]]
    assert found == smallest({n for x in links for n in x}, links)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("length", [1, 25, 26, 60, 362, 400, 1000])
def test_difference_cover(length):
    period, cover = difference_cover(length)
    found = {(a - b) % period for a in cover.tolist() for b in cover.tolist()}
    assert found == set(range(period)) and period <= max(1, length // 2)


def repeats(texts, length):
    """(n_bytes, n_removed, n_spans, sha256) per text, by comparing every string."""
    data = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for d in data:
        for k in range(len(d) - length + 1):
            seen[d[k : k + length]] = seen.get(d[k : k + length], 0) + 1
    out = []
    for d in data:
        gone = [False] * len(d)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [12, 40, 400])
def test_suffix_dedup(spark, length):
    rng = random.Random(length)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7)))
    base = [" ".join(word() for _ in range(rng.randrange(1, 300))) for _ in range(25)]
    texts = base + base[:5] + base[:2]
    for _ in range(20):  # passages inside other texts, some twice in one
        a, b = rng.choice(base), rng.choice(base)
        k = rng.randrange(len(a) + 1)
        texts.append(b + a[k : k + rng.randrange(600)] + word() + a[k:])
    texts += ["ab" * 500, "x" * (length - 1), "y" * length, "z" * (length + 1), "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (1_000_000, 3_000):
        rows = remove_repeats(docs, SuffixDedup(length, block), kept_text=True)
        found = [tuple(r)[1:5] for r in sorted(rows.collect())]
        assert found == repeats(texts, length)


def test_a_block_sends_the_same_in_any_order_of_its_rows():
    """The shuffle may hand over the rows of a block in another order at each step; answers go by place."""
    dedup = SuffixDedup(length=30)
    kinds = {"step": pa.int32(), "key": pa.int64(), "first": pa.int8(), "bucket": pa.int32(), "shared": pa.binary(), "lead": pa.binary()}
    for seed in range(20):
        rng = random.Random(seed)
        source = "".join(rng.choice("ab") for _ in range(300))
        texts = [source[k : k + rng.randrange(30, 120)] for k in (rng.randrange(200) for _ in range(24))]
        blocks = [pa.table({"block": [b] * 12, "key": range(12), "doc_id": range(12), "text": texts[b::2]}) for b in (0, 1)]
        sides = [pa.schema(kinds).empty_table()] * 2
        for upto, kind in _KINDS.items():
            sent = [
                [_send(rows.take(list(order)), side, dedup=dedup, buckets=1, upto=upto) for order in (range(12), range(11, -1, -1))]
                for rows, side in zip(blocks, sides)
            ]
            assert all(one.equals(other) for one, other in sent)
            for found in answer(pa.concat_tables([one for one, _ in sent]), kind).to_pylist():
                new = {"step": upto, "key": None, "first": None} | {c: found[c] for c in ("bucket", "shared", "lead")}
                sides[found["block"]] = pa.concat_tables([sides[found["block"]], pa.Table.from_pylist([new], sides[0].schema)])


def test_suffix_dedup_of_odd_rows(odd_docs, no_docs):
    rows = remove_repeats(odd_docs, keep=("lang",), kept_text=True).collect()
    assert len(rows) == odd_docs.count()
    got = {r.doc_id: r for r in rows}
    assert got[1].n_bytes == got[2].n_bytes == 0 and got[1].kept_text == ""
    assert got[6].n_removed == got[6].n_bytes == got[5].n_bytes and got[6].kept_text == ""
    assert got[4].n_removed == 0 and got[4].kept_sha256 == hashlib.sha256(got[4].kept_text.encode()).hexdigest()
    assert got[9].n_removed == 1400 and got[10].n_removed == 500
    assert remove_repeats(no_docs).count() == 0


def twins():
    """Two unlike texts whose polynomials modulo 2^64 are equal for every base: the Thue-Morse sequence and its opposite."""
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_unlike_texts_with_equal_polynomials_are_told_apart(spark):
    one, two = twins()
    docs = spark.createDataFrame([(1, one), (2, two), (3, one + " and more"), (4, two + " or less")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs.where("doc_id < 3")).collect()}
    assert found == {1: 1, 2: 2}
    rows = remove_repeats(docs.where("doc_id < 3"), SuffixDedup(length=1024)).collect()
    assert [r.n_removed for r in rows] == [0, 0]
    rows = remove_repeats(docs, SuffixDedup(length=1024)).collect()
    assert [r.n_removed for r in sorted(rows)] == [1024] * 4


def test_short_runs_of_repeats_stay(spark):
    long, short = " ".join(f"word{k}" for k in range(60)), " ".join(f"s{k}" for k in range(45))
    texts = [f"one {long} end", f"other {long} stop", f"a {short} b", f"c {short} d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(remove_repeats(docs, SuffixDedup(length=100, words=51), kept_text=True).collect())
    assert [r.n_spans for r in rows] == [1, 1, 0, 0]
    assert [r.kept_text for r in rows] == ["oneend", "otherstop", texts[2], texts[3]]
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in rows)
    assert [r.n_removed for r in remove_repeats(docs, SuffixDedup(length=100)).orderBy("doc_id").collect()] == [len(long) + 2] * 2 + [len(short) + 2] * 2


def shingle_set(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_ngram_join(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(40)]
    texts = []
    for _ in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 120))]
        texts.append(words)
        for _ in range(rng.randrange(9)):
            near = list(rng.choice(texts[-3:]))
            for _ in range(rng.randrange(1 + len(near) // 12)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            texts.append(near)
    texts = [" ".join(w) for w in texts] + ["One two", "one  TWO", "one two three", "Éa b", "éa b", "", None]
    sets = [shingle_set(t) for t in texts]
    for percent in (75, 50):
        links = [
            (a, b) for a in range(len(sets)) for b in range(a)
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
        ]
        low = smallest(range(len(sets)), links)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        rows = near_duplicates(docs, NgramJoin(percent=percent, block_bytes=5000, bits=128)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {
            k: (len(s), low[k]) for k, s in enumerate(sets)
        }
        assert len(links) > 20


def test_ngram_join_of_odd_rows(odd_docs, no_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3)
    assert got[6][1] == got[5][1] == 5 and got[8] == (1, 7) and got[None][1] is None
    assert near_duplicates(no_docs).count() == 0


def test_spent_tables_of_the_join_are_deleted(spark):
    """While candidates are compared, the sets are stored once; tables of the rounds go."""
    words = [[f"w{k}" for k in range(i % 7, i % 7 + 40)] + [f"only{i}"] for i in range(30)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")
    folder = scratch.shared_folder(spark)
    before = set(files.names(spark, folder))
    rows = near_duplicates(docs).collect()
    left = {name.rpartition("-")[0] for name in set(files.names(spark, folder)) - before}
    assert len(rows) == 30 and any(r.doc_id != r.component_id for r in rows)
    assert left >= {"ngram-leads", "ngram-links"} and not left & {"ngram-sets", "ngram-members", "ngram-found", "ngram-rest"}


def shuffle_files(folder):
    return {name for _, _, found in os.walk(folder) for name in found if name.startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    folder = spark.sparkContext.getConf().get("spark.local.dir", None) or os.environ.get("SPARK_LOCAL_DIRS") or tempfile.gettempdir()
    before = shuffle_files(folder)
    option = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting = spark.conf.get(option, None)
    table = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert sorted(tuple(r) for r in table.collect()) == [(k, 143 if k < 6 else 142) for k in range(7)]
    end = time.monotonic() + 10  # files are deleted by messages to the executors
    while (left := shuffle_files(folder) - before) and time.monotonic() < end:
        time.sleep(0.2)
    assert not left and spark.conf.get(option, None) == setting


def test_rounds_of_the_join_take_up_unsettled_places_only(spark, monkeypatch):
    """Places of connected sets are not looked at again, and what blocks exchange is gone before their sets are there."""
    made: dict[str, list[int]] = {}

    def noted(df, name):
        table = stored(df, name)
        made.setdefault(name, []).append(table.count())
        return table

    monkeypatch.setattr(ngram_join, "stored", noted)
    words = [[f"g{i % 3}w{k}" for k in range(i % 7, i % 7 + 40)] + [f"only{i}"] for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id long, text string")
    rows = near_duplicates(docs).collect()
    sets = [shingle_set(" ".join(w)) for w in words]
    links = [(a, b) for a in range(60) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    low = smallest(range(60), links)
    assert {r.doc_id: r.component_id for r in rows} == low and len(set(low.values())) < 60
    sizes = made["ngram-named"]
    assert sizes and max(sizes) < made["ngram-places"][0] and list(made)[0] == "ngram-orders"


def test_unlike_texts_under_one_id_are_linked_by_each(spark):
    """An id with several texts has the links of all; also where its texts are apart from others at the end of the rounds."""
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 60))] if i % 3 == 0 else list(rows[-1][1])
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((rng.randrange(70), words))
    docs = [(k, " ".join(w)) for k, w in rows]
    for percent in (75, 40):
        sets = [(k, shingle_set(t)) for k, t in docs]
        links = [(a, b) for a, x in sets for b, y in sets if a != b and 100 * len(x & y) >= percent * len(x | y)]
        low = smallest({k for k, _ in docs}, links)
        found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), NgramJoin(percent=percent)).collect()
        assert len(found) == 120 and {(r.doc_id, r.component_id) for r in found} == set(low.items())


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    marked = set()
    for k, w in enumerate(windows):
        if windows.count(w) > 1:
            marked |= {k, k + 1, k + 2}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(marked))


def test_quality_measures(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 3000")
    more = ["", None, "a", "a b a b a b", "a a a a", "x\ny\nx\n \n \nx", "# a|b c", "q\x0bw\x0ce", "a b c a b"]
    extra = spark.createDataFrame([(-k, t) for k, t in enumerate(more, 1)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").union(extra)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in measures(docs).collect():
        assert tuple(r)[1:6] == plain_measures(texts[r.doc_id]), texts[r.doc_id]


def test_rule_errors_are_recovered():
    """Votes drawn from known error rates: the estimate finds them and beats a filter of all rules."""
    rng = random.Random(5)
    truth = [(0.02, 0.7), (0.1, 0.6), (0.01, 0.4), (0.05, 0.9)]
    rows = []
    for _ in range(20_000):
        good = rng.random() < 0.85
        votes = tuple(
            None if rng.random() < 0.2 else int(rng.random() >= e[0 if good else 1]) for e in truth
        )
        rows.append((good, votes))
    counts: dict[tuple, int] = {}
    for _, votes in rows:
        counts[votes] = counts.get(votes, 0) + 1
    prior, errors = estimate(counts)
    assert abs(prior - 0.85) < 0.02
    assert all(abs(x - y) < 0.08 for e, t in zip(errors, truth) for x, y in zip(e, t))
    right = sum((posterior(v, prior, errors) >= 0.5) == g for g, v in rows)
    all_pass = sum((0 not in v) == g for g, v in rows)
    assert right > all_pass


def test_quality_verdicts(spark, odd_docs, no_docs):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality(spark.read.parquet(f"{sf}/documents.parquet")).withColumnRenamed("quality", "chance")
    judged = rows.join(labels, "doc_id").where("NOT base_failed")
    right = judged.where("kept = (quality = 1)").count()
    assert right >= 0.97 * judged.count()
    got = {r.doc_id: r for r in quality(odd_docs).collect()}
    assert got[1].base_failed and got[1].n_words == 0 and not got[2].kept and got[4].n_words == 20_000
    assert quality(odd_docs).count() == odd_docs.count() and quality(no_docs).count() == 0


def test_mixing(spark, odd_docs, no_docs):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(1, 40), rng.choice(["a", "a", "b", "é", "z", None])) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix_sources(docs).collect()
    assert sorted(found) == sorted(mix_sources(docs, Mix(rows_per_bucket=50)).collect())
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    total = sum(r["size"] for r in found)
    targets = {r.source: r.target for r in found}
    for s, t in targets.items():
        taken = sum(r.taken for r in found if r.source == s)
        assert t - 1 <= taken <= t
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    odd = mix_sources(odd_docs)
    assert odd.count() == odd_docs.count()
    assert {r.doc_id: r.taken for r in odd.collect()}[1] == 0
    assert mix_sources(no_docs).count() == 0
    empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [r.taken for r in mix_sources(empty).collect()] == [0, 0]


def test_bucket_boundaries_are_optimal():
    rng = random.Random(9)
    for _ in range(20):
        lengths = sorted(rng.sample(range(1, 60), 7))
        histogram = [(x, rng.randrange(1, 9), 0) for x in lengths]
        histogram = [(x, n, n * x) for x, n, _ in histogram]

        def padding(ends, histogram=histogram):
            return sum(n * next(e for e in ends if e >= x) - s for x, n, s in histogram)

        from itertools import combinations

        best = min(padding([*c, lengths[-1]]) for k in range(3) for c in combinations(lengths[:-1], k))
        ends = boundaries(histogram, 3)
        assert len(ends) <= 3 and ends[-1] == lengths[-1] and padding(ends) == best
    assert boundaries([], 4) == []


def test_boundaries_of_many_lengths_are_optimal():
    rng = random.Random(5)
    for size, buckets in ((1, 3), (9, 20), (80, 1), (80, 4), (80, 16)):
        histogram = [(x, n := rng.choice([1, 1, 2, 5, 400]), n * x) for x in sorted(rng.sample(range(1, 20_000), size))]
        cost = {(-1, -1): 0}  # padding of the lengths up to one, by bucket and last length
        for k in range(buckets):
            for j in range(size):
                of = [c + sum(histogram[j][0] * n - t for _, n, t in histogram[i + 1 : j + 1]) for (b, i), c in cost.items() if b == k - 1 and i < j]
                cost |= {(k, j): min(of)} if of else {}
        ends = boundaries(histogram, buckets)
        padding = sum(n * next(e for e in ends if e >= x) - t for x, n, t in histogram)
        assert len(ends) <= buckets and padding == min(c for (_, j), c in cost.items() if j == size - 1)


def test_long_documents_get_exact_boundaries(spark):
    sizes = [1025] * 5 + [70, 71, 71, 133, 300, 301, 999, 5003, 5003, 0]
    docs = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n long")
    same = pack(docs.where("n = 1025"), tokens="n").collect()
    assert [(r.bucket_length, r.padding) for r in same] == [(1025, 0)] * 5
    from itertools import combinations

    exact = sorted({max(n, 1) for n in sizes})
    padded = lambda ends: sum(next(e for e in ends if e >= n) - n for n in sizes)
    best = min(padded([*c, exact[-1]]) for k in range(4) for c in combinations(exact[:-1], k))
    found = pack(docs, Packing(buckets=4), tokens="n").collect()
    assert len(found) == len(sizes) and sum(r.padding for r in found) == best


def test_packing(spark, odd_docs, no_docs):
    rng = random.Random(2)
    rows = [(k, "w " * min(int(rng.expovariate(0.01)), 5000)) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pack(docs, Packing(buckets=5, batch_tokens=2000, docs_per_part=200)).collect()
    assert sorted(r.doc_id for r in found) == list(range(800))
    batches: dict[str, list] = {}
    for r in found:
        assert r.n_tokens == len(rows[r.doc_id][1].split()) and r.padding == r.bucket_length - r.n_tokens >= 0
        batches.setdefault(r.batch_id, []).append(r)
    for b in batches.values():
        assert len({r.bucket_length for r in b}) == 1 and sorted(r.slot for r in b) == list(range(len(b)))
        assert len(b) == 1 or len(b) * b[0].bucket_length <= 2000
    assert pack(odd_docs).count() == odd_docs.count() and pack(no_docs).count() == 0
    sized = spark.createDataFrame([(1, 10), (2, None), (3, -4)], "doc_id long, n long")
    assert sorted(r.n_tokens for r in pack(sized, tokens="n").collect()) == [0, 0, 10]


def test_copies_and_links_of_earlier_rounds_are_not_connected_again(spark, monkeypatch):
    """Whole copies are one set; what a round has linked goes on as parts, so steps at the end take up new links only."""
    connected, steps = [], []

    def noted(df, name):
        table = stored(df, name)
        steps.append(name)
        if name == "links":
            connected.append(table.count())
        return table

    monkeypatch.setattr(common, "stored", noted)
    monkeypatch.setattr(ngram_join, "stored", noted)
    near = [" ".join([f"w{k}" for k in range(60)] + [f"end{i}"]) for i in range(20)]
    texts = near + near[:1] * 150 + [" ".join(f"other{i}x{k}" for k in range(30)) for i in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert found == {k: 0 if k < 170 else k for k in range(180)}
    assert connected and max(connected) < 150
    assert not {"ngram-copies", "ngram-groups", "ngram-met"} & set(steps)


def test_rows_of_one_id_have_one_component(spark):
    """Also rows without words, copies of other texts, rows without an id, and ids that only another id's texts connect."""
    rng = random.Random(12)
    base = [" ".join(f"t{k}x{i}" for i in range(30)) for k in range(6)]
    for seed in range(3):
        rows = [(rng.choice([None, *range(25)]), rng.choice([None, "", "  ", *base, *(f"{t} {rng.randrange(3)}" for t in base)])) for _ in range(60)]
        sets = [(k, shingle_set(t)) for k, t in rows if k is not None]
        links = [(a, b) for a, x in sets for b, y in sets if a != b and x and y and 100 * len(x & y) >= 75 * len(x | y)]
        low = smallest({k for k, _ in sets}, links)
        found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        want = sorted((k if k is not None else -1, len(shingle_set(t)), low.get(k, -1)) for k, t in rows)
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in found) == want, seed
