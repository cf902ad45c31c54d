"""Each stage of the pipeline against a plain version, as whole rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from test_texts import WORD, shingle_set, smallest

import corpus_pipeline
from notice_lake.llm.packing import boundaries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choices(alphabet, k=rng.randrange(2, 9))) for _ in range(n))


def document(doc_id, text, source):
    return (doc_id, text, "en", source, None if text is None else len(text))


@pytest.fixture(scope="module")
def corpus():
    """Near copies, passages that many share, unlike texts under one id, rows without an id, a text or a source."""
    rng = random.Random(11)
    base = [words(rng, rng.randrange(1, 160)) for _ in range(70)]
    passage, note = words(rng, 70), words(rng, 30)
    rows = [document(i, t, f"s{i % 4}") for i, t in enumerate(base)]
    rows += [document(100 + i, f"{words(rng, 40)} {passage} {words(rng, 40)}", "s1") for i in range(6)]
    rows += [document(120 + i, f"{words(rng, 60)} {note} {words(rng, 60)}", "s2") for i in range(6)]
    long = [t for t in base if len(t.split()) > 80][:8]
    rows += [document(200 + i, t + " one more", "s0") for i, t in enumerate(long)]
    rows += [document(220, base[5], "s3"), document(3, words(rng, 50), "s3"), document(3, words(rng, 20), None)]
    rows += [document(None, words(rng, 33), "s1"), document(None, words(rng, 44), None), document(None, base[7], "s0")]
    rows += [document(300, None, "s1"), document(301, "", "s2"), document(302, " \n", None)]
    return rows


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def stage(spark, name, rows, sf_dir="."):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    return dict(corpus_pipeline.STAGES)[name](spark, docs, sf_dir)


def test_ngram_stage(spark, corpus):
    docs = sorted(set(corpus), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sets = [shingle_set(r[1]) for r in docs]
    links = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets)
        if i < j and a and b and 100 * len(a & b) >= 75 * len(a | b)
    ]
    low = smallest(range(len(docs)), links)
    assert rows_of(stage(spark, "ngram_join", corpus + corpus[:9])) == Counter(docs[i] for i in low if low[i] == i)


def cut(texts, length, least):
    """Texts without runs of repeated strings of ``length`` bytes that hold so many words."""
    data = [t.encode() for t in texts]
    seen = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        kept, k = b"", 0
        while k < len(d):
            e = k
            while e < len(d) and gone[e] == gone[k]:
                e += 1
            if not gone[k] or len(d[k:e].split()) < least:
                kept += d[k:e]
            k = e
        out.append(kept.decode())
    return out


def test_suffix_stage(spark, corpus):
    kept = cut([r[1] or "" for r in corpus], corpus_pipeline.PASSAGES.length, corpus_pipeline.PASSAGES.words)
    plain = []
    for (doc_id, text, lang, source, n), new in zip(corpus, kept, strict=True):
        plain.append((doc_id, text, lang, source, n) if new == (text or "") else (doc_id, new, lang, source, len(new)))
    assert sum(a != b for a, b in zip(plain, corpus, strict=True)) >= 6
    assert rows_of(stage(spark, "suffix_dedup", corpus)) == Counter(plain)


def times_taken(rows):
    """How often each row comes: documents of a source queue by a hash, twice at most, up to the source's target."""
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    target, left, open_ = {}, 1.5 * sum(size), list(sources)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > 2 * total[s]]
        for s in full or open_:
            target[s] = 2.0 * total[s] if full else weight[s] * level
        left -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in target]
    times = {}
    for s in sources:
        own = [i for i, r in enumerate(rows) if r[3] == s]
        own.sort(key=lambda i: (hashlib.md5((f"mix {rows[i][0]}" if rows[i][0] is not None else "mix").encode()).hexdigest(), rows[i][0] or 0, size[i]))
        ahead = 0
        for i in own * 2:
            times[i] = times.get(i, 0) + (size[i] > 0 and ahead + 1 <= target[s])
            ahead += size[i]
    return [times[i] if size[i] else 1 for i in range(len(rows))]


def test_mixing_stage(spark, corpus):
    rows = sorted({r[:2]: r for r in corpus}.values(), key=str)
    plain = Counter()
    for row, n in zip(rows, times_taken(rows), strict=True):
        plain[row] += n
    assert rows_of(stage(spark, "source_mix", rows)) == +plain


def test_packing_stage(spark, corpus):
    from notice_lake.llm.packing import Packing

    packing = Packing()
    size = [len(WORD.findall(r[1] or "")) for r in corpus]
    counts = Counter(max(n, 1) for n in size)
    sums = Counter()
    for n in size:
        sums[max(n, 1)] += n
    ends = boundaries([(k, c, sums[k]) for k, c in counts.items()], packing.buckets)
    end_of = {k: min(e for e in ends if e >= k) for k in counts}
    rows = stage(spark, "packing", corpus).collect()
    found = Counter((r.doc_id, r.n_tokens, r.bucket_length, r.padding) for r in rows)
    assert found == Counter((r[0], n, end_of[max(n, 1)], end_of[max(n, 1)] - n) for r, n in zip(corpus, size, strict=True))
    batches = {}
    for r in rows:
        batches.setdefault((r.bucket_length, r.batch_id), []).append(r.slot)
    for (end, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= max(1, packing.batch_tokens // end)


def test_toxicity_stage(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        text = words(rng, 30)
        rows.append(document(i, f"{text} vile{i % 5} {words(rng, 10)}" if i % 4 == 0 else text, "s"))
    rows += [document(900, None, "s"), document(901, "", "s"), document(None, words(rng, 20), None)]
    labels = spark.createDataFrame([(r[0], 1, int("vile" in (r[1] or ""))) for r in rows[:300]], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = rows_of(stage(spark, "toxicity", rows, str(tmp_path)))
    assert kept == Counter(r for r in rows if "vile" not in (r[1] or ""))
