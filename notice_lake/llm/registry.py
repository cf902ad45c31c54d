"""The operators as named queries over the test tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notice_lake.llm import filter_audit, fingerprints, turn_repair
from notice_lake.llm.chat_tree import digests, prefix_tree, read_back
from notice_lake.llm.common import stored
from notice_lake.llm.lattice import near_vectors
from notice_lake.llm.mixing import mix_sources
from notice_lake.llm.ngram_join import near_duplicates
from notice_lake.llm.packing import pack
from notice_lake.llm.quality_rules import quality
from notice_lake.llm.suffix_dedup import remove_repeats
from notice_lake.llm.toxicity import score_toxicity
from notice_lake.llm.url_filter import filter_urls
from notice_lake.llm.wrapper import extract


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), kept_text=True).drop("spans")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op5_lattice_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings")).drop("label")


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op7_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op8_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(_table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = "<|im_end|><|im_start|>assistant ok"
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], table.schema)
    nodes, leaves = prefix_tree(table.union(more))
    return digests(read_back(nodes, leaves), leaves)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = filter_audit.failures(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return filter_audit.audit(rows, filter_audit.LETTERS, measures={"good_lost": "good", "toxic_lost": "toxic"})


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    turns = turn_repair.damaged(conversations)
    return turn_repair.digests(turns, stored(turn_repair.audits(turns, conversations), "repair-audits"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.edited_fingerprints(_table(spark, sf_dir, "documents"))
    own = F.col("sketch")
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(own, F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(own, F.col("next_sketch")).alias("near_next"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_quality_rules,
        op3_ngram_join,
        op4_url_filter,
        op5_lattice_hash,
        op6_source_mix,
        op7_length_packing,
        op8_wrapper_text,
        op9_toxicity,
        op10_chat_tree,
        op11_filter_audit,
        op12_turn_repair,
        op13_fingerprints,
    )
}

#: Words of a text, as SQL.
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

_MIX = f"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('mix ' || doc_id::VARCHAR) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, (CASE rank % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END)::DOUBLE AS weight,
         source_size * 2.0::DOUBLE AS most FROM sources),
levels AS (
  SELECT *, ((SELECT sum(source_size)::BIGINT FROM sources) * 1.5::DOUBLE
             - coalesce(sum(most) OVER before, 0))
         / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY most / weight, rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, CASE WHEN most / weight <= level THEN most ELSE weight *
    (SELECT max(level) FROM levels WHERE most / weight > level) END AS target FROM levels),
queue AS (
  SELECT doc_id, size, source_size, target, coalesce(sum(size) OVER (
    PARTITION BY s.source ORDER BY key, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (
    CASE WHEN before + size <= target THEN size ELSE greatest(floor(target - before), 0) END
  + CASE WHEN source_size + before + size <= target THEN size
         ELSE greatest(floor(target - source_size - before), 0) END)::BIGINT AS taken
FROM queue
"""

_LOWERED = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)

_NGRAMS = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes n ON n.doc_id = x.doc_id JOIN sizes m ON m.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 75 * (any_value(n.n) + any_value(m.n) - count(*))),
reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reached r ON r.node = d.doc_id LEFT JOIN sizes n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length(role) + length(text) + len(regexp_extract_all(role, '<\\*\|'))
      + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

_VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reached AS (
  SELECT vec_id AS node, vec_id AS other FROM embeddings
  UNION SELECT r.node, l.b FROM reached r JOIN links l ON l.a = r.other),
groups AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node),
degrees AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN groups ON node = vec_id LEFT JOIN degrees ON a = vec_id
"""

_AUDIT = f"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(
    CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
    CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails
  FROM texts LEFT JOIN marks USING (doc_id)),
counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS x, left(filter_order, step - 1) AS earlier
  FROM orders, range(1, 6) r(step)),
results AS (
  SELECT part, filter_order, step, x,
    sum(n) FILTER (translate(fails, earlier || x, '') = fails) AS kept,
    sum(n) FILTER (contains(fails, x) AND translate(fails, earlier, '') = fails) AS removed,
    sum(n) FILTER (contains(fails, x) AND translate(fails, earlier, '') <> fails) AS redundant,
    sum(n) FILTER (fails = x) AS unique_fails,
    sum(good) FILTER (contains(fails, x) AND translate(fails, earlier, '') = fails) AS good_lost,
    sum(toxic) FILTER (contains(fails, x) AND translate(fails, earlier, '') = fails) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, x)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, x), 0)::BIGINT AS shapley
FROM results
"""



def _hash_sql(which: int, prime: int, first: int, factors: list[int], words: int) -> str:
    """One residue of the hash of the shingle ``w[i:i + m - 1]``."""
    terms = [f"coalesce(({f})::HUGEINT * (('0x' || md5(s[{k}])[{first}:{first + 7}])::BIGINT % {prime}), 0)" for k, f in enumerate(factors[:words], 1)]
    return f"(({' + '.join(terms)} + {factors[words]}::HUGEINT * len(s)) % {prime})"


def _fingerprint_sql(sketch: fingerprints.Sketch = fingerprints.Sketch()) -> str:
    words, k = sketch.words, sketch.k
    factors = fingerprints.coefficients(words).tolist()
    high, low = (_hash_sql(i, p, 1 + 8 * i, factors[i], words) for i, p in enumerate(fingerprints.PRIMES))

    def words_of(text: str) -> str:
        return f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"

    def hex_of(sketch: str) -> str:
        return f"array_to_string(list_transform({sketch}, lambda x: printf('%016x', x)), '')"

    def like(a: str, b: str) -> str:
        least = f"least(CASE WHEN len({a}) < {k} THEN {fingerprints.SCALE} ELSE {a}[{k}] END, CASE WHEN len({b}) < {k} THEN {fingerprints.SCALE} ELSE {b}[{k}] END)"
        seen = [f"list_filter({x}, lambda x: x < {least})" for x in (a, b)]
        both = f"len(list_intersect({seen[0]}, {seen[1]}))"
        return f"CASE WHEN len({a}) + len({b}) = 0 THEN 1.0 ELSE {both}::DOUBLE / (len({seen[0]}) + len({seen[1]}) - {both}) END"

    return f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, row_number() OVER (ORDER BY doc_id DESC) AS i
  FROM documents),
edits AS (
  SELECT x.doc_id, x.i, x.n, x.t, left(x.t, x.n - x.n // 2) || left(y.t, x.n // 2) AS e
  FROM ordered x JOIN ordered y ON y.i = x.i % (SELECT count(*) FROM documents) + 1),
parts AS (
  SELECT doc_id, false AS edited, {words_of("t")} AS w FROM edits
  UNION ALL SELECT doc_id, true, {words_of("e")} FROM edits),
shingles AS (
  SELECT doc_id, edited, w[i:i + {words - 1}] AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {words - 1}, least(len(w), 1)) + 1)) AS i FROM parts)),
hashes AS (
  SELECT DISTINCT doc_id, edited, ({high} * 2147483648 + {low})::BIGINT AS h FROM shingles),
sketches AS (
  SELECT doc_id, edited, list(h ORDER BY h)[1:{k}] AS sketch FROM hashes GROUP BY doc_id, edited),
joined AS (
  SELECT d.*, coalesce(a.sketch, []) AS a, coalesce(b.sketch, []) AS b
  FROM edits d LEFT JOIN sketches a ON a.doc_id = d.doc_id AND NOT a.edited
  LEFT JOIN sketches b ON b.doc_id = d.doc_id AND b.edited)
SELECT x.doc_id, x.n::BIGINT AS n_chars, sha256(x.e) AS edited_sha256, {hex_of("x.a")} AS fingerprint,
  {hex_of("x.b")} AS edited_fingerprint, {like("x.a", "x.b")} AS near_edited, {like("x.a", "y.a")} AS near_next
FROM joined x JOIN joined y ON y.i = x.i % (SELECT count(*) FROM documents) + 1
"""


#: CRC-32 of an ASCII string, bit by bit; the number is its reversed polynomial.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""


def _edit(letter: str, cost: str, after: str) -> str:
    """``after``, a cost of 8 digits and letters, with an edit before it."""
    return f"printf('%08d', left({after}, 8)::INTEGER + {cost}) || '{letter}' || substr({after}, 9)"


def _taken(state: str) -> str:
    """Best edit of the current row from a state: delete, keep, or give the role that is waited for."""
    waits, after = {"e0": ("u", "eu"), "es": ("u", "eu"), "eu": ("a", "ea"), "ea": ("u", "eu")}[state]
    keeps = f"CASE WHEN NOT gone AND initial = '{waits}' THEN {_edit('K', 'more', after)} ELSE '9' END"
    system = f", CASE WHEN NOT gone AND initial = 's' THEN {_edit('K', 'more', 'es')} ELSE '9' END" if state == "e0" else ""
    reroled = f"CASE WHEN NOT gone THEN {_edit('R', '3 + more', after)} ELSE '9' END"
    return f"least({_edit('D', '4', state)}, {keeps}{system}, {reroled})"


def _inserted(state: str, *after: str) -> str:
    """Best of a state's own edit and up to two insertions before that of the states they lead to."""
    ways = [state, _edit("I", "3", after[0]), *[_edit("I", "3", f"({_edit('I', '3', x)})") for x in after[1:]]]
    return f"least({', '.join(ways)})"


_REPAIR = f"""
WITH RECURSIVE damage AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations),
turns AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM damage),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM turns),
judged AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM placed),
faults AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
    count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
    count(*) FILTER (previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
ways AS (
  SELECT conv_id, n + 1 AS i, '00000000' AS e0, '00000006II' AS es, '00000003I' AS eu, '00000000' AS ea FROM faults
  UNION ALL
  SELECT conv_id, i, {_inserted("e0", "eu", "ea")}, {_inserted("es", "eu", "ea")}, {_inserted("eu", "ea")}, {_inserted("ea", "eu")}
  FROM (
    SELECT w.conv_id, j.i, {_taken("e0")} AS e0, {_taken("es")} AS es, {_taken("eu")} AS eu, {_taken("ea")} AS ea
    FROM ways w JOIN (SELECT *, blank OR again AS gone, CASE WHEN cut THEN 3 ELSE 0 END AS more FROM judged) j
    ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i - 1) x),
audited AS (
  SELECT conv_id, left(e0, 8)::BIGINT AS cost, substr(e0, 9) AS audit FROM ways WHERE i = 1),
edits AS (
  SELECT conv_id, p, audit[p] AS letter, length(replace(left(audit, p), 'I', '')) AS i,
    length(replace(left(audit, p), 'D', '')) - 1 - length(replace(audit, 'D', '')) % 2 AS place
  FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM audited)),
lines AS (
  SELECT e.conv_id, p, CASE WHEN letter = 'K' THEN role WHEN place < 0 THEN 'system' WHEN place % 2 = 0 THEN 'user'
    ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS line
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.i = e.i
  WHERE letter <> 'D'),
hashed AS (
  SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY p)) AS repaired_sha256 FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audited a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLE: dict[str, str] = {
    "op12_turn_repair": _REPAIR,
    "op13_fingerprints": _fingerprint_sql(),
    "op11_filter_audit": _AUDIT,
    "op5_lattice_hash": _VECTORS,
    "op3_ngram_join": _NGRAMS,
    "op6_source_mix": _MIX,
    "op10_chat_tree": _CHAT,
}
