"""DuckDB SQL for the registered queries, written apart from the Spark code.

It starts from the same message SQL and parses with regular expressions on the
whole text, where Spark splits into segments. Streaming queries are compared
with the SQL of their batch result.
"""

from __future__ import annotations

from notice_lake.registry.queries import NEAR_DEG, SHORT_KEYS, SKY_POINT
from notice_lake.schemas import NOTICE_FIELDS, SPATIAL_KEY, SUN_MOON_KEY, TIMING_KEY
from notice_lake.sources.synthetic import DAMAGED, IRREGULAR, NOTICES, SHAPED

_DELIVERY = "kafka_topic, kafka_partition, kafka_offset"
_META = "kafka_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp"
_FIRST = "ORDER BY kafka_timestamp, kafka_topic, kafka_partition, kafka_offset"
_NEWEST = "ORDER BY kafka_timestamp DESC NULLS LAST, kafka_topic, kafka_partition, kafka_offset"


def _with(ctes: dict[str, str], select: str) -> str:
    body = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{select}"


def _texts(source: str) -> str:
    """w: one line per label, every label after a newline; run: the first comment run."""
    clean = (
        "rtrim(replace(replace(kafka_value, chr(160), ' '), chr(13) || chr(10), chr(10)), chr(13))"
    )
    marked = rf"regexp_replace(chr(10) || {clean}, '\n([A-Z_]+:)', chr(1) || '\1', 'g')"
    unwrapped = f"replace(replace({marked}, chr(10), ' '), chr(1), chr(10))"
    return (
        rf"SELECT *, regexp_extract(w, '(?:\nCOMMENTS:[^\n]*)+') AS run,"
        rf" regexp_extract_all(w, '\n([A-Z_]+):', 1) AS labels"
        f" FROM (SELECT *, {unwrapped} AS w FROM {source})"
    )


def _field(name: str, text: str = "w") -> str:
    return (
        rf"CASE WHEN regexp_matches({text}, '\n{name}:')"
        rf" THEN trim(regexp_extract({text}, '\n{name}:([^\n]*)', 1)) END AS {name}"
    )


_COMMENTS = (
    r"CASE WHEN regexp_matches(w, '\nCOMMENTS:') THEN trim(regexp_replace(regexp_replace("
    r"run, '\nCOMMENTS:[ \t]*', chr(2), 'g'), chr(2) || '+', ' ', 'g')) END"
)

_ISSUE = (
    "CASE WHEN kafka_value IS NULL THEN 'null payload'"
    rf" WHEN NOT regexp_matches(w, '\n(?:{'|'.join(NOTICE_FIELDS)}):') THEN 'no known label'"
    r" WHEN len(list_distinct(labels)) < len(labels)"
    r" - greatest(len(regexp_extract_all(run, '\nCOMMENTS:')) - 1, 0) THEN 'repeated label' END"
)


def _parsed(texts: str, extra: str = "") -> str:
    fields = [_field(n) for n in NOTICE_FIELDS if n != "COMMENTS"]
    fields.append(f"{_COMMENTS} AS COMMENTS")
    return f"SELECT {_META}, {', '.join(fields)}{extra} FROM {texts}"


def _wide_key(columns: tuple[str, ...]) -> str:
    parts = ", ".join(f"coalesce(length({c}) || ':' || {c}, 'n')" for c in columns)
    return f"sha256(concat({parts}))"


_TIMING_SK = f"{_wide_key(TIMING_KEY)} AS timing_sk"
_SPATIAL_SK = f"{_wide_key(SPATIAL_KEY)} AS spatial_sk"
_SUN_MOON_SK = f"{_wide_key(SUN_MOON_KEY)} AS sun_moon_sk"


_DECIMAL = r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?"


def _number(field: str) -> str:
    return rf"TRY_CAST(regexp_extract({field}, '^\s*({_DECIMAL})(\s|$)', 1) AS DOUBLE)"


def _fact(parsed: str) -> str:
    return f"""SELECT TRY_CAST(TRIGGER_NUM AS BIGINT) AS trigger_num,
      TRY_CAST(RECORD_NUM AS INTEGER) AS record_num, {_META}, {_TIMING_SK}, {_SPATIAL_SK},
      TITLE AS notice_title, NOTICE_TYPE AS notice_type, LOC_ALGORITHM AS loc_algorithm,
      COMMENTS AS comments, LC_URL AS lightcurve_url, LOC_URL AS location_url,
      {_number('GRB_ERROR')} AS grb_error_deg, {_number('GRB_PHI')} AS grb_phi_deg,
      {_number('GRB_THETA')} AS grb_theta_deg, {_number('SUN_DIST')} AS sun_dist_deg,
      {_number('MOON_DIST')} AS moon_dist_deg FROM {parsed}"""


_ROWS = {
    "timing": f"{_TIMING_SK}, GRB_DATE AS grb_date_raw, GRB_TIME AS grb_time_raw,"
    " NOTICE_DATE AS notice_date_raw",
    "spatial": f"{_SPATIAL_SK}, {_SUN_MOON_SK}, GRB_RA AS right_ascension,"
    " GRB_DEC AS declination, GAL_COORDS AS galactic_coords, ECL_COORDS AS ecliptic_coords",
    "sun_moon": f"{_SUN_MOON_SK}, SUN_POSTN AS sun_position, MOON_POSTN AS moon_position,"
    " MOON_ILLUM AS moon_illumination",
}


def _dim(name: str, parsed: str) -> str:
    key = f"{name}_sk"
    return (
        f"SELECT {_ROWS[name]} FROM {parsed}"
        f" QUALIFY row_number() OVER (PARTITION BY {key} {_FIRST}) = 1"
    )


_RAW = {"raw": NOTICES.format(events="events")}
_SILVER = _RAW | {"texts": _texts("raw"), "silver": _parsed("texts")}
_FACT = _SILVER | {"fact": _fact("silver")}
_GOLD = _FACT | {n: _dim(n, "silver") for n in _ROWS}
_DAMAGED = _RAW | {"damaged": DAMAGED.format(notices="raw")}
_DAMAGED_DIMS = _DAMAGED | {
    "damaged_texts": _texts("damaged"),
    "damaged_silver": _parsed("damaged_texts"),
    **{n: _dim(n, "damaged_silver") for n in _ROWS},
}
_IRREGULAR = _RAW | {
    "irregular": IRREGULAR.format(notices="raw"),
    "irregular_texts": _texts("irregular"),
    "irregular_silver": _parsed("irregular_texts", f", {_ISSUE} AS parse_issue"),
}

# Murmur3 (x86, 32 bit) over ASCII text as Spark's hash() computes it: little-endian
# words, then each left-over byte as a word of its own; NULL passes the seed on.
_MASK = 4294967295


def _rotl(x: str, bits: int) -> str:
    return f"(((({x}) << {bits}) | (({x}) >> {32 - bits})) & {_MASK})"


def _murmur_step(seed: str, text: str) -> str:
    """Hash of one column, as an unsigned 32-bit number."""
    byte = f"ascii(substr({text}, CAST({{}} AS BIGINT), 1))::UBIGINT"
    word = " + ".join(f"{byte.format(f'i * 4 + {j + 1}')} * {256 ** j}" for j in range(4))
    words = f"list_transform(range(length({text}) // 4), lambda i: {word})"
    tail = (
        f"list_transform(range(length({text}) // 4 * 4 + 1, length({text}) + 1),"
        f" lambda i: {byte.format('i')})"
    )
    mixed = (
        f"list_transform(list_concat({words}, {tail}), lambda k:"
        f" ({_rotl(f'(k * 3432918353::UBIGINT) & {_MASK}', 15)} * 461845907::UBIGINT) & {_MASK})"
    )
    body = (
        f"list_reduce({mixed}, lambda h, k:"
        f" ({_rotl('xor(h, k)', 13)} * 5::UBIGINT + 3864292196::UBIGINT) & {_MASK}, {seed})"
    )
    return f"CASE WHEN {text} IS NULL THEN NULL ELSE xor({body}, length({text})::UBIGINT) END"


def _murmur_final(x: str, seed: str, text: str) -> str:
    a = f"((xor({x}, {x} >> 16) * 2246822507::UBIGINT) & {_MASK})"
    b = f"((xor({a}, {a} >> 13) * 3266489909::UBIGINT) & {_MASK})"
    return f"CASE WHEN {text} IS NULL THEN {seed} ELSE xor({b}, {b} >> 16) END"


def _murmur_ctes(source: str, keys: dict[str, tuple[str, ...]]) -> dict[str, str]:
    ctes, current = {}, source
    start = ", ".join(f"42::UBIGINT AS {name}_h" for name in keys)
    ctes["hash_start"] = f"SELECT *, {start} FROM {current}"
    current = "hash_start"
    for position in range(max(len(columns) for columns in keys.values())):
        active = {n: c[position] for n, c in keys.items() if position < len(c)}
        steps = ", ".join(f"{_murmur_step(f'{n}_h', c)} AS {n}_x" for n, c in active.items())
        finals = ", ".join(
            f"{_murmur_final(f'{n}_x', f'{n}_h', c)} AS {n}_h" for n, c in active.items()
        )
        ctes[f"hash_mix{position}"] = f"SELECT *, {steps} FROM {current}"
        gone = ", ".join([f"{n}_x" for n in active] + [f"{n}_h" for n in active])
        ctes[f"hash_col{position}"] = (
            f"SELECT * EXCLUDE ({gone}), {finals} FROM hash_mix{position}"
        )
        current = f"hash_col{position}"
    signed = ", ".join(
        f"CAST(CASE WHEN {n}_h >= 2147483648 THEN {n}_h::BIGINT - 4294967296"
        f" ELSE {n}_h::BIGINT END AS INTEGER) AS {n}"
        for n in keys
    )
    ctes["hashed"] = f"SELECT {_DELIVERY}, {signed} FROM {current}"
    return ctes


_MURMUR = _SILVER | _murmur_ctes(
    "silver", {"timing_sk": TIMING_KEY, "spatial_sk": SPATIAL_KEY, "sun_moon_sk": SUN_MOON_KEY}
)

# XXH64 over ASCII text as Spark's xxhash64() computes it; NULL passes the seed on.
_P1, _P2, _P3, _P4, _P5 = (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579,
    2870177450012600261,
)
_WRAP = 2**64


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is written once."""
    return f"list_transform([{value}], lambda {name}: {body})[1]"


def _times(x: str, factor: int) -> str:
    return f"((({x})::UHUGEINT * {factor}::UHUGEINT) % {_WRAP}::UHUGEINT)"


def _plus(*terms: str) -> str:
    return f"(({' + '.join(f'({t})::UHUGEINT' for t in terms)}) % {_WRAP}::UHUGEINT)"


def _turn(x: str, bits: int, name: str) -> str:
    return _let(x, name, f"((({name}) * {2**bits}::UHUGEINT) % {_WRAP}::UHUGEINT + ({name}) // {2 ** (64 - bits)}::UHUGEINT)")


def _xx_round(state: str, word: str, name: str) -> str:
    return _times(_turn(_plus(state, _times(word, _P2)), 31, name), _P1)


def _xx_word(text: str, at: str, size: int) -> str:
    """A little-endian number of ``size`` bytes from the 0-based place ``at``."""
    return _plus(*[f"ascii(substr({text}, CAST({at} + {j + 1} AS BIGINT), 1))::UHUGEINT * {256**j}::UHUGEINT" for j in range(size)])


def _xxhash(text: str, seed: str) -> str:
    n = f"length({text})"
    lanes = []
    for lane, start in enumerate((_plus(seed, str(_P1), str(_P2)), _plus(seed, str(_P2)), _plus(seed), _plus(seed, str(_WRAP - _P1)))):
        words = f"list_transform(range({n} // 32), lambda i: {_xx_word(text, f'(i * 32 + {8 * lane})', 8)})"
        lanes.append(f"list_reduce({words}, lambda s, k: {_xx_round('s', 'k', 'q')}, {start})")
    many = _let(
        f"[{', '.join(lanes)}]", "v",
        f"list_reduce(v, lambda s, x: {_plus(_times(f'xor(s, {_xx_round("0", "x", "q")})', _P1), str(_P4))},"
        f" {_plus(*[_turn(f'v[{k + 1}]', b, 'q') for k, b in enumerate((1, 7, 12, 18))])})",
    )
    few = _plus(seed, str(_P5))
    start = _plus(f"CASE WHEN {n} >= 32 THEN {many} ELSE {few} END", n)
    eights = f"list_transform(range({n} // 32 * 32, {n} - 7, 8), lambda i: {_xx_word(text, 'i', 8)})"
    after8 = f"list_reduce({eights}, lambda s, k: {_plus(_times(_turn(f'xor(s, {_xx_round("0", "k", "q")})', 27, 'r'), _P1), str(_P4))}, {start})"
    four = f"list_transform(range({n} // 8 * 8, {n} - 3, 4), lambda i: {_xx_word(text, 'i', 4)})"
    after4 = f"list_reduce({four}, lambda s, k: {_plus(_times(_turn(f'xor(s, {_times("k", _P1)})', 23, 'r'), _P2), str(_P3))}, {after8})"
    ones = f"list_transform(range({n} // 4 * 4, {n}), lambda i: {_xx_word(text, 'i', 1)})"
    after1 = f"list_reduce({ones}, lambda s, k: {_times(_turn(f'xor(s, {_times("k", _P5)})', 11, 'r'), _P1)}, {after4})"
    mixed = _let(after1, "a", _times(f"xor(a, a // {2**33}::UHUGEINT)", _P2))
    mixed = _let(mixed, "b", _times(f"xor(b, b // {2**29}::UHUGEINT)", _P3))
    return f"CASE WHEN {text} IS NULL THEN {seed} ELSE {_let(mixed, 'c', f'xor(c, c // {2**32}::UHUGEINT)')} END"


def _xxhash_ctes(source: str, keys: dict[str, tuple[str, ...]]) -> dict[str, str]:
    start = ", ".join(f"42::UHUGEINT AS {name}_h" for name in keys)
    ctes, current = {"xx_start": f"SELECT *, {start} FROM {source}"}, "xx_start"
    for position in range(max(len(columns) for columns in keys.values())):
        active = {n: c[position] for n, c in keys.items() if position < len(c)}
        steps = ", ".join(f"{_xxhash(c, f'{n}_h')} AS {n}_h" for n, c in active.items())
        gone = ", ".join(f"{n}_h" for n in active)
        ctes[f"xx_col{position}"] = f"SELECT * EXCLUDE ({gone}), {steps} FROM {current}"
        current = f"xx_col{position}"
    signed = ", ".join(
        f"CAST(CASE WHEN {n}_h >= {2**63}::UHUGEINT THEN {n}_h::HUGEINT - {_WRAP}::HUGEINT"
        f" ELSE {n}_h::HUGEINT END AS BIGINT) AS {n}"
        for n in keys
    )
    return ctes | {"xxhashed": f"SELECT {_DELIVERY}, {signed} FROM {current}"}


_XXHASH = _SILVER | _xxhash_ctes(
    "silver", {"timing_sk": TIMING_KEY, "spatial_sk": SPATIAL_KEY, "sun_moon_sk": SUN_MOON_KEY}
)

_CONTEXT = f"""SELECT f.trigger_num, f.kafka_timestamp, s.right_ascension, s.declination,
  s.galactic_coords, m.sun_position, m.moon_position, m.moon_illumination,
  f.sun_dist_deg, f.moon_dist_deg
FROM fact f JOIN spatial s ON f.spatial_sk = s.spatial_sk
LEFT JOIN sun_moon m ON s.sun_moon_sk = m.sun_moon_sk"""

_ORPHANS = """SELECT {c} AS key_value, count(*) AS child_rows FROM {child}
  WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {parent}) GROUP BY {c}"""

_REFERENCES = (
    ("dim_spatial_coords", "spatial", "sun_moon_sk", "dim_sun_moon_coords", "sun_moon"),
    ("fact_notices", "fact", "timing_sk", "dim_event_timing", "timing"),
    ("fact_notices", "fact", "spatial_sk", "dim_spatial_coords", "spatial"),
)

_TORN = _FACT | {k: v for k, v in _DAMAGED_DIMS.items() if k != "raw"}


def _clock_time(date: str, clock: str) -> str:
    day = rf"regexp_extract({date}, '\d{{4}}-\d{{2}}-\d{{2}}')"
    named = " || ".join(
        rf"regexp_extract({date}, '(\d{{1,2}}) ([A-Z][a-z]{{2}}) (\d{{2}})', {k})" for k in (1, 2, 3)
    )
    return (
        f"coalesce(TRY_CAST({day} || ' ' || {_CLOCK.format(clock)} AS TIMESTAMP),"
        f" try_strptime({named} || ' ' || {_CLOCK.format(clock)}, '%d%b%y %H:%M:%S'))"
    )


_CLOCK = r"regexp_extract({}, '\d{{2}}:\d{{2}}:\d{{2}}')"


def _deg(field: str) -> str:
    return rf"TRY_CAST(regexp_extract({field}, '^\s*({_DECIMAL})d?,?(?:\s|$)', 1) AS DOUBLE)"


def _second(field: str) -> str:
    """The number after a comma, or after a form in braces."""
    return rf"TRY_CAST(regexp_extract({field}, '[,}}]\s*({_DECIMAL})d?(?:\s|$)', 1) AS DOUBLE)"


_TYPED = {
    "typed": f"""SELECT {_DELIVERY},
  {_clock_time('NOTICE_DATE', 'NOTICE_DATE')} AS notice_time,
  {_clock_time('GRB_DATE', 'GRB_TIME')} AS burst_time,
  {_deg('GRB_RA')} AS ra_deg, {_deg('GRB_DEC')} AS dec_deg,
  {_deg('GAL_COORDS')} AS gal_lon_deg, {_second('GAL_COORDS')} AS gal_lat_deg,
  {_deg('ECL_COORDS')} AS ecl_lon_deg, {_second('ECL_COORDS')} AS ecl_lat_deg,
  {_deg('SUN_POSTN')} AS sun_position_deg, {_second('SUN_POSTN')} AS sun_position_dec_deg,
  {_deg('MOON_POSTN')} AS moon_position_deg, {_second('MOON_POSTN')} AS moon_position_dec_deg,
  {_deg('MOON_ILLUM')} AS moon_illumination_pct FROM silver""",
}
_SHAPED = _RAW | {
    "shaped": SHAPED.format(notices="raw"), "texts": _texts("shaped"), "silver": _parsed("texts")
}

_NOTICE_CHECKS = {
    "trigger_present": "TRIGGER_NUM IS NOT NULL",
    "valid_delivery": "kafka_topic IS NOT NULL AND kafka_partition >= 0 AND kafka_offset >= 0"
    " AND kafka_timestamp IS NOT NULL",
    "parsed": "TITLE IS NOT NULL AND NOTICE_DATE IS NOT NULL",
    "position_present": "GRB_RA IS NOT NULL AND GRB_DEC IS NOT NULL",
}
_FACT_CHECKS = {
    "trigger_present": "trigger_num IS NOT NULL",
    "error_in_range": "grb_error_deg >= 0 AND grb_error_deg <= 180",
    "phi_in_range": "grb_phi_deg >= 0 AND grb_phi_deg < 360",
    "theta_in_range": "grb_theta_deg >= 0 AND grb_theta_deg <= 180",
    "sun_dist_in_range": "sun_dist_deg >= 0 AND sun_dist_deg <= 180",
    "moon_dist_in_range": "moon_dist_deg >= 0 AND moon_dist_deg <= 180",
}


def _report(checks: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS expectation, count(*) FILTER (WHERE {test}) AS passed,"
        f" count(*) - count(*) FILTER (WHERE {test}) AS failed FROM {source}"
        for name, test in checks.items()
    )


def _null_pct(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) AS total, count(*) - count({f}) AS missing,"
        f" round(100.0::DOUBLE * (count(*) - count({f})) / count(*), 4) AS null_pct FROM {source}"
        for f in NOTICE_FIELDS
    )


_KNOWN = ", ".join(f"'{n}'" for n in NOTICE_FIELDS)

_LINES = (
    f"substr(CASE WHEN run = '' THEN w ELSE replace(w, run, chr(10) || 'COMMENTS: ' || {_COMMENTS}) END, 2)"
)

# A line per label; line 1 is what stands above the first one. Kept in a column are the first
# line of each known label and the comment lines that follow the first one.
_RESCUED = {
    "lines": f"SELECT {_DELIVERY}, generate_subscripts(string_split(w, chr(10)), 1) AS i,"
    " unnest(string_split(w, chr(10))) AS line FROM irregular_texts",
    "labelled": f"SELECT {_DELIVERY}, i, line, CASE WHEN i > 1 OR contains(line, ':')"
    " THEN trim(split_part(line, ':', 1)) ELSE '' END AS label,"
    " trim(CASE WHEN i > 1 OR contains(line, ':') THEN substr(line, strpos(line, ':') + 1)"
    " ELSE line END) AS value FROM lines",
    "placed": "SELECT *, row_number() OVER (PARTITION BY kafka_topic, kafka_partition, kafka_offset,"
    " label, i > 1 ORDER BY i) AS nth, i - min(i) OVER (PARTITION BY kafka_topic, kafka_partition,"
    " kafka_offset, label, i > 1) + 1 AS since FROM labelled",
    "rescued": f"SELECT {_DELIVERY}, i, label, value FROM placed WHERE (label <> '' OR value <> '')"
    f" AND NOT (i > 1 AND label IN ({_KNOWN})"
    " AND CASE WHEN label = 'COMMENTS' THEN nth = since ELSE nth = 1 END)",
}

_QUARANTINE = _with(
    _IRREGULAR
    | _RESCUED
    | {
        "entries": f"SELECT {_DELIVERY}, string_agg(label || '=' || value, chr(10) ORDER BY i)"
        f" AS rescued_text FROM rescued GROUP BY {_DELIVERY}",
        "texts": f"SELECT {_DELIVERY}, kafka_value, {_LINES} AS single_line_text FROM irregular_texts",
    },
    "SELECT s.*, t.kafka_value, t.single_line_text, CASE WHEN t.kafka_value IS NOT NULL"
    " THEN coalesce(e.rescued_text, '') END AS rescued_text FROM irregular_silver s"
    f" JOIN texts t USING ({_DELIVERY}) LEFT JOIN entries e USING ({_DELIVERY})"
    " WHERE parse_issue IS NOT NULL",
)

ORACLE: dict[str, str] = {
    "bronze_projection": _with(_RAW, "SELECT * FROM raw"),
    "silver_notices": _with(_SILVER, "SELECT * FROM silver"),
    "silver_strip_label": _with(
        _RAW
        | {
            "texts": _texts("raw"),
            "flat": r"SELECT *, regexp_replace(w, '\nCOMMENTS:\s*', ' ', 'g') AS m FROM texts",
        },
        f"SELECT {_META}, {', '.join(_field(n, 'm') for n in NOTICE_FIELDS if n != 'COMMENTS')},"
        " CAST(NULL AS VARCHAR) AS COMMENTS FROM flat",
    ),
    "silver_irregular": _with(_IRREGULAR, "SELECT * FROM irregular_silver"),
    "normalised_text": _with(
        _RAW | {"texts": _texts("raw")}, f"SELECT {_DELIVERY}, {_LINES} AS single_line_text FROM texts"
    ),
    "rescued_fields": _with(
        _IRREGULAR | _RESCUED, f"SELECT {_DELIVERY}, label AS field, value FROM rescued"
    ),
    "fact_notices": _with(_FACT, "SELECT * FROM fact"),
    "fact_own_sun_moon": _with(
        _GOLD | {"own": f"SELECT {_DELIVERY}, {_SPATIAL_SK}, {_SUN_MOON_SK} FROM silver"},
        f"SELECT {_DELIVERY}, o.sun_moon_sk, s.sun_moon_sk AS first_sun_moon_sk"
        " FROM own o JOIN spatial s USING (spatial_sk)",
    ),
    "dim_timing": _with(_GOLD, "SELECT * FROM timing"),
    "dim_spatial": _with(_GOLD, "SELECT * FROM spatial"),
    "dim_sun_moon": _with(_GOLD, "SELECT * FROM sun_moon"),
    "surrogate_hash_int32": _with(_MURMUR, "SELECT * FROM hashed"),
    "surrogate_xxhash64": _with(_XXHASH, "SELECT * FROM xxhashed"),
    "surrogate_wide": _with(
        _SILVER, f"SELECT {_DELIVERY}, {_TIMING_SK}, {_SPATIAL_SK}, {_SUN_MOON_SK} FROM silver"
    ),
    "accuracy_by_algorithm": _with(
        _FACT,
        "SELECT loc_algorithm, count(*) AS notices, round(avg(grb_error_deg), 4) AS avg_error_deg,"
        " min(grb_error_deg) AS min_error_deg, max(grb_error_deg) AS max_error_deg"
        " FROM fact WHERE grb_error_deg IS NOT NULL GROUP BY loc_algorithm"
        " ORDER BY notices DESC, loc_algorithm NULLS LAST",
    ),
    "activity_by_partition": _with(
        _FACT,
        "SELECT kafka_partition, count(*) AS notices, min(kafka_offset) AS first_offset,"
        " max(kafka_offset) AS latest_offset, max(kafka_timestamp) AS latest_event"
        " FROM fact GROUP BY kafka_partition ORDER BY kafka_partition",
    ),
    "latest_by_partition": _with(
        _RAW,
        "SELECT kafka_partition, max(kafka_offset) AS latest_offset,"
        " max(kafka_timestamp) AS latest_timestamp FROM raw GROUP BY kafka_partition",
    ),
    "parse_quality": _with(
        _SILVER,
        "SELECT count(*) AS total_notices,"
        " CAST(sum(CASE WHEN TRIGGER_NUM IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_trigger,"
        " CAST(sum(CASE WHEN GRB_RA IS NULL OR GRB_DEC IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
        " AS missing_position,"
        " CAST(sum(CASE WHEN NOTICE_DATE IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
        " AS missing_notice_date FROM silver",
    ),
    "layer_counts": _with(
        _FACT,
        "SELECT 'bronze' AS layer, count(*) AS row_count FROM raw"
        " UNION ALL SELECT 'silver', count(*) FROM silver"
        " UNION ALL SELECT 'fact_notices', count(*) FROM fact",
    ),
    "fact_with_timing": _with(
        _GOLD,
        "SELECT f.trigger_num, f.record_num, t.grb_date_raw, t.grb_time_raw, f.grb_error_deg,"
        " f.loc_algorithm FROM fact f LEFT JOIN timing t ON f.timing_sk = t.timing_sk",
    ),
    "recent_bursts": _with(
        _GOLD,
        "SELECT f.trigger_num, f.kafka_timestamp, s.right_ascension, s.declination,"
        " s.galactic_coords, f.grb_error_deg, f.location_url"
        f" FROM fact f JOIN spatial s ON f.spatial_sk = s.spatial_sk {_NEWEST} LIMIT 50",
    ),
    "burst_sun_moon_context": _with(_GOLD, _CONTEXT),
    "latest_raw": _with(
        _RAW,
        f"SELECT {_DELIVERY}, kafka_timestamp, kafka_value FROM raw {_NEWEST} LIMIT 10",
    ),
    "parsed_sample": _with(
        _SILVER,
        "SELECT TRIGGER_NUM, RECORD_NUM, GRB_RA, GRB_DEC, GRB_ERROR, NOTICE_DATE FROM silver"
        f" ORDER BY {_DELIVERY} LIMIT 20",
    ),
    "pk_violations": _with(
        _SILVER,
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, {name}_sk AS key_value, count(*) AS copies"
            f" FROM (SELECT {_ROWS[name]} FROM silver) GROUP BY {name}_sk HAVING count(*) > 1"
            for table, name in (
                ("dim_event_timing", "timing"),
                ("dim_spatial_coords", "spatial"),
                ("dim_sun_moon_coords", "sun_moon"),
            )
        ),
    ),
    "fk_orphans": _with(
        _TORN,
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, key_value, child_rows"
            f" FROM ({_ORPHANS.format(c=c, child=child, parent=parent)})"
            for table, child, c, _, parent in _REFERENCES
        ),
    ),
    "orphan_counts": _with(
        _TORN,
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, '{parent_table}'"
            " AS parent_table, count(*) AS orphan_keys,"
            " CAST(coalesce(sum(child_rows), 0) AS BIGINT) AS orphan_rows"
            f" FROM ({_ORPHANS.format(c=c, child=child, parent=parent)})"
            for table, child, c, parent_table, parent in _REFERENCES
        ),
    ),
    "not_null_violations": _with(
        _FACT,
        " UNION ALL ".join(
            f"SELECT {_DELIVERY}, '{c}' AS column_name FROM fact WHERE {c} IS NULL"
            for c in ("trigger_num", "record_num", "timing_sk", "spatial_sk", "grb_error_deg")
        ),
    ),
    "duplicate_deliveries": _with(
        _DAMAGED,
        f"SELECT {_DELIVERY}, count(*) AS copies FROM damaged GROUP BY {_DELIVERY}"
        " HAVING count(*) > 1",
    ),
    "parse_null_pct": _with(_IRREGULAR, _null_pct("irregular_silver")),
    "offset_gaps": _with(
        _DAMAGED,
        "SELECT kafka_topic, kafka_partition, kafka_offset + 1 AS gap_start,"
        " following - 1 AS gap_end, following - kafka_offset - 1 AS missing"
        " FROM (SELECT *, lead(kafka_offset) OVER (PARTITION BY kafka_topic, kafka_partition"
        " ORDER BY kafka_offset) AS following FROM damaged) WHERE following - kafka_offset > 1",
    ),
    "late_messages": _with(
        _DAMAGED
        | {
            "history": "SELECT *, max(kafka_timestamp) OVER (PARTITION BY kafka_topic,"
            " kafka_partition ORDER BY kafka_offset RANGE BETWEEN UNBOUNDED PRECEDING"
            " AND 1 PRECEDING) AS latest_before FROM damaged"
        },
        f"SELECT {_DELIVERY}, kafka_timestamp, latest_before, count(*) AS deliveries"
        f" FROM history WHERE kafka_timestamp < latest_before GROUP BY ALL",
    ),
    "malformed_payloads": _with(
        _IRREGULAR,
        f"SELECT {_DELIVERY}, CASE WHEN kafka_value IS NULL THEN 'null payload'"
        " ELSE 'no known label' END AS reason FROM irregular_texts WHERE kafka_value IS NULL"
        rf" OR NOT regexp_matches(w, '\n(?:{'|'.join(NOTICE_FIELDS)}):')",
    ),
    "key_collisions": _with(
        _MURMUR
        | {
            "keyed": "SELECT h.timing_sk, s.GRB_DATE, s.GRB_TIME, count(*) AS n FROM silver s"
            f" JOIN hashed h USING ({_DELIVERY}) GROUP BY ALL"
        },
        "SELECT timing_sk, count(*) AS variants, CAST(sum(n) AS BIGINT) AS row_count"
        " FROM keyed GROUP BY timing_sk HAVING count(*) > 1",
    ),
    "key_reuse": _with(
        _SILVER,
        "SELECT spatial_sk, count(DISTINCT sun_moon_sk) AS variants, count(*) AS row_count"
        f" FROM (SELECT {_ROWS['spatial']} FROM silver) GROUP BY spatial_sk"
        " HAVING count(DISTINCT sun_moon_sk) > 1",
    ),
    "consumer_lag": _with(
        _DAMAGED
        | {
            "ends": "SELECT kafka_topic, kafka_partition,"
            " max(kafka_offset) + 1 + 10 * kafka_partition AS end_offset"
            " FROM raw GROUP BY kafka_topic, kafka_partition",
            "consumed": "SELECT kafka_topic, kafka_partition, max(kafka_offset) AS latest_offset,"
            " max(kafka_timestamp) AS latest_timestamp FROM damaged"
            " GROUP BY kafka_topic, kafka_partition",
        },
        "SELECT kafka_topic, kafka_partition, end_offset, latest_offset, latest_timestamp,"
        " end_offset - coalesce(latest_offset + 1, 0) AS lag"
        " FROM ends LEFT JOIN consumed USING (kafka_topic, kafka_partition)",
    ),
    "expectation_report": _with(_IRREGULAR, _report(_NOTICE_CHECKS, "irregular_silver")),
    "fact_expectation_report": _with(_FACT, _report(_FACT_CHECKS, "fact")),
    "expected_rows": _with(
        _IRREGULAR,
        "SELECT * EXCLUDE (parse_issue) FROM irregular_silver WHERE "
        + " AND ".join(f"({test})" for test in _NOTICE_CHECKS.values()),
    ),
    "quarantine": _QUARANTINE,
    "stream_quarantine": _QUARANTINE,
    "accepted_notices": _with(
        _IRREGULAR,
        "SELECT * EXCLUDE (parse_issue) FROM irregular_silver WHERE parse_issue IS NULL",
    ),
    "stalled_offsets": _with(
        _RAW,
        "SELECT kafka_topic, kafka_partition, max(kafka_offset) // 3 - 5 AS latest_offset,"
        " max(kafka_offset) + 1 AS end_offset,"
        " max(kafka_offset) + 1 - max(kafka_offset) // 3 AS added FROM raw"
        " WHERE kafka_partition % 2 = 0 GROUP BY kafka_topic, kafka_partition",
    ),
    "typed_notices": _with(
        _SHAPED | _TYPED,
        "SELECT *, CAST(year(burst_time) AS INTEGER) AS burst_year,"
        " CAST(month(burst_time) AS INTEGER) AS burst_month,"
        " CAST(day(burst_time) AS INTEGER) AS burst_day,"
        " CAST(hour(burst_time) AS INTEGER) AS burst_hour,"
        " coalesce(ra_deg >= 0 AND ra_deg < 360 AND abs(dec_deg) <= 90, false) AS position_valid"
        " FROM typed",
    ),
    "sky_separations": _with(
        _SILVER
        | _TYPED
        | {
            "angles": f"SELECT *, radians(ra_deg) AS a1, radians(dec_deg) AS d1,"
            f" radians({SKY_POINT[0]}::DOUBLE) AS a2, radians({SKY_POINT[1]}::DOUBLE) AS d2"
            " FROM typed WHERE ra_deg >= 0 AND ra_deg < 360 AND abs(dec_deg) <= 90"
        },
        f"SELECT {_DELIVERY}, ra_deg, dec_deg, round(degrees(2 * asin(least(1.0, sqrt("
        "pow(sin((d2 - d1) / 2), 2) + cos(d1) * cos(d2) * pow(sin((a2 - a1) / 2), 2))))), 6)"
        " AS separation_deg FROM angles",
    ),
    "near_positions": _with(
        _SILVER
        | _TYPED
        | {
            "positions": "SELECT ra_deg, dec_deg, count(*) AS notices, radians(ra_deg) AS a, radians(dec_deg) AS d"
            " FROM typed WHERE ra_deg >= 0 AND ra_deg < 360 AND abs(dec_deg) <= 90 GROUP BY ra_deg, dec_deg",
            "pairs": "SELECT p.ra_deg, p.dec_deg, p.notices, q.ra_deg AS near_ra_deg, q.dec_deg AS near_dec_deg,"
            " q.notices AS near_notices, degrees(2 * asin(least(1.0, sqrt(pow(sin((q.d - p.d) / 2), 2)"
            " + cos(p.d) * cos(q.d) * pow(sin((q.a - p.a) / 2), 2))))) AS separation"
            " FROM positions p JOIN positions q ON (p.ra_deg, p.dec_deg) < (q.ra_deg, q.dec_deg)",
        },
        "SELECT * EXCLUDE (separation), round(separation, 6) AS separation_deg"
        f" FROM pairs WHERE separation <= {NEAR_DEG}",
    ),
    "rescued_schema": _with(
        _IRREGULAR
        | _RESCUED
        | {
            "kinds": f"SELECT {_DELIVERY}, label, regexp_full_match(value, '-?(0|[1-9][0-9]*)') AS whole FROM rescued",
        },
        "SELECT label, count(*) AS value_count, count(DISTINCT (kafka_topic, kafka_partition, kafka_offset)) AS message_count,"
        " CASE WHEN bool_and(whole) THEN 'BIGINT' WHEN bool_or(whole) THEN 'VARIANT' ELSE 'STRING' END AS value_type"
        " FROM kinds GROUP BY label",
    ),
    "rescued_typed": _with(
        _IRREGULAR | _RESCUED,
        f"SELECT {_DELIVERY}, CAST(any_value(r.value) FILTER (r.label = 'BACKGROUND') AS BIGINT) AS background,"
        " any_value(r.value) FILTER (r.label = 'FOO_BAR') AS foo_bar, any_value(r.value) FILTER (r.label = 'ODD_ONE') AS odd_one"
        f" FROM irregular LEFT JOIN rescued r USING ({_DELIVERY}) GROUP BY {_DELIVERY}",
    ),
    "bucketed_fact_with_timing": _with(
        _GOLD,
        "SELECT f.trigger_num, f.record_num, t.grb_date_raw, t.grb_time_raw, f.grb_error_deg,"
        " f.loc_algorithm FROM fact f LEFT JOIN timing t ON f.timing_sk = t.timing_sk",
    ),
    "stream_orphans": _with(
        _TORN
        | {
            "members": f"SELECT {_TIMING_SK}, min(kafka_timestamp) AS seen FROM damaged_silver GROUP BY ALL",
            "line": "SELECT least((SELECT max(kafka_timestamp) FROM fact), (SELECT max(seen) FROM members))"
            " - INTERVAL 10 MINUTE AS watermark",
        },
        "SELECT timing_sk AS key_value, count(*) AS child_rows, min(kafka_timestamp) AS first_timestamp,"
        " max(kafka_timestamp) AS latest_timestamp FROM fact WHERE timing_sk NOT IN (SELECT timing_sk FROM members)"
        " AND kafka_timestamp + INTERVAL 1 HOUR < (SELECT watermark FROM line) GROUP BY timing_sk",
    ),
    "stream_collisions": _with(
        _MURMUR
        | {
            "keyed": f"SELECT CAST(((h.timing_sk % {SHORT_KEYS}) + {SHORT_KEYS}) % {SHORT_KEYS} AS INTEGER) AS timing_sk,"
            f" s.GRB_DATE, s.GRB_TIME, count(*) AS n FROM silver s JOIN hashed h USING ({_DELIVERY}) GROUP BY ALL"
        },
        "SELECT timing_sk, count(*) AS variants, CAST(sum(n) AS BIGINT) AS row_count"
        " FROM keyed GROUP BY timing_sk HAVING count(*) > 1",
    ),
    "stream_lag": "SELECT CAST(NULL AS VARCHAR) AS kafka_topic, CAST(NULL AS INTEGER) AS kafka_partition,"
    " count(*) AS rows_read, CAST(0 AS BIGINT) AS lag FROM events",
    "stream_null_shares": _with(
        _IRREGULAR
        | {
            "line": "SELECT max(kafka_timestamp) AS newest FROM irregular_silver WHERE kafka_offset % 3 <> 0",
            "hours": "SELECT *, date_trunc('hour', kafka_timestamp) AS hour FROM irregular_silver",
            "judged": "SELECT *, hour::TIMESTAMP AS window_start, kafka_offset % 3 = 0 AND hour + INTERVAL 2 HOUR <="
            " (SELECT newest FROM line) AS too_late FROM hours",
            "counted": "SELECT window_start, count(*) FILTER (NOT too_late) AS total, count(*) FILTER (too_late) AS late,"
            " window_start + INTERVAL 2 HOUR <= (SELECT max(kafka_timestamp) FROM irregular_silver) AS closed, "
            + ", ".join(f"count({n}) FILTER (NOT too_late) AS {n}" for n in NOTICE_FIELDS)
            + " FROM judged GROUP BY window_start",
            "fields": f"UNPIVOT counted ON {', '.join(NOTICE_FIELDS)} INTO NAME field VALUE present",
        },
        "SELECT window_start, field, total, total - present AS missing,"
        " round(100.0 * (total - present) / nullif(total, 0), 4) AS null_pct, late, closed FROM fields",
    ),
    "stream_guarded": _with(_IRREGULAR, _report(_NOTICE_CHECKS, "irregular_silver")),
    "stream_silver": _with(_SILVER, "SELECT * FROM silver"),
    "stream_dims_bounded": _with(
        _GOLD, "SELECT spatial_sk, right_ascension, declination, galactic_coords FROM spatial"
    ),
    "stream_deliveries": _with(
        _DAMAGED,
        f"SELECT {_DELIVERY}, any_value(kafka_key) AS kafka_key, any_value(kafka_value) AS kafka_value"
        f" FROM damaged GROUP BY {_DELIVERY}",
    ),
    "stream_gaps": _with(
        _DAMAGED
        | {
            "offsets": f"SELECT {_DELIVERY}, min(kafka_timestamp) AS ts, max(kafka_timestamp) AS newest"
            f" FROM damaged GROUP BY {_DELIVERY}",
            "followed": "SELECT *, lead(kafka_offset) OVER feed AS following, lead(ts) OVER feed AS opened,"
            " max(newest) OVER (PARTITION BY kafka_topic, kafka_partition) AS latest FROM offsets"
            " WINDOW feed AS (PARTITION BY kafka_topic, kafka_partition ORDER BY kafka_offset)",
        },
        "SELECT kafka_topic, kafka_partition, kafka_offset + 1 AS gap_start, following - 1 AS gap_end,"
        " following - kafka_offset - 1 AS missing, opened, opened + INTERVAL 1 DAY < latest AS lost"
        " FROM followed WHERE following - kafka_offset > 1",
    ),
    "stream_dims": _with(_GOLD, "SELECT sun_moon_sk, sun_position, moon_position FROM sun_moon"),
    "stream_dim_timing": _with(_GOLD, "SELECT timing_sk, grb_date_raw, grb_time_raw FROM timing"),
    "stream_dim_spatial": _with(
        _GOLD, "SELECT spatial_sk, right_ascension, declination, galactic_coords FROM spatial"
    ),
    "stream_hops": _with(_FACT, "SELECT * FROM fact"),
    "stream_fanout": _with(_GOLD, _CONTEXT),
    "stream_fanout_timing": _with(_GOLD, "SELECT * FROM timing"),
}
# Reports kept by a stream equal those made from all rows.
ORACLE |= {f"stream_{name}": ORACLE[report] for name, report in (("accuracy", "accuracy_by_algorithm"), ("parse_quality", "parse_quality"))}
