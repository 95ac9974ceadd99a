"""The expected results of those queries that SQL can express, for DuckDB."""

from __future__ import annotations

from daybook.llm import mixing, quality_rules, queries, sharding, url_filter, vector_codes

_WORDS = r"[^\x20\x09-\x0D]+"


def _failed(rule: quality_rules.Rule) -> str:
    tests = []
    if rule.low is not None:
        tests.append(f"100 * {rule.part} < {rule.low} * {rule.whole}")
    if rule.high is not None:
        tests.append(f"100 * {rule.part} > {rule.high} * {rule.whole}")
    return f"(n_words >= {rule.min_words} AND ({' OR '.join(tests)}))"


def quality() -> str:
    stops = [*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)]
    stop_list = ", ".join(f"'{w}'" for w in stops)
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '{_WORDS}') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS ls
  FROM d
), windows AS (
  SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)
), twice AS (
  SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM twice)
  GROUP BY rid
), counts AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines,
    len(list_filter(ls, lambda x: regexp_matches(x, '^{blank}*[-*•]')))::BIGINT AS n_bullet_lines,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…){blank}*\z')))::BIGINT
      AS n_ellipsis_lines,
    len(list_filter(ws, lambda x: x IN ({stop_list})))::BIGINT AS n_stop_words,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1]))::BIGINT AS n_stuttered
  FROM w LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    concat_ws(',', {", ".join(f"CASE WHEN {_failed(r)} THEN '{r.name}' END" for r in quality_rules.RULES)})
      AS failed_rules
  FROM counts
)
SELECT *, NOT base_failed AND failed_rules = '' AS kept FROM judged
"""


def urls() -> str:
    order, bins, largest = url_filter.ORDER, url_filter.BINS, url_filter.LARGEST
    rules = sorted(url_filter.RULES, key=lambda r: (-len(r), r))

    def fits(rule: str) -> str:
        host, _, start = rule.partition("/")
        return f"(host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '/{start}')"

    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r in rules) + " END"
    allowed = ", ".join(f"'{r}'" for r, v in url_filter.RULES.items() if v == "allow")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pads = " || ".join(["chr(2)"] * order)

    def mixed(before: str, count: str, total: str, kinds: str) -> str:
        return (
            f"CASE WHEN coalesce({total}, 0) > 0 THEN"
            f" (coalesce({count}, 0) + {kinds} * {before}) / ({total} + {kinds})::DOUBLE"
            f" ELSE {before} END"
        )

    level = "\n".join(
        f""", p{k} AS (
  SELECT u.gram, {mixed("u.pa", "s.a", "c.na", "c.ta")} AS pa, {mixed("u.pr", "s.r", "c.nr", "c.tr")} AS pr
  FROM {"uniform" if not k else f"p{k - 1}"} u
  LEFT JOIN suffixes s ON s.s = right(u.gram, {k + 1})
  LEFT JOIN contexts c ON c.context = left(right(u.gram, {k + 1}), {k})
)"""
        for k in range(order + 1)
    )
    return rf"""
WITH rest AS (
  SELECT page_id, coalesce(url, '') AS url, CASE WHEN strpos(coalesce(url, ''), '://') > 0
    THEN substr(url, strpos(url, '://') + 3) END AS x FROM pages
), cut AS (
  SELECT page_id, url, regexp_extract(coalesce(x, ''), '^[^/?#]*') AS h, x FROM rest
), parts AS (
  SELECT page_id, translate(h, '{upper}', '{upper.lower()}') AS host,
    regexp_extract(substr(coalesce(x, ''), length(h) + 1), '^[^?#]*') AS path,
    CASE WHEN x IS NULL THEN url
      ELSE translate(h, '{upper}', '{upper.lower()}') || substr(x, length(h) + 1) END AS t
  FROM cut
), ruled AS (SELECT *, {rule} AS rule FROM parts
), texts AS (
  SELECT host, path, t, rule IN ({allowed}) AS accepted, count(*) AS n,
    md5(t)[1] IN ('0', '1', '2', '3') AS held_out
  FROM ruled GROUP BY ALL
), chars AS (
  SELECT *, regexp_extract_all({pads} || t || chr(3), '(?s).') AS cs FROM texts
), grams AS (
  SELECT host, path, t, n, accepted, held_out,
    unnest(list_transform(range(1, len(cs) - {order - 1}), lambda i: array_to_string(cs[i:i + {order}], ''))) AS gram
  FROM chars
), counts AS (
  SELECT gram, coalesce(sum(n) FILTER (accepted), 0) AS a,
    coalesce(sum(n) FILTER (NOT accepted), 0) AS r
  FROM grams WHERE accepted IS NOT NULL AND NOT held_out GROUP BY gram
), suffixes AS (
  SELECT right(gram, k + 1) AS s, left(right(gram, k + 1), k) AS context, sum(a) AS a, sum(r) AS r
  FROM counts, (SELECT unnest(range(0, {order + 1}))::INT AS k) GROUP BY ALL
), contexts AS (
  SELECT context, sum(a) AS na, sum(r) AS nr, count(*) FILTER (a > 0) AS ta,
    count(*) FILTER (r > 0) AS tr FROM suffixes GROUP BY context
), uniform AS (
  SELECT DISTINCT gram, 1.0::DOUBLE / {url_filter.ALPHABET} AS pa, 1.0::DOUBLE / {url_filter.ALPHABET} AS pr FROM grams
){level}, ratios AS (
  SELECT gram, CAST(ln(pa) - ln(pr) AS DECIMAL(18,9)) AS ratio FROM p{order}
), scored AS (
  SELECT host, path, t, n, accepted, held_out, sum(ratio)::DOUBLE / (length(t) + 1) AS score
  FROM grams JOIN ratios USING (gram) GROUP BY host, path, t, n, accepted, held_out
), binned AS (
  SELECT *, greatest(-{largest}, least({largest}, floor(score * {bins})::INT)) AS bin FROM scored
), cuts AS (
  SELECT c, sum(n) FILTER (accepted AND bin < c) AS lost, sum(n) FILTER (NOT accepted AND bin >= c) AS passed,
    sum(n) FILTER (accepted) AS acc, sum(n) FILTER (NOT accepted) AS rej
  FROM binned, (SELECT unnest(range(-{largest}, {largest + 2}))::INT AS c)
  WHERE held_out AND accepted IS NOT NULL GROUP BY c
), best AS (
  SELECT coalesce((
    SELECT c FROM cuts WHERE acc > 0 AND rej > 0
    ORDER BY coalesce(lost, 0) * rej + coalesce(passed, 0) * acc, abs(c), c LIMIT 1
  ), 0) AS c
)
SELECT page_id, host, path, rule, round(score, 6) AS score,
  CASE WHEN rule IN ({allowed}) THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN bin >= (SELECT c FROM best) THEN 'allow' ELSE 'block' END AS verdict
FROM ruled JOIN binned USING (host, path, t)
"""


def mixture() -> str:
    weights, epochs = queries.TARGET_WEIGHTS, queries.EPOCHS
    wanted = "CASE source " + " ".join(f"WHEN '{s}' THEN {w}::DOUBLE" for s, w in weights.items()) + " END"
    whole = float(16**13)
    return f"""
WITH sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::BIGINT AS size, {wanted} AS wanted
  FROM documents GROUP BY source
), totals AS (
  SELECT sum(size)::DOUBLE AS total, coalesce(sum(size) FILTER (wanted IS NULL), 0)::DOUBLE AS others,
    coalesce(sum(wanted) FILTER (wanted IS NOT NULL AND size > 0), 0)::DOUBLE AS present FROM sizes
), rates AS (
  SELECT source, CASE WHEN size > 0 THEN {epochs}::DOUBLE * total * CASE
      WHEN wanted IS NULL THEN (1.0::DOUBLE - present) * size / greatest(others, 1)
      WHEN others = 0 AND present > 0 THEN wanted / present ELSE wanted END / size
    ELSE {epochs}::DOUBLE END AS rate
  FROM sizes, totals
), steps AS (
  SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k
  FROM rates WHERE rate > 0
), logs AS (
  SELECT source, k, -rate + coalesce(sum(CASE WHEN k > 0 THEN ln(rate) - ln(k) ELSE 0 END)
    OVER (PARTITION BY source ORDER BY k), 0) AS log FROM steps
), upto AS (
  SELECT source, list(p ORDER BY k) AS upto FROM (
    SELECT source, k, sum(exp(log)) OVER (PARTITION BY source ORDER BY k) AS p FROM logs
  ) GROUP BY source
), drawn AS (
  SELECT d.*, upto, concat_ws(':', '{mixing.SEED}', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, ''))) AS key
  FROM documents d JOIN upto u ON d.source IS NOT DISTINCT FROM u.source
), counted AS (
  SELECT *, ('0x' || substr(md5(key), 1, 13))::BIGINT / {whole}::DOUBLE AS uniform FROM drawn
), copies AS (
  SELECT * EXCLUDE (upto, uniform),
    unnest(range(1, len(list_filter(upto, lambda p: p <= uniform)) + 1)) AS copy
  FROM counted
)
SELECT * EXCLUDE (key), ('0x' || substr(md5(key || ':' || copy), 1, 13))::BIGINT AS shuffle_key FROM copies
"""


def archives() -> str:
    """Base32 of the digest: five hexadecimal digits make four letters."""
    letter = """substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1), 1)"""
    return f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), kept AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: {letter}), '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to
FROM kept
"""


#: The remainder of each byte, and the CRC-32 of a text from its bytes.
_CRC_STEPS = """list_transform(range(256), lambda x: list_reduce(range(8),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, x))"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(
    list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: ('0x' || p)::BIGINT),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"""


def conversations() -> str:
    family, most = queries.FAMILY, queries.MOST_TAKEN
    return f"""
WITH crc AS (SELECT {_CRC_STEPS} AS steps
), told AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}}
      ORDER BY turn NULLS FIRST, coalesce(role, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), asked AS (
  SELECT conv_id, turns, conv_id - conv_id % {family} AS donor,
    {_crc("conv_id::VARCHAR")} % {most + 1} AS h
  FROM told, crc
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(d.turns, [])[1:h], a.turns[h + 1:len(a.turns)]) AS path
  FROM asked a LEFT JOIN told d ON d.conv_id = a.donor
), members AS (
  SELECT conv_id, path[1:d] AS node, d, d = len(path) AS ends
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node, d
), children AS (
  SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1
), whole AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN d > 0 THEN (n_convs - 1) * length(n.node[d].x) ELSE 0 END AS saved
  FROM nodes n LEFT JOIN children c ON c.node = n.node
), below AS (
  SELECT above, sum(saved) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT saved, n_children, unnest(list_transform(range(0, d + 1), lambda i: node[1:i])) AS above
    FROM whole)
  GROUP BY above
)
SELECT w.conv_id, w.d::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs,
  w.n_children::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
  w.ends_sha256
FROM whole w JOIN below b ON b.above = w.node
LEFT JOIN nodes p ON w.d > 0 AND p.node = w.node[1:w.d - 1]
"""


def codes() -> str:
    parts, entries, scale = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.SCALE
    steps = []
    for n in range(vector_codes.ROUNDS + 1):
        square = "list_sum(list_transform(list_zip(a.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"""near{n} AS MATERIALIZED (
  SELECT row, a.p, a.x, arg_min(entry, (square, entry)) AS entry, min(square)::BIGINT AS square
  FROM (SELECT row, a.p, a.x, entry, {square} AS square FROM cut a JOIN book{n} b ON a.p = b.p) a
  GROUP BY ALL
)""")
        if n == vector_codes.ROUNDS:
            break
        steps.append(f"""book{n + 1} AS MATERIALIZED (
  SELECT p, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
    SELECT p, entry, i, sum(x[i]) AS s, count(*) AS n
    FROM (SELECT p, entry, x, unnest(range(1, len(x) + 1)) AS i FROM near{n}) GROUP BY ALL)
  GROUP BY p, entry
  UNION ALL SELECT p, entry, x FROM book{n} b
  WHERE NOT EXISTS (SELECT 1 FROM near{n} a WHERE a.p = b.p AND a.entry = b.entry)
)""")
    last = vector_codes.ROUNDS
    return f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), cut AS MATERIALIZED (
  SELECT row, vec_id, label, p, v[len(v) * p // {parts} + 1:len(v) * (p + 1) // {parts}] AS x
  FROM (SELECT *, unnest(range(0, {parts})) AS p FROM whole)
), book0 AS (SELECT p, row - 1 AS entry, x FROM cut WHERE row <= {entries}
), {", ".join(steps)}, coded AS (
  SELECT row, string_agg(printf('%02x', entry), '' ORDER BY p) AS code, sum(square)::BIGINT AS error
  FROM near{last} GROUP BY row
), digest AS (
  SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, entry)) AS codebooks_sha256
  FROM book{last}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN whole USING (row), digest
"""


def shards() -> str:
    n = queries.SHARDS
    return f"""
WITH crc AS (SELECT {_CRC_STEPS} AS steps
), sized AS (
  SELECT doc_id, (coalesce(strlen(text), 0) + 1)::BIGINT AS size,
    {_crc("coalesce(text, '')")}::BIGINT AS text_crc32
  FROM documents, crc
), placed AS (
  SELECT *, (sum(size) OVER (ORDER BY doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING))::HUGEINT AS upto,
    (sum(size) OVER ())::HUGEINT AS total FROM sized
), cut AS (
  SELECT *, least(((2 * upto - size) * {n}) // (2 * total), {n - 1})::INTEGER AS shard FROM placed
)
SELECT doc_id, size, text_crc32, '{sharding.LAW}' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1 AS slot,
  NULL::INTEGER AS grown_shard
FROM cut
"""


def oracles() -> dict[str, str]:
    return {
        "op3_poisson_mixing": mixture(),
        "op4_url_filter": urls(),
        "op5_warc": archives(),
        "op6_quality_rules": quality(),
        "op11_conversation_trie": conversations(),
        "op12_vector_codes": codes(),
        "op13_sharding": shards(),
    }
