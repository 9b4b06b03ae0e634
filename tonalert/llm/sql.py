"""DuckDB texts of the queries, written apart from the Spark side."""

from __future__ import annotations

from tonalert.llm import conversation_trie as ct
from tonalert.llm import lm_score as lm
from tonalert.llm import quality_rules as qr
from tonalert.llm import superminhash as sm

_WORD = r"[^\x20\x09-\x0D]+"


def crc32_sql(expr: str) -> str:
    """CRC-32 (polynomial 0xEDB88320) of a short ASCII text, bit by bit."""
    step = "CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: {step})"
    codes = f"list_transform(string_split({expr}, ''), lambda s: ord(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295::BIGINT)"


def quality_features_ctes(source: str) -> str:
    """CTEs up to ``feat``: counts and features of the texts of ``source`` (doc_id, text, lang)."""
    return f"""
src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM {source}),
tok AS (SELECT rid, unnest(regexp_extract_all(t, '{_WORD}')) AS w, generate_subscripts(regexp_extract_all(t, '{_WORD}'), 1) AS i FROM src),
tri AS (SELECT rid, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM tok WINDOW o AS (PARTITION BY rid ORDER BY i)),
cnt AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w, w2, w3) AS c FROM tri WHERE w3 IS NOT NULL),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM cnt, (VALUES (0), (1), (2)) v(k) WHERE c > 1 GROUP BY rid),
feat0 AS (
  SELECT s.rid, doc_id, stratum, len(regexp_extract_all(t, '{_WORD}'))::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^!]', '', 'g')) AS shouts, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals
  FROM src s LEFT JOIN cov USING (rid)),
feat AS (
  SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_symbols / greatest(n_words, 1) AS f_symbols,
    (len(lines) - len(list_distinct(lines))) / greatest(len(lines), 1) AS f_dup_lines,
    n_repeat_words / greatest(n_words, 1) AS f_repeats,
    shouts / greatest(n_words, 1) AS f_shouts, capitals / greatest(word_chars, 1) AS f_capitals
  FROM feat0)"""


def quality_verdict_ctes(alpha: float = qr.ALPHA, delta: float = qr.DELTA) -> str:
    """CTEs from ``feat`` to ``verdict`` (feat's columns and kept)."""
    grid = ", ".join(f"('{r}', {c}::DOUBLE)" for r in qr.RULES for c in qr.GRID[r])
    value = "CASE rule " + " ".join(f"WHEN '{r}' THEN f_{r}" for r in qr.RULES) + " END"
    return f"""
lab AS (SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
known AS (SELECT f.*, q = 1 AS good, {crc32_sql("f.doc_id::VARCHAR")} % {qr.SELECT_FOLDS} = 0 AS sel
          FROM feat f JOIN lab USING (doc_id) WHERE NOT base_failed),
grid(rule, cutoff) AS (VALUES {grid}),
points AS (
  SELECT stratum, rule, cutoff,
    round(count(*) FILTER (NOT good AND {value} > cutoff) / count(*) FILTER (NOT good)
          - count(*) FILTER (good AND {value} > cutoff) / count(*) FILTER (good), 9) AS gain
  FROM known, grid WHERE sel GROUP BY ALL HAVING count(*) FILTER (good) > 0 AND count(*) FILTER (NOT good) > 0),
strata AS (SELECT count(DISTINCT stratum) AS n FROM points),
best AS (SELECT stratum, rule, arg_max(cutoff, (gain, cutoff)) AS cutoff, max(gain) AS gain FROM points GROUP BY ALL HAVING max(gain) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY gain DESC, cutoff DESC, rule DESC) AS k FROM best),
held AS (SELECT rid, f.stratum, min(k) FILTER ({value} > cutoff) AS at
         FROM known f JOIN ranked r ON f.stratum = r.stratum WHERE NOT sel AND good GROUP BY ALL),
risk AS (SELECT r.stratum, r.k, count(*) AS n, count(*) FILTER (h.at <= r.k) AS x
         FROM ranked r JOIN held h ON h.stratum = r.stratum GROUP BY ALL),
tested AS (
  SELECT stratum, k, x < n * {alpha} AND (
      SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({alpha}) + (n - i) * ln(1 - {alpha})))
      FROM range(0, x + 1) u(i)) <= {delta} / ({len(qr.RULES)} * (SELECT n FROM strata)) AS ok
  FROM risk),
used AS (SELECT r.* FROM ranked r JOIN (SELECT stratum, max(k) AS top FROM tested WHERE ok GROUP BY stratum) u
         ON u.stratum = r.stratum AND r.k <= u.top),
failed AS (SELECT DISTINCT rid FROM feat f JOIN used u ON f.stratum = u.stratum WHERE {value} > cutoff),
verdict AS (SELECT f.*, NOT base_failed AND x.rid IS NULL AS kept FROM feat f LEFT JOIN failed x USING (rid))"""


QUALITY_SQL = f"""WITH {quality_features_ctes("documents")}, {quality_verdict_ctes()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM verdict"""


def line_ctes(source: str) -> str:
    """CTEs up to ``shorter``: the texts of ``source`` (rid, doc_id, t) without their dropped lines."""
    key = "translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
ln AS (SELECT rid, doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM {source}),
keyed AS (SELECT *, {key} AS k FROM ln),
often AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) >= 3),
marked AS (SELECT rid, l.doc_id, line, i, o.k IS NOT NULL AND l.doc_id IS DISTINCT FROM o.keeper AS dropped FROM keyed l LEFT JOIN often o USING (k)),
shorter AS (SELECT rid, doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), '') AS t FROM marked GROUP BY rid, doc_id)"""


LINE_SQL = f"""WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), {line_ctes("src")}
SELECT doc_id, n_lines, n_dropped, sha256(t) AS kept_sha256 FROM shorter"""


def hit_ctes(source: str) -> str:
    """CTEs up to ``hits``: per row of ``source`` (rid, doc_id, t) its words, hit words and items."""
    split = r"string_split_regex(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
dw AS (SELECT rid, doc_id, list_filter({split.format("t")}, lambda w: w <> '') AS ws FROM {source}),
iw AS (SELECT coalesce(item_id::VARCHAR, '') AS item, list_filter({split.format("coalesce(text, '')")}, lambda w: w <> '') AS ws FROM benchmark),
iwin AS (SELECT DISTINCT item, ws[k:k + 9] AS win FROM (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS k FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT len(win) AS size FROM iwin),
dwin AS (SELECT rid, k, ws[k:k + size - 1] AS win FROM (
  SELECT rid, ws, size, unnest(range(1, len(ws) - size + 2)) AS k FROM dw, sizes WHERE len(ws) >= size)),
found AS (SELECT rid, k, win, item FROM dwin JOIN iwin USING (win)),
covered AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + len(win))) AS p FROM found) GROUP BY rid),
held AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid),
hits AS (SELECT d.rid, doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items
  FROM dw d LEFT JOIN covered USING (rid) LEFT JOIN held USING (rid))"""


BENCHMARK_SQL = f"""WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), {hit_ctes("src")}
SELECT doc_id, n_words, n_hit, n_items, sha256(items) AS items_sha256, n_hit > 0 AS contaminated FROM hits"""


def near_ctes(source: str, percent: int = sm.PERCENT) -> str:
    """CTEs up to ``near``: per row of ``source`` (rid, doc_id, t) its set size and component. All
    pairs of different sets that share a shingle are compared with ``percent``."""
    return f"""
sw AS (SELECT rid, doc_id, list_filter(string_split_regex(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM {source}),
sets AS MATERIALIZED (SELECT rid, doc_id, list_sort(list_distinct(list_transform(
         range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - 4, 1) + 1 END), lambda k: array_to_string(ws[k:k + 4], ' ')))) AS s FROM sw),
cls AS MATERIALIZED (SELECT min(doc_id) AS id, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
sh AS MATERIALIZED (SELECT id, n, unnest(s) AS g FROM cls),
pairs AS MATERIALIZED (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.id < b.id
          WHERE 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) GROUP BY ALL),
near_links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * k >= {percent} * (na + nb - k) UNION SELECT b, a FROM pairs WHERE 100 * k >= {percent} * (na + nb - k)),
reach AS (SELECT id, id AS c FROM cls UNION SELECT r.id, l.b FROM reach r JOIN near_links l ON l.a = r.c),
comp AS (SELECT id, min(c) AS c FROM reach GROUP BY id),
near AS (SELECT rid, s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(comp.c, s.doc_id) AS component_id
         FROM sets s LEFT JOIN cls ON s.s = cls.s AND len(s.s) > 0 LEFT JOIN comp ON comp.id = cls.id)"""


NEAR_SQL = f"""WITH RECURSIVE src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), {near_ctes("src")}
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM near"""


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
WARC_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}', 1 +
    ((('0x' || substr(x, ((i // 4) * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM d"""


LM_SQL = f"""
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % 5 <> 1 AS train FROM documents),
tk AS (SELECT rid, list_append(list_filter(string_split_regex(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''), ' end') AS ws FROM src),
tok AS MATERIALIZED (SELECT rid, train, unnest(ws) AS w, unnest(list_prepend(' start', ws)[:len(ws)]) AS v,
    unnest(list_prepend(NULL, list_prepend(' start', ws))[:len(ws)]) AS u FROM tk JOIN src USING (rid)),
uni AS MATERIALIZED (SELECT w, count(*) AS c FROM tok WHERE train GROUP BY w),
big AS MATERIALIZED (SELECT v, w, count(*) AS c FROM tok WHERE train GROUP BY v, w),
tri AS MATERIALIZED (SELECT u, v, w, count(*) AS c FROM tok WHERE train AND u IS NOT NULL GROUP BY u, v, w),
tot AS (SELECT sum(c)::DOUBLE AS n, count(*) AS k, (SELECT count(*) FROM src WHERE train) AS starts FROM uni),
val AS (SELECT rid, u1.c IS NOT NULL AS known, (coalesce(u1.c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (k + 1)) AS p0,
    coalesce(b.c, 0)::DOUBLE AS cb, CASE WHEN tok.v = ' start' THEN starts ELSE coalesce(s.c, 0) END::DOUBLE AS cs,
    coalesce(t.c, 0)::DOUBLE AS ct, coalesce(x.c, 0)::DOUBLE AS cx
  FROM tok CROSS JOIN tot LEFT JOIN uni u1 ON u1.w = tok.w LEFT JOIN uni s ON s.w = tok.v LEFT JOIN big b ON b.v = tok.v AND b.w = tok.w
  LEFT JOIN big x ON x.v = tok.u AND x.w = tok.v LEFT JOIN tri t ON t.u = tok.u AND t.v = tok.v AND t.w = tok.w),
one AS (SELECT *, (cb + {lm.MASS}::DOUBLE * p0) / (cs + {lm.MASS}::DOUBLE) AS p1 FROM val),
two AS (SELECT *, CASE WHEN cx >= {lm.MIN_CONTEXT} THEN (ct + {lm.MASS_TWO}::DOUBLE * p1) / (cx + {lm.MASS_TWO}::DOUBLE) ELSE p1 END AS p2 FROM one)
SELECT doc_id, NOT train AS held_out, count(*) AS n_tokens, count(*) FILTER (known) AS n_known, any_value(n)::BIGINT AS train_tokens,
  round(sum(log10(p0)), 6) AS base_score, round(sum(log10(p2)), 6) AS score
FROM two JOIN src USING (rid) CROSS JOIN tot GROUP BY rid, doc_id, train"""


# Every document through every order: the first filter of the order that it fails removes it.
AUDIT_SQL = """
WITH src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS eldest FROM src),
failed AS (SELECT rid, doc_id, part,
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > eldest THEN 'E' ELSE '' END AS fs FROM cut),
lab AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
rows AS (SELECT part, fs, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM failed LEFT JOIN lab USING (doc_id)),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM f a, f b, f c, f d, f e
           WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
walked AS (SELECT part, o, fs, good, toxic, coalesce(list_min(list_transform(string_split(nullif(fs, ''), ''), lambda x: instr(o, x))), 6) AS gone FROM rows, orders),
steps AS (SELECT part, o, k, substr(o, k, 1) AS x,
    count(*) FILTER (gone > k) AS kept, count(*) FILTER (gone = k) AS removed, count(*) FILTER (gone < k AND contains(fs, substr(o, k, 1))) AS redundant,
    count(*) FILTER (fs = substr(o, k, 1)) AS unique_fails, count(*) FILTER (gone = k AND good = 1) AS good_lost,
    count(*) FILTER (gone = k AND toxic = 1) AS toxic_lost
  FROM walked, range(1, 6) r(k) GROUP BY ALL)
SELECT part, o AS filter_order, k::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM steps"""


# A node is the list of its turns; a node's subtree is found through the smallest member's own prefixes.
TRIE_SQL = f"""
WITH src AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, role, t, row_number() OVER (PARTITION BY conv_id
    ORDER BY turn NULLS FIRST, sha256(strlen(role)::VARCHAR || ':' || role || t)) - 1 AS pos FROM src),
conv AS (SELECT DISTINCT conv_id, conv_id - conv_id % {ct.SHARED} AS base, {crc32_sql("conv_id::VARCHAR")} % {ct.HEAD} AS h FROM src),
parts AS (
  SELECT c.conv_id, 0 AS side, pos, role, t FROM conv c JOIN own o ON o.conv_id = c.base AND o.pos < c.h
  UNION ALL SELECT c.conv_id, 1, pos, role, t FROM conv c JOIN own o ON o.conv_id = c.conv_id AND o.pos >= c.h),
whole AS (SELECT conv_id, list({{'r': role, 't': t}} ORDER BY side, pos) AS ts FROM parts GROUP BY conv_id),
paths AS MATERIALIZED (SELECT conv_id, d, coalesce(ts[:d], []) AS p, d = coalesce(len(ts), 0) AS ends
  FROM (SELECT conv_id, ts FROM conv LEFT JOIN whole USING (conv_id)), range(0, coalesce(len(ts), 0) + 1) u(d)),
node AS MATERIALIZED (SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ids
  FROM paths GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[:d - 1] AS p, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_node AS MATERIALIZED (SELECT node.*, coalesce(kids.n, 0) AS n_children, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(p[d].t) END AS w FROM node LEFT JOIN kids USING (d, p)),
sub AS (SELECT a.d, a.p, count(*) FILTER (u.n_children = 0) AS n_leaves, sum(u.w)::BIGINT AS saved
  FROM full_node u JOIN paths a ON a.conv_id = u.conv_id AND a.d <= u.d GROUP BY a.d, a.p)
SELECT f.conv_id, f.d::BIGINT AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved AS saved_tokens, sha256(f.ids) AS ends_sha256
FROM full_node f JOIN sub USING (d, p) LEFT JOIN node up ON up.d = f.d - 1 AND up.p = f.p[:f.d - 1]"""
