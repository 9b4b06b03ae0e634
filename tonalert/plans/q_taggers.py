"""Queries for E9's taggers: names of several words and the learned tagger."""

from __future__ import annotations

from pyspark.sql import functions as F

from tonalert.functions import arrays as A
from tonalert.functions import entities as E
from tonalert.operators import models as MD
from tonalert.operators.splits import split_exact
from tonalert.operators.taggers import LOG_UNIT, Hmm
from tonalert.plans import fixtures as fx
from tonalert.plans import sqltext as q
from tonalert.plans.registry import normalise, register, with_ctes

# Phrases are found as n-grams (up to four words) or by their first word and a comparison of the whole, the longest at
# each place stays, and places are walked from the left: from a match to the first one that starts at its end or later.
_PHRASES_SQL = (
    "WITH RECURSIVE " + with_ctes(q.tagged_docs_cte(), q.entity_spans_cte()).removeprefix("WITH ")
    + ", phrases AS (SELECT list_filter(string_split(entity, ' '), lambda w: w <> '') AS w, min(tag) AS kind FROM "
    "(SELECT entity, min(tag) AS tag FROM spans GROUP BY entity) GROUP BY 1), "
    "listed AS MATERIALIZED (SELECT *, len(w) AS n FROM phrases WHERE len(w) > 0), "
    "place AS (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS p FROM tok_lists), "
    "found AS (SELECT doc_id, p, n, kind FROM (SELECT doc_id, p, toks[p:p + k - 1] AS g FROM place, range(1, 5) r(k) WHERE p + k - 1 <= len(toks)) "
    "JOIN listed ON listed.w = g AND n <= 4 "
    "UNION ALL SELECT doc_id, p, n, kind FROM place JOIN (SELECT *, w[1] AS first FROM listed WHERE n > 4) l "
    "ON toks[p] = l.first AND p + n - 1 <= len(toks) AND toks[p + n - 1] = l.w[n] AND toks[p:p + n - 1] = l.w), "
    "longest AS MATERIALIZED (SELECT doc_id, p, max(n) AS n, arg_max(kind, n) AS kind FROM found GROUP BY doc_id, p), "
    "linked AS MATERIALIZED (SELECT a.doc_id, a.p, b.p AS nxt FROM longest a ASOF LEFT JOIN longest b ON a.doc_id = b.doc_id AND a.p + a.n <= b.p), "
    "walk AS (SELECT doc_id, min(p) AS p FROM longest GROUP BY doc_id "
    "UNION ALL SELECT w.doc_id, l.nxt FROM walk w JOIN linked l ON l.doc_id = w.doc_id AND l.p = w.p WHERE l.nxt IS NOT NULL), "
    "taken AS (SELECT l.*, lag(l.p + l.n) OVER o AS prev_end, lag(kind) OVER o AS prev_kind FROM walk JOIN longest l USING (doc_id, p) "
    "WINDOW o AS (PARTITION BY doc_id ORDER BY l.p)), "
    "marks AS (SELECT doc_id, unnest(range(p, p + n)) AS at, p, kind, coalesce(prev_end = p AND prev_kind = kind, false) AS follows FROM taken) "
    "SELECT t.doc_id, t.pos, t.tok, CASE WHEN m.kind IS NULL THEN 'O' WHEN m.at = m.p AND NOT m.follows THEN 'B-' || m.kind ELSE 'I-' || m.kind END AS tag "
    "FROM tagged_docs t LEFT JOIN marks m ON m.doc_id = t.doc_id AND m.at = t.pos + 1"
)


@register("e09_tag_phrases", _PHRASES_SQL)
def e09_tag_phrases(spark, sf_dir):
    """E9 with whole names: every entity of the tagged corpus is a phrase of one word or many."""
    t = fx.tagged(spark, sf_dir)
    spans = t.select(F.explode(E.extract_entities("tokens", "ner_tags")).alias("e")).select("e.entity", "e.tag")
    return normalise(MD.tag_tokens(t.select("doc_id", "tokens"), MD.phrases_from_spans(spans)))


_NAMES = q.sql_map(E.BIO_LABELS)


def _score(n, of, kinds):
    return f"round({LOG_UNIT} * log10(({n} + 1.0::DOUBLE) / ({of}::DOUBLE + 1.0::DOUBLE * {kinds})))::BIGINT"


# The forward pass folds over a document's tokens; each tag keeps its score and the letters of its path.
_LEARNED_SQL = (
    with_ctes(q.tagged_docs_cte(), q.splits_cte())
    + f", gold AS (SELECT doc_id, pos, tok, coalesce({_NAMES}[tag], 'O') AS name FROM tagged_docs), "
    "train AS (SELECT g.*, coalesce(lag(name) OVER (PARTITION BY doc_id ORDER BY pos), '') AS before FROM gold g JOIN splits USING (doc_id) WHERE split = 'train'), "
    "names AS (SELECT name, count(*) AS total, row_number() OVER (ORDER BY name) AS s FROM train GROUP BY name), "
    "kinds AS (SELECT count(DISTINCT tok) + 1 AS words, (SELECT count(*) FROM names) AS k FROM train), "
    "seen AS MATERIALIZED (SELECT tok, name, count(*) AS n FROM train GROUP BY tok, name), "
    "words AS (SELECT DISTINCT tok FROM seen UNION ALL SELECT NULL), "
    f"emission AS MATERIALIZED (SELECT w.tok, list({_score('coalesce(n, 0)', 'total', 'words')} ORDER BY s) AS e "
    "FROM words w CROSS JOIN names CROSS JOIN kinds LEFT JOIN seen ON seen.tok = w.tok AND seen.name = names.name GROUP BY w.tok), "
    "pairs AS (SELECT before, name, count(*) AS n FROM train GROUP BY before, name), "
    "out_of AS (SELECT before, sum(n) AS total FROM pairs GROUP BY before), "
    f"step AS (SELECT b.name AS before, b.s AS b, a.s, {_score('coalesce(p.n, 0)', 'coalesce(o.total, 0)', 'k')} AS v "
    "FROM (SELECT name, s FROM names UNION ALL SELECT '', 0) b CROSS JOIN names a CROSS JOIN kinds "
    "LEFT JOIN pairs p ON p.before = b.name AND p.name = a.name LEFT JOIN out_of o ON o.before = b.name), "
    "first AS (SELECT list(v ORDER BY s) AS v FROM step WHERE b = 0), "
    "matrix AS (SELECT list(v ORDER BY s) AS m FROM (SELECT s, list(v ORDER BY b) AS v FROM step WHERE b > 0 GROUP BY s)), "
    "rows AS (SELECT doc_id, list({'e': coalesce(e.e, u.e), 'p': NULL::VARCHAR[]} ORDER BY pos) AS es "
    "FROM gold g LEFT JOIN emission e ON e.tok = g.tok CROSS JOIN (SELECT e FROM emission WHERE tok IS NULL) u GROUP BY doc_id), "
    "with_steps AS (SELECT doc_id, es, m, first.v AS f0 FROM rows, matrix, first), "
    "ahead AS (SELECT doc_id, list_reduce(list_prepend({'e': list_transform(es[1].e, lambda x, i: x + f0[i]), "
    "'p': list_transform(es[1].e, lambda x, i: i::VARCHAR)}, es[2:]), lambda a, x: {"
    "'e': list_transform(x.e, lambda y, s: y + list_max(list_transform(a.e, lambda z, b: z + m[s][b]))), "
    "'p': list_transform(x.e, lambda y, s: a.p[list_position(list_transform(a.e, lambda z, b: z + m[s][b]), "
    "list_max(list_transform(a.e, lambda z, b: z + m[s][b])))] || s::VARCHAR)}) AS f FROM with_steps), "
    "best AS (SELECT doc_id, f.p[list_position(f.e, list_max(f.e))] AS path FROM ahead) "
    "SELECT l.doc_id, len(l.toks) AS n, coalesce((SELECT count(*) FROM gold g JOIN names n USING (name) WHERE g.doc_id = l.doc_id "
    "AND substr(b.path, g.pos + 1, 1) = n.s::VARCHAR), 0) AS n_right, sha256(coalesce((SELECT string_agg(n.name, ' ' ORDER BY i) "
    "FROM (SELECT unnest(range(1, length(b.path) + 1)) AS i) JOIN names n ON substr(b.path, i, 1) = n.s::VARCHAR), '')) AS tags_sha256 "
    "FROM tok_lists l LEFT JOIN best b USING (doc_id)"
)


@register("e09_learned_tagger", _LEARNED_SQL)
def e09_learned_tagger(spark, sf_dir):
    """E9 with the learned tagger: fitted on the train split's gold tags, all documents tagged by the best path."""
    t = split_exact(fx.tagged(spark, sf_dir), "doc_id", fx.TRAIN_FRACTION, fx.SPLIT_SEED)
    t = t.withColumn("gold", A.decode_tags("ner_tags", list(E.BIO_LABELS.values())))
    model = Hmm.fit(t.where("split = 'train'"), "tokens", "gold")
    out = model.tag(t.select("doc_id", "tokens", "gold"))
    right = F.size(F.filter(F.zip_with("tags", "gold", lambda a, b: a == b), lambda x: x))
    return normalise(out.select("doc_id", F.size("tokens").alias("n"), right.cast("bigint").alias("n_right"),
                                F.sha2(F.array_join("tags", " ").cast("binary"), 256).alias("tags_sha256")))
