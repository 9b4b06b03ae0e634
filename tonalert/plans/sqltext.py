"""DuckDB text for the oracle: the fixtures as CTEs and SQL forms of the row rules.

These are written independently of the Spark expressions (different engine, different regex
dialect, and where possible a different formulation), so that agreement means something.
"""

from __future__ import annotations

from tonalert.constants import (
    BIO_LABELS,
    CONTRACTIONS,
    DEFAULT_EMOTION,
    EMOTION_CATEGORIES,
    ENTITY_STOPWORDS,
    LOC_PHRASES,
    MISC_PHRASES,
    NO_ENTITIES,
    ORG_PHRASES,
    PERSON_PHRASES,
    WORD,
)
from tonalert.plans.fixtures import LONG_SPAN_AT, LONG_SPAN_EVERY, MISSING_CAPTIONS, SPLIT_SEED, TAG_PATTERN, TRAIN_FRACTION, TWEET_SUFFIXES

WS = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
NOT_WS = "[^" + WS[1:]


def s(v: str) -> str:
    """SQL string literal."""
    return "'" + v.replace("'", "''") + "'"


def sql_map(d: dict) -> str:
    items = ", ".join(f"{s(k) if isinstance(k, str) else k}: {s(v)}" for k, v in d.items())
    return "MAP {" + items + "}"


def sql_list(xs) -> str:
    return "[" + ", ".join(s(x) if isinstance(x, str) else str(x) for x in xs) + "]"


# ------------------------------------------------------------------ text rules (T1-T16) --------

def lower_text(x):
    return f"lower({x})"


def mask_mentions(x):
    return f"regexp_replace({x}, {s('@' + WORD + '+')}, 'user', 'g')"


def mask_urls(x):
    return f"regexp_replace({x}, {s('(http|www)' + NOT_WS + '+')}, 'url', 'g')"


def mask_hashtags(x):
    return f"regexp_replace({x}, {s('#' + WORD + '+')}, 'hashtag', 'g')"


def words(x):
    return f"list_filter(regexp_split_to_array({x}, {s(WS + '+')}), lambda w: w <> '')"


def split_possessive(w):
    return f"regexp_replace({w}, {s('^(' + WORD + "+)'s$")}, '\\1 is')"


def expand_words(x):
    return (f"array_to_string(list_transform({words(x)}, lambda w: "
            f"coalesce({sql_map(CONTRACTIONS)}[w], {split_possessive('w')})), ' ')")


def tag_emotions(x):
    line = (f"array_to_string(list_transform(string_split(line, '**'), lambda p, i: CASE "
            f"WHEN i % 2 = 0 AND i < len(string_split(line, '**')) THEN "
            f"'<' || coalesce({sql_map(EMOTION_CATEGORIES)}[lower(p)], {s(DEFAULT_EMOTION)}) || '>' "
            f"WHEN i % 2 = 0 THEN '**' || p ELSE p END), '')")
    return f"array_to_string(list_transform(string_split({x}, chr(10)), lambda line: {line}), chr(10))"


def strip_marks(x):
    return f"regexp_replace({x}, '[,.\"…]', '', 'g')"


def space_marks(x):
    return f"regexp_replace({x}, '([!?])', ' \\1 ', 'g')"


def mask_emoji(x):
    return f"regexp_replace({x}, '[\\x{{10000}}-\\x{{10ffff}}]', 'emoji', 'g')"


def collapse_space(x):
    return f"regexp_replace(regexp_replace({x}, {s(WS + '+')}, ' ', 'g'), '^ | $', '', 'g')"


def clean_text(x):
    return collapse_space(mask_emoji(space_marks(strip_marks(x))))


def squeeze_chars(chars):
    """T13 over a character list (no back-references in RE2): drop a character that equals its
    left neighbour when it lies in a run of 3 or more. ``chars`` must be a column."""
    return (f"array_to_string(list_transform({chars}, lambda c, i: CASE WHEN i >= 2 AND c = {chars}[i - 1] "
            f"AND ((i >= 3 AND {chars}[i - 2] = c) OR (i < len({chars}) AND {chars}[i + 1] = c)) "
            f"THEN '' ELSE c END), '')")


def pre_squeeze(x):
    """T1-T11 of the normalisation chain (T13 comes after, over characters)."""
    t = mask_hashtags(mask_urls(mask_mentions(lower_text(x))))
    return clean_text(tag_emotions(expand_words(t)))


# ------------------------------------------------------------------ fixtures -------------------

CAPTION_KEY = f"d.doc_id % (SELECT count(*) + {MISSING_CAPTIONS} FROM benchmark)"


def tweets_cte():
    sfx = sql_list(TWEET_SUFFIXES)
    return f"tweets AS (SELECT doc_id, coalesce(text, '') || {sfx}[doc_id % 8 + 1] AS raw FROM documents)"


def tagged_docs_cte():
    pat = sql_list(TAG_PATTERN)
    return (
        f"tok_lists AS (SELECT doc_id, {words('coalesce(text, ' + chr(39) * 2 + ')')} AS toks FROM documents), "
        f"tagged_docs AS (SELECT doc_id, CAST(p - 1 AS BIGINT) AS pos, toks[p] AS tok, "
        f"CAST(CASE WHEN doc_id % {LONG_SPAN_EVERY} = {LONG_SPAN_AT} THEN (CASE WHEN p = 1 THEN 1 ELSE 2 END) "
        f"ELSE {pat}[((doc_id * 5 + p - 1) % {len(TAG_PATTERN)}) + 1] END AS BIGINT) AS tag "
        f"FROM (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS p FROM tok_lists))"
    )


def doc_sentiment_cte():
    return (
        "doc_sentiment AS (SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'negative' WHEN l.quality = 1 "
        "THEN 'positive' ELSE 'neutral' END AS sentiment, "
        "CAST(((d.doc_id * 37) % 101) / 100.0 AS DOUBLE) AS sentiment_score "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
    )


def logits_cte():
    return (
        "logits AS (SELECT doc_id, CAST(((doc_id * 13) % 21 - 10) / 5.0 AS DOUBLE) AS x, "
        "CAST(CASE WHEN quality = 1 THEN 2 ELSE 0 END AS BIGINT) AS y FROM labels)"
    )


def splits_cte():
    return (
        "splits AS (SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || "
        f"':{SPLIT_SEED}'), doc_id) <= CAST(round({TRAIN_FRACTION} * (SELECT count(*) FROM documents)) AS BIGINT) "
        "THEN 'train' ELSE 'test' END AS split FROM documents)"
    )


def entity_spans_cte(named: str | None = None, sfx: str = ""):
    """E1 by windows over ``tagged_docs`` (or the rows of ``named``: doc_id, pos, tok, name): group = running count of non-I tags, head = first tag
    of the group, broken = an I- of another kind seen so far. Empty-text spans are dropped."""
    labels = sql_map(BIO_LABELS)
    named = named or f"SELECT doc_id, pos, tok, coalesce({labels}[tag], 'O') AS name FROM tagged_docs"
    return (
        f"named{sfx} AS ({named}), "
        f"grouped{sfx} AS (SELECT *, sum(CASE WHEN name LIKE 'I-%' THEN 0 ELSE 1 END) OVER "
        f"(PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS grp FROM named{sfx}), "
        f"headed{sfx} AS (SELECT *, first_value(name) OVER (PARTITION BY doc_id, grp ORDER BY pos "
        f"ROWS UNBOUNDED PRECEDING) AS head FROM grouped{sfx}), "
        f"marked{sfx} AS (SELECT *, max(CASE WHEN name LIKE 'I-%' AND substr(name, 3) <> substr(head, 3) THEN 1 ELSE 0 END) "
        f"OVER (PARTITION BY doc_id, grp ORDER BY pos ROWS UNBOUNDED PRECEDING) AS bad FROM headed{sfx}), "
        f"spans_raw{sfx} AS (SELECT doc_id, grp, string_agg(tok, ' ' ORDER BY pos) AS raw, substr(max(head), 3) AS tag "
        f"FROM marked{sfx} WHERE head LIKE 'B-%' AND bad = 0 GROUP BY doc_id, grp), "
        f"spans{sfx} AS (SELECT doc_id, grp, {strip_ws('raw')} AS entity, tag FROM spans_raw{sfx} WHERE length(raw) > 0)"
    )


def strip_ws(x):
    return f"regexp_replace({x}, {s('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def clean_spans_cte(sfx: str = ""):
    stop = sql_list(ENTITY_STOPWORDS)
    return (
        f"clean_spans AS (SELECT doc_id, grp, {strip_ws('entity')} AS entity, tag FROM spans{sfx} "
        f"WHERE length({strip_ws('entity')}) >= 2 AND NOT regexp_matches({strip_ws('entity')}, '^[^\\p{{L}}\\p{{N}}]+$') "
        f"AND NOT list_contains({stop}, lower({strip_ws('entity')})))"
    )


def confidence_word(x):
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN 'slightly' WHEN {x} >= 0.95 THEN 'clearly' "
            f"WHEN {x} >= 0.7 THEN 'moderately' ELSE 'slightly' END")


def phrase_pick(key, kind, phrases, salt):
    """E5: the phrase that the md5 of key, salt and kind points at."""
    number = f"('0x' || substr(md5(coalesce({key}::VARCHAR, '') || ':{salt}:{kind}'), 1, 8))::BIGINT"
    return f"{sql_list(phrases)}[({number} % {len(phrases)}) + 1]"


def alerts_cte(salts=(0,)):
    """E6 per document for each salt: needs ``clean_spans`` and ``doc_sentiment``."""
    phrases = {"PER": PERSON_PHRASES, "ORG": ORG_PHRASES, "LOC": LOC_PHRASES, "MISC": MISC_PHRASES}
    per_kind = ", ".join(
        f"string_agg(entity, ', ' ORDER BY grp) FILTER (WHERE tag = '{k}') AS {k.lower()}_names"
        for k in phrases
    )
    cols = []
    for salt in salts:
        parts = []
        for k, ph in phrases.items():
            names = f"g.{k.lower()}_names"
            if k in ("PER", "MISC"):
                names = f"lower({names})"
            pick = phrase_pick("d.doc_id", k, ph, salt)
            parts.append(f"CASE WHEN g.{k.lower()}_names IS NOT NULL THEN {pick} || ' ' || {names} || '.' ELSE '' END")
        head = f"'Alert with a ' || {confidence_word('d.sentiment_score')} || ' ' || d.sentiment || ' tone.'"
        body = f"CASE WHEN coalesce(g.n, 0) = 0 THEN {s(NO_ENTITIES)} ELSE " + " || ".join(parts) + " END"
        cols.append(f"{head} || {body} AS alert_{salt}")
    return (
        f"kind_names AS (SELECT doc_id, count(*) AS n, {per_kind} FROM clean_spans GROUP BY doc_id), "
        f"alerts AS (SELECT d.doc_id, d.sentiment, d.sentiment_score, {', '.join(cols)} "
        f"FROM doc_sentiment d LEFT JOIN kind_names g ON d.doc_id = g.doc_id)"
    )


def alert_predictions_cte():
    return (
        ", ".join([tagged_docs_cte(), doc_sentiment_cte(), entity_spans_cte(), clean_spans_cte(), alerts_cte((0, 1))])
        + ", alert_predictions AS (SELECT doc_id, alert_1 AS prediction, alert_0 AS reference FROM alerts)"
    )


def rouge_tokens(x):
    """Published ROUGE tokeniser: lower-case, anything outside a-z0-9 separates tokens."""
    return f"list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: w <> '')"


__all__ = [n for n in dir() if not n.startswith("_")] + ["MISSING_CAPTIONS", "LONG_SPAN_AT", "LONG_SPAN_EVERY"]
