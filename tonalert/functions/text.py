"""Text normalisation as Column -> Column functions.

Every function is a native Spark expression: no Python runs per row, so the whole chain stays in
the JVM and fuses into the surrounding projection. Character classes are spelled out (see
``constants.WORD`` / ``constants.WS``) so that the Java engine gives Python's Unicode results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonalert.functions.core import bind
from tonalert.constants import (
    CONTRACTIONS,
    DEFAULT_EMOTION,
    EMOTION_CATEGORIES,
    NOT_WS,
    WORD,
    WS,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def _when_has(c: Column, needles: list[str], fn) -> Column:
    """``fn(c)`` only for rows that contain one of the literal ``needles`` (a plain substring
    test), else the input unchanged: the pattern cannot match without them. The input is bound
    once, since it is read three times (and is itself a nested expression in the chain)."""

    def guarded(v):
        test = None
        for n in needles:
            t = v.contains(n)
            test = t if test is None else (test | t)
        return F.when(test, fn(v)).otherwise(v)

    return bind(c, guarded)


def lower_text(c) -> Column:
    """Lower-case."""
    return F.lower(_col(c))


def mask_mentions(c) -> Column:
    """``@word`` -> ``user``."""
    c = _col(c)
    return _when_has(c, ["@"], lambda v: F.regexp_replace(v, "@" + WORD + "+", "user"))


def mask_urls(c) -> Column:
    """``http...`` or ``www...`` up to the next white space -> ``url`` (anywhere in a word)."""
    c = _col(c)
    return _when_has(c, ["http", "www"], lambda v: F.regexp_replace(v, "(?:http|www)" + NOT_WS + "+", "url"))


def mask_hashtags(c) -> Column:
    """T4: ``#word`` -> ``hashtag``."""
    c = _col(c)
    return _when_has(c, ["#"], lambda v: F.regexp_replace(v, "#" + WORD + "+", "hashtag"))


def words(c) -> Column:
    """Split on runs of white space, dropping empty pieces (Python's ``str.split()``)."""
    # array_remove is a native array function (no lambda call per word).
    return F.array_remove(F.split(_col(c), WS + "+", -1), "")


def split_possessive(w) -> Column:
    """A whole word ``x's`` (x made of word characters) -> ``x is``."""
    w = _col(w)
    return F.when(w.endswith("'s"), F.regexp_replace(w, "^(" + WORD + "+)'s$", "$1 is")).otherwise(w)


def expand_words(c) -> Column:
    """T5: contraction / slang expansion per word, then T6; rejoined with single spaces.

    A map literal is searched key by key, so the lookup is guarded by ``isin`` over the same
    keys, which Catalyst turns into a hash-set test (``InSet``): most words skip the map."""
    table = _map_literal(CONTRACTIONS)
    keys = list(CONTRACTIONS)
    return F.array_join(
        F.transform(words(c), lambda w: F.when(w.isin(keys), F.element_at(table, w)).otherwise(split_possessive(w))),
        " ",
    )


def _tag_emotions_line(line: Column) -> Column:
    # Pieces between '**' alternate outside / inside; an inside piece is closed when a piece
    # follows it. Closed pieces become tags, the unclosed last piece keeps its leading '**'.
    tags = _map_literal(EMOTION_CATEGORIES)

    def rebuild(pieces):
        n = F.size(pieces)

        def piece(p, i):
            inside = (i % 2) == 1
            closed = inside & (i < n - 1)
            tag = F.concat(F.lit("<"), F.coalesce(F.element_at(tags, F.lower(p)), F.lit(DEFAULT_EMOTION)), F.lit(">"))
            return F.when(closed, tag).when(inside, F.concat(F.lit("**"), p)).otherwise(p)

        return F.array_join(F.transform(pieces, piece), "")

    # Bind the split once (a one-element array passed through a lambda) instead of re-splitting
    # the line for every piece.
    return F.element_at(F.transform(F.array(F.split(line, r"\*\*", -1)), rebuild), 1)


def tag_emotions(c) -> Column:
    """``**word**`` -> ``<good emotion>`` / ``<bad emotion>`` / ``<emotion>``.

    Pairs are taken leftmost-first within a line (a pair never spans a newline, as with a
    regex whose ``.`` stops at ``\\n``).
    """
    c = _col(c)
    return _when_has(c, ["**"], lambda v: F.array_join(F.transform(F.split(v, "\n", -1), _tag_emotions_line), "\n"))


def strip_marks(c) -> Column:
    """Delete ``, . " …``."""
    return F.regexp_replace(_col(c), '[,."…]', "")


def space_marks(c) -> Column:
    """Put a space on both sides of ``!`` and ``?``."""
    return _when_has(_col(c), ["!", "?"], lambda v: F.regexp_replace(v, "([!?])", " $1 "))


def mask_emoji(c) -> Column:
    """Every code point above U+FFFF -> ``emoji`` (no spacing added)."""
    return F.regexp_replace(_col(c), r"[\x{10000}-\x{10ffff}]", "emoji")


def collapse_space(c) -> Column:
    """Collapse runs of white space to one space and trim."""
    return F.regexp_replace(F.regexp_replace(_col(c), WS + "+", " "), "^ | $", "")


def tokens(c) -> Column:
    """Tokens separated by white space, no empty tokens."""
    return words(c)


def squeeze_runs(c) -> Column:
    """Any run of 3 or more equal characters -> one (``soooo`` -> ``so``, ``1000`` -> ``10``)."""
    return F.regexp_replace(_col(c), r"(?d)(.)\1{2,}", "$1")


def join_tokens(a) -> Column:
    """Join tokens with one space."""
    return F.array_join(_col(a), " ")


def clean_text(c) -> Column:
    """T8, T9, T10, T11 in that order."""
    return collapse_space(mask_emoji(space_marks(strip_marks(c))))


def _masked_text(c) -> Column:
    """Words apart by single spaces, no other white space."""
    return tag_emotions(expand_words(mask_hashtags(mask_urls(mask_mentions(lower_text(c))))))


def normalize_text(c) -> Column:
    """T1-T11 and T13 as one string with single spaces (the joined form of T16)."""
    # T11 leaves single spaces between tokens, so squeezing the whole string equals squeezing
    # each token.
    return squeeze_runs(clean_text(_masked_text(c)))


def normalize_tweet(c) -> Column:
    """The whole chain, returning the token array. T5 has left no white space but spaces and no later step adds
    any, so the tokens are split at these and runs of them need not be collapsed (T11) before."""
    t = squeeze_runs(mask_emoji(space_marks(strip_marks(_masked_text(c)))))
    return F.array_remove(F.split(t, " ", -1), "")
