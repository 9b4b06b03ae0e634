"""Entity spans, prompts and alerts as Column functions.

All of them are row-wise: no shuffle, safe in Structured Streaming. Spans are decoded (E1) and cleaned (E2) in Arrow
batches, the rest are native expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.functions.core import bind
from tonalert.constants import (
    BIO_LABELS,
    CLEARLY_AT,
    ENTITY_STOPWORDS,
    LOC_PHRASES,
    MISC_PHRASES,
    MODERATELY_AT,
    NO_ENTITIES,
    ORG_PHRASES,
    PERSON_PHRASES,
)

ENTITY_TYPE = T.ArrayType(
    T.StructType([T.StructField("entity", T.StringType()), T.StructField("tag", T.StringType())])
)
ENTITY_KINDS = ["PER", "ORG", "LOC", "MISC"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_literal(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def bio_label(code) -> Column:
    """Tag code -> name; an unknown code reads as ``O``."""
    return F.coalesce(F.element_at(_map_literal(BIO_LABELS), _col(code)), F.lit("O"))


def strip_ws(c) -> Column:
    """Python's ``str.strip()``: trim every Unicode white-space character at both ends."""
    return F.btrim(_col(c), F.lit(_WS_ENDS))


# Every white-space character of ``WS``, to trim both ends without a pattern.
_WS_ENDS = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Each tag name as (number of its kind, 1 where it opens a span); any other tag is (0, 0).
_PART_OF_NAME = {f"{mark}-{kind}": (i + 1, int(mark == "B")) for i, kind in enumerate(ENTITY_KINDS) for mark in "BI"}
_PART_OF_CODE = [_PART_OF_NAME.get(BIO_LABELS.get(i, "O"), (0, 0)) for i in range(max(BIO_LABELS) + 1)]


def _tag_parts(tags, coded: bool):
    """Kind numbers and opening marks of a batch of tags; an out-of-range, unknown or NULL one reads as O."""
    import numpy as np

    if coded:
        codes = tags.fill_null(0).to_numpy(zero_copy_only=False)
        known = (codes >= 0) & (codes < len(_PART_OF_CODE))
        parts, at = np.array(_PART_OF_CODE), np.where(known, codes, 0).astype(np.int64)
    else:
        names = tags.dictionary_encode()
        words = names.dictionary.to_pylist()
        parts = np.array([_PART_OF_NAME.get(w, (0, 0)) for w in words] + [(0, 0)])
        at = names.indices.fill_null(len(words)).to_numpy(zero_copy_only=False)
    return parts[at, 0], parts[at, 1]


def _ranges(starts, sizes):
    """The numbers from each start on, ``sizes`` of them, one range after another."""
    import numpy as np

    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _lists_of_spans(toks, tags, coded: bool):
    """E1 over a batch of rows: all their tokens are decoded together."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    toks = toks.cast(pa.list_(pa.string()))
    sizes = [x.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (toks, tags)]
    n = np.minimum(*sizes)
    at_tok, at_tag = (_ranges(x.offsets.to_numpy()[:-1].astype(np.int64), n) for x in (toks, tags))
    kind, opens = _tag_parts(tags.values.take(pa.array(at_tag)), coded)
    # A run begins with a row, with a B- tag and where the kind changes; it is a span if it begins with a B- tag.
    begins = opens.astype(bool)
    begins[1:] |= kind[1:] != kind[:-1]
    rows_at = (np.cumsum(n) - n)[n > 0]
    begins[rows_at] = True
    runs = np.flatnonzero(begins)
    lengths = np.diff(np.append(runs, len(kind)))
    is_span = opens[runs] == 1
    first, lengths = runs[is_span], lengths[is_span]
    words = toks.values.take(pa.array(_ranges(at_tok[first], lengths)))
    if words.null_count:  # a NULL token leaves no trace in the joined text
        there = words.is_valid().to_numpy(zero_copy_only=False)
        lengths = np.diff(np.append(0, np.cumsum(there))[np.append(0, np.cumsum(lengths))])
        words = words.drop_null()
    text = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), words), " ")
    # A span whose joined text is empty is never emitted; the rest are stripped of white space.
    some = pc.greater(pc.binary_length(text), 0)
    row = np.repeat(np.arange(len(n)), n)[first][some.to_numpy(zero_copy_only=False)]
    kinds = pa.array([None, *ENTITY_KINDS]).take(pa.array(kind[first])).filter(some)
    spans = pa.StructArray.from_arrays([pc.utf8_trim(text.filter(some), characters=_WS_ENDS), kinds], names=["entity", "tag"])
    offsets = np.append(0, np.cumsum(np.bincount(row, minlength=len(n))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans, mask=tags.is_null() if tags.null_count else None)


def extract_entities(toks, tags, coded: bool = True) -> Column:
    """Decode B-/I- tags into ``array<struct<entity, tag>>`` in token order.

    B-X opens a span (closing any open one); I-X extends only an open span of the same X;
    anything else closes; an I- with no open span is dropped; the end closes. Tokens and tags are
    zipped to the shorter length. ``coded`` tags are codes 0-8, otherwise names like ``B-PER``. NULL tags have NULL
    entities, NULL tokens none.

    Runs in Arrow batches: the tokens of all rows of a batch are compared with their neighbours at once, so the time is
    linear in the number of tokens and no expression is evaluated token by token.
    """
    return F.arrow_udf(lambda toks, tags: _lists_of_spans(toks, tags, coded), ENTITY_TYPE)(_col(toks), _col(tags))


def _clean_lists(lists):
    """E2 over a batch of entity lists."""
    import unicodedata

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ents = lists.flatten()
    text, tag = (pc.struct_field(ents, i).cast(pa.string()) for i in (0, 1))
    text = pc.utf8_trim(text, characters=_WS_ENDS)
    signs = pc.invert(pc.match_substring_regex(text, "[A-Za-z0-9]")).fill_null(False)
    if pc.any(signs).as_py():  # others may have letters or digits of any script
        none = [not any(unicodedata.category(c)[0] in "LN" for c in t) for t in text.filter(signs).to_pylist()]
        signs = pc.replace_with_mask(signs, signs, pa.array(none, pa.bool_()))
    stop = pc.is_in(pc.utf8_lower(text), value_set=pa.array(ENTITY_STOPWORDS))
    keep = pc.and_(pc.greater_equal(pc.utf8_length(text), 2).fill_null(False), pc.invert(pc.or_(signs, stop)))
    before = np.append(0, np.cumsum(keep.to_numpy(zero_copy_only=False)))
    offsets = before[np.append(0, np.cumsum(sizes))]
    kept = pa.StructArray.from_arrays([text.filter(keep), tag.filter(keep)], names=["entity", "tag"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept, mask=lists.is_null() if lists.null_count else None)


def clean_entities(ents) -> Column:
    """Trim; drop empty, shorter than 2 characters, no letter or digit, or a stop word. Runs in Arrow batches, as E1."""
    return F.arrow_udf(_clean_lists, ENTITY_TYPE)(_col(ents))


def group_entities(ents, kind: str) -> Column:
    """The entities of one tag, in source order, duplicates kept."""
    return F.transform(F.filter(_col(ents), lambda e: e["tag"] == kind), lambda e: e["entity"])


def sentiment_label(c) -> Column:
    """Coded sentiment -> text: 1 is ``positive``, everything else (NULL too) ``negative``."""
    return F.when(_col(c) == 1, F.lit("positive")).otherwise(F.lit("negative"))


def confidence_word(score) -> Column:
    """>= 0.95 clearly, >= 0.7 moderately, else slightly (NaN and NULL are slightly)."""
    s = _col(score)
    return (
        F.when(s.isNull() | F.isnan(s), F.lit("slightly"))
        .when(s >= CLEARLY_AT, F.lit("clearly"))
        .when(s >= MODERATELY_AT, F.lit("moderately"))
        .otherwise(F.lit("slightly"))
    )


def build_prompt(ents, label, sentence) -> Column:
    """``Entidades: a (PER); b (LOC). Sentimiento: s. Texto: t`` from uncleaned entities."""
    listed = F.array_join(
        F.transform(_col(ents), lambda e: F.concat(e["entity"], F.lit(" ("), e["tag"], F.lit(")"))), "; "
    )
    return F.concat(
        F.lit("Entidades: "), listed, F.lit(". Sentimiento: "), _col(label), F.lit(". Texto: "), _col(sentence)
    )


PHRASES = {"PER": PERSON_PHRASES, "ORG": ORG_PHRASES, "LOC": LOC_PHRASES, "MISC": MISC_PHRASES}


def alert_phrase(kind: str, key, salt: int = 0) -> Column:
    """E5: one phrase of the kind's list, chosen by a hash of the row key (of any type; reproducible)
    and the kind, so the kinds do not move in step. A NULL key counts as the empty text."""
    options = PHRASES[kind]
    text = F.concat(F.coalesce(_col(key).cast("string"), F.lit("")), F.lit(f":{salt}:{kind}"))
    pick = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % len(options)
    return F.element_at(F.array(*[F.lit(p) for p in options]), (pick + 1).cast("int"))


def build_alert(ents, label, score, key, salt: int = 0, sep: str = "", cleaned: bool = False) -> Column:
    """``Alert with a {word} {label} tone.`` then PER, ORG, LOC, MISC parts.

    ``ents`` are the raw spans; they are cleaned here (E2) unless ``cleaned`` says they already are. PER and MISC names are lower-cased,
    ORG and LOC are not. No entity at all gives ``No specific entities mentioned.``. Parts are
    glued with ``sep`` (empty in the original).
    """
    head = F.concat(F.lit("Alert with a "), confidence_word(score), F.lit(" "), _col(label), F.lit(" tone."))

    def part_of(kind):
        def from_group(group):
            names = F.array_join(group, ", ")
            if kind in ("PER", "MISC"):
                names = F.lower(names)
            part = F.concat(alert_phrase(kind, key, salt), F.lit(" "), names, F.lit("."))
            return F.when(F.size(group) > 0, part)

        return from_group

    def body_of(cleaned):
        # Each kind's group is built once and tested by its size (no separate scan for presence).
        parts = [bind(group_entities(cleaned, kind), part_of(kind)) for kind in ENTITY_KINDS]
        return F.when(F.size(cleaned) == 0, F.lit(NO_ENTITIES)).otherwise(F.concat_ws(sep, *parts))

    # The cleaned list is bound once (a lambda over a one-element array) rather than rebuilt by
    # each of the parts that read it.
    return F.concat_ws(sep, head, bind(_col(ents) if cleaned else clean_entities(ents), body_of))

