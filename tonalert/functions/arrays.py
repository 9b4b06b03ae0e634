"""Array parsing and shaping as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonalert.constants import IGNORE_INDEX, MAX_INPUT_LEN, WS
from tonalert.functions.core import bind
from tonalert.functions.core import col as _col


def parse_quoted_tokens(c, is_array: bool = False) -> Column:
    """A1: every ``'...'`` piece of a text list (shortest match, not across a newline); NULL gives an
    empty list. ``is_array``: the column already holds lists, which pass through."""
    none = F.array().cast("array<string>")
    return F.coalesce(_col(c) if is_array else F.regexp_extract_all(_col(c), F.lit(r"(?d)'(.*?)'"), 1), none)


def parse_int_list(c, is_array: bool = False) -> Column:
    """A2: ``[1 2 3]`` -> ``[1, 2, 3]``; all-or-nothing: one bad item gives an empty list, and so does
    NULL. ``is_array``: the column already holds lists, which pass through."""
    none = F.array().cast("array<int>")
    if is_array:
        return F.coalesce(_col(c).cast("array<int>"), none)
    body = F.regexp_replace(_col(c), r"^[\[\]]+|[\[\]]+$", "")
    items = F.array_remove(F.split(body, WS + "+", -1), "")
    ints = F.transform(items, lambda x: x.try_cast("int"))
    return F.coalesce(bind(ints, lambda v: F.when(F.exists(v, lambda x: x.isNull()), none).otherwise(v)), none)


def build_sentence(c, is_array: bool = False) -> Column:
    """A3: A1 then joined with one space."""
    return F.array_join(parse_quoted_tokens(c, is_array), " ")


def zip_shortest(a, b) -> Column:
    """A4: ``array<struct<a, b>>`` of pairs, cut to the shorter array."""
    def zipped(a, b):
        n = F.coalesce(F.least(F.size(a), F.size(b)), F.lit(0))
        return F.transform(F.slice(a, 1, F.greatest(n, F.lit(0))), lambda x, i: F.struct(x.alias("a"), F.get(b, i).alias("b")))

    return bind(a, lambda av: bind(b, lambda bv: zipped(av, bv)))


def pad_to(ids, length, pad: int = 0) -> Column:
    """Right-pad an id array with ``pad`` up to ``length`` (never truncates)."""
    ids = _col(ids)
    missing = F.greatest(_col(length) - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(pad), missing))


def fix_length(ids, length: int = MAX_INPUT_LEN, pad: int = 0) -> Column:
    """Truncate and pad to exactly ``length``."""
    return pad_to(F.slice(_col(ids), 1, length), F.lit(length), pad)


def attention_mask(ids, length: int = MAX_INPUT_LEN) -> Column:
    """1 for a real position, 0 for padding, ``length`` long."""
    n = F.least(F.size(_col(ids)), F.lit(length))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(length) - n))


def unmask_labels(c, pad: int = 0) -> Column:
    """Replace the ignore marker (-100) by the padding id."""
    return F.transform(_col(c), lambda x: F.when(x == IGNORE_INDEX, F.lit(pad)).otherwise(x))


def mask_padding(c, pad: int = 0) -> Column:
    """The inverse of P18: padding ids in a label array become the ignore marker."""
    return F.transform(_col(c), lambda x: F.when(x == pad, F.lit(IGNORE_INDEX)).otherwise(x))


def decode_tags(codes, names) -> Column:
    """P10: integer codes -> names. ``names`` is a Python list or an array column of names by code;
    a code without a name raises, as the original's list access does; NULL codes stay NULL."""
    table = F.array(*[F.lit(n) for n in names]) if isinstance(names, list) else _col(names)
    no_name = F.raise_error(F.lit("tag code without a name"))
    return F.transform(_col(codes), lambda i: F.when(i.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.get(table, i.cast("int")), no_name.cast("string"))))


def n_chars(c) -> Column:
    """String length in characters."""
    return F.char_length(_col(c))


def array_text(c) -> Column:
    """K6: an array as JSON text (lossless, for CSV targets)."""
    return F.to_json(_col(c))
