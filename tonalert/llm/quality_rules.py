"""Operator 4, quality rules with risk-controlled thresholds (DataFrame functions only).

Every text is measured by a few countable features. A rule rejects a text whose feature exceeds a
cutoff. Cutoffs are chosen from a fixed grid on one part of the labelled rows (the selection fold)
as those that separate bad from good rows best; ties go to the larger cutoff. Rules are then
ordered by that separation and the prefixes "first rule", "first two rules", ... are certified on
the remaining labelled rows (the holdout): a prefix may be used in a stratum only if the exact
binomial test shows its false-rejection rate to be at most ``ALPHA``, at level ``DELTA`` divided
by the number of tests (strata times prefixes, Bonferroni). The longest certified prefix is used.
A stratum without enough labelled rows certifies nothing and keeps what the base rule keeps.

Edge cases: a NULL or wordless text has all counts 0 and fails the base rule (fewer than 50 words).
A NULL or unseen stratum value is a stratum of its own ('') or without certified rules. Label rows
that are NULL or without a document are ignored, repeated ones count once by their smallest label.
Rows repeated in the input are judged each. Extra columns of any name pass through, but those named
like a result (a count, ``f_<rule>``, ``base_failed``, ``kept``) are replaced by it. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalert.llm.common import WORD, doc_fold, stored, text_or_empty
from tonalert.operators.joins import checked_broadcast

ALPHA = 0.05  # largest tolerated rate of rejected good documents, per stratum
DELTA = 0.05  # chance that any certified set of rules breaks that limit
SELECT_FOLDS = 3  # one fold in three selects cutoffs, the others certify
MIN_WORDS = 50

# Per rule the grid of cutoffs (a text is rejected above the cutoff).
GRID = {
    "symbols": [0.02, 0.05, 0.1, 0.2, 0.5, 1.0],
    "dup_lines": [0.05, 0.1, 0.2, 0.3, 0.5, 0.7],
    "repeats": [0.05, 0.1, 0.2, 0.3, 0.4, 0.45],
    "shouts": [0.02, 0.05, 0.1, 0.2, 0.5, 1.0],
    "capitals": [0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
}
RULES = list(GRID)
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("bigint")


def _fixed(df: DataFrame, keep: list, **cols: Column) -> DataFrame:
    """``keep`` and new columns that are computed here, once per row: an explode of one element. A
    filter above a plain projection would be pushed below it with the expressions written out again,
    here inside lambdas, where an array would be sorted once per element."""
    one = F.explode(F.array(F.struct(*[c.alias(name) for name, c in cols.items()]))).alias("_row")
    return df.select(*keep, one).select(*keep, *[F.col(f"_row.{name}").alias(name) for name in cols])


def _packed(df: DataFrame, results: list):
    """``df``'s columns as one struct, less those that a result replaces: no name can clash there."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in results]).alias("_all")


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of COUNTS and one real column ``f_<rule>`` per rule."""
    keep, t = [F.col("_all")], F.col("_t")
    df = docs.select(_packed(docs, [*COUNTS, *[f"f_{r}" for r in RULES]]), text_or_empty(f"`{text}`").alias("_t"))
    df = _fixed(df, [*keep, t], _w=F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), _lines=F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)))
    n = F.size("_w")
    tri = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("p")))
    df = _fixed(df, [*keep, t, F.col("_lines")], _n=n, _tri=F.when(n >= 3, F.sort_array(tri)))
    # A window found twice has an equal neighbour once the windows are sorted by hash.
    s = F.col("_tri")
    twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | (x["h"] == F.get(s, i - 1)["h"]))
    df = _fixed(df, [*keep, t, F.col("_lines"), F.col("_n")], _at=F.sort_array(F.transform(twice, lambda x: x["p"])))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    covered = F.aggregate("_at", start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
                          lambda a: a["n"])
    df = _fixed(
        df, keep, n_words=F.col("_n").cast("bigint"), word_chars=F.char_length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("bigint"),
        n_symbols=_chars(t, "#*$%&|<>"), n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        n_repeat_words=F.coalesce(covered, F.lit(0)).cast("bigint"), _n_lines=F.size("_lines").cast("bigint"),
        _shouts=_chars(t, "!"), _capitals=_chars(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))

    def ratio(top, below):
        return F.col(top) / F.greatest(F.col(below), F.lit(1))

    return df.select(
        "_all.*", *COUNTS, ratio("n_symbols", "n_words").alias("f_symbols"), ratio("n_dup_lines", "_n_lines").alias("f_dup_lines"),
        ratio("n_repeat_words", "n_words").alias("f_repeats"), ratio("_shouts", "n_words").alias("f_shouts"),
        ratio("_capitals", "word_chars").alias("f_capitals"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _log_factorial(n: Column) -> Column:
    """ln(n!) by Stirling's series, shifted by 9 so that small n are exact to double precision."""
    x = n.cast("double") + 9
    low = F.lit(1.0)
    for k in range(1, 9):
        low = low * (n + k)
    series = 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0))) - 1 / (1680 * F.pow(x, F.lit(7.0)))
    return (x - 0.5) * F.log(x) - x + 0.5 * F.log(F.lit(2.0) * F.pi()) + series - F.log(low)


def binomial_cdf(x: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= x) for x below the mean, else 1. Terms are added from x downwards; they fall
    geometrically, and those more than 40 standard deviations away are below double precision."""
    log_top = _log_factorial(n) - _log_factorial(x) - _log_factorial(n - x) + x * F.log(F.lit(p)) + (n - x) * F.log(F.lit(1 - p))
    steps = F.least(x, F.ceil(40 * F.sqrt(n.cast("double"))) + 100)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(a, k):
        i = x - k + 1  # from the term of i to that of i - 1
        term = a["term"] * i * (1 - p) / ((n - i + 1) * p)
        return F.struct(term.alias("term"), (a["total"] + term).alias("total"))

    scaled = F.when(x > 0, F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.greatest(steps, F.lit(1))), start, add, lambda a: a["total"])).otherwise(1.0)
    return F.when(x >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), scaled * F.exp(log_top)))


def labelled(features: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Features of the labelled documents: ``stratum``, ``good`` and ``fold`` beside them."""
    lab = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_q"))
    df = features.select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), base_failed().alias("_base"),
                         *[f"f_{r}" for r in RULES])
    df = df.join(lab, "doc_id").where(~F.col("_base"))
    return df.select("stratum", (F.col("_q") == 1).alias("good"), (doc_fold(SELECT_FOLDS) == 0).alias("select"), *[f"f_{r}" for r in RULES])


def select_cutoffs(rows: DataFrame) -> DataFrame:
    """Per stratum the ordered rules, ``rules`` array<struct<gain, cutoff, rule>>, best first: one
    aggregation with a sum per grid point (no row is multiplied)."""
    good, bad = F.col("good").cast("bigint"), (~F.col("good")).cast("bigint")
    sums = [F.sum(good).alias("n_good"), F.sum(bad).alias("n_bad")]
    for r in RULES:
        for i, c in enumerate(GRID[r]):
            above = (F.col(f"f_{r}") > c).cast("bigint")
            sums += [F.sum(above * good).alias(f"g_{r}_{i}"), F.sum(above * bad).alias(f"b_{r}_{i}")]
    per = rows.where("select").groupBy("stratum").agg(*sums).where("n_good > 0 AND n_bad > 0")

    def best(r):
        points = [F.struct(F.round(F.col(f"b_{r}_{i}") / F.col("n_bad") - F.col(f"g_{r}_{i}") / F.col("n_good"), 9).alias("gain"),
                           F.lit(c).alias("cutoff"), F.lit(r).alias("rule")) for i, c in enumerate(GRID[r])]
        return F.array_max(F.array(*points))

    chosen = F.filter(F.array(*[best(r) for r in RULES]), lambda x: x["gain"] > 0)
    return per.select("stratum", F.sort_array(chosen, asc=False).alias("rules"))


def _first_rule(rules: Column) -> Column:
    """1-based place of the first rule of ``rules`` that rejects the row, 0 if none does."""
    def hit(x):
        out = F.lit(False)
        for r in RULES:
            out = out | ((x["rule"] == r) & (F.col(f"f_{r}") > x["cutoff"]))
        return out

    return F.coalesce(F.array_position(F.transform(rules, hit), True), F.lit(0))


def certify(rows: DataFrame, cutoffs: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per stratum the longest prefix of its rules whose false-rejection rate is certified on the
    holdout: stratum, rules, n_good, used."""
    held = rows.where("NOT select AND good").join(checked_broadcast(cutoffs), "stratum")
    at = _first_rule(F.col("rules")).alias("at")
    per = held.select("stratum", "rules", at).groupBy("stratum").agg(
        F.first("rules").alias("rules"), F.count(F.lit(1)).alias("n_good"),
        *[F.sum(F.col("at").between(1, k).cast("bigint")).alias(f"x{k}") for k in range(1, len(RULES) + 1)])
    # A NULL count of strata means no labelled rows: nothing is certified then.
    tests = cutoffs.agg((F.count(F.lit(1)) * len(RULES)).alias("tests"))
    per = per.crossJoin(F.broadcast(tests))  # one row
    used = F.lit(0)
    for k in range(1, len(RULES) + 1):
        ok = (F.size("rules") >= k) & (binomial_cdf(F.col(f"x{k}"), F.col("n_good"), alpha) <= delta / F.col("tests"))
        used = F.when(ok, F.lit(k)).otherwise(used)
    return per.select("stratum", "rules", "n_good", used.alias("used"))


def thresholds(features: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """The certified rules of every stratum: stratum, rules (those in use)."""
    rows = stored(labelled(features, labels, stratum), "quality-labelled")
    found = certify(rows, stored(select_cutoffs(rows), "quality-cutoffs"))
    return stored(found.select("stratum", F.slice("rules", 1, F.col("used")).alias("rules")), "quality-rules")


def with_verdict(features: DataFrame, rules: DataFrame, stratum: str = "lang") -> DataFrame:
    """``features`` with ``base_failed`` and ``kept``. The rules (one row per stratum) are broadcast
    only if measured small."""
    side = checked_broadcast(rules.select("stratum", F.col("rules").alias("_rules")), materialize=False)
    df = features.select(_packed(features, ["base_failed", "kept"]), base_failed().alias("base_failed"),
                         F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), *[f"f_{r}" for r in RULES])
    df = df.join(side, "stratum", "left")
    return df.select("_all.*", "base_failed", (~F.col("base_failed") & (_first_rule(F.col("_rules")) == 0)).alias("kept"))
