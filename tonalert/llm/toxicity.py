"""Operator 9, toxicity by noisy-channel deobfuscation.

1. Restoring. A token that may be disguised (look-alike characters inside it, a character repeated
   three times or more, single characters kept apart by blanks or marks) is a lattice: each character is itself, one of
   the letters it may stand for, or nothing (a separator, a repetition), each at a cost. Viterbi
   decoding under a character trigram model picks the restored token. Other tokens have
   one path and stay.
2. Scoring. Restored tokens are described by themselves and by their beginnings of 4 to 8
   characters. Log-odds of these come from labelled texts; the score is a logistic
   calibration of the strongest ones in the text, fitted on texts that the log-odds have not seen (two-fold).

Models are fitted on the whole texts of all allowed labelled rows: trigrams, lexicon and calibration are sums over the tasks.
Only entries that enough toxic texts hold for the lexicon are counted in the other class. Whole texts are scored.
Tasks take texts in blocks: the distinct pieces between blanks are read once a block, plain ones by Arrow, the others one by one.

Edge cases: NULL and empty texts have no tokens and get the score of that. With one class of labels
only (or none) every score is that class's share (0 without labels). Repeated rows and NULL ids are
scored like others. Extra columns are ignored. Very long tokens are decoded in linear time.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonalert.llm.common import stored
from tonalert.llm.training import Logistic, labelled_ids, labelled_rows
from tonalert.operators.joins import measured_bytes

MIN_TEXTS = 3  # texts of the toxic class that hold a lexicon entry
LEAST_ODDS = 1.5
MEMO = 200_000
LOGS = 200_000  # trigrams whose logarithm a task holds
RUN = 1 << 20  # characters whose trigrams are counted at a time
BLOCK_BYTES = 4 * 1024 * 1024  # bytes of text that a task reads at a time, one text at least
CANDIDATE_LIMIT_BYTES = 64 * 1024 * 1024  # measured bytes of lexicon entries that go to the tasks

# The letters that a character may stand for.
LOOK_ALIKE = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
              "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou"}
# Costs (natural logarithms) of the channel.
AS_LETTER, AS_ITSELF, DROP_MARK, DROP_REPEAT, KEEP_REPEAT = -0.7, -6.0, -1.0, -0.3, 0.0
_MARKS = set(" .-_*~'’·,/\\")
_LETTER = "a-zß-öø-ÿœ"
_HIDDEN = re.escape("".join(k for k in LOOK_ALIKE if not k.isalnum()))
_SEPARATOR = re.escape("".join(sorted(_MARKS)))
_SPACED = re.compile(rf"(?<![^\s])(?:[{_LETTER}0-9{_HIDDEN}][{_SEPARATOR}]{{1,3}}){{2,}}[{_LETTER}0-9{_HIDDEN}](?![{_LETTER}0-9])")
_STRIP = "\"'.,;:?%&#*<>()[]{}~^=/\\|!-_"
_PLAIN = re.compile(rf"[{_LETTER}]+")
_ONE_LETTER = re.compile(f"[{_LETTER}]")
_SIGNS = re.compile(rf"[0-9{_HIDDEN}{_SEPARATOR}]+")  # what may stand inside a disguised word
_SHOWN = re.compile(rf"[0-9{_HIDDEN}]")
_LED = re.compile(rf"[0-9{_HIDDEN}]+[{_LETTER}]{{2}}")
_LETTER_THRICE = re.compile(rf"([{_LETTER}])\1\1")
# The same for Arrow, whose expressions know no lookarounds and no references back.
_LETTERS = [chr(c) for c in range(0x180) if _ONE_LETTER.match(chr(c))]
_BLANK = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"  # str.isspace
_ANY_SPACED = (rf"(?:^|[{_BLANK}])(?:[{_LETTER}0-9{_HIDDEN}][{_SEPARATOR}]{{1,3}}){{2,}}[{_LETTER}0-9{_HIDDEN}](?:$|[^{_LETTER}0-9])")
_ALL_LETTERS, _ANY_THRICE = rf"^[{_LETTER}]+$", "|".join(c * 3 for c in _LETTERS)


def disguised(token: str) -> bool:
    """Whether ``token`` may be a disguised word: signs or digits stand between its letters or before two of them, or a
    letter stands three times in a row. One scan over its runs of signs."""
    if not _ONE_LETTER.search(token):
        return False
    if _LED.match(token) or _LETTER_THRICE.search(token):
        return True
    for m in _SIGNS.finditer(token):
        if _ONE_LETTER.match(token, m.end()) and (m.start() and _ONE_LETTER.match(token, m.start() - 1) or _SHOWN.search(token, m.start(), m.end() - 1)):
            return True
    return False


class CharModel:
    """Interpolated trigrams over lower-case letters; '^' begins and ends a token."""

    def __init__(self, trigrams: dict):
        self.tri, self.bi, self.uni = {}, {}, {}
        two, one = {}, {}
        for g, n in trigrams.items():
            self.tri[g] = self.tri.get(g, 0) + n
            two[g[:2]] = two.get(g[:2], 0) + n
            self.bi[g[1:]] = self.bi.get(g[1:], 0) + n
            one[g[1]] = one.get(g[1], 0) + n
            self.uni[g[2]] = self.uni.get(g[2], 0) + n
        self.two, self.one, self.all = two, one, sum(self.uni.values())
        self.known: dict = {}  # logarithms worked out before, LOGS at most

    def log(self, before: str, c: str) -> float:
        found = self.known.get(before + c)
        if found is None:
            if len(self.known) >= LOGS:
                self.known.clear()
            found = self.known[before + c] = self._log(before, c)
        return found

    def _log(self, before: str, c: str) -> float:
        p = 0.02 * (self.uni.get(c, 0) + 1) / (self.all + 64)
        n = self.one.get(before[1])
        if n:
            p += 0.18 * self.bi.get(before[1] + c, 0) / n
        n = self.two.get(before)
        if n:
            p += 0.8 * self.tri.get(before + c, 0) / n
        return math.log(p)


def restore(token: str, model: CharModel) -> str:
    """The likeliest plain token behind ``token`` (lower case)."""
    run, runs = 0, []
    for i, ch in enumerate(token):
        run = run + 1 if i and token[i - 1] == ch else 1
        runs.append(run)
    # A repetition is cheap to drop where the character stands three times or more in a row.
    long_run = [False] * len(token)
    for i in range(len(token) - 1, -1, -1):
        long_run[i] = runs[i] >= 3 or (i + 1 < len(token) and runs[i + 1] > runs[i] and long_run[i + 1])
    # Before the first character that may be another there is one path.
    begun, state, score, path = 0, "^^", 0.0, None
    for ch in token:
        if ch in LOOK_ALIKE or ch in _MARKS or runs[begun] > 1 and long_run[begun]:
            break
        score = score + (KEEP_REPEAT if ch.isalpha() else AS_ITSELF) + model.log(state, ch)
        state, path, begun = state[1] + ch, (ch, path), begun + 1
    states = {state: (score, path)}  # last two letters -> (score, (letter, earlier path))
    for i, ch in enumerate(token[begun:], begun):
        new: dict = {}
        log, repeat = model.log, runs[i] > 1 and long_run[i]
        # The ways of a character: (letter, cost).
        ways = [(ch, KEEP_REPEAT if ch.isalpha() else AS_ITSELF)]
        drop = DROP_MARK if ch in _MARKS and not ch.isalpha() else None
        ways += [(c, AS_LETTER) for c in LOOK_ALIKE.get(ch, "")]
        for state, (score, path) in states.items():
            for k, (c, cost) in enumerate(ways):
                to, s = state[1] + c, score + cost + log(state, c)
                if to not in new or s > new[to][0]:
                    new[to] = (s, (c, path))
                if k == 0 and drop is not None:
                    s = score + drop
                    if state not in new or s > new[state][0]:
                        new[state] = (s, path)
            if repeat:
                s = score + DROP_REPEAT
                if state not in new or s > new[state][0]:
                    new[state] = (s, path)
        states = new  # at most the square of what a character may stand for
    _, (_, path) = max(states.items(), key=lambda kv: kv[1][0] + model.log(kv[0], "^"))
    out = []
    while path:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out))


def blocks(batch):
    """``batch`` in slices of BLOCK_BYTES bytes of text, one row at least."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_BYTES, side="right")))
        yield batch.slice(at, end - at)
        at = end


def _lower(block) -> list:
    return [(t or "").lower() for t in block.column("text").to_pylist()]


def _distinct(x):
    """The distinct values of ``x``, sorted (numpy's own way hashes them first, which is slower)."""
    x = np.sort(x)
    return x[np.diff(x, prepend=-1) != 0]


def read_block(texts: list, decode):
    """(words, of, at): the distinct restored tokens of lower-case ``texts`` and the distinct pairs (text, token) by their
    places, in order; ``decode`` restores a disguised token."""
    import pyarrow as pa
    import pyarrow.compute as pc

    column = pa.array([t.strip() for t in texts], pa.string())  # the split reads on behind a blank at the end
    split = pc.utf8_split_whitespace(column)
    pieces = split.flatten().dictionary_encode()
    raw = pieces.dictionary
    token = pc.utf8_trim(raw, _STRIP)
    led = pc.not_equal(pc.binary_length(pc.utf8_ltrim(raw, _STRIP)), pc.binary_length(raw))
    # Letters alone, none thrice in a row, no mark before them: the token as it stands (``_read``).
    easy = pc.and_not(pc.match_substring_regex(token, _ALL_LETTERS), pc.or_(led, pc.match_substring_regex(token, _ANY_THRICE)))
    read = getattr(decode, "of_raw", None) or (lambda raw: _read(raw, decode))
    others = list(map(read, raw.filter(pc.invert(easy)).to_pylist()))
    apart, apart_of = [], []
    for i in np.flatnonzero(pc.match_substring_regex(column, _ANY_SPACED).to_numpy(zero_copy_only=False)).tolist():
        found = [decode(part) for m in _SPACED.finditer(texts[i]) for part in spaced(m.group())]
        apart += found
        apart_of += [i] * len(found)
    coded = pa.concat_arrays([token.filter(easy), pa.array(others, pa.string()), pa.array(apart, pa.string())]).dictionary_encode()
    code = pc.fill_null(coded.indices, -1).to_numpy().astype(np.int64)
    easy = easy.to_numpy(zero_copy_only=False)
    of_raw = np.empty(len(raw), np.int64)
    of_raw[easy], of_raw[~easy] = code[:easy.sum()], code[easy.sum():len(raw)]
    at = np.concatenate([of_raw[pieces.indices.to_numpy()], code[len(raw):]])
    of = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy())), np.array(apart_of, np.int64)])
    return coded.dictionary, *np.divmod(_distinct((of * len(coded.dictionary) + at)[at >= 0]), max(1, len(coded.dictionary)))


def tokens(text: str, decode) -> set:
    """Distinct restored tokens of ``text``; ``decode`` restores a disguised one."""
    return set(read_block([text.lower()], decode)[0].to_pylist())


def _read(raw: str, decode):
    """The restored token of a piece between blanks, None where only marks are left."""
    token = raw.strip(_STRIP)
    # A token of letters alone is only disguised if a letter repeats; marks behind it hide nothing.
    if _PLAIN.fullmatch(token) and not _repeats(token) and (raw.startswith(token) or not disguised(raw)):
        return token
    if token:
        lead = raw.lstrip("\"'([{<")  # a look-alike may stand first
        return decode(lead.rstrip(_STRIP)) if disguised(lead) or _repeats(token) else token
    return None


_APART = re.compile(rf"[{_SEPARATOR}]{{1,3}}")


def spaced(run: str) -> list:
    """A run of single characters kept apart, whole and without one or two characters at its ends: words of one letter
    beside it ('you are a s t u p i d person') are no part of the word."""
    cuts = [0, *(m.end() for m in _APART.finditer(run))]
    ends = [*(m.start() for m in _APART.finditer(run)), len(run)]
    n = len(cuts)
    return [run[cuts[a]:ends[n - 1 - b]] for a in range(3) for b in range(3) if n - a - b >= 3]


_THRICE = re.compile(r"(.)\1\1")


def _repeats(token: str) -> bool:
    return _THRICE.search(token) is not None


def described(token: str) -> list:
    """A token's lexicon keys: the whole token and its beginnings."""
    return ["=" + token] + [token[:n] for n in range(4, min(8, len(token)) + 1)]


def keys_of(words):
    """(keys, code): the distinct lexicon keys of ``words``, an Arrow array, and the place of each word's keys among them, a
    row for each kind of ``described`` with -1 where a word is too short."""
    import pyarrow as pa
    import pyarrow.compute as pc

    length = pc.utf8_length(words)
    starts = [pc.if_else(pc.greater_equal(length, n), pc.utf8_slice_codeunits(words, 0, n), pa.scalar(None, pa.string())) for n in range(4, 9)]
    coded = pa.concat_arrays([pc.binary_join_element_wise("=", words, ""), *starts]).dictionary_encode()
    return coded.dictionary, pc.fill_null(coded.indices, -1).to_numpy().astype(np.int64).reshape(6, len(words))


_LETTER_CODE = np.zeros(0x181, np.int32)  # 0: no letter, the last for all characters beyond
_LETTER_CODE[[ord(c) for c in _LETTERS]] = np.arange(1, len(_LETTERS) + 1)
_CODES = len(_LETTERS) + 1


def _trigrams(batches):
    """Letter trigrams of all runs of letters, a blank or another sign standing for '^', summed per task."""
    import pyarrow as pa

    counts = np.zeros(_CODES ** 3, np.int64)
    for batch in batches:
        for block in blocks(batch):
            text = "\n\n" + "\n".join(_lower(block)) + "\n"
            for i in range(0, len(text) - 2, RUN):
                points = np.frombuffer(text[i:i + RUN + 2].encode("utf-32-le"), np.uint32)
                c = _LETTER_CODE[np.minimum(points, len(_LETTER_CODE) - 1)]
                last, here = c[1:-1], c[2:]
                before = np.where(last > 0, c[:-2], 0)  # a run begins behind '^^'
                counts += np.bincount(((before * _CODES + last) * _CODES + here)[(last > 0) | (here > 0)], minlength=len(counts))
    seen, signs = np.flatnonzero(counts), ["^", *_LETTERS]
    grams = [signs[g // _CODES ** 2] + signs[g // _CODES % _CODES] + signs[g % _CODES] for g in seen.tolist()]
    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array(counts[seen])], names=["gram", "n"])


def char_model(texts: DataFrame) -> CharModel:
    """The trigram model of the labelled texts; the letters of _PLAIN bound the number of rows."""
    rows = texts.select("text").mapInArrow(_trigrams, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return CharModel({r["gram"]: r["n"] for r in rows})


def _memo(model: CharModel):
    """Restores a disguised token; ``of_raw`` does so for a piece between blanks."""
    decode = lru_cache(MEMO)(lambda token: restore(token, model))
    decode.of_raw = lru_cache(MEMO)(lambda raw: _read(raw, decode))
    return decode


def _key_counts(texts: DataFrame, model: CharModel, only=None) -> DataFrame:
    """key, half, n: in how many texts of each half a key occurs, summed per task or block; ``only``: a broadcast Arrow array of keys."""
    def counted(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        decode, wanted = _memo(model), None if only is None else only.value
        sums = None if wanted is None else np.zeros((2, len(wanted)), np.int64)

        def passed(keys, counts):
            for h in (0, 1):
                held = np.flatnonzero(counts[h])
                for at in range(0, len(held), 100_000):
                    some = held[at:at + 100_000]
                    yield pa.RecordBatch.from_arrays([keys.take(pa.array(some)), pa.array(np.full(len(some), h, np.int32)), pa.array(counts[h][some])],
                                                     names=["key", "half", "n"])

        for batch in batches:
            for block in blocks(batch):
                words, of, at = read_block(_lower(block), decode)
                keys, code = keys_of(words)
                if wanted is not None:
                    place = pc.fill_null(pc.index_in(keys, value_set=wanted), -1).to_numpy().astype(np.int64)
                    code = np.where(code >= 0, place[code], -1) if len(place) else code
                    keys = wanted
                n = len(keys)
                pairs = [(of * n + k)[k >= 0] for k in (kind[at] for kind in code)]
                text, key = np.divmod(_distinct(np.concatenate(pairs)), max(1, n))  # a text counts once
                half = block.column("half").to_numpy()[text]
                counts = np.bincount(half * np.int64(n) + key, minlength=2 * n).reshape(2, n)
                if wanted is None:
                    yield from passed(keys, counts)
                else:
                    sums += counts
        if wanted is not None:
            yield from passed(wanted, sums)

    return texts.select("text", "half").mapInArrow(counted, "key string, half int, n bigint")


def least_texts(counts: dict, halves) -> int:
    """In how many toxic texts of ``halves`` an entry of the lexicon occurs at least."""
    return min(MIN_TEXTS, max(2, sum(counts.get((h, 1), 0) for h in halves) // 8))


def lexicon_counts(rows: DataFrame, model: CharModel, least: int = 2) -> DataFrame:
    """key, n00, n01, n10, n11: in how many texts of each half and class a key occurs, of the keys that ``least`` toxic texts hold."""
    def by_half(counts, y):
        return counts.groupBy("key").agg(*[F.sum(F.when(F.col("half") == h, F.col("n")).otherwise(0)).alias(f"n{h}{y}") for h in (0, 1)])

    toxic = stored(by_half(_key_counts(rows.where("y = 1"), model), 1).where(f"n01 + n11 >= {least}"), "toxic-keys")
    only = None
    if measured_bytes(toxic.select("key")) <= CANDIDATE_LIMIT_BYTES:
        only = rows.sparkSession.sparkContext.broadcast(toxic.select("key").toArrow().column("key").cast("string").combine_chunks())  # measured
    clean = by_half(_key_counts(rows.where("y = 0"), model, only), 0)
    return toxic.join(clean, "key", "left").fillna(0, ["n00", "n10"])


def log_odds(rows, counts, halves) -> dict:
    """key -> log-odds of the toxic class, of keys that the toxic texts of ``halves`` hold often."""
    total, least = {y: sum(counts.get((h, y), 0) for h in halves) for y in (0, 1)}, least_texts(counts, halves)
    out = {}
    for r in rows:
        t, c = (sum(r[f"n{h}{y}"] for h in halves) for y in (1, 0))
        if t >= least:
            w = math.log((t + 0.5) / (total[1] + 1)) - math.log((c + 0.5) / (total[0] + 1))
            if w > LEAST_ODDS:
                out[r["key"]] = w
    return out


def inputs(found: list) -> list:
    """What the calibration sees of the weights found in a text."""
    best = sorted(found, reverse=True)[:3]
    return [best[0] if best else 0.0, sum(best), math.log1p(len(found))]


def _weigher(odds: dict):
    """The strongest weight of a token's keys, 0 for none. Most tokens begin like no key at all."""
    heads = {part for k in odds for part in (k[:4], k[1:5])}
    weigh = lru_cache(MEMO)(lambda w: max((odds.get(k, 0.0) for k in described(w)), default=0.0))
    return lambda w: weigh(w) if w[:4] in heads else 0.0


def inputs_of(texts: list, decode, weighers: list, which=None) -> np.ndarray:
    """``inputs`` of every one of some lower-case texts; ``which``: the place of each text's weigher, if there are several."""
    words, of, at = read_block(texts, decode)
    spelt = words.to_pylist()
    weights = np.array([list(map(weigh, spelt)) for weigh in weighers], float).reshape(len(weighers), len(spelt))
    weight = weights[0 if which is None else np.asarray(which)[of], at]
    of, weight = of[weight > 0], weight[weight > 0]
    x = np.empty((len(texts), 3))
    x[:] = inputs([])
    for found in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
        if len(found):
            x[of[found[0]]] = inputs(weight[found].tolist())
    return x


def _found(rows: DataFrame, model: CharModel, odds: list) -> DataFrame:
    """x0, x1, x2, y of every row: what the calibration sees by the log-odds of the other half."""
    def seen(batches):
        import pyarrow as pa

        decode, weighers = _memo(model), [_weigher(o) for o in odds]
        for batch in batches:
            for block in blocks(batch):
                x = inputs_of(_lower(block), decode, weighers, 1 - block.column("half").to_numpy())
                yield pa.RecordBatch.from_arrays([*[pa.array(x[:, i]) for i in range(3)], block.column("y")], names=["x0", "x1", "x2", "y"])

    return rows.select("text", "half", "y").mapInArrow(seen, "x0 double, x1 double, x2 double, y int")


def fit(docs: DataFrame, labels: DataFrame, allowed: Column):
    """(character model, log-odds, calibration) of all labelled rows, or the constant score where a class is missing."""
    half = F.pmod(F.col("_order"), F.lit(2)).cast("int")
    chosen = stored(labelled_ids(docs, labels, "toxic", allowed), "toxic-rows")
    counts = {(r["half"], r["y"]): r["n"] for r in chosen.groupBy(half.alias("half"), "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = {y: counts.get((0, y), 0) + counts.get((1, y), 0) for y in (0, 1)}
    if min(n.values()) < 2 or min(counts.get((h, y), 0) for h in (0, 1) for y in (0, 1)) < 1:
        return n[1] / max(1, n[0] + n[1])
    rows = labelled_rows(docs, chosen).withColumn("half", half)
    model = char_model(rows)
    # Entries that ``log_odds`` could take from some halves: the lexicon, whose size follows the words of toxic texts.
    ratio = math.exp(LEAST_ODDS - 0.01)
    speaks = F.lit(False)
    for halves in ((0,), (1,), (0, 1)):
        t, c = (sum(F.col(f"n{h}{k}") for h in halves) for k in (1, 0))
        of_t, of_c = (sum(counts.get((h, k), 0) for h in halves) for k in (1, 0))
        speaks = speaks | ((t + 0.5) * (of_c + 1) > ratio * (c + 0.5) * (of_t + 1))
    least = min(least_texts(counts, halves) for halves in ((0,), (1,), (0, 1)))
    entries = lexicon_counts(rows, model, least).where(speaks).collect()
    found = stored(_found(rows, model, [log_odds(entries, counts, (h,)) for h in (0, 1)]), "toxic-inputs")
    return model, log_odds(entries, counts, (0, 1)), Logistic.of_rows(found, ["x0", "x1", "x2"], "y")


def scored(docs: DataFrame, labels: DataFrame, allowed: Column) -> DataFrame:
    """doc_id, score of every text; labels are read from the ``allowed`` rows only."""
    model = fit(docs, labels, allowed)

    def score(batches):
        import pyarrow as pa

        constant = isinstance(model, float)
        decode, weigh = (None, None) if constant else (_memo(model[0]), _weigher(model[1]))
        for batch in batches:
            for part in blocks(batch):
                if constant:
                    p = np.full(part.num_rows, model)
                else:
                    p = model[2](inputs_of(_lower(part), decode, [weigh]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(score, "doc_id bigint, score double")
