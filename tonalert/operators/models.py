"""Model steps as Spark jobs.

* User models (sentiment scorer, captioner, alert generator) run inside ``mapInArrow``: Arrow
  batches in, the model loaded once per Python worker, called on fixed-size slices (L9).
* The trainable sentiment model is logistic regression (MLlib, trained on the executors with tree
  aggregation) over the mean of a text's prepared word vectors, in place of a recurrent network. The
  vectors are joined to the words; nothing is collected to the driver.
* The default alert generator is the native alert expression (E6), so no Python runs at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.constants import SCORING_BATCH
from tonalert.functions import entities as E
from tonalert.functions import labels as L
from tonalert.operators.joins import checked_broadcast, measured_bytes
from tonalert.operators.taggers import TRIE_LIMIT_BYTES, Gazetteer

def _model(loader: Callable, key: str):
    """The loaded model of a Python worker process, the latest one only. The cache hangs off ``sys`` (present in every
    worker), because this module's own globals travel with each task's pickled function and would
    start empty every time; ``key`` is fixed when the plan is built."""
    import sys

    cache = getattr(sys, "_tonalert_model", None)
    if cache is None or cache[0] != key:
        cache = sys._tonalert_model = (key, loader())
    return cache[1]


def _scored_rows(model: Callable, values: list) -> list:
    """(result, error) of each value. A list that fails is halved until single values remain: one that fails alone costs
    two calls for each halving, and does no harm to the others."""
    try:
        out = list(model(values))
        if len(out) != len(values):
            raise ValueError(f"{len(out)} results for {len(values)} rows")
        return [(r, None) for r in out]
    except Exception as e:  # whatever a user's model raises
        if len(values) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        half = len(values) // 2
        return _scored_rows(model, values[:half]) + _scored_rows(model, values[half:])


def score_batches(df: DataFrame, loader: Callable[[], Callable[[list], list]], col: str,
                  out_fields: list[T.StructField], batch: int = SCORING_BATCH,
                  keep: list[str] | None = None, error: str | None = None) -> DataFrame:
    """Distributed batch inference.

    ``loader()`` returns ``model(values: list) -> list`` of tuples (one per value, matching
    ``out_fields``); it runs once per Python worker, and the model sees ``batch`` rows at a time.
    ``keep``: columns that come back beside the result (all by default).
    ``error``: name of a column for the error of a row that the model fails on; its results are NULL and the job goes
    on. Without it a failing row ends the job.
    """
    kept = df.columns if keep is None else list(dict.fromkeys(keep))
    df = df if keep is None else df.select(*dict.fromkeys([*kept, col]))
    fields = out_fields + ([T.StructField(error, T.StringType())] if error else [])
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    key = uuid.uuid4().hex

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        model = _model(loader, key)
        types = [to_arrow_type(f.dataType) for f in fields]
        for arrived in batches:
            # Only the rows that the model sees at a time become Python values; the kept columns stay as they are.
            for start in range(0, arrived.num_rows, batch):
                chunk = arrived.slice(start, batch)
                values = chunk.column(col).to_pandas().tolist()
                if error:
                    nothing = (None,) * len(out_fields)
                    results = [(*(nothing if e else r), e) for r, e in _scored_rows(model, values)]
                else:
                    results = list(model(values))
                    if len(results) != len(values):
                        raise ValueError(f"{len(results)} results for {len(values)} rows")
                out = [pa.array([r[i] for r in results], t, from_pandas=True) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*[chunk.column(c) for c in kept], *out], names=schema.names)

    return df.mapInArrow(run, schema)


VECTOR_LIMIT_BYTES = 256 * 1024 * 1024  # measured bytes of word vectors that go to the tasks (as one matrix)
VECTOR_TOKENS = 65_536  # tokens whose vectors are held at a time


def doc_vectors(df: DataFrame, vocab: DataFrame, key: str = "doc_id", tokens: str = "tokens", col: str = "features",
                limit: int = VECTOR_LIMIT_BYTES) -> DataFrame:
    """Mean vector of each key's known words, ``(key, col, n_known)``; keys without a known word have none; keys may
    repeat or be NULL. ``vocab``: (word, vector), with ``idx`` (the most frequent word first) if known.

    Words of up to ``limit`` measured bytes go to the tasks as a matrix; a row's vectors are added up where the row is, so
    one vector a row is shuffled. Of a larger vocabulary with ``idx`` the first words go there, and the tokens of the
    rest alone are joined with their vectors; without ``idx`` all are."""
    listed = vocab.where("word IS NOT NULL AND vector IS NOT NULL")
    size = measured_bytes(listed.select("word", "vector"))
    here, rest = listed, None
    if size > limit:
        first = F.lit(False)
        if "idx" in vocab.columns:
            words = int(listed.count() * limit / size)
            last = listed.orderBy("idx").limit(words).agg(F.max("idx").alias("i")).first()["i"]
            first = F.coalesce(F.col("idx") <= last, F.lit(False)) if last is not None else first
        here, rest = listed.where(first), listed.where(~first)
    sums = _row_means(df, here, key, tokens)
    if rest is not None:
        words = df.select(key, F.explode(tokens).alias("word"))
        known = words.join(checked_broadcast(rest.select("word", array_to_vector("vector").alias("_v")), materialize=False), "word")
        sums = sums.unionByName(known.select(key, "_v", F.lit(1).cast("bigint").alias("_n")))
    return sums.groupBy(key).agg(Summarizer.mean(F.col("_v"), F.col("_n").cast("double")).alias(col), F.sum("_n").alias("n_known"))


def _row_means(df: DataFrame, vocab: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, _v, _n) of each row with a word of ``vocab``: the mean of their vectors and their number. A word that is listed
    twice counts twice."""
    import numpy as np
    import pyarrow as pa

    table = vocab.select("word", "vector").toArrow()  # measured by the caller
    matrix = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = matrix.reshape(table.num_rows, -1) if table.num_rows else np.zeros((0, 1), np.float32)
    coded = table.column("word").combine_chunks().cast(pa.string()).dictionary_encode()
    times = np.ones(table.num_rows, np.int64)
    if len(coded.dictionary) < table.num_rows:
        at, each = coded.indices.to_numpy(), matrix
        matrix, times = np.zeros((len(coded.dictionary), each.shape[1])), np.bincount(at, minlength=len(coded.dictionary))
        np.add.at(matrix, at, each)
    held = df.sparkSession.sparkContext.broadcast((coded.dictionary, matrix, times))

    def means(batches):
        for batch in batches:
            v, n = _means_of_lists(batch.column(1), *held.value)
            own = pa.RecordBatch.from_arrays([batch.column(0), v, n], names=[key, "v", "n"])
            yield own.filter(pa.array(n.to_numpy() > 0))

    schema = T.StructType([df.schema[key], T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())])
    # Not a UDF: a filter on its result would be moved below the joins that make ``df``.
    found = df.select(key, tokens).mapInArrow(means, schema)
    return found.select(key, array_to_vector("v").alias("_v"), F.col("n").alias("_n"))


def _means_of_lists(lists, words, matrix, times):
    """Mean vector and number of the known words of each token list, VECTOR_TOKENS at a time."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = lists.cast(pa.list_(pa.string()))
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    place = pc.index_in(coded.dictionary, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False) if len(coded.dictionary) else np.zeros(0, np.int64)
    token = np.append(place, -1)[coded.indices.fill_null(len(place)).to_numpy(zero_copy_only=False)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    hit = token >= 0
    token, row = token[hit], row[hit]
    sums, n = np.zeros((len(sizes), matrix.shape[1])), np.bincount(row, times[token], len(sizes)).astype(np.int64)
    for a in range(0, len(token), VECTOR_TOKENS):
        part = row[a:a + VECTOR_TOKENS]
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sums[part[starts]] += np.add.reduceat(matrix[token[a:a + VECTOR_TOKENS]], starts, axis=0, dtype=np.float64)
    means = sums / np.maximum(n, 1)[:, None]
    offsets = pa.array(np.arange(len(sizes) + 1) * matrix.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(means.ravel())), pa.array(n)


def with_features(df: DataFrame, vocab: DataFrame, key: str = "doc_id", tokens: str = "tokens") -> DataFrame:
    """``df`` without its tokens, with ``features``; a zero vector where no word is known."""
    means = doc_vectors(df, vocab, key, tokens)
    width = vocab.select(F.size("vector").alias("n")).first()
    zero = array_to_vector(F.array_repeat(F.lit(0.0), width["n"] if width else 1))
    out = df.drop(tokens).join(means, key, "left")
    return out.withColumn("features", F.coalesce("features", zero)).drop("n_known")


def train_sentiment(df: DataFrame, label: str = "target", max_iter: int = 30) -> PipelineModel:
    """M3: logistic regression on ``features``; label 2 reads as 1."""
    data = df.select("features", L.loss_label(label).cast("double").alias("_label"))
    return Pipeline(stages=[LogisticRegression(featuresCol="features", labelCol="_label", maxIter=max_iter)]).fit(data)


def predict_sentiment(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M4: probability of the positive class ``p``, its logit, and the binary / banded classes."""
    out = model.transform(df)
    p = F.get(vector_to_array("probability"), 1)
    raw = F.get(vector_to_array("rawPrediction"), 1)
    return out.withColumns({
        "p": p, "logit": raw, "pred_binary": L.class_binary(p), "pred_banded": L.class_banded(p),
    }).drop("features", "rawPrediction", "probability", "prediction")


def evaluate_sentiment(model: PipelineModel, df: DataFrame, label: str = "target") -> DataFrame:
    """M4: accuracy (P15, labels 0/2) and three-class accuracy (P16) in one aggregate."""
    from tonalert.operators.metrics import accuracy

    s = predict_sentiment(model, df)
    return s.agg(accuracy("pred_binary", label).alias("accuracy"), accuracy("pred_banded", label).alias("accuracy3"),
                 F.count(F.lit(1)).alias("n"))


def save_model(model: PipelineModel, path: str) -> None:
    """M5: save (overwriting)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """M5: load a saved pipeline."""
    return PipelineModel.load(path)


def compare_scorers(scored: DataFrame, reference: DataFrame, key: str = "doc_id", logit: str = "x",
                    sentiment: str = "sentiment") -> DataFrame:
    """M6: own model (a logit per row) against reference text labels, joined by key. Rows without a
    reference label stay, with ``agree`` NULL.

    One coding for both sides: negative 0, neutral 1, positive 2 (the banded class of P16).
    """
    code = F.when(F.col(sentiment) == "negative", 0).when(F.col(sentiment) == "neutral", 1).when(
        F.col(sentiment) == "positive", 2)
    j = scored.select(key, logit).join(reference.select(key, sentiment), key, "left")
    pred = L.class_banded(L.sigmoid(logit))
    return j.select(key, sentiment, pred.alias("predicted_sentiment"),
                    (pred == code).cast("int").alias("agree"))


def caption_images(images: DataFrame, loader: Callable[[], Callable[[list], list]], batch: int = 1) -> DataFrame:
    """M7: bytes -> caption, one row per image (``binaryFile`` rows in, ``image_name, caption`` out)."""
    named = images.select(F.element_at(F.split("path", "/"), -1).alias("image_name"), "content")
    scored = score_batches(named, loader, "content", [T.StructField("caption", T.StringType())], batch, keep=["image_name"])
    return scored.select("image_name", "caption")


def generate_alerts(df: DataFrame, generator: Callable[[], Callable[[list], list]] | None = None,
                    key: str = "doc_id", batch: int = SCORING_BATCH) -> DataFrame:
    """M8: ``input_text`` -> ``prediction`` beside ``reference`` (= ``target_text``).

    Without a generator the prediction is the native alert (E6, salt 1): no Python per row.
    """
    if generator is None:
        pred = E.build_alert("entities", "sentiment", "sentiment_score", key, salt=1)
        return df.select(key, "input_text", pred.alias("prediction"), F.col("target_text").alias("reference"))
    base = df.select(key, "input_text", F.col("target_text").alias("reference"))
    return score_batches(base, generator, "input_text", [T.StructField("prediction", T.StringType())], batch,
                         keep=[key, "input_text", "reference"])


def gazetteer_from_spans(spans: DataFrame, entity: str = "entity", tag: str = "tag") -> DataFrame:
    """A single-word gazetteer ``(tok, kind)`` from decoded spans: every word of a span, one kind
    per word (the smallest kind name on conflict)."""
    words = spans.select(F.explode(F.split(entity, " ")).alias("tok"), F.col(tag).alias("kind"))
    return _smallest_kind(words.filter(F.col("tok") != ""))


def phrases_from_spans(spans: DataFrame, entity: str = "entity", tag: str = "tag") -> DataFrame:
    """A gazetteer of whole names ``(tok, kind)`` from decoded spans, one kind per name (the smallest on conflict)."""
    return _smallest_kind(spans.select(F.col(entity).alias("tok"), F.col(tag).alias("kind")))


def _smallest_kind(rows: DataFrame) -> DataFrame:
    # A minimum of texts is aggregated by sorting, so pairs are made distinct before, by hashing (a plain distinct() is planned away).
    pairs = rows.groupBy("tok", "kind").agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    return pairs.groupBy("tok").agg(F.min("kind").alias("kind"))


def tag_rows(df: DataFrame, tagger, tokens: str = "tokens", col: str = "tags", limit: int = TRIE_LIMIT_BYTES) -> DataFrame:
    """E9 in rows: ``df`` with ``col``, one tag name per token. ``tagger``: a gazetteer table (tok, kind), whose ``tok`` may
    have several words, or anything with ``tag(df, tokens, col)`` (``taggers.Gazetteer``, ``taggers.Hmm``, a user's own)."""
    own = Gazetteer(tagger, limit=limit) if isinstance(tagger, DataFrame) else tagger
    return own.tag(df, tokens, col)


def tag_tokens(df: DataFrame, tagger, key: str = "doc_id", tokens: str = "tokens", limit: int = TRIE_LIMIT_BYTES) -> DataFrame:
    """E9 exploded: ``(key, pos, tok, tag)`` of every token, by ``tag_rows``; keys may repeat or be NULL."""
    z = F.arrays_zip(F.col(tokens).alias("tok"), F.col("_tags").alias("tag"))
    tagged = tag_rows(df.select(key, tokens), tagger, tokens, "_tags", limit)
    return tagged.select(key, F.posexplode(z).alias("pos", "z")).select(key, "pos", "z.tok", "z.tag")
