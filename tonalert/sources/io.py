"""Sources and sinks (S1-S8, K1-K5). Every reader declares its schema (no inference)."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonalert.functions.arrays import array_text
from tonalert.operators.joins import checked_broadcast

log = logging.getLogger(__name__)

TWEETS_SCHEMA = T.StructType([
    T.StructField("target", T.IntegerType()),
    T.StructField("ids", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("flag", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("text", T.StringType()),
])

TAGGED_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("tokens", T.ArrayType(T.StringType())),
    T.StructField("pos_tags", T.ArrayType(T.IntegerType())),
    T.StructField("chunk_tags", T.ArrayType(T.IntegerType())),
    T.StructField("ner_tags", T.ArrayType(T.IntegerType())),
    T.StructField("split", T.StringType()),
])

CAPTIONS_SCHEMA = T.StructType([
    T.StructField("image_name", T.StringType()),
    T.StructField("comment_number", T.StringType()),
    T.StructField("comment", T.StringType()),
])

VOCAB_SCHEMA = T.StructType([
    T.StructField("word", T.StringType()),
    T.StructField("idx", T.LongType()),
    T.StructField("vector", T.ArrayType(T.FloatType())),
])


def spread(df: DataFrame, min_partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Repartition only when a scan yields fewer partitions than the cluster can run at once
    (e.g. one large unsplittable file). On many input files this is a no-op: no extra shuffle.

    With a ``key`` the rows are hash-partitioned on it: deterministic on a retried task without
    the local sort that round-robin partitioning needs (a sort of whole text rows)."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key) if key else df.repartition(want)


def read_tweets(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headerless CSV, Latin-1, six named columns; doubled quotes escape quotes. Files are split
    among tasks; with ``multi_line`` quoted texts may span lines and each file is one task."""
    return (spark.read.schema(TWEETS_SCHEMA).option("header", False).option("encoding", "ISO-8859-1")
            .option("escape", '"').option("multiLine", multi_line).csv(path))


def read_table_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header row. Files are split among tasks; with ``multi_line`` quoted fields may span
    lines and a file is one task (write many files)."""
    return (spark.read.schema(schema).option("header", True).option("escape", '"')
            .option("multiLine", multi_line).csv(path))


def read_captions(spark: SparkSession, path: str, schema: T.StructType = CAPTIONS_SCHEMA, multi_line: bool = False) -> DataFrame:
    """S3: ``|``-separated CSV with a header; spaces around unquoted fields are trimmed, quoted
    fields are kept as written and, with ``multi_line``, may span lines (see S2)."""
    return (spark.read.schema(schema).option("header", True).option("sep", "|").option("escape", '"')
            .option("multiLine", multi_line)
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))


def read_tagged(spark: SparkSession, path: str) -> DataFrame:
    """The token corpus, one folder per split (``split=...``), tags as integer codes."""
    return spark.read.schema(TAGGED_SCHEMA).parquet(path)


def read_tag_names(spark: SparkSession, path: str, features=("pos_tags", "chunk_tags", "ner_tags")) -> DataFrame:
    """Label names out of a dataset description JSON -> ``(feature, idx, name)``, in one read
    with a declared schema."""
    names = T.StructType([T.StructField("feature", T.StructType([T.StructField("names", T.ArrayType(T.StringType()))]))])
    schema = T.StructType([T.StructField("features", T.StructType([T.StructField(f, names) for f in features]))])
    info = spark.read.schema(schema).option("multiLine", True).json(path)
    parts = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"features.{f}.feature.names").alias("names")) for f in features])
    return info.select(F.explode(parts).alias("f")).select("f.feature", F.posexplode("f.names").alias("idx", "name"))


def read_images(spark: SparkSession, path: str, exts=(".jpg",), ignore_case: bool = False) -> DataFrame:
    """List image files by extension and load their bytes (``path, modificationTime,
    length, content``). Other files are left out when the folder is listed, so they are not read."""
    def spelled(ext):
        return "".join(f"[{c.lower()}{c.upper()}]" if ignore_case and c.isalpha() else c for c in ext.lstrip("."))

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{" + ",".join(map(spelled, exts)) + "}").load(path)


def on_missing(reader: Callable[[], DataFrame], policy: str = "error", what: str = "input") -> DataFrame | None:
    """Missing-input policy: ``error`` raises, ``skip`` reports and returns None."""
    try:
        return reader()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        if policy == "skip":
            log.warning("%s not found; skipped", what)
            return None
        raise FileNotFoundError(f"{what} not found") from e


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """The prepared ``(word, idx, vector)`` table; an absent one raises (see on_missing)."""
    return on_missing(lambda: spark.read.schema(VOCAB_SCHEMA).parquet(path), "error", "vocabulary")


def read_vocab_or_fit(spark: SparkSession, path: str, fit: Callable[[], DataFrame]) -> DataFrame:
    """The prepared table, or, where there is none, the table that ``fit`` makes (``vocab.fit_vectors``), written to
    ``path`` for the next time. A folder that a failed write left without its marker is fitted again."""
    if not is_complete(spark, path):
        fit().write.mode("overwrite").parquet(path)
    return read_vocab(spark, path)


def _csv_ready(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(array_text(c).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else c)
    return df.select(*cols)


def _csv_writer(w):
    # Header, doubled quotes, and values kept exactly: Spark's CSV writer trims leading and
    # trailing spaces unless told not to.
    return (w.option("header", True).option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K1: write a table; CSV gets a header and nested columns as JSON text (K6)."""
    if fmt == "csv":
        _csv_writer(_csv_ready(df).write.mode(mode)).csv(path)
    else:
        df.write.mode(mode).format(fmt).save(path)


def write_by_split(df: DataFrame, path: str, split: str = "split", fmt: str = "parquet", mode: str = "overwrite") -> None:
    """K2: rows routed to a folder per split: ``test`` -> test, everything else -> train."""
    routed = df.withColumn("dir", F.when(F.col(split) == "test", F.lit("test")).otherwise(F.lit("train")))
    if fmt == "csv":
        routed = _csv_ready(routed)
    w = routed.write.mode(mode).partitionBy("dir")
    if fmt == "csv":
        w = _csv_writer(w)
    w.format(fmt).save(path)


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write into ``path`` has ended (its marker is there)."""
    fs, marker = _file(spark, f"{path.rstrip('/')}/_SUCCESS")
    return fs.exists(marker)


def ingest_once(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K4: write only if no ended write is there yet (a second call leaves the first write); what a write
    that did not end has left is replaced."""
    if not is_complete(df.sparkSession, path):
        df.write.mode("overwrite").format(fmt).save(path)


FILE_SCHEMA = "path string, length bigint, modificationTime timestamp"


def ingest_new(spark: SparkSession, source: str, target: str, read: Callable[[list[str]], DataFrame]) -> int:
    """K4 for a growing folder: reads the files of ``source`` that no earlier call has ingested (by path, length and time)
    and adds them to ``target``; returns how many. ``read``: paths -> DataFrame.

    Rows and the list of their files go to a staging folder, and one rename of that folder commits both. A call that is lost
    before it leaves nothing that is read (``read_ingested``), and the next one takes the same files."""
    files = spark.read.format("binaryFile").load(source).select("path", "length", "modificationTime")  # contents are not read
    fs, batches = _file(spark, f"{target.rstrip('/')}/batches")
    if fs.exists(batches):
        known = spark.read.schema(FILE_SCHEMA).parquet(f"{batches}/*/files")
        files = files.join(known, ["path", "length", "modificationTime"], "left_anti")
    new = files.collect()  # names, as many as Spark lists on the driver anyway
    if not new:
        return 0
    name = uuid.uuid4().hex
    staging = f"{target.rstrip('/')}/staging/{name}"
    read([r["path"] for r in new]).write.parquet(f"{staging}/rows")
    spark.createDataFrame(new, FILE_SCHEMA).coalesce(1).write.parquet(f"{staging}/files")
    fs.mkdirs(batches)
    if not fs.rename(_file(spark, staging)[1], _file(spark, f"{batches}/{name}")[1]):
        raise OSError(f"{staging} was not committed")
    return len(new)


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """All rows that ``ingest_new`` has committed to ``target``."""
    return spark.read.parquet(f"{target.rstrip('/')}/batches/*/rows")


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType, header: str | None = None, encoding: str = "UTF-8",
                      **options) -> tuple[DataFrame, DataFrame]:
    """S1 / S2 with a quarantine, for files with a row per line: (rows, rejects). A line that does not fit ``schema`` (a value of
    another type, too few or too many fields) is no row with NULLs but a reject: ``file``, ``line`` (its text) and ``parsed`` (what could
    be read of it). ``header``: the text of a header line, left out wherever it stands. Options as for CSV."""
    wide = T.StructType([*schema.fields, T.StructField("_reject", T.StringType())])
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.decode(F.col("value").cast("binary"), encoding).alias("line"))
    lines = text.where((F.btrim("line") != "") & ((F.col("line") != header) if header else F.lit(True)))
    settings = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_reject", **options}
    parsed = lines.select("file", "line", F.from_csv("line", F.lit(wide.toDDL()), settings).alias("r"))
    fields = [F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields]
    rejects = parsed.where(F.col("r._reject").isNotNull()).select("file", "line", F.struct(*fields).alias("parsed"))
    return parsed.where(F.col("r._reject").isNull()).select(*fields), rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(file, n): rejected lines per file."""
    return rejects.groupBy("file").agg(F.count(F.lit(1)).alias("n"))


def write_images_by_split(images: DataFrame, splits: DataFrame, path: str, name: str = "image_name",
                          unlisted: str = "unlisted") -> None:
    """K5: each image's bytes into its split's folder. ``splits`` is the manifest ``(image_name,
    split)``, broadcast when its measured size allows, so the bytes stay where they are; images it
    does not list go to a folder of their own."""
    named = images.withColumn(name, F.element_at(F.split("path", "/"), -1))
    side = checked_broadcast(splits.select(name, "split"), materialize=False)
    out = named.join(side, name, "left").withColumn("split", F.coalesce("split", F.lit(unlisted)))
    out.write.mode("overwrite").partitionBy("split").parquet(path)
