"""Landed JSON documents (bronze).

Two layouts are read. "dated" is ``{base}/raw/{dataset}/{YYYY-MM-DD}/*.json`` with one pretty-printed
object per file. "hive" is ``{base}/raw/{dataset}/ingest_date=.../`` with one object per line,
which splits, prunes by day and does not need a file per entity; ``write_documents`` lands this one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import batched, chain

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tasteforge.functions.parsing import id_token, utc_day
from tasteforge.operators.latest import latest_per_key
from tasteforge.session import intermediate_path, materialize

CORRUPT = "_corrupt_record"
SOURCE = "source_file"
DAY = "ingest_date"
OUTCOME = "outcome"
LINES = "*.{json,txt}"

# One-document files that a scan lists and plans at once. The driver holds a kilobyte or two of each.
FILES_AT_ONCE = 20_000


def _dated_files(spark: SparkSession, root: str, day: str | None) -> Iterator[str]:
    """Paths of the files in the day folders, one after the other; a path that is a pattern itself is escaped."""
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    folders = Path(f"{root}/{day or '*'}")
    store = folders.getFileSystem(spark._jsc.hadoopConfiguration())
    plain = lambda path: re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
    for status in store.globStatus(folders) or ():
        folder = status.getPath()
        if not status.isDirectory():
            yield plain(folder.toString())
            continue
        if folder.toUri().getScheme() == "file":
            # Hadoop lists a local folder as a whole, with all checksum files.
            with os.scandir(folder.toUri().getPath()) as found:
                entries = ((e.name, e.is_dir()) for e in found if e.name[0] != ".")
                yield from (plain(f"{folder.toString()}/{name}") for name, is_folder in entries if not is_folder)
            continue
        entries = store.listStatusIterator(folder)
        while entries.hasNext():
            entry = entries.next()
            if not entry.isDirectory():
                yield plain(entry.getPath().toString())


def _stored_in_parts(
    spark: SparkSession, root: str, day: str | None, files: str, read: Callable[[DataFrameReader, list[str]], DataFrame]
) -> DataFrame | None:
    """What ``read`` makes of the dated files, stored, if they are more than ``FILES_AT_ONCE``; else None (runs jobs).

    A scan keeps every file's status and place in a task on the driver, for as long as its DataFrame lives, and a file
    is charged like four megabytes, so tasks hold a few of them. Here the driver knows one part of the files at a time, and
    a task reads many.
    """
    parts = batched(_dated_files(spark, root, day), FILES_AT_ONCE)
    first, second = next(parts, None), next(parts, None)
    if second is None:
        return None
    session = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    slots = spark.sparkContext.defaultParallelism
    for name, value in (
        ("spark.sql.files.openCostInBytes", 64 << 10),
        ("spark.sql.files.minPartitionNum", 4 * slots),
        ("spark.sql.sources.parallelPartitionDiscovery.parallelism", 2 * slots),
        ("spark.sql.hive.filesourcePartitionFileCacheSize", 0),
    ):
        session.conf.set(name, value)
    path = intermediate_path(spark, "scanned")
    for part in chain((first, second), parts):
        docs = read(session.read.option("pathGlobFilter", files), list(part))
        docs.write.mode("append").parquet(path)
    return spark.read.schema(docs.schema).parquet(path)


def scan_documents(
    spark: SparkSession,
    base_path: str,
    dataset: str,
    schema: str,
    layout: str = "dated",
    day: str | None = None,
    files: str | None = None,
) -> DataFrame | None:
    """Documents with their day, source file and corrupt text; None when the dataset is not there.

    ``day`` (YYYY-MM-DD) reads that day's folder only; ``files`` is a pattern for file names (json, and text files of lines
    in the hive layout). More than ``FILES_AT_ONCE`` files of the dated layout are parsed and stored here, in parts. Any failure
    other than a missing path is raised.
    """
    files = files or ("*.json" if layout == "dated" else LINES)
    root = f"{base_path.rstrip('/')}/raw/{dataset}"

    def read(reader: DataFrameReader, paths: str | list[str]) -> DataFrame:
        parsing = reader.schema(f"{schema}, {CORRUPT} STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        if layout != "dated":
            return parsing.json(paths).withColumn(SOURCE, F.col("_metadata.file_path"))
        return parsing.option("multiLine", True).json(paths).withColumns({DAY: _day_of_path(), SOURCE: F.col("_metadata.file_path")})

    reader = spark.read.option("pathGlobFilter", files)
    try:
        if layout == "dated":
            stored = _stored_in_parts(spark, root, day, files, read)
            return stored if stored is not None else read(reader, f"{root}/{day or '*'}")
        docs = read(reader, root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return docs if day is None else docs.where(F.col(DAY) == F.lit(day).cast("date"))


def _day_of_path() -> Column:
    return F.regexp_extract("_metadata.file_path", r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1).try_cast("date")


def scan_or_empty(
    spark: SparkSession, base_path: str, dataset: str, schema: str, layout: str = "dated", day: str | None = None, files: str | None = None
) -> DataFrame:
    """Like ``scan_documents``, but a dataset that is not there gives no rows, with the columns and types of one that is."""
    docs = scan_documents(spark, base_path, dataset, schema, layout, day, files)
    return docs if docs is not None else spark.createDataFrame([], f"{schema}, {CORRUPT} STRING, {DAY} DATE, {SOURCE} STRING")



def store_outcomes(docs: DataFrame, *measures: Column) -> tuple[DataFrame, dict]:
    """Scanned documents parsed once and stored by outcome (``whole``, ``partial`` or ``lost``), with the measures (runs a job).

    What reads the documents and what reads the rejects each open their own partition, so neither parses JSON again and a
    clean dataset has no second output at all. The text of a document is stored only where it was flagged.
    """
    outcome = F.when(_lost(docs), "lost").when(F.col(CORRUPT).isNotNull(), "partial").otherwise("whole")
    seen = Observation("documents")
    path = intermediate_path(docs.sparkSession, "outcomes")
    docs.observe(seen, *measures).withColumn(OUTCOME, outcome).write.partitionBy(OUTCOME).parquet(path)
    schema = T.StructType([*docs.schema.fields, T.StructField(OUTCOME, T.StringType())])
    return docs.sparkSession.read.schema(schema).parquet(path), seen.get


def _fields(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in (CORRUPT, SOURCE, DAY, OUTCOME)]


def _lost(docs: DataFrame) -> Column:
    """The text is no JSON object: the parser flagged it and found nothing in it."""
    nothing = F.lit(True)
    for name in _fields(docs):
        nothing = nothing & F.col(name).isNull()
    return F.col(CORRUPT).isNotNull() & nothing


def readable(docs: DataFrame) -> DataFrame:
    """Every document that is JSON.

    The parser also flags a well-formed document for one value of another kind; what it could read is kept then, and
    only that value is NULL.
    """
    return docs.where(~_lost(docs)).drop(CORRUPT)


def _loose(kind: T.DataType) -> T.DataType:
    """``kind`` with text for every leaf and for every array element."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind.fields])
    return T.ArrayType(T.StringType()) if isinstance(kind, T.ArrayType) else T.StringType()


def _tighten(value: Column, kind: T.DataType) -> Column:
    """A value read as ``_loose(kind)`` as ``kind``: elements that are no objects (or arrays) where those belong are dropped."""
    if isinstance(kind, T.StructType):
        fields = [_tighten(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if not isinstance(kind, T.ArrayType):
        return value if isinstance(kind, T.StringType) else value.try_cast(kind)
    inner = kind.elementType
    if not isinstance(inner, (T.StructType, T.ArrayType)):
        return F.transform(value, lambda e: _tighten(e, inner))
    opens = "{" if isinstance(inner, T.StructType) else "["
    fitting = F.filter(value, lambda e: F.startswith(F.ltrim(e), F.lit(opens)))
    return F.transform(fitting, lambda e: _tighten(F.from_json(e, _loose(inner)), inner))


def rescue(docs: DataFrame, schema: str) -> DataFrame:
    """Read flagged documents again, array element by array element, at any depth of ``schema``.

    The parser gives a whole array up for one element of another kind. Here such an element is dropped and its neighbours
    stay, also in arrays inside objects and inside other arrays' elements. Documents that were not flagged are left alone.
    """
    kind = T.StructType.fromDDL(schema)
    again = F.from_json(CORRUPT, _loose(kind))
    return docs.withColumns(
        {
            f.name: F.when(F.col(CORRUPT).isNull(), F.col(f.name)).otherwise(_tighten(again.getField(f.name), f.dataType))
            for f in kind.fields
        }
    )


def document_counts(docs: DataFrame, stamp: str = "ingested_at") -> list[Column]:
    """Aggregates over scanned documents: how many there are, are lost, are read in part, and have no stamp."""
    lost = _lost(docs)
    return [
        F.count(F.lit(1)).alias("documents"),
        F.count_if(lost).alias("corrupt"),
        F.count_if(~lost & F.col(CORRUPT).isNotNull()).alias("partial"),
        F.count_if(~lost & F.col(stamp).isNull()).alias("unstamped"),
    ]


def corrupt_report(docs: DataFrame, stamp: str = "ingested_at") -> DataFrame:
    """One row with ``document_counts``. All fields are read, as a value of another kind shows only where it is read."""
    return docs.agg(*document_counts(docs, stamp))


def rejected(docs: DataFrame) -> DataFrame:
    """(source_file, ingest_date, reason, text) of documents that are lost or were read in part."""
    reason = F.when(_lost(docs), "not JSON").otherwise("value of another kind")
    flagged = docs.where(F.col(CORRUPT).isNotNull())
    return flagged.select(SOURCE, DAY, reason.alias("reason"), F.col(CORRUPT).alias("text"))


def write_documents(docs: DataFrame, base_path: str, dataset: str, day: Column | None = None) -> None:
    """Append documents under their ingest day.

    A rerun on the same day appends a newer snapshot; the reader's latest-per-key makes it replace
    the older one, so no file is ever rewritten.
    """
    stamped = docs.withColumn(DAY, utc_day(F.col("ingested_at")) if day is None else day)
    stamped.write.partitionBy(DAY).mode("append").json(f"{base_path.rstrip('/')}/raw/{dataset}")


def _keyed(texts: DataFrame, key: str) -> DataFrame:
    """Document texts (text, day, source) as lines, with their key and stamp.

    A line break in JSON is white space between tokens, so joining lines loses nothing. Texts are kept as they are, with
    fields that no schema here knows.
    """
    line = F.regexp_replace("text", r"[\r\n]+", " ")
    return texts.select(
        line.alias("value"),
        DAY,
        SOURCE,
        id_token(F.get_json_object("text", f"$.{key}")).alias("_key"),
        F.get_json_object("text", "$.ingested_at").alias("_stamp"),
    )


def _packed(known: DataFrame) -> DataFrame:
    """Of stored lines with keys, the latest of each day and key; those without a key all stay."""
    latest = latest_per_key(known.where("_key is not null"), [DAY, "_key"], "_stamp", [SOURCE, "value"])
    return latest.union(known.where("_key is null")).select("value", DAY)


def compact_documents(
    spark: SparkSession, base_path: str, dataset: str, key: str, out_base: str, day: str | None = None, files: str = "*.json"
) -> bool:
    """Pack the dated layout, one file per document, into the hive layout under ``out_base``; False if nothing landed.

    A day (or every day) becomes a few files of one document a line that list, split and prune well. Of several
    documents of a key on one day the latest stays, which is the one that latest-per-key would read. Texts that are
    not JSON are kept. Days that are packed again are replaced.
    """
    root = f"{base_path.rstrip('/')}/raw/{dataset}"

    def read(reader: DataFrameReader, paths: str | list[str]) -> DataFrame:
        texts = reader.text(paths, wholetext=True)
        return _keyed(texts.select(F.col("value").alias("text"), _day_of_path().alias(DAY), F.col("_metadata.file_path").alias(SOURCE)), key)

    known = _stored_in_parts(spark, root, day, files, read)
    try:
        if known is None:
            known = read(spark.read.option("pathGlobFilter", files), f"{root}/{day or '*'}")
            known = materialize(known, "document-lines")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    _replace_days(_packed(known), out_base, dataset)
    return True


def rewrite_documents(spark: SparkSession, base_path: str, dataset: str, key: str, day: str | None = None, files: str = LINES) -> bool:
    """Rewrite a day of the hive layout (or every day) to its latest document per key; False if nothing landed.

    Reruns append newer snapshots; without this a day grows with every one. The lines are stored before the day is
    replaced, and other days are not touched.
    """
    root = f"{base_path.rstrip('/')}/raw/{dataset}"
    try:
        lines = spark.read.option("pathGlobFilter", files).schema(f"value STRING, {DAY} DATE").text(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    if day is not None:
        lines = lines.where(F.col(DAY) == F.lit(day).cast("date"))
    texts = lines.select(F.col("value").alias("text"), DAY, F.col("_metadata.file_path").alias(SOURCE))
    kept = materialize(_packed(materialize(_keyed(texts, key), "document-lines")), "rewritten")
    _replace_days(kept, base_path, dataset)
    return True


def _replace_days(lines: DataFrame, base_path: str, dataset: str) -> None:
    # Rebalanced by day: a large day is split into files of the advisory size, small days are not scattered.
    writer = lines.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY)
    writer.option("partitionOverwriteMode", "dynamic").text(f"{base_path.rstrip('/')}/raw/{dataset}")


def on_day(df: DataFrame, stamp: str, day: str) -> DataFrame:
    """Rows of one day, as a half-open range on the stored column so that the scan can skip row groups."""
    kind = df.schema[stamp].dataType
    start = F.lit(day).cast("date")
    return df.where((F.col(stamp) >= start.cast(kind)) & (F.col(stamp) < F.date_add(start, 1).cast(kind)))
