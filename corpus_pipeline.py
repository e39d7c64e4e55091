"""Corpus pipeline: toxic documents out, one document per near-duplicate group, repeated passages cut, benchmark leaks out,
then token ids.

A stage is ``f(spark, docs, sf_dir) -> DataFrame`` on rows like those of ``documents``; ``run`` writes each result to the
shared folder as Parquet and reads it back as the next stage's input. All stages but the last return the columns of
``documents``, in its order; columns they do not need pass through.

Defined cases. A null or empty text is not toxic, not a duplicate, not contaminated, and encodes to no ids. A row with a
null doc_id is never linked or cut, and stays unless it is toxic. Of equal rows that share a doc_id one stays from the
near-duplicate stage on; rows that share a doc_id but differ are documents of their own, kept or dropped by their texts. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge.llm import toxicity
from tasteforge.llm.bpe import round_trip
from tasteforge.llm.decontaminate import contaminated_documents
from tasteforge.llm.neardup import MinHash, near_duplicates
from tasteforge.llm.queries import table, vocabulary
from tasteforge.llm.substrings import remove_repeated
from tasteforge.operators.ordering import number_rows
from tasteforge.session import materialize

#: Documents from this score on are rejected; it is that of ``op10_toxicity``.
TOXIC_FROM = toxicity.TOXIC_FROM


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on a bounded sample of the labelled ones, scores below ``TOXIC_FROM``."""
    cfg = toxicity.Network()
    # In a task: what training holds would else stay in the driver's process for the stages that follow.
    model = toxicity.train_in_task(toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), cfg), cfg)
    scored = toxicity.score_documents(docs, model, cfg, score="__toxicity", keep_text=True)
    return scored.where(F.col("__toxicity") < TOXIC_FROM).select(*[f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group linked on five-word shingles at a similarity of 0.8."""
    nodes = _with_nodes(docs)
    found = near_duplicates(nodes.select("__node", "text"), MinHash(shingle=5), doc_id="__node")
    extra = found.where("doc_id is not null and not kept").select(F.col("doc_id").alias("__node")).distinct()
    extra = materialize(extra, "near-duplicates")
    return nodes.join(extra, "__node", "left_anti").select(*[f"`{c}`" for c in docs.columns])


def _with_nodes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__node``: the doc_id, or, for all but one of different rows that share a doc_id, a number above all ids.

    Equal rows that share a doc_id become one.
    """
    code = F.xxhash64(*[f"`{c}`" for c in docs.columns])
    named = docs.where("doc_id is not null")
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(code).alias("h")).where("n > 1")
    repeated = materialize(repeated.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h")), "repeated-ids")
    own = F.col("doc_id").cast("long").alias("__node")
    if repeated.isEmpty():
        return docs.select("*", own)
    once = docs.join(repeated, F.col("doc_id") == F.col("__id"), "left_anti").select("*", own)
    again = docs.join(repeated, F.col("doc_id") == F.col("__id")).select(docs["*"], code.alias("__code"), "__h").distinct()
    again = materialize(again, "repeated-rows")
    others, _ = number_rows(again.where("__code <> __h").select("doc_id", "__code"), ["doc_id", "__code"], "__place")
    above = int(named.agg(F.max("doc_id")).first()[0]) + 1
    others = others.select("doc_id", "__code", (F.col("__place") + above).alias("__other"))
    placed = again.join(others, ["doc_id", "__code"], "left").withColumn("__node", F.coalesce("__other", own))
    return once.union(placed.select(*[f"`{c}`" for c in docs.columns], "__node"))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 20-word windows that start earlier in the corpus; documents made of such words only go."""
    done = remove_repeated(docs.select(*[f"`{c}`" for c in docs.columns]))
    left = done.where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") == 0, F.col("text")).otherwise(F.col("kept"))
    changed = left.withColumn("text", text).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*[f"`{c}`" for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, in its own words or with other slot values."""
    found = contaminated_documents(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    found = materialize(found.select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag")), "contaminated")
    tag = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(found, (F.col("doc_id") == F.col("__id")) & (tag == F.col("__tag")), "left_anti")


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, packed ids and the text that they decode to."""
    done = round_trip(docs, vocabulary())
    return done.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("bpe", encode_and_decode),
]

#: No stage but a join of stored results can be said in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
