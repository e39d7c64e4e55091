"""Mixing sources to target weights: how many words of each document a training mix takes.

Every document gets a hash-random key. Documents are range-sorted by (source, key), so a source with a third of all rows
is spread over many sort partitions; prefix sums of their sizes are running sums inside a partition plus the totals of the
partitions before it. A source is read through as often as its budget holds it whole, and the last, partial epoch is cut
at the exact word.

Budgets come from water filling: sources share the mix by weight, none gets more than ``most`` times its size, and what is
cut off goes to the others by weight. Capped sources are those with the smallest size per weight, so the level is found
from prefix sums over sources in that order, in whole numbers, however many sources there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteforge.session import materialize

WORD = r"[^\x20\x09-\x0D]+"

# monotonically_increasing_id: partition number above bit 33, row number within it below.
_ROW_BITS = 33
_WHOLE = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """``weights`` go round over the sources in order; the mix is ``share`` (a fraction) of all words; no source is taken
    more than ``most`` times."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: tuple[int, int] = (3, 2)
    most: int = 2


def word_count(text: Column) -> Column:
    """Words of a text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _placed(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` sorted, stored, with ``run`` (its sort partition) and ``place`` (its position, growing over all runs)."""
    stored = materialize(df.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), name)
    return stored.withColumn("run", F.shiftright("place", _ROW_BITS).cast("int"))


def _running(placed: DataFrame, sums: dict[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Add each column of ``sums`` summed over the rows of the same ``keys`` up to and with this one.

    ``run`` is one of the grouping columns of both windows' inputs, so no group holds more than one sort partition, or one
    row for each of them.
    """
    inside = Window.partitionBy("run", *keys).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("run", *keys).agg(*[F.sum(c).alias(f"_{out}") for c, out in sums.items()])
    before = totals.select(
        "run", *keys, *[F.coalesce(F.sum(f"_{out}").over(earlier), F.lit(0)).alias(f"_{out}") for out in sums.values()]
    )
    rows = placed.withColumns({out: F.sum(c).over(inside) for c, out in sums.items()}).join(before, ["run", *keys])
    return rows.withColumns({out: F.col(out) + F.col(f"_{out}") for out in sums.values()}).drop(*[f"_{o}" for o in sums.values()])


def source_targets(sizes: DataFrame, cfg: Mix = Mix()) -> DataFrame:
    """(no_source, source, source_size, weight, target double, budget bigint) for ``sizes`` (no_source, source, source_size).

    The budget is the target rounded to whole words. A source without words has target 0.
    """
    places = _placed(sizes, ["no_source", "source"], "mix-sources")
    one = places.withColumn("one", F.lit(1).cast("bigint"))
    weights, turn = F.array(*[F.lit(w).cast("bigint") for w in cfg.weights]), (F.col("number") - 1) % len(cfg.weights)
    number = _running(one, {"one": "number"}).withColumn("weight", F.get(weights, turn.cast("int")))
    unit, (num, den) = lcm(*cfg.weights), cfg.share
    caps = number.select(
        "no_source", "source", "source_size", "weight",
        (F.col("source_size") * cfg.most).cast(_WHOLE).alias("cap"),
        # The level at which a source is full, in units that keep it whole.
        F.expr(f"cast(source_size * {cfg.most} * ({unit} div weight) as {_WHOLE})").alias("level"),
    )
    filled = _running(
        _placed(caps, ["level", "no_source", "source"], "mix-levels"), {"cap": "caps", "weight": "weights"}
    )
    filled = materialize(filled, "mix-filled")
    total = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, weight = int(total["words"] or 0), int(total["weight"] or 0)
    # With every fuller source at its cap and the rest at this level, the mix does not pass its size.
    need = F.col("caps") * (den * unit) + F.col("level") * (F.lit(weight) - F.col("weights")).cast(_WHOLE) * den
    filled = filled.withColumn("full", need.cast(_WHOLE) <= F.lit(words * num * unit).cast(_WHOLE))
    rest = filled.agg(
        F.sum(F.when(F.col("full"), F.col("cap"))).alias("caps"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight")
    ).first()
    left, open_weight = num * words - den * int(rest["caps"] or 0), den * int(rest["weight"] or 0)
    share = (F.lit(left).cast(_WHOLE) * F.col("weight")).cast("double") / F.lit(float(open_weight or 1))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share)
    budget = F.floor(target + 0.5).cast("bigint")
    return filled.select("no_source", "source", "source_size", "weight", target.alias("target"), budget.alias("budget"))


def mix_sources(
    docs: DataFrame,
    cfg: Mix = Mix(),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, and ``carry``) for every row of ``docs``.

    ``taken`` counts the words that the mix takes, with repeats: all of a document once for each whole epoch of its source,
    and in the last epoch all, the first words, or none of it. The taken words of a source sum to its target, rounded.

    Defined cases. A null or empty text has size 0 and is taken 0 times. A null source is a source of its own, after all
    others. Rows that repeat a doc_id, or have none, are documents of their own; equal rows differ at most in which of
    them is cut. The order depends on doc_id and size only, so reruns and other file layouts give the same rows. An empty
    table gives an empty result. Columns other than the named ones take no part unless carried.
    """
    names = ["doc_id", "source", "size", "source_size", "target", "taken"]
    clash = set(carry) & {*names, "no_source", "_source", "key", "row", "place", "run", "upto", "budget"}
    if clash:
        raise ValueError(f"columns to carry need other names: {sorted(clash)}")
    ids = F.col(f"`{doc_id}`")
    narrow = docs.select(
        ids.alias("doc_id"),
        F.col(f"`{source}`").isNull().alias("no_source"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("_source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        F.md5(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")).alias("key"),
        *[F.col(f"`{c}`") for c in carry],
    )
    # Stored: texts are read once, not again for the sample that the range sort takes.
    narrow = materialize(narrow.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    sizes = narrow.groupBy("no_source", F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    keys = ("no_source", "_source")
    plan = source_targets(sizes, cfg).withColumnRenamed("source", "_source").select(*keys, "source_size", "target", "budget")
    placed = _placed(narrow, [*keys, "key", "doc_id", "size", "row"], "mix-order")
    upto = _running(placed, {"size": "upto"}, keys).join(plan, list(keys))
    size, whole = F.col("source_size"), F.expr("if(source_size = 0, 0, budget div source_size)")
    cut = F.col("budget") - whole * size
    part = F.least(F.col("size"), F.greatest(F.lit(0).cast("bigint"), cut - (F.col("upto") - F.col("size"))))
    return upto.select(
        "doc_id",
        F.when(~F.col("no_source"), F.col("_source")).alias("source"),
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + part).cast("bigint").alias("taken"),
        *[F.col(f"`{c}`") for c in carry],
    )


def mixed_texts(mix: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, source, epoch, words, text): the mix itself, one row per document and epoch that takes any of it.

    ``mix`` comes from ``mix_sources`` with the text carried. A document that is cut gives its first words, joined by one
    space; whole ones keep their text as it is. Texts without words are in no epoch.
    """
    size = F.col("size")
    epochs = F.expr("sequence(1L, (taken + size - 1) div size)")
    rows = mix.where("taken > 0").select("*", F.explode(epochs).alias("epoch"))
    words = F.least(size, F.col("taken") - (F.col("epoch") - 1) * size)
    all_words = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), 0)
    first = F.array_join(F.slice(all_words, F.lit(1), words.cast("int")), " ")
    part = F.when(words == size, F.col(f"`{text}`")).otherwise(first)
    return rows.select("doc_id", "source", "epoch", words.alias("words"), part.alias("text"))
