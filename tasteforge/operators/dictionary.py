"""Dense id dictionaries: ids to 0-based indices, most frequent first, ties by id.

The numbering is that of a frequency-ordered string indexer, but the labels stay in a table: they
never pass through the driver and no closure carries them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteforge.session import materialize

# A dictionary is broadcast only within both bounds, by its own row count and bytes. Indices are frequency ranks, so
# "index < n" names the n most frequent ids, whatever the data; of a large dictionary those are broadcast, but for labels
# longer than HEAD_LABEL, which bounds the bytes of that head.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32
HEAD_LABEL = 256

# monotonically_increasing_id: partition number above bit 33, row number within it below.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


@dataclass(frozen=True)
class IdDictionary:
    """``frame`` has (label string, frequency bigint, index bigint).

    ``size`` is its row count and ``label_bytes`` the bytes of all its labels.
    """

    frame: DataFrame
    size: int
    label_bytes: int

    def fits(self, broadcast_rows: int = BROADCAST_ROWS) -> bool:
        """Whether the whole dictionary may be broadcast."""
        return self.size <= broadcast_rows and self.label_bytes + ROW_BYTES * self.size <= BROADCAST_BYTES

    def encode(
        self, df: DataFrame, id_col: str, index_col: str, broadcast_rows: int = BROADCAST_ROWS, stored: bool = False
    ) -> DataFrame:
        """Add ``index_col``. Rows whose id is unseen or NULL are dropped. A ``stored`` table is not stored once more."""
        entries = self.frame.select(F.col("label").alias("_key"), F.col("index").alias(index_col))
        if not (stored or self.fits(broadcast_rows)):
            df = materialize(df, "lookup")
        keyed = df.withColumn("_key", F.col(id_col).cast("string"))
        return self._lookup(keyed, entries, F.col(index_col), "_key", broadcast_rows)

    def decode(
        self, df: DataFrame, index_col: str, id_col: str, broadcast_rows: int = BROADCAST_ROWS
    ) -> DataFrame:
        """Add ``id_col``, the label of each index."""
        entries = self.frame.select(
            F.col("index").alias("_key"), F.col("label").alias(id_col), F.col("index").alias("_order")
        )
        if not self.fits(broadcast_rows):
            df = materialize(df, "lookup")
        keyed = df.withColumn("_key", F.col(index_col).cast("bigint"))
        return self._lookup(keyed, entries, F.col("_order"), id_col, broadcast_rows).drop("_order")

    def _lookup(self, keyed: DataFrame, entries: DataFrame, order, label: str, broadcast_rows: int) -> DataFrame:
        """Inner join on ``_key`` that no frequent key can skew.

        A dictionary that ``fits`` is broadcast. Of a larger one only the most frequent ids are, which
        takes the heavy keys out of the shuffle; a key that is left over can hold no more than
        1/broadcast_rows of the rows the dictionary was fit on. Rows with other frequencies, as top-k lists
        have, are left to the run-time skew split: both sides of that join are bare exchanges. The large
        case reads its input twice, so the callers store it first.
        """
        if self.fits(broadcast_rows):
            return keyed.join(F.broadcast(entries), "_key").drop("_key")
        in_head = (order < broadcast_rows) & (F.octet_length(F.col(label)) <= HEAD_LABEL)
        head, tail = F.broadcast(entries.where(in_head)), entries.where(~in_head)
        frequent = keyed.join(head, "_key")
        rare = keyed.join(head.select("_key"), "_key", "left_anti").join(tail, "_key")
        return frequent.unionByName(rare).drop("_key")


def _label_bytes():
    return F.coalesce(F.sum(F.octet_length("label").cast("bigint")), F.lit(0).cast("bigint")).alias("label_bytes")


def fit_dictionary(df: DataFrame, id_col: str) -> IdDictionary:
    """Count, rank and number the ids of ``id_col`` (runs jobs).

    Ids are counted with a map-side combine, range-sorted by (frequency, id) and numbered within
    their partition. The numbered table is stored; a partition's first index is the number of
    rows in the partitions before it, which takes one count per sort partition on the driver.
    """
    ids = df.select(F.col(id_col).cast("string").alias("label")).where(F.col("label").isNotNull())
    counted = ids.groupBy("label").agg(F.count(F.lit(1)).alias("frequency"))
    ranked = counted.orderBy(F.col("frequency").desc(), F.col("label").asc())
    stored = materialize(ranked.withColumn("_place", F.monotonically_increasing_id()), "id-order")

    run = F.shiftright("_place", _ROW_BITS).cast("int")
    runs = stored.groupBy(run.alias("run")).agg(F.count(F.lit(1)).alias("rows"), _label_bytes()).collect()
    rows = {r["run"]: r["rows"] for r in runs}
    starts, size = [], 0
    for number in range(max(rows, default=-1) + 1):
        starts.append(size)
        size += rows.get(number, 0)

    first = F.get(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), run)
    index = first + F.col("_place").bitwiseAND(F.lit(_ROW_MASK))
    frame = stored.select("label", "frequency", index.alias("index"))
    return IdDictionary(frame, size, sum(r["label_bytes"] for r in runs))


_FACTS = "size BIGINT, label_bytes BIGINT"


def save_dictionary(dictionary: IdDictionary, path: str) -> None:
    """Write the dictionary, and its size in the same folder, where readers of the table do not look."""
    dictionary.frame.write.mode("overwrite").parquet(path)
    facts = dictionary.frame.sparkSession.createDataFrame([(dictionary.size, dictionary.label_bytes)], _FACTS)
    facts.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_facts")


def load_dictionary(spark: SparkSession, path: str) -> IdDictionary:
    """The stored dictionary. Its labels are scanned only if its size was not stored with it."""
    frame = spark.read.schema("label STRING, frequency BIGINT, index BIGINT").parquet(path)
    try:
        facts = spark.read.schema(_FACTS).json(f"{path.rstrip('/')}/_facts/part-*").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        facts = frame.agg(F.count(F.lit(1)).alias("size"), _label_bytes()).first()
    return IdDictionary(frame, facts["size"], facts["label_bytes"])
