"""An index of the ids that are stored, asked before any of them is read."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidewire.session import ensure_checkpoint_dir, folder_exists

#: Bits of one block of a filter, which is one row of 4 KB.
BLOCK_BITS = 32_768
BLOCK_WORDS = BLOCK_BITS // 64

FILTER = StructType([
    StructField("blocks", IntegerType(), False),
    StructField("block", IntegerType(), False),
    StructField("words", ArrayType(LongType()), False),
    StructField("segment", StringType(), True),
])


class SeenIds:
    """Which ids are stored, batch by batch.

    Each batch is a segment: its ids in ``buckets`` files by hash, and beside them a Bloom filter of
    ``bits_each`` bits an id, cut into blocks so that an id asks one row of 4 KB. A lookup tests the
    filters first and then reads only the files, one of a segment's buckets each, that a filter
    names; what it finds there is compared exactly. So ids that are new read next to nothing, and
    ids delivered again read the segments they came in. An overwritten segment replaces itself.
    """

    def __init__(self, path: str, id: str = "event_id", *, buckets: int = 16, bits_each: int = 24,
                 probes: int = 8):
        self.path, self.id = path.rstrip("/"), id
        self.buckets, self.bits_each, self.probes = buckets, bits_each, probes
        #: Folders of ids that the last lookup read.
        self.read: list[str] = []

    def _hashed(self, ids: DataFrame) -> DataFrame:
        """Distinct ids with two hashes and the bucket of each."""
        known = ids.select(self.id).filter(F.col(self.id).isNotNull()).distinct()
        return known.withColumns({"_h": F.xxhash64(self.id), "_g": F.xxhash64(self.id, F.lit(1))}
                                 ).withColumn("_bucket", F.pmod(
                                     F.shiftright("_h", 40), F.lit(self.buckets)).cast("int"))

    def _places(self) -> list[Column]:
        """The bits of an id in its block."""
        begin, step = F.pmod("_g", F.lit(BLOCK_BITS)), F.pmod(F.shiftright("_g", 20),
                                                            F.lit(BLOCK_BITS // 2)) * 2 + 1
        return [((begin + probe * step) % BLOCK_BITS).cast("int") for probe in range(self.probes)]

    def _held(self) -> Column:
        """Whether the words of a block have all bits of an id; the first that is missing decides."""
        return reduce(and_, [F.getbit(F.get("words", F.shiftright(place, 6)),
                                      place.bitwiseAND(63)) == 1 for place in self._places()])

    def add(self, ids: DataFrame, segment: str) -> None:
        """Store the ids of a batch. The segment can be looked up once its filter is written, last."""
        spark = ids.sparkSession
        ensure_checkpoint_dir(spark)
        hashed = self._hashed(ids).checkpoint()
        count = hashed.count()
        if not count:
            return
        blocks = 1 << (-(-count * self.bits_each // BLOCK_BITS) - 1).bit_length()
        (hashed.select(self.id, F.col("_bucket").alias("bucket")).repartition("bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/ids/segment={segment}"))
        bits = hashed.select(F.pmod("_h", F.lit(blocks)).cast("int").alias("block"),
                             F.explode(F.array(*self._places())).alias("place")).select(
            "block", F.shiftright("place", 6).alias("word"),
            F.expr("shiftleft(1L, place & 63)").alias("bits"))
        # every word of every block, so that a block's words only have to be put in order
        empty = spark.range(blocks * BLOCK_WORDS).select(
            F.floor(F.col("id") / BLOCK_WORDS).cast("int").alias("block"),
            (F.col("id") % BLOCK_WORDS).cast("int").alias("word"),
            F.lit(0).cast("long").alias("bits"))
        words = bits.unionByName(empty).groupBy("block", "word").agg(
            F.bit_or("bits").alias("bits"))
        held = words.groupBy("block").agg(
            F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("held"))
        held.select(F.lit(blocks).alias("blocks"), "block", F.col("held.bits").alias("words")
                    ).write.mode("overwrite").parquet(f"{self.path}/filters/segment={segment}")

    def _filters(self, spark: SparkSession, but: str | None) -> DataFrame | None:
        if not folder_exists(spark, f"{self.path}/filters"):
            return None
        filters = spark.read.schema(FILTER).parquet(f"{self.path}/filters")
        return filters if but is None else filters.filter(F.col("segment") != but)

    def seen(self, ids: DataFrame, but: str | None = None) -> DataFrame:
        """Those of some ids, distinct, that a segment other than ``but`` holds."""
        spark = ids.sparkSession
        hashed = self._hashed(ids)
        filters, self.read = self._filters(spark, but), []
        none = hashed.select(self.id).limit(0)
        if filters is None:
            return none
        # powers of two, so a few tens at most
        sizes = [row.blocks for row in filters.select("blocks").distinct().collect()]
        if not sizes:
            return none
        asked = hashed.withColumn("_blocks", F.explode(F.array(*map(F.lit, sizes)))).withColumn(
            "_block", F.pmod("_h", F.col("_blocks")).cast("int"))
        named = asked.join(filters, (F.col("_blocks") == F.col("blocks"))
                           & (F.col("_block") == F.col("block")) & self._held())
        # at most one row a stored folder
        found = named.select("segment", "_bucket").distinct().collect()
        if not found:
            return none
        self.read = sorted(f"{self.path}/ids/segment={segment}/bucket={bucket}"
                           for segment, bucket in found)
        there = [path for path in self.read if folder_exists(spark, path)]
        if not there:
            return none
        kind = hashed.select(self.id).schema
        stored = spark.read.schema(kind).parquet(*there)
        return hashed.select(self.id).join(stored.distinct(), self.id, "left_semi")

    def files(self, spark: SparkSession) -> list[str]:
        """All folders of ids that are stored."""
        if not folder_exists(spark, f"{self.path}/ids"):
            return []
        rows = spark.read.parquet(f"{self.path}/ids").select("segment", "bucket").distinct()
        return sorted(f"{self.path}/ids/segment={segment}/bucket={bucket}"
                      for segment, bucket in rows.collect())
