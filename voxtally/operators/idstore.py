"""Known ids in buckets, with a Bloom filter before the exact comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from voxtally.session import shared_path
from voxtally.sources.files import matching_files

#: Ids fall into buckets by hash; a bucket is what a comparison reads. A filter block is one bitmap.
BUCKETS = 32
BLOCKS = 64
BITS = 1 << 15
PROBES = 4
#: Folders a generation may have before it is merged into one.
MERGE_FOLDERS = 32
#: Bytes of the longest id that is kept as it is; a longer one, such as a text, is kept as its SHA-256, which is as long.
LONGEST = 71
_SEED = "voxtally"

_PLACE = [StructField("batch", StringType()), StructField("bucket", IntegerType())]


class IdStore:
    """Ids that were seen, by batch, in a folder.

    `ids/gen=…/batch=…/bucket=…` holds the ids, `filters/…`, laid out alike, a Bloom filter of each bucket: blocks of
    2**15 bits, of which an id sets PROBES in one block. New ids are told from known ones by the filters; only
    ids that pass them, known ones and about one of a hundred new ones while a block has fewer than 3,000
    ids, are compared exactly, and only with the buckets they are in. Fuller filters cost more comparisons, never
    a wrong result; a store for more than some million ids takes more `buckets`. Ids of more than LONGEST bytes are
    stored, shuffled and compared by their digest; bucket and filter bits come from the id itself.

    A batch that is added again replaces itself. `merge` writes a new generation with one folder; it counts once
    its ids are written, so a reader never sees half of it. One writer at a time; NULL is an id like any other.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str = "string", buckets: int = BUCKETS, blocks: int = BLOCKS):
        self.spark, self.root, self.key, self.kind = spark, path, key, kind
        self.buckets, self.blocks = buckets, blocks
        # Another number of buckets is another store, which `catch_up` fills.
        self.path = f"{path}/{buckets}x{blocks}"

    # --- layout ----------------------------------------------------------------------------------

    def _generation(self) -> int:
        ready = matching_files(self.spark, f"{self.path}/ids/gen=*/batch=merged/_SUCCESS")
        return max((int(p.rsplit("/", 3)[1].removeprefix("gen=")) for p in ready), default=0)

    def _folder(self, kind: str, batch: str, generation: int) -> str:
        return f"{self.path}/{kind}/gen={generation}/batch={batch}"

    def _read(self, kind: str, fields: list[StructField]) -> DataFrame:
        schema, base = StructType([*fields, *_PLACE]), f"{self.path}/{kind}/gen={self._generation()}"
        # Only folders that were written to the end.
        done = [mark.removesuffix("/_SUCCESS") for mark in matching_files(self.spark, f"{base}/batch=*/_SUCCESS")]
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*done)

    def _ids(self) -> DataFrame:
        rows = self._read("ids", [StructField("id", StringType())])
        return rows.withColumn("id", self._held(F.col("id")))

    def _filters(self) -> DataFrame:
        return self._read("filters", [StructField("block", IntegerType()), StructField("bits", BinaryType())])

    def batches(self) -> set[str]:
        """Names of all batches that were added."""
        marks = matching_files(self.spark, f"{self.path}/ids/gen={self._generation()}/batch=*/_SUCCESS")
        names = {mark.rsplit("/", 2)[1].removeprefix("batch=") for mark in marks}
        merged = matching_files(self.spark, f"{self.path}/names/gen={self._generation()}/*.parquet")
        if merged:
            names |= {row.batch for row in self.spark.read.schema("batch string").parquet(
                f"{self.path}/names/gen={self._generation()}").collect()}
        return names - {"merged"}

    # --- hashing ---------------------------------------------------------------------------------

    @staticmethod
    def _held(value: Column) -> Column:
        """What stands for an id; the same for what stands for one already."""
        return F.when(F.octet_length(value) > LONGEST, F.concat(F.lit("sha256:"), F.sha2(value, 256))).otherwise(value)

    def _placed(self, ids: DataFrame) -> DataFrame:
        """(id, bucket, block, places) of the column `id`: what stands for it, and the bits of the block that it sets."""
        share = F.xxhash64("id", F.lit(_SEED))
        return ids.select(self._held(F.col("id")).alias("id"), F.pmod(share, F.lit(self.buckets)).cast("int").alias("bucket"),
                          F.pmod(F.shiftright(share, 32), F.lit(self.blocks)).cast("int").alias("block"),
                          F.array(*[self._probe(i) for i in range(PROBES)]).alias("places"))

    @staticmethod
    def _probe(i: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(i)), F.lit(BITS))

    def _named(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.col(f"`{self.key}`").cast("string").alias("id"))

    # --- use -------------------------------------------------------------------------------------

    def add(self, ids: DataFrame, batch: str) -> None:
        """Record the ids in the key column as those of `batch`; a second time replaces the first."""
        placed = self._placed(self._named(ids))
        filters = placed.select("bucket", "block", F.explode("places").alias("bit")).groupBy("bucket", "block").agg(
            F.bitmap_construct_agg("bit").alias("bits"))
        self._write(filters, placed.select("id", "bucket").distinct(), batch, self._generation())

    def catch_up(self, root: str, part: str, fmt: str = "parquet") -> None:
        """Add the ids of the folders `root`/`part`=… that were written to the end and are not in the store.

        A writer that dies between its rows and their ids leaves such a folder, as does one that kept no store.
        """
        marks = matching_files(self.spark, f"{root}/{part}=*/_SUCCESS")
        folders = {mark.rsplit("/", 2)[1].split("=", 1)[1] for mark in marks}
        for name in sorted(folders - self.batches()):
            rows = self.spark.read.format(fmt).load(f"{root}/{part}={name}")
            self.add(rows.select(F.col(f"`{self.key}`")), name)

    def _write(self, filters: DataFrame, ids: DataFrame, batch: str, generation: int) -> None:
        for kind, rows in (("filters", filters), ("ids", ids)):
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder(kind, batch, generation))

    def maybe_known(self, ids: DataFrame, without: str = "") -> DataFrame:
        """(id, bucket) of the ids that pass the filters of all batches but `without`."""
        return self._passing(self._placed(ids), without)

    def _blocks(self, without: str) -> DataFrame:
        return self._filters().where(F.col("batch") != without).groupBy("bucket", "block").agg(F.bitmap_or_agg("bits").alias("bits"))

    def _passing(self, placed: DataFrame, without: str) -> DataFrame:
        passed = F.lit(True)
        for i in range(PROBES):
            place = F.col("places")[i]
            byte = F.conv(F.hex(F.substring("bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            passed = passed & (F.getbit(byte, (place % 8).cast("int")) == 1)
        return placed.join(self._blocks(without), ["bucket", "block"]).where(passed).select("id", "bucket")

    def known(self, ids: DataFrame, without: str = "") -> DataFrame:
        """The ids of the key column that the store has, each once; batches named `without` do not count."""
        same = self._held(F.col("id")).eqNullSafe(F.col("_known"))
        found = self._named(ids).distinct().join(self._known(ids, without), same, "left_semi")
        return found.select(F.col("id").cast(self.kind).alias(self.key))

    def _known(self, ids: DataFrame, without: str) -> DataFrame:
        """`_known`: what stands for the ids of the key column that the store has."""
        path = shared_path(self.spark, "maybe")
        self._passing(self._placed(self._named(ids)).distinct(), without).write.parquet(path)
        maybe = self.spark.read.schema("id string, bucket int").parquet(path)
        # At most as many numbers as there are buckets.
        touched = sorted(row.bucket for row in maybe.select("bucket").distinct().collect())
        stored = self._ids().where(F.col("bucket").isin(*touched) if touched else F.lit(False)).where(F.col("batch") != without)
        stored = stored.select(F.col("bucket").alias("_b"), F.col("id").alias("_i"))
        same = (maybe["bucket"] == stored["_b"]) & maybe["id"].eqNullSafe(stored["_i"])
        return maybe.join(stored, same, "left_semi").select(F.col("id").alias("_known"))

    def unseen(self, rows: DataFrame, without: str = "") -> DataFrame:
        """The rows whose id the store does not have."""
        asked = self._held(F.col(f"`{self.key}`").cast("string"))
        return rows.join(self._known(rows, without), asked.eqNullSafe(F.col("_known")), "left_anti")

    def merge(self, without: str = "", folders: int = MERGE_FOLDERS) -> bool:
        """Merge all batches but `without` into a new generation once there are more than `folders` of them."""
        now = self._generation()
        marks = matching_files(self.spark, f"{self.path}/ids/gen={now}/batch=*/_SUCCESS")
        if len(marks) <= folders:
            return False
        names = sorted(self.batches() - {without})
        self.spark.createDataFrame([(n,) for n in names], "batch string").write.mode("overwrite").parquet(f"{self.path}/names/gen={now + 1}")
        ids = self._ids().where(F.col("batch") != without).select("id", "bucket").distinct()
        self._write(self._blocks(without), ids, "merged", now + 1)
        return True
