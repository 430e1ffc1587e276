"""Bronze: every landing file once, as text, append only, new columns welcome.

The stream watches *files*, not rows: the checkpoint remembers which files were taken, and a
batch holds a bounded number of file names. Their rows are then read as a batch, grouped by
header. A batch writes its own ``_batch=<id>`` folder, so doing it again after a failure
replaces it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.lake import files, read_or_empty
from tierline.sources.landing import CORRUPT, headers, read_by_header, text_schema

FILES_PER_BATCH = 1000
# per table, the files its column list was read from and the list
_COLUMNS: dict[str, tuple] = {}

# rows of the file listing; the content column is never asked for, so no file is opened
FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
COLUMNS = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("name", T.StringType()),
    ]
)
SOURCES = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("generated_at", T.TimestampType()),
    ]
)


def source_registry(raw: DataFrame, entity: str | None, by: tuple[str, ...] = ("batch_id", "source_system")) -> DataFrame:
    """Provenance: what each batch brought, and when it arrived."""
    found = raw.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_written"), F.max("ingested_at").alias("generated_at"))
    return found.withColumn("entity", F.lit(entity)) if entity else found


@dataclass(frozen=True)
class Bronze:
    """One raw table: data, the columns seen so far, and the stream's checkpoint."""

    spark: SparkSession
    path: str

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    @property
    def columns_path(self) -> str:
        return f"{self.path}/columns"

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/checkpoint"

    @property
    def sources_path(self) -> str:
        return f"{self.path}/sources"

    def sources(self) -> DataFrame:
        """Rows per delivered batch, as counted when its files were taken."""
        return read_or_empty(self.spark, self.sources_path, SOURCES)

    def columns(self) -> list[str]:
        """Every column any batch brought, oldest first. Asked for again only when there are new lists."""
        listed = files(self.spark, f"{self.columns_path}/batch=*/*")
        if _COLUMNS.get(self.columns_path, (None, None))[0] != listed:
            seen = read_or_empty(self.spark, self.columns_path, COLUMNS, "json")
            first = seen.groupBy("name").agg(F.min(F.struct("batch", "position")).alias("at"))
            _COLUMNS[self.columns_path] = listed, [r["name"] for r in first.orderBy("at").collect()]
        return list(_COLUMNS[self.columns_path][1])

    def schema(self) -> T.StructType:
        names = self.columns()
        schema = text_schema(names + ([] if CORRUPT in names else [CORRUPT]))
        return (
            schema.add("ingested_at", T.TimestampType())
            .add("source_file", T.StringType())
            .add("source_modified_at", T.TimestampType())
        )

    def read(self) -> DataFrame:
        """All rows; a column a file did not have is NULL in its rows."""
        stored = self.schema().add("_batch", T.LongType())
        return read_or_empty(self.spark, self.data, stored).drop("_batch")

    def read_since(self, batch: int) -> DataFrame:
        """Rows of later batches, with their batch number; the others' folders are not opened."""
        stored = self.schema().add("_batch", T.LongType())
        return read_or_empty(self.spark, self.data, stored).where(F.col("_batch") > batch)

    def since(self, batch: int) -> tuple[int, int, list[str]]:
        """What came after a batch: rows, the newest batch, and the ids of the deliveries."""
        new = self.read_since(batch)
        n, newest = new.agg(F.count(F.lit(1)), F.max("_batch")).first()
        brought = self.sources().where((F.col("batch") > batch) & F.col("batch_id").isNotNull())
        return n, batch if newest is None else newest, [r["batch_id"] for r in brought.select("batch_id").distinct().collect()]

    def read_stream(self) -> DataFrame:
        """New rows since the reader's checkpoint, under the columns known at the start."""
        schema = self.schema().add("_batch", T.LongType())
        return self.spark.readStream.schema(schema).parquet(self.data).drop("_batch")


@dataclass(frozen=True)
class Ingested:
    files: int
    rows: int
    batches: tuple[int, ...] = ()


def ingest(spark: SparkSession, landing: str, bronze: Bronze, files_per_batch: int = FILES_PER_BATCH,
           multiline: bool = False, only_names: str | None = None) -> Ingested:
    """Take all files not taken yet, then stop. Returns what was new: nothing means no-op.

    Every visible file counts, whatever its name; ``only_names`` is a glob for folders that hold other files too.
    """

    taken: list[tuple[int, int, int]] = []

    def take(files: DataFrame, batch_id: int) -> None:
        # at most files_per_batch short rows
        paths = [r["path"] for r in files.select("path").collect()]
        if not paths:
            return
        by_header: dict[tuple[str, ...], list[str]] = {}
        names = headers(spark, paths)
        for path, header in names.items():
            by_header.setdefault(header, []).append(path)
        if not by_header:
            return
        rows = read_by_header(spark, by_header, multiline).withColumn("ingested_at", F.current_timestamp())
        counted = Observation()
        rows = rows.observe(counted, F.count(F.lit(1)).alias("n"))
        rows.write.mode("overwrite").parquet(f"{bronze.data}/_batch={batch_id}")

        # files are listed in path order, so the column order does not depend on the listing
        new = list(dict.fromkeys(c for p in sorted(names) for c in names[p]))
        listed = spark.createDataFrame([(batch_id, i, c) for i, c in enumerate(new)], COLUMNS).drop("batch")
        listed.coalesce(1).write.mode("overwrite").json(f"{bronze.columns_path}/batch={batch_id}")

        if {"batch_id", "source_system"} <= set(new):
            brought = spark.read.parquet(f"{bronze.data}/_batch={batch_id}")
            found = source_registry(brought, None).coalesce(1)
            found.write.mode("overwrite").parquet(f"{bronze.sources_path}/batch={batch_id}")
        taken.append((batch_id, len(paths), counted.get["n"]))

    files = spark.readStream.format("binaryFile")
    if only_names:
        files = files.option("pathGlobFilter", only_names)
    query = (
        files
        .schema(FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", True)
        .load(landing)
        .select("path", "modificationTime")
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", bronze.checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return Ingested(sum(f for _, f, _ in taken), sum(r for _, _, r in taken), tuple(b for b, _, _ in taken))
