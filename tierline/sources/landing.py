"""Landing files: headered CSV, one folder per entity, lineage columns in every row."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# a file is one task, so that its first lines are the first ones there
WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50)}
# a quote that is still open after so many lines is taken for a mistake
MAX_HEADER_LINES = 512

# A line with more or fewer fields than its header is kept whole in this column.
CORRUPT = "corrupt_record"


def stamp(df: DataFrame, batch_id: str | Column, source_system: str = "SYNTHETIC", period: str = "period") -> DataFrame:
    """Add ``source_system``, ``batch_id`` and, where absent, the mid-year ``effective_ts``."""
    batch = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    out = df.withColumn("source_system", F.lit(source_system)).withColumn("batch_id", batch)
    if "effective_ts" not in df.columns and period in df.columns:
        text = F.concat(F.col(period).cast("string"), F.lit("-07-01T00:00:00"))
        out = out.withColumn("effective_ts", text)
    return out


def write_csv(df: DataFrame, path: str) -> None:
    """Append headered CSV files. Timestamps keep their fraction, empty text stays empty."""
    (
        df.write.mode("append")
        .option("header", True)
        .option("emptyValue", '""')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("escape", '"')
        .csv(path)
    )


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def first_record(spark: SparkSession, path: str) -> str | None:
    """The first CSV record of a file: its first line, and more if a quote is still open at the end of it.

    A task reads from the beginning of the file and stops after these lines.
    """
    n = 1
    while True:
        lines = [r["value"] for r in spark.read.text(path).limit(n).collect()]
        quotes = 0
        for i, line in enumerate(lines):
            quotes += line.count('"')
            if quotes % 2 == 0:
                return "\n".join(lines[: i + 1])
        if len(lines) < n or n >= MAX_HEADER_LINES:
            return "\n".join(lines) if lines else None
        n *= 8


def headers(spark: SparkSession, paths: list[str], side_by_side: int = 16) -> dict[str, tuple[str, ...]]:
    """Header of each file, as file path -> column names.

    What is read of a file is bounded by a few buffers, whatever its size. The driver gets one record per file of
    a batch, whose number the caller bounds; the small jobs run side by side.
    """
    whole = spark.newSession()
    for key, value in WHOLE_FILES.items():
        whole.conf.set(key, value)
    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        found = dict(zip(paths, pool.map(lambda p: first_record(whole, p), paths)))
    return {p: tuple(next(csv.reader(r.lstrip("\ufeff").splitlines(keepends=True)))) for p, r in found.items() if r and r.strip()}


def read_by_header(spark: SparkSession, by_header: dict[tuple[str, ...], list[str]], multiline: bool = False) -> DataFrame:
    """Files with equal headers are read together; columns are matched by name, not by place.

    What does not fit the header is in ``corrupt_record``, unless a file has a column of that name.
    """
    out = None
    for names, files in sorted(by_header.items()):
        kept = [] if CORRUPT in names else [CORRUPT]
        part = (
            spark.read.schema(text_schema([*names, *kept]))
            .option("columnNameOfCorruptRecord", CORRUPT if kept else "")
            .option("header", True)
            .option("multiLine", multiline or any("\n" in c for c in names))
            .option("escape", '"')
            .option("enforceSchema", True)
            .csv(sorted(files))
            .withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("source_modified_at", F.col("_metadata.file_modification_time"))
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out
