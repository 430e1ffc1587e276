"""A lake folder: layers, tables, and publication without a table format.

A table is written to a folder of its own per run, then one row naming that folder is appended
to the publication log. Readers take the newest row, so a run that fails before the append has
published nothing, and a reader never sees half a table.

A partitioned table is published as a list of its partitions' folders. A run writes those it changed
into folders of its own and lists the others where they are. A publication also says what it was
made from, so that it is made again only when that has changed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The folder of each layer.
LAYERS = {
    "landing": "00_landing",
    "bronze": "01_bronze",
    "silver": "02_silver",
    "gold": "03_gold",
    "reporting": "04_reporting",
    "metadata": "05_metadata",
}

PUBLICATIONS = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("path", T.StringType()),
        T.StructField("columns", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("parts", T.StringType()),
        T.StructField("made_from", T.StringType()),
    ]
)
#: The partition of NULL, as Spark names its folder.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


def matched(spark: SparkSession, pattern: str) -> list:
    """Status of what a path pattern matches; nothing is opened."""
    where = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or [])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, or an empty one where there is none. Reading never writes."""
    if not matched(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)


@dataclass(frozen=True)
class File:
    path: str
    size: int
    modified: int


def files(spark: SparkSession, pattern: str) -> list[File]:
    """Visible files a path pattern matches, by path: a listing, no file is opened."""
    listed = [File(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in matched(spark, pattern) if not f.isDirectory()]
    return sorted((f for f in listed if f.path.rsplit("/", 1)[-1][0] not in "._"), key=lambda f: f.path)


class Staged(NamedTuple):
    """A table written aside: its folder and schema; for a partitioned one the run and the rows of each partition folder."""

    path: str
    columns: str
    parts: dict[str, list] | None = None
    made_from: dict | None = None


@dataclass(frozen=True)
class Published:
    path: str
    columns: str
    version: int
    rows: int
    parts: dict[str, list] | None = None
    made_from: dict | None = None


def part(by: str, value) -> str:
    """Folder name of a partition."""
    if value is not None and not re.fullmatch(r"[\w.-]+", str(value)):
        raise ValueError(f"{value!r} cannot name a partition")
    return f"{by}={NULL_PART if value is None else value}"


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{LAYERS[layer]}/{table}"

    @property
    def log_path(self) -> str:
        return self.path("metadata", "publications")

    def log(self) -> DataFrame:
        return read_or_empty(self.spark, self.log_path, PUBLICATIONS, "json")

    def published(self) -> dict[tuple[str, str], Published]:
        """The current folder of every table: one row per table, read in one job."""
        newest = self.log().groupBy("layer", "table").agg(
            F.max_by(F.struct("path", "columns", "version", "rows", "parts", "made_from"), "version").alias("p")
        )
        out = {}
        for r in newest.collect():
            p = r["p"].asDict()
            out[r["layer"], r["table"]] = Published(**{**p, **{c: json.loads(p[c]) if p[c] else None for c in ("parts", "made_from")}})
        return out

    def read(self, layer: str, table: str) -> DataFrame:
        return self.reader()(layer, table)

    def reader(self) -> Callable[[str, str], DataFrame]:
        """``read`` over the tables that are published now; the log is read once for any number of them."""
        now = self.published()

        def read(layer: str, table: str) -> DataFrame:
            if (layer, table) not in now:
                raise KeyError(f"{layer}.{table} has not been published")
            return self.open(now[layer, table])

        return read

    def open(self, p: Published | Staged, only: set[str] | None = None) -> DataFrame:
        """The table of a publication, or some partitions of it."""
        schema = T.StructType.fromJson(json.loads(p.columns))
        if p.parts is None:
            return self.spark.read.schema(schema).parquet(p.path)
        paths = [f"{p.path}/_run={run}/{name}" for name, (run, _) in sorted(p.parts.items()) if only is None or name in only]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField("_run", T.StringType())])
        return self.spark.read.schema(stored).option("basePath", p.path).parquet(*paths).select(*schema.names)

    def stage(self, df: DataFrame, layer: str, table: str, partition_by: tuple[str, ...] = ()) -> Staged:
        """Write to a new folder; nobody reads it until ``publish``."""
        path = f"{self.path(layer, table)}/run-{uuid.uuid4().hex}"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return Staged(path, df.schema.json())

    def stage_parts(self, df: DataFrame, layer: str, table: str, by: str, old: Published | None = None, touched: set[str] | None = None) -> Staged:
        """Write partitions to a new folder. The other partitions of ``old``, those not ``touched``, stay where they are."""
        root, run = self.path(layer, table), uuid.uuid4().hex
        df.write.partitionBy(by).parquet(f"{root}/_run={run}")
        schema = T.StructType([f for f in df.schema if f.name != by])
        # from the footers: one row per partition
        rows = read_or_empty(self.spark, f"{root}/_run={run}/{by}=*", schema).groupBy(
            F.regexp_extract(F.col("_metadata.file_path"), f"/({by}=[^/]*)/[^/]*$", 1).alias("part")).count().collect() if files(
            self.spark, f"{root}/_run={run}/{by}=*/*") else []
        parts = {} if old is None or touched is None else {k: v for k, v in old.parts.items() if k not in touched}
        parts.update({r["part"]: [run, r["count"]] for r in rows})
        return Staged(root, df.schema.json(), parts)

    def publish(self, layer: str, table: str, staged: tuple, run_id: str, rows: int | None = None) -> None:
        self.publish_all([(layer, table, staged, rows)], run_id)

    def publish_all(self, tables: list[tuple], run_id: str) -> None:
        """One append for any number of staged tables: they become visible together."""
        now = self.published()
        entries = []
        for layer, table, staged, rows in tables:
            s, old = Staged(*staged), now.get((layer, table))
            told = [None if x is None else json.dumps(x) for x in (s.parts, s.made_from)]
            entries.append((layer, table, (old.version if old else 0) + 1, s.path, s.columns, run_id, rows, *told))
        self.spark.createDataFrame(entries, PUBLICATIONS).coalesce(1).write.mode("append").json(self.log_path)

    def materialized(self, layer: str, table: str, made_from: dict, build: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        """A table that is built when it is first asked for, and again when what it is made from has changed."""
        now = self.published().get((layer, table))
        if now is None or now.made_from != json.loads(json.dumps(made_from)):
            df = build()
            staged = self.stage_parts(df, layer, table, by) if by else self.stage(df, layer, table)
            rows = sum(n for _, n in staged.parts.values()) if by else None
            self.publish(layer, table, staged._replace(made_from=made_from), f"build-{uuid.uuid4().hex}", rows)
            now = staged
        return self.open(now)
