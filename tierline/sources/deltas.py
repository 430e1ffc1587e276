"""A table kept as key-clustered delta folders: written by change, merged when read, compacted by size.

A write brings all rows of the keys it names. They go to a folder of their own per key bucket, next to a short
list of these keys; older rows of the same keys stay where they are and are passed over by readers. So a write
costs what it changes, and files without its keys are not touched.

    rows/_bucket=<b>/_seq=<n>   rows      keys/_bucket=<b>/_seq=<n>   the keys whose rows are there
    log                         one row per bucket and write: which folder, and from which write on it replaces others

A folder counts once the log names it; the log is appended last, so readers never see half a write, and a
write that is done again after a failure lands in a folder of its own and has the same effect. Where the deltas of a
bucket have grown to the size of its base, the bucket is merged into a new base; where there are many small ones,
they are merged with each other. Every row is thereby rewritten a few times at most, however many writes follow.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.sources.lake import files, read_or_empty

BUCKET, SEQ = "_bucket", "_seq"
#: `since` of a folder that replaces everything before it.
ALL = -1
WRITE, MERGE = "write", "merge"

LOG = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("seq", T.LongType()),
        T.StructField("since", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
    ]
)


@dataclass(frozen=True, order=True)
class Folder:
    """A live folder of one bucket."""

    bucket: int
    seq: int
    since: int
    bytes: int

    def under(self, root: str) -> str:
        return f"{root}/{BUCKET}={self.bucket}/{SEQ}={self.seq}"


@dataclass(frozen=True)
class DeltaTable:
    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 64
    # deltas of a bucket that readers have to merge at most
    max_deltas: int = 8

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    @property
    def keys_path(self) -> str:
        return f"{self.path}/keys"

    @property
    def log_path(self) -> str:
        return f"{self.path}/log"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def log(self) -> DataFrame:
        return read_or_empty(self.spark, self.log_path, LOG, "json")

    def live(self) -> list[Folder]:
        """Folders that no later one replaces: at most (max_deltas + 2) of each bucket. The newest is among them."""
        later = Window.partitionBy("bucket").orderBy("seq").rowsBetween(1, Window.unboundedFollowing)
        named = self.log().withColumn("until", F.min("since").over(later))
        found = named.where(F.col("until").isNull() | (F.col("until") > F.col("seq"))).collect()
        for r in found:
            if r["buckets"] != self.buckets:
                raise ValueError(f"{self.path} has {r['buckets']} buckets, not {self.buckets}")
        return sorted(Folder(r["bucket"], r["seq"], r["since"], r["bytes"]) for r in found)

    def newest(self) -> int:
        """Number of the newest folder; -1 before the first."""
        return max((f.seq for f in self.live()), default=ALL)

    # ---- reading ----------------------------------------------------------------------------

    def read(self) -> DataFrame:
        return self._merged(self.live()).drop(BUCKET, SEQ)

    def changed_since(self, seq: int) -> DataFrame:
        """Keys that writes after this one brought, each once."""
        written = self.log().where((F.col("seq") > seq) & (F.col("kind") == WRITE))
        folders = [Folder(r["bucket"], r["seq"], 0, 0) for r in written.select("bucket", "seq").distinct().collect()]
        return self._load(self.keys_path, self._key_schema(), folders).select(*self.keys).distinct()

    def _key_schema(self) -> T.StructType:
        return T.StructType([self.schema[k] for k in self.keys])

    def _load(self, root: str, schema: T.StructType, folders: list[Folder]) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(SEQ, T.LongType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*[f.under(root) for f in folders])

    def _merged(self, folders: list[Folder]) -> DataFrame:
        """Rows of these folders, without those whose key a later one of them has. Buckets of one folder are only read."""
        per = defaultdict(list)
        for f in folders:
            per[f.bucket].append(f)
        filled = {b: [f for f in fs if f.bytes] for b, fs in per.items()}
        alone = [f for b, fs in per.items() if len(fs) == 1 for f in filled[b]]
        many = [f for b, fs in per.items() if len(fs) > 1 for f in filled[b]]
        out = [self._load(self.rows_path, self.schema, alone)] if alone or not many else []
        if many:
            # the first folder of a bucket replaces nothing in it
            above = [f for fs in per.values() if len(fs) > 1 for f in fs[1:]]
            newest = self._load(self.keys_path, self._key_schema(), above).groupBy(*self.keys).agg(F.max(SEQ).alias("_newest"))
            newest = newest.withColumnsRenamed({k: f"_k_{k}" for k in self.keys})
            rows = self._load(self.rows_path, self.schema, many)
            same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_k_{k}") for k in self.keys])
            out.append(rows.join(newest, same & (F.col("_newest") > F.col(SEQ)), "left_anti"))
        return reduce(DataFrame.unionByName, out)

    # ---- writing ----------------------------------------------------------------------------

    def write(self, rows: DataFrame, keys: DataFrame) -> int:
        """Replace all rows of `keys` by `rows` (rows of other keys are not allowed). Returns the write's number."""
        live = self.live()
        known = {f.bucket for f in live}
        seq = max((f.seq for f in live), default=ALL) + 1
        brought = {self.keys_path: keys.select(*self.keys), self.rows_path: rows.select(*self.schema.names)}
        with ThreadPoolExecutor(max_workers=2) as pool:
            list(pool.map(lambda root: self._put(root, brought[root].withColumn(BUCKET, self.bucket()), seq), brought))
        size = self._sizes(self.rows_path, seq)
        new = [Folder(b, seq, seq if b in known else ALL, size.get(b, 0)) for b in sorted(self._sizes(self.keys_path, seq))]
        self._append(new, WRITE)
        self._compact(sorted([*live, *new]), seq + 1)
        return seq

    def _compact(self, live: list[Folder], seq: int) -> None:
        per = defaultdict(list)
        for f in live:
            per[f.bucket].append(f)
        whole, minor = [], []
        for base, *deltas in per.values():
            if deltas and sum(f.bytes for f in deltas) >= base.bytes:
                whole.append([base, *deltas])
            elif len(deltas) > self.max_deltas:
                minor.append(deltas)
        if not whole and not minor:
            return
        if minor:
            held = self._load(self.keys_path, self._key_schema(), [f for fs in minor for f in fs])
            self._put(self.keys_path, held.select(*self.keys, BUCKET).distinct(), seq)
        self._put(self.rows_path, self._merged([f for fs in (*whole, *minor) for f in fs]).drop(SEQ), seq)
        size = self._sizes(self.rows_path, seq)
        merged = [(fs[0].bucket, ALL) for fs in whole] + [(fs[0].bucket, fs[0].since) for fs in minor]
        self._append([Folder(b, seq, since, size.get(b, 0)) for b, since in merged], MERGE)

    def _put(self, root: str, df: DataFrame, seq: int) -> None:
        # a bucket with one very common key is split over several writers, small ones share one; only
        # folders of this number are replaced, so leftovers of a failed write do no harm
        (
            df.withColumn(SEQ, F.lit(seq).cast("long")).hint("rebalance", BUCKET)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET, SEQ).parquet(root)
        )

    def _sizes(self, root: str, seq: int) -> dict[int, int]:
        """Bytes a write has put into each bucket, from one listing."""
        out = defaultdict(int)
        for f in files(self.spark, f"{root}/{BUCKET}=*/{SEQ}={seq}/*"):
            out[int(f.path.rsplit(f"/{BUCKET}=", 1)[1].split("/")[0])] += f.size
        return out

    def _append(self, folders: list[Folder], kind: str) -> None:
        if folders:
            entries = [(f.bucket, f.seq, f.since, f.bytes, kind, self.buckets) for f in folders]
            self.spark.createDataFrame(entries, LOG).coalesce(1).write.mode("append").json(self.log_path)
