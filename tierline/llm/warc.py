"""A deterministic sharded WARC writer, and a reader.

Pass 1 reads the pages for digests and compressed sizes only. These small rows are range-sorted by
(page id, salt); the sizes summed in that order give every record its file, so file limits depend on
the data alone and not on partitions. Pass 2 sends the payloads to their files, once: the small rows
with what each record's header needs go along and are merged with the payloads in sorted order.

Every file is written by a task of its own, so as many are written at once as there are cores.
Files are written under a temporary name, renamed one by one, and become valid when the manifest
(also written under a temporary name) appears; a folder without a manifest is an unfinished run.
Each file is one gzip stream of WARC/1.1 records. Everything is written and read by Spark's own file
access, so any shared file system will do.

Records with equal payloads (of at least `min_revisit_bytes`): that with the smallest page id is the
response, others are revisits without a payload. The extension fields Page-Id, Payload-Length and
Refers-To-Page-Id keep what the format has no field for.

Defined cases: a null payload is empty; a null id sorts last, and if no equal payload has an id all of
them are responses; repeated rows are all written, and are responses if they have the smallest id; a
null url is written as an empty one; an empty table gives a manifest without files.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierline.llm.batches import blocks
from tierline.session import materialize, work_dir

GAP = "\r\n\r\n"
ROLL_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
#: Rows that a sorted range holds about, and the most file limits that are sent to tasks.
RANGE_ROWS, MAX_FILES = 200_000, 1_000_000


def base32_sha1(value: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits at a time, from the hexadecimal form."""
    h = F.sha1(value)
    parts = [F.lpad(F.conv(F.substring(h, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def measured(batches):
    """(page_id, salt, url, digest, html) to the same with byte length and compressed length, without html."""
    for batch in batches:
        column = batch.column("html")
        packed, plain = [], []
        for _, _, data, offsets in blocks(column):
            raw = data.tobytes()
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                packed.append(len(zlib.compress(raw[a:b], 6)))
                plain.append(b - a)
        kept = [batch.column(k) for k in ("page_id", "salt", "url", "digest")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(plain, pa.int64()), pa.array(packed, pa.int64())], ["page_id", "salt", "url", "digest", "n_bytes", "packed"])


def summed(batches):
    """Adds the sum of the compressed sizes so far in this range, and the range's number."""
    task, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        sums = []
        for x in batch.column("packed").to_pylist():
            sums.append(total)
            total += x
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(sums), pa.int32()), pa.array(sums, pa.int64())], [*batch.schema.names, "task", "so_far"])


def header(kind: str, page_id, url, digest: str, payload: int, content: int, first, nth: int) -> str:
    name = lambda p, d, k: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{p}/{d}/{k}')}>"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id, digest + (url or ''), nth)}", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {''.join((url or '').split())}", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Type: {'text/html; charset=utf-8' if kind == 'response' else 'message/http'}"]
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"Refers-To-Page-Id: {first}")
    lines += [f"Page-Id: {'' if page_id is None else page_id}", f"Payload-Length: {payload}", f"Content-Length: {content}"]
    return "\r\n".join(lines)


def merged(batches):
    """Sorted (file, page_id, salt, payload or the record's facts) to (file, nth, value): each fact row precedes its payloads."""
    fact, nth = None, 0
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["html"] is None:
                fact, nth = row, 0
                continue
            response = fact["first"] is None or fact["first"] == fact["page_id"]
            body = row["html"] if response else ""
            head = header("response" if response else "revisit", row["page_id"], fact["url"], fact["digest"], fact["n_bytes"], len(body.encode("utf-8", "surrogatepass")), fact["first"], nth)
            nth += 1
            out.append((row["file"], row["page_id"], row["salt"], nth, head + GAP + body))
        names, types = ("file", "page_id", "salt", "nth", "value"), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], list(names))


def dealt(records: DataFrame, files: int) -> DataFrame:
    """Each file's records in a task of its own: the number of the file is the number of the task."""
    return records.repartitionById(files, F.col("file").cast("int"))


def write(pages: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES, min_revisit_bytes: int = 0, prefix: str = "pages") -> None:
    """Write all rows of (page_id, url, html) as <folder>/<prefix>-<number>.warc.gz with <folder>/manifest.json."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html"), F.lit(""))
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.xxhash64(F.coalesce("url", F.lit("")), html).alias("salt"), F.col("url"), html.alias("html"))
    facts = source.select("page_id", "salt", "url", base32_sha1(F.col("html")).alias("digest"), "html").mapInArrow(measured, "page_id long, salt long, url string, digest string, n_bytes long, packed long")
    facts = materialize(spark, facts)
    same = facts.filter(F.col("n_bytes") >= min_revisit_bytes).groupBy("digest", "n_bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    facts = facts.join(same, ["digest", "n_bytes"], "left").select("page_id", "salt", "url", "digest", "n_bytes", "packed", "first")

    order = [F.col("page_id").asc_nulls_last(), F.col("salt").asc()]
    n_ranges = max(1, facts.count() // RANGE_ROWS + 1)
    sized = materialize(spark, facts.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order).mapInArrow(summed, facts.schema.simpleString()[7:-1] + ", task int, so_far long"))
    # one row per range, then one per file
    totals = sized.groupBy("task").agg(F.sum("packed").alias("t"))
    before = totals.select("task", F.coalesce(F.sum("t").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    filed = materialize(spark, sized.join(before, "task").groupBy(F.floor((F.col("before") + F.col("so_far")) / roll_bytes).alias("file"))
                        .agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), F.col("page_id"), F.col("salt"))).alias("start")))
    limits = filed.orderBy("file").limit(MAX_FILES + 1).collect()
    if len(limits) > MAX_FILES:
        raise ValueError("too many files: raise roll_bytes")
    starts = [(r["start"]["no_id"], r["start"]["page_id"] or 0, r["start"]["salt"]) for r in limits]

    @F.pandas_udf("long")
    def file_of(page_id, salt):
        import pandas as pd

        return pd.Series([bisect.bisect_right(starts, (p != p or p is None, 0 if p != p or p is None else int(p), int(s))) - 1 for p, s in zip(page_id, salt, strict=True)], dtype="int64")

    once = sized.groupBy("page_id", "salt").agg(*(F.first(c).alias(c) for c in ("url", "digest", "n_bytes", "first")))
    none = lambda kind: F.lit(None).cast(kind)
    both = once.select("page_id", "salt", "url", "digest", "n_bytes", "first", none("string").alias("html")).union(
        source.select("page_id", "salt", none("string"), none("string"), none("long"), none("long"), "html"))
    keys = ["file", F.col("page_id").asc_nulls_last(), "salt"]
    tasks = max(len(starts), 1)
    records = (both.withColumn("file", file_of("page_id", "salt")).transform(dealt, tasks).sortWithinPartitions(*keys, F.col("html").isNotNull())
               .mapInArrow(merged, "file long, page_id long, salt long, nth long, value string").sortWithinPartitions(*keys, "nth").select("file", "value"))
    temporary = f"{folder.rstrip('/')}/_writing"
    records.write.mode("overwrite").partitionBy("file").option("lineSep", GAP).option("compression", "gzip").option("maxRecordsPerFile", 0).text(temporary)

    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = []
    for number in range(len(starts)):
        part = [s.getPath() for s in fs.listStatus(path(f"{temporary}/file={number}")) if s.getPath().getName().startswith("part-")]
        if len(part) != 1:
            raise ValueError(f"file {number} has {len(part)} parts")
        name = f"{prefix}-{number:06d}.warc.gz"
        if not fs.rename(part[0], path(f"{folder}/{name}")):
            raise OSError(f"{name} is there already")
        listed.append({"name": name, "bytes": fs.getFileStatus(path(f"{folder}/{name}")).getLen()})
    fs.delete(path(temporary), True)
    stream = fs.create(path(f"{folder}/_manifest"), True)
    stream.write(bytearray(json.dumps({"files": listed, "roll_bytes": roll_bytes}, indent=1).encode()))
    stream.close()
    if not fs.rename(path(f"{folder}/_manifest"), path(f"{folder}/manifest.json")):
        raise OSError("there is a manifest already")


def record(head: dict[str, str], body: bytes) -> tuple:
    digest, revisit = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"] == "revisit"
    if not revisit and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
        raise ValueError(f"record of page {head['Page-Id']} does not match its digest")
    number = lambda k: int(head[k]) if head.get(k) else None
    return (number("Page-Id"), head["WARC-Target-URI"], int(head["Payload-Length"]) if revisit else len(body), digest, head["WARC-Type"], number("Refers-To-Page-Id"), None if revisit else body)


def parsed(batches):
    """(archive, piece between blank lines), in order, to records.

    An archive's bytes are its pieces with blank lines between them, wherever it was split; records are cut out by their
    lengths. Held is one record, and what one piece adds to it. After the last record the reader may have taken the blank line.
    """
    gap = GAP.encode()
    archive, held, head, want = None, bytearray(), None, 0

    def records(ended: bool):
        nonlocal head, want
        while True:
            if head is None:
                stop = held.find(gap)
                if stop < 0:
                    if ended and held:
                        raise ValueError(f"{archive} ends inside a record")
                    return
                head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in held[:stop].decode("utf-8", "replace").split("\r\n")[1:])
                want = int(head["Content-Length"])
                del held[: stop + len(gap)]
            if len(held) < want + len(gap) and not (ended and len(held) == want):
                if ended:
                    raise ValueError(f"{archive} ends inside a record")
                return
            if held[want : want + len(gap)] not in (gap, b""):
                raise ValueError(f"record of page {head['Page-Id']} is longer than {want} bytes")
            yield record(head, bytes(held[:want]))
            del held[: want + len(gap)]
            head = None

    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    of = lambda out: pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], list(names))
    for batch in batches:
        out = []
        for path, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if path == archive:
                held += gap
            else:
                out += records(True)
                archive = path
            held += piece
            out += records(False)
        yield of(out)
    yield of(list(records(True)))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives that the folder's manifest names. Payloads are checked against length and digest."""
    manifest = json.loads("\n".join(r[0] for r in spark.read.text(f"{folder}/manifest.json").collect()))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    if not manifest["files"]:
        return spark.createDataFrame([], schema)
    lines = spark.read.option("lineSep", GAP).text([f"{folder}/{f['name']}" for f in manifest["files"]])
    return lines.select(F.col("_metadata.file_path").alias("archive"), F.col("value").cast("binary").alias("value")).mapInArrow(parsed, schema)


def round_trip(pages: DataFrame, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write the pages to a fresh shared folder and read them back."""
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    write(pages, folder, roll_bytes)
    return read(spark, folder)
