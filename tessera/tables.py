"""Table storage helpers: lineage cuts, snapshot-switched refresh,
append, and open-format export.

Refresh (SNK-2) never overwrites the folder a reader may be scanning:
each refresh writes ``<root>/snap=<n>`` and readers resolve the highest
snapshot that has a commit marker (``_SUCCESS``). A failed write leaves
the previous snapshot in force; old snapshots can be expired separately.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from itertools import islice
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.session import scratch_path

_SNAP = re.compile(r"snap=(\d+)$")


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the
    written copy: lineage is cut, later readers prune columns and push
    filters down, and a lost executor costs only a reread. The copies of a
    session can be removed by ``release_materialized``, those in a ``folder``
    of the caller's by the caller."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "copies", spark.sparkContext.applicationId)
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_materialized(spark: SparkSession) -> None:
    """Remove the copies that this session has written; no DataFrame built
    on them may be evaluated afterwards."""
    delete_path(spark, scratch_path(spark, "copies", spark.sparkContext.applicationId))


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed_snapshots(spark: SparkSession, root: str) -> list[int]:
    return committed_snapshots_named(spark, root, "snap")


def current_path(spark: SparkSession, root: str) -> str | None:
    snaps = committed_snapshots(spark, root)
    return f"{root.rstrip('/')}/snap={snaps[-1]}" if snaps else None


def read_current(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The latest committed snapshot of a refreshed table (None if none)."""
    path = current_path(spark, root)
    if path is None:
        if schema is None:
            return None
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def refresh(df: DataFrame, root: str, partition_by: Sequence[str] = (), version: int | None = None) -> str:
    """Full refresh as a new snapshot (TRUNCATE + INSERT semantics without
    ever overwriting data being read). Returns the snapshot path. With
    ``version`` (a run or micro-batch number) the snapshot has that number,
    and a repeated run writes the same one again."""
    spark = df.sparkSession
    if version is not None:
        path = f"{root.rstrip('/')}/snap={version}"
        w = df.write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return path
    snaps = committed_snapshots(spark, root)
    fs, p = _fs(spark, root)
    # also skip past uncommitted leftovers of a failed attempt
    n = max(snaps + [-1]) + 1
    if fs.exists(p):
        for st in fs.listStatus(p):
            m = _SNAP.search(st.getPath().getName())
            if m:
                n = max(n, int(m.group(1)) + 1)
    path = f"{root.rstrip('/')}/snap={n}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows (SNK-1)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_open(df: DataFrame, path: str, ntz_cols: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Open-format copy (SNK-6): timestamps down-cast to microsecond
    ``TIMESTAMP_NTZ``; overwrite, so a re-sync never duplicates rows. An
    Iceberg catalog is used when ``fmt='iceberg'`` and one is configured."""
    out = df
    for c in ntz_cols:
        out = out.withColumn(c, F.col(c).cast("timestamp_ntz"))
    if fmt == "iceberg":  # pragma: no cover - needs an Iceberg runtime
        out.writeTo(path).using("iceberg").createOrReplace()
    else:
        out.write.mode("overwrite").parquet(path)


class BatchTable:
    """Append-only table written by numbered runs or micro-batches.

    A batch is the folder ``<root>/batch_id=<number>``, overwritten as a
    whole: a batch that is repeated after a failure replaces what its first
    attempt left, and nothing is ever written twice. A batch is written by
    as many tasks as its rows have partitions, and no older row is moved.
    ``compact`` writes the resolved rows of all batches so far as
    ``<root>/base=<number>``, from where readers go on.
    """

    def __init__(self, root: str, partition_by: Sequence[str] = ()):
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by)

    def path(self, batch_id: int) -> str:
        return f"{self.root}/batch_id={batch_id}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        self._write(df, self.path(batch_id))

    def _write(self, df: DataFrame, path: str) -> None:
        rows = df.drop("batch_id")
        if self.partition_by:
            # a file per partition, more where one is large
            w = rows.hint("rebalance", *self.partition_by).write.partitionBy(*self.partition_by)
        else:
            w = rows.write
        w.mode("overwrite").option("compression", "zstd").parquet(path)
        write_text(df.sparkSession, f"{path}/_schema", rows.schema.json())

    def _reader(self, spark: SparkSession, path: str) -> DataFrameReader:
        """A reader that has the columns of the folder from beside its files, so
        that none is opened for them; a folder without them is inferred."""
        text = read_text(spark, f"{path}/_schema")
        return spark.read if text is None else spark.read.schema(StructType.fromJson(json.loads(text)))

    def batches(self, spark: SparkSession) -> list[int]:
        """Numbers of the committed batches."""
        return committed_snapshots_named(spark, self.root, "batch_id")

    def last(self, spark: SparkSession) -> int:
        """The highest number written so far, compacted batches included; -1
        before the first. New batches are numbered after it."""
        return max([*self.batches(spark), *committed_snapshots_named(spark, self.root, "base")], default=-1)

    def _filled(self, spark: SparkSession, path: str) -> bool:
        """Whether a folder has rows, as far as its names tell: a partitioned
        write of none leaves no file to take a schema from."""
        if not self.partition_by:
            return True
        fs, p = _fs(spark, path)
        return any(st.isDirectory() for st in fs.listStatus(p))

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """The rows of one committed batch; None if a partitioned one is
        empty."""
        path = self.path(batch_id)
        return self._reader(spark, path).parquet(path) if self._filled(spark, path) else None

    def read(self, spark: SparkSession, upto: int | None = None, with_batch: bool = False) -> DataFrame | None:
        """Rows of the committed batches with numbers up to ``upto`` (None:
        all); None if there is no batch, or no row in a partitioned table."""
        inside = lambda n: upto is None or n <= upto
        base = max(filter(inside, committed_snapshots_named(spark, self.root, "base")), default=None)
        later = [n for n in self.batches(spark) if inside(n) and (base is None or n > base)]
        later = [n for n in later if self._filled(spark, self.path(n))]
        parts = []
        if base is not None and self._filled(spark, f"{self.root}/base={base}"):
            parts.append(self._reader(spark, f"{self.root}/base={base}").parquet(f"{self.root}/base={base}").withColumn("batch_id", F.lit(base).cast("long")))
        if later:
            found = self._reader(spark, self.path(later[0])).option("basePath", self.root).parquet(*map(self.path, later))
            parts.append(found.withColumn("batch_id", F.col("batch_id").cast("long")))
        if not parts:
            return None
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out if with_batch else out.drop("batch_id")

    def compact(self, spark: SparkSession, resolve: Callable[[DataFrame], DataFrame]) -> None:
        """Write ``resolve`` of all rows as the base of later reads, and
        remove the batches in it."""
        done = self.batches(spark)
        rows = self.read(spark, with_batch=True)
        if rows is None or not done:
            return
        self._write(resolve(rows), f"{self.root}/base={done[-1]}")
        for n in done:
            delete_path(spark, self.path(n))
        for n in committed_snapshots_named(spark, self.root, "base")[:-1]:
            delete_path(spark, f"{self.root}/base={n}")


def newest_generation(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the rows of the last batch that wrote it: the state of a
    table whose batches hold all rows of the keys that they touch."""
    last = rows.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, [*keys, "batch_id"], "left_semi").drop("batch_id")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder a job created and has finished with (landed input
    after its load, superseded versions)."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    found = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8")
    finally:
        found.close()


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files of a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


#: Names given to the file system at once by ``delete_files``, and by how many
#: threads: a call is a round trip, to an object store a slow one.
DELETE_CHUNK = 256
DELETE_THREADS = 16


def _in_chunks(work: Callable[[list[str]], list], names: Iterable[str]) -> list:
    """The joined results of ``work`` on chunks of ``names``, of which only
    some are held at a time."""
    names, out = iter(names), []
    with ThreadPoolExecutor(DELETE_THREADS) as pool:
        while round_ := list(islice(names, DELETE_CHUNK * DELETE_THREADS)):
            chunks = [round_[i : i + DELETE_CHUNK] for i in range(0, len(round_), DELETE_CHUNK)]
            for found in pool.map(work, chunks):
                out += found
    return out


def delete_files(spark: SparkSession, files: Iterable[str], root: str) -> None:
    """Remove exactly ``files`` (names as Spark gives them, URIs), then the
    folders up to ``root`` that they leave without any other file. What has
    landed beside them since they were listed stays."""
    jvm = spark._jvm
    markers = re.compile(r"_SUCCESS|\..*\.crc")
    fs, top = _fs(spark, root)
    top = fs.makeQualified(top).toUri().getPath()
    # looked up once: each part of a Java name is a round trip
    new_path, new_uri, conf = jvm.org.apache.hadoop.fs.Path, jvm.java.net.URI, spark._jsc.hadoopConfiguration()

    def remove(names: list[str]) -> list[str]:
        if names[0].startswith("file:"):  # no round trips for what the driver can reach itself
            for folder, _, base in (unquote(urlsplit(name).path).rpartition("/") for name in names):
                for file in (f"{folder}/{base}", f"{folder}/.{base}.crc"):
                    with suppress(FileNotFoundError):
                        os.remove(file)
        else:
            store = new_path(new_uri(names[0])).getFileSystem(conf)
            for name in names:
                store.delete(new_path(new_uri(name)), False)
        return list(dict.fromkeys(name.rpartition("/")[0] for name in names))

    def remove_empty(names: list[str]) -> list[str]:
        """Parents of the removed ones of the folders."""
        parents = {}
        store = new_path(new_uri(names[0])).getFileSystem(conf)
        for name in names:
            path = new_path(new_uri(name))
            try:
                left = list(store.listStatus(path))
            except Py4JJavaError as e:
                if e.java_exception.getClass().getName() != "java.io.FileNotFoundException":
                    raise
                continue  # an object store has no empty folders
            if any(x.isDirectory() or not markers.fullmatch(x.getPath().getName()) for x in left):
                continue
            for x in left:
                store.delete(x.getPath(), False)
            store.delete(path, False)
            if unquote(urlsplit(name).path) != top:
                parents[name.rpartition("/")[0]] = None
        return list(parents)

    folders = dict.fromkeys(_in_chunks(remove, files))
    while folders:
        folders = dict.fromkeys(_in_chunks(remove_empty, folders))


def committed_snapshots_named(spark: SparkSession, root: str, prefix: str) -> list[int]:
    pat = re.compile(rf"{prefix}=(\d+)$")
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = pat.search(st.getPath().getName())
        if m and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def count_files(spark: SparkSession, root: str, suffixes: Sequence[str] = (".txt", ".txt.gz", ".json", ".json.gz", ".parquet")) -> int:
    """Data files under ``root`` (recursive listing on the driver; file
    names only, no data)."""
    fs, p = _fs(spark, root)
    it = fs.listFiles(p, True)
    n = 0
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")) and name.endswith(tuple(suffixes)):
            n += 1
    return n
