"""Results by key in few files: a data source whose tasks write many keys to one file with an index beside it, and whose commit is one renamed manifest.

A task that is killed or repeated leaves files that no manifest names; readers never see them, and abort deletes what was told of. The
keys don't pass through the driver: a task's message holds two names and a number. A single key is found by the index files'
column statistics and read by its place.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from veriloom.sources import storage

FORMAT = "keyed_results"
SHAPE = "kind string, key string, body string"
INDEX = "kind string, key string, file string, start long, size long"
MANIFEST = re.compile(r"manifest-(\d{12})\.json")


def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


@dataclass
class Written(WriterCommitMessage):
    data: str
    index: str
    rows: int


class KeyedWriter(DataSourceArrowWriter):
    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite = root.rstrip("/"), overwrite

    def write(self, iterator: Iterator) -> Written:
        import pyarrow as pa
        import pyarrow.parquet as pq

        store, base = _store(self.root)
        name = uuid.uuid4().hex
        store.create_dir(f"{base}/parts", recursive=True)
        shape = pa.schema([("kind", pa.string()), ("key", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("size", pa.int64())])
        at = rows = 0
        # Both files grow batch by batch: a task holds one batch, however many keys it writes.
        with store.open_output_stream(f"{base}/parts/{name}.data") as f, pq.ParquetWriter(f"{base}/parts/{name}.parquet", shape, filesystem=store) as index:
            for batch in iterator:
                starts, sizes = [], []
                for body in batch.column("body").to_pylist():
                    raw = (body or "").encode("utf-8", "surrogatepass")
                    f.write(raw + b"\n")
                    starts.append(at)
                    sizes.append(len(raw))
                    at += len(raw) + 1
                if starts:
                    columns = [batch.column("kind").cast(pa.string()), batch.column("key").cast(pa.string()), pa.array([f"{name}.data"] * len(starts)), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
                    index.write_batch(pa.record_batch(columns, schema=shape))
                    rows += len(starts)
        return Written(f"{name}.data", f"{name}.parquet", rows)

    def commit(self, messages: list) -> None:
        store, base = _store(self.root)
        written = [m for m in messages if m is not None]
        number, before = _last_manifest(store, base)
        files = ([] if self.overwrite else before) + [{"data": m.data, "index": m.index, "rows": m.rows} for m in written]
        beside = f"{base}/.{uuid.uuid4().hex}"
        with store.open_output_stream(beside) as f:
            f.write(json.dumps(files).encode())
        store.move(beside, f"{base}/manifest-{number + 1:012d}.json")

    def abort(self, messages: list) -> None:
        store, base = _store(self.root)
        for m in messages:
            for name in (m.data, m.index) if m is not None else ():
                store.delete_file(f"{base}/parts/{name}")


def _last_manifest(store, base: str) -> tuple[int, list[dict]]:
    from pyarrow import fs

    found = [(int(m[1]), x.path) for x in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if (m := MANIFEST.fullmatch(x.base_name))]
    if not found:
        return -1, []
    number, path = max(found)
    with store.open_input_stream(path) as f:
        return number, json.loads(f.read())


class KeyedSource(DataSource):
    """Write only; read with KeyedResults."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SHAPE

    def writer(self, schema: StructType, overwrite: bool) -> KeyedWriter:
        return KeyedWriter(self.options["path"], overwrite)


class KeyedResults:
    """Bodies (texts) by kind and key in a folder that all tasks reach."""

    def __init__(self, spark: SparkSession, root: str):
        spark.dataSource.register(KeyedSource)
        self.spark, self.root = spark, root.rstrip("/")

    def write(self, rows: DataFrame, mode: str = "append") -> None:
        """rows: kind, key, body. Sorted by range, so that a key's place is told by the index files' statistics. One of several bodies with a key is read."""
        ranged = rows.selectExpr("cast(kind AS string) AS kind", "cast(key AS string) AS key", "cast(body AS string) AS body").repartitionByRange("kind", "key").sortWithinPartitions("kind", "key")
        ranged.write.format(FORMAT).mode(mode).option("path", self.root).save()

    def index(self) -> DataFrame:
        """kind, key, file, start, size of what the last manifest names."""
        store, base = _store(self.root)
        files = [f"{self.root}/parts/{x['index']}" for x in _last_manifest(store, base)[1] if x["rows"]]
        return self.spark.read.schema(INDEX).parquet(*files) if files else self.spark.createDataFrame([], INDEX)

    def one(self, kind: str, key: str) -> str | None:
        """The body of one key, read alone; none: null."""
        at = self.index().where((F.col("kind") == kind) & (F.col("key") == key)).select("file", "start", "size").first()
        return None if at is None else _slice(self.root, at["file"], at["start"], at["size"])

    def read(self, kind: str | None = None) -> DataFrame:
        """kind, key, body of all, a task for each file's places."""
        root = self.root
        places = self.index() if kind is None else self.index().where(F.col("kind") == kind)

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            store, base = _store(root)
            name, f = None, None
            for batch in batches:
                bodies = []
                for file, start, size in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "size"))):
                    if file != name:
                        name, f = file, store.open_input_file(f"{base}/parts/{file}")
                    f.seek(start)
                    bodies.append(f.read(size).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([batch.column("kind"), batch.column("key"), pa.array(bodies, pa.string())], ["kind", "key", "body"])

        return places.repartition("file").sortWithinPartitions("file", "start").mapInArrow(run, SHAPE)


def _slice(root: str, file: str, start: int, size: int) -> str:
    store, base = _store(root)
    with store.open_input_file(f"{base}/parts/{file}") as f:
        f.seek(start)
        return f.read(size).decode("utf-8", "surrogatepass")


def write_run(rows: DataFrame, root: str, metrics: DataFrame, key: str = "id", error: str = "error") -> KeyedResults:
    """A run's results, errors and metrics by key, from one evaluation: results are rows without an error, as JSON; metrics one row, under the key `metrics`."""
    kept = storage.cut(rows)
    body = F.to_json(F.struct(*[c for c in kept.columns if c != error]), {"ignoreNullFields": "false"})
    results = kept.where(F.col(error).isNull()).select(F.lit("results").alias("kind"), F.col(key).cast("string").alias("key"), body.alias("body"))
    errors = kept.where(F.col(error).isNotNull()).select(F.lit("errors").alias("kind"), F.col(key).cast("string").alias("key"), F.col(error).cast("string").alias("body"))
    whole = metrics.select(F.lit("metrics").alias("kind"), F.lit("metrics").alias("key"), F.to_json(F.struct(*metrics.columns)).alias("body"))
    out = KeyedResults(kept.sparkSession, root)
    out.write(results.unionByName(errors).unionByName(whole), "overwrite")
    return out


def write_traces(traces: DataFrame, root: str, key: str = "project") -> KeyedResults:
    """What a model said at each attempt (key, attempt, trace), appended under the key `project/attempt`."""
    out = KeyedResults(traces.sparkSession, root)
    out.write(traces.select(F.lit("trace").alias("kind"), F.concat_ws("/", F.col(key).cast("string"), F.col("attempt").cast("string")).alias("key"), F.col("trace").cast("string").alias("body")))
    return out
