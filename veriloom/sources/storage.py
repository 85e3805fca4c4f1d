"""Step storage: JSON lines, inventories, source trees, results. A step is a folder that a run reads back: its lineage ends there."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    """By Spark's own file systems, so for any store that it reads."""
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The last whole version of a table of JSON lines, or plain JSON-lines files there. A missing path is an empty table, blank lines are skipped, a malformed line raises."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(f"{path}/{_version(spark, path)}" if exists(spark, f"{path}/{CURRENT}") else path).where(F.trim("value") != "")
    checked = lines.select(F.from_json("value", schema if isinstance(schema, str) else schema.json(), {"mode": "FAILFAST"}).alias("r"))
    return checked.select("r.*")


#: The file of a versioned table that names its current version.
CURRENT = "CURRENT"


def _version(spark: SparkSession, path: str) -> str:
    return spark.read.text(f"{path}/{CURRENT}", wholetext=True).first()["value"].strip()


def write_jsonl(rows: DataFrame, path: str) -> None:
    """Whole or not at all: a new version is written in full, then one renamed file points to it; readers see the old or the new one.

    The versions before the last two are deleted. A crash at any moment leaves the table as it was, or a version that
    nothing points to.
    """
    spark = rows.sparkSession
    old = _version(spark, path) if exists(spark, f"{path}/{CURRENT}") else None
    new = f"v-{uuid.uuid4().hex}"
    rows.write.json(f"{path}/{new}")
    beside, fs = _file_system(spark, f"{path}/{CURRENT}.{new}")
    out = fs.create(beside)
    out.write(bytearray(new.encode()))
    out.close()
    # One rename that replaces: the file contexts' form of it is atomic where the store's is.
    context = spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(beside, _file_system(spark, f"{path}/{CURRENT}")[0], overwrite)
    for status in fs.listStatus(_file_system(spark, path)[0]):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (new, old):
            fs.delete(status.getPath(), True)


class StepStorage:
    """Steps of a run under one root, by name or by number."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "step"):
        self.spark, self.root, self.prefix, self.number = spark, root.rstrip("/"), prefix, 0

    def path(self, step: str) -> str:
        return f"{self.root}/{step}.jsonl"

    def read(self, step: str, schema) -> DataFrame:
        return read_jsonl(self.spark, self.path(step), schema)

    def write(self, step: str, rows: DataFrame) -> str:
        write_jsonl(rows, self.path(step))
        return self.path(step)

    def step(self, rows: DataFrame) -> DataFrame:
        """The rows as the next numbered step's, read back."""
        self.number += 1
        name = f"{self.prefix}_step{self.number}"
        self.write(name, rows)
        return self.read(name, rows.schema)


def memory(spark: SparkSession, rows: list[dict], schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def read_inventory(spark: SparkSession, path: str, schema) -> DataFrame:
    """A JSON array of objects, with row_pos, its order; read by ranges of the file, so its size doesn't matter."""
    from veriloom.sources import json_array

    kind = schema if isinstance(schema, str) else schema.simpleString()
    kind = kind if kind.startswith("struct") else f"struct<{kind}>"
    items = json_array.array_elements(json_array.pieces(spark, path))
    return items.select("row_pos", F.from_json("element", kind, {"mode": "FAILFAST"}).alias("r")).select("row_pos", "r.*")


def read_tree(spark: SparkSession, root: str, suffix: str = "lean") -> DataFrame:
    """path (below root), content of a source tree, dependency folders left out."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*.{suffix}").select(F.col("_metadata.file_path").alias("full"), F.col("value").alias("content"))
    below = F.regexp_extract("full", rf".*?{re.escape(root.rstrip('/').split('://')[-1])}/(.*)$", 1)
    return files.select(below.alias("path"), "content").where(~F.regexp_like("path", F.lit(r"(?:^|/)\.lake/")))


def write_results(rows: DataFrame, root: str, key: str = "id", error: str = "error") -> None:
    """Results and errors, a folder for each key, from one evaluation."""
    kept = cut(rows)
    kept.where(F.col(error).isNull()).drop(error).write.partitionBy(key).mode("overwrite").json(f"{root}/results")
    kept.where(F.col(error).isNotNull()).select(key, error).write.partitionBy(key).mode("overwrite").json(f"{root}/errors")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a folder of this machine serves local runs; a cluster has none and raises."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class _Written(threading.local):
    """Tables that cut() wrote in this thread, oldest first: a run never sees those of runs in other threads."""

    def __init__(self):
        self.paths: list[str] = []


_written = _Written()


def cut(rows: DataFrame) -> DataFrame:
    """The same rows, read from a table in the shared folder: the lineage ends there and a lost executor loses nothing."""
    spark = rows.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    _written.paths.append(path)
    return spark.read.schema(rows.schema).parquet(path)


def mark() -> int:
    """For discard(): the place after the tables that this thread cut so far."""
    return len(_written.paths)


def discard(spark: SparkSession, since: int = 0, but: DataFrame | list[DataFrame] | None = None) -> None:
    """Deletes the tables that this thread cut since a mark, but those that the frame or frames read; what was made of the others must be written by then."""
    frames = [] if but is None else but if isinstance(but, list) else [but]
    kept = {f.rsplit("/", 2)[-2] for frame in frames for f in frame.inputFiles()}
    for path in _written.paths[since:]:
        if path.rsplit("/", 1)[-1] not in kept:
            delete(spark, path)
            _written.paths.remove(path)


@contextmanager
def configured(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Runtime settings of the session (spark.sql. before each name, _ for each dot), put back at the end."""
    names = {f"spark.sql.{k.replace('_', '.')}": v for k, v in settings.items()}
    was = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def spread(run: Callable) -> Callable:
    """run(files, ...), its shuffles of small texts left in a task for each core: a text costs far more to mask than to move, and a table that one task writes is read by one again."""

    @wraps(run)
    def wrapped(files: DataFrame, *args, **kwargs):
        with configured(files.sparkSession, adaptive_coalescePartitions_minPartitionSize="16k", adaptive_coalescePartitions_parallelismFirst="true"):
            return run(files, *args, **kwargs)

    return wrapped


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; a missing one has none."""
    p, fs = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def replace_folder(rows: DataFrame, path: str) -> None:
    """Writes a table of Parquet files beside its folder and then renames it: the folder is there whole or not at all."""
    spark = rows.sparkSession
    beside = f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}-{uuid.uuid4().hex}"
    rows.write.parquet(beside)
    target, fs = _file_system(spark, path)
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(_file_system(spark, beside)[0], target):
        raise OSError(f"can't rename {beside}")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)
