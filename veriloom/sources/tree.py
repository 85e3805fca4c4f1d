"""Source trees as a data source: folders are planned into partitions on the driver, dependency folders are neither listed nor opened."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FORMAT = "source_tree"
# Fixed value: the folder of a project's dependencies and build products.
LEFT_OUT = ".lake"


def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


@dataclass
class Folders(InputPartition):
    """Files (paths below the root) of some folders."""

    files: tuple[str, ...]


class TreeReader(DataSourceReader):
    def __init__(self, root: str, suffix: str, size: int):
        self.root, self.suffix, self.size = root.rstrip("/"), suffix, size

    def partitions(self) -> list[Folders]:
        """Whole folders together, up to `size` bytes; a folder of more is several partitions. Only names and sizes are held here."""
        from pyarrow import fs

        store, base = _store(self.root)
        out: list[Folders] = []
        now: list[str] = []
        held, todo = 0, [base]
        while todo:
            folder = todo.pop()
            found = sorted(store.get_file_info(fs.FileSelector(folder)), key=lambda x: x.base_name)
            todo += [x.path for x in reversed(found) if x.type == fs.FileType.Directory and x.base_name != LEFT_OUT]
            for x in found:
                if x.type == fs.FileType.File and x.base_name.endswith(self.suffix):
                    if now and held + x.size > self.size:
                        out.append(Folders(tuple(now)))
                        now, held = [], 0
                    now.append(x.path[len(base.rstrip("/")) + 1 :])
                    held += x.size
        if now:
            out.append(Folders(tuple(now)))
        return out or [Folders(())]

    def read(self, partition: Folders) -> Iterator[tuple[str, str]]:
        store, base = _store(self.root)
        for path in partition.files:
            with store.open_input_stream(f"{base.rstrip('/')}/{path}") as f:
                yield path, f.read().decode("utf-8")


class SourceTree(DataSource):
    """path (below the root), content of the files with a suffix. Options: path, suffix (.lean), partition_bytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "path string, content string"

    def reader(self, schema: StructType) -> TreeReader:
        return TreeReader(self.options["path"], self.options.get("suffix", ".lean"), int(self.options.get("partition_bytes", 32 << 20)))


def read_sources(spark: SparkSession, root: str, suffix: str = ".lean", partition_bytes: int = 32 << 20) -> DataFrame:
    """path, content of a source tree in a store that the driver and the tasks reach; storage.read_tree reads the same by Spark's own file reader."""
    spark.dataSource.register(SourceTree)
    return spark.read.format(FORMAT).option("path", root).option("suffix", suffix).option("partition_bytes", str(partition_bytes)).load()
