"""Token-ID files: a shared zstandard dictionary, each document compressed on its own, an offset index in every file.

Layout of a shard (`shard-<part>-<k>.tok`):

    8 bytes   magic, 32 bytes SHA-256 of the dictionary
    frames    one zstandard frame for each document: its ids, little-endian unsigned 32-bit, the end id last
    index     for each document: has_id u1, doc_id i8, offset u8 (of its frame), n_tokens u8; then the number of documents u8

The dictionary is `dictionary.zstd` in the same folder. A worker writes a file under a name of its own and renames it when
whole, so that a repeated task replaces its file.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from .common import cut, lookup, sampled, shared_dir

MAGIC = b"VLTOKS01"
HEAD = len(MAGIC) + 32
END = 2
#: Compressed bytes after which a worker begins another file.
SHARD_BYTES = 16_000_000


def _index_type():
    import numpy as np

    return np.dtype([("has_id", "<u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("n_tokens", "<u8")])


def _dictionary(content: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(content) if content else None


def train_dictionary(docs: DataFrame, tokenizer: str, sample_rows: int = 1_000, size: int = 65_536, sample_bytes: int = 16_000_000) -> bytes:
    """A zstandard dictionary from the id arrays of about sample_rows hash-chosen rows that hold sample_bytes of text at most; too few for one: no dictionary.

    Texts become ids in the sample's own tasks, whole; one task trains.
    """

    def encoded(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = tokens.encoder(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(enc.stream(batch.column(0)), pa.binary())], ["ids"])

    def trained(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        samples = [x.as_py() for batch in batches for x in batch.column(0) if len(x.as_py())]
        try:
            content = zstandard.train_dictionary(size, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):
            content = b""
        yield pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

    ids = sampled(docs, sample_rows, sample_bytes).mapInArrow(encoded, "ids binary")
    got = ids.repartition(1).sortWithinPartitions("ids").mapInArrow(trained, "content binary").collect()
    return bytes(got[0]["content"]) if got else b""


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, sample_rows: int = 1_000, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Writes docs (doc_id, text) in ascending doc_id order, null ids first, ties by length and hash of the text; returns the manifest: shard, n_docs, n_tokens.

    Null text: the end id alone. Repeated rows are written as often. Empty: no shards.
    """
    from pyarrow import fs

    tokenizer = tokenizer or tokens.default_path()
    content = train_dictionary(docs, tokenizer, sample_rows)
    store, base = fs.FileSystem.from_uri(path)
    store.create_dir(base)
    with store.open_output_stream(f"{base}/dictionary.zstd") as f:
        f.write(content)
    # Ranges of ids and, where many rows share an id (or have none), of their texts' lengths and hashes; equal rows may part.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place = ["doc_id", F.coalesce(F.length("text"), F.lit(-1)).alias("_n"), F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_u")]
    ordered = rows.select("text", *place).repartitionByRange("doc_id", "_n", "_h", "_u").sortWithinPartitions("doc_id", "_n", "_h", "_u").select("doc_id", "text")
    digest, tail = hashlib.sha256(content).digest(), end.to_bytes(4, "little")

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import zstandard
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), tokens.encoder(tokenizer)
        pack = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(content), write_content_size=True)
        store, base = fs.FileSystem.from_uri(path)
        frames, index, at, done = [], [], HEAD, []

        def flush() -> None:
            nonlocal frames, index, at
            if index:
                name = f"shard-{part:08d}-{len(done):06d}"
                own = f"{base}/{name}.{uuid.uuid4().hex}.part"
                with store.open_output_stream(own) as f:
                    f.write(MAGIC + digest)
                    for x in frames:
                        f.write(x)
                    f.write(np.array(index, dtype=_index_type()).tobytes() + len(index).to_bytes(8, "little"))
                store.move(own, f"{base}/{name}.tok")
                done.append((name, len(index), sum(x[3] for x in index)))
            frames, index, at = [], [], HEAD

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.stream(batch.column(1))):
                frame = pack.compress(ids + tail)
                frames.append(frame)
                index.append((doc_id is not None, doc_id or 0, at, len(ids) // 4 + 1))
                at += len(frame)
                if at >= shard_bytes:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["shard", "n_docs", "n_tokens"])

    return cut(ordered.mapInArrow(write, "shard string, n_docs long, n_tokens long"))


def _checked(data: bytes, content: bytes) -> bytes:
    if data[: len(MAGIC)] != MAGIC or data[len(MAGIC) : HEAD] != hashlib.sha256(content).digest():
        raise ValueError("not a token file of this dictionary")
    return data


def read_tokens(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids: from the files; the manifest gives each file's place."""
    import numpy as np
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    with store.open_input_stream(f"{base}/dictionary.zstd") as f:
        content = f.read()
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    places = cut(manifest.select("shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("_base")))

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard

        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
        for batch in batches:
            for shard, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(_checked(data.as_py(), content))
                n = int.from_bytes(data[-8:], "little")
                index = np.frombuffer(data[len(data) - 8 - n * _index_type().itemsize : len(data) - 8], dtype=_index_type())
                offset, n_tokens = index["offset"].astype(np.int64), index["n_tokens"].astype(np.int64)
                stop = np.append(offset[1:], len(data) - 8 - n * _index_type().itemsize)
                start = np.cumsum(n_tokens) - n_tokens
                for lo in range(0, n, 500):
                    some = index[lo : lo + 500]
                    ids = [unpack.decompress(data[a:b]) for a, b in zip(some["offset"].tolist(), stop[lo : lo + 500].tolist())]
                    if [len(x) // 4 for x in ids] != some["n_tokens"].tolist():
                        raise ValueError(f"{shard}: a document's length differs from the index")
                    doc_id = pa.array(some["doc_id"], pa.int64(), mask=some["has_id"] == 0)
                    cols = [pa.array([shard] * len(some)), doc_id, pa.array(start[lo : lo + 500]), pa.array(some["n_tokens"].astype("i8")), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays(cols, ["shard", "doc_id", "local", "n_tokens", "ids"])

    if not manifest.limit(1).count():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids binary")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(path)
    named = files.select(F.regexp_extract("path", r"(shard-\d+-\d+)\.tok$", 1).alias("shard"), "content")
    rows = named.mapInArrow(read, "shard string, doc_id long, local long, n_tokens long, ids binary")
    return lookup(rows, places, "shard").select("doc_id", (F.col("local") + F.col("_base")).alias("start"), "n_tokens", "ids")


def read_document(path: str, shard: str, k: int) -> list[int]:
    """The ids of the k-th document of a shard, by its index entry alone."""
    import numpy as np
    import zstandard
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path)
    with store.open_input_stream(f"{base}/dictionary.zstd") as f:
        content = f.read()
    with store.open_input_file(f"{base}/{shard}.tok") as f:
        _checked(f.read_at(HEAD, 0), content)
        n = int.from_bytes(f.read_at(8, f.size() - 8), "little")
        index = np.frombuffer(f.read_at(n * _index_type().itemsize, f.size() - 8 - n * _index_type().itemsize), dtype=_index_type())
        at = int(index["offset"][k])
        stop = int(index["offset"][k + 1]) if k + 1 < n else f.size() - 8 - n * _index_type().itemsize
        return np.frombuffer(zstandard.ZstdDecompressor(dict_data=_dictionary(content)).decompress(f.read_at(stop - at, at)), dtype="<u4").tolist()


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
