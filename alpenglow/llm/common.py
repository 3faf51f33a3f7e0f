"""What the text operators share: reading tables, Arrow batches in tasks, number of partitions, written intermediates."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import alpenglow
from alpenglow.session import shared_folder

# What runs in the tasks travels with its code, so the executors need no copy of this package.
cloudpickle.register_pickle_by_value(alpenglow)

#: Bytes of text handled at once inside a task; what numpy holds beside it is a small multiple.
CHUNK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(frame: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    folder = shared_folder(frame.sparkSession)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def encoded(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about `limit` bytes of text each (one row at least)."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    total, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def map_batches(frame: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str,
                text: str = "text") -> DataFrame:
    """`work` on bounded slices of the frame's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, text):
                yield work(piece)

    return frame.mapInArrow(run, schema)


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and where each part begins (with the end as last entry)."""
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(x) for x in parts], out=bounds[1:])
    return np.frombuffer(b"".join(parts), np.uint8), bounds


def fields(frame: DataFrame, *names: str) -> list[T.StructField]:
    return [frame.schema[x] for x in names]


def worker_cache() -> dict:
    """A dictionary of this process: tasks of a worker share it, and what it holds never travels with a function."""
    return sys.modules.setdefault("_alpenglow_worker_cache", ModuleType("_alpenglow_worker_cache")).__dict__


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; `unpacked` takes their kinds."""
    sizes = np.array([x.nbytes for x in arrays], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(x.tobytes() for x in arrays))


def unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, len(kinds))
    ends = 8 * len(kinds) + np.cumsum(sizes)
    return [np.frombuffer(raw[e - s : e], k) for k, s, e in zip(kinds, sizes.tolist(), ends.tolist(), strict=True)]
