"""The weather archive as a Spark data source: `spark.read.format("weather_archive")`.

The request manifest is staged as one Parquet file a group of requests, and every file is one input partition: the unit
of parallelism and of retry. The driver lists files; it never holds requests. Filters on the manifest's columns are
taken over by the source, so requests that a query does not need are not made, and files whose footers exclude them are
not even scheduled. Errors keep their types: FetchError after the last attempt, MissingSliceError for what the archive
does not hold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from alpenglow.schemas import ROUTE_KEY, WEATHER_RAW, route_key
from alpenglow.sources.archive import ROWS_PER_BATCH, Transport, fetch, filesystem

FORMAT = "weather_archive"
KEPT = (ROUTE_KEY, "waypoint_name", "elevation", "period_start", "period_end")


def stage_manifest(manifest: DataFrame, folder: str, requests_per_task: int = 500) -> str:
    """Write a manifest as files of about requests_per_task neighbouring requests; returns the folder."""
    order = [*route_key(manifest), "waypoint_name", "period_start"]
    groups = max(1, -(-manifest.count() // requests_per_task))
    manifest.repartitionByRange(groups, *order).sortWithinPartitions(*order).write.parquet(folder)
    return folder


@dataclass
class RequestGroup(ds.InputPartition):
    """One staged file of requests."""

    path: str


def _condition(pushed: ds.Filter):
    """A filter as an expression over a file's columns; None for those the source leaves to Spark."""
    import pyarrow.compute as pc

    if isinstance(pushed, ds.Not):
        inner = _condition(pushed.child)
        return None if inner is None else ~inner
    column = getattr(pushed, "attribute", ())
    if len(column) != 1 or column[0] not in KEPT:
        return None
    field = pc.field(column[0])
    if isinstance(pushed, ds.IsNotNull):
        return field.is_valid()
    if isinstance(pushed, ds.EqualTo):
        return field == pushed.value
    if isinstance(pushed, ds.In):
        return field.isin(list(pushed.value))
    if isinstance(pushed, ds.GreaterThan):
        return field > pushed.value
    if isinstance(pushed, ds.GreaterThanOrEqual):
        return field >= pushed.value
    if isinstance(pushed, ds.LessThan):
        return field < pushed.value
    if isinstance(pushed, ds.LessThanOrEqual):
        return field <= pushed.value
    if isinstance(pushed, ds.StringStartsWith):
        return pc.starts_with(field, pushed.value)
    return None


class ArchiveReader(ds.DataSourceReader):
    def __init__(self, folder: str, transport: Transport, columns: list[str]):
        self.folder = folder
        self.transport = transport
        self.columns = columns
        self.pushed: list[ds.Filter] = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for given in filters:
            if _condition(given) is None:
                yield given
            else:
                self.pushed.append(given)

    def _wanted(self):
        wanted = None
        for given in self.pushed:
            own = _condition(given)
            wanted = own if wanted is None else wanted & own
        return wanted

    def partitions(self) -> list[RequestGroup]:
        return [RequestGroup(path) for path in _files(self.folder, self._wanted())]

    def read(self, partition: RequestGroup) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as dataset

        files, _ = filesystem(self.folder)
        requests = dataset.dataset(partition.path, filesystem=files, format="parquet")
        for batch in requests.to_batches(filter=self._wanted(), batch_size=ROWS_PER_BATCH):
            if batch.num_rows:
                texts = [fetch(self.transport, request) for request in batch.to_pylist()]
                now = pa.array([datetime.now(UTC)] * len(texts), pa.timestamp("us", "UTC"))
                own = {"response_json": pa.array(texts, pa.string()), "ingestion_timestamp": now}
                yield pa.RecordBatch.from_arrays(
                    [own[name] if name in own else batch.column(name) for name in self.columns], names=self.columns)


def _files(folder: str, wanted=None) -> list[str]:
    """Staged files, without those whose statistics exclude what is wanted."""
    import pyarrow.dataset as dataset

    files, where = filesystem(folder)
    staged = dataset.dataset(where, filesystem=files, format="parquet")
    return sorted({fragment.path for found in staged.get_fragments(filter=wanted)
                   for fragment in (found.split_by_row_group(filter=wanted) if wanted is not None else [found])})


class ArchiveSource(ds.DataSource):
    """Option `manifest`: the folder of `stage_manifest`. The transport is that of `register`."""

    transport: Transport

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        import pyarrow.dataset as dataset

        files, where = filesystem(self.options["manifest"])
        held = from_arrow_schema(dataset.dataset(where, filesystem=files, format="parquet").schema)
        routes = [field for field in held if field.name == ROUTE_KEY]
        return T.StructType([*routes, *(T.StructField(field.name, field.dataType) for field in WEATHER_RAW)])

    def reader(self, schema: T.StructType) -> ArchiveReader:
        return ArchiveReader(self.options["manifest"], self.transport, schema.fieldNames())


def register(spark: SparkSession, transport: Transport) -> None:
    """Make the format known to the session, answered by `transport`, and let it take over filters."""
    spark.dataSource.register(type("RegisteredArchive", (ArchiveSource,), {"transport": transport}))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def load_archive(spark: SparkSession, staged: str) -> DataFrame:
    """The raw rows of a staged manifest.

    Load once for each use that filters in its own way: Spark 4.1 keeps with a relation the filters it was pushed last,
    so one frame in two branches of a query (a union of two of its filters, say) reads the later branch's rows in both.
    Uses one after the other are safe: the condition that holds for all requests is always pushed, so each plans anew.
    """
    return spark.read.format(FORMAT).option("manifest", staged).load().filter(F.col("period_start").isNotNull())


def read_archive(spark: SparkSession, manifest: DataFrame, transport: Transport, folder: str,
                 requests_per_task: int = 500) -> DataFrame:
    """Raw rows of a manifest, as `fetch_payloads`, through the data source; `folder` is a new shared folder, from which
    `load_archive` gives further frames."""
    register(spark, transport)
    return load_archive(spark, stage_manifest(manifest, folder, requests_per_task))
