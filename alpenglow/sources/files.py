"""Plain file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_file(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              form: str = "lines") -> DataFrame:
    """A JSON or CSV file (or folder of them, named *.json or *.csv) as a DataFrame.

    CSV has a header and its columns stay strings. JSON is read as one record a line, which splits across tasks, or with
    form="document" as one document a file (an object, or an array of them).
    """
    if form not in ("lines", "document"):
        raise ValueError(f"unknown form: {form}")
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return spark.read.csv(path, header=True, inferSchema=False, schema=schema)
    if suffix == "json":
        return spark.read.json(path, schema=schema, multiLine=form == "document")
    raise ValueError(f"unsupported file type: {path}")
