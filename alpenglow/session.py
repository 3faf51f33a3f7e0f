"""Session helpers: the shared working folder and conf scopes."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="alpenglow-")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder for written tables, below the shared folder the cluster names in spark.checkpoint.dir.

    Only a local session without that setting falls back to a temporary folder: on a cluster the executors would not
    see the same disk, so there it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/alpenglow-{uuid.uuid4().hex}"


@contextmanager
def conf_scope(spark: SparkSession, **settings: str):
    """Set session confs (dots written as __) and put the old values back afterwards."""
    names = {key.replace("__", "."): value for key, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
