"""Small helpers that several operators share."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources.locations import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give executors this package, once for each application; only needed where it isn't installed there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like these that no column of `df` has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add columns; an input column with the name of a new one, in any case, is replaced."""
    names = {n.lower() for n in new}
    keep = [col(c) for c in df.columns if c.lower() not in names]
    return df.select(*keep, *(c.alias(n) for n, c in new.items()))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: it survives lost executors and is computed once."""
    folder = work_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def slices(texts: pa.Array, max_bytes: int = 4 << 20) -> Iterator[pa.Array]:
    """Cut an Arrow batch of texts into runs of rows of about `max_bytes`, whole texts always."""
    sizes = [0 if n is None else n for n in pa.compute.binary_length(texts).to_pylist()]
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > max_bytes:
            yield texts.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(texts):
        yield texts.slice(start)
