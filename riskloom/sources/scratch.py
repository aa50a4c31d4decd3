"""Written tables in the shared folder, used to cut lineage between passes.

The folder is the one the session names in ``spark.checkpoint.dir``.  Only a
session with a plain ``local`` master and no such setting, as in tests, gets a
temporary folder of its own, since driver and tasks are then one process.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

_LOCAL_ROOT: dict[str, str] = {}
# Paths made inside the open scopes, innermost last.
_SCOPES: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="riskloom-")
    return _LOCAL_ROOT[app]


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, deleted when the driver's JVM ends if nobody did before."""
    path = f"{scratch_root(spark)}/riskloom/{name}-{uuid.uuid4().hex}"
    jpath, fs = _hadoop(spark, path)
    fs.deleteOnExit(jpath)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    jpath, fs = _hadoop(spark, path)
    fs.delete(jpath, True)
    fs.cancelDeleteOnExit(jpath)


def materialise(df: DataFrame, name: str = "base") -> DataFrame:
    """Write ``df`` as Parquet once and read it back.

    Operators that pass over their input more than once take such a table, so a
    star join is not repeated per pass and each pass scans only its columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def finished(build: Callable[[], DataFrame], name: str = "result") -> DataFrame:
    """Write what ``build`` returns and delete every other table written meanwhile."""
    _SCOPES.append([])
    try:
        out = materialise(build(), name)
    finally:
        paths = _SCOPES.pop()
    for path in paths[:-1]:  # the last is the result's
        drop_scratch(out.sparkSession, path)
    if _SCOPES:
        _SCOPES[-1].append(paths[-1])
    return out


@contextmanager
def working_table(df: DataFrame, name: str = "work") -> Iterator[DataFrame]:
    """``materialise`` for a table that no result refers to: it is deleted at the end of the block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_scratch(spark, path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A driver-made parameter table as a local relation, so its size is known to the planner."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    data = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(data, schema=arrow), schema)
