"""Table scans: delimited text with a list of null strings, lenient text, Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# The cell texts read as NULL.
NULL_STRINGS = ("", "NA", "N/A", "null", "NULL")

_INFER_ORDER: tuple[tuple[str, T.DataType], ...] = (
    ("bigint", T.LongType()),
    ("double", T.DoubleType()),
    ("boolean", T.BooleanType()),
    ("date", T.DateType()),
    ("timestamp_ntz", T.TimestampNTZType()),
)
# try_cast accepts more spellings than a typed text file should
_SHAPES = {
    "bigint": r"^[+-]?\d{1,18}$",
    "double": r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:nan|inf|infinity))$",
    "boolean": r"^(?i:true|false)$",
    "date": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "timestamp_ntz": r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}.*$",
}


def _text(spark: SparkSession, path: str | Sequence[str], sep: str, multiline: bool) -> DataFrame:
    return spark.read.csv(
        path, header=True, sep=sep, quote='"', escape='"', multiLine=multiline,
        inferSchema=False, nullValue="\u0000", emptyValue="",
    )


def _cell(name: str, nulls: Sequence[str]) -> Column:
    c = F.col(f"`{name}`")
    return F.when(c.isin(*nulls), F.lit(None)).otherwise(c) if nulls else c


def infer_types(df: DataFrame, nulls: Sequence[str] = NULL_STRINGS) -> T.StructType:
    """Narrowest type every non-null cell of a text column fits.

    One scan whatever the width: cells become (column, value) rows and each
    candidate type is a map-side combined count.
    """
    cells = df.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column", "value")
    value = F.col("value")
    known = cells.where(value.isNotNull() & ~value.isin(*nulls) if nulls else value.isNotNull())
    fits = {k: value.rlike(_SHAPES[k]) & value.try_cast(k).isNotNull() for k, _ in _INFER_ORDER}
    counts = known.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(c, True)).alias(k) for k, c in fits.items()]
    )
    found = {r["column"]: r for r in counts.collect()}  # one row per column

    def narrowest(name: str) -> T.DataType:
        row = found.get(name)
        return next((t for k, t in _INFER_ORDER if row and row[k] == row["n"]), T.StringType())

    return T.StructType([T.StructField(c, narrowest(c)) for c in df.columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    nulls: Sequence[str] = NULL_STRINGS,
    schema: T.StructType | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Header-row text scan; any of ``nulls`` reads as NULL.

    A quoted cell may hold separators, doubled quotes and line ends.  Line ends in
    cells forbid splitting a file; for files that have none, ``multiline=False`` lets
    one large file be read by many tasks.

    With ``schema`` nothing is inferred and the scan stays lazy; columns are
    matched by name.
    """
    raw = _text(spark, path, sep, multiline)
    schema = schema or infer_types(raw, nulls)
    return raw.select(*[_cell(f.name, nulls).cast(f.dataType).alias(f.name) for f in schema])


def read_lenient(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, sep: str = ",", multiline: bool = True
) -> DataFrame:
    """Serving scan: a cell that does not parse as its column's type is NULL."""
    raw = _text(spark, path, sep, multiline)
    picked = []
    for f in schema:
        cell = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            picked.append(F.when(cell != "", cell).alias(f.name))
        else:
            picked.append(cell.try_cast(f.dataType).alias(f.name))
    return raw.select(*picked)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def input_size(df: DataFrame) -> DataFrame:
    """Bytes on disk of the files behind a freshly read DataFrame."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    return files.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_bytes"),
        (F.coalesce(F.sum("file_size"), F.lit(0)) / F.lit(1048576.0)).alias("size_mb"),
    )
