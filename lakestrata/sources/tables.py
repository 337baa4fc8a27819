"""Table readers: CSV, Parquet, Avro, layers, and the named-table loader."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F, types as T

from lakestrata import schemas
from lakestrata.operators.filters import normalise_na

LAYERS = ("bronze", "silver", "gold")


class MissingTableError(Exception):
    """A required table is absent, empty or lacks a column."""


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    normalise: bool = True,
    multi_line: bool = False,
    rescue: str | None = None,
) -> DataFrame:
    """CSV with a header row, UTF-8, quotes doubled inside quotes.

    Columns are found by the names in the file's header, as the session
    resolves names (without regard to case unless it is told otherwise): other
    columns and another order make no difference, and a column of the schema
    that the file lacks is NULL. A name that two columns of the file answer to
    is an error. Files of one folder must have the same header; one that
    differs fails the read. Without a schema every column is text; NA spellings
    become NULL either way, before values are converted. Files whose values
    hold line breaks need ``multi_line``, which reads each file as one split:
    keep such files small.

    A value that does not convert fails the read, unless ``rescue`` names a
    column for it: the value is then NULL, and the column lists what was lost
    as (column, text, reason); it is NULL for rows without loss. A row with
    too few or too many fields is listed there as well, with its whole text.
    """
    named = _header_columns(spark, path, multi_line)
    text = T.StructType([T.StructField(column, T.StringType()) for _, column in named])
    reader = _csv_reader(spark, multi_line).option("enforceSchema", False)
    if rescue:
        reader = reader.option("columnNameOfCorruptRecord", _CORRUPT).schema(text.add(_CORRUPT, T.StringType()))
    else:
        reader = reader.schema(text)
    raw = reader.csv(path)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    wanted = text if schema is None else schema
    found = {c: c for _, c in named} if schema is None else _resolved(spark, named, wanted)
    clean = normalise_na(raw) if normalise else raw
    if not rescue:
        return clean.select(*[
            (F.lit(None) if found[f.name] is None else F.col(f"`{found[f.name]}`")).cast(f.dataType).alias(f.name) for f in wanted
        ])
    if rescue in wanted.fieldNames():
        raise ValueError(f"the schema already has a column {rescue!r}")
    values, lost = [], []
    for f in wanted:
        value = F.lit(None).cast("string") if found[f.name] is None else F.col(f"`{found[f.name]}`")
        values.append(value.try_cast(f.dataType).alias(f.name))
        lost.append(F.when(
            value.isNotNull() & value.try_cast(f.dataType).isNull(),
            F.struct(F.lit(f.name).alias("column"), value.alias("text"), F.lit(f"no {f.dataType.simpleString()}").alias("reason")),
        ))
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.col(_CORRUPT).alias("text"), F.lit("wrong number of fields").alias("reason"))
    lost = F.array_compact(F.array(*lost, F.when(F.col(_CORRUPT).isNotNull(), whole)))
    return clean.select(*values, F.when(F.size(lost) > 0, lost).alias(rescue))


# Holds a row whose number of fields is not the header's, while it is read.
_CORRUPT = "_corrupt_csv_row"


def split_rescued(df: DataFrame, rescue: str) -> tuple[DataFrame, DataFrame]:
    """(rows read without loss, rows with something rescued), by ``read_csv``'s
    rescue column; both are plain filters."""
    return df.where(F.col(rescue).isNull()).drop(rescue), df.where(F.col(rescue).isNotNull())


def _csv_reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)


def _header_columns(spark: SparkSession, path: str, multi_line: bool) -> list[tuple[str, str]]:
    """(name in the header, name that Spark reads the column under). Spark
    renames names that occur twice."""
    columns = _csv_reader(spark, multi_line).csv(path).columns
    first = _csv_reader(spark, multi_line).option("header", False).csv(path).limit(1).collect()
    names = list(first[0]) if first else columns
    if len(names) != len(columns):
        return [(c, c) for c in columns]
    return [(column if name is None else name, column) for name, column in zip(names, columns)]


def _resolved(spark: SparkSession, named: Sequence[tuple[str, str]], schema: T.StructType) -> dict[str, str | None]:
    """The column that each name of the schema stands for; None if there is none."""
    folded = _folding(spark)
    out = {}
    for f in schema:
        found = [column for name, column in named if folded(name) == folded(f.name)]
        if len(found) > 1:
            raise ValueError(f"column {f.name!r} occurs {len(found)} times in the file's header")
        out[f.name] = found[0] if found else None
    return out


def _folding(spark: SparkSession) -> Callable[[str], str]:
    """What names are compared by: the session may tell cases apart."""
    return str if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower


def csv_header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """The column names in the header of a CSV file or folder."""
    return [name for name, _ in _header_columns(spark, path, multi_line)]


def explore_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types: a second pass over the file, for looking only."""
    return spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path)


def load_tables(
    spark: SparkSession,
    base: str,
    mapping: Mapping[str, str],
    table_schemas: Mapping[str, T.StructType] = schemas.DOMAIN,
    required: Mapping[str, Sequence[str]] | None = None,
    rescue: str | None = None,
) -> dict[str, DataFrame]:
    """Read several named tables; one that is missing, empty or lacks a
    required column fails the load. The format follows the file ending.
    ``rescue`` is that of ``read_csv``, for the CSV files among them."""
    tables = {}
    for name, relative in mapping.items():
        path = f"{base.rstrip('/')}/{relative}"
        try:
            if relative.endswith(".csv"):
                held = csv_header(spark, path)
                df = read_csv(spark, path, table_schemas.get(name), rescue=rescue)
            else:
                df = spark.read.parquet(path)
                held = df.columns
        except AnalysisException as error:
            raise MissingTableError(f"table {name!r} not found at {path}") from error
        # What the file holds, not what its schema declares.
        folded = _folding(spark)
        known = set(map(folded, held))
        lacking = [c for c in (required or {}).get(name, ()) if folded(c) not in known]
        if lacking:
            raise MissingTableError(f"table {name!r} lacks {', '.join(lacking)}")
        if df.isEmpty():
            raise MissingTableError(f"table {name!r} is empty")
        tables[name] = df
    return tables


def layer_path(root: str, layer: str, table: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"layer is one of {', '.join(LAYERS)}")
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_layer(
    spark: SparkSession,
    root: str,
    layer: str,
    table: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A table of a layer; ``root`` may be any file system Spark reads."""
    path = layer_path(root, layer, table)
    if fmt == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def avro_available(spark: SparkSession) -> bool:
    """Whether the session carries the external Avro module."""
    try:
        spark.read.format("avro").schema("data string").load("/nonexistent-avro-probe")
    except AnalysisException as error:
        return error.getCondition() == "PATH_NOT_FOUND"
    return True


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    if not avro_available(spark):
        raise RuntimeError("this Spark session has no Avro module (spark-avro)")
    return spark.read.format("avro").load(path)
