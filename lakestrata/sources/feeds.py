"""Landed JSON feeds: indicator series and weather observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lakestrata import schemas
from lakestrata.functions.text import first_element

# Columns per weather variant (fixed values).
WEATHER_VARIANTS = {
    3: ["cidade", "temperatura", "condicao"],
    4: ["cidade", "temperatura", "condicao", "data_coleta"],
    5: ["cidade", "temperatura", "condicao", "umidade", "pressao"],
    7: ["cidade", "temperatura", "condicao", "umidade", "pressao", "velocidade_vento", "data_coleta"],
}


def read_indicator(spark: SparkSession, path: str) -> DataFrame:
    """Files that each hold a JSON array of {data, valor}."""
    return spark.read.option("multiLine", True).schema(schemas.INDICATOR).json(path)


def flatten_indicator(documents: DataFrame, column: str = "json") -> DataFrame:
    """One row (data, valor) per element of the JSON arrays in a text column."""
    parsed = F.from_json(F.col(column), schemas.INDICATOR_DOC)
    kept = [c for c in documents.columns if c != column]
    return documents.select(*kept, F.inline(parsed))


def _weather(column: str) -> Column:
    corrupt = T.StructType([*schemas.WEATHER_DOC.fields, T.StructField("_corrupt", T.StringType())])
    return F.from_json(F.col(column), corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})


def _complete(doc: Column) -> Column:
    """Every nested value the 7-column row needs is there."""
    needed = [
        doc["main"]["temp"], doc["main"]["humidity"], doc["main"]["pressure"],
        first_element(doc["weather"])["description"], doc["wind"]["speed"],
    ]
    whole = doc["_corrupt"].isNull()
    for value in needed:
        whole = whole & value.isNotNull()
    return F.coalesce(whole, F.lit(False))


def flatten_weather(documents: DataFrame, variant: int = 7, column: str = "json") -> DataFrame:
    """Flat weather rows; ``cidade`` and ``data_coleta`` come with the document."""
    fields = WEATHER_VARIANTS[variant]
    doc = F.col("_doc")
    values = {
        "cidade": F.col("cidade"),
        "temperatura": doc["main"]["temp"],
        "condicao": first_element(doc["weather"])["description"],
        "umidade": doc["main"]["humidity"],
        "pressao": doc["main"]["pressure"],
        "velocidade_vento": doc["wind"]["speed"],
    }
    if "data_coleta" in fields:
        values["data_coleta"] = F.col("data_coleta")
    parsed = documents.withColumn("_doc", _weather(column))
    extra = [c for c in documents.columns if c not in (column, "cidade", "data_coleta")]
    return parsed.select(*extra, *[values[f].alias(f) for f in fields])


def split_malformed(documents: DataFrame, column: str = "json") -> tuple[DataFrame, DataFrame]:
    """(good, bad) documents: bad JSON or a missing nested value rejects one
    document and leaves the others."""
    checked = documents.withColumn("_good", _complete(_weather(column)))
    return checked.where("_good").drop("_good"), checked.where("not _good").drop("_good")
