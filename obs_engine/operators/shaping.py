"""Nested documents to flat tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obs_engine.functions import quoted


def explode_records(df: DataFrame, records: str, parents: Sequence[str] = ()) -> DataFrame:
    """One row per element of the struct array ``records``, with parent fields kept.

    ``records`` and ``parents`` may be struct paths. A parent keeps the last part of
    its path as name.
    """
    kept = [F.col(p).alias(p.rsplit(".", 1)[-1]) for p in parents]
    return df.select(F.explode(records).alias("_record"), *kept).select(
        "_record.*", *[F.col(quoted(p.rsplit(".", 1)[-1])) for p in parents]
    )


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs to top-level columns named by their path; arrays stay one cell."""

    def leaves(schema: T.StructType, path: list[str]) -> list[Column]:
        found: list[Column] = []
        for field in schema.fields:
            here = [*path, field.name]
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                found.append(F.col(".".join(map(quoted, here))).alias(sep.join(here)))
        return found

    return df.select(*leaves(df.schema, []))


def rejected_weather(documents: DataFrame) -> DataFrame:
    """Documents without a list of days, such as answers that tell an error."""
    return documents.where(F.col("forecast.forecastday").isNull())


def raw_weather(documents: DataFrame, strict: bool = True) -> DataFrame:
    """Weather documents to raw rows: one per (city, day), columns named by path.

    Columns beside the forecast, such as the arrival time, are kept. A document without
    a list of days raises; if not ``strict`` it is left out, see ``rejected_weather``. An
    empty list gives no rows.
    """
    parents = [c for c in documents.columns if c != "forecast"]
    days = F.col("forecast.forecastday")
    if strict:
        error = F.raise_error(F.lit("document without days"))
        days = F.when(days.isNull(), error).otherwise(days)
    checked = documents.select(days.alias("_days"), *map(quoted, parents))
    return flatten_struct(explode_records(checked, "_days", parents))


def raw_or_rejected(documents: DataFrame) -> DataFrame:
    """Raw rows of documents with days, and one row with ``_rejected`` for each without a list.

    ``_rejected`` is the document as JSON. The documents are read once for both.
    """
    parents = [c for c in documents.columns if c != "forecast"]
    days = F.col("forecast.forecastday")
    document = F.to_json(F.struct(*map(quoted, documents.columns)))
    marked = documents.select(
        F.explode_outer(days).alias("_record"),
        F.when(days.isNull(), document).alias("_rejected"),
        *map(quoted, parents),
    )
    filled = marked.where(F.col("_record").isNotNull() | F.col("_rejected").isNotNull())
    return flatten_struct(filled.select("_record.*", "_rejected", *map(quoted, parents)))


def raw_population(documents: DataFrame) -> DataFrame:
    """Population documents to one row per (city, country, year)."""
    cities = explode_records(documents, "data")
    return explode_records(cities, "populationCounts", ["city", "country"])


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column missing in one of them is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in floating point columns, other columns untouched."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(quoted(c)), F.col(quoted(c))).alias(c)
            if c in floats
            else F.col(quoted(c))
            for c in df.columns
        ]
    )


# Fixed order: a numeric type is widened to a later one of its row without loss.
WIDER = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("int", "double"))


def _wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    for row in WIDER:
        names = [t.simpleString() for t in (one, other)]
        if all(n in row for n in names):
            return max((one, other), key=lambda t: row.index(t.simpleString()))
    return None


def widened(known: T.StructType, found: T.StructType) -> T.StructType:
    """``known`` with the fields only ``found`` has, and numeric types wide enough for both.

    Structs and arrays of structs are merged field by field. The order of ``known`` stays.
    """

    def merged(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
        if one == other or isinstance(other, T.NullType):
            return one
        if isinstance(one, T.StructType) and isinstance(other, T.StructType):
            return widened(one, other)
        if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
            return T.ArrayType(merged(name, one.elementType, other.elementType))
        wide = _wider(one, other)
        if wide is None:
            raise ValueError(f"{name} is {one.simpleString()}, not {other.simpleString()}")
        return wide

    there = {f.name: f.dataType for f in found}
    fields = [
        T.StructField(f.name, merged(f.name, f.dataType, there[f.name]) if f.name in there else f.dataType)
        for f in known
    ]
    names = {f.name for f in known}
    fields += [T.StructField(f.name, f.dataType) for f in found if f.name not in names]
    return T.StructType(fields)
