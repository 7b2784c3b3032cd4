"""Schema inspection: type classes and common types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CLASSES = ("numeric", "categorical", "date", "other")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = (*_INTEGRAL, T.FloatType, T.DoubleType)
_DATE = (T.DateType, T.TimestampType, T.TimestampNTZType)


def type_class(dtype: T.DataType) -> str:
    """numeric, categorical, date or other; decimals, booleans and nested types are other."""
    if isinstance(dtype, _NUMERIC):
        return "numeric"
    if isinstance(dtype, T.StringType):
        return "categorical"
    if isinstance(dtype, _DATE):
        return "date"
    return "other"


def columns_by_class(df: DataFrame) -> dict[str, list[str]]:
    found: dict[str, list[str]] = {name: [] for name in CLASSES}
    for field in df.schema:
        found[type_class(field.dataType)].append(field.name)
    return found


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_by_class(df)["numeric"]


def type_counts(df: DataFrame) -> DataFrame:
    """One row per type class that occurs: ``(type_class, column_count)``."""
    rows = [(name, len(cols)) for name, cols in columns_by_class(df).items() if cols]
    return df.sparkSession.createDataFrame(rows, "type_class string, column_count int")


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """The type that holds every given type; text where nothing narrower does."""
    distinct = [t for t in dict.fromkeys(types) if not isinstance(t, T.NullType)]
    if not distinct:
        return T.StringType()
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, (*_INTEGRAL, T.BooleanType)) for t in distinct):
        integral = [t for t in distinct if isinstance(t, _INTEGRAL)]
        return max(integral, key=lambda t: [type(t) is k for k in _INTEGRAL].index(True))
    if all(isinstance(t, (*_NUMERIC, T.BooleanType, T.DecimalType)) for t in distinct):
        return T.DoubleType()
    if all(isinstance(t, _DATE) for t in distinct):
        zoned = any(isinstance(t, T.TimestampType) for t in distinct)
        return T.TimestampType() if zoned else T.TimestampNTZType()
    if all(isinstance(t, T.StructType) for t in distinct):
        names = dict.fromkeys(name for t in distinct for name in t.fieldNames())
        return T.StructType(
            [T.StructField(n, common_type(t[n].dataType for t in distinct if n in t.fieldNames())) for n in names]
        )
    return T.StringType()
