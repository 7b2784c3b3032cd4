"""JSON of any shape: parsed once into VARIANT, typed by the schema all records have in common."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citymart.session import stage

CORRUPT = "_corrupt_record"


def _parsed(text: Column) -> Column:
    """The value that a text holds, NULL if it is not one JSON value from its beginning to its end. The parser stops
    behind the first value, so the text goes in as the only element of an array."""
    array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    first, second = (F.try_variant_get(array, f"$[{i}]", "variant") for i in (0, 1))
    return F.when(second.isNull(), first)


def read_records(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Every record of JSON files as ``record`` (VARIANT) and ``CORRUPT`` (text that is no record, else NULL).

    A file holds one record or array per line, or one document that is a record or an array. Lines are read once, in
    splits of any file size, parsed, and kept as a staged table. Only files with a line that is no JSON of its own are
    read again, as one document each; where that is no JSON either, their other lines count and the broken
    ones are kept as text. Blank lines and empty files have no records; NULLs, numbers and texts are none either.
    """
    text, path = F.col("text"), F.col("_metadata.file_path").alias("file")
    lines = spark.read.text(list(files)).select(path, F.trim("value").alias("text")).filter(text != "")
    lines = lines.select("file", _parsed(text).alias("value"), "text")
    lines = lines.select("file", "value", F.when(F.col("value").isNull(), text).alias("broken"))
    lines = stage(lines, "json-lines")
    odd = [r["file"] for r in lines.filter("broken is not null").select("file").distinct().collect()]
    if odd:
        whole = spark.read.text(odd, wholetext=True).select(path, _parsed(F.col("value")).alias("value"))
        whole = stage(whole.filter(F.col("value").isNotNull()), "json-documents")
        read_whole = whole.select("file", "value", F.lit(None).cast("string").alias("broken"))
        lines = lines.join(whole.select("file"), "file", "left_anti").unionByName(read_whole)
    kind = F.schema_of_variant("value")
    one = F.when(kind.startswith("OBJECT"), F.array("value"))
    several = F.when(kind.startswith("ARRAY"), F.try_variant_get("value", "$", "array<variant>"))
    found = lines.select(F.explode_outer(F.coalesce(one, several)).alias("record"), F.col("broken").alias(CORRUPT))
    return found.filter(F.schema_of_variant("record").startswith("OBJECT") | F.col(CORRUPT).isNotNull())


def _settled(kind: T.DataType, top: bool = True) -> T.DataType:
    """The type a column gets: decimals become doubles; what is of several kinds, or always NULL, becomes text."""
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale or kind.precision > 18 else T.LongType()
    if isinstance(kind, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_settled(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in kind])
    return kind


def record_schema(records: DataFrame) -> T.StructType:
    """The columns all records have in common, from one aggregation."""
    found = records.agg(F.schema_of_variant_agg("record")).first()[0]
    if not found.startswith("OBJECT<"):
        return T.StructType()
    ddl = re.sub(r"(^|: |ARRAY<)OBJECT<", r"\1STRUCT<", found)
    return _settled(T.DataType.fromDDL(ddl.replace("OBJECT<>", "STRUCT<>")))


def _path(name: str) -> str:
    return f"""$['{name}']""" if "'" not in name else f'''$["{name}"]'''


def _typed(record: Column, field: T.StructField) -> Column:
    return F.try_variant_get(record, _path(field.name), field.dataType.simpleString()).alias(field.name)


def typed_records(records: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The records as columns of ``schema``, by default the one they have in common. A value that does not fit its
    column is NULL; one of a column of several kinds is its JSON text."""
    schema = schema or record_schema(records)
    return records.select(*[_typed(F.col("record"), f) for f in schema])


def read_json(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """JSON files as one table; the text of broken records in the column ``CORRUPT``, if there are any."""
    records = read_records(spark, files)
    schema = record_schema(records)
    columns = [_typed(F.col("record"), f) for f in schema]
    broken = records.filter(F.col(CORRUPT).isNotNull())
    return records.select(*columns, *([CORRUPT] if broken.limit(1).count() else []))
