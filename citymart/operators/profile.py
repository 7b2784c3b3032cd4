"""Profiling of any table: missing values, duplicates, distributions, quality scores."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citymart.functions import columns as C
from citymart.functions.schema import columns_by_class, numeric_columns, type_class
from citymart.operators.kpi import pearson
from citymart.operators.quantiles import group_quantiles, join_on


def _ref(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype)
    return False


def _comparable(field: T.StructField) -> Column:
    """The column in a form that can be grouped by: maps become sorted entries."""
    value = _ref(field.name)
    if isinstance(field.dataType, T.MapType) and not _holds_map(field.dataType.valueType):
        return F.array_sort(F.map_entries(value))
    return F.to_json(F.struct(value)) if _holds_map(field.dataType) else value


def identity(df: DataFrame, keys: Sequence[str] | None, exact: bool) -> list[Column]:
    """What two rows must share to be copies: their columns in comparable form, or the halves of a fingerprint."""
    fields = [df.schema[k] for k in (keys or df.columns)]
    if exact:
        return [_comparable(f).alias(f"id_{i}") for i, f in enumerate(fields)]
    parts: list[Column] = []
    for field in fields:
        # The hash passes over NULLs, so their places go in as values; nested values go in as text.
        value = _comparable(field)
        if isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            value = F.to_json(F.struct(value), {"ignoreNullFields": "false"})
        parts += [value, _ref(field.name).isNull()]
    return [
        F.xxhash64(*parts).alias("id_0"),
        F.xxhash64(F.lit(len(parts)), *reversed(parts)).alias("id_1"),
    ]


def _missing(df: DataFrame) -> list[Column]:
    return [_ref(c).isNull().cast("long") for c in df.columns]


def row_nulls(df: DataFrame) -> Column:
    """How many columns of a row are missing."""
    return sum(_missing(df), F.lit(0).cast("long"))


# ------------------------------------------------- missing values, duplicates


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values of every column, from one pass: ``(column_name, missing_count, missing_pct)``."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.coalesce(F.sum(m), F.lit(0)).alias(f"m_{i}") for i, m in enumerate(_missing(df))],
    )
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"m_{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select("rows", F.inline(F.array(*pairs))).select(
        "column_name", "missing_count", C.percent_of(F.col("missing_count"), F.col("rows")).alias("missing_pct")
    )


def missing_top(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` columns with the largest share of missing values; complete columns are left out."""
    return (
        null_profile(df)
        .filter(F.col("missing_count") > 0)
        .orderBy(F.desc("missing_pct"), "column_name")
        .limit(n)
    )


def null_totals(df: DataFrame) -> DataFrame:
    """One row ``(record_count, column_count, null_count, null_percentage)`` from one pass."""
    cells = F.lit(len(df.columns))
    return df.agg(
        F.count(F.lit(1)).alias("record_count"), F.coalesce(F.sum(row_nulls(df)), F.lit(0)).alias("null_count")
    ).select(
        "record_count",
        cells.alias("column_count"),
        "null_count",
        C.percent_of(F.col("null_count"), F.col("record_count") * cells).alias("null_percentage"),
    )


def duplicate_profile(df: DataFrame, keys: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Rows beyond the first of their kind, over all columns or the given keys.

    Copies are counted map-side, so a row repeated a billion times reaches the shuffle once per
    task. ``exact=False`` shuffles a 128-bit fingerprint instead of the columns, which spares wide
    tables most of the traffic; two different rows share one with a chance of about n² / 2^129.
    """
    kinds = df.select(*identity(df, keys, exact))
    kinds = kinds.groupBy(*kinds.columns).agg(F.count(F.lit(1)).alias("copies"))
    return kinds.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("unique_rows")
    ).select(
        "total_rows",
        "unique_rows",
        (F.col("total_rows") - F.col("unique_rows")).alias("duplicate_count"),
        C.percent_of(F.col("total_rows") - F.col("unique_rows"), F.col("total_rows")).alias(
            "duplicate_percentage"
        ),
    )


def distinct_kinds(df: DataFrame, figures: dict[str, Column], exact: bool) -> DataFrame:
    """Each kind of row once, with its ``copies`` and the given figures, which follow from the row."""
    kinds = df.select(*identity(df, None, exact), *[f.alias(n) for n, f in figures.items()])
    return kinds.groupBy(*kinds.columns).agg(F.count(F.lit(1)).alias("copies"))


def quality_metrics(df: DataFrame, exact: bool = True) -> DataFrame:
    """Size, missing cells and duplicates of a table in one row and one pass."""
    kinds = distinct_kinds(df, {"row_nulls": row_nulls(df)}, exact)
    cells = F.lit(len(df.columns))
    return (
        kinds.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.col("copies") * F.col("row_nulls")), F.lit(0)).alias("total_missing"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_count"),
        )
        .select(
            "total_rows",
            cells.alias("total_columns"),
            "total_missing",
            C.percent_of(F.col("total_missing"), F.col("total_rows") * cells).alias("missing_percentage"),
            "duplicate_count",
            C.percent_of(F.col("duplicate_count"), F.col("total_rows")).alias("duplicate_percentage"),
        )
    )


def missing_matrix(df: DataFrame, rows: int = 100, columns: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """1 where a value is missing, else 0, for the first rows and columns."""
    head = df.orderBy(*order_by).limit(rows) if order_by else df.limit(rows)
    return head.select(*[_ref(c).isNull().cast("int").alias(c) for c in df.columns[:columns]])


# ------------------------------------------------------------- distributions


def _finite(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 50) -> DataFrame:
    """Equal-width bins of each column: ``(column_name, bin, lower, upper, count)``, empty bins left out.

    All numeric columns by default. The limits are those of the finite values; infinities and NaN
    are counted in a row without bin and limits. The limits come from a scalar subquery, so counting
    needs no join and combines map-side, by one number for column and bin; names and limits follow for
    the few counted rows.
    """
    columns = list(columns or numeric_columns(df))
    limits = df.agg(
        F.struct(
            *[
                f(_finite(_ref(c).cast("double"))).alias(f"{n}_{i}")
                for i, c in enumerate(columns)
                for n, f in (("lo", F.min), ("hi", F.max))
            ]
        ).alias("limits")
    ).scalar()
    cells = []
    for i, name in enumerate(columns):
        value, low, high = _ref(name).cast("double"), limits[f"lo_{i}"], limits[f"hi_{i}"]
        place = F.try_divide(value - low, high - low) * bins
        inside = F.least(F.lit(bins - 1), F.coalesce(F.floor(place), F.lit(0))).cast("int")
        number = F.when(_finite(value).isNotNull(), inside).otherwise(bins)
        cells.append(F.when(value.isNotNull(), number + i * (bins + 1)))
    counts = (
        df.select(F.explode(F.array(*cells)).alias("cell"))
        .filter(F.col("cell").isNotNull())
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    place, bin_ = F.expr(f"cell div {bins + 1}").cast("int"), F.col("cell") % (bins + 1)
    known = counts.select(
        F.get(F.array(*[F.lit(c) for c in columns]), place).alias("column_name"),
        F.when(bin_ < bins, bin_).alias("bin"),
        *[F.get(F.array(*[limits[f"{n}_{i}"] for i in range(len(columns))]), place).alias(n) for n in ("lo", "hi")],
        "count",
    )
    low, width = F.col("lo"), (F.col("hi") - F.col("lo")) / bins
    lower, upper = low + F.col("bin") * width, low + (F.col("bin") + 1) * width
    return known.select("column_name", "bin", lower.alias("lower"), upper.alias("upper"), "count")


def top_values(df: DataFrame, column: str, n: int = 15) -> DataFrame:
    """The most frequent values of a column, ties by value."""
    return (
        df.groupBy(_ref(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "value")
        .limit(n)
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns, one pass: ``(col_a, col_b, r)``.

    All numeric columns by default.
    """
    columns = list(columns or numeric_columns(df))
    if len(columns) < 2:
        raise ValueError("correlation needs at least two numeric columns")
    pairs = [(a, b) for a, b in combinations(range(len(columns)), 2)] + [(a, a) for a in range(len(columns))]
    values = [_ref(c).cast("double") for c in columns]
    sums = df.agg(*[pearson(values[a], values[b]).alias(f"r_{a}_{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(columns[x]).alias("col_a"), F.lit(columns[y]).alias("col_b"), F.col(f"r_{a}_{b}").alias("r"))
        for a, b in pairs
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return sums.select(F.inline(F.array(*cells)))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Summary statistics, one row per column.

    Numeric columns get moments, limits and quartiles (nearest rank), infinities and NaN included;
    text and dates get their limits as text; anything else its counts.
    """
    fields = [df.schema[c] for c in (columns or df.columns)]
    classes = [type_class(f.dataType) for f in fields]
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    aggregates: list[Column] = [F.count(F.lit(1)).alias("rows")]
    cells = []
    for i, (field, kind) in enumerate(zip(fields, classes)):
        value = _ref(field.name)
        aggregates.append(F.count(value).alias(f"c_{i}"))
        numbers = {"mean": none, "std": none, "min": none, "max": none}
        texts = {"min_text": text, "max_text": text}
        if kind == "numeric":
            number = value.cast("double")
            for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
                aggregates.append(f(number).alias(f"{name}_{i}"))
                numbers[name] = F.col(f"{name}_{i}")
        elif kind in ("categorical", "date"):
            for name, f in (("min_text", F.min), ("max_text", F.max)):
                aggregates.append(f(value).cast("string").alias(f"{name}_{i}"))
                texts[name] = F.col(f"{name}_{i}")
        cells.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.col(f"c_{i}").alias("count"),
                (F.col("rows") - F.col(f"c_{i}")).alias("null_count"),
                *[e.alias(n) for n, e in {**numbers, **texts}.items()],
            )
        )
    stats = df.agg(*aggregates).select(F.inline(F.array(*cells)))
    numeric = [f.name for f, kind in zip(fields, classes) if kind == "numeric"]
    if not numeric:
        return stats.select(
            "*", *[none.alias(q) for q in ("p25", "p50", "p75")]
        )
    long = df.select(*[_ref(c).cast("double").alias(c) for c in numeric]).unpivot(
        [], numeric, "column_name", "value"
    )
    outputs = {"p25": ("value", 0.25), "p50": ("value", 0.5), "p75": ("value", 0.75)}
    [found] = group_quantiles(long, [["column_name"]], outputs, rule="nearest")
    return join_on(stats, found, ["column_name"], "left")


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a seeded hash of ``keys``: the same sample on every run.

    A count per hash prefix tells how far down the order the sample reaches, so only about ``n``
    rows, not ``n`` per task, go to the final sort.
    """
    hashed = df.withColumn("__hash", F.md5(F.concat_ws("|", F.lit(str(seed)), *[_ref(k) for k in keys])))
    prefix = F.substring("__hash", 1, 4)
    counts = hashed.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("prefix"))  # at most 65536 rows
    last = (
        counts.withColumn("upto", upto).filter(F.col("upto") >= n).agg(F.min("prefix").alias("last")).scalar()
    )
    near = prefix <= F.coalesce(last, F.lit("ffff"))
    return hashed.filter(near).orderBy("__hash", *[_ref(k) for k in keys]).limit(n).drop("__hash")


def preview(df: DataFrame, rows: int = 100) -> DataFrame:
    """The first rows of a table; the limit reaches the scan."""
    return df.limit(rows)


def clipped_preview(df: DataFrame, rows: int = 3, columns: int = 8, width: int = 20) -> DataFrame:
    """A narrow preview: few rows, few columns, long text clipped."""
    text = set(columns_by_class(df)["categorical"])
    return df.limit(rows).select(
        *[C.clip_text(_ref(c), width).alias(c) if c in text else _ref(c) for c in df.columns[:columns]]
    )


# ------------------------------------------------------------ quality scores


def quality_scores(metrics: DataFrame) -> DataFrame:
    """Scores out of the missing and duplicate percentages of :func:`quality_metrics`."""
    missing, duplicate = F.col("missing_percentage"), F.col("duplicate_percentage")
    return metrics.select(
        F.greatest(F.lit(0.0), 100 - (missing + duplicate)).alias("overview_score"),
        (100 - missing).alias("completeness"),
        (100 - duplicate).alias("uniqueness"),
        ((100 - missing + 100 - duplicate) / 2).alias("overall_quality"),
    )


def insights(metrics: DataFrame, numeric_count: int) -> DataFrame:
    """The rules a table trips: ``(rule, value)``; no row means the table looks fine."""
    value = {
        "high_missing_rate": (F.col("missing_percentage") > 10, F.col("missing_percentage")),
        "significant_duplicates": (F.col("duplicate_percentage") > 5, F.col("duplicate_percentage")),
        "no_numeric_columns": (F.lit(numeric_count == 0), F.lit(float(numeric_count))),
        "small_dataset": (F.col("total_rows") < 100, F.col("total_rows").cast("double")),
    }
    cells = [
        F.struct(hit.alias("hit"), F.lit(rule).alias("rule"), number.alias("value"))
        for rule, (hit, number) in value.items()
    ]
    return metrics.select(F.inline(F.array(*cells))).filter("hit").drop("hit")


def quality_bands(score: Column) -> Column:
    """A score split into the high, medium and low parts of a gauge."""
    zero = F.lit(0.0)
    return F.struct(
        F.greatest(zero, score - 80).alias("high_quality"),
        F.when(score > 50, F.least(F.lit(80.0), score - 50)).otherwise(F.greatest(zero, score)).alias("medium_quality"),
        F.greatest(zero, 50 - score).alias("low_quality"),
    )
