"""The most frequent values of a column in bounded memory, exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymart.session import stage

# So many values are followed by the sketch of the first scan, and the others fall into so many buckets in the second.
TRACKED = 4096
BUCKETS = 1 << 16


def heavy_values(df: DataFrame, column: str, n: int = 15, tracked: int = TRACKED, buckets: int = BUCKETS) -> DataFrame:
    """``value`` and ``count`` of the ``n`` most frequent values, ties by value: what ``profile.top_values`` gives.

    A first scan sketches the values and proposes candidates. A second counts these exactly, and all other
    values by bucket of their hash: at most ``tracked`` + ``buckets`` rows a task are shuffled, however many distinct
    values there are. A value of a bucket is at most as frequent as the bucket. So the candidates are right, unless some
    bucket reaches the ``n``-th of them: only the values of such buckets are counted one by one, in a third scan.

    NULL is a value; an empty table gives no rows. ``df`` is read two or three times.
    """
    values = df.select(F.col("`" + column.replace("`", "``") + "`").alias("value"))
    found = F.expr(f"approx_top_k(value, {tracked}, {tracked})")
    candidates = values.filter(F.col("value").isNotNull()).agg(found.alias("found"))
    candidates = stage(candidates.select(F.explode("found.item").alias("known")).distinct(), "candidates")
    marked = values.join(candidates, F.col("value") == F.col("known"), "left")
    single = F.col("known").isNotNull() | F.col("value").isNull()
    bucket = F.when(~single, F.pmod(F.xxhash64("value"), F.lit(buckets)))
    counted = marked.groupBy(F.when(single, F.col("value")).alias("value"), bucket.alias("bucket"))
    counted = stage(counted.agg(F.count(F.lit(1)).alias("count")), "value-counts")
    best = counted.filter("bucket is null").select("value", "count").orderBy(F.desc("count"), "value").limit(n)
    least = best.agg(F.when(F.count(F.lit(1)) == n, F.min("count")).otherwise(0)).first()[0]
    open_buckets = counted.filter(F.col("bucket").isNotNull() & (F.col("count") >= least))
    open_buckets = open_buckets.select(F.col("bucket").alias("__bucket"))
    if not open_buckets.limit(1).count():
        return best
    open_buckets = stage(open_buckets, "open-buckets")
    rest = values.join(candidates, F.col("value") == F.col("known"), "left_anti").filter(F.col("value").isNotNull())
    rest = rest.join(open_buckets, F.pmod(F.xxhash64("value"), F.lit(buckets)) == F.col("__bucket"), "left_semi")
    rest = rest.groupBy("value").agg(F.count(F.lit(1)).alias("count"))
    return best.unionByName(rest).orderBy(F.desc("count"), "value").limit(n)
