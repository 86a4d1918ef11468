"""Running values over a total order, however the rows are spread over the keys.

A window partitioned by a key puts a hot key into one task. Here a key's rows are dealt over buckets that follow the
order, such as stretches of time: what comes before a bucket is added up over the buckets' totals, of which a key has
few, and travels as one row in front of the bucket's own. Buckets depend on the rows' values alone, so a row finds the
same bucket again when a lost task is repeated, and nothing has to be pinned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_bucket"
#: Numbers in a row that make up one bucket of ordinals.
STRETCH = 100_000
#: Finer parts of the chosen value ranges of a percentile.
PARTS = 4096

_FOLD = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def stretch(value: Column, width: int) -> Column:
    """Buckets of a whole number."""
    return F.floor(value / F.lit(width))


def with_carries(df: DataFrame, carries: DataFrame) -> DataFrame:
    """Rows and, marked by `_row` = 0, the carry of each bucket, which holds the bucket's columns and its running inputs."""
    return df.withColumn("_row", F.lit(1)).unionByName(carries.withColumn("_row", F.lit(0)), allowMissingColumns=True)


def in_bucket(keys: list[str], order: list, inclusive: bool = True) -> Window:
    """The rows of a bucket from its carry on."""
    sort = [F.col(item) if isinstance(item, str) else item for item in order]
    return Window.partitionBy(*keys, BUCKET).orderBy("_row", *sort).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def earlier(keys: list[str]) -> Window:
    """The buckets of a key before this one."""
    return Window.partitionBy(*keys).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)


def running(df: DataFrame, keys: list[str], bucket: Column, order: list, values: dict[str, tuple[str, Column]], inclusive: bool = True) -> DataFrame:
    """Add running values: name -> (sum|count|max|min, column).

    `bucket` must not fall while the order goes on. Inclusive values cover the row itself, exclusive ones only the rows
    before it.
    """
    inputs = {f"_in_{name}": F.when(value.isNotNull(), 1).otherwise(0) if kind == "count" else value for name, (kind, value) in values.items()}
    staged = df.withColumn(BUCKET, bucket).withColumns(inputs)
    totals = staged.groupBy(*keys, BUCKET).agg(*[_FOLD[kind](f"_in_{name}").alias(f"_in_{name}") for name, (kind, _) in values.items()])
    carries = totals.select(*keys, BUCKET, *[_FOLD[kind](f"_in_{name}").over(earlier(keys)).alias(f"_in_{name}") for name, (kind, _) in values.items()])
    within = in_bucket(keys, order, inclusive)
    results = {}
    for name, (kind, _) in values.items():
        result = _FOLD[kind](f"_in_{name}").over(within)
        results[name] = F.coalesce(result, F.lit(0)) if kind == "count" else result
    kept = [name for name in df.columns if name not in results]
    placed = with_carries(staged, carries).select(*kept, "_row", *[value.alias(name) for name, value in results.items()])
    return placed.filter("_row = 1").drop("_row")


def global_ordinal(df: DataFrame, bucket: Column, order: list, name: str = "ordinal") -> DataFrame:
    """0-based position of each row in the order, which must be total for a repeatable result."""
    return running(df, [], bucket, order, {name: ("count", F.lit(1))}, inclusive=False)


def keyed_ordinal(df: DataFrame, keys: list[str], bucket: Column, order: list, name: str = "ordinal") -> DataFrame:
    """0-based position of each row within its key."""
    return running(df, keys, bucket, order, {name: ("count", F.lit(1))}, inclusive=False)


def _coarse(value: Column) -> Column:
    """Eighths of the powers of two: a bucket that grows with the value, whatever its size."""
    size = F.floor(F.log2(F.abs(value)) * 8) + 10_000
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("long"))


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> tuple[DataFrame, Column]:
    """`right` with other names for these columns, and that they equal those of `left`, NULL included."""
    renamed = right.withColumnsRenamed({name: f"_r_{name}" for name in names})
    match = F.lit(True)
    for name in names:
        match = match & left[name].eqNullSafe(renamed[f"_r_{name}"])
    return renamed, match


def exact_percentiles(df: DataFrame, keys: list[str], value: str, points: dict[str, float]) -> DataFrame:
    """Linear-interpolation percentiles per key over the values that are neither NULL nor NaN.

    Nothing is sorted as a whole: equal values are counted, the counts of coarse value ranges tell which of them hold
    the wanted ranks, those ranges are split finely and counted again, and only the values of the parts that hold a
    wanted rank are put in order. So one key may hold any share of the rows.
    """
    if not keys:
        return exact_percentiles(df.withColumn("_all", F.lit(0)), ["_all"], value, points).drop("_all")
    number = F.col(value).cast("double")
    counted = (
        df.filter(F.col(value).isNotNull() & ~F.isnan(number))
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_range", _coarse(F.col("_value").cast("double")))
    )
    whole = Window.partitionBy(*keys)
    ranges = counted.groupBy(*keys, "_range").agg(F.sum("_n").alias("_m"), F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    placed = ranges.select(
        *keys, "_range", "_m", "_low", "_high",
        F.coalesce(F.sum("_m").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_m").over(whole).alias("n"), F.min("_low").over(whole).alias("min"), F.max("_high").over(whole).alias("max"),
    )
    places = [(F.col("n") - 1) * F.lit(float(q)) for q in points.values()]
    ranks = F.array_distinct(F.array(*[side(place).cast("long") for place in places for side in (F.floor, F.ceil)]))

    def held(names: Column, first: Column, size: Column) -> Column:
        return F.filter(names, lambda rank: (rank >= first) & (rank < first + size))

    chosen = placed.withColumn("_ranks", held(ranks, F.col("_before"), F.col("_m"))).filter(F.size("_ranks") > 0).drop("_m")
    renamed, match = _same(counted, chosen, [*keys, "_range"])
    low, high = (F.col(name).cast("double") for name in ("_low", "_high"))
    part = F.when(high > low, F.floor((F.col("_value").cast("double") - low) / (high - low) * PARTS)).otherwise(F.lit(0).cast("long"))
    narrow = counted.join(renamed, match).select(*keys, "_range", "_value", "_n", part.alias("_part"), "_before", "_ranks", "n", "min", "max")
    once = [F.first(name).alias(name) for name in ("_before", "_ranks", "n", "min", "max")]
    parts = narrow.groupBy(*keys, "_range", "_part").agg(F.sum("_n").alias("_m"), *once)
    so_far = Window.partitionBy(*keys, "_range").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    begun = parts.withColumn("_from", F.col("_before") + F.coalesce(F.sum("_m").over(so_far), F.lit(0)))
    fine = begun.withColumn("_ranks", held(F.col("_ranks"), F.col("_from"), F.col("_m"))).filter(F.size("_ranks") > 0)
    base = narrow.select(*keys, "_range", "_part", "_value", "_n")
    renamed, match = _same(base, fine.select(*keys, "_range", "_part", "_from", "_ranks", "n", "min", "max"), [*keys, "_range", "_part"])
    rows = base.join(renamed, match)
    upto = Window.partitionBy(*keys, "_range", "_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("_from") + F.coalesce(F.sum("_n").over(upto), F.lit(0))
    ranked = rows.withColumn("_first", first).withColumn("_ranks", held(F.col("_ranks"), F.col("_first"), F.col("_n"))).filter(F.size("_ranks") > 0)
    # At most two values for each point.
    found = ranked.select(*keys, "n", "min", "max", F.explode("_ranks").alias("_rank"), F.col("_value").cast("double").alias("_value"))
    told = found.groupBy(*keys).agg(
        *[F.first(name).alias(name) for name in ("n", "min", "max")], F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_at")
    )
    columns = []
    for label, place in zip(points, places, strict=True):
        below, above = (F.element_at("_at", side(place).cast("long")) for side in (F.floor, F.ceil))
        columns.append((below + (above - below) * (place - F.floor(place))).alias(label))
    return told.select(*keys, "n", "min", "max", *columns)
