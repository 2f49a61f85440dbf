"""Items laid out by an interleaved key of brand, year and price, and read by range.

Every dimension is cut into 2**``BITS`` ranges of about equal weight, and the bits
of the ranges' numbers are interleaved, so items that are alike in all three lie
together.  The table is written in ranges of that key, with bloom filters on
brands, and beside it a manifest: for each file the least and greatest brand,
year and price.  A search opens only the files whose ranges meet its conditions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIMENSIONS = ("marca", "autoano", "precio")
BITS = 6


def _bounds(items: DataFrame, name: str) -> list:
    """At most 2**``BITS`` - 1 values that cut a dimension evenly."""
    steps = [i / 2**BITS for i in range(1, 2**BITS)]
    if items.schema[name].dataType.simpleString() == "string":
        # of the most frequent values; a bounded number of rows
        top = items.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), name).limit(len(steps)).collect()
        return sorted(r[name] for r in top)
    found = items.agg(F.percentile_approx(name, steps, 10_000).alias("b")).first().b
    return sorted(set(found or []))


def _passed(cuts: Column, value: Column) -> Column:
    """How many of the bounds a value has reached."""
    return F.size(F.filter(cuts, lambda b: b <= value)).cast("long")


def key(bounds: dict[str, list], kinds: dict[str, str]) -> Column:
    """The interleaved numbers of the ranges that an item is in; nulls come first."""
    numbers = []
    for name in DIMENSIONS:
        cuts = F.array(*[F.lit(b).cast(kinds[name]) for b in bounds[name]]).cast(f"array<{kinds[name]}>")
        numbers.append(_passed(cuts, F.col(name)))
    out = F.lit(0).cast("long")
    for bit in range(BITS):
        for place, number in enumerate(numbers):
            moved = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(moved, bit * len(numbers) + place))
    return out


def write(items: DataFrame, path: str, files: int = 64) -> None:
    """Writes ``items`` and their manifest at ``path``."""
    spark = items.sparkSession
    kinds = {n: items.schema[n].dataType.simpleString() for n in DIMENSIONS}
    bounds = {n: _bounds(items, n) for n in DIMENSIONS}
    laid = items.withColumn("_z", key(bounds, kinds))
    dealt = laid.repartitionByRange(files, "_z", "id").sortWithinPartitions("_z", "id").drop("_z")
    dealt.write.option("parquet.bloom.filter.enabled#marca", "true").parquet(f"{path}/items")
    ranges = [f(n).alias(f"{w}_{n}") for n in DIMENSIONS for w, f in (("min", F.min), ("max", F.max))]
    spark.read.parquet(f"{path}/items").groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"), *ranges).coalesce(1).write.parquet(f"{path}/manifest")


def files_for(spark: SparkSession, path: str, brand: str | None = None, at_least: dict[str, float | None] | None = None, at_most: dict[str, float | None] | None = None) -> list[str]:
    """The files that may hold such items; one row a file is looked at."""
    manifest = spark.read.parquet(f"{path}/manifest")
    if brand:
        manifest = manifest.where((F.col("min_marca") <= brand) & (F.col("max_marca") >= brand))
    for name, value in (at_least or {}).items():
        if value and name in DIMENSIONS:
            manifest = manifest.where(F.col(f"max_{name}") >= value)
    for name, value in (at_most or {}).items():
        if value and name in DIMENSIONS:
            manifest = manifest.where(F.col(f"min_{name}") <= value)
    return sorted(r.file for r in manifest.select("file").collect())


def read(spark: SparkSession, path: str, brand: str | None = None, at_least: dict[str, float | None] | None = None, at_most: dict[str, float | None] | None = None) -> DataFrame:
    """The items that meet the conditions, from the files that may have any.

    ``brand`` is a whole name; empty and zero values are no conditions.
    """
    schema = spark.read.parquet(f"{path}/items").schema
    files = files_for(spark, path, brand, at_least, at_most)
    found = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    conditions = [F.col("marca") == brand] if brand else []
    conditions += [F.col(c) >= v for c, v in (at_least or {}).items() if v] + [F.col(c) <= v for c, v in (at_most or {}).items() if v]
    for condition in conditions:
        found = found.where(condition)
    return found
