"""What a search would tell of each row of a table of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import amounts, text
from marlstone.operators import history, terms
from marlstone.operators.filters import available

NOTHING = "Nothing meets these conditions; try wider ones."
#: Terms meet brands by so many of their first characters.
LEAD = 3


def _holding(wanted: DataFrame, brands: DataFrame) -> DataFrame:
    """(term, marca): the brands that hold each of ``wanted`` (term), in any case.

    A brand has a row for each of its stretches of up to ``LEAD`` characters; a
    term meets those that are its beginning.
    """
    lower = F.lower("marca")
    starts = F.sequence(F.lit(1), F.length(lower))
    pieces = F.array_distinct(F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.lit(LEAD)), lambda n: F.substr(lower, i, n)))))
    cut = brands.where("marca <> ''").select("marca", F.explode(pieces).alias("lead"))
    asked = wanted.select("term", F.substring(F.lower("term"), 1, LEAD).alias("lead"))
    return asked.join(cut, "lead").where(F.contains(F.lower("marca"), F.lower("term"))).select("term", "marca").distinct()


def search(requests: DataFrame, items: DataFrame, dictionary: DataFrame, suggestions: int = 10) -> DataFrame:
    """request_id, corrections and message of ``requests`` (request_id, marca, precio_minimo, precio_maximo).

    The message is that of a single search: null where any available item meets
    the request, else what is unknown and what there is, or that nothing meets
    the conditions.  Whether an item is in a band of prices is one lookup: the
    dearest item of the brand up to the upper end is at the lower end or above.
    Brands and bands meet items in stretches of price, so a frequent brand is
    spread over tasks.  Empty and zero values are no conditions.
    """
    full = lambda c: F.when(F.coalesce(F.col(c), F.lit(0)) != 0, amounts.full_price(F.col(c)))
    asked = requests.select("request_id", text.blank_to_null(F.col("marca")).alias("term"), "precio_minimo", "precio_maximo", full("precio_minimo").alias("low"), full("precio_maximo").alias("high"))
    typed = asked.where("term is not null").select("term").distinct()
    fixed = terms.corrected(typed, dictionary, terms.candidates(items, "marca"))
    known = asked.join(fixed, "term", "left").withColumn("brand", text.blank_to_null(F.col("corrected")))
    live = available(items).select("marca", "precio")
    held = _holding(fixed.where("corrected <> ''").select(F.col("corrected").alias("term")).distinct(), live.select("marca").distinct())
    # a request without a brand may mean any
    priced = live.where("marca is not null").select(F.col("marca").alias("key"), "precio").union(live.select(F.lit("*").alias("key"), "precio"))
    changes = priced.distinct().select(F.concat(F.lit("="), "key").alias("key"), F.col("precio").alias("at"), F.lit(0).alias("seq"), F.col("precio").alias("status"))
    of_brand = known.where("brand is not null").join(held.withColumnRenamed("term", "brand"), "brand").select("request_id", F.col("marca").alias("key"), "low", "high")
    probes = of_brand.union(known.where("brand is null").select("request_id", F.lit("*").alias("key"), "low", "high"))
    probes = probes.select(F.concat(F.lit("="), "key").alias("key"), F.coalesce("high", F.lit(float("inf"))).alias("at"), "request_id", "low")
    found = history.as_of(probes, changes, lambda at: F.floor(F.log1p(F.least(F.greatest(at, F.lit(0.0)), F.lit(1e15))) * 8))
    met = found.where("status is not null and (low is null or status >= low)").select("request_id").distinct().withColumn("met", F.lit(True))
    # one row
    there = terms.top_candidates(items, "marca", suggestions).agg(F.array_join(F.array_sort(F.collect_list("candidate")), ", ").alias("there")).withColumn("_one", F.lit(1))
    rows = known.join(met, "request_id", "left").withColumn("_one", F.lit(1)).join(F.broadcast(there), "_one")
    log = text.corrections(
        text.correction("marca", F.col("term"), F.col("corrected"), F.col("was_corrected")),
        *[text.correction(c, F.col(c), F.col(f), F.col(f) != F.col(c)) for c, f in (("precio_minimo", "low"), ("precio_maximo", "high"))],
    )
    unknown = F.concat(F.lit("Nothing is known of "), F.col("term"), F.lit("; there are "), F.col("there"), F.lit("."))
    message = F.when(F.col("met").isNull(), F.when(F.col("unmatched"), unknown).otherwise(F.lit(NOTHING)))
    return rows.select("request_id", log.alias("corrections"), message.alias("message"))
