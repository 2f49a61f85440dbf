"""Term correction: dictionary, then exact, then nearest, then unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions.text import folded, trimmed

MAX_DISTANCE = 2


def candidates(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-null values of a column, as ``candidate``."""
    return df.select(F.col(column).alias("candidate")).where("candidate is not null").distinct()


def top_candidates(df: DataFrame, column: str, n: int) -> DataFrame:
    return candidates(df, column).orderBy("candidate").limit(n)


def by_dictionary(terms: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``terms`` (term) with the dictionary's name for it, or null."""
    known = dictionary.select(F.col("term").alias("_key"), F.col("canonical").alias("from_dictionary"))
    return terms.withColumn("_key", F.lower(trimmed(F.col("term")))).join(known, "_key", "left").drop("_key")


def by_value(terms: DataFrame, found: DataFrame, fold: bool = False) -> DataFrame:
    """``terms`` with the candidate that equals it in another case, or null.

    Of several such candidates the first in order is taken.  ``fold`` lets
    accents differ as well: keys are compared under :data:`FOLDED`.
    """
    key = (lambda c: folded(c)) if fold else F.lower
    known = found.groupBy(key(F.col("candidate")).alias("_key")).agg(F.min("candidate").alias("from_value"))
    return terms.withColumn("_key", key(trimmed(F.col("term")))).join(known, "_key", "left").drop("_key")


def nearest(terms: DataFrame, found: DataFrame, max_distance: int = MAX_DISTANCE, all_within: bool = False) -> DataFrame:
    """``terms`` with the nearest candidate within reach, or null.

    A term and a candidate within d edits agree in at least one of d + 1 equal
    stretches of the candidate, shifted by up to d places; they meet by those
    stretches and by nothing else, so no list of all pairs is made.  Candidates
    of up to d characters have empty stretches and meet all terms short enough.
    Ties go to the first candidate in order.  ``all_within`` gives a row for
    each candidate within reach instead, and none for a term without.
    """
    d = max_distance
    parts = d + 1
    cand = found.select("candidate", F.lower("candidate").alias("c"))
    cand = cand.withColumn("n", F.length("c"))
    # part p of a candidate of n characters: from n*p/parts to n*(p+1)/parts
    cut = F.explode(F.sequence(F.lit(0), F.lit(d)))
    lo, hi = F.floor(F.col("n") * F.col("p") / parts).cast("int"), F.floor(F.col("n") * (F.col("p") + 1) / parts).cast("int")
    left = cand.select("*", cut.alias("p")).select("candidate", "c", "n", "p", F.col("c").substr(lo + 1, hi - lo).alias("stretch"))
    distinct = terms.select("term").where("term is not null").distinct().withColumn("t", F.lower("term")).withColumn("m", F.length("t"))
    sizes = distinct.select("*", F.explode(F.sequence(F.greatest(F.col("m") - d, F.lit(0)), F.col("m") + d)).alias("n")).select("*", cut.alias("p"))
    sizes = sizes.select("term", "t", "m", "n", "p", F.explode(F.sequence(F.greatest(lo - d, F.lit(0)), lo + d)).alias("at"), (hi - lo).alias("width"))
    right = sizes.where("at + width <= m").select("term", "t", "n", "p", F.col("t").substr(F.col("at") + 1, F.col("width")).alias("stretch")).distinct()
    near = right.join(left, ["n", "p", "stretch"]).select("term", "candidate", F.levenshtein("t", "c", d).alias("distance")).where("distance >= 0")
    if all_within:
        return near.distinct().withColumnRenamed("candidate", "from_near")
    best = near.groupBy("term").agg(F.min(F.struct("distance", "candidate")).alias("b")).select("term", F.col("b.candidate").alias("from_near"), F.col("b.distance").alias("distance"))
    return terms.join(best, "term", "left")


def corrected(terms: DataFrame, dictionary: DataFrame, found: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``terms`` (term, ...) with corrected, was_corrected and unmatched.

    Only terms that neither dictionary nor values know are compared by edits,
    and those untrimmed, as they came.
    """
    known = by_value(by_dictionary(terms, dictionary), found)
    open_terms = known.where("from_dictionary is null and from_value is null").select("term").distinct()
    near = nearest(open_terms, found, max_distance).select("term", "from_near")
    first = F.coalesce("from_dictionary", "from_value", "from_near")
    return known.join(near, "term", "left").select(
        *terms.columns,
        F.coalesce(first, "term").alias("corrected"),
        F.coalesce(F.col("from_dictionary").isNotNull() | (F.col("from_value").isNull() & F.col("from_near").isNotNull()), F.lit(False)).alias("was_corrected"),
        first.isNull().alias("unmatched"),
    )
