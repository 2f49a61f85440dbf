"""A written index of the words of knowledge articles, for many questions at once.

Three tables in one folder: ``grams`` (a run of three characters and in how many
words it is), ``words`` (gram, word) and ``postings`` (word, the best articles
that have it).  A question's token meets words by its rarest gram only.  The
order of articles is the same for every question, so the best of a question are
among the best of its words: postings hold the ``depth`` first articles of a
word, those of the first ``SHALLOW`` apart, and a search of a smaller limit
reads no others.  Texts are read when the index is made and never again.  Words
whose postings the first articles fill, which most of a text is made of, are
dropped from all other articles before anything is sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.functions.text import tokens

#: Words are looked up by runs of so many characters; shorter tokens don't count.
GRAM = 3
SHALLOW, DEPTH = 16, 256
#: Times the depth, the articles that fill the postings of common words.
HEAD = 16
_S = "struct<u:boolean,p:bigint,i:bigint>"
TABLES = {"grams": "gram string, n long", "words": "word string, gram string", "postings": f"word string, s array<{_S}>, deep int", "first": f"s {_S}"}


def grams(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def order() -> Column:
    """A higher one comes first: unknown priorities, high ones, low ids."""
    return F.struct(F.col("priority").isNull().alias("u"), F.coalesce("priority", F.lit(0)).alias("p"), (-F.col("id")).alias("i"))


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    path: str
    depth: int = DEPTH

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{name}")


def build(articles: DataFrame, path: str, depth: int = DEPTH) -> Index:
    """Writes the index of the active ones of ``articles``."""
    spark = articles.sparkSession
    live = articles.where("is_active").withColumn("s", order())
    words = _open_words(live, depth)
    nth = F.row_number().over(Window.partitionBy("word").orderBy(F.desc("s")))
    best = words.withColumn("nth", nth).where(F.col("nth") <= depth).groupBy("word", (F.col("nth") > SHALLOW).cast("int").alias("deep")).agg(F.collect_list("s").cast(f"array<{_S}>").alias("s"))
    best.write.partitionBy("deep").parquet(f"{path}/postings")
    index = Index(spark, path, depth)
    of_word = index.table("postings").where("deep = 0").select("word", F.explode(grams(F.col("word"))).alias("gram"))
    of_word.repartition("gram").sortWithinPartitions("gram").write.parquet(f"{path}/words")
    index.table("words").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/grams")
    # questions without words find the first of all articles
    live.select("s").orderBy(F.desc("s")).limit(depth).write.parquet(f"{path}/first")
    return index


def _words(live: DataFrame) -> DataFrame:
    text = F.lower(F.concat_ws(" ", "title", "content"))
    return live.select("s", F.explode(F.array_distinct(F.split(text, r"(?U)\s+"))).alias("word")).where(F.length("word") >= GRAM)


def _open_words(live: DataFrame, depth: int) -> DataFrame:
    """(s, word) of all articles, but for words that ``depth`` articles before have."""
    first = HEAD * depth
    # one row: the last of the first articles
    last = live.select("s").orderBy(F.desc("s")).limit(first).agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("s")).first()
    if not first or last.n < first:
        return _words(live)
    least = F.struct(*[F.lit(v).cast(t).alias(k) for k, v, t in zip("upi", last.s, ("boolean", "bigint", "bigint"), strict=True)])
    head = _words(live.where(F.col("s") >= least))
    # each takes ``depth`` words of the head, so they are at most HEAD times an article's words
    full = head.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= depth).select("word")
    rest = _words(live.where(F.col("s") < least)).join(F.broadcast(full), "word", "left_anti").select("s", "word")
    # few of these go once more, so they are sorted where they meet and not before as well
    return head.union(rest).repartition("word")


def search(index: Index, questions: DataFrame, limit: int = 5) -> DataFrame:
    """(question_id, rank, id): the best articles of each of ``questions``.

    A token counts where a word holds it; a question without a token of three
    characters finds all articles.  ``limit`` is at most the index's depth.
    """
    if limit > index.depth:
        raise ValueError(f"the index holds the first {index.depth} articles of a word")
    asked = questions.select("question_id", tokens(F.col("question")).alias("tokens"))
    by_token = asked.select("question_id", F.explode("tokens").alias("token")).distinct()
    each = by_token.select("token").distinct().select("token", F.explode(grams(F.col("token"))).alias("gram"))
    # a gram that no word has leaves its token without words
    rarest = each.join(index.table("grams"), "gram", "left").groupBy("token").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r"))
    found = rarest.where("r.n > 0").select("token", F.col("r.gram").alias("gram")).join(index.table("words"), "gram").where(F.contains("word", "token")).select("token", "word")
    postings = index.table("postings") if limit > SHALLOW else index.table("postings").where("deep = 0")
    of_token = _best(found.join(postings.select("word", "s"), "word").select("token", F.explode("s").alias("s")), "token", limit)
    hits = by_token.join(of_token, "token").select("question_id", "s")
    # no more than ``limit`` rows
    top = index.table("first").orderBy(F.desc("s")).limit(limit).withColumn("_one", F.lit(1))
    wordless = asked.where(F.coalesce(F.size("tokens"), F.lit(0)) == 0).select("question_id", F.lit(1).alias("_one")).join(F.broadcast(top), "_one").select("question_id", "s")
    nth = F.row_number().over(Window.partitionBy("question_id").orderBy(F.desc("s")))
    ranked = hits.union(wordless).distinct().select("question_id", nth.alias("rank"), "s")
    return ranked.where(F.col("rank") <= limit).select("question_id", "rank", (-F.col("s.i")).alias("id"))


def _best(ranked: DataFrame, key: str, limit: int) -> DataFrame:
    """The ``limit`` highest distinct ``s`` of each key; each task drops the rest first."""
    nth = F.dense_rank().over(Window.partitionBy(key).orderBy(F.desc("s")))
    return ranked.select(key, "s", nth.alias("nth")).where(F.col("nth") <= limit).select(key, "s").distinct()
