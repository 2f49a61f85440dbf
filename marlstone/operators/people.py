"""Finding a person by phone, e-mail or name: keys, evidence, the best first.

What a request and a person agree on is a set of keys.  For each set that a
request has, the first people who agree on at least it are looked up; one who is
not among them has enough others before them, so nothing else is needed, and a
key that many share makes no pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.text import blank_to_null, trimmed
from marlstone.sources.store import new_folder

#: What each kind of agreement counts.
WEIGHTS = {"id": 100, "telefono": 40, "email": 40, "nombre": 20, "nombre_parecido": 10}

#: Keys that agree or don't; the place of each is its bit in ``sets``.
EXACT = ("telefono", "email", "id")
#: Up to so many names of one phone, e-mail or id are compared one by one.
FEW = 32
#: What stands for a replaced character; no normalised name has it.
MARK = "#"
_GROUP = ["sets", "key", "nombre"]


def phone(c: Column) -> Column:
    """The last ten digits, or all of fewer; null without any."""
    return blank_to_null(F.right(F.regexp_replace(c, r"[^0-9]", ""), F.lit(10)))


def email(c: Column) -> Column:
    """Lower case without white space at the ends, and without a tag before the at."""
    return blank_to_null(F.regexp_replace(F.lower(trimmed(c)), r"\+[^@]*@", "@"))


def name(c: Column) -> Column:
    """Lower-case words in order of the alphabet, so that their order doesn't count."""
    words = F.filter(F.split(F.lower(c), r"(?U)[\s,.#]+"), lambda w: w != "")
    return blank_to_null(F.array_join(F.array_sort(words), " "))


def _keys(df: DataFrame, own: str) -> DataFrame:
    """``own`` and the normalised keys of ``df`` (own, id, telefono, email, nombre)."""
    return df.select(F.col(own).alias(own), blank_to_null(F.col("id").cast("string")).alias("id"), phone(F.col("telefono")).alias("telefono"), email(F.col("email")).alias("email"), name(F.col("nombre")).alias("nombre"))


def _groups(keys: DataFrame, own: str) -> DataFrame:
    """(own, sets, key, nombre): each set of keys a row can agree on, and their values.

    ``nombre`` is empty where the name isn't in the set.
    """
    # unambiguous: a phone has digits only, an e-mail tells its length, an id is last
    part = {"telefono": F.col("telefono"), "email": F.concat(F.length("email"), F.lit(":"), "email"), "id": F.col("id")}
    key = lambda bits: F.concat(F.lit(""), *[F.concat(part[k], F.lit(":")) for i, k in enumerate(EXACT) if bits >> i & 1])
    sets = F.array(*[F.struct(F.lit(bits).alias("sets"), key(bits).alias("key")) for bits in range(1 << len(EXACT))])
    each = keys.select(own, F.coalesce("nombre", F.lit("")).alias("nombre"), F.explode(F.filter(sets, lambda s: s["key"].isNotNull())).alias("s"))
    return each.select(own, "s.*", F.explode(F.array_distinct(F.array(F.lit(""), "nombre"))).alias("nombre")).where("sets > 0 or nombre <> ''")


def _with_branches(named: DataFrame) -> DataFrame:
    """``named`` (sets, key, nombre) with ``starts``, ``either`` and ``pairs``: positions where names part.

    Characters before one of ``starts`` begin another name of the group too,
    which goes on otherwise; those after one of ``ends`` end another name;
    ``pairs`` has each start with each later end.
    """
    x = F.col("nombre")
    at = F.sequence(F.lit(0), F.length(x))
    # equal hashes of different stretches only add positions
    start = F.transform(at, lambda p: F.struct(F.lit(True).alias("start"), p.alias("at"), F.xxhash64(F.substr(x, F.lit(1), p)).alias("stretch"), F.substr(x, p + 1, F.lit(1)).alias("beside")))
    end = F.transform(at, lambda p: F.struct(F.lit(False).alias("start"), (p - 1).alias("at"), F.xxhash64(F.substr(x, p + 1)).alias("stretch"), F.when(p > 0, F.substr(x, p, F.lit(1))).otherwise("").alias("beside")))
    each = named.select(*_GROUP, F.explode(F.concat(start, end)).alias("e")).select(*_GROUP, "e.*")
    shared = ["sets", "key", "start", "stretch"]
    parting = each.groupBy(*shared).agg(F.min("beside").alias("a"), F.max("beside").alias("b")).where("a <> b").select(*shared)
    found = each.join(parting, shared, "left_semi").groupBy(*_GROUP).agg(F.collect_list(F.when(F.col("start"), F.col("at"))).alias("starts"), F.collect_list(F.when(~F.col("start"), F.col("at"))).alias("ends"))
    pairs = F.flatten(F.transform("starts", lambda p: F.transform(F.filter("ends", lambda q: q > p), lambda q: F.struct(p.alias("p"), q.alias("q")))))
    either = F.array_distinct(F.filter(F.concat("starts", "ends"), lambda i: (i >= 0) & (i < F.length(x))))
    # small rows that much is made of: adaptive execution would put them into few tasks
    tasks = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.select(*_GROUP, "starts", either.alias("either"), pairs.alias("pairs")).repartition(tasks, *_GROUP)


def _forms(asked: bool) -> Column:
    """What is left of a name after edits: an asked and a known name within two edits, and no others, share one.

    Without their common start and end, two names differ in their first and in
    their last characters, and these are the two edits, or one of the names is
    used up.  A letter tells which edits either side has made, at most two in all.
    """
    x, n = F.col("nombre"), F.length("nombre")
    before, after = lambda p: F.substr(x, F.lit(1), p), lambda q: F.substr(x, q + 2)
    between = lambda p, q: F.substr(x, p + 2, q - p - 1)
    two = lambda first, last: F.transform("pairs", lambda s: F.concat(before(s["p"]), F.lit(first), between(s["p"], s["q"]), F.lit(last), after(s["q"])))
    one = lambda mark: F.transform("either", lambda i: F.concat(before(i), F.lit(mark), after(i)))
    run = lambda size: F.transform(F.filter("starts", lambda p: p + size <= n), lambda p: F.concat(before(p), after(p + size - 1)))
    replaced_and_less, replaced = F.concat(two(MARK, ""), two("", MARK)), one(MARK)
    less, itself = F.concat(run(1), run(2), two("", "")), F.array(x)
    kinds = {"a": two(MARK, MARK), "b": one(""), "c": replaced_and_less if asked else replaced, "d": replaced if asked else replaced_and_less, "e": less if asked else itself, "f": itself if asked else less}
    lettered = lambda kind, forms: F.transform(forms, lambda f: F.concat(F.lit(kind), f))
    return F.array_distinct(F.concat(*[lettered(*k) for k in kinds.items()]))


def _near(asked: DataFrame, known: DataFrame, limit: int) -> DataFrame:
    """(sets, key, nombre, person_id): the first people of a group whose name is near the asked one.

    ``asked`` has (sets, key, nombre), ``known`` also ``ids``, the first people
    of that name.  Names of a large group meet by what edits leave of them;
    ``limit`` + 1 names of each form are kept, as one may be the asked name.
    """
    size = known.where("sets > 0").groupBy("sets", "key").agg((F.count(F.lit(1)) > FEW).alias("many"))
    everyone = F.col("sets") == 0

    def split(names: DataFrame) -> tuple[DataFrame, DataFrame]:
        sized = names.where(~everyone).join(size, ["sets", "key"])
        return sized.where("not many").drop("many"), sized.where("many").drop("many").union(names.where(everyone))

    (asked_few, asked_many), (known_few, known_many) = split(asked), split(known.withColumnRenamed("nombre", "candidate"))
    few = asked_few.join(known_few, ["sets", "key"]).where(F.levenshtein("nombre", "candidate", 2) > 0)
    known_many = known_many.withColumnRenamed("candidate", "nombre")
    branches = _with_branches(asked_many.union(known_many.select(*_GROUP)).distinct())
    form = ["sets", "key", "form"]
    wanted = asked_many.join(branches, _GROUP).select(*_GROUP, F.explode(_forms(True)).alias("form"))
    there = known_many.join(branches, _GROUP).select("sets", "key", F.col("nombre").alias("candidate"), "ids", F.explode(_forms(False)).alias("form"))
    nth = F.row_number().over(Window.partitionBy(*form).orderBy(F.col("ids")[0], "candidate"))
    there = there.select("*", nth.alias("nth")).where(F.col("nth") <= limit + 1).drop("nth")
    met = wanted.join(there, form).where("nombre <> candidate").select(*_GROUP, "ids").union(few.select(*_GROUP, "ids"))
    # a person may be met by several forms
    rank = F.dense_rank().over(Window.partitionBy(*_GROUP).orderBy("person_id"))
    return met.select(*_GROUP, F.explode("ids").alias("person_id")).select("*", rank.alias("nth")).where(F.col("nth") <= limit).select(*_GROUP, "person_id").distinct()


def find(requests: DataFrame, people: DataFrame, limit: int = 3, weights: dict[str, int] = WEIGHTS) -> DataFrame:
    """(request_id, person_id, puntos, evidencia, rank): who each request may mean.

    Requests (request_id, id, telefono, email, nombre) and people (person_id,
    id, ...), one row each, meet by each key on its own, names also within two
    edits; what agrees adds up, so no weight may be negative.  A name that is
    equal isn't counted as near as well.  Equal sums stand by person_id.
    Requests that nothing agrees with have no row.  The sets of keys are written
    to a folder that goes as Python ends, as they are read several times.
    """
    if min(weights.values()) < 0:
        raise ValueError("what agrees can't count against a person")
    spark, path, named = requests.sparkSession, new_folder(requests.sparkSession, "people"), F.col("nombre") != ""

    def written(df: DataFrame, table: str) -> DataFrame:
        df.write.parquet(f"{path}/{table}")
        return spark.read.schema(df.schema).parquet(f"{path}/{table}")

    asked = written(_groups(_keys(requests, "request_id"), "request_id"), "asked")
    # sixteen rows at most: the sets that any request has
    used = asked.select("sets", named.alias("named")).distinct()
    known = _groups(_keys(people, "person_id"), "person_id").withColumn("named", named).join(F.broadcast(used), ["sets", "named"], "left_semi")
    nth = F.row_number().over(Window.partitionBy(*_GROUP).orderBy("person_id"))
    first = written(known.select("*", nth.alias("nth")).where(F.col("nth") <= limit).groupBy(*_GROUP).agg(F.array_sort(F.collect_list("person_id")).alias("ids")), "first")
    equal = asked.join(first, _GROUP).select("request_id", F.explode("ids").alias("person_id"), "sets", F.when(named, "nombre").alias("por"))
    near = _near(asked.where(named).select(*_GROUP).distinct(), first.where(named), limit)
    by_near = asked.join(near, _GROUP).select("request_id", "person_id", "sets", F.lit("nombre_parecido").alias("por"))

    holds = {k: F.col("sets").bitwiseAND(1 << i) != 0 for i, k in enumerate(EXACT)} | {k: F.col("por").eqNullSafe(k) for k in ("nombre", "nombre_parecido")}
    points = sum((F.when(c, weights[k]).otherwise(0) for k, c in holds.items()), F.lit(0).cast("long"))
    size = sum((c.cast("int") for c in holds.values()), F.lit(0))
    evidence = F.concat_ws(",", *[F.when(holds[k], k) for k in sorted(holds)])
    # of the sets a person was found by, the largest is all that agrees
    best = F.max(F.struct(size.alias("size"), points.alias("puntos"), evidence.alias("evidencia"))).alias("b")
    summed = equal.union(by_near).groupBy("request_id", "person_id").agg(best).select("request_id", "person_id", "b.puntos", "b.evidencia")
    nth = F.row_number().over(Window.partitionBy("request_id").orderBy(F.desc("puntos"), "person_id"))
    return summed.select("*", nth.alias("rank")).where(F.col("rank") <= limit)
