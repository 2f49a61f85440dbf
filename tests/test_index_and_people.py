"""The word index, folded accents, fresh term tables and finding a person."""

import random
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marlstone.operators import knowledge, layout, people, search_index, term_table, terms

ARTICLE = "id long, category string, title string, content string, keywords array<string>, priority long, is_active boolean"


def slow_search(articles, question, limit):
    words = [w for w in question.lower().split() if len(w) > 2]
    found = [a for a in articles if a[6] and (not words or any(w in f"{a[2] or ''}\0{a[3] or ''}".lower() for w in words))]
    found.sort(key=lambda a: (a[5] is not None, -(a[5] or 0), a[0]))
    return [a[0] for a in found[:limit]]


@pytest.fixture(scope="module")
def articles():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7)))
    rows = [(i, "faq", " ".join(word() for _ in range(3)), "\n".join(word() for _ in range(rng.randrange(0, 30))), None, rng.choice([None, 1, 2, 3]), rng.random() < 0.9) for i in range(150)]
    return [*rows, (900, "faq", None, None, None, 5, True), (901, "faq", "", None, None, None, True)]


@pytest.mark.parametrize(("limit", "shallow"), [(1, 16), (5, 16), (40, 16), (5, 2)])
def test_index_equals_a_scan(spark, articles, tmp_path, monkeypatch, limit, shallow):
    monkeypatch.setattr(search_index, "SHALLOW", shallow)
    rng = random.Random(limit)
    questions = [(i, " ".join("".join(rng.choice("abcé") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(0, 4)))) for i in range(60)] + [(70, None), (71, "ABC zzz"), (72, "  ")]
    index = search_index.build(spark.createDataFrame(articles, ARTICLE), str(tmp_path / "index"), 64)
    asked = spark.createDataFrame(questions, "question_id int, question string")
    got = {}
    for r in search_index.search(index, asked, limit).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append(r.id)
    expected = {i: slow_search(articles, q or "", limit) for i, q in questions}
    assert got == {i: v for i, v in expected.items() if v}


def test_index_is_read_no_further_than_the_limit_needs(spark, articles, tmp_path):
    index = search_index.build(spark.createDataFrame(articles, ARTICLE), str(tmp_path / "index"), 64)
    asked = spark.createDataFrame([(1, "abc")], "question_id int, question string")
    few = search_index.search(index, asked, 5)
    shutil.rmtree(tmp_path / "index" / "postings" / "deep=1", ignore_errors=True)
    assert few.count() == len(slow_search(articles, "abc", 5))  # the deeper postings aren't needed
    with pytest.raises(ValueError, match="first 64"):
        search_index.search(index, asked, 65)


@pytest.mark.parametrize("depth", [1, 3])
def test_common_words_are_sorted_for_the_first_articles_only(spark, articles, tmp_path, monkeypatch, depth):
    monkeypatch.setattr(search_index, "HEAD", 12)
    rows = articles + [(i - 1000, "faq", "abc común", f"raro{i}", None, None if i % 50 == 0 else i % 4, True) for i in range(400)]
    df = spark.createDataFrame(rows, ARTICLE)
    words = search_index._open_words(df.where("is_active").withColumn("s", search_index.order()), depth).groupBy("word").count().collect()
    counts = {r.word: r["count"] for r in words}
    assert counts["abc"] <= 12 * depth and counts["común"] <= 12 * depth and all(counts[f"raro{i}"] == 1 for i in range(400))
    questions = [(1, "abc"), (2, "común"), (3, "raro37 raro399"), (4, "bcé aab"), (5, "a"), (6, "omú")]
    index = search_index.build(df, str(tmp_path / "index"), depth)
    got = {}
    for r in search_index.search(index, spark.createDataFrame(questions, "question_id int, question string"), depth).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append(r.id)
    assert got == {i: slow_search(rows, q, depth) for i, q in questions if slow_search(rows, q, depth)}


def test_index_of_nothing(spark, tmp_path):
    index = search_index.build(spark.createDataFrame([], ARTICLE), str(tmp_path / "index"))
    assert search_index.search(index, spark.createDataFrame([(1, "abc"), (2, "")], "question_id int, question string")).count() == 0


# accents


def test_folding_finds_accents_and_is_off_by_default(spark):
    rows = [(1, "politica", "Devolución y más", "x", None, 1, True), (2, "politica", "DEVOLUCION", "x", None, 1, True), (3, "politica", "otra", "x", None, 1, True)]
    df = spark.createDataFrame(rows, ARTICLE)
    ids = lambda found: sorted(r.id for r in found.collect())
    assert ids(knowledge.topic(df, "devoluciones")) == [2] and ids(knowledge.topic(df, "devoluciones", fold=True)) == [1, 2]
    assert ids(knowledge.search(df, "devolucion mas")) == [2] and ids(knowledge.search(df, "DEVOLUCION", fold=True)) == [1, 2]
    assert ids(knowledge.search(df, "100%", fold=True)) == []
    found = spark.createDataFrame([("Citroën",), ("CITROEN",), ("Seat",), (None,)], "candidate string").where("candidate is not null")
    typed = spark.createDataFrame([("citroen",), (" CITROËN ",), ("seát",), ("x",), (None,)], "term string")
    assert {r.term: r.from_value for r in terms.by_value(typed, found, fold=True).collect()} == {"citroen": "CITROEN", " CITROËN ": "CITROEN", "seát": "Seat", "x": None, None: None}
    assert {r.term: r.from_value for r in terms.by_value(typed, found).collect()}["seát"] is None


# fresh terms


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "term string, n int")


def test_terms_stay_fresh_from_appended_files_only(spark, tmp_path):
    source, path, check = (str(tmp_path / n) for n in ("in", "terms", "check"))
    schema = "brand string, gone boolean"
    weight = F.when(F.col("gone"), -1).otherwise(1)

    def refresh():
        stream = spark.readStream.schema(schema).parquet(source)
        term_table.start(stream, F.col("brand"), weight, path, check).awaitTermination()
        return {r.term: r.n for r in term_table.read(spark, path).collect()}

    spark.createDataFrame([("a", False), ("a", False), ("b", False), (None, False)], schema).write.parquet(source)
    assert refresh() == {"a": 2, "b": 1}
    for old in Path(source).glob("*.parquet"):  # what was read is not needed again
        old.write_bytes(b"unreadable")
    spark.createDataFrame([("b", True), ("c", False), ("a", True)], schema).write.mode("append").parquet(source)
    assert refresh() == {"a": 1, "c": 1}
    assert refresh() == {"a": 1, "c": 1}


def test_terms_of_a_batch_that_runs_twice_and_of_one_that_fails(spark, tmp_path):
    path = str(tmp_path / "terms")
    assert term_table.read(spark, path).collect() == []
    for batch, rows in ((0, [("a", 1), ("b", 1), (None, 1)]), (0, [("a", 1), ("b", 1)]), (1, [("b", -1), ("a", 2)]), (1, [("b", -1), ("a", 2)])):
        term_table.fold(changes(spark, *rows), path, batch)
    assert [tuple(r) for r in term_table.read(spark, path).collect()] == [("a", 3)]
    with pytest.raises(Exception, match="more deletions than rows of z"):
        term_table.fold(changes(spark, ("z", -1)), path, 2)
    assert [tuple(r) for r in term_table.read(spark, path).collect()] == [("a", 3)]
    for batch in range(2, 7):
        term_table.fold(changes(spark, ("a", 1)), path, batch)
    assert [tuple(r) for r in term_table.read(spark, path).collect()] == [("a", 8)]
    assert len(term_table.versions(spark, path)) <= term_table.KEPT + 2


# people


def slow_find(requests, known):
    import re

    def keys(r):
        tel = re.sub("[^0-9]", "", r[2] or "")[-10:]
        mail = re.sub(r"\+[^@]*@", "@", (r[3] or "").lower().strip())
        name = " ".join(sorted(w for w in re.split(r"[\s,.#]+", (r[4] or "").lower()) if w))
        return {"id": r[1] or "", "telefono": tel, "email": mail, "nombre": name}

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, left = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
        return row[-1]

    out = []
    for r in requests:
        own, found = keys(r), []
        for p in known:
            other = keys(p)
            why = [k for k in own if own[k] and own[k] == other[k]]
            if own["nombre"] and other["nombre"] and own["nombre"] != other["nombre"] and distance(own["nombre"], other["nombre"]) <= 2:
                why.append("nombre_parecido")
            if why:
                found.append((-sum(people.WEIGHTS[k] for k in why), p[0], ",".join(sorted(why))))
        out += [(r[0], p, -s, why, i + 1) for i, (s, p, why) in enumerate(sorted(found)[:3])]
    return sorted(out)


def test_people_equal_brute_force(spark):
    rng = random.Random(8)
    names = ["Ana López", "ana lopez", "López, Ana", "Juan Pérez", "Juan Peres", "Jon Peres", "", None, "X"]
    person = lambda i: (i, rng.choice([None, "", f"u{i % 9}"]), rng.choice([None, "", "+52 (81) 1234-567" + str(i % 7), "8112345672"]), rng.choice([None, " A@B.mx ", "a+tag@b.mx", f"p{i % 6}@c.mx"]), rng.choice(names))
    known, asked = [person(i) for i in range(60)], [person(100 + i) for i in range(40)]
    columns = "id string, telefono string, email string, nombre string"
    got = people.find(spark.createDataFrame(asked, f"request_id long, {columns}"), spark.createDataFrame(known, f"person_id long, {columns}"))
    assert sorted((r.request_id, r.person_id, r.puntos, r.evidencia, r["rank"]) for r in got.collect()) == slow_find(asked, known)


@pytest.mark.parametrize("few", [0, 32])
def test_near_names_of_large_and_small_groups_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(people, "FEW", few)
    rng = random.Random(few)
    name = lambda: "".join(rng.choice("ab é") for _ in range(rng.randrange(9)))
    person = lambda i: (i, None, rng.choice([None, None, "55 5-1"]), rng.choice([None, None, " A@B.mx "]), name())
    known, asked = [person(i) for i in range(150)], [person(1000 + i) for i in range(100)]
    rng.shuffle(known)
    columns = "id string, telefono string, email string, nombre string"
    got = people.find(spark.createDataFrame(asked, f"request_id long, {columns}"), spark.createDataFrame(known, f"person_id long, {columns}"))
    assert sorted((r.request_id, r.person_id, r.puntos, r.evidencia, r["rank"]) for r in got.collect()) == slow_find(asked, known)


def test_people_who_share_an_email_or_a_stretch_of_their_names_make_no_pairs(spark):
    """4,000 requests and people of one e-mail, whose names are a number and the same word: 16 million pairs."""
    n = 4000
    rows = spark.range(n).select("id", F.format_string("Customer#%09d", "id").alias("nombre"), F.lit("a@b.mx").alias("email"), F.lit(None).cast("string").alias("telefono"))
    asked = rows.select(F.col("id").alias("request_id"), F.lit(None).cast("string").alias("id"), "telefono", "email", "nombre")
    got = people.find(asked, rows.select(F.col("id").alias("person_id"), "*"))
    rows = {(r.request_id, r["rank"]): (r.person_id, r.puntos) for r in got.collect()}
    assert len(rows) == 3 * n and all(rows[i, 1] == (i, 60) for i in range(n))
    # by one edit from 1234: 0234; by two: 34 (both replaced), 123 (one in front, one less at the end)
    assert (rows[1234, 2], rows[1234, 3]) == ((34, 50), (123, 50))


# layout


def test_layout_opens_fewer_files_for_the_same_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice(["A", "B", "C", "D", None]), rng.choice([2000 + rng.randrange(20)] * 9 + [None]), rng.choice([float(rng.randrange(1, 9999))] * 9 + [None])) for i in range(3000)]
    items = spark.createDataFrame(rows, "id long, marca string, autoano int, precio double")
    layout.write(items, str(tmp_path / "t"), files=32)
    asked = ("B", {"autoano": 2005, "precio": 3000.0}, {"autoano": 2007, "precio": 5000.0})
    found = layout.read(spark, str(tmp_path / "t"), *asked)
    expected = sorted(r for r in rows if r[1] == "B" and r[2] and 2005 <= r[2] <= 2007 and r[3] and 3000 <= r[3] <= 5000)
    assert sorted(map(tuple, found.collect())) == expected and expected
    everything = layout.files_for(spark, str(tmp_path / "t"))
    assert len(found.inputFiles()) * 4 <= len(everything) == 32
    assert sorted(map(tuple, layout.read(spark, str(tmp_path / "t")).collect()), key=str) == sorted(rows, key=str)
    assert layout.read(spark, str(tmp_path / "t"), "none of these").count() == 0  # no file is opened
    layout.write(items.limit(0), str(tmp_path / "none"))
    assert layout.read(spark, str(tmp_path / "none"), *asked).count() == 0
