"""Repeated windows of words, the divergence audit and vector codes against brute force."""

import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from marlstone.llm import codes, divergence, queries, recompression, texts, words
from marlstone.llm.sql import ORACLE_SQL

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
#: Extra columns that the operators use names of themselves.
EXTRA = "id string, h1 string, name string, marks string, runs string, n string, ord string, label int"


def table(spark, rows, schema, parts=3):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x", "x", 1) for r in rows], f"{schema}, {EXTRA}").repartition(parts)


def flat(rows):
    return sorted(tuple(map(str, r)) for r in rows)


# 11 repeated windows


def slow_windows(rows):
    """(doc_id, n_words, n_removed, kept_sha256) of each row, window by window."""
    least, split = {}, [(-(2**63) if i is None else i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - 49):
            key = tuple(w[p : p + 50])
            least[key] = min(least.get(key, i), i)
    out = []
    for (shown, _), (i, w) in zip(rows, split):
        gone = [False] * len(w)
        for p in range(len(w) - 49):
            if least[tuple(w[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        out.append((shown, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def odd_texts(rng):
    vocabulary = [f"w{i}" for i in range(300)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, rows = some(500), []
    for i in range(104):
        a = rng.randrange(400)
        t = [
            lambda: some(rng.randrange(0, 160)),
            lambda: some(rng.randrange(0, 40)) + base[a : a + rng.randrange(40, 100)] + some(rng.randrange(0, 40)),
            lambda: ["a"] * rng.randrange(0, 170),
            lambda: (["a", "b"] * 200)[rng.randrange(2) : rng.randrange(60, 200)],
            lambda: (["x", "y", "z", "x"] * 100)[rng.randrange(4) : rng.randrange(60, 300)],
            lambda: base[:a] + ["new"] + base[a:],
            lambda: [rng.choice("ab") for _ in range(rng.randrange(50, 300))],
            lambda: ["a"] * 60 + base[100:180] + ["a"] * rng.randrange(0, 60) + ["é" * 300],
        ][i % 8]()
        rows.append((i, " \n".join(t) if i % 3 else " ".join(t)))
    rows += [(200, None), (201, ""), (202, " \t\n "), (203, rows[5][1]), (204, rows[1][1] + "\t" + rows[9][1]), rows[5], (3, " ".join(base)), (None, " ".join(base[:80])), (None, None), (205, " ".join(base[30:79])), (206, " ".join(base[30:80]))]
    return rows


@pytest.mark.parametrize("stretch", [1 << 17, 64])
def test_windows_equal_brute_force(spark, monkeypatch, stretch):
    monkeypatch.setattr(recompression, "STRETCH", stretch)
    rows = odd_texts(random.Random(stretch))
    got = recompression.dedup(table(spark, rows, "doc_id long, text string")).collect()
    assert flat(got) == flat(slow_windows(rows))


def test_windows_give_the_kept_text_and_empty_tables(spark):
    base = " ".join(f"v{i}" for i in range(70))
    df = spark.createDataFrame([(1, base), (2, f"new  {base[:-4]}\nend")], "doc_id long, text string")
    kept = {r.doc_id: bytes(r.kept).decode() for r in recompression.dedup(df, with_text=True).collect()}
    assert kept == {1: base, 2: "new end"}
    assert recompression.dedup(df.limit(0)).collect() == []


def test_equal_windows_have_equal_anchors_wherever_they_stand():
    rng = np.random.default_rng(1)
    inner = rng.integers(0, 30, 90).astype(np.uint64)
    found = set()
    for _ in range(20):
        left, right = (rng.integers(0, 30, rng.integers(0, 200)).astype(np.uint64) for _ in range(2))
        name, start, size = recompression.anchors(np.concatenate((left, inner, right)))
        own = slice(left.size, left.size + 41)
        found.add((name[own].tobytes(), (start[own] - left.size).tobytes(), size[own].tobytes()))
    assert len(found) == 1
    assert size.max() > 4  # anchors are symbols of several rounds


def test_words_of_long_texts_go_in_stretches(monkeypatch):
    data = np.frombuffer(b"  one two\tthree " + b"x" * 5000 + b" one \x0b four", np.uint8)
    whole = words.word_places(data)
    monkeypatch.setattr(words, "LONG", 9)  # named on their own
    names = words.word_names(data, *whole)
    monkeypatch.setattr(words, "STRETCH", 9)
    assert [a.tolist() for a in words.word_places(data)] == [a.tolist() for a in whole]
    assert words.word_names(data, *whole).tolist() == names.tolist()
    assert names[0] == names[4] and len(set(names.tolist())) == 5
    assert words.word_places(np.frombuffer(b"", np.uint8))[0].size == 0


def test_buckets_have_a_limit_and_files_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(texts, "BUCKET_BYTES", 100)
    monkeypatch.setattr(texts, "MOST_BUCKETS", 4)
    assert texts.buckets(spark, 100 * 200_000) == 4  # Spark itself refuses more than 100,000
    rows = spark.range(1000).selectExpr("id", "repeat('x', 10) as t")
    with texts.co_located(rows, ["id"], 10_000, 1000) as table_:
        assert table_.count() == 1000
        location, name = table_.inputFiles(), table_.schema.names
        assert len(location) > 50 and name == ["id", "t"]
        path = location[0].rsplit("/", 1)[0].removeprefix("file://")
    assert not Path(path).exists()
    with pytest.raises(ZeroDivisionError), texts.co_located(rows, ["id"], 10_000, 1000) as table_:
        path = table_.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        1 / 0
    assert not Path(path).exists()


# 12 source divergence


def slow_audit(rows):
    read = [tuple(x or "" for x in r) for r in rows]
    cut = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    out = []
    for lang in {r[1] for r in read}:
        own = [(s, cut(t)) for t, g, s in read if g == lang]
        df = Counter(w for _, ws in own for w in set(ws))
        kept = sorted((w for w, n in df.items() if n >= 3), key=str.encode)
        count = defaultdict(Counter)
        for s, ws in own:
            count[s].update(w for w in ws if df[w] >= 3)
            count[None].update(w for w in ws if df[w] >= 3)
        p = {s: {w: 1 + 10**9 * (count[s][w] + 1) // (sum(count[s].values()) + len(kept)) for w in kept} for s in count}
        for s in {s for s, _ in own}:
            gap = lambda a, b: (a - b) ** 2 // b
            pair = sorted(((-sum(gap(p[s][w], p[o][w]) for w in kept), o.encode(), o) for o in {x for x, _ in own} - {s}))
            term = sorted((-gap(p[s][w], p[None][w]), w.encode(), w) for w in kept if count[s][w] and p[s][w] > p[None][w])[:200]
            for part, found in (("pair", pair), ("term", term)):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(found)]
    return out


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(4)
    vocabulary = [f"{rng.choice(['ab', 'Ab', 'é', 'xyz'])}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)] + ["x" * 400, "日本", "a"]
    rows = [(" ".join(rng.choice(vocabulary) + rng.choice(["", "1", "-", "."]) for _ in range(rng.randrange(0, 120))), f"l{i % 3}", f"s{i % 7}" if i % 11 else None) for i in range(150)]
    rows += [(None, "l1", "empty"), ("", None, None), ("only here", "few", "s1"), ("only there", "few", "s2"), rows[3], rows[3], (None, None, "s1"), ("a" * 3000 + " a " * 900, "l0", "long")]
    return rows


def test_audit_equals_brute_force(spark, audited, monkeypatch):
    monkeypatch.setattr(divergence, "AT_ONCE", 1000)
    monkeypatch.setattr(divergence, "EXPANDED", 16)
    monkeypatch.setattr(divergence, "KEYS", 50)
    got = divergence.audit(table(spark, audited, "text string, lang string, source string"))
    assert flat(got.collect()) == flat(slow_audit(audited))
    assert divergence.audit(got.selectExpr("item as text", "lang", "source").limit(0)).collect() == []


def test_transducer_numbers_keys_and_shares_states():
    rng = random.Random(2)
    keys = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))).encode() + rng.choice([b"ing", b"ed", b""]) for _ in range(500)})
    machine = divergence.Transducer()
    for key in keys:
        machine.add(key)
    states = len(machine.finish()._arrays[3])
    asked = [*keys, b"", b"zz", keys[3] + b"\xff", *(k[:-1] for k in keys)]
    place = {k: i for i, k in enumerate(keys)}
    assert machine.ordinals(pa.array(asked, pa.binary())).tolist() == [place.get(k, -1) for k in asked]
    # no two states have the same right language
    right: dict[bytes, set] = defaultdict(set)
    for k in keys:
        for i in range(len(k) + 1):
            right[k[:i]].add(k[i:])
    assert states == len({frozenset(v) for v in right.values()})
    empty = divergence.Transducer().finish()
    assert empty.ordinals(pa.array([b"a"], pa.binary())).tolist() == [-1]


# 13 vector codes


def slow_codes(rows):
    kept = [(i, [math.floor(4096 * float(x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = len(kept[0][1]) // 8
    part = lambda v, p: v[p * size : (p + 1) * size]
    near = lambda x, book: min((sum((a - c) ** 2 for a, c in zip(x, e)), j) for j, e in enumerate(book))
    books = [[part(r[1], p) for r in kept[:16]] for p in range(8)]
    for _ in range(6):
        for p in range(8):
            groups = defaultdict(list)
            for _, v, _label in kept:
                groups[near(part(v, p), books[p])[1]].append(part(v, p))
            books[p] = [[sum(c) // len(groups[j]) for c in zip(*groups[j])] if j in groups else e for j, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    found = [(i, [near(part(v, p), books[p]) for p in range(8)], label) for i, v, label in kept]
    total = Counter()
    for _, n, label in found:
        total[label] += sum(d for d, _ in n)
    return [(i, "".join(f"{j:02x}" for _, j in n), sum(d for d, _ in n), total[label], sha) for i, n, label in found]


@pytest.mark.parametrize("leaves", [1 << 13, 3])
def test_codes_equal_brute_force(spark, monkeypatch, leaves):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    rng = np.random.default_rng(leaves)
    rows = [(i, [float(x) for x in rng.integers(-3, 3, 16) / 2], None if i % 7 == 0 else i % 3) for i in range(120)]
    rows += [(900, None, 1), (901, [None] * 16, 1), (902, [math.nan] * 16, 2), (903, [-math.inf] * 16, 2), rows[4], rows[4], (None, rows[9][1], 8), (5, rows[8][1], None)]
    df = spark.createDataFrame([(*r, "x", [1.0], 2, 3) for r in rows], "vec_id long, embedding array<float>, label int, code string, v array<double>, _label int, error int").repartition(3)
    assert flat(codes.compress(df).collect()) == flat(slow_codes(rows))


def test_codes_of_few_vectors_of_none_and_of_bad_ones(spark):
    schema = "vec_id long, embedding array<float>, label int"
    few = [(i, [float(i == k) for k in range(8)], i) for i in range(5)]
    assert flat(codes.compress(spark.createDataFrame(few, schema)).collect()) == flat(slow_codes(few))
    assert codes.compress(spark.createDataFrame([], schema)).collect() == []
    assert codes.compress(spark.createDataFrame([(1, None, 2)], schema)).collect() == []
    for bad in ([(1, [1.0] * 12, 0)], [(1, [1.0] * 8, 0), (2, [1.0] * 16, 0)]):
        with pytest.raises(ValueError, match="vectors must be"):
            codes.compress(spark.createDataFrame(bad, schema))
    with pytest.raises(Exception, match="components must stay below"):
        codes.compress(spark.createDataFrame([(1, [1e30] * 8, 0)], schema)).collect()


def test_trie_measures_shared_beginnings_once():
    rng = np.random.default_rng(7)
    rows = np.unique(rng.integers(-4, 4, (4000, 8)), axis=0)
    book = rng.integers(-4, 4, (16, 8))
    whole = ((rows[:, None, :] - book[None]) ** 2).sum(axis=2)
    for lo, hi, distance in codes.traverse(rows, book):
        assert (distance == whole[lo:hi]).all()
    entry, least = codes.nearest(rows, book)
    assert (entry == whole.argmin(axis=1)).all() and (least == whole.min(axis=1)).all()


@needs_data
@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_vector_codes"])
def test_registered_queries_equal_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    ours, theirs = queries.QUERIES[name](spark, DATA).toPandas(), con.execute(ORACLE_SQL[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert flat(ours[sorted(ours.columns)].itertuples(index=False)) == flat(theirs[sorted(theirs.columns)].itertuples(index=False))


@needs_data
def test_registered_windows_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert flat(queries.op11_substring_dedup(spark, DATA).collect()) == flat(slow_windows(rows))
