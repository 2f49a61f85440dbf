"""Brute-force versions beside the operators, registered queries, and odd tables."""

import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marlstone.llm import common, media, mixing, near_dup, packing, pii, quality, queries, secrets, sharding, suffix_dedup

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def words(rng, n):
    return " ".join(rng.choice("abcdefgh") + "ord" + str(rng.randint(0, 99)) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus in files, as the registered queries read it."""
    rng = random.Random(8)
    rows = [(i, words(rng, 60) if i % 4 else "!!".join("#|$" for _ in range(80)) + str(i)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "tel +1 555 123 4567, a.b@c.de"), (203, "password=abcdef1"), (204, words(rng, 5000)), (205, "é" * 37)]
    where = str(tmp_path_factory.mktemp("t"))
    spark.createDataFrame([(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in rows], SCHEMA).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(120)], "doc_id long, quality int").write.parquet(f"{where}/labels.parquet")
    return where


# 1 quality


def slow_score(m, text):
    """The forward pass, one number at a time."""
    x, _ = quality.passages([text])
    hidden, logits = [], []
    for row in x:
        seen = [(float(v) - float(a)) / float(s) for v, a, s in zip(row, m["mean"], m["scale"])]
        h = [math.tanh(sum(v * float(w) for v, w in zip(seen, column)) + float(b)) for column, b in zip(m["we"].T, m["be"])]
        t = [math.tanh(sum(a * float(w) for a, w in zip(h, column))) for column in m["v"].T]
        g = [1 / (1 + math.exp(-sum(a * float(w) for a, w in zip(h, column)))) for column in m["u"].T]
        hidden.append(h)
        logits.append(sum(a * b * float(w) for a, b, w in zip(t, g, m["w"])))
    weight = [math.exp(v - max(logits)) for v in logits]
    z = [sum(a * h[k] for a, h in zip(weight, hidden)) / sum(weight) for k in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-(sum(a * float(c) for a, c in zip(z, m["c"])) + float(m["b"][0]))))


def slow_passages(text):
    """Frequencies of pairs of classes, length and repeated words, by plain loops."""
    data, cls = (text or "").encode(), quality._class_of_byte()
    out = []
    for lo in range(0, max(1, len(data)), quality.PASSAGE):
        pairs = [cls[data[i]] + quality.CLASSES * cls[data[i - 1]] for i in range(max(lo, 1), min(lo + quality.PASSAGE, len(data)))]
        row = np.zeros(quality.FEATURES)
        for p in pairs:
            row[p] += 1
        row[: quality.PAIRS] = np.sqrt(row[: quality.PAIRS] / max(1, len(pairs)))
        row[-2] = math.log1p(len(pairs)) / 8
        found = [(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
        own = [k for k, (at, _) in enumerate(found) if lo <= at < lo + quality.PASSAGE]
        row[-1] = sum(k > 0 and found[k][1] == found[k - 1][1] for k in own) / max(1, len(own))
        out.append(row)
    return np.array(out)


def test_scores_equal_a_slow_forward_pass(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in queries.op1_quality(spark, folder).collect()}
    assert set(got) == set(texts)
    for i in (0, 1, 2, 200, 201, 204, 205):
        assert np.allclose(slow_passages(texts[i]), quality.passages([texts[i] or ""])[0], atol=1e-6)
        assert abs(got[i].score - slow_score(model, texts[i] or "")) < 1e-4
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1


def test_a_very_long_text_is_scored_in_stretches(spark, folder, monkeypatch):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    text = words(random.Random(1), 9000)
    whole = quality.score_of(model, text.encode())
    monkeypatch.setattr(quality, "AT_ONCE", 20 * quality.PASSAGE)
    assert abs(quality.score_of(model, text.encode()) - whole) < 1e-3
    monkeypatch.undo()
    long = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("repeat('good words of a long text ', 800000)").alias("text"))
    assert 0 <= quality.score(long, model).first().score <= 1
    assert len(quality.some_passages(b"x" * 30_000_000, 48)) == 48


# 2 near duplicates


def test_near_duplicates_of_long_texts(spark):
    text = words(random.Random(3), 150_000)
    rows = [(1, text), (2, text + " end"), (3, text[: len(text) // 2])]
    got = {r.doc_id: (r.n_links, r.group_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3)}


# 3 suffix dedup


def test_pieces_cover_all_windows_in_stretches(monkeypatch):
    rng = np.random.default_rng(4)
    for data in (rng.integers(97, 100, 5000), np.full(3000, 97), np.tile(np.frombuffer(b"xyz", np.uint8), 900), rng.integers(0, 256, 100), rng.integers(0, 256, 99)):
        data = data.astype(np.uint8)
        whole = suffix_dedup.pieces(data)
        monkeypatch.setattr(suffix_dedup, "STRETCH", 700)
        parts = suffix_dedup.pieces(data)
        monkeypatch.setattr(suffix_dedup, "MOST_WINDOWS", 50)
        small = suffix_dedup.pieces(data)
        monkeypatch.undo()
        for a, b in zip(whole[:3], parts[:3]):
            assert a.tolist() == b.tolist()
        for _, first, count, n in (whole, small):
            assert first.tolist() == np.concatenate(([0], np.cumsum(count)))[:-1].tolist()[: first.size] and count.sum() == max(0, data.size - 99) and (n > 0).all()


def test_dedup_of_runs_and_of_one_passage_everywhere(spark):
    passage = words(random.Random(6), 60)
    rows = [(i, words(random.Random(i), 40) + passage + words(random.Random(900 + i), 40)) for i in range(60)] + [(100, "a" * 2_000_000), (101, "ab" * 100_000)]
    got = {r.doc_id: r for r in suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert got[0].n_removed == 0 and all(got[i].n_removed >= len(passage) for i in range(1, 60))
    assert (got[100].n_removed, got[100].n_spans) == (1_999_999, 1) and (got[101].n_removed, got[101].n_spans) == (199_998, 1)


@pytest.mark.parametrize("hot", [8192, 3])
def test_dedup_of_short_periods_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(12)
    rows = []
    for i in range(150):
        parts = [(words(rng, rng.randint(0, 9)) + " ", (words(rng, 20)[: rng.randint(1, 120)]) * rng.randint(1, 30)) for _ in range(rng.randint(1, 4))]
        rows.append((i, "".join(a + b for a, b in parts)[: rng.randint(90, 2500)]))
    rows += [(200 + i, rows[i][1][rng.randint(0, 60) :]) for i in range(40)]
    seen, expected = set(), {}
    for i, text in rows:
        gone = bytearray(len(text))
        for p in range(len(text) - 99):
            w = text[p : p + 100]
            if w in seen:
                gone[p : p + 100] = b"\x01" * 100
            seen.add(w)
        expected[i] = (sum(gone), len(re.findall(b"\x01+", gone)), hashlib.sha256("".join(c for c, g in zip(text, gone) if not g).encode()).hexdigest())
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected


def test_positions_that_do_not_fit_are_refused(spark):
    with pytest.raises(ValueError):
        suffix_dedup._bits(spark.createDataFrame([(2**31 - 1, 2**40)], "n_bytes long, uid long"))


# 4 sharding


def test_splitters_against_sorted_keys(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("y"), (F.col("id") * 7 % 400).cast("int")).alias("text"))
    rows = common.durable(sharding.keyed(docs))
    cuts = sharding.splitters(rows, 7)
    ordered = sorted((r.key, r.size) for r in rows.collect())
    total, at = sum(s for _, s in ordered), np.cumsum([0, *(s for _, s in ordered)])
    assert cuts == sorted(cuts)
    for k, cut in enumerate(cuts, 1):
        below = at[sum(key < cut for key, _ in ordered)]
        assert abs(below - total * k / 7) <= max(0.001 * total / 7, max(s for _, s in ordered))


# 5 packing


def slow_best_fit(sizes, sources, clusters, capacity, per_source):
    bins, out = [], []
    for piece in zip(sizes, sources, clusters):
        fit = [(b["left"], n) for n, b in enumerate(bins) if b["left"] >= piece[0] and piece[2] not in b["clusters"] and b["sources"].count(piece[1]) < per_source]
        if not fit:
            bins.append({"left": capacity, "clusters": [], "sources": []})
        n = min(fit)[1] if fit else len(bins) - 1
        bins[n]["left"] -= piece[0]
        bins[n]["clusters"].append(piece[2])
        bins[n]["sources"].append(piece[1])
        out.append(n)
    return out


def test_best_fit_equals_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(0, 80)
        pieces = sorted((rng.randint(0, 50) for _ in range(n)), reverse=True), [rng.choice("abc") for _ in range(n)], [rng.randint(0, 25) for _ in range(n)]
        assert packing.best_fit(*pieces, 60, 3) == slow_best_fit(*pieces, 60, 3)


def test_packing_of_a_long_text_and_a_hot_source(spark):
    rows = [(0, "w " * 300_000, "hot")] + [(i, f"t{i} " * (i % 90), "hot" if i % 3 else f"s{i}") for i in range(1, 900)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), capacity=500, per_source=4).collect()
    assert sum(r.n_words for r in got) == 300_000 + sum(i % 90 for i in range(1, 900)) and sum(r.doc_id == 0 for r in got) == 600
    bins = {}
    for r in got:
        bins.setdefault((r.bin_group, r.bin), []).append(r)
    for held in bins.values():
        assert sum(r.n_words for r in held) <= 500 and sum(r.source == "hot" for r in held) <= 4


# 6 secrets and 9 personal data


def test_one_text_of_very_many_matches(spark):
    one = spark.range(1).select(F.col("id").alias("doc_id"))
    began = time.time()
    r = pii.digest(pii.scan(one.select("doc_id", F.expr("repeat('mail a.b@c.de tel 555-123-4567 ', 100000)").alias("text")))).first()
    assert r.n_email == 100000 and r.spans.endswith("local_phone:3099987:3099999") and r.spans.count("local_phone") == 100000
    assert time.time() - began < 60
    began = time.time()
    docs = one.select("doc_id", F.expr("repeat('token=abcdefgh ', 100000)").alias("text"))
    ledger = common.durable(secrets.extend(docs))
    assert secrets.digest(secrets.findings(docs, ledger)).first().n_assign == 100000
    assert secrets.masked_by(docs, ledger, "m").first().m == "[SECRET] " * 100000
    assert time.time() - began < 60


def test_before_equals_running_sums(spark):
    from marlstone.llm.spans import before

    rng = random.Random(7)
    rows = [(n, [rng.randint(-9, 9) for _ in range(n)]) for n in (0, 1, 2, 63, 64, 65, 130, 4096, 4097, 9000)]
    df = spark.createDataFrame(rows, "n int, a array<bigint>")
    got = df.select("n", "a", before(F.col("a"), F.lit(0).cast("long"), lambda x, y: x + y).alias("s"), before(F.col("a"), F.lit(-99).cast("long"), F.greatest).alias("m")).collect()
    for r in got:
        assert r.s == [sum(r.a[:i]) for i in range(0, 200)][: r.n] + [int(v) for v in np.cumsum([0, *r.a])[:-1][200:]][: max(0, r.n - 200)]
        top, expected = -99, []
        for v in r.a:
            expected.append(top)
            top = max(top, v)
        assert r.m == expected


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(9)
    span = lambda kind, rank: (rank, (a := rng.randint(0, 300)), a + rng.randint(1, 12), kind, 0.5)
    rows = [(i, [span("email", 0) for _ in range(rng.randint(0, 9))], [span("iban", 4) for _ in range(rng.randint(0, 9))]) for i in range(200)]
    kind = "array<struct<rank:int,start:bigint,end:bigint,kind:string,score:double>>"
    df = spark.createDataFrame(rows, f"i int, base {kind}, more {kind}")
    got = {r.i: sorted(tuple(s) for s in r.k) for r in df.select("i", pii.without_overlaps(F.col("base"), F.col("more")).alias("k")).collect()}
    for i, base, more in rows:
        assert got[i] == sorted(base + [m for m in more if not any(b[1] < m[2] and m[1] < b[2] for b in base)])


def test_a_second_run_scans_nothing_and_moves_no_text(spark, folder, tmp_path):
    path = str(tmp_path / "ledger")
    spark.conf.set("marlstone.secrets.ledger", path)
    try:
        first = sorted(tuple(r) for r in queries.op6_secrets(spark, folder).collect())
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        ledger = secrets.ledger_at(spark, path)
        rows = ledger.count()
        assert rows == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
        again = secrets.extend(docs, ledger)
        # with a complete ledger texts are not even read: only addresses meet
        assert again.count() == 0 and "documents" not in again._jdf.queryExecution().optimizedPlan().toString()
        moved = secrets.unseen(docs, ledger)._jdf.queryExecution().executedPlan()
        exchanges = [line for line in moved.toString().splitlines() if "Exchange" in line]
        assert exchanges and not any("text" in line for line in exchanges)
        assert sorted(tuple(r) for r in queries.op6_secrets(spark, folder).collect()) == first
        assert secrets.ledger_at(spark, path).count() == rows
    finally:
        spark.conf.unset("marlstone.secrets.ledger")
    # without that setting each run starts from nothing
    assert sorted(tuple(r) for r in queries.op6_secrets(spark, folder).collect()) == first


@pytest.mark.parametrize("at_once", [50_000, 0])
def test_ledgers_grow_by_content_and_are_compacted(spark, tmp_path, monkeypatch, at_once):
    monkeypatch.setattr(secrets, "AT_ONCE", at_once)
    path = str(tmp_path / "ledger")
    table = lambda *texts: spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = lambda docs: {r.doc_id: [s.kind for s in r.spans] for r in secrets.findings(docs, secrets.extended_at(docs, path)).collect()}
    one, two = table("token=abcdefgh", "clean", None), table("clean", "secret=qwertyui", "token=abcdefgh", "token=abcdefgh")
    assert spans(one) == {0: ["assign"], 1: [], 2: []}
    assert spans(two) == {0: [], 1: ["assign"], 2: ["assign"], 3: ["assign"]}
    assert secrets.ledger_at(spark, path).count() == 4  # equal content of another corpus isn't scanned again
    monkeypatch.setitem(secrets.VERSIONS, "assign", "assign@2")
    assert spans(two)[2] == ["assign"] and secrets.ledger_at(spark, path).count() == 7
    assert not secrets.compact(spark, path, 1000)
    assert secrets.compact(spark, path) and common.children(spark, path) == ["gen=1"]
    assert secrets.ledger_at(spark, path).count() == 4 and spans(one) == {0: ["assign"], 1: [], 2: []}
    # a compaction that breaks off counts for nothing
    spark.range(2).selectExpr("string(id) as blob").write.parquet(f"{path}/gen=9")
    common.remove(spark, f"{path}/gen=9/_SUCCESS")
    assert spans(one) == {0: ["assign"], 1: [], 2: []}


def test_empty_tables_and_clashing_names(spark):
    names = ("email", "_email", "spans", "_text", "_blob", "blob", "rules", "start", "near", "_base", "_digit", "text_", "seen")
    docs = spark.createDataFrame([(1, "a.b@c.de token=abcdefgh", *"x" * len(names)), (None, None, *"y" * len(names))], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    assert {r.doc_id: r.n_email for r in pii.digest(pii.scan(docs)).collect()} == {1: 1, None: 0}
    assert {r.doc_id: r.n_assign for r in secrets.digest(secrets.findings(docs, common.durable(secrets.extend(docs)))).collect()} == {1: 1, None: 0}
    none = docs.limit(0)
    assert pii.scan(none).count() == 0 and secrets.findings(none, common.durable(secrets.extend(none))).count() == 0


# 7 mixing


def test_mix_of_a_long_text(spark):
    docs = spark.createDataFrame([(1, "a " * 500_000, "x"), (2, "b c", "y")], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert got[1].size == 500_000 and got[2].target == 6.0 and got[2].taken == 6 and abs(got[1].taken - got[1].target) <= 1


# 10 media


def test_media_digests(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op10_media(spark, folder).collect():
        data = (texts[r.doc_id] or "").encode()
        payload = data + bytes((-len(data)) % 64 or (0 if data else 64))
        file = media.to_media(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest()) and file.endswith(payload)
        frames = -(-len(payload) // 4096)
        start = len(file) - len(payload)
        keys = ",".join(f"{start + 4096 * k}-{min(start + 4096 * (k + 1), len(file))}" for k in range(0, frames, 12))
        assert r.feature == f"codec=raw;ticks={25 * frames}/600;samples={frames};keyframes={keys}"


def test_fragments_are_named(spark):
    data = media.to_media(b"x" * 64) + media.box(b"moof", media.full(b"mfhd", b"\0\0\0\1"))
    r = media.described(spark.createDataFrame([(1, 64, bytearray(data))], "doc_id long, n_bytes long, media binary")).first()
    assert r.feature == "error=samples are in fragments" and r.tracks == []


# registered queries and stages


@needs_data
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries_return_all_rows(spark, name):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = queries.QUERIES[name](spark, DATA)
    rows = got.count()
    if name == "op8_topk":
        assert rows == 20 * spark.read.parquet(f"{DATA}/embeddings.parquet").where("vec_id % 20 = 0").count()
    elif name == "op5_packing":
        assert rows >= docs.count()
    else:
        assert rows == docs.count() and got.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_stages_of_odd_tables(spark, folder):
    """Empty tables, and columns named as the stages' own, which stay."""
    extra = ("_quality", "_uid", "_text_key", "_masked", "_blob", "_spans", "_cut", "score", "size", "class_id", "group_id", "_scored", "_source", "_kept", "_words", "target", "whole", "e")
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.lit(c) for c in extra})
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, folder).collect()
            assert k == 4 or not out or (list(out[0].asDict()) == docs.columns and all(r[c] == c for r in out for c in extra)), name
            assert (len(out) > 0) == (table is docs), name


def slow_targets(sizes):
    """Clamp, share the excess by weight, until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    clamped = {}
    while True:
        rest = sum(sizes.values()) - sum(clamped.values())
        live = [s for s in names if s not in clamped]
        level = rest / max(1e-9, sum(weight[s] for s in live))
        above = [s for s in live if level * weight[s] > 3 * sizes[s]]
        if not above:
            return clamped | {s: level * weight[s] for s in live}
        clamped |= {s: 3 * sizes[s] for s in above}


def test_run_equals_brute_force(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    kept = [r for r in docs.collect() if quality.score_of(model, (r.text or "").encode()) >= 0.3]
    grams = [(w := (r.text or "").lower().split()) and {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for r in kept]
    group = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            same = not grams[i] and not grams[j] or len(set(grams[i]) & set(grams[j])) >= 0.8 * max(1, len(set(grams[i]) | set(grams[j])))
            if same:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    left = [min((kept[i] for i in range(len(kept)) if group[i] == g), key=lambda r: r.doc_id) for g in sorted(set(group))]
    size = {r.doc_id: len((r.text or "").split()) for r in left}
    sizes = {}
    for r in left:
        sizes[r.source] = sizes.get(r.source, 0) + size[r.doc_id]
    targets = slow_targets(sizes)
    out = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in out} <= set(size)
    taken = {}
    for r in out:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.n_words
    for source, target in targets.items():
        own = [r.doc_id for r in left if r.source == source]
        assert abs(sum(taken.get(i, 0) for i in own) - target) <= 1
        whole = int(target // sizes[source]) if sizes[source] else 0
        assert sum(taken.get(i, 0) not in (whole * size[i], (whole + 1) * size[i]) for i in own) <= 1
