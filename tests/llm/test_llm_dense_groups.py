"""Large groups of near copies, long texts and recall of the n-gram Jaccard join."""

import random
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest

from marlstone.llm import near_dup, words

VOCABULARY = [f"w{i}" for i in range(5000)]


def group(rng, n, edits, first, size=120):
    """Texts that differ from one base in some words."""
    base = [rng.choice(VOCABULARY) for _ in range(size)]
    out = []
    for i in range(n):
        text = base[:]
        for _ in range(edits(i)):
            text[rng.randrange(size)] = f"n{rng.randrange(10**6)}"
        out.append((first + i, " ".join(text)))
    return out


def brute(rows):
    sets, links, root = [set(words.shingles(t).tolist()) for _, t in rows], [0] * len(rows), list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {rows[i][0]: (links[i], rows[top(i)][0]) for i in range(len(rows))}


@pytest.mark.parametrize(("block", "at_once"), [(20, 100_000), (20, 0), (384, 100_000)])
def test_groups_and_links_equal_brute_force_with_cores(spark, monkeypatch, block, at_once):
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", block)
    monkeypatch.setattr(near_dup, "AT_ONCE", at_once)
    rng = random.Random(2)
    rows = group(rng, 120, lambda i: 1, 0) + group(rng, 90, lambda i: i % 4, 1000) + group(rng, 50, lambda i: 2, 2000) + group(rng, 60, lambda i: i % 7, 3000, 300)
    rows += [(5000 + i, " ".join(rng.choice(VOCABULARY) for _ in range(50))) for i in range(40)]
    distinct = list({t: (i, t) for i, t in reversed(rows)}.values())
    got = {r.doc_id: (r.n_links, r.group_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    expected = brute(sorted(distinct))
    assert {i: got[i] for i in expected} == expected


def test_a_dense_group_takes_linear_time(spark):
    took = []
    for n in (2000, 8000):
        df = spark.createDataFrame(group(random.Random(n), n, lambda i: 1, 0), "doc_id long, text string").repartition(8)
        began = time.time()
        found = near_dup.near_duplicates(df).selectExpr("count(distinct class_id) as classes", "count_if(group_id = 0) as together", "min(n_links) as least", "max(n_links) as most").first()
        took.append(time.time() - began)
        # a few equal edits are one class
        assert found.together == n and n - 20 < found.classes <= n and found.least == found.most == found.classes - 1
    # four times the documents; all pairs would take sixteen times as long
    assert took[1] < 6 * took[0] + 5


def test_recall_close_to_the_threshold(spark):
    """A thousand planted pairs of similarity 0.80 to 0.85: a pair at 0.8 meets in no band with chance 2.6e-5."""
    rng, rows, planted = random.Random(11), [], []
    while len(planted) < 1000:
        base = [rng.choice(VOCABULARY) for _ in range(rng.randrange(60, 160))]
        other = base[:]
        for _ in range(rng.randrange(1, 4)):
            other[rng.randrange(len(base))] = f"n{rng.randrange(10**6)}"
        a, b = (set(words.shingles(" ".join(t)).tolist()) for t in (base, other))
        if 0.8 <= len(a & b) / len(a | b) <= 0.85:
            planted.append((2 * len(planted), 2 * len(planted) + 1))
            rows += [(planted[-1][0], " ".join(base)), (planted[-1][1], " ".join(other))]
    got = {r.doc_id: r.group_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert sum(got[a] == got[b] for a, b in planted) == 1000
    assert len(set(got.values())) == 1000


def test_stretches_of_a_text_give_the_same_shingles(monkeypatch):
    rng = random.Random(1)
    text = " \n".join(rng.choice(["ΑΣ", "Σ", "İx", "ab", "Cd", "é" * 40]) for _ in range(500))
    monkeypatch.setattr(words, "LONG", 64)  # longer words are named on their own
    whole = words.shingles(text)
    monkeypatch.setattr(words, "STRETCH", 64)
    assert words.shingles(text).tolist() == whole.tolist()
    assert words.word_hashes(text).tolist() == [words.word_hashes(w)[0] for w in text.split()]
    assert words.shingles("").size == 0 and words.shingles("a b").size == 1


def test_a_text_of_60_megabytes_takes_under_half_a_gigabyte():
    code = "import resource, numpy as np\nfrom marlstone.llm import near_dup, words\nbase = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\ntext = ' '.join(map(str, range(7_800_000)))\nassert len(text) > 60_000_000\nfrom_text = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss\nfound = near_dup.signature(words.shingles(text))\nprint((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) / 1024)"
    code = code.replace("' '.join(map(str, range(7_800_000)))", "''.join(' '.join(map(str, range(k, k + 10000))) + ' ' for k in range(0, 7_800_000, 10000))")
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[2], timeout=300)
    assert float(ran.stdout) < 512, ran.stderr[-500:]
    assert np.dtype(np.uint64).itemsize == 8
