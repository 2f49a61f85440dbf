"""What operators write to the shared folder goes where its owner says so."""

import random
from pathlib import Path

import pytest

import corpus_pipeline
from marlstone.llm import codes, common, divergence, mixing, near_dup, recompression, secrets, sharding, suffix_dedup, topk


@pytest.fixture
def shared(tmp_path, monkeypatch):
    (tmp_path / "shared").mkdir()
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path / "shared"))
    return tmp_path / "shared"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(90))
    same = text()
    rows = [(i, same if i % 5 == 0 else text() + " token=abcdefgh", "en", f"s{i % 3}", 9) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


OPERATORS = {
    "near": near_dup.near_duplicates,
    "suffix": suffix_dedup.dedup,
    "sharding": sharding.shard,
    "mixing": mixing.mix,
    "windows": recompression.dedup,
    "audit": divergence.audit,
    "secrets": lambda docs: secrets.findings(docs, secrets.extended_at(docs, secrets.lasting_ledger(docs.sparkSession))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_nothing_stays_of_an_operator(spark, shared, docs, name):
    with common.owned(spark):
        assert OPERATORS[name](docs).count() == 60 or name == "audit"
    assert list(shared.iterdir()) == []


def test_nothing_stays_of_vectors_and_failures(spark, shared):
    vectors = spark.createDataFrame([(i, [float(i * k % 7) for k in range(16)], i % 2) for i in range(60)], "vec_id long, embedding array<float>, label int")
    with common.owned(spark):
        assert codes.compress(vectors).count() == 60
        assert topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=3).count() == 9
    with pytest.raises(ZeroDivisionError), common.owned(spark):
        common.durable(spark.range(3))
        1 / 0
    assert list(shared.iterdir()) == []


def test_a_run_of_the_pipeline_leaves_its_result_only(spark, shared, docs, tmp_path):
    where = str(tmp_path / "tables")
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(60)], "doc_id long, quality int").write.parquet(f"{where}/labels.parquet")
    rows = corpus_pipeline.run(spark, where)
    assert [p.name.rsplit("-", 1)[0] for p in shared.iterdir()] == ["pipeline-4"] and rows.count() > 0


def test_a_folder_stands_in_on_one_machine_only():
    class Session:
        def __init__(self, **conf):
            self.conf = {k.replace("_", "."): v for k, v in conf.items()}

    first = common.shared_folder(Session(spark_master="local[2]"))
    assert Path(first).exists() and common.shared_folder(Session()) == first
    assert common.shared_folder(Session(spark_master="spark://x", **{"spark.checkpoint.dir": "/shared"})) == "/shared"
    for master in ("spark://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="must name a folder"):
            common.shared_folder(Session(spark_master=master))
