"""The stages of the pipeline and the registered queries."""

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from barfold.llm import jaccard, mixing
from barfold.llm.queries import BLOCK_ROWS, ORACLE, QUERIES, REST_WEIGHT, WEIGHTS
from tests.conftest import SMALL
from tests.llm.test_groups import joined
from tests.test_oracle import TABLES, ordered

STAGES = dict(corpus_pipeline.STAGES)
SNARLS = ("grumpf", "snarl", "blech")


@pytest.fixture(scope="module")
def folder(spark, texts, odd_rows, tmp_path_factory):
    """A small corpus: prose of two languages, toxic rows, noise, copies, and the odd rows under other numbers."""
    rows = []
    for n in range(100, 300):
        lang = ("en", "de")[n % 2]
        text = " ".join(texts(lang, 10 * n + k, 12) for k in range(4))
        if n % 5 == 0:
            text += f" You {SNARLS[n % 3]} and {SNARLS[n // 5 % 3]}."
        rows.append((n, text, lang, f"src{n % 4}"))
    rows += [(1000 + n, rows[3 * n + 1][1] + " tail" * (n % 2), "en", "src9") for n in range(20)]
    rows += [(2000, "zqx wqvk xqz jjq " * 9, "en", "src1"), (2001, "%%% 123 ***", "en", "src1")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    frame = frame.withColumns({"n_chars": F.length("text").cast("long"), "ids": F.lit("x"), "score": F.lit(1.0)})
    path = tmp_path_factory.mktemp("corpus")
    frame.unionByName(odd_rows).write.parquet(str(path / "documents.parquet"))
    labels = [(n, 1, int(n % 5 == 0)) for n in range(100, 260)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def stored(spark, folder, tmp_path_factory):
    """What each stage returns, stored and read again as the check tool does."""
    out, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, folder).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def numbers(frame):
    return sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=str)


def test_columns(stored):
    for name in list(STAGES)[:-2]:
        assert stored[name].columns == stored["documents"].columns
    assert stored["mix_sources"].columns == [*stored["documents"].columns, "position"]
    assert stored["encode"].columns == ["doc_id", "lang", "source", "position", "n_tokens", "ids"]


def test_language_stage_drops_only_what_is_no_language(stored):
    gone = set(numbers(stored["documents"])) - set(numbers(stored["language_id"]))
    assert gone == {2, 3, 4, 5, 7, 2000, 2001}
    assert numbers(stored["language_id"]).count(1) == 2


def test_toxic_stage(stored):
    before, after = set(numbers(stored["language_id"])), set(numbers(stored["toxicity"]))
    toxic = {n for n in range(100, 300, 5)}
    assert len((before - after) - toxic) <= 10  # copies of toxic rows among the numbers from 1000 on
    assert {n for n in before - after if n < 1000} <= toxic
    assert len(after & toxic) <= 2


def test_one_document_of_each_group_stays(stored):
    rows = [(r["doc_id"], r["text"]) for r in stored["toxicity"].collect()]
    kept = {n for n, _, component in joined(rows, jaccard.Rule(5, 80)) if n == component}
    found = numbers(stored["near_duplicates"])
    assert [n for n in found if n is not None] == sorted(kept, key=str)
    assert found.count(None) == sum(n is None for n, _ in rows)


def test_mixture_keeps_all_rows(stored):
    before, after = stored["near_duplicates"], stored["mix_sources"]
    assert sorted(map(str, before.collect())) == sorted(map(str, after.drop("position").collect()))


def test_mixture_order_outlives_several_files(spark, folder, tmp_path, monkeypatch):
    docs = spark.createDataFrame(
        [(n, "word " * (1 + n * 7919 % 400), "en", f"src{n % 7}", -1) for n in range(700)],
        "doc_id long, text string, lang string, source string, position long")
    mixed = mixing.mix(docs, WEIGHTS, rest=REST_WEIGHT, block_rows=BLOCK_ROWS)
    expected = {r["doc_id"]: r["position"] for r in mixed.collect()}
    read = docs
    for name in ("mix_sources", "encode"):
        STAGES[name](spark, read, folder).repartition(5).write.parquet(str(tmp_path / name))
        read = spark.read.parquet(str(tmp_path / name))
        assert {r["doc_id"]: r["position"] for r in read.collect()} == expected
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-2:])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["position"] for r in found} == expected


def test_positions_are_dense(stored):
    assert sorted(r["position"] for r in stored["encode"].collect()) == list(range(stored["mix_sources"].count()))


def test_encoded(stored):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts_ = {r["doc_id"]: r["text"] for r in stored["mix_sources"].collect()}
    rows = stored["encode"].collect()
    assert len(rows) == len(texts_)
    for r in rows:
        ids = library.encode(texts_[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))


def test_no_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_run_is_the_stages(spark, folder, stored):
    assert numbers(corpus_pipeline.run(spark, folder)) == numbers(stored["encode"])


def test_registered():
    names = contract.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names and set(contract.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = QUERIES[name](spark, SMALL)
    columns = sorted(found.columns)
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(ORACLE[name])
    assert sorted(expected.columns) == columns
    rows = ordered(found.select(*columns).collect())
    assert rows and rows == ordered(expected.project(quoted).fetchall())


@pytest.mark.parametrize("name, target, held_out, least", [
    ("op3_quality_classifier", "quality", "doc_id", 0.95), ("op7_language_id", "lang", "doc_id", 0.95)])
def test_held_out_accuracy(spark, name, target, held_out, least):
    found = QUERIES[name](spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    table = "labels" if target == "quality" else "documents"
    truth = spark.read.parquet(f"/root/testdata/sf0.01/{table}.parquet").select("doc_id", target).toPandas()
    both = found.merge(truth, on="doc_id")
    predicted = both["predicted"] if target == "quality" else both["lang_pred"]
    assert len(both) > 50 and np.mean(predicted == both[target]) >= least
