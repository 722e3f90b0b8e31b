"""Every operator and stage on awkward rows: nulls, empty and long texts, repeats, empty tables, clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from tidemark.llm import caps, idfiles, language, latent, passages, pieces, secrets, shards, simhash, toxicity
from tidemark.llm.queries import tokenizer_path

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("fp", T.StringType()), T.StructField("label", T.IntegerType()),
    T.StructField("component_id", T.LongType()), T.StructField("shard", T.StringType())])
LONG = "wandering words of some length, over and over again. " * 8000
ROWS = [
    (1, "A plain sentence, and one more of them.", "en", 0.5, "x", 1, 9, "s"),
    (1, "A plain sentence, and one more of them.", "en", 0.5, "x", 1, 9, "s"),
    (2, None, None, None, None, None, None, None),
    (3, "", "en", None, None, None, None, None),
    (4, "   \n\t ", "de", None, None, None, None, None),
    (5, LONG, "en", 1.0, None, 1, None, None),
    (None, "no id here", "en", None, None, None, None, None),
    (None, None, None, None, None, None, None, None),
    (6, "A plain sentence, and one more of them.", None, 0.1, "y", 0, 1, "t"),
    (7, "▁ literal ▁▁ signs, Ünïcödé \U0001F600 and \x00 a nul", "fr", None, None, None, None, None),
    (8, "12345 67890 !!! ???", "en", None, None, None, None, None),
]
BENCHMARK = "item_id long, text string"
ITEM = "How many quarrelsome badgers crossed the frozen river at midnight? The answer is thirty nine badgers."


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (3, 0, 0), (4, 0, 1), (5, 1, 1), (6, 1, 0), (7, None, None), (None, 1, 1), (2, 3, -1), (8, 0, 1), (8, 1, 0), (8, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def operators(spark, docs, labels):
    bpe, sp = tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model")
    return {
        "encode": lambda: pieces.encode(docs, sp), "round_trip": lambda: pieces.round_trip(docs, sp),
        "secrets": lambda: secrets.scan(docs), "redact": lambda: secrets.redact(docs),
        "language": lambda: language.identify(docs), "ids": lambda: idfiles.encode_documents(docs, bpe),
        "shards": lambda: shards.shard_documents(docs, 3, 2), "simhash": lambda: simhash.simhash_groups(docs),
        "toxicity": lambda: toxicity.toxicity(docs, labels), "quality": lambda: passages.quality(docs, labels),
    }


NAMES = list(operators(None, None, None))


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows_keep_one_result_each(spark, docs, labels, name):
    out = operators(spark, docs, labels)[name]()
    found = sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in out.select("doc_id").collect())
    assert found == sorted(r[0] if r[0] is not None else -1 for r in ROWS)


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_give_no_rows(spark, docs, labels, name):
    assert operators(spark, docs.limit(0), labels.limit(0))[name]().count() == 0


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_no_labels_still_score(spark, docs, labels, name):
    out = operators(spark, docs, labels.limit(0))[name]().collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)


def test_texts_without_any_candidate(spark):
    """A slice whose texts share no word with any item, or common ones only, has no region to compare."""
    empty = np.zeros(0, np.int64)
    assert [len(x) for x in latent._joined(empty, empty, empty, 10)] == [0, 0, 0]
    docs = spark.createDataFrame([(i, f"zebra{i} quagga{i} okapi{i}") for i in range(20)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, ITEM)], BENCHMARK)
    assert latent.leaks(docs, benchmark).count() == 0
    assert latent.without_leaks(docs, benchmark).count() == 20


@pytest.mark.parametrize("stage", [f for n, f in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, docs, labels, stage, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (None, "")], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    kept = out.collect()
    assert len(kept) <= len(ROWS)
    empty = stage(spark, docs.limit(0), str(tmp_path))
    assert empty.columns == docs.columns and empty.count() == 0


@pytest.mark.parametrize("stage", [f for n, f in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_with_dots_and_backticks(spark, docs, labels, stage, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    named = docs.withColumn("a.b", F.lit(1)).withColumn("c`d", F.lit(None).cast("string")).withColumn("a", F.lit("x"))
    out = stage(spark, named, str(tmp_path))
    assert out.columns == named.columns and out.dtypes == named.dtypes
    plain = stage(spark, docs, str(tmp_path))
    found = lambda df: sorted((repr(r["doc_id"]), repr(r["text"])) for r in df.collect())
    assert found(out) == found(plain)


def test_whole_pipeline_on_awkward_rows(spark, docs, labels, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids"]
    assert out.where("doc_id = 5").count() == 1


def test_near_duplicates_keep_one_row_each(spark, docs):
    kept = simhash.keep_one(docs).collect()
    named = [r["doc_id"] for r in kept if r["doc_id"] is not None]
    # 1 and 6 are copies; 2, 3, 4 and the null row without id are empty; the other row without id stands alone.
    assert sorted(named) == [1, 2, 5, 7, 8]
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["no id here"]


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 2), (4, [1.0, 0.0, 0.0], 1), (5, None, 1),
        (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.0], 1), (9, [nan, 1.0, 0.0], 1), (10, [inf, 1.0, 0.0], 1),
        (11, [1.0, 0.0, 0.0], None), (12, [1.0, 0.0], 1), (13, [1e-30, 0.0, 0.0], 1), (14, [0.0, 1.0, 0.0], 1),
        (None, [1.0, 0.0, 0.0], 1), (15, [5.0], 1), (16, [7.0], 1), (17, [-7.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("links", F.lit("x"))
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in caps.near_vectors(table).collect()}
    assert found[1] == (3, 1, True) and found[2] == found[4] == found[13] == (3, 1, False)
    assert found[15] == (1, 15, True) and found[16] == (1, 15, False)
    for alone in (3, 5, 6, 7, 8, 9, 10, 11, 12, 14, 17):
        assert found[alone] == (0, alone, True)
    assert found[None] == (0, None, False) and len(found) == len(rows)
    assert caps.near_vectors(table.limit(0)).count() == 0


def test_long_items_are_found(spark):
    rng = random.Random(6)
    item = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(700))
    benchmark = spark.createDataFrame([(1, item)], BENCHMARK)
    table = spark.createDataFrame([(1, LONG + item + LONG), (2, LONG + item[:900] + LONG)], "doc_id long, text string")
    assert [r["doc_id"] for r in latent.leaks(table, benchmark).collect()] == [1]


def test_leaks(spark, docs):
    benchmark = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (3, "too short"), (4, "")], BENCHMARK)
    words = ITEM.split()
    texts = [
        (1, "Some text before. " + ITEM + " and text after."), (2, None), (3, ""), (None, "x " + ITEM.upper()),
        (4, " ".join(words[:5]) + " and nothing more"),
        (5, LONG + " ".join(w for i, w in enumerate(words) if i not in (2, 5, 8)) + LONG),  # a paraphrase, with its answer
        (6, " ".join(w for i, w in enumerate(words) if i < 11))]  # no answer
    table = spark.createDataFrame(texts, "doc_id long, text string").withColumn("overlap", F.lit(1)).repartition(2)
    found = {(r["doc_id"], r["item_id"]) for r in latent.leaks(table, benchmark).collect()}
    assert found == {(1, 1), (None, 1), (5, 1)}
    kept = latent.without_leaks(table, benchmark)
    assert kept.columns == table.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 6]
    assert latent.leaks(table, benchmark.limit(0)).count() == 0 and latent.leaks(table.limit(0), benchmark).count() == 0
    assert latent.without_leaks(table, benchmark.limit(0)).count() == len(texts)
