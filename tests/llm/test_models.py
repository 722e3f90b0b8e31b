"""Held-out accuracy of the fitted models, and the guard on labels."""

import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from tidemark.llm import language, passages, toxicity

SF = "/root/testdata/sf0.1"


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def test_language_held_out(spark):
    out = entry.queries()["op5_language"](spark, SF).toPandas().set_index("doc_id")
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id")["lang"]
    assert (out["held_out"] == [crc(i) % 4 == 2 for i in out.index]).all()
    held = out[out["held_out"]]
    assert (held["lang_pred"] == truth.loc[held.index]).mean() > 0.99
    assert out["score"].between(0, 1).all()


@pytest.mark.parametrize("name, label, modulus, remainder, threshold, least", [
    ("op9_toxicity", "toxic", 3, 1, 0.7, 0.75), ("op10_quality", "quality", 5, 0, 0.3, 0.95)])
def test_classifiers_held_out(spark, name, label, modulus, remainder, threshold, least):
    out = entry.queries()[name](spark, SF).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")[label].dropna()
    assert (out["held_out"] == [crc(i) % modulus == remainder for i in out.index]).all()
    assert (out["predicted"] == (out["score"] >= threshold)).all() and out["score"].between(0, 1).all()
    held = out.loc[labels.index][out.loc[labels.index, "held_out"]]
    truth = labels.loc[held.index]
    for value in (0, 1):
        assert (held.loc[truth == value, "predicted"] == value).mean() > least


def test_attention_gradient_learns_a_rare_passage():
    rng = np.random.default_rng(0)
    bags, y = [], []
    for i in range(400):
        bag = rng.random((rng.integers(1, 12), passages.FEATURES)) * 0.3
        bad = i % 3 == 0
        if bad:
            bag[rng.integers(len(bag)), :4] += 1.0  # one passage of the document
        bags.append(bag)
        y.append(0.0 if bad else 1.0)
    model = passages.fit(bags, np.array(y))
    found = []
    for bag in bags:
        e, s = passages.attention(model, bag.astype(np.float32))
        a = np.exp(e - e.max())
        found.append(float((a * s).sum() / a.sum() + model.bias[0]) > 0)
    assert np.mean(np.array(found) == np.array(y)) > 0.95


def test_pairs_of_terms_that_tell_nothing_alone(spark):
    """Label 1 where exactly one of two words is there; neither tells anything by itself, among 6,000 other words."""
    rng = random.Random(0)
    others, rows = [f"q{i}z" for i in range(6000)], []
    for i in range(6000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [rng.choice(others) for _ in range(20)] + ["insultus"] * a + ["groupus"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a != b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    truth = {i: y for i, _, y in rows}
    held = [r for r in toxicity.toxicity(docs, labels).collect() if r["held_out"]]
    ranks = {r["doc_id"]: k for k, r in enumerate(sorted(held, key=lambda r: r["score"]))}
    toxic = [ranks[r["doc_id"]] for r in held if truth[r["doc_id"]]]
    n1, n0 = len(toxic), len(held) - len(toxic)
    assert (sum(toxic) - n1 * (n1 - 1) / 2) / (n1 * n0) > 0.9


def test_machine_equals_its_formula(spark):
    """Scores against sums over all pairs of terms."""
    rng = np.random.default_rng(1)
    texts = ["you pathetic fool", "a b c d", "", None, "fool " * 50, " ".join(f"w{i}" for i in range(400))]
    n = 5000
    place = np.arange(toxicity.BUCKETS, dtype=np.int32) % n
    model = toxicity.Model(place, -0.3, rng.normal(0, 0.3, n), rng.normal(0, 0.1, (n, toxicity.FACTORS)))
    got = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        body = np.frombuffer((texts[r["doc_id"]] or "").encode(), np.uint8)
        bucket, _ = toxicity.terms(body, np.array([0, len(body)]))
        own = np.unique(place[bucket])
        pairs = sum(float(model.factors[a] @ model.factors[b]) for i, a in enumerate(own) for b in own[i + 1:])
        raw = model.bias + model.weights[own].sum() + min(1, toxicity.USUAL / max(1, len(own))) * pairs
        assert abs(r["score"] - 1 / (1 + np.exp(-raw))) < 1e-9


def test_language_equals_plain_bayes(spark, sf):
    """Scores of every document from counts in plain Python dictionaries."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    langs, model = language.learn(docs)
    sums, priors = {lang: {} for lang in langs}, dict.fromkeys(langs, 0)
    rows = [r for r in docs.collect() if r["text"] is not None and r["lang"] is not None]
    grams = {}
    for r in rows:
        body = np.frombuffer(r["text"].encode(), np.uint8)
        found, _ = language.ngrams(body, np.array([0, len(body)]))
        grams[r["doc_id"]] = found.ravel().tolist()
        priors[r["lang"]] += 1
        for g in grams[r["doc_id"]]:
            sums[r["lang"]][g] = sums[r["lang"]].get(g, 0) + 1
    total = {lang: sum(own.values()) + 0.1 * language.BUCKETS for lang, own in sums.items()}
    for r in language.predict(docs, langs, model).collect():
        if r["lang_pred"] == language.UNKNOWN:
            continue
        logs = [np.log(priors[lang] / len(rows)) + sum(
            np.log((sums[lang].get(g, 0) + 0.1) / total[lang]) for g in grams[r["doc_id"]]) for lang in langs]
        assert langs[int(np.argmax(logs))] == r["lang_pred"]
        assert abs(r["score"] - 1 / np.exp(np.array(logs) - max(logs)).sum()) < 1e-6
