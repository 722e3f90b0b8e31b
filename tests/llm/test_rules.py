"""Quality rules against plain Python and against their SQL; the verdict on documents that no label covers."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check_oracles import compare, connect
from tidemark.llm import queries, rules

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def word_hash(word):
    body = word.encode()
    return sum((b + 1) * int(rules.FACTORS[i % 64]) for i, b in enumerate(body)) % rules.PRIME


def plain(docs, trusted):
    """(counts, base_failed, kept) of every document."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in docs]
    grams = []
    for own in words:
        h = [word_hash(w) for w in own]
        grams.append([x % rules.BUCKETS for x in h] + [(a * rules.PAIR + b) % rules.BUCKETS for a, b in zip(h, h[1:])])
    raw = Counter(g for own in grams for g in own)
    target = Counter(g for own, (i, _) in zip(grams, docs) if i in trusted for g in own)
    share = sum(target.values()) / max(1, sum(raw.values()))
    ratio = {g: math.floor(math.log((target[g] + rules.SMOOTH * share) / (share * (n + rules.SMOOTH))) * rules.UNIT + 0.5)
             if share else 0 for g, n in raw.items()}
    out = []
    for (i, text), own, hashed in zip(docs, words, grams):
        text = text or ""
        windows = Counter(zip(own, own[1:], own[2:]))
        covered = {k + j for k, w in enumerate(zip(own, own[1:], own[2:])) if windows[w] > 1 for j in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
        kept = not failed and sum(ratio[g] for g in hashed) >= round(rules.THRESHOLD * rules.UNIT) * len(hashed)
        out.append((i, len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                    len(covered), failed, kept))
    return out


def test_whole_table(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    got = rules.quality_rules(docs, labels).drop("ratio_millionths").collect()
    trusted = {r["doc_id"] for r in labels.collect() if r["quality"] == 1}
    assert sorted(map(tuple, got)) == sorted(plain([(r["doc_id"], r["text"]) for r in docs.collect()], trusted))


@pytest.mark.parametrize("bound", [1, 1_000])
def test_all_trusted_documents_count(spark, bound):
    """The target is counted over every trusted document, whether their ids are broadcast or shuffled."""
    rnd = random.Random(5)
    rows = [(i // 2 if i % 9 else None, " ".join(f"w{rnd.randint(0, 30) + 20 * (i % 3)}" for _ in range(60))) for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)] + [(1, 1, 0), (None, 1, 0)], LABELS)
    got = rules.quality_rules(spark.createDataFrame(rows, DOCS), labels, bound=bound).drop("ratio_millionths").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, {i for i in range(40) if i % 3}), key=repr)


def test_awkward_rows(spark):
    rnd = random.Random(2)
    prose = [" ".join(rnd.choice("alpha beta gamma delta epsilon zeta".split()) + str(rnd.randint(0, 40)) for _ in range(80)) for _ in range(6)]
    rows = [(1, prose[0]), (1, prose[0]), (2, None), (3, ""), (4, " \n\t"), (None, prose[1]), (None, None), (5, "a " * 60),
            (6, "one\ntwo\none\n \n \none"), (7, "Ünï   ## \U0001F600 *|<>&$%"), (8, prose[2] + "\n" + prose[2]), (9, prose[3]),
            (10, "word " * 200_000), (11, prose[4]), (12, "ab " * 49 + "\x0b"), (13, prose[5].replace(" ", "\x0c\n"))]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"trusted": F.lit("t"), "kept": F.lit(0), "a.b": F.lit(1)})
    labels = spark.createDataFrame(
        [(1, 1, 0), (9, 1, 0), (9, 0, 1), (11, 1, None), (None, 1, 1), (13, None, 0), (5, 0, 0), (99, 1, 1)], LABELS)
    got = rules.quality_rules(docs.repartition(3), labels).drop("ratio_millionths").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain(rows, {1, 11}), key=repr)
    unlabelled = rules.quality_rules(docs, labels.limit(0)).collect()
    assert all(r["kept"] is not r["base_failed"] for r in unlabelled) and len(unlabelled) == len(rows)
    assert rules.quality_rules(docs.limit(0), labels).count() == 0


def test_junk_goes_and_prose_stays(spark):
    """Half of the labels are hidden; their documents are judged as their labels say."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    hidden = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    out = rules.quality_rules(docs, labels.where(~hidden)).where("not base_failed").join(labels.where(hidden), "doc_id")
    bad, good = (out.where(f"quality = {q}").agg(F.avg(F.col("kept").cast("double"))).first()[0] for q in (0, 1))
    assert bad <= 0.05 and good >= 0.98


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(spark, sf, name):
    message = compare(spark, connect(sf), sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert message.startswith("ok"), message
