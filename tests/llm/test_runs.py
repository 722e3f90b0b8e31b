"""Periodic runs against a comparison of every word with the word a period further on, for every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import runs

DOCS = "doc_id long, text string"


def plain_runs(words):
    """All (start, length, period) of smallest period with four periods or more."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= 4 * q:
                part = words[i:j + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = [r for r in plain_runs(words) if r[1] >= 6]
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else None
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def texts(rnd):
    out = []
    for _ in range(rnd.randint(1, 5)):
        words = []
        while rnd.random() < 0.8 and len(words) < 150:
            k = rnd.randint(1, 4)
            if rnd.random() < 0.5:
                words += [rnd.randint(0, k) for _ in range(rnd.randint(0, 30))]
            else:
                unit = [rnd.randint(0, k) for _ in range(rnd.randint(1, 14))]
                unit = unit * rnd.randint(1, 8) + [9] if rnd.random() < 0.3 else unit
                words += (unit * rnd.randint(2, 9))[:rnd.randint(1, 200)]
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_every_run_is_found(seed):
    rnd = random.Random(seed)
    for _ in range(250):
        lists = texts(rnd)
        edges = np.cumsum([0] + [len(t) for t in lists])
        found = runs.find_runs(np.array([x for t in lists for x in t], np.int64), edges)
        want = [(e + s, length, q) for t, e in zip(lists, edges.tolist()) for s, length, q in plain_runs(t)]
        assert list(zip(*(x.tolist() for x in found))) == want


def test_long_periods_inside_long_texts():
    rnd = random.Random(1)
    unit = [rnd.randint(0, 3) for _ in range(5000)]
    ids = np.array([7] * 100 + unit * 5 + [8] * 3 + [1, 2] * 4000)
    found = runs.find_runs(ids, np.array([0, len(ids)]))
    assert (100, 25_000, 5000) in list(zip(*(x.tolist() for x in found)))
    assert (25_103, 8000, 2) in list(zip(*(x.tolist() for x in found)))


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r[0]: tuple(r[1:]) for r in runs.digest(runs.periodic_runs(docs, damage=True)).collect()}
    assert got == {r["doc_id"]: plain(r["doc_id"], r["text"]) for r in docs.collect()}


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 50), (4, "a " * 50), (None, "b c " * 9), (None, None), (5, "w"),
            (6, "x\x0by\x0cz " * 8), (7, "    " * 6), (8, "lorem ipsum dolor " * 60_000)]
    rows += [(i, "one two three four five six seven " * 6) for i in range(9, 60)]  # some of them damaged
    docs = spark.createDataFrame(rows, DOCS).withColumns({"runs": F.lit(1), "crc": F.lit("c"), "a.b": F.lit(0)})
    got = [tuple(r) for r in runs.digest(runs.periodic_runs(docs, damage=True)).collect()]
    assert [r[1:6] for r in got if r[0] == 8] == [(1, 0, 180_000, 3, 60_000_000)]
    want = [(doc_id, *plain(doc_id, text)) for doc_id, text in rows if doc_id != 8]
    assert sorted((r for r in got if r[0] != 8), key=repr) == sorted(want, key=repr)
    assert runs.digest(runs.periodic_runs(docs.limit(0))).count() == 0
