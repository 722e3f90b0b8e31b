"""Quality rules: counts of every text, and hashed n-grams under a trusted and a raw-corpus multinomial.

The verdict is the log-likelihood ratio of a document's words and pairs of words between a multinomial of trusted
documents and one of all documents, by n-gram. Log ratios are whole millionths, so sums do not depend on the order of
rows or partitions and the threshold decides every document alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import keep
from tidemark.llm.spans import SPACE, Words, per_text, split_words
from tidemark.llm.text import mix, slices

#: Buckets of the hashed n-grams, what a pair's first hash is multiplied by, and what the bytes of a word are.
BUCKETS, PAIR, PRIME = 1 << 20, 1_000_003, (1 << 31) - 1
FACTORS = np.array([pow(48_271, i + 1, PRIME) for i in range(64)], np.int64)
#: N-grams of the raw corpus that every bucket is taken to have besides its own, in millionths of a log ratio below.
SMOOTH, UNIT = 4, 1_000_000
#: Mean log ratio by n-gram from which a document is kept.
THRESHOLD = -0.25
#: Ids of trusted documents are broadcast up to this many; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Base rules: words that a text has at least, and percentage of words in repeated windows from which it fails.
LEAST_WORDS, MOST_REPEATED, WINDOW = 50, 50, 3

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def word_hashes(values: pa.Array) -> np.ndarray:
    """Sum over a word's bytes, each plus 1 and times its place's factor, modulo ``PRIME``; SQL can do it as well."""
    _, offsets, data = values.buffers()
    edges = np.frombuffer(offsets, np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    if not len(values):
        return np.zeros(0, np.int64)
    body = np.frombuffer(data, np.uint8)[edges[0]:edges[-1]]
    first = edges[:-1] - edges[0]
    within = np.arange(len(body)) - np.repeat(first, np.diff(edges))
    return np.add.reduceat((body.astype(np.int64) + 1) * FACTORS[within % len(FACTORS)], first) % PRIME


def buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and pair of neighbouring words of a text, and the number of n-grams of each text.

    The first part has one bucket for each word, the second one for each word, -1 at the last word of a text.
    """
    hashed = word_hashes(words.distinct)[words.ids]
    pair = np.full(len(hashed), -1, np.int64)
    pair[:-1] = (hashed[:-1] * PAIR + hashed[1:]) % BUCKETS
    sizes = np.diff(words.edges)
    pair[words.edges[1:][sizes > 0] - 1] = -1
    return np.stack([hashed % BUCKETS, pair]), np.maximum(0, 2 * sizes - 1)


def repeated(words: Words) -> np.ndarray:
    """Of each text, how many words stand in a window of three words that the text holds twice or more."""
    ids = words.ids.astype(np.int64)
    covered = np.zeros(len(ids), bool)
    owner = np.repeat(np.arange(len(words.edges) - 1), np.diff(words.edges))
    at = np.arange(len(ids) - WINDOW + 1)
    at = at[owner[at] == owner[at + WINDOW - 1]] if len(at) else at
    if len(at):
        # Windows whose hash is there twice are few; only they are compared exactly.
        hashed = owner[at].astype(np.uint64)
        for k in range(WINDOW):
            hashed = mix(hashed + ids[at + k].astype(np.uint64) * _STEP)
        ordered = np.sort(hashed)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            return np.zeros(len(words.edges) - 1, np.int64)
        at = at[shared[np.minimum(np.searchsorted(shared, hashed), len(shared) - 1)] == hashed]
        number = owner[at]
        for k in range(WINDOW):
            _, number = np.unique(number * len(words.distinct) + ids[at + k], return_inverse=True)
        twice = at[np.bincount(number)[number] > 1]
        for k in range(WINDOW):
            covered[twice + k] = True
    return per_text(covered, words.edges)


def duplicate_lines(column: pa.Array, n: int) -> np.ndarray:
    """Of each of ``n`` texts, how many lines with a word equal an earlier line of the text."""
    lines = [x.split("\n") for x in column.to_pylist()]
    out = np.zeros(n, np.int64)
    for t, own in enumerate(lines):
        if len(own) > 1:
            filled = [x for x in own if x.strip(" \t\n\x0b\x0c\r")]
            out[t] = len(filled) - len(set(filled))
    return out


def counts(docs: DataFrame, trusted: DataFrame, bound: int = BROADCAST_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """N-grams by bucket of all documents, and of those whose id is in ``trusted``, which has each id once.

    Up to ``bound`` ids are broadcast, and more are joined by a shuffle. What reaches the driver is one row per bucket at most.
    """
    side = trusted.withColumn("trusted", F.lit(True)).hint("broadcast" if trusted.count() <= bound else "merge")
    marked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("text is not null").join(
        side, "doc_id", "left").select("text", "trusted")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            known = batch.column(1).fill_null(False).to_numpy(zero_copy_only=False)
            for first, last, body, offsets in slices(batch.column(0)):
                words = split_words(body, offsets)
                found, _ = buckets(words)
                target = np.repeat(known[first:last], np.diff(words.edges))
                for part in found:
                    sums[0] += np.bincount(part[part >= 0], minlength=BUCKETS)
                    sums[1] += np.bincount(part[(part >= 0) & target], minlength=BUCKETS)
        at = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(at), "n": pa.array(sums[0, at]), "n_trusted": pa.array(sums[1, at])})

    rows = marked.mapInArrow(count, "bucket long, n long, n_trusted long").groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("n_trusted").alias("n_trusted")).toArrow()
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    at = rows["bucket"].to_numpy()
    raw[at], target[at] = rows["n"].to_numpy(), rows["n_trusted"].to_numpy()
    return raw, target


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's smoothed probabilities in millionths; all 0 where nothing is trusted.

    Every bucket counts ``SMOOTH`` n-grams more in the raw corpus and its share of them in the target, so that the
    ratio of an n-gram seen once or twice is close to 1.
    """
    if not target.sum():
        return np.zeros(len(raw), np.int64)
    share = float(target.sum()) / float(raw.sum())
    ratio = (target + SMOOTH * share) / (share * (raw + SMOOTH))
    return np.floor(np.log(ratio) * UNIT + 0.5).astype(np.int64)


def judge(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, log ratio in millionths by n-gram (null without words) and verdict of every whole text."""
    least = int(round(threshold * UNIT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, body, offsets in slices(batch.column(1)):
                texts = batch.column(1).slice(first, last - first).fill_null("")
                words = split_words(body, offsets)
                found, grams = buckets(words)
                weight = ratios[found[0]] + np.where(found[1] >= 0, ratios[found[1]], 0)
                total = per_text(weight, words.edges)
                n_words, n_repeat = np.diff(words.edges), repeated(words)
                failed = (n_words < LEAST_WORDS) | (100 * n_repeat > MOST_REPEATED * n_words)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(first, last - first),
                    "n_words": pa.array(n_words, pa.int64()),
                    "word_chars": pa.array(per_text(~SPACE[body] & ((body & 0xC0) != 0x80), offsets)),
                    "n_symbols": pa.array(per_text(_SYMBOLS[body], offsets)),
                    "n_dup_lines": pa.array(duplicate_lines(texts, last - first)),
                    "n_repeat_words": pa.array(n_repeat),
                    "base_failed": pa.array(failed),
                    "kept": pa.array(~failed & (total >= least * grams)),
                    "ratio_millionths": pa.array(total // np.maximum(1, grams), mask=grams == 0)})

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean, ratio_millionths long")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good, never bad."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id is not null and quality is not null")
    good = known.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where(
        "low = 1 and high = 1").select("doc_id")
    return keep(good, "trusted")


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bound: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document with its counts, whether it fails the base rules, and whether it is kept.

    Trusted are documents labelled of good quality and not otherwise as well; the raw corpus is all of ``docs``. A null
    text has no words; such a text, an empty one and one without words fail. A null id is never trusted. A ratio equal
    to the threshold is kept; without labels every document that passes the base rules is. Repeated rows count as often
    as they are there and give repeated results; an empty table gives none. One text is held whole in a task, at some
    100 bytes a word.
    """
    return judge(docs, log_ratios(*counts(docs, trusted_ids(labels), bound)), threshold)
