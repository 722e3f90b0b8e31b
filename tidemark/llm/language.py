"""Language of documents by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.sample import held_out, thinned
from tidemark.llm.text import slices

BUCKETS = 1 << 15
#: Documents the model is fitted on, at most about.
TRAINING_ROWS = 20_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower case of every letter's code point, 0 for all other code points."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def _code_points(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points and where each text starts in them."""
    try:
        points = np.frombuffer(body.tobytes().decode().encode("utf-32-le"), np.uint32)
        heads = np.zeros(len(body) + 1, np.int64)
        np.cumsum((body & 0xC0) != 0x80, out=heads[1:])
        return points, heads[offsets]
    except UnicodeDecodeError:  # broken bytes: each text on its own
        texts = [body[a:b].tobytes().decode(errors="replace") for a, b in zip(offsets[:-1], offsets[1:])]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        return points, np.concatenate(([0], np.cumsum([len(t) for t in texts])))


def ngrams(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all texts, n from 1 to 3, around each letter, and the text number of each.

    Letters are in lower case and everything else is one mark, so n-grams see where words begin and end but not
    what stands between them.
    """
    points, starts = _code_points(body, offsets)
    # A mark before and after each text keeps n-grams from crossing texts.
    text = np.searchsorted(starts, np.arange(len(points)), "right") - 1
    padded = np.zeros(len(points) + len(starts) + 1, np.uint32)
    at = np.arange(len(points)) + text + 1
    padded[at] = _letters()[points]
    at = at[padded[at] > 0]
    owner = np.searchsorted(starts + np.arange(len(starts)) + 1, at, "right") - 1
    left, mid, right = padded[at - 1], padded[at], padded[at + 1]
    a, b, c = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35)
    one = mid * b
    two = (left * a) ^ (mid * b) + np.uint32(1)
    three = (left * a) ^ (mid * b) ^ (right * c) + np.uint32(2)
    grams = np.stack([one, two, three], axis=1)
    grams ^= grams >> np.uint32(15)
    grams *= np.uint32(0x2C1B3C6D)
    return (grams >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64), owner


def learn(docs: DataFrame, sample_rows: int = TRAINING_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix (buckets + 1, languages) of log probabilities, whose last row is the prior.

    Fitted on about ``sample_rows`` documents with text and language, chosen by a hash of the id. The size is
    bounded by buckets times languages.
    """
    rows = docs.where("text is not null and lang is not null")
    sample = thinned(rows.select("doc_id", "text", "lang"), sample_rows, 2).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for first, last, body, offsets in slices(batch.column(0)):
                grams, owner = ngrams(body, offsets)
                edges = np.searchsorted(owner, np.arange(last - first + 1))
                for i in range(last - first):
                    found = sums.setdefault(langs[first + i], np.zeros(BUCKETS + 1, np.int64))
                    found[:-1] += np.bincount(grams[edges[i]:edges[i + 1]].ravel(), minlength=BUCKETS)
                    found[-1] += 1
        for lang, found in sums.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(at)), "bucket": pa.array(at), "n": pa.array(found[at])})

    sums = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toPandas()
    langs = sorted(sums["lang"].unique())
    counts = np.zeros((BUCKETS + 1, len(langs)))
    counts[sums["bucket"].to_numpy(np.int64), np.searchsorted(langs, sums["lang"].to_numpy(str)) if langs else []] = sums["n"]
    smooth = counts[:-1] + 0.1
    model = np.vstack([np.log(smooth / smooth.sum(0)), np.log(counts[-1:] / max(1.0, counts[-1].sum()))])
    return langs, model


def predict(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language of every whole text and its posterior probability.

    ``und`` with score 0 when the text is null or has no letter, or nothing was learned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for first, last, body, offsets in slices(batch.column(1)):
                n = last - first
                total = np.zeros((n, len(langs)))
                grams, owner = ngrams(body, offsets)
                filled, at = np.unique(owner, return_index=True)
                if len(filled) and langs:
                    per = model[grams[:, 0]]
                    for k in (1, 2):
                        per += model[grams[:, k]]
                    total[filled] = np.add.reduceat(per, at)
                    total += model[-1]
                    best = total.argmax(1)
                    weight = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                known = np.zeros(n, bool)
                known[filled] = bool(langs)
                names += [langs[best[i]] if known[i] else UNKNOWN for i in range(n)]
                scores += [float(weight[i]) if known[i] else 0.0 for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, modulus: int = 4, remainder: int = 2, sample_rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the documents that are not held out.

    A null ``doc_id`` is neither held out nor learned from. An empty table gives no rows, repeated rows repeated
    results. Of languages that are equally likely the first one by name is predicted.
    """
    out = held_out(F.col("doc_id"), modulus, remainder)
    langs, model = learn(docs.select(F.col("doc_id").cast("long"), "text", "lang").where(
        F.col("doc_id").isNotNull() & ~out), sample_rows)
    return predict(docs, langs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score")
