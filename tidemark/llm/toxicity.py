"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.sample import held_out, labelled
from tidemark.llm.shared import keep
from tidemark.llm.text import fold, hashes, slices, words

BUCKETS = 1 << 20
#: Labelled documents the model is fitted on, at most about, and bytes of the longest of them. Every term has a weight
#: and factors, whether it tells something by itself or not, but those of fewer than ``LEAST_DOCS`` of these documents.
TRAINING_ROWS, TRAINING_BYTES, LEAST_DOCS = 20_000, 64 << 10, 3
FACTORS, BATCH, DECAY = 8, 256, 1e-4
#: Passes over the sample, the first ``ALONE`` of them for the weights only: pairs learn what single terms leave.
EPOCHS, ALONE = 7, 3
#: Adam's rate and floor of the weights and of the factors. Floors that are large beside the gradient of a term in one
#: document of a batch keep rare terms from moving as far as telling ones.
RATES, FLOORS = (0.1, 0.1), (3e-2, 3e-2)
#: Size of the first factors; deviations from 0 that a term's log odds need for its weight to start from them.
SPREAD, SURE = 0.02, 3.0
#: Terms of a document beyond which its pairs count less.
USUAL = 256
_PREFIXES = (4, 5)


def terms(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the terms of all texts and their text numbers: each word in lower case, and its first 4 and 5
    bytes when it is longer, so that inflected and compound forms share a term."""
    body = fold(body)
    starts, ends, text = words(body, offsets)
    found, owner = [hashes(body, starts, ends)], [text]
    for size in _PREFIXES:
        longer = ends - starts > size
        found.append(hashes(body, starts[longer], starts[longer] + size) ^ np.uint64(size * 0x9E3779B97F4A7C15 % 2**64))
        owner.append(text[longer])
    return (np.concatenate(found) >> np.uint64(44)).astype(np.int64), np.concatenate(owner)


class Model(NamedTuple):
    """``place`` maps a bucket to its term, or to -1; ``weights`` and ``factors`` are by term."""

    place: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray


def _chosen(sample: DataFrame, least: int) -> np.ndarray:
    """The buckets that ``least`` documents of the sample hold, but for those that all hold; at most ``BUCKETS``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for first, last, body, offsets in slices(batch.column(0)):
                bucket, text = terms(body, offsets)
                sums[:-1] += np.bincount(np.unique(text * BUCKETS + bucket) % BUCKETS, minlength=BUCKETS)
                sums[-1] += last - first
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at), "n": pa.array(sums[at])})

    sums = sample.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("bucket") == BUCKETS)).toArrow()
    bucket, n = sums["bucket"].to_numpy(), sums["n"].to_numpy()
    total = int(n[bucket == BUCKETS].sum())
    return np.sort(bucket[(bucket < BUCKETS) & (n < total)])


def _reduced(text: pa.Array, place: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, text number, term) of each term that a text of the slice holds, once."""
    n = int(place.max()) + 1 if len(place) else 0
    for first, last, body, offsets in slices(text):
        bucket, owner = terms(body, offsets)
        term = place[bucket]
        seen = term >= 0
        once = np.unique(owner[seen] * max(n, 1) + term[seen])
        yield first, last, once // max(n, 1), once % max(n, 1)


def pair_scale(sizes: np.ndarray) -> np.ndarray:
    """What the pairs of a document count by: its number of pairs grows with the square of its terms, so those of long
    documents count less, and the chance products among thousands of terms do not drown what single terms tell."""
    return np.minimum(1.0, USUAL / np.maximum(sizes, 1))


def _log_odds(docs: list[np.ndarray], y: np.ndarray, n_terms: int) -> np.ndarray:
    """Weights to start from: log odds of a term's presence where they are ``SURE`` deviations from 0, else 0."""
    sizes = np.array([len(d) for d in docs])
    flat = np.concatenate(docs).astype(np.int64)
    n1 = np.bincount(flat, np.repeat(y, sizes), n_terms)
    n0 = np.bincount(flat, minlength=n_terms) - n1
    all1, all0 = y.sum(), len(y) - y.sum()
    odds = np.log((n1 + 0.5) / (all1 - n1 + 0.5)) - np.log((n0 + 0.5) / (all0 - n0 + 0.5))
    error = np.sqrt(1 / (n1 + 0.5) + 1 / (all1 - n1 + 0.5) + 1 / (n0 + 0.5) + 1 / (all0 - n0 + 0.5))
    return np.where(np.abs(odds) > SURE * error, odds, 0.0)


def fit(docs: list[np.ndarray], y: np.ndarray, n_terms: int, seed: int = 11) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors that minimise the log loss, by Adam over shuffled batches.

    A step touches the terms of its batch only: rows are lists of terms, and sums run by document and by term.
    """
    rng = np.random.default_rng(seed)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    bias = np.log(rate / (1 - rate))
    # Column 0 is the weight, the others are the factors; both moments of Adam lie beside them.
    params = np.zeros((n_terms, 1 + FACTORS))
    params[:, 0] = _log_odds(docs, y, n_terms)
    params[:, 1:] = rng.normal(0, SPREAD, (n_terms, FACTORS))
    first, second = np.zeros_like(params), np.zeros_like(params)
    bias_first, bias_second, step = 0.0, 0.0, 0
    each = lambda pair: np.array([pair[0]] + [pair[1]] * FACTORS)
    rates, floors = each(RATES), each(FLOORS)
    sizes = np.array([len(d) for d in docs])
    for epoch in range(EPOCHS):
        moving = rates if epoch >= ALONE else rates * each((1, 0))
        order = rng.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            owner = np.repeat(np.arange(len(rows)), sizes[rows])
            touched, place = np.unique(np.concatenate([docs[r] for r in rows]), return_inverse=True)
            own = params[touched]
            values = own[place]
            by_row = np.stack([np.bincount(owner, values[:, k], len(rows)) for k in range(1 + FACTORS)], axis=1)
            squares = np.bincount(owner, (values[:, 1:] ** 2).sum(1), len(rows))
            scale = pair_scale(sizes[rows])
            raw = bias + by_row[:, 0] + 0.5 * scale * ((by_row[:, 1:] ** 2).sum(1) - squares)
            g = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[rows]) / len(rows)
            back = by_row[owner] - values
            back *= (scale * g)[owner][:, None]
            back[:, 0] = g[owner]
            grad = np.stack([np.bincount(place, back[:, k], len(touched)) for k in range(1 + FACTORS)], axis=1) + DECAY * own
            step += 1
            a, b = 1 - 0.9**step, 1 - 0.999**step
            first[touched] = m = 0.9 * first[touched] + 0.1 * grad
            second[touched] = v = 0.999 * second[touched] + 0.001 * grad * grad
            params[touched] = own - moving * (m / a) / (np.sqrt(v / b) + floors)
            bias_first = 0.9 * bias_first + 0.1 * g.sum()
            bias_second = 0.999 * bias_second + 0.001 * g.sum() ** 2
            bias -= RATES[0] * (bias_first / a) / (np.sqrt(bias_second / b) + FLOORS[0])
    return float(bias), params[:, 0], params[:, 1:]


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, sample_rows: int = TRAINING_ROWS,
          least_docs: int = LEAST_DOCS) -> Model:
    """A machine fitted on about ``sample_rows`` labelled documents that are not held out.

    What reaches the driver is for each sampled document the terms it holds, bounded by its ``TRAINING_BYTES``, and at
    most ``BUCKETS`` terms. With labels of one kind only, the score is their share.
    """
    sample = keep(labelled(docs, labels, "toxic", modulus, remainder, sample_rows, TRAINING_BYTES), "toxic_sample")
    chosen = _chosen(sample, least_docs)
    place = np.full(BUCKETS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, owner, term in _reduced(batch.column(0), place):
                edges = np.searchsorted(owner, np.arange(last - first + 1))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(term, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(first, last - first), lists], names=["y", "terms"])

    order = F.xxhash64("doc_id"), F.col("doc_id")
    rows = sample.select("text", "y", "doc_id").orderBy(*order).select("text", "y").mapInArrow(
        reduce, "y int, terms array<int>").toArrow()
    y = np.clip(rows["y"].to_numpy(), 0, 1).astype(float)
    if not len(y):
        return Model(place, 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    lists = rows["terms"].combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(rows["terms"].chunks)
    found = np.split(lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())[:-1])
    if not 0 < y.sum() < len(y):
        found = [x[:0] for x in found]
    bias, weights, factors = fit(found, y, len(chosen))
    return Model(place, bias, weights.astype(np.float32), factors.astype(np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text; a null text counts as empty and scores as a text without terms."""
    place, bias, weights, factors = model
    squares = (factors * factors).sum(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for first, last, owner, term in _reduced(batch.column(1), place):
                n = last - first
                pairs = -np.bincount(owner, squares[term], n)
                for k in range(FACTORS):
                    pairs += np.bincount(owner, factors[term, k], n) ** 2
                raw = bias + np.bincount(owner, weights[term], n) + 0.5 * pair_scale(np.bincount(owner, minlength=n)) * pairs
                scores.append(1 / (1 + np.exp(-np.clip(raw, -500, 500))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, threshold: float = 0.7,
             sample_rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Repeated rows give repeated results, a null ``doc_id`` is not held out, an empty table gives no rows. A score equal
    to the threshold is predicted toxic.
    """
    model = learn(docs, labels, modulus, remainder, sample_rows)
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
