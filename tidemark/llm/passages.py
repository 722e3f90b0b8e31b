"""Quality of documents by attention-based multiple-instance learning over passages.

After Ilse, Tomczak and Welling (2018): every passage is encoded, gated attention learned from document labels alone
weighs the passages, and the weighted representation is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.sample import held_out, labelled
from tidemark.llm.shared import keep, map_rows
from tidemark.llm.text import hashes, slices

#: Bytes of a passage; passages worked on at once.
PASSAGE, AT_ONCE = 256, 4096
#: Labelled documents the model is fitted on, at most about, and the bytes of the longest text among them.
TRAINING_ROWS, LONGEST = 8_000, 1 << 16
HIDDEN, GATE, EPOCHS, BATCH, RATE, DECAY = 24, 16, 12, 64, 0.01, 1e-4
KINDS = 12
FEATURES = KINDS * KINDS + 2


def _kinds() -> np.ndarray:
    """Kind of each byte: 0 lower case, 1 upper case, 2 digit, 3 space, 4 line feed, 5 sentence mark, 6 bracket, quote
    or hyphen, 7 ! or ?, 8 bar, 9 other ASCII sign, 10 byte of another character, 11 control."""
    out = np.full(256, 9, np.uint8)
    out[:32], out[127], out[128:] = 11, 11, 10
    for kind, chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n",
                                  ".,;:", "'\"()[]-", "!?", "|")):
        out[[ord(c) for c in chars]] = kind
    return out


_KIND = _kinds()


def _repeated(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """1 for each byte of a line that stood in its text before, else 0."""
    out = np.zeros(len(body), np.uint8)
    line = np.zeros(len(body) + 1, bool)
    line[:-1] = body != 10
    cut = np.zeros(len(body) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(body) + 1, bool)
    before[1:] = line[:-1]
    starts, ends = np.flatnonzero(line & (~before | cut)), np.flatnonzero(before & (~line | cut))
    if not len(starts):
        return out
    text = np.searchsorted(offsets, starts, "right") - 1
    found = hashes(body, starts, ends)
    order = np.lexsort((starts, found, text))
    again = np.zeros(len(starts), bool)
    again[order[1:]] = (found[order[1:]] == found[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
    step = np.zeros(len(body) + 1, np.int8)
    np.add.at(step, starts[again], 1)
    np.add.at(step, ends[again], -1)
    return np.cumsum(step[:-1], dtype=np.int8).view(np.uint8)


def features(body: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, features) of the passages of all texts, some thousand passages at a time.

    A passage is described by the square roots of the shares of its pairs of neighbouring kinds of bytes, the share
    of repeated lines, and whether it has anything. An empty text has one empty passage.
    """
    sizes = np.diff(offsets)
    n = np.maximum(1, -(-sizes // PASSAGE))
    text = np.repeat(np.arange(len(sizes)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    starts = offsets[text] + number * PASSAGE
    ends = np.minimum(starts + PASSAGE, offsets[text + 1])
    kind, again = _KIND[body], _repeated(body, offsets)
    for at in range(0, len(text), AT_ONCE):
        a, b = starts[at:at + AT_ONCE], ends[at:at + AT_ONCE]
        own, first, last = np.repeat(np.arange(len(a)), b - a), int(a[0]), int(b[-1])
        here = kind[first:last].astype(np.int64)
        pair = here[:-1] * KINDS + here[1:]
        same = own[:-1] == own[1:]
        counts = np.bincount((own[:-1] * (KINDS * KINDS) + pair)[same], minlength=len(a) * KINDS * KINDS)
        x = np.zeros((len(a), FEATURES), np.float32)
        x[:, :-2] = np.sqrt(counts.reshape(len(a), -1) / np.maximum(1, b - a - 1)[:, None])
        x[:, -2] = np.bincount(own, again[first:last], len(a)) / np.maximum(1, b - a)
        x[:, -1] = b > a
        yield text[at:at + AT_ONCE], x


class Model(NamedTuple):
    encode: np.ndarray
    encode_bias: np.ndarray
    tanh: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    weigh: np.ndarray
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def attention(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attention logit and score of each passage; a text's raw score is the attention-weighted mean of scores."""
    h = np.tanh(x @ model.encode + model.encode_bias)
    return (np.tanh(h @ model.tanh) * _sigmoid(h @ model.gate)) @ model.attend, h @ model.weigh


def fit(bags: list[np.ndarray], y: np.ndarray, seed: int = 5) -> Model:
    """A model that minimises the log loss of the documents, by Adam over shuffled batches of bags."""
    rng = np.random.default_rng(seed)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    params = [
        rng.normal(0, 0.2, (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.2, (HIDDEN, GATE)),
        rng.normal(0, 0.2, (HIDDEN, GATE)), rng.normal(0, 0.2, GATE), rng.normal(0, 0.2, HIDDEN),
        np.array([np.log(rate / (1 - rate))])]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            x = np.concatenate([bags[r] for r in rows]).astype(float)
            sizes = np.array([len(bags[r]) for r in rows])
            edges, own = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(rows)), sizes)
            w, wb, v, u, t, c, bias = params
            h = np.tanh(x @ w + wb)
            left, right = np.tanh(h @ v), _sigmoid(h @ u)
            e = (left * right) @ t
            e = np.exp(e - np.maximum.reduceat(e, edges)[own])
            a = e / np.add.reduceat(e, edges)[own]
            z = np.add.reduceat(a[:, None] * h, edges)
            g = (_sigmoid(z @ c + bias[0]) - y[rows]) / len(rows)
            dz = g[own, None] * c
            da = (dz * h).sum(1)
            de = a * (da - np.add.reduceat(a * da, edges)[own])
            dleft, dright = de[:, None] * t * right * (1 - left * left), de[:, None] * t * left * right * (1 - right)
            dh = (a[:, None] * dz + dleft @ v.T + dright @ u.T) * (1 - h * h)
            grads = [x.T @ dh + DECAY * w, dh.sum(0), h.T @ dleft, h.T @ dright, (left * right).T @ de,
                     z.T @ g + DECAY * c, np.array([g.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                params[k] = params[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(*[p.astype(np.float32) for p in params])


def learn(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, sample_rows: int = TRAINING_ROWS,
          longest: int = LONGEST) -> Model | None:
    """A model fitted on about ``sample_rows`` labelled documents of at most ``longest`` bytes that are not held out.

    Their passages reach the driver as features, so ``sample_rows * longest`` bounds them. None without labels.
    """
    sample = labelled(docs, labels, "quality", modulus, remainder, sample_rows, longest)

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, body, offsets in slices(batch.column(1)):
                found = list(features(body, offsets))
                own, x = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                edges = np.searchsorted(own, np.arange(last - first + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), batch.column(2).slice(first, last - first),
                    pa.array([x[a:b].astype(np.float16).tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary())],
                    names=["doc_id", "y", "bag"])

    rows = keep(sample.mapInArrow(passages, "doc_id long, y int, bag binary"), "quality_sample").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("doc_id", "ascending")])
    bags = [np.frombuffer(x.as_buffer(), np.float16).reshape(-1, FEATURES) for x in rows["bag"]]
    return fit(bags, np.clip(rows["y"].to_numpy(), 0, 1).astype(float))


def _scores(texts: pa.Array, model: Model | None) -> np.ndarray:
    """Scores of a column of texts, keeping two numbers a passage."""
    if model is None:
        return np.full(len(texts), 0.5)
    out = []
    for first, last, body, offsets in slices(texts):
        own, logits, scores = [], [], []
        for text, x in features(body, offsets):
            e, s = attention(model, x)
            own.append(text)
            logits.append(e)
            scores.append(s)
        own, e, s = np.concatenate(own), np.concatenate(logits).astype(float), np.concatenate(scores)
        edges = np.searchsorted(own, np.arange(last - first))
        e = np.exp(e - np.maximum.reduceat(e, edges)[own])
        raw = np.add.reduceat(e * s, edges) / np.add.reduceat(e, edges)
        out.append(_sigmoid(raw + model.bias[0]))
    return np.concatenate(out) if out else np.zeros(0)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every whole text; a null text counts as empty. 0.5 for all without a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(batch.column(1), model), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def _predicted(score: Column, threshold: float) -> Column:
    return (score >= threshold).cast("int")


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, threshold: float = 0.3,
            sample_rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Repeated rows give repeated results and equal texts equal scores, a null ``doc_id`` is not held out, an empty table
    gives no rows. A score of exactly the threshold is predicted 1.
    """
    model = learn(docs, labels, modulus, remainder, sample_rows)
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
        _predicted(F.col("score"), threshold).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_rows: int = TRAINING_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns unchanged; one pass, no shuffle.

    A score depends on the text alone, so repeated rows and equal texts stay or go together; one of exactly ``threshold``
    stays. A null text is scored as an empty one; null ids and other columns do not matter. Without labels every score is
    the same one half. An empty table stays empty.
    """
    model = learn(docs, labels, sample_rows=sample_rows)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch.column(at), model) >= threshold))

    return map_rows(docs, run)
