"""Benchmark passages in documents: latent semantic retrieval, then longest common subsequence and answer checks.

Documents are read as passages of neighbouring blocks of ``BLOCK`` words: two of them for short items, four for longer
ones. TF-IDF over the benchmark's words is reduced by a randomised SVD (Halko, Martinsson and Tropp, 2011) whose range
finder is summed over all passages by Spark; passages near an item by cosine in the latent space are its candidates and
are compared with it word by word.

A cosine can miss an item whose words are common or many of which are lost. So where it proposes no region, stretches
that hold enough of an item's rarest words are compared too. A leak has 0.6 of the item's words, thus at least ``k`` of
any 0.4 n + ``k`` of them: no leak is without such a stretch, however short the item is and however many items there are.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.shared import keep, map_rows
from tidemark.llm.text import fold, hashes, slices, words

BLOCK = 16
#: Blocks of a passage, by the most words an item may have to be looked for in passages of that size.
PASSAGES = ((24, 2), (1 << 30, 4))
#: Dimensions of the latent space for each item, and the fewest and most of them; and what the range finder has more.
RANK, LEAST_RANK, MOST_RANK, EXTRA = 0.5, 96, 256, 16
#: Words in more than this share of blocks weigh nothing, but for the rarest words of each item.
COMMON, RAREST = 0.02, 8
#: Cosine of a candidate; share of the item's words in order that make a copy, or with its answer a paraphrase.
CANDIDATE, COPY, PARAPHRASE, ANSWER = 0.5, 0.8, 0.6, 0.8
#: Items of fewer words are no evidence and are left out.
LEAST_WORDS = 5
#: Items searched for at once, and characters of them; more are taken in blocks of as many, each against all documents.
ITEMS_AT_ONCE, CHARS_AT_ONCE = 1000, 500_000
#: A passage is matched inside stretches of this many times the item's words.
STRETCH = 1.5
#: One in so many of an item's words are asked for together, of its rarest ones.
TOGETHER = 6
#: Rare words looked at in one go; more are taken item by item.
HITS = 1 << 22
_STEP = 32


class Items(NamedTuple):
    """Benchmark items as word numbers in the ascending hashes ``vocabulary``; ``answers`` is where each one's begins."""

    names: list
    vocabulary: np.ndarray
    words: list[np.ndarray]
    answers: list[int]


class Rare(NamedTuple):
    """Pairs of a rare word and its item, by word; ``together`` is how many of them a leak of each item has at least."""

    word: np.ndarray
    item: np.ndarray
    together: np.ndarray


class Space(NamedTuple):
    """``terms`` is the weighted latent vector of each word, ``queries`` the unit vectors of the items' parts, of which
    part ``k`` is of item ``item[k]`` and looked for in passages of ``blocks[k]`` blocks."""

    terms: np.ndarray
    queries: np.ndarray
    item: np.ndarray
    blocks: np.ndarray
    rare: Rare


def read_items(rows: Sequence[tuple]) -> Items:
    """Items of (item_id, text) rows, or (item_id, text, answer); without an answer the last sentence stands in.

    Rows without text or with fewer than ``LEAST_WORDS`` words are left out.
    """
    names, found, answers = [], [], []
    for name, text, answer in rows:
        text = (text or "").strip()
        if answer:
            at = text.rfind(answer)
            text, at = (text, at) if at >= 0 else (f"{text} {answer}", len(text))
        else:
            at = max(text.rstrip(".!?").rfind(mark) for mark in (". ", "! ", "? ", ".\n", "\n"))
        body = fold(np.frombuffer(text.encode(), np.uint8))
        starts, ends, _ = words(body, np.array([0, len(body)]))
        if len(starts) < LEAST_WORDS:
            continue
        cut = int(np.searchsorted(starts, len(text[:max(at, 0)].encode())))
        names.append(name)
        found.append(hashes(body, starts, ends))
        answers.append(min(cut, len(starts) - 3) if at >= 0 else len(starts) - max(3, len(starts) // 4))
    vocabulary = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    return Items(names, vocabulary, [np.searchsorted(vocabulary, x) for x in found], answers)


def _terms(column: pa.Array, vocabulary: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, word numbers of all texts, -1 for words of no item, offsets) by slices of the column."""
    for first, last, body, offsets in slices(column):
        body = fold(body)
        starts, ends, _ = words(body, offsets)
        found = hashes(body, starts, ends)
        at = np.minimum(np.searchsorted(vocabulary, found), len(vocabulary) - 1)
        yield first, last, np.where(vocabulary[at] == found, at, -1).astype(np.int32), np.searchsorted(starts, offsets)


def _numbers(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """As :func:`_terms` for stored word numbers."""
    _, offsets, data = column.buffers()
    n = len(column)
    edges = np.frombuffer(offsets, np.int32)[column.offset:column.offset + n + 1].astype(np.int64) // 4
    flat = np.frombuffer(data, np.int32) if data is not None and data.size else np.zeros(0, np.int32)
    first = 0
    while first < n:
        last = min(max(int(np.searchsorted(edges, edges[first] + (1 << 19), "right")) - 1, first + 1), n)
        yield first, last, flat[edges[first]:edges[last]], edges[first:last + 1] - edges[first]
        first = last


def _blocked(offsets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block of each word position ``at``, and the text of each block."""
    sizes = np.diff(offsets)
    n = np.maximum(1, -(-sizes // BLOCK))
    base = np.cumsum(n) - n
    text = np.searchsorted(offsets, at, "right") - 1
    owner = np.repeat(np.arange(len(sizes)), n)
    return base[text] + (at - offsets[text]) // BLOCK, owner


def _sums(table: np.ndarray, rows: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``table[rows]`` by ascending ``group``, in steps of whole columns of rows."""
    out = np.zeros((n, table.shape[1]), table.dtype)
    if not len(group):
        return out
    edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
    sizes, groups = np.diff(edges), group[edges[:-1]]
    parts = -(-sizes // _STEP)
    own = np.repeat(np.arange(len(sizes)), parts)
    first = edges[own] + (np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)) * _STEP
    length = np.minimum(edges[own + 1] - first, _STEP)
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    sums = table[rows[first]]
    for k in range(1, int(length[0])):
        m = int(np.searchsorted(-length, -k, "left"))  # parts with more than k rows
        sums[:m] += table[rows[first[:m] + k]]
    if len(own) == len(sizes):
        out[groups[order]] = sums
        return out
    place = np.empty(len(own), np.int64)
    place[order] = np.arange(len(own))
    out[groups] = _sums(sums, place, own, len(sizes))
    return out


def _windows(sums: np.ndarray, owner: np.ndarray, blocks: int) -> np.ndarray:
    """Sum of each block and the ``blocks - 1`` after it in the same text, ``blocks`` being a power of two."""
    out, step = sums, 1
    while step < blocks:
        wider = out.copy()
        same = owner[step:] == owner[:-step]
        wider[:-step][same] += out[step:][same]
        out, step = wider, step * 2
    return out


def _windows_before(sums: np.ndarray, owner: np.ndarray, blocks: int) -> np.ndarray:
    """The same with the blocks before: what is in a block is in the passages that begin there or before."""
    return _windows(sums[::-1], owner[::-1], blocks)[::-1]


def _frequencies(stored: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many blocks of all documents each word is, and the number of blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size + 1, np.int64)
        for batch in batches:
            for _, _, ids, offsets in _numbers(batch.column(0)):
                at = np.flatnonzero(ids >= 0)
                block, owner = _blocked(offsets, at)
                sums[:-1] += np.bincount(np.unique(block * size + ids[at]) % size, minlength=size)
                sums[-1] += len(owner)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at), "n": pa.array(sums[at])})

    rows = stored.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size + 1, np.int64)
    for row in rows:
        out[row["term"]] = row["n"]
    return out[:-1], int(out[-1])


def _weights(items: Items, seen: np.ndarray, blocks: int) -> np.ndarray:
    """Inverse document frequencies, 0 for common words that are not among the rarest of an item."""
    weight = np.log((1 + blocks) / (1 + seen)) + 0.1
    kept = seen <= COMMON * max(1, blocks)
    for own in items.words:
        once = np.unique(own)
        kept[once[np.argsort(seen[once], kind="stable")[:RAREST]]] = True
    return np.where(kept, weight, 0.0)


def least_words(n: int) -> int:
    """The fewest of ``n`` words whose share makes a paraphrase."""
    least = int(PARAPHRASE * n)
    while least / n < PARAPHRASE:
        least += 1
    return least


def stretch_words(n: int) -> int:
    return int(np.ceil(STRETCH * n))


def _rare(items: Items, seen: np.ndarray) -> Rare:
    """The rarest words of each item, so many that a leak cannot do without ``together`` of them."""
    together = np.array([max(1, len(ids) // TOGETHER) for ids in items.words], np.int64)
    found = [
        np.unique(ids[np.argsort(seen[ids], kind="stable")[:len(ids) - least_words(len(ids)) + k]])
        for ids, k in zip(items.words, together.tolist())]
    word = np.concatenate(found)
    item = np.repeat(np.arange(len(found)), [len(x) for x in found]).astype(np.min_scalar_type(len(found)))
    order = np.argsort(word, kind="stable")
    return Rare(word[order], item[order], together)


def _parts(items: Items, weight: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Parts of the items as (words, weights), their items, and the blocks of the passages they are looked for in.

    An item longer than a passage is asked for in parts, any of which makes it a candidate.
    """
    found, owner, blocks = [], [], []
    for i, ids in enumerate(items.words):
        size = next(n for most, n in PASSAGES if len(ids) <= most)
        for part in np.array_split(ids, -(-len(ids) // (size * BLOCK))):
            once, times = np.unique(part, return_counts=True)
            found.append((once, times * weight[once]))
            owner.append(i)
            blocks.append(size)
    return found, np.array(owner), np.array(blocks)


def _space(stored: DataFrame, items: Items, rank: int | None = None, seed: int = 3) -> Space:
    """The latent space of all passages and the items.

    The items are rows of the matrix too, with the weight that gives them as much of its energy as all passages have,
    so that words of items rare in the corpus are not what the SVD cuts off. What is collected is one row per word of
    the items at once, bounded by ``ITEMS_AT_ONCE`` and ``CHARS_AT_ONCE``.
    """
    size = len(items.vocabulary)
    seen, blocks = _frequencies(stored, size)
    weight = _weights(items, seen, blocks)
    parts, owners, sizes = _parts(items, weight)
    rank = rank or int(min(max(LEAST_RANK, RANK * len(items.words)), MOST_RANK))
    width = min(rank + EXTRA, size)
    plain = np.random.default_rng(seed).standard_normal((size, width)).astype(np.float32)
    start = (plain * weight[:, None]).astype(np.float32)
    longest = int(sizes.max())

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, energy = np.zeros((size, width)), np.zeros(size)
        for batch in batches:
            for _, _, ids, offsets in _numbers(batch.column(0)):
                at = np.flatnonzero(ids >= 0)
                at = at[weight[ids[at]] > 0]
                term = ids[at]
                block, owner = _blocked(offsets, at)
                passages = _windows(_sums(start, term, block, len(owner)), owner, longest)
                both = _windows_before(passages, owner, longest)
                order = np.argsort(term, kind="stable")
                total += _sums(both, block[order], term[order], size)
                energy += np.bincount(term, minlength=size)
        at = np.flatnonzero(energy)
        columns = {"term": pa.array(at), "energy": pa.array(energy[at])}
        yield pa.RecordBatch.from_pydict(columns | {f"y{k}": pa.array(total[at, k]) for k in range(width)})

    schema = ", ".join(["term long", "energy double", *[f"y{k} double" for k in range(width)]])
    names = ["energy", *[f"y{k}" for k in range(width)]]
    rows = stored.select("terms").mapInArrow(sketch, schema).groupBy("term").agg(
        *[F.sum(n).alias(n) for n in names]).toArrow()
    found, energy = np.zeros((size, width)), np.zeros(size)
    at = rows["term"].to_numpy()
    energy[at] = rows["energy"].to_numpy()
    for k in range(width):
        found[at, k] = rows[f"y{k}"].to_numpy()
    found *= weight[:, None]

    share = longest * (energy * weight**2).sum() / len(parts) + 1
    plain = np.where(weight[:, None] > 0, plain, 0)
    for ids, values in parts:
        values = values / max(np.linalg.norm(values), 1e-12)
        found[ids] += share * values[:, None] * (values @ plain[ids])
    basis, _, _ = np.linalg.svd(found, full_matrices=False)
    basis = basis[:, :rank]
    latent = np.array([values @ basis[ids] for ids, values in parts])
    norms = np.linalg.norm(latent, axis=1, keepdims=True)
    queries = (latent / np.where(norms > 0, norms, 1)).astype(np.float32)
    terms = np.ascontiguousarray((basis * weight[:, None]).astype(np.float32))
    return Space(terms, queries, owners, sizes, _rare(items, seen))


def common_length(masks: dict[int, int], size: int, other: Sequence[int]) -> int:
    """Length of the longest common subsequence of a sequence of ``size`` and ``other``, by bit-parallel steps.

    ``masks`` has the positions of each element of the first sequence as bits.
    """
    full = (1 << size) - 1
    row = full
    for element in other:
        here = row & masks.get(element, 0)
        row = ((row + here) | (row - here)) & full
    return size - row.bit_count()


def _masks(ids: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, x in enumerate(ids.tolist()):
        out[x] = out.get(x, 0) | 1 << i
    return out


class Matcher:
    """Checks candidates word by word."""

    def __init__(self, items: Items) -> None:
        self.items = items
        self.whole = [_masks(x) for x in items.words]
        self.answer = [_masks(x[a:]) for x, a in zip(items.words, items.answers)]
        self.stretch = np.array([stretch_words(len(x)) for x in items.words], np.int64)
        self.least = [least_words(len(x)) for x in items.words]
        self.own = [np.unique(x) for x in items.words]

    def overlap(self, item: int, region: np.ndarray) -> tuple[float, bool]:
        """Best share of the item's words found in order within a stretch of ``region``, and whether it is a leak.

        Every stretch counts. It may as well begin at the first of the item's words in it, and one with fewer of them
        than a paraphrase has is no leak.
        """
        n, stretch, best, leak = len(self.items.words[item]), int(self.stretch[item]), 0.0, False
        own = self.own[item]
        inside = own[np.minimum(np.searchsorted(own, region), len(own) - 1)] == region
        before = np.concatenate(([0], np.cumsum(inside)))
        starts = np.flatnonzero(inside)
        held = before[np.minimum(starts + stretch, len(region))] - before[starts]
        if not (held >= self.least[item]).any():
            return best, leak
        words = region.tolist()
        need, seen, common = self.least[item], 0, len(words)
        for k, most in zip(starts.tolist(), held.tolist()):
            # A stretch that begins d words later has d new words, and no more of them in common than that.
            if most < need or common + k - seen < need:
                continue
            part = words[k:k + stretch]
            seen, common = k, common_length(self.whole[item], n, part)
            if common < need:
                continue
            hit = common / n >= COPY
            if not hit:
                size = n - self.items.answers[item]
                hit = common_length(self.answer[item], size, part) >= ANSWER * size
            if hit:
                leak, best, need = True, common / n, common + 1
        return best, leak


def _near(ids: np.ndarray, offsets: np.ndarray, space: Space, stretch: np.ndarray) -> tuple[np.ndarray, ...]:
    """(item, begin, stop) around each passage near an item in the latent space."""
    found = [(np.zeros(0, np.int64),) * 3]
    known = (space.terms != 0).any(1)
    at = np.flatnonzero(ids >= 0)
    at = at[known[ids[at]]]
    block, owner = _blocked(offsets, at)
    sums = _sums(space.terms, ids[at], block, len(owner))
    n = np.maximum(1, -(-np.diff(offsets) // BLOCK))
    place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
    begins = offsets[owner] + place * BLOCK
    for blocks in np.unique(space.blocks).tolist():
        asked = np.flatnonzero(space.blocks == blocks)
        queries = space.queries[asked].T
        latent = _windows(sums, owner, blocks)
        norms = np.linalg.norm(latent, axis=1)
        # Passages begin half a passage apart.
        filled = np.flatnonzero((norms > 0) & (place % (blocks // 2) == 0))
        for part in range(0, len(filled), 4096):
            rows = filled[part:part + 4096]
            row, query = np.nonzero((latent[rows] / norms[rows, None]) @ queries >= CANDIDATE)
            item, row = space.item[asked[query]], rows[row]
            text = owner[row]
            found.append((item, np.maximum(offsets[text], begins[row] - stretch[item]), np.minimum(
                offsets[text + 1], begins[row] + blocks * BLOCK + stretch[item])))
    return tuple(np.concatenate(x) for x in zip(*found))


def _with_rare_words(ids: np.ndarray, offsets: np.ndarray, rare: Rare, stretch: np.ndarray) -> tuple[np.ndarray, ...]:
    """(item, begin, stop) around each stretch that holds as many of an item's rare words as a leak of it must."""
    found = [(np.zeros(0, np.int64),) * 3]
    at = np.flatnonzero(ids >= 0)
    size = int(rare.word.max()) + 1
    at = at[ids[at] < size]
    seen = np.bincount(ids[at], minlength=size)
    group = np.cumsum(np.bincount(rare.item, seen[rare.word], len(stretch))).astype(np.int64) // HITS
    for g in np.unique(group):
        inside = group[rare.item] == g
        item, count = rare.item[inside], np.bincount(rare.word[inside], minlength=size)
        here = at[count[ids[at]] > 0]
        n = count[ids[here]]
        first = (np.cumsum(count) - count)[ids[here]] - (np.cumsum(n) - n)
        own = item[np.repeat(first, n) + np.arange(n.sum())]
        order = np.argsort(own, kind="stable")
        own, place = own[order].astype(np.int64), np.repeat(here, n)[order]
        last = np.arange(len(own)) + rare.together[own] - 1
        fits = last < len(own)
        own_, place_, last = own[fits], place[fits], last[fits]
        fits = (own[last] == own_) & (place[last] - place_ < stretch[own_])
        item, place, last = own_[fits], place_[fits], place[last[fits]]
        text = np.searchsorted(offsets, place, "right") - 1
        fits = last < offsets[text + 1]
        item, place, text = item[fits], place[fits], text[fits]
        found.append((item, np.maximum(offsets[text], place - stretch[item] + 1),
                      np.minimum(offsets[text + 1], place + stretch[item])))
    return tuple(np.concatenate(x) for x in zip(*found))


def _joined(item: np.ndarray, begin: np.ndarray, stop: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """The same with overlapping regions of an item joined; regions of two texts do not overlap."""
    if not len(item):
        return item, begin, stop
    low, high = item * (size + 1) + begin, item * (size + 1) + stop
    order = np.argsort(low, kind="stable")
    item, begin, low, high = item[order], begin[order], low[order], np.maximum.accumulate(high[order])
    fresh = np.flatnonzero(np.append(True, low[1:] >= high[:-1])[:len(low)])
    ends = np.append(fresh[1:], len(low)) - 1
    return item[fresh], begin[fresh], high[ends] - item[fresh] * (size + 1)


def _uncovered(regions: tuple[np.ndarray, ...], known: tuple[np.ndarray, ...], size: int) -> tuple[np.ndarray, ...]:
    """Regions that no region of ``known``, joined and in order, covers."""
    (item, begin, stop), (own, low, high) = regions, known
    if not len(own):
        return regions
    at = np.searchsorted(own * (size + 1) + low, item * (size + 1) + begin, "right") - 1
    covered = (at >= 0) & (own[at] == item) & (stop <= high[at])
    return item[~covered], begin[~covered], stop[~covered]


def _leaks(
    ids: np.ndarray, offsets: np.ndarray, space: Space, matcher: Matcher, complete: bool = True,
) -> Iterator[tuple[int, int, float]]:
    """(text, item, overlap) of every item that a text of the slice leaks; without ``complete`` of candidates alone."""
    if not len(matcher.items.words):
        return
    regions = _joined(*_near(ids, offsets, space, matcher.stretch), len(ids))
    if complete:
        more = _uncovered(_with_rare_words(ids, offsets, space.rare, matcher.stretch), regions, len(ids))
        regions = _joined(*(np.concatenate(x) for x in zip(regions, more)), len(ids))
    item, begin, stop = regions
    found: dict[tuple[int, int], float] = {}
    texts = np.searchsorted(offsets, begin, "right") - 1
    for text, own, a, b in zip(texts.tolist(), item.tolist(), begin.tolist(), stop.tolist()):
        if found.get((text, own)) == 1.0:
            continue
        overlap, leak = matcher.overlap(own, ids[a:b])
        if leak:
            found[text, own] = max(overlap, found.get((text, own), 0.0))
    for (text, own), overlap in sorted(found.items()):
        yield text, own, overlap


def _item_blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items by the hash of their row, ``ITEMS_AT_ONCE`` and ``CHARS_AT_ONCE`` of them at a time."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"), answer.alias("answer"))
    n, chars = rows.select(F.count(F.lit(1)), F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // ITEMS_AT_ONCE), -(-chars // CHARS_AT_ONCE))
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield read_items(sorted(part.distinct().collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")))


def _stored(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, terms): each document's words as numbers of the items' words, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, ids, offsets in _terms(batch.column(1), items.vocabulary):
                edges = pa.py_buffer((offsets * 4).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first),
                    pa.Array.from_buffers(pa.binary(), last - first, [None, edges, pa.py_buffer(ids)])],
                    names=["doc_id", "terms"])

    return keep(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, terms binary"), "terms")


def leaks(docs: DataFrame, benchmark: DataFrame, complete: bool = True) -> DataFrame:
    """(doc_id, item_id, overlap) for every benchmark item a document holds as a copy or paraphrase.

    ``benchmark`` has item_id and text, and may have answer. ``overlap`` is the largest share of the item's words
    found in order within a stretch of 1.5 times its length: from 0.8 on a copy, from 0.6 on a paraphrase when the item's
    answer (its last sentence where none is given) is there too. A null text counts as empty; an empty table on
    either side gives no rows; repeated documents give repeated rows, repeated items one. ``complete=False`` leaves out
    the stretches of rare words, for measuring what the latent space finds alone.
    """
    schema = "doc_id long, item_id long, overlap double"
    out = []
    for items in _item_blocks(benchmark):
        if not items.words:
            continue
        stored = _stored(docs, items)
        space = _space(stored, items)

        def run(batches: Iterator[pa.RecordBatch], items: Items = items, space: Space = space) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items)
            for batch in batches:
                for first, _, ids, offsets in _numbers(batch.column(1)):
                    rows = list(_leaks(ids, offsets, space, matcher, complete))
                    if rows:
                        text, item, overlap = zip(*rows)
                        yield pa.RecordBatch.from_pydict({
                            "doc_id": batch.column(0).take(pa.array([first + t for t in text])),
                            "item_id": pa.array([items.names[i] for i in item], pa.int64()),
                            "overlap": pa.array(overlap, pa.float64())})

        out.append(stored.mapInArrow(run, schema))
    return reduce(DataFrame.unionByName, out) if out else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, all columns unchanged; judged row by row, without a join.

    A null text leaks nothing, repeated rows stay or go together, an empty table on either side changes nothing. Items
    beyond one block are looked for in what the block before left, which is written in between.
    """
    at, first_block = docs.columns.index("text"), True
    for items in _item_blocks(benchmark):
        if not items.words:
            continue
        docs, first_block = docs if first_block else keep(docs, "clean"), False
        space = _space(_stored(docs, items), items)

        def run(batches: Iterator[pa.RecordBatch], items: Items = items, space: Space = space) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for first, _, ids, offsets in _terms(batch.column(at), items.vocabulary):
                    for text, _, _ in _leaks(ids, offsets, space, matcher):
                        clean[first + text] = False
                yield batch.filter(pa.array(clean))

        docs = map_rows(docs, run)
    return docs
