"""SentencePiece BPE with seeded merge-dropout: varied segmentations that decode to the very same text.

A text is a line of characters behind a space; neighbours are merged by the model's merges, best score first, leftmost
first among equals. A candidate merge that comes up is skipped for good when its hash, keyed by the document and the
place of its chunk, falls below the rate. Until the first skip a chunk merges as it does without dropout, so those
merges are remembered and only occurrences that skip one of them are merged anew. No
piece of the model joins characters across a line feed or from a word to the space after it, so texts are encoded in
chunks, each a run of spaces with the word behind it.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import mix

SPACE = "▁"
#: Chunks whose ids and merges without dropout a worker remembers.
CACHE = 400_000
#: Occurrences that are looked at, and merged, in one go.
AT_ONCE = 1 << 16
#: Longer chunks are merged one by one with a heap, which takes n log n steps however long they are.
TOGETHER = 64
_CHUNK = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
_NONE = np.int32(1 << 30)
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _key(*parts: np.ndarray | int) -> np.ndarray:
    total = np.zeros(1, np.uint64)
    with np.errstate(over="ignore"):
        for k, part in zip(_K, parts):
            total = mix(total + np.asarray(part, np.uint64) * k)
    return total


class _Column:
    """A growing array of unsigned 64-bit numbers."""

    def __init__(self) -> None:
        self.data, self.size = np.zeros(1024, np.uint64), 0

    def extend(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.data):
            self.data = np.concatenate((self.data[:self.size], np.zeros(max(end, 2 * self.size) - self.size, np.uint64)))
        self.data[self.size:end] = values
        self.size = end


class Pieces:
    """A BPE model with byte fallback: :meth:`encode` and :meth:`decode`."""

    def __init__(self, model_path: str, rate: float = 0.1, seed: int = 0, cache: int = CACHE) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        plain = {p: i for i, p in enumerate(names) if not (
            model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(names) if model.is_byte(i)}
        if len(self.bytes) != 256 or len(names) > 1 << 16:
            raise ValueError("a model with byte fallback and at most 65536 pieces is needed")
        self.text = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() if p in plain and plain[p] == i else b""
            for i, p in enumerate(names)]
        self.chars = np.full(0x110000, -2, np.int32)  # -2: no piece, -1: no character
        for piece, i in plain.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        scores = sorted({-model.get_score(i) for i in plain.values()})
        place = {s: k for k, s in enumerate(scores)}
        pairs = sorted(
            (plain[p[:k]] << 16 | plain[p[k:]], place[-model.get_score(i)], i)
            for p, i in plain.items() for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain)
        self.pairs = np.array([x[0] for x in pairs], np.int64)
        self.ranks = np.array([x[1] for x in pairs], np.int32)
        self.merged = np.array([x[2] for x in pairs], np.int32)
        self.seed, self.limit = seed, np.uint64(min(int(rate * 2**64), 2**64 - 1))
        self.cache = cache
        # By number of a known chunk: ids without dropout, hash of its characters, where its merges end in the last one.
        self.known: dict[str | None, int] = {None: 0}
        self.plain = [np.array([self.bytes[b] for b in SPACE.encode()], "<u2").tobytes()]
        self.sums, self.ends, self.merges = _Column(), _Column(), _Column()
        self.sums.extend(np.zeros(1, np.uint64))
        self.ends.extend(np.zeros(1, np.uint64))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of merging each pair, or ``_NONE``, and its row in the table of pairs."""
        key = (left.astype(np.int64) << 16) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        fits = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(fits, self.ranks[at], _NONE), at

    def _skipped(self, word: np.ndarray, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._below(word, _key(left, right, place))

    def _below(self, word: np.ndarray, merge: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix(word + merge) < self.limit

    def _together(self, symbols: np.ndarray, word: np.ndarray, log: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of symbols, padded with -1, all at once; with the first character of each symbol left.

        With a ``log`` nothing is skipped, and it gets the rows and the hashes of their merges.
        """
        n, width = symbols.shape
        place = np.tile(np.arange(width, dtype=np.int16), (n, 1))
        rank = self._rank(symbols[:, :-1], symbols[:, 1:])[0]
        rows, across = np.arange(n), np.arange(width)
        while len(rows):
            best = rank[rows].argmin(1)
            open_ = rank[rows, best] < _NONE
            rows, best = rows[open_], best[open_]
            left, right = symbols[rows, best], symbols[rows, best + 1]
            if log is None:
                skip = self._skipped(word[rows], left, right, place[rows, best])
            else:
                skip = np.zeros(len(rows), bool)
                log.append((rows, _key(left, right, place[rows, best])))
            rank[rows[skip], best[skip]] = _NONE
            a, b = rows[~skip], best[~skip]
            if not len(a):
                continue
            new = self.merged[self._rank(left[~skip], right[~skip])[1]]
            shift = np.minimum(across + (across > b[:, None]), width - 1)
            for array, end in ((symbols, -1), (place, 0)):
                moved = np.take_along_axis(array[a], shift, 1)
                moved[:, -1] = end
                array[a] = moved
            symbols[a, b] = new
            moved = np.take_along_axis(rank[a], np.minimum(shift[:, :-1], width - 2), 1)
            moved[:, -1] = _NONE
            rank[a] = moved
            rank[a, b] = self._rank(new, symbols[a, np.minimum(b + 1, width - 1)])[0]
            inner = b > 0
            rank[a[inner], b[inner] - 1] = self._rank(symbols[a[inner], b[inner] - 1], new[inner])[0]
        return symbols, place

    def _alone(self, symbols: np.ndarray, word: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`_together` for one row, with a heap as the agenda."""
        ids, n = symbols.tolist(), len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]

        def rank(left: int, right: int) -> tuple[int, int]:
            r, at = self._rank(np.array([left]), np.array([right]))
            return int(r[0]), int(self.merged[at[0]])

        ranks = self._rank(symbols[:-1], symbols[1:])[0]
        agenda = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r < _NONE]
        heapq.heapify(agenda)
        while agenda:
            _, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue
            if self._skipped(word, np.array([left]), np.array([right]), np.array([i]))[0]:
                continue
            ids[i], ids[j] = rank(left, right)[1], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0 and ids[a] >= 0 and ids[after[a]] >= 0:
                    r, _ = rank(ids[a], ids[after[a]])
                    if r < _NONE:
                        heapq.heappush(agenda, (r, a, ids[a], ids[after[a]]))
        place = np.flatnonzero(np.array(ids) != -1)
        return np.array(ids, np.int32)[place], place

    @staticmethod
    def _hashed(chunks: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of all chunks, where each chunk starts, its size, and the hash of its characters."""
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(c) for c in chunks], np.int64)
        starts = np.cumsum(sizes) - sizes
        parts = _key(points, np.arange(len(points)) - np.repeat(starts, sizes))
        with np.errstate(over="ignore"):
            return points, starts, sizes, np.add.reduceat(parts, starts)

    def _word(self, sums: np.ndarray, variants: np.ndarray) -> np.ndarray:
        return _key(sums, variants, self.seed % 2**64)

    def segment(self, chunks: Sequence[str], variants: Sequence[int]) -> list[bytes]:
        """Ids (unsigned 16-bit, little endian) of chunks, each under the variant given with it."""
        points, starts, sizes, sums = self._hashed(chunks)
        return self._merged(chunks, self.chars[points], starts, sizes, self._word(sums, np.asarray(variants, np.uint64)))

    def _learn(self, chunks: Sequence[str]) -> None:
        """Append chunks of up to ``TOGETHER`` characters to what is known by number."""
        points, starts, sizes, sums = self._hashed(chunks)
        log: list[tuple[np.ndarray, np.ndarray]] = []
        self.plain += self._merged(chunks, self.chars[points], starts, sizes, sums, log)
        owner, merges = (np.concatenate(x) for x in zip(*log)) if log else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        self.ends.extend(self.merges.size + np.cumsum(np.bincount(owner, minlength=len(chunks))))
        self.merges.extend(merges[np.argsort(owner, kind="stable")])
        self.sums.extend(sums)

    def _forget(self, n: int) -> None:
        """Keep the first ``n`` known chunks only."""
        del self.plain[n:]
        self.sums.size = self.ends.size = n
        self.merges.size = int(self.ends.data[n - 1])

    def _merged(self, chunks: Sequence[str], symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, word: np.ndarray,
                log: list | None = None) -> list[bytes]:
        out: list = [b""] * len(chunks)
        low = 0
        for high in (4, 8, 12, 16, 32, TOGETHER):
            own = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if not len(own):
                continue
            at = starts[own][:, None] + np.arange(high)
            inside = np.arange(high) < sizes[own][:, None]
            rows = np.where(inside, symbols[np.minimum(at, len(symbols) - 1)], -1).astype(np.int32)
            steps = None if log is None else []
            merged, place = self._together(rows, word[own], steps)
            if log is not None:
                log += [(own[r], merge) for r, merge in steps]
            used = merged != -1
            ends = np.cumsum(used.sum(1)).tolist()
            flat = merged[used].astype("<u2").tobytes()
            for i, a, b in zip(own.tolist(), [0, *ends[:-1]], ends):
                out[i] = flat[2 * a:2 * b]
            for k in np.flatnonzero((merged == -2).any(1)):
                count = int(used[k].sum())
                out[own[k]] = self._fallback(merged[k, :count], place[k, :count], chunks[own[k]])
        for i in np.flatnonzero(sizes > TOGETHER):
            merged, place = self._alone(symbols[starts[i]:starts[i] + sizes[i]], word[i])
            out[i] = self._fallback(merged, place, chunks[i])
        return out

    def _fallback(self, merged: np.ndarray, place: np.ndarray, chunk: str) -> bytes:
        ids: list[int] = []
        for x, p in zip(merged.tolist(), place.tolist()):
            ids += [x] if x >= 0 else [self.bytes[b] for b in chunk[p].encode()]
        return np.array(ids, "<u2").tobytes()

    @staticmethod
    def chunks(text: str) -> list[str | None]:
        """Chunks of a text behind its first space; None stands for the model's space sign itself in the text."""
        if not text:
            return []
        if SPACE not in text:
            return _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        out: list[str | None] = []
        for k, part in enumerate(text.split(SPACE)):
            out += [None] if k else []
            out += _CHUNK.findall(("" if k else SPACE) + part.replace(" ", SPACE))
        return out

    def encode(self, texts: Sequence[str | None], keys: Sequence[int]) -> list[bytes]:
        """Ids of each text; ``keys`` tell the texts apart, so that equal ones can be segmented differently."""
        split = [self.chunks(t or "") for t in texts]
        counts = np.array([len(s) for s in split], np.int64)
        starts = np.cumsum(counts) - counts
        flat = list(chain.from_iterable(split))
        if not flat:
            return [b""] * len(texts)
        owner = np.repeat(np.arange(len(split)), counts)
        number = np.arange(len(flat)) - starts[owner]
        key = np.array([k or 0 for k in keys], np.int64).view(np.uint64)
        variants = _key(key[owner], number, self.seed % 2**64)
        place = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        kept, missing = len(self.plain), np.flatnonzero(place < 0).tolist()
        fresh = list(dict.fromkeys(flat[i] for i in missing if len(flat[i]) <= TOGETHER))
        if fresh:
            self._learn(fresh)
            new = dict(zip(fresh, range(kept, kept + len(fresh))))
            place[missing] = [new.get(flat[i], -1) for i in missing]
            if kept < self.cache:
                self.known.update(new)
                kept += len(fresh)
        found = [self.plain[p] for p in place.tolist()]  # what stands for -1 is replaced
        varied = [np.zeros(0, np.int64)]
        for at in range(0, len(flat), AT_ONCE):
            varied.append(at + np.flatnonzero(self._varied(place[at:at + AT_ONCE], variants[at:at + AT_ONCE])))
        self._forget(kept)
        again = np.concatenate(varied)
        for at in range(0, len(again), AT_ONCE):
            part = again[at:at + AT_ONCE]
            own = part.tolist()
            for i, ids in zip(own, self.segment([flat[i] for i in own], variants[part])):
                found[i] = ids
        ends = (starts + counts).tolist()
        return [b"".join(found[a:b]) for a, b in zip(starts.tolist(), ends)]

    def _varied(self, place: np.ndarray, variants: np.ndarray) -> np.ndarray:
        """Which occurrences of known chunks skip one of their merges; true for those of chunks not known (-1)."""
        out = place < 0
        ends = self.ends.data.view(np.int64)
        known = np.flatnonzero(~out)
        chunk = place[known]
        first = np.where(chunk > 0, ends[chunk - 1], 0)
        n = ends[chunk] - first
        word = self._word(self.sums.data[chunk], variants[known])
        at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out[np.repeat(known, n)[self._below(np.repeat(word, n), self.merges.data[at])]] = True
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of a text."""
        return b"".join(map(self.text.__getitem__, ids.tolist()))[1:]


@lru_cache(maxsize=2)
def _pieces(model_path: str, rate: float, seed: int) -> Pieces:
    """One model per Python worker, which Spark keeps from task to task."""
    return Pieces(model_path, rate, seed)


def _texts(batch: pa.RecordBatch, size: int = 1 << 20) -> Iterator[tuple[pa.Array, list[str]]]:
    """(doc_id column, texts) of some texts at a time, about ``size`` characters or one longer text."""
    for at in range(0, batch.num_rows, 256):  # what is copied at once is a part of the batch
        ids, texts, first, held = batch.column(0).slice(at, 256), batch.column(1).slice(at, 256).to_pylist(), 0, 0
        for i, text in enumerate(texts):
            held += len(text or "")
            if held >= size or i == len(texts) - 1:
                yield ids.slice(first, i + 1 - first), texts[first:i + 1]
                first, held = i + 1, 0


def encode(docs: DataFrame, model_path: str, rate: float = 0.1, seed: int = 0) -> DataFrame:
    """(doc_id, ids) with the piece ids of every whole text. A null text counts as empty and has no ids.

    The segmentation depends on the seed, the ``doc_id`` (0 for null) and the text alone, so a repeated task, or a
    repeated row, gives the same ids. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(model_path, rate, seed)
        for batch in batches:
            for names, texts in _texts(batch):
                found = model.encode(texts, names.to_pylist())
                edges = np.cumsum([0, *[len(x) // 2 for x in found]])
                flat = np.frombuffer(b"".join(found), "<u2").astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [names, pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null or no ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(model_path, 0.0, 0)
        for batch in batches:
            ids = [np.array(x.values) if x.is_valid else np.zeros(0, np.int32) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([model.decode(x).decode() for x in ids], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, rate: float = 0.1, seed: int = 0) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, text_crc32, lossless): digests of the ids of every text and of what they decode to.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers, ``text_crc32`` over the decoded bytes.
    A null text counts as empty and gives no ids. Skips are keyed by ``doc_id`` and place, so repeated rows give repeated
    results, and rows without an id are keyed alike. Merges of equal rank go from left to right. An empty table gives no
    rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _pieces(model_path, rate, seed)
        for batch in batches:
            for names, texts in _texts(batch):
                ids = [np.frombuffer(x, "<u2") for x in model.encode(texts, names.to_pylist())]
                back = [model.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays([
                    names, pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x) for x in back], pa.int64()),
                    pa.array([a == (b or "").encode() for a, b in zip(back, texts)])],
                    names=["doc_id", "n_tokens", "ids_crc32", "text_crc32", "lossless"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_crc32 long, text_crc32 long, lossless boolean")
