"""Token ids of documents in one concatenated array, with Elias-Fano coded document boundaries.

Format of a segment (little endian): the four bytes ``TMEF``, then six unsigned 64-bit numbers: documents n,
ids m, bytes per id w, low bits l, bytes of the upper bit array, number of select samples; then the ids (m * w
bytes), the low bits of the n + 1 boundaries (packed), the upper bit array, and the select samples (unsigned
32-bit). Boundaries b_0 = 0 <= ... <= b_n = m cost at most l + 3 bits each, l = floor(log2(m / (n + 1))). Sample j is the
position of set bit j * 256 in the upper array, so any boundary is found from a few words without a table of
64-bit offsets. Segments are stored as rows (segment, payload) of a Parquet table, whose committed write survives
lost executors and works on every store that Spark can write.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.shared import keep
from tidemark.session import new_scratch

MAGIC, SAMPLE = b"TMEF", 256
#: A segment is closed once it holds this many ids, and holds one longer document at most.
SEGMENT_IDS = 4 << 20
#: Chunks whose ids a task remembers.
CACHE = 900_000
_NOT_LATIN = re.compile("[^\x00-\u012f\u0131-\u017f]")


def elias_fano(values: np.ndarray, upper_bound: int) -> tuple[int, bytes, bytes, np.ndarray]:
    """(l, low bits, upper bits, select samples) of ascending ``values`` up to ``upper_bound``."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    low = max(0, (max(1, int(upper_bound)) // max(1, n)).bit_length() - 1)
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    at = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    upper = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
    upper[at] = 1
    return low, lows, np.packbits(upper, bitorder="little").tobytes(), at[::SAMPLE].astype("<u4")


class Boundaries:
    """Reads Elias-Fano coded boundaries: :meth:`select` for any of them, :meth:`all` for the whole list."""

    def __init__(self, n: int, low: int, lows: bytes, upper: bytes, samples: np.ndarray) -> None:
        self.n, self.low, self.samples = n, low, samples
        self.lows, self.upper = np.frombuffer(lows, np.uint8), np.frombuffer(upper, np.uint8)

    def _low(self, first: int, last: int) -> np.ndarray:
        if not self.low:
            return np.zeros(last - first, np.int64)
        start, stop = first * self.low, last * self.low
        bits = np.unpackbits(self.lows[start // 8:-(-stop // 8)], bitorder="little")[start % 8:][:stop - start]
        return bits.reshape(-1, self.low).astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))

    def select(self, i: int) -> int:
        """Boundary ``i``, read from its sample on."""
        byte, wanted = int(self.samples[i // SAMPLE]) // 8, i % SAMPLE
        skip = int(self.samples[i // SAMPLE]) % 8
        seen = 0
        while True:
            part = np.unpackbits(self.upper[byte:byte + 64], bitorder="little")
            part[:skip] = 0
            ones = np.flatnonzero(part)
            if seen + len(ones) > wanted:
                position = byte * 8 + int(ones[wanted - seen])
                return ((position - i) << self.low) + int(self._low(i, i + 1)[0])
            seen, byte, skip = seen + len(ones), byte + 64, 0

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.upper, bitorder="little"))
        return ((ones - np.arange(self.n)) << self.low) + self._low(0, self.n)


def pack(ids: bytes, counts: np.ndarray, width: int) -> bytes:
    """A segment of documents with ``counts`` ids each, whose ids stand in ``ids`` with ``width`` bytes each."""
    edges = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    low, lows, upper, samples = elias_fano(edges, int(edges[-1]))
    head = struct.pack("<6Q", len(counts), int(edges[-1]), width, low, len(upper), len(samples))
    return b"".join((MAGIC, head, ids, lows, upper, samples.tobytes()))


class Segment:
    """A packed segment: ``ids(i)`` of document i, found through the select structure."""

    def __init__(self, payload: bytes) -> None:
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        self.n, self.m, width, low, upper, samples = struct.unpack_from("<6Q", payload, 4)
        at = 52
        self.array = np.frombuffer(payload, f"<u{width}", self.m, at)
        at += self.m * width
        lows = -(-(self.n + 1) * low // 8)
        body = memoryview(payload)
        self.edges = Boundaries(
            self.n + 1, low, body[at:at + lows], body[at + lows:at + lows + upper],
            np.frombuffer(payload, "<u4", samples, at + lows + upper))

    def ids(self, i: int) -> np.ndarray:
        return self.array[self.edges.select(i):self.edges.select(i + 1)]


class Encoder:
    """Ids of texts as little-endian bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its chunks between
    spaces and line feeds. Ids of chunks are remembered up to a bound, further ones are encoded each time. Where the
    tokenizer lower-cases anyway, texts of Latin letters are put in lower case first, so that fewer chunks differ;
    texts with ``<|``, which may begin a special token, and all others are left to it.
    """

    def __init__(self, tokenizer_path: str, cache: int = CACHE) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.cache = Tokenizer.from_file(tokenizer_path), cache
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.known: dict[str, bytes] = {"": b""}
        self.folds = "Lowercase()" in str(self.tokenizer.normalizer)

    def _folded(self, text: str) -> str:
        return text.lower() if self.folds and "<|" not in text and not _NOT_LATIN.search(text) else text

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [self._folded(t or "").replace("\n", " ").split(" ") for t in texts]
        known, missing = self.known, set()
        for chunks in split:
            missing.update(c for c in chunks if c not in known)
        extra: dict[str, bytes] = {}
        if missing:
            found = list(missing)
            kind = f"<u{self.width}"
            done = self.tokenizer.encode_batch_fast(found, add_special_tokens=False)
            extra = {c: np.array(e.ids, kind).tobytes() for c, e in zip(found, done)}
            room = self.cache - len(known)
            if room >= len(extra):
                known.update(extra)
                extra = {}
            elif room > 0:
                known.update(list(extra.items())[:room])
        if not extra:
            return [b"".join(map(known.__getitem__, chunks)) for chunks in split]
        return [b"".join([known[c] if c in known else extra[c] for c in chunks]) for chunks in split]


@lru_cache(maxsize=1)
def _encoder(tokenizer_path: str) -> Encoder:
    """One encoder per Python worker, which Spark keeps from task to task."""
    return Encoder(tokenizer_path)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1) -> None:
    """Write the ids of every text, each followed by ``end_id``, in ascending ``doc_id`` order to ``path``.

    Rows (segment, first, docs, payload): segments are numbered in the order of their documents; ``docs`` has the
    document ids in order (nulls first). A null text counts as empty and is its end id alone. Rows of one ``doc_id``
    stand side by side. No group or table passes through one task: documents are range-partitioned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(tokenizer_path)
        end, number = int(end_id).to_bytes(encoder.width, "little"), 0
        names, parts, held = [], [], 0

        def segment() -> pa.RecordBatch:
            counts = np.array([len(p) // encoder.width for p in parts], np.int64)
            return pa.RecordBatch.from_pydict({
                "segment": pa.array([number], pa.int32()), "docs": pa.array([names], pa.list_(pa.int64())),
                "n_ids": pa.array([int(counts.sum())], pa.int64()),
                "payload": pa.array([pack(b"".join(parts), counts, encoder.width)], pa.binary())})

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                names += part.column(0).to_pylist()
                for ids in encoder.encode(part.column(1).to_pylist()):
                    parts.append(ids + end)
                    held += len(parts[-1]) // encoder.width
                if held >= SEGMENT_IDS:
                    yield segment()
                    names, parts, held, number = [], [], 0, number + 1
        if parts:
            yield segment()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, "segment int, docs array<long>, n_ids long, payload binary").select(
        F.spark_partition_id().alias("part"), "segment", "n_ids", "docs", "payload"
    ).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the segments at ``path``.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is the unsigned crc32 of the document's ids as
    little-endian unsigned 32-bit integers.
    """
    files = spark.read.parquet(path)
    sizes = keep(files.select("part", "segment", "n_ids"), "segments")
    before = Window.orderBy("part", "segment").rowsBetween(Window.unboundedPreceding, -1)
    # One row per some four million ids; the sum in order is over these alone.
    starts = sizes.select("part", "segment", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment(batch.column(1)[row].as_buffer())
                edges = segment.edges.all()
                first = batch.column(2)[row].as_py()
                ids = [segment.array[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0)[row].values, "start": pa.array(edges[:-1] + first),
                    "n_tokens": pa.array(np.diff(edges)),
                    "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())})

    return files.join(starts, ["part", "segment"]).select("docs", "payload", "first").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """:func:`write_ids` to the shared folder, then :func:`read_ids`. An empty table gives no rows."""
    path = new_scratch(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer_path, end_id)
    return read_ids(docs.sparkSession, path)
