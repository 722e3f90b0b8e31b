"""Operators against plain Python on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from tidemark.llm import caps, idfiles, pieces, secrets, shards, simhash
from tidemark.llm.components import components
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.text import hashes, word_hash, words


def linked(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    chain = list(range(60))
    rng.shuffle(chain)
    pairs = list(zip(chain, chain[1:])) + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (5, 5)]
    expected = linked(300, pairs)
    out = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {r["node"]: r["root"] for r in out} == {i: r for i, r in enumerate(expected) if r != i}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_fingerprint(text):
    found = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(found[i:i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    values = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def test_simhash(spark, sf, documents):
    prints = [plain_fingerprint(d["text"]) for d in documents]
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    expected = linked(len(prints), pairs)
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in entry.queries()["op8_simhash"](spark, sf).collect()}
    ids = [d["doc_id"] for d in documents]
    assert out == {i: (format(p, "016x"), ids[e]) for i, p, e in zip(ids, prints, expected)}


@pytest.mark.parametrize("limit", [1, 8, 10_000])
def test_fingerprint_links_in_full_and_other_blocks(spark, limit):
    rng = random.Random(limit)
    base = [rng.getrandbits(64) for _ in range(6)]
    found = {b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(60)}
    found = sorted(x - (1 << 64) if x >> 63 else x for x in found)
    table = spark.createDataFrame([(x,) for x in found], "fp long")
    links = {(r["u"], r["v"]) for r in simhash.fingerprint_links(table, limit).collect()}
    place = {x: i for i, x in enumerate(found)}
    near = [(i, j) for i in range(len(found)) for j in range(i) if ((found[i] ^ found[j]) & (2**64 - 1)).bit_count() <= 2]
    assert linked(len(found), [(place[u], place[v]) for u, v in links]) == linked(len(found), near)
    # Linked through a midpoint, two fingerprints may differ in two bits each.
    assert all(((u ^ v) & (2**64 - 1)).bit_count() <= 2 for u, v in links)


def test_caps_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 24))
    vectors = np.concatenate([base, *[base[:20] + rng.standard_normal((20, 24)) * s for s in (0.1, 0.3, 0.4)]])
    vectors = np.concatenate([vectors, vectors[:10], np.tile(base[:1], (40, 1)) + rng.standard_normal((40, 24)) * 0.05])
    labels = rng.integers(0, 2, len(vectors)).tolist()
    labels[-40:] = [1] * 40
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    pairs = [(i, j) for i in range(len(unit)) for j in range(i) if labels[i] == labels[j] and unit[i] @ unit[j] >= 0.93]
    degree = np.bincount(np.array(pairs).ravel(), minlength=len(unit)).tolist()
    expected = linked(len(unit), pairs)
    rows = [(i, v.tolist(), lab) for i, (v, lab) in enumerate(zip(vectors, labels))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for chunk in (8, 512):  # with filters in chunks, and whole
        out = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in caps.near_vectors(table, chunk=chunk).collect()}
        assert out == {i: (d, e) for i, (d, e) in enumerate(zip(degree, expected))}


def test_caps_recall(spark, sf):
    table = spark.read.parquet(f"{sf.replace('0.001', '0.1')}/embeddings.parquet")
    data = table.toPandas()
    found = caps.near_vectors(table).toPandas()["n_links"].sum()
    total = 0
    for _, part in data.groupby("label"):
        x = np.array(part["embedding"].tolist(), float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        total += (x @ x.T >= 0.93).sum() - len(x)
    assert found >= 0.9 * total and found <= total


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


SECRETS = [
    "token:token:abcdefgh", 'é😀 Password = "hunter22" and API_KEY:x', "AKIAAKIA" + "A" * 20, "AKIA123 " + "AKIA" + "B" * 16,
    "0" * 23 + "g" + "f" * 24, "secret: key token=abcdefg secret=abcdefghi", "x" * 30 + "token=" + "0123456789abcdef" * 2, "",
    "apikey='a.b-c_d' " * 1500, "ſecret=abcdefghi passwd:  abc123",
]


def test_secrets_base_spans(spark, documents):
    texts = SECRETS + [d["text"] for d in documents]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in secrets.scan(rows).collect()}
    for i, text in enumerate(texts):
        base = plain_base(text)
        assert out[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), text[:80]
        assert set(filter(None, base.split(","))) <= set(out[i]["spans"].split(","))
        for k in ("assign", "access", "hex"):
            assert out[i][f"n_{k}"] == sum(s.startswith(k) for s in base.split(","))


def test_secrets_battery_and_redaction(spark):
    rng = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    tokens = ["".join(rng.choice(letters) for _ in range(n)) for n in range(22, 90) for _ in range(3)]
    tokens = [t for t in tokens if re.search("[0-9]", t)]
    plain = [f"chapter-{i}-of-the-long-history-of-the-county-and-its-people-in-{1900 + i}" for i in range(60)]
    plain += ["0123456789abcdefghijklmnopqrstuvwxyz", "a1" * 20, "x" * 30 + "1", "Internationalisation2024Committee"]
    rows = spark.createDataFrame(
        list(enumerate([f"see {t} here" for t in tokens + plain])), "doc_id long, text string")
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(rows).collect()}
    hit = sum(out[i] == f"random:4:{4 + len(t)}" for i, t in enumerate(tokens))
    false = sum("random" in out[len(tokens) + i] for i in range(len(plain)))
    assert hit >= 0.9 * len(tokens) and false <= 2
    hidden = {r["doc_id"]: r["text"] for r in secrets.redact(rows).collect()}
    for i, spans in out.items():
        assert hidden[i] == "see [SECRET] here" if spans else "SECRET" not in hidden[i]


def test_id_files_round_trip(spark, sf, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out = {r["doc_id"]: r for r in entry.queries()["op6_id_files"](spark, sf).collect()}
    start = 0
    for d in documents:
        ids = [*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        row = out.pop(d["doc_id"])
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert not out


def test_elias_fano_select():
    rng = np.random.default_rng(2)
    for n, top in ((1, 0), (3, 0), (1000, 10), (5000, 10**6), (700, 10**9), (2, 2**33)):
        counts = rng.integers(0, top // n + 1, n)
        packed = idfiles.pack(b"", np.zeros(0, int), 2) if n == 1 else None
        edges = np.concatenate(([0], np.cumsum(counts)))
        low, lows, upper, samples = idfiles.elias_fano(edges, int(edges[-1]))
        read = idfiles.Boundaries(len(edges), low, lows, upper, samples)
        assert (read.all() == edges).all()
        assert all(read.select(i) == edges[i] for i in {0, n // 2, n, min(n, 255), min(n, 256), min(n, 257)})
        assert (len(lows) + len(upper)) * 8 <= (low + 3) * len(edges) + 16
        assert packed is None or idfiles.Segment(packed).n == 0


def test_chunks_encode_as_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    encoder, tokenizer = idfiles.Encoder(path, cache=5), Tokenizer.from_file(path)
    texts = ["It's  a  test\n\nof\tchunks ", "Σίσυφος ΟΔΟΣ İstanbul é", "ÀÉÎ ŽŠ İ K Straße ABC<|ENDOFTEXT|>", "ÀÉÎ ŽŠ Straße ABC\u0301", " <|endoftext|> x<|startoftext|>y ", "a　b c", None, ""]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_differencing_against_plain_karmarkar_karp():
    rng = random.Random(3)
    sizes = [rng.randint(1, 1000) for _ in range(400)]
    parts = shards.difference([[s, 0, 0, 0] for s in sizes])
    loads = [0] * 4
    for s, p in zip(sizes, parts[:, 0]):
        loads[p] += s
    assert sorted(parts[0].tolist()) == [0, 1, 2, 3]
    rows = [(s, [s, 0, 0, 0]) for s in sizes]
    states = sorted((r[1] for r in rows), key=lambda x: x[-1] - x[0])
    while len(states) > 1:  # spreads of the plain method
        a, b = states.pop(0), states.pop(0)
        states.append(sorted((x + y for x, y in zip(a, reversed(b))), reverse=True))
        states.sort(key=lambda x: x[-1] - x[0])
    assert max(loads) - min(loads) <= 2 * max(1, states[0][0] - states[0][-1])


@pytest.mark.parametrize("at_once", [7, 50_000])
def test_shards(spark, sf, documents, at_once):
    out = shards.shard_documents(spark.read.parquet(f"{sf}/documents.parquet"), 8, at_once).collect()
    by_text, slots, loads = {}, {}, [0] * 8
    texts = {d["doc_id"]: d["text"] or "" for d in documents}
    for r in out:
        text = texts[r["doc_id"]]
        assert r["size"] == len(text.encode()) + 1 and r["text_crc32"] == zlib.crc32(text.encode())
        by_text.setdefault(text, set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert len(out) == len(documents) and all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads) - min(loads) <= 0.02 * sum(loads) / 8


def test_pieces_without_dropout_are_the_models(documents):
    import sentencepiece

    path = tokenizer_path("piece_bpe_32k.model")
    model, plain = sentencepiece.SentencePieceProcessor(model_file=path), pieces.Pieces(path, 0.0)
    texts = [d["text"] for d in documents] + ["", "  two  spaces ", "a\nb\n", "日本語\x00", "w" * 300]
    for text, ids in zip(texts, plain.encode(texts, [0] * len(texts))):
        assert np.frombuffer(ids, "<u2").tolist() == model.encode(text)


def test_pieces_vary_and_decode(documents):
    path = tokenizer_path("piece_bpe_32k.model")
    texts = [d["text"] for d in documents] + ["▁ a▁b ▁", "w" * 300 + " internationally"]
    one, two = pieces.Pieces(path, 0.2, 1), pieces.Pieces(path, 0.2, 2)
    keys = list(range(len(texts)))
    first, again, other = one.encode(texts, keys), pieces.Pieces(path, 0.2, 1, cache=0).encode(texts, keys), two.encode(texts, keys)
    assert first == again and first != other
    assert one.encode(["a fairly long sentence about internationalisation"] * 50, range(50)).count(first[0]) == 0
    assert len(set(one.encode(["a fairly long sentence about internationalisation"] * 50, range(50)))) > 5
    for text, ids in zip(texts, first):
        assert one.decode(np.frombuffer(ids, "<u2")).decode() == text


def test_heap_and_rows_agree(monkeypatch):
    path = tokenizer_path("piece_bpe_32k.model")
    chunks = ["▁internationalisation", "▁quarrelsome", "supercalifragilistic", "▁▁▁x", "▁Ünïcödé"] * 4
    variants = [i % 4 for i in range(len(chunks))]
    rows = pieces.Pieces(path, 0.3, 5).segment(chunks, variants)
    monkeypatch.setattr(pieces, "TOGETHER", 0)
    model = pieces.Pieces(path, 0.3, 5)
    for chunk, variant, ids in zip(chunks, variants, rows):
        points = np.frombuffer(chunk.encode("utf-32-le"), np.uint32)
        word = pieces._key(np.add.reduceat(pieces._key(points, np.arange(len(points))), [0]), [variant], 5)
        assert model._fallback(*model._alone(model.chars[points], word), chunk) == ids


def test_words_and_hashes():
    body = np.frombuffer("one, Two\nthree über".encode(), np.uint8)
    starts, ends, text = words(body, np.array([0, 8, len(body)]))
    assert [body[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["one", "Two", "three", "über"]
    assert text.tolist() == [0, 0, 1, 1]
    assert hashes(body, starts, ends)[2] == word_hash("THREE") and word_hash("Über") == word_hash("über")
