"""Findings of the second advice: each test has the rows that were lost before."""

import random

import numpy as np
import pyarrow as pa

from tidemark.llm import caps, latent, pieces, secrets
from tidemark.llm.queries import tokenizer_path


def test_short_items_are_all_found(spark):
    rng = random.Random(12)
    common = [f"w{i}" for i in range(3000)]
    prose = lambda n: [rng.choice(common) for _ in range(n)]
    items = [prose(15) for _ in range(1000)]
    text = lambda w: " ".join(w[:11]) + ". " + " ".join(w[11:])
    rows, planted = [], set()

    def plant(*found):
        words = prose(300)
        for at, (i, own) in zip(sorted((rng.randrange(301) for _ in found), reverse=True), found):
            words[at:at] = own
            planted.add((len(rows), i))
        rows.append((len(rows), " ".join(words)))

    for i, own in enumerate(items):
        plant((i, own))
        lost = set(rng.sample(range(11), 5))  # other words instead; the answer, its last sentence, stays
        plant((i, [rng.choice(common) if k in lost else w for k, w in enumerate(own)]))
    for k in range(0, 1000, 25):
        plant(*[(i, items[i]) for i in range(k, k + 25)])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    benchmark = spark.createDataFrame([(i, text(w)) for i, w in enumerate(items)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, benchmark).collect()}
    assert len(planted) == 3000 and not planted - found, f"{len(planted - found)} of {len(planted)} lost"
    # The latent space proposes nearly all of them by itself; rare words complete it.
    alone = {(r["doc_id"], r["item_id"]) for r in latent.leaks(docs, benchmark, complete=False).collect()}
    assert len(planted & alone) >= 0.9 * len(planted), f"{len(planted - alone)} of {len(planted)} not proposed"
    assert alone <= found


def test_all_pairs_equal_brute_force(spark, sf):
    """Every document against every item: the best share over all stretches, by plain dynamic programming."""
    docs, benchmark = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark"))
    items = latent.read_items([(r["item_id"], r["text"], None) for r in benchmark.orderBy("item_id").collect()])
    matcher, want = latent.Matcher(items), set()
    rows = docs.select("doc_id", "text").collect()
    for row in rows:
        for _, _, ids, _ in latent._terms(pa.array([row["text"]]), items.vocabulary):
            for i, name in enumerate(items.names):
                n, stretch, best = len(items.words[i]), latent.stretch_words(len(items.words[i])), 0.0
                own = set(items.words[i].tolist())
                words = ids.tolist()
                for k in range(len(words)):
                    part = words[k:k + stretch]
                    if words[k] in own and sum(w in own for w in part) >= latent.PARAPHRASE * n:
                        share = plain_common(items.words[i].tolist(), part) / n
                        tail = items.words[i][items.answers[i]:].tolist()
                        if share >= 0.8 or share >= 0.6 and plain_common(tail, part) >= 0.8 * len(tail):
                            best = max(best, share)
                if best:
                    want.add((row["doc_id"], name, round(best, 9)))
    got = {(r["doc_id"], r["item_id"], round(r["overlap"], 9)) for r in latent.leaks(docs, benchmark).collect()}
    assert got == want and len(want) >= 3


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_overlap_is_the_best_of_a_document(spark):
    item = "How many quarrelsome badgers crossed the frozen river at midnight? The answer is thirty nine badgers."
    part = " ".join(w for i, w in enumerate(item.split()) if i not in (2, 5, 8))
    docs = spark.createDataFrame([(1, part + " other words" * 200 + " " + item), (2, part)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r["doc_id"]: round(r["overlap"], 2) for r in latent.leaks(docs, benchmark).collect()} == {1: 1.0, 2: 0.81}


def test_every_occurrence_drops_merges_by_itself():
    model = pieces.Pieces(tokenizer_path("piece_bpe_32k.model"), 0.1, 3)
    _, plain = model.encode(["", "it"], [0, 0]), pieces.Pieces(tokenizer_path("piece_bpe_32k.model"), 0.0).encode(["it"], [0])[0]
    texts = ["it"] * 4000
    varied = np.mean([x != plain for x in model.encode(texts, range(len(texts)))])
    assert 0.08 < varied < 0.2  # one or two merges, each skipped at a rate of 0.1
    long = "internationalisation of quarrelsome badgers"
    assert len(set(model.encode([long] * 2000, range(2000)))) > 100
    # The same as merging every occurrence anew, without what is remembered.
    chunks = model.chunks(long)
    for key, ids in zip(range(300), model.encode([long] * 300, range(300))):
        variants = pieces._key(np.full(len(chunks), key, np.uint64), np.arange(len(chunks)), 3)
        assert b"".join(model.segment(chunks, variants)) == ids


def test_random_letters_without_digits_are_secrets(spark):
    rng = random.Random(4)
    lower, upper = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tokens = ["".join(rng.choice(own) for _ in range(n)) for own in (lower, upper, lower + upper) for n in range(20, 60)]
    plain = ["internationalisation", "Geschwindigkeitsbegrenzung", "counterrevolutionaries", "Rechtsschutzversicherung",
             "anticonstitutionnellement", "electroencefalografista", "uncharacteristically", "einlichheitenpfpfver",
             "chapter-of-the-long-history", "usr/share/documentation/index", "-" * 40, "_" * 25, "iertionieroupamenteux"]
    rows = spark.createDataFrame(list(enumerate([f"see {t} here" for t in tokens + plain])), "doc_id long, text string")
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(rows).collect()}
    hit = sum(out[i] == f"random:4:{4 + len(t)}" for i, t in enumerate(tokens))
    false = [t for i, t in enumerate(plain) if out[len(tokens) + i]]
    assert hit >= 0.9 * len(tokens) and not false, (hit, false)


def random_tokens(rng):
    """200 texts of each class that a candidate once stayed untested in: the text before the token, and the token."""
    base62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    draw = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    classes = {"path": ("services/my-team/", base62, (40,)), "name": ("a-b/", base62, (40,)), "plain": ("", base62, (40,)),
               "hex": ("", "0123456789abcdef", (20, 21, 22)), "hex upper": ("", "0123456789ABCDEF", (20, 21, 22)),
               "base64 behind": ("my-team-", base62 + "+/", (44,))}
    return {k: [(before, draw(chars, rng.choice(sizes))) for _ in range(200)] for k, (before, chars, sizes) in classes.items()}


def test_tokens_behind_paths_and_short_hex_are_tested(spark):
    found = random_tokens(random.Random(9))
    texts = [(k, before, token) for k, own in found.items() for before, token in own]
    rows = [(i, f"see {before}{token} here") for i, (_, before, token) in enumerate(texts)]
    out = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = {k: 0 for k in found}
    for i, (k, before, token) in enumerate(texts):
        first = 4 + len(before)
        spans = [tuple(map(int, s.split(":")[1:])) for s in out[i].split(",") if s]
        hit[k] += any(a <= first and first + len(token) <= b for a, b in spans)
    assert all(n >= 180 for n in hit.values()), hit


def test_pairs_at_the_very_threshold_share_a_filter():
    rng = np.random.default_rng(1)
    x, e = rng.standard_normal((2, 1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    e -= (e * x).sum(1, keepdims=True) * x
    y = 0.9301 * x + np.sqrt(1 - 0.9301 ** 2) * e / np.linalg.norm(e, axis=1, keepdims=True)
    directions = int(np.ceil(np.sqrt(caps.FILTERS * 100_000 / caps.OCCUPANCY)))  # as for a label of 100,000 vectors
    one, two = caps.decode(x, directions), caps.decode(y, directions)
    assert min(map(len, one)) >= caps.LEAST
    assert sum(len(np.intersect1d(a, b)) > 0 for a, b in zip(one, two)) >= 0.99 * len(x)
