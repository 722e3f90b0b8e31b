"""The randomness battery in plain Python, and the spans it leaves of whole tables."""

import math
import random
import re
from collections import Counter

from test_recall import random_tokens
from tidemark.llm import secrets


def two_sided(z):
    x = abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = 0.0
    for a in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = (poly + a) * t
    return max(poly * math.exp(-x * x), 1e-30)


def letters(token):
    logs = [math.log(x) for x in secrets.LETTERS]
    mean = sum(logs) / 26
    spread = math.sqrt(sum((x - mean) ** 2 for x in logs) / 26)
    own = re.sub("[^a-z]", "", token.lower())
    return max(0.0, sum((logs[ord(c) - 97] - mean) / spread for c in own) / math.sqrt(len(own))) if own else 0.0


def battery(token):
    """(n, p), or None where no encoding fits."""
    chars = next((c for _, p, c in secrets.ENCODINGS if re.search(p, token)), None)
    bare = token.rstrip("=")
    if chars is None or re.fullmatch("[0-9]+", token) or len(bare) < 20:
        return None
    x, n, k = [chars.index(c) for c in bare], len(bare), len(chars)
    df = k - 1
    chi = k / n * sum(c * c for c in Counter(x).values()) - n
    z_chi = max(0.0, ((max(chi, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    half = [v >= k / 2 for v in x]
    high, low = sum(half), n - sum(half)
    runs = 1 + sum(a != b for a, b in zip(half, half[1:]))
    mean_runs = 2 * high * low / n + 1
    var = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    z_runs = (runs - mean_runs) / math.sqrt(var) if var > 0 else 12.0
    mean = sum(x) / n
    spread = sum((v - mean) ** 2 for v in x)
    serial = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:]))
    z_serial = (serial / spread + 1 / (n - 1)) * math.sqrt(n) if spread > 0 else 12.0
    digits = re.search("[0-9]", token)
    p = min(two_sided(z) for z in (z_chi, z_runs, z_serial, 0.0 if digits else letters(token)))
    return n, min((3 if digits else 4) * p, 1.0)


def found(text):
    """(start, end, n, p) of every candidate."""
    out = set()
    for m in re.finditer(secrets.CANDIDATE, text):
        parts = [(m.start(), m.end())]
        if re.search("[+/_-]", m[0]):
            parts = [(m.start() + q.start(), m.start() + q.end()) for p in secrets.PARTS for q in re.finditer(p, m[0])]
        out |= {(a, b, *test) for a, b in parts if (test := battery(text[a:b]))}
    return out


def bases(text):
    spans = [(m.start(), m.end(), 0) for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= 6]
    spans += [(m.start(), m.end(), 1) for m in re.finditer(secrets.ACCESS, text) if len(m[0]) >= 20]
    return sorted(spans + [(m.start(), m.end(), 2) for m in re.finditer(secrets.HEX, text) if len(m[0]) >= 24])


def plain(texts):
    """The spans of every text: Benjamini-Hochberg by length class over bins of -ln p."""
    tests = [found(t) for t in texts]
    place = lambda p: min(math.floor(-math.log(p) * secrets.BINS_PER_UNIT), secrets.BINS)
    counts = Counter((math.floor(math.log2(n)), place(p)) for own in tests for _, _, n, p in own)
    cut = {}
    for size in {c for c, _ in counts}:
        rank, total = 0, sum(m for (c, _), m in counts.items() if c == size)
        for b in sorted((b for c, b in counts if c == size), reverse=True):
            rank += counts[size, b]
            if math.exp(-b / secrets.BINS_PER_UNIT) <= secrets.LEVEL * rank / total:
                cut[size] = b
    out = []
    for text, own in zip(texts, tests):
        base = bases(text)
        kept = {(a, b) for a, b, n, p in own if place(p) < cut.get(math.floor(math.log2(n)), secrets.BINS + 1)
                and not any(s < b and a < e for s, e, _ in base)}
        kept = [(a, b, 3) for a, b in kept if not any(x <= a and b <= y and (x, y) != (a, b) for x, y in kept)]
        out.append(",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, b, k in sorted(base + kept, key=lambda s: (s[0], s[1], s[2]))))
    return out


def test_spans_equal_the_plain_battery(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    planted = [f"see {before}{token} here" for own in random_tokens(random.Random(3)).values() for before, token in own[:20]]
    docs = docs.unionByName(spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(planted)], docs.schema))
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip((r["doc_id"] for r in rows), plain([r["text"] or "" for r in rows])))
    assert got == want
    assert any("random" in s for s in got.values())
