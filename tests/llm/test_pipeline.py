"""Each stage of the pipeline against plain Python on what the stage before it kept."""

import re

import pytest

import corpus_pipeline
from test_brute_force import linked, plain_base, plain_fingerprint
from tidemark.llm import passages, pieces
from tidemark.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, sf):
    """Rows before the first stage and after each, by doc_id."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames, tables = [docs], [{r["doc_id"]: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, sf), name)
        frames.append(docs)
        tables.append({r["doc_id"]: r for r in docs.collect()})
    return frames, tables


def test_quality_stage_keeps_what_the_query_accepts(spark, sf, stages):
    frames, tables = stages
    scored = passages.quality(frames[0], spark.read.parquet(f"{sf}/labels.parquet"))
    assert set(tables[1]) == {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    assert all(tables[0][i] == row for i, row in tables[1].items())


def test_near_duplicates_stage(stages):
    before, after = stages[1][1:3]
    ids = sorted(before)
    prints = [plain_fingerprint(before[i]["text"]) for i in ids]
    near = [(a, b) for a in range(len(ids)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = linked(len(ids), near)
    assert set(after) == {ids[k] for k, root in enumerate(roots) if k == root}
    assert all(before[i] == row for i, row in after.items())


def in_order(item, words):
    row = [0] * (len(words) + 1)
    for x in item:
        diagonal = 0
        for j, y in enumerate(words, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1] / len(item)


def test_decontamination_stage(spark, sf, stages):
    before, after = stages[1][2:4]
    plain = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = [plain(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for i, row in before.items():
        words = plain(row["text"])
        whole = any(f" {' '.join(item)} " in f" {' '.join(words)} " for item in items if len(item) >= 5)
        if whole:
            assert i not in after
        elif i not in after:
            assert max(in_order(item, words) for item in items) >= 0.6
    assert all(before[i] == row for i, row in after.items())


def test_secret_stage(stages):
    before, after = stages[1][3:5]
    assert set(before) == set(after)
    masked = 0
    for i, row in before.items():
        text, at, out = row["text"], 0, []
        for span in filter(None, plain_base(text).split(",")):
            _, a, b = span.split(":")
            if int(a) > at or not out:
                out += [text[at:int(a)], "[SECRET]"]
            at = max(at, int(b))
        assert after[i]["text"] == "".join(out) + text[at:]
        masked += bool(out)
    assert masked


def test_token_stage_decodes_to_the_text(stages):
    before, after = stages[1][4:6]
    frames = stages[0]
    back = {r["doc_id"]: r["text"] for r in pieces.decode(frames[5], tokenizer_path("piece_bpe_32k.model")).collect()}
    assert set(after) == set(before) and back == {i: r["text"] for i, r in before.items()}
