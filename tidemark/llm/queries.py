"""One query per operator over the whole tables, with the parameters of production use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import caps, idfiles, language, latent, passages, pieces, repair, rules, runs, secrets, shards, simhash, toxicity
from tidemark.llm.rules_sql import RULES
from tidemark.llm.shared import small_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(_table(spark, sf_dir, "embeddings"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.encode_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(_table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(_table(spark, sf_dir, "conversations"), damage=True)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(_table(spark, sf_dir, "documents"), damage=True))


def op13_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("ratio_millionths")


QUERIES = {f.__name__: f for f in (
    op1_caps, op2_decontamination, op3_pieces, op4_secrets, op5_language, op6_id_files, op7_shards, op8_simhash, op9_toxicity, op10_quality,
    op11_repair, op12_runs, op13_rules)}
ORACLES: dict[str, str] = {
    "op13_rules": RULES,
    "op1_caps": """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), link AS (
    SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT vec_id, vec_id AS root FROM v
    UNION SELECT link.w, reach.root FROM reach JOIN link ON reach.vec_id = link.u
), low AS (
    SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id
), degree AS (
    SELECT u, count(*) AS n FROM link GROUP BY u
)
SELECT low.vec_id, coalesce(degree.n, 0) AS n_links, low.component_id, low.vec_id = low.component_id AS kept
FROM low LEFT JOIN degree ON low.vec_id = degree.u
""",
}
