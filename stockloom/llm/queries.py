"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import (
    chat, decontaminate, exact, html_text, langid, line_dedup, mixing, pii, prefix_trie, repair, sharding, simhash, toxicity,
)
from stockloom.llm.oracles import ORACLES
from stockloom.sources.scratch import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """conv_id, seq, text, role: each turn written down in one of the usual ways, some without a speaker.

    The way follows from a checksum of the turn's ids, so reruns agree.
    """
    names = {"system": ("System", "Instructions"), "user": ("User", "Human"), "assistant": ("Assistant", "AI")}
    way = F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary")) % 8
    name = F.lit("User")
    for role, (first, second) in names.items():
        name = F.when(F.col("role") == role, F.when(way % 2 == 0, first).otherwise(second)).otherwise(name)
    text = F.coalesce("text", F.lit(""))
    piece = (
        F.when(way < 3, F.concat(name, F.lit(": "), text))
        .when(way == 3, F.concat(F.lit("### "), name, F.lit("\n"), text))
        .when(way == 4, F.concat(F.lit("["), name, F.lit("] "), text))
        .when(way == 5, F.concat(F.lit("<|"), F.lower(name), F.lit("|>\n"), text))
        .otherwise(F.concat(F.lit("\n"), text))
    )
    return conversations.select("conv_id", F.col("turn").alias("seq"), piece.alias("text"), "role")


def op8_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = raw_transcripts(_table(spark, sf_dir, "conversations"))
    model = chat.train(pieces.where(~langid.held_out("conv_id", 5, 0)))
    found = chat.turns(pieces.drop("role"), model)
    return found.withColumn("held_out", langid.held_out("conv_id", 5, 0))


def op9_simhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op1_benchmark_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items)


def op2_line_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_toxicity_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", langid.held_out("doc_id", 4, 2))
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    docs = docs.withColumn("apart", toxicity.for_curve(F.col("text")))
    gains = toxicity.train(toxicity.labelled(docs.where("not held_out and not apart"), labels))
    found = stage(toxicity.compared(docs, gains), "toxicity")
    score = toxicity.score(toxicity.fitted(found.where("not held_out").join(labels, "doc_id")))
    return found.select("doc_id", "held_out", score.alias("score"), toxicity.predicted(score).alias("predicted"))


def op4_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out("doc_id", 5, 0))
    model = langid.train(docs.where("not held_out"))
    found = langid.identified(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicates(_table(spark, sf_dir, "documents"))


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mix = mixing.mixed(mixing.sized(docs).drop("text"))
    position = mixing.due(F.col("offset") / F.col("target"), F.col("tilt"))
    wanted = mix.withColumn("position", F.when(F.col("taken") > 0, F.least(position, F.lit(1.0))))
    return wanted.select("doc_id", "size", "source_size", "target", "taken", "position").orderBy(
        F.col("position").asc_nulls_last(), "doc_id"
    )


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymised(docs, key="a key that only tests use")
    kinds = F.array_join(F.array_sort(F.array_distinct(F.transform("pii", lambda p: p["kind"]))), ",")
    return found.select("doc_id", F.size("pii").alias("values"), kinds.alias("kinds"), "text")


def op10_jump_hash_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(_table(spark, sf_dir, "documents"), 40)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), html_text.train())


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    return repair.repaired(repair.damaged(conversations), conversations)


QUERIES = {
    "op1_benchmark_templates": op1_benchmark_templates,
    "op2_line_minhash": op2_line_minhash,
    "op3_toxicity_kneser_ney": op3_toxicity_kneser_ney,
    "op4_language_bayes": op4_language_bayes,
    "op5_exact_duplicates": op5_exact_duplicates,
    "op6_curriculum_mix": op6_curriculum_mix,
    "op7_feistel_pseudonyms": op7_feistel_pseudonyms,
    "op10_jump_hash_shards": op10_jump_hash_shards,
    "op8_chat_roles": op8_chat_roles,
    "op9_simhash_near_copies": op9_simhash_near_copies,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_html_extraction": op12_html_extraction,
    "op13_conversation_repair": op13_conversation_repair,
}

__all__ = ["ORACLES", "QUERIES"]
