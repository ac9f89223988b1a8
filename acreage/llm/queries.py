"""The operators as queries, each over its whole table, with the digest columns that a check compares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from acreage.llm import chat, decontaminate, lm, packing, phrases, quality, ranking, rans, rules, secrets, simhash, toxicity, urls
from acreage.llm.common import remainder, table
from acreage.llm.oracles import ORACLES
from acreage.session import fresh_folder


# The rules on hosts and paths.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.without_held_out(table(spark, sf_dir, "labels")))
    scored = docs.select(
        "doc_id", (remainder(docs["doc_id"], 5) == 0).alias("held_out"), quality.score(docs, model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    written = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm.scores(docs, remainder(docs["doc_id"], 7) == 2)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.examples(chats.unionByName(extra))
    turns = chat.turns_of(F.col("text"))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = made.select(
        "conv_id",
        "loose",
        F.when(F.col("last"), F.struct(F.size(turns).alias("n"), F.sha2(said, 256).alias("sha"))).alias("whole"),
        F.struct("example", chat.trained_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("text")).alias("reply"),
        F.length("text").alias("chars"),
    )
    trained = F.array_join(F.transform(F.sort_array(F.collect_list("reply")), lambda r: r["text"]), "")
    return (
        read.groupBy("conv_id", "loose")
        .agg(F.max("whole").alias("whole"), trained.alias("trained"), F.sum("chars").alias("formatted_chars"))
        .select(
            "conv_id",
            F.col("whole.n").cast("bigint").alias("n_turns"),
            F.col("whole.sha").alias("turns_sha256"),
            F.length("trained").cast("bigint").alias("loss_chars"),
            F.sha2("trained", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).drop("ids")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    rans.write_tokens(table(spark, sf_dir, "documents"), folder)
    read = rans.read_tokens(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    judged = toxicity.judged(docs, toxicity.without_held_out(table(spark, sf_dir, "labels")))
    return judged.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


REGISTRY = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_decontaminate": op4_decontaminate,
    "op5_lm": op5_lm,
    "op6_chat": op6_chat,
    "op7_rules": op7_rules,
    "op8_packing": op8_packing,
    "op9_token_files": op9_token_files,
    "op10_urls": op10_urls,
    "op11_phrases": op11_phrases,
    "op12_ranking": op12_ranking,
    "op13_toxicity": op13_toxicity,
    "pipeline": corpus_pipeline.run,
}

__all__ = ["ORACLES", "REGISTRY"]
