"""One query for each operator, over whole tables with production parameters."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.llm import chat, decontam, licenses, lm, neardup, pieces, pii, quality, repair, runs, secrets, token_counts, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def joined(c: str) -> Column:
    return F.array_join(c, ",")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir)).select("doc_id", "counted.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.licence_labels(documents(spark, sf_dir))
    return found.withColumns({"base_labels": joined("base_labels"), "labels": joined("labels")})


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(documents(spark, sf_dir)).select("doc_id", "found.*")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir)).select("doc_id", "found.*")


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir)).select("doc_id", "encoded.*")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(joined("items"), 256).alias("items_sha256"), "contaminated",
    )


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(documents(spark, sf_dir), plant=True)
    listed = F.array_join(F.transform("runs", lambda x: F.concat_ws(",", x["start"], x["length"], x["period"])), "\n")
    ended = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "strongest.*",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(ended, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_conversations(table(spark, sf_dir, "conversations"), damage=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_quality_rules, op3_license_scans, op4_near_duplicates, op5_pii, op6_secret_scans,
        op7_lm_scores, op8_sentencepiece, op9_decontamination, op10_chat_format, op11_toxicity,
        op12_periodic_runs, op13_conversation_repair,
    )
}
