"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemart.llm import (centroids, chat, chosenpath, decontaminate, jaccard, licences, lines, packing, quality, repeats, resampling,
                          spotsigs, tokens)
from tidemart.llm.common import table

_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    _REGISTRY[fn.__name__] = fn
    return fn


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


@query
def op1_pack_mixture(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "source")


@query
def op2_spot_signatures(spark, sf_dir):
    found = spotsigs.compared_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.as_text(F.col("signatures")).alias("fingerprint"),
        spotsigs.as_text(F.col("edited_signatures")).alias("edited_fingerprint"), "near_edited", "near_next")


@query
def op3_quality_classifier(spark, sf_dir):
    """The documents that the classifier keeps, with their posteriors."""
    found = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.filter("not rejected").drop("rejected")


@query
def op4_licence_scan(spark, sf_dir):
    return licences.scan_licences(table(spark, sf_dir, "documents"), licences.known_licences(spark))


@query
def op5_decontaminate(spark, sf_dir):
    pairs = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.select("doc_id", "item_id", "item_words", "covered", "coverage", F.size("tiles").alias("n_tiles"))


@query
def op6_repeated_bytes(spark, sf_dir):
    left = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = lines.drop_repeated_chunks(docs)
    return left.select("doc_id", "n_lines", "n_chunks", "n_removed_lines",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op8_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


@query
def op9_jaccard_join(spark, sf_dir):
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


CHECK_TURN = "</s>[INST] ok [/INST]"


@query
def op10_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", CHECK_TURN), (-1, 1, "assistant", CHECK_TURN)], rows.schema)
    back = chat.read_back(chat.format_chats(rows.unionByName(probe)))
    turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


@query
def op11_centroid_clusters(spark, sf_dir):
    found = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2(centroids.written(F.col("centroid")), 256)).drop("centroid")


@query
def op12_importance_resampling(spark, sf_dir):
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_minhash_near_duplicates(spark, sf_dir):
    return chosenpath.near_duplicates(table(spark, sf_dir, "documents"))
