"""The registered queries of this subpackage: each applies one operator, with its production parameters, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, infill, langid, mixing, mtree, neardup, packing, pieces, pii, quality, token_counts, url_filter, vector_graph


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str, m: int):
    """crc32 of the id as text, mod m."""
    return F.crc32(F.col(key).cast("string")) % m


def op1_sentencepiece(spark, sf_dir):
    """Every text encoded and its ids decoded again: digests of both, and whether the text came back."""
    docs = _table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    encoded = pieces.encode_pieces(docs, carry=("text_crc32",))
    back = pieces.decode_pieces(encoded, carry=("n_tokens", "ids_crc32", "text_crc32"))
    return back.select("doc_id", "n_tokens", "ids_crc32", F.crc32("text").alias("decoded_crc32"), (F.crc32("text") == F.col("text_crc32")).alias("round_trip"))


def op2_url_filter(spark, sf_dir):
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark, url_filter.RULES))


def op3_vector_duplicates(spark, sf_dir):
    return vector_graph.vector_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_pii(spark, sf_dir):
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, c -> c.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


def op5_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn_languages(docs.filter(remainder("doc_id", 3) != 1))
    out = langid.predict_language(docs, model)
    return out.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op6_token_counts(spark, sf_dir):
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op7_packing(spark, sf_dir):
    return packing.pack(packing.token_pieces(_table(spark, sf_dir, "documents")))


def op8_top_k(spark, sf_dir):
    return mtree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_quality(spark, sf_dir):
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.learn_quality(docs, labels.filter(remainder("doc_id", 5) != 0))
    out = quality.score_quality(docs, model)
    return out.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op10_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_source_mix(spark, sf_dir):
    return mixing.Mix(_table(spark, sf_dir, "documents")).taken()


def op12_conversation_repair(spark, sf_dir):
    turns = _table(spark, sf_dir, "conversations")
    repair = conversations.Repair(conversations.damaged(turns))
    found = turns.select("conv_id").distinct().unionByName(repair.summary(), allowMissingColumns=True).unionByName(repair.digests(), allowMissingColumns=True)
    counts = [F.coalesce(F.max(c), F.lit(0).cast("long")).alias(c) for c in ("gaps", *conversations.COUNTS)]
    return found.groupBy("conv_id").agg(*counts, F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op13_fill_middle(spark, sf_dir):
    """Every text rearranged and rebuilt from its rearranged form: digests of both."""
    arranged = infill.fill_middle(_table(spark, sf_dir, "documents"))
    kept = ("n", "form", "prefix_chars", "middle_chars")
    back = infill.restore_text(arranged.withColumn("output_sha256", F.sha2("output", 256)), carry=(*kept, "output_sha256"))
    return back.select("doc_id", *kept, "output_sha256", F.sha2("text", 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_url_filter, op3_vector_duplicates, op4_pii, op5_language, op6_token_counts,
                                   op7_packing, op8_top_k, op9_quality, op10_near_duplicates, op11_source_mix,
                                   op12_conversation_repair, op13_fill_middle)}
