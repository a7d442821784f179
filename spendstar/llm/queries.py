"""Registered queries of the numbered operators: thin, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, balltree, langid, linecrf, lines, minhash, mixing, packing, pieces, search, sharding, suffixes, toxicity
from .common import documents, shared_folder

SHARDS = 40


def op1_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


def tokenizer_path() -> str:
    """The word tokenizer of the installed public vocabularies."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op2_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path())


def op3_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.with_copies(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_shared_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op5_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(
        "doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    folder = shared_folder(spark, "slot-map")
    sizes = sharding.slot_sizes(docs.withColumn("vslot", sharding.slot_of(F.col("doc_id"))), "vslot", "size")
    now = sharding.store_map(sharding.first_map(spark, SHARDS), sizes, folder, 1)
    grown = sharding.store_map(sharding.grow_map(now.select("vslot", "shard", "version"), SHARDS),
                               now.select("vslot", "rows", "bytes"), folder, 2)
    out = sharding.assign(docs, now, grown=grown)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "vslot")


def op6_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = linecrf.judge(docs, linecrf.train(docs, labels))
    return out.drop("text")


def op7_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return balltree.top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op8_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = docs.withColumn("held_out", toxicity.fold(F.col("doc_id"), 5) == 0)
    model = langid.train(out.filter(~F.col("held_out")))
    return langid.predict(out.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


def op9_sparse_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


def op10_nb_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(toxicity.fold(F.col("doc_id"), 4) != 2)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


def piece_model_path() -> str:
    """The piece model of the installed public vocabularies."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op11_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.encode(documents(spark, sf_dir).select("doc_id", "text"), piece_model_path(), decoded_col="decoded")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return search.ranked(documents(spark, sf_dir).select("doc_id", "text"), items)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.col("lang").alias("part"), *audit.text_key(text),
                       audit.failure_mask(audit.text_conditions(text)).alias("mask"))
    counted = audit.later_copies(audit.with_labels(read, labels), "doc_id", ["part", "mask", "good", "toxic"])
    mask = F.col("mask").bitwiseOR(F.when(F.col("copy"), F.lit(16)).otherwise(F.lit(0)))
    cells = audit.cells(counted, mask, F.col("part"), F.col("n"), good_lost=F.col("n") * F.col("good").cast("int"),
                        toxic_lost=F.col("n") * F.col("toxic").cast("int"))
    return audit.audit(cells, "ABCDE", ["good_lost", "toxic_lost"])


QUERIES = {
    "op1_hyperminhash": op1_hyperminhash,
    "op2_bm25_packing": op2_bm25_packing,
    "op3_systematic_mix": op3_systematic_mix,
    "op4_line_dedup": op4_line_dedup,
    "op5_virtual_slots": op5_virtual_slots,
    "op6_line_crf": op6_line_crf,
    "op7_ball_tree": op7_ball_tree,
    "op8_byte_gru": op8_byte_gru,
    "op9_sparse_suffixes": op9_sparse_suffixes,
    "op10_nb_ngrams": op10_nb_ngrams,
    "op11_piece_encoding": op11_piece_encoding,
    "op12_block_max_search": op12_block_max_search,
    "op13_filter_audit": op13_filter_audit,
}
