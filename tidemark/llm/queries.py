"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, decontaminate, licenses, linededup, mixing, neardup, quality, tokenalign
from tidemark.llm import topk, toxicity, urls, whitening
from tidemark.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held = toxicity.held_out(F.col("doc_id")).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", held, "score", "predicted")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), carry=False)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    held = quality.held_out(F.col("doc_id")).alias("held_out")
    return quality.score(docs, model).select("doc_id", held, "score", "predicted")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages).drop("url")


def vocabulary() -> tuple[bytes, str]:
    """Ranks and pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the encoded and decoded texts."""
    ranks, pattern = vocabulary()
    return bpe.encode(docs.select("doc_id", "text"), ranks, pattern, decoded=True).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(topk.usable(F.col("embedding")))
    vectors = rows.select("vec_id", topk.whole_components(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.as_vectors(table(spark, sf_dir, "embeddings"))
    index = ann.build_index(vectors, 10)
    return ann.search_index(index, vectors.where(F.col("vec_id") % 100 == 0).distinct(), 10)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.encode(F.coalesce("text", F.lit("")), "utf-8"), 256)
    return linededup.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def vocabularies() -> tokenalign.Vocabularies:
    """The two public vocabularies that are aligned."""
    import public_tokenizers

    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return tokenalign.Vocabularies.read(*paths)


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = tokenalign.align(docs, vocabularies())
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    counted = tokenalign.count_links(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return counted.select("row.doc_id", *tokenalign.COUNTS, "n_best", "count_sum", "groups_sha256")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whitening.whole_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return whitening.whiten(vectors)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    names = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_license_scan,
        op3_mixing,
        op4_quality,
        op5_near_dedup,
        op6_url_filter,
        op7_bpe,
        op8_top_k,
        op9_ann,
        op10_line_dedup,
        op11_token_align,
        op12_whitening,
        op13_decontaminate,
    )
}
