"""The registered queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from idweave.llm import (
    chat_format,
    decontamination,
    forest,
    jaccard_join,
    linear,
    merkle,
    mixing,
    oracles,
    quality,
    substring_dedup,
    suffix_dedup,
    token_count,
    topk_search,
    toxicity,
    variants,
)

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
PLANTED_CHAT = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Wanted shares of tokens: good and clean, good and toxic, bad and clean, bad and toxic.
TARGETS = [0.94, 0.02, 0.035, 0.005]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score_quality(docs, quality_model(docs, sf_dir), quality.host_of(F.col("source")), quality.path_of(F.col("source"), F.col("lang")))
    return scored.select("doc_id", *quality.RESULT)


def quality_model(docs: DataFrame, sf_dir: str) -> quality.Model:
    labels = table(docs.sparkSession, sf_dir, "labels")
    return quality.fit(linear.labelled_sample(docs.select("doc_id", "text"), labels, F.col("quality")))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    labels = table(spark, sf_dir, "labels").where(~held_out)
    model = toxicity.fit(linear.labelled_sample(docs, labels, F.col("toxic")))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), jaccard_join.Join(n=3, percent=90))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def domain_posterior(docs: DataFrame, sf_dir: str) -> tuple[DataFrame, Column]:
    """``docs`` with two classifiers' evidence, and the posterior over the domains of ``TARGETS`` that it gives."""
    texts, labels = docs.select("doc_id", "text"), table(docs.sparkSession, sf_dir, "labels")
    toxic = toxicity.fit(linear.labelled_sample(texts, labels, F.col("toxic")))
    good = quality.posteriors(F.col("text"), quality_model(docs, sf_dir))
    seen = docs.select("*", good.alias("_good"), toxicity.score(F.col("text"), toxic).alias("_toxic"))
    t = F.col("_toxic")
    return seen, F.array(*[F.col("_good")[q] * x for q in (1, 0) for x in (1 - t, t)])


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen, posterior = domain_posterior(table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    return mixing.mixed(seen, posterior, TARGETS)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations, from their windows in order; a conversation may span batches."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = pa.schema([(n, pa.string() if "sha" in n else pa.int64()) for n in names])
    out: list[tuple] = []
    none = object()
    current, n, turns, loss, loss_chars, chars = none, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
    for batch in batches:
        for row in batch.to_pylist():
            if current is not none and current != row["conv_id"]:
                out.append((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                n, turns, loss, loss_chars, chars = 0, hashlib.sha256(), hashlib.sha256(), 0, 0
            current = row["conv_id"]
            chars += len(row["text"])
            for (role, body, start, end), turn in zip(chat_format.parse(row["text"]), row["turns"], strict=True):
                if not turn["repeated"]:
                    n += 1
                    turns.update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                if turn["loss"]:
                    text = chat_format.unescape(row["text"][turn["start"] : turn["end"]])
                    loss_chars += len(text)
                    loss.update(text.encode("utf-8", "surrogatepass"))
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)
            out = []
    if current is not none:
        out.append((current, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_CHAT).alias("text"),
    )
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    made = chat_format.windows(chats).select("conv_id", "window", "text", "turns")
    ordered = made.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(
        _read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    # No public unigram vocabulary is at hand, and none may be trained: the pieces and scores of this one serve as one.
    vocabulary = token_count.load_vocabulary(TOKENIZER, as_unigram=True)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_count.with_token_counts(docs, vocabulary).select("doc_id", "token_count.n_tokens", "token_count.score")


#: What a leaf of the manifest is the hash of, in this order.
MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = [F.translate("text", variants.UPPER, variants.LOWER) if c == "text" else F.col(c) for c in MANIFEST_FIELDS]
    rows = merkle.manifest(docs, MANIFEST_FIELDS, "lang", "doc_id", also={"tampered": F.when(changed, merkle.leaf_hash(lowered))})
    root = merkle.folded(F.coalesce("tampered", "leaf"), F.col("places"), F.col("siblings"))
    rows = rows.select(F.col("order").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"), root.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def planted_typos(words: DataFrame) -> DataFrame:
    """``words`` (``id, word``), with one character deleted from one in 199 (id, word)."""
    h = F.crc32(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("word")))
    at = (h % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return words.select(F.when(h % 199 == 0, cut).otherwise(F.col("word")).alias("word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = planted_typos(variants.words(table(spark, sf_dir, "documents"), least=6)).where(F.length("word") >= 6)
    return variants.spelling_groups(variants.counted(found, least=5), ratio=5)


def op13_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_quality": op2_quality,
        "op3_topk_search": op3_topk_search,
        "op4_toxicity": op4_toxicity,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_substring_dedup": op6_substring_dedup,
        "op7_chat_format": op7_chat_format,
        "op8_mixing": op8_mixing,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_token_count": op10_token_count,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_forest_search": op13_forest_search,
    }


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; the others are tested in ``tests/llm``."""
    return oracles.all_sql()
