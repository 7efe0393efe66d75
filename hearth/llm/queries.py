"""The registered query of each training-data operator, and its SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import read_table
from hearth.llm.conversations import report
from hearth.llm.decontaminate import decontaminate
from hearth.llm.html import extract
from hearth.llm.lm import score as lm_score
from hearth.llm.merkle import fold, leaf_of, manifest, siblings
from hearth.llm.mixing import mix
from hearth.llm.packing import pack
from hearth.llm.pii import KINDS, personal_data
from hearth.llm.quality import judge
from hearth.llm.sharding import shard
from hearth.llm.simhash import near_duplicates
from hearth.llm.toxicity import remainder
from hearth.llm.toxicity import score as toxicity_score
from hearth.llm.urls import filter_urls, seed_labels, split_url

#: the query's site rules
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
#: host words whose URLs seed the rejected model; all other URLs seed the accepted one
URL_TERMS = ["ad", "ads", "adult", "bet", "bets", "betting", "casino", "gambling", "lottery", "loan", "loans", "pills", "poker", "porn", "sex", "slots", "spam",
             "track", "tracker", "tracking", "viagra", "xxx"]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.sort_array(F.transform("item_ids", lambda x: x.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), max_bits=4, shingle=4)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    labelled = pages.select("url", seed_labels(split_url(F.col("url"))[0], URL_TERMS).alias("accepted"))
    found = filter_urls(pages, labelled, URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", F.round("score", 6).alias("score"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(read_table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept", F.array_join("failed", ",").alias("rules"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(read_table(spark, sf_dir, "documents"), shards=24)
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), "source", "fraction")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 3) != 1)
    found = toxicity_score(read_table(spark, sf_dir, "documents"), labels.select("doc_id", "toxic"))
    return found.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 3) == 1).alias("held_out"), "score",
                        (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read_table(spark, sf_dir, "documents"))
    kinds = F.col("base.kind")
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = lm_score(docs, docs.filter(remainder(F.col("doc_id"), 5) != 1))
    return found.select(F.col("id").alias("doc_id"), (remainder(F.col("id"), 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), length=2048, end_id=1).withColumnRenamed("id", "doc_id")


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix(read_table(spark, sf_dir, "documents"), shards=64, block=128).taken()
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that the contract of op12 names; ``present`` is false for dropped ones."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    return conversations.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), text.alias("text"),
                                (fault != 0).alias("present"), F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1)))).drop("col")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(read_table(spark, sf_dir, "conversations"))
    return report(rows, F.col("present")).withColumnRenamed("conv", "conv_id")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claim = F.when(tampered, leaf_of([F.col(f) + F.lit(1) if f == "n_chars" else F.col(f) for f in fields]))
    found = manifest(docs, fields, claim=claim)
    folded = fold(F.coalesce("claim", "leaf"), F.col("path"))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                        folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_simhash": op2_simhash,
    "op3_urls": op3_urls,
    "op4_html": op4_html,
    "op5_quality": op5_quality,
    "op6_sharding": op6_sharding,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_lm": op9_lm,
    "op10_packing": op10_packing,
    "op11_mixing": op11_mixing,
    "op12_conversations": op12_conversations,
    "op13_merkle": op13_merkle,
    "pipeline": pipeline,
}

_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_SQL_WORDS} AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(list_slice(w, s, s + least(10, len(w)) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (
  SELECT doc_id, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item_id FROM places JOIN grams USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}
