"""Each operator applied to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mailspark.llm import audit, brown, decontam, exact, langid, packing, phrases, quality, simhash, suffix, topk, urlfilter, warc
from mailspark.llm.common import table

#: Fixed values.
URL_RULES = (
    urlfilter.Rule("block", "net", "/"),
    urlfilter.Rule("allow", "example.net", "/en/"),
    urlfilter.Rule("block", "example.com", "/de/"),
    urlfilter.Rule("allow", "org", "/fr/"),
)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op4_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicate(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group(table(spark, sf_dir, "documents"), ["doc_id"])


def op7_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = exact.deduplicate(documents, exact.older_half(documents))
    return found.withColumnRenamed("digest", "text_sha256")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


def op9_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.evaluate(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontam.contamination(documents, items, ["doc_id"]).drop("spans")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors["vec_id"] % 50 == 0)


def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_urls": op3_urls,
    "op4_suffix": op4_suffix,
    "op5_language": op5_language,
    "op6_simhash": op6_simhash,
    "op7_exact": op7_exact,
    "op8_warc": op8_warc,
    "op9_brown": op9_brown,
    "op10_decontaminate": op10_decontaminate,
    "op11_phrases": op11_phrases,
    "op12_topk": op12_topk,
    "op13_filters": op13_filters,
}
