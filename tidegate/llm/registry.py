"""Queries over the test tables and the SQL that must agree with them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import alignment
from .common import table, text_of
from .exact_dedup import exact_dedup
from .html import extract
from .langid import identify
from .line_dedup import line_dedup
from .outliers import quality_rules
from .packing import pack
from .quality import classify
from .search import search
from .sharding import shard
from .simhash import near_dedup
from .substring_dedup import substring_dedup
from .transducer import encode


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup(table(spark, sf, "documents"))


def op3_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    scored = classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(table(spark, sf, "documents"))


def op5_html(spark: SparkSession, sf: str) -> DataFrame:
    return extract(table(spark, sf, "pages"))


def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    coded = encode(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_ids", "ids_crc32", "n_byte_ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shard(table(spark, sf, "documents"))


def op8_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    left = substring_dedup(table(spark, sf, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules(table(spark, sf, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = line_dedup(table(spark, sf, "documents").select("doc_id", "text"))
    digest = F.sha2(text_of("text").cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_removed", "n_near", "n_links", digest.alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identify(table(spark, sf, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op13_tokenizer_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_html": op5_html,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_sharding": op7_sharding,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_line_dedup": op10_line_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_language_id": op12_language_id,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLES = {
    "op4_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents""",
    "op11_ranked_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        asked AS (
            SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY 1),
        corpus AS (SELECT count(*) AS docs, cast(sum(n) AS BIGINT) AS total FROM sizes),
        bags AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY 1, 2),
        weights AS (SELECT term, cast(floor(1000 * ln((2.0 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM bags, corpus GROUP BY 1),
        scored AS (
            SELECT item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
            FROM (SELECT item_id, term, count(*) AS times FROM asked GROUP BY 1, 2) JOIN bags USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
            GROUP BY 1, 2 HAVING score > 0)
        SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
        FROM scored QUALIFY rank <= 10""",
}
