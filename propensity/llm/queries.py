"""Registered queries of the corpus operators, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as P
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm.common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm import quality_classifier as Q
    docs = table(spark, sf_dir, "documents")
    return Q.score(docs, Q.train(docs, table(spark, sf_dir, "labels")))


def op4_simhash_gray(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.simhash_gray import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's path is its source, language and number."""
    from propensity.llm.license_scan import license_scan
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return license_scan(table(spark, sf_dir, "documents"), path, "doc_id")


def op8_pii_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.pii_boost import personal_data
    return personal_data(table(spark, sf_dir, "documents"))


def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.line_rules import line_rules
    return line_rules(table(spark, sf_dir, "documents"))


def op2_cws_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.cws_fingerprint import fingerprints
    return fingerprints(table(spark, sf_dir, "documents"))


def op3_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.word_bpe import encode_decode
    return encode_decode(table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"))


def op5_piece_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.piece_count import token_counts
    return token_counts(table(spark, sf_dir, "documents"), P.path("piece_bpe_32k.model"))


def op6_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.repair_tokens import read_store, write_store
    return read_store(write_store(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json")))


def op10_bestfit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.bestfit_pack import pack
    return pack(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.lexical_search import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Every score of every document that shares a term with an item.
OP11_SQL = """
WITH words AS (
    SELECT rowid_ AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)),
tf AS (SELECT d, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM words GROUP BY d, term),
lengths AS (SELECT d, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY d),
totals AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM lengths),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, totals GROUP BY term),
asked AS (SELECT q, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS q, item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
    GROUP BY q, item_id, term),
scored AS (
    SELECT q, any_value(item_id) AS item_id, d, any_value(doc_id) AS doc_id,
           CAST(sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
    FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN lengths USING (d), totals GROUP BY q, d),
places AS (SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM places WHERE rank <= 20"""


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.site_style_tree import extract
    return extract(table(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from propensity.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_classifier, op2_cws_fingerprint, op3_word_bpe, op4_simhash_gray, op5_piece_count,
                               op6_repair_tokens, op7_license_scan, op8_pii_boost, op9_line_rules, op10_bestfit_pack, op11_lexical_search,
                               op12_html_extraction, op13_whitening)}

ORACLES: dict[str, str] = {"op11_lexical_search": OP11_SQL}
