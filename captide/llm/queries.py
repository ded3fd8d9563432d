"""The registered queries of the operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from captide.llm import conversation_repair, decontaminate, hard_negatives, html_extract, line_dedup, ngram_join, oracles, packing, quality, substring_dedup, suffix_dedup, token_counts, token_store, url_filter
from captide.llm.common import query_registry, table
from captide.session import shared_folder

QUERIES, query = query_registry()
ORACLES = {"op1_quality_rules": oracles.QUALITY_SQL}

TOKEN_LIMIT = 512


@query
def op2_token_counts(spark, sf_dir):
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op3_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op9_token_store(spark, sf_dir):
    folder = shared_folder(spark, "tokens")
    manifest = token_store.write_tokens(
        table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    stored = token_store.read_tokens(spark, folder, manifest)
    n_tokens = (F.octet_length("ids") / 4).cast("bigint")
    return stored.select("doc_id", "start", n_tokens.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op1_quality_rules(spark, sf_dir):
    judged = quality.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *(f"quality.{c}" for c in counts))


# The site rules of the contract, and patterns for the rest: advertising, gambling, pills and link farms.
SITE_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
PATTERN_RULES = [
    ("block", rf"(?:^|[./_-]){word}(?:$|[./_-])", [word])
    for word in ("ads", "adserver", "bets", "betting", "casino", "doubleclick", "pills", "poker", "porn", "spam", "viagra", "xxx")
]


@query
def op5_url_filter(spark, sf_dir):
    rules = [url_filter.site_rule(*rule) for rule in SITE_RULES] + [url_filter.pattern_rule(*rule) for rule in PATTERN_RULES]
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules), carry=["page_id"])
    return judged.select("page_id", *(f"judged.{c}" for c in ("host", "path", "rule", "verdict")))


ORACLES["op5_url_filter"] = oracles.url_sql(SITE_RULES, PATTERN_RULES)


@query
def op7_ngram_join(spark, sf_dir):
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark, sf_dir):
    cut = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), every_line=True)
    return cut.select("doc_id", "text", F.col("lines.total").alias("n_lines"), F.col("lines.removed").alias("n_removed"))


@query
def op10_html_text(spark, sf_dir):
    texts = html_extract.extract_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query
def op6_decontaminate(spark, sf_dir):
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_suffix_dedup(spark, sf_dir):
    rows = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = (F.col("n_bytes") - F.octet_length("kept")).cast("bigint")
    return rows.select(
        "doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


@query
def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


ORACLES["op12_hard_negatives"] = oracles.NEGATIVES_SQL


@query
def op13_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


ORACLES["op13_substring_dedup"] = oracles.SUBSTRING_SQL
