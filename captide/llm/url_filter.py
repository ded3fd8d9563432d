"""URL filters: pattern rules indexed by their rarest literal token.

A URL is cut into its host and path, and into tokens (runs of letters and digits, ASCII lower case). A rule is a
regular expression over ``host + path`` with literal tokens that every fitting URL must hold. Each rule is filed
under the one of its tokens that the fewest URLs of the table hold, counted over the whole table. The tokens of
a URL fetch the rules filed under them, and only those expressions are run.

The rules are joined, so a table of any number of rules works; Spark broadcasts the index where it is small.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from captide.llm.common import staged

RULE_SCHEMA = "rule string, verdict string, pattern string, tokens array<string>, named boolean, weight int"
TOKEN = r"[a-z0-9]+"


def site_rule(verdict: str, site: str) -> Row:
    """A rule ``host/path``: fits the host and its subdomains, and paths that start with its path."""
    host, _, path = site.partition("/")
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}"
    # The path's last token may go on in the URL, so only its closed tokens are literals.
    tokens = re.findall(TOKEN, host) + re.findall(rf"{TOKEN}(?=[^a-z0-9])", path.lower())
    return Row(rule=site, verdict=verdict, pattern=pattern, tokens=tokens, named=True, weight=len(site))


def pattern_rule(verdict: str, pattern: str, tokens: list[str]) -> Row:
    """A regular expression over ``host + path``; ``tokens`` stand in every URL that it fits."""
    return Row(rule=pattern, verdict=verdict, pattern=pattern, tokens=tokens, named=False, weight=0)


def rule_table(spark: SparkSession, rules: list[Row]) -> DataFrame:
    return spark.createDataFrame([tuple(rule[c.split()[0]] for c in RULE_SCHEMA.split(", ")) for rule in rules], RULE_SCHEMA)


def located(pages: DataFrame, url_column: str = "url") -> DataFrame:
    """``url, host, path`` of every distinct URL; both parts are empty without ``://``."""
    urls = pages.select(F.col(url_column).cast("string").alias("url")).distinct()
    after = F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return urls.select("url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def tokens_of(host_path) -> F.Column:
    lower = F.translate(host_path, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.filter(F.split(lower, "[^a-z0-9]+"), lambda token: token != ""))


def rule_index(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``token`` and the rule filed under it: its literal that fewest URLs hold, or the first of equals.

    ``urls`` needs the array ``tokens``. Rules without a literal are filed under the empty token, which every URL
    asks for.
    """
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    counts = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    filed = rules.select("*", F.explode_outer("tokens").alias("token")).join(counts, "token", "left")
    rarest = F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")
    kept = [c for c in rules.columns if c != "tokens"]
    return filed.groupBy(*kept).agg(rarest).withColumn("token", F.coalesce("token", F.lit("")))


def judge_urls(pages: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``pages`` (all by default) and a struct ``judged``: ``host, path, rule, verdict, pattern``.

    Named rules come first, the longest one wins; ``rule`` is its name. Without one, a fitting pattern rule decides
    (block before allow), and without any the ``default`` verdict. A null URL, and one without ``://``, has an empty host and
    path and gets the default unless a rule without tokens fits. Rows with equal URLs are judged once and alike; an
    empty table stays empty; a column ``judged`` of the input is replaced.
    """
    columns = [c for c in (carry or pages.columns) if c != "judged"]
    urls = staged(located(pages, url_column).withColumn("tokens", tokens_of(F.concat("host", "path"))), "urls")
    index = staged(rule_index(urls, rules), "url-rules")
    asked = urls.select("url", "host", "path", F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token"))
    fits = asked.join(index, "token").where("regexp_like(concat(host, path), pattern)")
    rank = F.struct("named", "weight", (F.col("verdict") == "block").alias("block"), "rule")
    best = fits.groupBy(F.col("url").alias("fit_url")).agg(F.max_by(F.struct("rule", "verdict", "named"), rank).alias("best"))
    decided = urls.join(best, urls.url.eqNullSafe(best.fit_url), "left").select(
        F.col("url").alias("judged_url"),
        F.struct(
            "host",
            "path",
            F.when(F.col("best.named"), F.col("best.rule")).alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
            F.when(~F.col("best.named"), F.col("best.rule")).alias("pattern"),
        ).alias("judged"),
    )
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col(url_column).cast("string").alias("row_url"))
    return rows.join(decided, rows.row_url.eqNullSafe(decided.judged_url)).select("row.*", "judged")
