"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over host and what follows it: ``||`` at its front stands for the start of the host or of any of its
labels, ``^`` for one character that is no ASCII letter or digit (or an end), ``*`` for any run without ``/``, ``?`` and
``#``; all else is literal.  A token is a longest run of ASCII letters and digits; a run in a pattern must stand in every
matching URL as a whole token when neither ``*`` nor an open end touches it.  The rule is filed under the one of these that
the fewest URLs hold.  The tokens of a URL fetch its candidate rules, and only they run their regular expressions; rules
without such a token are candidates of every URL.

Rows are numbered in a written table, so a hot URL or host is no key of any shuffle; a hot token meets the few rules
filed under it, with a broadcast only if Spark finds the index small enough.

Null URLs and those without ``://`` have an empty host and path, no rule and are allowed.  Repeated rows and null ids are
judged each by itself, very long URLs as a whole.  An empty table gives an empty result.  Other columns of the pages are not read."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.scratch import Scratch
from sluice.llm.texts import ascii_lower
from sluice.session import ship

#: Host and path prefix with a verdict; the longest one that fits decides.
PREFIXES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

#: Decide where no prefix fits: an ``allow`` that matches goes before a ``block``; without a match a URL is allowed.
PATTERNS = (
    *((p, "block") for p in (
        "||ads-*.", "||ads.", "||adserver.", "||doubleclick.", "||adult-", "||*-adult.", "||porn-", "||*-porn.", "||xxx.", "||casino-",
        "||*-casino.", "||poker-", "||*-poker.", "||free-bets.", "||*-bets.", "||cheap-pills.", "||*-pills.", "||viagra-", "||*-viagra.",
        "||spam-", "||*-spam.", "||link-farm.", "||*-farm.*/out/", "^sessionid=", "^phpsessid=", "/wp-login.php", "/cgi-bin/")),
    *((p, "allow") for p in ("||gov/", "||edu/", "||*^gamblers-anonymous^")),
)

_RULE = "rule string, regex string, verdict string, exact boolean, tokens array<string>"


def rule_regex(rule: str) -> str:
    """Regular expression of a rule, in the common part of the Java, RE2 and Python dialects."""
    kinds = {"*": "[^/?#]*", "^": "(?:[^0-9A-Za-z]|^|\\z)"}
    head = "^(?:[^/?#]*\\.)?" if rule.startswith("||") else ""
    return head + "".join(kinds.get(ch) or (ch if ch.isalnum() else "\\" + ch if ch.isascii() else ch) for ch in rule.removeprefix("||"))


def rule_tokens(rule: str) -> list[str]:
    """Lower-cased tokens that every match of the rule holds."""
    body = rule.removeprefix("||")
    opened = len(body) < len(rule)
    return sorted({m[0].lower() for m in re.finditer("[0-9A-Za-z]+", body)
                   if (opened if m.start() == 0 else body[m.start() - 1] != "*") and m.end() < len(body) and body[m.end()] != "*"})


def _compiled(frames: Iterable[pd.DataFrame]):
    for f in frames:
        exact = f["exact"].tolist()
        rules = [r if e else re.sub("[A-Z]", lambda m: m[0].lower(), r) for r, e in zip(f["rule"], exact)]
        yield pd.DataFrame({"rule": f["rule"], "regex": [rule_regex(r) for r in rules], "verdict": f["verdict"], "exact": exact,
                            "tokens": [rule_tokens(r) for r in rules]})


def compiled(rules: DataFrame) -> DataFrame:
    """Rules (rule, verdict, exact) with their regular expressions and tokens.  An ``exact`` rule is a prefix whose path
    keeps its case and which goes before all patterns; the others match the lower-cased URL."""
    ship(rules.sparkSession)
    return rules.where("rule IS NOT NULL AND rule NOT IN ('', '||')").mapInPandas(_compiled, _RULE)


def default_rules(spark: SparkSession) -> DataFrame:
    rows = [(f"||{p}", v, True) for p, v in PREFIXES] + [(p, v, False) for p, v in PATTERNS]
    return compiled(spark.createDataFrame(rows, "rule string, verdict string, exact boolean").coalesce(1))


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, everything from the host on with the host lower-cased); empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    host = ascii_lower(raw)
    return host, F.regexp_extract(after, "^[^?#]*", 0), F.concat(host, after)


def _tokens(address: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(address), "[^0-9a-z]+"))


def index(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(token, rule, regex, verdict, exact): each rule under the token that the fewest addresses hold, or under the empty
    token, which every address has."""
    filed = rules.select("rule", "regex", "verdict", "exact", F.explode_outer("tokens").alias("token"))
    wanted = filed.where("token IS NOT NULL").select("token").distinct()
    often = (addresses.select(F.explode(_tokens(F.col("address"))).alias("token")).join(wanted, "token")
             .groupBy("token").agg(F.count("*").alias("often")))
    return (filed.join(often, "token", "left").groupBy("rule", "regex", "verdict", "exact")
            .agg(F.coalesce(F.min_by("token", F.struct(F.coalesce("often", F.lit(0)), "token")), F.lit("")).alias("token")))


def judged(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, pattern, n_candidates) for every row: the prefix that decides, or else the pattern
    that does, and how many rules were tried."""
    spark = pages.sparkSession
    scratch = Scratch(spark, "url-filters")
    rules = scratch.keep(default_rules(spark) if rules is None else rules, "rules")
    host, path, address = parts(F.col("url").cast("string"))
    rows = scratch.keep(pages.select(F.monotonically_increasing_id().alias("rid"), "page_id", host.alias("host"), path.alias("path"), address.alias("address")), "rows")
    filed = scratch.keep(index(rows, rules), "index")
    tried = (rows.select("rid", "address", F.explode(F.array_union(_tokens(F.col("address")), F.array(F.lit("")))).alias("token")).join(filed, "token")
             .withColumn("fits", F.expr("CASE WHEN exact THEN address ELSE " + _lowered_sql("address") + " END RLIKE regex")))
    rank = F.when(F.col("exact"), 2).when(F.col("verdict") == "allow", 1).otherwise(0)
    best = (tried.groupBy("rid").agg(F.count("*").alias("n"), F.max(F.when(F.col("fits"), F.struct(
        rank.alias("rank"), F.length("rule").alias("length"), "rule", "verdict", "exact"))).alias("best")))
    return (rows.drop("address").join(best, "rid", "left").select(
        "page_id", "host", "path", F.when(F.col("best.exact"), F.expr("substring(best.rule, 3)")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), F.when(~F.col("best.exact"), F.col("best.rule")).alias("pattern"),
        F.coalesce("n", F.lit(0)).alias("n_candidates")))


def _lowered_sql(name: str) -> str:
    return f"translate({name}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def allowed(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """The rows of ``pages`` that are allowed, with their columns.  A verdict follows from the URL alone, so the blocked
    URLs, once each, are taken out by an anti-join; rows with many copies of a URL stay where they are or are split."""
    urls = pages.select("url", F.col("url").alias("page_id"))
    blocked = judged(urls, rules).where("verdict = 'block'").select(F.col("page_id").alias("blocked")).distinct()
    rows = pages.select(F.struct("*").alias("row"), F.col("url").alias("key"))
    return rows.join(blocked, F.col("key") == F.col("blocked"), "left_anti").select("row.*")
