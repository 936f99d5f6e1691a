"""URL filters: pattern rules found by their rarest literal token.

A pattern is literal text with ``*`` for any run of characters, matched anywhere in the URL from its
scheme's end on; ``^`` is a separator (any character but letters, digits, ``_ - . %``, or an end). The
literal tokens of a pattern are its runs of letters and digits that a URL can only contain as whole
tokens: bounded on each side by literal other characters, a separator or the pattern's end marks ``|``.
Rules are indexed by the one of these tokens that the fewest URLs hold; only URLs that hold it run the
rule's regular expression. Patterns without such a token are tried on every URL.

The rule table is configuration: the driver reads the few rules that have no token. All work is on distinct URLs, and only those with a candidate rule are shuffled for the verdict. Each rule
table is joined without a hint; Spark broadcasts it if its size allows.

Null and empty URLs match no rule. Repeated URLs have the same result. Any allow rule beats block rules.
An empty rule table or URL table gives an empty result of the same columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm.common import column, unpacked, whole_row

#: Default rules: feed and tracking parameters are blocked, front matter of documentation is allowed.
DEFAULT_RULES = (
    ("utm_source=feed", "block"),
    ("^ref=x", "block"),
    ("|http://m.", "block"),
    ("://blog.*.example.org/", "block"),
    ("?page=2^", "block"),
    (".html|", "allow"),
    ("#top|", "allow"),
)

_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\A|\z)"


def regular(pattern: str) -> str:
    """The regular expression of a pattern, to be searched for in a lower-case URL."""
    body = pattern.lower()
    start = end = ""
    if body.startswith("|"):
        start, body = r"\A", body[1:]
    if body.endswith("|"):
        end, body = r"\z", body[:-1]
    made = "".join(".*" if c == "*" else _SEPARATOR if c == "^" else re.escape(c) for c in body)
    return start + made + end


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every URL with the pattern holds as whole tokens."""
    marked = pattern.lower().replace("|", "\x00")
    found = []
    for hit in re.finditer(r"[a-z0-9]+", marked):
        before = marked[hit.start() - 1] if hit.start() else "*"
        after = marked[hit.end()] if hit.end() < len(marked) else "*"
        if before != "*" and after != "*":
            found.append(hit.group())
    return list(dict.fromkeys(found))


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """(rule_id, pattern, action, regex, tokens) of (pattern, action) pairs."""
    names = ("rule_id", "pattern", "action", "regex", "tokens")
    rows = [
        F.struct(
            *(F.lit(v).alias(n) for n, v in zip(names, (i, pattern, action, regular(pattern)), strict=False)),
            F.array(*map(F.lit, literal_tokens(pattern))).cast("array<string>").alias("tokens"),
        )
        for i, (pattern, action) in enumerate(rules)
    ]
    kind = "array<struct<rule_id:int,pattern:string,action:string,regex:string,tokens:array<string>>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda t: t != ""))


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, n_block, n_allow) of the distinct URLs that some rule matches."""
    distinct = urls.filter(F.col(url).isNotNull()).select(F.col(url).alias("_url")).distinct()
    tokens = distinct.select("_url", F.explode(url_tokens(F.col("_url"))).alias("_token"))
    wanted = rules.select("rule_id", F.explode("tokens").alias("_token"))
    # How many URLs hold each token that a rule has: one row per such token at most.
    frequency = tokens.join(wanted.select("_token").distinct(), "_token").groupBy("_token").agg(
        F.count(F.lit(1)).alias("_urls")
    )
    rarest = (
        wanted.join(frequency, "_token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("_urls", F.lit(0)).alias("_urls"), "_token")).alias("_best"))
        .select("rule_id", F.col("_best._token").alias("_token"))
    )
    index = rules.join(rarest, "rule_id", "left").select("rule_id", "action", "regex", "_token")
    candidates = tokens.join(index.filter(F.col("_token").isNotNull()), "_token")
    # A pattern without a whole token is a candidate for every URL; such rules are given as expressions.
    matched = candidates.filter(F.expr("lower(_url) RLIKE regex")).select("_url", "rule_id", "action")
    loose = [(r["regex"], r["action"], r["rule_id"]) for r in rules.filter(F.size("tokens") == 0).collect()]
    for regex, action, rule_id in loose:
        hit = distinct.filter(F.lower("_url").rlike(regex))
        matched = matched.union(hit.select("_url", F.lit(rule_id).alias("rule_id"), F.lit(action).alias("action")))
    return matched.groupBy("_url").agg(
        F.count_if(F.col("action") == "block").alias("n_block"), F.count_if(F.col("action") == "allow").alias("n_allow")
    ).withColumnRenamed("_url", url)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def site_rule(host: Column, path: Column, rules) -> Column:
    """The longest fitting (action, 'host/path') rule as a struct (rule, action), or null."""
    chosen = None
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("action"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    return chosen


def judge(pages: DataFrame, site_rules, pattern_rules, url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to the pages, replacing columns of these names.

    A fitting site rule decides; else the pattern rules do: block if some block rule and no allow rule matches.
    """
    host, path = host_and_path(F.col("_url"))
    rows = pages.select(whole_row(pages, ("host", "path", "rule", "verdict")), column(url).alias("_url"))
    hits = match_rules(rows, rule_table(pages.sparkSession, pattern_rules), "_url")
    blocked = hits.filter((F.col("n_block") > 0) & (F.col("n_allow") == 0)).select(F.col("_url").alias("_hit"))
    joined = rows.join(blocked, F.col("_url") == F.col("_hit"), "left").withColumns({"_host": host, "_path": path})
    joined = joined.withColumn("_site", site_rule(F.col("_host"), F.col("_path"), site_rules))
    other = F.when(F.col("_hit").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select(
        *unpacked(joined),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_site.rule").alias("rule"),
        F.coalesce(F.col("_site.action"), other).alias("verdict"),
    )
