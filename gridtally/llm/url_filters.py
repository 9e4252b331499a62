"""URL filters: rules indexed by their rarest literal token.

A rule names literal tokens that every URL it matches must hold.  The rules are
indexed by the one of these that is rarest in the given URLs; a URL's tokens
fetch the rules filed under them, and only those run their regular expression.
Built-in functions only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: The rules are a list held by the driver, so that this bounds what is broadcast.
MAX_RULES = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``regex`` is searched in host and path (``kind`` prefix) or in the whole URL, ASCII lower-cased (pattern).

    ``literals`` are runs of [a-z0-9_] that stand whole in every URL the rule matches.  A rule without any is tried
    on every URL.
    """

    name: str
    verdict: str
    regex: str
    literals: tuple[str, ...]
    kind: str = "pattern"


def prefix_rule(verdict: str, rule: str) -> Rule:
    """Rule of a host with its subdomains and a path prefix, such as ``example.org/en/``."""
    host, slash, path = rule.partition("/")
    regex = "^([^/?#]*[.])?" + re.escape(host) + re.escape(slash + path)
    whole = re.findall("[a-z0-9_]+(?=[^a-z0-9_])", host + slash + path)  # the last run may go on in a URL
    return Rule(rule, verdict, regex, tuple(dict.fromkeys(whole)), "prefix")


#: The host and path rules of the query.
SITE_RULES = tuple(prefix_rule(v, r) for v, r in (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/")))

#: Pages that are seldom prose.  They decide where no host and path rule fits.
PATTERN_RULES = (
    Rule("login", "block", "/login(/|[?]|$)", ("login",)),
    Rule("signin", "block", "/signin(/|[?]|$)", ("signin",)),
    Rule("cart", "block", "/cart(/|[?]|$)", ("cart",)),
    Rule("admin", "block", "/wp_admin(/|[?]|$)", ("wp_admin",)),
    Rule("casino", "block", "://([^/?#]*[.-])?casino[.-]", ("casino",)),
    Rule("adult", "block", "://([^/?#]*[.-])?porn[.-]", ("porn",)),
    Rule("archive", "block", "[.]zip([?#]|$)", ("zip",)),
    Rule("program", "block", "[.]exe([?#]|$)", ("exe",)),
    Rule("print", "block", "[?&]print=1(&|#|$)", ("print",)),
)


def host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``; both empty for a null URL or one without ``://``."""
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url), F.lit(""))
    return pages.withColumns({
        "host": F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER),
        "path": F.regexp_extract(text, parts, 2),
    })


def _tokens(url):
    return F.array_distinct(F.regexp_extract_all(F.translate(url, UPPER, LOWER), F.lit("[a-z0-9_]+"), F.lit(0)))


def rarest_literals(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> dict[str, int]:
    """Token of any rule -> number of URLs that hold it; as many rows as the rules have tokens."""
    spark = pages.sparkSession
    wanted = sorted({t for r in rules for t in r.literals})
    names = spark.createDataFrame([(t,) for t in wanted], StructType([StructField("token", StringType())]))
    found = pages.select(F.explode(_tokens(F.col(url))).alias("token")).join(F.broadcast(names), "token")
    counts = {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {t: counts.get(t, 0) for t in wanted}


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = SITE_RULES + PATTERN_RULES, url: str = "url",
               default: str = "allow") -> DataFrame:
    """The input rows with ``host``, ``path``, ``rule``, ``pattern`` and ``verdict``.

    ``rule`` is the longest host and path rule that fits (ties: the least name), ``pattern`` the first pattern
    rule by name that fits; ``verdict`` is that of the rule, else of the pattern, else ``default``.

    Null and odd URLs have empty host and path and get the default unless a pattern fits.  Repeated rows are judged
    one by one and all kept; an empty table gives an empty result.  Columns of the input named like a result are
    replaced, other columns are kept.  The input is read twice: once for the counts of the rules' tokens.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES}")
    spark = pages.sparkSession
    counts = rarest_literals(pages, rules, url)
    rows = [(min(r.literals, key=lambda t: (counts[t], t), default=""), r.kind, r.name, r.verdict, r.regex,
             -len(r.name) if r.kind == "prefix" else 0) for r in rules]
    index = spark.createDataFrame(rows, StructType([StructField(n, StringType()) for n in (
        "_token", "_kind", "_name", "_verdict", "_regex")] + [StructField("_rank", IntegerType())]))
    kept = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "pattern", "verdict")]
    # The input stands in one column, so that its names meet none of the others.
    base = host_and_path(pages.select(F.struct(*kept).alias("_in"), F.col(url).alias("_url")), "_url")
    lower = F.translate(F.coalesce(F.col("_url"), F.lit("")), UPPER, LOWER)
    tried = (
        base.withColumns({"_row": F.monotonically_increasing_id(), "_lower": lower})
        .withColumn("_token", F.explode(F.array_append(_tokens(F.col("_lower")), F.lit(""))))
        .join(F.broadcast(index), "_token", "left")
    )
    subject = F.when(F.col("_kind") == "prefix", F.concat("host", "path")).otherwise(F.col("_lower"))
    fits = F.coalesce(F.regexp_like(subject, F.col("_regex")), F.lit(False))
    best = lambda kind: F.min(F.when(fits & (F.col("_kind") == kind), F.struct("_rank", "_name", "_verdict")))
    out = tried.groupBy("_row").agg(
        *[F.any_value(F.col(c)).alias(c) for c in ("_in", "host", "path")],
        best("prefix").alias("_prefix"), best("pattern").alias("_pattern"))
    return out.select(
        "_in.*", "host", "path", F.col("_prefix._name").alias("rule"), F.col("_pattern._name").alias("pattern"),
        F.coalesce("_prefix._verdict", "_pattern._verdict", F.lit(default)).alias("verdict"))
