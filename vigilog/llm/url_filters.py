"""URL filters: host rules, then pattern rules found through their rarest literal token.

Host rules are few and compiled into one CASE, longest first. Of pattern rules there may be
many. Each is filed under that one of its literal tokens that the URLs hold least often;
the tokens of a URL fetch the rules filed under them, and only those run their regular
expression. A rule without a whole literal token is filed under the empty token, which
every URL has. The rules are a table of any length, compiled, filed and matched by DataFrame
operations; they reach no driver.

Pattern syntax: ``||`` the start of the host or of one of its labels, ``|`` the start or
end of the URL, ``*`` anything, ``^`` a separator or the end, all else literal, in any
case; ``@@`` in front makes an exception, which outweighs all blocks.

Defined cases: a null URL or one without ``://`` has an empty host and path; a null URL
meets no rule and is allowed; of rules of one length the first in text order wins;
repeated rows are judged one by one; columns named like a result are replaced, others pass
through; an empty table stays empty, an empty rule list allows all.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigilog.llm.common import ascii_lower, clash_free, light
from vigilog.session import materialize


class HostRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The host rules of the contract.
HOST_RULES = (
    HostRule("allow", "org", "/"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)

# Patterns of hosts and paths that carry no text worth keeping.
PATTERNS = (
    "||casino-win.",
    "||free-bets.",
    "||ads-track.",
    "||spam-farm.",
    "||cheap-pills.",
    "||adult-x.",
    "||casino.",
    "||porn.",
    "||xxx.",
    "||doubleclick.",
    "-casino.",
    "/casino/",
    "/adserver/",
    "/login^",
    "/signin^",
    "/cart^",
    "/checkout^",
    "/wp-admin/",
    "/cgi-bin/",
    ".exe|",
    ".zip|",
    "?sessionid=",
    "&sessionid=",
    "*viagra*",
    "@@||docs.*.example.org^",
)

_SEPARATOR = r"(?:[^a-z0-9_.%-]|$)"
_HOST_START = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?"


def compile_patterns(rules: DataFrame) -> DataFrame:
    """(number, pattern, verdict, regex, tokens) of rules (number, pattern).

    ``tokens`` are those literal runs of letters and digits that are whole in any URL that
    fits: neither a ``*`` nor an open end of the pattern is beside them. Open ends are
    marked by a ``*`` while tokens are looked for.
    """
    text = F.lower(F.regexp_replace("pattern", "^@@", ""))
    parts = rules.where("pattern IS NOT NULL").select(
        "number",
        "pattern",
        F.when(F.col("pattern").startswith("@@"), "allow").otherwise("block").alias("verdict"),
        F.regexp_replace(text, r"^\|\|?|\|$", "").alias("body"),
        F.when(text.startswith("||"), _HOST_START).when(text.startswith("|"), "^").otherwise("").alias("start"),
        F.when(text.rlike(r"^(?!\|\|?$).*\|$"), "$").otherwise("").alias("end"),
    )
    escaped = F.regexp_replace("body", r"([^a-z0-9*^/:_=&%,;~@!<> -])", r"\\$1")
    regex = F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("^"), F.lit(_SEPARATOR))
    edge = lambda c: F.when(F.col(c) == "", "*").otherwise("")
    whole = F.regexp_extract_all(F.concat(edge("start"), "body", edge("end")), F.lit("(?<![a-z0-9*])([a-z0-9]+)(?![a-z0-9*])"))
    tokens = F.when(F.size(whole) > 0, F.array_distinct(whole)).otherwise(F.array(F.lit("")))
    return parts.select("number", "pattern", "verdict", F.concat("start", regex, "end").alias("regex"), tokens.alias("tokens"))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: Column, path: Column, rules: tuple[HostRule, ...]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, out) if found is None else found.when(fits, out)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if found is None else found


def _tokens(url: Column) -> Column:
    """Distinct runs of letters and digits, and the empty token."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(url), "[^a-z0-9]+")))


def matched_patterns(urls: DataFrame, patterns: DataFrame) -> DataFrame:
    """(url, pattern, pattern_verdict) of the distinct URLs that some rule of ``patterns`` (number, pattern) fits: the first exception, else the first block."""
    filed = materialize(compile_patterns(patterns).withColumn("token", F.explode("tokens")).drop("tokens"), "url-rules")
    tokens = urls.where("url IS NOT NULL").select("url", F.explode(_tokens(F.col("url"))).alias("token"))
    # only tokens of rules are counted: never more rows than the rules have
    named = light(materialize(filed.select("token").distinct(), "url-tokens"))
    often = tokens.join(named, "token", "left_semi").groupBy("token").agg(F.count("*").alias("seen"))
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.coalesce("seen", F.lit(0)), "token"))
    index = materialize(filed.join(often, "token", "left").withColumn("rank", rank).where("rank = 1").drop("rank", "seen"), "url-index")
    fits = tokens.join(light(index), "token").where(F.expr("rlike(lower(url), regex)"))
    return (
        fits.groupBy("url")
        .agg(F.min(F.struct("verdict", "number", "pattern")).alias("best"))  # "allow" sorts before "block"
        .select("url", F.col("best.pattern").alias("pattern"), F.col("best.verdict").alias("pattern_verdict"))
    )


def url_filters(
    pages: DataFrame, rules: tuple[HostRule, ...] = HOST_RULES, patterns: tuple[str, ...] | DataFrame = PATTERNS, url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the host rule, else null), ``pattern`` (else null) and ``verdict``.

    ``patterns`` are a few in order, or a table (number, pattern) of any length.
    """
    names = ("host", "path", "rule", "pattern", "verdict")
    safe, renamed = clash_free(pages.drop(*(n for n in names if n != url)))
    if not isinstance(patterns, DataFrame):
        patterns = pages.sparkSession.createDataFrame(list(enumerate(patterns)), "number long, pattern string")
    found = light(materialize(matched_patterns(safe.select(F.col(renamed[url]).alias("url")), patterns), "url-patterns"))
    value = F.col(renamed[url])
    judged = (
        safe.withColumns({"host": host_of(value), "path": path_of(value)})
        .withColumn("host_rule", host_rule(F.col("host"), F.col("path"), rules))
        .join(found.withColumnRenamed("url", "matched_url"), value == F.col("matched_url"), "left")
    )
    return judged.select(
        *(F.col(new).alias(old) for old, new in renamed.items()),
        "host",
        "path",
        F.col("host_rule.rule").alias("rule"),
        "pattern",
        F.coalesce("host_rule.verdict", "pattern_verdict", F.lit("allow")).alias("verdict"),
    )
