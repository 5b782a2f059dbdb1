"""URL filters: pattern rules found through their rarest literal token.

A filter list may hold very many patterns. Each rule is filed under the one of
its literal tokens that the fewest URLs have; the tokens of a URL fetch the
rules filed under them, and only those rules run their regular expression. The
longest rule that fits decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import stored

# What separates the tokens of a URL.
_BETWEEN = "[^0-9a-z]+"
# Up to so many tokens of rules are sent to every task that counts them.
BROADCAST_TOKENS = 100_000


@dataclass(frozen=True)
class Rule:
    """A pattern over host and path (``www.example.com/en/1``) and its verdict.

    ``tokens``: lower-case runs of letters and digits that every URL it fits has
    whole, that is, between other characters. ``stated``: it is returned as the
    rule and beats every rule that is not.
    """

    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str
    stated: bool = True


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for ``host``, its subdomains and every path that starts with ``path``."""
    # The last token of a path may go on in the URL, so only what is closed counts.
    closed = re.split(_BETWEEN, (host + path).lower())[: None if not path or re.match(_BETWEEN, path[-1].lower()) else -1]
    return Rule(
        host + path,
        r"^(?:[^/?#]*\.)?" + re.escape(host) + (re.escape(path) if path else "(?:/|$)"),
        tuple(sorted({t for t in closed if t})),
        verdict,
    )


def word_rule(*words: str) -> Rule:
    """Blocks hosts of which one label has ``words`` in a row, joined by hyphens."""
    name = "-".join(words)
    return Rule(name, r"^(?:[^/?#]*[.-])?" + re.escape(name) + r"(?:[.:-]|/|$)", words, "block", stated=False)


# Stated rules: host, path, verdict.
RULES = (
    host_rule("com", "/", "allow"),
    host_rule("example.com", "/en/", "block"),
    host_rule("www.example.com", "/en/", "allow"),
    host_rule("net", "/es/", "block"),
    host_rule("net", "/fr/", "block"),
)
# The method's own rules, for URLs that no stated rule fits: words of hosts that
# sell, bet, track or spam.
OWN_RULES = tuple(
    word_rule(*words.split("-"))
    for words in (
        "ads ads-track adult adult-x bets casino cheap-pills free-bets gambling malware phishing pills poker "
        "porn sex spam spam-farm tracker viagra xxx"
    ).split()
)


def host_of(url: str | Column = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(_col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str | Column = "url") -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def _rows(spark: SparkSession, structs: list[Column]) -> DataFrame:
    """Literal rows as a table of Spark's own; nothing comes from Python when it runs."""
    return spark.range(1).select(F.inline(F.array(*structs)))


def rule_index(spark: SparkSession, places: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``token, rule, regex, verdict, stated`` with each rule under its rarest token.

    Token counts are taken over all ``places`` (column ``tokens``), but only of
    tokens that some rule has. A rule without tokens is filed under the empty
    one, which every URL has.
    """
    columns = ("rule", "regex", "tokens", "verdict", "stated")
    listed = _rows(
        spark,
        [
            F.struct(
                *[
                    (F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(c)
                    for c, v in zip(columns, (r.name, r.regex, list(r.tokens) or [""], r.verdict, r.stated))
                ]
            )
            for r in rules
        ],
    )
    # One row per token of the rules, which the driver holds anyway. URLs do not move for
    # it, unless the list is long.
    tokens = sorted({t for r in rules for t in r.tokens} | {""})
    asked = _rows(spark, [F.struct(F.lit(t).alias("token")) for t in tokens])
    counts = (
        places.select(F.explode("tokens").alias("token"))
        .join(F.broadcast(asked) if len(tokens) <= BROADCAST_TOKENS else asked, "token", "left_semi")
        .groupBy("token")
        .count()
    )
    return (
        listed.select("*", F.explode("tokens").alias("token"))
        .join(counts, "token", "left")
        .groupBy("rule", "regex", "verdict", "stated")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "token"))["token"].alias("token"))
    )


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, own: tuple[Rule, ...] = OWN_RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    Among the stated rules that fit, the longest wins and is returned; if none
    fits, the longest of the method's own rules decides, and ``rule`` is null;
    if none of those fits either, the verdict is ``allow``. Rules of the same
    length go by name.

    A null URL or one without ``://`` has an empty host and path, and is
    allowed. Repeated rows are judged each, an empty table gives no rows, and
    other columns are neither read nor returned.
    """
    spark = pages.sparkSession
    urls = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    # Each place once, however many pages (or a hot one) share it.
    place = F.concat("host", "path")
    places = stored(
        urls.select("host", "path", place.alias("place"))
        .distinct()
        .withColumn("tokens", F.array_union(F.split(F.lower("place"), _BETWEEN), F.array(F.lit("")))),
        "url-places",
    )
    index = stored(rule_index(spark, places, rules + own), "url-rules")
    fitting = (
        places.select("host", "path", "place", F.explode("tokens").alias("token"))
        .join(index, "token")
        .filter(F.expr("rlike(place, regex)"))
    )
    best = F.max(F.struct("stated", F.length("rule").alias("length"), "rule", "verdict"))
    decided = fitting.groupBy("host", "path").agg(best.alias("best"))
    return urls.join(decided, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.stated"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )


# ``judge_urls`` with the production rules as SQL: all rules against all URLs.
SQL = f"""
WITH u AS (
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
    FROM pages
), r(rule, regex, verdict, stated) AS (
    VALUES {", ".join(f"('{r.name}', '{r.regex.replace(chr(92) + '-', '-').replace(chr(92) + '/', '/')}', '{r.verdict}', {r.stated})" for r in RULES + OWN_RULES)}
), b AS (
    SELECT host, path, max({{'stated': stated, 'length': length(rule), 'rule': rule, 'verdict': verdict}}) AS best
    FROM (SELECT DISTINCT host, path FROM u) JOIN r ON regexp_matches(host || path, regex)
    GROUP BY host, path
)
SELECT page_id, u.host, u.path, CASE WHEN best.stated THEN best.rule END AS rule,
       coalesce(best.verdict, 'allow') AS verdict
FROM u LEFT JOIN b ON u.host = b.host AND u.path = b.path
"""
