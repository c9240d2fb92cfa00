"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression over host and path together with the literal tokens that every URL it
matches must contain. The rule is filed under the one of its tokens that is rarest among all URLs. A
URL fetches the rules filed under its own tokens, and only those run their regular expressions.
Rules without a token are filed under the empty token, which every URL has if there is such a rule.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlane.llm.sizes import broadcast_within
from paperlane.session import materialize

ALLOW, BLOCK = "allow", "block"
TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``grade`` ranks kinds of rules; within a grade the longer name wins, then the first in order."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    grade: int = 0


def host_rule(host: str, path: str, verdict: str, grade: int = 1) -> Rule:
    """Rule for a host, its subdomains, and paths that start with ``path``."""
    # the last token counts only if nothing can follow it
    whole = f"{host}{path}".lower() if path.endswith("/") else f"{host}{path}".lower() + "\0"
    tokens = [m[0] for m in TOKEN.finditer(whole) if whole[m.end() : m.end() + 1] != "\0"]
    return Rule(host + path, verdict, f"^([^/]*[.])?{re.escape(host.lower())}{re.escape(path)}", tuple(tokens), grade)


def pattern_rule(pattern: str, verdict: str, grade: int = 0) -> Rule:
    """Rule for an address that contains the pattern; ``*`` is any text, ``^`` a separator or the end.

    Upper and lower case are the same. Tokens are the runs of letters and digits with a sign other
    than ``*`` on both sides.
    """
    lower = pattern.lower()
    tokens = [
        m[0] for m in TOKEN.finditer(lower)
        if 0 < m.start() and m.end() < len(lower) and lower[m.start() - 1] != "*" and lower[m.end()] != "*"
    ]
    signs = {"*": ".*", "^": "(^|[^0-9a-zA-Z]|$)"}
    return Rule(pattern, verdict, "(?i)" + "".join(signs.get(c) or re.escape(c) for c in lower), tuple(tokens), grade)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


RULE = "array<struct<rule: string, verdict: string, regex: string, tokens: array<string>, grade: int>>"


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as a table, from one constant; no Python runs on executors."""
    rows = [{"rule": r.name, "verdict": r.verdict, "regex": r.regex, "tokens": list(r.tokens), "grade": r.grade} for r in rules]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), RULE)))


def tokens_of(address: Column) -> Column:
    """The distinct tokens of an address."""
    return F.filter(F.array_distinct(F.split(F.lower(address), "[^a-z0-9]+")), lambda token: token != "")


def index_rules(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """Rules with the token each is filed under: its rarest one among all addresses."""
    listed = rules.select("rule", "grade", F.explode("tokens").alias("token")).distinct()
    wanted = broadcast_within(materialize(listed.select("token").distinct(), "wanted"))
    seen = addresses.select(F.explode(tokens_of(F.col("address"))).alias("token"))
    counts = seen.join(wanted, "token").groupBy("token").agg(F.count("*").alias("n"))
    order = Window.partitionBy("rule", "grade").orderBy(F.coalesce("n", F.lit(0)), "token")
    rarest = listed.join(counts, "token", "left").withColumn("place", F.row_number().over(order)).filter("place = 1")
    filed = rules.join(rarest.select("rule", "grade", "token"), ["rule", "grade"], "left")
    return filed.select("rule", "verdict", "regex", "grade", F.coalesce("token", F.lit("")).alias("token"))


def judge(df: DataFrame, url: str, rules: Sequence[Rule], default: str = ALLOW) -> DataFrame:
    """Add host, path, the rule that decides and its verdict to every row.

    Of the matching rules the highest grade wins, then the longest name, then the first in order. No
    matching rule gives no rule and the default. A missing URL, or one without ``://``, has an empty
    host and path. Each distinct address is judged once, and repeated rows all get its verdict.
    Columns named ``host``, ``path``, ``rule`` or ``verdict`` are replaced.
    """
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in df.columns if c.lower() not in added]
    rows = df.select(*kept, host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = rows.withColumn("_address_", F.concat("host", "path"))
    addresses = rows.select(F.col("_address_").alias("address"))

    index = materialize(index_rules(rule_table(df.sparkSession, rules), addresses), "rules")
    tokens = tokens_of(F.col("address"))
    if not all(r.tokens for r in rules):
        # only where a rule is filed under it is the empty token looked up, once per address
        tokens = F.array_append(tokens, F.lit(""))
    # rules stay with the tasks that read addresses, if they are few bytes; a token of many addresses is no hot key then
    fetched = addresses.distinct().select("address", F.explode(tokens).alias("token")).join(broadcast_within(index), "token")
    matching = fetched.filter(F.expr("address RLIKE regex"))
    best = F.min_by(F.struct("rule", "verdict"), F.struct(-F.col("grade"), -F.length("rule"), "rule"))
    verdicts = matching.groupBy("address").agg(best.alias("best"))
    # stored, so that the join below starts from plain shuffles, which a hot address cannot block
    verdicts = materialize(verdicts.select(F.col("address").alias("_address_"), "best.*"), "verdicts")
    found = rows.join(verdicts, "_address_", "left")
    return found.select(*kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
