"""URL filter: rules indexed by their rarest literal token.

A rule needs some whole tokens (runs of letters and digits) to be in a URL. It is
filed under that one of them which fewest URLs have, counted over all of them. The
tokens of a URL fetch the rules filed under them, and only those run their
regular expressions; a rule without a whole token is tried on every URL.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shaftline.llm.common import find_library, map_arrow

ALLOW, BLOCK = "allow", "block"
_TOKEN = re.compile("[a-z0-9]+")
# A token is whole where neither a wildcard nor another letter can touch it.
_WHOLE = re.compile(r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])")


@dataclass(frozen=True)
class Rule:
    """A pattern over host and path, ``*`` for any characters, and its verdict.

    With ``domain`` it fits the host it starts with, that host's subdomains and
    every path that goes on from its own.
    """

    verdict: str
    pattern: str
    domain: bool = False
    regex: re.Pattern[str] = field(init=False, compare=False)
    tokens: tuple[str, ...] = field(init=False, compare=False)

    def __post_init__(self) -> None:
        whole = f"{self.pattern}*" if self.domain else self.pattern
        body = ".*".join(map(re.escape, whole.split("*")))
        lead = r"(?:[^/]*\.)?" if self.domain else ""
        object.__setattr__(self, "regex", re.compile(lead + body, re.DOTALL))
        found = tuple(dict.fromkeys(_WHOLE.findall(_lowered(whole))))
        object.__setattr__(self, "tokens", found)


def _lowered(text: str) -> str:
    """A-Z lowered, so that other letters keep their length and meaning."""
    return text.translate(_LOWER)


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# The rules of the query. The longest that fits wins.
RULES = (
    Rule(ALLOW, "com/", domain=True),
    Rule(BLOCK, "example.com/en/", domain=True),
    Rule(ALLOW, "www.example.com/en/", domain=True),
    Rule(BLOCK, "net/es/", domain=True),
    Rule(BLOCK, "net/fr/", domain=True),
)
# For URLs that no domain rule fits; what none of these fits either is allowed.
PATTERNS = (
    Rule(BLOCK, "*/casino/*"),
    Rule(BLOCK, "*/login/*"),
    Rule(BLOCK, "*/cart/*"),
    Rule(BLOCK, "*/search/*"),
    Rule(BLOCK, "ads.*"),
    Rule(BLOCK, "*.ads.*"),
)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host, A-Z lowered, and path of a URL; both empty without ``://``."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = re.split("[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return _lowered(host), slash + path


def _host_and_path_column(url: Column) -> Column:
    """The same, joined, as a column; null for a URL without ``://``."""
    return F.regexp_extract(url, r"^(?s:.*?)://([^?#]*)", 1)


def url_tokens(text: str) -> set[str]:
    return set(_TOKEN.findall(_lowered(text)))


def token_counts(pages: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many URLs have each token that some rule needs.

    One row a token comes back, as many as the rules have. Tokens are counted in
    each task before anything is shuffled, so a token of all URLs costs one row a task.
    """
    needed = sorted({t for rule in rules for t in rule.tokens})
    if not needed:
        return {}
    text = F.translate(
        _host_and_path_column(F.col("url")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    tokens = pages.select(F.explode(F.array_distinct(F.split(text, "[^a-z0-9]+"))).alias("token"))
    counted = tokens.where(F.col("token").isin(needed)).groupBy("token").count().collect()
    return {**dict.fromkeys(needed, 0), **{row["token"]: row["count"] for row in counted}}


class RuleIndex:
    """Rules by the token they are filed under."""

    def __init__(self, rules: Sequence[Rule], counts: Mapping[str, int]) -> None:
        self.filed: dict[str, list[Rule]] = {}
        self.always: list[Rule] = []
        for rule in rules:
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), -len(t), t))
                self.filed.setdefault(rarest, []).append(rule)
            else:
                self.always.append(rule)

    def candidates(self, text: str) -> list[Rule]:
        if not text:
            return []
        own = [rule for t in url_tokens(text) for rule in self.filed.get(t, ())]
        return own + self.always

    def best(self, text: str) -> Rule | None:
        """The longest rule that fits; of equally long ones a blocking rule, then
        the first by pattern."""
        fitting = [rule for rule in self.candidates(text) if rule.regex.fullmatch(text)]
        return min(
            fitting, key=lambda r: (-len(r.pattern), r.verdict != BLOCK, r.pattern), default=None
        )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, patterns: Sequence[Rule] = PATTERNS
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``pattern`` per row.

    ``rule`` is the domain rule that decides, else null; then ``pattern`` is the
    pattern rule that decides, and what neither fits is allowed, also a null URL
    and one without ``://``. Rows are judged where they are and copies of a URL
    alike; the rules are held by every task, so their number is what a driver
    can list.
    """
    find_library(pages.sparkSession)
    counts = token_counts(pages, [*rules, *patterns])
    domains, others = RuleIndex(rules, counts), RuleIndex(patterns, counts)

    def per_batch(batch: pa.RecordBatch) -> Iterator[dict[str, object]]:
        hosts, paths, names, verdicts, fitted = [], [], [], [], []
        for url in batch["url"].to_pylist():
            host, path = host_and_path(url)
            rule = domains.best(host + path)
            pattern = None if rule else others.best(host + path)
            decides = rule or pattern
            hosts.append(host)
            paths.append(path)
            names.append(rule.pattern if rule else None)
            fitted.append(pattern.pattern if pattern else None)
            verdicts.append(decides.verdict if decides else ALLOW)
        yield {
            "page_id": batch["page_id"],
            "host": pa.array(hosts, pa.string()),
            "path": pa.array(paths, pa.string()),
            "rule": pa.array(names, pa.string()),
            "verdict": pa.array(verdicts, pa.string()),
            "pattern": pa.array(fitted, pa.string()),
        }

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(
        pages.select("page_id", "url"),
        per_batch,
        f"page_id {kind}, host string, path string, rule string, verdict string, pattern string",
    )


def op3_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf}/pages.parquet"))


ORACLE = r"""
WITH parts AS (
  SELECT page_id,
         CASE WHEN position('://' IN url) > 0
              THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*') ELSE '' END
           AS raw_host,
         CASE WHEN position('://' IN url) > 0
              THEN regexp_extract(substr(url, position('://' IN url) + 3), '^[^/?#]*([^?#]*)', 1)
              ELSE '' END AS path
  FROM pages
), lowered AS (
  SELECT page_id, path,
         translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule
  FROM lowered
), fitted AS (
  SELECT *, CASE
    WHEN rule IS NOT NULL THEN NULL
    WHEN host || path LIKE '%/casino/%' THEN '*/casino/*'
    WHEN host || path LIKE '%/search/%' THEN '*/search/*'
    WHEN host || path LIKE '%/login/%' THEN '*/login/*'
    WHEN host || path LIKE '%/cart/%' THEN '*/cart/*'
    WHEN host || path LIKE '%.ads.%' THEN '*.ads.*'
    WHEN host || path LIKE 'ads.%' THEN 'ads.*' END AS pattern
  FROM ruled
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL OR pattern IS NOT NULL THEN 'block'
            ELSE 'allow' END AS verdict,
       pattern
FROM fitted
"""
