"""URL filters: allow and block rules, and patterns indexed by their rarest literal token.

Everything is DataFrame expressions. A rule or pattern is stored under one literal token that
any URL it fits must contain; the tokens of a URL fetch the candidates by an equi-join, and
only a fetched candidate's regular expression runs.

Defined results: a NULL url, or one without `://`, has empty host and path and fits nothing;
such rows and empty tables get verdict `allow` (or no rows). Repeated rows are judged alike and
all returned. Extra columns of the input are kept; if one has the name of an output column, the
output column replaces it.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm.work import free_name, table

TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """Fits `host` and its subdomains where the path starts with `path`."""

    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class Pattern:
    """Blocks a URL whose `host + path` the regular expression finds. `literals`: lower-case
    words of the expression that any such URL holds as whole tokens (runs of a-z, 0-9)."""

    regex: str
    literals: tuple[str, ...]


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

# Sites for gambling, pills, adult content and file dumps, by words of their host names.
PATTERNS = (
    Pattern(r"(^|[.-])casino([.-]|$| )", ("casino",)),
    Pattern(r"(^|[.-])free-bets?([.-]|$| )", ("free",)),
    Pattern(r"(^|[.-])cheap-pills?([.-]|$| )", ("cheap",)),
    Pattern(r"(^|[.-])xxx([.-]|$| )", ("xxx",)),
    Pattern(r"(^|[.-])porn([.-]|$| )", ("porn",)),
    Pattern(r"/wp-login[.]php$", ("wp", "login", "php")),
)


def tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.lower())


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in text)


def _compiled(rules: Sequence[Rule], patterns: Sequence[Pattern]) -> list[dict]:
    """One entry per rule or pattern: its regular expression over `host path` (joined by one
    blank), its literal tokens, and its rank: longer rules first, patterns after all rules."""
    entries = []
    for rule in rules:
        host = rule.host.lower()
        # A path prefix that ends inside a word may go on in the URL: its last token is no literal.
        last = re.sub(r"[A-Za-z0-9]+$", "", rule.path)
        entries.append({
            "regex": rf"^(?:[^/]*\.)?{_quoted(host)} {_quoted(rule.path)}",
            "literals": tokens(host) + tokens(last),
            "rule": f"{rule.host}{rule.path}",
            "verdict": rule.verdict,
            "rank": len(rule.host) + len(rule.path),
        })
    for place, pattern in enumerate(patterns):
        entries.append({
            "regex": pattern.regex, "literals": list(pattern.literals), "rule": None,
            "verdict": "block", "rank": -1 - place,
        })
    return entries


def url_parts(urls: DataFrame, url: str, host: str, path: str) -> DataFrame:
    """Add host (A-Z lower-cased) and path columns by plain text rules."""
    rest = F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)")
    has = F.instr(F.col(url), "://") > 0
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    whole = r"(?s)^([^/?#]*)([^?#]*)"
    return urls.withColumns({
        host: F.when(has, F.translate(F.regexp_extract(rest, whole, 1), upper, lower))
        .otherwise(""),
        path: F.when(has, F.regexp_extract(rest, whole, 2)).otherwise(""),
    })


def _held(host: str, path: str):
    """The distinct lower-case tokens of a URL."""
    words = F.split(F.lower(F.concat_ws(" ", host, path)), "[^a-z0-9]+")
    return F.array_distinct(F.filter(words, lambda t: t != ""))


def _rarest(parted: DataFrame, host: str, path: str, entries: list[dict]) -> list[str]:
    """The index token of each entry: of its literals, the one that the fewest URLs hold.
    Counts cover all URLs but only tokens that some entry has, so the driver gets one number
    for each of those."""
    wanted = sorted({t for e in entries for t in e["literals"]})
    counted = (
        parted.select(F.explode(F.array_intersect(
            _held(host, path), F.array(*[F.lit(t) for t in wanted]))).alias("token"))
        .groupBy("token").count().collect() if wanted else [])
    count = {row["token"]: row["count"] for row in counted}
    return [min(e["literals"], key=lambda t: (count.get(t, 0), t), default="") for e in entries]


_ENTRY = "token string, regex string, rule string, verdict string, rank int"


def _index(entries: list[dict], under: list[str], buckets: int):
    """The entries as one constant, an array of buckets by the checksum of the index token, so
    that a token is looked up in one step however many rules there are."""
    rows: list[list[dict]] = [[] for _ in range(buckets)]
    for entry, token in zip(entries, under, strict=True):
        rows[zlib.crc32(token.encode()) % buckets].append({**entry, "token": token})
    return F.from_json(F.lit(json.dumps(rows)), f"array<array<struct<{_typed(_ENTRY)}>>>")


def _typed(columns: str) -> str:
    return ", ".join(":".join(c.split()) for c in columns.split(", "))


def judge_urls(
    urls: DataFrame,
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    patterns: Sequence[Pattern] = PATTERNS,
    default: str = "allow",
) -> DataFrame:
    """The rows of `urls` with `host`, `path`, `rule` (the text of the longest rule that fits,
    or NULL), `verdict` (the rule's; where none fits, `block` if a pattern fits, else `default`)
    and `pattern` (the expression that blocked it, or NULL).

    Tokens are looked up in a constant made of the caller's rules, so no row is shuffled and
    nothing that grows with the URLs is sent anywhere. Entries without a literal are fetched by
    every URL.
    """
    taken = ("host", "path", "rule", "verdict", "pattern")
    kept = [c for c in urls.columns if c == url or c.lower() not in taken]
    parted = url_parts(urls.select(*[F.col(f"`{c}`") for c in kept]), url,
                       host := free_name(kept, "host"), path := free_name(kept, "path"))
    entries = _compiled(rules, patterns)
    buckets = max(16, 2 * len(entries))
    index = _index(entries, _rarest(parted, host, path, entries), buckets)
    fetched, best = free_name(parted.columns, "fetched"), free_name(parted.columns, "best")
    subject = F.concat_ws(" ", host, path)
    candidates = F.flatten(F.transform(
        F.array_union(F.array(F.lit("")), _held(host, path)),
        lambda t: F.filter(
            F.element_at(index, (F.crc32(t) % buckets).cast("int") + 1),
            lambda e: e["token"] == t)))
    # array_max compares structs field by field, so the rank goes first.
    fits = F.array_max(F.transform(
        F.filter(F.col(fetched), lambda e: F.rlike(subject, e["regex"])),
        lambda e: F.struct(e["rank"], e["rule"], e["verdict"], e["regex"])))
    out = parted.withColumn(fetched, candidates).withColumn(best, fits)
    chosen = F.col(best)
    return out.select(
        *[F.col(f"`{c}`") for c in kept if c == url or c not in taken],
        F.col(host).alias("host"), F.col(path).alias("path"),
        chosen["rule"].alias("rule"),
        F.coalesce(chosen["verdict"], F.lit(default)).alias("verdict"),
        F.when(chosen["rank"] < 0, chosen["regex"]).alias("pattern"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH parts AS (
    SELECT page_id,
        CASE WHEN contains(url, '://')
            THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), cut AS (
    SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw_host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), named AS (
    SELECT page_id, path,
        translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
    FROM cut
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), chosen AS (
    SELECT n.page_id, n.host, n.path, r.verdict, r.rule_host || r.rule_path AS rule,
        row_number() OVER (PARTITION BY n.page_id
            ORDER BY length(r.rule_host) + length(r.rule_path) DESC NULLS LAST) AS place
    FROM named n LEFT JOIN rules r ON starts_with(n.path, r.rule_path)
        AND (n.host = r.rule_host OR ends_with(n.host, '.' || r.rule_host))
)
SELECT page_id, host, path, rule, coalesce(verdict,
    CASE WHEN regexp_matches(host || ' ' || path,
        '(^|[.-])(casino|free-bets?|cheap-pills?|xxx|porn)([.-]|$| )|/wp-login[.]php$')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM chosen WHERE place = 1
"""
