"""URL filter by a weighted vocabulary.

An Aho-Corasick automaton finds every term of the vocabulary in the lower-cased address. A hit counts only
between boundaries: neither side may continue with a letter or digit. One strict term, or `SOFT_LIMIT`
different soft terms, block an address. Rules for hosts and paths come first: a rule fits its host and all
subdomains if the path starts with the rule's, and the longest that fits decides.

Nulls and edges: a null address or one without `://` has an empty host and path, so no rule fits; a null has
no hits and is allowed, other text is searched whole; repeated rows are judged each; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import read_table

STRICT_TERMS = ("adult", "casino", "escort", "hentai", "jackpot", "malware", "nsfw", "phishing", "porn",
                "porno", "roulette", "sex", "spam", "viagra", "warez", "xxx")
SOFT_TERMS = ("ads", "bet", "bets", "betting", "bonus", "cheap", "cialis", "crack", "dating", "deals", "farm",
              "free", "gambling", "keygen", "loan", "loans", "pharmacy", "pill", "pills", "poker", "popup",
              "slots", "torrent", "track", "tracker", "win", "winner")
SOFT_LIMIT = 2
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
COLUMNS = "host string, path string, rule string, verdict string, strict_hits int, soft_hits int"
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    ends = [i for i in map(rest.find, "/?#") if i >= 0]
    host_end = min(ends, default=len(rest))
    path = rest[host_end:]
    ends = [i for i in map(path.find, "?#") if i >= 0]
    return rest[:host_end].translate(TO_LOWER), path[: min(ends, default=len(path))]


def fitting_rule(host: str, path: str, rules: tuple[tuple[str, str], ...]) -> tuple[str | None, str | None]:
    """The longest rule that fits and what it says."""
    best: tuple[str | None, str | None] = (None, None)
    for rule, verdict in rules:
        rule_host, _, rule_path = rule.partition("/")
        of_host = host == rule_host or host.endswith(f".{rule_host}")
        if of_host and path.startswith(f"/{rule_path}") and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return best


def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in (*soft, *strict):
        found.add_word(term, (term, term in strict))
    found.make_automaton()
    return found


def hits(text: str, terms: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Different strict and soft terms that stand between boundaries."""
    strict: set[str] = set()
    soft: set[str] = set()
    text = text.translate(TO_LOWER)
    for end, (term, is_strict) in terms.iter(text):
        start = end - len(term) + 1
        if text[start - 1 : start].isalnum() or text[end + 1 : end + 2].isalnum():
            continue
        (strict if is_strict else soft).add(term)
    return strict, soft


def judge_urls(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    strict: tuple[str, ...] = STRICT_TERMS,
    soft: tuple[str, ...] = SOFT_TERMS,
    soft_limit: int = SOFT_LIMIT,
    rules: tuple[tuple[str, str], ...] = RULES,
) -> DataFrame:
    """One row per input row: the identifier, host, path, rule, verdict, strict_hits, soft_hits."""

    @F.pandas_udf(COLUMNS)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms = automaton(strict, soft)
        for urls in batches:
            rows = []
            for url in urls:
                host, path = split_url(url)
                rule, verdict = fitting_rule(host, path, rules)
                strict_found, soft_found = hits(url or "", terms)
                if verdict is None:
                    verdict = "block" if strict_found or len(soft_found) >= soft_limit else "allow"
                rows.append((host, path, rule, verdict, len(strict_found), len(soft_found)))
            names = [c.split()[0] for c in COLUMNS.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"strict_hits": "int32", "soft_hits": "int32"})

    rows = df.select(F.col(f"`{id_col}`").alias("page_id"), judged(F.col(f"`{url_col}`")).alias("judged"))
    return rows.select("page_id", "judged.*")


def query(spark, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"))


def _hit_counts(terms: tuple[str, ...]) -> str:
    return " + ".join(
        rf"regexp_matches(address, '(^|[^\p{{L}}\p{{N}}]){term}($|[^\p{{L}}\p{{N}}])')::INT" for term in terms
    )


def _fits(rule: str) -> str:
    host, _, path = rule.partition("/")
    return f"(host = '{host}' OR suffix(host, '.{host}')) AND starts_with(path, '/{path}')"


_LONGEST_FIRST = sorted(RULES, key=lambda rule: -len(rule[0]))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL = rf"""
WITH parts AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS address,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), counted AS (
  SELECT page_id, host, path, {_hit_counts(STRICT_TERMS)} AS strict_hits, {_hit_counts(SOFT_TERMS)} AS soft_hits,
    CASE {" ".join(f"WHEN {_fits(rule)} THEN '{rule}'" for rule, _ in _LONGEST_FIRST)} END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, strict_hits, soft_hits,
  CASE {" ".join(f"WHEN rule = '{rule}' THEN '{verdict}'" for rule, verdict in RULES)}
    WHEN strict_hits > 0 OR soft_hits >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM counted
"""
