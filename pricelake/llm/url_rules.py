"""URL filters: host and path rules, and pattern rules, found by their rarest literal token.

Every rule names literal tokens that a fitting URL must contain whole (runs of ASCII letters and digits;
host tokens apart from path tokens). How many URLs hold each of these tokens is counted over all URLs,
and a rule is filed under its rarest one. A URL's tokens fetch the rules filed under them, and only
these run their regular expression; rules without a whole token are tried on every URL.

The rules are a list in the program, so what is sent to tasks is bounded by that list, not by data. Nothing
is shuffled but the token counts.

Defined cases: a URL that is null or has no ``://`` has an empty host and path and fits no rule; its verdict is
that of no rule, ``allow``; repeated rows are judged alike; further columns stay; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import ascii_lower


def _runs(text: str) -> list[str]:
    return re.findall(r"[A-Za-z0-9]+", text)


@dataclass(frozen=True)
class Rule:
    """text: how the rule is shown; pattern: searched in "host/path", as no host holds a slash; tokens: literals that a fitting URL holds."""

    text: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    by_place: bool = True

    @staticmethod
    def place(text: str, verdict: str) -> Rule:
        """A rule for a host, its subdomains, and paths with a prefix: ``example.org/en/``."""
        host, slash, rest = text.partition("/")
        path = slash + rest
        pattern = rf"\A(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}"
        whole = path if path.endswith("/") or not path else path[: len(path) - len(re.search(r"[A-Za-z0-9]*\Z", path)[0])]
        return Rule(text, verdict, pattern, tuple(f"h:{t}" for t in _runs(host)) + tuple(f"p:{t}" for t in _runs(whole)))

    @staticmethod
    def words(text: str, verdict: str, *host_tokens: str) -> Rule:
        """A rule for hosts that hold these tokens side by side, joined by hyphens."""
        pattern = r"\A(?:[^/]*[^A-Za-z0-9/])?" + "-".join(map(re.escape, host_tokens)) + r"(?![A-Za-z0-9])[^/]*/"
        return Rule(text, verdict, pattern, tuple(f"h:{t}" for t in host_tokens), by_place=False)


#: The rules of the contract, the longest that fits decides.
PLACES = (
    Rule.place("org/", "allow"),
    Rule.place("example.org/es/", "block"),
    Rule.place("example.org/en/1", "block"),
    Rule.place("com/fr/", "allow"),
    Rule.place("com/de/", "block"),
)
#: Names of hosts that are blocked where no rule above fits; the first that fits decides.
WORDS = (
    Rule.words("*cheap-pills*", "block", "cheap", "pills"),
    Rule.words("*casino-win*", "block", "casino", "win"),
    Rule.words("*free-bets*", "block", "free", "bets"),
    Rule.words("*spam-farm*", "block", "spam", "farm"),
    Rule.words("*ads-track*", "block", "ads", "track"),
)


def url_host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens() -> Column:
    """Distinct tokens of the columns host and path."""
    def tokens(column: str, mark: str) -> Column:
        runs = F.regexp_extract_all(F.col(column), F.lit("[A-Za-z0-9]+"), F.lit(0))
        return F.transform(F.array_distinct(runs), lambda t: F.concat(F.lit(mark), t))

    return F.concat(tokens("host", "h:"), tokens("path", "p:"))


def token_counts(urls: DataFrame, rules: Iterable[Rule]) -> dict[str, int]:
    """How many rows hold each token of the rules; at most as many values as the rules have tokens."""
    wanted = sorted({t for r in rules for t in r.tokens})
    held = F.array_intersect(url_tokens(), F.array(*(F.lit(t) for t in wanted)).cast("array<string>"))
    counted = urls.select(F.explode(held).alias("token")).groupBy("token").count().collect()
    return dict.fromkeys(wanted, 0) | {r["token"]: r["count"] for r in counted}


def index_rules(rules: Iterable[Rule], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rules by their rarest token; those without one under the empty string."""
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        index.setdefault(min(rule.tokens, key=lambda t: (counts[t], t), default=""), []).append(rule)
    return index


def judge(urls: DataFrame, url: str = "url", places=PLACES, words=WORDS) -> DataFrame:
    """Add host, path, rule (null where none of the place rules fits), pattern_rule and verdict."""
    taken = [c for c in ("host", "path", "rule", "pattern_rule", "verdict") if c in urls.columns]
    split = urls.drop(*taken).withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    rules = [*places, *words]
    rank = {r: i for i, r in enumerate(words)}
    index = index_rules(rules, token_counts(split, rules))

    @F.pandas_udf("struct<rule:string,pattern_rule:string,verdict:string>")
    def decide(host: pd.Series, path: pd.Series, tokens: pd.Series) -> pd.DataFrame:
        found = {rule: re.compile(rule.pattern) for filed in index.values() for rule in filed}
        out = []
        for h, p, held in zip(host, path, tokens, strict=True):
            where = f"{h}/{p}"
            tried = (r for t in ("", *held) for r in index.get(t, ()))
            fits = [r for r in tried if h and found[r].search(where)]
            by_place = max((r for r in fits if r.by_place), key=lambda r: len(r.text), default=None)
            by_word = min((r for r in fits if not r.by_place), key=rank.__getitem__, default=None)
            deciding = by_place or by_word
            out.append((by_place and by_place.text, by_word and by_word.text, deciding.verdict if deciding else "allow"))
        return pd.DataFrame(out, columns=["rule", "pattern_rule", "verdict"])

    judged = split.withColumn("_found", decide("host", "path", url_tokens()))
    return judged.select(*split.columns, "_found.rule", "_found.pattern_rule", "_found.verdict")
