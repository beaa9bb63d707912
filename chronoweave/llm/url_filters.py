"""URL filters, in DataFrame functions alone.

Rules are patterns on the whole URL and rules of host and path. Both are indexed by one literal token each: of the tokens that every match
must hold, the one that fewest URLs of the table hold. The tokens of a URL fetch candidate rules from that index, and only those are
tried. The longest rule of host and path that fits decides; patterns decide the rest.

Every distinct URL is judged once, so a URL that many pages share costs one row; counts by token are summed before they are shuffled.
Null URLs and URLs without ``://`` have an empty host and path, which no rule fits; a null URL fits no pattern. Repeated rows get the same
verdict. An empty table gives an empty result. Columns besides ``page_id`` and ``url`` are not read. A rule without any token is refused.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.common import stored, table

#: Most rules whose index is broadcast; a longer list is joined by shuffle.
BROADCAST_RULES = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Pattern:
    """A blocking rule: a regular expression on the lower-cased URL, and tokens ``[a-z0-9]+`` that each match holds whole."""

    name: str
    regex: str
    tokens: tuple[str, ...]


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str


PATTERNS = [
    Pattern("feed-tracking", r"[?&]utm_source=feed(?:[&#]|$)", ("utm", "source", "feed")),
    Pattern("ad-tracking", r"[?&]utm_medium=(?:cpc|banner|ads?)(?:[&#]|$)", ("utm", "medium")),
    Pattern("click-id", r"[?&](?:gclid)=[a-z0-9_-]{8,}", ("gclid",)),
    Pattern("session-id", r"[?&;]jsessionid=[0-9a-f]{16,}", ("jsessionid",)),
    Pattern("paged-referral", r"[?&]page=\d+&ref=", ("page", "ref")),
    Pattern("print-view", r"[?&]print=(?:1|true)(?:[&#]|$)", ("print",)),
    Pattern("login", r"/(?:[a-z]{2}/)?login(?:[/?#.]|$)", ("login",)),
    Pattern("cart", r"/cart/(?:add|checkout)(?:[/?#]|$)", ("cart",)),
    Pattern("ad-host", r"^[a-z]+://ads\.", ("ads",)),
    Pattern("casino", r"[./-]casino[./-]", ("casino",)),
    Pattern("pills", r"[./-]viagra[./-]", ("viagra",)),
    Pattern("adult", r"[./-]xxx[./-]", ("xxx",)),
    Pattern("replica", r"[./-]replica-watches[./-]", ("replica", "watches")),
    Pattern("torrent", r"/torrent/[0-9a-f]{40}", ("torrent",)),
    Pattern("calendar-trap", r"/calendar/\d{4}/\d{1,2}/\d{1,2}(?:[/?#]|$)", ("calendar",)),
]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(1 << 30))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.when(F.instr(url, "://") > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    """Behind the host, up to ``?``, ``#`` or the end."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(1 << 30))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(url), F.lit("[a-z0-9]+"), F.lit(0)))


def rule_tokens(rule: HostRule) -> tuple[str, ...]:
    """Tokens that each match holds whole: those of the host, and of the path but for one that it may go on behind."""
    return tuple(re.findall("[a-z0-9]+", rule.host) + re.findall("[a-z0-9]+(?=[^a-z0-9])", rule.path.lower()))


_RULE = "token string, name string, regex string, rule string, verdict string, host string, path string"


def rule_index(tokens: DataFrame, rules: list[HostRule], patterns: list[Pattern]) -> DataFrame:
    """``_RULE`` rows: each rule under the token of its own that fewest URLs hold. ``tokens`` has ``url, token``."""
    rows = [(t, p.name, p.regex, None, None, None, None) for p in patterns for t in p.tokens]
    rows += [(t, None, None, r.host + r.path, r.verdict, r.host, r.path) for r in rules for t in rule_tokens(r)]
    if len({r[1:] for r in rows}) < len({*rules}) + len({*patterns}):
        raise ValueError("a rule without tokens can't be indexed")
    literals = tokens.sparkSession.createDataFrame(rows, _RULE)
    wanted = literals.select("token").distinct()
    counts = tokens.join(F.broadcast(wanted) if len(rows) <= BROADCAST_RULES else wanted,
        "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    ranked = literals.join(counts, "token", "left").withColumn("urls", F.coalesce("urls", F.lit(0)))
    rarest = F.min(F.struct("urls", "token")).getField("token").alias("token")
    return ranked.groupBy([c for c in literals.columns if c != "token"]).agg(rarest).select(*literals.columns)


def matched_urls(pages: DataFrame, rules: list[HostRule], patterns: list[Pattern] = PATTERNS) -> DataFrame:
    """``url, rule, verdict, pattern`` of every URL that something fits: its longest rule, a block first of equally long ones, and the first pattern."""
    urls = pages.select("url").filter(F.col("url").isNotNull()).distinct()
    tokens = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    index = rule_index(tokens, rules, patterns)
    candidates = tokens.join(F.broadcast(index) if len(rules) + len(patterns) <= BROADCAST_RULES else index, "token")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    in_host = ((host == F.col("host")) | F.endswith(host, F.concat(F.lit("."), "host"))) & F.startswith(path, F.col("path"))
    fits = F.when(F.col("regex").isNotNull(), F.rlike(F.lower("url"), F.col("regex"))).otherwise(in_host)
    longest = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.char_length("rule").alias("size"), F.col("verdict") == "block", "rule", "verdict")))
    found = candidates.filter(fits).groupBy("url").agg(longest.alias("one"), F.min("name").alias("pattern"))
    return found.select("url", "one.rule", "one.verdict", "pattern")


def judge(pages: DataFrame, rules: list[HostRule], patterns: list[Pattern] = PATTERNS) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of every page."""
    matched = stored(matched_urls(pages, rules, patterns), "matched-urls")
    parted = pages.select("page_id", "url", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"))
    by_pattern = F.when(F.col("pattern").isNotNull(), "block").otherwise("allow")
    return parted.join(matched, "url", "left").select("page_id", "host", "path", "rule",
        F.coalesce("verdict", by_pattern).alias("verdict"), "pattern")


RULES = [HostRule("allow", "org", "/"), HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"), HostRule("allow", "com", "/fr/"), HostRule("block", "com", "/de/")]


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES)
