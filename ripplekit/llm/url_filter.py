"""URL verdicts from pattern rules, each looked up by its rarest literal token.

A rule names what any URL it fits must hold as whole literal tokens: a list of
choices, of each of which at least one. All URLs' tokens are counted, each rule is
stored under the tokens of its rarest choice, URL tokens fetch the rules stored under
them, and only those rules' expressions run. Site rules (a host and a path prefix) go
the same way as expressions, and the longest that fits decides; without one, an
allowing pattern wins over a blocking one, and a URL that nothing fits is allowed.

Only DataFrame functions are used. Rules are a table, of any length: the written ones
below, or one made with ``site_rules`` and ``pattern_rules`` from tables of the caller's.
A token that many URLs share only fetches rules that have no rarer one. Expressions
spell out their word boundaries in ASCII and end with ``\\z``, so that other engines read them alike.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is allowed. Repeated pages and URLs each get their row, repeated rules
count once, rules with a null are left out. Texts are read whole. Other columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SiteRule:
    """Fits a host, all its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """Fits URLs whose host and path together match ``pattern``, which needs one token of each of ``tokens``."""

    name: str
    pattern: str
    verdict: str
    tokens: tuple[tuple[str, ...], ...]


def host_word(word: str, after: str = "") -> str:
    """A whole word of a host, before its last dot; ``after`` follows that dot."""
    return rf"^(?:[^/]*[^a-z0-9_/])?{word}(?:[^a-z0-9_/][^/]*)?\.{after}"


SITES = (
    SiteRule("org", "/", "allow"),
    SiteRule("example.org", "/es/", "block"),
    SiteRule("example.org", "/en/1", "block"),
    SiteRule("com", "/fr/", "allow"),
    SiteRule("com", "/de/", "block"),
)
PATTERNS = (
    PatternRule("casino-host", host_word("casino"), "block", (("casino",),)),
    PatternRule("adult-host", host_word("adult"), "block", (("adult",),)),
    PatternRule("xxx-host", host_word("xxx"), "block", (("xxx",),)),
    PatternRule("poker-host", host_word("poker"), "block", (("poker",),)),
    PatternRule("pills-host", host_word("pills"), "block", (("pills",),)),
    PatternRule("cheap-offers", host_word("cheap", "(?:com|net|info)/"), "block", (("cheap",), ("com", "net", "info"))),
    PatternRule("short-pages", r"/(?:en|fr|de|es)/[0-9]{1,2}/\z", "block", (("en", "fr", "de", "es"),)),
    PatternRule("help-pages", r"^(?:help|docs)\.[^/]*/en/", "allow", (("en",), ("help", "docs"))),
)
RULE = "name string, pattern string, verdict string, site int, tokens array<array<string>>"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def words(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; the empty one fetches rules that have no token."""
    found = F.regexp_extract_all(ascii_lower(F.concat(host, path)), F.lit("([a-z0-9]+)"), 1)
    return F.array_append(F.array_distinct(found), F.lit(""))


def site_rules(frame: DataFrame) -> DataFrame:
    """Rules from (host, path, verdict); a path's last word may be the start of a longer one, so it is no token."""
    host = ascii_lower(F.col("host"))
    name = F.concat(host, "path")
    path = F.regexp_extract_all(ascii_lower(F.col("path")), F.lit(r"([a-z0-9]+)(?![a-z0-9]|\z)"), 1)
    tokens = F.concat(F.regexp_extract_all(host, F.lit("([a-z0-9]+)"), 1), path)
    return frame.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        name.alias("name"),
        F.concat(F.lit(r"^(?:[^/]*\.)?"), F.regexp_replace(name, "([^A-Za-z0-9/_])", r"\\$1")).alias("pattern"),
        "verdict",
        F.length(name).alias("site"),
        F.transform(tokens, lambda t: F.array(t)).alias("tokens"),
    )


def pattern_rules(frame: DataFrame) -> DataFrame:
    """Rules from (name, pattern, verdict, tokens)."""
    frame = frame.where("name IS NOT NULL AND pattern IS NOT NULL AND verdict IS NOT NULL")
    tokens = F.coalesce(F.col("tokens").cast("array<array<string>>"), F.array())
    return frame.select("name", "pattern", "verdict", F.lit(0).alias("site"), tokens.alias("tokens"))


def written(spark, rows: list[tuple], kind: str) -> DataFrame:
    """A table of a few rows, as part of the plan."""
    lit = lambda v: F.array(*map(lit, v)) if isinstance(v, tuple) else F.lit(v)
    structs = F.array(*(F.struct(*map(lit, row)).cast(f"struct<{kind}>") for row in rows)).cast(f"array<struct<{kind}>>")
    return spark.range(1).select(F.inline(structs))


def rule_table(spark, sites=SITES, patterns=PATTERNS) -> DataFrame:
    at = written(spark, [(s.host, s.path, s.verdict) for s in sites], "host:string,path:string,verdict:string")
    like = [(p.name, p.pattern, p.verdict, p.tokens) for p in patterns]
    return site_rules(at).union(
        pattern_rules(written(spark, like, "name:string,pattern:string,verdict:string,tokens:array<array<string>>"))
    )


def indexed(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Rules with each ``token`` of the choice of theirs that the fewest URLs hold (ties: the first in order)."""
    wanted = rules.select("name", "pattern", F.posexplode("tokens").alias("choice", "words"))
    wanted = wanted.select("name", "pattern", "choice", F.explode("words").alias("token")).distinct()
    counted = tokens.join(wanted.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count("*").alias("n")
    )
    choices = (
        wanted.join(counted, "token", "left")
        .groupBy("name", "pattern", "choice")
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.sort_array(F.collect_list("token")).alias("words"))
    )
    rarest = choices.groupBy("name", "pattern").agg(F.min(F.struct("n", "words")).alias("best"))
    return rules.join(rarest, ["name", "pattern"], "left").select(
        "name", "pattern", "verdict", "site", F.explode(F.coalesce("best.words", F.array(F.lit("")))).alias("token")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame | None = None, key: str = "page_id", url: str = "url"
) -> DataFrame:
    """(key, host, path, rule, verdict, pattern): ``rule`` is the site rule that decided, ``pattern`` the pattern rule.

    ``rules`` (columns ``RULE``) are the written ones if not given.
    """
    rules = rule_table(pages.sparkSession) if rules is None else rules
    host, path = parts(F.col(url))
    split = pages.select(F.col(key).alias("key"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    sought = split.where("host != '' OR path != ''").select(
        "host", "path", F.explode(words(F.col("host"), F.col("path"))).alias("token")
    )
    fits = sought.join(indexed(rules, sought.select("token")), "token").where("rlike(concat(host, path), pattern)")
    best = fits.groupBy("host", "path").agg(
        F.max(F.when(F.col("site") > 0, F.struct("site", "name", "verdict"))).alias("rule"),
        F.min(F.when(F.col("site") == 0, F.struct("verdict", "name"))).alias("pattern"),  # allow sorts before block
    )
    # Grows with the URLs, so it is not broadcast; written first, so that Spark can split the rows of a hot URL.
    best = settle(best, "judged").hint("merge")
    return split.join(best, ["host", "path"], "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("rule.name").alias("rule"),
        F.coalesce("rule.verdict", "pattern.verdict", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("pattern.name")).alias("pattern"),
    )
