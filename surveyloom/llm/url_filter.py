"""URL filters: rules indexed by their rarest literal token; regular expressions for candidates only.

Two kinds of rules are held. A **prefix rule** such as ``example.net/en/`` fits its host and all
subdomains where the path starts with its path, letter case included; of those that fit, the longest
decides. Where none fits, **patterns** decide: ``||`` stands for the begin of a host or of one of its
parts, ``|`` for the begin or end of the URL, ``*`` for any characters, ``^`` for a separator or the
end. A pattern that allows outweighs those that block; a URL that nothing fits is allowed.

**Index.** A literal token of a rule is a run of letters and digits that the rule cannot continue on
either side, so that a URL which the rule fits holds it as a whole token. How many URLs hold each of
these tokens is counted over the table, and a rule is filed under its rarest one. The tokens of a
URL fetch candidate rules by an equi-join, and only those are run as regular expressions. Rules
without such a token are candidates of every URL. The index is a written table, so Spark knows its
size and broadcasts it only where that is small; beyond that it is a shuffled join on tokens that
adaptive execution splits where a token is frequent.

What was found for the tokens of a row is put together by an aggregate that combines inside each
task: one narrow row for each row of a task is shuffled, whatever it holds.

A null URL, or one without ``://``, has an empty host and path, which no prefix rule fits; patterns
see its text (null: nothing). Repeated rows give repeated results, a null id is an id like any
other. Among prefix rules of equal length the one with the longer host decides, then the blocking
one, then the later in order of text. Columns other than ``page_id`` and ``url`` are not read; an
empty table gives an empty result, an empty list of rules allows everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.sources.workspace import written

PREFIX, PATTERN = "prefix", "pattern"
BLOCK, ALLOW = "block", "allow"

#: The prefix rules of the query, as (text, verdict).
PREFIX_RULES = (
    ("net/", BLOCK),
    ("example.net/en/", ALLOW),
    ("example.com/de/", BLOCK),
    ("org/fr/", ALLOW),
)

#: Patterns for URLs that seldom lead to prose, as (text, verdict).
PATTERNS = (
    # Spam and adult hosts
    ("||cheap-pills.", BLOCK), ("-casino.", BLOCK), ("||casino-", BLOCK), ("||casino.", BLOCK),
    ("||poker.", BLOCK), ("||betting.", BLOCK), ("||xxx.", BLOCK), ("||porn.", BLOCK),
    ("/porn/", BLOCK), ("/viagra^", BLOCK), ("/payday-loans^", BLOCK), ("||free-movies.", BLOCK),
    # Adverts and trackers
    ("||ads.", BLOCK), ("||adserver.", BLOCK), ("||doubleclick.", BLOCK), ("||track.", BLOCK),
    ("/banner/*/click^", BLOCK), ("/pixel.gif^", BLOCK),
    # Accounts, shops, searches, endless calendars
    ("/login^", BLOCK), ("/signin^", BLOCK), ("/register^", BLOCK), ("/cart^", BLOCK),
    ("/checkout^", BLOCK), ("/wp-admin/", BLOCK), ("/search?q=", BLOCK), ("/calendar/*/day/", BLOCK),
    ("?sessionid=", BLOCK), ("&sessionid=", BLOCK), ("?replytocom=", BLOCK),
    # Files that are no pages
    (".exe|", BLOCK), (".zip|", BLOCK), (".tar.gz|", BLOCK), (".mp4|", BLOCK), (".jpg|", BLOCK),
    (".apk|", BLOCK),
    # Exceptions
    ("||docs.*/login^", ALLOW), ("||help.*/register^", ALLOW), ("/legal/terms^", ALLOW),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[a-z0-9]++"
_WHOLE_TOKEN = r"(?<=[^a-z0-9*])[a-z0-9]++(?=[^a-z0-9*])"
_SEPARATOR = r"(?:[^a-z0-9_.%-]|\z)"
_EVERYWHERE = ""


def rule_table(
    spark: SparkSession, prefixes: Sequence[tuple[str, str]] = PREFIX_RULES,
    patterns: Sequence[tuple[str, str]] = PATTERNS,
) -> DataFrame:
    """``kind, text, verdict``; a longer list may as well be read from a table of these columns."""
    rules = [(PREFIX, *rule) for rule in prefixes] + [(PATTERN, *rule) for rule in patterns]
    names = ("kind", "text", "verdict")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules]
    empty = F.array().cast("array<struct<kind: string, text: string, verdict: string>>")
    return spark.range(1).select(F.inline(F.array(*rows) if rows else empty))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without it."""
    return lower_ascii(F.regexp_extract(_rest(url), r"\A[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    return F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")


def tokens_of(url: Column) -> Column:
    """Distinct runs of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(lower_ascii(url), F.lit(_TOKEN), 0))


def with_expressions(rules: DataFrame) -> DataFrame:
    """Each rule once, with its regular expression and its whole literal tokens."""
    text = F.col("text")
    slash = F.instr(text, "/")
    host = F.when(slash > 0, F.substring(text, F.lit(1), slash - 1)).otherwise(text)
    path = F.when(slash > 0, F.substring(text, slash, F.length(text))).otherwise("")
    is_prefix = F.col("kind") == PREFIX
    given = rules.where("text IS NOT NULL AND verdict IS NOT NULL").select(
        "kind", "verdict",
        F.when(is_prefix, F.concat(lower_ascii(host), path)).otherwise(lower_ascii(text)).alias("text"),
        F.when(is_prefix, F.length(host)).otherwise(0).alias("host_length"),
    ).distinct()

    special = r"[\\.+?()\[\]{}$|]"
    body = F.regexp_replace(text, r"\A\|{1,2}|\|\z", "")
    body = F.regexp_replace(body, special, r"\\$0")
    body = F.replace(F.replace(body, F.lit("*"), F.lit(r"[\s\S]*")), F.lit("^"), F.lit("\x01"))
    pattern = F.concat(
        F.when(text.startswith("||"), r"\A[^:/?#]*://(?:[^/?#]*\.)?")
        .when(text.startswith("|"), r"\A").otherwise(""),
        F.replace(body, F.lit("\x01"), F.lit(_SEPARATOR)),
        F.when(text.endswith("|") & (F.length(text) > 1), r"\z").otherwise(""),
    )
    prefix = F.concat(F.lit(r"\A(?:[^/]*\.)?"), F.regexp_replace(text, r"[\\.+?()\[\]{}$|*^]", r"\\$0"))
    bounded = F.when(is_prefix, F.concat(F.lit("||"), lower_ascii(text))).otherwise(text)
    return given.select(
        "kind", "text", "verdict", "host_length",
        F.when(is_prefix, prefix).otherwise(pattern).alias("expression"),
        F.array_distinct(F.regexp_extract_all(bounded, F.lit(_WHOLE_TOKEN), 0)).alias("tokens"),
    )


def rarest_tokens(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules, each filed under the token that fewest URLs hold (ties: the least)."""
    names = ("kind", "text", "verdict", "host_length", "expression")
    filed = with_expressions(rules).select(*names, F.explode_outer("tokens").alias("token"))
    wanted = filed.select("token").where("token IS NOT NULL").distinct()
    counts = (
        urls.select(F.explode(tokens_of(F.col("url"))).alias("token"))
        .groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
        .join(wanted, "token", "left_semi")
    )
    ranked = filed.join(counts, "token", "left").withColumn(
        "rank", F.struct(F.coalesce("urls", F.lit(0)), F.coalesce("token", F.lit(_EVERYWHERE)))
    )
    return ranked.groupBy(*names).agg(F.min("rank").alias("rank")).select(
        *names, F.col("rank.col2").alias("token")
    )


def judge_urls(pages: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row.

    ``rule`` is the prefix rule that decided, null where patterns did or nothing fits.
    """
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    index = written(
        rarest_tokens(urls, rule_table(pages.sparkSession) if rules is None else rules),
        "url-rules",
    )
    lower = lower_ascii(F.col("url"))
    keys = F.array_union(F.coalesce(tokens_of(F.col("url")), F.array()), F.array(F.lit(_EVERYWHERE)))
    # A key of null never joins: it stands for the row itself, so that repeated rows are counted.
    # Rows are grouped inside their input split, where their number is bounded.
    asked = urls.withColumn("split", F.spark_partition_id()).withColumn(
        "token", F.explode(F.array_append(keys, F.lit(None).cast("string")))
    )
    is_prefix = F.col("kind") == PREFIX
    target = F.when(is_prefix, F.concat(host_of(F.col("url")), path_of(F.col("url")))).otherwise(lower)
    candidates = asked.join(index, "token", "left")
    tried = candidates.withColumn(
        "fits", F.coalesce(F.when(F.col("kind").isNotNull(), F.rlike(target, F.col("expression"))), F.lit(False))
    )
    rank = F.struct(
        F.length("text").alias("length"), "host_length",
        (F.col("verdict") == BLOCK).alias("blocks"), "text", "verdict",
    )
    pattern_fits = F.col("fits") & (F.col("kind") == PATTERN)
    found = tried.groupBy("page_id", "url", "split").agg(
        F.max(F.when(F.col("fits") & is_prefix, rank)).alias("best"),
        F.bool_or(pattern_fits & (F.col("verdict") == BLOCK)).alias("blocked"),
        F.bool_or(pattern_fits & (F.col("verdict") == ALLOW)).alias("excepted"),
        F.count_if(F.col("token").isNull()).alias("times"),
    )
    by_pattern = F.when(
        F.coalesce("blocked", F.lit(False)) & ~F.coalesce("excepted", F.lit(False)), BLOCK
    ).otherwise(ALLOW)
    return found.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select(
        "page_id",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
        F.col("best.text").alias("rule"),
        F.coalesce("best.verdict", by_pattern).alias("verdict"),
    )


def oracle() -> str:
    """Every rule against every URL, without an index."""

    def expression(text: str) -> str:
        start, end = "", ""
        if text.startswith("||"):
            start, text = r"^[^:/?#]*://([^/?#]*[.])?", text[2:]
        elif text.startswith("|"):
            start, text = "^", text[1:]
        if text.endswith("|"):
            end, text = "$", text[:-1]
        parts = {"*": r"[\s\S]*", "^": "([^a-z0-9_.%-]|$)"}
        return start + "".join(
            parts.get(c, c if c.isalnum() or c in "/-_=&:" else f"[{c}]") for c in text
        ) + end

    prefixes = ", ".join(
        f"('{t.split('/', 1)[0]}', '/{t.split('/', 1)[1]}', '{v}')" for t, v in PREFIX_RULES
    )

    def any_of(verdict: str) -> str:
        union = "|".join(f"({expression(t)})" for t, v in PATTERNS if v == verdict)
        return f"coalesce(regexp_matches(lower(url), '{union}'), false)"

    return rf"""
WITH rules(rule_host, rule_path, said) AS (VALUES {prefixes}),
cut AS (
    SELECT *, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, url, row_number() OVER () AS row_id,
           coalesce(lower(regexp_extract(rest, '^[^/?#]*')), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
           CASE WHEN {any_of(BLOCK)} AND NOT {any_of(ALLOW)} THEN 'block' ELSE 'allow' END AS other
    FROM cut
), fits AS (
    SELECT row_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(said, length(rule_host || rule_path)) AS said
    FROM parts JOIN rules ON (host = rule_host OR suffix(host, '.' || rule_host))
         AND starts_with(path, rule_path)
    GROUP BY row_id
)
SELECT page_id, host, path, rule, coalesce(said, other) AS verdict
FROM parts LEFT JOIN fits USING (row_id)
"""
