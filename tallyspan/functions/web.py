"""URLs, robots rules and scans of published text."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = r"\A(?i:https?)://[^\s\\/?#@]+(?:[/?#]\S*)?\z"


def url_host(url: Column) -> Column:
    """Lower-case host of an http(s) URL without white-space or user part, else null."""
    host = F.regexp_extract(url, r"\A(?i:https?)://(\[[^\]]*\]|[^:/?#]*)", 1)
    return F.when(url.rlike(_PLAIN) & (host != ""), F.lower(host))


def url_parts(url: Column) -> Column:
    """``struct<base, path, query, asked>`` of a URL fit for scope checks, null for one with tricks (backslash, encoded dots or slashes)."""
    port = F.regexp_extract(url, r"\A[^:]+://(?:\[[^\]]*\]|[^:/?#]*)(?::(\d*))?", 1)
    base = F.concat(F.lower(F.regexp_extract(url, r"\A([^:]+)://", 1)), F.lit("|"), url_host(url), F.lit("|"), port)
    path = F.regexp_extract(url, r"\A[^:]+://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(url, r"\A[^?#]*\?([^#]*)", 1)
    fit = url_host(url).isNotNull() & ~url.rlike(r"\\|(?i)%2e|%2f|%5c")
    return F.when(fit, F.struct(base.alias("base"), F.when(path == "", "/").otherwise(path).alias("path"), query.alias("query"), F.contains(url, F.lit("?")).alias("asked")))


def in_scope(url: Column, scope: Column) -> Column:
    """Whether ``url`` is inside ``scope``: a path ending in ``/`` takes what is below it, one with ``?`` is exact with its query, any
    other is exact without query. Never a bare prefix match."""
    a, b = url_parts(url), url_parts(scope)
    inside = (
        F.when(b["asked"], (a["path"] == b["path"]) & (a["query"] == b["query"])).when(F.endswith(b["path"], F.lit("/")), F.startswith(a["path"], b["path"])).otherwise((a["path"] == b["path"]) & (a["query"] == ""))
    )
    return F.coalesce((a["base"] == b["base"]) & inside, F.lit(False))


def _bytes_normal(s: str) -> str:
    """Percent forms of unreserved characters undone, everything outside printable ASCII percent-encoded."""

    def undo(m: re.Match) -> str:
        ch = chr(int(m.group(1), 16))
        return ch if re.fullmatch(r"[A-Za-z0-9._~-]", ch) else m.group().upper()

    raw = s.encode("utf-8").decode("latin-1")
    parts = re.split(r"(%[0-9A-Fa-f]{2})", raw)
    return "".join(undo(re.fullmatch(r"%(..)", p)) if re.fullmatch(r"%[0-9A-Fa-f]{2}", p) else re.sub(r"[^\x21-\x7e]", lambda m: f"%{ord(m.group()):02X}", p) for p in parts)


@F.pandas_udf(T.StringType())
def percent_normal(s: pd.Series) -> pd.Series:
    return s.map(_bytes_normal, na_action="ignore")


def rule_regex(pattern: Column) -> Column:
    """Robots pattern (``*``, final ``$``) as an anchored regular expression."""
    end = F.endswith(pattern, F.lit("$"))
    body = F.when(end, F.substring(pattern, F.lit(1), F.length(pattern) - 1)).otherwise(pattern)
    quoted = F.concat(F.lit(r"\Q"), F.replace(body, F.lit("*"), F.lit(r"\E.*\Q")), F.lit(r"\E"))
    return F.concat(F.lit(r"\A"), quoted, F.when(end, r"\z").otherwise(""))


def allowed(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """``paths`` (``path``, ``agent_group``) with ``allowed``: the longest matching rule of the group decides, Allow wins a tie, no match
    and ``/robots.txt`` are allowed. ``rules``: ``agent_group``, ``allow``, ``pattern``; a group's rules are one robots file, so they travel as an array."""
    r = rules.where(F.coalesce("pattern", F.lit("")) != "").groupBy("agent_group").agg(F.collect_list(F.struct("allow", "pattern")).alias("rules"))
    joined = paths.join(r, "agent_group", "left")
    best = F.array_max(F.transform(F.filter("rules", lambda x: F.rlike(F.col("path"), rule_regex(x["pattern"]))), lambda x: F.struct(F.length(x["pattern"]).alias("n"), x["allow"].alias("allow"))))
    return joined.withColumn("allowed", F.when(F.col("path") == "/robots.txt", True).otherwise(F.coalesce(best["allow"], F.lit(True)))).drop("rules")


def parse_robots(text: str | None) -> list[tuple[int, str, str | None, str | None]]:
    """(group, agent line or '', directive, value) rows of a robots file: consecutive agent lines share a group, comments and a byte order mark go."""
    rows, group, naming = [], 0, False
    for raw in (text or "").removeprefix("﻿").splitlines():
        key, colon, value = raw.partition("#")[0].strip().partition(":")
        key, value = key.strip().lower(), value.strip()
        if not colon:
            continue
        if key == "user-agent":
            group += not naming
            naming = True
            rows.append((group, value.lower(), None, None))
            continue
        naming = False
        if group and (key in ("allow", "disallow") and value or key == "crawl-delay"):
            rows.append((group, "", key, value))
    return rows


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("grp", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in ("agent", "directive", "value")]])))
def robots_rows(s: pd.Series) -> pd.Series:
    return s.map(lambda t: [dict(zip(("grp", "agent", "directive", "value"), r)) for r in parse_robots(t)])


def robots_rules(files: DataFrame, agents: list[str]) -> DataFrame:
    """``host``, ``allow``, ``pattern``, ``delay`` that bind the named agents: their own groups, or those of ``*`` if no group names them."""
    rows = files.select("host", F.explode(robots_rows("body")).alias("r")).select("host", "r.*")
    named = F.split_part(F.col("agent"), F.lit("/"), F.lit(1))
    groups = rows.where(F.col("directive").isNull()).groupBy("host", "grp").agg(F.max(F.trim(named).isin([a.lower() for a in agents])).alias("mine"), F.max(F.col("agent") == "*").alias("star"))
    any_mine = groups.groupBy("host").agg(F.max("mine").alias("any_mine"))
    bound = groups.join(any_mine, "host").where(F.col("mine") | (~F.col("any_mine") & F.col("star"))).select("host", "grp")
    rules = rows.where(F.col("directive").isNotNull()).join(bound, ["host", "grp"])
    delay = F.greatest(F.lit(0.0), F.col("value").try_cast("double"))
    return rules.select("host", F.when(F.col("directive").isin("allow", "disallow"), F.col("directive") == "allow").alias("allow"), F.when(F.col("directive") != "crawl-delay", F.col("value")).alias("pattern"), F.when(F.col("directive") == "crawl-delay", delay).alias("delay"))


def robots_verdict(status: Column, ctype: Column, size: Column, head: Column) -> Column:
    """What an answer for a robots file is worth: absent, busy, unclear or readable."""
    kind = F.lower(F.trim(F.split_part(F.coalesce(ctype, F.lit("")), F.lit(";"), F.lit(1))))
    return (
        F.when(status.isin(404, 410), "absent").when(status.isin(429, 503), "busy").when(status.isNull() | (status < 200) | (status >= 300), "unclear")
        .when(~kind.isin("", "text/plain", "text/html") | (size > 512 * 1024) | is_html(head), "unclear").otherwise("readable")
    )


def is_html(head: Column) -> Column:
    return F.lower(F.substring(F.regexp_replace(head, r"\A[\s\x{FEFF}]+", ""), 1, 512)).rlike(r"\A<|<html|<!doctype")


def headings(html: Column) -> Column:
    """Texts of title, h1 to h3 and the description, tags stripped."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    parts = F.concat(F.regexp_extract_all(bare, F.lit(r"(?is)<(?:title|h[1-3])\b[^>]*>(.*?)</(?:title|h[1-3])\s*>"), F.lit(1)), F.regexp_extract_all(bare, F.lit(r"""(?is)<meta\s+name=["']description["']\s+content=["']([^"']*)["']"""), F.lit(1)))
    return F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", ""), r"\s+", " "))), lambda x: x != "")


def lines(df: DataFrame, text: str) -> DataFrame:
    """One row per line with its number from 1."""
    return df.select(*[c for c in df.columns if c != text], F.posexplode(F.split(text, "\n")).alias("_n", "line")).withColumn("line_no", F.col("_n") + 1).drop("_n")


def word_hits(df: DataFrame, text: str, words: list[str], around: int = 28) -> DataFrame:
    """Lines that hold one of ``words``: line number, word and its surroundings; one row per line and word."""
    rows = lines(df, text).withColumn("word", F.explode(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(F.col("line"), w))))
    pos = F.instr(F.col("line"), F.col("word"))
    return rows.withColumn("context", F.substring("line", F.greatest(pos - around, F.lit(1)), F.length("word") + F.least(pos - 1, F.lit(around)) + around)).drop("line")


def number_tokens(line: Column) -> Column:
    """Whole numbers of a line, thousands separators taken out."""
    return F.filter(F.transform(F.regexp_extract_all(line, F.lit(r"[0-9][0-9,]*"), F.lit(0)), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("bigint")), lambda x: x.isNotNull())


def canonical_json(c: Column, schema: str = "map<string,string>") -> Column:
    """JSON object with sorted keys, compact, as input of a fingerprint."""
    m = F.from_json(c, schema)
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))
