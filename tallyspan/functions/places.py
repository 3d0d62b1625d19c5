"""Place names and addresses: keys that spellings of one place share.

Unicode normalization and kanji numbers are the steps Spark has no expression for; they are Arrow-batched, see each distinct name of a batch
once and move no other column, so that no row is shuffled for its key. Everything else stays in the JVM. Nulls give '' as a key, as blank
names do.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = "〇一二三四五六七八九"
RUN = re.compile(f"[{DIGITS}十]+")


def read_number(s: str, unknown_ones: int | None = None) -> int | None:
    """Kanji number up to 99. A tens digit that cannot be read counts as 1; a ones digit that cannot be read gives ``unknown_ones``."""
    if len(s) == 1 and s in DIGITS:
        return DIGITS.index(s)
    tens, ten, ones = s.partition("十")
    if not ten:
        return None
    low = 0 if not ones else DIGITS.index(ones) if len(ones) == 1 and ones in DIGITS else unknown_ones
    high = DIGITS.index(tens) if len(tens) == 1 and tens in DIGITS else 1
    return None if low is None else high * 10 + low


def once_each(s: pd.Series, fn) -> pd.Series:
    """``fn`` of every value, worked out once per distinct value; nulls stay."""
    known = {x: fn(x) for x in s.dropna().unique()}
    return pd.Series([known.get(x) for x in s], dtype=object)


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return once_each(s, lambda x: unicodedata.normalize("NFKC", x))


def digits_of(s: str) -> str:
    """Every run of kanji digits in Arabic digits; runs that are no number stay."""
    return RUN.sub(lambda m: str(n) if (n := read_number(m.group(), 0)) is not None else m.group(), s)


@F.pandas_udf(T.StringType())
def kanji_digits(s: pd.Series) -> pd.Series:
    return once_each(s, digits_of)


#: Spellings that stand for one kana, and blanks that are left out (fixed values).
ONE_KANA = str.maketrans({"ヶ": "ケ", "ヵ": "ケ", "之": "ノ", "の": "ノ", "ッ": "ツ", "　": "", " ": ""})
KANJI_BLOCK = re.compile(rf"([{DIGITS}十]+)丁目\Z")
ZEROS = re.compile(r"(?<![0-9])0+(?=[0-9]+丁目\Z)")


def key_text(name: str) -> str:
    """Key of a name: NFKC, one kana for its variants, no blanks, Arabic block number without leading zeros."""
    s = unicodedata.normalize("NFKC", name).strip(" ").translate(ONE_KANA)
    if (m := KANJI_BLOCK.search(s)) and (n := read_number(m.group(1))) is not None:
        s = f"{s[: m.start()]}{n}丁目"
    return ZEROS.sub("", s)


@F.pandas_udf(T.StringType())
def key_texts(s: pd.Series) -> pd.Series:
    return once_each(s, key_text)


def place_key(name: Column) -> Column:
    return F.coalesce(key_texts(name), F.lit(""))


def parent_key(key: Column) -> Column:
    """Key without its block number, null if it has none."""
    return F.nullif(F.regexp_extract(key, r"(?s)\A(.+?)\d+丁目\z", 1), F.lit(""))


def city_code5(code: Column) -> Column:
    """Five digits of a five- or six-digit code, else ''."""
    c = F.trim(F.coalesce(code, F.lit("")))
    return F.when(c.rlike(r"\A\d{6}\z"), F.substring(c, 1, 5)).when(c.rlike(r"\A\d{5}\z"), c).otherwise("")


def with_key(df: DataFrame, name: str, out: str = "key") -> DataFrame:
    """``df`` with the key of column ``name``."""
    return df.withColumn(out, place_key(F.col(f"`{name}`")))


MARKER = r"(丁目|番地|番|号)(?=\d|$)"


def address(pref: Column, city: Column, addr: Column, code: Column) -> Column:
    """``struct<body, marked>`` of an address: blanks, 大字 and 字 removed, numbers Arabic, markers as hyphens; ``marked`` is the town
    in front of the first marker, '' without one."""
    s = F.regexp_replace(nfkc(F.trim(F.coalesce(addr, F.lit("")))), r"[\s\x{3000}]+", "")
    s = kanji_digits(F.replace(F.replace(s, F.lit("大字"), F.lit("")), F.lit("字"), F.lit("")))
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, MARKER, "-"), r"[-−]+", "-"), r"^-+|-+$", "")
    return F.struct(s.alias("text"), body.alias("body"), F.regexp_extract(s, rf"^(.*?){MARKER}", 1).alias("marked"), F.regexp_extract(s, MARKER, 1).alias("marker"))


def normalize_addresses(df: DataFrame, codes: DataFrame, towns: DataFrame, code: str | None = None) -> DataFrame:
    """``pref``, ``city``, ``addr`` of ``df`` → the normalized address, its town, how the town was found and both keys.

    ``codes``: ``pref``, ``city``, ``city_code``; ``towns``: ``city_code``, ``town`` (normalized). The town list is matched by its longest prefix:
    every prefix of an address is an equi-join key, no row meets more than its own prefixes."""
    rows = df.withColumn("_id", F.monotonically_increasing_id()).withColumn("pref", F.trim(F.coalesce("pref", F.lit("")))).withColumn("city", F.trim(F.coalesce("city", F.lit(""))))
    rows = rows.join(codes.select(F.col("pref").alias("_p"), F.col("city").alias("_c"), F.col("city_code").alias("_known")), (F.col("pref") == F.col("_p")) & (F.col("city") == F.col("_c")), "left")
    given = city_code5(F.col(code)) if code else F.lit("")
    asked = F.col(code).isNotNull() & (F.col(code) != "") if code else F.lit(False)
    rows = rows.withColumn("_code", F.when(asked, given).otherwise(F.coalesce("_known", F.lit("")))).withColumn("_a", address(F.col("pref"), F.col("city"), F.col("addr"), F.col("_code")))
    listed = longest_prefix(rows.where("_a.marker = ''").select("_id", F.col("_code").alias("city_code"), F.col("_a.text").alias("text")), towns).select(F.col("_id").alias("_i"), F.col("town").alias("_town"))
    rows = rows.join(listed, F.col("_id") == F.col("_i"), "left")
    town = F.when(F.col("_a.marker") != "", F.col("_a.marked")).otherwise(F.coalesce("_town", F.lit("")))
    source = F.when(F.col("_a.marker") != "", "marker").when(F.col("_town").isNotNull(), "list").otherwise("unknown")
    return rows.select(
        "pref", "city", F.col("_code").alias("city_code"), town.alias("town"), source.alias("town_source"), F.concat("city", "_a.body").alias("addr"),
        F.when(F.col("_code") != "", F.concat("_code", F.lit("|"), "_a.body")).otherwise("").alias("addr_key"),
        F.when((F.col("_code") != "") & (town != ""), F.concat("_code", F.lit("|"), town)).otherwise("").alias("addr_key_town"),
    )


def longest_prefix(rows: DataFrame, towns: DataFrame) -> DataFrame:
    """``_id``, ``town``: the longest town of the row's city that its ``text`` begins with. The longest listed name bounds the prefixes of a row."""
    listed = towns.select("city_code", "town").distinct()
    bounded = rows.crossJoin(F.broadcast(towns.agg(F.coalesce(F.max(F.length("town")), F.lit(1)).alias("_most"))))
    prefixes = bounded.withColumn("n", F.explode(F.sequence(F.lit(1), F.greatest(F.least(F.length("text"), F.col("_most")), F.lit(1))))).select("_id", "city_code", F.expr("left(text, n)").alias("town"))
    return prefixes.join(listed, ["city_code", "town"]).groupBy("_id").agg(F.max_by("town", F.length("town")).alias("town"))
