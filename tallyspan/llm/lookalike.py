"""Visually identical text with different characters, brought to one form.

A character is *unstable* if a normalization quick check does not answer yes for it, or if it has a width, blank, invisible or
look-alike mapping. Only maximal runs of unstable characters, together with the starter before them (the boundary context that
composition needs), are normalized; the canonical segments are spliced into the unchanged text. Text without an unstable
character comes back untouched.

``canonical`` folds width, composition, invisible and blank characters; ``skeleton`` folds look-alike letters on top, so that two
texts look the same exactly if their skeletons are equal. Variant kanji (also compatibility ideographs) stay what they are.

Defined results: null stays null; text of nothing but blanks or invisible characters becomes ''; very long text is handled in
one linear pass; repeated rows are judged one by one; extra input columns are ignored by the queries.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.session import broadcast_if_small

#: Groups of characters drawn alike, each folded to its first (fixed values).
ALIKE = [
    "一ー−–—―‐‑‒─━⎯-ｰ㇐", "二ニ", "八ハ", "口ロ囗", "工エ", "夕タ", "力カ", "卜ト", "丿ノ⼃", "才オ", "又ヌ", "厶ム", "ヘへ", "リり", 
    "lI1|ӏӀІΙ∣ⅼⅠǀ", "O0ОΟ", "oоοօ", "AАΑ", "BВΒ", "CСϹ", "EЕΕ", "HНΗ", "JЈ", "KКΚK", "MМΜ", "NΝ", "PРΡ", "SЅ", "TТΤ", "XХΧ", "YҮΥ", "ZΖ",
    "aаɑα", "cсϲ", "eе", "iіι", "jј", "pрρ", "sѕ", "xх", "yуү", "vνѵ", "nո", "uս", "hһ", "dԁ", "qԛ", "wԝ", "gɡ",
]
#: CJK radical supplements drawn as the unified ideograph (fixed values; the Kangxi radicals follow from their decomposition).
RADICALS = dict(zip("⻄⻑⻘⻝⻤⻩⻨⻫⻯⻲⺁⺇⺎⺟⺠⺩⻁⻃⻆⻋⻙⻚⻛⻜⻢⻣⻥⻦⻧⻬⻭⻮⻰⻳", "西長青食鬼黄麦斉竜亀厂几兀母民王虎覀角车韦页风飞马骨鱼鸟卤齐歯齿龙龟"))


def _ideograph(cp: int) -> bool:
    return 0xF900 <= cp <= 0xFAFF or 0x2F800 <= cp <= 0x2FA1F


def is_invisible(ch: str) -> bool:
    cp = ord(ch)
    return unicodedata.category(ch) in ("Cf", "Cc") or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or 0x180B <= cp <= 0x180F or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0)


def is_blank(ch: str) -> bool:
    return ch.isspace() or unicodedata.category(ch)[0] == "Z" or ch == "⠀"


@cache
def tables() -> tuple[dict[int, str], dict[int, str], re.Pattern]:
    """Width, blank and invisible foldings; look-alike foldings; the pattern of segments to normalize."""
    fold: dict[int, str] = {}
    quick_no = set()
    # every code point but ideographs, hangul syllables, surrogates, private use and the planes that hold no characters: these are stable
    for cp in (*range(0x80, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x17000), *range(0x1AFF0, 0x20000), *range(0xE0000, 0xE1000)):
        ch = chr(cp)
        if _ideograph(cp):
            continue
        if is_invisible(ch) or is_blank(ch):
            fold[cp] = ""
            continue
        tag, _, rest = unicodedata.decomposition(ch).partition(" ")
        if tag in ("<wide>", "<narrow>", "<font>") or tag == "<compat>" and 0x2E80 <= cp <= 0x2FDF:
            fold[cp] = "".join(chr(int(x, 16)) for x in rest.split())
        elif not unicodedata.is_normalized("NFC", ch) or unicodedata.combining(ch):
            quick_no.add(cp)
    for cp in (*range(0x21), 0x7F):
        fold[cp] = ""
    fold |= {ord(k): v for k, v in RADICALS.items()}
    fold[0x309B], fold[0x309C] = "゙", "゚"
    same = {ord(x): group[0] for group in ALIKE for x in group[1:]}
    unstable = sorted(fold.keys() | quick_no | set(range(0x1161, 0x1200)))
    parts, start = [], None
    for a, b in zip(unstable, [*unstable[1:], None]):
        start = a if start is None else start
        if b != a + 1:
            parts.append(f"\\U{start:08x}-\\U{a:08x}")
            start = None
    cls = "".join(parts)
    return fold, same, re.compile(f"[^{cls}]?[{cls}]+")


def _normalize(segment: re.Match) -> str:
    fold = tables()[0]
    out = unicodedata.normalize("NFC", segment.group().translate(fold)) if not any(_ideograph(ord(c)) for c in segment.group()) else None
    if out is not None:
        return out
    # a compatibility ideograph as context would be replaced by its variant; it never composes, so it is set aside
    head, tail = segment.group()[:1], segment.group()[1:]
    return head + unicodedata.normalize("NFC", tail.translate(fold))


def canonical(text: str | None) -> str | None:
    if text is None:
        return None
    return tables()[2].sub(_normalize, text)


def skeleton(text: str | None) -> str | None:
    """Canonical text taken apart into letters and marks, look-alike letters folded: equal exactly for texts that look the same."""
    if text is None:
        return None
    same = tables()[1]
    out = canonical(text)
    if not out.isascii():
        out = "".join(c if _ideograph(ord(c)) else unicodedata.normalize("NFD", c) for c in out) if any(_ideograph(ord(c)) for c in out) else unicodedata.normalize("NFD", out)
    return out.translate(same)


def _mapped(fn, c: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(fn, na_action="ignore")

    return run(c)


def canonical_col(c: Column) -> Column:
    return _mapped(canonical, c)


def skeleton_col(c: Column) -> Column:
    return _mapped(skeleton, c)


def values(boundary: DataFrame, area_counts: DataFrame) -> DataFrame:
    """``src``, ``row_id``, ``city``, ``value`` of both tables."""
    return boundary.select(F.lit("boundary").alias("src"), F.col("rec_no").alias("row_id"), F.col("city_code").alias("city"), F.col("s_name").alias("value")).unionByName(
        area_counts.select(F.lit("area_counts").alias("src"), F.col("count_id").alias("row_id"), F.col("city_code").alias("city"), F.col("key").alias("value"))
    )


def spellings(areas: DataFrame) -> DataFrame:
    """``a_city``, ``form``, ``area_id``: name and key of every area, one row per form (the lowest area of a city counts)."""
    forms = areas.select(F.col("city_code").alias("a_city"), F.explode(F.array("name", "key")).alias("form"), "area_id").where(F.col("form").isNotNull())
    return forms.groupBy("a_city", "form").agg(F.min("area_id").alias("area_id"))


def lookalikes(boundary: DataFrame, area_counts: DataFrame, areas: DataFrame) -> DataFrame:
    """``src``, ``row_id``, ``area_id`` of values that look like an area's name or key of their city but are neither.

    Values that are a name or key as they stand leave in the JVM; only the others reach Python, nothing is shuffled while the
    reference list is small enough to broadcast."""
    forms = spellings(areas)
    other = values(boundary, area_counts).where(F.col("value").isNotNull()).join(broadcast_if_small(forms), (F.col("city") == F.col("a_city")) & (F.col("value") == F.col("form")), "left_anti")
    shapes = forms.select("a_city", skeleton_col(F.col("form")).alias("shape"), "area_id").groupBy("a_city", "shape").agg(F.min("area_id").alias("area_id")).where(F.col("shape") != "")
    shaped = other.select("src", "row_id", "city", skeleton_col(F.col("value")).alias("v_shape"))
    return shaped.join(broadcast_if_small(shapes), (F.col("city") == F.col("a_city")) & (F.col("v_shape") == F.col("shape"))).select("src", "row_id", "area_id")


def one_form(boundary: DataFrame, area_counts: DataFrame, areas: DataFrame) -> DataFrame:
    """Every row in one form: ``src``, ``row_id``, ``form`` (the area's name where it looks like one, else canonical text), ``area_id``."""
    rows = values(boundary, area_counts)
    forms = spellings(areas).select("a_city", skeleton_col(F.col("form")).alias("shape"), "area_id").groupBy("a_city", "shape").agg(F.min("area_id").alias("area_id"))
    named = forms.join(areas.select("area_id", "name"), "area_id")
    shaped = rows.select("src", "row_id", "city", canonical_col(F.col("value")).alias("plain"), skeleton_col(F.col("value")).alias("v_shape"))
    return shaped.join(broadcast_if_small(named), (F.col("city") == F.col("a_city")) & (F.col("v_shape") == F.col("shape")), "left").select(
        "src", "row_id", F.coalesce("name", "plain").alias("form"), "area_id"
    )
