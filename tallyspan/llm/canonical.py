"""Free-entered values mapped to the closest entry of a reference list, unmatched values reported.

Reference entries and values are taken apart into a name and a block number; names are compared under the unrestricted
Damerau-Levenshtein distance, a true metric, so a BK-tree per city with triangle-inequality pruning returns every entry within the
threshold. The closest entry wins if it is alone; ties and block numbers that are not listed win nothing. Names can also be typed by
their reading, in kana or in Latin letters: each script has a tree of its own.

A reference list that a bounded count proves small travels to the workers once, its trees are built once per process, and nothing is shuffled.
A larger one is sharded: every shard holds a part of a city's entries, every distinct value meets every shard of its city, each shard names
its winners, and the winners of a value are merged. Both sides of a shard are bounded, whatever one city holds.

Defined results: null values and values of white-space only are not rows; a value that names no area has 0; so has one whose city is
null or not in the list; null names of the reference are skipped; repeated values are mapped one by one; names and values may be of any
length (the distance is cut off where it can decide nothing); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.lookalike import canonical as one_width
from tallyspan.llm.lookalike import skeleton
from tallyspan.session import broadcast_if_small, left_join_dimension

#: Names of fewer characters than this may differ by one edit, others by two; of readings twice as many.
SHORT = 4
#: Reference lists up to this size travel to the workers.
MOST_ENTRIES = 50_000
#: Entries in a shard of a larger one, and distinct values that meet it in one task.
SHARD_ENTRIES, GROUP_VALUES = 20_000, 50_000

#: Older or simplified forms and kana that stand for each other in place names (fixed values).
VARIANTS = str.maketrans(
    "國濱澤櫻邊邉廣嶋嶌臺櫁渕淵齋齊髙﨑瀨鷗檜藪埜冨榮圓壽龍瀧靜驛條縣區關眞惠德增彌與澁實寶畠驒籠嵜鐵權禮乗舘",
    "国浜沢桜辺辺広島島台樒淵淵斎斉高崎瀬鴎桧薮野富栄円寿竜滝静駅条県区関真恵徳増弥与渋実宝畑騨篭崎鉄権礼乗館",
)
KANJI_DIGITS = {c: i for i, c in enumerate("〇一二三四五六七八九")}
NUMBER = r"(?:\d{1,3}|[一二三四五六七八九十]{1,3})"
#: Words and marks behind a name that say where near it something is (fixed values).
NEAR_WORDS = ("付近", "周辺", "近辺", "界隈", "先路上", "路上", "地先", "地内", "先", "あたり", "辺り", "の一部", "公園横", "公園前", "駅前", "(旧)", "(旧", "旧)", "旧")
NEAR_MARKS = "*＊?？!！。、,.・※~〜"
BLOCK = re.compile(
    rf"\A(?P<base>.+?)(?:第?(?P<n>{NUMBER})(?:丁目|丁|ちょうめ|チョウメ|町目|-?chome)(?P<rest>.*)|\((?P<p>\d{{1,3}})\)|(?P<a>\d{{1,4}})-(?P<b>\d{{0,5}})(?:-(?P<c>\d{{0,5}}))?|(?P<q>\d{{1,3}}))\Z", re.I | re.S
)
#: Name and number changed places by one character: a slip of one edit.
SWAPPED = re.compile(rf"\A(?P<base>.+?)(?P<n>\d{{1,2}}|[一二三四五六七八九十]{{1,2}})(?P<c>[^\d一二三四五六七八九十])丁目?(?P<rest>.*)\Z", re.S)
LOT = re.compile(r"\A(?P<base>.*?[^\d-])(?P<lot>\d{1,4}番(?:地)?(?:の?\d{1,4})?(?:号)?(?:の?\d{1,4})?)\Z", re.S)
AFTER_BLOCK = re.compile(r"(?:\d{1,5}(?:番地?|-\d{1,5}|号)?(?:の?\d{1,5})?号?|-?\d{1,5}(?:-\d{1,5})*)?\Z")

_ROMA = {
    "きゃ": "kya", "きゅ": "kyu", "きょ": "kyo", "しゃ": "sha", "しゅ": "shu", "しょ": "sho", "ちゃ": "cha", "ちゅ": "chu", "ちょ": "cho", "にゃ": "nya", "にゅ": "nyu", "にょ": "nyo",
    "ひゃ": "hya", "ひゅ": "hyu", "ひょ": "hyo", "みゃ": "mya", "みゅ": "myu", "みょ": "myo", "りゃ": "rya", "りゅ": "ryu", "りょ": "ryo", "ぎゃ": "gya", "ぎゅ": "gyu", "ぎょ": "gyo",
    "じゃ": "ja", "じゅ": "ju", "じょ": "jo", "びゃ": "bya", "びゅ": "byu", "びょ": "byo", "ぴゃ": "pya", "ぴゅ": "pyu", "ぴょ": "pyo", "てぃ": "ti", "でぃ": "di", "ふぁ": "fa", "ふぃ": "fi", "ふぇ": "fe", "ふぉ": "fo",
    "し": "shi", "ち": "chi", "つ": "tsu", "ふ": "fu", "じ": "ji", "ぢ": "ji", "づ": "zu", "ん": "n", "を": "o", "ー": "",
}
for _row, _c in (("あいうえお", ""), ("かきくけこ", "k"), ("さしすせそ", "s"), ("たちつてと", "t"), ("なにぬねの", "n"), ("はひふへほ", "h"), ("まみむめも", "m"), ("らりるれろ", "r"), ("がぎぐげご", "g"), ("ざじずぜぞ", "z"), ("だぢづでど", "d"), ("ばびぶべぼ", "b"), ("ぱぴぷぺぽ", "p")):
    for _k, _v in zip(_row, "aiueo"):
        _ROMA.setdefault(_k, _c + _v)
_ROMA |= {"や": "ya", "ゆ": "yu", "よ": "yo", "わ": "wa"}


def hiragana(s: str) -> str:
    return "".join(chr(ord(c) - 0x60) if "ァ" <= c <= "ヶ" else c for c in s)


def romaji(kana: str) -> str:
    """Latin spelling of hiragana, long vowels folded."""
    out, i, double = [], 0, False
    while i < len(kana):
        if kana[i] == "っ":
            double, i = True, i + 1
            continue
        two = kana[i : i + 2]
        got, n = (_ROMA[two], 2) if two in _ROMA else (_ROMA.get(kana[i], kana[i]), 1)
        out.append((got[:1] if double else "") + got)
        double, i = False, i + n
    return short_vowels("".join(out))


def short_vowels(s: str) -> str:
    return re.sub(r"(?<=[aiueo])h(?![aiueoy])", "", re.sub(r"([aiueo])\1+", r"\1", s.replace("ou", "o").translate(str.maketrans("āīūēōâîûêô", "aiueoaiueo")).replace("mb", "nb").replace("mp", "np")))


def kanji_number(s: str) -> int | None:
    """1 to 99 in ASCII or kanji digits."""
    if s.isascii():
        return int(s) if s.isdigit() else None
    tens, ten, ones = s.rpartition("十")
    if not ten:
        return int("".join(str(KANJI_DIGITS[c]) for c in s))
    if len(tens) > 1 or len(ones) > 1:
        return None
    return (KANJI_DIGITS[tens] if tens else 1) * 10 + (KANJI_DIGITS[ones] if ones else 0)


def script(base: str) -> str:
    if any("㐀" <= c <= "鿿" or "豈" <= c <= "﫿" for c in base):
        return "kanji"
    if any("ぁ" <= c <= "ヿ" for c in base):
        return "kana"
    return "latin"


def fold(base: str, kind: str) -> str:
    """Name in the form that is compared."""
    if kind == "kana":
        return hiragana(base).replace("-", "").replace("ヶ", "け")
    if kind == "latin":
        return short_vowels(re.sub(r"[^a-z]", "", unicodedata.normalize("NFKD", base).lower()))
    s = base.translate(VARIANTS)
    s = re.sub(r"(?<=[㐀-鿿])[のノ之乃](?=[㐀-鿿])", "ノ", s)
    s = re.sub(r"(?<=[㐀-鿿])[ケヶヵがガカか](?=[㐀-鿿])", "ケ", s)
    s = s.replace("ッ", "ツ") if not re.search(r"[ァ-ヺ]ッ", s) else s
    return re.sub(r"[À-ɏ]", lambda m: unicodedata.normalize("NFD", m.group())[0], unicodedata.normalize("NFKC", s)).lower()


def tidy(value: str) -> str:
    """One width, no blanks or invisible characters, dashes as hyphens."""
    s = unicodedata.normalize("NFKC", one_width(value))
    s = re.sub(r"(?<=[0-9])[-‐‑‒–—―−ーｰ](?=[0-9]|\Z)", "-", s)
    return s


def bare(s: str, least: str | None = None) -> str:
    """``s`` without the remarks behind it; a text of nothing but remarks stays as the last of them, or becomes ``least``."""
    while True:
        cut = s.rstrip(NEAR_MARKS)
        if cut == s and s[-1:] in (")", "）") and (at := max(s.rfind("(", 0, -1), s.rfind("（", 0, -1))) >= 0 and not any(c in "()（）0123456789" for c in s[at + 1 : -1]):
            cut = s[:at]
        if cut == s and (word := next((w for w in NEAR_WORDS if s.endswith(w)), None)):
            cut = s[: -len(word)]
        if cut == s:
            return s
        if not cut:
            return s if least is None else least
        s = cut


def take_apart(s: str) -> tuple[str, list[int | None]]:
    """Name and the block numbers it may mean, likeliest first (null: none; lot numbers are no block)."""
    s = bare(s)
    m = BLOCK.match(s)
    if (not m or not m["n"]) and (lot := LOT.match(s)):
        return lot["base"], [None]
    if not m:
        return s, [None]
    if m["n"]:
        rest = bare(m["rest"], "")
        n = kanji_number(m["n"])
        if not AFTER_BLOCK.match(rest) or n is None:
            return s, [None]
        return m["base"].rstrip("-"), [n]
    if m["p"] or m["q"]:
        return m["base"], [int(m["p"] or m["q"])]
    if m["c"] is not None or not m["b"]:
        return m["base"], [int(m["a"])]
    return m["base"], [None, int(m["a"])]


def distance(a: str, b: str, most: int) -> int:
    """Unrestricted Damerau-Levenshtein distance; anything above ``most`` comes back as ``most + 1`` at least. Only a band of ``most`` cells around
    the diagonal is worked out: what leaves it costs more."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    if abs(la - lb) > most:
        return abs(la - lb)
    big = la + lb
    last: dict[str, int] = {}
    d = [[big] * (lb + 2) for _ in range(la + 2)]
    for i in range(min(la, most) + 1):
        d[i + 1][1] = i
    for j in range(min(lb, most) + 1):
        d[1][j + 1] = j
    for i in range(1, la + 1):
        seen, ch = 0, a[i - 1]
        up, row = d[i], d[i + 1]
        for j in range(max(1, i - most), min(lb, i + most) + 1):
            k, m = last.get(b[j - 1], 0), seen
            if ch == b[j - 1]:
                cost, seen = 0, j
            else:
                cost = 1
            row[j + 1] = min(up[j] + cost, row[j] + 1, up[j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[ch] = i
    return d[la + 1][lb + 1] if d[la + 1][lb + 1] <= most else max(d[la + 1][lb + 1], most + 1)


class BKTree:
    """Metric tree over strings; children are filed by their exact distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[str, dict] | None = None

    def add(self, word: str) -> None:
        if self.root is None:
            self.root = (word, {})
            return
        node = self.root
        while (d := distance(word, node[0], len(word) + len(node[0]))) != 0:
            if d not in node[1]:
                node[1][d] = (word, {})
                return
            node = node[1][d]

    def near(self, word: str, most: int) -> list[tuple[int, str]]:
        """Every entry within ``most``, by the triangle inequality without looking at most of the others."""
        out, todo = [], [self.root] if self.root else []
        while todo:
            w, kids = todo.pop()
            cutoff = max(kids, default=0) + most  # from here on neither the node nor any child can be within reach
            d = distance(word, w, cutoff)
            if d > cutoff:
                continue
            if d <= most:
                out.append((d, w))
            todo += [kids[k] for k in range(max(1, d - most), d + most + 1) if k in kids] if len(kids) > 2 * most else [n for k, n in kids.items() if d - most <= k <= d + most]
        return out


class City:
    """The areas of one city: per script a tree of names, and what each name stands for by block number."""

    def __init__(self, rows: list[tuple]):
        self.trees: dict[str, BKTree] = {}
        self.areas: dict[tuple[str, str], dict[int | None, set[int]]] = {}
        self.exact: dict[str, set[int]] = {}
        self.titles: set[str] = set()
        for area, city_name, pref, name, key, yomi in rows:
            self.titles |= {x for x in (city_name, pref) if x}
            for form in (name, key):
                if form:
                    self.exact.setdefault(skeleton(form), set()).add(area)
            for text in (name, yomi):
                if text:
                    base, blocks = take_apart(tidy(text))
                    kinds = ["kanji"] if text is name else ["kana", "latin"]
                    for kind in kinds:
                        word = fold(base, "kana") if kind == "latin" else fold(base, kind)
                        word = romaji(word) if kind == "latin" else word
                        self._file(kind, word, blocks[0], area)
                        short = re.sub(r"\A(?:大字|字|おおあざ|oaza)", "", word)
                        if short != word:
                            self._file(kind, short, blocks[0], area)
        self.strip = re.compile(r"\A[(]?(?:" + "|".join(map(re.escape, sorted((tidy(t) for t in self.titles), key=len, reverse=True))) + r")[)]?") if self.titles else None

    def _file(self, kind: str, word: str, block: int | None, area: int) -> None:
        if word:
            self.trees.setdefault(kind, BKTree()).add(word)
            self.areas.setdefault((kind, word), {}).setdefault(block, set()).add(area)

    def winners(self, value: str) -> list[tuple[int, int, str]]:
        """(distance, area, compared name if it is two edits off) of every area that ``value`` may mean within the threshold, for merging with other shards."""
        same = self.exact.get(skeleton(value))
        if same:
            return [(-1, a, "") for a in same]
        s = tidy(value)
        seen = {s: 0}
        while True:  # prefecture, then city
            cut = self.strip.sub("", s) if self.strip else s
            if cut == s or not cut:
                break
            s = cut
            seen[s] = 0
        readings = [(*take_apart(text), 0) for text in seen]
        if m := SWAPPED.match(s):
            n = kanji_number(m["n"])
            readings += [(m["base"] + m["c"], [n], 1)] if n is not None else []
        best: dict[int, tuple[int, str]] = {}
        for base, blocks, slip in readings:
            if not base:
                continue
            kind = script(base)
            word = fold(base, kind)
            if not word:
                continue
            short = SHORT if kind == "kanji" else 2 * SHORT
            if (kind, word) in self.areas:
                words = [(0, word)]
            else:
                tree = self.trees.get(kind)
                near = tree.near(word, 2 - slip) if tree else []
                words = [(d, w) for d, w in near if d <= (1 if max(len(word), len(w)) < short else 2) - slip]
            for d, w in words:
                by_block = self.areas[kind, w]
                for b in blocks:
                    if b in by_block:
                        for a in by_block[b]:
                            best[a] = min((d + slip, word if d > 1 else ""), best.get(a, (9, "")))
                        break
        return [(d, a, w) for a, (d, w) in best.items()]


def decide(winners: list[tuple[int, int, str]], names: set[str]) -> int:
    """The area of the least distance if it is alone, else 0. A name that stands in the list for another city is no double slip."""
    if not winners:
        return 0
    least = min(d for d, *_ in winners)
    closest = {a: w for d, a, w in winners if d == least}
    return next(iter(closest)) if len(closest) == 1 and not names.intersection(closest.values()) else 0


def base_names(name: str) -> list[str]:
    """Compared forms of a reference name."""
    word = fold(take_apart(tidy(name))[0], "kanji")
    return list({word, re.sub(r"\A(?:大字|字)", "", word)})


COLUMNS = ["area_id", "city_name", "pref", "name", "key", "yomi"]


def wanted(entries: DataFrame, areas: DataFrame) -> DataFrame:
    """``entry_id``, ``city``, ``value`` of the entries to map: neither blank nor, as they stand, a name of their city."""
    from tallyspan.functions.text import is_blank

    rows = entries.where(~is_blank(F.col("s_name"))).select("entry_id", F.substring("city_code", 1, 5).alias("city"), F.col("s_name").alias("value"))
    names = areas.select(F.col("city_code").alias("a_city"), F.col("name").alias("a_name")).distinct()
    return rows.join(broadcast_if_small(names), (F.col("city") == F.col("a_city")) & (F.col("value") == F.col("a_name")), "left_anti")


_built: dict[str, tuple[dict, dict]] = {}


def _trees(key: str) -> tuple[dict[str, City], dict[tuple[str, str], int]]:
    """Cities and answers of one reference list, kept once per Python process."""
    if key not in _built:
        _built.clear()
        _built[key] = ({}, {})
    return _built[key]


def map_values(entries: DataFrame, areas: DataFrame, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """``entry_id``, ``area_id`` (0: none) of every entry that needs mapping."""
    rows = wanted(entries, areas)
    head = areas.select("city_code", *COLUMNS).limit(most_entries + 1).collect()
    if len(head) > most_entries:
        return merge(shard_winners(rows, areas), rows, areas)
    names = {w for r in head if r.name for w in base_names(r.name)}
    by_city: dict[str, list[tuple]] = {}
    for r in sorted(head, key=lambda r: r.area_id):
        by_city.setdefault(r.city_code, []).append(tuple(r)[1:])
    sent = entries.sparkSession.sparkContext.broadcast((by_city, names))
    key = hashlib.sha256(repr(sorted(map(repr, head))).encode()).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        listed, known = sent.value
        cities, memo = _trees(key)
        for pdf in batches:
            got = []
            for city, value in zip(pdf.city, pdf.value):
                if (city, value) not in memo:
                    if city in listed and city not in cities:
                        cities[city] = City(listed[city])
                    if len(memo) > 500_000:
                        memo.clear()
                    memo[city, value] = decide(cities[city].winners(value), known) if city in cities else 0
                got.append(memo[city, value])
            yield pd.DataFrame({"entry_id": pdf.entry_id, "area_id": pd.array(got, dtype="int64")})

    return rows.mapInPandas(run, "entry_id bigint, area_id bigint")


def shard_winners(rows: DataFrame, areas: DataFrame, shard_entries: int = SHARD_ENTRIES, group_values: int = GROUP_VALUES) -> DataFrame:
    """For a large reference list: ``city``, ``value``, ``distance``, ``area_id``, ``word`` of the winners of every distinct value in every shard of its
    city's list. A city of many entries has several shards, one of many values several groups for each."""
    values = rows.where("city IS NOT NULL").select("city", "value").distinct()
    parts = lambda most: F.ceil(F.count("*") / most).cast("int")
    shards = areas.where("city_code IS NOT NULL").groupBy(F.col("city_code").alias("city")).agg(parts(shard_entries).alias("shards"))
    sizes = broadcast_if_small(shards.join(values.groupBy("city").agg(parts(group_values).alias("groups")), "city"))
    left = values.join(sizes, "city").select("city", "value", F.pmod(F.xxhash64("value"), F.col("groups")).cast("int").alias("grp"), F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    right = areas.withColumnRenamed("city_code", "city").join(sizes, "city").select("city", *COLUMNS, F.pmod(F.xxhash64("area_id"), F.col("shards")).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("grp"))

    def run(mine: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        city = City(sorted(listed[COLUMNS].astype(object).where(listed[COLUMNS].notna(), None).itertuples(index=False, name=None), key=lambda r: r[0])) if len(listed) else None
        out = [(c, v, *w) for c, v in zip(mine.city, mine.value) for w in (city.winners(v) if city else [])]
        return pd.DataFrame(out, columns=["city", "value", "distance", "area_id", "word"]).astype({"distance": "int32", "area_id": "int64"})

    by = ["city", "shard", "grp"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(run, "city string, value string, distance int, area_id bigint, word string")


def merge(winners: DataFrame, rows: DataFrame, areas: DataFrame) -> DataFrame:
    """Winners of all shards merged: the closest area if it is alone and not named like one of another city, else 0."""

    @F.pandas_udf("array<string>")
    def forms(s: pd.Series) -> pd.Series:
        return s.map(base_names, na_action="ignore")

    listed = areas.where("name IS NOT NULL").select(F.explode(forms("name")).alias("word")).distinct().withColumn("listed", F.lit(True))
    flagged = winners.join(listed, "word", "left")
    best = (
        flagged.groupBy("city", "value", "distance")
        .agg(F.min("area_id").alias("area_id"), F.count_distinct("area_id").alias("n"), F.max("listed").alias("listed"))
        .groupBy("city", "value")
        .agg(F.min_by(F.struct("area_id", "n", "listed"), "distance").alias("w"))
        .where("w.n = 1 AND w.listed IS NULL")
        .select("city", "value", F.col("w.area_id").alias("area_id"))
    )
    return left_join_dimension(rows, best, ["city", "value"], F.col("entry_id")).select("entry_id", F.coalesce("area_id", F.lit(0)).cast("bigint").alias("area_id"))


def mapped(entries: DataFrame, areas: DataFrame) -> DataFrame:
    """Every mapped entry with the canonical name and its codes: ``entry_id``, ``s_name``, ``area_id``, ``name``, ``key_codes``."""

    found = map_values(entries, areas).where("area_id > 0")
    return found.join(broadcast_if_small(areas.select("area_id", "name", "key_codes")), "area_id").join(entries.select("entry_id", "s_name"), "entry_id").select("entry_id", "s_name", "area_id", "name", "key_codes")


def unmatched(entries: DataFrame, areas: DataFrame) -> DataFrame:
    """Report of values that name no area: city, value, number of entries."""
    return (
        map_values(entries, areas).where("area_id = 0").join(entries.select("entry_id", F.substring("city_code", 1, 5).alias("city"), "s_name"), "entry_id").groupBy("city", "s_name").agg(F.count("*").alias("n_entries"))
    )
