"""Text decoded with the wrong character encoding: find it, and restore what still can be restored.

Characters of a suspicious run are mapped back to the bytes of the encoding they were wrongly read in. A byte-structure automaton of
the right encoding finds maximal well-formed multibyte spans in these bytes; only those spans are decoded and spliced back in. A
span counts if what it decodes to is plausible (characters in ordinary use here) while what stood there was not. Bytes that the
wrong decoder lost leave truncated sequences: they count if a character completing them forms a known pair with its neighbour.

Signs that no correct text has (replacement character, C1 controls, private-use characters) make a row a case by themselves, also
where nothing can be restored. Correct text in rare or foreign characters, in half-width kana or with variant kanji is no case.

Defined results: null or empty text is no case and stays; very long texts are handled in one linear pass per encoding pair; repeated
texts are judged once per batch; text read wrongly several times is undone until nothing changes; extra columns are ignored.

Text of nothing but ordinary characters is recognised by one table in the JVM and never reaches Python.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SINGLE = ["cp1252", "mac_roman", "cp437"]
DOUBLE = ["cp932", "gbk", "euc_jp", "big5", "euc_kr"]
#: Which right encodings are tried for text wrongly read as the key.
READ_AS = {
    **{w: ["utf-8", "euc_jp", "cp932"] for w in SINGLE},
    "cp932": ["utf-8", "euc_jp"], "gbk": ["utf-8"], "euc_jp": ["utf-8", "cp932"], "big5": ["utf-8"], "euc_kr": ["utf-8"],
}
MARKS = re.compile("[�\x80-\x9f-]")
ESCAPED = re.compile(r"\x1b?\$[B@]((?:[!-~]{2})+?)(?:\x1b?\([BJ]|\Z)")
KANA_WORD = re.compile(r"(?:[ｦｱ-ﾝ](?:ﾞ|ﾟ)?(?:[ｬｭｮｧｨｩｪｫ](?:ﾞ|ﾟ)?)?[ｯｰ]?|[ｰ])+")


@cache
def ordinary() -> frozenset[str]:
    """Characters in ordinary use: ASCII, kana, full-width forms, common punctuation, first-level kanji."""
    kanji = [bytes((hi, lo)).decode("cp932", "ignore") for hi in range(0x88, 0x99) for lo in range(0x40, 0xFD) if (hi, lo) >= (0x88, 0x9F) and (hi, lo) <= (0x98, 0x72) and lo != 0x7F]
    spans = [(0x20, 0x7F), (0x3041, 0x3097), (0x30A1, 0x30FB), (0x30FC, 0x30FF), (0xFF01, 0xFF5F), (0x3000, 0x3003), (0x3005, 0x3012)]
    return frozenset("\t\r\n・々仝ヶ") | {c for c in kanji if len(c) == 1} | {chr(x) for a, b in spans for x in range(a, b)}


@cache
def _to_bytes(wrong: str) -> dict[str, bytes]:
    """Characters of a wrongly used single-byte encoding and the bytes they stand for; C1 controls fill what cp1252 leaves open."""
    out = {bytes((b,)).decode(wrong, "ignore"): bytes((b,)) for b in range(256)}
    if wrong == "cp1252":
        out |= {chr(b): bytes((b,)) for b in range(0x80, 0x100) if chr(b) not in out}
    out.pop("", None)
    return out


#: Bytes that common cp932 decoders map to single characters of their own.
CP932_EXTRA = {"": b"\xa0", "": b"\xfd", "": b"\xfe", "": b"\xff", "\x80": b"\x80", "\xa0": b"\xa0"}


@lru_cache(maxsize=1 << 16)
def _char_bytes(ch: str, wrong: str) -> bytes | None:
    if wrong in SINGLE:
        return _to_bytes(wrong).get(ch)
    if wrong == "cp932" and "" <= ch <= "":
        n = ord(ch) - 0xE000
        hi, lo = divmod(n, 188)
        return bytes((0xF0 + hi, lo + (0x40 if lo < 63 else 0x41)))
    if wrong == "cp932" and ch in CP932_EXTRA:
        return CP932_EXTRA[ch]
    try:
        got = ch.encode(wrong)
    except UnicodeEncodeError:
        return None
    return got if len(got) < 3 else None


#: One well-formed multibyte character of each right encoding.
STRUCTURE = {
    "utf-8": re.compile(rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}"),
    "euc_jp": re.compile(rb"[\xa1-\xa8\xad\xb0-\xf4][\xa1-\xfe]"),
    "cp932": re.compile(rb"(?:[\x81-\x84\x87-\x9f\xe0-\xea\xed\xee\xfa-\xfc][\x40-\x7e\x80-\xfc])"),
}


class Restorer:
    """``native``: further ordinary characters; ``known``: reference texts whose pairs of characters decide doubtful spans."""

    def __init__(self, native: str = "", known: tuple[str, ...] = ()):
        self.plain = ordinary() | frozenset(native) | frozenset("".join(known))
        self.pairs = frozenset(k[i : i + 2] for k in known for i in range(len(k) - 1))
        body = "".join(re.escape(c) for c in sorted(self.plain))
        self.all_plain = re.compile(f"[{body}ｦ-ﾟ]*")
        self.fast = re.compile(f"[{body}]*")
        self.by_prefix: dict[bytes, list[str]] = {}
        for c in sorted({c for k in known for c in k}):
            b = c.encode()
            if len(b) == 3:
                self.by_prefix.setdefault(b[:2], []).append(c)
        self.memo: dict[str, tuple[str | None, bool]] = {}

    def __call__(self, text: str) -> tuple[str | None, bool]:
        """Restored text (null: nothing could be restored) and whether the text is a case."""
        if text not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            self.memo[text] = self._judge(text)
        return self.memo[text]

    def _judge(self, text: str) -> tuple[str | None, bool]:
        now, seen = text, {text}
        while (after := self._once(now)) not in seen:
            seen.add(after)
            now = after
        case = now != text or bool(MARKS.search(text)) or self._cut_off(text)
        return (now if now != text else None), case

    def _once(self, text: str) -> str:
        out = ESCAPED.sub(self._escaped, text)
        if out != text or self.fast.fullmatch(text):
            return out
        best, gain = text, 0
        for wrong, rights in READ_AS.items():
            for right in rights:
                got, n = self._pair(text, wrong, right)
                if n > gain:
                    best, gain = got, n
        return best

    def _escaped(self, m: re.Match) -> str:
        try:
            got = (b"\x1b$B" + m.group(1).encode("ascii") + b"\x1b(B").decode("iso2022_jp")
        except UnicodeDecodeError:
            return m.group()
        return got if all(c in self.plain for c in got) else m.group()

    def _pair(self, text: str, wrong: str, right: str) -> tuple[str, int]:
        """``text`` with the spans decoded that were ``right`` but read as ``wrong``; how many strange characters went."""
        pieces, run, gain, i, n = [], [], 0, 0, len(text)
        while i <= n:
            b = _char_bytes(text[i], wrong) if i < n else None
            if b is not None and (b[0] >= 0x80 or right == "cp932" and b[0] >= 0x40):
                run.append((text[i], b))
            else:
                if run:
                    got, k = self._run(run, wrong, right, text[: i - len(run)][-1:], text[i : i + 1])
                    pieces.append(got)
                    gain += k
                    run = []
                if i < n:
                    pieces.append(text[i])
            i += 1
        return "".join(pieces), gain

    def _run(self, run: list[tuple[str, bytes]], wrong: str, right: str, before: str, after: str) -> tuple[str, int]:
        data = b"".join(b for _, b in run)
        starts, at = {}, 0
        for k, (_, b) in enumerate(run):
            starts[at] = k
            at += len(b)
        starts[at] = len(run)
        one = STRUCTURE[right]
        latin_too = wrong in SINGLE and right == "utf-8"
        out, gain, done, pos = [], 0, 0, 0
        while pos < len(data):
            # a maximal chain of well-formed characters that are plausible here
            chain, at = [], pos
            while m := one.match(data, at):
                ch = m.group().decode(right, "ignore")
                if ch not in self.plain and not (latin_too and ch and ("\x80" <= ch <= "\xff" or "\u2010" <= ch <= "\u2027")):
                    break
                chain.append((at, m.end(), ch))
                at = m.end()
            pos = max(at, pos + 1)
            # whole characters only: a rare one may be cut by the end of the chain (its rest was lost), an ordinary one may not
            while chain and chain[0][0] not in starts:
                chain.pop(0)
            while chain and (end := chain[-1][1]) not in starts and run[self._inside(starts, end)][0] in self.plain:
                chain.pop()
            if not chain or starts[chain[0][0]] < done:
                continue
            begin, end = chain[0][0], chain[-1][1]
            a = starts[begin]
            b = starts[end] if end in starts else self._inside(starts, end) + 1
            old, new = "".join(c for c, _ in run[a:b]), "".join(c for *_, c in chain)
            prev = run[a - 1][0] if a else before
            nxt = run[b][0] if b < len(run) else after
            if self._accept(old, new, wrong, right, data[begin:end], prev, nxt):
                out.append("".join(c for c, _ in run[done:a]) + new)
                gain += sum(c not in self.plain for c in old) or len(old)
                done = b
        out.append("".join(c for c, _ in run[done:]))
        return "".join(out), gain

    @staticmethod
    def _inside(starts: dict[int, int], at: int) -> int:
        """Number of the character of the run that holds byte ``at`` in its middle."""
        while at not in starts:
            at -= 1
        return starts[at]

    def _accept(self, old: str, new: str, wrong: str, right: str, data: bytes, prev: str, nxt: str) -> bool:
        strange = sum(c not in self.plain and not c.isspace() and not "｡" <= c <= "ﾟ" and unicodedata.category(c) != "Cf" for c in old)
        joins = any((prev + new + nxt)[i : i + 2] in self.pairs for i in range(len(prev + new + nxt) - 1))
        fits = all(c in self.plain for c in new)
        if wrong in SINGLE:
            if right == "utf-8":
                latin = all(c in self.plain or "\x80" <= c <= "ӿ" or " " <= c <= "⁯" for c in new)
                return strange > 0 and (fits or latin)
            high = sum(b >= 0x80 for b in data)
            if not fits or not strange or high < 0.6 * len(data):
                return False
            if len(new) > 1:
                return True
            return joins or high == len(data) and not (prev.isascii() and prev.isalpha() or nxt.isascii() and nxt.isalpha())
        if not fits or not any(c >= "⺀" for c in old):
            return False
        if strange == 0:
            if right == "euc_jp" and all("｡" <= c <= "ﾟ" for c in old):  # half-width kana, or pairs of bytes that look like it
                return joins and len(new) > 1 or not KANA_WORD.fullmatch(old)
            return False
        if right == "cp932" and len(new) < 3:  # one or two variant kanji happen to map to ordinary ones
            return False
        return 2 * (strange + sum("｡" <= c <= "ﾟ" for c in old)) >= len(old)

    def _cut_off(self, text: str) -> bool:
        """Rare characters that are the first two bytes of a known character whose last byte was lost."""
        if self.all_plain.fullmatch(text):
            return False
        for i, c in enumerate(text):
            if c in self.plain or c.isascii():
                continue
            for wrong in ("cp932", "gbk"):
                b = _char_bytes(c, wrong)
                for want in self.by_prefix.get(b or b"", ()):
                    nxt = text[i + 1 : i + 2]
                    follow = [nxt, *self.by_prefix.get(_char_bytes(nxt, wrong) or b"", ())] if nxt else []
                    if any(want + f in self.pairs for f in follow) or i and text[i - 1] + want in self.pairs:
                        return True
        return False


def judge_col(c: Column, native: str = "", known: tuple[str, ...] = ()) -> Column:
    """``struct<text, garbled>``: restored text (the original where nothing was restored) and whether ``c`` is a case."""
    cell: list[Restorer] = []

    @F.pandas_udf("struct<text string, garbled boolean>")
    def run(s: pd.Series) -> pd.DataFrame:
        if not cell:
            cell.append(Restorer(native, known))
        one = cell[0]
        got = {v: one(v) for v in s.dropna().unique()}
        return pd.DataFrame({"text": [None if not isinstance(v, str) else got[v][0] or v for v in s], "garbled": [isinstance(v, str) and got[v][1] for v in s]})

    return run(c)


#: Values of the charge column that stand for the known character pairs (fixed domain values).
CHARGES = ("窃盗", "窃盗（未遂）", "窃盗未遂（自転車）", "窃盗（部品ねらい）", "占有離脱物横領")


def texts(incidents: DataFrame, boundary: DataFrame) -> DataFrame:
    return incidents.select(F.lit("incidents").alias("src"), "row_id", F.col("罪名").alias("value")).unionByName(
        boundary.select(F.lit("boundary").alias("src"), F.col("rec_no").alias("row_id"), F.col("s_name").alias("value"))
    )


def known_pairs(areas: DataFrame) -> tuple[str, ...]:
    """Every character of the reference names with its neighbour, and names of one character. Distinct pairs are what is collected, all of them: their
    number is bounded by the alphabet, not by the list."""
    names = areas.select(F.explode(F.array("name", "key")).alias("x")).where("x <> ''")
    pairs = names.select(F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("x") - 1, F.lit(1))), lambda i: F.substring(F.col("x"), i, F.lit(2)))).alias("p"))
    return tuple(sorted(r.p for r in pairs.distinct().collect()))


def suspicious(c: Column, known: tuple[str, ...]) -> Column:
    """Whether ``c`` holds anything but ordinary and known characters, or what could be an escape sequence."""
    plain = "".join(sorted(ordinary() | frozenset("".join(known))))
    return (F.translate(c, plain, "") != "") | c.contains("$B") | c.contains("$@")


def judged(incidents: DataFrame, boundary: DataFrame, areas: DataFrame) -> DataFrame:
    """``src``, ``row_id``, ``value``, ``text``, ``garbled`` of every text that is not plainly in order; the town names of ``areas`` are known."""
    known = (*CHARGES, *known_pairs(areas))
    rows = texts(incidents, boundary).where(suspicious(F.col("value"), known))
    return rows.withColumn("j", judge_col(F.col("value"), known=known)).select("src", "row_id", "value", "j.text", "j.garbled")


def found(incidents: DataFrame, boundary: DataFrame, areas: DataFrame) -> DataFrame:
    return judged(incidents, boundary, areas).where("garbled").select("src", "row_id")


def restored(incidents: DataFrame, boundary: DataFrame, areas: DataFrame) -> DataFrame:
    """Every case with its original and restored text (null where nothing could be restored)."""
    return judged(incidents, boundary, areas).where("garbled").select("src", "row_id", "value", F.when(F.col("text") != F.col("value"), F.col("text")).alias("restored"))
