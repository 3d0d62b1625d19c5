"""Sentence boundaries across languages and scripts.

A pushdown automaton runs over each text. One stack holds open quotations and brackets (an opener without partner counts as text);
stops inside them end nothing, what follows a closed quotation decides whether it ends a sentence. Another holds the open list levels: a
line indented below an item's mark goes on with it. Line level comes first: blank lines, list marks, headings and lines that stand alone
cut blocks, line breaks of wrapped text do not. Stops are judged by a trie of
abbreviations, by the case and script of what follows, and by the terminators of each script; Thai ends sentences at spaces.

Offsets are code points; sentences have no white-space at either end and cover everything else.

Defined results: null or blank text has no sentence; repeated texts give equal rows for each id; very long text takes linear time
(each character is visited a bounded number of times); extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tallyspan.session import spread

OPEN = {"「": "」", "『": "』", "（": "）", "(": ")", "【": "】", "〈": "〉", "《": "》", "“": "”", "«": "»", "„": "“”", "｢": "｣", "[": "]", "［": "］", "〔": "〕", "‹": "›", "﹁": "﹂", "〝": "〟"}
CLOSE = set("」』）)】〉》”»｣]］〕›﹂〟")
QUOTES = set("「『“«„｢《‹﹁〝\"")
STOPS = "。｡．.！？!?…‥।॥؟۔"
FIRM = set("。｡।॥۔")
ASKING = set("！？!?؟")
SPECIAL = re.compile(r"[。｡．.！？!?…‥।॥؟۔「『（(【〈《“«„｢\[［〔‹﹁〝\"]|(?<=[฀-๿])\s+(?=[฀-๿])|(?<=[฀-๿]\.)\s+(?=[฀-๿])")
RUN = re.compile(r"[。｡．.！？!?…‥।॥؟۔]+(?:\s?[!?…]+(?=\s|\Z))?")
LEADING = re.compile(r"(?<=[。｡！？।॥؟۔．])[…‥]+\Z")
PAIRED = re.compile(r"[「」『』（）()【】〈〉《》“”«»„｢｣\[\]［］〔〕‹›﹁﹂〝〟\"]")
SAYS_AFTER = re.compile(r"と(?:いう|言|聞|問|思|叫|書|答|話|呼|の)|って")
WORD = re.compile(r"\S+")
ALNUM = re.compile(r"[^\W_]")
LIST_MARK = re.compile(r"\s*(?:[・‣•※■□●○◆◇▪▶►★☆◎→]|[-–—*+](?=\s)|[①-⑳❶-❿㈠-㈩]|\(\d{1,3}\)|（\d{1,3}）|（[一二三四五六七八九十]{1,3}）|\d{1,3}[.)](?=\s)|\d{1,3}[）、．](?![\d０-９])|[a-zA-Z]\)(?=\s)|[一二三四五六七八九十]{1,3}、|#{1,6}\s|【)")
KANA = re.compile(r"[぀-ヿｦ-ﾟ]")
CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿ｦ-ﾟ가-힣]")

#: Abbreviations that never end a sentence, and those that do if a sentence can begin after them (fixed values).
NEVER = """fr frl dr mr mrs ms prof sgt st no nos fig figs app vs cf e.g i.e approx ca vgl tab nr hr sr sra srta dra av pág pag págs núm num env art arts vol vols ver p pp
tr tp mme mlle messrs rev hon gen col lt capt cmdr gov sen rep ed eds ex bzw d.h z.b u.a s.o s.u inkl zzgl evtl ggf bspw abs aufl str tel ph.d cap ch sec sect eq
l'art n.o nº mt ft ud uds ths gs ts pgs bs ths fl op cit ibid viz al डॉ श्री सं प्रो कु पृ د ص أ م ดร อ จ ต ถ พ.ศ ค.ศ ร.ร โทร""".split()
MAYBE = """etc usw a.m p.m ltd co inc corp jr bros u.s u.k u.n jan feb mar apr jun jul aug sep sept oct nov dec mon tue tues wed thu thur thurs fri sat sun
aprox h hs est dept min max sec hr hrs approx'd enero gen févr janv juil déc ene abr ago dic usf etc""".split()
MONTH_LIKE = re.compile(r"(?:jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec|janv|févr|juil|déc|ene|abr|ago|dic)\Z")
AFTER_ORDINAL = re.compile(r"(?:Januar|Jänner|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Quartal|Jahrhundert|Halbjahr|Tag|Mal|Stock|Klasse|Auflage|Bezirk|Platz|Jh)\b")
#: Japanese after a quotation that goes on with its sentence.
GOES_ON = re.compile(
    r"(?:と(?!ころ|ても|にかく|りわけ|き|も[にか])|って|は(?!じめ|い、|っき)|が(?![、，])|を|の(?!ち)|に(?!わか)|へ|で(?!は[、，]|も[、，]|す)|も(?!し|う|ちろん|っと)|や(?!は|が)|から|まで|より|など|だ(?!が|から)|です|なる|なん(?:て|か)|ほか|等|[、，､,]|・)"
)
EXCHANGE = re.compile(r"[^。｡．！？]{0,12}(?:問答|やり取り|やりとり|会話|応酬|言い合|口々|次々|掛け合)")
SAYS_ZH = re.compile(r"[^，。！？；：“\n]{0,14}?(?:说道|说|道|问道|问|答道|答|喊道|喊|表示|写道|指出|回答)(?=[，。：！])")
SAYS_KO = re.compile(r"(?:이?라고|이?라는|이?라며|하고|고|라는|는|은|을|를|이|가|와|과)(?![가-힣]{3})")


class Trie:
    """Abbreviations read backwards from their period."""

    def __init__(self, words: list[str], tag: str):
        self.root: dict = {}
        for w in words:
            node = self.root
            for ch in reversed(w):
                node = node.setdefault(ch, {})
            node[""] = tag

    def add(self, words: list[str], tag: str) -> Trie:
        for w in words:
            node = self.root
            for ch in reversed(w):
                node = node.setdefault(ch, {})
            node.setdefault("", tag)
        return self

    def look(self, text: str, at: int, least: int) -> str | None:
        """Tag of the whole word that ends before ``at``."""
        node, i = self.root, at - 1
        while i >= least and (nxt := node.get(text[i].lower())) is not None:
            node = nxt
            i -= 1
            if "" in node and (i < least or not (text[i].isalnum() or text[i] in ".'’") or CJK.match(text[i]) or "0" <= text[i] <= "9" and len(text[i + 1 : at]) == 1 and text[at - 1] in "hอ"):
                return node[""]
        return None


ABBREVIATIONS = Trie(NEVER, "never").add(MAYBE, "maybe")


class Stack:
    """The automaton's stack of open quotations and brackets. ``partner`` fills as closers come: opener → its closer. A closer shuts the nearest opener
    of its kind and drops what was opened inside it; whether there is such an opener is known from counts, so that a closer without one costs
    nothing and every opener is pushed and dropped once."""

    def __init__(self) -> None:
        self.open: list[tuple[int, str]] = []
        self.count: dict[str, int] = {}
        self.partner: dict[int, int] = {}

    def push(self, i: int, ends: str) -> None:
        self.open.append((i, ends))
        for c in ends:
            self.count[c] = self.count.get(c, 0) + 1

    def close(self, i: int, ch: str) -> bool:
        """Whether ``ch`` at ``i`` shuts something."""
        if not self.count.get(ch):
            return False
        while True:
            at, ends = self.open.pop()
            for c in ends:
                self.count[c] -= 1
            if ch in ends:
                self.partner[at] = i
                return True

    def read(self, i: int, ch: str) -> None:
        top = self.open[-1][1] if self.open else ""
        if ch == '"':  # straight marks open and shut alternately
            if not self.close(i, ch):
                self.push(i, ch)
        elif ch in top:
            self.close(i, ch)
        elif ch in OPEN and ch not in CLOSE or ch == "“":
            self.push(i, OPEN.get(ch, ""))
        else:
            self.close(i, ch)


class Levels:
    """The automaton's stack of list levels: the indents of the marks that are open. A line without a mark that is indented deeper than the last one, by
    two blanks at least, goes on with its item (an ideographic space begins a paragraph instead); a mark shuts the levels that are not above it, a blank line or an unmarked line at the margin shuts all it leaves."""

    def __init__(self) -> None:
        self.open: list[int] = []

    def read(self, text: str, a: int, b: int, joined: bool) -> bool:
        """Whether the line ``text[a:b]`` goes on with an open item."""
        indent = a
        while indent < b and text[indent] in " \t":
            indent += 1
        plain = text[indent : indent + 1] != "\u3000"
        indent -= a
        if not joined:
            self.open.clear()
        while self.open and indent <= self.open[-1]:
            self.open.pop()
        if LIST_MARK.match(text, a, b):
            self.open.append(indent)
            return False
        return bool(self.open) and plain and indent >= self.open[-1] + 2


def _partners(text: str, a: int, b: int) -> dict[int, int]:
    """Openers of ``text[a:b]`` that have a partner → position of the partner."""
    stack = Stack()
    for m in PAIRED.finditer(text, a, b):
        stack.read(m.start(), m.group())
    return stack.partner


def _begins(text: str, k: int) -> bool:
    """A sentence can begin at ``k`` (after white-space): not with a lower-case letter unless of a name like iBike."""
    n = text[k]
    if n.islower() and n not in "ªº":
        return k + 1 < len(text) and text[k + 1].isupper()
    return n.isalnum() or n in OPEN or n in "¿¡…‥\"'‘“#※■・-–—*@&$€£¥+" or n == "." and text[k : k + 2] == ".." or ord(n) > 0x2E80


class _Block:
    """One run of the automaton over ``text[a:b]``."""

    def __init__(self, text: str, a: int, b: int):
        self.t, self.a, self.b = text, a, b
        self.partner = _partners(text, a, b)
        self.kana = bool(KANA.search(text, a, b))
        self.quoted = [-1, -1, True]  # from where, up to where, and whether there can be nothing but quotations
        self.chain = (0, 0)  # quotations that follow each other: from the first seen to behind the last

    def skip(self, k: int) -> int:
        while k < self.b and self.t[k].isspace():
            k += 1
        return k

    def run(self) -> Iterator[tuple[int, int]]:
        t, b, s, pos = self.t, self.b, self.a, self.a
        while (m := SPECIAL.search(t, pos, b)) is not None:
            i, ch = m.start(), t[m.start()]
            if ch in OPEN or ch == '"':
                c = self.partner.get(i)
                if c is None:
                    pos = i + 1
                    continue
                pos = c + 1
                end = pos if self.quote_ends(s, i, c) else 0
            elif ch.isspace():
                pos = m.end()
                end = i if self.thai_ends(s, i, m.end()) else 0
            else:
                pos = self.run_end(i)
                end = pos if self.stop_ends(s, i, pos) else 0
                while end and end < b and t[end] in CLOSE:
                    end += 1
            if end:
                yield s, end
                s = pos = max(end, pos if ch.isspace() else end)
        yield s, b

    def run_end(self, i: int) -> int:
        """End of the stops that begin at ``i``; an ellipsis that opens the next sentence is not one of them."""
        m = RUN.match(self.t, i, self.b)
        run = m.group()
        if len(run) == 1 or run[-1] not in "…‥":
            return m.end()
        lead = LEADING.search(run)
        if lead and m.end() < self.b and self.t[m.end()].isalnum():
            return i + lead.start()
        return m.end()

    def alnum(self, a: int, b: int) -> bool:
        return ALNUM.search(self.t, a, b) is not None

    def number(self, a: int, b: int) -> bool:
        """Nothing but one number and white-space; a number of a heading or list is short."""
        return b - a < 64 and self.t[a:b].strip().isdigit()

    def thai_ends(self, s: int, i: int, j: int) -> bool:
        t = self.t
        if t[j] == "ๆ" or t[i - 1] == "ๆ":
            return False
        if t[i - 1] == ".":
            return bool(re.search(r"\d\s*[ก-ฮ.]{1,6}\.\Z", t[max(s, i - 12) : i]))
        return True

    def stop_ends(self, s: int, i: int, j: int) -> bool:
        t, b = self.t, self.b
        run = t[i:j]
        k0 = j
        while k0 < b and t[k0] in CLOSE:
            k0 += 1
        k = self.skip(k0)
        if k >= b:
            return True
        n, spaced, p = t[k], k > k0, t[i - 1] if i > s else ""
        kinds = set(run)
        if kinds & FIRM:
            return self.alnum(s, i)
        if kinds & ASKING:
            if not self.alnum(s, i):
                return False
            if n.islower() and not _begins(t, k) or not spaced and n.isascii() and n.isalnum() and p.isascii() and not self.capital(k):
                return False
            if n in ",;:、，､" or (self.kana and not spaced and SAYS_AFTER.match(t, k)):
                return False
            return True
        if run == "．":
            if p.isdigit() and n.isdigit() and not spaced or self.starts_line(s) and self.number(s, i):
                return False
            return self.alnum(s, i) and not (p.isascii() and p.isalpha() and not spaced)
        if kinds <= {"…", "‥"} or len(run) > 1 and kinds <= {".", "…", "‥"}:
            if not self.alnum(s, i):
                return False
            if spaced:
                return _begins(t, k)
            return not self.kana and len(run) > 1 and bool(CJK.match(n) or n in OPEN) and bool(CJK.match(p or " "))
        return self.period_ends(s, i, k, spaced, n, p)

    def period_ends(self, s: int, i: int, k: int, spaced: bool, n: str, p: str) -> bool:
        t = self.t
        if not self.alnum(s, i):
            return False
        if self.number(s, i) or self.starts_line(s) and i - s < 64 and len(t[s:i].strip()) == 1:
            return False
        tag = ABBREVIATIONS.look(t, i, s)
        if not spaced:
            wide = bool(CJK.match(n)) or n in QUOTES
            if self.capital(k) and p.islower() and i - 2 >= s and t[i - 2].islower():
                return tag != "never" and not t.startswith("Ltd", k)
            return wide and tag is None and not p.isdigit() and not (p.isascii() and p.isalpha() and not (i - 2 >= s and t[i - 2].isalpha()))
        if tag == "never":
            return False
        if p.isalpha() and not (i - 2 >= s and (t[i - 2].isalnum() or t[i - 2] in "-'’")) and not CJK.match(p) and tag is None:
            if i - 2 >= s and t[i - 2] == ".":  # U.K., z.B. and the like
                return _begins(t, k) and not n.isdigit()
            return False
        if tag == "maybe":
            word = re.search(r"[^\W\d]+\Z", t[max(s, i - 8) : i])
            if n.isdigit() or word and MONTH_LIKE.match(word.group().lower()) and n.isdigit() or t.startswith("Ltd", k):
                return False
            return _begins(t, k)
        if p.isdigit() and (AFTER_ORDINAL.match(t, k) and re.search(r"(?<![\d.,])\d{1,3}\Z", t[max(s, i - 4) : i])):
            return False
        return _begins(t, k)

    def capital(self, k: int) -> bool:
        """A capitalised word begins at ``k``."""
        return self.t[k].isupper() and k + 1 < self.b and (self.t[k + 1].islower() or self.t[k + 1] in " .")

    def starts_line(self, s: int) -> bool:
        return s == self.a or self.t[s - 1] == "\n"

    def quote_ends(self, s: int, o: int, c: int) -> bool:
        """Whether the sentence ends with the quotation or bracket ``text[o:c+1]``."""
        t, b = self.t, self.b
        inner = t[o + 1 : c].rstrip()
        while inner and inner[-1] in CLOSE:
            inner = inner[:-1].rstrip()
        k = c + 1
        while k < b and t[k] in CLOSE:
            k += 1
        j = self.skip(k)
        if j >= b or not inner or inner[-1] not in STOPS:
            return False
        n, spaced = t[j], j > k
        quote = t[o] in QUOTES
        lead = not self.alnum(s, o) or self.only_quotes(s, o)
        if t.startswith("..", j) or n in "…‥":
            return lead
        if n in ",;:、，､.。．｡！？!?—–-" or n == "/":
            return False
        if not quote:
            return lead and (_begins(t, j) if spaced else bool(CJK.match(n)) and not GOES_ON.match(t, j))
        if "가" <= n <= "힣":
            return spaced and not SAYS_KO.match(t, j) and lead
        if CJK.match(n) or n in "「『｢“《【（…・" and not spaced:
            if n in "「『｢“" and not spaced:
                return self.chain_ends(s, o, inner, j)
            if self.kana or KANA.match(n):
                return not GOES_ON.match(t, j)
            if lead:
                return not SAYS_ZH.match(t, j)
            e = o
            while e > s and t[e - 1].isspace():
                e -= 1
            return t[s:e][-1:] in "：:，," and n not in "的等了" if e - s < 64 else t[e - 1] in "：:，," and n not in "的等了"
        if n.isupper() or n in "¿¡" or n in OPEN or n.isdigit():
            return lead or n not in OPEN
        if n.islower():
            return _begins(t, j)
        return lead and spaced and not n.startswith("و") and not t.startswith("और", j)

    def only_quotes(self, s: int, o: int) -> bool:
        """Everything between ``s`` and ``o`` is quotations; goes on where it stopped for the same ``s``."""
        if self.quoted[0] != s:
            self.quoted = [s, s, True]
        i = self.quoted[1]
        while self.quoted[2] and i < o:
            if self.t[i].isspace():
                i += 1
            elif i in self.partner:
                if self.partner[i] >= o:
                    break
                i = self.partner[i] + 1
            else:
                self.quoted[2] = False
        self.quoted[1] = i
        return self.quoted[2] and i >= o

    def chain_ends(self, s: int, o: int, inner: str, j: int) -> bool:
        """Quotation follows quotation: an exchange that the same sentence tells of goes on (it begins with its first question),
        else each stands alone."""
        if not self.chain[0] <= j < self.chain[1]:
            k = j
            while k < self.b and k in self.partner:
                k = self.skip(self.partner[k] + 1)
            self.chain = (j, k)
        k = self.chain[1]
        if k >= self.b or not (GOES_ON.match(self.t, k) and EXCHANGE.match(self.t, k)):
            return True
        answer = self.t[j + 1 : self.partner.get(j, j + 1)].rstrip()[-1:]
        return not self.t[s:o].strip() and inner[-1] not in ASKING and answer in ASKING


LINE = re.compile(r"[^\n\r\x0b\x0c\x85  ]*")
ENDS_STOPPED = re.compile(r"[。｡．.！？!?…‥।॥؟۔][」』）)】〉》”»｣\]］〕›\"'’]*\s*\Z")
HOLDS_BACK = re.compile(r"[、，､,;；:：(（「『“«\-–/&]\s*\Z")
CLOSES_FIRST = re.compile(r"\s*[」』）)】〉》”»｣］〕、，､。｡．！？…％%]")


def _count(text: str) -> int:
    return sum(1 for a, b in _Block(text, 0, len(text)).run() if text[a:b].strip())


def _thai(c: str) -> bool:
    return "฀" <= c <= "๿"


class _Wrapping:
    """How the lines of a text were wrapped: after ``exact`` characters, or at spaces before ``width``; 0 means not."""

    def __init__(self, text: str, lines: list[tuple[int, int]], near: list[bool]):
        self.exact = self.width = 0
        cut: list[tuple[int, bool]] = []  # lengths of lines that end inside a sentence, and whether between wide characters
        joined = [k for k, n in enumerate(near) if n]
        for k in joined:
            (a, b), (c, d) = lines[k], lines[k + 1]
            last, first = text[b - 1], text[c]
            if _stopped(text, a, b) or LIST_MARK.match(text, c, d) or _thai(last):
                continue
            wide = bool(CJK.match(last) and CJK.match(first)) and not ("가" <= last <= "힣" and "가" <= first <= "힣")
            if _count(text[a:b]) > 1:
                cut.append((b - a, wide))
            elif first.islower() and first.isascii() and not text[c + 1 : c + 2].isupper() and not LIST_MARK.match(text, a, b) and ENDS_STOPPED.search(text, c, d):
                cut.append((b - a, False))
        lengths = [b - a for a, b in lines]
        most = max(lengths, default=0)
        plain = [k for k in joined if not (LIST_MARK.match(text, *lines[k]) or LIST_MARK.match(text, *lines[k + 1]) or ENDS_STOPPED.search(text, *lines[k]))]
        same = sum(lengths[k] == most for k in joined)
        if cut and len({n for n, _ in cut}) == 1 and (any(w for _, w in cut) or len(cut) > 2) and cut[0][0] == most:
            self.exact = most
        elif same >= 2 and most >= 16 and plain and all(lengths[k] == most for k in plain) and any(CJK.match(text[lines[k][1] - 1]) or _thai(text[lines[k][1] - 1]) for k in plain):
            self.exact = most
        elif cut:
            self.width = sorted(n for n, _ in cut)[len(cut) // 2]

    def fills(self, text: str, a: int, b: int, c: int, d: int) -> bool:
        """The line is as long as wrapped ones are."""
        return self.width > 0 and (b - a >= 0.8 * self.width or _greedy(text, a, b, c, d, self.width))


def sentences(text: str) -> list[tuple[int, int]]:
    """Offsets of the sentences of ``text``, in order."""
    lines = [(m.start(), m.end()) for m in LINE.finditer(text) if m.end() > m.start() and not m.group().isspace()]
    near = [text[b:c] in BREAKS for (_, b), (c, _) in zip(lines, lines[1:])]
    wrap = _Wrapping(text, lines, near)
    blocks: list[list[tuple[int, int]]] = []  # each a list of pieces that follow each other without the breaks between them
    levels = Levels()
    for k, (a, b) in enumerate(lines):
        joined = bool(k and near[k - 1])
        within = levels.read(text, a, b, joined)
        if joined:
            how = _between(text, lines[k - 1], (a, b), wrap)
            if how == "hard" and within and not _stopped(text, *lines[k - 1]):
                how = "soft"
            if how == "glued":
                blocks[-1].append((a, b))
                continue
            if how == "soft":
                blocks[-1][-1] = (blocks[-1][-1][0], b)
                continue
        blocks.append([(a, b)])
    out = []
    for pieces in blocks:
        if len(pieces) == 1:
            (a, b), body, at = pieces[0], text, None
        else:
            body = "".join(text[x:y] for x, y in pieces)
            a, b, at, n = 0, len(body), [], 0
            for x, y in pieces:
                at.append((n, x - n))
                n += y - x
        for x, y in _Block(body, a, b).run():
            while x < y and body[x].isspace():
                x += 1
            while x < y and body[y - 1].isspace():
                y -= 1
            if x < y:
                out.append((x, y) if at is None else (x + _shift(at, x), y + _shift(at, y - 1)))
    return out


#: A line that begins like this goes on with the one before it, unless it begins a sentence with one of the usual words.
GOES_ON_LINE = re.compile(r"(?!この|その|あの|どの|ここ|そこ|こう|そう|また|なお|ちなみに|しかし|そして|だが|もし|いま|お|ご|みな|まず|さら|つい|たぶん|やがて|すで|あ|いつ|かつ|ただ|つまり|なぜ|なんと|ほか|よく|わた|たとえ|むし|ところで|とき|とても|でも|では)[ぁ-んー]")
WIDE_CLOSE = re.compile(r"[」』）】〉》｣］〕、，､。｡．！？％]")
INITIAL = re.compile(r"(?:\A|\s)[A-Z]\.\Z")


def _stopped(text: str, a: int, b: int) -> bool:
    """The line ends with a stop that is not the period of an abbreviation or initial."""
    if not ENDS_STOPPED.search(text, a, b):
        return False
    end = b
    while text[end - 1].isspace():
        end -= 1
    return not (text[end - 1] == "." and (ABBREVIATIONS.look(text, end - 1, a) == "never" or INITIAL.search(text[max(a, end - 3) : end])))


BREAKS = {"\n", "\r\n", "\r", "\u2028", "\x85", "\x0b", "\x0c"}


def _shift(at: list[tuple[int, int]], x: int) -> int:
    return at[bisect_right(at, (x, 1 << 60)) - 1][1]


def _between(text: str, before: tuple[int, int], after: tuple[int, int], wrap: _Wrapping) -> str:
    """What a line break is: ``hard`` (ends a block), ``soft`` (white-space) or ``glued`` (set between any two characters)."""
    (a, b), (c, d) = before, after
    marked, listed = bool(LIST_MARK.match(text, c, d)), bool(LIST_MARK.match(text, a, b))
    if wrap.exact and b - a == wrap.exact and not (marked and ENDS_STOPPED.search(text, a, b)):
        return "glued"
    if WIDE_CLOSE.match(text, c, d):
        return "glued"
    if text[b - 1] in ".．" and text[b - 2 : b - 1].isdigit() and text[c].isdigit() and not marked:
        return "glued"
    if marked:
        return "hard"
    if _stopped(text, a, b):
        if any(o < b <= e for o, e in _partners(text, a, d).items()):  # a quotation or bracket goes on in the next line
            return "glued" if CJK.match(text[c]) else "soft"
        low = text[c].islower() and text[c].isascii() and not text[c + 1 : c + 2].isupper() and ENDS_STOPPED.search(text, c, d) and b - a > 30
        return "soft" if not listed and (low or wrap.fills(text, a, b, c, d)) else "hard"
    if not listed and b - a >= 20 and CJK.match(text[b - 1]) and GOES_ON_LINE.match(text, c, d) and _stopped(text, c, d):
        return "glued"
    if CLOSES_FIRST.match(text, c, d) or not listed and HOLDS_BACK.search(text, a, b) and text[b - 1] not in ":：-–":
        return "soft"
    if _thai(text[b - 1]) and _thai(text[c]):
        return "hard"
    if not _thai(text[b - 1]) and not listed and wrap.width and _count(text[a:b]) > 1 or wrap.fills(text, a, b, c, d):
        return "soft"
    return "hard"


def _greedy(text: str, a: int, b: int, c: int, d: int, width: int) -> bool:
    """The first word of the next line did not fit behind this line within ``width``."""
    word = WORD.search(text, c, d)
    return (b - a) + 1 + (len(word.group()) if word else 0) > width > 0


def split(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``start_pos``, ``end_pos`` of every sentence of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            docs, starts, ends = [], [], []
            for doc, text in zip(pdf.doc_id, pdf.text):
                got = sentences(text)
                docs += [doc] * len(got)
                starts += [a for a, _ in got]
                ends += [b for _, b in got]
            yield pd.DataFrame({"doc_id": pd.array(docs, dtype="int64"), "start_pos": pd.array(starts, dtype="int32"), "end_pos": pd.array(ends, dtype="int32")})

    return spread(documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")).mapInPandas(run, "doc_id bigint, start_pos int, end_pos int")
