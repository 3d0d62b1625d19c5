"""Held-out evaluation texts leaking into training text.

The evaluation items, normalized, form a generalised suffix automaton. Documents are streamed through it; the automaton tracks the
length of the longest match that ends at each position, and every match of ``LEAST`` letters or digits names the items that hold
it. A sampled look-up keeps the stream short without losing a match: a match of ``LEAST`` characters covers one of the sampled
grams completely, so only the neighbourhood of grams that may occur in some item is fed to the automaton. The unit is the character, since a
leak is defined by letters and digits.

The automaton is held in flat arrays: a state costs 16 bytes and only states that branch have a table of their own. The items' texts travel to
the workers, the automaton is built once per Python process. Items of more than ``MOST_CHARS`` characters are cut into parts that are
counted one by one until each is smaller; the documents are then read once per part and the spans of all parts are merged.

Defined results: null or empty texts match nothing; items shorter than ``LEAST`` leak nowhere; documents and items posted twice give
their own pairs; very long texts take time in proportion to their length; an item that is larger than a part by itself is a part by itself;
extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEAST = 40
GRAM = 8
#: Documents of which more than this share leaks are dropped by ``cleaned`` as a whole.
COVERAGE = 0.5
#: More characters of items than this are matched part by part (about 300 bytes of automaton a character, measured).
MOST_CHARS = 1_000_000

_NOT_ALNUM = re.compile(r"[\W_]+")
#: A character with the marks behind it, or a run of conjoining jamo: what NFKC may compose, and nothing that it composes lies across two of them.
_MARKED = regex.compile(r"[\u1100-\u11FF\uA960-\uA97F\uD7B0-\uD7FF]+\p{M}*|\P{M}[\p{M}\uFF9E\uFF9F]*|\p{M}+", regex.S)


def normalize(text: str) -> str:
    """Letters and digits only, without regard to case and width."""
    return _NOT_ALNUM.sub("", unicodedata.normalize("NFKC", text).casefold())


def normalize_with_positions(text: str) -> tuple[str, list[int]]:
    """The normalized text and for each of its characters the position it came from."""
    out, at = [], []
    for m in _MARKED.finditer(text):
        piece = normalize(m.group())
        out.append(piece)
        at += [m.start()] * len(piece)
    return "".join(out), at


class SuffixAutomaton:
    """Generalised suffix automaton of several texts; states that hold a substring of length ``least`` know the texts it is in.

    The first transition of a state lies in two arrays (character, target; 0: none, since nothing leads back to the root), further ones in ``more``."""

    def __init__(self, texts: dict[int, str], least: int = LEAST):
        self.least = least
        self.ch, self.to = array("I", [0]), array("I", [0])
        self.link, self.len = array("i", [-1]), array("i", [0])
        self.more: dict[int, dict[str, int]] = {}
        ends, keys = array("I"), []
        for key, text in texts.items():
            if len(text) < least:
                continue
            last = 0
            for ch in text:
                last = self._extend(last, ch)
                ends.append(last)
            keys.append((key, len(text)))
        self.texts: dict[int, set[int]] = {}
        at = 0
        for key, n in keys:
            for state in ends[at : at + n]:
                while state > 0 and self.len[state] >= least:
                    if self.len[self.link[state]] < least:
                        self.texts.setdefault(state, set()).add(key)
                        break
                    state = self.link[state]
            at += n
        # two bytes of a table of 16 slots per gram at least: a gram of an item is never missed, hardly any other passes
        size = 1 << max(10, (16 * at).bit_length())
        self.mask, self.slots = size - 1, bytearray(size)
        for t in texts.values():
            if len(t) >= least:
                for i in range(len(t) - GRAM + 1):
                    h = hash(t[i : i + GRAM])
                    self.slots[h & self.mask] = self.slots[(h >> 32) & self.mask] = 1

    def step(self, state: int, ch: str) -> int:
        """Where ``ch`` leads from ``state``; 0 if nowhere."""
        if self.ch[state] == ord(ch):
            return self.to[state]
        more = self.more.get(state)
        return more.get(ch, 0) if more else 0

    def _lead(self, state: int, ch: str, to: int) -> None:
        if self.ch[state] in (0, ord(ch)):
            self.ch[state], self.to[state] = ord(ch), to
        else:
            self.more.setdefault(state, {})[ch] = to

    def _state(self, length: int, link: int, ch: int = 0, to: int = 0) -> int:
        self.len.append(length)
        self.link.append(link)
        self.ch.append(ch)
        self.to.append(to)
        return len(self.len) - 1

    def _clone(self, p: int, q: int, ch: str) -> int:
        c = self._state(self.len[p] + 1, self.link[q], self.ch[q], self.to[q])
        if q in self.more:
            self.more[c] = dict(self.more[q])
        self.link[q] = c
        while p != -1 and self.step(p, ch) == q:
            self._lead(p, ch, c)
            p = self.link[p]
        return c

    def _extend(self, last: int, ch: str) -> int:
        q = self.step(last, ch)
        if q:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, q, ch)
        cur = self._state(self.len[last] + 1, 0)
        p = last
        while p != -1 and not self.step(p, ch):
            self._lead(p, ch, cur)
            p = self.link[p]
        if p != -1:
            q = self.step(p, ch)
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._clone(p, q, ch)
        return cur

    def bytes(self) -> int:
        """Memory held by the automaton."""
        import sys

        return sum(sys.getsizeof(x) for x in (self.ch, self.to, self.link, self.len, self.more, self.slots, self.texts)) + sum(map(sys.getsizeof, self.more.values())) + sum(map(sys.getsizeof, self.texts.values()))

    def windows(self, text: str) -> Iterator[tuple[int, int]]:
        """Stretches of ``text`` outside of which no match of ``least`` characters can lie."""
        step, begin, end, slots, mask = self.least - GRAM + 1, None, 0, self.slots, self.mask
        for p in range(0, len(text) - GRAM + 1, step):
            h = hash(text[p : p + GRAM])
            if slots[h & mask] and slots[(h >> 32) & mask]:
                a, b = max(0, p + GRAM - self.least), min(len(text), p + self.least)
                if begin is None:
                    begin = a
                elif a > end:
                    yield begin, end
                    begin = a
                end = b
        if begin is not None:
            yield begin, end

    def matches(self, text: str) -> Iterator[tuple[int, int, set[int]]]:
        """(end, length, texts) for every position where the longest match has ``least`` characters or more."""
        step, link, length, least, texts = self.step, self.link, self.len, self.least, self.texts
        for a, b in self.windows(text):
            state = n = 0
            for i in range(a, b):
                ch = text[i]
                while not (to := step(state, ch)) and state:
                    state = link[state]
                    n = length[state]
                if not to:
                    continue
                state, n = to, n + 1
                if n >= least:
                    v = state
                    while length[link[v]] >= least:
                        v = link[v]
                    yield i + 1, n, texts.get(v, set())


def _parts(eval_items: DataFrame, most: int) -> list[DataFrame]:
    """The items, or parts of them of at most ``most`` characters each: counted hash buckets, packed; more buckets while one of several items is too large."""
    rows = eval_items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text")
    whole = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if whole <= most:
        return [rows]
    n = 8 * -(-whole // most)
    while True:
        bucket = F.pmod(F.xxhash64("item_id"), F.lit(n))
        sizes = rows.groupBy(bucket.alias("b")).agg(F.sum(F.length("text")).alias("chars"), F.count_distinct("item_id").alias("items")).collect()
        if all(r.chars <= most or r.items == 1 for r in sizes):
            break
        n *= 2
    packs: list[tuple[int, list[int]]] = []
    for r in sorted(sizes, key=lambda r: -r.chars):
        k = next((k for k, (size, _) in enumerate(packs) if size + r.chars <= most), None)
        if k is None:
            packs.append((r.chars, [r.b]))
        else:
            packs[k] = (packs[k][0] + r.chars, [*packs[k][1], r.b])
    return [rows.where(bucket.isin(bs)) for _, bs in packs]


def _texts(part: DataFrame) -> dict[int, str]:
    return {r.item_id: normalize(r.text) for r in part.collect()}


_built: dict[int, SuffixAutomaton] = {}


def _automaton(items: dict[int, str]) -> SuffixAutomaton:
    """Built once per Python process."""
    key = hash(tuple(sorted(items.items())))
    if key not in _built:
        _built.clear()
        _built[key] = SuffixAutomaton(items)
    return _built[key]


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def found(documents: DataFrame, eval_items: DataFrame, most: int = MOST_CHARS) -> DataFrame:
    """``doc_id``, ``item_id`` of every document that holds ``LEAST`` consecutive letters or digits of an item."""
    return _union([_found(documents, _texts(p)) for p in _parts(eval_items, most)])


def _found(documents: DataFrame, items: dict[int, str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sam = _automaton(items)
        for pdf in batches:
            docs, hits = [], []
            for doc, text in zip(pdf.doc_id, pdf.text):
                leaked: set[int] = set()
                for _, _, keys in sam.matches(normalize(text)):
                    leaked |= keys
                docs += [doc] * len(leaked)
                hits += sorted(leaked)
            yield pd.DataFrame({"doc_id": pd.array(docs, dtype="int64"), "item_id": pd.array(hits, dtype="int64")})

    return documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").mapInPandas(run, "doc_id bigint, item_id bigint")


def leaked_spans(sam: SuffixAutomaton, text: str) -> list[tuple[int, int]]:
    """Maximal leaked stretches of ``text`` in code points, in order."""
    norm, at = normalize_with_positions(text)
    out: list[tuple[int, int]] = []
    for end, n, _ in sam.matches(norm):
        a = end - n
        if out and a <= out[-1][1]:
            out[-1] = (min(out[-1][0], a), max(out[-1][1], end))
        else:
            out.append((a, end))
    return [(at[a], at[b - 1] + 1) for a, b in out]


def _spans(documents: DataFrame, items: dict[int, str]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sam = _automaton(items)
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf.doc_id, pdf.text):
                if next(sam.matches(normalize(text)), None):
                    rows += [(doc, a, b) for a, b in leaked_spans(sam, text)]
            yield pd.DataFrame(rows, columns=["doc_id", "start_pos", "end_pos"]).astype({"doc_id": "int64", "start_pos": "int32", "end_pos": "int32"})

    return documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").mapInPandas(run, "doc_id bigint, start_pos int, end_pos int")


def spans(documents: DataFrame, eval_items: DataFrame, most: int = MOST_CHARS) -> DataFrame:
    """``doc_id``, ``start_pos``, ``end_pos`` of every leaked stretch. Stretches of several parts that touch are one: the earlier ends of a document's
    stretches, in order, tell where a new one begins."""
    parts = _parts(eval_items, most)
    if len(parts) == 1:
        return _spans(documents, _texts(parts[0]))
    raw = _union([_spans(documents, _texts(p)) for p in parts]).distinct()
    order = Window.partitionBy("doc_id").orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = raw.withColumn("new", F.when(reach.isNull() | (F.col("start_pos") > reach), 1).otherwise(0)).withColumn("run", F.sum("new").over(order))
    return runs.groupBy("doc_id", "run").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("run")


def without(text: str | None, cuts: list[tuple[int, int]], coverage: float) -> tuple[str | None, int]:
    """``text`` without ``cuts`` (null where they cover more than ``coverage`` of it) and the number of characters cut."""
    gone = sum(b - a for a, b in cuts)
    if not gone:
        return text, 0
    if gone > coverage * len(text):
        return None, gone
    edges = [0, *[x for ab in cuts for x in ab], len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), gone


def cleaned(documents: DataFrame, eval_items: DataFrame, coverage: float = COVERAGE, most: int = MOST_CHARS) -> DataFrame:
    """Every document: ``text`` without leaked stretches (null where they cover more than ``coverage`` of it) and ``n_removed`` code points."""
    parts = _parts(eval_items, most)
    out = "doc_id bigint, text string, n_removed bigint"
    if len(parts) == 1:
        items = _texts(parts[0])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sam = _automaton(items)
            for pdf in batches:
                got = [without(t, leaked_spans(sam, t) if isinstance(t, str) and next(sam.matches(normalize(t)), None) else [], coverage) for t in pdf.text]
                yield pd.DataFrame({"doc_id": pdf.doc_id, "text": [t for t, _ in got], "n_removed": pd.array([n for _, n in got], dtype="int64")})

        return documents.select("doc_id", "text").mapInPandas(run, out)
    cuts = spans(documents, eval_items, most).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start_pos", "end_pos"))).alias("cuts"))

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [without(t, [(c["start_pos"], c["end_pos"]) for c in cs] if cs is not None else [], coverage) for t, cs in zip(pdf.text, pdf.cuts)]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "text": [t for t, _ in got], "n_removed": pd.array([n for _, n in got], dtype="int64")})

    return documents.select("doc_id", "text").join(cuts, "doc_id", "left").select("doc_id", "text", "cuts").mapInPandas(apply, out)
