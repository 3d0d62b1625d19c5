"""Leaked passages, mixing, sentences."""

import random
from collections import defaultdict

import pytest

from tallyspan.llm import leakage, mixing, sentences

DOC = "doc_id bigint, text string, source string, item_id bigint, n_tokens bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, -1) for i, t, s in rows], DOC)


def brute(items, texts, least=leakage.LEAST):
    grams = defaultdict(set)
    for i, t in items.items():
        n = leakage.normalize(t)
        for p in range(len(n) - least + 1):
            grams[n[p : p + least]].add(i)
    out = set()
    for d, t in texts.items():
        n = leakage.normalize(t)
        out |= {(d, i) for p in range(len(n) - least + 1) for i in grams.get(n[p : p + least], ())}
    return out


def test_leaks_against_brute_force(spark):
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdefgh駐輪場盗ガ") for _ in range(n))
    items = {i: word(rnd.randint(30, 120)) for i in range(25)}
    items[25] = items[3]
    texts = {}
    for d in range(150):
        parts = [word(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 2)):
            t = items[rnd.randrange(25)]
            n = rnd.choice([38, 39, 40, 41, 60])
            a = rnd.randint(0, max(0, len(t) - n))
            parts += ["".join(c + rnd.choice(["", "", "", " ", "\n", "、", "​"]) for c in t[a : a + n]).upper(), word(rnd.randint(0, 60))]
        texts[d] = "-".join(parts)
    ev = spark.createDataFrame([(i, t, "x") for i, t in items.items()] + [(90, None, "x"), (91, "", "x"), (None, "x", "x")], "item_id bigint, text string, doc_id string")
    rows = [(d, t, "s") for d, t in texts.items()] + [(900, None, "s"), (901, "", "s"), (902, (items[1] + "z") * 3000, "s")]
    got = [tuple(r) for r in leakage.found(docs(spark, rows), ev).collect()]
    want = brute(items, texts | {902: (items[1] + "z") * 3000})
    assert set(got) == want and len(got) == len(want) and len(want) > 20
    assert {tuple(r) for r in leakage.found(docs(spark, rows), ev, most=600).collect()} == want
    assert leakage.found(docs(spark, []), ev).count() == 0 and leakage.found(docs(spark, rows), ev.where("false")).count() == 0


def test_spans_and_cleaning(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away home"
    text = "Intro. " + item.upper().replace(" ", "  ") + "! " + "End of something entirely different, long enough to stay in. " * 3
    ev = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    (a, b), = [(r.start_pos, r.end_pos) for r in leakage.spans(docs(spark, [(1, text, "s")]), ev).collect()]
    assert text[a:b] == item.upper().replace(" ", "  ")
    got = {r.doc_id: (r.text, r.n_removed) for r in leakage.cleaned(docs(spark, [(1, text, "s"), (2, item, "s"), (3, "x", "s"), (4, None, "s")]), ev).collect()}
    assert got == {1: (text[:a] + text[b:], b - a), 2: (None, len(item)), 3: ("x", 0), 4: (None, 0)}


def test_sampling_misses_nothing():
    rnd = random.Random(1)
    base = "".join(rnd.choice("ab") for _ in range(60))
    sam = leakage.SuffixAutomaton({1: base})
    for shift in range(80):
        text = "z" * shift + base[5:45] + "z" * 7
        assert any(1 in k for _, _, k in sam.matches(text)), shift
        assert not list(sam.matches("z" * shift + base[5:44] + "z" * 7)), shift


@pytest.fixture(scope="module")
def mixed_inputs(spark):
    rnd = random.Random(4)
    rows = [(i, "word " * rnd.randint(1, 60), rnd.choice(["a", "b", "b", "c"] + ["hot"] * 3)) for i in range(900)] + [(2000, None, "a"), (2001, "x y", None), (2002, "", "a")]
    targets = [("m", "a", 2.0, 3, 0.5), ("m", "b", 1.0, 1, 0.5), ("m", "hot", 1.0, 1, 0.5), ("m", "none", 1.0, 2, 0.5), ("m", "c", None, 2, 0.5), ("cap", "a", 1.0, 2, 5.0), (None, "a", 1.0, 1, 1.0)]
    return docs(spark, rows), spark.createDataFrame(targets, "mix string, source string, weight double, max_repeats int, size_factor double")


def test_mix_reaches_shares(spark, mixed_inputs):
    d, t = mixed_inputs
    got = {(r.mix, r.source): r for r in mixing.shares(d, t).collect()}
    total = sum(r.n_tokens for r in mixing.token_counts(d).collect())
    m = {s: got["m", s] for s in ("a", "b", "hot", "none")}
    assert sum(r.reached_tokens for r in m.values()) == pytest.approx(0.5 * total, rel=0.02)
    assert m["none"].reached_tokens == 0 and m["a"].reached_tokens / m["b"].reached_tokens == pytest.approx(2, rel=0.03) and m["hot"].reached_tokens == pytest.approx(m["b"].reached_tokens, rel=0.03)
    assert got["cap", "a"].most_uses == 2 and got["cap", "a"].reached_tokens == 2 * got["cap", "a"].available_tokens
    assert set(got) == {("m", x) for x in m} | {("cap", "a")}


def test_positions_follow_the_schedule(spark, mixed_inputs):
    d, t = mixed_inputs
    rows = mixing.selection(d, t, {"a": 0.8, "b": -0.8}).where("mix = 'm'").collect()
    assert all(0 <= r.position <= 1 for r in rows) and len({(r.doc_id, r.use_no) for r in rows}) == len(rows)
    late = {s: sum(r.n_tokens for r in rows if r.source == s and r.position > 0.5) / sum(r.n_tokens for r in rows if r.source == s) for s in ("a", "b")}
    assert late["a"] > 0.57 and late["b"] < 0.43
    half = sum(r.n_tokens for r in rows if r.position <= 0.5) / sum(r.n_tokens for r in rows)
    assert half == pytest.approx(0.5, abs=0.03)
    places = {r.doc_id: r.place for r in mixing.placed(mixing.token_counts(d)).collect()}
    assert len(places) == 900 and mixing.selection(d.where("false"), t).count() == 0 and mixing.selection(d, t.where("false")).count() == 0


def split(text):
    return [text[a:b] for a, b in sentences.sentences(text)]


CASES = [
    ["Dr. Averlin left at 11 a.m. on Mon. the 7th.", "It rose by approx. 3.5 percent, e.g. in St. Orrin.", "Bring a lock, etc.", "(The 2017 edition is out of print.)", "No one answered...", "...and it was back."],
    ["He asked, “Why here? Why now?” and left.", "“Lock it twice. Then check,” she said.", "Really?!", "iBike lockers cost 3 yen.", "See p. 5 of v.3.7."],
    ["差は０．9ポイント。", "「鍵は？」「はい。」「では、なぜ？」と問答が続いた。", "「返してほしい。」", "気を付けよう！！", "本当だろうか……。", "…霞町の分はまだ。", "「みなと。の市」は開かれる。", "箱（施錠あり。登録済み。）は3台。", "A.区分は B.区分より多い。"],
    ["他想了很久……", "“昨天还在！今天就没了！”管理员说道。", "统计科说：“请上锁。不要忘记。”", "与此同时，有五户。"],
    ["Nr. 526 fehlt im 3. Quartal.", "Am 23. März 2015 verschwand z. B. ein Rad.", "„Zweimal abschließen. Dann prüfen!“, riet Fr. Ostrell."],
    ["비율은 41.3에서 2.8로 낮아졌습니다.", "No. 5 표에 있습니다.", "“잠그세요. 확인하세요.”라고 말했습니다.", "그는 말이 없었다…", "왜 그럴까요?"],
    ["अवलिन ने कहा, “दो ताले लगाइए। फिर जाँचिए।” और चले गए।", "दर 21.7 से घटी।", "बहुत अच्छा!"],
    ["قال: «أقفلوا مرتين. ثم تأكدوا.» وانصرف.", "انظر ص. 935 من العدد.", "لماذا؟"],
    ["รายงานจะนับรวมในปีถัดไป", "เวลาคือ 9.59 น.", "มีจักรยานหายในย่าน Sumibe จำนวน 653 คัน", "ตรวจสอบบ่อย ๆ ก่อนออก"],
]


@pytest.mark.parametrize("want", CASES)
def test_sentences(want):
    sep = "" if want[0][0] in "差他" else " "
    assert split(sep.join(want)) == want


def test_lines():
    assert split("Notes\n- Bag (3)\n- Lock it.\n1. Moto: 3\n\nお知らせ\n・鍵：3台\n(1) 駅前") == ["Notes", "- Bag (3)", "- Lock it.", "1. Moto: 3", "お知らせ", "・鍵：3台", "(1) 駅前"]
    assert split("次回は6日です\n不審な人を見たら連絡を") == ["次回は6日です", "不審な人を見たら連絡を"]
    wrapped = "The figures, e.g. those here, exclude towns\nwith one case. A bag was taken from the old\npath in May.\nThe end."
    assert split(wrapped) == ["The figures, e.g. those here, exclude towns\nwith one case.", "A bag was taken from the old\npath in May.", "The end."]
    cut = "率は30.5から45.8へ下がった。認知件数は3\n5件となった。「鍵を掛けてください。」と役員は呼び\nかけている。"
    assert "".join(split(cut)) and len(split(cut)) == 3


def test_cover_everything_once(spark):
    rnd = random.Random(5)
    pool = ["。", ". ", "「", "」", "(", ")", "a", "Aa", " ", "\n", "…", "？", "\"", "ก ", "3.5", "・", "漢字", "No. ", "\r\n", "​", "”", "“"]
    for _ in range(3000):
        t = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25)))
        got = sentences.sentences(t)
        inside = [False] * len(t)
        for a, b in got:
            assert a < b and not t[a].isspace() and not t[b - 1].isspace()
            for i in range(a, b):
                assert not inside[i]
                inside[i] = True
        assert all(x or c.isspace() for x, c in zip(inside, t))
    rows = [(1, "一。二。", "s"), (2, None, "s"), (3, " \n ", "s"), (4, "一。二。", "s"), (5, "「" * 3000 + "あ。い\n" * 20_000, "s")]
    got = sentences.split(docs(spark, rows)).where("doc_id < 5").collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 2), (1, 2, 4), (4, 0, 2), (4, 2, 4)]
    assert sentences.split(docs(spark, [])).count() == 0


def test_parts_of_items_give_equal_spans_and_texts(spark):
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdefghij") for _ in range(n))
    items = [(i, word(rnd.randint(60, 200))) for i in range(30)]
    rows = [(i, word(30) + "。 " + items[i][1][: rnd.randint(40, 60)] + items[(i + 1) % 30][1] + word(40), "s") for i in range(30)] + [(98, items[3][1], "s"), (99, None, "s")]
    ev = spark.createDataFrame(items, "item_id bigint, text string")
    for most in (2000,):
        for op in (leakage.found, leakage.spans, leakage.cleaned):
            a, b = op(docs(spark, rows), ev), op(docs(spark, rows), ev, most=most)
            assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr), (op, most)


def test_positions_of_composed_characters():
    for text in ("が\u3099x", "e\u0301\u0323 ﾊﾟ 각\u11a8", "\u1100\u1161\u11a8a\u0bc6\u0bbe", "\u0301x", "ﬁ①㈱Å"):
        norm, at = leakage.normalize_with_positions(text)
        assert norm == leakage.normalize(text) and len(at) == len(norm)


def encoder():
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    return tiktoken.Encoding("public", pat_str=mixing.PATTERN, mergeable_ranks=load_tiktoken_bpe(mixing.VOCABULARY), special_tokens={})


def test_tokens_of_long_texts_are_those_of_the_whole():
    enc = encoder()
    for text in ("word " * 23_000, "a" * 300_000, "x" + " " * 1500 + "y" + "\n" * 1200, " " * 1100 + "1", "あ" * 120_000, "a" + "\u3000" * 1001 + "b c"):
        assert mixing.count_tokens(enc, text) == len(enc.encode_ordinary(text))
    assert mixing.count_tokens(enc, " " * 2_000_000 + "x") > 0


def test_filling_and_inverted_schedules(spark):
    from pyspark.sql import functions as F

    assert mixing.fill([0.5, 0.3, 0.2], [10, 100, 100], 100) == pytest.approx([10, 54, 36]) and mixing.fill([0.5, 0.5], [1, 2], 100) == [1, 2] and mixing.fill([], [], 5) == []
    rnd = random.Random(4)
    knots = {f"s{k}": [(t, rnd.choice([0.0, 1.0, 2.0, rnd.random()])) for t in (0.0, *sorted(rnd.random() for _ in range(k)), 1.0)] for k in range(5)} | {"none": [(0.0, 0.0), (1.0, 0.0)]}
    sched = spark.createDataFrame([("m", s, [{"t": t, "w": w} for t, w in ks]) for s, ks in knots.items()], "mix string, source string, knots array<struct<t double, w double>>")
    dones = spark.createDataFrame([(i / 50,) for i in range(51)], "done double")
    got = mixing.segments(sched).crossJoin(dones).select("source", "done", mixing.position(F.col("done"), F.col("segs")).alias("p")).collect()
    for r in got:
        ks = knots[r.source]
        if sum(w for _, w in ks) == 0:
            assert abs(r.p - r.done) < 1e-9
            continue
        weight = lambda x: next(a + (b - a) * (x - t) / (u - t) if u > t else b for (t, a), (u, b) in zip(ks, ks[1:]) if x <= u)
        steps = [(i + 0.5) / 20_000 for i in range(20_000)]
        mass = [weight(x) for x in steps]
        below = sum(m for x, m in zip(steps, mass) if x <= r.p) / sum(mass)
        assert abs(below - r.done) < 2e-3, (r, ks)


def test_list_levels_and_linear_time():
    import time

    got = lambda t: [t[a:b] for a, b in sentences.sentences(t)]
    assert got("- one thing\n    that goes on\n  - below it\n      further\n- next\nend") == ["- one thing\n    that goes on", "- below it\n      further", "- next", "end"]
    for text in ("(]" * 32_000, "「あ。」" * 20_000, "「" * 30_000 + "」" * 30_000, "12. " * 20_000, '"x." ' * 20_000, "a. " * 30_000):
        t = time.time()
        sentences.sentences(text)
        assert time.time() - t < 5
