"""Free-entered values, look-alikes, wrong encodings."""

import random
import unicodedata

import pytest

from tallyspan.llm import canonical, lookalike, mojibake

AREA = "area_id bigint, city_code string, city_name string, pref string, key string, name string, yomi string, key_codes array<string>, word string"
AREAS = [
    (1, "11111", "甲市", "丙県", "鶯見町1丁目", "鶯見町一丁目", "うぐいすみちょう1ちょうめ", ["k1"], "x"),
    (2, "11111", "甲市", "丙県", "鶯見町2丁目", "鶯見町二丁目", "うぐいすみちょう2ちょうめ", ["k2"], "x"),
    (3, "11111", "甲市", "丙県", "大字霧国ガーデン", "大字霧国ガーデン", "おおあざきりくにがーでん", ["k3"], "x"),
    (4, "11111", "甲市", "丙県", "西萩ケ丘12丁目", "西萩ケ丘十二丁目", "にしはぎがおか12ちょうめ", ["k4"], "x"),
    (5, "22222", "乙市", "丙県", "鞍宮通", "鞍宮通", "くらみやどおり", ["k5"], "x"),
    (6, "11111", "甲市", "丙県", "東露口1丁目", "東露口一丁目", "ひがしつゆぐち1ちょうめ", ["k6"], "x"),
    (7, "11111", "甲市", "丙県", "東霧口1丁目", "東霧口一丁目", "ひがしきりぐち1ちょうめ", ["k7"], "x"),
]
ENTRY = "entry_id bigint, city_code string, s_name string, desk string, city string, value string, area_id bigint"


def entries(spark, rows):
    return spark.createDataFrame([(i, c, s, None, "clash", "clash", -1) for i, c, s in rows], ENTRY)


CASES = {
    "鶯見町１丁目": 1, "丙県甲市鶯見町二丁目": 2, "（甲市）鶯見町2丁目付近": 2, "鶯見町1-3-4": 1, "鶯見町(2)": 2, "鶯見町第二丁目": 2, "うぐいすみちょう2ちょうめ": 2, "UGUISUMICHO-1chome": 1, "ウグイスミチョウ1丁目": 1,
    "鶯見1丁目": 1, "鶯町見2丁目": 2, "鶯見町3丁目": 0, "鶯見町": 0, "霧国ガーデン": 3, "霧國ガーデン": 3, "霧国ガデン": 3, "西萩ヶ丘12丁目": 4, "西荻ケ丘十二丁目": 4, "同上": 0, "??": 0, "鞍宮通": 0, "東?口1丁目": 0, "鶯見1町丁目": 1,
    "鶯見町1丁目25番3号": 1, "大字霧国ガーデン17番地の2": 3,
}


def test_entries(spark):
    rows = [(i, "11111", s) for i, s in enumerate(CASES)] + [(100, "111119", "鶯見町1丁目 "), (101, "22222", "鞍宮通"), (102, "22222", "鞍宮"), (103, None, "鞍宮通"), (104, "11111", None), (105, "11111", " 　"), (106, "99999", "鶯見町一丁目"), (107, "11111", "鶯" * 100_000), (108, "11111", "鶯見町一丁目")]
    areas = spark.createDataFrame([*AREAS, (8, None, None, None, None, None, None, None, None)], AREA)
    got = {r.entry_id: r.area_id for r in canonical.map_values(entries(spark, rows), areas).collect()}
    assert {s: got[i] for i, s in enumerate(CASES)} == CASES
    assert {k: v for k, v in got.items() if k >= 100} == {100: 1, 102: 5, 103: 0, 106: 0, 107: 0}
    sharded = {r.entry_id: r.area_id for r in canonical.map_values(entries(spark, rows), areas, most_entries=1).collect()}
    assert sharded == got
    assert canonical.map_values(entries(spark, []), areas).count() == 0


def test_names_of_one_character_left(spark):
    row = lambda i, city, name: (i, city, "甲市", "丙県", None, name, None, None, "x")
    areas = spark.createDataFrame([row(1, "11111", "鷺野七丁目"), row(2, "11111", "鞍宮"), row(3, "22222", "鞍宮"), row(4, "22222", "宮野"), row(5, "22222", "鷺野町")], AREA)
    rows = [(1, "11111", "鷺七丁目"), (2, "11111", "宮"), (3, "11111", "鷺八丁目"), (4, "22222", "宮"), (5, "22222", "鷺")]
    for shards in ({}, {"most_entries": 1}):
        got = {r.entry_id: r.area_id for r in canonical.map_values(entries(spark, rows), areas, **shards).collect()}
        assert got == {1: 1, 2: 2, 3: 0, 4: 0, 5: 0}


def test_distance_is_a_metric_and_tree_is_complete():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(0, 6))) for _ in range(120)]
    d = lambda a, b: canonical.distance(a, b, 99)
    for _ in range(3000):
        a, b, c = rnd.sample(words, 3)
        assert d(a, b) == d(b, a) and d(a, c) <= d(a, b) + d(b, c) and (d(a, b) == 0) == (a == b)
    assert d("ab", "ba") == 1 and d("ca", "abc") == 2
    tree = canonical.BKTree()
    for w in words:
        tree.add(w)
    for q in ("abca", "", "ccc"):
        for k in (0, 1, 2):
            assert {w for _, w in tree.near(q, k)} == {w for w in words if d(q, w) <= k}


def test_one_form():
    same = [("パークＡ1丁目", "ﾊﾟｰｸA１丁⽬"), ("ガーデン", "ガー​デン"), ("Élan町", "Élan 町"), ("口ノ二", "ロ丿ニ"), ("Port", "Рοrt"), ("ド", "卜゙"), ("一丁目", "―丁目"), ("西", "⻄")]
    for a, b in same:
        assert lookalike.skeleton(a) == lookalike.skeleton(b), (a, b)
    for a, b in [("崎", "﨑"), ("神", "\ufa19"), ("国", "國"), ("ケ", "ヶ"), ("末", "未"), ("A", "a"), ("の", "ノ")]:
        assert lookalike.skeleton(a) != lookalike.skeleton(b), (a, b)
    assert lookalike.canonical(None) is None and lookalike.canonical("​ 　") == "" and lookalike.canonical("が" * 50_000) == "が" * 50_000


def test_canonical_equals_whole_text_normalization():
    rnd = random.Random(6)
    pool = "aé́̀ががパパ하학Ｑ１ｶﾞ 国"
    for _ in range(4000):
        s = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 9)))
        assert lookalike.canonical(s) == unicodedata.normalize("NFKC", s.replace(" ", ""))


def test_lookalike_rows(spark):
    areas = spark.createDataFrame(AREAS, AREA)
    b = spark.createDataFrame([(1, "11111", "鶯見町一丁⽬", "x"), (2, "11111", "鶯見町一丁目", "x"), (3, "11111", None, "x"), (4, "22222", "鶯見町一丁⽬", "x"), (5, None, "鞍宮通", "x"), (6, "22222", "​鞍宮通", "x"), (6, "22222", "鞍宮通​", "x")], "rec_no bigint, city_code string, s_name string, shape string")
    c = spark.createDataFrame([(1, "11111", "鶯見町２丁目"), (2, "11111", "鶯見町2丁目"), (3, "11111", ""), (4, "11111", "鶯見町2丁目（飛地）")], "count_id bigint, city_code string, key string")
    got = sorted((r.src, r.row_id, r.area_id) for r in lookalike.lookalikes(b, c, areas).collect())
    assert got == [("area_counts", 1, 2), ("boundary", 1, 1), ("boundary", 6, 5), ("boundary", 6, 5)]
    forms = {(r.src, r.row_id): r.form for r in lookalike.one_form(b, c, areas).collect()}
    assert forms["boundary", 1] == "鶯見町一丁目" and forms["boundary", 3] is None and forms["area_counts", 4] == "鶯見町2丁目(飛地)"
    assert lookalike.lookalikes(b.where("false"), c.where("false"), areas.where("false")).count() == 0


@pytest.fixture(scope="module")
def restorer():
    return mojibake.Restorer(known=(*mojibake.CHARGES, "大字霧国Élan町", "鶯見ガーデン三丁目", "萩広ケ丘二丁目"))


ORIGINALS = ["窃盗", "窃盗（未遂）", "鶯見ガーデン三丁目", "萩広ケ丘二丁目"]


@pytest.mark.parametrize("true,wrong", [("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("euc_jp", "latin-1"), ("cp932", "latin-1"), ("cp932", "mac_roman")])
def test_exact_round_trip(restorer, true, wrong):
    for text in ORIGINALS:
        bad = text.encode(true).decode(wrong)
        assert restorer(bad) == (text, True), (text, bad)
        assert restorer(text + bad) == (text + text, True)


@pytest.mark.parametrize("true,wrong", [("utf-8", "cp932"), ("utf-8", "gbk"), ("euc_jp", "cp932"), ("cp932", "utf-8"), ("utf-8", "ascii"), ("utf-8", "cp1252")])
@pytest.mark.parametrize("errors", ["replace", "ignore"])
def test_lossy_damage_is_found(restorer, true, wrong, errors):
    for text in ORIGINALS:
        bad = text.encode(true).decode(wrong, errors)
        if bad and bad != text and (errors == "replace" or wrong in ("cp932", "gbk") and true == "utf-8"):
            assert restorer(bad)[1], (text, bad)


def test_correct_text_is_no_case(restorer):
    for text in ["窃盗", "ｾｯﾄｳ", "窃盜", "せっ盗", "Theft", "vol à l’arraché", "Diebstahl (Fahrräder)", "кража", "절도", "ขโมย", "盗竊", "ﾊﾟｰｸｻｲﾄﾞ", "西轟田ｹ丘一丁目", "國濱澤櫻邊廣嶋﨑臺", "\xa0\xa0甲\xad", "Élan\xad町", "№①㈱", "⻄丁⽬", "😀", "Ærøskøbing", "naïveté œuvre", "$100 (B)", "A$B"]:
        assert restorer(text) == (None, False), text
    assert restorer("\u001b$B" + "窃盗".encode("iso2022_jp").decode()[3:])[1]
    assert restorer("$B@`Ep(B") == ("窃盗", True)
    assert restorer("çª\x83ç\x9b\x97".encode().decode("latin-1")) == ("窃盗", True)


def test_rows_of_both_tables(spark):
    inc = spark.createDataFrame([(1, "窃盗", "x"), (2, "çª\x83ç\x9b\x97", "x"), (2, "çª\x83ç\x9b\x97", "x"), (3, None, "x"), (4, "", "x"), (5, "�" * 100_000, "x")], "row_id bigint, `罪名` string, value string")
    bnd = spark.createDataFrame([(7, "鶯見", "x"), (8, "é¶¯è¦\x8b", "x")], "rec_no bigint, s_name string, src string")
    areas = spark.createDataFrame(AREAS, AREA)
    assert sorted(tuple(r) for r in mojibake.found(inc, bnd, areas).collect()) == [("boundary", 8), ("incidents", 2), ("incidents", 2), ("incidents", 5)]
    assert {r.restored for r in mojibake.restored(inc, bnd, areas).collect()} == {"鶯見", "窃盗", None}
    assert mojibake.found(inc.where("false"), bnd.where("false"), areas.where("false")).count() == 0


def test_names_of_any_length_and_real_shards(spark):
    long = "あ" * 20 + "鷺沼" * 40
    areas = [(1, "c", "市", "県", long, long, None), (2, "c", "市", "県", "鷺野町", "鷺野町", None), (3, "c", "市", "県", "鷺田町", "鷺田町", None), (4, "d", "市", "県", "桜町", "桜町", None)] + [(10 + i, "c", "市", "県", f"甲{chr(0x4E8C + i)}通", None, None) for i in range(40)]
    listed = spark.createDataFrame(areas, "area_id bigint, city_code string, city_name string, pref string, name string, key string, yomi string")
    values = [long[:-1] + "野", long + "鷺鷺鷺", "鷺町", "鷺野町付近", "県市鷺野町", "桜町", "山" * 200_000, "*" * 100_000 + "山", "(" * 100_000]
    rows = [(i, "c", v) for i, v in enumerate(values)] + [(100 + i, "c", "鷺野長") for i in range(60)] + [(900, None, "鷺野町"), (901, "e", "鷺野町")]
    entries = spark.createDataFrame(rows, "entry_id bigint, city_code string, s_name string")
    small = {r.entry_id: r.area_id for r in canonical.map_values(entries, listed).collect()}
    assert [small[i] for i in range(6)] == [1, 0, 0, 2, 2, 0] and small[6] == small[7] == small[8] == small[900] == small[901] == 0 and small[100] == 2
    want = canonical.wanted(entries, listed)
    winners = canonical.shard_winners(want, listed, 7, 3)
    assert {r.entry_id: r.area_id for r in canonical.merge(winners, want, listed).collect()} == small


def test_banded_distance_is_the_full_one():
    rnd = __import__("random").Random(5)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 9)))
    for _ in range(3000):
        a, b = word(), word()
        full = canonical.distance(a, b, len(a) + len(b) + 1)
        for most in range(5):
            got = canonical.distance(a, b, most)
            assert got == full if full <= most else got > most


def test_long_lists_of_names_still_decide_lossy_damage(spark):
    names = [(f"甲{chr(0x4E00 + i)}", None) for i in range(600)] + [("鷺野", "鷺野")] * 3
    areas = spark.createDataFrame(names, "name string, key string")
    assert len(mojibake.known_pairs(areas)) == 601
    bad = "鷺野".encode().decode("cp932", "ignore")
    boundary = spark.createDataFrame([(1, bad), (2, "鷺野"), (3, None), (4, "鷺野".encode().decode("cp1252", "replace").encode("utf-8").decode("cp1252", "replace"))], "rec_no bigint, s_name string")
    incidents = spark.createDataFrame([(1, "窃盗"), (2, "$B@`Ep")], "row_id bigint, `罪名` string")
    got = {(r.src, r.row_id) for r in mojibake.found(incidents, boundary, areas).collect()}
    assert ("boundary", 1) in got and ("boundary", 4) in got and ("boundary", 2) not in got and ("incidents", 1) not in got
