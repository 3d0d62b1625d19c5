"""Disclosure control, counting, matching, audits: golden vectors and brute force."""

import random

from pyspark.sql import functions as F

from tallyspan.functions import party, places, sdc
from tallyspan.operators import audit, cube, matching, observe, publish
from tallyspan.operators.suppress import suppress


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_rate_and_count_rules(spark):
    pairs = [(10, 499), (10, 500), (0, 7), (0, 0), (2, 5000), (3, 5000)]
    assert column(spark, pairs, "n long, p long", sdc.suppress_rate(F.col("n"), F.col("p"))) == [True, False, False, True, True, False]
    pairs = [(2, 5000), (10, 400), (10, 5000), (0, 0), (5, None)]
    assert column(spark, pairs, "n long, p long", sdc.rate_per_1k(F.col("n"), F.col("p"))) == [None, None, 2.0, None, None]
    pairs = [(98, 0), (3, 0), (28, 4), (225, 93), (3, 26), (5, 57), (3, 300)]
    assert column(spark, pairs, "n long, p long", sdc.suppress_count(F.col("n"), F.col("p"))) == [False, False, False, False, True, True, False]
    assert column(spark, [(0,), (1,), (2,), (3,), (1500,)], "n long", sdc.bucket_label(F.col("n"))) == ["0", "1-2", "1-2", "3", "1500"]
    grid = [(n, p) for n in (0, 1, 2, 3, 9, 100) for p in (0, 1, 100, 499, 500, 5000)]
    for (n, p), got in zip(grid, column(spark, grid, "n long, p long", sdc.rate_reason(F.col("n"), F.col("p")))):
        want = "no_population" if p == 0 else "shown" if n == 0 else "suppressed" if p < 500 or n <= 2 else "shown"
        assert got == want


def test_city_rate_scales_and_bars(spark):
    rows = [(6000, 400_000, 30), (6000, 400_000, 5), (6000, 400_000, 500), (1, 400_000, 30), (5, 900, 1), (5, 0, 1), (0, 400_000, 1)]
    got = [(None if r.value is None else float(r.value), r.scale) for r in column(spark, rows, "t long, p long, k long", sdc.city_rate(F.col("t"), F.col("p"), F.col("k")))]
    assert got == [(15.0, 1), (15.0, 1), (None, None), (None, None), (None, None), (None, None), (0.0, 2)]
    tops = [(0,), (1,), (3,), (5,), (6,), (10,), (11,), (21,), (99,), (100,), (None,)]
    assert column(spark, tops, "t long", sdc.nice_ceiling(F.col("t"))) == [1, 1, 5, 5, 10, 10, 20, 50, 100, 100, 1]
    assert column(spark, [(None,), (0,), (2,), (5,), (99,)], "n long", sdc.bar_width(F.col("n"), F.lit(10))) == [0, 0, 0, 50, 100]
    assert column(spark, [(None,), (0,), (3,), (5,), (24,)], "n long", sdc.class_of(F.col("n"), sdc.CLASS_TOTAL)) == [None, 0, 1, 1, 4]
    assert audit.breaks_in_small(sdc.CLASS_TOTAL) == [] and audit.breaks_in_small([2, 6]) == [2]


def loop(values, pops):
    """Brute force: hide the next smallest cell until nothing hidden is determined by bounds and total."""
    n = len(values)
    small = [1 <= v <= 2 for v in values]
    line = [not s and v > 0 and p and v <= p and p < 100 and v <= 5 for s, v, p in zip(small, values, pops)]
    added = []

    def determined():
        hid = [i for i in range(n) if small[i] or line[i] or i in added]
        total = sum(values[i] for i in hid)
        lo = {i: 1 if small[i] else 3 for i in hid}
        hi = {i: 2 if small[i] else 5 if line[i] else total for i in hid}
        for _ in range(60):
            for i in hid:
                lo[i] = max(lo[i], total - sum(hi[j] for j in hid if j != i))
                hi[i] = min(hi[i], total - sum(lo[j] for j in hid if j != i))
        return any(lo[i] == hi[i] for i in hid if i not in added)

    rest = sorted((i for i in range(n) if values[i] > 2 and not line[i]), key=lambda i: (values[i], i))
    while determined() and rest:
        added.append(rest.pop(0))
    wide = any(line) or added
    return ["withheld" if line[i] or i in added or small[i] and wide else "small" if small[i] else "shown" for i in range(n)], determined()


def test_suppression_against_the_loop(spark):
    rnd = random.Random(9)
    groups = {"a": ([9, 7, 5], [900] * 3), "b": ([9, 7, 1, 5], [900] * 4), "c": ([1, 2, 4, 30, 40, 50], [900, 900, 26, 900, 900, 900]), "d": ([], [])}
    for k in range(250):
        n = rnd.randint(1, 7)
        groups[f"g{k}"] = ([rnd.randint(0, 9) for _ in range(n)], [rnd.choice([0, 50, 90, 900]) for _ in range(n)])
    rows = [(g, i, v, p, "x") for g, (vs, ps) in groups.items() for i, (v, p) in enumerate(zip(vs, ps))]
    got: dict = {}
    for r in suppress(spark.createDataFrame(rows, "g string, o long, v long, p long, _m string"), ["g"], "v", ["o"], "p").collect():
        got.setdefault(r.g, []).append((r.o, r.state, r.pinned, r.published))
    for g, (vs, ps) in groups.items():
        if vs:
            states, pinned = loop(vs, ps)
            mine = sorted(got[g])
            assert [s for _, s, _, _ in mine] == states, (g, vs, ps)
            assert {x for _, _, x, _ in mine} == {pinned}, (g, vs, ps)
            assert [x for *_, x in mine] == [v if s == "shown" else None for v, s in zip(vs, states)]


def test_suppression_edges(spark):
    schema = "g string, o long, v long"
    assert suppress(spark.createDataFrame([], schema), ["g"], "v", ["o"]).count() == 0
    got = {(r.g, r.o): r.state for r in suppress(spark.createDataFrame([(None, 1, None), (None, 2, 1), (None, 3, 8)], schema), ["g"], "v", ["o"]).collect()}
    assert got == {(None, 1): "shown", (None, 2): "withheld", (None, 3): "withheld"}


def test_place_keys(spark):
    cases = {"潮江１丁目": "潮江1丁目", "弥生ヶ丘町": "弥生ケ丘町", "玄番北之町": "玄番北ノ町", "武庫之荘西二丁目": "武庫ノ荘西2丁目", "甲子園八番町": "甲子園八番町", "名神町十二丁目": "名神町12丁目", "上ッ町 01丁目": "上ツ町1丁目", None: "", " ": ""}
    df = places.with_key(spark.createDataFrame([(k,) for k in cases], "name string"), "name")
    assert {r.name: r.key for r in df.collect()} == cases
    assert column(spark, [("282022",), ("28204",), ("",), (None,), ("2820x",)], "c string", places.city_code5(F.col("c"))) == ["28202", "28204", "", "", ""]
    assert [places.read_number(s) for s in ("九", "十", "十二", "二十", "九十九", "x")] == [9, 10, 12, 20, 99, None]
    assert places.read_number("十x") is None and places.read_number("十x", 0) == 10 and places.digits_of("梅田一丁目二番町") == "梅田1丁目2番町"


def test_addresses(spark):
    codes = spark.createDataFrame([("大阪府", "大阪市北区", "27127"), ("兵庫県", "尼崎市", "28202"), ("兵庫県", "西宮市", "28204")], "pref string, city string, city_code string")
    towns = spark.createDataFrame([("28204", "上ケ原2番町"), ("28204", "上ケ原"), ("28204", "甲子園8番町")], "city_code string, town string")
    rows = [("大阪府", "大阪市北区", "梅田一丁目１番１号"), ("兵庫県", "尼崎市", "潮江1丁目3番1号"), ("兵庫県", "西宮市", "大字上ケ原　二番町3-5"), ("兵庫県", "西宮市", "甲子園八番町"), ("兵庫県", "無い市", "知らない町3-5"), (None, None, None)]
    got = {r.addr: (r.town, r.town_source, r.addr_key, r.addr_key_town) for r in places.normalize_addresses(spark.createDataFrame(rows, "pref string, city string, addr string"), codes, towns).collect()}
    assert got["大阪市北区梅田1-1-1"] == ("梅田1", "marker", "27127|梅田1-1-1", "27127|梅田1")
    assert got["尼崎市潮江1-3-1"][2:] == ("28202|潮江1-3-1", "28202|潮江1")
    assert got["西宮市上ケ原2番町3-5"] == ("上ケ原2番町", "list", "28204|上ケ原2番町3-5", "28204|上ケ原2番町")
    assert got["西宮市甲子園8番町"][3] == "28204|甲子園8番町" and got["無い市知らない町3-5"][1:] == ("unknown", "", "") and got[""][0] == ""


def test_longest_prefix_of_any_length(spark):
    rows = spark.createDataFrame([(1, "c", "甲" * 60 + "乙"), (2, "c", "甲" * 59), (3, "d", "甲" * 60), (4, "c", ""), (5, "c", None)], "_id long, city_code string, text string")
    towns = spark.createDataFrame([("c", "甲" * 60), ("c", "甲甲"), ("c", None)], "city_code string, town string")
    assert {r._id: r.town for r in places.longest_prefix(rows, towns).collect()} == {1: "甲" * 60, 2: "甲甲"}
    assert places.longest_prefix(rows, towns.where("false")).count() == 0


def test_matching_decisions(spark):
    areas = spark.createDataFrame([(1, "c", "武庫ノ荘西"), (2, "c", "名神町"), (3, "c", "名神町1丁目"), (4, "c", "潮江1丁目"), (5, "d", "潮江2丁目")], "area_id long, city_code string, key string")
    rows = [(1, "c", "潮江１丁目"), (2, "c", "武庫之荘西2丁目"), (3, "c", "名神町3丁目"), (4, "c", "潮江"), (5, "c", "潮江2丁目"), (6, "c", " "), (7, "c", None), (8, None, "潮江1丁目")]
    m = matching.match(spark.createDataFrame(rows, "id long, city string, town string"), areas)
    got = {r.id: (r.area_id, r.box) for r in m.collect()}
    assert got == {1: (4, None), 2: (1, None), 3: (None, "undecided"), 4: (None, "undecided"), 5: (None, "unobserved"), 6: (None, "unobserved"), 7: (None, "unobserved"), 8: (None, "unobserved")}
    assert {r.box: r.n for r in matching.not_counted(m).collect()} == {"unresolved": 0, "unobserved": 4, "undecided": 2, "gone": 0}


def test_registered_queries_normalize_names(spark, tmp_path):
    from tallyspan.plans.core_queries import QUERIES

    boundary = [(3, "c", 8101, "甲１丁目", "k2", 5, 1), (1, "c", 8101, "甲一丁目", "k1", 7, 2), (2, "c", 8101, "甲1丁目", "k1", 7, 2), (4, "c", 8101, "乙", None, 1, 1)]
    counts = [(1, "c", "甲１丁目"), (2, "c", "乙の二丁目"), (3, "c", "丙"), (4, "c", None)]
    areas = [(1, "c", "甲1丁目"), (2, "c", "乙ノ")]
    for name, rows, schema in (("boundary", boundary, "rec_no long, city_code string, hcode int, s_name string, key_code string, jinko long, setai long"), ("area_counts", counts, "count_id long, city_code string, key string"), ("areas", areas, "area_id long, city_code string, key string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    run = lambda q: QUERIES[q](spark, str(tmp_path)).collect()
    assert {r.key: (r.name, r.code, r.jinko, r.setai, r.n_records) for r in run("merge_same_name")} == {"甲1丁目": ("甲一丁目", "k1", 19, 5, 3), "乙": ("乙", None, 1, 1, 1)}
    assert [(r.key, r.codes) for r in run("codes_in_order")] == [("甲1丁目", ["k1", "k2"])]
    assert {r.count_id: r.area_id for r in run("decision_table_match")} == {1: 1, 2: 2, 3: None, 4: None}
    assert {r.count_id for r in run("rejects")} == {3, 4}
    assert [(r.n_rows, r.n_matched) for r in run("match_rate")] == [(4, 2)]


def test_counting_is_dense(spark):
    rows = [(1, "612013", "自転車盗", "8", 2024), (2, "61201", "その他", "２３", 2024), (3, "61201", None, "99", 2023), (4, "x", "自転車盗", "", 2024), (5, "61202", "自動車盗", None, 2010)]
    df = spark.createDataFrame([(i, c, k, h, "甲", y) for i, c, k, h, y in rows], f"row_id long, `{cube.CODE}` string, `{cube.CATEGORY}` string, `{cube.HOUR}` string, `{cube.TOWN}` string, _year int")
    f = cube.incidents(df)
    assert {(r.city, r.band): r.n for r in cube.hour_counts(f).collect() if r.n} == {("61201", "6-12"): 1, ("61201", "18-24"): 2}
    assert cube.hour_counts(f).count() == 8
    assert {(r.city, r.layer): r.n for r in cube.layer_counts(f).collect()} == {("61201", "bicycle"): 1, ("61201", "vehicle"): 0, ("61202", "bicycle"): 0, ("61202", "vehicle"): 1}
    assert [r.category for r in cube.outside_layers(f).collect()] == ["その他"]
    assert cube.in_window(f).where("year = 2010").count() == 0
    import pytest

    with pytest.raises(ValueError):
        cube.refuse_parents(cube.multi_grain(f), ["a"])


def test_area_cells_count_every_spelling(spark):
    areas = [(1, "61201", "潮江1丁目", "潮江一丁目"), (2, "61201", "武庫ノ荘西", "武庫之荘西"), (3, "61201", "名神町", "名神町"), (4, "61201", "名神町1丁目", "名神町一丁目"), (5, "61202", "潮江1丁目", "潮江一丁目")]
    towns = ["潮江１丁目", "潮江一丁目", "潮江1丁目", "潮江 01丁目", "潮江", "武庫の荘西", "武庫之荘西２丁目", "名神町３丁目", "名神町", "名神町一丁目", "無い町", " ", None]
    rows = [(i, c, k, t) for i, (c, k, t) in enumerate((c, k, t) for c in ("612013", "61202", "x") for k in ("自転車盗", "自動車盗", "その他") for t in towns)]
    df = spark.createDataFrame([(i, c, k, "8", t, 2024) for i, c, k, t in rows], f"row_id long, `{cube.CODE}` string, `{cube.CATEGORY}` string, `{cube.HOUR}` string, `{cube.TOWN}` string, _year int")
    listed = spark.createDataFrame([(i, c, k, n, 100) for i, c, k, n in areas], "area_id long, city_code string, key string, name string, jinko long")
    placed = {"61201": {1: 4, 2: 2, 3: 1, 4: 1}, "61202": {5: 4}}
    want = {(c, a, layer): placed[c].get(a, 0) for a, c, _, _ in areas for layer in ("bicycle", "vehicle")}
    assert {(r.city, r.area_id, r.layer): r.v for r in cube.area_cells(cube.incidents(df), listed).collect()} == want


def test_audit_finds_leaks(spark):
    cells = spark.createDataFrame([("a", 1, None, "small", 500), ("a", 2, None, "small", 500), ("a", 3, 9, "shown", 500), ("b", 1, None, "withheld", 500), ("b", 2, None, "small", 500), ("c", 1, 4, "shown", 50), ("c", 2, 1, "shown", 0)], "g string, area_id long, published long, state string, pop long")
    s = spark.createDataFrame([("a", 11), ("b", 9), ("c", 5)], "g string, s long")
    assert {r.g: (r.m, r.verdict) for r in audit.margins(cells, s, ["g"]).collect()} == {"a": (0, "recoverable"), "b": (None, "mixed labels"), "c": (None, "nothing hidden")}
    got = {(r.g, r.area_id): (r.new_lo, r.new_hi, r.solved) for r in audit.intervals(cells, s, ["g"]).collect()}
    assert got["a", 1] == (1, 1, True) and got["b", 1] == (7, 8, False)
    assert {r.verdict for r in audit.population_line(cells).collect()} == {"unsafe", "kept"} and audit.raw_small(cells).count() == 1
    texts = spark.createDataFrame([(1, "桜は 1,012 件\n他"), (2, "桜 1013"), (3, "梅 1012"), (4, None)], "id long, text string")
    parents = spark.createDataFrame([("桜", 1000, 12)], "clue string, shown long, k long")
    assert {(r.id, r.line_no, r.verdict) for r in audit.text_parents(texts, "text", parents).collect()} == {(1, 1, "unique"), (2, 1, "narrowed")}
    assert column(spark, [(5, 2), (40, 20), (3, 4), (3, 0)], "n long, k long", audit.choose(F.col("n"), F.col("k"))) == [10, 137846528820, 0, 1]


def test_audit_of_texts_over_many_hidden_cells(spark):
    texts = spark.createDataFrame([(n, f"桜 {n}") for n in (139, 140, 141, 210, 279, 280, 281)], "id long, text string")
    parents = spark.createDataFrame([("桜", 0, 140)], "clue string, shown long, k long")
    got = {r.id: r.verdict for r in audit.text_parents(texts, "text", parents).collect()}
    assert got == {140: "unique", 141: "narrowed", 210: "narrowed", 279: "narrowed", 280: "unique"}


def test_party_and_redaction(spark):
    names = {"山田太郎": "individual", "大阪市": "corp", "国": "corp", "オークワ　ほか": "corp", "F.O.B COOP": "corp", "大阪市北区角田町３番25号": "individual", "カタカナ商事": "individual", "三井住友ファイナンス": "individual", None: "individual", "": "individual"}
    assert {r[0]: r[1] for r in spark.createDataFrame([(n,) for n in names], "n string").select("n", party.party_kind(F.col("n"))).collect()} == names
    assert column(spark, [("尼崎市潮江1-3-1", "individual"), ("尼崎市潮江1-3-1", "corp")], "a string, k string", party.redact_addr(F.col("a"), F.col("k"))) == ["尼崎市潮江1", "尼崎市潮江1-3-1"]


def test_completeness_and_caps(spark):
    rows = [({"a": "はい", "b": "はい"},), ({"a": "はい", "b": "いいえ"},), ({"a": "はい", "b": "分からない"},), ({"a": "はい"},), (None,)]
    assert column(spark, rows, "m map<string,string>", observe.complete(F.col("m"), ["a", "b"])) == [True, False, None, None, None]
    assert column(spark, rows[:1], "m map<string,string>", observe.complete(F.col("m"), [])) == [None]
    assert column(spark, [(12, 0, None), (12, 0, True), (0, 0, None)], "b long, n long, e boolean", observe.zero_rows(F.col("b"), F.col("n"), F.col("e"))) == ["分からない", "はい", "はい"]
    snap = spark.createDataFrame([(1, f"p{i}") for i in range(10)] + [(2, f"p{i}") for i in range(5)] + [(4, f"p{i}") for i in range(3)], "run_no int, path string")
    assert {r.run_no: r.alarm for r in observe.vanished(snap).collect()} == {2: True, 4: False}
    days = spark.createDataFrame([("a", d) for d in (1, 1, 7, 8, 20)], "who string, day int")
    assert {r.day: r.n_within for r in observe.rolling_counts(days, "who", "day", 7).collect()} == {1: 1, 7: 2, 8: 1, 20: 0}
    tries = spark.createDataFrame([("p", "r", d) for d in (1, 10, 20, 31, 32, 40)] + [("p", "q", 10)], "party string, route string, day int")
    assert sorted((r.route, r.day, r.accepted) for r in observe.accept_in_turn(tries, 2, 30).collect()) == [("q", 10, True), ("r", 1, True), ("r", 10, False), ("r", 20, True), ("r", 31, True), ("r", 32, False), ("r", 40, False)]


def test_fingerprint_ignores_order(spark):
    a = spark.createDataFrame([("z", f"n{i}", "d") for i in range(50)], "g string, n string, d string")
    b = a.orderBy(F.desc("n")).repartition(7)
    c = a.withColumn("d", F.when(F.col("n") == "n3", "e").otherwise(F.col("d")))
    one = lambda df: observe.fingerprint(df, ["g"], "n", "d").first()
    assert one(a) == one(b) and one(a).fingerprint != one(c).fingerprint and one(a).n_members == 50


def test_templates():
    import pytest

    assert publish.render("a {{x}} b", {"x": "1"}) == "a 1 b"
    for bad in ({}, {"x": "1", "y": "2"}):
        with pytest.raises(ValueError):
            publish.render("a {{x}} b", bad)


def test_fingerprint_is_the_digest_of_the_sorted_members(spark):
    import hashlib

    rows = [(g, f"n{i}", None if i == 3 else f"d{i}") for g in ("a", "b", None) for i in range(2500)] + [("c", None, "x")]
    got = {r.g: (r.fingerprint, r.n_members) for r in observe.fingerprint(spark.createDataFrame(rows, "g string, n string, d string").repartition(5), ["g"], "n", "d").collect()}
    for g in ("a", "b", None, "c"):
        mine = sorted((n or "", d or "") for k, n, d in rows if k == g)
        assert got[g] == (hashlib.sha256("".join(f"{n}\0{d}\n" for n, d in mine).encode()).hexdigest(), len(mine))
    assert observe.fingerprint(spark.createDataFrame([], "g string, n string, d string"), ["g"], "n", "d").count() == 0


def test_stamps_caps_and_repeated_attempts(spark):
    stamps = spark.createDataFrame([("p", 1, "2024-01-05"), ("p", 2, "2024-01-04"), ("p", 3, None), ("p", 4, "2024-01-04"), ("q", 1, "2024-01-01")], "path string, run_no int, stamp string")
    assert [(r.path, r.run_no, r.before) for r in observe.moved_back(stamps, ["path"], "run_no", "stamp").collect()] == [("p", 2, "2024-01-05")]
    days = spark.createDataFrame([("a", 1, True), ("a", 3, True), ("a", 4, False), ("a", 9, True)], "who string, day int, busy boolean")
    assert {r.day: r.goes_on for r in observe.congestion(days, "who", "day", F.col("busy")).collect()} == {1: False, 3: True, 4: False, 9: False}
    tries = spark.createDataFrame([("p", "r", 1)] * 5000 + [("q", "r", 2), (None, "r", 1)], "party string, route string, day int")
    got = observe.accept_in_turn(tries, 2, 30)
    assert got.count() == 5002 and {(r.party, r.n) for r in got.where("accepted").groupBy("party").agg(F.count("*").alias("n")).collect()} == {("p", 1), ("q", 1), (None, 1)}


def test_grid_bars_and_parents(spark):
    cells = spark.createDataFrame([("a", 1, 1, "small", None), ("a", 2, 2, "small", None), ("a", 3, 9, "shown", 9)], "city string, area_id long, v long, state string, published long").withColumns({"layer": F.lit("l"), "pop": F.lit(900)})
    assert {(r.edition, r.n) for r in audit.editions(cells).groupBy("edition").agg(F.count("published").alias("n")).collect()} == {("raw", 3), ("primary", 1), ("final", 1)}
    cities = spark.createDataFrame([("a", "x", 5), ("a", "y", None), ("b", "x", 4), ("b", "y", 3)], "city string, category string, count long")
    layers = spark.createDataFrame([("l", "x"), ("l", "y")], "layer string, category string")
    assert {r.city: r.s for r in audit.published_parents(cities, layers).collect()} == {"a": None, "b": 7}
    page = '<tr><td class="v num">1-2件</td><td class="barcell"><i style="width:3.0%"></i></td></tr><tr><td class="v num">非公開</td><td class="barcell"></td></tr><tr><td class="v num">9件</td><td class="barcell"><i style="width:90.0%"></i></td></tr>'
    assert {(r.label, r.leaks) for r in audit.bar_leaks(spark.createDataFrame([("p", page)], "path string, html string")).collect()} == {("1-2件", True), ("非公開", False)}
    with_parent = audit.intervals(cells.withColumn("g", F.lit("g")), spark.createDataFrame([("g", 12)], "g string, s long"), ["g"])
    assert {(r.area_id, r.solved) for r in with_parent.where("state <> 'shown'").collect()} == {(1, False), (2, False)}
    assert audit.missing_parents(cells, ["city"], spark.createDataFrame([("z",)], "city string")).count() == 2
