"""Schemas that drift between files."""

import json
import random

from tallyspan.operators import drift

ROWS = "row_id bigint, _file string, _year int, _extra map<string,string>, column string, kind string, before string"
FILES = "file_id bigint, _file string, series_no bigint, _year int, stage string, tok string"


def build(spark, files):
    """files: {(series, year): [extra dicts]}"""
    rows, meta, n = [], [], 0
    for (s, y), extras in files.items():
        f = f"s{s}_{y}.csv"
        meta.append((len(meta), f, s, y, "loaded", "x"))
        for e in extras:
            n += 1
            rows.append((n, f, y, e, "clash", "clash", "clash"))
    return spark.createDataFrame(rows, ROWS), spark.createDataFrame(meta, FILES)


def found(spark, files):
    return {tuple(r) for r in drift.changes(*build(spark, files)).collect()}


def sample(rnd, **cols):
    return [{k: str(v(rnd)) for k, v in cols.items()} for _ in range(80)]


def test_kinds_of_change(spark):
    rnd = random.Random(2)
    place, lock, age, money = (lambda r: r.choice(["路上", "公園", "駅周辺"])), (lambda r: r.choice(["施錠した", "施錠せず"])), (lambda r: r.randint(1, 99)), (lambda r: r.randint(1, 900) * 100)
    files = {
        (1, 2018): sample(rnd, 場所=place, 施錠=lock, 年齢=age),
        (1, 2020): sample(rnd, 発生場所=place, 施錠=lock, 年齢=lambda r: f"{r.randint(1, 9)}0歳代", 被害額=money),
        (1, 2021): sample(rnd, **{"﻿発生場所 ": place, "年齢": lambda r: f"{r.randint(1, 9)}0歳代", "損害": money}),
        (2, 2020): sample(rnd, 別=place),
    }
    assert found(spark, files) == {
        ("s1_2020.csv", "renamed", "場所", "発生場所"), ("s1_2020.csv", "retyped", "年齢", "年齢"), ("s1_2020.csv", "added", "", "被害額"),
        ("s1_2021.csv", "removed", "施錠", ""), ("s1_2021.csv", "renamed", "被害額", "損害"),
    }


def test_plain_answers_need_a_common_header(spark):
    rnd = random.Random(3)
    yes = lambda r: r.choice(["あり", "なし"])
    files = {(1, 1): sample(rnd, 現金被害の有無=yes), (1, 2): sample(rnd, 防犯カメラの有無=yes), (2, 1): sample(rnd, 現金被害の有無=yes), (2, 2): sample(rnd, 現金被害=yes)}
    assert found(spark, files) == {("s1_2.csv", "removed", "現金被害の有無", ""), ("s1_2.csv", "added", "", "防犯カメラの有無"), ("s2_2.csv", "renamed", "現金被害の有無", "現金被害")}


def test_nulls_blanks_ties_empty(spark):
    files = {(1, 1): [{"a": "1", "b": None, " b": "2"}, None, {"a": "x"}], (1, 2): [None, {"a": " ", "b": "", "": "z"}], (1, 3): []}
    assert found(spark, files) == {("s1_3.csv", "removed", "a", ""), ("s1_3.csv", "removed", "b", "")}
    assert found(spark, {}) == set()
    long = "長" * 100_000
    assert found(spark, {(1, 1): [{"a": long}] * 3, (1, 2): [{"c": long}] * 3}) == {("s1_2.csv", "renamed", "a", "c")}


def test_only_loaded_files_of_a_series(spark):
    rows, meta = build(spark, {(1, 1): [{"a": "1"}], (1, 2): [{"b": "x"}]})
    meta = meta.withColumn("stage", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("raw"))
    assert drift.changes(rows, meta).count() == 0


def test_rescue_and_replay(spark):
    rows, _ = build(spark, {(1, 1): [{"年齢": "31", "x": "1"}, {"年齢": "不明"}, {"歳": " 40 ", "届出日": "2024/2/30"}, {"届出日": "20240131", "歳": "old"}, None]})
    target = {"年齢": "integer", "届出日": "date"}
    got = {r.row_id: (r["年齢"], str(r["届出日"]), json.loads(r._rescued) if r._rescued else None) for r in drift.promote(rows, target, {"歳": "年齢"}).collect()}
    assert got == {1: (31, "None", {"x": "1"}), 2: (None, "None", {"年齢": "不明"}), 3: (40, "None", {"届出日": "2024/2/30"}), 4: (None, "2024-01-31", {"歳": "old"}), 5: (None, "None", None)}


def test_types(spark):
    vals = {"12": "integer", "1.5": "decimal", "-1.5": "decimal", "-3": "text", "2024-1-2": "date", "2024/01/02": "date", "2024-1/2": "text", "１２": "text", "x": "text"}
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert {r[0]: r[1] for r in df.select("v", drift.value_type(df.v)).collect()} == vals
