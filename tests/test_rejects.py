"""Rows that fail to parse."""

import csv
import io
import random

from tallyspan.operators import rejects

HEAD = ",".join(rejects.COMMON)
SCHEMA = "line_id bigint, _file string, _year int, line_no int, raw string, received_at timestamp, reason string, delim string"


def table(spark, rows):
    return spark.createDataFrame([(i, f, 2020, n, raw, None, "clash", "clash") for i, f, n, raw in rows], SCHEMA)


def good(day="2020-02-29", hour="8", code="612013", town="甲"):
    return f"窃盗,自転車盗,a,b,{code},c,d,{town},{day},{hour}"


def reasons(spark, rows):
    return {r.line_id: r.reason for r in rejects.rejected(table(spark, rows)).collect()}


def test_reasons(spark):
    rows = [
        (1, "f", 1, "﻿" + HEAD), (2, "f", 2, good()), (3, "f", 3, good(town='"甲""乙"",\n丙"')), (4, "f", 4, good(town='甲"乙')), (5, "f", 5, good(town='"甲"乙')), (6, "f", 6, good() + ","),
        (7, "f", 7, "窃盗"), (8, "f", 8, good(day="2021-02-29")), (9, "f", 9, good(hour="24")), (10, "f", 10, good(code="6120")), (11, "f", 11, good(day="２０２０年２月２９日", hour="０８", code="６１２０１")),
        (12, "f", 12, good(hour="")), (13, "f", 13, ' "" , ,\t'), (14, "f", 14, ""), (15, "f", 15, None), (16, "f", 16, good(day="20200101 ")), (17, "f", 17, good(day="2020/1-3")), (18, "f", 18, good(day="00000101")),
    ]
    assert reasons(spark, rows) == {4: "quoting", 5: "quoting", 6: "column_count", 7: "column_count", 8: "value", 9: "value", 10: "value", 17: "value", 18: "value"}


def test_tabs_quoted_header_missing_columns_and_no_header(spark):
    rows = [
        (1, "t", 1, "\t".join(f'"{c}"' for c in rejects.COMMON)), (2, "t", 2, good().replace(",", "\t")), (3, "t", 3, good()),
        (4, "m", 1, "罪名,手口"), (5, "m", 2, "x,y"), (6, "m", 3, "x"), (7, "n", 2, "a,b"), (8, "n", 3, 'a"b'), (9, None, 2, "a,b"), (10, "d", 1, "罪名,罪名"), (11, "d", 2, "x,y"),
    ]
    assert reasons(spark, rows) == {3: "column_count", 6: "column_count", 7: "column_count", 8: "quoting", 9: "column_count"}


def test_load_keeps_rest_and_corrupt_text(spark):
    rows = [(1, "f", 1, HEAD + ",施錠関係,施錠関係"), (2, "f", 2, good() + ',"x""y",z'), (3, "f", 3, "bad")]
    got = {r.line_id: r for r in rejects.load(table(spark, rows)).collect()}
    assert got[2]["罪名"] == "窃盗" and got[2]["_extra"] == {"施錠関係": 'x"y'} and got[2]["_corrupt"] is None
    assert got[3]["_corrupt"] == "bad" and got[3]["罪名"] is None and got[3]["reason"] == "column_count"


def test_empty_long_and_repeated(spark):
    assert reasons(spark, []) == {}
    long = good(town='"' + 'a""' * 200_000 + '"')
    rows = [(1, "f", 1, HEAD), (2, "f", 2, long), (4, "f", 4, good(hour="99")), (5, "f", 5, good(hour="99"))]
    assert reasons(spark, rows) == {4: "value", 5: "value"}


def strict(raw, d):
    """Brute force: a state machine over characters."""
    fields, i = [], 0
    while True:
        if i < len(raw) and raw[i] == '"':
            j, out = i + 1, []
            while True:
                k = raw.find('"', j)
                if k < 0:
                    return None
                out.append(raw[j:k])
                if raw[k + 1 : k + 2] == '"':
                    out.append('"')
                    j = k + 2
                    continue
                i = k + 1
                break
            fields.append("".join(out))
        else:
            k = raw.find(d, i)
            k = len(raw) if k < 0 else k
            if '"' in raw[i:k]:
                return None
            fields.append(raw[i:k])
            i = k
        if i == len(raw):
            return fields
        if raw[i] != d:
            return None
        i += 1


def test_against_state_machine(spark):
    rnd = random.Random(3)
    rows = [(0, "f", 1, "a,b,c")] + [(i, "f", i + 1, "".join(rnd.choice('ab,"" \n') for _ in range(rnd.randint(1, 14)))) for i in range(1, 1500)]
    want = {}
    for i, _, _, raw in rows[1:]:
        if raw.strip(',"\n '):
            got = strict(raw, ",")
            if got is None:
                want[i] = "quoting"
            elif len(got) != 3:
                want[i] = "column_count"
    assert reasons(spark, rows) == want


def test_round_trip_with_csv_module(spark):
    rnd = random.Random(5)
    rows, want = [(0, "f", 1, "a,b,c")], {}
    for i in range(1, 200):
        vals = ["".join(rnd.choice('xy,"\n ') for _ in range(rnd.randint(0, 6))) + "z" for _ in range(3)]
        buf = io.StringIO()
        csv.writer(buf, lineterminator="").writerow(vals)
        rows.append((i, "f", i + 1, buf.getvalue()))
        want[i] = vals
    got = {r.line_id: [rejects_unquote(x) for x in r.fields] for r in rejects.read_permissive(table(spark, rows)).collect()}
    assert got == want


def rejects_unquote(x):
    return x[1:-1].replace('""', '"') if x.startswith('"') else x
