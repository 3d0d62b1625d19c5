"""Files, geometry, web rules, sinks, streaming."""

import io
import json
import math
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from tallyspan.functions import web
from tallyspan.operators import boundary, rejects
from tallyspan.sources import files, sinks
from tallyspan.streaming import ingest


def test_sniff():
    assert files.sniff(b"\xef\xbb\xbfa") == "utf-8-sig" and files.sniff("窃盗".encode()) == "utf-8" and files.sniff("窃盗①㈱".encode("cp932")) == "cp932"
    assert files.sniff(("a" * 4095 + "窃").encode()[:4096]) == "utf-8"
    assert files.sniff("窃".encode()[:2], whole=True) == "cp932"


def test_csv_files_of_several_encodings(spark, tmp_path):
    text = ",".join(rejects.COMMON) + '\r\n窃盗,自転車盗,a,b,612013,c,d,"甲\n①",20240101,8\r\n'
    for name, enc in (("p_2020a.csv", "utf-8-sig"), ("p_2021a.csv", "cp932"), ("p_2022a.csv", "utf-8")):
        (tmp_path / name).write_bytes(text.encode(enc))
    (tmp_path / "p_2023a.csv").write_bytes(b"")
    raw = files.read_incident_csv(spark, str(tmp_path))
    got = rejects.load(raw).collect()
    assert {(r._file, r._year, r["町丁目（発生地）"]) for r in got} == {(f"p_{y}a.csv", y, "甲\n①") for y in (2020, 2021, 2022)}


def square(x, y, s=1.0):
    pts = [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    return struct.pack("<BIII", 1, 3, 1, 5) + b"".join(struct.pack("<2d", *p) for p in pts)


def test_neighbours_against_brute_force(spark):
    rnd = random.Random(4)
    shapes = [("c", f"a{i}", square(rnd.randint(0, 9) * 0.01, rnd.randint(0, 9) * 0.01, rnd.choice([0.01, 0.02]))) for i in range(60)] + [("c", "none", None), ("c", "bad", b"xx"), ("d", "far", square(0, 0, 0.01))]
    df = spark.createDataFrame(shapes, "city_code string, area string, geom_wkb binary")
    got = {(r.area, r.neighbour) for r in boundary.neighbours(df).collect()}
    want = {(a, b) for c, a, x in shapes for e, b, y in shapes if c == e and a != b and x and y and boundary.gap(x, y) <= boundary.TOUCH}
    assert got == want and len(want) > 20
    assert boundary.gap(square(0, 0), square(3, 4)) == pytest.approx(math.hypot(2, 3)) and boundary.gap(square(0, 0, 5), square(1, 1)) == 0
    assert boundary.simplify_ring([(0, 0), (1, 1e-7), (2, 0), (2, 2), (0, 2), (0, 0)]) == [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)]


def test_shape_of_all_parts(spark):
    rows = [
        (1, "甲一丁目", "k1", 2015, square(50, 50)), (2, "甲一丁目", "k1", 2020, square(0, 0)), (3, "甲１丁目", "k2", 2020, square(10, 0)), (4, "甲1丁目", "k2", 2020, square(70, 70)), (5, "甲一丁目", "k3", 2015, square(20, 0)),
        (6, "甲一丁目", None, 2020, square(0, 0)), (7, "乙", "k4", 2020, square(11, 0)), (8, "丙", "k5", 2020, square(21, 0)), (9, "丁", "k6", 2020, square(50, 51)), (10, "戊", "k7", 2020, b"xx"),
    ]
    df = spark.createDataFrame([("c", 8101, *r) for r in rows], "city_code string, hcode int, rec_no long, s_name string, key_code string, edition int, geom_wkb binary")
    shapes = boundary.one_shape_per_area(df).cache()
    parts = {r.area: [p[0][0] for p in boundary.polygons(r.geom_wkb and bytes(r.geom_wkb))] for r in shapes.collect()}
    assert parts == {"甲1丁目": [(0, 0), (10, 0), (20, 0)], "乙": [(11, 0)], "丙": [(21, 0)], "丁": [(50, 51)], "戊": []}
    assert {(r.area, r.neighbour) for r in boundary.neighbours(shapes, cell=0.5).collect()} == {("甲1丁目", "乙"), ("乙", "甲1丁目"), ("甲1丁目", "丙"), ("丙", "甲1丁目")}
    shown = {r.area: r.g for r in shapes.select("area", boundary.geojson_geometry("geom_wkb").alias("g")).collect()}
    assert [p[0][0] for p in json.loads(shown["甲1丁目"])["coordinates"]] == [[0, 0], [10, 0], [20, 0]] and shown["戊"] is None
    ring = lambda x, y, s: struct.pack("<I", 5) + square(x, y, s)[13:]
    holed = struct.pack("<BII", 1, 3, 2) + ring(0, 0, 9) + ring(1, 1, 7)
    assert boundary.gap(holed, square(4, 4)) == 3 and boundary.gap(holed, square(0.2, 0.2, 0.5)) == 0


def test_merge(spark):
    rows = [(1, "c", 8101, "西立花町二丁目", "k1", 487, 2), (2, "c", 8101, "西立花町２丁目", "k2", 1674, 3), (3, "c", 8154, "水面", None, 0, 0), (4, "c", 8101, None, "k", 1, 1), (5, "c", 8101, "東", None, None, None)]
    df = spark.createDataFrame(rows, "rec_no long, city_code string, hcode int, s_name string, key_code string, jinko long, setai long")
    got = {r.key: (r.name, r.code, r.jinko, r.setai, r.ord, r.n_records) for r in boundary.merge(df).collect()}
    assert got == {"西立花町2丁目": ("西立花町二丁目", "k1", 2161, 5, 1, 2), "東": ("東", None, 0, 0, 5, 1)}
    assert boundary.skipped(df).first().n_skipped == 2


def test_shapefile_in_zip(spark, tmp_path):
    fields = [("HCODE", "N", 5), ("S_NAME", "C", 20), ("JINKO", "N", 6)]
    rec = [(8101, "甲一丁目", 12), (8154, "水", None)]
    size = 1 + sum(w for *_, w in fields)
    dbf = struct.pack("<4BIHH20x", 3, 1, 1, 1, len(rec), 32 + 32 * len(fields) + 1, size) + b"".join(struct.pack("<11sc4xBB14x", n.encode(), k.encode(), w, 0) for n, k, w in fields) + b"\r"
    for r in rec:
        dbf += b" " + b"".join((str(v) if v is not None else "").rjust(w).encode("cp932")[:w] if k == "N" else v.encode("cp932").ljust(w) for (_, k, w), v in zip(fields, r))
    ring = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (0.0, 0.0)]
    poly = struct.pack("<i4dii", 5, 0, 0, 1, 1, 1, 4) + struct.pack("<i", 0) + b"".join(struct.pack("<2d", *p) for p in ring)
    shp = b"\0" * 100 + struct.pack(">II", 1, len(poly) // 2) + poly + struct.pack(">II", 2, 2) + struct.pack("<i", 0)
    with zipfile.ZipFile(tmp_path / "r2ka61201.zip", "w") as z:
        z.writestr("r2ka61201.dbf", dbf)
        z.writestr("r2ka61201.shp", shp)
    got = files.read_boundaries(spark, str(tmp_path)).orderBy("rec_no").collect()
    assert [(r.city_code, r.hcode, r.s_name, r.jinko) for r in got] == [("61201", 8101, "甲一丁目", 12), ("61201", 8154, "水", None)]
    assert boundary.rings(bytes(got[0].geom_wkb)) == [ring] and got[1].geom_wkb is None
    members = {(r.name, r.error) for r in files.zip_members(spark, str(tmp_path), [".dbf", ".shx"]).collect()}
    assert members == {("r2ka61201.dbf", None), ("r2ka61201.shp", None), (".shx", "missing member")}


def test_bad_archives_and_registry(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"no zip")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("../up.txt", "x")
    (tmp_path / "y.zip").write_bytes(buf.getvalue())
    got = {r.archive: r.error for r in files.zip_members(spark, str(tmp_path)).collect()}
    assert got["y.zip"] == "path leaves the archive" and got["x.zip"]
    (tmp_path / "r.json").write_text(json.dumps({"common": ["a"], "extra": {"k": ["b", "c"]}, "optional": ["d"]}))
    assert files.registry(spark, str(tmp_path / "r.json")).count() == 4 and files.registry(spark, str(tmp_path / "none.json")).count() == 0
    listed = spark.createDataFrame([("a/b.md",), ("a.md",), ("secret/x.md",), ("secret/ok.md",), ("secretly.md",), ("z.py",)], "rel string")
    assert {r.rel for r in files.published_files(listed, ["secret"], ["secret/ok.md"], [".md"]).collect()} == {"a/b.md", "a.md", "secret/ok.md", "secretly.md"}


def verdict(spark, rules, urls):
    r = spark.createDataFrame([("*", a, p) for a, p in rules], "agent_group string, allow boolean, pattern string")
    u = spark.createDataFrame([(x, "*") for x in urls], "path string, agent_group string")
    return {x.path: x.allowed for x in web.allowed(u, r).collect()}


def test_robots(spark):
    assert verdict(spark, [(False, "/a/"), (True, "/a/b/")], ["/a/b/c", "/a/c"]) == {"/a/b/c": True, "/a/c": False}
    assert verdict(spark, [(True, "/a/"), (False, "/a/b/"), (False, "/t"), (True, "/t")], ["/a/b/c", "/t", "/robots.txt"]) == {"/a/b/c": False, "/t": True, "/robots.txt": True}
    assert verdict(spark, [(False, "/*.pdf$"), (False, "/q.E\\Q")], ["/y.pdf", "/y.pdf?v=1", "/q.E\\Qx", "/qxE"]) == {"/y.pdf": False, "/y.pdf?v=1": True, "/q.E\\Qx": False, "/qxE": True}
    text = "﻿User-agent: a\nUser-agent: Bot/2 # x\nDisallow: /x\nCrawl-delay: 12\n\nUser-agent: *\nDisallow:\nDisallow: /y\n"
    df = spark.createDataFrame([("h", text), ("g", None), ("s", "User-agent: *\nDisallow: /z")], "host string, body string")
    got = {(r.host, r.allow, r.pattern, r.delay) for r in web.robots_rules(df, ["bot"]).collect()}
    assert got == {("h", False, "/x", None), ("h", None, None, 12.0), ("s", False, "/z", None)}
    assert web._bytes_normal("/%7Ejoe/%2f日") == "/~joe/%2F%E6%97%A5"


def test_url_scope(spark):
    base = "https://e.example"
    cases = [(f"{base}/p?id=21424", f"{base}/p?id=21424", True), (f"{base}/p?id=214240", f"{base}/p?id=21424", False), (f"{base}/f.csv", f"{base}/f.csv", True), (f"{base}/f.csv?x=1", f"{base}/f.csv", False), (f"{base}/data/a/b.csv", f"{base}/data/", True)]
    cases += [(f"{base}/database/x", f"{base}/data/", False), ("http://e.example/data/x", f"{base}/data/", False), ("https://e.example:8443/data/x", f"{base}/data/", False), ("https://u@e.example/data/x", f"{base}/data/", False), (f"{base}/data/%2e%2e/x", f"{base}/data/", False), (None, f"{base}/", False)]
    df = spark.createDataFrame(cases, "u string, s string, w boolean")
    assert all(r[0] == r[1] for r in df.select("w", web.in_scope(F.col("u"), F.col("s"))).collect())


def test_headings_and_scans(spark):
    html = "<title>A &amp; b</title><script>h1</script><h1>C <b>d</b></h1><H2 class='x'>E</H2><meta name=\"description\" content=\"F\"><h4>no</h4>"
    assert spark.createDataFrame([(html,), (None,)], "h string").select(web.headings(F.col("h")).alias("x")).first().x == ["A &amp; b", "C d", "E", "F"]
    df = spark.createDataFrame([(1, "x\nyy bad zz 1,234 5"), (2, None), (3, "")], "id long, t string")
    assert [(r.id, r.line_no, r.word) for r in web.word_hits(df, "t", ["bad"]).collect()] == [(1, 2, "bad")]
    assert df.select(web.number_tokens(F.col("t")).alias("n")).first().n == [1234, 5]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("k", "w", "i"), ("k", "w", "a")], "kind string, where string, item string")
    sinks.write_findings(rows, str(tmp_path / "f"))
    assert [r.item for r in spark.read.json(str(tmp_path / "f")).collect()] == ["a", "i"]
    with pytest.raises(ValueError):
        sinks.store_observation(rows, rows, str(tmp_path / "o"))
    sinks.store_observation(rows, rows.where("false"), str(tmp_path / "o"))
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.store_observation(rows, rows.where("false"), str(tmp_path / "o"))
    feats = spark.createDataFrame([("c", "2", '{"b":1}'), ("c", "1", '{"a":null}')], "city string, code string, feature string")
    sinks.write_features(feats, str(tmp_path / "g"))
    assert spark.read.text(str(tmp_path / "g"), wholetext=True).first().value.strip() == '{"type":"FeatureCollection","features":[{"a":null},\n{"b":1}]}'


def test_stream_takes_each_record_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    rows = spark.sql("select 1L line_id, 'f' _file, 2020 _year, 1 line_no, 'a' raw, timestamp'2024-01-01' received_at")
    for i in range(2):
        rows.withColumn("line_id", F.lit(i).cast("long")).write.mode("append").parquet(src)
        ingest.ingest(spark, src, out, cp).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_records_are_cut_at_line_breaks_only(spark, tmp_path):
    from tallyspan.sources import files

    (tmp_path / "a_2020.csv").write_text('h1,h2\na\u2028b,"x\ny"\r\nc\x0cd,e\n"open,' + "z\n" * 20_000, encoding="utf-8", newline="")
    got = [r.raw for r in files.read_incident_csv(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert got[:3] == ["h1,h2", 'a\u2028b,"x\ny"', "c\x0cd,e"] and len(got) == 4 and got[3].startswith('"open,z')


def test_holes_of_shapes_stay_holes():
    import struct

    from tallyspan.operators.boundary import polygons
    from tallyspan.sources.files import read_shp

    outer, hole, island = [(0, 0), (0, 9), (9, 9), (9, 0), (0, 0)], [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)], [(20, 0), (20, 1), (21, 1), (21, 0), (20, 0)]
    points = [p for ring in (outer, hole, island) for p in ring]
    body = struct.pack("<i4d2i3i", 5, 0, 0, 21, 9, 3, 15, 0, 5, 10) + b"".join(struct.pack("<2d", *p) for p in points)
    (wkb,) = read_shp(b"\0" * 100 + struct.pack(">2I", 1, len(body) // 2) + body)
    assert [len(p) for p in polygons(wkb)] == [2, 1]
