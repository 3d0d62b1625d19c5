"""Boundary records merged to areas, and areas that touch each other.

Merging keeps the order of first appearance. Neighbours are found without comparing all pairs: every area is filed under the grid
cells its widened box touches, areas meet per cell, pairs are made unique and only then measured exactly.

Defined results: records without name or of another kind than ``KEEP`` are skipped and counted; null populations count 0; a geometry that is
null or not a (multi)polygon has no neighbours; polygons are filed one by one, so parts far apart cost no more; a repeated record appears as a member again, as delivered.
"""

from __future__ import annotations

import math
import struct

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspan.functions.places import with_key

KEEP = 8101  # kind of record that is an area (fixed value)
TOUCH = 2e-5  # degrees within which areas count as touching (fixed value)
CELL = 0.005


def usable(records: DataFrame) -> DataFrame:
    return records.where((F.col("hcode") == KEEP) & F.col("s_name").isNotNull())


def skipped(records: DataFrame) -> DataFrame:
    return records.agg(F.count_if(~F.coalesce(F.col("hcode") == KEEP, F.lit(False)) | F.col("s_name").isNull()).alias("n_skipped"), F.count("*").alias("n_records"))


def merge(records: DataFrame, key: str | None = None) -> DataFrame:
    """One row per city and key: first name, first code, codes in order, population, households, ordinal of the first record."""
    rows = usable(records)
    rows = rows.withColumn("key", F.col(key)) if key else with_key(rows, "s_name")
    g = rows.groupBy("city_code", "key").agg(
        F.min_by("s_name", "rec_no").alias("name"), F.min_by("key_code", F.when(F.col("key_code").isNotNull(), F.col("rec_no"))).alias("code"),
        F.sum(F.coalesce("jinko", F.lit(0))).alias("jinko"), F.sum(F.coalesce("setai", F.lit(0))).alias("setai"), F.min("rec_no").alias("ord"), F.count("*").alias("n_records"),
    )
    return g


def codes_in_order(records: DataFrame, key: str | None = None) -> DataFrame:
    """Distinct codes of each key (or other column) in the order of first appearance: a bounded list per area, of distinct codes only."""
    rows = usable(records).where(F.col("key_code").isNotNull())
    rows, key = (rows, key) if key else (with_key(rows, "s_name"), "key")
    first = rows.groupBy("city_code", key, "key_code").agg(F.min("rec_no").alias("at"))
    return first.groupBy("city_code", key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "key_code"))), lambda x: x["key_code"]).alias("codes"))


def polygons(wkb: bytes | None) -> list[list[list[tuple[float, float]]]]:
    """Polygons of a WKB polygon or multipolygon, each a list of rings, the outer one first."""
    if not wkb or len(wkb) < 9:
        return []
    out: list[list[list[tuple[float, float]]]] = []

    def read(at: int) -> int:
        e = "<" if wkb[at] == 1 else ">"
        kind, n = struct.unpack_from(e + "II", wkb, at + 1)
        at += 9
        if kind % 1000 == 6:
            for _ in range(n):
                at = read(at)
            return at
        if kind % 1000 != 3:
            raise ValueError(kind)
        own = []
        for _ in range(n):
            (m,) = struct.unpack_from(e + "I", wkb, at)
            xy = struct.unpack_from(e + f"{2 * m}d", wkb, at + 4)
            own.append(list(zip(xy[::2], xy[1::2])))
            at += 4 + 16 * m
        if own and own[0]:
            out.append(own)
        return at

    try:
        read(0)
    except (struct.error, ValueError, IndexError):
        return []
    return out


def rings(wkb: bytes | None) -> list[list[tuple[float, float]]]:
    """Rings of a WKB polygon or multipolygon."""
    return [r for p in polygons(wkb) for r in p]


def combined(parts: list[bytes]) -> bytes | None:
    """WKB multipolygon of every different polygon of ``parts``; null if there is none."""
    own = []
    for w in parts:
        own += [p for p in polygons(w) if p not in own]
    if not own:
        return None
    ring = lambda r: struct.pack("<I", len(r)) + struct.pack(f"<{2 * len(r)}d", *(x for p in r for x in p))
    return struct.pack("<BII", 1, 6, len(own)) + b"".join(struct.pack("<BII", 1, 3, len(p)) + b"".join(map(ring, p)) for p in own)


@F.pandas_udf(T.BinaryType())
def multipolygon(s: pd.Series) -> pd.Series:
    return s.map(lambda parts: combined([bytes(w) for w in parts]))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("x0", "y0", "x1", "y1")])))
def boxes(s: pd.Series) -> pd.Series:
    """Box of every polygon."""
    def one(w):
        xy = [list(zip(*p[0])) for p in polygons(w)]
        return [{"x0": min(x), "y0": min(y), "x1": max(x), "y1": max(y)} for x, y in xy]

    return s.map(one)


def _apart(a, b, c, d) -> float:
    """Distance of segments ab and cd."""
    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def point(p, q, r):
        l2 = (r[0] - q[0]) ** 2 + (r[1] - q[1]) ** 2
        t = 0.0 if l2 == 0 else max(0.0, min(1.0, ((p[0] - q[0]) * (r[0] - q[0]) + (p[1] - q[1]) * (r[1] - q[1])) / l2))
        return math.hypot(p[0] - q[0] - t * (r[0] - q[0]), p[1] - q[1] - t * (r[1] - q[1]))

    if side(a, b, c) * side(a, b, d) < 0 and side(c, d, a) * side(c, d, b) < 0:
        return 0.0
    return min(point(a, c, d), point(b, c, d), point(c, a, b), point(d, a, b))


def _inside(p, ring) -> bool:
    hit = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > p[1]) != (y2 > p[1]) and p[0] < (x2 - x1) * (p[1] - y1) / (y2 - y1) + x1:
            hit = not hit
    return hit


def gap(one: bytes, two: bytes) -> float:
    """Distance of two (multi)polygons, 0 if they overlap."""
    a, b = polygons(one), polygons(two)
    if not a or not b:
        return math.inf
    within = lambda p, poly: _inside(p, poly[0]) and not any(_inside(p, hole) for hole in poly[1:])
    if any(within(p[0][0], q) or within(q[0][0], p) for p in a for q in b):
        return 0.0
    sides = lambda polys: [side for p in polys for r in p for side in zip(r, r[1:])]
    two_sides = sides(b)
    return min((_apart(p, q, r, s) for p, q in sides(a) for r, s in two_sides), default=math.inf)


@F.pandas_udf(T.DoubleType())
def gaps(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([gap(x, y) for x, y in zip(a, b)], dtype="float64")


def simplify_ring(ring: list, tolerance: float = TOUCH) -> list:
    """Douglas-Peucker with an explicit stack; a ring keeps at least a triangle."""
    keep, todo = {0, len(ring) - 1}, [(0, len(ring) - 1)]
    if len(ring) > 3:
        far = max(range(len(ring)), key=lambda i: math.dist(ring[i], ring[0]))
        keep.add(far)
        todo = [(0, far), (far, len(ring) - 1)]
    while todo:
        i, j = todo.pop()
        if j - i < 2:
            continue
        k = max(range(i + 1, j), key=lambda n: _apart(ring[n], ring[n], ring[i], ring[j]))
        if _apart(ring[k], ring[k], ring[i], ring[j]) > tolerance:
            keep.add(k)
            todo += [(i, k), (k, j)]
    out = [ring[i] for i in sorted(keep)]
    return out if len(out) >= 4 else ring


@F.pandas_udf(T.StringType())
def geojson_geometry(s: pd.Series) -> pd.Series:
    """GeoJSON of the (simplified) polygon; parts of a merged area come as one multipolygon."""
    import json

    def one(w):
        got = [[[list(p) for p in simplify_ring(r)] for r in polygon] for polygon in polygons(w)]
        return json.dumps({"type": "MultiPolygon", "coordinates": got}, separators=(",", ":")) if got else None

    return s.map(one, na_action="ignore")


def one_shape_per_area(records: DataFrame, name: str = "s_name") -> DataFrame:
    """``city_code``, ``area`` (normalized key), ``geom_wkb``: a multipolygon of the area's parts, one for each code: the first record of the
    newest edition that has the code. Records without a code count as one code more."""
    rows = with_key(usable(records).where(F.col("geom_wkb").isNotNull()), name, "area")
    parts = rows.groupBy("city_code", "area", "key_code").agg(F.min_by("geom_wkb", F.struct(-F.col("edition"), F.col("rec_no"))).alias("part"), F.min("rec_no").alias("at"))
    listed = parts.groupBy("city_code", "area").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda x: x["part"]).alias("parts"))
    return listed.select("city_code", "area", multipolygon("parts").alias("geom_wkb"))


def neighbours(shapes: DataFrame, touch: float = TOUCH, cell: float = CELL) -> DataFrame:
    """``city_code``, ``area``, ``neighbour`` of shapes (``city_code``, ``area``, ``geom_wkb``) at most ``touch`` apart, both directions."""
    filed = shapes.withColumn("b", F.explode(boxes("geom_wkb")))
    span = lambda lo, hi: F.sequence(F.floor((F.col(lo) - touch) / cell), F.floor((F.col(hi) + touch) / cell))
    filed = filed.withColumn("cx", F.explode(span("b.x0", "b.x1"))).withColumn("cy", F.explode(span("b.y0", "b.y1")))
    a = filed.select("city_code", "cx", "cy", F.col("area").alias("area"), F.col("b").alias("ba"))
    b = filed.select("city_code", "cx", "cy", F.col("area").alias("neighbour"), F.col("b").alias("bb"))
    close = (F.col("ba.x0") - touch <= F.col("bb.x1")) & (F.col("bb.x0") - touch <= F.col("ba.x1")) & (F.col("ba.y0") - touch <= F.col("bb.y1")) & (F.col("bb.y0") - touch <= F.col("ba.y1"))
    pairs = a.join(b, ["city_code", "cx", "cy"]).where((F.col("area") < F.col("neighbour")) & close).select("city_code", "area", "neighbour").distinct()
    geo = shapes.select("city_code", "area", "geom_wkb")
    measured = pairs.join(geo, ["city_code", "area"]).withColumnRenamed("geom_wkb", "ga").join(geo.select("city_code", F.col("area").alias("neighbour"), F.col("geom_wkb").alias("gb")), ["city_code", "neighbour"])
    hit = measured.where(gaps("ga", "gb") <= touch).select("city_code", "area", "neighbour")
    return hit.unionByName(hit.select("city_code", F.col("neighbour").alias("area"), F.col("area").alias("neighbour")))
