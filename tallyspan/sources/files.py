"""Sources: delivered CSV files of several encodings, boundary shapefiles, archives, JSON registries, published pages.

Listing and sniffing are done where the files are (``binaryFile``), never by collecting contents on the driver. Files of one encoding are
read by one scan; the number of scans is the number of encodings.
"""

from __future__ import annotations

import codecs
import hashlib
import io
import re
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD = 4096


def sniff(head: bytes, whole: bool = False) -> str:
    """utf-8-sig, utf-8 or cp932 from the first bytes; a character cut by the end of ``head`` is no error."""
    if head.startswith(codecs.BOM_UTF8):
        return "utf-8-sig"
    try:
        codecs.getincrementaldecoder("utf-8")().decode(head, final=whole)
        return "utf-8"
    except UnicodeDecodeError:
        return "cp932"


@F.pandas_udf(T.StringType())
def encoding_of(content: pd.Series, length: pd.Series) -> pd.Series:
    return pd.Series([sniff(c[:HEAD], n <= HEAD) for c, n in zip(content, length)])


def binary(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path``, ``name``, ``length``, ``sha256``, ``modified`` of every file below ``path``."""
    return binary(spark, path, pattern).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))


BREAK = re.compile(r"\r\n|\r|\n")


def read_incident_csv(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """Every record of the CSV files below ``path`` in the shape of the raw-record table (``_file``, ``_year``, ``line_no``, ``raw``, ``encoding``).

    Decoding keeps line breaks inside quotes: records are cut by a quote-aware reader per file, files are spread over tasks."""

    def records(text: str) -> Iterator[str]:
        # cut at CR and LF only; marks are counted line by line, so an unclosed quotation costs nothing twice
        begin = at = marks = 0
        for m in BREAK.finditer(text):
            marks += text.count('"', at, m.start())
            at = m.end()
            if marks % 2 == 0:
                yield text[begin : m.start()]
                begin, marks = at, 0
        if begin < len(text):
            yield text[begin:].rstrip("\r\n")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf.path, pdf.content):
                enc = sniff(content[:HEAD], len(content) <= HEAD)
                rows = list(records(content.decode(enc, "replace")))
                name = p.rsplit("/", 1)[-1]
                year = next((int(name[i : i + 4]) for i in range(len(name) - 3) if name[i : i + 4].isdigit() and name[i : i + 2] in ("19", "20")), None)
                yield pd.DataFrame({"_file": name, "_year": pd.array([year] * len(rows), dtype="Int32"), "line_no": pd.array(range(1, len(rows) + 1), dtype="int32"), "raw": rows, "encoding": enc})

    files = binary(spark, path, pattern).select("path", "content")
    got = files.mapInPandas(run, "_file string, _year int, line_no int, raw string, encoding string")
    return got.withColumn("line_id", F.xxhash64("_file", "line_no"))


def csv_name(pref: str, year: int, category_code: str, overrides: dict[tuple[int, str], str] | None = None) -> str:
    """File name of a year and category, with exceptions by file."""
    return (overrides or {}).get((year, category_code), f"{pref}_{year}{category_code}.csv")


def plan(spark: SparkSession, prefs: list[str], years: list[int], codes: list[str]) -> DataFrame:
    """Every file that a full delivery holds."""
    p = spark.createDataFrame([(x,) for x in prefs], "pref string")
    y = spark.createDataFrame([(x,) for x in years], "year int")
    c = spark.createDataFrame([(x,) for x in codes], "code string")
    return p.crossJoin(y).crossJoin(c).withColumn("file", F.concat("pref", F.lit("_"), F.col("year").cast("string"), "code", F.lit(".csv")))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """A JSON registry ``{common: [], extra: {category: []}, optional: []}`` as rows ``kind``, ``category``, ``item``. A missing file is empty, a corrupt one an error."""
    from pyspark.errors import AnalysisException

    schema = "common array<string>, extra map<string,array<string>>, optional array<string>"
    try:
        raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)
    except AnalysisException:
        return spark.createDataFrame([], "kind string, category string, item string")
    pick = lambda k: raw.select(F.lit(k).alias("kind"), F.lit("").alias("category"), F.explode(k).alias("item"))
    extra = raw.select(F.explode("extra").alias("category", "items")).select(F.lit("extra").alias("kind"), "category", F.explode("items").alias("item"))
    return pick("common").unionByName(extra).unionByName(pick("optional"))


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """A flat JSON object as rows ``key``, ``value``."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,string>")).alias("key", "value"))


def read_dbf(data: bytes, encoding: str = "cp932") -> list[dict]:
    """Records of a dBASE table."""
    n, header, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode("ascii")
        fields.append((name, chr(data[at + 11]), data[at + 16], data[at + 17]))
        at += 32
    out = []
    for i in range(n):
        pos, row = header + i * size + 1, {}
        for name, kind, width, decimals in fields:
            text = data[pos : pos + width].decode(encoding, "replace").strip()
            row[name] = (float(text) if decimals else int(text)) if kind in "NF" and text else None if kind in "NF" else text
            pos += width
        out.append(row)
    return out


def _turns_left(ring: tuple) -> bool:
    """Counter-clockwise ring (x and y alternate): a hole of a shapefile polygon."""
    x, y = ring[::2], ring[1::2]
    return sum((x[k + 1] - x[k]) * (y[k + 1] + y[k]) for k in range(len(x) - 1)) < 0


def _holds(ring: tuple, px: float, py: float) -> bool:
    x, y, hit = ring[::2], ring[1::2], False
    for k in range(len(x) - 1):
        if (y[k] > py) != (y[k + 1] > py) and px < (x[k + 1] - x[k]) * (py - y[k]) / (y[k + 1] - y[k]) + x[k]:
            hit = not hit
    return hit


def read_shp(data: bytes) -> list[bytes | None]:
    """Polygons of a shapefile as WKB, in order; null shapes stay null. A clockwise ring is a polygon, any other a hole of the polygon that holds it (of
    none: a polygon itself)."""
    out, at = [], 100
    while at + 8 <= len(data):
        (words,) = struct.unpack_from(">I", data, at + 4)
        body, at = data[at + 8 : at + 8 + 2 * words], at + 8 + 2 * words
        (kind,) = struct.unpack_from("<i", body, 0)
        if kind % 10 != 5:
            out.append(None)
            continue
        parts, points = struct.unpack_from("<ii", body, 36)
        begins = [*struct.unpack_from(f"<{parts}i", body, 44), points]
        base = 44 + 4 * parts
        rings = [struct.unpack_from(f"<{2 * (b - a)}d", body, base + 16 * a) for a, b in zip(begins, begins[1:])]
        polygons = [[r] for r in rings if not _turns_left(r)]
        for r in (r for r in rings if _turns_left(r)):
            home = next((p for p in polygons if _holds(p[0], r[0], r[1])), None)
            if home is None:
                polygons.append([r])
            else:
                home.append(r)
        packed = b"".join(struct.pack("<BII", 1, 3, len(p)) + b"".join(struct.pack("<I", len(r) // 2) + struct.pack(f"<{len(r)}d", *r) for r in p) for p in polygons)
        out.append(struct.pack("<BII", 1, 6, len(polygons)) + packed)
    return out


def read_boundaries(spark: SparkSession, path: str, pattern: str = "r2ka*.zip") -> DataFrame:
    """Boundary records of zipped shapefiles below ``path``: the columns of the boundary table, ``rec_no`` unique over files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf.path, pdf.content):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    by = {m.rsplit(".", 1)[-1].lower(): m for m in z.namelist()}
                    rows, shapes = read_dbf(z.read(by["dbf"])), read_shp(z.read(by["shp"]))
                name = p.rsplit("/", 1)[-1]
                city = "".join(c for c in name.removeprefix("r2ka") if c.isdigit())[:5]
                salt = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
                yield pd.DataFrame(
                    [(salt * 1_000_000 + i, city, r.get("HCODE"), r.get("S_NAME"), r.get("KEY_CODE"), r.get("JINKO"), r.get("SETAI"), s) for i, (r, s) in enumerate(zip(rows, shapes))],
                    columns=["rec_no", "city_code", "hcode", "s_name", "key_code", "jinko", "setai", "geom_wkb"],
                ).astype({"hcode": "Int32", "jinko": "Int64", "setai": "Int64"})

    return binary(spark, path, pattern).select("path", "content").mapInPandas(run, "rec_no bigint, city_code string, hcode int, s_name string, key_code string, jinko bigint, setai bigint, geom_wkb binary")


def zip_members(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """Members of archives: ``archive``, ``name``, ``size``, ``sha256``, ``error`` (bad checksum, a path that leaves the archive, a missing member)."""
    need = [r.lower() for r in required or []]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, content in zip(pdf.path, pdf.content):
                name = p.rsplit("/", 1)[-1]
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        seen = set()
                        for m in z.infolist():
                            if m.is_dir():
                                continue
                            base = m.filename.replace("\\", "/")
                            seen.add(base.rsplit("/", 1)[-1].lower())
                            bad = base.startswith("/") or ".." in base.split("/")
                            try:
                                data = z.read(m)
                                rows.append((name, base, m.file_size, hashlib.sha256(data).hexdigest(), "path leaves the archive" if bad else None))
                            except zipfile.BadZipFile as e:
                                rows.append((name, base, m.file_size, None, str(e)))
                        rows += [(name, r, None, None, "missing member") for r in need if not any(s.endswith(r) for s in seen)]
                except zipfile.BadZipFile as e:
                    rows.append((name, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["archive", "name", "size", "sha256", "error"]).astype({"size": "Int64"})

    return binary(spark, path, "*.zip").select("path", "content").mapInPandas(run, "archive string, name string, size bigint, sha256 string, error string")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Properties of published GeoJSON features, one row each."""
    schema = "features array<struct<properties: struct<code: string, name: string, jinko: bigint, n: array<bigint>, w: array<boolean>, neighbors: array<string>>>>"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("features").alias("f")).select("f.properties.*")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Rows of published HTML tables: ``path``, ``label``, ``value``, ``width`` (null where there is no bar)."""
    pat = r'<th scope="row">(.*?)</th><td class="v num">(.*?)</td><td class="barcell">(.*?)</td>'
    whole = spark.read.text(path, wholetext=True, pathGlobFilter="*.html").select(F.col("_metadata.file_path").alias("path"), "value")
    rows = whole.select("path", F.explode(F.arrays_zip(*[F.regexp_extract_all("value", F.lit(pat), F.lit(i)) for i in (1, 2, 3)])).alias("r"))
    width = F.nullif(F.regexp_extract(F.col("r")["2"], r"width:([0-9.]+)%", 1), F.lit("")).cast("double")
    return rows.select("path", F.col("r")["0"].alias("label"), F.col("r")["1"].alias("value"), width.alias("width"))


def published_files(files: DataFrame, excluded: list[str], kept: list[str], suffixes: list[str]) -> DataFrame:
    """Files (``rel``) that are published: not at or under an excluded path, or kept by name; with one of the suffixes."""
    under = F.lit(False)
    for q in excluded:
        under = under | (F.col("rel") == q) | F.startswith(F.col("rel"), F.lit(q.rstrip("/") + "/"))
    ends = F.lit(False)
    for s in suffixes:
        ends = ends | F.endswith(F.col("rel"), F.lit(s))
    return files.where((~under | F.col("rel").isin(kept)) & ends)
