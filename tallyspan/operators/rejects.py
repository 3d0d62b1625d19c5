"""Rows that fail to parse: permissive read of delimited records under their file's header, rejects with a reason.

Each record is read permissively under an explicit schema, the header of its own file: a record that fits becomes its
fields, one that does not keeps its raw text in ``_corrupt``. Corrupt records are then classified by quoting, field count
and cast checks, in that order. Everything is a JVM expression. Headers (one row per file) are broadcast where a count proves them small:
then no record is shuffled. Beyond that records meet their header in salted groups, so a huge file is many tasks.

Defined results
---------------
* null ``raw`` or ``_file``: a null ``raw`` is a blank record; records of a file without header (or with a null ``_file``)
  can only fail on ``quoting`` or, having no header to agree with, on ``column_count``.
* blank records (delimiters, quotes, white-space only) are neither loaded nor rejected.
* a header lacking one of the checked columns: that check does not apply. A header naming a column twice: the first counts.
* several header lines in a file: the one of the lowest ``line_id`` counts, none of them is a record.
* repeated records are judged one by one; very long records need constant stack (possessive patterns only).
* extra input columns, also ones named like this module's own, are ignored by ``read_permissive``: it selects what it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions.text import fold_width, trim_header, trim_space
from tallyspan.session import BROADCAST_ROWS, left_join_dimension

CITY, DAY, HOUR = "市区町村コード（発生地）", "発生年月日（始期）", "発生時（始期）"
#: Columns every incident file has.
COMMON = ["罪名", "手口", "管轄警察署（発生地）", "管轄交番・駐在所（発生地）", CITY, "都道府県（発生地）", "市区町村（発生地）", "町丁目（発生地）", DAY, HOUR]
DELIMITERS = [",", "\t", ";", "|"]


def _field(d: Column) -> Column:
    return F.concat(F.lit(r'(?:"(?:[^"]++|"")*+"|[^"'), d, F.lit("]*+)"))


def quoting_pattern(d: Column) -> Column:
    return F.concat(F.lit(r"\A"), _field(d), F.lit("(?:["), d, F.lit("]"), _field(d), F.lit(r")*+\z"))


def fields_pattern(d: Column) -> Column:
    """Every match takes the delimiter before its field, so empty fields are matches too; the record gets one in front."""
    return F.concat(F.lit("["), d, F.lit("]("), _field(d), F.lit(")"))


def blank_pattern(d: Column) -> Column:
    return F.concat(F.lit(r'\A[\s\p{Z}\x{FEFF}"'), d, F.lit(r"]*+\z"))


def unquote(c: Column) -> Column:
    return F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)


def split_fields(raw: Column, delim: Column) -> Column:
    """Raw (still quoted) fields of a record whose quoting is right."""
    return F.regexp_extract_all(F.concat(delim, raw), fields_pattern(delim), F.lit(1))


def headers(records: DataFrame) -> DataFrame:
    """One row per file: ``h_file``, delimiter, header fields, positions of the checked columns (0: none)."""
    bare = F.regexp_replace(F.col("h_raw"), r"\A\x{FEFF}++", "")
    outside = F.regexp_replace(bare, r'"(?:[^"]++|"")*+"', "")
    n = [F.length(outside) - F.length(F.replace(outside, F.lit(d), F.lit(""))) for d in DELIMITERS]
    most = F.greatest(*n)
    delim = F.lit(DELIMITERS[-1])
    for d, k in list(zip(DELIMITERS, n))[-2::-1]:
        delim = F.when(k == most, F.lit(d)).otherwise(delim)
    return (
        records.where((F.col("line_no") == 1) & F.col("raw").isNotNull())
        .groupBy(F.col("_file").alias("h_file"))
        .agg(F.min_by("raw", "line_id").alias("h_raw"))
        .select("h_file", delim.alias("delim"), bare.alias("h_raw"))
        .select("h_file", "delim", F.transform(split_fields(F.col("h_raw"), F.col("delim")), lambda x: trim_header(unquote(trim_header(x)))).alias("names"))
        .select("h_file", "delim", "names", *[F.array_position("names", c).cast("int").alias(f"at_{k}") for k, c in (("city", CITY), ("day", DAY), ("hour", HOUR))])
    )


def day_parts(v: Column) -> Column:
    """``[year, month, day]`` of YYYYMMDD or of year, month, day with ``-``, ``/`` or 年月日; other texts give nulls."""
    dashed = F.regexp_replace(v, r"\A(\d{4})(?:(\d{2})(\d{2})|([-/])(\d{1,2})\4(\d{1,2})|年(\d{1,2})月(\d{1,2})日)\z", "$1~$2$5$7~$3$6$8")
    return F.transform(F.split(dashed, "~"), lambda x: x.try_cast("int"))


def day_exists(parts: Column) -> Column:
    y, m, d = (F.get(parts, F.lit(k)) for k in range(3))
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m.isin(4, 6, 9, 11), 30).when((m == 2) & leap, 29).when(m == 2, 28).otherwise(31)
    return F.coalesce((F.size(parts) == 3) & (y >= 1) & m.between(1, 12) & d.between(1, last), F.lit(False))


def read_permissive(records: DataFrame, most_files: int = BROADCAST_ROWS) -> DataFrame:
    """Every record that is neither header nor blank: its ``line_id``, ``_file``, ``_year``, ``raw``, ``names``, ``fields``
    (null where the quoting is broken) and ``reason`` (null where it parses)."""
    rows = records.where(F.coalesce(F.col("line_no"), F.lit(0)) != 1).select("line_id", "_file", "_year", "raw")
    joined = left_join_dimension(rows, headers(records).withColumnRenamed("h_file", "_file"), "_file", F.col("line_id"), most_files).withColumn("delim", F.coalesce("delim", F.lit(",")))
    raw = F.col("raw")
    value = lambda k: trim_space(fold_width(F.coalesce(unquote(F.try_element_at("fields", F.col(f"at_{k}"))), F.lit(""))))
    fits = {
        "city": lambda v: v.rlike(r"\A[0-9]{5,6}\z"),
        "day": lambda v: day_exists(day_parts(v)),
        "hour": lambda v: v.rlike(r"\A(?:[01]?[0-9]|2[0-3])?\z"),
    }
    return (
        joined.where(raw.isNotNull() & ~F.rlike(raw, blank_pattern(F.col("delim"))))
        .withColumn("quoted", F.rlike(raw, quoting_pattern(F.col("delim"))))
        .withColumn("fields", F.when(F.col("quoted"), split_fields(raw, F.col("delim"))))
        .withColumns({f"v_{k}": F.when(F.col(f"at_{k}") > 0, value(k)) for k in fits})
        .withColumns({f"ok_{k}": F.coalesce(ok(F.col(f"v_{k}")), F.lit(True)) for k, ok in fits.items() if k != "day"} | {"days": day_parts(F.col("v_day"))})
        .withColumn("ok_day", F.col("v_day").isNull() | day_exists(F.col("days")))
        .withColumn(
            "reason",
            F.when(~F.col("quoted"), "quoting")
            .when(F.size("fields") != F.coalesce(F.size("names"), F.lit(-1)), "column_count")
            .when(~(F.col("ok_city") & F.col("ok_day") & F.col("ok_hour")), "value"),
        )
        .select("line_id", "_file", "_year", "raw", "names", "fields", "reason")
    )


def rejected(records: DataFrame) -> DataFrame:
    """``line_id``, ``reason`` of every record that does not parse. The generator, unlike a filter, is not pushed below the
    projection of ``reason``, so the checks run once."""
    return read_permissive(records).select("line_id", F.explode(F.when(F.col("reason").isNotNull(), F.array("reason"))).alias("reason"))


def load(records: DataFrame) -> DataFrame:
    """The loaded rows: the common columns, the rest in ``_extra``, and ``_corrupt`` (raw text) with ``reason`` for rejects."""
    at = lambda c: F.try_element_at("fields", F.array_position("names", c).cast("int"))
    rows = read_permissive(records).withColumn("fields", F.when(F.col("reason").isNull(), F.transform("fields", unquote)))
    own = F.array(*map(F.lit, COMMON))
    rest = F.filter(
        F.transform("names", lambda n, i: F.struct(n.alias("key"), F.get("fields", i).alias("value"), (F.array_position(F.col("names"), n) == i + 1).alias("first"))),
        lambda e: e["first"] & ~F.array_contains(own, e["key"]),
    )
    picked = F.transform(rest, lambda e: F.struct(e["key"], e["value"]))
    ok = F.col("reason").isNull()
    return rows.select(
        "line_id", "_file", "_year", *[F.when(ok & (F.array_position("names", c) > 0), at(c)).alias(c) for c in COMMON],
        F.when(ok, F.map_from_entries(picked)).alias("_extra"), F.when(~ok, F.col("raw")).alias("_corrupt"), "reason",
    )


def report(records: DataFrame) -> DataFrame:
    """Per file and outcome the number of records; partial aggregation keeps a huge file from meeting in one task."""
    return read_permissive(records).groupBy("_file", F.coalesce("reason", F.lit("loaded")).alias("outcome")).agg(F.count("*").alias("n_records"))
