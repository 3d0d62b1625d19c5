"""Town names of rows matched to areas, with a reason for every row and a box for every miss.

Two equi-joins against the same reference (key, then parent key) and one ordered CASE. Names are normalized once per distinct
name. A row is never lost; nulls and blanks are a reason of their own. Areas with the same key in a city are one area (lowest id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan import dims
from tallyspan.functions.places import parent_key, with_key
from tallyspan.functions.text import is_blank
from tallyspan.session import broadcast_if_small

# Reasons (fixed values)
BLANK = "町丁目が空欄"
EXACT = "そのまま一致"
NO_BLOCK = "丁目の記載がなく、どの区画か決められない"
BOTH = ("e-Statに「", "」と丁目が併存し、寄せると推測になる")
PARENT = ("e-Statが丁目に分けていないため「", "」に寄せた")
MISSING = "e-Statに該当する町丁目がない"


def reference(areas: DataFrame) -> DataFrame:
    """``r_city``, ``r_key``, ``r_area``, ``r_blocks``: whether areas with a block number share the name."""
    a = areas.select(F.col("city_code").alias("r_city"), F.col("key").alias("r_key"), "area_id").where(F.col("r_key").isNotNull()).groupBy("r_city", "r_key").agg(F.min("area_id").alias("r_area"))
    blocks = a.select("r_city", parent_key(F.col("r_key")).alias("r_key")).where(F.col("r_key").isNotNull()).distinct().withColumn("r_blocks", F.lit(True))
    return a.join(blocks, ["r_city", "r_key"], "left").withColumn("r_blocks", F.coalesce("r_blocks", F.lit(False)))


def decide(keyed: DataFrame, areas: DataFrame) -> DataFrame:
    """``keyed`` (``city``, ``town``, ``key``, anything else) with ``area_id``, ``reason``, ``box``."""
    ref = broadcast_if_small(reference(areas))
    d = keyed.withColumn("parent", parent_key(F.col("key")))
    d = d.join(ref.select("r_city", "r_key", F.col("r_area").alias("own")), (F.col("city") == F.col("r_city")) & (F.col("key") == F.col("r_key")), "left").drop("r_city", "r_key")
    d = d.join(ref.select("r_city", "r_key", F.col("r_area").alias("up"), F.col("r_blocks").alias("blocks")), (F.col("city") == F.col("r_city")) & (F.col("parent") == F.col("r_key")), "left").drop("r_city", "r_key")
    blank = is_blank(F.col("town"))
    to_parent = F.col("up").isNotNull() & ~F.col("blocks")
    step = F.when(blank, 1).when(F.col("own").isNotNull(), 2).when(F.col("parent").isNull(), 3).when(F.col("up").isNotNull() & F.col("blocks"), 4).when(to_parent, 5).otherwise(6)
    d = d.withColumn("step", step)
    say = lambda ends: F.concat(F.lit(ends[0]), F.col("parent"), F.lit(ends[1]))
    reason = F.when(F.col("step") == 1, BLANK).when(F.col("step") == 2, EXACT).when(F.col("step") == 3, NO_BLOCK).when(F.col("step") == 4, say(BOTH)).when(F.col("step") == 5, say(PARENT)).otherwise(MISSING)
    box = F.when(F.col("step").isin(1, 6), "unobserved").when(F.col("step").isin(3, 4), "undecided")
    area = F.when(F.col("step") == 2, F.col("own")).when(F.col("step") == 5, F.col("up"))
    return d.withColumns({"area_id": area, "reason": reason, "box": box}).drop("own", "up", "blocks", "parent", "step")


def match(fact: DataFrame, areas: DataFrame) -> DataFrame:
    """Fact rows (``city``, ``town``) matched to areas."""
    return decide(with_key(fact, "town"), areas)


def rejects(matched: DataFrame) -> DataFrame:
    return matched.where(F.col("area_id").isNull())


def not_counted(matched: DataFrame) -> DataFrame:
    """Misses per box, every box present."""
    counts = matched.where(F.col("box").isNotNull()).groupBy("box").agg(F.count("*").alias("n"))
    return F.broadcast(dims.boxes(matched.sparkSession)).join(counts, "box", "left").select("box", F.coalesce("n", F.lit(0)).alias("n"))


def reasons(matched: DataFrame) -> DataFrame:
    return matched.groupBy("reason").agg(F.count("*").alias("n"))


def match_rate(matched: DataFrame) -> DataFrame:
    """Per city and year: rows, matched rows, share of matched rows in hundredths of a percent (null without rows)."""
    n, hit = F.count("*"), F.count("area_id")
    return matched.groupBy("city", "year").agg(n.alias("n_rows"), hit.alias("n_matched"), F.floor(F.try_divide(hit * 20000 + n, 2 * n)).cast("bigint").alias("share_bp"))


def findings(df: DataFrame) -> DataFrame:
    """Distinct unknown values of closed-domain columns: ``kind``, ``where``, ``item``."""
    def unknown(column: str, known: list[str]) -> DataFrame:
        bad = F.col(column).isNotNull() & (F.trim(F.col(column)) != "") & ~F.col(column).isin(known)
        return df.where(bad).select(F.lit(column).alias("kind"), F.col("_file").alias("where"), F.col(column).alias("item")).distinct()

    return unknown("手口", dims.CATEGORIES).unionByName(unknown("罪名", dims.CHARGES))


def column_findings(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Columns a file has that its category does not know, and known ones it lacks: ``_file``, ``kind``, ``item``."""
    need = rows.sparkSession.createDataFrame([(c, x) for c, xs in dims.EXTRA.items() for x in xs], "category string, item string")
    have = rows.where(F.col("_extra").isNotNull()).select("_file", F.explode(F.map_keys("_extra")).alias("item")).distinct()
    loaded = files.where("stage = 'loaded'").select("_file", "category").distinct()
    known = F.broadcast(need)
    extra = have.join(loaded, "_file").join(known, ["category", "item"], "left_anti").where(~F.col("item").isin(dims.OPTIONAL)).select("_file", F.lit("unknown").alias("kind"), "item")
    missing = loaded.join(known, "category").join(have, ["_file", "item"], "left_anti").select("_file", F.lit("missing").alias("kind"), "item")
    return extra.unionByName(missing)


def blank_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose every listed column is blank."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & is_blank(F.col(c))
    return df.where(cond)
