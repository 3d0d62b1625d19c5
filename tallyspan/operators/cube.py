"""Counts at several grains: areas, categories, layers, hour bands, years; dense where zero is information.

What is published counts matched rows only: ``matched`` first counts the fact by what is written in it (a pre-aggregation that shrinks any
fact to its distinct combinations), then places those few rows by ``matching.match``; nothing row-sized is joined or normalized. The
functions below take such counts (a column ``n``) or plain rows, which weigh 1.

Nulls: a null category, hour or city counts nowhere that needs it. Every aggregate is partially aggregated before its exchange;
dimensions are constants of a few rows or the cities of the area list. No operator emits a total beside its parts unless it is named so
(``multi_grain``), and ``refuse_parents`` guards what is published.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan import dims
from tallyspan.functions.places import city_code5
from tallyspan.functions.text import fold_width
from tallyspan.operators.matching import match

CODE, CATEGORY, HOUR, TOWN, DAY = "市区町村コード（発生地）", "手口", "発生時（始期）", "町丁目（発生地）", "発生年月日（始期）"


def hour_band(v: Column) -> Column:
    """Band of an hour written as digits; hours past 23 fall in the last band, anything else in none."""
    digits = F.trim(fold_width(F.coalesce(v, F.lit(""))))
    return F.when(digits.rlike(r"\A\d{1,9}\z"), F.element_at(F.array(*map(F.lit, dims.BANDS)), F.least(F.floor(digits.try_cast("int") / 6), F.lit(3)).cast("int") + 1))


def incidents(df: DataFrame) -> DataFrame:
    """Narrow fact: ``city``, ``year``, ``category``, ``band``, ``town``, ``row_id``."""
    return df.select("row_id", city_code5(fold_width(F.col(CODE))).alias("city"), F.col("_year").alias("year"), F.col(CATEGORY).alias("category"), hour_band(F.col(HOUR)).alias("band"), F.col(TOWN).alias("town"))


GRAIN = ("year", "category", "band")


def tallies(fact: DataFrame, grain: tuple[str, ...] = GRAIN) -> DataFrame:
    """The fact counted by what it says: ``city``, ``town``, the columns of ``grain``, ``n``."""
    return fact.groupBy("city", "town", *grain).agg(F.count("*").alias("n"))


def matched(fact: DataFrame, areas: DataFrame, grain: tuple[str, ...] = GRAIN) -> DataFrame:
    """Counts of the rows that have an area: ``city``, ``area_id``, the columns of ``grain``, ``n``."""
    return match(tallies(fact, grain), areas).where(F.col("area_id").isNotNull()).groupBy("city", "area_id", *grain).agg(F.sum("n").alias("n"))


def total(fact: DataFrame) -> Column:
    return (F.sum("n") if "n" in fact.columns else F.count("*")).alias("n")


def cities_of(fact: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """Cities that dense tables list: those of the area list, else those the fact names."""
    return areas.select(F.col("city_code").alias("city")).distinct() if areas is not None else fact.where(F.col("city") != "").select("city").distinct()


def cell_counts(fact: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts by category of ``keys`` (city and year unless told otherwise)."""
    return fact.where((F.col("city") != "") & F.col("category").isNotNull()).groupBy(*(keys or ["city", "year"]), "category").agg(total(fact))


def band_counts(fact: DataFrame) -> DataFrame:
    """Counts by area, year and hour band; hours that cannot be read count nowhere."""
    return fact.where(F.col("band").isNotNull()).groupBy("city", "area_id", "year", "band").agg(total(fact))


def hour_counts(fact: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """City × band, every band of a city present."""
    counts = fact.where((F.col("city") != "") & F.col("band").isNotNull()).groupBy("city", "band").agg(total(fact))
    dense = cities_of(fact, areas).crossJoin(F.broadcast(dims.bands(fact.sparkSession).select("band")))
    return dense.join(counts, ["city", "band"], "left").select("city", "band", F.coalesce("n", F.lit(0)).alias("n"))


def layer_counts(fact: DataFrame, areas: DataFrame | None = None) -> DataFrame:
    """City × layer, zeros kept."""
    spark = fact.sparkSession
    counts = fact.where(F.col("city") != "").join(F.broadcast(dims.layers(spark)), "category").groupBy("city", "layer").agg(total(fact))
    dense = cities_of(fact, areas).crossJoin(F.broadcast(dims.layers(spark).select("layer").distinct()))
    return dense.join(counts, ["city", "layer"], "left").select("city", "layer", F.coalesce("n", F.lit(0)).alias("n"))


def outside_layers(fact: DataFrame) -> DataFrame:
    """Categories that belong to no layer, with their counts."""
    return fact.where(F.col("category").isNotNull()).join(F.broadcast(dims.layers(fact.sparkSession)), "category", "left_anti").groupBy("category").agg(total(fact))


def multi_grain(fact: DataFrame) -> DataFrame:
    """City × category × year and city × category in one pass; for internal use, never published together."""
    f = fact.where((F.col("city") != "") & F.col("category").isNotNull())
    return f.groupingSets([("city", "category", "year"), ("city", "category")], "city", "category", "year").agg(total(fact), F.grouping("year").alias("over_years"))


def area_cells(fact: DataFrame, areas: DataFrame) -> DataFrame:
    """Dense area × layer cells of the window's years: ``city``, ``area_id``, ``layer``, ``v``, ``pop``; incidents are placed by ``matching.match``."""
    spark = fact.sparkSession
    layered = matched(in_window(fact), areas, ("category",)).join(F.broadcast(dims.layers(spark)), "category")
    counts = layered.groupBy("area_id", "layer").agg(F.sum("n").alias("n"))
    dense = areas.select(F.col("city_code").alias("city"), "area_id", F.col("jinko").alias("pop")).crossJoin(F.broadcast(dims.layers(spark).select("layer").distinct()))
    return dense.join(counts, ["area_id", "layer"], "left").select("city", "area_id", "layer", F.coalesce("n", F.lit(0)).alias("v"), "pop")


def city_cells(fact: DataFrame, areas: DataFrame) -> DataFrame:
    """Dense city × category × year cells of matched rows: every city of the list, every year of the window."""
    spark = fact.sparkSession
    counts = cell_counts(matched(in_window(fact), areas, ("year", "category")))
    dense = cities_of(fact, areas).crossJoin(F.broadcast(dims.categories(spark))).crossJoin(F.broadcast(window_years(fact)))
    return dense.join(counts, ["city", "category", "year"], "left").select("city", "category", "year", F.coalesce("n", F.lit(0)).alias("n"))


def last_year(fact: DataFrame) -> Column:
    return fact.agg(F.max("year")).scalar()


def window_years(fact: DataFrame, years: int = dims.WINDOW_YEARS) -> DataFrame:
    """``year``: the years of the window, one row each; none of an empty fact."""
    last = fact.agg(F.max("year").alias("y"))
    return last.where("y IS NOT NULL").select(F.explode(F.sequence(F.col("y") - years + 1, F.col("y"))).alias("year"))


def in_window(fact: DataFrame, years: int = dims.WINDOW_YEARS) -> DataFrame:
    """Rows of the last ``years`` years; the window shifts, it does not grow. The last year is a scalar subquery over one column."""
    return fact.where(F.col("year") > last_year(fact) - years)


def refuse_parents(df: DataFrame, grains: list[str], keys: list[str] | None = None) -> DataFrame:
    """``df`` itself, or an error if it would publish a total beside its parts: a grouping marker or sum in its schema, the same grain twice, or
    a key column of which a null stands for all values (``keys``: those that must never be null; checked where the rows are written)."""
    bad = [c for c in df.columns if c in ("total", "sum", "over_years") or c.startswith("grouping")]
    if bad or len(set(grains)) != len(grains):
        raise ValueError(f"published tables carry no totals beside their parts: {bad or grains}")
    for k in keys or []:
        df = df.withColumn(k, F.when(F.col(k).isNull(), F.raise_error(F.lit(f"a row without {k} is a total beside its parts")).cast(df.schema[k].dataType)).otherwise(F.col(k)))
    return df
