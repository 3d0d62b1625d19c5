"""Published artefacts as DataFrames: area records, city cells, features, pages, reports. Sinks write them (``tallyspan.sources.sinks``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan import dims
from tallyspan.functions import sdc
from tallyspan.operators.cube import refuse_parents


def _layer_name(c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in dims.LAYER_NAMES.items() for x in kv]), c)


def run_date(day: str) -> str:
    """The date a run is told to carry; anything but an ISO date is refused."""
    import datetime

    return datetime.date.fromisoformat(day).isoformat()


def period_label(first: Column, last: Column) -> Column:
    return F.concat(first.cast("string"), F.lit("-"), last.cast("string"))


def area_records(cells: DataFrame, areas: DataFrame, site: str, base_url: str, source_url: str, fetched_on: Column, first: Column, last: Column) -> DataFrame:
    """One record per area and layer from suppressed cells (``city``, ``area_id``, ``layer``, ``published``, ``state``, ``pop``); ``first`` and ``last``
    are the years of the window, ``fetched_on`` the date of the newest source."""
    a = areas.select("area_id", "city_name", "pref", "name", "key", F.element_at("key_codes", 1).alias("code"))
    j = cells.join(a, "area_id")
    period = period_label(first, last)
    name = _layer_name(F.col("layer"))
    rate = sdc.rate_per_1k(F.col("published"), F.col("pop"))
    out = j.select(
        F.concat_ws(":", F.lit(site), "city", "code", "layer").alias("id"),
        F.concat("name", F.lit("（"), "city_name", F.lit("）"), period, F.lit("年の"), name, F.lit("の窃盗認知件数")).alias("title"),
        F.concat(F.lit("犯罪統計/"), name).alias("kind"), F.concat(last.cast("string"), F.lit("-12-31")).alias("date"), period.alias("period"), "pref", F.col("city_name").alias("city"), F.col("city").alias("city_code"),
        F.concat("city_name", "name").alias("addr"), F.concat(F.col("city"), F.lit("|"), "key").alias("addr_key"), F.concat(F.col("city"), F.lit("|"), F.regexp_replace("key", "丁目$", "")).alias("addr_key_town"),
        F.lit("").alias("party"), F.lit("none").alias("party_kind"), F.concat(F.lit(f"{base_url}/cho/"), "code", F.lit(".html")).alias("url"), F.lit(source_url).alias("source_url"), fetched_on.cast("string").alias("fetched_on"),
        F.col("pop").alias("population"), F.col("published").alias("count"),
        F.when(F.col("state") == "withheld", sdc.WITHHELD_LABEL).otherwise(sdc.label_for(F.col("published"))).alias("count_label"),
        rate.alias("rate_per_1k"), rate.isNull().alias("rate_suppressed"),
    )
    return refuse_parents(out, ["area"], ["id"])


def city_cells(cells: DataFrame, cities: DataFrame) -> DataFrame:
    """One record per city, category and year (``cells``: ``city``, ``category``, ``year``, ``n``; ``cities``: ``city_code``, ``city_name``, ``pop``)."""
    j = cells.join(cities, F.col("city") == F.col("city_code"))
    n, pop = F.col("n"), F.col("pop")
    return j.select(
        "city_code", F.col("city_name").alias("city"), F.concat(F.lit("犯罪統計/"), "category").alias("kind"), F.col("year").alias("period"), sdc.masked(n).alias("count"), sdc.bucket_label(n).alias("count_label"),
        pop.alias("population"), sdc.rate_per_1k(n, pop).alias("rate_per_1k"), sdc.suppress_rate(n, pop).alias("rate_suppressed"),
    )


def displayed_total(cells: DataFrame, group: list[str]) -> DataFrame:
    """Sum of shown cells plus one for each hidden one: a lower bound where something is hidden."""
    hidden = F.count_if(F.col("published").isNull())
    return cells.groupBy(*group).agg((F.sum(F.coalesce("published", F.lit(0))) + hidden).alias("n"), F.when(hidden > 0, "件以上").otherwise("件").alias("unit"))


def features(cells: DataFrame, shapes: DataFrame, neighbours: DataFrame) -> DataFrame:
    """GeoJSON features per area as JSON text, null slots of hidden layers kept: ``city``, ``code``, ``feature``."""
    order = F.array(*map(F.lit, dims.LAYERS))
    per = cells.groupBy("city", "area_id", "pop").agg(F.map_from_entries(F.collect_list(F.struct("layer", F.struct("published", "state").alias("c")))).alias("m"))
    n = F.transform(order, lambda k: F.try_element_at("m", k)["published"])
    w = F.transform(order, lambda k: F.try_element_at("m", k)["state"] == "withheld")
    near = neighbours.groupBy("city_code", "area").agg(F.array_sort(F.collect_set("neighbour")).alias("neighbors"))
    j = per.join(shapes, "area_id").join(near.withColumnRenamed("area", "name"), ["city_code", "name"], "left")
    props = F.struct(F.col("code"), F.col("name"), F.col("pop").alias("jinko"), n.alias("n"), w.alias("w"), F.coalesce("neighbors", F.array().cast("array<string>")).alias("neighbors"))
    text = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(props, {"ignoreNullFields": "false"}), F.lit(',"geometry":'), F.coalesce("geometry", F.lit("null")), F.lit("}"))
    return j.select("city", "code", text.alias("feature"))


def escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def pages(cells: DataFrame, names: DataFrame) -> DataFrame:
    """One HTML page per area: a row per layer, bars on a scale that gives no count away. ``names``: ``area_id``, ``code``, ``name``, ``city_name``."""
    top = Window.partitionBy("area_id")
    scale = sdc.nice_ceiling(F.max(F.when(~sdc.is_small(F.col("published")), F.col("published"))).over(top))
    width = F.when(F.col("state") == "withheld", F.lit(0.0)).otherwise(sdc.bar_width(F.col("published"), F.col("scale")))
    bar = F.when(F.col("width") > 0, F.concat(F.lit('<i style="width:'), F.format_string("%.1f", "width"), F.lit('%"></i>'))).otherwise("")
    row = F.concat(F.lit('<tr><th scope="row">'), escape(_layer_name(F.col("layer"))), F.lit('</th><td class="v num">'), sdc.label_for_state(F.col("state"), F.col("published")), F.lit('</td><td class="barcell">'), bar, F.lit("</td></tr>"))
    rows = cells.withColumn("scale", scale).withColumn("width", width).withColumn("row", row)
    body = rows.groupBy("area_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("layer", "row"))), lambda x: x["row"]), "").alias("rows"))
    title = F.concat(escape(F.col("name")), F.lit("（"), escape(F.col("city_name")), F.lit("）"))
    html = F.concat(F.lit('<!doctype html><html lang="ja"><head><meta charset="utf-8"><title>'), title, F.lit("</title></head><body><h1>"), title, F.lit("</h1><table>"), F.col("rows"), F.lit("</table></body></html>"))
    return body.join(names, "area_id").select("code", F.concat(F.lit("cho/"), "code", F.lit(".html")).alias("path"), html.alias("html"))


def sitemap(pages_: DataFrame, base_url: str) -> DataFrame:
    return pages_.select(F.concat(F.lit("<url><loc>"), escape(F.concat(F.lit(f"{base_url}/"), "path")), F.lit("</loc></url>")).alias("line"))


def suppression_report(cells: DataFrame) -> DataFrame:
    """Hidden cells per city, layer and label; numbers of cells only, never counts."""
    return cells.groupBy("city", "layer").agg(F.count("*").alias("n_cells"), F.count_if(F.col("state") == "small").alias("n_small"), F.count_if(F.col("state") == "withheld").alias("n_withheld"), F.bool_or("pinned").alias("pinned"))


def render(template: str, values: dict[str, str]) -> str:
    """Fill ``{{name}}`` places; each must occur exactly once and none may be left over."""
    import re

    places = re.findall(r"\{\{(\w+)\}\}", template)
    if sorted(places) != sorted(values):
        raise ValueError(f"places {sorted(places)} and values {sorted(values)} differ")
    return re.sub(r"\{\{(\w+)\}\}", lambda m: values[m.group(1)], template)
