"""Queries of the statistics operators over the test tables, each with its DuckDB counterpart where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyspan import dims
from tallyspan.functions import party, places, sdc, web
from tallyspan.functions.text import FULL_WIDTH, HALF_WIDTH, is_blank
from tallyspan.operators import audit, boundary, cube, matching, observe, publish
from tallyspan.operators.suppress import complement_sql, suppress
from tallyspan.plans.sql_text import keys_sql, parent_sql
from tallyspan.session import table

SITE, BASE, SOURCE = "example-site", "https://stats.example", "https://open.example/data"


def fact(s, d):
    return cube.incidents(table(s, d, "incidents"))


def areas(s, d):
    return table(s, d, "areas")


def cells(s, d):
    return cube.matched(fact(s, d), areas(s, d))


def area_cells(s, d):
    return cube.area_cells(fact(s, d), areas(s, d))


def suppressed(s, d):
    return suppress(area_cells(s, d), ["city", "layer"], "v", ["area_id"], "pop")


def year_cells(s, d):
    return cube.city_cells(fact(s, d), areas(s, d)).withColumnRenamed("n", "v")


def city_pop(s, d):
    return areas(s, d).groupBy("city_code").agg(F.min("city_name").alias("city_name"), F.sum("jinko").alias("pop"))


def city_records(s, d):
    return publish.city_cells(cube.city_cells(fact(s, d), areas(s, d)), city_pop(s, d))


def editions(s, d):
    return audit.editions(suppressed(s, d))


def parents(s, d):
    """Parents a reader has of each edition: the sums themselves of the drafts, what the published city cells add up to of the final one."""
    cities = city_records(s, d).select(F.col("city_code").alias("city"), F.regexp_replace("kind", "^犯罪統計/", "").alias("category"), "count")
    final = audit.published_parents(cities, dims.layers(s)).select(F.lit("final").alias("edition"), "city", "layer", "s")
    drafts = area_cells(s, d).groupBy("city", "layer").agg(F.sum("v").alias("s")).withColumn("edition", F.explode(F.array(F.lit("raw"), F.lit("primary"))))
    return final.unionByName(drafts)


GROUP = ["edition", "city", "layer"]


def area_records(s, d):
    last = cube.last_year(fact(s, d))
    newest = table(s, d, "feed_files").where("stage = 'loaded'").agg(F.max("delivered_at").cast("date")).scalar()
    return publish.area_records(suppressed(s, d), areas(s, d), SITE, BASE, SOURCE, newest, last - (dims.WINDOW_YEARS - 1), last)


def keyed(s, d):
    return places.with_key(table(s, d, "area_counts").select("count_id", F.col("city_code").alias("city"), F.col("key").alias("town"), F.lit(2024).alias("year")), "town")


def decided(s, d):
    return matching.decide(keyed(s, d), table(s, d, "areas"))


def rates(s, d):
    hidden = suppressed(s, d).groupBy("city", "layer").agg(F.sum("v").alias("total"), F.count_if(F.col("state") != "shown").alias("hidden"))
    return rates_of(s, d, hidden)


def fine_rates(s, d):
    """Rates of a draft that rounds every city alike, to two digits."""
    hidden = suppressed(s, d).groupBy("city", "layer").agg(F.sum("v").alias("total"), F.count_if(F.col("state") != "shown").alias("hidden"))
    pop = city_pop(s, d).where("pop > 0").select(F.col("city_code").alias("city"), "pop")
    return hidden.join(pop, "city").select("city", "layer", "pop", "hidden", F.floor((F.col("total") * 200000 + F.col("pop")) / (2 * F.col("pop"))).cast("bigint").alias("value"), F.lit(2).alias("scale"))


def rates_of(s, d, hidden):
    j = hidden.join(city_pop(s, d), F.col("city") == F.col("city_code")).withColumn("r", sdc.city_rate(F.col("total"), F.col("pop"), F.col("hidden")))
    return j.select("city", "layer", "pop", "hidden", F.col("r.value").alias("value"), F.col("r.scale").alias("scale"))


def events_by_day(s, d):
    return table(s, d, "events").select("user_id", F.datediff(F.col("ts").cast("date"), F.lit("2020-01-01").cast("date")).alias("day"))


RULES = [("*", False, "/docs/sewa_2019"), ("*", True, "/docs/sewa_2019jitensha"), ("*", False, "/*.zip$"), ("*", False, "/data?code=*5&"), ("*", True, "/docs/"), ("*", False, "/docs/*_p0000001.csv$")]
RULE_SQL = [("/docs/sewa_2019", r"^/docs/sewa_2019"), ("/docs/sewa_2019jitensha", r"^/docs/sewa_2019jitensha"), ("/*.zip$", r"^/.*\.zip$"), ("/data?code=*5&", r"^/data\?code=.*5&"), ("/docs/", r"^/docs/"), ("/docs/*_p0000001.csv$", r"^/docs/.*_p0000001\.csv$")]
SCOPES = ["https://open.sewa-pref.example/docs/", "https://chiri.toukei.example/data?code=0000080&format=shape", "https://open.sewa-pref.example/docs"]
NAMES = ["山田太郎", "大阪市", "国", "オークワ　ほか", "F.O.B COOP", "大阪市北区角田町３番25号", "カタカナ商事", "株赤ちゃん本舗", "○○町教育委員会", "鈴木商店", ""]
ADDRESSES = [("尼崎市潮江1-3-1", "individual"), ("尼崎市潮江1-3-1", "corp"), ("西宮市甲子園8−2", "individual"), ("", "individual")]
WORDS = ["盗難", "無施錠", "stolen", "registration"]
MARK_ROWS = [(1, {"入口に届いた": "はい", "解析できた": "はい"}), (2, {"入口に届いた": "はい", "解析できた": "いいえ"}), (3, {"入口に届いた": "はい", "解析できた": "分からない"}), (4, {"入口に届いた": "いいえ"}), (5, {})]


def robots_match(s, d):
    rules = s.createDataFrame(RULES, "agent_group string, allow boolean, pattern string")
    path = F.regexp_extract("url", r"\A[a-z]+://[^/]+(/.*)\z", 1)
    paths = table(s, d, "fetch_manifest").select("url").distinct().where(F.col("url").isNotNull()).select("url", path.alias("path"), F.lit("*").alias("agent_group"))
    return web.allowed(paths, rules).select("url", "allowed")


def url_scope(s, d):
    scopes = F.explode(F.array(*map(F.lit, SCOPES)))
    return table(s, d, "fetch_manifest").select("url").distinct().where(F.col("url").isNotNull()).withColumn("scope", scopes).select("url", "scope", web.in_scope(F.col("url"), F.col("scope")).alias("inside"))


def longest_prefix(s, d):
    rows = table(s, d, "town_entries").where(F.col("s_name").isNotNull()).select(F.col("entry_id").alias("_id"), F.substring("city_code", 1, 5).alias("city_code"), F.col("s_name").alias("text"))
    return places.longest_prefix(rows, table(s, d, "areas").select("city_code", F.col("name").alias("town"))).withColumnRenamed("_id", "entry_id")


def neighbours(s, d):
    return boundary.neighbours(boundary.one_shape_per_area(table(s, d, "boundary")))


def names(s, d):
    return table(s, d, "areas").select("area_id", F.element_at("key_codes", 1).alias("code"), "name", "city_name", "city_code")


def features(s, d):
    areas = table(s, d, "areas")
    shapes = boundary.one_shape_per_area(table(s, d, "boundary")).select("city_code", F.col("area").alias("key"), boundary.geojson_geometry("geom_wkb").alias("geometry"))
    with_shape = names(s, d).join(areas.select("area_id", "key"), "area_id").join(shapes, ["city_code", "key"], "left").select("area_id", "code", "name", "city_code", "geometry")
    near = neighbours(s, d)
    for c in ("area", "neighbour"):  # keys to names as listed
        near = near.join(areas.select("city_code", F.col("key").alias(c), F.col("name").alias("_n")), ["city_code", c], "left").withColumn(c, F.coalesce("_n", c)).drop("_n")
    return publish.features(suppressed(s, d), with_shape, near)


def audit_text(s, d):
    """Numbers in the documents that fit a hidden town total: a town's cells over its blocks and layers, hidden ones all small."""
    towns = areas(s, d).select("area_id", F.coalesce(places.parent_key(F.col("key")), F.col("key")).alias("clue"))
    own = suppressed(s, d).join(towns, "area_id")
    clues = audit.text_clues(own.withColumn("city", F.concat_ws("|", "city", "clue")), own.select(F.concat_ws("|", "city", "clue").alias("city"), "clue").distinct(), ["city"])
    return audit.text_parents(table(s, d, "documents").select("doc_id", "text"), "text", clues).select("doc_id", "line_no", "city", "clue", "n", "k", "verdict")


def pages(s, d):
    return publish.pages(suppressed(s, d), names(s, d))


QUERIES = {
    "cell_counts": lambda s, d: cube.cell_counts(cells(s, d), ["city", "area_id", "year"]),
    "band_counts": lambda s, d: cube.band_counts(cells(s, d)),
    "hour_bands": lambda s, d: cube.hour_counts(cells(s, d), areas(s, d)),
    "layer_sums": lambda s, d: cube.layer_counts(cube.matched(cube.in_window(fact(s, d)), areas(s, d), ("category",)), areas(s, d)),
    "city_only": lambda s, d: cube.outside_layers(fact(s, d)),
    "multi_grain": lambda s, d: cube.multi_grain(cube.matched(fact(s, d), areas(s, d), ("year", "category"))),
    "latest_period_window": lambda s, d: cube.in_window(fact(s, d), 3).groupBy("year").agg(F.count("*").alias("n")),
    "area_cells": area_cells,
    "city_year_cells": year_cells,
    "primary_suppress": lambda s, d: area_cells(s, d).select("city", "area_id", "layer", sdc.suppress_count(F.col("v"), F.col("pop")).alias("hide"), sdc.masked(F.col("v"), F.col("pop")).alias("shown")),
    "count_label": lambda s, d: area_cells(s, d).select("area_id", "layer", sdc.bucket_label(F.col("v")).alias("label")),
    "rate_rules": lambda s, d: area_cells(s, d).select("area_id", "layer", sdc.suppress_rate(F.col("v"), F.col("pop")).alias("suppressed"), sdc.rate_reason(F.col("v"), F.col("pop")).alias("reason"), sdc.rate_hundredths(F.col("v"), F.col("pop")).alias("hundredths")),
    "complement_suppress": lambda s, d: suppress(year_cells(s, d), ["city", "category"], "v", ["year"]),
    "complement_suppress_pop": suppressed,
    "label_unify_check": lambda s, d: audit.label_mix(editions(s, d), GROUP),
    "city_rate": rates,
    "bar_scale": lambda s, d: suppressed(s, d).groupBy("city", "layer").agg(F.max("published").alias("top")).select("city", "layer", sdc.nice_ceiling(F.col("top")).alias("scale")),
    "class_breaks": lambda s, d: suppressed(s, d).groupBy("layer", sdc.class_of(F.col("published"), sdc.CLASS_TOTAL).alias("class")).agg(F.count("*").alias("n")),
    "displayed_total": lambda s, d: publish.displayed_total(suppressed(s, d), ["city", "area_id"]),
    "suppression_report": lambda s, d: publish.suppression_report(suppressed(s, d)),
    "audit_raw": lambda s, d: audit.raw_small(editions(s, d)).select("edition", "area_id", "layer", "published"),
    "audit_population_line": lambda s, d: audit.population_line(editions(s, d)).groupBy("edition", "verdict").agg(F.count("*").alias("n")),
    "audit_margin": lambda s, d: audit.margins(editions(s, d), parents(s, d), GROUP).select(*GROUP, "s", "shown", "k", "m", "verdict"),
    "audit_interval": lambda s, d: audit.intervals(editions(s, d), parents(s, d), GROUP).where("state <> 'shown'").select("edition", "area_id", "layer", "new_lo", "new_hi", "solved", "route"),
    "audit_recovered": lambda s, d: audit.recovered(audit.intervals(editions(s, d), parents(s, d), GROUP), ["edition", "layer"]),
    "audit_parents_missing": lambda s, d: audit.missing_parents(editions(s, d), GROUP, parents(s, d).where("s IS NOT NULL")),
    "audit_bars": lambda s, d: audit.bar_leaks(pages(s, d)).groupBy("label").agg(F.count("*").alias("n_rows"), F.count_if("leaks").alias("n_leaks")),
    "audit_breaks": lambda s, d: audit.class_break_findings(s, total=sdc.CLASS_TOTAL, draft=[1, 2, 6, 12]),
    "audit_rate_precision": lambda s, d: audit.rate_too_fine(fine_rates(s, d)),
    "audit_checks": lambda s, d: audit.checks(editions(s, d), GROUP),
    "audit_text_parents": audit_text,
    "match_rows": lambda s, d: matching.match(fact(s, d), areas(s, d)).select("row_id", "city", "key", "area_id", "reason", "box"),
    "decision_table_match": lambda s, d: decided(s, d).select("count_id", "area_id", "reason", "box"),
    "not_counted": lambda s, d: matching.not_counted(decided(s, d)),
    "match_reasons": lambda s, d: matching.reasons(decided(s, d)),
    "match_rate": lambda s, d: matching.match_rate(decided(s, d)),
    "rejects": lambda s, d: matching.rejects(decided(s, d)).select("count_id", "town", "reason"),
    "place_keys": lambda s, d: places.with_key(table(s, d, "boundary").select("rec_no", "s_name"), "s_name"),
    "chome_parent": lambda s, d: table(s, d, "areas").select("area_id", places.parent_key(F.col("key")).alias("parent")),
    "city_code5": lambda s, d: table(s, d, "incidents").select("row_id", places.city_code5(F.col(cube.CODE)).alias("code5")),
    "longest_prefix": longest_prefix,
    "merge_same_name": lambda s, d: boundary.merge(table(s, d, "boundary")),
    "codes_in_order": lambda s, d: boundary.codes_in_order(table(s, d, "boundary")),
    "skipped_records": lambda s, d: boundary.skipped(table(s, d, "boundary")),
    "neighbors_eps": neighbours,
    "findings": lambda s, d: matching.findings(table(s, d, "incidents")),
    "column_findings": lambda s, d: matching.column_findings(table(s, d, "feed_files"), table(s, d, "incidents")),
    "blank_rows": lambda s, d: matching.blank_rows(table(s, d, "incidents"), ["罪名", cube.HOUR]).select("row_id"),
    "run_summary": lambda s, d: observe.run_summary(table(s, d, "fetch_manifest")),
    "snapshot_outcomes": lambda s, d: observe.outcomes(table(s, d, "fetch_manifest")),
    "content_fingerprint": lambda s, d: observe.fingerprint(table(s, d, "fetch_manifest"), ["run_no"], "path", "sha256"),
    "vanished": lambda s, d: observe.vanished(table(s, d, "fetch_manifest")),
    "complete_marks": lambda s, d: s.createDataFrame(MARK_ROWS, "id int, marks map<string,string>").select("id", observe.complete(F.col("marks"), ["入口に届いた", "解析できた"]).alias("complete")),
    "rolling_cap": lambda s, d: observe.rolling_counts(events_by_day(s, d), "user_id", "day", 7),
    "four_caps": lambda s, d: observe.cap_counts(events_by_day(s, d), "user_id", "day", {"in_1": 1, "in_7": 7, "in_30": 30}),
    "congestion": lambda s, d: observe.congestion(table(s, d, "events").select("user_id", F.datediff(F.col("ts").cast("date"), F.lit("2020-01-01").cast("date")).alias("day"), "event_type"), "user_id", "day", F.col("event_type") == "error"),
    "waits": lambda s, d: observe.waits(table(s, d, "events").select("event_id", "user_id", "ts"), "user_id", "ts", 3600).where("short_by > 0").groupBy("user_id").agg(F.count("*").alias("n")),
    "moved_back": lambda s, d: observe.moved_back(table(s, d, "fetch_manifest"), ["path"], "run_no", "fetched_at").select("path", "run_no"),
    "prev_observation": lambda s, d: observe.previous(events_by_day(s, d).distinct(), "user_id", "day"),
    "accept_in_turn": lambda s, d: observe.accept_in_turn(events_by_day(s, d).select(F.col("user_id").cast("string").alias("party"), F.lit("r").alias("route"), "day"), 2, 30),
    "robots_match": robots_match,
    "url_host": lambda s, d: table(s, d, "fetch_manifest").select("entry_id", web.url_host(F.col("url")).alias("host")),
    "url_scope": url_scope,
    "word_hits": lambda s, d: web.word_hits(table(s, d, "documents").select("doc_id", "text"), "text", WORDS).select("doc_id", "line_no", "word"),
    "number_tokens": lambda s, d: web.lines(table(s, d, "documents").select("doc_id", "text"), "text").withColumn("n", F.explode(web.number_tokens(F.col("line")))).groupBy("doc_id").agg(F.count("*").alias("n_numbers"), F.sum("n").cast("bigint").alias("total")),
    "party_kind": lambda s, d: table(s, d, "supplier").select(F.col("s_name").alias("name")).unionByName(s.createDataFrame([(n,) for n in NAMES], "name string")).distinct().select("name", party.party_kind(F.col("name")).alias("kind")),
    "redact_addr": lambda s, d: s.createDataFrame(ADDRESSES, "addr string, kind string").select("addr", "kind", party.redact_addr(F.col("addr"), F.col("kind")).alias("shown")),
    "top_findings": lambda s, d: area_cells(s, d).where("v > 0").orderBy("pop", "v", "area_id", "layer").limit(8),
    "anti_area": lambda s, d: table(s, d, "raw_records").select("_file").distinct().join(table(s, d, "feed_files").where("stage = 'loaded'").select("_file"), "_file", "left_anti"),
    "area_records": area_records,
    "city_records": city_records,
    "geojson_features": features,
    "area_pages": pages,
    "heading_scan": lambda s, d: pages(s, d).select("path", F.explode(web.headings(F.col("html"))).alias("heading")),
    "sitemap": lambda s, d: publish.sitemap(pages(s, d), BASE),
    "town_list": lambda s, d: areas(s, d).where(~is_blank(F.col("key"))).groupBy("city_code").agg(F.array_sort(F.collect_set("key")).alias("towns")),
}


_FW, _HW = FULL_WIDTH, HALF_WIDTH.replace("'", "''")
_FACT = f"""
SELECT row_id, CASE WHEN regexp_full_match(c, '[0-9]{{6}}') THEN left(c, 5) WHEN regexp_full_match(c, '[0-9]{{5}}') THEN c ELSE '' END AS city, _year AS year, "手口" AS category,
       CASE WHEN regexp_full_match(h, '[0-9]{{1,9}}') THEN ['0-6', '6-12', '12-18', '18-24'][least(h::INT // 6, 3) + 1] END AS band, "町丁目（発生地）" AS town
FROM (SELECT *, trim(translate(coalesce("市区町村コード（発生地）", ''), '{_FW}', '{_HW}')) AS c, trim(translate(coalesce("発生時（始期）", ''), '{_FW}', '{_HW}')) AS h FROM incidents)"""
_LAYERS = "(VALUES " + ", ".join(f"('{k}', '{c}')" for k, cs in dims.LAYERS.items() for c in cs) + ") AS l(layer, category)"
_LAYER = "(VALUES " + ", ".join(f"('{k}')" for k in dims.LAYERS) + ") AS l(layer)"
_CATS = "(VALUES " + ", ".join(f"('{c}')" for c in dims.CATEGORIES) + ") AS k(category)"
_REF = f"""(SELECT r.city_code, r.key, r.area_id, b.key IS NOT NULL AS blocks FROM (SELECT city_code, key, min(area_id) AS area_id FROM areas WHERE key IS NOT NULL GROUP BY ALL) r
 LEFT JOIN (SELECT DISTINCT city_code, {parent_sql('key')} AS key FROM areas) b ON b.city_code = r.city_code AND b.key = r.key)"""


def decided_sql(rel: str) -> str:
    """The decision table over a relation with ``city`` and ``town``: its columns, ``key``, ``area_id``, ``reason``, ``box``."""
    return f"""
SELECT * EXCLUDE (step, own, up, blocks, parent), CASE step WHEN 2 THEN own WHEN 5 THEN up END AS area_id,
       CASE step WHEN 1 THEN '{matching.BLANK}' WHEN 2 THEN '{matching.EXACT}' WHEN 3 THEN '{matching.NO_BLOCK}' WHEN 4 THEN '{matching.BOTH[0]}' || parent || '{matching.BOTH[1]}'
       WHEN 5 THEN '{matching.PARENT[0]}' || parent || '{matching.PARENT[1]}' ELSE '{matching.MISSING}' END AS reason,
       CASE WHEN step IN (1, 6) THEN 'unobserved' WHEN step IN (3, 4) THEN 'undecided' END AS box
FROM (SELECT k.*, o.area_id AS own, u.area_id AS up, u.blocks, CASE WHEN coalesce(regexp_replace(town, '^[\\s\\p{{Z}}\\x{{200B}}\\x85]+|[\\s\\p{{Z}}\\x{{200B}}\\x85]+$', '', 'g'), '') = '' THEN 1 WHEN o.area_id IS NOT NULL THEN 2 WHEN k.parent IS NULL THEN 3
      WHEN u.area_id IS NOT NULL AND u.blocks THEN 4 WHEN u.area_id IS NOT NULL THEN 5 ELSE 6 END AS step
FROM (SELECT r.*, coalesce(y.key, '') AS key, {parent_sql("coalesce(y.key, '')")} AS parent FROM ({rel}) r LEFT JOIN ({keys_sql(f"SELECT town AS v FROM ({rel})")}) y ON y.v = r.town) k
LEFT JOIN {_REF} o ON o.city_code = k.city AND o.key = k.key LEFT JOIN {_REF} u ON u.city_code = k.city AND u.key = k.parent)"""


_PLACED = decided_sql(_FACT)
_CELLS = f"(SELECT city, area_id, year, category, band, count(*) AS n FROM ({_PLACED}) WHERE area_id IS NOT NULL GROUP BY ALL)"
_LAST = "(SELECT max(_year) FROM incidents)"
_WINDOW = f"(SELECT * FROM {_CELLS} WHERE year > {_LAST} - {dims.WINDOW_YEARS})"
_CITY = "(SELECT DISTINCT city_code AS city FROM areas)"
_AREA_CELLS = f"""
SELECT a.city_code AS city, a.area_id, l.layer, coalesce(n.n, 0)::BIGINT AS v, a.jinko AS pop
FROM areas a CROSS JOIN {_LAYER} LEFT JOIN (SELECT f.area_id, l.layer, sum(f.n) AS n FROM {_WINDOW} f JOIN {_LAYERS} ON f.category = l.category GROUP BY ALL) n ON n.area_id = a.area_id AND n.layer = l.layer"""
_YEAR_CELLS = f"""
SELECT c.city, k.category, y.year::INT AS year, coalesce(n.n, 0)::BIGINT AS v FROM {_CITY} c CROSS JOIN {_CATS} CROSS JOIN (SELECT unnest(generate_series({_LAST} - {dims.WINDOW_YEARS - 1}, {_LAST})) AS year) y
LEFT JOIN (SELECT city, category, year, sum(n) AS n FROM {_WINDOW} GROUP BY ALL) n ON n.city = c.city AND n.category = k.category AND n.year = y.year"""
_SUPPRESSED = complement_sql(_AREA_CELLS, "city, layer", "area_id")
_S = f"(SELECT city, area_id, layer, v, pop, state, published::BIGINT AS published, pinned FROM ({_SUPPRESSED}))"
_POP = "(SELECT city_code, min(city_name) AS city_name, sum(jinko)::BIGINT AS pop FROM areas GROUP BY city_code)"
_RATES = f"""
SELECT city, layer, pop, hidden, CASE WHEN pop > 0 AND scale IS NOT NULL AND NOT (steps = 0 AND total <> 0) THEN (steps / unit)::DECIMAL(12,2) END AS value,
       CASE WHEN pop > 0 AND scale IS NOT NULL AND NOT (steps = 0 AND total <> 0) THEN scale END::INT AS scale
FROM (SELECT *, (total * 2000 * unit + pop) // (2 * greatest(pop, 1)) AS steps FROM (SELECT *, CASE scale WHEN 2 THEN 100 WHEN 1 THEN 10 ELSE 1 END AS unit
FROM (SELECT g.*, p.pop, CASE WHEN pop >= k * 100000 THEN 2 WHEN pop >= k * 10000 THEN 1 WHEN pop >= k * 1000 THEN 0 END AS scale
FROM (SELECT city, layer, sum(v)::BIGINT AS total, count(*) FILTER (state <> 'shown') AS hidden, greatest(count(*) FILTER (state <> 'shown'), 1) AS k FROM {_S} GROUP BY ALL) g JOIN {_POP} p ON p.city_code = g.city)))"""
_DECIDED = decided_sql("SELECT count_id, city_code AS city, key AS town, 2024 AS year FROM area_counts")
_BOUNDARY = f"(SELECT b.*, coalesce(y.key, '') AS key FROM boundary b LEFT JOIN ({keys_sql('SELECT s_name AS v FROM boundary')}) y ON y.v = b.s_name WHERE hcode = 8101 AND s_name IS NOT NULL)"
_RATE = "CASE WHEN coalesce(pop, 0) = 0 THEN 'no_population' WHEN pop <= 0 THEN 'suppressed' WHEN {n} = 0 THEN 'shown' WHEN pop < 500 THEN 'suppressed' WHEN {n} BETWEEN 1 AND 2 THEN 'suppressed' ELSE 'shown' END"
_HIDE = "CASE WHEN v = 0 THEN FALSE WHEN v BETWEEN 1 AND 2 THEN TRUE WHEN coalesce(pop, 0) = 0 OR v > pop THEN FALSE ELSE pop < 100 AND v <= 5 END"
_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)"
_DAYS = "(SELECT user_id, date_diff('day', DATE '2020-01-01', ts::DATE)::INT AS day FROM events)"
_ORG = ", ".join(f"'{w}'" for w in party.ORGANISATION)
_PUBLIC = ", ".join(f"'{w}'" for w in party.PUBLIC_WORDS)
_MANIFEST_ONE = r"""(SELECT run_no, path, h AS content FROM (SELECT run_no, path, fetched_at, nullif(regexp_extract(lower(regexp_replace(sha256, '[\s:\-]', '', 'g')), '([0-9a-f]{64})$', 1), '') AS h FROM fetch_manifest WHERE run_no IS NOT NULL AND path IS NOT NULL)
 QUALIFY row_number() OVER (PARTITION BY run_no, path ORDER BY (h IS NOT NULL) DESC, fetched_at DESC NULLS LAST, h DESC) = 1)"""
_ED = f"""(WITH s AS MATERIALIZED (SELECT * FROM {_S}) SELECT 'raw' AS edition, city, area_id, layer, pop, 'shown' AS state, v AS published FROM s
 UNION ALL SELECT 'primary', city, area_id, layer, pop, CASE WHEN v BETWEEN 1 AND 2 THEN 'small' ELSE 'shown' END, CASE WHEN NOT v BETWEEN 1 AND 2 THEN v END FROM s
 UNION ALL SELECT 'final', city, area_id, layer, pop, state, published FROM s)"""
_PARENTS = f"""(SELECT e.edition, p.city, p.layer, p.s FROM (SELECT city, layer, sum(v)::BIGINT AS s FROM ({_AREA_CELLS}) GROUP BY ALL) p CROSS JOIN (VALUES ('raw'), ('primary')) e(edition)
 UNION ALL SELECT 'final', y.city, l.layer, CASE WHEN bool_or(y.v BETWEEN 1 AND 2) THEN NULL ELSE sum(y.v)::BIGINT END FROM ({_YEAR_CELLS}) y JOIN {_LAYERS} ON l.category = y.category GROUP BY y.city, l.layer)"""
_TOWNS = f"""(SELECT city || '|' || clue AS city, clue, sum(coalesce(published, 0))::BIGINT AS shown, count(*) FILTER (state <> 'shown') AS k FROM (SELECT s.*, coalesce({parent_sql('a.key')}, a.key) AS clue FROM {_S} s JOIN areas a ON a.area_id = s.area_id)
 GROUP BY ALL HAVING count(*) FILTER (state <> 'shown') > 0 AND count(*) FILTER (state = 'withheld') = 0)"""
_BOUNDS = f"""(SELECT *, CASE WHEN solved THEN edition || '/' || city || '/' || layer END AS route FROM (SELECT *, coalesce(new_lo = new_hi, FALSE) AS solved
      FROM (SELECT *, CASE WHEN s IS NULL THEN lo ELSE greatest(lo, s - (sum_hi - hi)) END::BIGINT AS new_lo, CASE WHEN s IS NULL THEN hi ELSE least(hi, s - (sum_lo - lo)) END::BIGINT AS new_hi
      FROM (SELECT *, sum(lo) OVER g AS sum_lo, sum(hi) OVER g AS sum_hi FROM (SELECT *, CASE WHEN state = 'shown' THEN published ELSE 1 END AS lo, CASE WHEN state = 'shown' THEN published WHEN state = 'small' THEN 2 ELSE s END AS hi
      FROM {_ED} LEFT JOIN {_PARENTS} USING (edition, city, layer)) WINDOW g AS (PARTITION BY edition, city, layer))) WHERE state <> 'shown'))"""


SQL = {
    "cell_counts": f"SELECT city, area_id, year, category, sum(n)::BIGINT AS n FROM {_CELLS} WHERE category IS NOT NULL GROUP BY ALL",
    "band_counts": f"SELECT city, area_id, year, band, sum(n)::BIGINT AS n FROM {_CELLS} WHERE band IS NOT NULL GROUP BY ALL",
    "hour_bands": f"SELECT c.city, b.band, coalesce(n.n, 0)::BIGINT AS n FROM {_CITY} c CROSS JOIN (VALUES ('0-6'), ('6-12'), ('12-18'), ('18-24')) b(band) LEFT JOIN (SELECT city, band, sum(n) AS n FROM {_CELLS} WHERE band IS NOT NULL GROUP BY ALL) n ON n.city = c.city AND n.band = b.band",
    "layer_sums": f"SELECT c.city, l.layer, coalesce(n.n, 0)::BIGINT AS n FROM {_CITY} c CROSS JOIN {_LAYER} LEFT JOIN (SELECT city, l.layer, sum(f.n) AS n FROM {_WINDOW} f JOIN {_LAYERS} ON l.category = f.category GROUP BY ALL) n ON n.city = c.city AND n.layer = l.layer",
    "city_only": f"SELECT category, count(*) AS n FROM ({_FACT}) WHERE category IS NOT NULL AND category NOT IN (SELECT category FROM {_LAYERS}) GROUP BY ALL",
    "multi_grain": f"SELECT city, category, year, sum(n)::BIGINT AS n, grouping(year)::TINYINT AS over_years FROM {_CELLS} WHERE category IS NOT NULL GROUP BY GROUPING SETS ((city, category, year), (city, category))",
    "latest_period_window": f"SELECT year, count(*) AS n FROM ({_FACT}) WHERE year > (SELECT max(_year) FROM incidents) - 3 GROUP BY ALL",
    "area_cells": _AREA_CELLS,
    "city_year_cells": _YEAR_CELLS,
    "primary_suppress": f"SELECT city, area_id, layer, {_HIDE} AS hide, CASE WHEN NOT ({_HIDE}) THEN v END AS shown FROM ({_AREA_CELLS})",
    "count_label": f"SELECT area_id, layer, CASE WHEN v <= 0 THEN '0' WHEN v <= 2 THEN '1-2' ELSE v::VARCHAR END AS label FROM ({_AREA_CELLS})",
    "rate_rules": f"SELECT area_id, layer, CASE WHEN coalesce(pop, 0) <= 0 THEN TRUE WHEN v = 0 THEN FALSE WHEN pop < 500 THEN TRUE ELSE v BETWEEN 1 AND 2 END AS suppressed, {_RATE.format(n='v')} AS reason, CASE WHEN {_RATE.format(n='v')} = 'shown' THEN ((v * 200000 + pop) // (2 * pop))::BIGINT END AS hundredths FROM ({_AREA_CELLS})",
    "complement_suppress": f"SELECT city, category, year, v, state, published::BIGINT AS published, pinned FROM ({complement_sql(_YEAR_CELLS, 'city, category', 'year', None)})",
    "complement_suppress_pop": f"SELECT * FROM {_S}",
    "label_unify_check": f"SELECT edition, city, layer, count(DISTINCT state) AS n_labels FROM {_ED} WHERE state <> 'shown' GROUP BY ALL",
    "city_rate": _RATES,
    "bar_scale": f"SELECT city, layer, CASE WHEN t <= 0 THEN 1 WHEN t <= b THEN b WHEN t <= 2 * b THEN 2 * b WHEN t <= 5 * b THEN 5 * b ELSE 10 * b END::BIGINT AS scale FROM (SELECT *, pow(10, length(greatest(t, 1)::VARCHAR) - 1)::BIGINT AS b FROM (SELECT city, layer, coalesce(max(published), 0) AS t FROM {_S} GROUP BY ALL))",
    "class_breaks": f"SELECT layer, CASE WHEN published IS NOT NULL THEN (published >= 3)::INT + (published >= 6)::INT + (published >= 12)::INT + (published >= 24)::INT END AS class, count(*) AS n FROM {_S} GROUP BY ALL",
    "displayed_total": f"SELECT city, area_id, (sum(coalesce(published, 0)) + count(*) FILTER (published IS NULL))::BIGINT AS n, CASE WHEN count(*) FILTER (published IS NULL) > 0 THEN '件以上' ELSE '件' END AS unit FROM {_S} GROUP BY ALL",
    "suppression_report": f"SELECT city, layer, count(*) AS n_cells, count(*) FILTER (state = 'small') AS n_small, count(*) FILTER (state = 'withheld') AS n_withheld, bool_or(pinned) AS pinned FROM {_S} GROUP BY ALL",
    "audit_raw": f"SELECT edition, area_id, layer, published FROM {_ED} WHERE published BETWEEN 1 AND 2",
    "audit_population_line": f"SELECT edition, verdict, count(*) AS n FROM (SELECT edition, CASE WHEN coalesce(pop, 0) = 0 OR published > pop THEN 'kept' WHEN pop < 100 AND published <= 5 THEN 'unsafe' END AS verdict FROM {_ED} WHERE published > 0) WHERE verdict IS NOT NULL GROUP BY ALL",
    "audit_margin": f"""SELECT edition, city, layer, s, shown, k, CASE WHEN w = 0 AND k > 0 THEN s - shown - k END AS m,
      CASE WHEN k = 0 THEN 'nothing hidden' WHEN w > 0 AND w < k THEN 'mixed labels' WHEN w > 0 AND k = 1 THEN 'single cell' WHEN w > 0 THEN 'labels unified' WHEN k < 2 OR s - shown - k <= 0 OR s - shown - k >= k THEN 'recoverable' WHEN least(s - shown - k, 2 * k - s + shown) < 0.25 * k THEN 'thin' ELSE 'safe' END AS verdict
      FROM (SELECT edition, city, layer, sum(coalesce(published, 0))::BIGINT AS shown, count(*) FILTER (state <> 'shown') AS k, count(*) FILTER (state = 'withheld') AS w FROM {_ED} GROUP BY ALL) JOIN {_PARENTS} USING (edition, city, layer) WHERE s IS NOT NULL""",
    "audit_interval": f"SELECT edition, area_id, layer, new_lo, new_hi, solved, route FROM {_BOUNDS}",
    "audit_recovered": f"SELECT edition, layer, count(*) AS n_hidden, count(*) FILTER (solved) AS n_solved FROM {_BOUNDS} GROUP BY ALL",
    "audit_parents_missing": f"SELECT edition, city, layer, 'cells' AS \"where\" FROM {_ED} ANTI JOIN (SELECT edition, city, layer FROM {_PARENTS} WHERE s IS NOT NULL) USING (edition, city, layer) GROUP BY ALL",
    "audit_bars": f"SELECT label, count(*) AS n_rows, 0::BIGINT AS n_leaks FROM (SELECT CASE state WHEN 'small' THEN '1-2件' ELSE '非公開' END AS label FROM {_S} WHERE state <> 'shown') GROUP BY label",
    "audit_breaks": "SELECT * FROM (VALUES ('draft', 1.0::DOUBLE), ('draft', 2.0::DOUBLE)) t(scale, lower)",
    "audit_rate_precision": f"""SELECT city, layer, pop, hidden, (total * 200000 + pop) // (2 * pop) AS value, 2 AS scale FROM (SELECT city, layer, sum(v)::BIGINT AS total, count(*) FILTER (state <> 'shown') AS hidden FROM {_S} GROUP BY ALL) g JOIN {_POP} p ON p.city_code = g.city
      WHERE pop > 0 AND pop / 100000 < greatest(hidden, 1)""",
    "audit_checks": f"""WITH e AS MATERIALIZED (SELECT * FROM {_ED}) SELECT 'raw_small' AS check, count(*) AS n_bad FROM e WHERE published BETWEEN 1 AND 2 UNION ALL SELECT 'population_line', count(*) FROM e WHERE published > 0 AND coalesce(pop, 0) > 0 AND published <= pop AND pop < 100 AND published <= 5
      UNION ALL SELECT 'mixed_labels', count(*) FROM (SELECT edition, city, layer FROM e WHERE state <> 'shown' GROUP BY ALL HAVING count(DISTINCT state) > 1) UNION ALL SELECT 'duplicate_cells', count(*) FROM (SELECT edition, city, layer, area_id FROM e GROUP BY ALL HAVING count(*) > 1)""",
    "match_rows": f"SELECT row_id, city, key, area_id, reason, box FROM ({_PLACED})",
    "decision_table_match": f"SELECT count_id, area_id, reason, box FROM ({_DECIDED})",
    "not_counted": f"SELECT b.box, coalesce(n.n, 0)::BIGINT AS n FROM (VALUES ('unresolved'), ('unobserved'), ('undecided'), ('gone')) b(box) LEFT JOIN (SELECT box, count(*) AS n FROM ({_DECIDED}) GROUP BY ALL) n ON n.box = b.box",
    "match_reasons": f"SELECT reason, count(*) AS n FROM ({_DECIDED}) GROUP BY ALL",
    "match_rate": f"SELECT city, year, count(*) AS n_rows, count(area_id) AS n_matched, ((count(area_id) * 20000 + count(*)) // (2 * count(*)))::BIGINT AS share_bp FROM ({_DECIDED}) GROUP BY ALL",
    "rejects": f"SELECT count_id, town, reason FROM ({_DECIDED}) WHERE area_id IS NULL",
    "place_keys": f"SELECT rec_no, s_name, coalesce(y.key, '') AS key FROM boundary b LEFT JOIN ({keys_sql('SELECT s_name AS v FROM boundary')}) y ON y.v = b.s_name",
    "chome_parent": f"SELECT area_id, {parent_sql('key')} AS parent FROM areas",
    "city_code5": """SELECT row_id, CASE WHEN regexp_full_match(c, '[0-9]{6}') THEN left(c, 5) WHEN regexp_full_match(c, '[0-9]{5}') THEN c ELSE '' END AS code5 FROM (SELECT row_id, trim(coalesce("市区町村コード（発生地）", '')) AS c FROM incidents)""",
    "longest_prefix": "SELECT entry_id, arg_max(name, length(name)) AS town FROM town_entries t JOIN areas a ON a.city_code = left(t.city_code, 5) AND starts_with(t.s_name, a.name) GROUP BY entry_id",
    "merge_same_name": f"SELECT city_code, key, arg_min(s_name, rec_no) AS name, arg_min(key_code, rec_no) FILTER (key_code IS NOT NULL) AS code, sum(coalesce(jinko, 0))::BIGINT AS jinko, sum(coalesce(setai, 0))::BIGINT AS setai, min(rec_no) AS ord, count(*) AS n_records FROM {_BOUNDARY} GROUP BY city_code, key",
    "codes_in_order": f"SELECT city_code, key, list(key_code ORDER BY first_no) AS codes FROM (SELECT city_code, key, key_code, min(rec_no) AS first_no FROM {_BOUNDARY} WHERE key_code IS NOT NULL GROUP BY ALL) GROUP BY ALL",
    "skipped_records": "SELECT count(*) FILTER (NOT coalesce(hcode = 8101, FALSE) OR s_name IS NULL) AS n_skipped, count(*) AS n_records FROM boundary",
    "findings": "SELECT DISTINCT '手口' AS kind, _file AS \"where\", \"手口\" AS item FROM incidents WHERE trim(\"手口\") <> '' AND \"手口\" NOT IN (" + ", ".join(f"'{c}'" for c in dims.CATEGORIES) + ") UNION ALL SELECT DISTINCT '罪名', _file, \"罪名\" FROM incidents WHERE trim(\"罪名\") <> '' AND \"罪名\" <> '窃盗'",
    "column_findings": "WITH need AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{x}')" for c, xs in dims.EXTRA.items() for x in xs) + """) n(category, item)), have AS (SELECT DISTINCT _file, unnest(map_keys(_extra)) AS item FROM incidents WHERE _extra IS NOT NULL),
      loaded AS (SELECT DISTINCT _file, category FROM feed_files WHERE stage = 'loaded') SELECT h._file, 'unknown' AS kind, h.item FROM have h JOIN loaded l ON l._file = h._file WHERE NOT EXISTS (SELECT 1 FROM need n WHERE n.category = l.category AND n.item = h.item) AND h.item NOT IN (""" + ", ".join(f"'{o}'" for o in dims.OPTIONAL) + ") UNION ALL SELECT l._file, 'missing', n.item FROM loaded l JOIN need n ON n.category = l.category WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h._file = l._file AND h.item = n.item)",
    "blank_rows": r"""SELECT row_id FROM incidents WHERE regexp_full_match(coalesce("罪名", ''), '[\s\p{Z}\x{200B}\x{85}]*') AND regexp_full_match(coalesce("発生時（始期）", ''), '[\s\p{Z}\x{200B}\x{85}]*')""",
    "run_summary": "SELECT run_no, 'status' AS kind, coalesce(status, '') AS value, count(*) AS n FROM fetch_manifest GROUP BY ALL UNION ALL SELECT run_no, 'result', coalesce(result, ''), count(*) FROM fetch_manifest GROUP BY ALL",
    "snapshot_outcomes": f"SELECT run_no, path, CASE WHEN content IS NULL AND before IS NULL THEN 'missing' WHEN content IS NULL THEN 'kept_previous' WHEN before IS NULL THEN 'new' WHEN content = before THEN 'same' ELSE 'changed' END AS outcome FROM (SELECT *, last_value(content IGNORE NULLS) OVER (PARTITION BY path ORDER BY run_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {_MANIFEST_ONE})",
    "content_fingerprint": "SELECT run_no, sha256(string_agg(coalesce(path, '') || chr(0) || coalesce(sha256, '') || chr(10), '' ORDER BY coalesce(path, ''), coalesce(sha256, ''))) AS fingerprint, count(*) AS n_members FROM fetch_manifest GROUP BY run_no",
    "four_caps": f"SELECT user_id, day, n, " + ", ".join(f"(sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN {k - 1} PRECEDING AND CURRENT ROW) - 1)::BIGINT AS in_{k}" for k in (1, 7, 30)) + f" FROM (SELECT user_id, day, count(*) AS n FROM {_DAYS} GROUP BY ALL)",
    "congestion": "SELECT *, busy AND coalesce(lag(busy) OVER (PARTITION BY user_id ORDER BY day), FALSE) AS goes_on FROM (SELECT user_id, date_diff('day', DATE '2020-01-01', ts::DATE)::INT AS day, bool_or(coalesce(event_type = 'error', FALSE)) AS busy FROM events GROUP BY ALL)",
    "waits": "SELECT user_id, count(*) AS n FROM (SELECT user_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS us FROM events) WHERE us < 3600000000 GROUP BY user_id",
    "moved_back": "SELECT path, run_no FROM (SELECT path, run_no, f, lag(f) OVER (PARTITION BY path ORDER BY run_no) AS b FROM (SELECT path, run_no, max(fetched_at) AS f FROM fetch_manifest WHERE fetched_at IS NOT NULL GROUP BY ALL)) WHERE f < b",
    "sitemap": f"SELECT '<url><loc>{BASE}/cho/' || key_codes[1] || '.html</loc></url>' AS line FROM areas",
    "heading_scan": "SELECT 'cho/' || key_codes[1] || '.html' AS path, name || '（' || city_name || '）' AS heading FROM areas, (VALUES (1), (2)) t(i)",
    "vanished": "WITH k AS (SELECT DISTINCT run_no, path FROM fetch_manifest), r AS (SELECT run_no, lead(run_no) OVER (ORDER BY run_no) AS nx FROM (SELECT DISTINCT run_no FROM k)) SELECT r.nx AS run_no, count(*) AS n_before, count(*) FILTER (c.path IS NULL) AS n_gone, count(*) FILTER (c.path IS NULL) * 2 >= count(*) AS alarm FROM k JOIN r ON r.run_no = k.run_no AND r.nx IS NOT NULL LEFT JOIN k c ON c.run_no = r.nx AND c.path = k.path GROUP BY r.nx",
    "complete_marks": "SELECT * FROM (VALUES (1, TRUE), (2, FALSE), (3, NULL), (4, FALSE), (5, NULL)) t(id, complete)",
    "rolling_cap": f"SELECT user_id, day, n, (sum(n) OVER (PARTITION BY user_id ORDER BY day RANGE BETWEEN 6 PRECEDING AND CURRENT ROW) - 1)::BIGINT AS n_within FROM (SELECT user_id, day, count(*) AS n FROM {_DAYS} GROUP BY ALL)",
    "prev_observation": f"SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS previous FROM (SELECT DISTINCT * FROM {_DAYS})",
    "robots_match": "WITH r AS (SELECT * FROM (VALUES " + ", ".join(f"({len(p)}, {str(a).upper()}, '{x}')" for (p, x), (_, a, _) in zip(RULE_SQL, RULES)) + ") t(n, allow, rx)), u AS (SELECT DISTINCT url, regexp_extract(url, '^[a-z]+://[^/]+(/.*)$', 1) AS path FROM fetch_manifest WHERE url IS NOT NULL) SELECT u.url, CASE WHEN u.path = '/robots.txt' THEN TRUE ELSE coalesce(max_by(r.allow, r.n * 2 + r.allow::INT), TRUE) END AS allowed FROM u LEFT JOIN r ON regexp_matches(u.path, r.rx) GROUP BY u.url, u.path",
    "url_host": r"SELECT entry_id, CASE WHEN regexp_full_match(url, '(?i)https?://[^\s\\/?#@]+(?:[/?#]\S*)?') THEN lower(regexp_extract(url, '^[A-Za-z]+://([^:/?#]*)', 1)) END AS host FROM fetch_manifest",
    "url_scope": "SELECT url, scope, CASE WHEN scope LIKE '%?%' THEN url = scope WHEN scope LIKE '%/' THEN starts_with(split_part(url, '?', 1), scope) ELSE url = scope END AS inside FROM (SELECT DISTINCT url FROM fetch_manifest WHERE url IS NOT NULL) CROSS JOIN (VALUES " + ", ".join(f"('{x}')" for x in SCOPES) + ") s(scope)",
    "word_hits": f"SELECT doc_id, line_no::INT AS line_no, word FROM {_LINES} CROSS JOIN (VALUES " + ", ".join(f"('{w}')" for w in WORDS) + ") w(word) WHERE contains(line, word)",
    "number_tokens": f"SELECT doc_id, count(*) AS n_numbers, sum(n)::BIGINT AS total FROM (SELECT doc_id, try_cast(replace(unnest(regexp_extract_all(line, '[0-9][0-9,]*')), ',', '') AS BIGINT) AS n FROM {_LINES}) WHERE n IS NOT NULL GROUP BY doc_id",
    "audit_text_parents": f"""WITH g AS (SELECT * FROM {_TOWNS}), t AS (SELECT DISTINCT doc_id, line_no::INT AS line_no, line, try_cast(replace(unnest(regexp_extract_all(line, '[0-9][0-9,]*')), ',', '') AS BIGINT) AS n FROM {_LINES})
      SELECT doc_id, line_no, city, clue, n, k, CASE WHEN n - shown - k IN (0, k) THEN 'unique' ELSE 'narrowed' END AS verdict FROM t JOIN g ON contains(line, clue) AND n BETWEEN shown + k AND shown + 2 * k""",
    "party_kind": f"""SELECT name, CASE WHEN list_bool_or(list_transform([{_ORG}], lambda w: contains(name, w))) OR regexp_matches(name, '^国(?:$|[ 　])') OR list_bool_or(list_transform([{_PUBLIC}], lambda w: contains(name, w)))
      OR (NOT regexp_matches(name, '\\p{{Nd}}') AND NOT regexp_matches(name, '丁目|番|号|地') AND length(name) <= 6 AND regexp_matches(name, '[都道府県市区町村]$'))
      OR regexp_matches(core, '[A-Za-z]') OR regexp_matches(core, '^[ァ-ヶー]+$') THEN 'corp' ELSE 'individual' END AS kind
      FROM (SELECT name, regexp_replace(regexp_replace(name, 'ほか|他|外|など|ら', '', 'g'), '[\\s\\p{{Z}}・，,.／/\\-－＆&（）()]', '', 'g') AS core FROM (SELECT s_name AS name FROM supplier UNION SELECT * FROM (VALUES """ + ", ".join(f"('{n}')" for n in NAMES) + ") v(name)))",
    "redact_addr": "SELECT addr, kind, CASE WHEN kind = 'individual' THEN regexp_extract(trim(addr), '^[^-−]*') ELSE trim(addr) END AS shown FROM (VALUES " + ", ".join(f"('{a}', '{k}')" for a, k in ADDRESSES) + ") t(addr, kind)",
    "top_findings": f"SELECT * FROM ({_AREA_CELLS}) WHERE v > 0 ORDER BY pop, v, area_id, layer LIMIT 8",
    "anti_area": "SELECT DISTINCT _file FROM raw_records WHERE _file NOT IN (SELECT _file FROM feed_files WHERE stage = 'loaded' AND _file IS NOT NULL)",
    "area_records": f"""SELECT concat_ws(':', '{SITE}', s.city, a.key_codes[1], s.layer) AS id, a.name || '（' || a.city_name || '）' || period || '年の' || ln || 'の窃盗認知件数' AS title, '犯罪統計/' || ln AS kind, (SELECT max(_year) FROM incidents) || '-12-31' AS date, period, a.pref, a.city_name AS city, s.city AS city_code,
      a.city_name || a.name AS addr, s.city || '|' || a.key AS addr_key, s.city || '|' || regexp_replace(a.key, '丁目$', '') AS addr_key_town, '' AS party, 'none' AS party_kind, '{BASE}/cho/' || a.key_codes[1] || '.html' AS url, '{SOURCE}' AS source_url, (SELECT max(delivered_at)::DATE::VARCHAR FROM feed_files WHERE stage = 'loaded') AS fetched_on, s.pop AS population, s.published AS count,
      CASE WHEN s.state = 'withheld' THEN '非公開' WHEN s.published IS NULL THEN '1-2' ELSE s.published::VARCHAR END AS count_label, r AS rate_per_1k, r IS NULL AS rate_suppressed
      FROM (SELECT *, CASE layer WHEN 'bicycle' THEN '自転車' ELSE '車・バイク' END AS ln, CASE WHEN published IS NOT NULL AND {_RATE.format(n='published')} = 'shown' THEN ((published * 200000 + pop) // (2 * pop)) / 100 END::DOUBLE AS r FROM {_S}, (SELECT (max(_year) - 7) || '-' || max(_year) AS period FROM incidents)) s JOIN areas a ON a.area_id = s.area_id""",
    "city_records": f"""SELECT p.city_code, p.city_name AS city, '犯罪統計/' || category AS kind, year AS period, CASE WHEN NOT (v BETWEEN 1 AND 2) THEN v END AS count, CASE WHEN v <= 0 THEN '0' WHEN v <= 2 THEN '1-2' ELSE v::VARCHAR END AS count_label, p.pop AS population,
      CASE WHEN {_RATE.format(n='v')} = 'shown' THEN ((v * 200000 + pop) // (2 * pop)) / 100 END::DOUBLE AS rate_per_1k, CASE WHEN coalesce(pop, 0) <= 0 THEN TRUE WHEN v = 0 THEN FALSE WHEN pop < 500 THEN TRUE ELSE v BETWEEN 1 AND 2 END AS rate_suppressed
      FROM ({_YEAR_CELLS}) c JOIN {_POP} p ON p.city_code = c.city""",
    "town_list": "SELECT city_code, list_sort(list(DISTINCT key)) AS towns FROM areas WHERE trim(key) <> '' GROUP BY city_code",
}
