"""Recover hidden cells from what is published, as a reader could: every operator here reads published values only.

Published cells carry ``published`` (null where hidden) and ``state``; parents are sums the same publication gives away. Nulls in a
parent mean that the parent itself is hidden: then nothing follows from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspan.functions import sdc
from tallyspan.functions.web import lines, number_tokens
from tallyspan.session import is_small

#: Up to this number of hidden parents are tested against every line that holds a digit.
MOST_CLUES = 2_000

HIDDEN_LABELS = ("1-2件", "非公開")  # fixed values
THIN = 0.25  # a margin below this share of the hidden cells is reported as thin


def editions(cells: DataFrame) -> DataFrame:
    """Suppressed cells as three publications: ``raw`` (nothing hidden), ``primary`` (small counts only) and ``final``; an audit has to find the
    leaks of the first two."""
    small = sdc.is_small(F.col("v"))
    one = lambda name, state, value: F.struct(F.lit(name).alias("edition"), state.alias("state"), value.cast("bigint").alias("published"))
    each = F.array(one("raw", F.lit("shown"), F.col("v")), one("primary", F.when(small, "small").otherwise("shown"), F.when(~small, F.col("v"))), one("final", F.col("state"), F.col("published")))
    return cells.select("city", "area_id", "layer", "pop", F.explode(each).alias("e")).select("city", "area_id", "layer", "pop", "e.*")


def published_parents(city_cells: DataFrame, layers: DataFrame) -> DataFrame:
    """``city``, ``layer``, ``s``: sum that published cells of city, category and year (``count``, null where hidden) give away; null if any is hidden."""
    j = city_cells.join(F.broadcast(layers), "category")
    return j.groupBy("city", "layer").agg(F.when(F.count("*") == F.count("count"), F.sum("count")).alias("s"))


def raw_small(df: DataFrame, value: str = "published") -> DataFrame:
    """Published cells that still show a small count."""
    return df.where(sdc.is_small(F.col(value)))


def population_line(df: DataFrame) -> DataFrame:
    """Shown cells with few cases among few residents: ``verdict`` unsafe, or kept where nobody lives there or victims outnumber them."""
    n, pop = F.col("published"), F.coalesce(F.col("pop"), F.lit(0))
    verdict = F.when((pop == 0) | (n > pop), "kept").when((pop < sdc.LINE_POPULATION) & (n <= sdc.LINE_MAX), "unsafe")
    return df.where(n > 0).withColumn("verdict", verdict).where(F.col("verdict").isNotNull())


def label_mix(df: DataFrame, group: list[str]) -> DataFrame:
    """Number of different labels among the hidden cells of a group; more than one gives cells away."""
    return df.where(F.col("state") != "shown").groupBy(*group).agg(F.count_distinct("state").alias("n_labels"))


def choose(n: Column, k: Column) -> Column:
    """Binomial coefficient as a double, exact up to 2**53: product over the smaller side, ``infinity`` where a double ends."""
    small = F.least(k, n - k)
    product = F.aggregate(F.sequence(F.lit(1).cast("bigint"), F.greatest(small, F.lit(1)).cast("bigint")), F.lit(1.0), lambda acc, i: acc * (n - small + i) / i)
    return F.when((k < 0) | (k > n), F.lit(0.0)).when(small == 0, F.lit(1.0)).otherwise(product)


def margins(cells: DataFrame, parents: DataFrame, group: list[str]) -> DataFrame:
    """Per group with a known parent sum ``s``: hidden cells ``k``, how many of them are 2 (``m``), whether that gives them away."""
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    g = cells.groupBy(*group).agg(F.sum(F.coalesce("published", F.lit(0))).alias("shown"), one(F.col("state") != "shown").alias("k"), one(F.col("state") == "withheld").alias("n_withheld"))
    j = g.join(parents.where(F.col("s").isNotNull()), group)
    m = F.col("s") - F.col("shown") - F.col("k")
    plain = (F.col("n_withheld") == 0) & (F.col("k") > 0)
    j = j.withColumn("m", F.when(plain, m)).withColumn("margin", F.when(plain, F.least(m, F.col("k") - m)))
    verdict = (
        F.when(F.col("k") == 0, "nothing hidden")
        .when((F.col("n_withheld") > 0) & (F.col("n_withheld") < F.col("k")), "mixed labels")
        .when((F.col("n_withheld") > 0) & (F.col("k") == 1), "single cell")
        .when(F.col("n_withheld") > 0, "labels unified")
        .when((F.col("k") < 2) | (F.col("m") <= 0) | (F.col("m") >= F.col("k")), "recoverable")
        .when(F.col("margin") < THIN * F.col("k"), "thin")
        .otherwise("safe")
    )
    return j.withColumn("verdict", verdict)


def intervals(cells: DataFrame, parents: DataFrame, group: list[str]) -> DataFrame:
    """Bounds of every hidden cell before and after its group's parent sum is used, in closed form; ``solved`` if they meet, ``route`` names the
    relation that solved it. Sums are pre-aggregated per group; no group is ordered or held."""
    j = grid(cells, parents, group)
    sums = j.groupBy(*group).agg(F.sum("lo").alias("sum_lo"), F.sum("hi").alias("sum_hi"))
    j = j.join(sums, group)
    lo = F.when(F.col("s").isNotNull(), F.greatest(F.col("lo"), F.col("s") - (F.col("sum_hi") - F.col("hi")))).otherwise(F.col("lo"))
    hi = F.when(F.col("s").isNotNull(), F.least(F.col("hi"), F.col("s") - (F.col("sum_lo") - F.col("lo")))).otherwise(F.col("hi"))
    solved = F.coalesce((F.col("state") != "shown") & (F.col("new_lo") == F.col("new_hi")), F.lit(False))
    return j.withColumns({"new_lo": lo, "new_hi": hi}).withColumn("solved", solved).withColumn("route", F.when(F.col("solved"), F.col("route"))).drop("sum_lo", "sum_hi")


def recovered(bounds: DataFrame, by: list[str]) -> DataFrame:
    """Hidden and solved cells per ``by``."""
    return bounds.where("state <> 'shown'").groupBy(*by).agg(F.count("*").alias("n_hidden"), F.count_if("solved").alias("n_solved"))


def rate_too_fine(rates: DataFrame) -> DataFrame:
    """Published city rates whose rounding step is worth fewer cases than are hidden: ``value``, ``scale``, ``pop``, ``hidden``."""
    worth = F.col("pop") / 1000 / F.pow(F.lit(10.0), F.col("scale"))
    return rates.where(F.col("value").isNotNull() & (worth < F.greatest(F.col("hidden"), F.lit(1))))


def breaks_in_small(breaks: list[float]) -> list[float]:
    """Class breaks that lie among the counts that are hidden."""
    return [b for b in breaks if b <= sdc.MAX_SMALL]


def class_break_findings(spark, **scales: list[float]) -> DataFrame:
    """``scale``, ``lower`` of every class break among the hidden counts."""
    rows = [(name, float(b)) for name, breaks in scales.items() for b in breaks_in_small(breaks)]
    return spark.createDataFrame(rows, "scale string, lower double")


def bar_leaks(pages: DataFrame) -> DataFrame:
    """Rows of published pages (``path``, ``html``) whose count is hidden: their label and whether the bar has a width all the same."""
    row = r'(<td class="v num">[^<]*</td><td class="barcell">.*?</td>)'
    rows = pages.select("path", F.posexplode(F.regexp_extract_all("html", F.lit(row), F.lit(1))).alias("row_no", "cells"))
    label = F.regexp_extract("cells", r'class="v num">([^<]*)<', 1)
    width = F.nullif(F.regexp_extract("cells", r"width:([0-9.]+)%", 1), F.lit("")).cast("double")
    return rows.select("path", "row_no", label.alias("label"), F.coalesce(width, F.lit(0.0)).alias("width")).where(F.col("label").isin(*HIDDEN_LABELS)).withColumn("leaks", F.col("width") > 0)


def missing_parents(published: DataFrame, group: list[str], parents: DataFrame) -> DataFrame:
    """Groups of the publication that lack a row among the parents an audit needs, and parents without cells: ``where`` is cells or parents."""
    a, b = published.select(*group).distinct(), parents.select(*group).distinct()
    return a.join(b, group, "left_anti").withColumn("where", F.lit("cells")).unionByName(b.join(a, group, "left_anti").withColumn("where", F.lit("parents")))


def grid(cells: DataFrame, parents: DataFrame, group: list[str]) -> DataFrame:
    """The reader's table: every cell with its bounds and, where the group's parent is published, the relation it stands in. Hour bands are
    counted over other rows and are related to nothing."""
    hidden = F.col("state") != "shown"
    j = cells.join(parents.select(*group, "s"), group, "left")
    hi = F.when(~hidden, F.col("published")).when(F.col("state") == "small", sdc.MAX_SMALL).otherwise(F.col("s"))
    return j.withColumns({"lo": F.when(~hidden, F.col("published")).otherwise(1).cast("bigint"), "hi": hi.cast("bigint"), "route": F.when(F.col("s").isNotNull(), F.concat_ws("/", *group))})


def text_clues(cells: DataFrame, names: DataFrame, group: list[str]) -> DataFrame:
    """Hidden parents that a text could name: ``clue`` (from ``names``: ``city``, ``clue``), ``shown``, ``k``; groups whose hidden cells are all small."""
    g = cells.groupBy(*group).agg(F.sum(F.coalesce("published", F.lit(0))).alias("shown"), F.count_if(F.col("state") != "shown").alias("k"), F.count_if(F.col("state") == "withheld").alias("w"))
    return g.where("k > 0 AND w = 0").join(names, "city").select(*group, "clue", "shown", "k")


def text_parents(texts: DataFrame, text: str, parents: DataFrame) -> DataFrame:
    """Lines of published text that name a group and hold a number in the range of its hidden parent.

    ``parents``: ``clue``, ``shown``, ``k`` (hidden cells of 1 or 2 each), anything else. The clue must stand in the line and the number lie in
    [shown + k, shown + 2k]. Lines without a digit leave first. A list of parents that a count proves small travels as one array, so that a
    line is tested where it is read; a larger one is joined by number. Each hit tells how many assignments are left: one is a leak, fewer
    than all is a narrowing."""
    own = [c for c in parents.columns]
    rows = lines(texts.where(F.col(text).rlike("[0-9]")), text).where(F.col("line").rlike("[0-9]"))
    toks = rows.withColumn("_n", F.array_distinct(number_tokens(F.col("line"))))
    if is_small(parents, MOST_CLUES):
        listed = parents.agg(F.collect_list(F.struct(*own)).alias("_p"))
        here = F.filter("_p", lambda p: F.contains(F.col("line"), p["clue"]) & F.exists("_n", lambda n: n.between(p["shown"] + p["k"], p["shown"] + 2 * p["k"])))
        named = toks.crossJoin(F.broadcast(listed)).withColumn("_h", F.explode(here)).drop("_p")
        hits = named.withColumn("n", F.explode("_n")).select(*[c for c in rows.columns], "n", *[F.col(f"_h.{c}").alias(c) for c in own])
        hits = hits.where(F.col("n").between(F.col("shown") + F.col("k"), F.col("shown") + 2 * F.col("k")))
    else:
        wide = parents.withColumn("n", F.explode(F.sequence(F.col("shown") + F.col("k"), F.col("shown") + 2 * F.col("k"))))
        hits = toks.withColumn("n", F.explode("_n")).drop("_n").join(wide, "n").where(F.contains(F.col("line"), F.col("clue")))
    m = F.col("n") - F.col("shown") - F.col("k")
    verdict = F.when((m == 0) | (m == F.col("k")), "unique").otherwise("narrowed")  # C(k, m) < 2**k for every 0 < m < k
    return hits.withColumn("ways", choose(F.col("k"), m)).withColumn("verdict", verdict).drop("line")


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def checks(published: DataFrame, group: list[str]) -> DataFrame:
    """All cell checks as one table (``check``, ``n_bad``), none skipped when another fails: one aggregate over the cells, one over their groups."""
    cell = published.groupBy(*group, "area_id").agg(
        F.count("*").alias("n"), F.count_if(sdc.is_small(F.col("published"))).alias("raw_small"),
        F.count_if((F.col("published") > 0) & (F.coalesce("pop", F.lit(0)) > 0) & (F.col("published") <= F.col("pop")) & (F.col("pop") < sdc.LINE_POPULATION) & (F.col("published") <= sdc.LINE_MAX)).alias("population_line"),
        F.count_if(F.col("state") == "small").alias("small"), F.count_if(F.col("state") == "withheld").alias("withheld"),
    )
    per = cell.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("raw_small", "population_line", "small", "withheld")], F.count_if(F.col("n") > 1).alias("duplicate_cells"))
    whole = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("raw_small", "population_line", "duplicate_cells")], F.count_if((F.col("small") > 0) & (F.col("withheld") > 0)).alias("mixed_labels"))
    names = ["raw_small", "population_line", "mixed_labels", "duplicate_cells"]
    return whole.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("n_bad")) for c in names])).alias("x")).select("x.*")
