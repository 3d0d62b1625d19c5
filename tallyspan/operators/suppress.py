"""Cell suppression per group: primary, population-aware and complementary, in two window passes and without iteration.

Small counts are hidden; so are counts on the population line. If the group's total then determines a hidden cell, the smallest shown
cells (by value, then ``ord``) are withheld too, as many as are needed. Once one such cell is hidden, lower bounds cannot rise any more,
so a hidden cell is determined exactly if the hidden total equals the sum of lower bounds: that gives the number in closed form.
If anything is withheld, every hidden cell of the group carries the same label.

A group is all cells of one (city, layer), the unit that has to be judged as one; its aggregates are pre-aggregated before the
exchange, the ranking window is partitioned by group.

Defined results: a null value counts as 0 and is shown as 0; null populations mean no population line; ties are broken by ``ord``; equal
``ord`` by the row itself; empty input gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions import sdc


def suppress(df: DataFrame, group: list[str], value: str, ord_: list[str], pop: str | None = None) -> DataFrame:
    """``df`` with ``state`` (shown, small, withheld), ``published`` (null where hidden), ``pinned`` (the group still gives a cell away)."""
    # the row is packed away, so that no column of it can clash with the working ones
    keys, order = [f"g{i}" for i in range(len(group))], [f"o{i}" for i in range(len(ord_))]
    kept = [c for c in df.columns if c not in ("state", "published", "pinned")]
    v = F.coalesce(F.col(value), F.lit(0)).cast("bigint")
    d = df.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), *[F.col(c).alias(k) for c, k in zip(group, keys)], *[F.col(c).alias(o) for c, o in zip(ord_, order)],
        v.alias("v"), (F.col(pop) if pop else F.lit(None).cast("bigint")).alias("pop"),
    )
    line = (~sdc.is_small(F.col("v")) & (F.col("v") > 0) & sdc.suppress_count(F.col("v"), F.col("pop"))) if pop else F.lit(False)
    d = d.withColumns({"small": sdc.is_small(F.col("v")), "line": line}).withColumn("cand", (F.col("v") > sdc.MAX_SMALL) & ~F.col("line"))
    # pass 1: group aggregates, partially aggregated before the exchange
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    hidden = F.col("small") | F.col("line")
    g = d.groupBy(*keys).agg(
        one(F.col("small")).alias("ns"), one(F.col("line")).alias("nl"), F.sum(F.when(hidden, F.col("v")).otherwise(0)).alias("t"),
        one(F.col("cand")).alias("c"), one(F.col("cand") & (F.col("v") == 3)).alias("n3"),
    )
    k, lo, hi = F.col("ns") + F.col("nl"), F.col("ns") + 3 * F.col("nl"), 2 * F.col("ns") + sdc.LINE_MAX * F.col("nl")
    determined = (k > 0) & ((k == 1) | (F.col("t") == lo) | (F.col("t") == hi))
    need = F.when(~determined, 0).when(F.col("t") > lo, F.least(F.lit(1), F.col("c"))).otherwise(F.least(F.col("n3") + 1, F.col("c")))
    g = g.select(*[F.col(x).alias(f"h{x}") for x in keys], "nl", "t", need.alias("m"), determined.alias("det"), lo.alias("lo"))
    j = d.join(g, [F.col(x).eqNullSafe(F.col(f"h{x}")) for x in keys])
    # pass 2: rank candidates where any are needed
    rank = F.when(F.col("cand") & (F.col("m") > 0), F.row_number().over(Window.partitionBy(*keys, "cand").orderBy("v", *order)))
    j = j.withColumn("added", F.coalesce(rank <= F.col("m"), F.lit(False)))
    total_added = F.sum(F.when(F.col("added"), F.col("v")).otherwise(0)).over(Window.partitionBy(*keys))
    withheld = F.col("line") | F.col("added") | (F.col("small") & ((F.col("nl") > 0) | (F.col("m") > 0)))
    pinned = (F.col("det") & (F.col("m") == 0)) | ((F.col("m") > 0) & (F.col("t") + total_added == F.col("lo") + 3 * F.col("m")))
    state = F.when(withheld, "withheld").when(F.col("small"), "small").otherwise("shown")
    return j.select("row", "v", state.alias("state"), pinned.alias("pinned")).select("row.*", "state", F.when(F.col("state") == "shown", F.col("v")).alias("published"), "pinned")


def complement_sql(cells: str, group: str, ord_: str, pop: str | None = "pop") -> str:
    """The same as SQL over a relation with columns of ``group``, ``v``, ``ord_`` and ``pop``."""
    line = f"(v > 2 AND coalesce({pop}, 0) > 0 AND v <= {pop} AND {pop} < 100 AND v <= 5)" if pop else "FALSE"
    return f"""
SELECT * EXCLUDE (small, line, cand, ns, nl, t, c, n3, lo, hi, det, m, rk, added),
       CASE WHEN line OR added OR (small AND (nl > 0 OR m > 0)) THEN 'withheld' WHEN small THEN 'small' ELSE 'shown' END AS state,
       CASE WHEN line OR added OR small THEN NULL ELSE v END AS published,
       (det AND m = 0) OR (m > 0 AND t + sum(CASE WHEN added THEN v ELSE 0 END) OVER (PARTITION BY {group}) = lo + 3 * m) AS pinned
FROM (SELECT *, coalesce(cand AND m > 0 AND rk <= m, FALSE) AS added
FROM (SELECT *, CASE WHEN NOT det THEN 0 WHEN t > lo THEN least(1, c) ELSE least(n3 + 1, c) END AS m
FROM (SELECT *, (ns + nl > 0) AND (ns + nl = 1 OR t = lo OR t = hi) AS det
FROM (SELECT *, ns + 3 * nl AS lo, 2 * ns + 5 * nl AS hi
FROM (SELECT *, sum(small::INT) OVER g AS ns, sum(line::INT) OVER g AS nl, sum(CASE WHEN small OR line THEN v ELSE 0 END) OVER g AS t,
       sum(cand::INT) OVER g AS c, sum((cand AND v = 3)::INT) OVER g AS n3, row_number() OVER (PARTITION BY {group}, cand ORDER BY v, {ord_}) AS rk
FROM (SELECT *, v > 2 AND NOT line AS cand FROM (SELECT *, v BETWEEN 1 AND 2 AS small, {line} AS line FROM ({cells})))
WINDOW g AS (PARTITION BY {group}))))))
"""
