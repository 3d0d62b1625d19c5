"""Observations of sources over time: run summaries, fingerprints, previous observations, rolling caps, completeness."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

MARKS = ["入口に届いた", "必要本文を受け取った", "ページ送りを最後まで受け取った", "辿る対象の失敗0", "上限未到達", "全件数表示と一致", "最終URLが承認範囲内", "private保存成功", "解析できた"]  # fixed values
YES, NO, UNKNOWN = "はい", "いいえ", "分からない"


def run_summary(manifest: DataFrame) -> DataFrame:
    """Counts by status and by result of each run, two grains in one pass."""
    g = manifest.groupingSets([("run_no", "status"), ("run_no", "result")], "run_no", "status", "result").agg(F.count("*").alias("n"), F.grouping("status").alias("gs"))
    return g.select("run_no", F.when(F.col("gs") == 0, "status").otherwise("result").alias("kind"), F.coalesce(F.when(F.col("gs") == 0, F.col("status")).otherwise(F.col("result")), F.lit("")).alias("value"), "n")


def outcome(content: Column, before: Column) -> Column:
    """new, same, changed, kept_previous or missing of an entry whose content and previous content are given (null: none)."""
    return F.when(content.isNull() & before.isNull(), "missing").when(content.isNull(), "kept_previous").when(before.isNull(), "new").when(content == before, "same").otherwise("changed")


def outcomes(manifest: DataFrame) -> DataFrame:
    """What each run's entry really was, from the hashes alone: ``run_no``, ``path``, ``outcome``."""
    from tallyspan.operators.snapshot import entries

    known = Window.partitionBy("path").orderBy("run_no").rowsBetween(Window.unboundedPreceding, -1)
    return entries(manifest).withColumn("before", F.last("content", ignorenulls=True).over(known)).select("run_no", "path", outcome(F.col("content"), F.col("before")).alias("outcome"))


def fingerprint(members: DataFrame, group: list[str], name: str, digest: str) -> DataFrame:
    """Content fingerprint of a set of named members, whatever order or packing they come in: SHA-256 over ``name``, a zero byte, ``digest`` and a line break of
    every member, sorted by name. The digest is sequential by definition, so a group is one task; its members stream through, sorted by the
    exchange, and only the state of the hash is held. A null name or digest counts as ''."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = members.select(*group, text(name).alias("_n"), text(digest).alias("_d"))
    lines_ = rows.repartition(*group).sortWithinPartitions(*group, "_n", "_d").select(F.to_json(F.struct(*group), {"ignoreNullFields": "false"}).alias("_k"), F.concat("_n", F.lit("\x00"), "_d", F.lit("\n")).alias("_l"), *group)
    schema = T.StructType([*[members.schema[g] for g in group], T.StructField("fingerprint", T.StringType()), T.StructField("n_members", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, n, head = None, hashlib.sha256(), 0, None
        out: list[tuple] = []
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin = 0
            while begin < len(keys):
                end = begin
                while end < len(keys) and keys[end] == keys[begin]:
                    end += 1
                if keys[begin] != key:
                    if key is not None:
                        out.append((*head, state.hexdigest(), n))
                    key, state, n, head = keys[begin], hashlib.sha256(), 0, [batch.column(2 + i)[begin].as_py() for i in range(len(group))]
                state.update("".join(texts[begin:end]).encode())
                n += end - begin
                begin = end
        if key is not None:
            out.append((*head, state.hexdigest(), n))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], names=arrow.names)

    arrow = to_arrow_schema(schema)
    return lines_.mapInArrow(run, schema)


def vanished(snapshot: DataFrame) -> DataFrame:
    """Per run: keys of the run before, how many of them vanished, and whether that is half of them or more. ``snapshot``: ``run_no``, ``path``."""
    keys = snapshot.select("run_no", "path").distinct()
    runs = keys.select("run_no").distinct()
    order = runs.select("run_no", F.lead("run_no").over(Window.orderBy("run_no")).alias("next_run"))  # one row per run
    before = keys.join(F.broadcast(order), "run_no").where(F.col("next_run").isNotNull()).select(F.col("next_run").alias("run_no"), "path")
    gone = before.join(keys.withColumn("still", F.lit(1)), ["run_no", "path"], "left")
    return gone.groupBy("run_no").agg(F.count("*").alias("n_before"), F.count_if(F.col("still").isNull()).alias("n_gone")).withColumn("alarm", F.col("n_gone") * 2 >= F.col("n_before"))


def complete(marks: Column, required: list[str]) -> Column:
    """Three-valued: false if any required mark says no, null if one is missing or unknown, else true; nothing required is undetermined."""
    if not required:
        return F.lit(None).cast("boolean")
    out = F.lit(True)
    for m in required:
        v = F.try_element_at(marks, F.lit(m))
        out = out & F.when(v == YES, True).when(v == NO, False)
    return out


def zero_rows(before: Column, now: Column, evidence: Column) -> Column:
    """Nothing after something needs explicit evidence."""
    return F.when((now == 0) & (F.coalesce(before, F.lit(0)) > 0) & ~F.coalesce(evidence, F.lit(False)), UNKNOWN).otherwise(YES)


def may_diff(before: Column, now: Column) -> Column:
    """Two observations (structs ``complete``, ``origin``, ``method``) may be compared: both complete, same origin and method."""
    ok = lambda x: F.coalesce(x["complete"], F.lit(False))
    return F.coalesce(before.isNotNull() & ok(before) & ok(now) & before["origin"].eqNullSafe(now["origin"]) & before["method"].eqNullSafe(now["method"]), F.lit(False))


def previous(df: DataFrame, who: str, when: str) -> DataFrame:
    """Each observation with the day of the one before it of the same party."""
    return df.withColumn("previous", F.lag(when).over(Window.partitionBy(who).orderBy(when)))


def rolling_counts(df: DataFrame, who: str, day: str, days: int) -> DataFrame:
    """Earlier records of the same party within less than ``days`` days, same-day ones included. ``day``: a day number.

    Records are first counted per day, so a busy party is as many rows as days, and the range window runs over those."""
    per_day = df.groupBy(who, day).agg(F.count("*").alias("n"))
    w = Window.partitionBy(who).orderBy(day).rangeBetween(-(days - 1), Window.currentRow)
    return per_day.select(who, day, "n", (F.sum("n").over(w) - 1).alias("n_within"))


def cap_counts(df: DataFrame, who: str, day: str, caps: dict[str, int]) -> DataFrame:
    """``rolling_counts`` for several windows at once: a column per cap (name → days) over the same per-day counts."""
    per_day = df.groupBy(who, day).agg(F.count("*").alias("n"))
    within = lambda days: F.sum("n").over(Window.partitionBy(who).orderBy(day).rangeBetween(-(days - 1), Window.currentRow)) - 1
    return per_day.select(who, day, "n", *[within(days).alias(name) for name, days in caps.items()])


def congestion(df: DataFrame, who: str, day: str, busy: Column) -> DataFrame:
    """Days on which a party was busy (``busy`` of any record) and had been so on its previous observed day, too."""
    per_day = df.groupBy(who, day).agg(F.bool_or(F.coalesce(busy, F.lit(False))).alias("busy"))
    return per_day.withColumn("goes_on", F.col("busy") & F.coalesce(F.lag("busy").over(Window.partitionBy(who).orderBy(day)), F.lit(False)))


def waits(df: DataFrame, who: str, at: str, least: int, delay: Column | None = None) -> DataFrame:
    """Seconds since the party's previous request and how many it should still have waited: the larger of ``least`` and ``delay`` less what passed."""
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    passed = (micros - F.lag(micros).over(Window.partitionBy(who).orderBy(at))) / 1e6
    wanted = F.greatest(F.lit(float(least)), F.coalesce(delay.cast("double") if delay is not None else F.lit(0.0), F.lit(0.0)))
    return df.withColumn("passed", passed).withColumn("short_by", F.greatest(wanted - F.col("passed"), F.lit(0.0)))


def moved_back(stamps: DataFrame, key: list[str], order: str, stamp: str) -> DataFrame:
    """Entries whose date stamp is older than that of the same key one ``order`` before: ``before`` and ``stamp``. Nulls are no stamps."""
    one = stamps.where(F.col(stamp).isNotNull()).groupBy(*key, order).agg(F.max(stamp).alias(stamp))
    return one.withColumn("before", F.lag(stamp).over(Window.partitionBy(*key).orderBy(order))).where(F.col(stamp) < F.col("before"))


def accept_in_turn(attempts: DataFrame, cap: int, days: int) -> DataFrame:
    """Decide attempts (``route``, ``party``, ``day``) in order of days: refused ones use up nothing. One attempt a day per party, ``cap`` per
    ``days`` and route. Of equal attempts only the first can be accepted, so they are counted before the exchange. Sequential by nature, hence
    per party; the attempts stream through in order, state is the accepted days within the window."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        party, last, kept = None, None, {}
        for pdf in batches:
            got = []
            for who, route, day in zip(pdf.party, pdf.route, pdf.day):
                if who != party:
                    party, last, kept = who, None, {}
                mine = [d for d in kept.get(route, []) if day - d < days]
                ok = last != day and len(mine) < cap
                if ok:
                    last = day
                    mine.append(day)
                kept[route] = mine
                got.append(ok)
            yield pdf.assign(first=got)[["party", "route", "day", "n", "first"]]

    one = attempts.groupBy("party", "route", "day").agg(F.count("*").alias("n")).repartition("party").sortWithinPartitions("party", "day", "route")
    decided = one.select("party", "route", F.col("day").cast("int").alias("day"), "n").mapInPandas(run, "party string, route string, day int, n bigint, first boolean")
    return decided.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("party", "route", "day", (F.col("first") & (F.col("i") == 1)).alias("accepted"))
