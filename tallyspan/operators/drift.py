"""Schemas that drift between files: rescue-column ingestion, a report of each change, replay into one table.

``enforced`` holds every further field of every row against a target schema: a value of its column's type is typed, whatever is unknown or
has another type is rescued. ``rescue`` gives the same per row: typed columns, and the rest as JSON in ``_rescued``. ``changes`` profiles the
fields per file and compares each file with the one before it in its series. ``promote`` replays rescued values into typed columns, under the
renames that ``changes`` found (``lineage``).

The profile is relational: one row per (file, column, token), a token being a value's type and coarse content; values become tokens before
the first aggregate, so that a file that holds a third of all rows arrives as a few thousand counts per task. No window and no join key
is a column alone: tokens are spread by their own value. Pairs exist only between removed and added columns of one file, whose number is
bounded by the width of a header. The compared profile is written to the shared checkpoint folder once and read by the branches of the report.

Defined results
---------------
* a null ``_extra`` adds no column; a key that is empty after trimming white-space and byte order marks is no column; a key
  that occurs twice in a row after trimming counts once, with its first value.
* a file of ``feed_files`` that is not ``loaded``, has no series or no year takes no part; a loaded file without any row has no
  columns.
* a column without non-blank values has no type: it is never ``retyped``. Equal votes go to the narrower type.
* repeated rows weigh as rows; very long values are reduced to a hash of their digit-free form.
* extra input columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.functions.text import SPACES, fold_width, trim_header, trim_space
from tallyspan.session import broadcast_if_small, cut, left_join_dimension, spread

TYPES = ["integer", "decimal", "date", "text"]
#: A removed and an added column are one renamed column from this similarity of content on; from the second one if their
#: headers agree (small files), and with the third share of answers that any yes/no column has only if headers have a part in common.
SAME_CONTENT, ALIKE_CONTENT, PLAIN_ANSWERS = 0.5, 0.3, 0.9
ANSWERS = ["tあり", "tなし", "t不明", "t有", "t無", "n0", "n1", "tはい", "tいいえ"]


def with_clean_map(df: DataFrame, source: str, out: str) -> DataFrame:
    """The map with trimmed keys; of keys that become equal the first stays, an empty key goes. A map without a blank in any key passes untouched."""
    joined = F.array_join(F.map_keys(source), "")
    dirty = (F.translate(joined, SPACES + "\ufeff", "") != joined) | F.array_contains(F.map_keys(source), "")
    keys = F.transform(F.map_keys(source), trim_header)
    pairs = F.arrays_zip(keys.alias("key"), F.map_values(source).alias("value"))
    first = F.filter(pairs, lambda e, i: (F.array_position(keys, e["key"]) == i + 1) & (e["key"] != ""))
    return df.withColumn(out, F.when(F.col(source).isNotNull(), F.when(dirty, F.map_from_entries(first)).otherwise(F.col(source))))


def value_type(v: Column) -> Column:
    """integer, decimal, date or text of a trimmed non-blank value; what begins with no digit, sign or point is text without further tests."""
    return (
        F.when(~F.ascii(v).between(43, 57), "text").when(v.rlike(r"\A[0-9]+\z"), "integer")
        .when(v.rlike(r"\A[+-]?(?:[0-9]+\.[0-9]*|\.[0-9]+)\z"), "decimal")
        .when(v.rlike(r"\A[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}\z"), "date")
        .otherwise("text")
    )


def cast_to(v: Column, kind: str) -> Column:
    """``v`` as its approved type, null where it does not cast."""
    if kind == "integer":
        return F.when(v.rlike(r"\A[0-9]{1,18}\z"), v).try_cast("bigint")
    if kind == "decimal":
        return v.try_cast("decimal(38,9)")
    if kind == "date":
        return F.coalesce(*[F.try_to_date(F.when(v.rlike(p), v), f) for p, f in ((r"\A\d{8}\z", "yyyyMMdd"), (r"\A\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"), (r"\A\d{4}/\d{1,2}/\d{1,2}\z", "yyyy/M/d"))])
    return v


def enforced(rows: DataFrame, target: dict[str, str]) -> DataFrame:
    """One row per further field: ``_file``, ``column``, ``kind`` (null for a blank value), ``v`` (trimmed) and ``typed``: whether ``target`` knows the
    column and the value has its type. What is not typed is what ``rescue`` keeps as JSON."""
    base = with_clean_map(spread(rows.where(F.col("_extra").isNotNull()).select("_file", "_extra")), "_extra", "_m")
    fields = base.select("_file", F.explode("_m").alias("column", "value")).select("_file", "column", trim_space(F.coalesce("value", F.lit(""))).alias("v"))
    wanted = F.lit(None).cast("string")
    for c, k in target.items():
        wanted = F.when(F.col("column") == c, k).otherwise(wanted)
    kinds = fields.withColumn("kind", F.when(F.col("v") != "", value_type(F.col("v"))))
    return kinds.withColumn("typed", F.coalesce(F.col("kind") == wanted, F.lit(False)))


def rescue(rows: DataFrame, target: dict[str, str] | None = None) -> DataFrame:
    """``row_id``, ``_file``, ``_year``, the approved columns of ``target`` (name → type) and ``_rescued``: JSON of every
    further field that is not in ``target`` or does not cast to its type."""
    target = target or {}
    base = with_clean_map(rows.select("row_id", "_file", "_year", "_extra"), "_extra", "_m")
    cast = {f"_t{i}": cast_to(trim_space(F.try_element_at("_m", F.lit(c))), k) for i, (c, k) in enumerate(target.items())}
    base = base.withColumns(cast) if cast else base
    kept = F.col("_m")
    if target:
        typed = F.array_compact(F.array(*[F.when(F.col(f"_t{i}").isNotNull(), F.lit(c)) for i, c in enumerate(target)]))
        kept = F.map_filter("_m", lambda k, _: ~F.array_contains(typed, k))
    return base.select("row_id", "_file", "_year", *[F.col(f"_t{i}").alias(c) for i, c in enumerate(target)], F.to_json(kept, {"ignoreNullFields": "false"}).alias("_rescued"))


def token(v: Column, kind: Column) -> Column:
    """Coarse content of a value: numbers by magnitude and trailing zeros, dates as one, texts by their form without digits."""
    folded = F.when(v.rlike(r"[\x{FF01}-\x{FF5E}\x{3000}]"), fold_width(v)).otherwise(v)
    number = v.try_cast("double")
    day_like = (F.length(v) == 8) & v.rlike(r"\A(?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\z")
    size = F.floor(3 * F.log10(F.abs(number) + 1)).cast("int").cast("string")
    zeros = F.when(number == 0, "0").otherwise((F.length(v) - F.length(F.rtrim(v, F.lit("0")))).cast("string"))
    text = F.when(folded.rlike("[0-9]"), F.regexp_replace(folded, r"[0-9]+", "9")).otherwise(folded)
    return (
        F.when((kind == "integer") & day_like, "day")
        .when(kind == "integer", F.concat(F.lit("n"), size, F.when(F.length(v) > 3, F.concat(F.lit("z"), zeros)).otherwise("")))
        .when(kind == "decimal", F.concat(F.lit("f"), size))
        .when(kind == "date", "day")
        .otherwise(F.concat(F.lit("t"), F.when(F.length(text) > 64, F.md5(text)).otherwise(text)))
    )


def profile(rows: DataFrame, target: dict[str, str] | None = None) -> DataFrame:
    """Counts per ``_file``, ``column``, ``kind`` and ``tok`` of non-blank values; blank ones count under null ``kind``. A typed date is one token
    without another look at its text."""
    f = enforced(rows, target or {})
    tok = F.when(F.col("kind").isNotNull(), F.when(F.col("kind") == "date", "day").otherwise(token(F.col("v"), F.col("kind"))))
    return f.select("_file", "column", "kind", tok.alias("tok"), "typed").groupBy("_file", "column", "kind", "tok").agg(F.count("*").alias("n"), F.count_if("typed").alias("n_typed"))


def loaded_files(files: DataFrame) -> DataFrame:
    """``_file`` with the file before it (``before``) and after it (``after``) in its series."""
    w = Window.partitionBy("series_no").orderBy("_year", "_file")
    return (
        files.where((F.col("stage") == "loaded") & F.col("series_no").isNotNull() & F.col("_year").isNotNull() & F.col("_file").isNotNull())
        .select("series_no", "_year", "_file")
        .distinct()
        .select("_file", F.lag("_file").over(w).alias("before"), F.lead("_file").over(w).alias("after"))
    )


def _stand_in(c: Column) -> Column:
    """Header without the marks that spellings differ in, as a set of characters for comparing headers."""
    return F.array_distinct(F.split(F.regexp_replace(fold_width(c), r"[\s()の]|有無", ""), ""))


def steps(rows: DataFrame, files: DataFrame, target: dict[str, str] | None = None) -> DataFrame:
    """The profile from both sides: per compared ``_file`` its own counts (``side`` 1) and those of the file before it (``side`` 0)."""
    order = loaded_files(files).select(F.col("_file").alias("p_file"), "before", "after").where("before IS NOT NULL OR after IS NOT NULL")
    prof = profile(rows, target).join(broadcast_if_small(order), F.col("_file") == F.col("p_file"))
    views = F.array(F.when(F.col("before").isNotNull(), F.struct(F.col("p_file").alias("f"), F.lit(1).alias("s"))), F.when(F.col("after").isNotNull(), F.struct(F.col("after").alias("f"), F.lit(0).alias("s"))))
    return prof.select("column", "kind", "tok", "n", F.explode(F.array_compact(views)).alias("x")).select(F.col("x.f").alias("_file"), F.col("x.s").alias("side"), "column", "kind", "tok", "n")


def column_pairs(both: DataFrame) -> DataFrame:
    """Per compared file and column: on which sides it stands, its type there (most non-blank values; a tie gives the narrower) and how many values."""
    side = lambda s, x: F.sum(F.when(F.col("side") == s, x).otherwise(0))
    votes = both.groupBy("_file", "column").agg(
        *[side(s, F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"{k}_{s}") for s in (0, 1) for k in TYPES],
        F.max(F.when(F.col("side") == 1, 1).otherwise(0)).alias("is_now"),
        F.max(F.when(F.col("side") == 0, 1).otherwise(0)).alias("is_before"),
    )
    most = lambda s: F.greatest(*[F.col(f"{k}_{s}") for k in TYPES])
    kind = lambda s: F.when(most(s) > 0, F.coalesce(*[F.when(F.col(f"{k}_{s}") == most(s), F.lit(k)) for k in TYPES]))
    total = lambda s: sum(F.col(f"{k}_{s}") for k in TYPES)
    return votes.select("_file", "column", "is_now", "is_before", kind(0).alias("was"), kind(1).alias("is"), total(0).alias("n_before"), total(1).alias("n_now"))


def changes(rows: DataFrame, files: DataFrame, target: dict[str, str] | None = None) -> DataFrame:
    """``_file``, ``change``, ``old_column``, ``new_column`` of every loaded file against the one before it in its series."""
    both = cut(steps(rows, files, target))  # read by four branches below, computed once
    columns = column_pairs(both)
    retyped = columns.where((F.col("is_now") == 1) & (F.col("is_before") == 1) & (F.col("was") != F.col("is"))).select("_file", F.lit("retyped").alias("change"), F.col("column").alias("old_column"), F.col("column").alias("new_column"))
    moved = columns.where(F.col("is_now") + F.col("is_before") == 1)
    pairs = renamed_pairs(both, moved)
    gone = moved.join(pairs.select("_file", F.explode(F.array("old_column", "new_column")).alias("column")).distinct(), ["_file", "column"], "left_anti")
    single = gone.select(
        "_file", F.when(F.col("is_now") == 1, "added").otherwise("removed").alias("change"),
        F.when(F.col("is_now") == 1, "").otherwise(F.col("column")).alias("old_column"), F.when(F.col("is_now") == 1, F.col("column")).otherwise("").alias("new_column"),
    )
    return retyped.unionByName(single).unionByName(pairs.select("_file", F.lit("renamed").alias("change"), "old_column", "new_column"))


def scored_pairs(both: DataFrame, moved: DataFrame) -> DataFrame:
    """Every removed column beside every added one of the same file with the similarity of their content and of their headers. A column's number of
    values comes with ``moved``, so that its tokens never have to meet."""
    sized = moved.select("_file", "column", F.greatest("n_now", "n_before").alias("whole"))
    hist = both.where(F.col("kind").isNotNull()).join(sized, ["_file", "column"]).groupBy("_file", "column", "side", "tok", "whole").agg(F.sum("n").alias("n"))
    p = F.col("n") / F.col("whole")
    old = hist.where(F.col("side") == 0).select("_file", F.col("column").alias("old_column"), "tok", p.alias("p_old"))
    new = hist.where(F.col("side") == 1).select("_file", F.col("column").alias("new_column"), "tok", p.alias("p_new"))
    common = old.join(new, ["_file", "tok"]).groupBy("_file", "old_column", "new_column").agg(
        F.sum(F.least("p_old", "p_new")).alias("content"), F.sum(F.when(F.col("tok").isin(ANSWERS), F.least("p_old", "p_new")).otherwise(0)).alias("answers")
    )
    a, b = _stand_in(F.col("old_column")), _stand_in(F.col("new_column"))
    return common.withColumn("header", F.size(F.array_intersect(a, b)) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1)))


def renamed_pairs(both: DataFrame, moved: DataFrame) -> DataFrame:
    """One-to-one pairs of removed and added columns with the same content, best first."""
    good = scored_pairs(both, moved).where(
        ((F.col("content") >= SAME_CONTENT) | ((F.col("content") >= ALIKE_CONTENT) & (F.col("header") >= 0.8)))
        & ((F.col("answers") < PLAIN_ANSWERS * F.col("content")) | (F.col("header") > 0))
    )
    ranked = good.groupBy("_file").agg(F.sort_array(F.collect_list(F.struct((-(F.col("content") + F.col("header") / 2)).alias("rank"), "old_column", "new_column"))).alias("pairs"))
    none = F.filter("pairs", lambda _: F.lit(False))
    taken = F.aggregate("pairs", none, lambda acc, p: F.when(F.exists(acc, lambda t: (t["old_column"] == p["old_column"]) | (t["new_column"] == p["new_column"])), acc).otherwise(F.concat(acc, F.array(p))))
    return ranked.select("_file", F.explode(taken).alias("p")).select("_file", "p.old_column", "p.new_column")


def lineage(found: DataFrame, files: DataFrame, approved: list[str]) -> DataFrame:
    """``_file``, ``header``, ``column``: headers that are an approved column under another name, as the renames in ``found`` say. A chain of renames
    within a series that holds one approved name is that column in all its files; chains are worked out per series, which is bounded by its years."""
    renames = found.where("change = 'renamed'").select(F.col("_file").alias("r_file"), "old_column", "new_column")
    series = files.where("stage = 'loaded' AND series_no IS NOT NULL AND _year IS NOT NULL AND _file IS NOT NULL").select("series_no", "_year", "_file").distinct()
    one = series.join(renames, F.col("_file") == F.col("r_file"), "left").drop("r_file")
    names = set(approved)

    def chains(pdf: pd.DataFrame) -> pd.DataFrame:
        order = pdf.drop_duplicates("_file").sort_values(["_year", "_file"])["_file"].tolist()
        at = {f: i for i, f in enumerate(order)}
        steps_ = sorted((at[f], o, n) for f, o, n in zip(pdf["_file"], pdf.old_column, pdf.new_column) if isinstance(o, str))
        open_: dict[str, list[tuple[str, int, int]]] = {}
        done = []
        for i, old, new in steps_:
            chain = open_.pop(old, [(old, 0, 0)])
            h, start, _ = chain[-1]
            chain = [*chain[:-1], (h, start, i), (new, i, len(order))]
            if new in open_:
                done.append(open_.pop(new))
            open_[new] = chain
        rows = []
        for chain in [*done, *open_.values()]:
            known = {h for h, *_ in chain} & names
            if len(known) == 1:
                rows += [(f, h, next(iter(known))) for h, a, b in chain if h not in known for f in order[a:b]]
        return pd.DataFrame(rows, columns=["_file", "header", "column"]).drop_duplicates()

    return one.groupBy("series_no").applyInPandas(chains, "_file string, header string, column string")


def _cast_under(kind: str):
    return lambda h: F.struct(h.alias("h"), cast_to(trim_space(F.try_element_at("_m", h)), kind).alias("v"))


def promote(rows: DataFrame, approved: dict[str, str], synonyms: dict[str, str] | DataFrame) -> DataFrame:
    """One consistent table: ``approved`` columns typed, fields under another header replayed into them, every other or uncastable field left in
    ``_rescued``. ``synonyms``: header → approved column, or a ``lineage`` table that says so per file; a header
    that is one column wherever it occurs in it is that column in files of other series, too. A field under the column's own header comes
    first, then the file's headers, then the others."""
    base = with_clean_map(rows.select("row_id", "_file", "_year", "_extra"), "_extra", "_m")
    if isinstance(synonyms, dict):
        heads = {c: F.array(*[F.lit(c), *[F.lit(h) for h, to in synonyms.items() if to == c]]) for c in approved}
    else:
        listed = lambda name: [F.array_sort(F.collect_set(F.when(F.col("column") == c, F.col("header")))).alias(f"{name}{i}") for i, c in enumerate(approved)]
        single = synonyms.groupBy("header").agg(F.min("column").alias("column"), F.count_distinct("column").alias("n")).where("n = 1")
        base = left_join_dimension(base, synonyms.groupBy("_file").agg(*listed("_h")), "_file", F.col("row_id"))
        base = base.crossJoin(F.broadcast(single.agg(*listed("_g"))))  # one row
        none = F.array().cast("array<string>")
        heads = {c: F.array_distinct(F.concat(F.array(F.lit(c)), F.coalesce(f"_h{i}", none), F.col(f"_g{i}"))) for i, c in enumerate(approved)}
    for i, (c, k) in enumerate(approved.items()):
        tried = F.transform(heads[c], _cast_under(k))
        base = base.withColumn(f"_c{i}", F.filter(tried, lambda t: t["v"].isNotNull()))
    used = F.flatten(F.array(*[F.transform(f"_c{i}", lambda t: t["h"]) for i in range(len(approved))])) if approved else F.array().cast("array<string>")
    rest = F.map_filter("_m", lambda h, _: ~F.array_contains(used, h))
    return base.select("row_id", "_file", "_year", *[F.get(F.col(f"_c{i}"), F.lit(0))["v"].alias(c) for i, c in enumerate(approved)], F.to_json(rest, {"ignoreNullFields": "false"}).alias("_rescued"))


def consistent_table(rows: DataFrame, files: DataFrame, approved: dict[str, str]) -> DataFrame:
    """The incident rows under ``approved``, replayed under the renames found in the files themselves. The lineage is read twice, hence cut."""
    return promote(rows, approved, cut(lineage(changes(rows, files, approved), files, list(approved))))


#: Approved columns of the one table (a parameter of the ingestion).
APPROVED = {"施錠関係": "text", "被害者の年齢": "integer", "被害者の職業": "text", "被害額": "integer", "届出日": "date", "発生場所": "text", "天候": "text", "備考": "text"}
