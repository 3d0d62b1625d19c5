"""What changed between full snapshots.

Every key belongs to the chunk that the leading bits of its own hash name, so chunks are cut by content: an inserted or removed key moves no
boundary. Rows are partitioned by chunk and sorted by key and run within it, which holds a stretch of the key space of every snapshot. Per
chunk and pair of consecutive snapshots a 128-bit digest of the rows of both sides is kept; where it shows that the sides are equal the
chunk is discarded, only rows of unmatched chunks are joined by key and classified.

One exchange in all: rows by chunk, narrowed to key, run, time, binary hash and url. Before it every batch is combined (``combined``), so that a
key that is listed a million times arrives as a few rows; deduplication, carried content, digests and the join all run on the chunk's
partitioning, in the JVM. Nothing that grows with the data is broadcast: the runs are counted first.

Defined results
---------------
* entries without ``run_no`` or ``path`` take no part; an empty table has no changes; a single run has none.
* a null or empty hash is no hash; hashes compare by their 64 hex digits, however they are written (case, blanks, ``sha256:``).
* a key that never had a hash has unknown content, which differs from every known one.
* of several hashes of a key in a run the one fetched last counts (ties: the greatest hash), its ``url`` with it; a null url
  is a value of its own.
* input columns other than those named in ``entries`` are ignored.
* with ``observations`` (what is known of each run) only pairs of complete runs of the same origin and method are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.session import broadcast_if_small

#: Chunks are the values of so many leading bits of a key's hash.
CHUNK_BITS = 20


def hash_value(c: Column) -> Column:
    """The 64 hex digits of a SHA-256 value in lower case; null if there are none."""
    found = F.regexp_extract(F.lower(F.regexp_replace(c, r"[\s\p{Z}\x{FEFF}\x{200B}:\-]", "")), r"([0-9a-f]{64})\z", 1)
    return F.when(found != "", found)


def entries(manifest: DataFrame) -> DataFrame:
    """One row per run and path: ``run_no``, ``path``, ``url``, ``content`` (null: the run has no hash for it)."""
    rows = manifest.where(F.col("run_no").isNotNull() & F.col("path").isNotNull()).select(
        "run_no", "path", F.struct(hash_value(F.col("sha256")).isNotNull().alias("has"), "fetched_at", hash_value(F.col("sha256")).alias("content"), F.col("url")).alias("e")
    )
    return rows.groupBy("run_no", "path").agg(F.max("e").alias("e")).select("run_no", "path", "e.url", "e.content")


def _combine(batches: Iterator) -> Iterator:
    """Of the rows of a batch with the same run and key the one that counts; a batch without any such rows passes as it is."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        keys = np.sort(batch.column("k").to_numpy(zero_copy_only=False))
        if len(keys) > 1 and (keys[1:] == keys[:-1]).any():
            pdf = batch.to_pandas()
            pdf["has"] = pdf.content.notna()
            pdf = pdf.sort_values(["has", "fetched_at", "content", "url"], na_position="first", kind="stable").drop_duplicates(["run_no", "path"], keep="last").drop(columns="has")
            batch = pa.RecordBatch.from_pandas(pdf, schema=batch.schema, preserve_index=False)
        yield batch


def combined(manifest: DataFrame) -> DataFrame:
    """Narrow rows with their ``chunk``, pre-aggregated per batch."""
    rows = manifest.where(F.col("run_no").isNotNull() & F.col("path").isNotNull()).select(
        F.col("run_no").cast("int").alias("run_no"), "path", "url", F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("fetched_at"), F.unhex(hash_value(F.col("sha256"))).alias("content"),
        F.shiftrightunsigned(F.xxhash64("path"), 64 - CHUNK_BITS).cast("int").alias("chunk"), F.xxhash64("run_no", "path").alias("k"),
    )
    return rows.mapInArrow(_combine, rows.schema).drop("k")


def run_pairs(manifest: DataFrame, observations: DataFrame | None = None) -> DataFrame:
    """``run_no``, ``next_run`` and whether the run is compared with the one before it (``has_before``) and after it (``has_next``)."""
    from tallyspan.operators.observe import may_diff

    runs = manifest.where(F.col("run_no").isNotNull()).select(F.col("run_no").cast("int").alias("run_no")).distinct()
    order = Window.orderBy("run_no")  # one row per run
    if observations is None:
        return runs.select("run_no", F.lead("run_no").over(order).alias("next_run"), F.lag("run_no").over(order).isNotNull().alias("has_before")).withColumn("has_next", F.col("next_run").isNotNull())
    known = runs.join(observations.select("run_no", F.struct("complete", "origin", "method").alias("o")), "run_no", "left")
    pairs = known.select("run_no", "o", F.lead("run_no").over(order).alias("next_run"), F.lag("o").over(order).alias("o_before"), F.lead("o").over(order).alias("o_next"))
    return pairs.select("run_no", "next_run", may_diff(F.col("o_before"), F.col("o")).alias("has_before"), may_diff(F.col("o"), F.col("o_next")).alias("has_next"))


def unmatched_rows(manifest: DataFrame, observations: DataFrame | None = None) -> DataFrame:
    """Rows of the chunks that differ between a run and the one before: ``chunk``, ``run`` compared, ``side`` (1 now, 0 before), ``path``, ``state``."""
    entry = F.struct(F.col("content").isNotNull().alias("has"), "fetched_at", "content", "url")
    e = combined(manifest).repartition("chunk").groupBy("chunk", "path", "run_no").agg(F.max(entry).alias("e"))
    known = Window.partitionBy("chunk", "path").orderBy("run_no")
    e = e.select("chunk", "path", "run_no", F.col("e.url").alias("url"), F.last("e.content", ignorenulls=True).over(known).alias("content"))
    e = e.join(broadcast_if_small(run_pairs(manifest, observations)), "run_no")
    hashes = [F.xxhash64(F.lit(seed), "path", F.coalesce("content", F.lit(b"")), F.col("content").isNull(), F.coalesce("url", F.lit("")), F.col("url").isNull()).alias(f"h{seed}") for seed in (1, 2)]
    sides = F.array(F.when(F.col("has_before"), F.struct(F.col("run_no").alias("run"), F.lit(1).alias("side"))), F.when(F.col("has_next"), F.struct(F.col("next_run").alias("run"), F.lit(0).alias("side"))))
    both = e.select("chunk", "path", F.struct("url", "content").alias("state"), *hashes, F.explode(F.array_compact(sides)).alias("s")).select("chunk", "path", "state", "h1", "h2", "s.run", "s.side")
    # rows that both sides hold cancel each other out of the digest; sorted by key, as the join below needs them
    whole = Window.partitionBy("chunk", "run").orderBy("path").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    digest = both.withColumns({"d1": F.bit_xor("h1").over(whole), "d2": F.bit_xor("h2").over(whole)})
    return digest.where((F.col("d1") != 0) | (F.col("d2") != 0)).select("chunk", "run", "side", "path", "state")


def changes(manifest: DataFrame, observations: DataFrame | None = None) -> DataFrame:
    """``run_no``, ``path``, ``change`` (added, removed, changed) against the next lower run that exists."""
    return (
        unmatched_rows(manifest, observations)
        .groupBy("chunk", "run", "path")
        .agg(F.max(F.when(F.col("side") == 1, F.col("state"))).alias("now"), F.max(F.when(F.col("side") == 0, F.col("state"))).alias("before"))
        .select(
            F.col("run").alias("run_no"),
            "path",
            F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").when(~F.col("now").eqNullSafe(F.col("before")), "changed").alias("change"),
        )
        .where(F.col("change").isNotNull())
    )


def report(manifest: DataFrame) -> DataFrame:
    """Changes per run and kind."""
    return changes(manifest).groupBy("run_no", "change").agg(F.count("*").alias("n_paths"))


CHANGES_SQL = r"""
WITH cleaned AS (
  SELECT run_no, path, url, fetched_at,
         nullif(regexp_extract(lower(regexp_replace(sha256, '[\s:\-]', '', 'g')), '([0-9a-f]{64})$', 1), '') AS h
  FROM fetch_manifest WHERE run_no IS NOT NULL AND path IS NOT NULL),
one AS (SELECT run_no, path, url, h FROM cleaned
        QUALIFY row_number() OVER (PARTITION BY run_no, path ORDER BY (h IS NOT NULL) DESC, fetched_at DESC NULLS LAST, h DESC, url DESC NULLS LAST) = 1),
runs AS (SELECT run_no, lag(run_no) OVER (ORDER BY run_no) AS before_no FROM (SELECT DISTINCT run_no FROM fetch_manifest WHERE run_no IS NOT NULL)),
state AS (SELECT run_no, path, url, last_value(h IGNORE NULLS) OVER (PARTITION BY path ORDER BY run_no ROWS UNBOUNDED PRECEDING) AS c FROM one),
cur AS (SELECT s.* FROM state s JOIN runs r USING (run_no) WHERE r.before_no IS NOT NULL),
bef AS (SELECT r.run_no, s.path, s.url, s.c FROM state s JOIN runs r ON r.before_no = s.run_no)
SELECT coalesce(n.run_no, b.run_no) AS run_no, coalesce(n.path, b.path) AS path,
       CASE WHEN b.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM cur n FULL JOIN bef b ON n.run_no = b.run_no AND n.path = b.path
WHERE b.path IS NULL OR n.path IS NULL OR n.url IS DISTINCT FROM b.url OR n.c IS DISTINCT FROM b.c
"""
