"""Mixing sources to target weights, with a time-varying curriculum.

Each source of a mix has a demand: its share of the total size in tokens, at most ``max_repeats`` times what it holds; what capped
sources cannot give is shared among the others in proportion to their weights, so that the total is reached if it can be. Documents
of a source stand in a hashed order; a document's repeats are the whole passes over the source plus one more if it lies before the end of
the last, partial pass.

Every source has a weight schedule, piecewise linear over training time. Its integral is the source's cumulative demand; inverting it turns a
document's place in its source into a training position, by which the selection is range-sorted. Without a schedule of the caller's the
curriculum comes from the input: sources of short documents first, of long ones later.

The running token sum of a source is two-level: sums per hash bucket (``2 ** BUCKET_BITS`` for each source), then within a bucket, so
a source with a third of all rows is never in one task. Documents are tokenized once, into a narrow checkpoint.

Defined results: documents without source or tokens are never selected; null or non-positive weights do not count; a target named twice in
a mix counts with the sum of its weights and the larger cap; a source without documents gets nothing and is reported; an empty
corpus gives an empty selection; documents posted twice under other ids are documents of their own; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyspan.session import broadcast_if_small, cut, spread

VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A long run of white-space, which the pattern takes as one piece without its last character if anything follows; matching it would need deep backtracking.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
BUCKET_BITS = 16
SEED = 17
#: How far the default curriculum bends a source's weight: from ``1 - STRENGTH`` to ``1 + STRENGTH`` for the shortest and the longest.
STRENGTH = 0.8


def count_tokens(enc, text: str) -> int:
    """Tokens of the whole text. Long runs of white-space, pieces of their own by the pattern, are encoded as such; nothing else is cut."""
    n = at = 0
    for m in LONG_BLANK.finditer(text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        n += len(enc.encode_ordinary(text[at : m.start()])) + len(enc._encode_single_piece(text[m.start() : end]))
        at = end
    return n + len(enc.encode_ordinary(text[at:] if at else text))


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens`` under the public tokenizer whose ranks stand in ``vocabulary``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken
        from tiktoken.load import load_tiktoken_bpe

        enc = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=load_tiktoken_bpe(vocabulary), special_tokens={})

        for pdf in batches:
            n = [count_tokens(enc, t) if isinstance(t, str) else 0 for t in pdf.text]
            yield pd.DataFrame({"doc_id": pdf.doc_id, "source": pdf.source, "n_tokens": pd.array(n, dtype="int64")})

    return spread(documents.where("doc_id IS NOT NULL").select("doc_id", "source", "text")).mapInPandas(run, "doc_id bigint, source string, n_tokens bigint")


def fill(shares: list[float], caps: list[float], total: float) -> list[float]:
    """Water-filling: the level at which ``sum(min(level * share, cap))`` is ``total`` (all caps if it cannot be), as a demand for each."""
    out, left, rest = [0.0] * len(shares), total, 1.0
    for k in sorted(range(len(shares)), key=lambda k: caps[k] / shares[k]):
        out[k] = max(0.0, min(caps[k], left * shares[k] / rest if rest > 1e-12 else left))
        left, rest = left - out[k], rest - shares[k]
    return out


def demands(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``mix``, ``source``, ``share``, ``available``, ``cap``, ``max_repeats``, ``wanted``, ``demand`` in tokens and ``mean_size`` of a source's documents. ``sizes``:
    tokens (``available``) and documents (``n_docs``) per source, null source included. A mix is one group of as many rows as it names sources."""
    clean = targets.where((F.col("weight") > 0) & F.col("mix").isNotNull() & F.col("source").isNotNull())
    t = clean.groupBy("mix", "source").agg(F.sum("weight").alias("weight"), F.max("max_repeats").alias("max_repeats"), F.max("size_factor").alias("size_factor"))
    corpus = sizes.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("corpus"))
    t = t.join(sizes.where("source IS NOT NULL"), "source", "left").crossJoin(F.broadcast(corpus))

    def levels(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source")
        share = (pdf.weight / pdf.weight.sum()).tolist()
        available = pdf.available.fillna(0).astype("int64")
        cap = available * pdf.max_repeats.fillna(1).clip(lower=0).astype("int64")
        size = pdf.size_factor.max()
        total = (0.0 if pd.isna(size) else float(size)) * int(pdf.corpus.iloc[0])
        docs = pdf.n_docs.fillna(0)
        return pd.DataFrame({"mix": pdf.mix, "source": pdf.source, "share": share, "available": available, "cap": cap, "max_repeats": pdf.max_repeats.astype("Int32"), "wanted": [x * total for x in share],
                             "demand": fill(share, cap.tolist(), total), "mean_size": [a / n if n else 0.0 for a, n in zip(available, docs)]})

    return t.groupBy("mix").applyInPandas(levels, "mix string, source string, share double, available bigint, cap bigint, max_repeats int, wanted double, demand double, mean_size double")


def placed(tokens: DataFrame) -> DataFrame:
    """Every document with ``place``: the tokens of its source before its middle, in hashed order."""
    rows = tokens.where(F.col("source").isNotNull() & (F.col("n_tokens") > 0)).withColumn("h", F.xxhash64("doc_id", F.lit(SEED)))
    rows = rows.withColumn("bucket", F.shiftrightunsigned("h", 64 - BUCKET_BITS).cast("int"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n"))
    offset = sums.select("source", "bucket", (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(offset, ["source", "bucket"]).withColumn("place", F.col("offset") + F.sum("n_tokens").over(inside) - F.col("n_tokens") / 2).select("doc_id", "source", "n_tokens", "place")


def straight(wanted: DataFrame, tilt: Column) -> DataFrame:
    """``mix``, ``source``, ``knots`` of straight lines with the given tilts (-1: all at the start, 1: all at the end), centred by demand so that training
    goes on at an even pace, and bounded so that no weight is negative."""
    mix = Window.partitionBy("mix")
    t = wanted.withColumn("raw", tilt.cast("double"))
    t = t.withColumn("raw", F.col("raw") - F.sum(F.col("raw") * F.col("demand")).over(mix) / F.greatest(F.sum("demand").over(mix), F.lit(1.0)))
    t = t.withColumn("tilt", F.col("raw") / F.greatest(F.max(F.abs(F.col("raw"))).over(mix), F.lit(1.0)))
    return t.select("mix", "source", F.array(F.struct(F.lit(0.0).alias("t"), (1 - F.col("tilt")).alias("w")), F.struct(F.lit(1.0).alias("t"), (1 + F.col("tilt")).alias("w"))).alias("knots"))


def curriculum(wanted: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """The default schedule, from the input itself: sources of a mix ranked by the mean size of their documents, short ones first."""
    by_size = Window.partitionBy("mix").orderBy("mean_size", "source")
    return straight(wanted, strength * (2 * F.percent_rank().over(by_size) - 1))


def tilted(wanted: DataFrame, late: dict[str, float]) -> DataFrame:
    """The schedule of a caller's tilts per source, 0 for the others."""
    return straight(wanted, F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in late.items() for x in kv]), F.col("source")), F.lit(0.0)) if late else F.lit(0.0))


def segments(schedule: DataFrame) -> DataFrame:
    """``mix``, ``source``, ``segs`` of a piecewise linear weight schedule (``knots`` of ``t``, ``w`` in order): per segment its begin ``t0`` and length ``dt``, weights
    ``w0``, ``w1``, and the integral before it (``c0``) and of it (``c``) as parts of the whole. A schedule without weight is an even one."""
    area = lambda a, b: (b["t"] - a["t"]) * (a["w"] + b["w"]) / 2
    k = F.col("knots")
    pieces = F.transform(F.sequence(F.lit(0), F.size(k) - 2), lambda i: F.struct(F.get(k, i)["t"].alias("t0"), (F.get(k, i + 1)["t"] - F.get(k, i)["t"]).alias("dt"), F.get(k, i)["w"].alias("w0"), F.get(k, i + 1)["w"].alias("w1"), area(F.get(k, i), F.get(k, i + 1)).alias("a")))
    whole = F.aggregate(pieces, F.lit(0.0), lambda acc, p: acc + p["a"])
    even = F.array(F.struct(F.lit(0.0).alias("t0"), F.lit(1.0).alias("dt"), F.lit(1.0).alias("w0"), F.lit(1.0).alias("w1"), F.lit(1.0).alias("a")))
    s = schedule.withColumn("p", pieces).withColumn("whole", whole).withColumn("p", F.when(F.col("whole") > 0, F.col("p")).otherwise(even)).withColumn("whole", F.when(F.col("whole") > 0, F.col("whole")).otherwise(1.0))
    before = lambda i: F.aggregate(F.slice("p", F.lit(1), i), F.lit(0.0), lambda acc, x: acc + x["a"])
    return s.select("mix", "source", F.transform("p", lambda p, i: F.struct(p["t0"].alias("t0"), p["dt"].alias("dt"), p["w0"].alias("w0"), p["w1"].alias("w1"), (before(i) / F.col("whole")).alias("c0"), (p["a"] / F.col("whole")).alias("c"))).alias("segs"))


def position(done: Column, segs: Column) -> Column:
    """Training time at which a source's cumulative demand reaches the part ``done`` of it: the segment whose integral holds it, and in the segment the
    root of ``w0 x + (w1 - w0) x x / 2`` for the rest."""
    inside = F.filter(segs, lambda p: p["c"] > 0)
    p = F.coalesce(F.get(F.filter(inside, lambda p: p["c0"] + p["c"] >= done), F.lit(0)), F.element_at(inside, -1))
    mean = (p["w0"] + p["w1"]) / 2
    y = F.least(F.greatest((done - p["c0"]) / p["c"], F.lit(0.0)), F.lit(1.0)) * mean
    slope = (p["w1"] - p["w0"]) / 2
    root = F.try_divide(2 * y, p["w0"] + F.sqrt(F.greatest(p["w0"] * p["w0"] + 4 * slope * y, F.lit(0.0))))
    return F.least(F.greatest(p["t0"] + p["dt"] * F.least(F.greatest(F.coalesce(root, F.lit(0.0)), F.lit(0.0)), F.lit(1.0)), F.lit(0.0)), F.lit(1.0))


def mixed(documents: DataFrame, targets: DataFrame, late: dict[str, float] | None = None, vocabulary: str = VOCABULARY, schedule: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Selection (one row per use of a document) and demands. ``schedule`` (``mix``, ``source``, ``knots``) or ``late`` replace the default curriculum; a source that
    the schedule does not name comes evenly."""
    tokens = cut(token_counts(documents, vocabulary))
    sizes = tokens.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count_if(F.col("n_tokens") > 0).alias("n_docs"))
    wanted = cut(demands(sizes, targets))  # a row per mix and source, read by three branches
    if schedule is None:
        schedule = curriculum(wanted) if late is None else tilted(wanted, late)
    plan = wanted.where("demand > 0").join(segments(schedule), ["mix", "source"], "left")
    even = F.array(F.struct(F.lit(0.0).alias("t0"), F.lit(1.0).alias("dt"), F.lit(1.0).alias("w0"), F.lit(1.0).alias("w1"), F.lit(0.0).alias("c0"), F.lit(1.0).alias("c")))
    uses = placed(tokens).join(broadcast_if_small(plan.withColumn("segs", F.coalesce("segs", even))), "source")
    n = F.least(F.floor((F.col("demand") - F.col("place")) / F.col("available")) + 1, F.coalesce("max_repeats", F.lit(1)))
    uses = uses.withColumn("n_uses", n.cast("int")).where("n_uses > 0").withColumn("use_no", F.explode(F.sequence(F.lit(1), F.col("n_uses"))))
    done = F.least((F.col("place") + (F.col("use_no") - 1) * F.col("available")) / F.col("demand"), F.lit(1.0))
    return uses.select("mix", position(done, F.col("segs")).alias("position"), "doc_id", "use_no", "source", "n_tokens"), wanted


def selection(documents: DataFrame, targets: DataFrame, late: dict[str, float] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """``mix``, ``position`` (0 to 1), ``doc_id``, ``use_no``, ``source``, ``n_tokens``, range-sorted by mix and position."""
    picked, _ = mixed(documents, targets, late, vocabulary)
    return picked.repartitionByRange("mix", "position").sortWithinPartitions("mix", "position", "doc_id", "use_no")


def shares(documents: DataFrame, targets: DataFrame, late: dict[str, float] | None = None, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per mix and source: wanted and reached share, tokens, documents and most uses of one document."""
    picked, wanted = mixed(documents, targets, late, vocabulary)
    got = picked.groupBy("mix", "source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("uses"), F.max("use_no").alias("most_uses"))
    out = wanted.select("mix", "source", "share", "available", "max_repeats", "wanted", "demand").join(got, ["mix", "source"], "left")
    tokens = F.coalesce("tokens", F.lit(0))
    return out.select(
        "mix", "source", F.col("share").alias("wanted_share"), (tokens / F.greatest(F.sum(tokens).over(Window.partitionBy("mix")), F.lit(1))).alias("reached_share"),
        F.col("wanted").alias("wanted_tokens"), tokens.alias("reached_tokens"), F.col("available").alias("available_tokens"),
        F.coalesce("uses", F.lit(0)).alias("uses"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats",
    )


#: Sources that come late in the curriculum query: long and formal texts after short notices.
LATE = {"council_minutes": 0.8, "manual_old": 0.8, "tokei_kaisetsu": 0.5, "boundary_memo": 0.5, "open_data_notes": 0.4, "town_board": -0.5, "sewa_police_mail": -0.5}
