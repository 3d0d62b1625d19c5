"""What changed between snapshots."""

import random
from datetime import datetime

from tallyspan.operators import snapshot

SCHEMA = "run_no int, path string, url string, fetched_at timestamp, sha256 string, previous_sha256 string, result string, chunk string, side int"


def table(spark, rows):
    return spark.createDataFrame([(r, p, u, datetime(2024, 1, 1, 0, 0, t), h, "x", "new", "clash", 9) for r, p, u, t, h in rows], SCHEMA)


def brute(rows):
    def clean(h):
        h = "".join(c for c in (h or "").lower() if not c.isspace() and c not in ":-")[-64:]
        return h if len(h) == 64 else None

    runs = sorted({r for r, *_ in rows if r is not None})
    known, before, out = {}, None, set()
    for run in runs:
        best = {}
        for r, p, u, t, h in rows:
            if r == run and p is not None:
                key = (clean(h) is not None, t, clean(h) or "", u or "")
                if p not in best or key > best[p][0]:
                    best[p] = (key, u, clean(h))
        now = {}
        for p, (_, u, h) in best.items():
            known[p] = h or known.get(p)
            now[p] = (u, known[p])
        if before is not None:
            out |= {(run, p, "added") for p in now.keys() - before.keys()} | {(run, p, "removed") for p in before.keys() - now.keys()} | {(run, p, "changed") for p in now.keys() & before.keys() if now[p] != before[p]}
        before = now
    return out


def result(spark, rows):
    got = [tuple(r) for r in snapshot.changes(table(spark, rows)).select("run_no", "path", "change").collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_cases(spark):
    a, b = "a" * 64, "b" * 64
    rows = [
        (1, "same", "u", 0, a), (3, "same", "u", 0, f" SHA256:{a.upper()}"), (1, "gone", "u", 0, a), (3, "late", "u", 0, a), (1, "url", "u", 0, a), (3, "url", "v", 0, a), (1, "fail", "u", 0, a), (3, "fail", "u", 0, None),
        (5, "fail", "u", 0, b), (5, "same", "u", 0, b), (5, "same", "u", 1, None), (5, "url", "v", 0, a), (5, "late", "u", 0, a), (None, "x", "u", 0, a), (5, None, "u", 0, a),
    ]
    assert result(spark, rows) == brute(rows) == {(3, "gone", "removed"), (3, "late", "added"), (3, "url", "changed"), (5, "fail", "changed"), (5, "same", "changed")}


def test_random_against_brute_force_with_small_chunks(spark):
    rnd = random.Random(1)
    rows = []
    for run in (1, 2, 5, 6, 9):
        for k in range(400):
            if rnd.random() < 0.9:
                for _ in range(1 if rnd.random() < 0.95 else 3):
                    rows.append((run, f"p{k:04d}", rnd.choice([None, "u", "u", "u"]), rnd.randint(0, 3), rnd.choice([None, "a" * 64, "a" * 64, "a" * 64, "b" * 64, ""])))
    rows += [(6, "hot", "u", 0, "c" * 64)] * 500
    assert result(spark, rows) == brute(rows)


def test_chunks_are_discarded(spark):
    rows = [(r, f"p{k:05d}", "u", 0, "a" * 64) for r in (1, 2) for k in range(3000)] + [(2, "p00500x", "u", 0, "b" * 64)]
    t = table(spark, rows)
    assert snapshot.unmatched_rows(t).count() < 600
    assert result(spark, rows) == {(2, "p00500x", "added")}


def test_empty_and_single(spark):
    assert result(spark, []) == set()
    assert result(spark, [(1, "p", "u", 0, "a" * 64)]) == set()
    long = "p" * 100_000
    assert result(spark, [(1, "p", "u", 0, None), (2, long, None, 0, None)]) == {(2, "p", "removed"), (2, long, "added")}
