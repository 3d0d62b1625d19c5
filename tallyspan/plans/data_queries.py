"""Queries of the general data-processing problems: rejected rows, snapshot changes, schema drift."""

from __future__ import annotations

from tallyspan.functions.text import FULL_WIDTH, HALF_WIDTH
from tallyspan.operators import drift, rejects, snapshot
from tallyspan.session import table

_FW, _HW = FULL_WIDTH, HALF_WIDTH.replace("'", "''")
_SP = r"[\s\p{Z}\x{200B}\x{85}]"


def _reject_sql(d: str) -> str:
    """Rejects among the files whose delimiter is ``d``."""
    f = rf'(?:"(?:[^"]|"")*"|[^"{d}]*)'
    clean = lambda x: rf"regexp_replace({x}, '^(?:{_SP}|\x{{FEFF}})+|(?:{_SP}|\x{{FEFF}})+$', '', 'g')"
    bare = lambda x: f"CASE WHEN starts_with({x}, '\"') THEN replace(substring({x}, 2, length({x}) - 2), '\"\"', '\"') ELSE {x} END"
    value = lambda c: f"regexp_replace(translate({bare(f'coalesce(f[list_position(names, {chr(39)}{c}{chr(39)})], {chr(39)}{chr(39)})')}, '{_FW}', '{_HW}'), '^{_SP}+|{_SP}+$', '', 'g')"
    has = lambda c: f"list_contains(names, '{c}')"
    day = "try_cast(lpad(regexp_extract(day, p, 1), 4, '0') || '-' || lpad(regexp_extract(day, p, 2), 2, '0') || '-' || lpad(regexp_extract(day, p, 3), 2, '0') AS DATE)"
    return f"""
SELECT line_id, reason FROM (SELECT line_id, CASE WHEN NOT quoted THEN 'quoting' WHEN len(f) <> len(names) THEN 'column_count'
  WHEN {has(rejects.CITY)} AND NOT regexp_full_match(city, '[0-9]{{5,6}}') OR {has(rejects.HOUR)} AND NOT regexp_full_match(hour, '(?:[01]?[0-9]|2[0-3])?') OR {has(rejects.DAY)} AND (p IS NULL OR {day} IS NULL OR regexp_extract(day, p, 1) = '0000') THEN 'value' END AS reason
FROM (SELECT *, CASE WHEN regexp_full_match(day, '[0-9]{{8}}') THEN '^(....)(..)(..)$' WHEN regexp_full_match(day, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') THEN '^(.*)-(.*)-(.*)$' WHEN regexp_full_match(day, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}') THEN '^(.*)/(.*)/(.*)$' WHEN regexp_full_match(day, '[0-9]{{4}}年[0-9]{{1,2}}月[0-9]{{1,2}}日') THEN '^(.*)年(.*)月(.*)日$' END AS p
FROM (SELECT *, {value(rejects.CITY)} AS city, {value(rejects.DAY)} AS day, {value(rejects.HOUR)} AS hour
FROM (SELECT r.line_id, regexp_full_match(r.raw, '{f}(?:[{d}]{f})*') AS quoted, regexp_extract_all('{d}' || r.raw, '[{d}]({f})', 1) AS f, list_transform(regexp_extract_all('{d}' || h.h, '[{d}]({f})', 1), lambda x: {clean(bare(clean('x')))}) AS names
FROM raw_records r JOIN heads h ON h._file = r._file WHERE h.delim = '{d}' AND coalesce(r.line_no, 0) <> 1 AND r.raw IS NOT NULL AND NOT regexp_full_match(r.raw, '[\\s\\p{{Z}}\\x{{FEFF}}"{d}]*'))))) WHERE reason IS NOT NULL"""


_HEADS = r"""
WITH heads AS (SELECT _file, h, CASE greatest(a, b, c, e) WHEN a THEN ',' WHEN b THEN chr(9) WHEN c THEN ';' ELSE '|' END AS delim
FROM (SELECT *, length(o) - length(replace(o, ',', '')) AS a, length(o) - length(replace(o, chr(9), '')) AS b, length(o) - length(replace(o, ';', '')) AS c, length(o) - length(replace(o, '|', '')) AS e
FROM (SELECT *, regexp_replace(h, '"(?:[^"]|"")*"', '', 'g') AS o FROM (SELECT _file, ltrim(arg_min(raw, line_id), chr(65279)) AS h FROM raw_records WHERE line_no = 1 AND raw IS NOT NULL GROUP BY _file))))"""
REJECTS_SQL = _HEADS + " UNION ALL ".join(_reject_sql(d) for d in rejects.DELIMITERS)

QUERIES = {
    "p2_found": lambda s, d: rejects.rejected(table(s, d, "raw_records")),
    "p2_load": lambda s, d: rejects.load(table(s, d, "raw_records")),
    "p2_report": lambda s, d: rejects.report(table(s, d, "raw_records")),
    "p4_found": lambda s, d: snapshot.changes(table(s, d, "fetch_manifest")),
    "p4_report": lambda s, d: snapshot.report(table(s, d, "fetch_manifest")),
    "p5_found": lambda s, d: drift.changes(table(s, d, "incidents"), table(s, d, "feed_files"), drift.APPROVED),
    "p5_table": lambda s, d: drift.consistent_table(table(s, d, "incidents"), table(s, d, "feed_files"), drift.APPROVED),
    "p5_lineage": lambda s, d: drift.lineage(drift.changes(table(s, d, "incidents"), table(s, d, "feed_files"), drift.APPROVED), table(s, d, "feed_files"), list(drift.APPROVED)),
}

SQL = {
    "p2_found": REJECTS_SQL,
    "p2_report": f"""SELECT _file, outcome, count(*) AS n_records FROM (SELECT r._file, coalesce(x.reason, 'loaded') AS outcome FROM raw_records r LEFT JOIN ({REJECTS_SQL}) x ON x.line_id = r.line_id
      WHERE coalesce(r.line_no, 0) <> 1 AND r.raw IS NOT NULL AND NOT regexp_full_match(r.raw, '[\\s\\p{{Z}}\\x{{FEFF}}",\\t;|]*')) GROUP BY ALL""",
    "p4_found": snapshot.CHANGES_SQL,
    "p4_report": f"SELECT run_no, change, count(*) AS n_paths FROM ({snapshot.CHANGES_SQL}) GROUP BY ALL",
}
