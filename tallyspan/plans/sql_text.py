"""DuckDB counterparts of the name normalization: compatibility forms by a table that Python's Unicode data gives, canonical forms by ``nfc_normalize``."""

from __future__ import annotations

import unicodedata
from functools import cache

from tallyspan.functions.places import DIGITS


@cache
def compatibility_values() -> str:
    """``VALUES`` of every character whose compatibility decomposition differs from its canonical one."""
    spans = ((0x80, 0x3400), (0xA000, 0xAC00), (0xF900, 0x11000), (0x16000, 0x20000))
    rows = []
    for cp in (cp for a, b in spans for cp in range(a, b)):
        ch = chr(cp)
        if (to := unicodedata.normalize("NFKD", ch)) != unicodedata.normalize("NFD", ch):
            rows.append(f"('{ch}','{to.replace(chr(39), chr(39) * 2)}')")
    return "(VALUES " + ",".join(rows) + ")"


def nfkc_sql(names: str) -> str:
    """``v``, ``w``: every distinct non-null ``v`` of the relation ``names`` and its NFKC form."""
    return f"""
SELECT v, coalesce(nfc_normalize(string_agg(coalesce(m.t, x.c), '' ORDER BY x.i)), '') AS w
FROM (SELECT v, unnest(string_split(v, '')) AS c, generate_subscripts(string_split(v, ''), 1) AS i FROM (SELECT DISTINCT v FROM ({names}) WHERE v IS NOT NULL)) x
LEFT JOIN {compatibility_values()} m(c, t) ON m.c = x.c GROUP BY v"""


def _digit(x: str) -> str:
    return f"CASE WHEN length({x}) = 1 AND strpos('{DIGITS}', {x}) > 0 THEN strpos('{DIGITS}', {x}) - 1 END"


def keys_sql(names: str) -> str:
    """``v``, ``key`` of every distinct non-null ``v`` of ``names``: the same as ``places.place_key``."""
    low = f"CASE WHEN substring(k, strpos(k, '十') + 1) = '' THEN 0 ELSE {_digit(chr(39).join(['substring(k, strpos(k, ', '十', ') + 1)']))} END"
    tens = "left(k, strpos(k, '十') - 1)"
    number = f"CASE WHEN strpos(k, '十') = 0 THEN {_digit('k')} ELSE coalesce({_digit(tens)}, 1) * 10 + {low} END"
    return f"""
SELECT v, regexp_replace(s, '(^|[^0-9])0+([0-9]+丁目)$', '\\1\\2') AS key FROM (
SELECT v, CASE WHEN k <> '' AND n IS NOT NULL THEN regexp_replace(s, '[{DIGITS}十]+丁目$', '') || n::VARCHAR || '丁目' ELSE s END AS s FROM (
SELECT *, {number} AS n FROM (
SELECT *, regexp_extract(s, '([{DIGITS}十]+)丁目$', 1) AS k FROM (
SELECT v, translate(trim(w), 'ヶヵ之のッ　 ', 'ケケノノツ') AS s FROM ({nfkc_sql(names)})))))"""


def parent_sql(key: str) -> str:
    return f"nullif(regexp_extract({key}, '(?s)^(.+?)[0-9]+丁目$', 1), '')"
