"""Registered queries of the text problems."""

from __future__ import annotations

from tallyspan.llm import canonical, leakage, lookalike, mixing, mojibake, sentences
from tallyspan.session import table

QUERIES = {
    "p1_found": lambda s, d: canonical.map_values(table(s, d, "town_entries"), table(s, d, "areas")),
    "p1_mapped": lambda s, d: canonical.mapped(table(s, d, "town_entries"), table(s, d, "areas")),
    "p1_unmatched": lambda s, d: canonical.unmatched(table(s, d, "town_entries"), table(s, d, "areas")),
    "p3_found": lambda s, d: mojibake.found(table(s, d, "incidents"), table(s, d, "boundary"), table(s, d, "areas")),
    "p3_restored": lambda s, d: mojibake.restored(table(s, d, "incidents"), table(s, d, "boundary"), table(s, d, "areas")),
    "p6_found": lambda s, d: lookalike.lookalikes(table(s, d, "boundary"), table(s, d, "area_counts"), table(s, d, "areas")),
    "p6_one_form": lambda s, d: lookalike.one_form(table(s, d, "boundary"), table(s, d, "area_counts"), table(s, d, "areas")),
    "p7_found": lambda s, d: leakage.found(table(s, d, "documents"), table(s, d, "eval_items")),
    "p7_spans": lambda s, d: leakage.spans(table(s, d, "documents"), table(s, d, "eval_items")),
    "p7_cleaned": lambda s, d: leakage.cleaned(table(s, d, "documents"), table(s, d, "eval_items")),
    "p8_selection": lambda s, d: mixing.selection(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p8_curriculum": lambda s, d: mixing.selection(table(s, d, "documents"), table(s, d, "mix_targets"), mixing.LATE),
    "p8_shares": lambda s, d: mixing.shares(table(s, d, "documents"), table(s, d, "mix_targets")),
    "p9_found": lambda s, d: sentences.split(table(s, d, "documents")),
}

SQL: dict[str, str] = {}
