"""Pieces of SQL that several queries share."""

from __future__ import annotations


def shapes(key: str, *templates: str | None) -> str:
    """Which of some shapes of text a row has, by the remainder of its key; {k} in one is the key. Spark and DuckDB read it alike."""
    value = lambda t: "NULL" if t is None else "concat('" + t.replace("{k}", f"', {key}, '") + "')"
    return f"CASE {key} % {len(templates)} " + " ".join(f"WHEN {i} THEN {value(t)}" for i, t in enumerate(templates)) + " END"


#: Jaro-Winkler from Jaro, whatever that is: DuckDB's own raises only similarities over 0.7.
WINKLER = "CASE WHEN {a} = {b} THEN 1.0 WHEN {a} = '' OR {b} = '' THEN 0.0 ELSE jaro_similarity({a}, {b}) + 0.1 * (1 - jaro_similarity({a}, {b})) * CASE WHEN substr({a}, 1, 4) = substr({b}, 1, 4) AND least(length({a}), length({b})) >= 4 THEN 4 WHEN substr({a}, 1, 3) = substr({b}, 1, 3) AND least(length({a}), length({b})) >= 3 THEN 3 WHEN substr({a}, 1, 2) = substr({b}, 1, 2) AND least(length({a}), length({b})) >= 2 THEN 2 WHEN substr({a}, 1, 1) = substr({b}, 1, 1) THEN 1 ELSE 0 END END"
