"""The alignment rules once more as list expressions of the oracle's SQL.

A matrix is a list of rows, built row by row and cell by cell; a trace is a fold over as many steps
as it can take. Lists count from 1, so cell (i, j) of a matrix is ``m[i + 1][j + 1]``.
"""

from __future__ import annotations


def matrix(a: str, b: str, local: bool) -> str:
    floor, edge = ("0, ", "0") if local else ("", "CAST(-i AS INT)")
    step = (
        f"greatest({floor}m[-1][j] + CASE WHEN {a}[i] = {b}[j] THEN 1 ELSE -1 END,"
        " m[-1][j + 1] - 1, r[-1] - 1)"
    )
    row = f"list_reduce(range(1, len({b}) + 1), lambda r, j: r || [{step}], [{edge}])"
    top = "0" if local else "CAST(-x AS INT)"
    first = f"list_transform(range(0, len({b}) + 1), lambda x: {top})"
    return f"list_reduce(range(1, len({a}) + 1), lambda m, i: m || [{row}], [{first}])"


def _move(i: str, j: str, x: str, y: str) -> str:
    return f"{{'i': {i}, 'j': {j}, 'x': {x} || t.x, 'y': {y} || t.y}}"


def trace_global(m: str, a: str, b: str) -> str:
    both = _move("t.i - 1", "t.j - 1", f"[{a}[t.i]]", f"[{b}[t.j]]")
    up = _move("t.i - 1", "t.j", f"[{a}[t.i]]", "['-']")
    left = _move("t.i", "t.j - 1", "['-']", f"[{b}[t.j]]")
    here, above = f"{m}[t.i + 1][t.j + 1]", f"{m}[t.i][t.j + 1]"
    step = (
        f"CASE WHEN t.i = 0 AND t.j = 0 THEN t WHEN t.i > 0 AND t.j > 0 AND {a}[t.i] = {b}[t.j]"
        f" THEN {both} WHEN t.i > 0 AND {here} = {above} - 1 THEN {up} ELSE {left} END"
    )
    start = f"{{'i': len({a}), 'j': len({b}), 'x': CAST([] AS VARCHAR[]), 'y': CAST([] AS VARCHAR[])}}"
    return f"list_reduce(range(0, len({a}) + len({b})), lambda t, k: {step}, {start})"


def trace_local(m: str, a: str, b: str) -> str:
    here = f"{m}[t.i + 1][t.j + 1]"
    both = _move("t.i - 1", "t.j - 1", f"[{a}[t.i]]", f"[{b}[t.j]]")
    up = _move("t.i - 1", "t.j", f"[{a}[t.i]]", "['-']")
    left = _move("t.i", "t.j - 1", "['-']", f"[{b}[t.j]]")
    step = (
        f"CASE WHEN {here} = 0 THEN t WHEN {here} = {m}[t.i + 1][t.j] - 1 THEN {left}"
        f" WHEN {here} = {m}[t.i][t.j + 1] - 1 THEN {up} ELSE {both} END"
    )
    best = f"list_max(list_transform({m}, lambda r: list_max(r)))"
    last_row = f"list_max(list_filter(range(0, len({a}) + 1), lambda i: list_max({m}[i + 1]) = {best}))"
    last_cell = f"list_max(list_filter(range(0, len({b}) + 1), lambda j: {m}[{last_row} + 1][j + 1] = {best}))"
    start = f"{{'i': {last_row}, 'j': {last_cell}, 'x': CAST([] AS VARCHAR[]), 'y': CAST([] AS VARCHAR[])}}"
    return f"list_reduce(range(0, len({a}) + len({b})), lambda t, k: {step}, {start})"


def score(y: str, whole: str) -> str:
    kept = f"list_filter({y}, lambda s: s <> '-')"
    return f"round(CASE WHEN len({y}) < 2 THEN 0.0 ELSE CAST(len({kept}) AS DOUBLE) / len({whole}) END, 9)"


def aligned(pairs: str, kind: str) -> str:
    """``WITH`` clauses that end in ``aligned``: the columns of ``pairs``, align1, align2, score.

    Equal pairs of sequences are aligned once.
    """
    clauses = [f"todo AS (SELECT DISTINCT Seq1, Seq2 FROM {pairs})"]
    source, a, b = "todo", "Seq1", "Seq2"
    if kind in ("global", "hybrid"):
        clauses += [
            f"gm AS (SELECT *, {matrix(a, b, False)} AS M FROM {source})",
            f"gt AS (SELECT Seq1, Seq2, {trace_global('M', a, b)} AS g FROM gm)",
            "gd AS (SELECT Seq1, Seq2, g.x AS G1, g.y AS G2 FROM gt)",
        ]
        source, a, b = "gd", "G1", "G2"
    if kind in ("local", "hybrid"):
        clauses += [
            f"lm AS (SELECT *, {matrix(a, b, True)} AS LM FROM {source})",
            f"ltr AS (SELECT *, {trace_local('LM', a, b)} AS lt FROM lm)",
            f"done AS (SELECT Seq1, Seq2, lt.x AS align1, lt.y AS align2, {score('lt.y', b)} AS score FROM ltr)",
        ]
    else:
        clauses.append("done AS (SELECT Seq1, Seq2, G1 AS align1, G2 AS align2 FROM gd)")
    clauses.append(f"aligned AS (SELECT p.*, d.* EXCLUDE (Seq1, Seq2) FROM {pairs} p JOIN done d USING (Seq1, Seq2))")
    return ", ".join(clauses)
