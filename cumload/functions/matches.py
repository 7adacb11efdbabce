"""Positions of pattern matches as columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is made once, however often ``then`` reads it."""
    return F.get(F.transform(F.array(value), lambda x: then(x)), 0)


def _let(name: str, value: str, then: str) -> str:
    """SQL: ``then`` with ``name`` for a value that is made once."""
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def before(values: str, add: str, block: int = 512) -> str:
    """SQL: for each of some integers what ``add`` (of {a} and {b}) makes of all before it, starting at 0.

    An array that grows in a fold is copied at each step, so only blocks of ``block`` elements are folded: each starts
    from the total of the blocks before, found in the same way. That keeps it near linear up to millions of elements.
    """

    def scan(part: str, start: str) -> str:
        return f"aggregate({part}, named_struct('a', {start}, 'out', CAST(array() AS ARRAY<INT>)), (x, b) -> named_struct('a', {add.format(a="x.a", b="b")}, 'out', concat(x.out, array(x.a))), x -> x.out)"

    cut = f"transform(sequence(0, greatest(CAST(floor((size(vals) - 1) / {block}) AS INT), 0)), k -> slice(vals, k * {block} + 1, {block}))"
    totals = scan(f"transform(parts, q -> aggregate(q, 0, (a, b) -> {add.format(a="a", b="b")}))", "0")
    return _let("vals", values, _let("parts", cut, _let("starts", totals, f"flatten(transform(parts, (q, i) -> {scan('q', 'get(starts, i)')}))")))


def _over(value: Column, sql: str) -> Column:
    """A SQL lambda of one variable over a column. Text, since a tree of columns this deep takes long to build."""
    return F.get(F.call_function("transform", F.array(value), F.expr(sql)), F.lit(0))


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def found(text: Column, pattern: str, around: int = 0) -> Column:
    """array<struct<start, end, match, before>> of the matches of a pattern, in code points counted from 0, end exclusive.

    Positions are running sums over matches and the text between them; ``before`` is up to ``around`` characters before a
    match (back to the match before the last).
    """
    plain, grouped = _quoted(pattern), _quoted(f"({pattern})")
    last = f"right(concat(coalesce(get(g, k - 1), ''), coalesce(get(h, k - 1), ''), get(g, k)), {around})" if around else "''"
    one = f"named_struct('start', get(pos, k) + length(get(g, k)), 'end', get(pos, k) + length(get(g, k)) + length(m), 'match', m, 'before', {last})"
    placed = _let("pos", before("transform(h, (m, k) -> length(m) + length(get(g, k)))", "({a} + {b})"), f"transform(h, (m, k) -> {one})")
    parts = _let("h", f"regexp_extract_all(t, {grouped}, 1)", _let("g", f"split(t, {plain}, -1)", placed))
    return _over(text, f"t -> CASE WHEN t RLIKE {plain} THEN {parts} ELSE CAST(array() AS ARRAY<STRUCT<start: INT, end: INT, match: STRING, before: STRING>>) END")


def replaced(text: Column, spans: Column, by: str, *, block: int = 512) -> Column:
    """``text`` with its spans (structs with start and end, sorted) replaced by ``by``: SQL of a span ``s`` and of ``at``, where the spans before it end.

    Parts of the text are cut from blocks of ``block`` characters, so that none is searched from the text's start.
    """

    def cut(a: str, b: str) -> str:
        first = f"CAST(floor({a} / {block}) AS INT)"
        some = f"array_join(slice(blocks, {first} + 1, greatest(CAST(floor(({b} - 1) / {block}) AS INT) - {first} + 1, 0)), '')"
        return f"CASE WHEN {b} > {a} THEN substring({some}, {a} - {first} * {block} + 1, {b} - {a}) ELSE '' END"

    ends = before("transform(p.spans, s -> s.end)", "greatest({a}, {b})")
    pieces = _let("pos", ends, f"transform(p.spans, (s, k) -> {_let('at', 'get(pos, k)', f'concat({cut("at", "s.start")}, {by})')})")
    tail = _let("at", "array_max(transform(p.spans, s -> s.end))", cut("at", "length(p.text)"))
    build = _let("blocks", f"regexp_extract_all(p.text, '(?s)(.{{1,{block}}})', 1)", f"array_join(concat({pieces}, array({tail})), '')")
    return _over(F.struct(text.alias("text"), spans.alias("spans")), f"p -> CASE WHEN size(p.spans) > 0 THEN {build} ELSE p.text END")


def first_at(text: Column, pattern: str) -> Column:
    """Where the first match starts, null without one."""
    return F.when(text.rlike(pattern), F.length(F.get(F.split(text, pattern, 2), 0)))


def last_at(text: Column, pattern: str) -> Column:
    """Where the last match starts, null without one."""
    return F.when(text.rlike(pattern), F.length(F.regexp_extract(text, f"(?s)^(.*){pattern}", 1)))
