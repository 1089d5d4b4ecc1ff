"""Spans of regular-expression matches as column expressions.

Everything is a built-in function. Positions are code points, ends are exclusive, matches are the
leftmost non-overlapping ones. The pieces between matches and the matches themselves alternate, so
their lengths give the positions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``before`` is what stands in front of a span, up to REACH code points.
REACH = 40
SPAN = "array<struct<start:int,end:int,found:string,value:string,before:string>>"
#: Items that one inner pass of ``scan`` takes.
CHUNK = 64


def quoted(text: str) -> str:
    """A string literal for SQL expressions, whatever the parser does with backslashes."""
    return "decode(unhex('" + text.encode().hex() + "'), 'UTF-8')"


def bound(value: str, name: str, body: str) -> str:
    """body with name standing for value, which is evaluated once and not once per use."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def scan(items: str, state: str, kind: str, following: str, emitted: str) -> str:
    """A pass over an array that carries a state and emits elements of ``kind``.

    ``following`` is the next state and ``emitted`` an array, both of the state $ and the item x. An
    array that grows by one is copied each time, so the items are taken in chunks: the first pass
    carries the state from chunk to chunk, the second lets each chunk emit on its own. n items cost
    about n * CHUNK / 2 + (n / CHUNK)^2 / 2 copies of references instead of n^2 / 2.
    """
    chunks = f"transform(sequence(1, size(list), {CHUNK}), i -> slice(list, i, {CHUNK}))"
    states = f"""aggregate(chunks, named_struct('s', {state}, 'seen', slice(array({state}), 1, 0)),
        (acc, c) -> named_struct('s', aggregate(c, acc.s, (s, x) -> {following.replace('$', 's')}), 'seen', concat(acc.seen, array(acc.s))), acc -> acc.seen)"""
    step = f"named_struct('s', {following}, 'out', concat(a.out, {emitted}))".replace("$", "a.s")
    own = f"aggregate(c, named_struct('s', element_at(states, i + 1), 'out', cast(array() as array<{kind}>)), (a, x) -> {step}, a -> a.out)"
    walked = bound(chunks, "chunks", bound(states, "states", f"flatten(transform(chunks, (c, i) -> {own}))"))
    return bound(items, "list", f"if(size(list) > 0, {walked}, cast(array() as array<{kind}>))")


def spans(text: str, pattern: str, gate: str, group: int = 0) -> Column:
    """Matches of ``pattern`` in the column ``text``; ``value`` is the text of ``group``.

    ``gate`` is a cheap SQL condition that every text with a match meets. Time is linear in the text:
    positions and context are carried along, not looked up.
    """
    p = quoted(pattern)
    pieces = f"arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {group}))"
    before = f"right(concat($.tail, right(x['0'], {REACH})), {REACH})"
    at = "$.at + length(x['0'])"
    # the last piece has no match behind it
    following = f"if(x['1'] is null, $, named_struct('at', {at} + length(x['1']), 'tail', right(concat({before}, right(x['1'], {REACH})), {REACH})))"
    found = f"named_struct('start', {at}, 'end', {at} + length(x['1']), 'found', x['1'], 'value', x['2'], 'before', {before})"
    one = SPAN.removeprefix("array<").removesuffix(">")
    walked = scan(pieces, "named_struct('at', 0, 'tail', '')", one, following, f"if(x['1'] is null, cast(array() as {SPAN}), array({found}))")
    return F.expr(f"if({gate}, {walked}, cast(array() as {SPAN}))")


def listed(columns: list[tuple[str, str]], by: str) -> Column:
    """``kind:start:end`` of all spans, comma-joined, ordered by 'kind' (as listed) or by 'start' then kind."""
    marked = [
        f"transform({column}, x -> named_struct('a', {'x.start' if by == 'start' else i}, 'b', {i if by == 'start' else 'x.start'}, 's', concat('{kind}:', x.start, ':', x.end)))"
        for i, (kind, column) in enumerate(columns)
    ]
    return F.expr(f"array_join(transform(sort_array(concat({', '.join(marked)})), x -> x.s), ',')")
