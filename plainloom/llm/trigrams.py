"""Boolean trigram queries of regular expressions.

A query is ANYTHING, a trigram, or ("all" | "any", parts). Every text that a pattern
matches satisfies the pattern's query once both are in lower case, so texts that do
not satisfy it need no look at all. The standard library reads the pattern; only what
a match must hold is worked out here.
"""

from __future__ import annotations

import re
from itertools import product

ANYTHING = True
#: Sets of exact strings are followed up to this size; a class of more characters is anything.
MOST_STRINGS = 64
MOST_CHARACTERS = 8


def _both(kind: str, parts: list):
    if kind == "all":
        parts = [p for p in parts if p is not ANYTHING]
    elif any(p is ANYTHING for p in parts):
        return ANYTHING
    if kind == "any":  # a way that asks for all that another asks for, and more, adds nothing
        asked = {p: frozenset(p[1]) if isinstance(p, tuple) and p[0] == "all" else frozenset([p]) for p in parts}
        parts = [p for p in parts if not any(asked[o] < asked[p] for o in parts)]
    parts = sorted(set(parts), key=repr)
    if not parts:
        return ANYTHING
    return parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _strings(exact: set[str]):
    """One of these strings stands in the text."""
    return _both("any", [_both("all", [s[i : i + 3] for i in range(len(s) - 2)]) for s in exact])


def _characters(arg) -> set[str] | None:
    found: set[str] = set()
    for op, value in arg:
        if str(op) == "LITERAL":
            found.add(chr(value).lower())
        elif str(op) == "RANGE" and value[1] - value[0] < MOST_CHARACTERS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_CHARACTERS else None


def _item(op: str, arg) -> tuple[set[str] | None, object]:
    """The exact strings of one element if they are few, else None and what it needs."""
    if op == "LITERAL":
        return {chr(arg).lower()}, None
    if op == "IN":
        return _characters(arg), ANYTHING
    if op == "SUBPATTERN":
        return _sequence(arg[3])
    if op == "AT":
        return {""}, None
    if op == "BRANCH":
        ways = [_sequence(way) for way in arg[1]]
        if all(exact is not None for exact, _ in ways):
            union = set().union(*(exact for exact, _ in ways))
            if len(union) <= MOST_STRINGS:
                return union, None
        return None, _both("any", [_strings(e) if e is not None else q for e, q in ways])
    if op in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, inner = arg
        exact, needs = _sequence(inner)
        if exact is not None and high <= 2:
            union = {"".join(p) for n in range(low, high + 1) for p in product(exact, repeat=n)}
            if len(union) <= MOST_STRINGS:
                return union, None
        return None, (_strings(exact) if exact is not None else needs) if low else ANYTHING
    return None, ANYTHING


def _sequence(items) -> tuple[set[str] | None, object]:
    run, closed, whole = {""}, [], True
    for op, arg in items:
        exact, needs = _item(str(op), arg)
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
            continue
        whole = False
        closed += [_strings(run), ANYTHING if exact is not None else needs]
        run = exact if exact is not None and len(exact) <= MOST_STRINGS else {""}
    if whole:
        return run, None
    return None, _both("all", [*closed, _strings(run)])


def trigram_query(pattern: str):
    exact, needs = _sequence(re._parser.parse(pattern))
    return _strings(exact) if exact is not None else needs


def trigrams_of(query) -> set[str]:
    if query is ANYTHING:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def holds(query, text: str) -> bool:
    """Whether a text in lower case satisfies a query; for tests and small use."""
    if query is ANYTHING:
        return True
    if isinstance(query, str):
        return query in text
    return (all if query[0] == "all" else any)(holds(part, text) for part in query[1])
