"""Boolean trigram queries that are derived from regular expressions.

The expression is parsed and walked from the left. What is known about a part of it is either
the few strings it can match, all of them (``exact``), or conditions that each of its matches
meets: a list of alternatives (``clauses``), each a set of lower-case strings that a match holds.
Neighbouring parts with few exact strings are joined, so that trigrams reach over their border.
Whatever is not understood is something that can match anything, so a query never loses a match.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

# CPython's own parser of regular expressions.
from re import _constants as C
from re import _parser as parser

GRAM = 3
# More strings than this are not followed one by one.
MOST_STRINGS = 16
MOST_CLAUSES = 24

Clauses = tuple[frozenset[str], ...]


@dataclass(frozen=True)
class Known:
    """``exact``: all strings that a part matches, lower-case, or None. ``clauses``: or of ands; () is unknown."""

    exact: frozenset[str] | None
    clauses: Clauses = ()


ANYTHING = Known(None)
NOTHING = Known(frozenset({""}))


def _held(strings: frozenset[str]) -> Clauses:
    """Alternatives that say: one of the strings is there. A string without a trigram says nothing."""
    if any(len(s) < GRAM for s in strings) or len(strings) > MOST_CLAUSES:
        return ()
    return tuple(frozenset({s}) for s in sorted(strings))


def _both(one: Clauses, other: Clauses) -> Clauses:
    """Alternatives of a part that is followed by another one: both hold."""
    if not one or not other:
        return one or other
    if len(one) * len(other) > MOST_CLAUSES:
        return min(one, other, key=len)
    return tuple(dict.fromkeys(a | b for a, b in product(one, other)))


def _either(parts: list[Known]) -> Known:
    exact: set[str] | None = set()
    for part in parts:
        exact = None if exact is None or part.exact is None else exact | part.exact
    if exact is not None and len(exact) <= MOST_STRINGS:
        return Known(frozenset(exact))
    clauses = [part.clauses if part.exact is None else _held(part.exact) for part in parts]
    if not all(clauses) or sum(map(len, clauses)) > MOST_CLAUSES:
        return ANYTHING
    return Known(None, tuple(dict.fromkeys(c for alternatives in clauses for c in alternatives)))


def _literal(code: int) -> Known:
    return Known(frozenset({chr(code).lower()}))


def _set(members) -> Known:
    """A character class: exact if it is a few characters, one by one."""
    found = set()
    for op, value in members:
        if op is C.LITERAL:
            found.add(chr(value).lower())
        elif op is C.RANGE and value[1] - value[0] < MOST_STRINGS:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return ANYTHING
    return Known(frozenset(found)) if 0 < len(found) <= MOST_STRINGS else ANYTHING


def _repeated(low: int, high: int, part: Known) -> Known:
    if low == high == 1:
        return part
    if low == 0:
        if high == 1 and part.exact is not None and len(part.exact) < MOST_STRINGS:
            return Known(part.exact | {""})
        return ANYTHING
    if low == high and part.exact is not None and len(part.exact) ** low <= MOST_STRINGS and low <= 64:
        return Known(frozenset("".join(p) for p in product(sorted(part.exact), repeat=low)))
    return Known(None, part.clauses if part.exact is None else _held(part.exact))


def _item(op, value) -> Known:
    if op is C.LITERAL:
        return _literal(value)
    if op is C.IN:
        return _set(value)
    if op is C.SUBPATTERN:
        return _sequence(value[3])
    if op is C.ATOMIC_GROUP:
        return _sequence(value)
    if op is C.BRANCH:
        return _either([_sequence(branch) for branch in value[1]])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        return _repeated(value[0], value[1], _sequence(value[2]))
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return NOTHING  # takes no characters; its condition is not used
    return ANYTHING


def _sequence(items) -> Known:
    clauses: Clauses = ()
    run: frozenset[str] | None = frozenset({""})  # strings of the exact items since the last other one
    all_exact = True
    for op, value in items:
        part = _item(op, value)
        if part.exact is not None and len(run) * len(part.exact) <= MOST_STRINGS:
            run = frozenset(a + b for a, b in product(run, part.exact))
            continue
        all_exact = False
        clauses = _both(clauses, _held(run))
        if part.exact is not None:
            run = part.exact
        else:
            clauses = _both(clauses, part.clauses)
            run = frozenset({""})
    if all_exact:
        return Known(run)
    return Known(None, _both(clauses, _held(run)))


def mandatory(pattern: str) -> Clauses:
    """Alternatives of strings: each match of ``pattern`` holds, in lower case, all strings of one of them.

    Empty if nothing can be derived, also where the pattern cannot be parsed.
    """
    try:
        known = _sequence(parser.parse(pattern))
    except (re.error, OverflowError, RecursionError):
        return ()
    return known.clauses if known.exact is None else _held(known.exact)


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + GRAM] for i in range(len(text) - GRAM + 1))


def trigram_query(pattern: str) -> list[list[str]]:
    """The query of ``pattern``: all trigrams of one of these lists are in a text with a match."""
    clauses = {frozenset().union(*map(trigrams, strings)) for strings in mandatory(pattern)}
    # A clause that asks for more than another one is not needed.
    least = [c for c in clauses if not any(other < c for other in clauses)]
    return sorted(sorted(c) for c in least)
