"""Boolean trigram queries from regular expressions.

A query is a list of clauses that must all hold. A clause is a list of alternatives, one of
which must hold; an alternative is a set of trigrams that a text must all have. Trigrams are
in lower case, so a query finds a superset of what the expression matches. An empty query
means that the expression names no trigram and every text must be scanned.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser

Query = list[list[frozenset[str]]]
#: More literal alternatives than this are not multiplied out; the clause ends there.
MOST = 48


def _exact(item: tuple) -> set[str] | None:
    """All texts that a part of an expression can match, if they are few literals."""
    kind, arg = item
    if kind is op.LITERAL:
        return {chr(arg).lower()}
    if kind is op.IN:
        if any(k is not op.LITERAL for k, _ in arg):
            return None
        return {chr(c).lower() for _, c in arg}
    if kind is op.SUBPATTERN:
        return _all_exact(arg[3])
    if kind is op.BRANCH:
        found = [_all_exact(branch) for branch in arg[1]]
        return None if None in found else set().union(*found)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = arg
        once = _all_exact(inner)
        if once is None or most > 8 and most != least or least > 8:
            return None
        return _repeated(once, least, int(most))
    if kind is op.AT:
        return {""}
    return None


def _repeated(once: set[str], least: int, most: int) -> set[str] | None:
    found, now = set(), {""}
    for n in range(most + 1):
        if n >= least:
            found |= now
        now = {a + b for a in now for b in once}
        if len(now) > MOST:
            return None
    return found


def _all_exact(items) -> set[str] | None:
    found = {""}
    for item in items:
        more = _exact(item)
        if more is None or len(found) * len(more) > MOST:
            return None
        found = {a + b for a in found for b in more}
    return found


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _flat(items) -> list[tuple]:
    """Parts in order, with plain groups opened."""
    found = []
    for kind, arg in items:
        whole = kind is op.SUBPATTERN and _exact((kind, arg)) is None
        found += _flat(arg[3]) if whole else [(kind, arg)]
    return found


def trigram_query(pattern: str) -> Query:
    clauses: Query = []
    run = {""}

    def close() -> None:
        if all(len(text) >= 3 for text in run):
            sets = {_trigrams(text) for text in run}
            # An alternative that asks for more than another adds nothing.
            clauses.append([a for a in sorted(sets, key=sorted) if not any(b < a for b in sets)])

    for item in _flat(_parser.parse(pattern)):
        exact = _exact(item)
        if exact is not None and len(run) * len(exact) <= MOST:
            run = {a + b for a in run for b in exact}
            continue
        close()
        run = exact if exact is not None else {""}
    close()
    return clauses
