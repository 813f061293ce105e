"""A filter evaluated over plain dictionaries, row by row: what the engine's plans are held against.

Operands are expected in the type of their field. Absent and null are one.
"""

from __future__ import annotations


def candidates(doc, path):
    """(values at the path, whether the path ends on a list): lists are transparent, and count as a value at the end."""
    level = [doc]
    for name in path.split("."):
        level = [y for x in level for y in (x if isinstance(x, list) else [x])]
        level = [x[name] for x in level if isinstance(x, dict) and x.get(name) is not None]
    return [y for x in level for y in ([x, *x] if isinstance(x, list) else [x])]


def _same(a, b):
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    return type(a) is type(b) and a == b or isinstance(a, (int, float)) and isinstance(b, (int, float)) and a == b


def _kind(x):
    return "number" if isinstance(x, (int, float)) and not isinstance(x, bool) else type(x).__name__


def leaf(doc, path, operator, v):
    found = candidates(doc, path)

    def equals(w):
        return not found if w is None else any(_same(x, w) for x in found)
    compare = {"greater_than": lambda a, b: a > b, "greater_than_equal": lambda a, b: a >= b, "less_than": lambda a, b: a < b, "less_than_equal": lambda a, b: a <= b}
    if operator in compare:
        return any(_kind(x) == _kind(v) and _kind(x) in ("number", "str") and compare[operator](x, v) for x in found)
    if operator in ("equals", "not_equals"):
        return equals(v) == (operator == "equals")
    if operator in ("in", "not_in"):
        return any(equals(w) for w in v) == (operator == "in")
    if operator == "all":
        return all(equals(w) for w in v)
    if operator == "exists":
        there = bool(found)
        return (there and "" not in found) if v else (not there or "" in found)
    if operator in ("like", "not_like"):
        hit = not isinstance(v, str) or v == "" or any(isinstance(x, str) and v.lower() in x.lower() for x in found)
        return hit == (operator == "like")
    if operator == "contains":
        def text(x):
            return x if isinstance(x, str) else str(int(x)) if float(x).is_integer() else repr(x)
        needles = v if isinstance(v, list) else [v]
        return any(_kind(x) in ("number", "str") and text(n).lower() in text(x).lower() for x in found for n in needles)
    raise AssertionError(operator)


def matches(doc, where):
    for key, clause in (where or {}).items():
        if key == "and":
            ok = all(matches(doc, w) for w in clause)
        elif key == "or":
            ok = not clause or any(matches(doc, w) for w in clause)
        else:
            ok = all(leaf(doc, key, op, v) for op, v in clause.items())
        if not ok:
            return False
    return True
