"""Rules to Spark SQL text.

SQL text rather than Column objects: planning a thousand rules then costs one call to the JVM. Each
distinct test of a field is projected once, under a short name, and the rules are built over those.
"""

from __future__ import annotations

import re

from .rules import Atom, Every, FieldMapping, Not, Rule, Some, atoms


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def wildcard_pattern(value: str) -> str:
    """A Java pattern for a value with * and ?; a backslash makes the next character literal and goes.

    A real tab or newline becomes a backslash and a letter, so it can't match itself: kept as it is
    in the dialect. (?d) and \\z keep the meaning of . and the end to newlines alone.
    """
    out, escaped = [], False
    for c in value.lower():
        if escaped or c not in "\\*?":
            out.append({"\t": r"\\t", "\n": r"\\n"}.get(c) or (re.escape(c) if ord(c) < 128 and not c.isalnum() and c != "_" else c))
            escaped = False
        elif c == "\\":
            escaped = True
        else:
            out.append(".*" if c == "*" else ".")
    if escaped:
        out.append(r"\\")
    return "(?d)^" + "".join(out) + r"\z"


def _test(column: str, command: str, values: tuple[str, ...]) -> str:
    if command == "wildcard":
        return f"rlike({column}, {literal(wildcard_pattern(values[0]))})"
    values = tuple(dict.fromkeys(v.lower() for v in values))
    if command == "equals":
        return f"{column} IN ({', '.join(map(literal, values))})" if values else "false"
    if not values:
        return "true"  # contains without values holds
    return "(" + " OR ".join(f"{command}({column}, {literal(v)})" for v in values) + ")"


class Compiled:
    """The tests, and for each tree an expression over them. Columns are never null, so that NOT is two-valued."""

    def __init__(self, mapping: FieldMapping | None = None):
        self.mapping = mapping or FieldMapping()
        self.columns: dict[str, str] = {}
        self.tests: dict[str, str] = {}

    def column(self, name: str) -> str:
        return self.columns.setdefault(name, f"__f{len(self.columns)}")

    def _named(self, test: str) -> str:
        return test if test in ("true", "false") else self.tests.setdefault(test, f"__t{len(self.tests)}")

    def _atom(self, a: Atom) -> str:
        parts = []
        for name in self.mapping(a.name):
            column = self.column(name)
            if a.every and len(a.values) > 1:
                parts.append("(" + " AND ".join(self._named(_test(column, a.command, (v,))) for v in a.values) + ")")
            else:
                parts.append(self._named(_test(column, a.command, a.values)))
        # empty means empty in all mapped fields; anything else may be in any of them
        word = " AND " if a.values == ("",) else " OR "
        return parts[0] if len(parts) == 1 else "(" + word.join(parts) + ")"

    def expression(self, tree) -> str:
        if isinstance(tree, Atom):
            return self._atom(tree)
        if isinstance(tree, Not):
            return f"(NOT {self.expression(tree.part)})"
        if not tree.parts:
            return "false"
        parts = [self.expression(p) for p in tree.parts]
        return parts[0] if len(parts) == 1 else "(" + (" AND " if isinstance(tree, Every) else " OR ").join(parts) + ")"


def used_fields(rules: list[Rule], mapping: FieldMapping) -> list[str]:
    """Event fields that the rules look at, in order of first use."""
    return list(dict.fromkeys(n for r in rules for a in atoms(r.tree) for n in mapping(a.name)))


__all__ = ["Compiled", "Some", "literal", "used_fields", "wildcard_pattern"]
