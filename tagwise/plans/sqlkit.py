"""Tiny helper to compose oracle SQL from named common table expressions.

Only string assembly: each oracle is ``WITH <needed ctes in dependency order> <final select>``.
"""

from __future__ import annotations

import re


class CteSet:
    def __init__(self) -> None:
        self._defs: dict[str, str] = {}

    def add(self, name: str, sql: str) -> None:
        self._defs[name] = sql.strip()

    def __contains__(self, name: str) -> bool:
        return name in self._defs

    def _deps(self, name: str) -> list[str]:
        body = self._defs[name]
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", body))
        return [d for d in self._defs if d != name and d in words]

    def query(self, final_sql: str) -> str:
        words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", final_sql))
        order: list[str] = []
        seen: set[str] = set()

        def visit(n: str) -> None:
            if n in seen:
                return
            seen.add(n)
            for d in self._deps(n):
                visit(d)
            order.append(n)

        for n in self._defs:
            if n in words:
                visit(n)
        final = final_sql.strip()
        if not order:
            return final
        body = ",\n".join(f"{n} AS (\n{self._defs[n]}\n)" for n in order)
        if re.match(r"(?i)^with\s", final):
            # the final statement has CTEs of its own: append them after ours
            return f"WITH {body},\n{final[4:].lstrip()}"
        return f"WITH {body}\n{final}"


def dbl(x: float) -> str:
    """A DOUBLE literal for DuckDB with the exact same value as the Python float."""
    return f"{float(x)!r}e0" if "e" not in repr(float(x)) else repr(float(x))


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(sql_str(i) for i in items) + "]"
