"""SQL equivalents of the registered queries, for an independent engine."""

from __future__ import annotations

import re

from oracle.base import BASE
from oracle.queries import SQL

# A text is completed with the common table expressions it names, directly or indirectly.
_NAME = re.compile(r"\bo_[a-z_]+\b")


def _needed(text: str, seen: list[str]) -> list[str]:
    for name in _NAME.findall(text):
        if name in BASE and name not in seen:
            _needed(BASE[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def complete(text: str) -> str:
    parts = [f"{name} AS ({BASE[name].strip()})" for name in _needed(text, [])]
    own = text.strip()
    if own.startswith("WITH RECURSIVE "):  # a text with steps of its own goes on with them
        return "WITH RECURSIVE " + ",\n".join([*parts, own.removeprefix("WITH RECURSIVE ")])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + own


ORACLE: dict[str, str] = {key: complete(text) for key, text in SQL.items()}
