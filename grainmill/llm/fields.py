"""Records written as lists of named fields, read from whichever notation they use."""

from __future__ import annotations

import json
import re

_PAIR = {
    "|": re.compile(r"^\|\s*([^|]*?)\s*\|\s*([^|]*?)\s*\|?$"),
    "\t": re.compile(r"^([^\t]*?)[ ]*\t\s*(.*)$"),
    "=": re.compile(r"^([^=]*?)\s*=\s*(.*)$"),
    ":": re.compile(r"^([^:]*?)\s*:\s*(.*)$"),
}
_JSON_PAIR = re.compile(r'"((?:[^"\\]|\\.)*)"\s*:\s*("(?:[^"\\]|\\.)*"|[^",{}]*)')
_BLANK = re.compile(r"[^\S\n\t]+")


def fields_of(text: str | None) -> list[tuple[str, str]] | None:
    """(name, value) pairs of a record of at least two named fields, else None.

    A JSON object, one pair per line or one pair per ``;``; every unit has to be a pair in the same notation.
    """
    if not text:
        return None
    t = text.replace("﻿", "").strip()
    if len(t) < 5:
        return None
    if t[0] == "{" and t[-1] == "}":
        return _object(t)
    if not ("\t" in t or ":" in t or "=" in t or t[0] == "|"):
        return None
    t = _BLANK.sub(" ", t.replace("\r", "\n"))
    lines = [x for x in (line.strip(" ") for line in t.split("\n")) if x.strip()]
    return _pairs(lines) or _pairs([x for x in (part.strip() for part in t.replace("\n", " ").split(";")) if x])


def _object(t: str) -> list[tuple[str, str]] | None:
    try:
        made = json.loads(re.sub(r"\s+", " ", t))
        pairs = [(k, v if isinstance(v, str) else json.dumps(v)) for k, v in made.items()]
    except ValueError:
        pairs = [(m[1], m[2]) for m in _JSON_PAIR.finditer(t)]
    return pairs if len(pairs) >= 2 else None


def _pairs(units: list[str]) -> list[tuple[str, str]] | None:
    if len(units) < 2:
        return None
    for shape in _PAIR.values():
        found = []
        for u in units:
            m = shape.match(u)
            if not m or not m[1].strip():
                break
            found.append((m[1], m[2]))
        else:
            return found
    return None
