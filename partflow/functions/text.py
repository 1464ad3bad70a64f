"""String expressions: filled templates, JSON texts, line picking."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


# Code points that count as whitespace where texts are split or stripped.
SPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
SPACES = "".join(map(chr, SPACE_CODES))


def strip(text: Column) -> Column:
    """``text`` without whitespace at its ends."""
    return F.trim(text, F.lit(SPACES))


def has_ink(text: Column) -> Column:
    """True where something other than whitespace is there.

    The search stops at the first such character, mostly the very first.
    """
    return text.rlike(f"[^{SPACES}]")


def words(text: Column) -> Column:
    """``text`` split at runs of whitespace; no empty words."""
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def fill(template: str, **marks: Column) -> Column:
    """``template`` with each ``{mark}`` replaced by a column."""
    pieces = re.split(r"\{(\w+)\}", template)
    cols = [marks[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p]
    return F.concat(*cols)


def contains_any(text: Column, words) -> Column:
    """True where lower-cased ``text`` holds one of the words as a substring."""
    low = F.lower(text)
    hit = F.contains(low, F.lit(words[0]))
    for word in words[1:]:
        hit = hit | F.contains(low, F.lit(word))
    return hit


def json_text(value: Column) -> Column:
    """One value as JSON, with everything beyond ASCII escaped."""
    wrapped = F.to_json(F.struct(value.alias("v")), {"writeNonAsciiCharacterAsCodePoint": "true"})
    return F.substring(wrapped, F.lit(6), F.length(wrapped) - 6)


def json_object(pairs: list[tuple[str, Column]]) -> Column:
    """A JSON object written with ``": "`` and ``", "`` between its parts.

    The values are JSON texts already (see ``json_text``).
    """
    parts = [F.concat(F.lit(f'"{key}": '), value) for key, value in pairs]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def join_lines(lines: Column, indent: str = "  ") -> Column:
    """Each line trimmed, indented and closed by a newline, as one text."""
    return F.array_join(F.transform(lines, lambda s: F.concat(F.lit(indent), strip(s), F.lit("\n"))), "")


def pick_lines(text: Column, words) -> Column:
    """The lines of ``text`` that hold one of the words."""
    return F.filter(F.split(text, "\n"), lambda s: contains_any(s, words))
