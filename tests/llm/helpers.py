"""Small tables, and plain versions of what operators do."""

from __future__ import annotations

import re
import string

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def documents(spark, rows, extra: str = ""):
    """Rows of (doc_id, text); ``extra`` names further columns, which hold an ``x``."""
    names = extra.split()
    schema = "doc_id long, text string" + "".join(f", {n} string" for n in names)
    return spark.createDataFrame([(*r, *("x" for _ in names)) for r in rows], schema)


def lowered(text: str | None) -> str:
    return (text or "").translate(LOWERED)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(lowered(text))


def syllables(seed: int, count: int) -> list[str]:
    """Invented words, the same for the same seed."""
    import random

    draw = random.Random(seed)
    parts = "an be co du el fi go ha in ju ka lo mu no or".split()
    return ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(count)]
