"""Durations as tokens: a head with its dots, and signs that hold it on."""

from __future__ import annotations

from fractions import Fraction
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Quarters of the letters, of which one and a half with a dot.
LETTERS = (("", Fraction(1)), ("q", Fraction(1, 2)), ("s", Fraction(1, 4)), ("d", Fraction(1, 8)), ("h", Fraction(1, 16)))
#: The smallest step that a token can say, and the longest duration in the table, in quarters.
STEP, LONGEST = Fraction(1, 32), 16


def spellings() -> dict[Fraction, list[str]]:
    """Duration -> head and signs of it, up to four in all: the fewest, then the longest head without or with a dot, then the longest signs."""
    heads = [(name + dot, value * (Fraction(3, 2) if dot else 1)) for name, value in LETTERS for dot in ("", ".")]
    signs = [(f"{name}-", value) for name, value in LETTERS]
    out: dict[Fraction, list[str]] = {}
    for more in range(4):
        for parts in product(heads, *[signs] * more):
            out.setdefault(sum(value for _, value in parts), [name for name, _ in parts])
    return out


def table() -> list[tuple[int, list[str], bool]]:
    """(steps, parts, exact) of every duration up to LONGEST quarters. Longer notes than four signs can say are a head of one beat and the
    rest of a beat, held on beat by beat; what has no spelling is one beat, and not exact."""
    known = spellings()
    rows = []
    for steps in range(1, int(LONGEST / STEP) + 1):
        value = steps * STEP
        parts = known.get(value)
        if parts is None and value >= 1 and (head := known.get(1 + value % 1)):
            parts = head + ["-"] * (int(value) - 1)
        rows.append((steps, parts or [""], parts is not None))
    return rows


def spelled(spark: SparkSession, rows: DataFrame, quarters: Column) -> DataFrame:
    """``rows`` with parts and exact, looked up by the steps of a duration in quarters; durations between steps, of none or beyond
    LONGEST have the spelling of one beat, not exact. The table has LONGEST / STEP rows."""
    listed = spark.createDataFrame(table(), "steps int, parts array<string>, exact boolean")
    steps = F.round(quarters / float(STEP), 6)
    joined = rows.withColumn("steps", F.when(steps == F.floor(steps), steps).cast("int")).join(F.broadcast(listed), "steps", "left").drop("steps")
    return joined.withColumns({"parts": F.coalesce("parts", F.array(F.lit(""))), "exact": F.coalesce("exact", F.lit(False))})
