"""Alignment of a transcription with what is true: how many notes are wrong, and in what."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

KINDS = ("edits", "octave", "digit", "missing", "extra")
#: Errors of one kind are counted in so many units of the next: a score has fewer notes.
UNIT = 1 << 20
FAR = np.iinfo(np.int64).max // 4


def _within(true: np.ndarray, read: np.ndarray, band: int) -> int:
    """The least cost of turning one sequence of codes (digit + 8 * octave) into the other, by ways that stay within ``band`` places of
    the diagonals between the corners: edits first, of these the fewest left out or put in, of these the fewest other digits."""
    edit, gap = UNIT * UNIT, UNIT * UNIT + UNIT
    lean = len(read) - len(true)
    low, high = min(0, lean) - band, max(0, lean) + band
    columns = np.arange(len(read) + 1, dtype=np.int64)
    row = np.where(columns <= high, columns * gap, FAR)
    for i in range(1, len(true) + 1):
        first, last = max(0, i + low), min(len(read), i + high)
        some = slice(first, last + 1)
        now = row[some] + gap
        come = read[max(first, 1) - 1 : last]
        wrong = np.where(come == true[i - 1], 0, edit + ((come & 7) != (true[i - 1] & 7)))
        from_left_up = row[max(first, 1) - 1 : last] + wrong
        now[len(now) - len(come) :] = np.minimum(now[len(now) - len(come) :], from_left_up)
        now = np.minimum.accumulate(now - columns[some] * gap) + columns[some] * gap  # notes put in, one after another
        row = np.full(len(read) + 1, FAR)
        row[some] = np.minimum(now, FAR)
    return int(row[-1])


def errors(true: np.ndarray, read: np.ndarray) -> tuple[int, ...]:
    """KINDS of the best alignment. The band doubles until no way out of it could be as good, so the result is that of the whole table."""
    band = 8
    while True:
        cost = _within(true, read, band)
        edits, rest = divmod(cost, UNIT * UNIT)
        gaps, digits = divmod(rest, UNIT)
        if edits <= band or band >= max(len(true), len(read)):
            lost = (gaps + len(true) - len(read)) // 2
            return edits, edits - gaps - digits, digits, lost, gaps - lost
        band *= 4


@F.pandas_udf(StructType([StructField(kind, LongType()) for kind in KINDS]))
def transcription_errors(true: pd.Series, read: pd.Series) -> pd.DataFrame:
    """struct(edits, octave, digit, missing, extra) of arrays of note codes, digit + 8 * octave with octaves from 0 up; null counts as none."""
    codes = lambda x: np.asarray([] if x is None else x, np.int64)
    return pd.DataFrame([errors(codes(a), codes(b)) for a, b in zip(true, read, strict=True)], columns=list(KINDS))
