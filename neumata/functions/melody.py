"""Degree strings: windows, contours, intervals and window costs, as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from neumata.functions.common import let, pairwise

# Semitones of the degrees 1 to 7 over the tonic; costs of query against stored accidental (-1, 0, 1).
SEMITONES = (0, 2, 4, 5, 7, 9, 11)
ACCIDENTAL_COST = {(0, 0): 0, (0, 1): 1, (0, -1): 1, (1, 0): 2, (1, 1): 0, (1, -1): 3, (-1, 0): 2, (-1, 1): 3, (-1, -1): 0}
OTHER_DEGREE = 4


def text_digits(text: Column) -> Column:
    """Any text as a degree string: its ASCII letters in turn stand for 1 to 7."""
    letters = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z]", ""))
    return F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "12345671234567123456712345")


def query_digits(query: str) -> str:
    """A typed query as one segment of degrees; everything else is dropped."""
    return "".join(c for c in query if c in "1234567")


def ngrams(digits: Column, n: int) -> Column:
    """All windows of n symbols in order, in one pass over the string; shorter strings have none."""
    return F.regexp_extract_all(digits, F.lit(f"(?=(.{{{n}}}))"), F.lit(1))


def symbols(digits: Column) -> Column:
    return F.regexp_extract_all(digits, F.lit("."), F.lit(0))


def contour(digits: Column) -> Column:
    """Steps between neighbours, modulo 7, as one string; the same for every diatonic transposition."""
    x = F.transform(symbols(digits), lambda c: c.cast("int"))
    return F.array_join(pairwise(x, lambda a, b: F.pmod(b - a, F.lit(7)).cast("string")), "")


def intervals(digits: Column) -> Column:
    """Shortest signed semitone steps (-5 to 6) as letters a to l; the same for every chromatic transposition."""
    table = F.array(*map(F.lit, SEMITONES))
    x = F.transform(symbols(digits), lambda c: F.get(table, c.cast("int") - 1))
    return F.array_join(pairwise(x, lambda a, b: F.char(F.pmod(b - a + 5, F.lit(12)) + 97)), "")


def window_costs(digits: Column, query: str) -> Column:
    """Differing symbols of every window of the query's length, in order; none for shorter strings."""
    n = len(query)

    def costs(chars: Column) -> Column:
        at = lambda i: sum(((F.get(chars, i + k) != c).cast("int") for k, c in enumerate(query)), F.lit(0))
        return F.when(F.size(chars) >= n, F.transform(F.sequence(F.lit(0), F.size(chars) - n), at)).otherwise(F.array().cast("array<int>"))

    return let(symbols(digits), costs)


def _differing(text: str, query: np.ndarray) -> np.ndarray:
    """Differing symbols of every window of the query's length."""
    x = np.frombuffer(text.encode(), np.uint8)
    n = max(0, len(x) - len(query) + 1)
    out = np.zeros(n, np.int32)
    for k, c in enumerate(query):
        out += x[k : k + n] != c
    return out


def least_differing(text: str, queries: list[str]) -> int | None:
    """The least differing symbols of any window of any of the queries; None without windows."""
    costs = [c for c in (_differing(text or "", np.frombuffer(q.encode(), np.uint8)) for q in queries) if len(c)]
    return min((int(c.min()) for c in costs), default=None)


def best_windows(symbols: Column, queries: list[str]) -> Column:
    """struct(diff, at): the least differing symbols of any window of any of the queries, and the starts of all
    windows that reach it. Null without windows. Whole strings go through numpy in Arrow batches: a window costs a
    few vector operations, where column functions make strings of it."""
    codes = [np.frombuffer(q.encode(), np.uint8) for q in queries]

    @F.pandas_udf("struct<diff:int,at:array<int>>")
    def scan(texts: pd.Series) -> pd.DataFrame:
        diffs, places = [], []
        for text in texts:
            costs = [c for c in (_differing(text or "", q) for q in codes) if len(c)]
            low = min((int(c.min()) for c in costs), default=None)
            diffs.append(low)
            places.append(None if low is None else np.unique(np.concatenate([np.flatnonzero(c == low) for c in costs])).astype(np.int32))
        return pd.DataFrame({"diff": pd.array(diffs, dtype="Int32"), "at": places})

    return scan(symbols)


#: Odd multiplier of the window hashes, and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _window_hashes(sums: np.ndarray, inverse: np.ndarray, n: int) -> np.ndarray:
    return (sums[n:] - sums[:-n]) * inverse[: len(sums) - n]


class Windowed(NamedTuple):
    """A text with the prefix sums of its hash, and the hashes of its windows of ``least`` symbols in order, with their places."""

    text: str
    least: int
    sums: np.ndarray
    hashes: np.ndarray
    order: np.ndarray


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of INVERSE, ``size`` of each and one."""
    return tuple(np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, base, np.uint64)]) for base in (BASE, INVERSE))


def windowed(text: str, least: int) -> Windowed:
    power, inverse = _powers(1 << len(text).bit_length())
    sums = np.r_[np.uint64(0), np.cumsum(np.frombuffer(text.encode(), np.uint8) * power[: len(text)], dtype=np.uint64)]
    hashes = _window_hashes(sums, inverse, least) if len(text) >= least else sums[:0]
    order = np.argsort(hashes, kind="stable")
    return Windowed(text, least, sums, hashes[order], order)


def longest_shared(a: str, b: str, least: int) -> tuple[int, int, int]:
    """(length, start in a, start in b) of the longest common substring, the first of equals; zeros if it is shorter than ``least``."""
    return longest_run(windowed(a, least), windowed(b, least))


def longest_run(x: Windowed, y: Windowed) -> tuple[int, int, int]:
    """``longest_shared`` of two texts.

    Windows of ``least`` symbols that both strings hold lie on diagonals, where neighbours make one run. Windows
    are compared by polynomial hashes modulo 2 ** 64, from prefix sums; what is found is compared itself. Strings that
    repeat themselves so much that their windows meet all over are halved in on instead, see ``_by_bisection``.
    """
    a, b, least = x.text, y.text, x.least
    if min(len(x.hashes), len(y.hashes)) == 0:
        return 0, 0, 0
    low = np.searchsorted(y.hashes, x.hashes)
    met = np.flatnonzero(y.hashes.take(low, mode="clip") == x.hashes)
    if not len(met):
        return 0, 0, 0
    low = low[met]
    times = np.searchsorted(y.hashes, x.hashes[met], "right") - low
    total = int(times.sum())
    if total > 8 * (len(a) + len(b)):
        return _by_bisection(a, b, least, [x.sums, y.sums], _powers(1 << max(len(a), len(b)).bit_length())[1])
    i = np.repeat(x.order[met], times)
    j = y.order[np.repeat(low - np.cumsum(times) + times, times) + np.arange(total)]
    along = np.lexsort((i, i - j))
    i, j = i[along], j[along]
    starts = np.flatnonzero(np.r_[True, (np.diff(i) != 1) | (np.diff(j) != 1)])
    lengths = np.diff(np.r_[starts, total]) + least - 1
    best = max(zip(lengths.tolist(), (-i[starts]).tolist(), (-j[starts]).tolist(), strict=True))
    n, i, j = best[0], -best[1], -best[2]
    return (n, i, j) if a[i : i + n] == b[j : j + n] else _by_bisection(a, b, least, [x.sums, y.sums], _powers(1 << max(len(a), len(b)).bit_length())[1])


def _by_bisection(a: str, b: str, least: int, sums: list[np.ndarray], inverse: np.ndarray) -> tuple[int, int, int]:
    """``longest_shared`` by halving the length: two strings share a substring of n symbols if they share one of n + 1."""
    low, high, best = least, min(len(a), len(b)), (0, 0, 0)
    while low <= high:
        n = (low + high) // 2
        x, y = (_window_hashes(s, inverse, n) for s in sums)
        both = np.isin(x, y)
        i = int(both.argmax())
        j = int((y == x[i]).argmax()) if both[i] else 0
        if both[i] and a[i : i + n] == b[j : j + n]:
            best, low = (n, i, j), n + 1
        else:
            high = n - 1
    return best


def repeat_profile(texts: pd.Series, n: int) -> pd.DataFrame:
    """most, repeated: how often the most repeated window of n symbols comes again, and how many symbols lie in a repeated one."""
    rows = []
    for text in texts:
        x = np.frombuffer(text.encode(), np.uint8).astype(np.int64) - 48
        codes = sum(x[k : len(x) - n + 1 + k] * 8**k for k in range(n))
        _, at, counts = np.unique(codes, return_inverse=True, return_counts=True)
        again = counts[at] - 1
        change = np.zeros(len(x) + 1, np.int64)
        np.add.at(change, np.flatnonzero(again), 1)
        np.add.at(change, np.flatnonzero(again) + n, -1)
        rows.append((int(again.max()), int((np.cumsum(change)[:-1] > 0).sum())))
    return pd.DataFrame(rows, columns=["most", "repeated"])


def near_windows(symbols: Column, query: str, most: int) -> Column:
    """array of struct(pos, diff): all windows within ``most`` differing symbols, in order."""
    code = np.frombuffer(query.encode(), np.uint8)

    @F.pandas_udf("array<struct<pos:int,diff:int>>")
    def scan(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            costs = _differing(text or "", code)
            out.append([{"pos": int(p), "diff": int(costs[p])} for p in np.flatnonzero(costs <= most)])
        return pd.Series(out)

    return scan(symbols)


def aligned(segments: list[str], places: list[Column], most_gap: int = 8) -> Column:
    """struct(diff, at): the segments in order as one phrase, with ``most_gap`` symbols between two at most.

    ``places`` are ascending arrays of struct(pos, diff), one of each segment. Least sum of diff first, then the
    shortest span, then the earliest. Of the ways to one end only the best goes on. Null if they make no phrase.
    """
    state = lambda diff, start, at: F.struct(diff.alias("diff"), (-start).alias("less"), at.alias("at"))
    ways = F.transform(places[0], lambda o: state(o["diff"], o["pos"], F.array(o["pos"])))

    def onward(ways: Column, o: Column, n: int) -> Column:
        gap = lambda w: o["pos"] - F.element_at(w["at"], -1) - n
        fit = F.filter(ways, lambda w: (gap(w) >= 0) & (gap(w) <= most_gap))
        return F.array_min(F.transform(fit, lambda w: state(w["diff"] + o["diff"], -w["less"], F.array_append(w["at"], o["pos"]))))

    def grown(found: Column, n: int) -> Callable[[Column], Column]:
        return lambda ways: F.array_compact(F.transform(found, lambda o: onward(ways, o, n)))

    for before, found in zip(segments, places[1:], strict=False):
        ways = let(ways, grown(found, len(before)))
    n = len(segments[-1])
    ends = F.transform(ways, lambda w: F.struct(w["diff"].alias("diff"), (F.element_at(w["at"], -1) + n + w["less"]).alias("span"), w["at"].alias("at")))
    return let(F.array_min(ends), lambda b: F.when(b.isNotNull(), F.struct(b["diff"].alias("diff"), b["at"].alias("at"))))


def section_at(sections: Column, pos: Column, n: Column | int) -> Column:
    """struct(weight, name) of the weightiest section (array of struct(start, name)) that a hit covers a part of, the first of
    equals; null without sections."""
    from neumata.functions.tokens import section_weight

    stop = lambda k: F.coalesce(F.get(sections, k + 1)["start"], F.lit(2_147_483_647))
    met = F.filter(sections, lambda s, k: (s["start"] < pos + n) & (stop(k) > pos))
    best = F.array_max(F.transform(met, lambda s: F.struct(section_weight(s["name"]).alias("weight"), (-s["start"]).alias("less"), s["name"].alias("name"))))
    return let(best, lambda b: F.when(b.isNotNull(), F.struct(b["weight"].alias("weight"), b["name"].alias("name"))))


def bar_span(bars: Column, pos: Column, n: Column | int) -> Column:
    """struct(first, stop, bar_from, bar_to): the least whole bars around notes pos to pos + n - 1. ``bars`` are the notes before
    which a line stands; bars count from 1; stop is null in the last bar."""
    up_to = lambda i: F.filter(bars, lambda b: b <= i)
    last = pos + n - 1
    return F.struct(
        F.coalesce(F.array_max(up_to(pos)), F.lit(0)).alias("first"),
        F.array_min(F.filter(bars, lambda b: b > last)).alias("stop"),
        F.greatest(F.size(up_to(pos)), F.lit(1)).alias("bar_from"),
        F.greatest(F.size(up_to(last)), F.lit(1)).alias("bar_to"),
    )


def snippet(notes: Column, bars: Column, pos: Column, n: Column | int, most: int = 240) -> Column:
    """The notes of the bars around a hit, bar lines between, the hit in 【】; of very long ones the two ends."""

    def written(span: Column) -> Column:
        stop = F.least(F.coalesce(span["stop"], F.size(notes)), F.size(notes))
        one = lambda i: F.concat(
            F.when(F.array_contains(bars, i) & (i > span["first"]), "| ").otherwise(""),
            F.when(i == pos, "【").otherwise(""),
            F.get(notes, i),
            F.when(i == pos + n - 1, "】").otherwise(""),
        )
        text = F.array_join(F.transform(F.sequence(span["first"], stop - 1), one), " ")
        half = most // 2
        return let(text, lambda t: F.when(F.length(t) > most, F.concat(F.left(t, F.lit(half)), F.lit(" … "), F.right(t, F.lit(half)))).otherwise(t))

    return F.when(pos + n <= F.size(notes), let(bar_span(bars, pos, n), written)).otherwise("")


def section_score(n: int, weight: Column, cover: Column, diff: Column) -> Column:
    """The worth of a hit of n symbols: by section weight and by how much of the section it covers, less its errors."""
    return n * weight * (0.5 + 0.5 * F.least(20 * cover, F.lit(1.0))) - diff * n * 0.25


def parsed_query(raw: Column) -> Column:
    """The notes (digit, acc, oct) of freely typed text; what is no note is skipped."""
    pattern = "([#b♯♭]?)([,']*)([1-7])([,']*)([#b♯♭]?)"
    part = lambda k: F.regexp_extract_all(raw, F.lit(pattern), F.lit(k))

    def note(p: Column) -> Column:
        signs, marks = F.concat(p["a"], p["e"]), F.concat(p["b"], p["d"])
        return F.struct(
            p["c"].cast("int").alias("digit"),
            F.when(signs.rlike("[#♯]"), 1).when(signs.rlike("[b♭]"), -1).otherwise(0).alias("acc"),
            (F.regexp_count(marks, F.lit(",")) - F.regexp_count(marks, F.lit("'"))).alias("oct"),
        )

    return F.transform(F.arrays_zip(*(part(k).alias(c) for k, c in enumerate("abcde", 1))), note)


def shown(notes: Column) -> Column:
    """Notes as readable text, like ``6 3 #5``."""
    return F.array_join(F.transform(notes, lambda n: F.concat(F.when(n["acc"] == 1, "#").when(n["acc"] == -1, "b").otherwise(""), n["digit"].cast("string"))), " ")


def octave_codes(notes: Column) -> Column:
    """Notes as codes of degree and signed octave, like ``6+1``."""
    return F.transform(notes, lambda n: F.format_string("%d%+d", n["digit"], n["oct"]))


def octaves_apart(notes: Column, pos: Column, octaves: list[int]) -> Column:
    """How many notes of a window from ``pos`` lie in another octave than those of a query."""
    return sum(((F.get(notes, pos + k)["oct"] != o).cast("int") for k, o in enumerate(octaves)), F.lit(0))


def best_window(costs: Column) -> Column:
    """struct(diff, pos): the least cost and where it first occurs (from 0); null without windows."""
    low = F.array_min(costs)
    return F.when(F.size(costs) > 0, F.struct(low.alias("diff"), (F.array_position(costs, low) - 1).cast("int").alias("pos")))


def accidental_costs(notes: Column, query: list[tuple[int, int]]) -> Column:
    """Costs of every window of notes (digit, acc) against query notes: strict where the query is marked, lenient where the
    stored note alone is."""

    def one(note: Column, digit: int, acc: int) -> Column:
        cost = F.when(note["digit"] != digit, OTHER_DEGREE)
        for stored in (-1, 0, 1):
            cost = cost.when(note["acc"] == stored, ACCIDENTAL_COST[acc, stored])
        return cost

    at = lambda i: sum((one(F.get(notes, i + k), *q) for k, q in enumerate(query)), F.lit(0))
    every = F.transform(F.sequence(F.lit(0), F.size(notes) - len(query)), at)
    return F.when(F.size(notes) >= len(query), every).otherwise(F.array().cast("array<int>"))


def deletion_variants(query: str) -> list[str]:
    """The query and all of its single deletions, in order, without repeats."""
    return list(dict.fromkeys([query, *(query[:k] + query[k + 1 :] for k in range(len(query)))]))


def seed_blocks(n: int, errors: int) -> list[tuple[int, int]]:
    """(offset, length) of errors + 1 blocks that cover n symbols; one is met exactly by any window within ``errors``."""
    cuts = [n * k // (errors + 1) for k in range(errors + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]
