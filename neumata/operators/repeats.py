"""Repeats: scores as they are written, in the order they are played.

A table function gives, for the signs of a score, the place of each sign that is played,
in turn. What the signs stand for stays in its own table and is looked up by place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Levels of repeats within each other, and signs that are played, beyond which a score is refused.
DEEPEST, LONGEST = 64, 1_000_000
PLAYED = "nth int, at int, problem string"
#: Fixed value: the repeat macro, R, a number, what is repeated and what each time ends with.
MACRO = re.compile(r"R(\d*)\s*\{\s*(.*?)\s*\}(?:\s*A\s*\{\s*(.*?)\s*\})?", re.DOTALL)


class Refused(ValueError):
    """A score that is not played."""


@dataclass
class Repeat:
    """The signs from ``low`` up to ``high`` again and again, each time with its ending, if it has one; ``stop`` is where it goes on."""

    low: int
    high: int = 0
    endings: list[list[int]] = field(default_factory=list)  # number, from, to
    stop: int = 0

    def begin(self, number: int, at: int) -> None:
        self.endings.append([number, at, at])

    def shut(self, at: int) -> None:
        if self.endings:
            self.endings[-1][2] = at

    def times(self) -> list[int]:
        numbers = {e[0] for e in self.endings}
        return [k for k in range(1, max(2, *numbers, 2) + 1) if k <= 2 or k in numbers]


def repeats_of(signs: list[str]) -> tuple[dict[int, Repeat], list[str]]:
    """The repeats of a score by where they begin, and what is odd about it, from one pass with a stack.

    ``|:`` begins a repeat and ``:|`` ends the innermost; one that none has begun goes back to the last repeat's end, or
    to the start. ``[n`` begins an ending, which the next one, ``:|``, or after the repeat also ``||`` or ``|]``, ends.
    """
    found, problems, stack, tail = {}, [], [Repeat(0)], None
    for at, sign in enumerate(signs):
        number = int(sign[1:]) if re.fullmatch(r"\[\d+", sign) else None
        closes, opens = sign.startswith(":"), len(sign) > 1 and sign.endswith(":")
        follows = closes and at + 1 < len(signs) and re.fullmatch(r"\[(?!1$)\d+", signs[at + 1])
        if tail and (number or closes or opens or sign in ("||", "|]")):
            tail.shut(at + (sign in ("||", "|]")))
            tail.stop = at if opens and not closes else at + 1
            if number:
                tail.begin(number, at + 1)
                continue
            closed, tail = closes, tail if follows else None
            if len(stack) == 1:
                stack = [Repeat(at + 1)]
            if closed and not opens:
                continue
            closes = False
        if closes:
            now = stack.pop()
            now.shut(at)
            now.high, now.stop = now.endings[0][1] - 1 if now.endings else at, at + 1
            found[now.low] = now
            tail = now if follows else None
            stack = stack or [Repeat(at + 1)]
        if opens:
            if len(stack) == DEEPEST:
                raise Refused(f"repeats go deeper than {DEEPEST} levels")
            stack.append(Repeat(at + 1))
        elif number:
            stack[-1].shut(at)
            stack[-1].begin(number, at + 1)
    if tail:
        tail.shut(len(signs))
        tail.stop = len(signs)
    problems += ["a repeat is not closed"] * (len(stack) - 1) + ["an ending of no repeat"] * sum(len(r.endings) for r in stack)
    return found, problems


def played(signs: list[str], order: str = "") -> tuple[list[int], list[str]]:
    """The places of the signs of a score in playing order, without those that only say what is repeated, and what is odd about it.

    ``P:x`` begins part x. Parts go by ``order`` (``ABA``), or else as they stand; what stands before the first goes first,
    and parts that the order leaves out go last. A part that comes more than once is played as it is written.
    """
    starts = [k for k, s in enumerate(signs) if s.startswith("P:")]
    pieces = [("", 0, starts[0] if starts else len(signs))]
    pieces += [(signs[k][2:].strip().upper()[:1], k + 1, end) for k, end in zip(starts, [*starts, len(signs)][1:], strict=True)]
    wanted = [c for c in order.upper() if c.isalpha()]
    names = [name for name, _, _ in pieces]
    problems = ["an order of parts that is not plain"] * bool(re.search(r"[^A-Za-z\s]", order))
    problems += [f"no part {c}" for c in dict.fromkeys(wanted) if c not in names] + [f"part {c} stands twice" for c in dict.fromkeys(names) if names.count(c) > 1]
    turn = [*([] if wanted and pieces[0][1] == pieces[0][2] else [0]), *(names.index(c) for c in wanted if c in names)] if wanted else range(len(pieces))
    turn = [*turn, *(k for k in range(1, len(pieces)) if wanted and k not in turn)]
    out: list[int] = []
    for k in turn:
        name, low, high = pieces[k]
        part = signs[low:high]
        repeats, odd = repeats_of(part)
        problems += odd if k not in turn[: list(turn).index(k)] else []
        out += [low + at for at in _walk(part, {} if wanted.count(name) > 1 else repeats, 0, len(part), None)]
        if len(out) > LONGEST:
            raise Refused(f"more than {LONGEST} signs are played")
    return out, problems


def _walk(signs: list[str], repeats: dict[int, Repeat], low: int, high: int, within: Repeat | None) -> Iterator[int]:
    at, n = low, 0
    while at < high:
        repeat = repeats.get(at)
        if repeat and repeat is not within:
            for time in repeat.times():
                for a, b in [(repeat.low, repeat.high), *(e[1:] for e in repeat.endings if e[0] == time)]:
                    for place in _walk(signs, repeats, a, b, repeat):
                        n += 1
                        if n > LONGEST:
                            raise Refused(f"more than {LONGEST} signs are played")
                        yield place
            at = repeat.stop
            continue
        sign = signs[at]
        if not (sign.startswith((":", "[")) and sign != "[|" or len(sign) > 1 and sign.endswith(":")):
            yield at
        at += 1


@F.udtf(returnType=PLAYED)
class PlayOrder:
    """``played`` as rows, nth from 0; then what is odd, in rows without a place. A score that is refused has one such row."""

    def eval(self, signs: list, order: str = "") -> Iterator[tuple]:
        try:
            places, problems = played([s or "" for s in signs or []], order or "")
        except Refused as why:
            places, problems = [], [str(why)]
        yield from ((nth, at, None) for nth, at in enumerate(places))
        yield from ((None, None, problem) for problem in problems)


def register(spark: SparkSession) -> None:
    """Make ``play_order(signs, order)`` known to SQL."""
    spark.udtf.register("play_order", PlayOrder)


def _unrolled(m: re.Match) -> str:
    times, body, ends = m[1], m[2].strip(), m[3]
    if ends is None:
        return "\n".join([body] * (int(times) if times else 2))
    endings = [e.strip() for e in ends.split("|")]
    if len(endings) < 2 or times and int(times) != len(endings):
        return m[0]
    return "\n".join(f"{body} {e}" for e in endings)


@F.pandas_udf(StringType())
def macro_expanded(scores: pd.Series) -> pd.Series:
    """Scores with ``R3{..}`` written out three times (twice without a number) and ``R{..}A{..|..}`` once with each ending; a macro
    whose number is not that of its endings stays as it is."""
    return scores.map(lambda s: MACRO.sub(_unrolled, s), na_action="ignore")
