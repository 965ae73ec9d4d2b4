"""Operators on ordered tokens: fills, onsets, bars, octaves, keys and voices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neumata.functions import tokens as T
from neumata.functions.common import let

# The major and minor key profiles from the tonic upward.
MAJOR = (6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88)
MINOR = (6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17)


def fill_forward(rows: DataFrame, column: str, keys: list[str], order: list[str]) -> DataFrame:
    """``column`` with empty values replaced by the last one before them in their group."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(column, F.last(F.nullif(F.col(column), F.lit("")), ignorenulls=True).over(w))


def onsets(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` (beats) with onset: the beats before each token of its group."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("onset", F.coalesce(F.sum("beats").over(w), F.lit(0.0)))


def octave_shift(notes: DataFrame) -> DataFrame:
    """(song_id, shift, marks): the shift of 0, 1 or -1 octaves that leaves fewest octave marks; the first of equals."""
    cost = {s: F.sum(F.abs(F.col("oct") + s)) for s in (0, 1, -1)}
    sums = notes.groupBy("song_id").agg(*(c.alias(f"c{k}") for k, c in enumerate(cost.values())))
    best = F.array_min(F.array(*(F.struct(F.col(f"c{k}").alias("marks"), F.lit(k).alias("k"), F.lit(s).alias("shift")) for k, s in enumerate(cost))))
    return sums.select("song_id", best.alias("b")).select("song_id", "b.shift", "b.marks")


def rest_heavy(tokens: DataFrame, least_tokens: int = 40, share: float = 0.70) -> DataFrame:
    """(song_id, n, silent, rest_heavy): songs of which rests and held notes make up ``share`` or more."""
    silent = F.get(T.parse_notes(F.col("token")), F.lit(0))["digit"].isNull()
    counts = tokens.groupBy("song_id").agg(F.count("*").alias("n"), F.count_if(silent).alias("silent"))
    heavy = (F.col("silent") * 100 >= F.col("n") * round(100 * share)) & (F.col("n") >= least_tokens)
    return counts.withColumn("rest_heavy", heavy)


def bar_starts(score: Column, per_bar: float | Column) -> Column:
    """The note indices before which a bar line stands, in an ordered fold over one score's tokens.

    Notes, rests and held notes take beats; only pitched notes have an index, and a tied
    repeat has none of its own. A full bar and a written line start the next one from
    zero; what a bar has too much is not carried. Within a tuplet (``3[`` to ``]``, or as
    many tokens as its number says) beats are scaled. Adjacent repeats are dropped; a
    leading 0 stays: the first bar is silent.
    """
    none = F.lit(None).cast("struct<digit:int,acc:int,oct:int>")

    def step(s: Column, token: Column) -> Column:
        facts = F.struct(
            T.parse_notes(token).alias("notes"),
            F.filter(T.parse_notes(token), lambda n: n["digit"].isNotNull()).alias("pitched"),
            T.tuplet_ratio(token).alias("tuplet"),
            token.rlike("^[cqsdh]*-$").alias("hold"),
        )

        def moved(x: Column) -> Column:
            line, close, tie = token == "|", token == "]", token == "~"
            opens = x["tuplet"].isNotNull()
            held = x["hold"] & ~opens
            note = ~(line | close | tie | opens | held) & (F.size(x["notes"]) > 0)
            other = ~(line | close | tie | opens | held | note)
            first = F.get(x["pitched"], F.lit(0))
            same = note & s["tied"] & (s["index"] > 0) & (first["digit"] == s["last"]["digit"]) & (first["acc"] == s["last"]["acc"])
            index = s["index"] + F.when(note, F.size(x["pitched"]) - F.coalesce(same, F.lit(False)).cast("int")).otherwise(0)
            beats = s["beats"] + F.when(note | held, T.beat(token) * s["ratio"]).otherwise(0.0)
            full = line | (note & (beats >= F.lit(per_bar) - 1e-9 if not isinstance(per_bar, Column) else beats >= per_bar - 1e-9))
            ends = note & (s["left"] == 1)
            last = F.element_at(F.concat(F.array(F.lit(-1)), s["out"]), -1)
            return F.struct(
                index.alias("index"),
                F.when(full, 0.0).otherwise(beats).alias("beats"),
                F.when(opens, x["tuplet"]["num"] / x["tuplet"]["fit_in"]).when(close | ends, 1.0).otherwise(s["ratio"]).alias("ratio"),
                F.when(opens, x["tuplet"]["fit_in"]).when(close, 0).when(note & (s["left"] > 0), s["left"] - 1).otherwise(s["left"]).alias("left"),
                F.when(tie, s["sounded"]).when(note | other, F.lit(False)).otherwise(s["tied"]).alias("tied"),
                F.when(note, F.size(x["pitched"]) > 0).when(other, F.lit(False)).otherwise(s["sounded"]).alias("sounded"),
                F.when(note & (F.size(x["pitched"]) > 0), F.element_at(x["pitched"], -1)).otherwise(s["last"]).alias("last"),
                F.when(full & (last != index), F.array_append(s["out"], index)).otherwise(s["out"]).alias("out"),
            )

        return let(facts, moved)

    start = F.struct(
        F.lit(0).alias("index"), F.lit(0.0).alias("beats"), F.lit(1.0).alias("ratio"), F.lit(0).alias("left"), F.lit(False).alias("tied"),
        F.lit(False).alias("sounded"), none.alias("last"), F.array().cast("array<int>").alias("out"),
    )
    return F.aggregate(T.tokens_of(score), start, step, lambda s: s["out"])


def infer_key(weighed: DataFrame, key: str) -> DataFrame:
    """(key, tonic, minor, r): of the 24 keys the one whose profile correlates best with the group's pitch classes.

    ``weighed`` has key, pc and w; it is summed to 12 numbers a group in one shuffle.
    """
    sums = [F.sum(F.when(F.col("pc") == c, F.col("w")).otherwise(0.0)).alias(f"w{c}") for c in range(12)]
    bags = weighed.groupBy(key).agg(*sums)
    w = [F.col(f"w{c}") for c in range(12)]
    mean = sum(w[1:], w[0]) / 12
    spread = F.sqrt(sum(((x - mean) * (x - mean) for x in w[1:]), (w[0] - mean) * (w[0] - mean)))
    rated = []
    for tonic in range(12):
        for minor, shape in ((False, MAJOR), (True, MINOR)):
            m = sum(shape) / 12
            size = sum((x - m) ** 2 for x in shape) ** 0.5
            dot = sum(((w[c] - mean) * (shape[(c - tonic) % 12] - m) for c in range(1, 12)), (w[0] - mean) * (shape[-tonic % 12] - m))
            r = F.when(spread > 0, F.round(dot / (spread * size), 6))
            rated.append(F.struct((-r).alias("less"), F.lit(tonic).alias("tonic"), F.lit(minor).alias("minor")))
    return bags.select(key, F.array_min(F.array(*rated)).alias("b")).select(key, "b.tonic", "b.minor", (-F.col("b.less")).alias("r"))
