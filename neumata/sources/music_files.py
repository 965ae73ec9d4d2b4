"""Standard MIDI files and ABC tunes as rows of note events, parsed file by file in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neumata.sources import abc

MIDI_EVENTS = "path string, track int, onset long, duration long, pitch int, ticks_per_quarter int, problem string"


def _number(data: bytes, at: int) -> tuple[int, int]:
    """A variable-length number and where it ends."""
    value = 0
    while True:
        value = value << 7 | data[at] & 0x7F
        at += 1
        if data[at - 1] < 0x80:
            return value, at


def track_notes(data: bytes) -> list[tuple[int, int, int]]:
    """(onset, duration, pitch) of one track's bytes in ticks; notes still held at the end are closed there."""
    at = now = status = 0
    held: dict[tuple[int, int], int] = {}
    notes = []
    while at < len(data):
        wait, at = _number(data, at)
        now += wait
        if data[at] >= 0x80:
            status, at = data[at], at + 1
        if status == 0xFF:
            size, at = _number(data, at + 1)
            at += size
        elif status in (0xF0, 0xF7):
            size, at = _number(data, at)
            at += size
        elif status >> 4 in (0xC, 0xD):
            at += 1
        else:
            key, force, at = (status & 15, data[at]), data[at + 1], at + 2
            if status >> 4 in (8, 9) and key in held:
                start = held.pop(key)
                notes.append((start, now - start, key[1]))
            if status >> 4 == 9 and force:
                held[key] = now
    return sorted(notes + [(start, now - start, key[1]) for key, start in held.items()])


def midi_notes(data: bytes) -> list[tuple[int, int, int, int, int]]:
    """(track, onset, duration, pitch, ticks per quarter) of a file; what is no MIDI file has none."""
    if data[:4] != b"MThd" or len(data) < 14:
        return []
    ticks, at, track, out = int.from_bytes(data[12:14], "big"), 8 + int.from_bytes(data[4:8], "big"), 0, []
    while at + 8 <= len(data):
        size = int.from_bytes(data[at + 4 : at + 8], "big")
        if data[at : at + 4] == b"MTrk":
            out += [(track, *note, ticks) for note in track_notes(data[at + 8 : at + 8 + size])]
            track += 1
        at += 8 + size
    return out


def read_midi(spark: SparkSession, path: str) -> DataFrame:
    """Note rows of all MIDI files under ``path``; a file that is none, or breaks off, gives one row with the problem."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"], strict=True):
                data = bytes(content)
                try:
                    if not data.startswith(b"MThd"):
                        raise ValueError("no MIDI file")
                    rows += [(name, *note, None) for note in midi_notes(data)]
                except IndexError:
                    rows.append((name, None, None, None, None, None, "file breaks off"))
                except ValueError as why:
                    rows.append((name, None, None, None, None, None, str(why)))
            columns = ["path", "track", "onset", "duration", "pitch", "ticks_per_quarter", "problem"]
            yield pd.DataFrame(rows, columns=columns).astype({c: "Int64" for c in columns[1:6]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, MIDI_EVENTS)


def read_abc(spark: SparkSession, path: str) -> DataFrame:
    """(path, tune from 0, tune's events) of all tunes of the ABC files under ``path``; see ``abc.events``."""
    texts = spark.read.format("binaryFile").load(path).select("path", F.decode("content", "UTF-8").alias("text"))
    tunes = F.filter(F.split("text", r"(?m)^(?=X:)", -1), lambda t: t.startswith("X:"))
    rows = texts.select("path", F.posexplode(tunes).alias("tune", "body"))
    return rows.lateralJoin(abc.AbcEvents(F.col("body").outer())).drop("body")
