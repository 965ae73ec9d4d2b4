"""Error kinds of a transcription against the whole table of the dynamic programme."""

import random

import numpy as np
import pytest

from neumata.functions import alignment


def plain_errors(true, read):
    """(edits, gaps, digits) of the best alignment, in that order of weight, from the full table."""
    table = [[(j, j, 0) for j in range(len(read) + 1)]]
    for i, a in enumerate(true, 1):
        row = [(i, i, 0)]
        for j, b in enumerate(read, 1):
            e, g, d = table[i - 1][j - 1]
            both = (e + (a != b), g, d + (a & 7 != b & 7))
            e, g, d = min(table[i - 1][j], row[j - 1])
            row.append(min(both, (e + 1, g + 1, d)))
        table.append(row)
    edits, gaps, digits = table[-1][-1]
    missing = (gaps + len(true) - len(read)) // 2
    return edits, edits - gaps - digits, digits, missing, gaps - missing


@pytest.mark.parametrize("seed", range(4))
def test_errors_equal_the_whole_table(seed):
    rng = random.Random(seed)
    for _ in range(60):
        true = [rng.randint(1, 3) + 8 * rng.randint(0, 1) for _ in range(rng.randint(0, 40))]
        read = [rng.randint(1, 3) + 8 * rng.randint(0, 1) for _ in range(rng.randint(0, 40))] if rng.random() < 0.4 else list(true)
        for _ in range(rng.randint(0, 6)):
            at = rng.randint(0, len(read))
            read[at : at + rng.randint(0, 2)] = [rng.randint(1, 3) + 8 * rng.randint(0, 1) for _ in range(rng.randint(0, 2))]
        assert alignment.errors(np.array(true, np.int64), np.array(read, np.int64)) == plain_errors(true, read)


def test_long_scores_stay_within_a_band():
    rng = np.random.default_rng(1)
    true = rng.integers(1, 8, 5000) + 8
    read = np.delete(true, [10, 400, 4000])
    read[[50, 60]] += 8
    read[100] = read[100] % 7 + 9 if read[100] & 7 != 7 else 9
    assert alignment.errors(true, read) == (6, 2, 1, 3, 0)


def test_kinds(spark):
    rows = [(1, [9, 10, 11], [9, 18, 11]), (2, [9, 10, 11], [9, 11]), (3, None, [9]), (4, [9], None), (5, [9, 10], [9, 12]), (6, [], [])]
    table = spark.createDataFrame(rows, "id int, true array<int>, read array<int>")
    got = {r.id: tuple(r.e) for r in table.select("id", alignment.transcription_errors("true", "read").alias("e")).collect()}
    assert got == {1: (1, 1, 0, 0, 0), 2: (1, 0, 0, 1, 0), 3: (1, 0, 0, 0, 1), 4: (1, 0, 0, 1, 0), 5: (1, 0, 1, 0, 0), 6: (0, 0, 0, 0, 0)}
