"""Durations, versions of a title, claims of names, and work in rounds."""

import random
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from neumata.functions import durations
from neumata.operators import corpus, records, versions
from neumata.streaming import rounds


def beats(part):
    value = dict(durations.LETTERS)[part.rstrip(".-")]
    return value * (Fraction(3, 2) if part.endswith(".") else 1)


def test_every_duration_adds_up():
    known = durations.spellings()
    assert known[Fraction(1)] == [""] and known[Fraction(7, 4)] == [".", "s-"] and known[Fraction(3, 8)] == ["s."] and known[Fraction(5, 2)] == [".", "-"]
    rows = durations.table()
    assert [steps for steps, _, _ in rows] == list(range(1, 513))
    for steps, parts, exact in rows:
        total = sum(map(beats, parts))
        assert not exact or total == steps * durations.STEP
        assert not exact or parts[0][-1:] != "-" and all(p.endswith("-") for p in parts[1:])
    assert all(exact for steps, _, exact in rows if steps % 2 == 0 and steps <= 128)
    assert dict((s, p) for s, p, _ in rows)[264] == ["", "s-"] + ["-"] * 7


def test_durations_are_looked_up(spark):
    rows = spark.createDataFrame([(1, 1.5), (2, 0.3), (3, 0.0), (4, 99.0), (5, None), (6, 16.0)], "id int, beats double")
    got = {r.id: (r.parts, r.exact) for r in durations.spelled(spark, rows, F.col("beats")).collect()}
    assert got == {1: (["."], True), 2: ([""], False), 3: ([""], False), 4: ([""], False), 5: ([""], False), 6: (["", *["-"] * 15], True)}


def agreement(a, b):
    if not a or not b:
        return 0.0
    a_, b_ = Counter(a), Counter(b)
    return max(0.0, 1 - sum(((a_ - b_) + (b_ - a_)).values()) / max(len(a), len(b)))


@pytest.mark.parametrize("block", [512, 3])
def test_consensus_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(versions, "BLOCK", block)
    rng = random.Random(1)
    songs = [(k, rng.choice(["hot", "hot", "b", f"only{k}"]), "".join(rng.choices("1234567", k=rng.choice([0, 1, 5, 30]))), 0.02 * (k % 8)) for k in range(60)]
    songs += [(100 + k, "hot", "12345", 0.0) for k in range(20)] + [(200, "b", None, 0.0)]
    table = spark.createDataFrame(songs, "song_id long, title string, digits string, unread double")
    by_title = defaultdict(list)
    for song, title, digits, unread in songs:
        by_title[title].append((song, digits or "", unread))
    expected = {}
    for title, some in by_title.items():
        median = max(1, sorted(len(d) for _, d, _ in some)[len(some) // 2])
        for song, digits, unread in some:
            others = [agreement(digits, d) for s, d, _ in some if s != song]
            cons = sum(others) / len(others) if others else 1.0
            dev = abs(len(digits) - median) / median
            expected[song] = (cons, 0.5 * cons + 0.3 * max(0, 1 - unread / 0.1) + 0.2 * max(0, 1 - dev))
    scores = versions.scored(spark, table)
    got = {r.song_id: (r.cons, r.score) for r in scores.collect()}
    assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k]) for k in got)
    best = {r.title: r.song_id for r in versions.best_of_title(scores).collect()}
    assert best == {t: max((round(expected[s][1], 9), -s) for s, _, _ in some)[1] * -1 for t, some in by_title.items()}


def test_claims(spark):
    rng = random.Random(2)
    old = [(rng.choice(["x", "y", "z", None]), f"old{k:03}") for k in range(90)]
    new = [("x" if k % 3 == 0 else rng.choice(["y", "z", "w", None]), f"new{k:03}") for k in range(90)]
    side = lambda rows: spark.createDataFrame(rows, "digest string, name string").repartition(5)
    expected = {}
    for digest in "xyzw":
        expected |= dict(zip(sorted(n for d, n in new if d == digest), sorted(n for d, n in old if d == digest)))
    assert {r.new_name: r.old_name for r in versions.claims(spark, side(old), side(new)).collect()} == expected
    assert versions.claims(spark, side(old).limit(0), side(new)).count() == 0


def test_numbers_in_ranges_do_not_gather_a_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).select(F.lit("hot").alias("key"), F.concat(F.lit("n"), F.lpad("id", 5, "0")).alias("name"))
        got = versions.numbered_in_ranges(spark, rows, "key", ["name"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.name, r.nth) for r in got) == [(f"n{k:05}", k + 1) for k in range(3000)]


def test_first_of_each(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randint(0, 9), k) for k in range(500)]
    got = records.first_of_each(spark.createDataFrame(rows, "key string, v int, id int"), ["key"], ["v", "id"], 5).collect()
    assert sorted(map(tuple, got)) == sorted(r for key in "ab" for r in sorted(x for x in rows if x[0] == key)[:5])


def test_only_what_changed_is_computed(spark, tmp_path):
    path, taken = str(tmp_path / "kinds"), []

    def compute(rows):
        taken.append(rows)
        return rows.select("page_id", F.length("html").alias("size"))

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "html", "url")
    n = pages.count()
    run = lambda table, version=1: {r.page_id: r["size"] for r in rounds.recomputed(spark, table, "page_id", [F.col("html")], compute, path, version).collect()}
    schema = "page_id long, size int, _mark long, _round long"
    assert run(pages) == {r.page_id: len(r.html) for r in pages.collect()} and rounds.last_round_size(spark, path, schema) == n
    changed = pages.withColumn("html", F.when(F.col("page_id") < 3, F.concat("html", F.lit("!"))).otherwise(F.col("html"))).withColumn("url", F.lit("another"))
    assert run(changed) == {r.page_id: len(r.html) for r in changed.collect()} and rounds.last_round_size(spark, path, schema) == 3
    assert run(changed) == {r.page_id: len(r.html) for r in changed.collect()} and rounds.last_round_size(spark, path, schema) == 3  # nothing new
    assert run(pages.where("page_id <> 7")).keys() == {r.page_id for r in pages.collect()} - {7} and rounds.last_round_size(spark, path, schema) == 3
    run(pages, 2)
    assert rounds.last_round_size(spark, path, schema) == n


def test_rounds_go_on_only_with_what_succeeded(spark, tmp_path):
    path, seen = str(tmp_path / "rounds"), []
    rows = [(k, "abc"[k % 3] if k < 30 else "d", float(k % 7)) for k in range(34)]
    table = spark.createDataFrame(rows, "id long, source string, worth double")
    work = lambda batch: seen.append([(r.id, r.source) for r in batch.collect()])

    def crash():
        raise RuntimeError("between write and commit")

    with pytest.raises(RuntimeError, match="between"):
        rounds.take_round(spark, table, path, 8, work, crash)
    assert rounds.take_round(spark, table, path, 8, work) == 8 and seen[0] == seen[1]  # the same batch again

    def fails(batch):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        rounds.take_round(spark, table, path, 8, fails)
    while rounds.take_round(spark, table, path, 8, work):
        pass
    assert sorted(i for some in seen[1:] for i, _ in some) == list(range(34))
    assert Counter(s for _, s in seen[1]) == Counter({"a": 2, "b": 2, "c": 2, "d": 2})  # sources in turn


def test_a_source_in_debt_goes_first(spark, tmp_path):
    path = str(tmp_path / "debt")
    old = spark.createDataFrame([(k, "a", 1.0) for k in range(6)], "id long, source string, worth double")
    assert rounds.take_round(spark, old, path, 6, lambda batch: None) == 6
    both = old.union(spark.createDataFrame([(100 + k, s, 9.0 if s == "a" else 1.0) for k, s in enumerate("aaaabbbb")], "id long, source string, worth double"))
    assert [r.source for r in rounds.next_batch(spark, both, path, 4).collect()] == ["b"] * 4


def test_numbered_within_still_agrees(spark):
    rows = spark.createDataFrame([("k", v) for v in (5, 1, 9, 3)], "key string, v int")
    assert sorted((r.v, r.nth) for r in corpus.numbered_within(rows, ["key"], "v").collect()) == [(1, 1), (3, 2), (5, 3), (9, 4)]
