"""What showed on larger tables only: ties, hot keys, tables too large to meet pair by pair."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from neumata import plans
from neumata.functions import nearness, runs
from neumata.operators import clones, evaluation, records, search
from neumata.operators.graph import components
from neumata.sources import abc


def test_page_choice_rounds_as_sql_does(spark, tmp_path):
    lines = "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE"
    rows = [(1, 1000, 1, 10.0, 901.5), (1, 1001, 2, 10.0, 902.5), (2, 1000, 1, 10.0, 900.0), (2, 1001, 2, 10.0, 900.5), (3, 1000, 1, 2.5125, 900.0), (4, 900, 1, 2.5125, 901.0), (4, 900, 2, 10.0, 900.0)]
    spark.createDataFrame(rows, lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    got = sorted(tuple(r) for r in plans.QUERIES["page_choice"](spark, str(tmp_path)).collect())
    assert got == sorted(con.sql(plans.SQL["page_choice"]).fetchall()) == [(1, "p1"), (2, "p1"), (4, "p2")]


def test_page_choice_of_equal_files_is_the_portrait(spark):
    pages = [(7, 2, "p2", 400, 101 + 900 * (k % 2), 50, False) for k in range(40)] + [(7, 1, "p1", 400, 900, 10, False)]
    schema = "folder int, number int, name string, width int, height int, size long, second_first boolean"
    for part in (pages, pages[::-1]):
        best = records.chosen_page(spark.createDataFrame(part, schema), "folder").collect()
        assert [tuple(r) for r in best] == [(7, "p2")]


def drawn_songs(seed, n, longest=80):
    rng = random.Random(seed)
    return ["".join(rng.choices("1234567", k=rng.choice([0, 3, 9, 30, longest]))) for _ in range(n)] + [None]


def plain_windows(text, q):
    return [(sum(a != b for a, b in zip(text[i:], q)), i) for i in range(len(text or "") - len(q) + 1)]


@pytest.mark.parametrize("pieces", [(1 << 16, 1 << 18, 1 << 20), (16, 16, 4)])
def test_many_queries_in_many_texts(monkeypatch, pieces):
    for name, size in zip(("PIECE", "SEEDED", "COMPARED"), pieces, strict=True):
        monkeypatch.setattr(nearness, name, size)
    rng = random.Random(3)
    for seed in range(40):
        texts = drawn_songs(seed, rng.randint(1, 20))
        queries = [nearness.Query(k, "".join(rng.choices("1234567", k=rng.choice([5, 9, 11]))).encode(), rng.choice([0, 1, 2, 3, 5])) for k in range(10)]
        found, got = nearness.Texts(texts), {}
        for rows in nearness.near(found, queries):
            for number, text, diff, pos in zip(*(x.tolist() for x in rows), strict=True):
                got[number, text] = min(got.get((number, text), (99, 0)), (diff, pos))
        every = {(q.number, t): min(w) for q in queries for t, text in enumerate(texts) if (w := plain_windows(text, q.code.decode()))}
        assert got == {key: best for key, best in every.items() if best[0] <= queries[key[0]].most}
        for q in queries:
            both = [w for v in (q.code.decode(), q.code.decode()[1:]) for t in texts[1:] for w, _ in plain_windows(t, v)]
            assert found.least([q.code, q.code[1:]], 0) == min(both, default=None)


def test_seeds_of_many_queries_shuffle_no_windows(spark, monkeypatch):
    monkeypatch.setattr(search, "FEW", 3)
    texts = drawn_songs(5, 60)
    songs = spark.createDataFrame(list(enumerate(texts)), "song_id long, digits string")
    asked = [(k, t[2:13]) for k, t in enumerate(texts) if len(t or "") >= 20]
    hits = search.seed_search(songs, spark.createDataFrame(asked, "query_id long, q string"), 11, 1)
    expected = {(i, k, *min(w)) for i, q in asked for k, t in enumerate(texts) if (w := plain_windows(t, q)) and min(w)[0] <= 1}
    assert len(asked) > 9 and {tuple(r) for r in hits.select("query_id", "song_id", "diff", "pos").collect()} == expected
    assert "Join" not in hits._jdf.queryExecution().executedPlan().toString()


def test_nearest_songs_equal_plain_scores(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "FIRST_SONGS", (2, 5))
    monkeypatch.setattr(evaluation, "SCORED", 4)
    texts = drawn_songs(6, 70, 40) + ["1", "2", "1", "1", "12", "12"]
    texts += [t[3:] for t in texts if len(t or "") >= 30][:8]
    rows = [(k * 7 % 101, f"t{k % 4}", t) for k, t in enumerate(texts) if t is not None]
    songs = spark.createDataFrame(rows, "song_id long, title string, digits string")
    asked = [(i, title, t[4:15]) for i, title, t in rows if len(t) >= 30][:10]
    best = evaluation.nearest_songs(songs, spark.createDataFrame(asked, "query_id long, true_title string, q string"), 3)
    got = {(r.scorer, r.query_id, r.place): (r.song_id, r["diff"]) for r in best.collect()}
    expected = {}
    for i, _, q in asked:
        window = sorted((min(w)[0], k) for k, _, t in rows if (w := plain_windows(t, q)))
        exact = sorted((0 if q in t else 1, k) for k, _, t in rows)
        edits = sorted((levenshtein(t, q), k) for k, _, t in rows)
        for scorer, scores in (("window", window), ("exact", exact), ("edits", edits)):
            expected |= {(scorer, i, place): (k, d) for place, (d, k) in enumerate(scores[:3], 1)}
    assert got == expected


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_leaving_out_the_own_song(spark):
    texts = [t for t in drawn_songs(8, 50, 60) if t]
    songs = [(k, f"t{k % 6}", t) for k, t in enumerate(texts)]
    asked = [(k, title, t[1:12]) for k, title, t in songs if len(t) >= 30 and k % 2 == 0]
    frags = spark.createDataFrame(asked, "query_id long, true_title string, q string")
    got = evaluation.nearer_titles(spark.createDataFrame(songs, "song_id long, title string, digits string"), frags, without_own=True)
    expected = {}
    for i, true, q in asked:
        best = {}
        for k, title, t in songs:
            if k != i and (w := plain_windows(t, q)):
                best[title] = min(best.get(title, 99), min(w)[0])
        expected |= {(i, title): d for title, d in best.items() if d <= best.get(true, -1)}
    assert {(r.query_id, r.title): r["diff"] for r in got.collect()} == expected


def clone_songs(seed, n):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("1234567", k=rng.choice([14, 20, 25, 40]))) for _ in range(6)]
    some = lambda: "".join(rng.choices("1234567", k=rng.randint(0, 30)))
    texts = ["".join(some() + rng.choice(passages)[rng.choice([0, 0, 7]) :] for _ in range(rng.randint(0, 3))) + some() for _ in range(n)]
    return list(enumerate([*texts, *texts[:5], None, ""]))


def test_classes_are_connected_without_pairing_crowds(spark, monkeypatch):
    monkeypatch.setattr(clones, "DEALT", 1000)
    monkeypatch.setattr(clones, "CROWD", 7)
    songs = spark.createDataFrame(clone_songs(1, 40), "song_id long, digits string")
    every = {(r.a, r.b) for r in clones.pair_links(spark, songs, 14, 12).collect()}
    few = {(r.a, r.b) for r in clones.linked(spark, songs, 14, 12).collect()}
    classes = lambda pairs: {tuple(r) for r in components(spark, spark.createDataFrame(sorted(pairs), "a long, b long")).collect()}
    assert few <= every and len(few) < len(every) and classes(few) == classes(every)
    passage = "12345671122334455667712"
    rng = random.Random(4)
    crowd = [(k, "".join(rng.choices("1234567", k=40)) + passage * 2) for k in range(60)]
    crowd = spark.createDataFrame(crowd, "song_id long, digits string")
    assert clones.linked(spark, crowd, 14, 12).count() < 2 * 60  # of 60 * 59 / 2 pairs


@pytest.mark.parametrize("followed", [3, 1 << 20])
def test_longest_runs_of_many_pairs(monkeypatch, followed):
    monkeypatch.setattr(runs, "FOLLOWED", followed)
    rng = random.Random(9)
    for _ in range(40):
        signs = rng.choice(["12", "1234567", "abcdefghijklmnop", "1"])
        core = "".join(rng.choices(signs, k=16))
        part = lambda: rng.choice([core[rng.randint(0, 8) : rng.randint(6, 16)], "".join(rng.choices(signs, k=rng.randint(0, 5)))])  # noqa: E731, B023
        a, b = (["".join(part() for _ in range(rng.randint(0, 3))) for _ in range(rng.randint(1, 4))] for _ in "ab")
        pairs = np.array([(i, j) for i in range(len(a)) for j in range(len(b)) if rng.random() < 0.8]).reshape(-1, 2)
        turned = np.array([rng.random() < 0.5 for _ in pairs], bool)
        n, expected = rng.choice([2, 4, 14, 25]), {}
        for k, (i, j) in enumerate(pairs.tolist()):
            best = (0, 0, 0)
            for p in range(len(a[i])):
                for q in range(len(b[j])):
                    size = next((s for s in range(99) if a[i][p + s : p + s + 1] != b[j][q + s : q + s + 1] or p + s >= len(a[i])), 0)
                    best = max(best, (size, -q, -p) if turned[k] else (size, -p, -q))
            if best[0] >= n:
                expected[k] = (best[0], -best[2], -best[1]) if turned[k] else (best[0], -best[1], -best[2])
        assert {r[0]: tuple(r[1:]) for r in runs.longest_runs(a, b, pairs, n, turned).tolist()} == expected
    if followed > 3:  # a text that repeats itself
        found = runs.longest_runs(["1" * 100_000], ["1" * 99_999 + "2"], np.array([(0, 0)]), 14)
        assert found.tolist() == [[0, 99_999, 0, 0]]


@pytest.mark.parametrize("key", ["C", "Em", "G dorian", "Bb"])
def test_notes_are_counted_as_the_events_are(spark, key):
    bodies = ["CDEFGABc | defg ab |\nCC", "^FGF | F _B, B, |\nFB\n=F2 F/ (3FGA [C^Eg]2 E | E", "", "F ^f f\nf F |\nf F", "A>B C- C % F\nK:D\nF C\nw:FACE\nz2 F'' \"Am\" {g}f"]
    tunes = [f"X:1\nM:4/4\nK:{key}\n{body}" for body in bodies] + [None, "FACE"]
    expected = [Counter(e[6:] for e in abc.events(t or "") if e[1] == "note") for t in tunes]
    assert [abc.note_counts(t or "") for t in tunes] == expected and sum(map(len, expected)) > 20
    table = spark.createDataFrame(list(enumerate(tunes)), "id long, tune string")
    got = {tuple(r) for r in abc.counted_notes(table).collect()}
    assert got == {(k, *pitch, n) for k, notes in enumerate(expected) for pitch, n in notes.items()}


def test_unique_windows_of_a_large_group_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(clones, "DEALT", 300)
    rows = [(k, k % 2, t) for k, t in clone_songs(3, 40)]
    songs = spark.createDataFrame(rows, "song_id long, group long, digits string")
    dealt = clones.dealt_windows(songs, 11)
    sizes = dealt.groupBy("part").agg(F.sum(F.length("codes") / 8).alias("n")).collect()
    assert len(sizes) > 5 and max(r.n for r in sizes) < 3 * sum(r.n for r in sizes) / len(sizes)
    own = {k: {t[i : i + 11] for i in range(len(t) - 10)} for k, _, t in rows if t}
    others = lambda k: set().union(*(own[j] for j in own if j != k and j % 2 == k % 2))
    expected = {(k, len(w), len(w - others(k))) for k, w in own.items() if w}
    assert {tuple(r) for r in clones.unique_windows(songs, 11).collect()} == expected
