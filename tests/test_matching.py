"""Containment and similarity joins against all pairs."""

import difflib
import random

import pytest

from neumata.operators import matching


def random_texts(seed, n, signs="abcde", longest=12):
    rng = random.Random(seed)
    out = ["", None] + ["".join(rng.choices(signs, k=rng.randint(1, longest))) for _ in range(n)]
    return out + [x + "".join(rng.choices(signs, k=3)) for x in out[2 : n // 2]] + out[5:9]


def table(spark, values, column):
    return spark.createDataFrame([(v, 1) for v in values], f"{column} string, other int").repartition(3)


@pytest.mark.parametrize("q", [1, 2, 4])
@pytest.mark.parametrize("signs", ["ab", "abcdé春天", "春夏秋冬的歌"])
def test_holding(spark, q, signs):
    texts, needles = random_texts(q, 40, signs), random_texts(q + 9, 60, signs, 5)
    got = [tuple(r) for r in matching.holding(table(spark, texts, "text"), table(spark, needles, "needle"), q).collect()]
    assert sorted(got) == sorted({(t, n) for t in texts for n in needles if t is not None and n and n in t})


def test_holding_without_rows(spark):
    none, some = table(spark, [], "text"), table(spark, ["ab"], "needle")
    assert matching.holding(none, some).count() == matching.holding(table(spark, ["ab"], "text"), table(spark, [None, ""], "needle")).count() == 0


def same_title(a, b):
    short, long_ = sorted((a, b), key=len)
    return a == b or (short in long_ and len(short) >= 4 and 2 * len(short) >= len(long_))


@pytest.mark.parametrize("head", [0, 2])
def test_same_titles(spark, head):
    have, want = random_texts(1, 60, "ab", 9), random_texts(2, 60, "ab", 9)
    got = [tuple(r) for r in matching.same_titles(table(spark, have, "title"), table(spark, want, "wanted"), head).collect()]
    pairs = {(a, b) for a in have for b in want if a is not None and b is not None}
    assert sorted(got) == sorted((a, b) for a, b in pairs if same_title(a, b) and a[:head] == b[:head])


def similarity(wanted, title):
    ratio = difflib.SequenceMatcher(None, title, wanted, autojunk=False).ratio()
    held = min(len(wanted), len(title)) >= 3 and (wanted in title or title in wanted)
    return max(ratio, 0.75) if held else ratio


@pytest.mark.parametrize("least", [0.5, 0.6, 0.9])
@pytest.mark.parametrize("signs", ["abc", "abcdefghij春天"])
def test_similar(spark, least, signs):
    have, want = random_texts(3, 50, signs), random_texts(4, 30, signs)
    got = {(r.wanted, r.title): r.ratio for r in matching.similar(table(spark, have, "title"), table(spark, want, "wanted"), least).collect()}
    expected = {(w, t): similarity(w, t) for w in want for t in have if w and t and similarity(w, t) >= least}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-12 for k in got)
    best = {r.wanted: r.title for r in matching.most_similar(table(spark, have, "title"), table(spark, want, "wanted"), least).collect()}
    assert best == {w: min((-r, t) for (x, t), r in expected.items() if x == w)[1] for w in {w for w, _ in expected}}


def test_spelled(spark):
    known = spark.createDataFrame([("abba", "ABBA"), ("the who", "The Who"), ("u2", "U2"), ("邓丽君", "邓丽君")], "key string, spelling string")
    names = spark.createDataFrame([("Abba", 1), ("Abba", 2), ("best of ABBA and U2", 3), ("怀旧经典 邓丽君", 4), ("nobody", 5), (None, 6), ("", 7)], "name string, n int")
    got = {r.n: r.artist for r in matching.spelled(names, known).collect()}
    assert got == {1: "ABBA", 2: "ABBA", 3: "ABBA", 4: "邓丽君", 5: None, 6: None, 7: None}


def test_a_word_that_many_titles_have_is_no_block(spark):
    """The piece that all titles have finds nobody: each needle is looked for by its rarest."""
    titles = [f"love song number {k}" for k in range(2000)]
    got = matching.holding(table(spark, titles, "text"), table(spark, [f"number {k}" for k in range(1990, 2000)], "needle"))
    assert got.count() == 10
