"""The ten operators against plain Python, on small tables with every odd case."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from oracle import mismatch
from pyspark.sql import functions as F

import __spark_entry__ as entry
from neumata.llm import classifier, licences, mixing, packing, quality_rules, registry, secrets, sharding, simhash, substrings, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket string, n long"
BLANK = re.compile("[^\x20\x09-\x0d]+")


def words_of(text):
    return BLANK.findall(text or "")


def odd_rows():
    """Nulls in every column, empty and long texts, ties, exact and near copies, repeated rows, columns with clashing names."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)] + ["straße", "Été", "x y", "password", "日本"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    passage, base = text(60), text(120)
    texts = [None, "", "  \n\t ", "one", "one two", base, base, base + " end", base.replace("w1 ", "w2 ", 1), text(30) + " " + passage, passage + "\n" + text(25)]
    texts += ["a line that repeats\n" * 8, "!!! ??? ### $$$ %%% &&&", "é" * 500, "x " * 3000, text(9000), passage, "word " * 19, "word " * 20, "word " * 25]
    texts += [text(rng.randint(1, 60)) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 3}", None, "b", 1) for i, t in enumerate(texts)]
    rows += [(1000, base, None, None, 3, None, None), (1001, None, None, None, None, None, None), (5, base, "en", "s2", None, "b", 1)]
    rows += [(7, "another text under the same id, " + text(12), "en", "s1", None, None, 2), (None, text(15), "en", "s0", 1, "b", 1), (None, text(15), "en", "s0", 1, "b", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_queries_agree_with_sql(spark, name):
    assert mismatch(spark, name, "/root/testdata/sf0.001", entry) == ""


def test_empty_tables(spark, none):
    no_vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    results = [
        mixing.mix(spark, none), mixing.mixed_documents(spark, none), quality_rules.judged(none), quality_rules.keep_good(none),
        packing.packed(packing.tokenised(none), 0), classifier.scored(spark, none, no_labels), licences.licensed(none),
        vectors.near_vectors(spark, no_vectors), secrets.counts(none), secrets.redacted(none), substrings.deduplicated(spark, none),
        sharding.sharded(spark, none), simhash.near_duplicates(spark, none), simhash.keep_one(spark, none),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def plain_mix(rows, weights=(5, 2, 1), most=3, seed=1):
    """copies -> number of rows per (doc_id, source, size), by queueing every row by itself."""
    sized = [(r[0], r[3], len(words_of(r[1]))) for r in rows]
    total = Counter()
    for _, source, size in sized:
        total[source] += size
    names = sorted(total, key=lambda x: (x is None, x or ""))
    weight = {x: weights[k % len(weights)] for k, x in enumerate(names)}
    free, budget, target = list(names), float(sum(total.values())), {}
    while free:
        level = budget / sum(weight[x] for x in free)
        over = [x for x in free if level * weight[x] > most * total[x]]
        if not over:
            target |= {x: level * weight[x] for x in free}
            break
        for x in over:
            target[x] = float(most * total[x])
            budget -= target[x]
            free.remove(x)
    key = lambda r: (hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[2])
    turns = []
    for rank, x in enumerate(names):
        emitted = 0
        queue = sorted((r for r in sized if r[1] == x and r[2]), key=key)
        for epoch in range(most if queue else 0):
            for row in queue:
                if emitted < target[x]:
                    turns.append(((emitted + row[2]) / target[x], rank, epoch, key(row), row))
                emitted += row[2]
    used, copies = 0, Counter()
    for *_, row in sorted(turns, key=lambda t: t[:4]):
        used += row[2]
        if used > sum(total.values()):
            break
        copies[row] += 1
    out = Counter()
    for row, n in Counter(sized).items():
        full, more = divmod(copies[row], n)
        out[(*row, full)] += n - more
        if more:
            out[(*row, full + 1)] += more
    return +out, target


HOT = [(1, "a b c", "en", "a", 1, "b", 1)] * 1000 + [(100 + k, "d e", "en", "b", 1, "b", 1) for k in range(50)]
NAMELESS = [(None, f"w{k % 3} x y " + "z " * (k % 4), "en", "s", 1, "b", 1) for k in range(90)] + [(k, "t u v w", "en", None, 1, "b", 1) for k in range(40)]


@pytest.mark.parametrize("rows", [odd_rows(), HOT, NAMELESS, HOT[:7], [(1, None, None, None, None, None, None)]], ids=["odd", "hot", "nameless", "one entry", "no words"])
def test_mixing(spark, rows):
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    expected, target = plain_mix(rows)
    got = mixing.mix(spark, table).collect()
    found = Counter()
    for r in got:
        found[(r.doc_id, r.source, r.size, r.copies)] += r.n_rows
        assert r.target <= 3 * r.source_size and abs(r.target - target[r.source]) <= 1e-6 * max(1, target[r.source])
    assert found == expected
    mixed = mixing.mixed_documents(spark, table)
    assert mixed.columns == table.columns
    taken = Counter((r.doc_id, r.source, len(words_of(r.text))) for r in mixed.collect())
    times = Counter()
    for (*entry, copies), n in expected.items():
        times[tuple(entry)] += copies * n
    assert taken == +times


def test_mixing_keeps_clashing_columns(spark):
    rows = [(k, f"word{k} and more", "s", f"row {k}", k, k) for k in range(9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, row string, size int, mix_size int")
    got = mixing.mixed_documents(spark, table)
    assert got.columns == table.columns and {tuple(r) for r in got.collect()} <= set(rows)


def plain_measures(text):
    words, text = words_of(text), text or ""
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, docs):
    got = Counter(tuple(r[:7]) for r in quality_rules.judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    expected = Counter()
    for doc_id, text, *_ in odd_rows():
        m = plain_measures(text)
        expected[(doc_id, *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
    assert got == expected
    kept = quality_rules.judged(docs).where("kept").count()
    assert quality_rules.keep_good(docs).count() == kept and quality_rules.keep_good(docs).columns == docs.columns


def test_cascade_order_by_worth(spark, docs, monkeypatch):
    """Costs are of measures, paid once; rules nearly as good as the best go as listed; reruns with the same costs agree."""
    costs = {"n_words": 0.02, "word_chars": 0.1, "n_symbols": 0.4, "n_marks": 0.4, "n_lines": 0.1, "n_dup_lines": 0.2, "n_repeat_words": 2.0}
    monkeypatch.setattr(quality_rules, "measured_costs", lambda sample, names: {n: costs[n] for n in names})
    rows = [(k, "one two three", None, None, None, None, 1) for k in range(40)] + [(100 + k, "ab " * 60, None, None, None, None, 1) for k in range(200)]
    table = spark.createDataFrame(rows, DOCS)
    runs = [quality_rules.measured_cascade(table) for _ in range(2)]
    assert [[r.name for r, _, _ in run] for run in runs][0] == [r.name for r, _, _ in runs[1]]
    order = {rule.name: (k, cost, share) for k, (rule, cost, share) in enumerate(runs[0])}
    assert order["few_words"][0] == 0 and order["repeats"][0] == 1 and abs(order["repeats"][1] - 2.0) < 1e-9  # n_words is paid already
    assert abs(order["repeats"][2] - 1.0) < 1e-9


def test_cascade_order_changes_no_verdict(docs):
    a = quality_rules.judged(docs).select("doc_id", "kept").collect()
    b = quality_rules.judged(docs, tuple(reversed(quality_rules.RULES))).select("doc_id", "kept").collect()
    assert Counter(map(tuple, a)) == Counter(map(tuple, b))


def test_cascade_takes_the_best_rule_left_over(docs):
    order = quality_rules.measured_cascade(docs)
    rows = [plain_measures(r[1]) for r in odd_rows() if r[0] is not None or r[1] is not None]
    assert sorted(r.name for r, _, _ in order) == sorted(r.name for r in quality_rules.RULES)
    assert all(cost >= quality_rules.LEAST_COST and 0 <= share <= 1 for _, cost, share in order)
    few = next(share for rule, _, share in order[:1] if rule.name == "few_words") if order[0][0].name == "few_words" else None
    assert few is None or abs(few - sum(m[0] < 10 for m in rows) / len(rows)) < 0.05
    judged = quality_rules.judged(docs).collect()
    names = [r.name for r, _, _ in order]
    assert all((r.rejected_by is None) == r.kept and (r.kept or r.rejected_by in names) for r in judged)


def test_packing_round_trip(spark, docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    some = docs.where("doc_id IS NOT NULL").unionByName(spark.createDataFrame([(2000, "a <|endoftext|> b", "en", "s0", 1, "", 1)], DOCS)).dropDuplicates(["doc_id"])
    rows = packing.packed(packing.tokenised(some, ("ids", "ids_crc32")), some.count()).collect()
    texts = {r.doc_id: r.text for r in some.collect()}
    ids, bins = defaultdict(list), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(ids[r.doc_id]) and r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        ids[r.doc_id] += r.ids
        bins[r.sequence_id].append((r.offset, r.length))
    assert dict(ids) == {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(map(len, ids.values())) // 2048) + 2


def test_packing_reads_any_text(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    texts = [" " * 1_000_000, "a" * 1_000_000, "\n" * 1_000_000, "x " + "\t" * 700_000 + " y", "é" * 100_000]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = defaultdict(list)
    for r in sorted(packing.packed(packing.tokenised(table), len(texts)).collect(), key=lambda r: (r.doc_id, r.piece)):
        ids[r.doc_id] += r.ids
    assert dict(ids) == {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}


def plain_sum_of_squares(lengths, capacity):
    """Every open bin's gap is tried and the squares are summed anew."""
    gaps, bins = [], []
    for length in lengths:
        choices = []
        for gap in sorted({g for g in gaps if g >= length}):
            after = list(gaps)
            after.remove(gap)
            after.append(gap - length)
            choices.append((sum(n * n for g, n in Counter(after).items() if g), gap))
        if choices:
            gap = min(choices)[1]
            at = max(k for k, g in enumerate(gaps) if g == gap)
        else:
            gaps.append(capacity)
            at = len(gaps) - 1
        gaps[at] -= length
        bins.append(at)
    return gaps


def test_packing_takes_the_least_sum_of_squares():
    for seed in range(6):
        lengths = np.sort(np.random.default_rng(seed).integers(1, 40, 120))[::-1]
        bins, offsets = packing.sum_of_squares(lengths, 40)
        fill = np.bincount(bins, weights=lengths)
        assert sorted(40 - fill) == sorted(plain_sum_of_squares(lengths, 40)) and (offsets + lengths <= 40).all()


def test_packing_is_near_the_bound():
    lengths = np.random.default_rng(3).integers(1, 2048, 6000)
    bins, offsets = packing.sum_of_squares(lengths, 2048)
    assert bins.max() + 1 <= 1.02 * -(-lengths.sum() // 2048) and (offsets + lengths <= 2048).all()


def test_packing_refuses_its_own_columns(spark):
    with pytest.raises(ValueError, match="block"):
        packing.packed(spark.createDataFrame([], "doc_id long, piece int, start long, length long, block int"), 0)


def test_classifier(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.5
        rows.append((i, " ".join(rng.choices([f"word{k}." for k in range(300)] if good else ["zz", "###", "ZZ!"], k=rng.randint(20, 60)))))
        labels.append((i, int(good), 0))
    rows += [(9001, None), (9002, "")]
    got = classifier.scored(spark, spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (1, None, None)], "doc_id long, quality int, toxic int")).collect()
    truth = {i: y for i, y, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 602 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_classifier_is_ridge_and_isotonic(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((700, 5))
    y = (x[:, 0] + 0.3 * rng.standard_normal(700) > 0).astype(float)
    fold = rng.integers(1, 5, 700)
    table = spark.createDataFrame([(r.tolist(), float(t), int(f)) for r, t, f in zip(x, y, fold)], "x array<double>, y double, fold int").repartition(7)
    model = classifier.fit(table)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.std, x.std(0))
    some = fold != classifier.CALIBRATION
    z = model.features(x[some])
    penalty = np.diag([classifier.RIDGE * some.sum()] * classifier.FEATURES_D + [classifier.RIDGE * some.sum() * 1e-9]) + 1e-9 * np.eye(z.shape[1])
    assert np.allclose(model.ridge, np.linalg.solve(z.T @ z + penalty, z.T @ y[some]), atol=1e-6)
    bins = np.round(model.raw(x[~some]) * classifier.BINS)
    at = np.unique(bins)
    mean, n = np.array([y[~some][bins == b].mean() for b in at]), np.array([(bins == b).sum() for b in at])
    best = [max(min(np.average(mean[i : j + 1], weights=n[i : j + 1]) for j in range(k, len(at))) for i in range(k + 1)) for k in range(len(at))]
    assert np.allclose(np.interp(at / classifier.BINS, *model.curve), best)  # the min-max form of isotonic regression


def test_classifier_odd_rows(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(3, None, 1), (4, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = classifier.scored(spark, docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 5}) == 1 and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}


def wrapped(text, leader="", width=76):
    """The paragraphs of a text wrapped anew, each line with a comment sign."""
    import textwrap

    return "\n".join((leader + line).rstrip() for part in text.split("\n\n") for line in [*textwrap.wrap(part, width), ""])


def test_licences(spark):
    from neumata.llm.licence_texts import TEXTS

    shapes = (lambda t: wrapped(t), lambda t: wrapped(t, " * "), lambda t: wrapped(t, "// ", 70), lambda t: wrapped(t, "# ", 60), lambda t: "Copyright (c) 2020 A. Person\n\n" + " ".join(t.split()))
    rows, expected = [], []
    for name, (text, _) in TEXTS.items():
        for shape in shapes:
            rows.append(shape(text))
            expected.append([name])
    bsd = TEXTS["BSD-3-Clause"][0].replace("the copyright holder nor", "Acme Widgets, Inc. nor").replace("THE COPYRIGHT HOLDER OR CONTRIBUTORS BE", "ACME BE")
    rows += [wrapped(bsd, " * "), "Some prose without an end\nReleased under the MIT License\nmore prose", "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: MIT",
             "// SPDX-License-Identifier: GPL-3.0-only\nint x;", "This work is licensed under the GNU General Public License, version 3.", "An unknown licence applies here. All rights reserved.", "Licensed under CC BY-NC 4.0.\nNext",
             wrapped(TEXTS["MIT"][0]) + "\n\n" + wrapped(TEXTS["Apache-2.0"][0], "# "), None, "", "a b " * 50_000 + "\nReleased under the MIT License.", "x" * 10]
    expected += [["BSD-3-Clause"], ["MIT"], ["Apache-2.0"], ["MIT"], ["GPL-3.0-only"], ["GPL-3.0"], ["proprietary"], ["CC-BY-NC-4.0"], ["Apache-2.0", "MIT"], [], [], ["MIT"], []]
    table = [(i, t, "clash", 1) for i, t in enumerate(rows)]
    docs_ = spark.createDataFrame([*table, table[0], (None, "Released under the MIT License.", None, None)], "doc_id long, text string, licences string, found int").repartition(4)
    got = licences.licensed(docs_).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows) + 2 and by_id[None].licences == ["MIT"]
    assert [by_id[i].licences for i in range(len(rows))] == expected
    assert by_id[expected.index(["proprietary"])].n_unknown == 1
    python = [licences.cut(t or "") for t in rows]
    sentences = {r.doc_id: r.s for r in docs_.select("doc_id", licences.sentences(F.coalesce("text", F.lit(""))).alias("s")).collect()}
    plain = [i for i in range(len(TEXTS) * len(shapes)) if expected[i] != ["EPL-2.0"]]  # of which a wrapped line is a statement by itself
    assert [sentences[i] for i in plain] == [python[i] for i in plain]


def plain_licences(text):
    """sentence_ids of a text: a line that is a known sentence stands apart, then the text is cut and looked up."""
    for step in licences.STEPS:
        text = licences._python(*step, text)
    lines = [f"\n{x}\n" if licences.normal(x) in licences.known() else x for x in text.split("\n")]
    found = (licences.known().get(licences.normal(s)) for s in re.split(licences.BREAK, "\n".join(lines)))
    return "".join(f"<{i}>" for i in found if i)


def test_every_known_sentence_is_found_however_it_is_wrapped(spark):
    import duckdb
    import pandas as pd
    from neumata.llm.licence_texts import IDENTIFIERS, NAMES, RESERVED, TEXTS

    raw = []
    for text, _ in TEXTS.values():
        for step in licences.STEPS:
            text = licences._python(*step, text)
        raw += [" ".join(s.split()) for s in re.split(licences.BREAK, text) if s.strip()]
    raw += [f"{lead} the {name}." for name in NAMES for lead in ("Released under", "This file is licensed under the terms of", "Available under", "The code is provided under")]
    raw += [f"SPDX-License-Identifier: {name}" for name in [*TEXTS, *NAMES.values(), *IDENTIFIERS]] + [f"{s}." for s in RESERVED]
    raw += [s.replace("the copyright holder", "Acme, Inc.").replace("THE COPYRIGHT HOLDER OR CONTRIBUTORS", "ACME").replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "ACME") for s in raw if "copyright holder" in s.lower()]
    blanks = ("\n", "  ", " \n ", "\n * ", "\n\t", "\n# ", "\ndnl ", "\r\n")
    texts = sorted({re.sub(" +", blank, s) for s in raw for blank in blanks} | {x for s in raw for x in (s, s.upper(), s.lower())})
    texts += [f"Some words before. {s}\n\nAnd after it." for s in raw]
    table = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    got = {r.doc_id: (r.sentence_ids, r.n_unknown, ",".join(r.licences)) for r in licences.licensed(spark.createDataFrame(table)).collect()}
    assert {i: g[0] for i, g in got.items()} == {i: plain_licences(t) for i, t in enumerate(texts)}
    con = duckdb.connect()
    con.register("documents", table)
    assert got == {i: (ids, n, names) for i, ids, n, names in con.sql(f"SELECT doc_id, sentence_ids, n_unknown, licences FROM ({licences.sql()})").fetchall()}
    ids = {i for g in got.values() for i in re.findall("<([^>]*)>", g[0])}
    assert ids == set(licences.known().values())


def test_what_a_known_sentence_must_hold(spark):
    samples = ["Released\nunder the MIT.", "This notice may not be removed or altered from any source distribution.", "An odd LICENCE.", "no such thing", "", "Copyright"]
    table = spark.createDataFrame(list(enumerate(samples)), "doc_id long, text string")
    assert [r.s for r in table.orderBy("doc_id").select(licences.speaks(F.col("text")).alias("s")).collect()] == [True, True, True, False, False, True]
    assert all(any(w in s for w in licences.spoken()) for s in licences.known())


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + rng.standard_normal(16) * 0.12).astype(np.float32).tolist(), 0) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(300)]
    rows += [(5000, None, 0), (5001, [0.0] * 16, 0), (5002, [float("nan")] + [1.0] * 15, 0), (5003, [None] + [1.0] * 15, 0), (5004, [float("inf")] * 16, 0), (5005, [], 0)]
    got = {r.vec_id: r for r in vectors.near_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    good = [(i, np.array(v, float)) for i, v, _ in rows if i < 5000]
    x = np.stack([v for _, v in good])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    links = near.sum(1) - 1
    assert sum(got[i].n_links for i, _ in good) >= 0.9 * links.sum()
    assert all(got[i].n_links <= n for (i, _), n in zip(good, links, strict=True))
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(5000, 5006))


def plain_links(rows, least=0.95):
    x = np.stack([np.array(v, float) for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= least
    label, ids = np.arange(len(rows)), [i for i, _ in rows]
    while True:
        low = np.array([label[n].min() for n in near])
        if (low == label).all():
            break
        label = low
    name = {k: min(ids[i] for i in range(len(rows)) if label[i] == k) for k in set(label)}
    return Counter((i, int(n.sum()) - 1, name[k]) for i, n, k in zip(ids, near, label))


def test_vectors_of_one_id(spark):
    rows = [(7, [1.0, 0.0]), (7, [0.0, 1.0]), (8, [1.0, 0.01]), (9, [0.01, 1.0]), (9, [0.01, 1.0]), (3, [-1.0, 0.1])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows] + [(None, [1.0, 0.0], 1, 2)], "vec_id long, embedding array<float>, class_id int, n int")
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(spark, table).collect())
    assert got == plain_links(rows) + Counter([(None, 0, None)])


@pytest.mark.parametrize("n", [300, 1500])
def test_vectors_exact_and_in_two_levels(spark, monkeypatch, n):
    monkeypatch.setattr(vectors, "CELL", 40)
    monkeypatch.setattr(vectors, "HOME_BLOCK", 16)
    monkeypatch.setattr(vectors, "VISIT_BLOCK", 64)
    rng = np.random.default_rng(n)
    centres = rng.standard_normal((n // 10, 12))
    rows = [(i, (centres[i % len(centres)] + rng.standard_normal(12) * 0.22).astype(np.float32).tolist()) for i in range(n)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    expected = plain_links(rows)
    result = lambda **o: Counter((r.vec_id, r.n_links, r.component_id) for r in vectors.near_vectors(spark, table, **o).collect())
    assert result(exact=True) == expected
    links = lambda c: sum(k[1] * m for k, m in c.items())
    one = links(result())
    monkeypatch.setattr(vectors, "MOST_CELLS", 6)
    two = links(result())
    assert 0.9 * links(expected) <= one <= links(expected) and 0.9 * links(expected) <= two <= links(expected)


def plain_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(spark, docs):
    texts = ['é💡 password = "hunter2hunter" then API_KEY:abc', "AKIA" + "A1" * 8 + " token=short", "0123456789abcdef01234567 deadbeef", "k 9fGh2LmQ8xZr4TvB7nWc6YpD", None, ""]
    for rows in (list(enumerate(texts)), [(r[0], r[1]) for r in odd_rows()]):
        got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.counts(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        expected = Counter()
        for i, text in rows:
            found = plain_secrets(text)
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in found).encode()).hexdigest()
            expected[(i, *(sum(f[1] == k for f in found) for k in range(3)), digest)] += 1
        assert got == expected
    spans = {r.doc_id: r.spans for r in secrets.counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert spans[3] == "entropy_base64:2:26"
    red = {r.doc_id: r.text for r in secrets.redacted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert "hunter2" not in red[0] and red[0].startswith("é💡 password") and red[4] is None


def test_substrings(spark, docs, monkeypatch):
    def order(row):  # null ids first; under one id by a hash of the text
        h = 42 if row[1] is None else xxhash.xxh64_intdigest(row[1].encode(), seed=42)
        return row[0] is not None, row[0] or 0, h - (1 << 64) if h >> 63 else h

    rows = [(r[0], r[1]) for r in odd_rows()]
    expected, seen = {}, {}
    for unit in sorted(set(rows), key=order):
        words = words_of(unit[1])
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            if seen.setdefault(tuple(words[k : k + 20]), (unit, k)) != (unit, k):
                gone[k : k + 20] = [True] * 20
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        expected[unit] = (unit[0], len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    for crowd in (substrings.CROWD, 1):
        monkeypatch.setattr(substrings, "CROWD", crowd)
        assert Counter(map(tuple, substrings.deduplicated(spark, docs).collect())) == Counter(expected[r] for r in rows)


def test_places_of_a_crowded_anchor_are_dealt_over_salts(spark, monkeypatch):
    """The salt is part of the key of every exchange of places, so that one anchor does not fill one task."""
    from neumata.llm.shared import Scratch

    monkeypatch.setattr(substrings, "CROWD", 8)
    monkeypatch.setattr(substrings, "SMALL_CROWDS", 10_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    passage = " ".join(f"p{k}" for k in range(24))
    texts = spark.createDataFrame([(k, 0, f"own{k} {passage} end{k}".encode()) for k in range(400)], "unit_id long, text_hash long, text binary").repartition(8)
    spans = substrings._repeated_spans(Scratch(spark, "spans"), texts, 20)
    by_group = spans.groupBy("gram", "salt").count().collect()
    grams = Counter(r.gram for r in by_group)
    assert max(r["count"] for r in by_group) <= 40 and max(grams.values()) >= 25
    plan = spans._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    places = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "gram" in line]
    assert places and all("salt" in line for line in places)


def test_sharding_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK", 16)
    rows = [(1, "same")] * 500 + [(None, "nameless")] * 300 + [(None, f"t{k}") for k in range(50)] + [(k, None) for k in range(30)]
    got = sharding.sharded(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(r.number for r in got) == list(range(len(rows)))
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((i, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_sharding(spark, docs):
    rows = sharding.sharded(spark, docs, 8, seed=3).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    n = len(rows)
    assert all(sharding.row_of(np.array([r.shard]), np.array([r.slot]), n, 8, 3)[0] == r.number for r in rows)
    digest = lambda t: (len(t) + 1, zlib.crc32(t))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((r[0], *digest((r[1] or "").encode())) for r in odd_rows())


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_permutation(n):
    assert sorted(sharding.permute(np.arange(n), n, 9)) == list(range(n))
    assert (sharding.permute(sharding.permute(np.arange(n), n, 9), n, 9, back=True) == np.arange(n)).all()


def plain_entropy_spans(text):
    """Runs of each character class, parted at what is allowed, with a window over the threshold, counted anew at each place."""
    out = []
    for kind, (pattern, least) in secrets.CLASSES.items():
        beside = secrets.BESIDE if kind == "entropy_hex" else f"{secrets.CLASSES['entropy_hex'][0]}|{secrets.BESIDE}"
        for m in re.finditer(pattern, text or ""):
            if re.search(secrets.ALLOWED, m[0]):
                continue
            peaks = []
            for part in re.split(beside, m[0]):
                for k in range(len(part) - 19):
                    counts = Counter(part[k : k + 20]).values()
                    peaks.append(round(-sum(c / 20 * np.log2(c / 20) for c in counts), 9))
            if peaks and max(peaks) >= least:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return sorted(out)


def test_entropy_spans_and_redaction_of_many(spark, monkeypatch):
    rng = random.Random(11)
    texts = []
    for n in (0, 1, 2, 20, 21, 40, 200, 3000):
        for symbols in (string.hexdigits, string.ascii_letters + string.digits + "+/_-", "ab", "0123456789"):
            texts.append("é " + "".join(rng.choices(symbols, k=n)) + " end=x")
    texts += [" ".join("".join(rng.choices("0123456789abcdef", k=30)) for _ in range(300)), "password: hunter22 " * 200, "token=abcdefgh," * 150 + "api_key='zzzzzzzz'"]
    table = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, secret_spans string")
    for chunk, segment in ((secrets.CHUNK, secrets.SEGMENT), (3, 32)):
        monkeypatch.setattr(secrets, "CHUNK", chunk)
        monkeypatch.setattr(secrets, "SEGMENT", segment)
        got = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("entropy")] for r in secrets.counts(table).collect()}
        assert {i: sorted(s) for i, s in got.items()} == {i: plain_entropy_spans(t) for i, t in enumerate(texts)}
        red = {r.doc_id: (r.text, r.secret_spans) for r in secrets.redacted(table).collect()}
        spans = {r.doc_id: r.s for r in table.select("doc_id", secrets.find_spans(F.col("text")).alias("s")).collect()}
        for i, text in enumerate(texts):
            out, at = "", 0
            for start, end in sorted((s.secret_start, s.end) for s in spans[i]):
                out += text[at:start] + ("[secret]" if start >= at else "")
                at = max(at, end)
            assert red[i] == (out + text[at:], "kept")


def test_secrets_beside_words_and_signs(spark):
    rng = random.Random(3)
    key = lambda symbols, n: "".join(rng.choices(symbols, k=n))
    b64, letters, upper_hex = string.ascii_letters + string.digits, string.ascii_letters, "0123456789ABCDEF"
    found = [before + key(upper_hex, 32) for before in ("AUTH=", "key-", "id_") for _ in range(20)]
    found += [before + key(b64, 24) for before in ("/v1/sample/", "example_", "a=b=", "Some-Plain-Word/") for _ in range(5)]
    found += [key(letters, n) for n in (24, 32, 40) for _ in range(5)] + [key(b64, 22) + "=="]
    clean = ["123e4567-e89b-42d3-a456-426614174000", "getting-started/with-the-quick-brown-Fox_guide12", "placeholder-changeme-example", "=" * 40, "qwerty" * 5, "/usr/share/dictionary/english/wordlist"]
    texts = [f"see {x} there" for x in found + clean]
    rows = secrets.redacted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    missed = [t for t, r in zip(texts, rows, strict=True) if r.text == t]
    assert missed == texts[len(found) :]
    assert not any(x[-20:] in r.text for x, r in zip(found, rows, strict=False))


def test_windows_of_secrets_stand_in_the_text(spark):
    rng = random.Random(8)
    key = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    texts = ["aB3dE5fG7h-example-kL9mN1pQ2r", "aB3dE5fG7h kL9mN1pQ2r", "aB3dE5fG7h-kL9mN1pQ2r", f"{key(24)}-example-{key(5)}", f"{key(5)}_placeholder_{key(5)}-word-{key(26)}"]
    got = [r.spans for r in secrets.counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert [bool(s) for s in got] == [False, False, True, True, True]
    assert [s.split(",") if s else [] for s in got] == [plain_entropy_spans(t) for t in texts]


def plain_fingerprint(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, tau=2):
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if label[b] < label[a] and (prints[a] ^ prints[b]).bit_count() <= tau:
                    label[a], changed = label[b], True
    return label


def test_simhash(spark, docs):
    rows = [(r[0], plain_fingerprint(r[1])) for r in odd_rows()]
    label = plain_components({p: p for _, p in rows})
    name = {}
    for i, p in rows:
        name[label[p]] = min((x for x in (name.get(label[p]), i) if x is not None), default=None)
    got = Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(spark, docs).collect())
    assert got == Counter((i, p, name[label[p]]) for i, p in rows)
    kept = simhash.keep_one(spark, docs).collect()
    assert sorted(label[plain_fingerprint(r.text)] for r in kept) == sorted(set(label.values()))
    assert all(r.doc_id == name[label[plain_fingerprint(r.text)]] for r in kept)


def test_keep_one_row_of_each_component(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcd")
    rows = [(None, a, "x"), (None, b, "x"), (None, b, "x"), (1, c, "y"), (2, c, "y"), (2, d, "y"), (2, d, "z"), (None, d, "a"), (None, None, None)]
    results = []
    for seed in range(2):
        shuffled = random.Random(seed).sample(rows, len(rows))
        results.append(simhash.keep_one(spark, spark.createDataFrame(shuffled, "doc_id long, text string, source string").repartition(3)).collect())
        assert sorted((r[:2] for r in results[-1]), key=repr) == sorted([(None, a), (None, b), (1, c), (2, d), (None, None)], key=repr)
    assert set(results[0]) == set(results[1])


@pytest.mark.parametrize(("bucket", "tau"), [(256, 2), (4, 2), (256, 1), (4, 1), (4, 0), (256, 3), (4, 3)])
def test_fingerprint_links(spark, monkeypatch, bucket, tau):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(2)
    prints = []
    for _ in range(15):
        base = rng.getrandbits(64)
        prints += [base, *(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(8)), base ^ 1, base ^ (7 << 9)]
    prints = {i: p for i, p in enumerate(sorted(set(prints)))}
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    from neumata.llm.components import components

    edges = simhash.near_edges(spark, spark.createDataFrame([(signed(p),) for p in prints.values()], "fp long"), tau)
    named = {r.node: r.component for r in components(spark, edges).collect()}
    label = plain_components(prints, tau)
    groups = lambda key: {frozenset(i for i in prints if key(i) == k) for k in map(key, prints)}
    assert groups(lambda i: named.get(signed(prints[i]), signed(prints[i]))) == groups(lambda i: label[i])


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from public_tokenizers import path
    from tokenizers import Tokenizer

    key = "k 9fGh2LmQ8xZr4TvB7nWc6YpD and password: hunter22"
    rows = [r[:5] for r in odd_rows()] + [(3000, f"a clean text of its own that tells the {key} in between", "en", "s1", None)]
    rows += [(3001 + k, " ".join(f"q{k}w{j}" for j in range(15 + k)), "en", f"s{k % 4}", 7) for k in range(30)] + [(3100, "x" + " " * 1_000_000 + " ".join(f"y{j}" for j in range(20)), "en", "s2", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = read, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == read.columns
        kept.append([tuple(r) for r in docs.collect()])

    def good(text):
        n, chars, symbols, dup, repeat = plain_measures(text)
        lines, marks = [x for x in (text or "").split("\n") if BLANK.search(x)], len(re.findall("[!?]", text or ""))
        return n >= 10 and 2 * n <= chars <= 15 * n and 10 * symbols <= n and 2 * marks <= n and 2 * dup <= len(lines) and 100 * repeat <= 20 * n

    assert Counter(kept[0]) == Counter(r for r in rows if good(r[1]))
    label = plain_components({p: p for p in (plain_fingerprint(r[1]) for r in kept[0])})
    groups = defaultdict(set)
    for r in kept[0]:
        groups[label[plain_fingerprint(r[1])]].add(r)
    assert len(kept[1]) == len(groups) and all(sum(r in group for r in kept[1]) == 1 for group in groups.values())
    spans = {r[0]: plain_entropy_spans(r[1]) for r in kept[1]}
    clean = [r for r in kept[1] if not spans[r[0]] and not plain_secrets(r[1])]
    assert len(kept[2]) == len(kept[1]) and set(clean) <= set(kept[2]) and len(clean) == len(kept[1]) - 1
    assert not any("9fGh2" in r[1] or "hunter22" in r[1] for r in kept[2])
    times = Counter()
    for (*entry, copies), n in plain_mix(kept[2])[0].items():
        times[tuple(entry)] += copies * n
    assert Counter((r[0], r[3], len(words_of(r[1]))) for r in kept[3]) == +times
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    length = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1
    pieces, bins = defaultdict(int), defaultdict(list)
    for r in docs.collect():
        pieces[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    whole = Counter()
    for r in kept[3]:
        whole[r[0]] += length(r[1])
    assert Counter(pieces) == whole
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= packing.CAPACITY
    assert corpus_pipeline.run(spark, str(tmp_path)).agg(F.sum("length")).first()[0] == sum(whole.values())


def test_scratch_tables_are_cleaned(spark):
    from pathlib import Path

    from neumata.llm import shared

    scratch = shared.Scratch(spark, "clean")
    scratch.keep(spark.range(3), "a")
    assert Path(scratch.top).exists() and shared.clean(spark) >= 1 and not Path(scratch.top).exists() and shared.clean(spark) == 0
