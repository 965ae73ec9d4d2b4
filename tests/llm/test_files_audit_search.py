"""Token files, the filter audit and the ranked search against plain Python, on small tables with every odd case."""

import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from test_operators import DOCS, odd_rows, words_of
from tokenizers import Tokenizer

from neumata.llm import filter_audit, ranked_search, registry, token_files

LABELS = "doc_id long, quality int, toxic int, part string, n long"


@pytest.fixture(scope="module")
def whole_tokenizer():
    import public_tokenizers

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


ODD_TEXTS = [
    "Hello <|endoftext|> wor<|startoftext|>ld it's fine\x0b\x1c x", "", None, "É é ́a 日本 … ΑΣ ΣΑΣ İ 12345 don't'S", " a b c ", "x" * 300 + " " + "y" * 70,
    "á e\ńx ᄀ ᅡ ffﬁ", "...!?  '' 's 'S 't", "<|endoftext|>", "<|ENDOFTEXT|> <|StartOfText|>x", "J\u030c j\u030c J.J?! a.b, c;'s.'S U.S.A. 3.5,x e.\u0301", "\U0001f600 \U0001f468‍\U0001f469 ퟿ \x00 \x85 　 z",
]


@pytest.mark.parametrize("memory", [1_000_000, 20])
def test_words_are_encoded_as_whole_texts(whole_tokenizer, monkeypatch, memory):
    monkeypatch.setattr(token_files, "MEMORY", memory)
    encode = token_files.encoder.__wrapped__(token_files.VOCABULARY)
    for _ in range(2):  # anew, and from memory
        ids, sizes = encode(pa.array(ODD_TEXTS))
        expected = [whole_tokenizer.encode(t or "", add_special_tokens=False).ids for t in ODD_TEXTS]
        assert sizes.tolist() == [len(e) for e in expected] and ids.tolist() == sum(expected, [])


def test_words_of_a_corpus_are_encoded_as_whole_texts(whole_tokenizer):
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].combine_chunks()
    ids, sizes = token_files.encoder(token_files.VOCABULARY)(texts)
    expected = [e.ids for e in whole_tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
    assert sizes.tolist() == [len(e) for e in expected] and ids.tolist() == sum(expected, [])


def test_latin_words_go_past_the_normalizer():
    """Every letter of LATIN, alone, in words and before a sign, has the ids of the whole text, and none of these words is encoded one by one."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(f"{token_files.VOCABULARY}.json"))
    letters = [c for c in map(chr, range(0x41, 0x250)) if token_files.Words.letters.fullmatch(c)]
    assert len(letters) > 400 and not {"×", "÷", "İ"} & set(letters)
    texts = [f"{c} a{c} {c}B{c}{c}$$$ {c};{c} {c}'s x{c}#×;÷ \u0130{c} {c}\u0301 <|{c}|> {c}<|endoftext|>" for c in letters]
    texts += ["don't% DON'T& it's* we'll: ×$ a\u0301$ 'S", "".join(letters), "<|ENDOFTEXT|> A", "A<|endoftext|>B$"]
    for group in ([t] for t in texts):
        ids, sizes = token_files.encoder(token_files.VOCABULARY)(pa.array(group))
        assert ids.tolist() == tokenizer.encode(group[0], add_special_tokens=False).ids
        assert sizes.tolist() == [len(ids)]
    words = token_files.Words(token_files.VOCABULARY)
    words._marked = words._alone = None
    words.numbers([c + "a" + c for c in letters if token_files.Words.letters.fullmatch(c.lower())] + ["Abc"])


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_shard_answers_without_decoding(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 49_000).astype(np.uint16)
    shard = token_files.Shard(token_files.Shard.pack([7, None, 3], [n // 3, 0, n - n // 3], ids))
    assert shard.ids().tolist() == ids.tolist() and shard.starts.tolist() == [0, n // 3, n // 3, n]
    assert shard.doc_ids[shard.nameless == 0].tolist() == [7, 3]
    at = rng.integers(0, n, 200) if n else np.empty(0, np.int64)
    assert shard.access(at).tolist() == ids[at].tolist()
    for token in (0, 1, 2, 5, 48_999, 65_535, 70_000, -1):
        found = [p for some in shard.positions(token, batch=100) for p in some.tolist()]
        assert found == np.flatnonzero(ids == token).tolist()
        low, high = n // 5, n - n // 7
        assert shard.rank(token, np.array([0, low]), np.array([n, high])).tolist() == [(ids == token).sum(), (ids[low:high] == token).sum()]
    with pytest.raises(ValueError, match="not a token shard"):
        token_files.Shard(b"something else, of any length")


def plain_files(rows, tokenizer):
    """(doc_id, ids) in order of id, nulls first, each with its end."""
    coded = [(r[0], (*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1)) for r in rows]
    return sorted(coded, key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("shard_tokens", [1, 700, 1 << 22])
def test_round_trip(spark, docs, whole_tokenizer, shard_tokens):
    got = token_files.round_trip(spark, docs, shard_tokens=shard_tokens).collect()
    expected = plain_files(odd_rows(), whole_tokenizer)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(ids), crc(ids)) for d, ids in expected)
    got = sorted(got, key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert [r.doc_id for r in got] == [d for d, _ in expected]


def test_questions_to_files(spark, docs, whole_tokenizer, tmp_path):
    path = str(tmp_path / "shards")
    token_files.write(docs, path, shard_tokens=900)
    rows = sorted(token_files.documents(spark, path, ids=True).collect(), key=lambda r: r.start)
    every = [i for r in rows for i in r.ids]
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter(plain_files(odd_rows(), whole_tokenizer))
    common = [t for t, _ in Counter(every).most_common(3)] + [1, 49_000]
    n = token_files.counts(spark, path, common).collect()
    assert sorted((r.token, r.start, r.n) for r in n) == sorted((t, r.start, r.ids.count(t)) for t in common for r in rows if t in r.ids)
    found = token_files.occurrences(spark, path, common).collect()
    assert sorted((r.token, r.place) for r in found) == sorted((t, k) for t in common for k, i in enumerate(every) if i == t)
    starts = {r.start: r.doc_id for r in rows}
    assert all(starts[r.place - r.offset] == r.doc_id for r in found)
    places = spark.createDataFrame([(k,) for k in [0, 1, 899, 900, 901, len(every) - 1, len(every), -1, 5, 5]], "place long")
    assert {(r.place, r.token) for r in token_files.tokens_at(spark, path, places).collect()} == {(k, every[k]) for k in (0, 1, 899, 900, 901, len(every) - 1, 5)}


def test_many_rows_of_one_id_keep_apart(spark):
    rows = spark.createDataFrame([(None, "same text"), (4, "x y")] * 2000, "doc_id long, text string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = token_files.shards(rows, shard_tokens=10**9).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r.task for r in got}) > 2 and sum(r.n_docs for r in got) == 4000


def plain_audit(rows, labels):
    good = {r[0] for r in labels if r[1] == 1}
    toxic = {r[0] for r in labels if r[2] == 1}
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    judged = []
    for r in rows:
        text, words = r[1] or "", words_of(r[1])
        fails = "A" * (len(words) < 100) + "B" * (100 * len(set(words)) < 80 * len(words)) + "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        fails += "D" * bool(re.search("[#$%&*|]", text)) + "E" * (r[0] is not None and first[text] < r[0])
        judged.append((r[2] or "", fails, r[0] in good and r[0] is not None, r[0] in toxic and r[0] is not None))
    out, removed_by = [], Counter()
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                removed_by[part, f] += len(gone)
                failing = sum(f in j[1] for j in mine)
                out.append((part, order, step, len(left), len(gone), failing - len(gone), sum(j[1] == f for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone)))
    return {(*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out}


def audit_rows():
    """Long texts that pass and fail each filter, copies under several parts and ids, repeated rows, nulls."""
    rng = random.Random(11)
    fresh = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    base, loud = fresh(150), fresh(120) + " " + "LOUD" * 60
    texts = [base, base, base, loud, loud, fresh(130) + " #", "a b " * 80, fresh(100), fresh(99), "é " + fresh(110), "A" * 30 + "é" * 300, "", None]
    parts = ["en", "fr", None, ""]
    rows = [(k, rng.choice(texts), rng.choice(parts), "s", 1, "b", 1) for k in range(120)]
    rows += [(None, base, "en", None, None, None, None)] * 3 + [(0, base, "fr", "s", 1, "b", 1)] * 4 + [(-5, loud, "de", "s", 1, "b", 1), (-5, loud, "en", "s", 1, "b", 1)]
    labels = [(k, rng.randint(0, 1), rng.randint(0, 1), "x", 2) for k in range(0, 120, 2)]
    return rows, labels + [(0, None, None, "x", 2), (3, 1, None, None, None), (3, 0, 1, None, None), (None, 1, 1, None, None), (999, 1, 1, None, None)]


def test_filter_audit(spark, docs):
    for rows, labels in (audit_rows(), (odd_rows(), [(5, 1, 1, "x", 1), (7, 1, 0, "x", 1)]), ([(1, None, None, None, None, None, None)], [])):
        table = spark.createDataFrame(rows, DOCS).repartition(4)
        got = filter_audit.audited(table, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain_audit(rows, labels)


def test_filter_audit_hands_parts_on(spark, monkeypatch):
    rows = [(k, "a b " * (k % 60), f"part{k % 30}", "s", 1, "b", 1) for k in range(300)]
    monkeypatch.setattr(filter_audit, "HELD", 3)
    got = filter_audit.audited(spark.createDataFrame(rows, DOCS).repartition(2), spark.createDataFrame([], LABELS)).collect()
    assert {tuple(r) for r in got} == plain_audit(rows, [])


TERM = re.compile(ranked_search.TERM)


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(rows, items, k):
    docs = [(r[0], terms_of(r[1])) for r in rows]
    total, many = sum(len(t) for _, t in docs), sum(bool(t) for _, t in docs)
    df = Counter(t for _, terms in docs for t in set(terms))
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms_of(text))
    out = set()
    for item, terms in asked.items():
        scores = []
        for doc_id, words in docs:
            tf, m = Counter(words), 25 + 75 * len(words) * many // max(total, 1)
            score = sum(q * math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t, q in terms.items() if tf[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out |= {(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)}
    return out


ITEMS = [(1, "w1 w2 W3 w3 straße"), (2, "Été x y日本"), (3, ""), (4, None), (5, "nowhere-to-be-found"), (6, "w5 " * 50 + " ".join(f"w{k}" for k in range(200))), (6, "password"), (None, "w7 w8"), (7, "word a")]


@pytest.mark.parametrize("k", [1, 10, 1000])
@pytest.mark.parametrize("block", [200_000, 20])
def test_ranked_search(spark, docs, monkeypatch, k, block):
    monkeypatch.setattr(ranked_search, "ITEM_BLOCK", block)
    monkeypatch.setattr(ranked_search, "CELLS", 50 if block == 20 else 1 << 21)
    items = spark.createDataFrame([(i, t, "b") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = ranked_search.ranked(spark, docs, items, k).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain_search(odd_rows(), ITEMS, k)


def test_search_prunes_only_what_cannot_count(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["the", "of", "and"], k=30) + rng.choices([f"r{k}" for k in range(40)], k=5)), "en", "s", 1, "b", 1) for i in range(400)]
    rows += [(1000 + i, "r1 r1 r2 the", "en", "s", 1, "b", 1) for i in range(60)]  # ties across the last rank
    items = [(k, f"the of and r{k} r{k + 1}") for k in range(20)]
    table = spark.createDataFrame(rows, DOCS).repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert {tuple(r) for r in ranked_search.ranked(spark, table, asked).collect()} == plain_search(rows, items, 10)
    rows_ = spark.createDataFrame([(1, 0, 1, 3, 900, 800), (1, 1, 1, 100, 900, 800), (1, 2, 1, 1, 900, 0)], "item_id long, term int, n int, w long, highest long, kth long")
    seeds = {r.term: (r.threshold, r.essential) for r in ranked_search.seeded(rows_).collect()}
    assert seeds == {0: (80_000, False), 1: (80_000, True), 2: (80_000, False)}


def test_empty_tables(spark):
    none, no_labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    no_items, items = spark.createDataFrame([], "item_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    full = spark.createDataFrame(odd_rows(), DOCS)
    results = [
        token_files.round_trip(spark, none), filter_audit.audited(none, no_labels), ranked_search.ranked(spark, none, items), ranked_search.ranked(spark, full, no_items),
        ranked_search.ranked(spark, none, no_items),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_query_of_files_is_whole(spark):
    got = registry.op11_token_files(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert sum(r.n_tokens for r in got) == max(r.start + r.n_tokens for r in got)
