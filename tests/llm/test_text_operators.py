"""Each text operator against brute force on small tables, and on awkward rows."""

import math
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from check import DATA, difference, duck

import corpus_pipeline
from tidemark.llm import (
    decontaminate,
    language,
    licences,
    minhash,
    mixing,
    quantise,
    recurrent,
    reputation,
    toxicity,
    trie,
    words,
)
from tidemark.llm.oracle import ORACLE_SQL
from tidemark.llm.queries import QUERIES

SF = f"{DATA}/sf0.001"
KIND = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, score int, copy_no int"
LONG = "lang wörd " * 30_000
AWKWARD = [
    (1, "The cat sat on the mat today", "en", "a"),
    (1, "The cat sat on the mat today", "en", "a"),
    (2, "the CAT sat on\tthe mat today", "en", None),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \n\t ", "fr", "b"),
    (6, LONG, "de", "b"),
    (7, "12 34 !!", "de", "b"),
    (None, "idiot words here", None, None),
    (8, "x" * 5000, "en", "a"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i, t, la, s, len(t or ""), "r", 1, 2, 3) for i, t, la, s in AWKWARD]
    return spark.createDataFrame(rows, KIND)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def tokens(text):
    return (text or "").encode().lower().split()


def test_words_are_those_of_bytes_split():
    rng = np.random.default_rng(0)
    made = ["".join(rng.choice(list("aBz é\t\n\x0b\x1f\u00a0"), 40)) for _ in range(200)]
    made += ["", LONG * 20, "y" * (words.SLICE_BYTES + 5), "p q"]
    raw = [t.encode() for t in made]
    data = np.frombuffer(b"".join(raw), np.uint8)
    found = words.split(data, np.cumsum([0, *map(len, raw)]))
    seen = {}
    cut = words.bounds(found.row, len(raw))
    for i, text in enumerate(raw):
        want = text.lower().split()
        got = found.hash[cut[i] : cut[i + 1]].tolist()
        assert len(got) == len(want)
        for w, h in zip(want, got, strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_toxicity(spark, awkward, empty):
    made = [(i, f"{'stupid idiot' if i % 4 == 0 else 'kind friend'} word{i % 7} more{i % 11}") for i in range(400)]
    docs = spark.createDataFrame(made, "doc_id long, text string")
    marks = labels(spark, [(i, 1, int(i % 4 == 0)) for i in range(400) if i % 3])
    for r in toxicity.toxicity(docs, marks).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.doc_id % 4 == 0) and 0 <= r.score <= 1
    scored = toxicity.toxicity(awkward, labels(spark)).collect()
    assert len(scored) == len(AWKWARD) and not any(r.predicted for r in scored)
    assert toxicity.toxicity(empty, labels(spark)).count() == 0
    clean = toxicity.clean_documents(awkward, marks)
    assert clean.columns == awkward.columns and clean.count() >= 8


def test_language(spark, documents, awkward, empty):
    held = [r for r in language.languages(documents).collect() if r.held_out]
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    found = language.languages(awkward).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    assert all(r.lang_pred == "und" for r in found if r.doc_id in (3, 4, 5, 7))
    assert language.languages(empty).count() == 0
    kept = language.accepted_documents(awkward)
    assert kept.columns == awkward.columns
    assert not {3, 4, 5, 7} & {r.doc_id for r in kept.collect()}


def test_every_language_is_learnt(spark):
    """Three hundred of them, most with a single text."""
    rng = np.random.default_rng(2)
    rows = []
    for n in range(300):
        letters = [chr(0x4E00 + 40 * n + j) for j in range(8)]
        for i in range(40 if n < 5 else 2):
            rows.append((len(rows), "".join(rng.choice(letters, 60)), f"l{n}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs)
    learnt = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    assert set(model.languages) == learnt and len(learnt) > 256
    found = language.languages(docs.repartition(5)).collect()
    again = language.languages(docs.repartition(2)).collect()
    scores = {r.doc_id: (r.lang_pred, r.score) for r in again}
    assert all(scores[r.doc_id][0] == r.lang_pred for r in found)
    assert all(abs(scores[r.doc_id][1] - r.score) < 1e-6 for r in found)


def brute_components(rows, k, percent):
    sets = {}
    for i, text in rows:
        w = tokens(text)
        n = min(k, len(w))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
                one, two = root(a), root(b)
                parent[max(one, two)] = min(one, two)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_minhash(spark, documents, k, percent):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    base = [f"w{i}" for i in range(60)]
    for j in range(40):  # a group whose members are near the threshold, and chains
        own = list(base)
        for x in range(j % 5):
            own[(7 * j + 13 * x) % 60] = f"z{j}{x}"
        rows.append((100_000 + j, " ".join(own)))
    want = brute_components(rows, k, percent)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(docs, words=k, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_awkward(awkward, empty):
    got = minhash.near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD)
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].component_id == 1 and not by_id[2].kept
    assert all(by_id[i].n_shingles == 0 and by_id[i].kept for i in (3, 4, 5))
    assert by_id[None].component_id is None and by_id[None].kept
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.kept_rows(awkward).count() == len(AWKWARD) - 2


def test_minhash_by_row(spark, tmp_path):
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    near = text("a", 40) + " tail"
    rows = [
        (1, text("a"), "a"), (1, text("a"), "a"),  # a row that repeats
        (None, text("b"), "b"), (None, text("b"), "b"), (None, text("b") + " end", "b"),  # no id
        (3, text("c"), "c"), (9, text("c"), "c"), (9, text("d"), "d"),  # 9 has another text
        (1, text("e"), "e"), (7, near, "a"), (7, text("f"), "f"),  # 7 is only near with one
        (None, text("a"), "a"), (None, "", "none"), (None, None, "none"), (8, "", "none"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    got = minhash.near_duplicates(docs.withColumnsRenamed({"row": "other"})).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.component_id) for r in got if r.n_shingles) == Counter(
        {(1, 1): 3, (None, None): 3, (3, 3): 1, (9, 3): 1, (9, 9): 1, (7, 1): 1, (7, 7): 1, (None, 1): 1}
    )
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert sum(r.kept_row for r in got) == 9
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r.row for r in kept.collect()) == ["a", "b", "c", "d", "e", "f", "none", "none", "none"]


def test_decontamination(spark, awkward, empty):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame(
        [(1, item), (2, item.upper()), (3, "short item"), (4, None), (5, ""), (None, "x"), (6, " ".join(f"q{i}" for i in range(30)))],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [
            (1, f"before it {item} after it"),
            (2, "one two three four five other words seven eight nine ten"),
            (3, "a short item here"),
            (4, " ".join(f"q{i}" for i in range(28)) + " tail"),
            (5, None),
            (6, "nothing of the kind is in this text at all"),
            (None, item),
            (7, LONG + item),
        ],
        "doc_id long, text string",
    )
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench).collect()}
    assert set(got) == {(1, 1), (3, 3), (4, 6), (None, 1), (7, 1)}
    assert got[1, 1].first_word == 2 and got[1, 1].n_words == 10 and got[1, 1].similarity == 1
    assert 0.8 <= got[4, 6].similarity < 1
    assert decontaminate.contaminated(awkward, bench).count() == 0
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert {r.doc_id for r in decontaminate.clean_rows(docs, bench).collect()} == {2, 5, 6}


def brute_items(docs, items):
    """All windows of an item's words, by fingerprint and then by weighted shingles."""

    def parts(w):
        k = min(5, len(w))
        return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]

    def printed(w):
        data = np.frombuffer(" ".join(w).encode(), np.uint8)
        values = words.shingles(words.split(data, np.array([0, len(data)])).hash, min(5, len(w)))
        return int(decontaminate.fingerprints(values, np.array([0]), np.array([len(values)]))[0])

    out = {}
    for d, text in docs:
        w = [t.decode() for t in tokens(text)]
        for i, item in items:
            own = [t.decode() for t in tokens(item)]
            if not own or not w:
                continue
            theirs, mark = Counter(parts(own)), printed(own)
            for at in range(max(1, len(w) - len(own) + 1)):
                window = w[at : at + len(own)]
                if min(5, len(window)) != min(5, len(own)):
                    continue
                mine = Counter(parts(window))
                shared = sum((mine & theirs).values())
                joint = sum(mine.values()) + sum(theirs.values()) - shared
                if shared * 100 < 80 * joint or (printed(window) ^ mark).bit_count() > decontaminate.RADIUS:
                    continue
                if (d, i) not in out or shared / joint > out[d, i][2]:
                    out[d, i] = (at, len(window), shared / joint)
    return out


@pytest.mark.parametrize("at_once", [1 << 15, 3])
def test_decontamination_against_all_windows(spark, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "ANCHORS_AT_ONCE", at_once)
    monkeypatch.setattr(decontaminate, "WINDOWS_AT_ONCE", at_once)
    rng = np.random.default_rng(5)
    draw = lambda n, m=40: [f"w{x}" for x in rng.integers(0, m, n)]
    stem = draw(6)
    items = [stem + draw(n) for n in (4, 4, 9, 20, 30)] + [draw(n) for n in (2, 5, 7, 12, 25)] + [["r"] * 9]
    docs = []
    for n in range(60):
        text = draw(int(rng.integers(0, 60)))
        item = list(items[n % len(items)])
        for at in rng.integers(0, len(item), n % 3):
            item[at] = f"changed{n}"
        at = int(rng.integers(0, len(text) + 1))
        docs.append(text[:at] + item + text[at:])
    docs += [stem * 12, ["r"] * 40, items[4][:26], [], draw(3)]
    docs = list(enumerate(" ".join(d) for d in docs))
    items = list(enumerate(" ".join(i) for i in items))
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id): (r.first_word, r.n_words, r.similarity) for r in got} == brute_items(docs, items)


def test_a_text_that_repeats_a_stem_stays_in_memory():
    """One megabyte of a phrase with which a hundred items begin."""
    phrase = [f"stem{i}" for i in range(7)]
    items = [phrase + [f"own{i}_{j}" for j in range(10 + i % 40)] for i in range(100)]

    def hashes(texts):
        data = [" ".join(t).encode() for t in texts]
        found = words.split(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
        return found.hash, words.bounds(found.row, len(texts))

    own, cut = hashes(items)
    index = decontaminate.build_index(list(range(100)), [own[a:b] for a, b in zip(cut, cut[1:])])
    text = phrase * (1_000_000 // 43) + items[3] + phrase * 50
    value, cut = hashes([text])
    tracemalloc.start()
    found = decontaminate.hits(index, value, cut)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(f[1], f[2], f[3]) for f in found if f[4] == f[5]] == [(3, 7 * (1_000_000 // 43), len(items[3]))]
    assert peak < 500e6


def test_decontamination_by_row(spark, empty, monkeypatch, tmp_path):
    item, other = "one two three four five six seven eight", "red green blue white black brown"
    bench = [(1, item), (None, other), (None, "only here alone"), (2, "first of two"), (2, "second of two")]
    bench = spark.createDataFrame(bench, "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, item, "a"), (None, "nothing of it", "b"), (7, item, "c"), (7, "clean text here", "d"), (8, f"so {other} so", "e"),
            (9, "it is only here alone", "f"), (10, "the first of two", "g"), (11, "the second of two", "h"), (12, None, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    for limit in (decontaminate.INDEX_WORDS, 8):
        monkeypatch.setattr(decontaminate, "INDEX_WORDS", limit)
        got = decontaminate.contaminated(docs, bench).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(None, 1), (7, 1), (8, None), (9, None), (10, 2), (11, 2)}
        clean = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
        assert clean.columns == docs.columns and sorted(r.row for r in clean.collect()) == ["b", "d", "i"]
    assert decontaminate.clean_rows(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.clean_rows(empty, bench).count() == 0


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLE_SQL[name]) is None


def test_reputation(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x?y#z", "x://www.example.com/en/1",
            "x://shop.net/es/", "x://shop.net#/es/", "x://com", "x://foocom/", "x://good.org/a", "x://bad.org/a"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(10, 1)] * 2 + [(11, 0)], "page_id long, good int")
    got = {r.page_id: r for r in reputation.judge_urls(pages, outcomes).collect()}
    assert [got[i].host for i in range(4)] == ["", "", "", ""]
    assert (got[4].host, got[4].path, got[4].rule, got[4].verdict) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[5].rule == "www.example.com/en/" and got[5].verdict == "allow"
    assert got[6].rule == "net/es/" and got[7].rule is None
    assert got[8].rule is None and got[9].rule is None
    assert reputation.judge_urls(pages.limit(0), outcomes).count() == 0
    many = spark.createDataFrame([(i, f"x://{'bad' if i % 2 else 'good'}.org/") for i in range(200)], "page_id long, url string")
    marks = spark.createDataFrame([(i, 1 - i % 2) for i in range(200)], "page_id long, good int")
    for r in reputation.judge_urls(many, marks).collect():
        assert r.verdict == ("block" if r.host == "bad.org" else "allow")


def test_mixing(spark, awkward, empty):
    got = mixing.document_copies(awkward).collect()
    size_of = {i: len(tokens(t)) for i, t, _, _ in AWKWARD}
    assert len(got) == len(AWKWARD)
    assert all(r["size"] == size_of[r.doc_id] and 0 <= r.copies <= 2 for r in got)
    assert mixing.document_copies(empty).count() == mixing.mixed_documents(empty).count() == 0
    rows = [(i, "w " * (i % 50), f"s{i % 3}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source = {i: s for i, _, s in rows}
    taken, target = Counter(), {}
    for r in mixing.document_copies(docs).collect():
        taken[source[r.doc_id]] += r.copies * r["size"]
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) < 0.01 * target[s] for s in target)
    assert mixing.mixed_documents(awkward).columns == awkward.columns


def test_mixing_ids_that_repeat(spark, monkeypatch):
    """Rows of one id, or of none, are sampled one by one, in runs of row numbers."""
    monkeypatch.setattr(mixing, "SUB_ROWS", 16)
    rows = [(7, "a b", "s")] * 500 + [(None, "a b", "s")] * 700 + [(i, "a b", "s") for i in range(100)]
    rows += [(7, "c", None)] * 40 + [(8, "x y z", "t")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.document_copies(docs).collect()
    assert len(got) == len(rows) and {r.copies for r in got} <= {0, 1, 2}
    sums = Counter()
    for r in got:
        sums[r.source_size] += r.copies * r["size"]
    for r in got:
        assert abs(sums[r.source_size] - r.target) <= 3
    again = mixing.document_copies(docs).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    for bound in (mixing.BROADCAST_ROWS, 1):
        monkeypatch.setattr(mixing, "BROADCAST_ROWS", bound)
        mixed = mixing.mixed_documents(docs)
        assert mixed.columns == [*docs.columns, "copy_no"]
        assert mixed.count() == sum(r.copies for r in got)


def count_word(word, vocabulary):
    """Tokens of the best segmentation of one word, without a trie."""
    text = trie.SPACE_MARK + word
    lengths = list(vocabulary.hashes)
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        score, tokens = best[end - 1]
        found = (score + vocabulary.byte_score, -tokens - 1)
        for n in lengths:
            if n > end:
                break
            own = vocabulary.score.get(text[end - n : end])
            if own is not None:
                score, tokens = best[end - n]
                found = max(found, (score + own, -tokens - 1))
        best.append((found[0], -found[1]))
    return best[-1][1]


def test_long_words_share_their_prefixes(spark):
    vocabulary = trie.read_vocabulary()
    rng = np.random.default_rng(6)
    stem = bytes(rng.integers(97, 123, 300, dtype=np.uint8))
    made = [stem[:200], stem, stem + b"ing", stem + b"ings" * 50, stem[:150] + "是的".encode() * 60, b"z" * 129, b"y" * 129]
    assert trie.count_long(made, vocabulary) == [count_word(w, vocabulary) for w in made]
    asked, own = [], vocabulary.score

    class Asked(dict):
        def get(self, piece, *default):
            asked.append(piece)
            return own.get(piece, *default)

    trie.count_long([stem, stem + b"a"], vocabulary._replace(score=Asked()))
    assert len(asked) < 1.1 * len(stem) * len(vocabulary.hashes)  # the stem once
    docs = spark.createDataFrame([(1, b" ".join(made).decode())], "doc_id long, text string")
    got = trie.token_counts(docs).first()
    assert (got.n_words, got.n_tokens) == (7, sum(count_word(w, vocabulary) for w in made))


def test_token_counts(spark, awkward, empty, documents):
    vocabulary = trie.read_vocabulary()
    want = {r.doc_id: sum(count_word(w, vocabulary) for w in r.text.encode().split()) for r in documents.limit(20).collect()}
    got = {r.doc_id: r.n_tokens for r in trie.token_counts(documents.limit(20)).collect()}
    assert got == want
    found = {r.doc_id: r for r in trie.token_counts(awkward).collect()}
    assert found[3].n_tokens == found[4].n_tokens == found[5].n_tokens == 0
    assert found[8].n_tokens == count_word(b"x" * 5000, vocabulary)
    assert trie.token_counts(empty).count() == 0


def test_licences(spark, awkward, empty, documents):
    made = [
        (1_000_001, "Some words.\nReleased under the MIT License.\nMore words."),
        (1_000_002, "Licensed under CC BY-NC 4.0."),
        (1_000_003, "Licensed under the Apache License, Version 2.0."),
        (1_000_004, "He was under the table with the general public."),
    ]
    docs = documents.select("doc_id", "text").union(spark.createDataFrame(made, "doc_id long, text string"))
    got = {r.doc_id: (r.paragraph, r.family) for r in licences.licences(docs).collect() if r.doc_id and r.doc_id > 1_000_000}
    assert got == {1_000_001: (1, "mit"), 1_000_002: (0, "cc-by-nc"), 1_000_003: (0, "apache")}
    assert licences.licences(awkward).count() == 0
    assert licences.licences(empty).count() == 0


def test_licences_learn_every_line(spark):
    """Every ordinary line is learnt or held out, however many there are: over 6000 of them
    in one text, and a kind of line that one text of 3000 has."""
    common = "\n".join(["He may not use this file for the work."] * 7000)
    made = [(0, common), *((i, "It is under the General Store.") for i in range(1, 3000))]
    made.append((3000, "You may obtain a copy of the book."))
    made.append((3001, "Released under the MIT License"))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    scanner = licences.Scanner(licences.Scratch(spark, "licences-test"))
    lines = scanner.lines(docs)
    model = scanner.train(lines)
    got = sorted((r.learnt + r.test, min(r.learnt, r.test) > 0) for r in spark.read.parquet(scanner.scratch.path("ordinary")).collect())
    assert got == [(1, False), (2999, True), (7000, True)]
    told = scanner.scan(lines, model).collect()
    assert [(r.doc_id, r.family) for r in told if r.family != licences.UNKNOWN] == [(3001, "mit")]


def test_licences_wrapped(spark, documents):
    gpl = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
    made = [
        gpl,
        "First some prose of its own.\n" + "\n".join(f"# {x}" for x in bsd.split("\n")) + "\nand then other prose.",
        "Prose.\r\n" + gpl.replace("\n", "\r\n"),
        "\n".join(gpl.split()[:32]),
        "word " * 90 + bsd + " word" * 90,
        "Released under the MIT License.\n" + bsd,
        gpl.replace("\n", "\n\n"),
    ]
    docs = documents.select("doc_id", "text").union(
        spark.createDataFrame(list(enumerate(made, 1_000_000)), "doc_id long, text string")
    )
    got = sorted(
        (r.doc_id - 1_000_000, r.paragraph, r.family)
        for r in licences.licences(docs).collect()
        if r.doc_id >= 1_000_000
    )
    sure = [r for r in got if r[2] != "unknown"]
    assert sure == [(0, 0, "gpl"), (1, 1, "bsd"), (2, 2, "gpl"), (3, 0, "gpl"), (4, 0, "bsd"), (5, 0, "mit"), (5, 1, "bsd")]
    assert all(r[0] == 6 for r in got if r[2] == "unknown")


def test_language_model(spark, awkward, empty, documents):
    rows = documents.collect()
    learnt = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    count = Counter(w for r in learnt for w in tokens(r.text))
    total, types = sum(count.values()) + len(learnt), len(count) + 1
    got = {r.doc_id: r for r in recurrent.language_model_scores(documents).collect()}
    assert len(got) == len(rows)
    for r in rows:
        own, g = tokens(r.text), got[r.doc_id]
        base = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in own)
        base += math.log10((len(learnt) + 1) / (total + types + 1))
        assert abs(g.base_score - base) < 1e-6 * abs(base)
        assert (g.n_tokens, g.train_tokens) == (len(own) + 1, total)
        assert g.n_known == sum(w in count for w in own) + 1
    held = [g for g in got.values() if g.held_out]
    assert sum(g.score for g in held) > sum(g.base_score for g in held)
    found = recurrent.language_model_scores(awkward).collect()
    assert len(found) == len(AWKWARD) and all(r.score <= 0 for r in found)
    assert recurrent.language_model_scores(empty).count() == 0


def test_language_model_sums_to_one_and_carries_state():
    net = recurrent.new_network(np.arange(1, 100, dtype=float))
    texts = [np.array([i]) for i in range(2, 99)] + [np.array([0]), np.array([1])]
    assert abs(np.exp(recurrent.score_tokens(net, texts)).sum() - 1) < 1e-3
    long = [np.array([2, 3, 4] * 40)]
    state = np.zeros((1, recurrent.HIDDEN), np.float32)
    before = np.concatenate([[0], long[0][:-1]])[:, None]
    states, _ = recurrent.run_window(net, state, before, np.arange(120)[:, None] == 0)
    flat, cls, place = states[:, 0], long[0] // 64, long[0] % 64
    want = recurrent.log_softmax(flat @ net.of_class + net.class_bias)[np.arange(120), cls].sum()
    word = [recurrent.log_softmax(f @ net.of_word[c] + net.word_bias[c])[p] for f, c, p in zip(flat, cls, place, strict=True)]
    assert abs(recurrent.score_tokens(net, long)[0] - (want + sum(word))) < 1e-2


def test_language_model_learns_every_token():
    counts = np.ones(200)
    texts = [np.array([2, 3, 4, 5, 6]), np.arange(7, 7 + 2 * recurrent.WINDOW + 3), np.array([9])]
    net = recurrent.new_network(counts)
    net = net._replace(of_class=net.of_class + 0.1, of_word=net.of_word + 0.05)
    before, fresh, target, number = next(recurrent.windows(texts, 3, recurrent.WINDOW))
    use = number >= 0
    assert 0 < use.sum() < use.size
    state = np.zeros((3, recurrent.HIDDEN), np.float32)
    grads, _ = recurrent.train_window(net, state, before, fresh, target, use)

    def loss(bias):
        one = [target[:, k][use[:, k]] for k in range(3)]
        return -recurrent.score_tokens(net._replace(bias=bias), one).sum()

    wide = net._replace(**{f: getattr(net, f).astype(np.float64) for f in ("of_class", "of_word", "across", "inward", "embedding")})
    net = wide
    for k in (0, 40, 70):
        step = np.zeros(3 * recurrent.HIDDEN)
        step[k] = 1e-2
        assert abs((loss(step) - loss(-step)) / 2e-2 - grads[3][k]) < 0.02 * abs(grads[3][k]) + 1e-3
    learner = recurrent.train(recurrent.new_learner(counts), [np.array([2, 3, 4])])
    assert learner.step == 1  # fewer lanes than a quarter, less than a window

    corpus = recurrent.Corpus(np.zeros(0, np.uint64), np.zeros(0, np.int64), 2, 1, 1, 1, 0, 0)
    made = [f"w{i} " * (i % 90) for i in range(1500)] + ["long " * 11_000] * 64
    batch = pa.record_batch([pa.array([t.encode() for t in made])], names=["text"])
    start = recurrent.new_learner(np.ones(2))
    out = list(recurrent.learn_texts(iter([batch]), corpus, start))
    seen = sum(len(t.split()) + 1 for t in made)
    assert seen > 700_000 and set(out[0].column("seen").to_pylist()) == {seen}
    rows = pa.Table.from_batches(out + out)
    means = [recurrent.average(rows.filter(pa.compute.equal(rows["slice"], i))) for i in range(out[0].num_rows)]
    flat = np.frombuffer(b"".join(m["values"][0].as_py() for m in means), np.float32)
    assert recurrent.unpack(flat, start).step > 100


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 24))
    made = [v + rng.normal(size=24) * s for v in base for s in (0.0, 0.0, 0.1, 0.2, 0.35)]
    rows = [(i, [float(x) for x in v], i % 2 if i % 10 < 5 else 0) for i, v in enumerate(made)]
    odd = [(900, None, 0), (901, [0.0] * 24, 0), (902, [float("nan")] * 24, 0), (903, [None] * 24, 0),
           (904, rows[0][1], None), (None, rows[0][1], 0), (905, [], 0), (906, [1.0, 2.0], 0), (907, [2.0, 4.0], 0)]
    kind = "vec_id long, embedding array<double>, label int"
    got = {r.vec_id: r for r in quantise.near_vectors(spark.createDataFrame(rows + odd, kind)).collect()}
    x = np.array(made) / np.linalg.norm(made, axis=1, keepdims=True)
    same = np.array([[a[2] == b[2] for b in rows] for a in rows])
    want = ((x @ x.T >= 0.93) & same).sum(axis=1) - 1
    have = np.array([got[i].n_links for i in range(len(rows))])
    assert (have <= want).all() and have.sum() >= 0.97 * want.sum()
    least = components_of(np.arange(len(rows)), (x @ x.T >= 0.93) & same)
    assert np.mean([got[i].component_id == least[i] for i in range(len(rows))]) > 0.98
    assert all(got[i].n_links == 0 and got[i].kept for i in (900, 901, 902, 903, 904, 905, None))
    assert got[907].component_id == 906 and got[906].n_links == 1
    assert quantise.near_vectors(spark.createDataFrame([], kind)).count() == 0


def test_learners_are_averaged_in_levels(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(s, float(n + 1), rng.normal(size=5).astype(np.float32).tobytes()) for n in range(40) for s in (0, 1)]
    parts = spark.createDataFrame(rows, "slice int, seen double, values binary").repartition(3)
    want = [np.average([np.frombuffer(v, np.float32) for s, _, v in rows if s == k], axis=0, weights=[n for s, n, _ in rows if s == k]) for k in (0, 1)]
    for meeting in (256, 4):
        monkeypatch.setattr(recurrent, "MEETING", meeting)
        got = recurrent.common_learner(parts, len(rows), 2).orderBy("slice").collect()
        assert [r.seen for r in got] == [820.0, 820.0]
        assert np.allclose([np.frombuffer(r["values"], np.float32) for r in got], want, atol=1e-5)


def components_of(ids, near):
    """The least id that each reaches by a matrix of links."""
    least = np.array(ids)
    while True:
        lower = np.minimum(least, np.where(near, least[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == least).all():
            return least
        least = lower


@pytest.mark.parametrize("norm", [0.0, 0.7, 0.9, 0.95])
@pytest.mark.parametrize("length", [24, 96])
def test_embeddings_with_a_common_direction(spark, norm, length):
    """Links found, of those there are, whatever the norm of the unit vectors' mean."""
    rng = np.random.default_rng(int(norm * 100) + length)
    base = rng.normal(size=(150, length))
    made = np.concatenate([base, *(base + rng.normal(size=base.shape) * s for s in (0.15, 0.3, 0.4, 0.45))])
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    common = np.zeros(length)
    common[0] = norm / np.sqrt(1 - norm * norm)
    made = made + common
    x = made / np.linalg.norm(made, axis=1, keepdims=True)
    assert abs(np.linalg.norm(x.mean(axis=0)) - norm) < 0.1
    ids = np.arange(len(made)) * 3 + 1
    near = (x @ x.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    frame = spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, made)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in quantise.near_vectors(frame).collect()}
    have = np.array([got[int(i)].n_links for i in ids])
    want = near.sum(axis=1)
    assert (have <= want).all() and have.sum() >= 0.99 * want.sum()
    component = np.array([got[int(i)].component_id for i in ids])
    assert (component >= components_of(ids, near)).all()
    assert (component == components_of(ids, near)).mean() > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embeddings_of_many_lengths_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(quantise, "MAX_LENGTHS", 2)
    rng = np.random.default_rng(4)
    rows = []
    for length in (3, 5, 8, 13, 40):
        for i in range(20):
            v = rng.normal(size=length).tolist()
            rows += [(len(rows), v, 1, "i", 0, 0), (len(rows) + 1, [2.0 * t for t in v], 1, "j", 0, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, id string, code int, n_links int")
    got = {r.vec_id: r for r in quantise.near_vectors(frame).collect()}
    assert len(got) == 200 and all(got[i].n_links >= 1 for i in got)
    assert all(got[i + 1].component_id <= i for i in range(0, 200, 2))


def test_pipeline_on_awkward_and_empty_tables(spark, awkward, empty):
    for docs in (awkward, empty):
        given = docs
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF).cache()
            assert [c for c in docs.columns if c != "copy_no"] == [c for c in given.columns if c != "copy_no"]
        texts = Counter(r.text for r in docs.collect())
        assert set(texts) <= {t for _, t, _, _ in AWKWARD if t and any(c.isalpha() for c in t)}


def test_pipeline_stages_decide_like_their_operators(spark, documents):
    """Row by row: a stage keeps what its operator, run on the same rows, says."""
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    said = {r.doc_id: r.predicted for r in toxicity.toxicity(documents, marks).collect()}
    kept = corpus_pipeline.drop_toxic(spark, documents, SF)
    assert {r.doc_id for r in kept.collect()} == {i for i, p in said.items() if p == 0}
    accepted = {r.doc_id for r in language.languages(documents).collect() if r.accepted}
    known = corpus_pipeline.keep_known_language(spark, documents, SF)
    assert {r.doc_id for r in known.collect()} == accepted
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    few = documents.filter("doc_id < 60")
    found = {d for d, _ in brute_items([(r.doc_id, r.text) for r in few.collect()], items)}
    clean = corpus_pipeline.drop_contaminated(spark, few, SF)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in few.collect()} - found
    taken = {r.doc_id: r.copies for r in mixing.document_copies(documents).collect()}
    mixed = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, documents, SF).collect())
    assert mixed == Counter({i: n for i, n in taken.items() if n})


def test_pipeline(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert set(before.columns) <= set(docs.columns)
        if name != "mixing":
            assert docs.columns == documents.columns
            assert docs.exceptAll(before).count() == 0
        if name == "near_duplicates":
            want = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in want.items() if i == c}
        if name == "decontamination":
            items = [tokens(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall()]
            left = [b" " + b" ".join(tokens(r.text)) + b" " for r in docs.collect()]
            assert not any(b" " + b" ".join(i) + b" " in t for i in items for t in left)
    assert docs.count() > 0
