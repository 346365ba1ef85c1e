"""Exact duplicates, ranked search and the prefix trie against brute force, and on awkward rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import exact, prefixes, ranked

KIND = "doc_id long, text string, row string, page string, id long, score int, rank int, kept int"
AWKWARD = [
    (1, "The Cat"), (5, "the cat"), (5, "THE CAT"), (None, "the cat"), (2, None), (3, ""),
    (4, "É"), (6, "é"), (None, "alone"), (None, "Alone"), (7, "x " * 200_000), (8, "X " * 200_000),
    (9, "the  cat"), (-3, "below"), (10, "12 the-cat sat"),
]


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, "r", "p", 1, 2, 3, 4) for r in AWKWARD], KIND)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


# -- exact duplicates ---------------------------------------------------------------


def test_golomb_codes_round_trip():
    rng = np.random.default_rng(1)
    for n, span in ((1, 1), (1, 1000), (50, 60), (1000, 10**6), (3000, 2**40)):
        values = np.unique(rng.integers(0, span, n))
        for divisor in (0, 3, max(0, int(np.log2(0.69 * span / n + 1)))):
            if (span >> divisor) > 10**7:
                continue
            code = exact.golomb_encode(values, divisor)
            assert (exact.golomb_decode(*code, len(values), divisor) == values).all()
            assert len(code[1]) <= len(values) * divisor / 8 + 1
    gaps = exact.golomb_encode(np.unique(rng.integers(0, 2**30, 10_000)), 16)
    assert sum(map(len, gaps)) < 10_000 * 20 / 8  # under 20 bits each


def brute_groups(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[lower(text)].append(i)
    return Counter(
        (
            i,
            max((x for x in groups[lower(text)] if x is not None), default=None),
            len(groups[lower(text)]),
            hashlib.sha256(lower(text).encode()).hexdigest(),
        )
        for i, text in rows
    )


def check_groups(found, rows):
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == brute_groups(rows)
    kept = [r for r in found if r.kept]
    assert len({r.text_sha256 for r in kept}) == len(kept) == len({lower(t) for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_exact_duplicates(spark, monkeypatch, digest_bytes):
    monkeypatch.setattr(exact, "ROWS_PER_OWNER", 50)
    rows = [(i, f"text {i * i % 700} {'A' if i % 2 else 'a'}") for i in range(1500)]
    rows += [(2000 + i, "hot") for i in range(800)] + [(None, "hot")] * 3 + [(2001, "hot")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = exact.duplicates(docs, digest_bytes).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
    check_groups(found.collect(), rows)


def test_exact_duplicates_in_turns(spark, monkeypatch):
    monkeypatch.setattr(exact, "BROADCAST_PAGES", 2)
    rows = [(i, f"t{i % 90}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = exact.duplicates(docs).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
    check_groups(found.collect(), rows)


def test_exact_duplicates_awkward(awkward, empty):
    for parts in (1, 5):
        docs = awkward.repartition(parts)
        found = exact.duplicates(docs).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
        check_groups(found.collect(), AWKWARD)
        kept = exact.kept_rows(docs)
        assert kept.columns == awkward.columns
        assert Counter(lower(r.text) for r in kept.collect()) == Counter({lower(t) for _, t in AWKWARD})
    assert exact.duplicates(empty).count() == exact.kept_rows(empty).count() == 0


def test_a_page_read_in_parts():
    place = np.arange(600)
    digest = [hashlib.sha256(b"%d" % (i % 400)).digest() for i in place]
    column = [pa.array(place), pa.array(digest, pa.binary())]
    whole = pa.record_batch(column, names=["place", "digest"])
    sent = []
    for part in (whole.slice(0, 250), whole.slice(250)):  # two tasks
        sent += list(exact.send(iter([part]), 30, 3, -(-(1 << 30) // 3)))
    table = pa.Table.from_batches(sent)
    messages = table.filter(pa.compute.equal(table["kind"], 1))
    replies = pa.concat_tables(
        exact.answer(messages.filter(pa.compute.equal(messages["owner"], o))) for o in range(3)
    )
    words = exact.suspects_of_page(table.filter(pa.compute.equal(table["kind"], 0)), replies)["bits"][0].as_py()
    marked = {64 * w + b for w, word in enumerate(words) for b in range(64) if word >> b & 1}
    assert marked == {i for i in range(600) if i < 200 or i >= 400}


# -- ranked search ------------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def brute_ranks(docs, items, k=20):
    vectors = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(v) for _, v in vectors)
    total = sum(sum(v.values()) for _, v in vectors)
    df = Counter(t for _, v in vectors for t in v)
    out = Counter()
    for item, text in items:
        asked = terms(text)
        scores = []
        for i, v in vectors:
            n = sum(v.values())
            m = 75 + (25 * n * n_docs) // max(1, total)
            s = sum(
                floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * v[t] // (1000 * v[t] + 12 * m))
                for t in asked
                if v[t]
            )
            if s > 0:
                scores.append((-s, i is None, i or 0))
        for rank, (s, none, i) in enumerate(sorted(scores)[:k], 1):
            out[item, rank, None if none else i, -s] += 1
    return out


def found_ranks(docs, items, k=20):
    rows = ranked.top_documents(docs, items, k).collect()
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in rows)


def random_texts(rng, n, words, longest):
    vocabulary = [f"w{i}" for i in range(words)]
    weight = 1 / np.arange(1, words + 1)
    draw = lambda: rng.choice(vocabulary, rng.integers(0, longest), p=weight / weight.sum())
    return [" ".join(draw()) for _ in range(n)]


@pytest.mark.parametrize(("k", "terms_at_once", "block"), [(20, 1 << 14, 2048), (3, 300, 40), (1, 64, 17)])
def test_ranked_search(spark, monkeypatch, k, terms_at_once, block):
    monkeypatch.setattr(ranked, "BATCH_TERMS", terms_at_once)
    monkeypatch.setattr(ranked, "BLOCK_DOCS", block)
    rng = np.random.default_rng(k)
    docs = list(enumerate(random_texts(rng, 400, 300, 60)))
    docs += [(1000 + i, docs[i % 5][1]) for i in range(60)]  # ties
    items = list(enumerate(random_texts(rng, 12, 300, 30)))
    items += [(100, docs[7][1]), (101, docs[7][1] + " " + docs[7][1])]
    frames = (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert found_ranks(*frames, k) == brute_ranks(docs, items, k)


def test_pairs_are_left_out_whole():
    """Five terms of an item are at most five times the best score of one term."""
    idf = np.full(50, 1000)
    tree = ranked.item_tree([np.arange(5 * i, 5 * i + 5) for i in range(10)], idf)
    tfs = np.ones(400, np.int64)
    block = ranked.doc_block(
        list(range(400)), np.full(400, 3), np.arange(400) % 50, tfs, np.arange(401), 400, 1200, idf
    )
    exact_scores = np.array([[ranked.leaf_scores(tree, block, i, d).max() for d in range(25)] for i in range(10)])
    assert not list(ranked.dual_search(tree, block, np.full(10, 6.0 * exact_scores.max())))
    bar = exact_scores.max(axis=1).astype(float)
    kept = set(ranked.dual_search(tree, block, bar))
    assert {(i, d) for i, d in np.argwhere(exact_scores >= bar[:, None]).tolist()} <= kept
    assert len(kept) < exact_scores.size / 2


def test_ranked_search_awkward(spark, awkward, empty):
    made = [(1, "the cat sat"), (1, "alone"), (None, "É 12"), (2, None), (3, ""), (4, "- !"), (5, "nowhere"), (6, "x")]
    items = spark.createDataFrame([(*r, 9) for r in made], "item_id long, text string, doc_id int")
    got = found_ranks(awkward.repartition(3), items)
    assert got == brute_ranks(AWKWARD, made)
    none = items.limit(0)
    for docs, of in ((empty, items), (awkward, none), (empty, none)):
        assert ranked.top_documents(docs, of).count() == 0


# -- prefix trie --------------------------------------------------------------------


def brute_trie(rows):
    def key(r):
        role, text = r[2] or "", r[3] or ""
        told = f"{len(role.encode())}:{role}{text}".encode()
        return (r[1] is not None, r[1] or 0, hashlib.sha256(told).hexdigest()[:32])

    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own[r[0]].append((r[2] or "", r[3] or ""))
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        first = c - (c % 5 if c >= 0 else -(-c % 5))
        whole[c] = tuple(own.get(first, [])[:h] + own[c][h:])
    nodes = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    out = Counter()
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = sorted(c for c in members if len(whole[c]) == len(path))
        out[
            min(members),
            len(path),
            min(nodes[path[:-1]]) if path else None,
            len(members),
            children[path],
            sum(not children[p] for p in below),
            sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ] += 1
    return out


def found_trie(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(tuple(r) for r in prefixes.prefix_trie(df).select(*names).collect())


CONVERSATION = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("range_keys", [1000, 3])
def test_prefix_trie(spark, monkeypatch, range_keys):
    monkeypatch.setattr(prefixes, "RANGE_KEYS", range_keys)
    monkeypatch.setattr(prefixes, "ID_BLOCK", 7)
    rng = np.random.default_rng(3)
    rows = []
    for c in range(-20, 150):
        if c % 11 == 3:
            continue
        for t in range(int(rng.integers(1, 12))):
            rows.append((c, t, ["user", "assistant"][t % 2], f"say {rng.integers(0, 2)}"))
    rows += [(500 + 5 * i, t, "user", "same") for i in range(40) for t in range(3)]  # one key, many times
    rows += [(900, t, "user", f"deep {t}") for t in range(300)]
    df = spark.createDataFrame(rows, CONVERSATION).repartition(4)
    assert found_trie(df) == brute_trie(rows)


def test_prefix_trie_wide(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "RANGE_KEYS", 100)
    rows = [(i, 0, "user", f"first {i}") for i in range(600)] + [(i, 1, "user", "next") for i in range(600)]
    assert found_trie(spark.createDataFrame(rows, CONVERSATION)) == brute_trie(rows)


def test_prefix_trie_awkward(spark):
    rows = [
        (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 0, "", "user"), (None, 1, "user", "lost"),
        (2, 5, "user", "é" * 30_000), (3, 5, "user", "é" * 30_000), (2, 1, None, "a"), (7, 1, "a", "b"), (5, 1, "a", "b"),
        (8, 1, "us", "er"), (9, 1, "u", "ser"), (0, 2, "x", None),
    ]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], f"{CONVERSATION}, key string, depth int")
    assert found_trie(df) == brute_trie(rows)
    assert prefixes.prefix_trie(df.limit(0)).count() == 0
    assert prefixes.prefix_trie(df.filter("conv_id IS NULL")).count() == 0


def test_radix_tree_layouts_hold_all_keys():
    rng = np.random.default_rng(0)
    keys = {bytes(rng.integers(0, 256, rng.integers(1, 9)).astype(np.uint8)) for _ in range(5000)}
    keys |= {b"\x01" * i for i in range(1, 300)}
    root = prefixes.Node(b"")
    for key in keys:
        prefixes.insert(root, key, key)
    found, kinds, stack = [], set(), [(root, b"")]
    while stack:
        node, path = stack.pop()
        path += node.path
        if node.value is not None:
            assert node.value == path
            found.append(path)
        if node.kids:
            kinds.add(getattr(node.kids, "size", type(node.kids).__name__))
            stack += [(kid, path) for kid in reversed(node.kids.ordered())]
    assert found == sorted(keys) and kinds == {4, 16, "Indexed", "Full"}
