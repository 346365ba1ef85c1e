"""Words and where they are found: what they cost, and that no chunk or run of bits changes them."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa

from tidemark.llm import words

MASK = (1 << 64) - 1


def took(work):
    start = time.process_time()
    work()
    return time.process_time() - start


def least(*works):
    """Each one's least time of several, taken in turn."""
    times = [[took(work) for work in works] for _ in range(7)]
    return [min(own) for own in zip(*times, strict=True)]


def one_hash(word: bytes) -> int:
    value = sum((b + 1) * pow(int(words.BASE), i, 1 << 64) for i, b in enumerate(word.lower())) & MASK
    return int(words.mix(np.array([value], np.uint64))[0])


def test_words_cost_a_few_passes_over_their_bytes():
    rng = np.random.default_rng(3)
    text = b" ".join(bytes(rng.integers(97, 123, n, np.uint8)) for n in rng.integers(2, 10, 250_000))
    data, offsets = words.texts(pa.array([text[i : i + 3000] for i in range(0, len(text), 3000)], pa.binary()))
    parts = np.split(data, range(1 << 14, len(data), 1 << 14))
    table, some = np.arange(256, dtype=np.uint64), np.arange(0, 1 << 14, 6)

    def passes():
        for part in parts[:-1]:
            np.add.reduceat(table.take(part), some)

    cost, pace = least(lambda: words.split(data, offsets), passes)
    assert cost / pace < 6.5, cost / pace  # 10.5 before places were counted from the chunk, 4.1 now


def test_places_cost_less_than_a_search():
    rng = np.random.default_rng(4)
    known = np.unique(rng.integers(0, MASK, 200_000, np.uint64))
    asked = rng.choice(known, 300_000)
    places = words.Places(known)
    cost, search = least(lambda: places.of(asked), lambda: np.searchsorted(known, asked))
    assert cost < search / 2, cost / search


def test_words_are_the_same_whatever_the_chunks(monkeypatch):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"aBcZ\xc3\xa9\x00.  \t\n", np.uint8)
    for chunk in (1, 2, 7, 64, 1 << 16):
        monkeypatch.setattr(words, "CHUNK", chunk)
        words._common_powers.cache_clear()
        for _ in range(25):
            made = [rng.choice(letters, int(n)).tobytes() for n in rng.integers(0, 40, int(rng.integers(0, 9)))]
            made += [b"", b"Long" * 60 + b" " + b"x" * 90, b"", b"end"]
            found = words.split(*words.texts(pa.array(made, pa.binary())))
            apart = [(i, w) for i, t in enumerate(made) for w in t.split()]
            assert found.row.tolist() == [i for i, _ in apart]
            assert found.length.tolist() == [len(w) for _, w in apart]
            assert found.hash.tolist() == [one_hash(w) for _, w in apart]
            whole = b"".join(made)
            spans = zip(found.start.tolist(), found.length.tolist(), strict=True)
            assert [whole[s : s + n] for s, n in spans] == [w for _, w in apart]
    words._common_powers.cache_clear()


def test_places_are_those_of_a_search():
    rng = np.random.default_rng(6)
    ends = np.array([0, 1, MASK - 1, MASK], np.uint64)
    for n in (0, 1, 2, 50, 4000):
        spread = np.unique(rng.integers(0, MASK, n, np.uint64, endpoint=True))
        for known in (spread, np.arange(n, dtype=np.uint64), np.unique(np.append(spread, ends))):
            asked = np.concatenate([known, rng.integers(0, MASK, 300, np.uint64), ends])
            assert words.Places(known).of(asked).tolist() == np.searchsorted(known, asked).tolist()
