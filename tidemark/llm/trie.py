"""Token counts by dynamic programming over a trie of distinct pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.words import BASE, CASED, powers, slices, split

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE_MARK = "▁".encode()  # before every word, as the vocabulary has it
RANK_SHIFT = 2.7  # of Zipf's law, by which a piece's rank gives its probability
BYTE_PENALTY = 10.0
LONG_WORD = 128  # bytes; longer ones go through their trie depth first
COUNT_SLICE = 8 << 20
FILTER_BITS = 20


class Vocabulary(NamedTuple):
    """Pieces as bytes with their scores; and, for each length, hashes in order."""

    score: dict[bytes, float]
    byte_score: float
    hashes: dict[int, tuple[np.ndarray, np.ndarray]]
    filter: np.ndarray


def piece_hash(piece: bytes) -> int:
    value = 0
    for byte in piece:
        value = (value * int(BASE) + byte + 1) % (1 << 64)
    return value


def build_vocabulary(pieces: list[bytes]) -> Vocabulary:
    """Pieces by falling frequency; log probabilities follow Zipf's law."""
    score = {}
    for rank, piece in enumerate(pieces):
        score.setdefault(piece, -float(np.log(rank + RANK_SHIFT)))
    least = min(score.values(), default=0.0) - BYTE_PENALTY
    hashes, sieve = {}, np.zeros(1 << FILTER_BITS, bool)
    for n in sorted({len(p) for p in score}):
        mine = sorted((piece_hash(p), s) for p, s in score.items() if len(p) == n)
        key = np.array([h for h, _ in mine], np.uint64)
        hashes[n] = (key, np.array([s for _, s in mine]))
        sieve[(key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Vocabulary(score, least, hashes, sieve)


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """The ordinary pieces of a sentencepiece model, in its order of rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [
        i
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    usual.sort(key=lambda i: (-model.get_score(i), i))
    return build_vocabulary([model.id_to_piece(i).encode() for i in usual])


class Trie:
    """Nodes level by level; each holds its prefix's best score and number of tokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.power = powers(max(vocabulary.hashes, default=0))
        self.parent = np.array([-1], np.int64)
        self.hash = np.zeros(1, np.uint64)
        self.score = np.zeros(1)
        self.tokens = np.zeros(1, np.int64)

    def add(self, parent: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Nodes below ``parent``; their scores come from their ancestors' alone."""
        first = len(self.parent)
        own = self.hash[parent] * BASE + byte.astype(np.uint64) + np.uint64(1)
        score = self.score[parent] + self.vocabulary.byte_score
        tokens = self.tokens[parent] + 1
        above, steps = parent, 1
        alive = np.arange(len(parent))
        shift = np.uint64(64 - FILTER_BITS)
        for n, (key, scores) in self.vocabulary.hashes.items():
            while steps < n:
                above, steps = self.parent[above], steps + 1
                inside = above >= 0
                if not inside.all():
                    above, alive = above[inside], alive[inside]
            if not len(alive):
                break
            part = own[alive] - self.hash[above] * self.power[n]
            maybe = np.flatnonzero(self.vocabulary.filter[(part >> shift).astype(np.int64)])
            at = np.minimum(np.searchsorted(key, part[maybe]), len(key) - 1)
            hit = key[at] == part[maybe]
            node, start, gain = alive[maybe[hit]], above[maybe[hit]], scores[at[hit]]
            total, number = self.score[start] + gain, self.tokens[start] + 1
            better = (total > score[node]) | ((total == score[node]) & (number < tokens[node]))
            score[node[better]] = total[better]
            tokens[node[better]] = number[better]
        self.parent = np.concatenate([self.parent, parent])
        self.hash = np.concatenate([self.hash, own])
        self.score = np.concatenate([self.score, score])
        self.tokens = np.concatenate([self.tokens, tokens])
        return np.arange(first, len(self.parent))

    def insert(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Token counts of distinct words, all put in at once, a level at a time."""
        root = np.array([0])
        for byte in SPACE_MARK:
            root = self.add(root, np.array([byte]))
        node = np.full(len(start), root[0])
        active = np.arange(len(start))
        level = 0
        while True:
            active = active[length[active] > level]
            if not len(active):
                return self.tokens[node]
            edge = node[active] * 256 + data[start[active] + level]
            new, place = np.unique(edge, return_inverse=True)
            node[active] = self.add(new // 256, new % 256)[place]
            level += 1


def _shared(one: bytes, two: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(one), len(two))
    while low < high:
        middle = (low + high + 1) // 2
        if one[:middle] == two[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def count_long(words: list[bytes], vocabulary: Vocabulary) -> list[int]:
    """Token counts of distinct long words: their trie, walked depth first.

    Sorted words visit each node of the trie once, and the scores of the path to it are
    all that is held: a word goes on from the prefix that it shares with the one before.
    A level of the other walk costs the same for one word as for many, so few words of
    very many bytes are cheaper this way.
    """
    lengths = list(vocabulary.hashes)
    counts, before, path = [0] * len(words), b"", [(0.0, 0)]
    for i in sorted(range(len(words)), key=words.__getitem__):
        text = SPACE_MARK + words[i]
        del path[_shared(before, text) + 1 :]
        for end in range(len(path), len(text) + 1):
            score, tokens = path[end - 1]
            found = (score + vocabulary.byte_score, -tokens - 1)
            for n in lengths:
                if n > end:
                    break
                own = vocabulary.score.get(text[end - n : end])
                if own is not None:
                    score, tokens = path[end - n]
                    found = max(found, (score + own, -tokens - 1))
            path.append((found[0], -found[1]))
        counts[i], before = path[-1][1], text
    return counts


def count_slice(
    data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary
) -> tuple[np.ndarray, np.ndarray]:
    """Words and tokens of each text of a slice."""
    words = split(data, offsets, case=CASED)
    rows = len(offsets) - 1
    _, first, place = np.unique(words.hash, return_index=True, return_inverse=True)
    start, length = words.start[first], words.length[first]
    tokens = np.zeros(len(first), np.int64)
    short = length <= LONG_WORD
    tokens[short] = Trie(vocabulary).insert(data, start[short], length[short])
    long = [data[a : a + n].tobytes() for a, n in zip(start[~short], length[~short], strict=True)]
    tokens[~short] = count_long(long, vocabulary)
    sums = np.bincount(words.row, tokens[place], rows).astype(np.int64)
    return np.bincount(words.row, minlength=rows), sums


def token_counts(docs: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of ``docs``.

    Pre-tokens are runs of non-space bytes behind a space mark, and a text's
    tokens are those of the best unigram segmentation of each.  Within a slice
    of texts the distinct pre-tokens are put into one trie, where the score of a
    prefix is computed once for all pre-tokens that share it; the node at a
    pre-token's end has its count.  Nothing is shuffled, and memory follows the
    slice.

    A null or empty text has no words and no tokens; repeated rows are counted
    one by one; ids are passed through, null or not; an empty table gives no rows; other
    columns are not looked at.  The vocabulary file, of
    bounded size, is read by the driver and sent to the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary or read_vocabulary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(1), COUNT_SLICE):
                n_words, n_tokens = count_slice(data, offsets, shared.value)
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n_words), pa.array(n_tokens)],
                    names=["doc_id", "n_words", "n_tokens"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long")
