"""Benchmark decontamination by SimHash of item-sized windows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import bounds, mix, shingles, slices, split

SHINGLE = 5  # words
ANCHORS_AT_ONCE, WINDOWS_AT_ONCE = 1 << 19, 1 << 15
PERCENT = 80
BLOCKS, BLOCK_BITS = 8, 8
BLOCK_RADIUS = 2  # bits that may differ in the block that differs least
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1  # so 23 of 64 bits
INDEX_WORDS = 1_000_000  # benchmark words of one pass over the documents
WINDOW_SLICE = 1 << 20  # bytes of text at a time

FLIPS = np.array(
    [sum(1 << b for b in bits) for n in range(BLOCK_RADIUS + 1) for bits in combinations(range(BLOCK_BITS), n)],
    np.int64,
)


class Index(NamedTuple):
    """One pass's items: fingerprints in one table per block, and their shingles."""

    item: np.ndarray  # ids, None where an item has none
    size: np.ndarray  # words
    shingles: list[np.ndarray]  # of each item, with repeats
    prints: np.ndarray  # uint64
    table: np.ndarray  # (size, block, value) as one number, ascending
    table_item: np.ndarray
    anchor: dict[int, tuple[np.ndarray, np.ndarray]]  # by shingle length: shingle, size


def fingerprints(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """SimHash of values[start:end] for each window: the majority of every bit, each
    shingle counting as often as it occurs."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(values) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=sums[1:])
    ones = sums[ends] - sums[starts]
    most = ones * 2 > (ends - starts)[:, None]
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()


def keys(size: np.ndarray, prints: np.ndarray, block: int) -> np.ndarray:
    value = (prints >> np.uint64(block * BLOCK_BITS)).astype(np.int64) & ((1 << BLOCK_BITS) - 1)
    return (size.astype(np.int64) * BLOCKS + block) << BLOCK_BITS | value


def build_index(ids: list[int | None], word_hashes: list[np.ndarray]) -> Index:
    size = np.array([len(w) for w in word_hashes], np.int64)
    sets = [shingles(w, min(SHINGLE, len(w))) for w in word_hashes]
    prints = np.array(
        [fingerprints(s, np.array([0]), np.array([len(s)]))[0] for s in sets], np.uint64
    )
    table = np.concatenate([keys(size, prints, b) for b in range(BLOCKS)])
    order = np.argsort(table, kind="stable")
    anchor = {}
    for k in sorted({min(SHINGLE, int(n)) for n in size}):
        mine = [i for i in range(len(sets)) if min(SHINGLE, int(size[i])) == k]
        both = np.unique(
            np.array([(s, size[i]) for i in mine for s in sets[i].tolist()], np.uint64), axis=0
        )
        anchor[k] = (both[:, 0].copy(), both[:, 1].astype(np.int64))
    item_of = np.tile(np.arange(len(ids)), BLOCKS)[order]
    return Index(np.array(ids, object), size, sets, prints, table[order], item_of, anchor)


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of [lo, hi) after one another, and which range each is from."""
    number = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(lo)), number)
    first = np.repeat(np.cumsum(number) - number, number)
    return np.arange(len(which)) - first + lo[which], which


def lookup(index: Index, size: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of equal size whose fingerprints differ in at most RADIUS bits.

    If two fingerprints differ in that many bits, some block differs in at most
    BLOCK_RADIUS, so looking up each block with up to that many bits flipped
    finds all of them.
    """
    found = []
    for block in range(BLOCKS):
        probe = (keys(size, prints, block)[:, None] ^ FLIPS).ravel()
        lo = np.searchsorted(index.table, probe, "left")
        hi = np.searchsorted(index.table, probe, "right")
        place, which = ranges(lo, hi)
        window, item = which // len(FLIPS), index.table_item[place]
        near = np.bitwise_count(prints[window] ^ index.prints[item]) <= RADIUS
        found.append(window[near] * len(index.item) + item[near])
    both = np.unique(np.concatenate(found))
    return both // len(index.item), both % len(index.item)


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Shared and joint weight of two shingle lists, a shingle weighing its number."""
    one, two = Counter(a.tolist()), Counter(b.tolist())
    shared = sum(min(n, two[s]) for s, n in one.items() if s in two)
    return shared, len(a) + len(b) - shared


def pieces(number: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbouring entries that have about ``most`` together, at least one each."""
    total, lo = np.cumsum(number), 0
    while lo < len(number):
        before = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, before + most, "right")))
        yield slice(lo, hi)
        lo = hi


def windows(
    index: Index, k: int, values: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, size) of all windows worth a fingerprint: as many words as an item has,
    and with at least one shingle of an item of that size.  Any other window shares
    nothing with the items of its size.  A shorter text is one window itself.

    ``values`` are the k-word shingles; a text's words are [start, end).  A shingle's
    windows of one size begin in an interval; intervals that touch are joined before
    they are listed, a bounded number at once, so a text that repeats an item's
    shingle over and over takes no more memory than any other.
    """
    shingle, sizes = index.anchor[k]
    lo = np.searchsorted(shingle, values, "left")
    met = np.flatnonzero((lo < len(shingle)) & (shingle[np.minimum(lo, len(shingle) - 1)] == values))
    lo, hi = lo[met], np.searchsorted(shingle, values[met], "right")
    for part in pieces(hi - lo, ANCHORS_AT_ONCE):
        place, which = ranges(lo[part], hi[part])
        at, size = met[part][which], sizes[place]
        text = np.searchsorted(starts, at, "right") - 1
        inside = at + k <= ends[text]
        at, size, text = at[inside], size[inside], text[inside]
        if not len(at):
            continue
        last = np.maximum(np.minimum(at, ends[text] - size), starts[text])
        first = np.maximum(np.minimum(at - size + k, last), starts[text])
        order = np.lexsort((first, size))
        apart = size[order] << 32  # beyond every place of the size before
        first, reach = apart + first[order], np.maximum.accumulate(apart + last[order])
        new = np.append(True, first[1:] > reach[:-1] + 1)
        begin, end = first[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)] + 1
        steps = -(-(end - begin) // WINDOWS_AT_ONCE)
        step, of = ranges(np.zeros_like(steps), steps)
        begin, end = begin[of] + step * WINDOWS_AT_ONCE, end[of]
        end = np.minimum(end, begin + WINDOWS_AT_ONCE)
        for some in pieces(end - begin, WINDOWS_AT_ONCE):
            both, _ = ranges(begin[some], end[some])
            yield both & ((1 << 32) - 1), both >> 32


def hits(index: Index, hashes: np.ndarray, cut: np.ndarray) -> list[tuple]:
    """(text, item, first word, words, shared, joint) of each text's best window per item."""
    starts, ends = cut[:-1], cut[1:]
    filled = ends > starts
    text_of = np.flatnonzero(filled)
    starts, ends = starts[filled], ends[filled]
    best: dict[tuple[int, int], tuple] = {}
    for k in index.anchor if len(starts) else ():
        values = shingles(hashes, k)
        totals = np.append(np.uint64(0), np.cumsum(mix(values)))
        for start, size in windows(index, k, values, starts, ends):
            text = np.searchsorted(starts, start, "right") - 1
            end = np.minimum(start + size, ends[text])
            # Of a text's windows with the same shingles the first is enough.
            content = np.stack([text, size, (totals[end - k + 1] - totals[start]).view(np.int64)], axis=1)
            first = np.sort(np.unique(content, axis=0, return_index=True)[1])
            start, size, text, end = start[first], size[first], text[first], end[first]
            used = np.zeros(len(values) + 1, np.int32)
            np.add.at(used, start, 1)
            np.add.at(used, end - k + 1, -1)
            places = np.flatnonzero(np.cumsum(used[:-1]) > 0)
            prints = fingerprints(
                values[places],
                np.searchsorted(places, start),
                np.searchsorted(places, start) + (end - k + 1 - start),
            )
            for w, i in zip(*lookup(index, size, prints), strict=True):
                key = (int(text_of[text[w]]), int(i))
                if key in best and best[key][0][0] == -1:
                    continue  # windows come from the left, and no later one is better
                own = values[start[w] : end[w] - k + 1]
                shared, joint = similarity(own, index.shingles[i])
                if shared * 100 >= joint * PERCENT:
                    rank = (-shared / joint, int(start[w] - starts[text[w]]))
                    if key not in best or rank < best[key][0]:
                        best[key] = (rank, int(end[w] - start[w]), shared, joint)
    return [(t, i, r[1], n, s, j) for (t, i), (r, n, s, j) in sorted(best.items())]


def find_items(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to one row per document and item found in it."""
    index = index.value
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1), WINDOW_SLICE):
            words = split(data, offsets)
            found = hits(index, words.hash, bounds(words.row, hi - lo))
            rows = pa.array([lo + f[0] for f in found], pa.int64())
            yield pa.record_batch(
                [
                    batch.column(0).take(rows),
                    pa.array([index.item[f[1]] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.int64()),
                    pa.array([f[4] / f[5] for f in found], pa.float64()),
                ],
                names=["doc_id", "item_id", "first_word", "n_words", "similarity"],
            )


def item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            words = split(data, offsets)
            ends = pa.array(bounds(words.row, hi - lo), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(words.hash.view(np.int64)))
            yield pa.record_batch(
                [batch.column(0).slice(lo, hi - lo), lists], names=["item_id", "words"]
            )


def keep_clean(batches: Iterator[pa.RecordBatch], index) -> Iterator[pa.RecordBatch]:
    """(row, text) to the rows in whose text no item is found."""
    index = index.value
    for batch in batches:
        found = np.zeros(batch.num_rows, bool)
        for lo, hi, data, offsets in slices(batch.column(1), WINDOW_SLICE):
            words = split(data, offsets)
            for hit in hits(index, words.hash, bounds(words.row, hi - lo)):
                found[lo + hit[0]] = True
        rows = batch.column(0).filter(pa.array(~found))
        yield pa.record_batch([rows], names=["row"])


def item_classes(benchmark: DataFrame) -> DataFrame:
    """(item_id, class_id, words): items of equal words are one class, named by its least
    id, or by null if none of them has an id."""
    items = benchmark.select(
        F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text")
    )
    hashed = items.mapInArrow(item_words, "item_id long, words array<long>")
    least = hashed.groupBy("words").agg(F.min("item_id").alias("class_id"))
    return hashed.filter(F.size("words") > 0).join(least, "words").select(
        "item_id", "class_id", "words"
    )


def indexes(benchmark: DataFrame, scratch: Scratch) -> Iterator:
    """Broadcast indexes of all items, about INDEX_WORDS words each.  Items are told apart
    by their words, so neither a repeated nor a missing id leaves a text out."""
    items = item_classes(benchmark).groupBy("words").agg(F.min("class_id").alias("class_id"))
    items = scratch.save(items.select("class_id", "words"), "items")
    total = items.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).first()[0]
    parts = total // INDEX_WORDS + 1
    for part in range(parts):
        own = items.filter(F.pmod(F.xxhash64("words"), F.lit(parts)) == part)
        rows = own.orderBy("class_id", "words").collect()  # about INDEX_WORDS words
        if rows:
            words = [np.array(r["words"], np.int64).view(np.uint64) for r in rows]
            index = build_index([r["class_id"] for r in rows], words)
            yield benchmark.sparkSession.sparkContext.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, similarity): items found in documents.

    Every window of a document that has as many words as an item is compared
    with the items of that size: their SimHash fingerprints by multi-index
    Hamming lookup, then, within the radius, by exact weighted similarity of
    their five-word shingles (shared over joint numbers), which must reach 0.8.
    One row per document and item tells the best window; of windows alike, the
    first.  Items of fewer words are one shingle, and match only word for word.

    Words are runs of non-space bytes, A-Z lower-cased.  Items of equal words are
    one; ``item_classes`` has the members.  Null or empty texts and items match
    nothing; rows that repeat are each searched; a null doc_id or item_id is
    reported as null; of an id with several texts each is an item.  Very long texts are
    searched in slices, and windows listed a bounded number at a time.  An empty
    table on either side gives no rows; other columns are not looked at.  The benchmark
    is taken INDEX_WORDS at a time: each part is one index, so bounded, and one
    pass over the documents.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    kind = "doc_id long, item_id long, first_word long, n_words long, similarity double"
    found = part = None
    for turn, index in enumerate(indexes(benchmark, scratch)):
        if part is not None:
            # written, so that its index can go before the next one comes
            part = scratch.save(part, f"hits-{turn}")
            before.unpersist()
            found = part if found is None else found.union(part)
        part, before = texts.mapInArrow(partial(find_items, index=index), kind), index
    if part is None:
        return spark.createDataFrame([], kind)
    return part if found is None else found.union(part)


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item is found.

    Each row is judged by its own text; its id, repeated or null, decides nothing.
    What one part of the benchmark leaves is written before the next part's pass.
    """
    scratch = Scratch(docs.sparkSession, "clean")
    left, before = docs, None
    for turn, index in enumerate(indexes(benchmark, scratch)):
        if turn:
            left = scratch.save(left, f"left-{turn}")
            if before:
                scratch.drop(before)
            before = f"left-{turn}"
        own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
        rows = left.select(own, F.col("text").cast("binary").alias("text"))
        kind = T.StructType([rows.schema["row"]])
        left = rows.mapInArrow(partial(keep_clean, index=index), kind).select("row.*")
    return left
