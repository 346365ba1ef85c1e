"""Ranked lexical search by dual trees.

Items and documents are sparse vectors over the items' terms, none of them negative,
and a score is their inner product.  Both sides are trees whose nodes hold the largest
value of each coordinate, so the product of two nodes bounds every score below them.
A pair of nodes is left out when it is under the weakest k-th score that any of its
items has so far; what is left at the leaves is scored exactly, in whole numbers.

Documents are dealt into blocks, each a tree of its own.  A first pass scores the best
leaf of every block for every item, which gives all tasks a k-th score to start from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import NOT_LETTERS, bounds, slices, split

BATCH_TERMS = 1 << 14  # terms of the items that are searched together
ITEM_COST = 64  # an item counts as so many terms at least
BLOCK_DOCS = 2_048
BLOCK_CELLS = 1 << 25  # a block has so many documents times terms at most
SALTS = 64  # parts of an item's scores that are cut to k before they meet
LEAF_DOCS, LEAVES = 16, 8  # documents of a leaf, and children of the nodes above
LEAF_ITEMS, FAN = 4, 8
VECTOR = "doc_id long, n long, terms array<int>, tfs array<long>"
SLACK = 1 + 1e-9  # bounds are sums of doubles, scores of whole numbers


# -- terms -------------------------------------------------------------------------


def text_terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of terms, where each row's begin) over slices of a column."""
    for lo, hi, data, offsets in slices(column):
        found = split(data, offsets, NOT_LETTERS)
        yield lo, found.hash, bounds(found.row, hi - lo)


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, text) to (item_id, terms)."""
    for batch in batches:
        for lo, hashes, cut in text_terms(batch.column(1)):
            lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(hashes.view(np.int64)))
            ids = batch.column(0).slice(lo, len(cut) - 1)
            yield pa.record_batch([ids, lists], names=["item_id", "terms"])


def doc_vectors(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to term counts over the known terms; n counts all terms."""
    known = known.value  # sorted hashes
    for batch in batches:
        for lo, hashes, cut in text_terms(batch.column(1)):
            rows = len(cut) - 1
            at = np.searchsorted(known, hashes)
            at[at == len(known)] = 0
            here = np.flatnonzero(known[at] == hashes) if len(known) else np.zeros(0, np.int64)
            row = np.searchsorted(cut, here, "right") - 1
            pairs, tfs = np.unique(row * (len(known) + 1) + at[here], return_counts=True)
            row, terms = np.divmod(pairs, len(known) + 1)
            ends = pa.array(bounds(row, rows), pa.int32())
            yield pa.record_batch(
                [
                    batch.column(0).slice(lo, rows),
                    pa.array(np.diff(cut), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tfs.astype(np.int64))),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )


def term_documents(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """The task's (term, df), a row for each known term it saw."""
    counts = np.zeros(n_terms, np.int64)
    for batch in batches:
        counts += np.bincount(flat(batch.column(0))[0], minlength=n_terms)
    seen = np.flatnonzero(counts)
    yield pa.record_batch(
        [pa.array(seen, pa.int32()), pa.array(counts[seen])], names=["term", "df"]
    )


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and where each row's begin."""
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy()[offsets[0] : offsets[-1]], offsets - offsets[0]


# -- trees -------------------------------------------------------------------------


def grouped_maxima(rows: np.ndarray, size: int) -> np.ndarray:
    """The largest value of each coordinate over every ``size`` neighbouring rows."""
    return np.maximum.reduceat(rows, np.arange(0, len(rows), size), axis=0)


class Items(NamedTuple):
    """Items in the order of their leaves: exact vectors, and a level of maxima each
    time nodes are joined.  ``number`` is the item's place in the batch."""

    number: np.ndarray
    terms: list[np.ndarray]
    weights: list[np.ndarray]  # times repeats, whole numbers
    levels: list[np.ndarray]  # from single items up to the root
    idf: np.ndarray


def item_tree(items: list[np.ndarray], idf: np.ndarray) -> Items:
    """Items with the same rarest term come to stand side by side."""
    found = [np.unique(i, return_counts=True) for i in items]
    pairs = [(t, c.astype(np.int64) * idf[t]) for t, c in found]
    lead = [tuple(t[np.argsort(-w, kind="stable")][:3].tolist()) for t, w in pairs]
    number = np.array(sorted(range(len(items)), key=lead.__getitem__), np.int64)
    level = np.zeros((len(items), len(idf)))
    for row, i in enumerate(number.tolist()):
        level[row, pairs[i][0]] = pairs[i][1]
    levels = [level]
    for fan in (LEAF_ITEMS, *[FAN] * 64):
        if len(levels[-1]) > 1:
            levels.append(grouped_maxima(levels[-1], fan))
    return Items(number, [pairs[i][0] for i in number], [pairs[i][1] for i in number], levels, idf)


class Block(NamedTuple):
    """A document tree; rows are documents in the order of their leaves."""

    ids: list
    values: np.ndarray  # exact coordinates, documents by the block's terms
    local: np.ndarray  # the block's place of each known term, -1 if it has none
    levels: list[np.ndarray]  # from leaves up to the root


def doc_block(ids: list, n: np.ndarray, terms: np.ndarray, tfs: np.ndarray, cut: np.ndarray, n_docs: int, total: int, idf: np.ndarray) -> Block:
    """Documents with the same weightiest term come to stand side by side."""
    row = np.repeat(np.arange(len(ids)), np.diff(cut))
    m = np.array([75 + (25 * int(k) * n_docs) // total for k in n], np.int64)
    value = (1_000_000_000 * tfs) // (1_000 * tfs + 12 * m[row])
    worth = value * idf[terms]
    own = np.lexsort((-worth, row))
    first = cut[:-1][np.diff(cut) > 0]
    lead = np.full(len(ids), len(idf))
    lead[row[own[first]]] = terms[own[first]]
    most = np.zeros(len(ids), np.int64)
    most[row[own[first]]] = worth[own[first]]
    order = np.lexsort((-most, lead))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    used = np.unique(terms)
    local = np.full(len(idf), -1)
    local[used] = np.arange(len(used))
    values = np.zeros((len(ids), max(1, len(used))), np.int32)  # each under a million
    values[place[row], local[terms]] = value
    levels = [grouped_maxima(values, LEAF_DOCS).astype(np.float64)]
    while len(levels[-1]) > 1:
        levels.append(grouped_maxima(levels[-1], LEAVES))
    return Block([ids[i] for i in order], values, local, levels)


# -- search ------------------------------------------------------------------------


def project(items: Items, block: Block) -> list[np.ndarray]:
    """The items' levels over the block's terms."""
    used = np.flatnonzero(block.local >= 0)
    return [level[:, used] if len(used) else np.zeros((len(level), 1)) for level in items.levels]


def leaf_scores(items: Items, block: Block, item: int, leaf: int) -> np.ndarray:
    """Exact scores of a leaf's documents for an item."""
    at = block.local[items.terms[item]]
    has = at >= 0
    rows = block.values[leaf * LEAF_DOCS : (leaf + 1) * LEAF_DOCS, at[has]]
    return rows @ items.weights[item][has]


def best_leaves(items: Items, block: Block) -> Iterator[tuple[int, np.ndarray]]:
    """For each item the scores of the leaf with the highest bound."""
    bound = project(items, block)[0] @ block.levels[0].T
    for item, leaf in enumerate(bound.argmax(axis=1).tolist()):
        if bound[item, leaf] > 0:
            yield item, leaf_scores(items, block, item, leaf)


def dual_search(items: Items, block: Block, least: np.ndarray) -> Iterator[tuple[int, int]]:
    """(item, leaf) pairs whose bound reaches the item's k-th score, by going down both trees.

    ``least`` is by item, in the order of the tree; a node's is that of its weakest.
    """
    levels = project(items, block)
    weakest = [least]
    for level, fan in zip(levels[1:], (LEAF_ITEMS, *[FAN] * 64), strict=False):
        weakest.append(np.minimum.reduceat(weakest[-1], np.arange(0, len(weakest[-1]), fan)))
        assert len(weakest[-1]) == len(level)
    i, d = len(levels) - 1, len(block.levels) - 1
    alive = np.ones((1, 1), bool)  # of the item nodes and document nodes of a level
    while True:
        rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            return
        bound = levels[i][rows] @ block.levels[d][columns].T * SLACK
        open_pairs = alive[np.ix_(rows, columns)]
        open_pairs &= (bound >= weakest[i][rows][:, None]) & (bound > 0)
        alive = np.zeros_like(alive)
        alive[np.ix_(rows, columns)] = open_pairs
        if i == 0 and d == 0:
            pairs = np.argwhere(alive)
            yield from zip(pairs[:, 0].tolist(), pairs[:, 1].tolist(), strict=True)
            return
        if i:
            i -= 1
            fan = LEAF_ITEMS if i == 0 else FAN
            alive = np.repeat(alive, fan, axis=0)[: len(levels[i])]
        if d:
            d -= 1
            alive = np.repeat(alive, LEAVES, axis=1)[:, : len(block.levels[d])]


class Best:
    """An item's best documents so far; ids decide between equal scores."""

    def __init__(self, k: int, least: int):
        self.k, self.least, self.rows = k, least, []

    def add(self, ids: list, scores: np.ndarray) -> None:
        """What is under the k-th score, or scores nothing, is out."""
        for at in np.flatnonzero((scores >= self.least) & (scores > 0)).tolist():
            self.rows.append((-int(scores[at]), ids[at] is None, ids[at] or 0))
        if len(self.rows) > 4 * self.k:
            self.cut()

    def cut(self) -> None:
        self.rows = sorted(self.rows)[: self.k]
        if len(self.rows) == self.k:
            self.least = max(self.least, -self.rows[-1][0])


def read_blocks(batches: Iterator[pa.RecordBatch], n_docs: int, total: int, idf: np.ndarray) -> Iterator[Block]:
    """Document trees of up to BLOCK_DOCS rows, from vectors as they come."""
    rows = min(BLOCK_DOCS, max(LEAF_DOCS, BLOCK_CELLS // len(idf)))
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            terms, cut = flat(part.column(2))
            tfs, _ = flat(part.column(3))
            if len(terms):
                ids, n = part.column(0).to_pylist(), part.column(1).to_numpy()
                yield doc_block(ids, n, terms.astype(np.int64), tfs, cut, n_docs, total, idf)


def _found(rows: list[tuple]) -> pa.RecordBatch:
    item, score, no_id, ids = zip(*rows, strict=True) if rows else ((), (), (), ())
    ids = [None if none else i for none, i in zip(no_id, ids, strict=True)]
    return pa.record_batch(
        [pa.array(item, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())],
        names=["item", "doc_id", "score"],
    )


def probe(batches: Iterator[pa.RecordBatch], items, n_docs: int, total: int, k: int) -> Iterator[pa.RecordBatch]:
    """The task's k best scores of each item over its blocks' best leaves."""
    tree = items.value
    best = [Best(k, 1) for _ in tree.number]
    for block in read_blocks(batches, n_docs, total, tree.idf):
        for item, scores in best_leaves(tree, block):
            best[item].add([0] * len(scores), scores)
    for heap in best:
        heap.cut()
    rows = [(int(tree.number[i]), -s, none, doc) for i, heap in enumerate(best) for s, none, doc in heap.rows]
    yield _found(rows)


def search(batches: Iterator[pa.RecordBatch], items, least, n_docs: int, total: int, k: int) -> Iterator[pa.RecordBatch]:
    """The task's k best documents of each item, or all that tie with the k-th score known."""
    tree, known = items.value, least.value
    best = [Best(k, int(known[number])) for number in tree.number.tolist()]
    for block in read_blocks(batches, n_docs, total, tree.idf):
        bar = np.array([heap.least for heap in best], np.float64)
        for item, leaf in dual_search(tree, block, bar):
            lo = leaf * LEAF_DOCS
            best[item].add(block.ids[lo : lo + LEAF_DOCS], leaf_scores(tree, block, item, leaf))
        for heap in best:
            heap.cut()
    rows = [(int(tree.number[i]), -s, none, doc) for i, heap in enumerate(best) for s, none, doc in heap.rows]
    yield _found(rows)


# -- the whole job -------------------------------------------------------------------


def item_batches(items: DataFrame) -> Iterator[list]:
    """Items as (item, item_id, terms) rows, so many at a time as a task can hold.

    Items are dealt into buckets of about a batch, and those cut by running sums; a
    batch has BATCH_TERMS terms, and besides at most the one item that passes them.
    """
    running = Window.partitionBy("bucket").orderBy("place")
    cost = F.greatest(F.size("terms"), F.lit(ITEM_COST))
    everything = items.agg(F.coalesce(F.sum(cost), F.lit(0))).first()[0]
    buckets = everything // BATCH_TERMS + 1
    dealt = items.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(buckets)))
    summed = dealt.withColumn("sum", F.sum(cost).over(running))
    dealt = summed.withColumn("turn", F.expr(f"(sum - 1) div {BATCH_TERMS}"))
    turns = dealt.select("bucket", "turn").distinct().orderBy("bucket", "turn").collect()
    for bucket, turn in turns:
        own = dealt.filter((F.col("bucket") == bucket) & (F.col("turn") == turn))
        yield own.select("item_id", "terms").orderBy("item_id", "terms").collect()


def top_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents, best first.

    Terms are runs of letters, digits and characters outside ASCII, A-Z lower-cased.
    Only scores above 0 count; equal scores go by ascending doc_id, null ids last.
    A null or empty text has no terms: such an item finds nothing, such a document is
    never found.  Every row of ``items`` is an item and every row of ``docs`` a
    document, also if ids repeat; items of one id are ranked on their own.  Very long
    texts are read in slices; an empty table on either side gives no rows; other
    columns are not read.

    Items are taken in batches that fit a task, each one pass over the documents.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ranked")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")
    )
    wanted = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")
    ).mapInArrow(item_terms, "item_id long, terms array<long>")
    wanted = wanted.filter(F.size("terms") > 0).withColumn("place", F.monotonically_increasing_id())
    wanted = scratch.save(wanted, "items")
    kind = "item_id long, rank int, doc_id long, score long"
    result = None
    for turn, rows in enumerate(item_batches(wanted)):
        found = _search_batch(texts, rows, k, scratch, turn)
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], kind) if result is None else result


def _top(found: DataFrame, k: int) -> DataFrame:
    """Each item's k best rows with their rank, cut to k in parts and then over all."""
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    part = Window.partitionBy("item", "salt").orderBy(*order)
    found = found.withColumn("salt", F.spark_partition_id() % SALTS)
    found = found.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= k)
    whole = Window.partitionBy("item").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)


def _search_batch(texts: DataFrame, rows: list, k: int, scratch: Scratch, turn: int) -> DataFrame:
    spark = texts.sparkSession
    context = spark.sparkContext
    hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
    known = np.unique(np.concatenate(hashes))
    seen = Observation()
    vectors = texts.mapInArrow(partial(doc_vectors, known=context.broadcast(known)), VECTOR)
    vectors = vectors.observe(
        seen, F.count_if(F.col("n") > 0).alias("n_docs"), F.sum("n").alias("total")
    )
    vectors = scratch.save(vectors, f"vectors-{turn}")
    n_docs, total = seen.get["n_docs"], max(1, seen.get["total"] or 0)

    counted = vectors.select("terms").mapInArrow(
        partial(term_documents, n_terms=len(known)), "term int, df long"
    )
    df = np.zeros(len(known), np.int64)
    for term, count in counted.groupBy("term").agg(F.sum("df")).collect():  # BATCH_TERMS rows
        df[term] = count
    idf = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    tree = item_tree([np.searchsorted(known, h) for h in hashes], np.array(idf, np.int64))
    tree = context.broadcast(tree)

    found = "item int, doc_id long, score long"
    sizes = {"n_docs": n_docs, "total": total, "k": k}
    probed = _top(vectors.mapInArrow(partial(probe, items=tree, **sizes), found), k)
    least = np.ones(len(rows), np.int64)
    for item, score in probed.filter(F.col("rank") == k).select("item", "score").collect():
        least[item] = score  # one per item of the batch
    searcher = partial(search, items=tree, least=context.broadcast(least), **sizes)
    ranked = _top(vectors.mapInArrow(searcher, found), k)
    # items of the batch
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
