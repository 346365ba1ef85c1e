"""Near duplicates by MinHash bands, checked on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.scratch import Scratch
from tidemark.llm.words import bounds, mix, shingle_set, slices, split

BANDS, ROWS = 32, 5  # a pair at similarity 0.8 is missed with probability 3e-6
PIVOT_ROUNDS = 2
BROADCAST_IDS = 250_000  # three columns and a hash table's share, about 100 bytes each: 25 MB

SIGNED = (
    "id long, k1 long, k2 int, n long, f1 long, f2 long, bands array<long>, minima binary"
)


def hash_functions(count: int, seed: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of multiply-shift hashing, a universal family."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factor, rng.integers(0, 1 << 63, count, dtype=np.uint64)


def minima(shingles: np.ndarray, factor: np.ndarray, summand: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set of shingles."""
    least = np.full(len(factor), np.iinfo(np.uint64).max)
    for lo in range(0, len(shingles), 2048):
        part = shingles[lo : lo + 2048, None] * factor
        part += summand
        np.minimum(least, part.min(axis=0), out=least)
    return least >> np.uint64(32)


def sign(
    batches: Iterator[pa.RecordBatch], k: int, bands: int, rows: int
) -> Iterator[pa.RecordBatch]:
    """Set size, fingerprint of the set, band keys and minima (16 bits each) of each text."""
    factor, summand = hash_functions(bands * rows)
    place = mix(np.arange(1, bands + 1, dtype=np.uint64))
    weights = hash_functions(rows, seed=5)[0]
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            words = split(data, offsets)
            cut = bounds(words.row, hi - lo)
            sizes = np.zeros(hi - lo, np.int64)
            prints = np.zeros((hi - lo, 2), np.uint64)
            keys, least = [], []
            for i in range(hi - lo):
                found = shingle_set(words.hash[cut[i] : cut[i + 1]], k)
                sizes[i] = len(found)
                if not len(found):
                    keys.append([])
                    least.append(b"")
                    continue
                prints[i] = mix(found).sum(), mix(found ^ factor[0]).sum()
                low = minima(found, factor, summand)
                band = mix((low.reshape(bands, rows) * weights).sum(axis=1) ^ place)
                keys.append(band.view(np.int64))
                least.append(low.astype(np.uint16).tobytes())
            prints = prints.view(np.int64)
            yield pa.record_batch(
                [
                    *(batch.column(c).slice(lo, hi - lo) for c in (0, 2, 3)),
                    pa.array(sizes),
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                    pa.array(keys, pa.list_(pa.int64())),
                    pa.array(least, pa.binary()),
                ],
                names=["id", "k1", "k2", "n", "f1", "f2", "bands", "minima"],
            )


def shingle_sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            words = split(data, offsets)
            cut = bounds(words.row, hi - lo)
            sets = [shingle_set(words.hash[cut[i] : cut[i + 1]], k) for i in range(hi - lo)]
            ends = np.cumsum([0, *map(len, sets)])
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.record_batch(
                [
                    batch.column(0).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)),
                ],
                names=["id", "shingles"],
            )


def agreeing(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree in at least this share of the minima."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (
            np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(
                batch.num_rows, -1
            )
            for i in (2, 3)
        )
        near = (a == b).mean(axis=1) >= least
        yield batch.select([0, 1]).filter(pa.array(near))


def _keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, k1, k2): 96 bits of hash tell rows of different id or text apart, so that
    a row can be found again when the documents are read again."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    return rows.select("*", F.xxhash64("id", "text").alias("k1"), F.hash("id", "text").alias("k2"))


def _only(docs: DataFrame, reps: DataFrame, ids: DataFrame, at_most: int) -> DataFrame:
    """(id, text) of these classes, once each: by broadcast while the counted bound on
    them is small."""
    few = at_most <= BROADCAST_IDS
    own = reps.select("id", "k1", "k2").join(F.broadcast(ids) if few else ids, "id", "left_semi")
    texts = docs.select("text", "k1", "k2").join(F.broadcast(own) if few else own, ["k1", "k2"])
    # Rows that repeat id and text have one key.
    return texts.select("id", "text").dropDuplicates(["id"])


def _verified(
    pairs: DataFrame,
    docs: DataFrame,
    reps: DataFrame,
    scratch: Scratch,
    name: str,
    k: int,
    percent: int,
    bands_rows: int,
) -> tuple[DataFrame, int]:
    """Pairs (a, b) whose signatures agree and whose whole sets are similar enough, and
    their number.

    Signatures may fall short of the wanted similarity by five standard errors.
    """
    wanted = percent / 100
    least = wanted - 5 * (wanted * (1 - wanted) / bands_rows) ** 0.5
    of = reps.select("id", "minima")
    near = (
        pairs.join(of.toDF("b", "mb"), "b")
        .join(of.toDF("a", "ma"), "a")
        .select("a", "b", "ma", "mb")
        .mapInArrow(partial(agreeing, least=least), "a long, b long")
    )
    near, seen = scratch.save_seen(near, f"{name}-near")
    ids = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = _only(docs, reps, ids, at_most=2 * seen["n"]).mapInArrow(
        partial(shingle_sets, k=k), "id long, shingles array<long>"
    )
    sets = scratch.save(sets, f"{name}-sets")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    links = (
        near.join(sets.toDF("b", "sb"), "b")
        .join(sets.toDF("a", "sa"), "a")
        .filter((F.size("sa") > 0) & (F.size("sb") > 0))
        .filter(shared.cast("long") * 100 >= union.cast("long") * percent)
        .select("a", "b")
    )
    links, seen = scratch.save_seen(links, f"{name}-links")
    scratch.drop(f"{name}-near", f"{name}-sets")
    return links, seen["n"]


def _sharing_rare(
    members: DataFrame, docs: DataFrame, reps: DataFrame, scratch: Scratch, k: int, percent: int
) -> DataFrame:
    """Pairs (a, na, b, nb) across components that share one of their rarest shingles.

    A partner of x shares at least ``percent`` hundredths of x's shingles, so one
    of any |x| - that + 1 of them; taking the rarest of these members' shingles
    keeps the meetings few.  No linked pair is lost.  Near copies whose own
    changes exceed the allowed difference have rare shingles that nobody shares.
    """
    nodes = members.groupBy("id").agg(F.first("n").alias("n"), F.first("comp").alias("comp"))
    nodes, seen = scratch.save_seen(nodes, "rest")
    sets = _only(docs, reps, nodes.select("id"), at_most=seen["n"]).mapInArrow(
        partial(shingle_sets, k=k), "id long, shingles array<long>"
    )
    entries = scratch.save(sets.select("id", F.explode("shingles").alias("shingle")), "rest-sets")
    shared = entries.groupBy("shingle").agg(F.count("*").alias("df")).filter("df > 1")
    common = entries.join(shared, "shingle").join(nodes, "id")
    of_text = Window.partitionBy("id")
    place = F.row_number().over(of_text.orderBy("df", "shingle"))
    alone = F.col("n") - F.count("*").over(of_text)
    needed = F.ceil(F.col("n") * percent / 100)
    prefix = (
        common.withColumn("place", place + alone)
        .filter(F.col("place") <= F.col("n") - needed + 1)
        .select("shingle", "id", "n", "comp", "place")
    )
    prefix = scratch.save(prefix, "rest-prefix")
    left = prefix.toDF("shingle", "a", "na", "comp_a", "ia")
    right = prefix.toDF("shingle", "b", "nb", "comp_b", "ib")
    # At their first common shingle, the places from there on bound what is shared.
    most = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) + 1
    enough = most * (100 + percent) >= (F.col("na") + F.col("nb")) * percent
    met = left.join(right, (left["shingle"] == right["shingle"]) & (F.col("comp_a") < F.col("comp_b")) & enough)
    return met.select("a", "na", "b", "nb")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are runs of non-space bytes, A-Z lower-cased; a text's set holds its
    distinct shingles of ``words`` words, and two texts are linked if the sets'
    Jaccard similarity is ``percent`` hundredths or more.  Components are those
    of all links; the least id of each is kept.

    Equal sets are one class, found by grouping on a 128-bit fingerprint.  Class
    representatives meet in buckets of equal bands.  Within a bucket all members
    are compared with its least one, so a large group of near copies costs a pair
    per member; in further rounds those of other components than a pivot drawn by
    hash are compared with that.  What then still lies in different components of
    one bucket is compared wherever two texts share one of their rarest shingles,
    which loses no link and needs no pair for texts that are alike but not enough.

    A null or empty text has no shingles and is linked with nothing.  ``kept`` says that
    a row has its component's id, so of rows that repeat it all are; ``kept_row`` is true
    for exactly one of them.  Ids decide nothing else: rows that repeat an id are
    judged by their own texts, and rows without id are linked like others; a component
    of none but these has a null id, which they have too.  Very long texts are split in
    slices; an empty table gives no rows; other columns are not looked at.
    """
    judged = _judged(_keyed(docs, id_col, text_col), words, percent, bands, rows)
    return judged.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.col("kept").alias("kept_row"),
    )


def _judged(docs: DataFrame, words: int, percent: int, bands: int, rows: int) -> DataFrame:
    """(id, k1, k2, n, component_id, kept) for every row of ``_keyed`` documents.

    Links and components are those of classes of equal sets, each under a number
    written with it; ids come in again at the end.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    signed = docs.select("id", "text", "k1", "k2").mapInArrow(partial(sign, k=words, bands=bands, rows=rows), SIGNED)
    signed = scratch.save(signed.withColumn("row", F.monotonically_increasing_id()), "signed")
    # The kept row of a class is one with the least id; a null id comes last.
    best = F.struct(F.col("id").isNull().alias("none"), "id", "row", "k1", "k2")
    classes = signed.filter("n > 0").groupBy("f1", "f2", "n").agg(
        F.min(best).alias("best"), F.count("*").alias("size"),
        F.first("bands").alias("bands"), F.first("minima").alias("minima"),
    )
    number = F.monotonically_increasing_id().alias("id")
    reps = scratch.save(
        classes.select(number, "f1", "f2", "n", "size", "best", "best.k1", "best.k2", "bands", "minima"),
        "reps",
    )

    # Pivots go by document id, as originals mostly precede their copies.
    order = F.coalesce("best.id", F.lit((1 << 63) - 1)).alias("place")
    banded = reps.select("id", "n", order, F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    buckets = scratch.save(banded.join(shared.select("key"), "key"), "buckets")
    like = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    check = partial(
        _verified,
        docs=docs, reps=reps, scratch=scratch, k=words, percent=percent, bands_rows=bands * rows,
    )

    linked, changed = None, True
    for turn in range(PIVOT_ROUNDS + 1):
        if changed:
            members = buckets.withColumn("comp", F.col("id"))
            if linked is not None:
                members = (
                    buckets.join(linked, "id", "left")
                    .withColumn("comp", F.coalesce("component", "id"))
                    .drop("component")
                )
            spans = members.groupBy("key").agg(
                F.min("comp").alias("first_comp"), F.max("comp").alias("last_comp")
            )
            open_keys = spans.filter("first_comp < last_comp")
            members, seen = scratch.save_seen(members.join(open_keys, "key"), f"open-{turn}")
            if not seen["n"]:
                break
        if turn < PIVOT_ROUNDS:
            # The first pivot is the least member, so nearly the same in all buckets of
            # a group.  Later ones are drawn by a hash, so a member that is still apart
            # meets another pivot in each of its buckets.
            drawn = F.xxhash64(F.lit(turn), "key", "id") if turn else F.col("place")
            first = F.struct(drawn.alias("draw"), F.col("id").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"))
            pivots = members.groupBy("key").agg(F.min(first).alias("p"))
            pivots = pivots.select("key", "p.a", "p.ca", "p.na")
            pairs = members.join(pivots, "key").filter("comp <> ca")
            pairs = pairs.select("a", "na", F.col("id").alias("b"), F.col("n").alias("nb"))
        else:
            pairs = _sharing_rare(members, docs, reps, scratch, words, percent)
        pairs = pairs.filter(like).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links, changed = check(pairs.distinct(), name=f"round-{turn}")
        if changed:
            # Earlier links are represented by the stars they have become.
            edges = links if linked is None else links.union(linked.select("id", "component"))
            linked = components(edges, "a", "b", scratch, f"stars-{turn}")
    scratch.drop("buckets")

    best = reps.select("id", "best.none", F.col("best.id").alias("doc"), F.col("best.row").alias("row"))
    best = best.select("id", F.struct("none", "doc", "row").alias("best"))
    if linked is not None:
        # Only classes that are linked need the best row of their component.
        first = linked.join(best, "id").groupBy("component").agg(F.min("best").alias("of_all"))
        shared = linked.join(first, "component").select("id", "of_all")
        best = best.join(shared, "id", "left").select("id", F.coalesce("of_all", "best").alias("best"))
    # A row that is a class alone and not linked needs no lookup by its fingerprint.
    of_class = reps.select("id", "f1", "f2", "n", "size").join(best, "id")
    alone = (F.col("size") == 1) & (F.col("best.row") == F.col("own"))
    own = reps.select("id", F.col("best.row").alias("own"))
    of_class = of_class.join(own, "id").filter(~alone)
    of_class = of_class.select("f1", "f2", "n", F.struct("best.doc", "best.row").alias("b"))
    out = signed.select("id", "k1", "k2", "n", "f1", "f2", "row").join(
        of_class, ["f1", "f2", "n"], "left"
    )
    return out.select(
        "id",
        "k1",
        "k2",
        "n",
        F.when(F.col("b").isNull(), F.col("id")).otherwise(F.col("b.doc")).alias("component_id"),
        F.coalesce(F.col("b.row") == F.col("row"), F.lit(True)).alias("kept"),
    )


def kept_rows(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps: one of every component, and all
    without shingles.  Of rows that repeat id and text any one can be the one."""
    judged = _judged(_keyed(docs), words, percent, bands, rows).filter("n > 0")
    by_key = judged.groupBy("k1", "k2").agg(
        F.count("*").alias("copies"), F.max("kept").alias("kept")
    )
    marked, seen = Scratch(docs.sparkSession, "kept").save_seen(
        by_key.filter("NOT kept OR copies > 1").select("k1", "k2", "kept"),
        "marked",
        kept=F.count_if("kept"),
    )
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    keyed = docs.select(own, F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    keyed = keyed.select("own", F.xxhash64("id", "text").alias("k1"), F.hash("id", "text").alias("k2"))
    left = keyed.join(marked, ["k1", "k2"], "left_anti").select("own.*")
    if not seen["kept"]:
        return left
    repeated = keyed.join(marked.filter("kept"), ["k1", "k2"], "left_semi")
    return left.union(repeated.dropDuplicates(["k1", "k2"]).select("own.*"))
