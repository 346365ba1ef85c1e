"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every row has a place in a written table, and 65 536 places are a page.  A page
sorts the fingerprints of its texts and sends each owner, which has a range of
fingerprints, the sorted gaps as Golomb codes with a power of two as divisor.
An owner answers with a bitmap of the fingerprints that other pages sent too.
Rows so marked, or repeated within their page, are suspects: only their texts are
shuffled, and compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import lower_ascii

PAGE_BITS = 16
PAGE_ROWS = 1 << PAGE_BITS
SPARE_BITS = 12  # a text that is alone is a suspect once in so many powers of two
OWNER_HASHES = 4_000_000  # fingerprints an owner holds at once, as 64-bit numbers
ROWS_PER_OWNER = 1_000  # and no more owners than give each so many
BROADCAST_PAGES = 8_192  # bitmaps of 8 KB each: 64 MB
HOT_ROWS, HOT_GROUPS = 1_000_000, 1_000
ID_STEP = 1 << 54  # above every place, so that id * ID_STEP + place orders by both
MESSAGE = "kind int, page long, part int, owner int, first int, n int, divisor int, code binary, rest binary"


def golomb_encode(values: np.ndarray, divisor: int) -> tuple[bytes, bytes]:
    """Sorted distinct numbers from 0 as (unary quotients, remainders) of their gaps.

    ``divisor`` is given as its power of two; remainders are packed in that many bits.
    """
    gaps = np.diff(values, prepend=-1) - 1
    quotient = gaps >> divisor
    unary = np.zeros(int(quotient.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    low = (gaps[:, None] >> np.arange(divisor)) & 1
    return np.packbits(unary).tobytes(), np.packbits(low.astype(np.uint8)).tobytes()


def golomb_decode(unary: bytes, rest: bytes, n: int, divisor: int) -> np.ndarray:
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotient = np.diff(ones, prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * divisor].reshape(n, divisor)
    gaps = (quotient << divisor) + low.astype(np.int64) @ (1 << np.arange(divisor))
    return np.cumsum(gaps + 1) - 1


def fingerprints(digests: pa.Array, bits: int) -> np.ndarray:
    """The first ``bits`` bits of each digest, at most 60."""
    _, offsets, data = digests.cast(pa.binary()).buffers()
    if not len(digests):
        return np.zeros(0, np.int64)
    offsets = np.frombuffer(offsets, np.int32)[digests.offset : digests.offset + len(digests) + 1]
    width = int(offsets[1] - offsets[0])
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].reshape(-1, width)[:, :8]
    number = np.zeros((len(raw), 8), np.uint8)
    number[:, : raw.shape[1]] = raw
    return (number.view(">u8")[:, 0] >> np.uint64(64 - bits)).astype(np.int64)


def _page(page: int, slots: np.ndarray, prints: np.ndarray, owners: int, span: int) -> Iterator[tuple]:
    """The state of (a part of) a page, then its messages."""
    order = np.lexsort((slots, prints))
    slots, prints = slots[order], prints[order]
    new = np.diff(prints, prepend=-1) > 0
    distinct, part = prints[new], int(slots.min())
    yield 0, page, part, -1, 0, len(slots), 0, slots.astype(np.uint16).tobytes(), np.packbits(new).tobytes()
    cuts = np.searchsorted(distinct, np.arange(owners + 1) * span)
    for owner in np.flatnonzero(np.diff(cuts)).tolist():
        first, n = int(cuts[owner]), int(cuts[owner + 1] - cuts[owner])
        divisor = max(0, int(np.log2(max(1.0, 0.69 * span / n))))
        codes = golomb_encode(distinct[first : first + n] - owner * span, divisor)
        yield 1, page, part, owner, first, n, divisor, *codes


def send(batches: Iterator[pa.RecordBatch], bits: int, owners: int, span: int) -> Iterator[pa.RecordBatch]:
    """(place, digest) to the states and messages of pages.

    A page of which a task reads a part only is that part, named by its first slot.
    """
    names = [field.split()[0] for field in MESSAGE.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[field.split()[1]] for field in MESSAGE.split(", ")]

    def flush(places: list[np.ndarray], prints: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        place, own = np.concatenate(places), np.concatenate(prints)
        pages = place >> PAGE_BITS
        for page in np.unique(pages).tolist():
            at = pages == page
            rows = list(_page(page, place[at] & (PAGE_ROWS - 1), own[at], owners, span))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.record_batch(columns, names=names)

    places, prints, held = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        places.append(batch.column(0).to_numpy(zero_copy_only=False))
        prints.append(fingerprints(batch.column(1), bits))
        held += batch.num_rows
        if held >= 4 * PAGE_ROWS:
            yield from flush(places, prints)
            places, prints, held = [], [], 0
    if held:
        yield from flush(places, prints)


def answer(messages: pa.Table) -> pa.Table:
    """All messages to one owner: for each the bitmap of what others sent too, if any."""
    sent = messages.select(["n", "divisor", "code", "rest"]).to_pylist()
    values = [golomb_decode(m["code"], m["rest"], m["n"], m["divisor"]) for m in sent]
    distinct, inverse, counts = np.unique(
        np.concatenate(values), return_inverse=True, return_counts=True
    )
    shared = counts[inverse] > 1
    cuts = np.cumsum([0, *map(len, values)])
    bitmaps = [np.packbits(shared[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    some = [bool(shared[a:b].any()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    replies = messages.select(["page", "part", "first", "n"]).append_column("bitmap", pa.array(bitmaps, pa.binary()))
    return replies.filter(pa.array(some, pa.bool_()))


def suspects_of_page(states: pa.Table, replies: pa.Table) -> pa.Table:
    """The bitmap over a page's slots, as 64-bit words; no row if none is a suspect."""
    marked = np.zeros(PAGE_ROWS, bool)
    answers = replies.to_pylist()
    for state in states.to_pylist():
        slots = np.frombuffer(state["code"], np.uint16)
        new = np.unpackbits(np.frombuffer(state["rest"], np.uint8))[: state["n"]].astype(bool)
        rank = np.cumsum(new) - 1
        shared = np.bincount(rank) > 1
        for reply in answers:
            if reply["part"] == state["part"]:
                bits = np.unpackbits(np.frombuffer(reply["bitmap"], np.uint8))[: reply["n"]]
                shared[reply["first"] : reply["first"] + reply["n"]] |= bits.astype(bool)
        marked[slots[shared[rank]]] = True
    kind = pa.schema([("page", pa.int64()), ("bits", pa.list_(pa.int64()))])
    if not marked.any():
        return kind.empty_table()
    words = np.packbits(marked, bitorder="little").view("<i8")
    words = words[: int(np.flatnonzero(words)[-1]) + 1]
    return pa.table([[states["page"][0].as_py()], [words.tolist()]], schema=kind)


def _is_marked() -> Column:
    slot = F.col("place").bitwiseAND(PAGE_ROWS - 1).cast("int")
    word = F.get("bits", F.floor(slot / 64).cast("int"))
    return F.coalesce(F.getbit(word, slot % 64) == 1, F.lit(False))


class Exchange:
    """The written rows, and the bitmaps of those that may have an equal."""

    def __init__(self, docs: DataFrame, digest_bytes: int = 32):
        spark = docs.sparkSession
        self.scratch = scratch = Scratch(spark, "exact")
        seen = Observation()
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        digest = F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256))
        rows = docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
            F.col("doc_id").cast("long").alias("id"),
            F.monotonically_increasing_id().alias("place"),
            digest.alias("sha256"),
        ).observe(seen, F.count(F.lit(1)).alias("n"))
        self.rows = scratch.save(rows, "rows").select(
            "*",
            F.shiftright("place", PAGE_BITS).alias("page"),
            F.substring("sha256", 1, digest_bytes).alias("digest"),
        )
        self.n_rows = seen.get["n"]
        self.pages = self._marked_pages()

    def _marked_pages(self) -> DataFrame:
        spark, scratch, n = self.rows.sparkSession, self.scratch, self.n_rows
        bits = min(60, max(n, 1).bit_length() + SPARE_BITS)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        owners = max(min(tasks, 1 + n // ROWS_PER_OWNER), 1 + n // OWNER_HASHES)
        span = -(-(1 << bits) // owners)
        sender = partial(send, bits=bits, owners=owners, span=span)
        sent = self.rows.select("place", "digest").mapInArrow(sender, MESSAGE)
        sent.write.partitionBy("kind").parquet(scratch.path("sent"))
        sent = spark.read.schema(MESSAGE).parquet(scratch.path("sent"))
        messages = sent.filter("kind = 1").select("page", "part", "owner", "first", "n", "divisor", "code", "rest")
        replies = messages.groupBy("owner").applyInArrow(
            answer, "page long, part int, first int, n int, bitmap binary"
        )
        states = sent.filter("kind = 0").select("page", "part", "n", "code", "rest")
        pages = (
            states.groupBy("page")
            .cogroup(replies.groupBy("page"))
            .applyInArrow(suspects_of_page, "page long, bits array<long>")
        )
        seen = Observation()
        pages = scratch.save(pages.observe(seen, F.count(F.lit(1)).alias("n")), "pages")
        self.n_pages = seen.get["n"]
        scratch.drop("sent")
        return pages

    def split(self, *columns: str | Column) -> tuple[DataFrame, DataFrame]:
        """Suspects, and rows that have no equal.

        Bitmaps are broadcast, so no row moves; of more than BROADCAST_PAGES pages, one
        range of pages after the other.
        """
        turns = self.n_pages // BROADCAST_PAGES + 1
        cuts = []
        if turns > 1:
            shares = [i / turns for i in range(1, turns)]
            cuts = sorted(set(map(int, self.pages.approxQuantile("page", shares, 0.1 / turns))))
        both = None
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            # by place, which the files' statistics prune
            inside, own = F.lit(True), F.lit(True)
            if low is not None:
                inside &= F.col("place") >= low << PAGE_BITS
                own &= F.col("page") >= low
            if high is not None:
                inside &= F.col("place") < high << PAGE_BITS
                own &= F.col("page") < high
            bitmaps = F.broadcast(self.pages.filter(own))
            marked = self.rows.filter(inside).join(bitmaps, "page", "left")
            marked = marked.select(*columns, _is_marked().alias("marked"))
            both = marked if both is None else both.unionByName(marked)
        return both.filter("marked").drop("marked"), both.filter("NOT marked").drop("marked")


def duplicates(docs: DataFrame, digest_bytes: int = 32) -> DataFrame:
    """Every row of ``docs`` as ``row``, with keep_id, group_size, kept and text_sha256.

    Texts are equal if their bytes are, once A-Z is lower-cased; a null text is
    an empty one, and empty texts are equal.  Of equal texts the row with the
    largest doc_id stays; null ids come below all others, and of rows that repeat the
    id as well exactly one stays.  An empty table gives no rows; very long texts are
    hashed and compared in the JVM; other columns ride along in ``row``.

    Suspects are compared by grouping on digest and text, so each task sends a text
    once, however many copies it holds.  Rows find their group by the digest; if texts
    share one (``digest_bytes`` shortens it in tests), by the text as well.  Groups of
    more than a thousandth of all rows are broadcast, at most a few thousand.
    """
    exchange = Exchange(docs, digest_bytes)
    scratch = exchange.scratch
    below = F.lit(str(-(2**63) - 1)).cast("decimal(20,0)")
    order = F.coalesce(F.col("id").cast("decimal(20,0)"), below)
    order = (order * F.lit(ID_STEP).cast("decimal(17,0)") + F.col("place")).cast("decimal(38,0)")
    text = lower_ascii(F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    own = ["row", "id", "digest", "sha256", order.alias("order")]
    suspects, alone = exchange.split(*own)

    def grouped(of: DataFrame) -> DataFrame:
        return of.groupBy("digest", text.alias("text")).agg(
            F.max("order").alias("last"), F.max("id").alias("keep_id"), F.count("*").alias("n")
        )

    seen = Observation()
    groups = grouped(suspects).groupBy("digest").agg(
        F.count("*").alias("texts"),
        F.max("last").alias("last"),
        F.max("keep_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
    )
    groups = scratch.save(groups.observe(seen, F.max("texts").alias("texts")), "groups")
    one = groups.filter("texts = 1").drop("texts")
    large = min(HOT_ROWS, exchange.n_rows // HOT_GROUPS + 1)
    hot = F.broadcast(one.filter(F.col("group_size") > large))
    rest = suspects.join(hot.select("digest"), "digest", "left_anti")
    found = suspects.join(hot, "digest").unionByName(
        rest.join(one.filter(F.col("group_size") <= large), "digest")
    )
    if (seen.get["texts"] or 0) > 1:
        clash = suspects.join(groups.filter("texts > 1").select("digest"), "digest", "left_semi")
        exact = grouped(clash).withColumnRenamed("n", "group_size")
        clash = clash.withColumn("text", text).join(exact, ["digest", "text"])
        found = found.unionByName(clash.drop("text"))
    found = found.withColumn("kept", F.col("order") == F.col("last")).drop("last")
    alone = alone.select(
        "*",
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    return alone.unionByName(found).select(
        "row", "keep_id", "group_size", "kept", F.lower(F.hex("sha256")).alias("text_sha256")
    )


def kept_rows(docs: DataFrame) -> DataFrame:
    """One row of each text, with the columns of ``docs``."""
    return duplicates(docs).filter("kept").select("row.*")
