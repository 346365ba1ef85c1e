"""The prefix trie of rebuilt conversations, by adaptive radix trees.

A turn's id is a digest of role and text and the text's length, of fixed width and
big-endian, and a conversation's key is the ids of its turns.  Distinct keys are cut
into ranges at keys of their own; each task builds the radix tree of one range.
Its inner nodes grow from 4 to 16, 48 and 256 children, and hold the bytes of a
path without branches.  Only byte depths at the end of a turn are trie nodes.

A trie node may lie in several ranges only if it is a prefix of a key at which
ranges are cut, so the few shared nodes are known beforehand: their counts are added
up, and all other nodes are final in their task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch

DIGEST, LENGTH = 16, 4
WIDTH = DIGEST + LENGTH
FOLDS, HEADS = 5, 9  # a conversation begins like the first of its five, for up to eight turns
RANGE_BYTES = 16 << 20  # keys of one radix tree
RANGE_KEYS = 200  # and no more ranges than give each so many
CUT_SAMPLE = 20  # keys drawn for each cut
ID_BLOCK = 4_096  # ids that are joined to one text before the digest of all
NO_IDS = hashlib.sha256(b"").hexdigest()
ROW = (
    "shared int, parent_shared int, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved long, n_bytes long, ends_sha256 string"
)


# -- adaptive radix tree ----------------------------------------------------------


class Few:
    """Up to 4 or 16 children, by sorted bytes."""

    def __init__(self, size: int, keys: bytes = b"", kids: list | None = None):
        self.size, self.keys, self.kids = size, bytearray(keys), kids or []

    def get(self, byte: int):
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid):
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.keys) < self.size:
            self.keys.insert(at, byte)
            self.kids.insert(at, kid)
            return self
        if self.size == 4:
            return Few(16, bytes(self.keys), self.kids).put(byte, kid)
        grown = Indexed()
        for key, old in zip(self.keys, self.kids, strict=True):
            grown.put(key, old)
        return grown.put(byte, kid)

    def ordered(self) -> list:
        return self.kids


class Indexed:
    """Up to 48 children, found by a table of 256 places."""

    def __init__(self):
        self.place, self.kids = bytearray(256), []

    def get(self, byte: int):
        at = self.place[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid):
        at = self.place[byte]
        if at:
            self.kids[at - 1] = kid
            return self
        if len(self.kids) < 48:
            self.kids.append(kid)
            self.place[byte] = len(self.kids)
            return self
        return Full([self.get(b) for b in range(256)]).put(byte, kid)

    def ordered(self) -> list:
        return [self.kids[at - 1] for at in self.place if at]


class Full:
    """A child for every byte."""

    def __init__(self, kids: list):
        self.kids = kids

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def ordered(self) -> list:
        return [kid for kid in self.kids if kid is not None]


class Node:
    """``path``: the bytes from the parent's end to here, the branching byte included."""

    __slots__ = ("path", "kids", "value")

    def __init__(self, path: bytes, kids=None, value=None):
        self.path, self.kids, self.value = path, kids, value


def _common(path: bytes, key: bytes, start: int) -> int:
    """Length of the common part of a path and a key from ``start``."""
    if key.startswith(path, start):
        return len(path)
    low, high = 0, min(len(path), len(key) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(path[:middle], start):
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Node, key: bytes, value) -> None:
    node, start = root, 0
    while start < len(key):
        kid = node.kids.get(key[start]) if node.kids else None
        if kid is None:
            node.kids = (node.kids or Few(4)).put(key[start], Node(key[start:], value=value))
            return
        same = _common(kid.path, key, start)
        if same < len(kid.path):
            upper = Node(kid.path[:same])
            kid.path = kid.path[same:]
            upper.kids = Few(4).put(kid.path[0], kid)
            node.kids = node.kids.put(key[start], upper)
            kid = upper
        node, start = kid, start + same
    node.value = value


# -- cuts -------------------------------------------------------------------------


class Cuts(NamedTuple):
    """Keys at which ranges begin; the first range begins before all keys.

    ``shared[i][d]`` numbers the prefix of d turns of cut i.
    """

    keys: list[bytes]
    shared: list[list[int]]


def shared_nodes(keys: list[bytes]) -> tuple[Cuts, list[tuple]]:
    """The trie of the cuts: numbers, and (shared, n_shared_children, counted_twice) rows.

    ``counted_twice`` are the bytes of all last texts of a shared subtree: each of its
    nodes counts one conversation as the first, over all ranges together.
    """
    numbers: dict[tuple[int, bytes], int] = {}
    parents, sizes, paths = [-1], [0], []
    for key in keys:
        path = [0]
        for start in range(0, len(key), WIDTH):
            turn = key[start : start + WIDTH]
            number = numbers.get((path[-1], turn))
            if number is None:
                number = numbers[path[-1], turn] = len(parents)
                parents.append(path[-1])
                sizes.append(int.from_bytes(turn[DIGEST:], "big"))
            path.append(number)
        paths.append(path)
    children = [0] * len(parents)
    for number in range(len(parents) - 1, 0, -1):  # a parent has a smaller number
        sizes[parents[number]] += sizes[number]
        children[parents[number]] += 1
    return Cuts(keys, paths), list(zip(range(len(parents)), children, sizes, strict=True))


def choose_cuts(keys: DataFrame, ranges: int) -> list[bytes]:
    """Cuts for about equal ranges: keys drawn by their digest, so without regard to order."""
    if ranges < 2:
        return []
    drawn = keys.filter(F.length("key") > 0).orderBy("digest").limit(CUT_SAMPLE * ranges)
    found = sorted(bytes(row["key"]) for row in drawn.select("key").collect())
    return [found[i * len(found) // ranges] for i in range(1, ranges)] if len(found) >= ranges else found


def number_ranges(batches: Iterator[pa.RecordBatch], cuts) -> Iterator[pa.RecordBatch]:
    keys = cuts.value.keys
    for batch in batches:
        own = [bisect_right(keys, key) for key in batch.column(0).to_pylist()]
        yield pa.record_batch(
            [*batch.columns, pa.array(own, pa.int32())], names=[*batch.schema.names, "range"]
        )


# -- trie nodes of one range --------------------------------------------------------


def range_nodes(rows: pa.Table, cuts) -> pa.Table:
    """Trie nodes of one range of (key, n, least, ends_sha256, range).

    Nodes are numbered from the root down, so sums go up by descending numbers.
    """
    cuts = cuts.value
    number = rows["range"][0].as_py()
    begin = cuts.keys[number - 1] if number else None
    end = cuts.keys[number] if number < len(cuts.keys) else None
    root = Node(b"")
    for value in zip(*[rows[c].to_pylist() for c in ("key", "n", "least", "ends_sha256")], strict=True):
        if value[0]:
            insert(root, value[0], value[1:])
        else:
            root.value = value[1:]

    parent, depth, size, ends = [-1], [0], [0], [None]
    shared = [0 if cuts.keys else None]
    on_begin, on_end = [begin is not None], [end is not None]  # a prefix of the range's cuts
    path = bytearray()
    stack = [(root, 0, 0)]
    while stack:
        node, start, at = stack.pop()
        del path[start:]
        path += node.path
        for d in range(start // WIDTH + 1, len(path) // WIDTH + 1):
            turn = bytes(path[(d - 1) * WIDTH : d * WIDTH])
            one = on_begin[at] and begin[(d - 1) * WIDTH : d * WIDTH] == turn
            two = on_end[at] and end[(d - 1) * WIDTH : d * WIDTH] == turn
            on_begin.append(one)
            on_end.append(two)
            shared.append(
                cuts.shared[number - 1][d] if one else cuts.shared[number][d] if two else None
            )
            parent.append(at)
            depth.append(d)
            size.append(int.from_bytes(turn[DIGEST:], "big"))
            ends.append(None)
            at = len(parent) - 1
        if node.value is not None:
            ends[at] = node.value
        for kid in reversed(node.kids.ordered() if node.kids else ()):
            stack.append((kid, len(path), at))

    n = [e[0] if e else 0 for e in ends]
    least = [e[1] if e else None for e in ends]
    children, leaves, saved = [0] * len(n), [0] * len(n), [0] * len(n)
    for i in range(len(n) - 1, -1, -1):
        # a node that begins the next range's cut goes on there
        longer = on_end[i] and len(end) > depth[i] * WIDTH
        if ends[i] is not None and children[i] == 0 and not longer:
            leaves[i] = 1
        saved[i] += (n[i] - (shared[i] is None)) * size[i]
        up = parent[i]
        if up >= 0:
            n[up] += n[i]
            least[up] = least[i] if least[up] is None else min(least[up], least[i])
            children[up] += shared[i] is None
            leaves[up] += leaves[i]
            saved[up] += saved[i]
    names = [field.split()[0] for field in ROW.split(", ")]
    columns = {
        "shared": shared,
        "parent_shared": [shared[p] if p >= 0 else None for p in parent],
        "conv_id": least,
        "depth": depth,
        "parent_conv_id": [least[p] if p >= 0 else None for p in parent],
        "n_convs": n,
        "n_children": children,
        "n_leaves": leaves,
        "saved": saved,
        "n_bytes": size,
        "ends_sha256": [e[2] if e else None for e in ends],
    }
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    types = [kinds[field.split()[1]] for field in ROW.split(", ")]
    arrays = [pa.array(columns[c], t) for c, t in zip(names, types, strict=True)]
    return pa.table(arrays, names=names)


# -- conversations ------------------------------------------------------------------


def turn_id(role: Column, text: Column) -> Column:
    """The fixed-width id, as hexadecimal text."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.sha2(told.cast("binary"), 256), 1, 2 * DIGEST)
    return F.concat(digest, F.lpad(F.lower(F.hex(F.octet_length(text))), 2 * LENGTH, "0"))


def head_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key): each conversation's turn ids, its head taken from the first of five."""
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"),
            F.col("turn"),
            turn_id(F.col("role"), F.col("text")).alias("id"),
        ).alias("t"),
    )
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["id"].alias("ids"))
    heads = own.filter(f"conv_id % {FOLDS} = 0").select(
        F.col("conv_id").alias("first"), F.slice("ids", 1, HEADS - 1).alias("head")
    )
    first = (F.col("conv_id") - F.col("conv_id") % FOLDS).alias("first")
    h = head_turns(F.col("conv_id")).cast("int")
    joined = own.select("conv_id", "ids", first, h.alias("h")).join(heads, "first", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    rest = F.slice("ids", F.col("h") + 1, F.greatest(F.size("ids") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", F.unhex(F.array_join(F.concat(head, rest), "")).alias("key"))


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, block, ids, n, least) to (digest, n, least, ends_sha256), block after block."""
    at, state, n, least = None, None, 0, None
    for batch in batches:
        done = []
        for digest, _, ids, count, first in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if digest != at:
                if at is not None:
                    done.append((at, n, least, state.hexdigest()))
                at, state, n, least = digest, hashlib.sha256(), 0, first
            else:
                state.update(b",")
            state.update(ids.encode())
            n += count
        if done:
            yield _ended(done)
    if at is not None:
        yield _ended([(at, n, least, state.hexdigest())])


def _ended(done: list[tuple]) -> pa.RecordBatch:
    digest, n, least, ends = zip(*done, strict=True)
    return pa.record_batch(
        [pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(least, pa.int64()), pa.array(ends)],
        names=["digest", "n", "least", "ends_sha256"],
    )


def distinct_keys(convs: DataFrame) -> DataFrame:
    """(digest, key, n, least, ends_sha256): the conversations of each key, ids in order.

    Ids are joined in blocks by any number of tasks; one task then hashes a key's blocks
    one after the other, as SHA-256 demands, and holds one block at a time.
    """
    keyed = convs.select("conv_id", "key", F.unhex(F.sha2("key", 256)).alias("digest"))
    blocks = keyed.groupBy("digest", F.expr(f"conv_id div {ID_BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list("conv_id")).alias("all")
    )
    blocks = blocks.select(
        "digest",
        "block",
        F.array_join(F.transform("all", lambda i: i.cast("string")), ",").alias("ids"),
        F.size("all").cast("long").alias("n"),
        F.get("all", F.lit(0)).alias("least"),
    )
    ended = (
        blocks.repartition("digest")
        .sortWithinPartitions("digest", "block")
        .mapInArrow(digests, "digest binary, n long, least long, ends_sha256 string")
    )
    # the least of the keys of one digest, which is the only one
    keys = keyed.groupBy("digest").agg(F.min("key").alias("key"))
    return keys.join(ended, "digest")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    Turns are ordered by turn, null first, and of one number by the digest of their role
    and text; a turn that repeats counts each time.  A null role or text is an empty one.
    Rows without conv_id belong to no conversation.  An empty table has no nodes, not
    even a root.  A conversation with no turns left belongs to the root.  Very long
    texts are hashed in the JVM; only ids move.  Other columns are not read.

    A conversation's ids, 20 bytes a turn, are one row.  Identical conversations are one
    key, however many; a first turn that many conversations share costs its cuts.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "prefixes")
    convs = scratch.save(rebuilt(conversations), "convs")
    seen = Observation()
    keys = distinct_keys(convs).observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.length("key")).alias("size")
    )
    keys = scratch.save(keys, "keys")
    n, size = seen.get["n"], seen.get["size"] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(min(tasks, n // RANGE_KEYS), size // RANGE_BYTES) + 1
    cuts, nodes = shared_nodes(sorted(set(choose_cuts(keys, ranges))))
    sent = spark.sparkContext.broadcast(cuts)

    kind = "key binary, n long, least long, ends_sha256 string"
    numbered = keys.select("key", "n", "least", "ends_sha256").mapInArrow(
        partial(number_ranges, cuts=sent), f"{kind}, range int"
    )

    def build(rows: pa.Table) -> pa.Table:
        return range_nodes(rows, sent)

    found = numbered.groupBy("range").applyInArrow(build, ROW)
    found = scratch.save(found, "nodes")

    # shared nodes: as many as the cuts have turns
    known = spark.createDataFrame(nodes, "shared int, more int, twice long")
    parts = found.filter("shared IS NOT NULL").groupBy("shared").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent_shared").alias("parent_shared"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved").alias("saved"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    whole = scratch.save(
        parts.join(F.broadcast(known), "shared")
        .withColumn("n_children", F.col("n_children") + F.col("more"))
        .withColumn("saved", F.col("saved") - F.col("twice"))
        .drop("more", "twice"),
        "shared",
    )
    above = F.broadcast(
        whole.select(F.col("shared").alias("parent_shared"), F.col("conv_id").alias("above"))
    )
    final = found.filter("shared IS NULL").drop("n_bytes")
    final = final.unionByName(whole, allowMissingColumns=True).join(above, "parent_shared", "left")
    return final.select(
        "conv_id",
        "depth",
        F.coalesce("above", "parent_conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256"),
    )
