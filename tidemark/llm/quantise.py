"""Near duplicates among embeddings by iterative quantisation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.scratch import Scratch

COSINE = 0.93
BITS, BLOCKS = 64, 4
BLOCK_BITS = BITS // BLOCKS
BLOCK_RADIUS = 2  # met by listing each code under all keys one bit away
RADIUS = 22  # bits that may differ in the whole code
MAX_SAMPLE = 20_000  # vectors of one length to learn from
MAX_LENGTHS = 64  # vector lengths whose rotations are broadcast together; each set is a pass
SHARES = 1 << 30
CODED = "id long, code long, keys array<long>"


def random_rotation(rng: np.random.Generator, n: int) -> np.ndarray:
    q, r = np.linalg.qr(rng.normal(size=(n, n)))
    return q * np.sign(np.diag(r))


def learn_rotation(vectors: np.ndarray, steps: int = 40, seed: int = 8) -> np.ndarray:
    """A length x BITS matrix whose products' signs are a vector's code.

    Principal components about the origin are turned until the signs lie as near as
    possible to the projected vectors.  Where a vector has fewer components than the
    code has bits, further rotations from other starts add theirs.

    Nothing is shifted by the mean: cosines are angles at the origin, and vectors with a
    strong common direction would be torn apart by angles at their mean.  About the
    origin that direction is the first component, and turning spreads it over all bits,
    so that near vectors agree in their codes whatever the mean is.
    """
    rng = np.random.default_rng(seed)
    _, axes = np.linalg.eigh(vectors.T @ vectors)
    axes = axes[:, ::-1][:, :BITS]
    flat = vectors @ axes
    columns: list[np.ndarray] = []
    while sum(c.shape[1] for c in columns) < BITS:
        turn = random_rotation(rng, flat.shape[1])
        for _ in range(steps if len(vectors) else 0):
            u, _, vt = np.linalg.svd(np.sign(flat @ turn).T @ flat)
            turn = (u @ vt).T
        columns.append(axes @ turn)
    return np.concatenate(columns, axis=1)[:, :BITS]


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    vectors = vectors / largest
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    ends = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    length = np.diff(ends)
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        yield rows, values[ends[rows][:, None] + np.arange(n)]


def encode(
    batches: Iterator[pa.RecordBatch], rotations: dict[int, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """(id, vector) to (id, code, keys): a key is a block's number and value, listed for
    the code itself and for every code that differs from it in one bit of that block."""
    flips = np.array([0, *(1 << b for b in range(BLOCK_BITS))], np.int64)
    for batch in batches:
        codes = np.zeros(batch.num_rows, np.uint64)
        for rows, vectors in by_length(batch.column(1)):
            signs = unit(vectors) @ rotations[vectors.shape[1]] > 0
            codes[rows] = np.packbits(signs, axis=1, bitorder="little").view(np.uint64).ravel()
        keys = []
        for block in range(BLOCKS):
            value = (codes >> np.uint64(block * BLOCK_BITS)).astype(np.int64)
            value &= (1 << BLOCK_BITS) - 1
            keys.append((block << BLOCK_BITS) | (value[:, None] ^ flips))
        both = np.concatenate(keys, axis=1)
        ends = pa.array(np.arange(batch.num_rows + 1) * both.shape[1], pa.int32())
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(codes.view(np.int64)),
                pa.ListArray.from_arrays(ends, pa.array(both.ravel())),
            ],
            names=["id", "code", "keys"],
        )


def _encode(batches: Iterator[pa.RecordBatch], rotations) -> Iterator[pa.RecordBatch]:
    return encode(batches, rotations.value)


def cosines(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """(a, b, vector of a, vector of b) to the pairs (a, b) with this cosine or more."""
    for batch in batches:
        near = np.zeros(batch.num_rows, bool)
        right = {int(r): v for rows, vs in by_length(batch.column(3)) for r, v in zip(rows, vs, strict=True)}
        for rows, left in by_length(batch.column(2)):
            other = np.array([right[int(r)] for r in rows])
            near[rows] = (unit(left) * unit(other)).sum(axis=1) >= least
        yield batch.select([0, 1]).filter(pa.array(near))


def _lengths(vectors: DataFrame) -> list[list]:
    """The lengths there are with their counts, so many at a time as are broadcast at once."""
    lengths = vectors.groupBy(F.size("vector").alias("length")).count()
    found = lengths.orderBy("length").collect()
    return [found[i : i + MAX_LENGTHS] for i in range(0, len(found), MAX_LENGTHS)]


def _rotations(vectors: DataFrame, lengths: list) -> dict[int, np.ndarray]:
    """A rotation for each of these lengths, learnt in a task each."""
    share = {r["length"]: int(SHARES * min(1.0, MAX_SAMPLE / r["count"])) for r in lengths}
    least = F.try_element_at(
        F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.size("vector")
    )
    draw = F.pmod(F.xxhash64(F.lit("itq"), F.col("id")), F.lit(SHARES))
    sample = vectors.filter(draw < least).select(F.size("vector").alias("length"), "id", "vector")

    def fit(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table.column("id").to_pylist(), table.column("vector").to_pylist(), strict=True))
        matrix = learn_rotation(unit(np.array([v for _, v in rows[: 2 * MAX_SAMPLE]], np.float64)))
        return pa.table(
            {
                "length": table.column("length")[:1],
                "matrix": pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary()),
            }
        )

    found = sample.groupBy("length").applyInArrow(fit, "length int, matrix binary").collect()
    return {
        r["length"]: np.frombuffer(r["matrix"], np.float64).reshape(r["length"], BITS)
        for r in found
    }


def _block(code: Column, block: int) -> Column:
    return F.shiftrightunsigned(code, block * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1)


def _first_meeting(a: Column, b: Column, key: Column) -> Column:
    """Whether two codes meet at this key for the first time: in the first block that
    differs in at most two bits, at the least key that both are listed under."""
    earlier, first = F.lit(False), F.lit(False)
    for block in range(BLOCKS):
        mine, yours = _block(a, block), _block(b, block)
        differ = mine.bitwiseXOR(yours)
        low = differ.bitwiseAND(-differ)
        between = F.least(mine.bitwiseXOR(low), yours.bitwiseXOR(low))
        count = F.bit_count(differ)
        least = F.when(count == 0, mine).when(count == 1, F.least(mine, yours)).otherwise(between)
        here = F.shiftright(key, BLOCK_BITS) == block
        value = key.bitwiseAND((1 << BLOCK_BITS) - 1)
        first = first | (here & ~earlier & (value == least))
        earlier = earlier | (count <= BLOCK_RADIUS)
    return first


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    group_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors of the same group are linked if their cosine, in double precision,
    is at least ``cosine``.  Each vector gets a 64-bit code of signs after a
    learnt rotation.  Codes meet in tables of 16-bit blocks if some block differs
    in at most two bits; of those, pairs within RADIUS bits are compared by their
    vectors.  At a cosine of 0.93 a pair is found with probability 0.99, nearer pairs
    almost surely, and whatever direction the vectors have in common; the more of it
    they have, the more pairs are compared.  No pair is linked without its cosine.

    Equal vectors of a group are one class and are never paired with each other;
    their number counts in ``n_links``.  Vectors of different length are not
    linked.  A null group or id, and a vector that is null, empty, zero or has
    null or non-finite components, is linked with nothing: ``n_links`` 0 and its
    own component (a null id has a null component and stays).  Repeated rows
    count one by one.  Other columns are not looked at.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "quantise")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(group_col).alias("group"),
        F.col(vector_col).alias("vector"),
    )
    good = (
        F.col("id").isNotNull()
        & F.col("group").isNotNull()
        & F.col("vector").isNotNull()
        & ~F.exists("vector", odd)
        & F.exists("vector", lambda x: x != 0)
    )
    good = F.coalesce(good, F.lit(False))
    prints = [F.xxhash64("vector").alias("f1"), F.xxhash64(F.lit(8), "vector").alias("f2")]
    key = ["group", "f1", "f2"]
    usable = rows.filter(good).select("id", "group", "vector", *prints)
    classes = usable.groupBy(*key).agg(
        F.min("id").alias("id"), F.count("*").alias("size"), F.first("vector").alias("vector")
    )
    classes = scratch.save(classes, "classes")

    plain = classes.select("id", "vector")
    coded = None
    for lengths in _lengths(plain):
        rotations = spark.sparkContext.broadcast(_rotations(plain, lengths))
        own = plain.filter(F.size("vector").isin([r["length"] for r in lengths]))
        part = own.mapInArrow(partial(_encode, rotations=rotations), CODED)
        coded = part if coded is None else coded.unionByName(part)
    if coded is None:
        coded = spark.createDataFrame([], CODED)
    of = classes.select("id", "group", F.size("vector").alias("length"))
    listed = coded.join(of, "id").select("group", "length", "id", "code", F.explode("keys").alias("key"))
    listed = scratch.save(listed, "listed")
    one = listed.toDF("group", "length", "a", "ca", "key")
    two = listed.toDF("group", "length", "b", "cb", "key")
    apart = F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")))
    pairs = (
        one.join(two, ["group", "length", "key"])
        .filter((F.col("a") < F.col("b")) & (apart <= RADIUS))
        .filter(_first_meeting(F.col("ca"), F.col("cb"), F.col("key")))
        .select("a", "b")
    )
    vector = classes.select("id", "vector")
    links = (
        pairs.join(vector.toDF("a", "va"), "a")
        .join(vector.toDF("b", "vb"), "b")
        .select("a", "b", "va", "vb")
        .mapInArrow(partial(cosines, least=cosine), "a long, b long")
    )
    links = scratch.save(links, "links")
    linked = components(links, "a", "b", scratch, "stars")
    size = classes.select("id", "size")
    others = (
        links.join(size.toDF("b", "size"), "b")
        .select(F.col("a").alias("id"), "size")
        .union(links.join(size.toDF("a", "size"), "a").select("b", "size"))
        .groupBy("id")
        .agg(F.sum("size").alias("others"))
    )
    scratch.drop("listed")
    found = (
        classes.select(*key, F.col("id").alias("rep"), "size")
        .join(others.toDF("rep", "others"), "rep", "left")
        .join(linked.toDF("rep", "component"), "rep", "left")
        .select(
            *key,
            (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    keyed = rows.select("id", *[F.when(good, c).alias(n) for c, n in zip((F.col("group"), *prints), key, strict=True)])
    own = F.col("id")
    return keyed.join(found, key, "left").select(
        own.alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", own).alias("component_id"),
        own.eqNullSafe(F.coalesce("component", own)).alias("kept"),
    )
