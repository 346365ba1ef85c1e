"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import Scratch
from tidemark.llm.words import GAP

UNIT = 1 << 24  # expected copies are counted in whole parts of this size
SALTS = 2  # hex digits of the salt within one source and size: 256 blocks
SUB_ROWS = 1 << 16  # row numbers of one run
BROADCAST_SOURCES = 100_000  # targets, about 100 bytes each
BROADCAST_ROWS = 500_000  # copies, about 50 bytes each


def n_words(text: Column) -> Column:
    """Words of a text by one split; an empty one is before or after white space."""
    return F.coalesce(F.size(F.array_remove(F.split(text, GAP), "")), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """The source as a join key that tells null from every text."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2
) -> DataFrame:
    """(source, source_size) with each source's target added.

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all sizes.  No target passes ``most`` times its source's size;
    what is cut off goes to the others by weight, until none is above.  That is
    one level for all sources that are not capped: with sources ordered by the
    level at which they fill up, running sums give the level at each place, and
    the first source that its level does not fill sets it.

    The table holds a row per source, so its windows are one small task.
    """
    cycle = F.array(*map(F.lit, weights))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    )
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, after = (
        filling.rowsBetween(Window.unboundedPreceding, -1),
        filling.rowsBetween(0, Window.unboundedFollowing),
    )
    total = F.sum("source_size").over(everything).cast("double") * share
    full = F.coalesce(F.sum("cap").over(before), F.lit(0))
    level = (total - full) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level).withColumn("turn", F.row_number().over(filling))
    open_turn = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("turn"))
    levels = levels.withColumn("open_turn", F.min(open_turn).over(everything))
    at_open = F.when(F.col("turn") == F.col("open_turn"), F.col("level"))
    levels = levels.withColumn("level", F.min(at_open).over(everything))
    cap = F.col("cap").cast("double")
    target = F.when(F.col("turn") < F.col("open_turn"), cap).otherwise(
        F.coalesce(F.col("level") * F.col("weight"), cap)
    )
    return levels.select("source", "source_size", target.alias("target"))


def ranks(rows: DataFrame, group: str, order: str, row_id: str, row: str) -> DataFrame:
    """``rows`` with ``rank``: each row's place from 1 within its group, by ``order``, then
    by a hash of ``row_id``, by ``row_id``, null first, and by ``row``, the row's number.

    A group may hold any share of the rows, and so may an id.  Places are added up in
    steps, each of them small: over the values of ``order`` in a group, over the hashes
    of one value, over the ids of one hash, and for ids that repeat over runs of
    SUB_ROWS row numbers, and over the rows of one run.
    """
    salt = F.substring(F.md5(F.coalesce(F.col(row_id).cast("string"), F.lit(""))), 1, SALTS)
    base = rows.withColumn("salt", salt)
    keys = [group, order, "salt", row_id]
    ids = base.groupBy(*keys).agg(F.count("*").alias("n"), F.min(row).alias(row))

    def before(within: list[str], *by: str) -> Column:
        window = Window.partitionBy(*within).orderBy(*by)
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), F.lit(0))

    salts = base.groupBy(group, order, "salt").agg(F.count("*").alias("n"))
    values = salts.groupBy(group, order).agg(F.sum("n").alias("n"))
    values = values.select(group, order, before([group], order).alias("p"))
    salts = salts.withColumn("q", before([group, order], "salt")).drop("n")
    salts = salts.join(values, [group, order]).withColumn("p", F.col("p") + F.col("q")).drop("q")
    ids = ids.withColumn("r", before(keys[:3], row_id)).join(salts, keys[:3])
    ids = ids.withColumn("r", F.col("r") + F.col("p")).drop("p")

    columns = [group, order, row_id, row]
    once = ids.filter("n = 1").select(*columns, (F.col("r") + 1).alias("rank"))
    # Ids that repeat: their rows meet their run's place by a key of SUB_ROWS rows at most.
    sub = F.floor(F.col(row) / SUB_ROWS).alias("sub")
    runs = base.groupBy(*keys, sub).agg(F.count("*").alias("n"))
    many = ids.filter("n > 1").select(*[F.col(k).alias(f"{k}#") for k in keys], "r")
    same = [F.col(k).eqNullSafe(F.col(f"`{k}#`")) for k in keys]
    runs = runs.withColumn("s", before(keys, "sub")).join(many, same)
    runs = runs.select(*[f"`{k}#`" for k in keys], F.col("sub").alias("sub#"), (F.col("r") + F.col("s")).alias("r"))
    in_run = Window.partitionBy(*keys, "sub").orderBy(row)
    repeated = base.withColumn("sub", sub).join(runs, [*same, F.col("sub") == F.col("`sub#`")])
    place = F.row_number().over(in_run).cast("long") + F.col("r")
    return once.unionByName(repeated.select(*columns, place.alias("rank")))


def numbered_copies(rank: Column, expected: Column, start: Column) -> Column:
    """Copies of the row in a place, if each row of its group expects as many.

    Expected copies are added up along the group; a row is emitted once for each whole
    number that its part of the running sum, moved by ``start``, crosses.  So it gets
    its expected copies rounded up or down, and any run of rows gets its sum to within
    one copy.  Sums are of whole parts of UNIT, so that reruns agree.
    """
    each = F.floor(F.coalesce(expected, F.lit(0.0)) * UNIT + 0.5).cast("long")
    upto = each * rank + F.floor(start * UNIT).cast("long")
    return F.floor(upto / UNIT).cast("long") - F.floor((upto - each) / UNIT).cast("long")


def sizes(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A written table of (row, doc_id, source, name, size): texts are read once, for their
    number of words, and no text is moved."""
    return scratch.save(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id"),
            F.col("source"),
            _key(F.col("source")).alias("name"),
            n_words(F.col("text")).alias("size"),
        ),
        "sizes",
    )


def mix(
    sized: DataFrame,
    scratch: Scratch,
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """(row, doc_id, size, source_size, target, copies) for the rows of ``sizes``.

    Sizes are words; a null or empty text has none, and an empty source expects
    no copies.  Expected copies of a document are its source's target over its
    size, so at most ``most``.  Documents are sampled in order of size, so that
    the words taken come near the target and not only the documents.  A source's
    offset is drawn from the seed and its name.  Null sources are one source; rows that
    repeat, or have no id, are sampled one by one; rows of one size and id are taken by
    their number.  An empty table gives no rows.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share, most)
    targets = targets.select(_key(F.col("source")).alias("name"), "source_size", "target")
    targets, seen = scratch.save_seen(targets, "targets")
    few = seen["n"] <= BROADCAST_SOURCES
    ranked = ranks(sized.select("row", "doc_id", "name", "size"), "name", "size", "doc_id", "row")
    # Beyond the bound, adaptive execution splits a source that is joined by its name.
    rows = ranked.join(F.broadcast(targets) if few else targets, "name")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("name"))), 1, 6), 16, 10)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    copies = numbered_copies(F.col("rank"), expected, offset.cast("double") / (1 << 24))
    return rows.select("row", "doc_id", "size", "source_size", "target", copies.alias("copies"))


def document_copies(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, copies) of each document."""
    scratch = Scratch(docs.sparkSession, "mixing")
    return mix(sizes(docs, scratch), scratch, **options).drop("row")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered ``copy_no``.

    Documents are written once with their row numbers, and meet their copies by these:
    by broadcast while the counted copies are few, else in one shuffle.  Other columns
    ride along; one named ``copy_no`` is replaced.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    numbered = scratch.save(docs.select(own, F.monotonically_increasing_id().alias("row")), "docs")
    sized = numbered.select(
        "row",
        F.col("own.doc_id").alias("doc_id"),
        F.col("own.source").alias("source"),
        _key(F.col("own.source")).alias("name"),
        n_words(F.col("own.text")).alias("size"),
    )
    copies = mix(scratch.save(sized, "sizes"), scratch, **options)
    copies, seen = scratch.save_seen(copies.filter("copies > 0").select("row", "copies"), "copies")
    few = seen["n"] <= BROADCAST_ROWS
    taken = numbered.join(F.broadcast(copies) if few else copies, "row")
    repeated = taken.select("own", F.explode(F.expr("sequence(1, copies)")).alias("copy_no#"))
    names = [F.col(f"own.`{c}`") for c in docs.columns if c.lower() != "copy_no"]
    return repeated.select(*names, F.col("`copy_no#`").alias("copy_no"))
