"""Random feeds: the Spark results equal a row-by-row model, however they are run."""

import random
from functools import reduce

import pytest
from model import ACCOUNT, DAY, PLACE, apply_type1, apply_versioned, change, frame, rows_of, target
from pyspark.sql import functions as F

from tidemark.operators import replay
from tidemark.operators.joins import BROADCAST_BYTES

SMALL, UNKNOWN = BROADCAST_BYTES, None


def random_batches(seed):
    """Sequence values are unique but do not rise from batch to batch."""
    rng = random.Random(seed)
    sequence = iter(rng.sample(range(1, 1000), 100))
    batches = []
    for _ in range(rng.randint(1, 4)):
        batch = []
        for _ in range(rng.randint(0, 12)):
            seq, day = next(sequence), rng.choice([None, 0, 1, 2, 3])
            batch.append(change(seq, rng.choice([1, 2, 4]), rng.randint(1, 5), f"n{seq}", day))
        batches.append(batch)
    return batches


def numbered(spark, table, batches):
    rows = [(*c, n) for n, batch in enumerate(batches, start=1) for c in batch]
    schema = frame(spark, table, []).withColumn("batch_no", F.lit(1)).schema
    return spark.createDataFrame(rows, schema)


def day_of(date):
    return None if date is None else (date - DAY).days


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("size", [SMALL, UNKNOWN])
def test_type1(spark, seed, size):
    batches = random_batches(seed)
    state = reduce(apply_type1, batches, {1: ["s", DAY, False], 2: ["t", DAY, True]})
    want = sorted(((k, n, day_of(d), x) for k, (n, d, x) in state.items()), key=repr)
    start = target(spark, ACCOUNT, [(1, "s", 0, False), (2, "t", 0, True)])
    history = numbered(spark, ACCOUNT, batches)
    assert rows_of(replay.replay(start, history, ACCOUNT, size)) == want
    one_by_one = [frame(spark, ACCOUNT, b) for b in batches]
    result = replay.apply_batches(start, one_by_one, ACCOUNT)
    assert rows_of(result) == want
    # the last batch once more changes no content and resets no flag, but may
    # delete a key that the batch itself created after its delete was lost
    assert replay.apply_batches(result, one_by_one[-1:], ACCOUNT).count() == len(want)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("size", [SMALL, UNKNOWN])
def test_versioned(spark, seed, size):
    batches = random_batches(seed)
    state = reduce(apply_versioned, batches, [[1, "s", DAY, False, True]])
    want = sorted(((r[0], r[1], day_of(r[2]), r[3], r[4]) for r in state), key=repr)
    start = target(spark, PLACE, [(1, "s", 0, False, True)])
    history = numbered(spark, PLACE, batches)
    assert rows_of(replay.replay(start, history, PLACE, size)) == want
    one_by_one = [frame(spark, PLACE, b) for b in batches]
    assert rows_of(replay.apply_batches(start, one_by_one, PLACE)) == want
