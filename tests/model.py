"""Tables, hand-written batches and a row-by-row model of the apply procedure."""

from __future__ import annotations

from datetime import datetime, timedelta

from tidemark.config import define_table

ACCOUNT = define_table("dim_account", "account_id long, note string, modified_date timestamp")
PLACE = define_table(
    "dim_place", "place_id long, note string, modified_date timestamp", versioned=True
)
DAY = datetime(2024, 3, 1)


def change(seq, op, key, note=None, day=0, at=None):
    """One change; commit time rises with the sequence unless given."""
    return (
        at or DAY + timedelta(seconds=seq),
        None,
        f"0x{seq:020X}",
        op,
        1,
        key,
        note,
        None if day is None else DAY + timedelta(days=day),
    )


def frame(spark, table, rows):
    return spark.createDataFrame(rows, table.stage_schema)


def target(spark, table, rows=()):
    """Target rows as (key, note, day, flags…)."""
    dated = [(k, n, None if d is None else DAY + timedelta(days=d), *f) for k, n, d, *f in rows]
    return spark.createDataFrame(dated, table.target_schema)


def rows_of(df):
    """Rows as (key, note, day, flags…), sorted."""
    found = [
        (r[0], r[1], None if r[2] is None else (r[2] - DAY).days, *r[3:]) for r in df.collect()
    ]
    return sorted(found, key=repr)


def apply_type1(state, batch):
    """``state`` maps key to [note, day, is_deleted]."""
    state = {k: list(v) for k, v in state.items()}
    for key in {c[5] for c in batch if c[3] in (2, 4)}:
        last = max((c for c in batch if c[5] == key and c[3] in (2, 4)), key=lambda c: c[2])
        deleted = state[key][2] if key in state else False
        state[key] = [last[6], last[7], deleted]
    for c in batch:
        if c[3] == 1 and c[5] in state:
            state[c[5]][2] = True
    return state


def apply_versioned(rows, batch):
    """``rows`` is a list of [key, note, day, is_deleted, is_current]."""
    rows = [list(r) for r in rows]
    rows += [[c[5], c[6], c[7], False, False] for c in batch if c[3] in (2, 4)]
    dropped = {c[5] for c in batch if c[3] == 1}
    for r in rows:
        if r[0] in dropped:
            r[3] = True
    for key in {c[5] for c in batch}:
        dates = [c[7] for c in batch if c[5] == key and c[7] is not None]
        for r in rows:
            if r[0] == key:
                r[4] = bool(dates) and r[2] == max(dates)
    return rows
