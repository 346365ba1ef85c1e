"""Expected answers of the registered queries as plain SQL for DuckDB.

Feeds are spelled out again here.  Successive batches are applied one after the
other, step by step, while the Spark side mostly works in closed form.
"""

from __future__ import annotations

from tidemark.config import CHANGE_COLUMNS, SALES_TABLES, TableConfig
from tidemark.plans.feeds import CUSTOMER_BALANCE, CUSTOMER_VERSIONS, REGION

CHANGES = ", ".join(CHANGE_COLUMNS)
_REGION = REGION.columns
BATCH_NO = """CASE WHEN start_lsn < TIMESTAMP '2024-01-08' THEN 1
    WHEN start_lsn < TIMESTAMP '2024-01-15' THEN 2
    WHEN start_lsn < TIMESTAMP '2024-01-22' THEN 3 ELSE 4 END"""


def _with(*parts: str, result: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + result


# -- feeds ------------------------------------------------------------------------

EVENT_CHANGES = """event_changes AS (
    SELECT *, user_id * 15 + (event_id // 20) % 15 AS k,
           '0x' || lpad(hex(event_id), 20, '0') AS seqval,
           unnest(CASE WHEN event_id % 20 = 0 THEN [1]
                       WHEN event_id % 20 <= 6 THEN [2] ELSE [3, 4] END)::INTEGER AS operation
    FROM events)"""

CUSTOMER_CT = (
    EVENT_CHANGES
    + """,
customer_ct AS (
    SELECT ts AS start_lsn, NULL::TIMESTAMP AS end_lsn, seqval, operation, 1 AS command_id,
           k AS customer_id, event_type AS segment,
           CASE WHEN operation = 3 THEN value - 1 ELSE value END AS balance,
           ts AS modified_date
    FROM event_changes),
customer_batches AS (
    SELECT *, """
    + BATCH_NO
    + """ AS batch_no FROM customer_ct WHERE operation <> 3)"""
)

CUSTOMER_SEED = """customer_seed AS (
    SELECT c_custkey AS customer_id, c_mktsegment AS segment, c_acctbal AS balance,
           TIMESTAMP '2023-12-31' AS modified_date, FALSE AS is_deleted
    FROM customer)"""

REGION_CT = (
    """region_ct AS (
    SELECT ts AS start_lsn, NULL::TIMESTAMP AS end_lsn,
           '0x' || lpad(hex(event_id), 20, '0') AS seqval,
           unnest(CASE WHEN event_id % 200 = 0 THEN [1]
                       WHEN event_id % 3 = 0 THEN [2] ELSE [3, 4] END)::INTEGER AS operation,
           1 AS command_id, user_id % 50 AS region_id, event_type AS region_name,
           date_trunc('day', ts)::TIMESTAMP AS modified_date
    FROM events),
region_batches AS (
    SELECT *, """
    + BATCH_NO
    + """ AS batch_no FROM region_ct WHERE operation <> 3)"""
)

REGION_SEED = """region_seed AS (
    SELECT n_nationkey::BIGINT AS region_id, n_name AS region_name,
           TIMESTAMP '2023-12-31' AS modified_date, FALSE AS is_deleted, TRUE AS is_current
    FROM nation)"""

REGISTRY = """registry AS (
    SELECT 'dim_customer' AS table_name, max(start_lsn) AS last_update
    FROM customer_batches WHERE batch_no = 1
    UNION ALL SELECT 'dim_region', NULL)"""

GUID = "'00000000-0000-0000-0000-' || lpad({}::VARCHAR, 12, '0')"

SALES_SOURCES = [
    EVENT_CHANGES,
    REGION_CT,
    """line_changes AS (
    SELECT *, unnest(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN [1]
                          WHEN l_linestatus = 'O' THEN [2] ELSE [3, 4] END) AS operation
    FROM lineitem)""",
    """order_changes AS (
    SELECT *, o_orderdate + to_days(CASE operation WHEN 2 THEN 0 WHEN 1 THEN 30 ELSE 7 END)
              AS changed
    FROM (SELECT *, unnest(CASE o_orderstatus WHEN 'O' THEN [2] WHEN 'P' THEN [2, 3, 4]
                                              ELSE [2, 1] END) AS operation
          FROM orders))""",
]


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _sales_feed(name: str, source: str, ts: str, seqval: str, **columns: str) -> str:
    """A table's change log; columns that are not given are NULL."""
    fields = SALES_TABLES[name].row_schema.fields
    kinds = [SQL_TYPES.get(k := f.dataType.simpleString(), k) for f in fields]
    values = [
        f"CAST({columns.get(f.name, 'NULL')} AS {kind}) AS {f.name}"
        for f, kind in zip(fields, kinds, strict=True)
    ]
    return f"""SELECT {ts} AS start_lsn, {seqval} AS seqval, operation, 1 AS command_id,
        {", ".join(values)} FROM {source}"""


def _event_feed(name: str, **columns: str) -> str:
    guid = GUID.format("event_id")
    return _sales_feed(
        name, "event_changes", "ts", "seqval", rowguid=guid, modified_date="ts", **columns
    )


_DAYS = "lpad(hex(date_diff('day', TIMESTAMP '1995-01-01', {})), 4, '0')"

SALES_FEEDS = {
    "dim_address": _event_feed(
        "dim_address",
        address_id="k",
        address_line1="'Line ' || event_id",
        city="'City ' || user_id",
        state_province="event_type",
    ),
    "dim_customer": _event_feed(
        "dim_customer",
        customer_id="k",
        first_name="'First' || user_id",
        last_name="'Last' || event_id",
        company_name="event_type",
    ),
    "dim_customer_address": _event_feed(
        "dim_customer_address",
        customer_address_id="k",
        customer_id="user_id",
        address_id="event_id",
        address_type="event_type",
    ),
    "dim_region": """SELECT start_lsn, seqval, operation, command_id, region_id, region_name,
        modified_date FROM region_ct""",
    "fact_sales_order_detail": _sales_feed(
        "fact_sales_order_detail",
        "line_changes",
        "l_shipdate",
        f"""'0x' || {_DAYS.format("l_shipdate")} || lpad(hex(l_partkey), 10, '0')
            || lpad(hex(l_suppkey), 6, '0')""",
        sales_order_detail_id="l_orderkey * 10 + l_linenumber",
        sales_order_id="l_orderkey",
        order_qty="l_quantity",
        product_id="l_partkey",
        unit_price="l_extendedprice",
        unit_price_discount="l_discount",
        line_total="l_extendedprice::DECIMAL(19, 4) * l_quantity::INTEGER",
        rowguid=GUID.format("l_partkey"),
        modified_date="l_shipdate",
    ),
    "fact_sales_order_header": _sales_feed(
        "fact_sales_order_header",
        "order_changes",
        "changed",
        f"'0x' || {_DAYS.format('changed')} || lpad(hex(o_orderkey), 16, '0')",
        sales_order_id="o_orderkey",
        revision_number="CASE WHEN operation = 2 THEN 1 ELSE 2 END",
        order_date="o_orderdate",
        status="CASE WHEN operation = 4 THEN 5 ELSE 1 END",
        online_order_flag="o_orderpriority = '5-LOW'",
        sales_order_number="'SO' || o_orderkey",
        customer_id="o_custkey",
        sub_total="o_totalprice",
        total_due="o_totalprice",
        rowguid=GUID.format("o_orderkey"),
        modified_date="changed",
    ),
}
# The label of the result over all tables.
LABELS = {name: "rowguid" for name in SALES_FEEDS} | {"dim_region": "region_name"}


# -- steps of the apply procedure -------------------------------------------------


def _latest(batch: str, key: str) -> str:
    return f"""(SELECT * FROM {batch} WHERE operation IN (2, 4)
        QUALIFY row_number() OVER (
            PARTITION BY {key} ORDER BY seqval DESC, start_lsn DESC, command_id DESC) = 1)"""


def _upsert(out: str, target: str, batch: str, columns: list[str]) -> str:
    key = columns[0]
    chosen = ", ".join(
        f"CASE WHEN n.{key} IS NOT NULL THEN n.{c} ELSE t.{c} END AS {c}" for c in columns
    )
    return f"""{out} AS (
    SELECT {chosen}, coalesce(t.is_deleted, FALSE) AS is_deleted
    FROM {target} t FULL OUTER JOIN {_latest(batch, key)} n ON t.{key} = n.{key})"""


def _delete(out: str, target: str, batch: str, columns: list[str], *others: str) -> str:
    key = columns[0]
    return f"""{out} AS (
    SELECT {", ".join([*columns, *others])}, is_deleted OR EXISTS (
        SELECT 1 FROM {batch} s WHERE s.{key} = t.{key} AND s.operation = 1) AS is_deleted
    FROM {target} t)"""


def _type1_step(out: str, target: str, batch: str, columns: list[str]) -> list[str]:
    return [
        _upsert(f"{out}_up", target, batch, columns),
        _delete(out, f"{out}_up", batch, columns),
    ]


def _append(out: str, target: str, batch: str, columns: list[str]) -> str:
    cols = ", ".join(columns)
    return f"""{out} AS (
    SELECT {cols}, is_deleted, is_current FROM {target}
    UNION ALL SELECT {cols}, FALSE, FALSE FROM {batch} WHERE operation IN (2, 4))"""


def _reset(out: str, target: str, batch: str, columns: list[str]) -> str:
    key = columns[0]
    return f"""{out} AS (
    SELECT {", ".join(columns)}, is_deleted, is_current AND NOT EXISTS (
        SELECT 1 FROM {batch} s WHERE s.{key} = t.{key}) AS is_current
    FROM {target} t)"""


def _set(out: str, target: str, batch: str, columns: list[str]) -> str:
    key = columns[0]
    return f"""{out} AS (
    SELECT {", ".join(f"t.{c}" for c in columns)}, is_deleted,
           is_current OR coalesce(t.modified_date = m.newest, FALSE) AS is_current
    FROM {target} t LEFT JOIN (
        SELECT {key}, max(modified_date) AS newest FROM {batch} GROUP BY {key}) m
    ON t.{key} = m.{key})"""


def _versioned_step(out: str, target: str, batch: str, columns: list[str]) -> list[str]:
    return [
        _append(f"{out}_app", target, batch, columns),
        _delete(f"{out}_del", f"{out}_app", batch, columns, "is_current"),
        _reset(f"{out}_res", f"{out}_del", batch, columns),
        _set(out, f"{out}_res", batch, columns),
    ]


def _fold(table: TableConfig, target: str, batches: str) -> list[str]:
    """Batches 1 to 4, one after the other; the last result is ``applied_4``."""
    step = _versioned_step if table.versioned else _type1_step
    parts = []
    for n in range(1, 5):
        parts.append(f"batch_{n} AS (SELECT * FROM {batches} WHERE batch_no = {n})")
        parts += step(f"applied_{n}", target, f"batch_{n}", table.columns)
        target = f"applied_{n}"
    return parts


def _polls() -> list[str]:
    """Four polls of a growing log that is its own watermark."""
    ends = ["TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-15'", "TIMESTAMP '2024-01-22'", None]
    parts = []
    for n, end in enumerate(ends, start=1):
        mark = (
            f"(SELECT date_trunc('milliseconds', max(start_lsn)) FROM log_{n - 1})"
            if n > 1
            else "TIMESTAMP '2023-12-31'"
        )
        earlier = f"SELECT * FROM log_{n - 1} UNION ALL " if n > 1 else ""
        visible = f" AND start_lsn < {end}" if end else ""
        parts.append(
            f"log_{n} AS ({earlier}SELECT * FROM customer_ct WHERE start_lsn > {mark}{visible})"
        )
    return parts


# -- two cycles over six tables ---------------------------------------------------

_FIRST_MARK = {"dim_customer": "TIMESTAMP '2024-01-07 23:57:10.275269'"}


def _cycle_parts(*names: str) -> list[str]:
    parts = list(SALES_SOURCES) + [REGION_SEED]
    for name in names or SALES_FEEDS:
        table = SALES_TABLES[name]
        columns = table.columns
        step = _versioned_step if table.versioned else _type1_step
        end = "1998-07-01" if name.startswith("fact") else "2024-01-15"
        mark = _FIRST_MARK.get(name, "TIMESTAMP '1900-01-01'")
        if table.versioned:
            start = f"SELECT {', '.join(columns)}, is_deleted, is_current FROM region_seed"
        else:
            start = f"SELECT {', '.join(columns)}, FALSE AS is_deleted FROM {name}_log WHERE FALSE"
        parts += [
            f"{name}_log AS (SELECT * FROM ({SALES_FEEDS[name]}) WHERE operation <> 3)",
            f"{name}_0 AS ({start})",
            f"""{name}_b1 AS (SELECT * FROM {name}_log WHERE start_lsn < TIMESTAMP '{end}'
                AND start_lsn > date_trunc('milliseconds', {mark}))""",
            *step(f"{name}_1", f"{name}_0", f"{name}_b1", columns),
            f"""{name}_b2 AS (SELECT * FROM {name}_log WHERE start_lsn >
                (SELECT date_trunc('milliseconds', max(start_lsn)) FROM {name}_b1))""",
            *step(f"{name}_2", f"{name}_1", f"{name}_b2", columns),
        ]
    return parts


def _cycle_summary(name: str) -> str:
    current = "count_if(is_current)" if SALES_TABLES[name].versioned else "count(*)"
    return f"""SELECT '{name}' AS table_name, count(*) AS n_rows,
        count_if(is_deleted)::BIGINT AS n_deleted, {current}::BIGINT AS n_current,
        (SELECT max(start_lsn) FROM {name}_b2) AS last_update FROM {name}_2"""


def _cycle_rows(name: str) -> str:
    current = "is_current" if SALES_TABLES[name].versioned else "TRUE AS is_current"
    return f"""SELECT '{name}' AS table_name, {SALES_TABLES[name].key} AS row_key,
        {LABELS[name]} AS label, modified_date, is_deleted, {current} FROM {name}_2"""


def _cycle_then_stream() -> list[str]:
    """Each file counts from the mark at which the stream took over."""
    files = {
        2: "batch_no = 2 OR (batch_no = 1 AND start_lsn >= TIMESTAMP '2024-01-05')",
        3: "batch_no IN (1, 3)",
        4: "batch_no = 4",
    }
    taken = "SELECT date_trunc('milliseconds', max(start_lsn)) FROM batch_1"
    parts = ["batch_1 AS (SELECT * FROM region_batches WHERE batch_no = 1)"]
    parts += [
        f"batch_{n} AS (SELECT * FROM region_batches WHERE ({f}) AND start_lsn > ({taken}))"
        for n, f in files.items()
    ]
    target = "region_seed"
    for n in range(1, 5):
        parts += _versioned_step(f"applied_{n}", target, f"batch_{n}", _REGION)
        target = f"applied_{n}"
    return parts


# -- the answers ------------------------------------------------------------------

_CUSTOMER = CUSTOMER_BALANCE.columns
_CUSTOMER_COLS = ", ".join(_CUSTOMER)
_ALL_TABLES = " UNION ALL ".join(f"SELECT '{t}' AS table_name" for t in SALES_TABLES)

_REPLAYED_CUSTOMERS = _with(
    CUSTOMER_CT,
    CUSTOMER_SEED,
    *_fold(CUSTOMER_BALANCE, "customer_seed", "customer_batches"),
    result="SELECT * FROM applied_4",
)
_REPLAYED_REGIONS = _with(
    REGION_CT,
    REGION_SEED,
    *_fold(REGION, "region_seed", "region_batches"),
    result="SELECT * FROM applied_4",
)
_APPENDED = [REGION_CT, REGION_SEED, _append("app", "region_seed", "region_batches", _REGION)]

_MAPPED = [
    """raw AS (SELECT *, event_id * 2 + (event_type = 'error')::INTEGER AS position
        FROM event_changes)""",
    "lsn_times AS (SELECT event_id * 2 AS lsn, ts AS commit_time FROM events)",
    """mapped AS (SELECT s.commit_time AS start_lsn, e.commit_time AS end_lsn, seqval,
        operation, 1 AS command_id, k AS customer_id, event_type AS segment,
        value AS balance, ts AS modified_date
        FROM raw LEFT JOIN lsn_times s ON position = s.lsn
        LEFT JOIN lsn_times e ON event_type = 'signup' AND position = e.lsn)""",
]

_INCREMENTAL = _with(
    CUSTOMER_CT,
    REGISTRY,
    result=f"""SELECT {CHANGES}, {_CUSTOMER_COLS} FROM customer_ct
        WHERE operation <> 3 AND start_lsn > (
            SELECT date_trunc('milliseconds', last_update) FROM registry
            WHERE table_name = 'dim_customer')""",
)

ORACLE_SQL: dict[str, str] = {
    "watermark_lookup": _with(
        CUSTOMER_CT,
        REGISTRY,
        result=f"""SELECT table_name, date_trunc('milliseconds',
            coalesce(last_update, TIMESTAMP '2024-07-31 03:35:57.990')) AS last_update
            FROM ({_ALL_TABLES}) LEFT JOIN registry USING (table_name)""",
    ),
    "watermark_from_stage": _with(
        CUSTOMER_CT,
        result="""SELECT date_trunc('milliseconds', coalesce(max(start_lsn),
            TIMESTAMP '2024-07-31 03:35:57.990')) AS last_update FROM customer_ct""",
    ),
    "watermark_truncate_ms": """SELECT event_id, date_trunc('milliseconds', ts) AS ts_ms
        FROM events""",
    "watermark_upsert": _with(
        CUSTOMER_CT,
        REGION_CT,
        result="""SELECT 'dim_customer' AS table_name, max(start_lsn) AS last_update
            FROM customer_batches
            UNION ALL SELECT 'dim_region', NULL
            UNION ALL SELECT 'dim_address', max(start_lsn) FROM region_batches""",
    ),
    "batch_count": _with(
        CUSTOMER_CT,
        result="""SELECT count(*) AS n_rows, max(start_lsn) AS last_update
            FROM customer_batches""",
    ),
    "change_scan_incremental": _INCREMENTAL,
    "change_scan_indexed": _INCREMENTAL,
    "change_scan_all_images": _with(
        CUSTOMER_CT,
        result="SELECT * FROM customer_ct WHERE start_lsn > TIMESTAMP '2023-12-31'",
    ),
    "adhoc_query": _with(
        CUSTOMER_CT,
        """per_customer AS (SELECT segment, operation, customer_id, count(*) AS n,
            max(start_lsn) AS last_change FROM customer_ct GROUP BY ALL)""",
        result="""SELECT segment, operation, sum(n)::BIGINT AS n_changes,
            count(customer_id) AS n_customers, max(last_change) AS last_change
            FROM per_customer GROUP BY ALL""",
    ),
    "change_scan_raw": _with(
        CUSTOMER_CT,
        REGISTRY,
        *_MAPPED,
        result="""SELECT * FROM mapped WHERE operation <> 3 AND start_lsn > (
            SELECT date_trunc('milliseconds', last_update) FROM registry
            WHERE table_name = 'dim_customer')""",
    ),
    "lsn_to_commit_time": _with(EVENT_CHANGES, *_MAPPED, result="SELECT * FROM mapped"),
    "seqval_hex": _with(
        EVENT_CHANGES, result="SELECT k AS customer_id, seqval FROM event_changes"
    ),
    "rename_project": _with(
        EVENT_CHANGES,
        result=f"""SELECT ts AS start_lsn, NULL::TIMESTAMP AS end_lsn, seqval, operation,
            1 AS command_id, k AS address_id, 'Line ' || event_id AS address_line1,
            NULL::VARCHAR AS address_line2, 'City ' || user_id AS city,
            event_type AS state_province, 'NATION' AS country_region,
            lpad(event_id::VARCHAR, 12, '0') AS postal_code,
            {GUID.format("event_id")} AS rowguid, ts AS modified_date FROM event_changes""",
    ),
    "upsert_images": _with(
        CUSTOMER_CT, result="SELECT * FROM customer_ct WHERE operation IN (2, 4)"
    ),
    "delete_keys": _with(
        CUSTOMER_CT, result="SELECT DISTINCT customer_id FROM customer_ct WHERE operation = 1"
    ),
    "latest_per_key": _with(
        CUSTOMER_CT, result=f"SELECT * FROM {_latest('customer_ct', 'customer_id')}"
    ),
    "max_modified_by_key": _with(
        REGION_CT,
        result="""SELECT region_id, max(modified_date) AS max_modified_date
            FROM region_batches GROUP BY region_id""",
    ),
    "stage_append": _with(CUSTOMER_CT, *_polls(), result="SELECT * FROM log_4"),
    "stage_append_merged": _with(
        CUSTOMER_CT,
        result="SELECT * FROM customer_ct WHERE start_lsn > TIMESTAMP '2023-12-31'",
    ),
    "stage_replace": _with(
        CUSTOMER_CT, result="SELECT * FROM customer_ct WHERE operation <> 3"
    ),
    "upsert_type1": _with(
        CUSTOMER_CT,
        CUSTOMER_SEED,
        _upsert("merged", "customer_seed", "customer_batches", _CUSTOMER),
        result="SELECT * FROM merged",
    ),
    "soft_delete_type1": _with(
        CUSTOMER_CT,
        CUSTOMER_SEED,
        _delete("marked", "customer_seed", "customer_ct", _CUSTOMER),
        result="SELECT * FROM marked",
    ),
    "apply_type1_batch": _with(
        CUSTOMER_CT,
        CUSTOMER_SEED,
        *_type1_step("applied", "customer_seed", "customer_batches", _CUSTOMER),
        result="SELECT * FROM applied",
    ),
    "successive_type1": _REPLAYED_CUSTOMERS,
    "replay_type1": _REPLAYED_CUSTOMERS,
    "versioned_append": _with(*_APPENDED, result="SELECT * FROM app"),
    "versioned_soft_delete": _with(
        *_APPENDED,
        _delete("res", "app", "region_batches", _REGION, "is_current"),
        result="SELECT * FROM res",
    ),
    "versioned_reset_current": _with(
        *_APPENDED,
        _reset("res", "app", "region_batches", _REGION),
        result="SELECT * FROM res",
    ),
    "versioned_set_current": _with(
        *_APPENDED,
        _set("res", "app", "region_batches", _REGION),
        result="SELECT * FROM res",
    ),
    "apply_versioned_batch": _with(
        REGION_CT,
        REGION_SEED,
        *_versioned_step("applied", "region_seed", "region_batches", _REGION),
        result="SELECT * FROM applied",
    ),
    "successive_versioned": _REPLAYED_REGIONS,
    "replay_versioned": _REPLAYED_REGIONS,
    "multi_table_cycle": _with(
        *_cycle_parts(), result=" UNION ALL ".join(map(_cycle_summary, SALES_FEEDS))
    ),
    "multi_table_targets": _with(
        *_cycle_parts(), result=" UNION ALL ".join(map(_cycle_rows, SALES_FEEDS))
    ),
    **{
        f"cycle_{name}": _with(*_cycle_parts(name), result=f"SELECT * FROM {name}_2")
        for name in SALES_FEEDS
    },
    "versioned_large_batch": _with(
        CUSTOMER_CT,
        CUSTOMER_SEED,
        "version_seed AS (SELECT *, TRUE AS is_current FROM customer_seed)",
        *_fold(CUSTOMER_VERSIONS, "version_seed", "customer_batches"),
        result="SELECT * FROM applied_4",
    ),
    "versioned_no_reread": _REPLAYED_REGIONS,
    "cycle_then_stream": _with(
        REGION_CT, REGION_SEED, *_cycle_then_stream(), result="SELECT * FROM applied_4"
    ),
    "stream_apply_type1": _REPLAYED_CUSTOMERS,
    "stream_apply_versioned": _REPLAYED_REGIONS,
    "stream_stage_append": _with(CUSTOMER_CT, result="SELECT * FROM customer_ct"),
}
