"""The expected result of every query, as SQL over the given tables.

The labels are found by comparing keys and values themselves, not their hashes.
"""

from __future__ import annotations

from workload.queries import (
    DAY_ONE,
    DAY_TWO,
    FIRST,
    LIVE_DAYS,
    POINTER_ONE,
    POINTER_TWO,
    SECOND,
    THIRD,
)
from workload.snapshots import SOURCES, Source, nulled_sql


def _framed(text: str) -> str:
    return f"coalesce(length({text}) || ':' || {text}, '~')"


def _encoded(columns, prefix: str = "") -> str:
    return " || ".join(_framed(f"CAST({prefix}{c} AS VARCHAR)") for c in columns) or "''"


def _key(source: Source, prefix: str = "") -> str:
    return f"md5({_encoded(sorted(source.keys), prefix)})"


def _value(source: Source, prefix: str = "") -> str:
    return f"md5({_encoded(sorted(source.valued), prefix)})"


def _uuid(source: Source, key_hash: str, job: str) -> str:
    seed = f"'{len(source.name)}:{source.name}' || {_framed(key_hash)} || '{len(job)}:{job}'"
    h = f"md5({seed})"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({h}, {at}, {n})" for at, n in cuts)


def _stamped(
    source: Source, shown: str, where: str = "", fact: bool = False, days: tuple | None = None
) -> str:
    """Both days matched, labelled and stamped; ``shown`` picks columns of the result."""
    first_day, second_day = days or (f"SELECT * FROM {source.name}", source.next_day_sql())
    on = " AND ".join(f"n.{k} IS NOT DISTINCT FROM o.{k}" for k in source.keys)
    same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM o.{c}" for c in source.valued)
    pairs = ", ".join(f"n.{c} AS n_{c}, o.{c} AS o_{c}" for c in source.columns)
    payload = ", ".join(
        f"CASE WHEN act IN ('I', 'U') THEN n_{c} ELSE o_{c} END AS {c}" for c in source.columns
    )
    if fact:
        stamps = (
            f"CASE WHEN act = 'S' THEN '{FIRST}' ELSE '{SECOND}' END AS \"DWSJOB\", "
            "'N' AS \"DWSAUTO\""
        )
    else:
        stamps = (
            f"CASE WHEN act = 'I' THEN {_uuid(source, 'n_kh', SECOND)} "
            f"ELSE {_uuid(source, 'o_kh', FIRST)} END AS \"NK\", "
            f"'{SECOND}' AS \"DWSJOB\", CAST(NULL AS VARCHAR) AS \"DWSUNIACT\""
        )
    pointers = ", ".join(
        f"CASE WHEN act IN ('I', 'U') THEN {POINTER_TWO[c]} ELSE {POINTER_ONE[c]} END AS {c}"
        for c in POINTER_ONE
    )
    pointers += f", CASE WHEN act IN ('I', 'U') THEN '{SECOND}' ELSE '{FIRST}' END AS export_date"
    return f"""
WITH first_day AS ({first_day}),
old_day AS (SELECT *, {_key(source)} AS kh, {_value(source)} AS vh FROM first_day),
next_day AS ({second_day}),
new_day AS (SELECT *, {_key(source)} AS kh, {_value(source)} AS vh FROM next_day),
pairs AS (
  SELECT {pairs}, n.kh AS n_kh, n.vh AS n_vh, o.kh AS o_kh, o.vh AS o_vh,
    CASE WHEN o.kh IS NULL THEN 'I' WHEN n.kh IS NULL THEN 'D'
         WHEN {same} THEN 'S' ELSE 'U' END AS act
  FROM new_day n FULL JOIN old_day o ON {on}),
stamped AS (
  SELECT {stamps}, CASE WHEN act = 'D' THEN 'Y' ELSE 'N' END AS "DWSARCHIVE",
    act AS "DWSACT", coalesce(o_kh, n_kh) AS "DWSKEYHASH",
    CASE WHEN act IN ('I', 'U') THEN n_vh ELSE o_vh END AS "DWSVALHASH",
    {payload}, {pointers},
    n_kh AS "new_DWSKEYHASH", n_vh AS "new_DWSVALHASH",
    o_kh AS "old_DWSKEYHASH", o_vh AS "old_DWSVALHASH"
  FROM pairs)
SELECT {shown} FROM stamped {where}""".strip()


_DIM = ("NK", "DWSJOB", "DWSUNIACT", "DWSARCHIVE", "DWSACT", "DWSKEYHASH", "DWSVALHASH")
_FACT = ("DWSJOB", "DWSAUTO", "DWSARCHIVE", "DWSACT", "DWSKEYHASH", "DWSVALHASH")


def _names(*names: str) -> str:
    return ", ".join(f'"{n}"' for n in names)


def _rows(
    name: str,
    acts: str,
    labelled: bool = True,
    fact: bool = False,
    link: tuple | None = None,
    days: tuple | None = None,
):
    """Full rows of the given labels, as delta (labelled) or mirror columns.

    ``link``: the source partition columns of a link table.
    """
    source = SOURCES[name]
    lineage = [c for c in (_FACT if fact else _DIM) if labelled or c != "DWSACT"]
    payload = [*source.keys, *link] if link else source.columns
    allowed = ", ".join(f"'{a}'" for a in acts)
    return _stamped(
        source, _names(*lineage, *payload), f'WHERE "DWSACT" IN ({allowed})', fact, days
    )


def _ddl(name: str, payload: dict[str, str], pointers: tuple = ()) -> str:
    """Columns of a mirror or link table as created, and how many a first load fills."""
    always = dict.fromkeys(("DWSARCHIVE", "DWSKEYHASH", "DWSVALHASH"), "string")
    columns = {"NK": "string", "DWSUNIACT": "string", **always, **payload, "DWSJOB": "string"}
    rows = []
    for position, (column, kind) in enumerate(columns.items(), 1):
        filled = f"count({column})" if column in payload and column not in pointers else "count(*)"
        filled = "0" if column == "DWSUNIACT" else f"(SELECT {filled} FROM {name})"
        rows.append(f"({position}, '{column}', '{kind}', {filled})")
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t(position, name, type, filled)"


def _link_view() -> str:
    source = SOURCES["conversations"]
    shown = [c for c in _DIM if c != "DWSACT"]
    return _stamped(
        source, _names(*shown, *source.columns, *POINTER_ONE), "WHERE \"DWSACT\" <> 'D'"
    )


def _link_view_live() -> str:
    """Each row as on the day, of those that were run, when its name changed last."""
    source = SOURCES["supplier"]
    first, second, third = (int(d[-2:]) for d in LIVE_DAYS)
    changed = (
        f"CASE WHEN s_nationkey > {second} THEN {third} "
        f"WHEN s_nationkey > {first} THEN {second} ELSE {first} END"
    )
    named = (
        f"SELECT *, s_name || '*' || least({{}}, s_nationkey) AS name, {changed} AS day FROM supplier"
    )
    shown = ", ".join("name AS s_name" if c == "s_name" else c for c in source.columns)
    rows = f"SELECT {shown}, day FROM ({named.format(changed)})"
    return (
        f'SELECT {_uuid(source, _key(source), LIVE_DAYS[0])} AS "NK", \'{LIVE_DAYS[-1]}\' AS "DWSJOB", '
        "CAST(NULL AS VARCHAR) AS \"DWSUNIACT\", 'N' AS \"DWSARCHIVE\", "
        f'{_key(source)} AS "DWSKEYHASH", {_value(source)} AS "DWSVALHASH", '
        f"{', '.join(source.columns)}, printf('day-%02d', day) AS export_date FROM ({rows})"
    )


def _history() -> str:
    source = SOURCES["conversations"]
    one = ", ".join(f"{v} AS {c}" for c, v in POINTER_ONE.items())
    two = ", ".join(f"{v} AS {c}" for c, v in POINTER_TWO.items())
    return (
        f"SELECT {', '.join(source.columns)}, {one} FROM {source.name} UNION ALL "
        f"SELECT *, {two} FROM ({source.next_day_sql()})"
    )


def _landed(day_one: str, day_two: str) -> str:
    return (
        f"SELECT *, '{DAY_ONE}' AS export_date FROM ({day_one}) UNION ALL "
        f"SELECT *, '{DAY_TWO}' AS export_date FROM ({day_two})"
    )


def _batch() -> str:
    parts = [
        f"SELECT 'events' AS tbl, CAST(event_id AS VARCHAR) AS key, d.mark AS mark, "
        f"CAST(NULL AS VARCHAR) AS nk FROM events, "
        f"(VALUES ('{DAY_ONE}'), ('{DAY_TWO}')) AS d(mark)"
    ]
    for name in ("region", "nation", "supplier", "part"):
        source = SOURCES[name]
        shown = (
            f"'{name}' AS tbl, CAST({source.keys[0]} AS VARCHAR) AS key, "
            '"DWSACT" AS mark, "NK" AS nk'
        )
        parts.append(f"SELECT * FROM ({_stamped(source, shown, where_changed())})")
    return " UNION ALL ".join(parts)


def where_changed() -> str:
    return "WHERE \"DWSACT\" <> 'S'"


def _replay() -> str:
    source = SOURCES["customer"]
    shown = '"DWSJOB", "DWSACT", "NK", c_custkey, c_mktsegment, c_acctbal'
    first = (
        f"SELECT '{FIRST}' AS \"DWSJOB\", 'I' AS \"DWSACT\", "
        f'{_uuid(source, _key(source), FIRST)} AS "NK", c_custkey, c_mktsegment, c_acctbal '
        "FROM customer"
    )
    second = _stamped(source, shown, where_changed())
    # day three is day one again: what came goes, what went returns under a new key
    third = f"""
SELECT '{THIRD}' AS "DWSJOB",
  CASE WHEN e.c_custkey IS NULL THEN 'I' WHEN b.c_custkey IS NULL THEN 'D' ELSE 'U' END AS "DWSACT",
  CASE WHEN e.c_custkey IS NULL THEN {_uuid(source, _key(source, "b."), THIRD)}
       WHEN b.c_custkey IS NULL THEN {_uuid(source, _key(source, "e."), SECOND)}
       ELSE {_uuid(source, _key(source, "b."), FIRST)} END AS "NK",
  coalesce(b.c_custkey, e.c_custkey) AS c_custkey,
  coalesce(b.c_mktsegment, e.c_mktsegment) AS c_mktsegment,
  coalesce(b.c_acctbal, e.c_acctbal) AS c_acctbal
FROM customer b FULL JOIN ({source.next_day_sql()}) e ON b.c_custkey = e.c_custkey
WHERE b.c_custkey IS NULL OR e.c_custkey IS NULL OR b.c_mktsegment <> e.c_mktsegment"""
    return f"{first} UNION ALL SELECT * FROM ({second}) UNION ALL {third}"


def _mutated() -> str:
    source = SOURCES["part"]
    key = _encoded(source.keys)

    def drawn(column: str) -> str:
        return f"md5('1:7{len(column)}:{column}' || {key})"

    text = ", ".join(f"substr({drawn(c)}, 1, 20) AS {c}" for c in ("p_name", "p_brand", "p_type"))
    size = f"CAST(CAST('0x' || substr({drawn('p_size')}, 1, 8) AS BIGINT) % 2147483648 AS INTEGER)"
    return f"SELECT p_partkey, {text}, {size} AS p_size, p_retailprice FROM part"


def _columns(source: Source, names) -> str:
    return f"SELECT {', '.join(names)} FROM {source.name}"


def _deduped(day: str = "SELECT * FROM lineitem", hashed: bool = False) -> str:
    """First row of each key; in a hashed snapshot the value hash is the first tie-breaker."""
    source = SOURCES["lineitem"]
    rest = [c for c in source.columns if c not in source.keys and c != "l_shipdate"]
    rest = [_value(source)] if hashed else rest
    return (
        f"SELECT {', '.join(source.columns)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {', '.join(source.keys)} ORDER BY l_shipdate, {', '.join(rest)}) AS rn "
        f"FROM ({day})) WHERE rn = 1"
    )


def oracle_sql() -> dict[str, str]:
    lineitem, orders, talk = SOURCES["lineitem"], SOURCES["orders"], SOURCES["conversations"]
    customer = SOURCES["customer"]
    day = "strftime(ts, '%Y-%m-%d')"
    keys = ", ".join(lineitem.keys)
    label = '"DWSACT"'
    return {
        "read_snapshot": "SELECT * FROM customer",
        "read_landing_partition": (
            f"SELECT *, '{DAY_TWO}' AS export_date FROM ({orders.next_day_sql()})"
        ),
        "read_catalog_table": "SELECT * FROM orders",
        "write_dataset": "SELECT * FROM events",
        "land_partition": _landed(orders.next_day_sql(), "SELECT * FROM orders"),
        "append_delta": _rows("orders", "IUD", fact=True),
        "write_mirror": _rows("customer", "IUS", labelled=False),
        "swap_mirror": _rows("customer", "IUS", labelled=False),
        "add_partition": f"SELECT *, {day} AS export_date FROM events",
        "drop_partition": (
            f"SELECT *, {day} AS export_date FROM events "
            f"WHERE {day} <> (SELECT min({day}) FROM events)"
        ),
        "list_partitions": f"SELECT DISTINCT 'export_date=' || {day} AS partition FROM events",
        "create_mirror": _ddl(
            "customer",
            {
                "c_custkey": "bigint",
                "c_name": "string",
                "c_nationkey": "int",
                "c_acctbal": "double",
                "c_mktsegment": "string",
            },
        ),
        "create_link": _ddl(
            "conversations",
            {"conv_id": "bigint", "turn": "bigint", **dict.fromkeys(POINTER_ONE, "int")},
            tuple(POINTER_ONE),
        ),
        "link_view": _link_view(),
        "link_view_live": _link_view_live(),
        "create_landing_table": _history(),
        "project_ids": _columns(lineitem, lineitem.keys),
        "project_payload_bare": _columns(
            lineitem, [c for c in lineitem.columns if c not in lineitem.keys]
        ),
        "project_hashable": _columns(
            orders, [c for c in orders.columns if c not in orders.excluded]
        ),
        "narrow": "SELECT * FROM lineitem",
        "unwrap_fields": "SELECT * FROM part",
        "key_hash": f'SELECT {keys}, {_key(lineitem)} AS "DWSKEYHASH" FROM lineitem',
        "value_hash": f'SELECT {keys}, {_value(lineitem)} AS "DWSVALHASH" FROM lineitem',
        "value_hash_exclusions": (
            f'SELECT o_orderkey, {_value(orders)} AS "DWSVALHASH" FROM ({orders.next_day_sql()})'
        ),
        "hash_md5": (
            f"SELECT event_id, md5({_encoded(SOURCES['events'].columns)}) AS digest FROM events"
        ),
        "hash_sha": (
            f"SELECT doc_id, sha256({_encoded(SOURCES['documents'].columns)}) AS digest "
            "FROM documents"
        ),
        "hash_murmur": _stamped(SOURCES["customer"], f"c_custkey, {label}"),
        "hash_xxhash": _stamped(orders, f"o_orderkey, {label}"),
        "add_hashes_inline": (
            f'SELECT {_key(orders)} AS "DWSKEYHASH", {_value(orders)} AS "DWSVALHASH", * '
            "FROM orders"
        ),
        "add_hashes_link": (
            f'SELECT {_key(talk)} AS "DWSKEYHASH", {_value(talk)} AS "DWSVALHASH", '
            "conv_id, turn FROM conversations"
        ),
        "mutate_snapshot": _mutated(),
        "outer_join_keys": _stamped(
            orders,
            _names("new_DWSKEYHASH", "new_DWSVALHASH", "old_DWSKEYHASH", "old_DWSVALHASH"),
        ),
        "attach_new_payload": _rows("orders", "IU"),
        "attach_old_payload": _rows("orders", "DS"),
        "classify_changes": _stamped(orders, f'o_orderkey, "DWSKEYHASH", {label}'),
        "dim_delta": _rows("customer", "IUD"),
        "dim_mirror": _rows("customer", "IUS", labelled=False),
        "fact_delta": _rows("orders", "IUD", fact=True),
        "fact_mirror": _rows("orders", "IUS", labelled=False, fact=True),
        "assign_surrogate_key": _stamped(SOURCES["customer"], f'c_custkey, "NK", {label}'),
        "partition_carry": _stamped(talk, f"conv_id, turn, {label}, {_names(*POINTER_ONE)}"),
        "changes_new_side": _rows("customer", "IU"),
        "changes_old_side": _rows("customer", "DS"),
        "inserted": _rows("orders", "I"),
        "updated": _rows("orders", "U"),
        "deleted": _rows("orders", "D"),
        "stationary": _rows("orders", "S"),
        "build_delta_inline": _rows("orders", "IUD"),
        "build_delta_link": _rows("conversations", "IUD", link=tuple(POINTER_ONE)),
        "build_delta_link_default": _rows("conversations", "IUD", link=("export_date",)),
        "build_delta_reordered": _rows("orders", "IUD"),
        "build_delta_narrow_first": _rows("orders", "IUD"),
        "build_delta_fact": _rows("orders", "IUD", fact=True),
        "build_delta_copy_on_write": _rows("orders", "IUD", fact=True),
        "copy_on_write_mirror": _rows("orders", "IUS", labelled=False, fact=True),
        "build_delta_digests": _rows("orders", "IUD"),
        "bucket_digests": (
            "SELECT DISTINCT CAST('0x' || substr(\"DWSKEYHASH\", 1, 8) AS BIGINT) % 4096 AS \"__bucket\" "
            f"FROM ({_rows('customer', 'IUD')})"
        ),
        "build_delta_buckets": _rows("customer", "IUD"),
        "build_delta_keep_first": _rows(
            "lineitem",
            "IUD",
            days=(_deduped(hashed=True), _deduped(lineitem.next_day_sql(), hashed=True)),
        ),
        "build_delta_nulls": _rows(
            "customer",
            "IUD",
            days=(nulled_sql("SELECT * FROM customer"), nulled_sql(customer.next_day_sql())),
        ),
        "project_payload_metaex": _stamped(customer, ", ".join(customer.columns)),
        "run_batch": _batch(),
        "replay_days": _replay(),
        "replay_at_once": _replay(),
        "compact_delta": _replay(),
        "read_delta_rolled": f"SELECT * FROM ({_replay()}) WHERE \"DWSJOB\" <> '{FIRST}'",
        "job_statistics": (
            f"SELECT '{FIRST}' AS \"DWSJOB\", count(*) AS rows, count(*) AS inserted, "
            "CAST(0 AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted, "
            "'period-0' AS \"DWSPERIOD\" FROM orders "
            f"UNION ALL SELECT '{SECOND}', count(*), count(*) FILTER ({label} = 'I'), "
            f"count(*) FILTER ({label} = 'U'), count(*) FILTER ({label} = 'D'), 'period-0' FROM ("
            f"{_rows('orders', 'IUD', fact=True)})"
        ),
        "build_delta_landed": _rows("customer", "IUD"),
        "duplicate_keys": (
            f"SELECT {keys}, count(*) AS copies FROM lineitem GROUP BY {keys} HAVING count(*) > 1"
        ),
        "dedupe_snapshot": _deduped(),
        "action_counts": (
            f"SELECT {label}, count(*) AS rows FROM ("
            f"{_stamped(orders, label, where_changed())}) GROUP BY {label}"
        ),
    }
