"""Test inputs derived from the given TPC-H-style tables.

Each fixture is one SQL text with ``{table}`` placeholders.  Spark runs it
through ``spark.sql(text, table=DataFrame)`` (no global views) and the DuckDB
oracle runs the same text with the placeholders replaced by view names, so
both engines start from identical inputs.  Strings are ASCII and no ``concat``
ever sees a null (the two engines differ there).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from upcheck.plans.presets import sequence_columns

_PLACEHOLDER = re.compile(r"\{([a-z_]+)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tables_of(sql: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(sql)))


def spark_fixture(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables_of(sql)})


def duck_fixture(sql: str) -> str:
    return _PLACEHOLDER.sub(lambda m: m.group(1), sql)


# Authority: one row per order, ids unique.
AUTH = """
select concat('P', o_orderkey) as sample_id, concat('S', o_custkey) as alias,
       cast(o_orderkey % 50 as bigint) as run, o_orderpriority as antigen
from {orders}
"""

# Upload: unknown id every 11th order, wrong sequence id every 7th, wrong run
# every 5th, null antigen every 13th.
SUB = """
select case when o_orderkey % 11 = 0 then concat('X', o_orderkey) else concat('P', o_orderkey) end as id,
       case when o_orderkey % 7 = 0 then concat('Z', o_custkey) else concat('S', o_custkey) end as sequence_id,
       cast(case when o_orderkey % 5 = 0 then 99 else o_orderkey % 50 end as bigint) as run,
       case when o_orderkey % 13 = 0 then null else o_orderpriority end as antigen,
       o_totalprice as pay
from {orders}
"""

# The authority some days later: rows gone (every 17th order), one more row (every 19th), another run
# (every 23rd), rows for ids unknown before (every 121st).
AUTH_LATER = """
select sample_id, alias, case when k % 23 = 0 then run + 1 else run end as run, antigen
from (select o_orderkey as k, concat('P', o_orderkey) as sample_id, concat('S', o_custkey) as alias,
             cast(o_orderkey % 50 as bigint) as run, o_orderpriority as antigen from {orders}) o where k % 17 <> 0
union all
select concat('P', o_orderkey), concat('T', o_custkey), cast(99 as bigint), o_orderpriority from {orders} where o_orderkey % 19 = 0
union all
select concat('X', o_orderkey), concat('S', o_custkey), cast(o_orderkey % 50 as bigint), o_orderpriority from {orders} where o_orderkey % 121 = 0
"""

# Token table: null s1, blank s1, invalid s2 ('Brand#n'); ids repeat.
SEQ = """
select l_orderkey as id, l_linenumber as ln,
       case when l_partkey % 19 = 0 then null
            when l_partkey % 23 = 0 then '   '
            else concat('  ', replace(p_name, ' ', ''), ' ') end as s1,
       case when l_partkey % 17 = 0 then p_brand else p_type end as s2
from {lineitem} join {part} on l_partkey = p_partkey
"""

# Ids repeat on both sides; identity = (id, ln, rf, ls).  The authority differs
# in rf from line 4 on.
DUP_AUTH = """
select distinct l_orderkey as id, cast(l_linenumber as bigint) as ln,
       case when l_linenumber > 3 then '-' else l_returnflag end as rf, l_linestatus as ls
from {lineitem}
"""

DUP_UPLOAD = """
select l_orderkey as id, cast(l_linenumber as bigint) as ln,
       case when l_partkey % 10 = 0 then '?' else l_returnflag end as rf,
       case when l_partkey % 13 = 0 then null else l_linestatus end as ls,
       l_partkey as pay
from {lineitem}
"""

# A small upload beside a large authority: every order's first line, as its header tells it.
FIRST_LINES = """
select o_orderkey as id, cast(1 as bigint) as ln, case when o_orderstatus = 'F' then 'R' else 'N' end as rf,
       case when o_orderkey % 31 = 0 then null else o_orderstatus end as ls
from {orders}
"""

# Run-like strings from three tables.
RUNS = """
select 'documents' as src, source as raw from {documents}
union all
select 'orders' as src, o_orderpriority as raw from {orders}
union all
select 'part' as src, p_brand as raw from {part}
"""

# Columns nulled / blanked by key so that some rows are entirely null.
SPARSE = """
select case when o_orderkey % 4 = 0 then null else cast(o_orderkey as string) end as c1,
       case when o_orderkey % 6 = 0 then null else o_orderpriority end as c2,
       case when o_orderkey % 10 = 0 then null when o_orderkey % 7 = 0 then '   '
            when o_orderkey % 9 = 0 then '' else o_orderstatus end as c3,
       case when o_orderkey % 15 = 0 then null else o_totalprice end as c4
from {orders}
"""

# Column names with spaces, symbols and leading digits -> normalised names.
PART_ODD_NAMES = {
    "p_partkey": "Part Key",
    "p_name": " Part-Name ",
    "p_brand": "1st Brand",
    "p_type": "TYPE (AA) Heavy",
    "p_size": "96well Size",
    "p_retailprice": "Retail__Price%",
}
PART_CLEAN_NAMES = {
    "p_partkey": "part_key",
    "p_name": "part_name",
    "p_brand": "st1_brand",
    "p_type": "type_aa_heavy",
    "p_size": "well96_size",
    "p_retailprice": "retail_price",
}

# Orders for the CSV round trip: '', blanks, null, quotes, commas and backslashes
# occur in `note`.
ORDERS_CSV = """
select o_orderkey as order_key, o_custkey as cust_key, o_orderstatus as order_status,
       o_totalprice as total_price, cast(cast(o_orderdate as date) as string) as first_date, o_orderpriority as order_priority,
       case when o_orderkey % 7 = 0 then '' when o_orderkey % 5 = 0 then null
            when o_orderkey % 11 = 0 then concat('a "', o_orderstatus, '", b')
            when o_orderkey % 13 = 0 then concat('c', chr(92), '",w', chr(92))
            when o_orderkey % 17 = 0 then '  pad  ' when o_orderkey % 19 = 0 then '   '
            else o_orderstatus end as note
from {orders}
"""
ORDERS_CSV_HEADERS = {
    "order_key": "Order Key",
    "cust_key": "Cust-Key",
    "order_status": "Order  Status",
    "total_price": "Total-Price",
    "first_date": "1st. Date",
    "order_priority": "Order Priority",
    "note": "NOTE ",
}
# ---------------------------------------------------------------------------
# Antibody-shaped upload: one row per line item (ids repeat per order), the
# four identity columns, a run written as text ('NGS<n>'), and 32 sequence
# columns derived from part names with nulls, blanks, symbols and a 'U'.
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO_NUCLEOTIDES = "ACGTRYWSKMBDHVNACGTACGTACG"


def _part_strings() -> str:
    """Per-part sequence strings, built once per part (not per line item)."""
    names = {"a": "upper(replace(p_name, ' ', ''))", "b": "lower(replace(p_type, ' ', ''))"}
    cols = []
    for v, expr in names.items():
        nu = f"translate(upper({expr}), '{_LETTERS}', '{_TO_NUCLEOTIDES}')"
        cols += [f"concat(' ', {expr}, ' ') as aa_{v}", f"concat({expr}, '*') as aa_{v}_bad",
                 f"concat(' ', {nu}, ' ') as nu_{v}", f"concat({nu}, 'U') as nu_{v}_bad"]
    return "select p_partkey, p_brand, " + ", ".join(cols) + " from {part}"


def _sequence_expr(kind: str, j: int) -> str:
    v = "a" if j % 2 == 0 else "b"
    return (f"case when (l_partkey + {j}) % 211 = 0 then null "
            f"when (l_partkey + {2 * j}) % 223 = 0 then '   ' "
            f"when (l_suppkey + {j}) % 227 = 0 then p_brand "
            f"when (l_partkey + {3 * j}) % 229 = 0 then {kind}_{v}_bad "
            f"else {kind}_{v} end")


def _ab_upload_sql() -> str:
    seq = ",\n       ".join(
        f"{_sequence_expr(kind, j)} as {c}"
        for kind in ("aa", "nu") for j, c in enumerate(sequence_columns(kind)))
    return f"""
with pp as ({_part_strings()})
select case when o_orderkey % 11 = 0 then concat('X', o_orderkey) else concat('P', o_orderkey) end as mab_id,
       case when (o_orderkey + l_linenumber) % 7 = 0 then concat('Z', o_custkey)
            else concat('S', o_custkey) end as sequence_id,
       case when o_orderkey % 5 = 0 then 'NGS99' else concat('NGS', o_orderkey % 50) end as run,
       case when o_orderkey % 13 = 0 then null else o_orderpriority end as antigen,
       cast(l_linenumber as string) as line_number,
       {seq}
from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey join pp on l_partkey = p_partkey
"""


AB_UPLOAD = _ab_upload_sql()

AB_AUTH = """
select concat('P', o_orderkey) as sample_id, concat('S', o_custkey) as alias,
       concat('NGS', o_orderkey % 50) as run, o_orderpriority as antigen
from {orders}
"""


def ab_header(name: str) -> str:
    """An 'as exported' header for a normalised name (spaces, caps, symbols)."""
    special = {"mab_id": "Mab ID", "sequence_id": " Sequence ID ", "run": "Run",
               "antigen": "ANTIGEN", "line_number": "Line #Number"}
    if name in special:
        return special[name]
    region, kind, chain = name.split("_")
    return f"{region.upper()} ({kind.upper()}) {chain.capitalize()}" if region != "trimmed" \
        else f"Trimmed-{kind.upper()}--{chain}"
