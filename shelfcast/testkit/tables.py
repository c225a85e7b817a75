"""Columns the views read from the driver's tables."""

# Column types as stored in the parquet files.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_type string, p_size int",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
        " o_totalprice double, o_orderdate timestamp_ntz"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double,"
        " l_discount double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    ),
}
