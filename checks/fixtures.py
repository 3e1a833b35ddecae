"""Inputs of the registered queries, derived from the whole given tables.

Every derivation is one SELECT that Spark and the checking engine both run, so
the inputs agree by construction. No derivation drops rows to stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The next version of orders: one status moves to new keys (rows deleted and
# added), one priority changes status, another loses its value, one column is new.
NEW_ORDERS = """
SELECT CASE WHEN o_orderstatus = 'P' THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey,
       o_custkey,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS o_orderdate,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       concat('Clerk#', CAST(o_custkey AS VARCHAR(20))) AS o_clerk
FROM orders
"""

# Orders as they are, but for one priority without a value.
SAME_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""

# Raw text: padded, blank and missing values, a repeated row per customer.
DIRTY_CUSTOMER = """
SELECT CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_custkey END AS "CustKey",
       CASE WHEN c_mktsegment = 'FURNITURE' THEN ' '
            WHEN c_mktsegment = 'BUILDING' THEN concat(' ', c_name, chr(9))
            WHEN c_mktsegment = 'MACHINERY' THEN concat(chr(160), 'Stra', chr(223), 'e ', c_name)
            ELSE c_name END AS "Full Name",
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'NA' ELSE CAST(c_acctbal AS VARCHAR(30)) END AS " % Balance",
       CASE WHEN c_mktsegment = 'FURNITURE' THEN '' WHEN c_nationkey < 12 THEN 'TRUE' ELSE 'F' END AS "# Nation"
FROM customer
UNION ALL
SELECT c_custkey, c_name, concat(' ', CAST(c_acctbal AS VARCHAR(30))), CASE WHEN c_nationkey < 12 THEN 'T' ELSE 'F' END
FROM customer
"""

OLD_CUSTOMER = """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 'BUILDING' ELSE c_mktsegment END AS c_mktsegment
FROM customer
"""
NEW_CUSTOMER = """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR(20)) AS c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
"""

# One column per class of text.
LADDER = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN 'T' ELSE 'FALSE' END AS flag,
       CAST(o_custkey AS VARCHAR(20)) AS whole,
       concat(' ', CAST(o_totalprice AS VARCHAR(30))) AS price,
       concat(CAST(1 + o_custkey % 900 AS VARCHAR(10)), ',500') AS grouped,
       concat(lpad(CAST(o_custkey % 24 AS VARCHAR(10)), 2, '0'), ':30') AS clock,
       substring(CAST(o_orderdate AS VARCHAR(30)), 1, 10) AS day,
       concat(substring(CAST(o_orderdate AS VARCHAR(30)), 1, 10), 'T12:30:00') AS moment,
       concat('00', CAST(o_orderkey AS VARCHAR(20))) AS code,
       CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderpriority END AS words,
       CASE WHEN o_orderstatus = 'P' THEN 'NA' WHEN o_orderstatus = 'F' THEN ' ' ELSE NULL END AS nothing,
       CASE WHEN o_orderpriority = '5-LOW' THEN '1.5' ELSE CAST(o_custkey AS VARCHAR(20)) END AS mixed
FROM orders
"""

# Every order is a version of its customer's table.
VERSIONS = """
SELECT concat('T', CAST(o_custkey AS VARCHAR(20))) AS table_name, o_orderdate AS version_ts,
       o_orderkey AS version_id
FROM orders
"""

# The same as entries of a state log.
STATE_LOG = """
SELECT concat('T', CAST(o_custkey AS VARCHAR(20))) AS table_name, o_orderdate AS created,
       o_orderdate AS updated, 'parquet' AS file_type, o_orderpriority AS file_name,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS latest_date,
       o_orderstatus AS date_field, o_orderdate AS logged_at, true AS has_version, o_orderkey AS entry
FROM orders
"""

CHANGE_COUNTS = """
SELECT concat('T', CAST(o_custkey AS VARCHAR(20))) AS table_name, o_orderdate AS run_ts, o_orderkey AS entry,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_custkey END AS BIGINT) AS n_added,
       CAST(CASE WHEN o_orderpriority = '5-LOW' THEN 7 ELSE 0 END AS BIGINT) AS n_edited,
       CAST(0 AS BIGINT) AS n_deleted
FROM orders
"""

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


class Tables:
    """The given tables of one folder, and frames derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derive(self, sql: str) -> DataFrame:
        words = set(sql.replace("(", " ").replace(")", " ").replace("\n", " ").split())
        for name in TABLES:
            if name in words:
                getattr(self, name).createOrReplaceTempView(f"given_{name}")
                sql = sql.replace(f"FROM {name}\n", f"FROM given_{name}\n").replace(f"JOIN {name} ", f"JOIN given_{name} ")
        return self.spark.sql(sql.replace('"', "`"))
