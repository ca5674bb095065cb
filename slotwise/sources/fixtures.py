"""Fixture tables for tests, the query catalogue and the bench.

The reference ships no sample data, so its configuration, profile and lookup
tables are derived from the TPC-H-like parquet files with plain SQL. The same
text runs in Spark (here) and DuckDB (the oracle inlines it as CTEs), so both
engines see identical inputs. Every view reads its whole base tables. The
campaign side comes in blocks (375 customers, 25 suppliers, 480 parts), so it
grows with the scale factor while each recipient meets a bounded number of
campaigns and each campaign a bounded number of modules. Only the quoting of the ``default`` column
differs between the dialects.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders")

# Run parameters shared by every fixture query.
LOCALE = "en_us"
TPID = 1
EAPID = 0
LAUNCH_DATE = "2024-03-05"
AS_OF = "2024-03-05"

FIXTURE_SQL: dict[str, str] = {
    "fx_profiles": (
        "SELECT 'r' || CAST(c_custkey AS VARCHAR(20)) || '@example.com' AS email_address, CAST(c_custkey % 100 AS INT) AS test_keys, 1 AS tpid, 0 AS eapid, CASE WHEN c_custkey % 2 = 0 THEN 'en_US' ELSE 'en_us' END AS locale, CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END AS mer_status, c_custkey + 5000000 AS expuserid, c_mktsegment AS first_name, c_name AS last_name, 1033 AS lang_id, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey END AS paid, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'City' || CAST(c_nationkey AS VARCHAR(20)) END AS home_city, CAST(c_nationkey AS VARCHAR(20)) AS nation_key, 'n' || CAST(c_custkey % 3 AS VARCHAR(20)) AS profile_note"
        ' FROM customer'
    ),
    "fx_segments": (
        "SELECT 'r' || CAST(c_custkey AS VARCHAR(20)) || '@example.com' AS email_address, CAST(c_custkey % 100 AS INT) AS test_keys, 1 AS tpid, 0 AS eapid, 'en_us' AS locale, CAST(k + 8 * b AS INT) AS segment_type_id, CAST(c_nationkey % 5 + 1 + 8 * b AS VARCHAR(20)) || '#' || CAST(c_custkey % 3 + 6 + 8 * b AS VARCHAR(20)) AS segment_type_id_concat"
        ' FROM (SELECT c_custkey, c_nationkey, c_nationkey % 5 + 1 AS k, CAST(floor(c_custkey / 375) AS INT) AS b'
        ' FROM customer UNION ALL SELECT c_custkey, c_nationkey, c_custkey % 3 + 6 AS k, CAST(floor(c_custkey / 375) AS INT) AS b'
        ' FROM customer) u'
    ),
    "fx_campaigns": (
        "SELECT CAST(s_suppkey + 1 AS VARCHAR(20)) AS campaign_id, CASE WHEN i < 16 THEN 'en_us' ELSE 'fr_fr' END AS locale, CASE WHEN i % 12 = 11 THEN '2024-03-06' ELSE '2024-03-05' END AS LaunchDate, CAST(TIMESTAMP '2024-03-05 12:00:00' AS TIMESTAMP) AS LaunchDateTimeUTC, CASE WHEN i % 8 = 7 THEN 1 ELSE 0 END AS campaign_deleted_flag, CASE WHEN i = 13 THEN 2 ELSE 1 END AS tpid, CASE WHEN i = 14 THEN 1 ELSE 0 END AS eapid, CAST(i % 4 + 1 AS INT) AS template_id, CAST(i % 5 + 1 + 5 * b AS INT) AS segment_module_map_id, CAST(i % 8 + 1 + 8 * b AS INT) AS campaign_segment_type_id, CAST(i % 3 + 1 AS INT) AS priority, 'audience_' || CAST(i % 5 AS VARCHAR(20)) AS AudienceTableName"
        ' FROM (SELECT s_suppkey, CAST(s_suppkey % 25 AS INT) AS i, CAST(floor(s_suppkey / 25) AS INT) AS b'
        ' FROM supplier) u'
    ),
    "fx_templates": (
        'SELECT CAST(r_regionkey + 1 AS INT) AS template_id, CASE WHEN r_regionkey = 3 THEN 1 ELSE 0 END AS template_deleted_flag'
        ' FROM region'
    ),
    "fx_segment_defs": (
        'SELECT 1 AS tpid, 0 AS eapid, CASE WHEN i < 8 THEN CAST(i + 1 + 8 * b AS INT) ELSE CAST(1000000 + s_suppkey AS INT) END AS segment_type_id, CASE WHEN i = 4 THEN 1 ELSE 0 END AS segment_deleted_flag'
        ' FROM (SELECT s_suppkey, CAST(s_suppkey % 25 AS INT) AS i, CAST(floor(s_suppkey / 25) AS INT) AS b'
        ' FROM supplier) u'
    ),
    "fx_segment_modules": (
        "SELECT m + 1 + 5 * b AS segment_module_map_id, sl + 1 AS slot_position, CASE sl WHEN 0 THEN 'subject' WHEN 2 THEN 'banner' ELSE 'hero' END AS placement_type, ty + 1 + 3 * b AS module_type_id, 'email' AS channel, sg + 1 + 8 * b AS segment_type_id, (ty * sl + m) % 3 + 1 AS module_priority_in_slot, CASE WHEN (m + sl + ty + sg) % 11 = 0 OR (sl = 2 AND m IN (1, 3)) OR (sl = 3 AND ty <> 0 AND m = 0) THEN 1 ELSE 0 END AS seg_mod_deleted_flag"
        ' FROM (SELECT CAST(p_partkey % 5 AS INT) AS m, CAST(floor(p_partkey / 5) AS INT) % 4 AS sl, CAST(floor(p_partkey / 20) AS INT) % 3 AS ty, CAST(floor(p_partkey / 60) AS INT) % 8 AS sg, CAST(floor(p_partkey / 480) AS INT) AS b'
        ' FROM part) u'
    ),
    "fx_modules": (
        'SELECT \'en_us\' AS locale, 1 AS tpid, 0 AS eapid, \'email\' AS channel, CASE sl WHEN 0 THEN \'subject\' WHEN 1 THEN \'hero\' ELSE \'banner\' END AS placement_type, ty + 1 + 3 * b AS module_type_id, v * 10 + 5 AS version, CAST(p_partkey AS INT) + 101 AS module_id, \'type\' || CAST(ty AS VARCHAR(20)) AS module_type, CASE WHEN p_partkey % 4 = 0 THEN \'1\' ELSE \'0\' END AS "default", CASE WHEN p_partkey % 13 = 12 THEN \'draft\' ELSE \'active published\' END AS status'
        ' FROM (SELECT p_partkey, CAST(p_partkey % 3 AS INT) AS sl, CAST(floor(p_partkey / 3) AS INT) % 3 AS ty, CAST(floor(p_partkey / 9) AS INT) % 3 AS v, CAST(floor(p_partkey / 27) AS INT) AS b'
        ' FROM part) u'
    ),
    "fx_module_vars": (
        "SELECT module_id, 'sql' || CAST(module_id % 2 AS VARCHAR(20)) AS source_connection, CASE WHEN module_id % 7 = 5 THEN CASE WHEN var_position = 1 THEN 'traveler.nation_key;traveler.first_name|fx_offer_lookup.nation_key;fx_offer_lookup.segment' ELSE '' END WHEN var_position = 1 OR module_id % 7 = 3 THEN 'traveler.nation_key|fx_nation_lookup.nation_key' ELSE '' END AS var_source, var_position, CASE WHEN var_position = 1 AND module_id % 7 = 5 THEN 'Deal|Offer %%fx_offer_lookup.offer%%' WHEN var_position = 1 AND module_id % 3 = 0 THEN 'Deals|Off to %%traveler.home_city%%|See %%fx_nation_lookup.label%%|Fly now' WHEN var_position = 1 AND module_id % 3 = 1 THEN 'Welcome|Hello %%fx_nation_lookup.label%%' WHEN var_position = 1 THEN 'Default|Plain offer|Second offer' WHEN module_id % 5 = 0 THEN 'no options' WHEN module_id % 5 = 1 THEN NULL WHEN module_id % 7 = 5 THEN 'alt|Go %%traveler.home_city%%' ELSE 'alt|Go %%traveler.home_city%% via %%fx_nation_lookup.label%%' END AS var_structure, 'EN_us' AS locale, 1 AS tpid, 0 AS eapid"
        ' FROM (SELECT CAST(floor(p_partkey / 2) AS INT) + 101 AS module_id, CAST(p_partkey % 2 AS INT) + 1 AS var_position'
        ' FROM part) u'
    ),
    "fx_nation_lookup": (
        "SELECT CASE WHEN c = 1 AND n_nationkey % 5 = 2 THEN 'fr_FR' ELSE 'en_US' END AS locale, CASE WHEN c = 1 AND n_nationkey % 5 = 3 THEN 2 ELSE 1 END AS tpid, CASE WHEN c = 1 AND n_nationkey % 5 = 4 THEN 1 ELSE 0 END AS eapid, CAST(n_nationkey AS VARCHAR(20)) AS nation_key, CASE WHEN c = 1 THEN 'Alt ' || n_name WHEN n_nationkey % 6 = 0 THEN '' WHEN n_nationkey = 8 THEN NULL WHEN n_nationkey = 10 THEN 'Banana coast' ELSE n_name END AS label"
        ' FROM (SELECT n_nationkey, n_name, 0 AS c FROM nation UNION ALL SELECT n_nationkey, n_name, 1 AS c FROM nation) u'
    ),
    # Two key columns; one row per nation and customer segment seen, several rows for some keys.
    "fx_offer_lookup": (
        "SELECT 'EN_us' AS locale, 1 AS tpid, 0 AS eapid, CAST(c_nationkey AS VARCHAR(20)) AS nation_key, c_mktsegment AS segment, 'Deal ' || CAST(max(c_custkey) % 50 AS VARCHAR(20)) AS offer"
        ' FROM customer GROUP BY c_nationkey, c_mktsegment, c_custkey % 3'
    ),
    "fx_run_log": (
        "SELECT o_orderkey AS LogID, CAST(o_custkey % 20 AS INT) AS SourceID, CASE WHEN o_orderpriority < '3' THEN 'ETL' ELSE 'Segment_mapping' END AS SourceName, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS IsComplete, o_orderdate AS StartDate, o_orderdate AS EndDate, '/out/' || CAST(o_orderkey AS VARCHAR(20)) AS FilePath"
        ' FROM orders'
    ),
    "fx_schedules": (
        "SELECT CAST(s_suppkey AS INT) AS ID, CASE WHEN s_suppkey % 2 = 0 THEN 'en_us' ELSE 'fr_fr' END AS Locale, CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE 1 END AS IsFinal, CASE WHEN s_suppkey % 7 = 0 THEN ' ' WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_name END AS Job_Name, s_acctbal AS ScheduleTimes"
        ' FROM supplier'
    ),
    "fx_account_tokens": (
        "SELECT c_custkey * 3 AS ProtoAccountID, 'a' || CAST(c_custkey * 3 AS VARCHAR(20)) AS UserToken"
        ' FROM customer'
    ),
    "fx_subscriber_tokens": (
        "SELECT c_custkey * 2 AS SubscriberID, 's' || CAST(c_custkey * 2 AS VARCHAR(20)) AS UserToken"
        ' FROM customer'
    ),
    "fx_seeds": (
        "SELECT CASE WHEN s_suppkey % 4 = 3 THEN 'Other' ELSE 'Merch' END AS CampaignCategory, CASE WHEN s_suppkey % 5 = 4 THEN 0 ELSE 1 END AS IsActive, CASE WHEN s_suppkey % 17 = 16 THEN 2 ELSE 1 END AS tpid, 0 AS eapid, 'en_us' AS locale, 'seed' || CAST(s_suppkey AS VARCHAR(20)) || '@example.com' AS SeedEmail"
        ' FROM supplier'
    ),
    "fx_members": (
        "SELECT 1 AS TPID, c_custkey * 2 + 1 AS PAID, 1033 AS LANG_ID, CAST(floor(c_acctbal) AS BIGINT) AS LRMPendingPoints, 'M' || CAST(c_custkey AS VARCHAR(20)) AS MemberID, CASE WHEN c_acctbal > 5000 THEN 'gold' ELSE 'blue' END AS LRMTierName, c_acctbal AS MonetaryValue, CAST(floor(c_acctbal) AS BIGINT) AS LRMAvailablePoints, CASE WHEN c_custkey % 4 = 0 THEN 'Closed' WHEN c_custkey % 9 = 0 THEN NULL ELSE 'Active' END AS LRMStatus, 'x' AS authrealm_code"
        ' FROM customer'
    ),
    # Not in FIXTURES.md: process configuration for the process-identity lookup.
    "fx_process_config": (
        "SELECT CAST(n_nationkey AS INT) AS id, CASE WHEN n_nationkey % 3 = 0 THEN 'en_US' ELSE 'fr_FR' END AS Locale,"
        " CASE WHEN n_regionkey % 2 = 0 THEN 'Brand A' ELSE 'Brand B' END AS brand, 'proc_' || n_name AS ProcessName"
        ' FROM nation'
    ),
}

_BASE_RE = re.compile(r"\b(" + "|".join(BASE_TABLES) + r")\b")


def spark_text(name: str) -> str:
    """Fixture SQL in Spark's dialect, base tables as ``{name}`` parameters."""
    sql = FIXTURE_SQL[name].replace('"default"', "`default`")
    return _BASE_RE.sub(lambda m: "{" + m.group(1) + "}", sql)


def duckdb_text(name: str) -> str:
    return FIXTURE_SQL[name]


def base_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in BASE_TABLES}


class Fixtures:
    """Lazily built fixture DataFrames over one scale-factor directory.

    Every view is a plain Spark plan over the parquet scans (no caching), so
    Catalyst prunes columns and pushes filters into the base-table scans.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._base = base_tables(spark, self.sf_dir)
        self._views: dict[str, DataFrame] = {}

    def __getattr__(self, item: str) -> DataFrame:
        name = item if item.startswith("fx_") else "fx_" + item
        if name not in FIXTURE_SQL:
            raise AttributeError(item)
        if name not in self._views:
            text = spark_text(name)
            used = {t: df for t, df in self._base.items() if "{" + t + "}" in text}
            self._views[name] = self.spark.sql(text, **used)
        return self._views[name]

    def table(self, name: str) -> DataFrame:
        """Base parquet table by name (region, nation, ...)."""
        return self._base[name]


def oracle_with(names: list[str] | tuple[str, ...], body: str) -> str:
    """DuckDB SQL: the named fixture views inlined as CTEs in front of ``body``."""
    ctes = ",\n".join(f"{n} AS (\n{duckdb_text(n)}\n)" for n in names)
    return f"WITH {ctes}\n{body}"


@lru_cache(maxsize=None)
def fixture_names() -> tuple[str, ...]:
    return tuple(FIXTURE_SQL)
