"""The given tables seen as players and matches.

The two SELECTs are the same text for Spark and for the oracle: only table names differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLAYERS_SQL = """
select cast(c_custkey as string) as player_id,
 case when c_custkey % 50 = 7 then null else 'Customer' end as name_first,
 case when c_custkey % 50 = 11 then null else substr(c_name, 10) end as name_last,
 case when c_custkey % 40 = 3 then '19000000' when c_custkey % 40 = 5 then null
      else cast(19500101 + (c_custkey % 50) * 10000 + (c_custkey % 12) * 100 + (c_custkey % 28) as string)
           || case when c_custkey % 2 = 0 then '.0' else '' end end as dob,
 n_name as ioc, 'Q' || cast(c_custkey as string) as wikidata_id
from {customer} join {nation} on c_nationkey = n_nationkey
"""

MATCHES_SQL = """
select cast(year(o_orderdate) as string) || '-' || cast(o_orderkey % 40 as string) as tourney_id,
 case o_orderpriority when '1-URGENT' then 'G' when '2-HIGH' then 'M' when '3-MEDIUM' then 'D'
      when '4-NOT SPECIFIED' then 'F' else 'A' end as tourney_level,
 case l_linenumber when 7 then 'F' when 6 then 'SF' when 5 then 'QF' else 'R32' end as round,
 cast(year(o_orderdate) as int) as year,
 cast(w as string) as winner_id,
 case when l_quantity = 13 then null else 'Customer' || case when l_quantity = 17 then '-' else ' ' end
      || lpad(cast(w as string), 9, '0') end as winner_name,
 cast(l as string) as loser_id,
 case when l_quantity = 14 then null else 'Customer' || case when l_quantity = 18 then '-' else ' ' end
      || lpad(cast(l as string), 9, '0') end as loser_name,
 case when l_quantity = 29 then null when w % 25 = 14 then '0.0'
      else cast(cast(floor((l_quantity % 12) * 0.6) as int) as string) || '.0' end as w_bpSaved,
 case when l_quantity = 31 then null when w % 25 = 14 then '0.0'
      else cast(cast(l_quantity as int) % 12 as string) || '.0' end as w_bpFaced,
 cast(cast(floor((l_suppkey % 9) * 0.5) as int) as string) as l_bpSaved,
 cast(l_suppkey % 9 as string) as l_bpFaced
from (select *, case when other % 25 <> 9 then other when other - 1 <> w then other - 1 else other - 2 end as l
      from (select *, (w + 1 + (l_suppkey * 31 + l_partkey) % (n - 1)) % n as other
            from (select *, case when o_custkey % 25 = 4 then o_custkey - 1 else o_custkey end as w,
                   (select count(*) from {customer}) as n
                  from {lineitem} join {orders} on l_orderkey = o_orderkey) j) k) x
"""

# Some figures with a word in them, some blank.
UNTIDY_SQL = "case round when 'QF' then l_bpFaced || ' or so' when 'SF' then ' ' else l_bpFaced end"

# A name over three lines, with what CSV has to quote.
BROKEN_NAME_SQL = "name_last || chr(10) || '\"' || name_last || '\",' || chr(10) || chr(10) || ioc"

TABLES = ("customer", "nation", "orders", "lineitem")


def adapted(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}))


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted(spark, sf_dir, PLAYERS_SQL)


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapted(spark, sf_dir, MATCHES_SQL)
