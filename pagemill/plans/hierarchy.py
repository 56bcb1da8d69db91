"""Queries of problem 1 over ``structural_chunks``, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.hierarchy import Forest, build_forest


def _forest(spark: SparkSession, sf_dir: str) -> Forest:
    return build_forest(spark.read.parquet(f"{sf_dir}/structural_chunks.parquet"), "chunk_id", "parent_header_id", "page")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks whose links never end or point to nothing: chunk_id, state."""
    return _forest(spark, sf_dir).states().select(F.col("node").alias("chunk_id"), "state")


def p1_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path, depth, root and number of descendants of each chunk; a tree below a cycle is rooted in its cycle node."""
    out = _forest(spark, sf_dir).table()
    return out.select(F.col("node").alias("chunk_id"), F.col("root").alias("root_id"), "depth", "n_descendants", F.array_join("path", " > ").alias("path"))


def p1_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk with each of its descendants: ancestor_id, chunk_id."""
    forest = _forest(spark, sf_dir)
    name = forest.names.select("nid", "node")
    pairs = forest.ancestor_pairs().join(name.select(F.col("nid").alias("ancestor"), F.col("node").alias("ancestor_id")), "ancestor")
    return pairs.join(name.withColumnRenamed("node", "chunk_id"), "nid").select("ancestor_id", "chunk_id")


QUERIES = {"p1_found": p1_found, "p1_hierarchy": p1_hierarchy, "p1_descendants": p1_descendants}

_LINKS = """
with recursive n as (
  select chunk_id as v, min(case when trim(parent_header_id) not in ('', 'nan') then parent_header_id end) as up
  from structural_chunks where chunk_id is not null group by 1),
l as (select v, up, case when up in (select v from n) then up end as p from n),
walk as (select v, p as a from l where p is not null union select w.v, l.p from walk w join l on l.v = w.a where l.p is not null),
onc as (select distinct v from walk where v = a)"""

_FOREST = (
    _LINKS
    + """,
t as (select v, case when v in (select v from onc) then null else p end as p from l),
down as (select v, v as root, 0 as depth, v as path from t where p is null
  union all select t.v, d.root, d.depth + 1, d.path || ' > ' || t.v from t join down d on t.p = d.v),
above as (select v, p as a from t where p is not null union all select w.v, t.p from above w join t on t.v = w.a where t.p is not null)"""
)

SQL = {
    "p1_found": _LINKS
    + """
select v as chunk_id, 'on_cycle' as state from onc
union all select distinct v, 'below_cycle' from walk where a in (select v from onc) and v not in (select v from onc)
union all select v, 'lost_parent' from l where up is not null and p is null""",
    "p1_hierarchy": _FOREST
    + """
select d.v as chunk_id, d.root as root_id, cast(d.depth as bigint) as depth, coalesce(k.n, 0) as n_descendants, d.path
from down d left join (select a, count(*) as n from above group by 1) k on k.a = d.v""",
    "p1_descendants": _FOREST + " select a as ancestor_id, v as chunk_id from above",
}
