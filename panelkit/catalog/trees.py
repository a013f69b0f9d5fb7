"""The tree all <- region <- nation <- customer, and facts attached to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.catalog.base import query, table
from panelkit.functions import columns as C
from panelkit.operators import hierarchy as H
from panelkit.operators.ranks import with_dense_rank
from panelkit.operators.union import union_all
from panelkit.session import stage, staging_path
from panelkit.sources import sinks


def tree_facts(spark, sf_dir):
    """Panel rows naming node and parent: every customer and order, and the inner nodes."""
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")

    def rows(df, node, parent, label, order):
        return df.select(
            node.cast("long").alias("node"),
            parent.cast("long").alias("parent"),
            label.alias("label"),
            order.cast("long").alias("order"),
        )

    def customers(df):
        order = F.floor(F.col("c_acctbal") / 100)
        return rows(df, F.col("c_custkey") + 1000, F.col("c_nationkey") + 100, F.col("c_name"), order)

    return union_all(
        [
            customers(customer),
            customers(orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))),
            rows(nation, F.col("n_nationkey") + 100, F.col("n_regionkey") + 10, F.col("n_name"), -F.col("n_nationkey")),
            rows(region, F.col("r_regionkey") + 10, F.lit(1), F.col("r_name"), F.col("r_regionkey")),
            rows(region.agg(F.lit(1).alias("id")), F.col("id"), F.col("id"), F.lit("ALL"), F.lit(0)),
        ]
    )


def tree_edges(spark, sf_dir):
    """Edges with the sibling order, which the facts of this tree carry themselves."""
    facts = tree_facts(spark, sf_dir)
    label = F.struct("label", "order").alias("label")
    edges = H.edges_from_facts(facts.select("node", "parent", label), "node", "parent", "label")
    return edges.select("id", "parent", "label.label", "label.order")


EDGES_SQL = """edges AS (
      SELECT CAST(c_custkey + 1000 AS BIGINT) AS id, CAST(c_nationkey + 100 AS BIGINT) AS parent, c_name AS label,
        CAST(floor(c_acctbal / 100) AS BIGINT) AS ord FROM customer
      UNION ALL SELECT n_nationkey + 100, n_regionkey + 10, n_name, -n_nationkey FROM nation
      UNION ALL SELECT r_regionkey + 10, 1, r_name, r_regionkey FROM region
      UNION ALL SELECT 1, 1, 'ALL', 0),
    ranked AS (SELECT *, dense_rank() OVER (PARTITION BY parent ORDER BY ord) AS rk FROM edges WHERE id <> parent)"""

WALK_SQL = f"""WITH RECURSIVE {EDGES_SQL},
    nodes(id, parent, label, depth, ordinal, hier, path, hiers) AS (
      SELECT id, parent, label, 0, '', '0. ' || label, [id], ['0. ' || label] FROM edges WHERE id = parent
      UNION ALL
      SELECT r.id, r.parent, r.label, n.depth + 1, n.ordinal || r.rk || '.',
        n.ordinal || r.rk || '.0. ' || r.label, list_append(n.path, r.id),
        list_append(n.hiers, n.ordinal || r.rk || '.0. ' || r.label)
      FROM ranked r JOIN nodes n ON r.parent = n.id)"""


@query(f"WITH {EDGES_SQL} SELECT id, parent, label, false AS conflict FROM edges")
def tree_edges_from_facts(spark, sf_dir):
    return H.edges_from_facts(tree_facts(spark, sf_dir), "node", "parent", "label")


@query(
    f"""WITH {EDGES_SQL} SELECT id, id = parent AS is_root FROM edges
    WHERE id = parent OR id NOT IN (SELECT parent FROM edges)"""
)
def tree_roots_and_leaves(spark, sf_dir):
    edges = stage(H.edges_from_facts(tree_facts(spark, sf_dir), "node", "parent", "label"), "edges")
    marked = [
        H.roots(edges).select("id", F.lit(True).alias("is_root")),
        H.leaves(edges).select("id", F.lit(False).alias("is_root")),
    ]
    return union_all(marked)


@query(f"WITH {EDGES_SQL} SELECT id, parent, rk AS rank FROM ranked")
def sibling_rank(spark, sf_dir):
    """Dense ranks the way they are made when the siblings do not fit one task."""
    below = tree_edges(spark, sf_dir).filter("id <> parent")
    return with_dense_rank(below, ["parent"], ["order"], "rank", one_task_rows=0).select("id", "parent", "rank")


def _nodes(spark, sf_dir, **options):
    return H.walk(tree_edges(spark, sf_dir), **options)


@query(f"{WALK_SQL} SELECT id, depth, array_to_string(path, '/') AS path FROM nodes")
def tree_paths(spark, sf_dir):
    path = F.array_join(F.col("path").cast("array<string>"), "/")
    return _nodes(spark, sf_dir).select("id", "depth", path.alias("path"))


@query(f"{WALK_SQL} SELECT id, depth, array_to_string(path, '/') AS path FROM nodes")
def large_tree_paths(spark, sf_dir):
    """The same walk the way it runs when neither siblings nor a level are small."""
    path = F.array_join(F.col("path").cast("array<string>"), "/")
    nodes = _nodes(spark, sf_dir, one_task_rows=0, limit=0)
    return nodes.select("id", "depth", path.alias("path"))


@query(f"{WALK_SQL} SELECT id, depth, ordinal, hier FROM nodes")
def tree_labels(spark, sf_dir):
    return _nodes(spark, sf_dir).select("id", "depth", "ordinal", "hier")


LEVELS_SQL = ", ".join(
    f"coalesce(hiers[{i + 1}], hiers[-1]) AS level_{i}, coalesce(path[{i + 1}], path[-1]) AS level_{i}_code"
    for i in range(5)
)


@query(f"{WALK_SQL} SELECT id, {LEVELS_SQL} FROM nodes")
def tree_levels(spark, sf_dir):
    return H.with_levels(_nodes(spark, sf_dir), "level_").drop(
        "parent", "label", "depth", "path", "ordinal", "hier", "hiers"
    )


@query(
    f"""{WALK_SQL} SELECT o_orderkey, hier, depth, path[2] AS region FROM orders
    LEFT JOIN nodes ON o_custkey + 1000 = id"""
)
def tree_attach(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 1000).alias("node"))
    nodes = _nodes(spark, sf_dir).select("id", "hier", "depth", F.get("path", F.lit(1)).alias("region"))
    return H.attach(orders, nodes, "node").drop("node")


@query(
    f"""{WALK_SQL} SELECT o_orderkey, hiers[1] AS level_0, path[1] AS level_0_code, hiers[2] AS level_1,
      path[2] AS level_1_code, hiers[3] AS level_2, path[3] AS level_2_code FROM orders
    JOIN (SELECT * FROM nodes WHERE depth = 3) n ON o_custkey + 1000 = n.id"""
)
def drop_levels(spark, sf_dir):
    """Facts of the nations only: the levels below the nation repeat it and go."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 100).alias("node"))
    facts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "node")
    nodes = H.with_levels(_nodes(spark, sf_dir), "level_")
    levels = [c for c in nodes.columns if c.startswith("level_")]
    joined = H.attach(facts, nodes.select("id", *levels), "node").drop("node")
    return H.drop_redundant_levels(joined, [c for c in levels if not c.endswith("_code")])


@query(
    f"""{WALK_SQL} SELECT DISTINCT c_mktsegment, o_orderstatus, hiers[2] AS level_1, hiers[3] AS level_2
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nodes ON id = c_custkey + 1000"""
)
def category_tree(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    facts = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("node", F.col("c_custkey") + 1000)
    nodes = H.with_levels(_nodes(spark, sf_dir), "level_").select("id", "level_1", "level_2")
    path = staging_path(spark, "category-tree")
    attached = H.attach(facts, nodes, "node")
    sinks.write_tree(attached, ["c_mktsegment", "o_orderstatus", "level_1", "level_2"], path)
    return spark.read.parquet(path)


@query(f"{WALK_SQL} SELECT id, parent, label, depth, ordinal, hier FROM nodes")
def levels_excluded(spark, sf_dir):
    """The tree without any of its numbered level columns."""
    nodes = H.with_levels(_nodes(spark, sf_dir), "level_")
    return C.drop_matching(nodes, "level_").drop("path", "hiers")
