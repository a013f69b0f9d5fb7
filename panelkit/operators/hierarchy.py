"""Parent-child trees: paths, sibling ranks, ordinal labels and level columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from panelkit.operators.lookup import lookup, require_unique
from panelkit.operators.quality import Findings
from panelkit.operators.ranks import ONE_TASK_ROWS, with_dense_rank
from panelkit.operators.skew import BROADCAST_BYTES, sized_join
from panelkit.operators.union import union_all
from panelkit.session import row_bytes, side_by_side, stage, stage_sized


class BrokenTreeError(ValueError):
    """Some nodes cannot be reached from a root."""


def edges_from_facts(
    facts: DataFrame,
    node: str,
    parent: str,
    label: str,
    order: str | Column | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """One (id, parent, label) per node; of conflicting rows the last in ``order`` counts.

    ``conflict`` tells that the facts name more than one parent for the node. ``scope``
    columns keep one tree per value, so that an id may stand in several trees.
    """
    last = F.struct(F.col(parent).alias("parent"), F.col(label).alias("label"))
    return (
        facts.filter(F.col(node).isNotNull())
        .groupBy(*scope, F.col(node).alias("id"))
        .agg(
            F.max_by(last, F.struct(order, last) if order is not None else last).alias("last"),
            (F.min(parent) != F.max(parent)).alias("conflict"),
        )
        .select(*scope, "id", "last.parent", "last.label", "conflict")
    )


def roots(edges: DataFrame) -> DataFrame:
    """Nodes that are their own parent."""
    return edges.filter(F.col("id") == F.col("parent"))


def leaves(edges: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Nodes that are nobody's parent."""
    parents = edges.select(*scope, F.col("parent").alias("id")).distinct()
    return sized_join(edges, parents, [*scope, "id"], "left_anti")


def walk(
    edges: DataFrame,
    strict: bool = True,
    scope: Sequence[str] = (),
    one_task_rows: int = ONE_TASK_ROWS,
    limit: int = BROADCAST_BYTES,
    findings: Findings | None = None,
    step: str = "tree",
) -> DataFrame:
    """Every node with the way to it from its root.

    ``edges`` holds id, parent, label and ``order``, the dictionary order of siblings, and
    the ``scope`` columns that tell trees apart; every id comes once. Returns the scope, id, parent, label, depth,
    ``path`` (ids, root first), ``ordinal`` (sibling ranks as ``1.2.``, empty for a root), ``hier`` (ordinal and label)
    and ``hiers`` (``hier`` of every node on the path).

    The ways of the inner nodes are found by pointer doubling (see ``_inner_ways``), so that a tree of depth d
    takes log2(d) joins of inner nodes, and one more that hangs all other nodes below them.

    A node no root leads to (its parent is unknown, or it lies on or below a cycle) fails in
    strict mode and is left out otherwise; see ``unreached``. ``findings`` are told, for this ``step``, the nodes, those
    left out and those with more than one parent (``conflict`` of the edges).
    """
    scope = list(scope)
    disputed = Observation(f"{step}-parents") if findings and "conflict" in edges.columns else None
    if disputed:
        edges = edges.observe(disputed, F.count_if("conflict").alias("n"))
    edges, total, edge_bytes = stage_sized(edges, "edges")
    below_root = edges.filter(F.col("id") != F.col("parent")).drop("conflict")
    ranked = with_dense_rank(below_root, [*scope, "parent"], ["order"], "rank", one_task_rows, total)
    top = roots(edges).withColumn("rank", F.lit(0).cast("long"))
    ranked = union_all([top.drop("conflict"), ranked]).select(*scope, "id", "parent", "label", "rank")
    if total > one_task_rows:
        ranked = stage(ranked, "ranked")
    own = F.struct("id", "rank", "label")
    above = F.when(F.col("id") != F.col("parent"), F.col("parent"))
    ranked = ranked.withColumn("way", F.array(own)).withColumn("up", above)

    parents = below_root.select(*scope, F.col("parent").alias("id")).distinct()
    inner = sized_join(ranked, parents, [*scope, "id"], "left_semi", limit, edge_bytes)
    rounds = 2 if total <= one_task_rows else 1
    _, (inner, measured) = side_by_side(
        lambda: require_unique(edges, [*scope, "id"], "tree"), lambda: _inner_ways(inner, scope, limit, 8 * edge_bytes, rounds)
    )
    inner = inner.select(*scope, F.col("id").alias("parent"), F.col("way").alias("above"))
    hung = sized_join(ranked.filter("up is not null"), inner, [*scope, "parent"], "inner", limit, measured)
    ways = union_all([ranked.filter("up is null"), hung.withColumn("way", F.concat("above", "way")).drop("above")])
    nodes, reached, _ = stage_sized(_labelled(ways, scope), "nodes")
    if strict and reached < total:
        some = [row.id for row in unreached(edges, nodes, scope).select("id").take(5)]
        raise BrokenTreeError(f"no root leads to {total - reached} nodes, {some} among them")
    if findings:
        findings.add(step, "rows", total)
        findings.add(step, "nodes no root leads to", total - reached)
    if disputed:
        findings.add(step, "nodes with several parents", disputed.get["n"])
    return nodes


def _inner_ways(inner: DataFrame, scope: Sequence[str], limit: int, measured: int, rounds: int) -> tuple[DataFrame, int]:
    """The nodes that have children with the whole ``way`` from the root, and the bytes of that table.

    Every node knows the last 1, 2, 4, .. nodes of its way and the node above them (``up``), and takes over what that
    node knows, until ``up`` is null. Finished nodes are not joined again. A node that finds itself above itself
    lies on a cycle and goes, as do nodes whose ``up`` is gone.

    ``measured`` bounds the bytes of ``inner`` with one-node ways; the table is written after every ``rounds`` doublings.
    """
    columns = [*scope, "id", "way", "up"]

    def doubled(waiting, done, bytes_):
        known = union_all([*done, waiting]).select(
            *scope, F.col("id").alias("up"), F.col("way").alias("above"), F.col("up").alias("next")
        )
        joined = sized_join(waiting.filter("up is not null"), known, [*scope, "up"], "inner", limit, bytes_)
        joined = joined.filter(~F.exists("above", lambda node: node["id"] == F.col("id")))
        longer = joined.withColumn("way", F.concat("above", "way")).withColumn("up", F.col("next"))
        return longer.select(*columns)

    latest, done, done_bytes, open_, step = inner.select(*columns), [], 0, 1, 0
    while open_:
        for number in range(rounds):
            finished = latest.filter("up is null")
            latest, done = doubled(latest, [*done], done_bytes + measured * 2**number), [*done, finished]
        step += 1
        seen = Observation(f"ways-{step}")
        # what this write finishes is one table, so that plans stay short
        fresh = union_all([*done[-rounds:], latest])
        fresh = fresh.observe(
            seen,
            F.count_if(F.col("up").isNotNull()).alias("open"),
            F.coalesce(F.sum(row_bytes(fresh)), F.lit(0)).alias("bytes"),
        )
        fresh = stage(fresh, f"ways-{step}")
        open_, measured = seen.get["open"], seen.get["bytes"]
        done = [*done[:-rounds], fresh.filter("up is null")]
        done_bytes, latest = done_bytes + measured, fresh.filter("up is not null")
    return union_all(done).select(*scope, "id", "way"), done_bytes


def _labelled(ways: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Depth, path, ordinal and labels from the way to each node."""
    ranks = F.transform("way", lambda node: F.concat(node["rank"].cast("string"), F.lit(".")))

    def ordinal(last):
        return F.array_join(F.slice(ranks, 2, last), "")

    def hier(node, i):
        return F.trim(F.concat(ordinal(i), F.lit("0. "), node["label"]))

    depth = F.size("way") - 1
    return ways.select(
        *scope,
        "id",
        "parent",
        "label",
        depth.alias("depth"),
        F.col("way.id").alias("path"),
        ordinal(depth).alias("ordinal"),
        F.transform("way", hier).alias("hiers"),
    ).select(*scope, "id", "parent", "label", "depth", "path", "ordinal", F.element_at("hiers", -1).alias("hier"), "hiers")


def unreached(edges: DataFrame, nodes: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Orphans and members of cycles, which the walk from the roots never meets."""
    return sized_join(edges, nodes.select(*scope, "id"), [*scope, "id"], "left_anti")


def level_count(nodes: DataFrame) -> int:
    """Level columns the tree needs: its longest path and one more."""
    longest = nodes.agg(F.max("depth")).first()[0]
    return 0 if longest is None else longest + 2


def _padded(values: Column, width: int) -> Column:
    """The list, its last value repeated up to ``width``."""
    missing = F.greatest(F.lit(width) - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.element_at(values, -1), missing))


def with_levels(nodes: DataFrame, prefix: str, width: int | None = None) -> DataFrame:
    """``<prefix>0..n`` with the labels and ``<prefix>0_code..`` with the ids of the way to the node.

    Below its own depth a node stands in for itself. ``width`` gives the number of levels;
    without it there are as many as the tree needs.
    """
    width = level_count(nodes) if width is None else width
    labels, codes = _padded(F.col("hiers"), width), _padded(F.col("path"), width)
    return nodes.withColumns(
        {f"{prefix}{i}": labels[i] for i in range(width)}
        | {f"{prefix}{i}_code": codes[i] for i in range(width)}
    )


def attach(
    facts: DataFrame, closure: DataFrame, node: str, scope: Sequence[str] = (), **options
) -> DataFrame:
    """Facts with the columns of the node their id names."""
    return lookup(facts, closure, {**{c: c for c in scope}, node: "id"}, **options)


def redundant_levels(df: DataFrame, levels: Sequence[str]) -> list[str]:
    """Levels equal to the level above on every row; a null makes a level differ."""
    pairs = list(zip(levels, levels[1:]))
    if not pairs:
        return []
    equal = [F.count_if(F.col(a) == F.col(b)).alias(b) for a, b in pairs]
    found = df.agg(F.count("*").alias("__rows"), *equal).first()
    return [b for _, b in pairs if found[b] == found["__rows"]]


def drop_redundant_levels(df: DataFrame, levels: Sequence[str], keep: int = 1) -> DataFrame:
    """Without redundant levels and their codes; the first ``keep`` levels always stay."""
    gone = [c for c in redundant_levels(df, levels) if c not in list(levels)[:keep]]
    return df.drop(*gone, *[f"{c}_code" for c in gone])


def category_tree(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct tree rows of every category."""
    return df.select(*columns).distinct()
