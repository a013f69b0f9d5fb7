from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelkit.operators import hierarchy as H
from panelkit.operators.lookup import RepeatedKeyError
from panelkit.operators.ranks import with_chunk, with_dense_rank, with_row_number

SCHEMA = "id long, parent long, order long, label string"
TREE = [(1, 1, 0, "Diapers"), (10, 1, 5, "Pants"), (11, 1, 3, "Tape"), (110, 11, 1, "Tape S")]


def nodes(spark, data, **options):
    found = H.walk(spark.createDataFrame(data, SCHEMA), **options)
    return {r.id: r for r in found.collect()}


@pytest.mark.parametrize("options", [{}, {"one_task_rows": 0, "limit": 0}])
def test_paths_ordinals_and_labels(spark, options):
    found = nodes(spark, TREE, **options)
    assert {i: (r.depth, r.ordinal, r.hier, list(r.path)) for i, r in found.items()} == {
        1: (0, "", "0. Diapers", [1]),
        10: (1, "2.", "2.0. Pants", [1, 10]),
        11: (1, "1.", "1.0. Tape", [1, 11]),
        110: (2, "1.1.", "1.1.0. Tape S", [1, 11, 110]),
    }


def test_levels_are_padded_and_redundant_ones_dropped(spark):
    levelled = H.with_levels(H.walk(spark.createDataFrame(TREE, SCHEMA)), "level_")
    codes = {r.id: [r[f"level_{i}_code"] for i in range(4)] for r in levelled.collect()}
    assert codes == {1: [1, 1, 1, 1], 10: [1, 10, 10, 10], 11: [1, 11, 11, 11], 110: [1, 11, 110, 110]}
    names = [f"level_{i}" for i in range(4)]
    assert H.redundant_levels(levelled, names) == ["level_3"]
    kept = H.drop_redundant_levels(levelled, names).columns
    assert "level_3" not in kept and "level_3_code" not in kept and "level_2" in kept


def test_a_null_level_is_not_redundant(spark):
    df = spark.createDataFrame([("a", "a", "a"), (None, None, "b")], "l0 string, l1 string, l2 string")
    assert H.redundant_levels(df, ["l0", "l1", "l2"]) == []


def test_siblings_of_one_order_share_a_rank(spark):
    found = nodes(spark, [(1, 1, 0, "r"), (2, 1, 4, "a"), (3, 1, 4, "b"), (4, 1, 7, "c")])
    assert [found[i].ordinal for i in (2, 3, 4)] == ["1.", "1.", "2."]


def test_lone_root_has_depth_zero(spark):
    assert nodes(spark, [(1, 1, 0, "r")])[1].hier == "0. r"


@pytest.mark.parametrize("broken", [[(5, 99, 0, "orphan")], [(6, 7, 0, "a"), (7, 6, 0, "b")]])
def test_orphans_and_cycles(spark, broken):
    with pytest.raises(H.BrokenTreeError):
        nodes(spark, TREE + broken)
    assert set(nodes(spark, TREE + broken, strict=False)) == {1, 10, 11, 110}
    edges = spark.createDataFrame(TREE + broken, SCHEMA)
    lost = H.unreached(edges, H.walk(edges, strict=False))
    assert {r.id for r in lost.collect()} == {row[0] for row in broken}


def test_only_broken_nodes_give_an_empty_walk(spark):
    assert nodes(spark, [(6, 7, 0, "a"), (7, 6, 0, "b")], strict=False) == {}


def test_scopes_keep_trees_apart(spark):
    data = [("x", 1, 1, 0, "r"), ("x", 2, 1, 5, "a"), ("x", 3, 1, 6, "b"), ("y", 1, 1, 0, "r"), ("y", 3, 1, 6, "b")]
    edges = spark.createDataFrame(data, f"cat string, {SCHEMA}")
    found = {(r.cat, r.id): r.ordinal for r in H.walk(edges, scope=["cat"]).collect()}
    assert found == {("x", 1): "", ("x", 2): "1.", ("x", 3): "2.", ("y", 1): "", ("y", 3): "1."}


def test_edges_roots_and_leaves(spark):
    facts = spark.createDataFrame(
        [(1, 1, "r", 0), (2, 1, "old", 1), (2, 1, "new", 2), (3, 1, "c", 1), (3, 2, "c", 5), (None, 1, "x", 1)],
        "node long, up long, name string, seq int",
    )
    edges = H.edges_from_facts(facts, "node", "up", "name", F.col("seq"))
    found = {r.id: (r.parent, r.label, r.conflict) for r in edges.collect()}
    assert found == {1: (1, "r", False), 2: (1, "new", False), 3: (2, "c", True)}
    assert [r.id for r in H.roots(edges).collect()] == [1]
    assert [r.id for r in H.leaves(edges).collect()] == [3]


@pytest.fixture(scope="module")
def lopsided(spark):
    """A group of half the rows, order values with many copies, and null groups."""
    data = [("big", i % 90, i) for i in range(500)] + [(f"g{i % 60}", i % 7, i) for i in range(450)]
    return spark.createDataFrame(data + [(None, 3, i) for i in range(50)], "g string, o int, u int").repartition(5)


def test_row_numbers_do_not_depend_on_the_way(lopsided):
    small = with_row_number(lopsided, ["g"], ["o", "u"], "n")
    large = with_row_number(lopsided, ["g"], ["o", "u"], "n", one_task_rows=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_row_numbers_with_equal_order_values_are_complete(lopsided):
    found = with_row_number(lopsided, ["g"], [F.lit(1)], "n", one_task_rows=0)
    per_group = found.groupBy("g").agg(F.count("*").alias("c"), F.max("n").alias("m"), F.count_distinct("n").alias("d"))
    assert all(r.c == r.m == r.d for r in per_group.collect())


def test_dense_ranks_do_not_depend_on_the_way(lopsided):
    small = with_dense_rank(lopsided, ["g"], ["o"], "r")
    large = with_dense_rank(lopsided, ["g"], ["o"], "r", one_task_rows=0)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


@pytest.mark.parametrize("n, chunks", [(5, [0, 0, 1, 1, 2]), (4, [0, 0, 1, 1])])
@pytest.mark.parametrize("one_task_rows", [0, 100])
def test_chunks(spark, n, chunks, one_task_rows):
    df = spark.createDataFrame([("a", i) for i in range(n)], "category string, id int")
    found = with_chunk(df, ["category"], ["id"], 2, one_task_rows=one_task_rows)
    assert [r.chunk for r in sorted(found.collect(), key=lambda r: r.id)] == chunks


def test_a_chain_of_200_nodes_takes_nine_joins(spark, monkeypatch):
    joins = []
    plain = H.sized_join
    monkeypatch.setattr(H, "sized_join", lambda *a, **k: joins.append(a[3] if len(a) > 3 else "left") or plain(*a, **k))
    data = [(i, max(i - 1, 0), 1, f"n{i}") for i in range(200)]
    found = nodes(spark, data)
    assert joins.count("inner") <= 9 and len(found) == 200
    assert list(found[199].path) == list(range(200)) and found[199].ordinal == "1." * 199 and found[199].depth == 199
    assert list(found[7].hiers) == [f"{'1.' * i}0. n{i}" for i in range(8)]


def test_long_and_short_ways_side_by_side(spark):
    data = [(0, 0, 0, "r")] + [(i, (i - 1) // 2 if i % 3 else max(0, i - 1), i % 4, f"n{i}") for i in range(1, 120)]
    parent = {i: p for i, p, *_ in data}
    for options in ({}, {"one_task_rows": 0, "limit": 0}):
        found = nodes(spark, data, **options)
        assert len(found) == len(data)
        for i, row in found.items():
            way = [i]
            while way[0]:
                way.insert(0, parent[way[0]])
            assert list(row.path) == way and row.depth == len(way) - 1


def test_repeated_ids_hide_no_orphan(spark):
    data = [(1, 1, 0, "r"), (2, 1, 1, "a"), (2, 1, 1, "a"), (3, 2, 0, "b"), (9, 99, 0, "orphan")]
    with pytest.raises(RepeatedKeyError):
        nodes(spark, data)
    with pytest.raises(RepeatedKeyError):
        nodes(spark, data, strict=False)


def test_ways_into_a_cycle_end(spark):
    ring = [(i, 100 + (i - 99) % 7, 0, f"c{i}") for i in range(100, 107)]
    tail = [(200, 103, 0, "t0")] + [(200 + i, 199 + i, 0, f"t{i}") for i in range(1, 30)]
    with pytest.raises(H.BrokenTreeError):
        nodes(spark, TREE + ring + tail)
    assert set(nodes(spark, TREE + ring + tail, strict=False)) == {1, 10, 11, 110}


def test_ties_are_numbered_alike_on_both_ways(spark):
    data = [("a", i % 3, f"t{i}") for i in range(40)] + [("b", 1, "same")] * 12 + [(None, 2, f"n{i}") for i in range(5)]
    df = spark.createDataFrame(data, "g string, o int, text string").repartition(4)
    ways = [with_row_number(df, ["g"], ["o"], "n", one_task_rows=k) for k in (1000, 0, 20)]
    found = [sorted(map(str, way.collect())) for way in ways]
    assert found[0] == found[1] == found[2]
    whole = [sorted(map(str, with_row_number(df, [], ["o"], "n", one_task_rows=k).collect())) for k in (1000, 0)]
    assert whole[0] == whole[1]


def test_no_row_is_shuffled_after_the_range_write(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), "id", F.lit("long text").alias("text"))
    plan = with_row_number(df, ["g"], ["id"], "n", one_task_rows=0)._jdf.queryExecution().executedPlan().toString()
    large = plan[plan.rindex("__first") :]
    assert "SortMergeJoin" not in plan and plan.count("text#") and "hashpartitioning(g" in plan
    assert all("text" not in line for line in large.splitlines() if "Exchange" in line)
