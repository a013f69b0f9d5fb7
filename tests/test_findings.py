"""Findings of the third review on core queries: each test failed before its change."""

from __future__ import annotations

from panelkit.catalog import lookups
from panelkit.operators import lookup


def test_grouped_dictionaries_are_not_counted_again(spark, tmp_path, monkeypatch):
    tables = {
        "lineitem": ([(1, 1, 10, 20), (1, 2, 10, 20), (2, 1, 11, 21)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"),
        "part": ([(10, "a"), (11, "b")], "p_partkey long, p_type string"),
        "supplier": ([(20, "s")], "s_suppkey long, s_name string"),
        "orders": ([(1, "d"), (2, None)], "o_orderkey long, o_orderdate string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    counted, plain = [], lookup.profile
    monkeypatch.setattr(lookup, "profile", lambda df, keys: counted.append(tuple(keys)) or plain(df, keys))
    found = {tuple(r) for r in lookups.large_lookup_chain(spark, str(tmp_path)).collect()}
    assert found == {(1, 1, "a", "s", "d", 2), (1, 2, "a", "s", "d", 2), (2, 1, "b", None, None, 1)}
    assert counted == [("l_partkey",), ("l_suppkey",), ("l_orderkey",)]
