"""Findings of the second review: each test failed before its change."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from panelkit.llm import ctw, hilbert, langid, line_dedup, pieces, topk
from panelkit.llm.common import usable_labels
from panelkit.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_context_tree_reaches_five_bytes(spark):
    # the byte after "bbbb" is only told by the fifth byte before it
    rows = [(i, ("abbbba" if i % 2 else "cbbbbc") * 30, "en", "s", 1) for i in range(60)]
    found = {r.doc_id: r.score for r in ctw.score(spark.createDataFrame(rows, DOCS)).collect()}
    assert ctw.DEPTH >= 5 and all(-s * math.log2(10) < 12 for s in found.values())


def test_context_tree_codes_the_end(spark):
    rows = [(i, "ab", "en", "s", 1) for i in range(40)] + [(100, None, "en", "s", 1), (101, "", "en", "s", 1), (None, "b", "en", "s", 1)]
    table = spark.createDataFrame(rows, DOCS)
    bytes_, whole = ({r.doc_id: r.score for r in ctw.score(table, ends=e).collect()} for e in (False, True))
    assert bytes_[100] == bytes_[101] == 0 and whole[100] == whole[101] < -1  # an empty text is improbable, not certain
    assert all(whole[d] < bytes_[d] for d in whole)
    # the probabilities of all texts sum to one at most
    assert 10 ** whole[0] + 10 ** whole[100] + 10 ** whole[None] <= 1 < 10 ** bytes_[0] + 10 ** bytes_[100]


def test_lines_without_blanks_are_long(spark):
    chinese = "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏閏餘成歲律呂調陽"
    tabbed, spaced = "\t".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    padded = "only" + " " * 60 + "two"
    rows = [(i, "\n".join([f"own {i}", line, f"end {i}"]), "en", "s", 1) for i, line in enumerate([chinese, chinese, tabbed, tabbed, spaced, spaced, padded, padded])]
    found = {r.doc_id: r.dropped_lines for r in line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {0: 0, 1: 1, 2: 0, 3: 1, 4: 0, 5: 1, 6: 0, 7: 0}
    lines = ["", "a", "a  b\tc", "日本語 abc", "ภาษาไทย", " 　", "x" * 50]
    words = line_dedup.line_table(spark.createDataFrame([(1, "\n".join(lines), "en", "s", 1)], DOCS)).orderBy("pos").collect()
    assert [r.words for r in words] == [1, 1, 3, 4, 7, 1, 1]


def test_rightly_predicted_documents_stay(spark):
    rnd = random.Random(4)
    part = lambda signs, n: "".join(rnd.choice(signs) for _ in range(n))
    signs = {"aa": "abcde ", "mm": "mnopq ", "zz": "vwxyz "}
    # a clean text in three languages, the first of them only just the longest
    rows = [(i, part(signs[lang], 90), lang, "s", 90) for i in range(300) for lang in [("aa", "mm", "zz")[i % 3]]]
    rows += [(1000 + i, part(signs["aa"], 192) + part(signs["mm"], 128) + part(signs["zz"], 128), "aa", "s", 448) for i in range(20)]
    table = spark.createDataFrame([*rows, (2000, "12 34", "aa", "s", 5)], DOCS)
    found = {r.doc_id: r for r in langid.language(table).collect()}
    right = {d for d, _, lang, _, _ in rows if found[d].lang_pred == lang}
    assert any(found[d].score < 0.5 for d in right)
    kept = {r.doc_id for r in corpus_pipeline.known_language(spark, table, "").collect()}
    assert right <= kept and 2000 not in kept


def test_one_row_of_each_class(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(80)) for k in "abc")
    rows = [(1, a), (1, a), (2, a), (None, b), (None, b), (3, c), (3, a), (None, c), (4, None), (4, None)]
    table = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS)
    kept = corpus_pipeline.one_of_each(spark, table, "").collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, a), (None, b), (3, c), (4, None)], key=str)


def test_repeated_candidates_take_one_place():
    scores = np.array([[9], [9], [9], [8], [5], [4], [7]], np.float32)
    q, ids, value = topk.best(scores, np.array([1, 1, 1, 1, 2, 3, 3]), np.array([50]), 3)
    assert ids.tolist() == [1, 3, 2] and value.tolist() == [9, 7, 5] and q.tolist() == [0, 0, 0]


def test_code_length_per_byte(spark):
    table = spark.createDataFrame([(i, "abc" * 20, "en", "s", 1) for i in range(10)] + [(20, "", "en", "s", 0), (21, None, "en", "s", 0)], DOCS)
    found = {r.doc_id: r for r in ctw.score(table, ends=True, code_length=True).collect()}
    assert found[20].code_bits_per_byte is None and found[21].code_bits_per_byte is None
    assert abs(found[1].code_bits_per_byte + found[1].score * math.log2(10) / 60) < 1e-12


def test_vectors_of_any_length_and_size_find_their_neighbours(spark):
    rnd = np.random.default_rng(6)
    rows = {i: rnd.normal(size=16) for i in range(300)}
    rows[300], rows[301] = rnd.normal(size=17), rows[5][:9]
    rows[350], rows[352], rows[354] = rows[7] * 1e200, rows[8] * 1e-200, rows[9] * 1e300
    table = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>")
    found = {}
    for r in hilbert.neighbours(table, table.where("vec_id % 50 = 0 or vec_id in (7, 8, 9)"), 5).collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == {0, 50, 100, 150, 200, 250, 300, 350, 7, 8, 9} and all(len(x) == 5 for x in found.values())
    assert found[7][0][0] == 350 and found[350][0][0] == 7 and found[8][0][0] == 352 and found[9][0][0] == 354
    assert abs(found[350][0][1] - 1) < 1e-12
    unit = {i: hilbert._even(v, 17) / np.linalg.norm(hilbert._even(v, 17)) for i, v in rows.items()}
    hits = 0
    for q, got in found.items():
        best = sorted((-float(unit[q] @ unit[c]), c) for c in rows if c != q)[:5]
        hits += len({c for _, c in best} & {c for c, _ in got})
        assert all(abs(s - float(unit[q] @ unit[c])) < 1e-9 for c, s in got)
    assert hits >= 0.9 * 5 * len(found)


def test_suffix_array_and_its_intervals(spark):
    rnd = random.Random(4)
    texts = [[rnd.randrange(3) for _ in range(rnd.randrange(1, 25))] for _ in range(12)] + [[1, 2] * 20, [1, 2] * 20, [0]]
    rows = [(d, 0, 0, p, x, 0) for d, t in enumerate(texts) for p, x in enumerate(t)]
    runs = spark.createDataFrame(rows, "d1 long, d2 long, run int, pos int, h1 long, h2 long")
    table, count = line_dedup.suffix_ranks(runs)
    found = {(r.d1, r.pos): r.rank for r in table.collect()}
    suffixes = {(d, p): t[p:] for d, t in enumerate(texts) for p in range(len(t))}
    order = sorted({tuple(s) for s in suffixes.values()})
    assert count == len(order) and found == {k: order.index(tuple(s)) for k, s in suffixes.items()}
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    prefixes = line_dedup.common_prefixes(table, 8)
    lcp = {r.rank: r.lcp for r in prefixes.collect()}
    assert lcp == {i: min(8, shared(order[i - 1], order[i])) if i else 0 for i in range(len(order))}
    # copies of the array far apart, so that intervals are handed from piece to piece
    n = 40_000
    wide = spark.range(n).select(F.col("id").alias("rank"), F.when(F.col("id") % 30_000 == 0, 0).when(F.col("id") % 7 == 0, 1).otherwise(2).cast("int").alias("lcp"))
    starts = {r.rank: r.starts for r in line_dedup.interval_starts(wide, n, 2).where("rank % 997 = 0").collect()}
    assert len(starts) == 41 and all(v == [i // 30_000 * 30_000, max(i // 7 * 7, i // 30_000 * 30_000)] for i, v in starts.items())


def test_languages_whose_rows_share_an_id_are_learned(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["ala", "makota", "ona"]) for _ in range(30)), "aa", "s", 1) for i in range(1, 300) if zlib.crc32(str(i).encode()) % 5]
    same = next(i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 5)
    rows += [(same, "zzz yyy xxx " * 12, "zz", "s", 1)] * 4000
    network = langid.fit(spark.createDataFrame(rows, DOCS).coalesce(2), windows=50)
    assert network.languages == ["aa", "zz"]


def test_labels_are_counted_in_tasks(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    plan = usable_labels(labels, "toxic", 3, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "SinglePartition" not in plan and "Limit" not in plan


def test_round_trip_is_a_decode(spark):
    texts = ["a▁b", "a b", " a", "", "▁", "日本 x\n"]
    found = pieces.digests(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS), tokenizer_path("piece_bpe_32k.model"))
    assert {r.doc_id: r.round_trip for r in found.where("rank = 1").collect()} == {i: "▁" not in t for i, t in enumerate(texts)}


def test_top_k_with_components_beyond_64_bits(spark):
    draw = random.Random(5)
    rows = [[draw.uniform(-1, 1) for _ in range(4)] for _ in range(60)]
    rows[3], rows[7], rows[20] = [1e30, 0.5, 0.0, 0.0], [1e30, 1.0, -1e30, 0.25], [1.0, 0.5, 1.0, 0.0]
    rows[40], rows[11], rows[12] = [-1e300, 0.1, 0.2, 0.3], [1.7e308, 0.0, 0.0, 0.0], [3e16, 1.0, 0.0, 0.0]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    whole = [[int(min(max(np.floor(np.float64(64) * x), -topk.LARGEST), topk.LARGEST)) for x in v] for v in rows]
    wanted = set()
    for q in range(0, 60, 20):
        scores = [(min(max(sum(a * b for a, b in zip(whole[q], v)), -(2**63)), 2**63 - 1), i) for i, v in enumerate(whole) if i != q]
        for rank, (score, i) in enumerate(sorted(scores, key=lambda s: (-s[0], s[1]))[:9], 1):
            wanted.add((q, rank, i, score))
    with np.errstate(over="ignore"):
        got = topk.top_k(df, df.where("vec_id % 20 = 0"), 9).select("query_id", "rank", "vec_id", "score").collect()
    assert {tuple(r) for r in got} == wanted and len(got) == 27
