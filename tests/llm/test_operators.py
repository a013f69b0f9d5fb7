"""The text operators against brute force on small rows: nulls, empty and long texts, ties, repeats, clashing columns."""

from __future__ import annotations

import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import ctw, hilbert, langid, line_dedup, near_dedup, packing, pieces, quality, tokens, topk, toxicity
from panelkit.llm.common import text_blocks
from panelkit.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, sequence_id string"
LABELS = "doc_id long, quality int, toxic int, score double"
VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def words(seed, n, pool=400):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(pool)}" for _ in range(n)]


def awkward():
    """Null, empty, punctuation, very long, repeated rows, a null id."""
    base = " ".join(words(1, 80))
    rows = [
        (0, None, None, None, None), (1, "", "en", "s", 0), (2, "... !!", "en", "s", 6), (3, "word " * 8000, "en", "s", 1),
        (4, base, "en", "s", 1), (5, base, None, "s", 1), (5, base, None, "s", 1), (None, base + " tail", "en", "s", 1),
        (7, "日本語 ñ 'tis it's\n\n x", "ja", "s", 1), (8, "x", "en", "s", 1),
    ]
    return [(*r, 0.5, "clash") for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_exact_top_k(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(0, 0.2, 6)], 1, "z") for i in range(120)]
    rows += [(200, rows[0][1], 1, "z"), (201, None, 1, "z"), (202, [1.0, None], 1, "z"), (203, [float("nan")] * 6, 1, "z"), (204, [0.0] * 6, 1, "z"), (220, [], 1, "z")]
    df = spark.createDataFrame(rows, VECTORS)
    got = [tuple(r) for r in topk.top_k(df, df.where("vec_id % 20 = 0"), 7).orderBy("query_id", "rank").collect()]
    fine = {i: np.floor(64 * np.array(np.float32(v), np.float64)).astype(int) if v else np.zeros(6, int) for i, v, _, _ in rows if i not in (201, 202, 203)}
    want = []
    for q in sorted(x for x in fine if x % 20 == 0):
        best = sorted((-int(fine[q] @ fine[c]), c) for c in fine if c != q)[:7]
        want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    assert got == want
    none = spark.createDataFrame([], VECTORS)
    assert topk.top_k(none, none, 3).count() == 0


def test_quality_learns_and_handles_awkward_rows(spark, docs, empty):
    rnd = random.Random(5)
    rows = [(i, (" ".join(words(i, 60)) if i % 3 else "!! ".join(w.upper() for w in words(i, 60)) + " | |"), "en", "s", 1, 0.0, "c") for i in range(300)]
    labels = [(i, int(i % 3 > 0), 0, 0.1) for i in range(300)] + [(None, 1, 1, 0.1), (3, None, None, 0.1)]
    table, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    found = {r.doc_id: r for r in quality.quality(table, marks).collect()}
    held = [r for r in found.values() if r.held_out]
    assert len(found) == 300 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found.values())
    assert all(r.predicted == int(r.doc_id % 3 > 0) == int(r.score >= 0.7) for r in held)
    assert quality.quality(docs, marks).count() == 10 and quality.quality(empty, marks).count() == 0
    assert {r.score for r in quality.quality(docs, marks.limit(0)).collect()} == {0.5}
    del rnd


def test_flat_trees_match_a_walk():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(400, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit_trees(x, y, trees=30)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97

    def walk(row):
        total = model.base
        for feature, cut, value in zip(model.feature, model.cut, model.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > cut[node])
            total += value[node - len(feature)]
        return 1 / (1 + math.exp(-total))

    assert np.allclose(model.score(x[:20]), [walk(r) for r in x[:20]])


def test_toxicity_from_positives_and_unlabelled(spark, docs, empty):
    rows = [(i, " ".join([*words(i, 40), *(["vilest"] if i % 5 == 0 else []), *words(i + 1000, 40)]), "en", "s", 1, 0.0, "c") for i in range(600)]
    labels = [(i, 1, int(i % 5 == 0), 0.2) for i in range(0, 600, 2)]
    table, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    found = toxicity.toxicity(table, marks).collect()
    assert len(found) == 600 and all(r.predicted == int(r.score >= 0.7) for r in found)
    assert np.mean([r.predicted == int(r.doc_id % 5 == 0) for r in found if r.held_out]) > 0.97
    assert toxicity.toxicity(docs, marks).count() == 10 and toxicity.toxicity(empty, marks).count() == 0
    assert all(r.predicted == 0 for r in toxicity.toxicity(docs, marks.limit(0)).collect())


def test_network_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in langid._parameters(3, 4, rng).items()}
    codes, labels = rng.integers(97, 105, (6, 5)), rng.integers(0, 3, 5)
    _, g = langid.gradients(p, codes, labels)
    for name in p:
        flat = p[name].reshape(-1)
        for i in np.argsort(-np.abs(g[name].reshape(-1)))[:3]:
            old, step = flat[i], 1e-3
            flat[i] = old + step
            up = langid.gradients(p, codes, labels)[0]
            flat[i] = old - step
            down = langid.gradients(p, codes, labels)[0]
            flat[i] = old
            assert (up - down) / (2 * step) == pytest.approx(g[name].reshape(-1)[i], rel=0.05, abs=2e-4)


def test_language(spark, docs, empty):
    alphabets = {"aa": "abcde ", "zz": "vwxyz "}
    rnd = random.Random(4)
    rows = [(i, "".join(rnd.choice(alphabets[lang]) for _ in range(90)), lang, "s", 1, 0.0, "c") for i in range(300) for lang in [("aa", "zz")[i % 2]]]
    rows += [(900, None, "aa", "s", 1, 0.0, "c"), (901, "12 34 !", "zz", "s", 1, 0.0, "c"), (902, "vxzyvw" * 3000, None, "s", 1, 0.0, "c")]
    found = {r.doc_id: r for r in langid.language(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(found) == 303 and all(found[i].lang_pred == ("aa", "zz")[i % 2] for i in range(300))
    assert found[900].lang_pred == found[901].lang_pred == "und" and found[902].lang_pred == "zz"
    assert all(0 <= r.score <= 1 for r in found.values())
    assert langid.language(empty).count() == 0
    assert {r.lang_pred for r in langid.language(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def brute_lines(rows, least):
    """Deleted lines by comparing all pairs of places."""
    lines = [(d, i) for d, text in rows for i in range(len(text.split("\n")))]
    text = {d: [x.strip(" \t\r") for x in t.split("\n")] for d, t in rows}
    gone = set()
    for (a, i), (b, j) in itertools.combinations(lines, 2):
        n = 0
        while i + n < len(text[a]) and j + n < len(text[b]) and text[a][i + n] == text[b][j + n]:
            n += 1
        if sum(x.count(" ") + 1 for x in text[b][j : j + n]) >= least:
            gone |= {(b, j + k) for k in range(n)}
    return gone


def test_line_dedup_against_all_pairs(spark, docs, empty):
    rnd = random.Random(9)
    pool = ["a b c", "d e f g", "h i", "j", "", "k l m n o p", "q r s t u v w"]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.85 else f"own {i} {k}" for k in range(rnd.randrange(1, 14)))) for i in range(40)]
    rows += [(50, "same line\n" * 30 + "end")]
    table = spark.createDataFrame([(*r, "en", "s", 1, 0.0, "c") for r in rows], DOCS)
    gone = brute_lines(rows, 12)
    want = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}
    found = line_dedup.dedup_lines(table, 12).collect()
    assert {r.doc_id: r.text for r in found} == want and gone
    assert sum(r.dropped_lines for r in found) == len(gone)
    odd = line_dedup.dedup_lines(docs, 12).collect()
    assert len(odd) == 10 and [r.text for r in odd if r.doc_id == 0] == [None] and {r.text for r in odd if r.doc_id == 5} == {""}
    assert line_dedup.dedup_lines(empty).count() == 0


def test_segmentation_against_all_segmentations(spark, docs, empty):
    segmenter = pieces.Segmenter(tokenizer_path("piece_bpe_32k.model"), 4)
    table = segmenter.vocabulary

    def every(text):
        whole, out = (pieces.MARK + text.replace(" ", pieces.MARK) if text else ""), []

        def go(i, score, ids):
            if i == len(whole):
                out.append(score)
                return
            for j in range(i + 1, min(len(whole), i + table.longest) + 1):
                if whole[i:j] in table.lookup:
                    go(j, score + table.lookup[whole[i:j]][1], ids)
            if whole[i] not in table.lookup:
                go(i + 1, score + table.unknown, ids)

        go(0, 0.0, [])
        return sorted(out, reverse=True)[:4]

    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abcdet  éß\n日q'") for _ in range(rnd.randrange(10))) for _ in range(120)]
    for text, found in zip(texts, segmenter.encode(texts), strict=True):
        assert [s for s, _ in found] == pytest.approx(every(text))
        assert len({tuple(i) for _, i in found}) == len(found) and all(table.decode(i) == text for _, i in found)
    rows = pieces.segment(docs, tokenizer_path("piece_bpe_32k.model"), 2)
    back = pieces.decode(rows, tokenizer_path("piece_bpe_32k.model")).join(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).distinct(), "doc_id")
    assert back.where("decoded <> t").count() == 0 and back.count() == 16  # one each of two empty texts, two each of the seven others
    assert pieces.segment(empty, tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    element = np.unique(rng.integers(0, 2**39, 400)).astype(np.uint64)
    a, b = rng.integers(1, 6, len(element)).astype(float), rng.integers(0, 6, len(element)).astype(float)
    kept = b > 0
    text = np.concatenate([np.zeros(len(a), int), np.ones(kept.sum(), int)])
    marks = near_dedup.signatures(text, np.concatenate([element, element[kept]]), np.concatenate([a, b[kept]]), 2, 4000)
    assert (marks[0] == marks[1]).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)


def test_near_classes_against_all_pairs(spark, docs, empty, monkeypatch):
    rnd = random.Random(2)
    rows = []
    for group in range(12):
        base = words(group, 120, 5000)
        for copy in range(8):
            own = list(base)
            for _ in range(copy % 4):
                own[rnd.randrange(len(own))] = f"x{rnd.random()}"
            rows.append((group * 10 + copy, " ".join(own)))
    rows += [(500, "a b"), (501, "A, b!"), (502, "a c")]
    sets = {}
    for i, text in rows:
        for _, _, data, offsets in text_blocks(__import__("pyarrow").array([text])):
            _, e, w, _, _ = near_dedup.shingles(data, offsets)
            sets[i] = np.repeat((e >> np.uint64(8)).astype(np.uint32), w)
    root = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        both = near_dedup.shared(sets[a], sets[b])
        if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    table = spark.createDataFrame([(*r, "en", "s", 1, 0.0, "c") for r in rows], DOCS)
    assert {r.doc_id: r.class_id for r in near_dedup.near_classes(table).collect()} == root
    monkeypatch.setattr(near_dedup, "PAIRS", 0.01)  # the rounds of hubs alone
    monkeypatch.setattr(near_dedup, "HUBS", 2)
    assert {r.doc_id: r.class_id for r in near_dedup.near_classes(table).collect()} == root
    odd = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    assert odd == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 7: 7, 8: 8}
    assert near_dedup.near_classes(empty).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    order = cells[np.argsort(hilbert.hilbert_keys(cells, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_curves_find_the_neighbours(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rnd.normal(size=16)], 1, "z") for i in range(600)]
    rows += [(1000 + i, rows[50][1], 1, "z") for i in range(30)] + [(2000, [0.0] * 16, 1, "z"), (2050, None, 1, "z"), (2100, [None] * 16, 1, "z")]
    df = spark.createDataFrame(rows, VECTORS)
    found = hilbert.neighbours(df, df.where("vec_id % 50 = 0"), 5).collect()
    unit = {i: np.float64(np.float32(v)) / np.linalg.norm(np.float64(np.float32(v))) for i, v, _, _ in rows[:630]}
    want = {q: sorted((-round(float(unit[q] @ unit[c]), 9), c) for c in unit if c != q)[:5] for q in unit if q % 50 == 0}
    got = {q: [(-round(r.score, 9), r.vec_id) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in want}
    assert len(found) == 5 * len(want)
    assert np.mean([x in want[q] for q in want for x in got[q]]) >= 0.9
    assert got[50] == want[50] and got[1000] == want[1000]
    none = spark.createDataFrame([], VECTORS)
    assert hilbert.neighbours(none, none).count() == 0


def test_ids_are_those_of_the_tokenizer():
    encoder = tokens.Encoder(tokenizer_path())
    rnd = random.Random(3)
    signs = ["a", "B", "é", "1", " ", "  ", "\n", "\t", "'", "'s", "'re", "'LL", "!", "\xa0", " '", "''", "it's", "²", "日", "<|endoftext|>", "\x85", "\r\n", "'m "]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randrange(14))) for _ in range(3000)]
    ids, counts = encoder.encode(texts)
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_keeps_every_id_once(spark, docs, empty):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    more = spark.createDataFrame([(100 + i, " ".join(words(i, 30 * i)), "en", "s", 1, 0.0, "c") for i in range(60)], DOCS)
    rows = packing.pack(docs.where("doc_id is not null and doc_id <> 5").unionByName(more).repartition(5, "doc_id"), tokenizer_path(), 256, 3).collect()
    texts = {r.doc_id: r.text or "" for r in docs.unionByName(more).collect()}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, own in by_doc.items():
        want = [*plain.encode(texts[doc], add_special_tokens=False).ids, 1]
        own.sort(key=lambda r: r.start)
        assert b"".join(r.ids for r in own) == np.array(want, "<u4").tobytes() and {r.doc_tokens for r in own} == {len(want)}
        assert [r.start for r in own] == [0, *itertools.accumulate(r.length for r in own)][:-1]
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *itertools.accumulate(r.length for r in own)][:-1]
        total = sum(r.length for r in own)
        assert total == 256 or total & (total - 1) == 0 and total < 256
    assert len(by_doc) == 67 and packing.pack(empty, tokenizer_path()).count() == 0
    assert packing.pack(docs, tokenizer_path()).where("doc_id = 5 and start = 0").count() == 2


def test_context_tree_against_a_plain_recursion(spark, docs, empty):
    rows = [(i, "ab" * (i % 7) + "c " + "banana " * (i % 3), "en", "s", 1, 0.0, "c") for i in range(40)]
    table = docs.unionByName(spark.createDataFrame(rows, DOCS).withColumn("doc_id", F.col("doc_id") + 100))
    texts = [(r.doc_id, (r.text or "").encode()) for r in table.collect()]
    lower = lambda t: bytes(c + 32 if 65 <= c < 91 else c for c in t)
    learns = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 != 2
    counts, tokens_ = {}, {}
    for d, t in texts:
        if learns(d):
            t = lower(t)
            for w in t.split():
                tokens_[w] = tokens_.get(w, 0) + 1
            for i in range(len(t)):
                before = (b"\0" * ctw.DEPTH + t)[i : i + ctw.DEPTH]
                for k in range(8):
                    m, bit = (t[i] | 256) >> (8 - k), t[i] >> (7 - k) & 1
                    for depth in range(ctw.DEPTH + 1):
                        counts.setdefault((before[ctw.DEPTH - depth :], m), [0, 0])[bit] += 1
    children = {}
    for x, m in counts:
        if x:
            children.setdefault((x[1:], m), []).append((x, m))
    weighted = {}
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    for key in sorted(counts, key=lambda k: -len(k[0])):
        own = kt(*counts[key])
        weighted[key] = own if len(key[0]) == ctw.DEPTH else math.log(0.5) + np.logaddexp(own, sum(weighted[c] for c in children[key]))

    def chance(before, m):
        total, left, last = 0.0, 1.0, 0.5
        for depth in range(ctw.DEPTH + 1):
            key = (before[ctw.DEPTH - depth :], m)
            if key not in counts:
                break
            a, b = counts[key]
            last = total + left * (b + 0.5) / (a + b + 1)
            share = math.exp(kt(a, b) + math.log(0.5) - weighted[key])
            total, left = total + left * share * (b + 0.5) / (a + b + 1), left * (1 - share)
        return last

    ends = sum(learns(d) for d, _ in texts)
    n, v = sum(tokens_.values()) + ends, len(tokens_) + 1
    found = sorted(map(tuple, ctw.score(table).collect()), key=str)
    want = []
    for d, t in texts:
        t = lower(t)
        score = 0.0
        for i in range(len(t)):
            before = (b"\0" * ctw.DEPTH + t)[i : i + ctw.DEPTH]
            for k in range(8):
                p = chance(before, (t[i] | 256) >> (8 - k))
                score += math.log10(p if t[i] >> (7 - k) & 1 else 1 - p)
        own = t.split()
        base = sum(math.log10((tokens_.get(w, 0) + 1) / (n + v + 1)) for w in own) + math.log10((ends + 1) / (n + v + 1))
        want.append((d, not learns(d), len(own) + 1, sum(w in tokens_ for w in own) + 1, n, base, score))
    want.sort(key=str)
    for a, b in zip(found, want, strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6, abs=1e-6)
    assert ctw.score(empty).count() == 0
