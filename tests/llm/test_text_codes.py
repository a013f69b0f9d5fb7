"""Byte-level BPE, fill-in-middle and ranked search against the tokenizer's library, plain Python and exhaustive scoring."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from panelkit.llm import byte_bpe, fim, fp_tree
from panelkit.llm.common import text_bytes

DOCS = "doc_id long, text string, n long, form string, ids binary, score double"
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark, rows):
    return spark.createDataFrame([(d, t, 1, "clash", b"x", 0.5) for d, t in rows], DOCS)


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


SIGNS = [*"aabcstmdrevl'''    \n\t !?.,123é日本😀 ñ ́", "'s", "'re", "'ll", " '", "  ", "\n\n", "don't", "<|endoftext|>"]


def noise(seed, n):
    rnd = random.Random(seed)
    return "".join(rnd.choice(SIGNS) for _ in range(n))


def test_boundaries_are_those_of_the_pattern():
    import regex

    for seed in range(300):
        text = noise(seed, 80)
        data, offsets = text_bytes(pa.array([text]))
        found = byte_bpe.boundaries(data, offsets).tolist()
        assert found == [len(text[: m.start()].encode()) for m in regex.finditer(public_tokenizers.PATTERN, text)]


def test_every_code_point_has_the_class_of_the_library(library):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0]
    text = "".join(f"a{c}1{c} {c}" for c in every)
    data, offsets = text_bytes(pa.array([text]))
    assert byte_bpe.Encoder(byte_bpe.Vocabulary.load(PATH)).encode(data, offsets)[0].tolist() == library.encode_ordinary(text)


def test_byte_bpe_gives_the_ids_of_the_library(spark, library):
    texts = [noise(s, s % 90) for s in range(800)] + ["a" * 3000, " " * 5000, "日本" * 700, "ab'S", "don't", "\x00\x7f", "x" * 65, noise(1, 30_000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5000, None), (5001, ""), (None, "no id"), (3, texts[3])]
    for limit in (1 << 21, 512):
        encoded = byte_bpe.encode(table(spark, rows), PATH, limit=limit).cache()
        found = encoded.collect()
        assert len(found) == len(rows)
        want = Counter((d, np.array(library.encode_ordinary(t or ""), "<u4").tobytes()) for d, t in rows)
        assert Counter((r.doc_id, bytes(r.ids)) for r in found) == want
        assert all(r.n_tokens * 4 == len(r.ids) == len(r.ends) for r in found)
        text = dict(rows)
        for r in found[:50]:  # ends cut the text into the bytes of the ids
            at = np.append(0, np.frombuffer(r.ends, "<u4")).tolist()
            raw = (text[r.doc_id] or "").encode()
            assert [raw[a:b] for a, b in zip(at, at[1:])] == [library.decode_single_token_bytes(i) for i in np.frombuffer(r.ids, "<u4").tolist()]
        back = byte_bpe.decode(encoded, PATH).collect()
        assert Counter((r.doc_id, bytes(r.bytes).decode()) for r in back) == Counter((d, t or "") for d, t in rows)
        encoded.unpersist()
    empty = byte_bpe.encode(table(spark, []), PATH)
    assert empty.count() == 0 and byte_bpe.decode(empty, PATH).count() == 0


def test_cache_survives_colliding_keys_and_forgetting(vocabulary, library, monkeypatch):
    text = " ".join(noise(s, 12) for s in range(400))
    data, offsets = text_bytes(pa.array([text]))
    small = byte_bpe.Encoder(vocabulary, kept=50)
    for _ in range(3):
        assert small.encode(data, offsets)[0].tolist() == library.encode_ordinary(text)
    few = lambda sums, starts, ends: (ends - starts).astype(np.uint64)  # noqa: E731  every slice of one length collides
    monkeypatch.setattr(byte_bpe, "span_hashes", few)
    assert byte_bpe.Encoder(vocabulary).encode(data, offsets)[0].tolist() == library.encode_ordinary(text)


def test_heap_and_rounds_merge_alike(vocabulary):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeinorst") for _ in range(rnd.randrange(1, 60))).encode() for _ in range(300)]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    ids, count = vocabulary.merge_all(data, np.append(0, ends[:-1]), ends)
    parts = np.split(ids, np.cumsum(count)[:-1])
    assert [p.tolist() for p in parts] == [vocabulary.merge_one(w) for w in words]


def cut(doc_id, text, rate=100, spm=50):
    """Fill-in-middle in plain Python."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm = h4 % 100 < spm
    return doc_id, len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    rnd = random.Random(8)
    signs = ["a", "é", "😀", "\n", "\n", "$1", "\\", "%d", "<P", "<", "S>", "\r", " "]
    rows = [(i, "".join(rnd.choice(signs) for _ in range(rnd.randrange(0, 40)))) for i in range(300)]
    rows += [(300, None), (301, ""), (302, "x <S> y"), (303, "\n" * 200_000 + "end"), (304, "y" * 3_000_000), (None, "a\nb\nc"), (7, rows[7][1])]
    for rate, spm in ((100, 50), (40, 10)):
        found = fim.fill_in_middle(table(spark, rows), rate=rate, spm=spm)
        got = [tuple(r) for r in found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
        assert Counter(got) == Counter(cut(d, t, rate, spm) for d, t in rows)
        back = found.select("doc_id", fim.restored(found.form, found.output).alias("text")).collect()
        assert Counter(map(tuple, back)) == Counter((d, t or "") for d, t in rows)
    words = fim.fill_in_middle(table(spark, [(1, "100% of it, all\n")]), unit=r"\S+\s*|\s+").first()
    assert words.n == 4
    assert fim.fill_in_middle(table(spark, [])).count() == 0


def ranking(docs, items, k):
    """Every score by the formula, for all pairs."""
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    terms = lambda t: re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", (t or "").translate(low))
    docs = [(d, Counter(terms(t))) for d, t in docs]
    docs = [(d, c) for d, c in docs if c]
    total = sum(sum(c.values()) for _, c in docs)
    n_docs = len(docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for item, text in dict.fromkeys(items):
        if item is not None:
            asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for d, c in docs:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, times in own.items())
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def prose(seed, n, pool=60):
    rnd = random.Random(seed)
    return " ".join(f"{rnd.choice(['w', 'W', 'ñ'])}{int(rnd.paretovariate(0.7)) % pool}" for _ in range(n))


def test_ranked_search_is_exhaustive_scoring(spark):
    docs = [(i, prose(i, 1 + i % 70)) for i in range(400)]
    docs += [(1000 + i, prose(3, 50)) for i in range(90)]  # ties: one text under many ids
    docs += [(5, docs[5][1]), (None, prose(3, 50)), (None, None), (2000, ""), (2001, "!! -"), (2002, prose(9, 20_000)), (2003, "w" * 5000)]
    items = [(i, prose(1000 + i, 12)) for i in range(20)] + [(3, prose(1003, 12)), (3, "w1 w1"), (None, "w1"), (50, None), (51, "??"), (52, "absent1"), (53, "W1")]
    rows, asked = table(spark, docs), spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    want = ranking(docs, items, 10)
    for options in ({}, {"documents": 100, "leaf": 4}, {"entries": 40, "postings": 300}):
        assert sorted(map(tuple, fp_tree.search(rows, asked, 10, **options).collect())) == want
    assert fp_tree.search(table(spark, []), asked).count() == 0
    assert fp_tree.search(rows, asked.limit(0)).count() == 0


def test_long_texts_are_counted_in_parts():
    words = fp_tree.Terms(["w1", "zz"])
    data, offsets = text_bytes(pa.array(["w1 zz w1, " * 400 + "W1"]))
    whole = fp_tree.counted(words, data, offsets)
    parts = [fp_tree.counted(words, a, b) for a, b in fp_tree.shortened(data, offsets, 37)]
    assert sum(int(n.sum()) for n, *_ in parts) == whole[0][0] == 1201
    assert sum(int(tf[term == 0].sum()) for _, _, term, tf in parts) == 801 and len(parts) > 50


def test_terms_of_one_key_are_told_apart(monkeypatch):
    monkeypatch.setattr(fp_tree, "span_hashes", lambda sums, starts, ends: np.full(len(starts), 7, np.uint64))
    words = fp_tree.Terms(["ab", "cd", "efg"])
    data, _ = text_bytes(pa.array(["cdefgabxy"]))
    assert words.find(data, np.array([0, 2, 5, 7]), np.array([2, 5, 7, 9])).tolist() == [1, 2, 0, -1]


def test_subtree_bounds_hold_and_prune():
    rnd = np.random.default_rng(5)
    n, size = 600, 40
    docs = [np.unique(np.minimum(rnd.geometric(0.12, rnd.integers(1, 15)) - 1, size - 1)) for _ in range(n)]
    doc, term = np.repeat(np.arange(n), [len(d) for d in docs]), np.concatenate(docs)
    tf, m = rnd.integers(1, 9, len(doc)), rnd.integers(25, 400, n)
    tree = fp_tree.Tree(m, doc, term, tf, leaf=4)
    for node, own in enumerate(tree.children):
        if own:
            assert [tree.low[c] for c in own] == [tree.low[node], *[tree.high[c] for c in own[:-1]]] and tree.high[own[-1]] == tree.high[node]
        part = slice(tree.begin[tree.low[node]], tree.begin[tree.high[node]])
        most = {int(t): int(tree.tf[part][tree.term[part] == t].max()) for t in np.unique(tree.term[part])}
        assert dict(zip(tree.terms[node].tolist(), tree.most[node].tolist(), strict=True)) == most
        assert tree.least[node] == tree.m[tree.low[node] : tree.high[node]].min()
    search = fp_tree.Search(np.array([2]), np.array([37, 38]), np.array([900, 800]), size, 3)
    search.walk(tree, list(range(n)))
    assert 0 < search.visited < len(tree.children) / 2
