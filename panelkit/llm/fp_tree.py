"""Ranked lexical search over document FP-trees with branch and bound.

Documents keep only the terms that some item asks for, as vectors (term, tf) in the order of falling document frequency.
Blocks of such vectors become FP-trees: documents with a common beginning share the path to it, unbranched paths are one
node, and small subtrees are leaves of a few documents. A node holds, for its whole subtree, the largest tf of
every term in it and the smallest m. Both bound what any document below can score, since a score grows with tf and falls
with m. The tree is walked depth-first, best child first; every item has its own bound and its own k-th best
score, and leaves a subtree out once its bound is below that score.

Items are taken in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import BLOCK_BYTES, BYTE_CODES, IS_WORD, LOWER, Finder, ragged, running_hash, span_hashes, spans, text_blocks
from panelkit.session import stage

#: Fixed values of the contract: how scores and document lengths weigh.
SCALE, LENGTH_SHARE = 1000, 75
#: A maximal run of digits, letters and signs beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Different terms of items in one block (a single item may have more), documents and postings in one tree, documents in one leaf.
ENTRIES, DOCUMENTS, POSTINGS, LEAF = 1 << 18, 8192, 1 << 20, 32
#: Branchings above a node beyond which it is cut into leaves at once.
DEPTH = 64


def weight(n_docs: int, df: int) -> int:
    """The weight of a term that ``df`` of ``n_docs`` documents hold."""
    return math.floor(SCALE * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m from its number of terms."""
    if len(n) and LENGTH_SHARE * int(n.max()) * n_docs >= 2**63:
        return np.array([100 - LENGTH_SHARE + LENGTH_SHARE * int(x) * n_docs // n_terms for x in n], np.int64)
    return 100 - LENGTH_SHARE + LENGTH_SHARE * n.astype(np.int64) * n_docs // max(1, n_terms)


def gain(tf: np.ndarray, m) -> np.ndarray:
    """What a term that occurs ``tf`` times adds for each unit of its weight; grows with tf, falls with m."""
    return SCALE**3 * tf // (SCALE * tf + 8 * m)


# --- items ---------------------------------------------------------------------------------------------------------


def item_terms(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term, times) of every item, terms by SQL functions. Rows without an id are left out, equal rows count once."""
    upper = "".join(chr(c) for c in range(65, 91))
    rows = items.select(F.col(f"`{id}`").cast("long").alias("item"), F.col(f"`{text}`").cast("string").alias("text")).where("item is not null").distinct()
    terms = F.regexp_extract_all(F.translate("text", upper, upper.lower()), F.lit(TERM), 0)
    return rows.select("item", F.explode(terms).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


class Terms:
    """A block's vocabulary: finds byte strings in texts by hash, and compares them byte for byte."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        length = np.array([len(r) for r in raw], np.int64)
        first = np.cumsum(length) - length
        data = np.frombuffer(b"".join(raw), np.uint8)
        keys = span_hashes(running_hash(BYTE_CODES[data]), first, first + length)
        # terms of one key (there should be none) are tried one after the other
        order = np.lexsort((np.arange(len(keys)), keys))
        self.keys, start = np.unique(keys[order], return_index=True)
        self.groups = np.append(start, len(keys))
        self.order, self.data, self.first, self.length = order, data, first, length
        self.finder = Finder(self.keys)

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each span's term, -1 where it is no term of the block."""
        out = np.full(len(starts), -1, np.int64)
        if not len(starts) or not len(self.keys):
            return out
        at = self.finder.find(span_hashes(running_hash(BYTE_CODES[data]), starts, ends))
        open_ = np.flatnonzero(at >= 0)
        turn = self.groups[at[open_]]
        while len(open_):
            term = self.order[turn]
            length = ends[open_] - starts[open_]
            same = self.length[term] == length
            fits = np.flatnonzero(same)
            size, step = length[fits], ragged(length[fits])
            differs = data[np.repeat(starts[open_[fits]], size) + step] != self.data[np.repeat(self.first[term[fits]], size) + step]
            same[fits] = np.add.reduceat(differs, np.cumsum(size) - size) == 0 if len(fits) else False
            out[open_[same]] = term[same]
            turn = turn + 1
            more = ~same & (turn < self.groups[at[open_] + 1])
            open_, turn = open_[more], turn[more]
        return out


# --- documents -----------------------------------------------------------------------------------------------------


def shortened(data: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, offsets) of a block as it is, or of a long text in parts cut between terms."""
    done = 0
    while len(data) - done > limit:
        cut = np.flatnonzero(~IS_WORD[data[done : done + limit]])
        if len(cut):
            end = done + int(cut[-1]) + 1
        else:
            later = np.flatnonzero(~IS_WORD[data[done + limit :]])
            end = done + limit + int(later[0]) + 1 if len(later) else len(data)
        yield data[done:end], np.array([0, end - done])
        done = end
    yield (data, offsets) if not done else (data[done:], np.array([0, len(data) - done]))


def counted(vocabulary: Terms, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each text, and doc, term, tf of the vocabulary's terms in them, sorted by doc and term)."""
    low = LOWER[data]
    starts, ends, owner = spans(IS_WORD[low], offsets)
    n = np.bincount(owner, minlength=len(offsets) - 1)
    term = vocabulary.find(low, starts, ends)
    hit = term >= 0
    size = len(vocabulary.length) or 1
    key, tf = np.unique(owner[hit] * size + term[hit], return_counts=True)
    return n, key // size, key % size, tf


VECTORS = "doc_id long, n long, terms binary, tfs binary"


def vectors(docs: DataFrame, terms: list[str], limit: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with at least one term; numbers of ``terms`` and their tf as little-endian 64-bit lists."""

    def run(batches):
        vocabulary = Terms(terms)
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, offsets in text_blocks(batch.column(1), limit):
                if b - a > 1 or len(data) <= limit:
                    n, doc, term, tf = counted(vocabulary, data, offsets)
                else:  # one long text: its parts add up
                    n, sums = np.zeros(1, np.int64), np.zeros(len(terms), np.int64)
                    for part, cut in shortened(data, offsets, limit):
                        some, _, t, f = counted(vocabulary, part, cut)
                        n += some.sum()
                        sums[t] += f
                    term = np.flatnonzero(sums)
                    tf, doc = sums[term], np.zeros(len(term), np.int64)
                upto = np.searchsorted(doc, np.arange(len(n) + 1)).tolist()
                term, tf = (np.ascontiguousarray(x, "<i8").tobytes() for x in (term, tf))
                lists = [pa.array([x[8 * i : 8 * j] for i, j in zip(upto[:-1], upto[1:], strict=True)], pa.binary()) for x in (term, tf)]
                found = pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"])
                yield found.filter(pa.array(n > 0))

    return docs.mapInArrow(run, VECTORS)


def frequencies(table: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """(documents, terms in all of them, document frequency of each of the ``size`` terms of the vocabulary)."""

    def run(batches):
        counts = np.zeros(size, np.int64)
        for batch in batches:
            raw = b"".join(batch.column(0).to_pylist())
            counts += np.bincount(np.frombuffer(raw, "<i8"), minlength=size)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"term": some, "df": counts[some]})

    found = table.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = np.zeros(size, np.int64)
    for term, n in table.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        df[term] = n
    return found[0], found[1], df


# --- trees ---------------------------------------------------------------------------------------------------------


class Tree:
    """The FP-tree of a block of documents.

    ``doc``, ``term``, ``tf``: the postings, sorted by document and then term, terms numbered by falling frequency.
    Nodes lie in an array, parents before their children. A leaf has no children but a range of the sorted documents.
    """

    def __init__(self, m: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, leaf: int = LEAF):
        n = len(m)
        at = np.searchsorted(doc, np.arange(n + 1))
        raw = term.astype(">u4").tobytes()
        paths = [raw[4 * i : 4 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        #: Documents in the order of their paths.
        self.order = np.array(sorted(range(n), key=paths.__getitem__), np.int64)
        length = np.diff(at)[self.order]
        self.begin = np.append(0, np.cumsum(length))
        source = np.repeat(at[self.order], length) + ragged(length)
        self.term, self.tf, self.m = term[source], tf[source], m[self.order]
        self.leaf = leaf
        self._branch(self._shared())
        self._bounds()

    def _shared(self) -> np.ndarray:
        """How many terms the path of each document shares with the one before it."""
        length = np.diff(self.begin)
        short = np.minimum(length[1:], length[:-1])
        step = ragged(short)
        differs = self.term[np.repeat(self.begin[:-2], short) + step] != self.term[np.repeat(self.begin[1:-1], short) + step]
        end = np.cumsum(short)
        # the first difference of each pair, or the whole shorter path
        where = np.where(differs, step, np.iinfo(np.int64).max)
        shared = short.copy()
        some = np.flatnonzero(short)
        if len(some):
            shared[some] = np.minimum(np.minimum.reduceat(where, (end - short)[some]), short[some])
        return np.append(-1, shared)

    def _branch(self, shared: np.ndarray):
        """Nodes as ranges of documents, cut where the paths part; neighbours too small for a node of their own share a leaf."""
        self.low, self.high, self.children = [0], [len(self.m)], [[]]
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            low, high = self.low[node], self.high[node]
            if high - low <= self.leaf:
                continue
            if depth >= DEPTH:
                cuts = list(range(low + self.leaf, high, self.leaf))
            else:
                inner = shared[low + 1 : high]
                cuts = (low + 1 + np.flatnonzero(inner == inner.min())).tolist()
            start, edges = low, [*cuts, high]
            pieces = []
            for i, edge in enumerate(edges):
                # take the next branch along while both fit a leaf
                if i + 1 < len(edges) and edges[i + 1] - start <= self.leaf:
                    continue
                pieces.append((start, edge))
                start = edge
            for a, b in pieces:
                self.low.append(a)
                self.high.append(b)
                self.children.append([])
                self.children[node].append(len(self.low) - 1)
                stack.append((len(self.low) - 1, depth + 1))

    def _bounds(self):
        """Subtree maxima of tf and minima of m, from the leaves up."""
        nodes = len(self.low)
        self.terms, self.most, self.least = [None] * nodes, [None] * nodes, [0] * nodes
        for node in range(nodes - 1, -1, -1):
            own = self.children[node]
            if own:
                term, tf = (np.concatenate([x[c] for c in own]) for x in (self.terms, self.most))
                self.least[node] = min(self.least[c] for c in own)
            else:
                part = slice(self.begin[self.low[node]], self.begin[self.high[node]])
                term, tf = self.term[part], self.tf[part]
                self.least[node] = int(self.m[self.low[node] : self.high[node]].min()) if self.high[node] > self.low[node] else 0
            rank = np.argsort(term, kind="stable")
            term, tf = term[rank], tf[rank]
            first = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
            self.terms[node], self.most[node] = term[first], np.maximum.reduceat(tf, first) if len(first) else tf


class Search:
    """The k best documents of every item of a block over all trees that it has walked."""

    def __init__(self, ends: np.ndarray, terms: np.ndarray, weights: np.ndarray, size: int, k: int):
        """``terms`` and ``weights`` (times in the item included) of all items in a row, each item's up to its entry in ``ends``."""
        self.begin, self.terms, self.weights, self.k = np.append(0, ends), terms, weights, k
        self.count = np.diff(self.begin)
        self.best: list[list] = [[] for _ in ends]  # (-score, has no id, id)
        self.least = np.ones(len(ends), np.int64)  # scores below this are of no use
        self.place = np.full(size, -1, np.int64)
        self.visited = 0

    def _entries(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of some items, and where those of each begin."""
        count = self.count[items]
        return np.repeat(self.begin[items], count) + ragged(count), np.cumsum(count) - count

    def _scores(self, node_terms: np.ndarray, gains: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Sums of weight x gain, one row per row of ``gains``, one column per item."""
        entry, first = self._entries(items)
        self.place[node_terms] = np.arange(len(node_terms))
        at = self.place[self.terms[entry]]
        self.place[node_terms] = -1
        wide = np.concatenate([gains, np.zeros((len(gains), 1), np.int64)], axis=1)  # a last column for terms that are not here
        return np.add.reduceat(wide[:, at] * self.weights[entry], first, axis=1)

    def _bound(self, tree: Tree, node: int, items: np.ndarray) -> np.ndarray:
        return self._scores(tree.terms[node], gain(tree.most[node], tree.least[node])[None, :], items)[0]

    def walk(self, tree: Tree, ids: list):
        """Depth first, best child first; ``ids``: the document ids in the order in which the tree was given them."""
        items = np.flatnonzero(self.count)
        if not len(items) or not len(tree.m):
            return
        stack = [(0, items, self._bound(tree, 0, items))]
        while stack:
            node, items, bound = stack.pop()
            alive = bound >= self.least[items]  # equal scores may still win by their id
            items = items[alive]
            if not len(items):
                continue
            self.visited += 1
            if not tree.children[node]:
                self._score_leaf(tree, node, items, ids)
                continue
            below = [(c, items, self._bound(tree, c, items)) for c in tree.children[node]]
            stack += sorted(below, key=lambda x: int(x[2].max()))

    def _score_leaf(self, tree: Tree, node: int, items: np.ndarray, ids: list):
        low, high = tree.low[node], tree.high[node]
        part = slice(tree.begin[low], tree.begin[high])
        row = np.repeat(np.arange(high - low), np.diff(tree.begin[low : high + 1]))
        gains = np.zeros((high - low, len(tree.terms[node])), np.int64)
        column = np.searchsorted(tree.terms[node], tree.term[part])
        gains[row, column] = gain(tree.tf[part], tree.m[low:high][row])
        score = self._scores(tree.terms[node], gains, items)
        where, who = np.nonzero((score >= self.least[items]).T)
        cut = np.flatnonzero(np.diff(where)) + 1
        for i, rows in zip(where[np.append(0, cut)].tolist() if len(where) else [], np.split(who, cut), strict=False):
            item = int(items[i])
            new = [(-int(score[r, i]), ids[d] is None, ids[d] or 0) for r, d in zip(rows.tolist(), tree.order[low + rows].tolist(), strict=True)]
            self.best[item] = sorted(self.best[item] + new)[: self.k]
            if len(self.best[item]) == self.k:
                self.least[item] = -self.best[item][-1][0]


def _searched(block: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, n_terms: int, df: np.ndarray, k: int, sizes: tuple[int, int, int]):
    """A task: trees of its documents, one at a time, each walked for all items of the block."""
    order = np.argsort(-df, kind="stable")  # number of the term that is first, second, .. by frequency
    by_frequency = np.empty(len(df), np.int64)
    by_frequency[order] = np.arange(len(df))
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    documents, postings, leaf = sizes

    def run(batches):
        ends = np.cumsum([len(t) for _, t, _ in block])
        terms = np.concatenate([t for _, t, _ in block])
        times = np.concatenate([n for _, _, n in block])
        search = Search(ends, by_frequency[terms], weights[terms] * times, len(df), k)
        ids, ns, vectors_, held = [], [], [], 0

        def grown():
            m = length_factor(np.array(ns, np.int64), n_docs, n_terms)
            length = np.array([len(t) // 8 for t, _ in vectors_], np.int64)
            doc = np.repeat(np.arange(len(ids)), length)
            term = by_frequency[np.frombuffer(b"".join(t for t, _ in vectors_), "<i8")]
            tf = np.frombuffer(b"".join(f for _, f in vectors_), "<i8")
            rank = np.lexsort((term, doc))
            search.walk(Tree(m, doc, term[rank], tf[rank], leaf), ids)

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for doc_id, n, t, f in zip(*columns, strict=True):
                ids.append(doc_id)
                ns.append(n)
                vectors_.append((t, f))
                held += len(t) // 8
                if len(ids) == documents or held >= postings:
                    grown()
                    ids, ns, vectors_, held = [], [], [], 0
        if ids:
            grown()
        rows = [(block[i][0], None if none else d, -s) for i, own in enumerate(search.best) for s, none, d in own]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["item_id", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, entries: int = ENTRIES, documents: int = DOCUMENTS, postings: int = POSTINGS, leaf: int = LEAF) -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1), doc_id, score.

    Only scores above 0 count; equal scores go by ascending doc_id, documents without an id last. Every row of ``docs``
    is a document (repeated rows are several), null and empty texts have no terms. An item is an id with the terms
    of its different rows; items without an id or without terms get no rows. Other columns are ignored. An
    empty table on either side gives no rows.

    Items are read in blocks of about ``entries`` terms, which alone reach the tasks; the documents' restricted vectors
    are written once a block. Each task sends at most ``k`` rows an item to the merge.
    """
    spark = docs.sparkSession
    asked = stage(item_terms(items), "fp-items")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    blocks = max(1, -(-asked.count() // entries))
    merged = None
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        if not rows:
            continue
        terms = sorted({r.term for r in rows})
        numbers = {t: i for i, t in enumerate(terms)}
        lists: dict[int, tuple[list, list]] = {}
        for item, term, times in rows:
            own = lists.setdefault(item, ([], []))
            own[0].append(numbers[term])
            own[1].append(times)
        block = [(item, np.array(t, np.int64), np.array(n, np.int64)) for item, (t, n) in sorted(lists.items())]
        table = stage(vectors(texts, terms), "fp-vectors")
        n_docs, n_terms, df = frequencies(table, len(terms))
        some = table.where(F.octet_length("terms") > 0)
        found = some.mapInArrow(_searched(block, n_docs, n_terms, df, k, (documents, postings, leaf)), "item_id long, doc_id long, score long")
        merged = found if merged is None else merged.unionByName(found)
    if merged is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
