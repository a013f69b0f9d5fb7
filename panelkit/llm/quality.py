"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of whole texts are taken in the tasks. The trees are fitted in numpy on a bounded
sample of labelled documents and flattened into arrays, which every task walks for all its
documents at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import (
    BLOCK_BYTES,
    IS_WORD,
    held_out,
    label_sample,
    list_array,
    mix,
    running_hash,
    span_hashes,
    spans,
    text_blocks,
)

SAMPLE = 20_000
CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "wide": range(128, 256),
    "blank": (9, 10, 13, 32),
    "stop": b".,;:?",
    "shout": b"!",
    "bar": b"|",
    "sign": b"#$%&*+/<=>@\\^_`~{}[]",
    "quote": b"\"'()-",
}
CLASS_OF = np.full(256, len(CLASSES), np.int64)
for _i, _codes in enumerate(CLASSES.values()):
    CLASS_OF[list(_codes)] = _i
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
WIDTH = len(CLASSES) + 1 + 17


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics for each text; an empty text gives zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    share = lambda a, b: a / np.maximum(b, 1)
    width = len(CLASSES) + 1
    kinds = np.bincount(text * width + CLASS_OF[data], minlength=n * width).reshape(n, width)
    out = [share(kinds[:, i], size) for i in range(width)]

    start, end, doc = spans(~BLANK[data], offsets)
    sums = running_hash(data)
    word = span_hashes(sums, start, end)
    words = np.bincount(doc, minlength=n)
    length = end - start
    mean = share(np.bincount(doc, length, n), words)
    out += [np.log1p(size), np.log1p(words), mean, share(np.bincount(doc, length**2, n), words) - mean**2]
    longest = np.zeros(n)
    np.maximum.at(longest, doc, length)
    out.append(np.log1p(longest))
    count = lambda flag: share(np.bincount(doc[flag], minlength=n), words)
    first, last = (data[start], data[end - 1]) if len(start) else (data[:0], data[:0])
    upper = np.cumsum(np.append(0, (data >= 65) & (data < 91)))
    lower = np.cumsum(np.append(0, (data >= 97) & (data < 123)))
    cased = lambda total: total[end] - total[start]
    out += [count(~IS_WORD[last]), count(~IS_WORD[first]), count(length <= 3), count((first >= 65) & (first < 91))]
    out.append(count((cased(upper) > 1) & (cased(lower) == 0)))
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
    out.append(count(same))
    out += list(_repeats(doc, word, n))

    start, end, doc = spans(data != 10, offsets)
    lines = np.bincount(doc, minlength=n)
    out += [np.log1p(lines), share(np.bincount(doc, end - start, n), lines), count_share(doc, (end - start) < 30, n, lines)]
    out.append(_repeats(doc, span_hashes(sums, start, end), n)[0])
    return np.column_stack(out).astype(np.float32)


def count_share(doc, flag, n, total):
    return np.bincount(doc[flag], minlength=n) / np.maximum(total, 1)


def _repeats(doc: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text the share of distinct keys among all, and the share of the most frequent key."""
    mixed = (doc.astype(np.uint64) << np.uint64(40)) | (mix(key) >> np.uint64(24))
    mixed.sort()
    first = np.flatnonzero(np.append(True, mixed[1:] != mixed[:-1])) if len(mixed) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(mixed)))
    owner = (mixed[first] >> np.uint64(40)).astype(np.int64)
    total = np.maximum(np.bincount(doc, minlength=n), 1)
    most = np.zeros(n)
    np.maximum.at(most, owner, times)
    return np.bincount(owner, minlength=n) / total, most / total


@dataclass
class Trees:
    """A boosted ensemble in flat arrays: node i of a tree has children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: float = 8.0) -> Trees:
    """Boosted trees with logistic loss, each split chosen from histograms of gradients over quantile bins.

    With no rows, or one class only, every score is the smoothed share of label 1.
    """
    n, width = x.shape if len(x) else (0, WIDTH)
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    nodes, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, nodes), np.int64)
    cut = np.full((trees, nodes), np.inf, np.float32)
    value = np.zeros((trees, leaves))
    if n == 0 or y.min() == y.max():
        return Trees(base, feature, cut, value, depth)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]).astype(np.float32)) for f in range(width)]
    binned = np.column_stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)])
    total = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            here = 2**level
            first = here - 1
            local = node - first
            gain = np.zeros(here)
            for f in range(width):
                cell = local * bins + binned[:, f]
                g = np.bincount(cell, gradient, here * bins).reshape(here, bins)
                w = np.bincount(cell, weight, here * bins).reshape(here, bins)
                gl, wl = np.cumsum(g, 1), np.cumsum(w, 1)
                gt, wt = gl[:, -1:], wl[:, -1:]
                better = gl**2 / (wl + ridge) + (gt - gl) ** 2 / (wt - wl + ridge) - gt**2 / (wt + ridge)
                better[(wl < least / 4) | (wt - wl < least / 4)] = 0
                better[:, len(edges[f]) :] = 0
                at = better.argmax(1)
                top = better[np.arange(here), at]
                won = np.flatnonzero(top > gain + 1e-9)
                gain[won] = top[won]
                feature[t, first + won] = f
                cut[t, first + won] = edges[f][at[won]]
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > cut[t, node])
        leaf = node - nodes
        g, w = np.bincount(leaf, gradient, leaves), np.bincount(leaf, weight, leaves)
        value[t] = rate * g / (w + ridge)
        total += value[t, leaf]
    return Trees(base, feature, cut, value, depth)


def document_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the statistics of each whole text, as one array column."""
    kept = docs.select(*keep, F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(len(keep))):
                rows = statistics(data, offsets)
                columns = [batch.column(i).slice(first, end - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, list_array(rows, WIDTH, pa.float32())], names=[*keep, "statistics"])

    kinds = dict(docs.dtypes)
    return kept.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", statistics array<float>")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", n: int = 4, rest: int = 2, sample: int = SAMPLE) -> Trees:
    """Fit on at most ``sample`` labelled documents outside the held-out fold (by lowest id hash)."""
    chosen = label_sample(labels, label, n, rest, sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = document_statistics(rows, ["label"]).toArrow()
    if not found.num_rows:
        return fit_trees(np.zeros((0, WIDTH), np.float32), np.zeros(0))
    x = found.column("statistics").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, WIDTH)
    y = found.column("label").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T[::-1], y))
    return fit_trees(x[order], y[order])


def score(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """``docs`` (all their columns but ``text``) with ``score`` and ``predicted``.

    Every row gets a score from its text alone; a null text counts as an empty one. Rows that
    repeat are scored alike, and an empty table gives an empty result.
    """
    keep = [c for c in docs.columns if c not in ("text", "score", "predicted")]

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(len(keep)), BLOCK_BYTES):
                p = model.score(statistics(data, offsets))
                columns = [batch.column(i).slice(first, end - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + (", " if keep else "") + "score double, predicted int"
    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, n: int = 4, rest: int = 2, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for every document; the model is fitted first.

    Only texts decide a score. With no usable label, all scores are one half.
    """
    model = fit(docs, labels, "quality", n, rest, sample)
    rows = docs.select("doc_id", held_out(n, rest).alias("held_out"), "text")
    return score(rows, model, threshold)

