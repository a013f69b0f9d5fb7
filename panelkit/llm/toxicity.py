"""Toxicity by non-negative learning from positive and unlabelled text.

Confirmed toxic documents are the positives; every other sampled text is unlabelled. A linear
classifier over five-byte runs of lower-cased text is trained in numpy on the risk estimate
that the class prior corrects and that is kept from going negative (Kiryo et al., 2017).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import LOWER, Finder, held_out, label_sample, mix, text_blocks, usable_labels
from panelkit.session import stage

POSITIVES = 4096
UNLABELLED = 8192
FEATURES = 512
GRAM = 5
#: Bytes that count as one kind of gap.
GAP = LOWER.copy()
GAP[list(b"\t\n\x0b\x0c\r !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = 32


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All five-byte runs of each text as numbers, and the text of each.

    Every text is taken as if a gap stood before and behind it.
    """
    n = len(offsets) - 1
    size = np.diff(offsets)
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    inside = np.arange(len(data)) + 2 * np.repeat(np.arange(n), size) + 1
    padded[inside] = GAP[data]
    wide = padded.astype(np.uint64)
    usable = max(0, len(wide) - GRAM + 1)
    out = np.zeros(usable, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | wide[i : i + usable]
    bounds = offsets + 2 * np.arange(n + 1)
    owner = np.repeat(np.arange(n), size + 2)
    fits = bounds[owner[:usable] + 1] >= np.arange(usable) + GRAM
    return out[fits], owner[:usable][fits]


def _distinct(gram: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's runs once."""
    out_gram, out_owner = [], []
    if len(gram):
        cut = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        for a, b in zip(cut, np.append(cut[1:], len(owner)), strict=True):
            found = np.unique(gram[a:b])
            out_gram.append(found)
            out_owner.append(np.full(len(found), owner[a]))
    if not out_gram:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out_gram), np.concatenate(out_owner)


@dataclass
class Model:
    """Weights of the chosen runs; ``prior`` is the assumed share of toxic text."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def finder(self):
        table = np.zeros(1 << 20, bool)
        table[_slot(self.features)] = True
        return table, Finder(self.features)

    def score(self, data, offsets, finder=None) -> np.ndarray:
        table, find = finder or self.finder()
        gram, owner = grams(data, offsets)
        near = np.flatnonzero(table[_slot(gram)])
        at = find.find(gram[near])
        hit = at >= 0
        owner, at = owner[near[hit]], at[hit]
        pairs = np.unique(owner * max(1, len(self.features)) + at)
        owner, at = np.divmod(pairs, max(1, len(self.features)))
        total = self.bias + np.bincount(owner, self.weights[at], len(offsets) - 1)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _slot(gram):
    return (mix(gram) >> np.uint64(44)).astype(np.int64)


def train(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, prior: float, width: int, steps: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), logistic loss.

    ``rows``, ``cols``: the present features of each example; ``positive``: which examples are
    confirmed. Where the bracket is negative its gradient is climbed instead, as the estimator asks.
    """
    n = len(positive)
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    np_, nu = max(1, positive.sum()), max(1, (~positive).sum())
    for step in range(1, steps + 1):
        f = b + np.bincount(rows, w[cols], n)
        p = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
        loss_minus = np.logaddexp(0, f)
        bracket = loss_minus[~positive].mean() - prior * loss_minus[positive].mean() if nu and positive.any() else 1.0
        if bracket >= 0:
            df = np.where(positive, prior * ((p - 1) - p) / np_, p / nu)
        else:
            df = np.where(positive, prior * p / np_, -p / nu)
        gw = np.bincount(cols, df[rows], width) + ridge * w
        gb = df.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        b -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-9)
    return w, b


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", n: int = 3, rest: int = 1, positives: int = POSITIVES, unlabelled: int = UNLABELLED, features: int = FEATURES) -> Model:
    """Fit on bounded samples outside the held-out fold: confirmed documents and unlabelled ones.

    The class prior is the share of toxic ones among the usable labels. The ``features`` runs that
    are most over-represented in the positives (three times at least) are kept. Without a confirmed document every
    score is near 0.
    """
    usable = usable_labels(labels, label, n, rest)
    totals = usable.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    none = Model(np.zeros(0, np.uint64), np.zeros(0), -10.0, 0.0)
    if not totals[1]:
        return none
    prior = min(0.9, max(0.005, totals[1] / totals[0]))
    confirmed = label_sample(labels.where(F.col(label) == 1), label, n, rest, positives)
    others = docs.where(F.col("doc_id").isNotNull() & ~held_out(n, rest)).select("doc_id").orderBy(F.xxhash64(F.lit("u"), "doc_id"), "doc_id").limit(unlabelled)
    chosen = (
        confirmed.select("doc_id", F.lit(True).alias("positive"))
        .unionByName(others.select("doc_id", F.lit(False).alias("positive")))
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("positive", F.col("text").cast("string").alias("text")).dropDuplicates()

    def take(batches):
        for batch in batches:
            flags = batch.column(0).to_numpy(zero_copy_only=False)
            for first, end, data, offsets in text_blocks(batch.column(1)):
                gram, owner = _distinct(*grams(data, offsets))
                at = np.append(0, np.cumsum(np.bincount(owner, minlength=end - first))).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(at), pa.array(gram.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(flags[first:end]), found], names=["positive", "grams"])

    sample = stage(rows.mapInArrow(take, "positive boolean, grams array<bigint>"), "toxicity-sample")

    def count(batches):
        for batch in batches:
            flag = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            lists = batch.column(1)
            owner = np.repeat(flag, np.diff(lists.offsets.to_numpy()))
            gram, at = np.unique(lists.values.to_numpy(zero_copy_only=False), return_inverse=True)
            yield pa.RecordBatch.from_pydict({"gram": gram, "p": np.bincount(at[owner], minlength=len(gram)), "u": np.bincount(at[~owner], minlength=len(gram))})

    sizes = dict(sample.groupBy("positive").count().collect())
    n_p, n_u = max(1, sizes.get(True, 0)), max(1, sizes.get(False, 0))
    least = max(5, n_p // 100)
    counted = sample.mapInArrow(count, "gram bigint, p bigint, u bigint").groupBy("gram").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    gain = F.col("p") / n_p - F.col("u") / n_u
    typical = F.col("p") / n_p > 3 * F.col("u") / n_u
    kept = [r[0] for r in counted.where((F.col("p") >= least) & typical).orderBy(F.desc(gain), "gram").limit(features).select("gram").collect()]
    if not kept:
        return none
    chosen_grams = np.sort(np.array(kept, np.int64)).astype(np.uint64)

    def present(batches):
        find = Finder(chosen_grams)
        for batch in batches:
            lists = batch.column(1)
            at = find.find(lists.values.to_numpy(zero_copy_only=False).astype(np.uint64))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            owner, at = owner[at >= 0], at[at >= 0]
            ends = np.append(0, np.cumsum(np.bincount(owner, minlength=batch.num_rows))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))], names=["positive", "at"])

    got = sample.mapInArrow(present, "positive boolean, at array<int>").toArrow()
    lists = got.column("at").combine_chunks()
    cols = lists.values.to_numpy(zero_copy_only=False).astype(np.int64)
    examples = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    positive = got.column("positive").to_numpy().astype(bool)
    w, b = train(examples, cols, positive, prior, len(chosen_grams))
    return Model(chosen_grams, w, b, prior)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` (all their columns) with ``score`` and ``predicted``.

    Every row is scored from its whole text alone; a null or empty text has no feature and gets
    the score of the bias. Repeated rows are scored alike; an empty table stays empty.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    place = keep.index("text")
    kinds = dict(docs.dtypes)

    def run(batches):
        finder = model.finder()
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(place)):
                p = model.score(data, offsets, finder)
                columns = [batch.column(i).slice(first, end - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    typed = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in keep])
    schema = ", ".join(f"`{c}` {'string' if c == 'text' else kinds[c]}" for c in keep)
    return typed.mapInArrow(run, schema + ", score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame, n: int = 3, rest: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; the model is fitted first."""
    model = fit(docs, labels, "toxic", n, rest)
    rows = docs.select("doc_id", held_out(n, rest).alias("held_out"), "text")
    return score(rows, model, threshold).drop("text")
