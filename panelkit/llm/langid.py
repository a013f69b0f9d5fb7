"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time on bounded samples of windows,
labels every byte position of a text, and pools the positions' probabilities per document.
Gates use a straight-line sigmoid and the state a softsign, which cost a fraction of exp.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import held_out, text_blocks
from panelkit.session import stage

HIDDEN = 8
WINDOW = 32
WINDOWS = 2000
STRIDE = 64
LANES = 4096


@dataclass
class Network:
    """Input tables (3 gates, byte), recurrent weights of both directions, and the output layer; units first."""

    languages: list[str]
    tables: list[np.ndarray]
    recurrent: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray

    def states(self, codes: np.ndarray, direction: int) -> np.ndarray:
        """Hidden states (time, unit, lane); direction 1 runs from the end."""
        steps, lanes = codes.shape
        table, recurrent = self.tables[direction], self.recurrent[direction]
        size = recurrent.shape[1]
        h = np.zeros((size, lanes), np.float32)
        out = np.empty((steps, size, lanes), np.float32)
        a, u = np.empty((3 * size, lanes), np.float32), np.empty((3 * size, lanes), np.float32)
        zr, z, r, c, uc = a[: 2 * size], a[:size], a[size : 2 * size], a[2 * size :], u[2 * size :]
        side = np.empty((size, lanes), np.float32)
        for t in range(steps) if direction == 0 else range(steps - 1, -1, -1):
            np.take(table, codes[t], axis=1, out=a, mode="clip")
            np.matmul(recurrent, h, out=u)
            zr += u[: 2 * size]
            zr *= 0.25
            zr += 0.5
            np.clip(zr, 0, 1, out=zr)
            uc *= r
            c += uc
            np.abs(c, out=side)
            side += 1
            c /= side
            c -= h
            c *= z
            h += c
            out[t] = h
        return out

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Language probabilities of every position (time, language, lane)."""
        size = self.recurrent[0].shape[1]
        logits = np.matmul(self.output[:, :size], self.states(codes, 0))
        logits += np.matmul(self.output[:, size:], self.states(codes, 1))
        logits += self.bias[:, None]
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over all positions of each text; zeros for an empty one.

        Texts are cut into strips that run side by side; every byte is labelled once.
        """
        n = len(offsets) - 1
        size = np.diff(offsets)
        strips = -(-size // STRIDE)
        doc = np.repeat(np.arange(n), strips)
        first = np.cumsum(strips) - strips
        begin = offsets[doc] + STRIDE * (np.arange(len(doc)) - first[doc])
        length = np.minimum(STRIDE, offsets[doc + 1] - begin)
        total = np.zeros((n, len(self.languages)))
        padded = np.append(data, np.full(STRIDE, 32, np.uint8))
        steps = np.arange(STRIDE)[:, None]
        for at in range(0, len(doc), LANES):
            lanes = slice(at, at + LANES)
            real = steps < length[None, lanes]
            codes = np.where(real, padded[begin[None, lanes] + steps], 32)
            p = self.probabilities(codes)
            p *= real[:, None, :]
            strip = p.sum(0).astype(np.float64)
            for i in range(len(strip)):
                total[:, i] += np.bincount(doc[lanes], strip[i], n)
        return total / np.maximum(size, 1)[:, None]


def _parameters(languages: int, hidden: int, rng) -> dict[str, np.ndarray]:
    scale = 1 / np.sqrt(hidden)
    new = {}
    for d in (0, 1):
        new[f"table{d}"] = rng.normal(0, 0.3, (3 * hidden, 256))
        new[f"recurrent{d}"] = rng.normal(0, scale, (3 * hidden, hidden))
    new["output"] = rng.normal(0, scale, (languages, 2 * hidden))
    new["bias"] = np.zeros(languages)
    return {k: v.astype(np.float32) for k, v in new.items()}


def gradients(p: dict[str, np.ndarray], codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions, and its gradients by backpropagation through time.

    ``codes``: bytes (time, lane); ``labels``: the language of each lane.
    """
    steps, lanes = codes.shape
    hidden = p["recurrent0"].shape[1]
    tapes, states = [], []
    for d in (0, 1):
        h = np.zeros((hidden, lanes), np.float32)
        tape, out = [None] * steps, np.empty((steps, hidden, lanes), np.float32)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            a, u = p[f"table{d}"][:, codes[t]], p[f"recurrent{d}"] @ h
            pre = a[: 2 * hidden] + u[: 2 * hidden]
            gates = np.clip(0.25 * pre + 0.5, 0, 1)
            z, r, uc = gates[:hidden], gates[hidden:], u[2 * hidden :]
            inner = a[2 * hidden :] + r * uc
            c = inner / (1 + np.abs(inner))
            tape[t] = (h, pre, z, r, uc, inner, c)
            h = h + z * (c - h)
            out[t] = h
        tapes.append(tape)
        states.append(out)
    both = np.concatenate(states, 1)
    q = p["output"] @ both + p["bias"][:, None]
    q -= q.max(1, keepdims=True)
    np.exp(q, out=q)
    q /= q.sum(1, keepdims=True)
    lane = np.arange(lanes)
    loss = -np.log(q[:, labels, lane] + 1e-9).mean()
    q[:, labels, lane] -= 1
    q /= steps * lanes
    g = {"bias": q.sum((0, 2)), "output": np.tensordot(q, both, ((0, 2), (0, 2)))}
    dboth = p["output"].T @ q
    for d in (0, 1):
        rec, drec = p[f"recurrent{d}"], np.zeros_like(p[f"recurrent{d}"])
        da = np.empty((steps, 3 * hidden, lanes), np.float32)
        dh = np.zeros((hidden, lanes), np.float32)
        for t in range(steps - 1, -1, -1) if d == 0 else range(steps):
            h, pre, z, r, uc, inner, c = tapes[d][t]
            dh = dh + dboth[t, d * hidden : (d + 1) * hidden]
            dinner = dh * z / (1 + np.abs(inner)) ** 2
            da[t, :hidden] = dh * (c - h)
            da[t, hidden : 2 * hidden] = dinner * uc
            da[t, : 2 * hidden] *= 0.25 * (np.abs(pre) < 2)
            da[t, 2 * hidden :] = dinner
            du = da[t].copy()
            du[2 * hidden :] *= r
            drec += du @ h.T
            dh = dh * (1 - z) + rec.T @ du
        at = codes.reshape(-1)
        rows = da.transpose(1, 0, 2).reshape(3 * hidden, -1)
        g[f"table{d}"] = np.stack([np.bincount(at, row, 256) for row in rows]).astype(np.float32)
        g[f"recurrent{d}"] = drec
    return float(loss), g


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = 220, lanes: int = 256, rate: float = 0.03, seed: int = 5) -> Network:
    """Adam over random batches of windows (example, byte), equally many per language."""
    rng = np.random.default_rng(seed)
    p = _parameters(len(languages), hidden, rng)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    by = [np.flatnonzero(labels == i) for i in range(len(languages))]
    for step in range(1, steps + 1):
        kind = rng.integers(0, len(languages), lanes)
        pick = np.array([by[i][rng.integers(len(by[i]))] for i in kind])
        _, g = gradients(p, windows[pick].T, kind)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            now = rate * min(1.0, 2 * (1 - step / steps) + 0.02)
            p[k] -= now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return Network(languages, [p["table0"], p["table1"]], [p["recurrent0"], p["recurrent1"]], p["output"], p["bias"])


def fit(docs: DataFrame, n: int = 5, rest: int = 0, windows: int = WINDOWS, window: int = WINDOW) -> Network | None:
    """Fit on about ``windows`` windows of ``window`` bytes per language, outside the held-out fold.

    Documents are drawn by the hash of id and text, in proportion to what their language needs, and
    their window lies at a hashed place of the text. Rows equal in id, text and lang count as one, and every language
    gets the document of the lowest hash at least. Only text and non-null lang are read. The
    languages are all values of lang; without any there is no network.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(n, rest)).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("key")
    )
    uniform = lambda name: F.pmod(F.xxhash64("key", F.lit(name)), F.lit(1_000_000)) / 1_000_000
    draw = uniform("window")
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("key").alias("n"), F.min(draw).alias("least"))
    wanted = F.broadcast(counts.select("lang", F.greatest(F.lit(float(windows)) / F.col("n"), "least").alias("share")))
    chosen = usable.join(wanted, "lang").where(draw <= F.col("share"))

    def cut(batches):
        for batch in batches:
            places = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
            names, out = [], []
            for first, end, data, offsets in text_blocks(batch.column(1)):
                for i in range(first, end):
                    text = data[offsets[i - first] : offsets[i - first + 1]]
                    start = int(places[i] * max(1, len(text) - window + 1))
                    part = text[start : start + window]
                    names.append(i)
                    out.append(part.tobytes().ljust(window, b" "))
            at = pa.array(names, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(3).take(at), pa.array(out, pa.binary())], names=["lang", "key", "part"])

    cuts = chosen.select("lang", "text", uniform("place").alias("at"), "key").mapInArrow(cut, "lang string, key bigint, part binary")
    sample = stage(cuts.dropDuplicates(["lang", "key"]).drop("key"), "language-windows")
    got = sample.orderBy("lang", "part").toArrow()
    if not got.num_rows:
        return None
    names = got.column("lang").to_pylist()
    languages = sorted(set(names))
    number = {lang: i for i, lang in enumerate(languages)}
    bytes_ = np.frombuffer(b"".join(got.column("part").to_pylist()), np.uint8).reshape(-1, window)
    return train(bytes_, np.array([number[x] for x in names]), languages)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` (all their columns) with ``lang_pred`` and ``score``.

    A null text, or one without a letter, gets ``und`` and score 0; so does every text where no
    network could be learned. All other texts get the learned language with the highest mean
    probability over all bytes (ties to the first name) and that mean.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    place = keep.index("text")
    kinds = dict(docs.dtypes)

    def run(batches):
        names = np.array(network.languages if network else ["und"], object)
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(place)):
                text = batch.column(place).slice(first, end - first)
                letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                if network is None:
                    letters = np.zeros(end - first, bool)
                    p = np.zeros((end - first, 1))
                else:
                    p = network.pooled(data, offsets)
                top = p.argmax(1)
                value = np.where(letters, np.clip(p[np.arange(len(p)), top], 0, 1), 0.0)
                label = np.where(letters, names[top], "und")
                columns = [batch.column(i).slice(first, end - first) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(label, pa.string()), pa.array(value)], names=[*keep, "lang_pred", "score"])

    typed = docs.select(*[F.col(f"`{c}`").cast("string").alias(c) if c == "text" else F.col(f"`{c}`") for c in keep])
    schema = ", ".join(f"`{c}` {'string' if c == 'text' else kinds[c]}" for c in keep)
    return typed.mapInArrow(run, schema + ", lang_pred string, score double")


def language(docs: DataFrame, n: int = 5, rest: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; the network is trained first."""
    network = fit(docs, n, rest)
    rows = docs.select("doc_id", held_out(n, rest).alias("held_out"), "text")
    return predict(rows, network).drop("text")
