"""SentencePiece encoding and decoding with the n best segmentations.

A text becomes the lattice of all pieces of a public vocabulary that fit somewhere. Forward Viterbi
gives the best score up to every position, which is an exact heuristic for a backward A* search: it
leaves the agenda with whole segmentations in the order of their scores. No piece crosses the front of a
blank, so a text's lattice is a chain of word lattices: Viterbi runs over all distinct words of a block at once, and
A* only over the words whose second-best segmentation is among the cheapest of the text.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import Finder, mix, ragged, running_hash, span_hashes, text_blocks

MARK = "▁"
# Fixed value: how far below the worst piece a character without a piece is scored.
UNKNOWN_PENALTY = 10.0
BLOCK = 1 << 20
N_BEST = 4
#: Characters beyond which a word is treated by itself.
LONG = 48


def _codes(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + np.uint64(17)) | np.uint64(1)


class Vocabulary:
    """Pieces, scores and byte pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(MARK in self.pieces[i].lstrip(MARK) for i in usable):
            raise ValueError("a piece crosses the front of a blank")
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.longest = max(len(self.pieces[i]) for i in usable)
        joined = "".join(self.pieces[i] for i in usable)
        size = np.array([len(self.pieces[i]) for i in usable])
        end = np.cumsum(size)
        keys = span_hashes(running_hash(_codes(np.frombuffer(joined.encode("utf-32-le"), np.uint32))), end - size, end)
        order = np.argsort(keys)
        self.ids = np.array(usable)[order]
        self.find = Finder(keys[order], 5).find
        self.scores = np.array([model.get_score(int(i)) for i in self.ids])
        self.unknown = float(min(self.scores[self.scores > -1e8].min(), 0.0)) - UNKNOWN_PENALTY
        self.lookup = {self.pieces[i]: (int(i), model.get_score(int(i))) for i in usable}
        byte_of = {int(i): b for b, i in enumerate(self.bytes)}
        self.is_byte = {i: bytes([b]) for i, b in byte_of.items()}

    def spell(self, character: str) -> list[int]:
        """A character without a piece, as byte pieces."""
        return [int(self.bytes[b]) for b in character.encode()]

    def decode(self, ids) -> str:
        """The text of ids: byte pieces join to characters, marks are blanks, and the blank in front goes."""
        raw = b"".join(self.is_byte[i] if i in self.is_byte else self.pieces[i].encode() for i in map(int, ids))
        text = raw.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@dataclass
class Lattice:
    """Edges of one word ending at each position, as (start, ids, score)."""

    ends: list[list[tuple[int, list[int], float]]]
    best: list[float]


def lattice(word: str, vocabulary: Vocabulary) -> Lattice:
    """All pieces that fit in ``word``, and forward Viterbi scores."""
    ends, best = [[]], [0.0]
    for j in range(1, len(word) + 1):
        edges = []
        for i in range(max(0, j - vocabulary.longest), j):
            hit = vocabulary.lookup.get(word[i:j])
            if hit:
                edges.append((i, [hit[0]], hit[1]))
        if not edges or edges[-1][0] != j - 1:
            edges.append((j - 1, vocabulary.spell(word[j - 1]), vocabulary.unknown))
        ends.append(edges)
        best.append(max(best[i] + s for i, _, s in edges))
    return Lattice(ends, best)


def n_best(word: str, vocabulary: Vocabulary, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations (score, ids) by backward A*; of equal ones the first found comes first.

    An entry of the agenda is the score it can still reach, a serial number, its place, its score so
    far, and the pieces behind it as a chain.
    """
    graph = lattice(word, vocabulary)
    agenda = [(-graph.best[-1], 0, len(word), 0.0, None)]
    found, serial = [], 0
    while agenda and len(found) < n:
        _, _, at, score, tail = heapq.heappop(agenda)
        if at == 0:
            ids = []
            while tail:
                ids += tail[0]
                tail = tail[1]
            found.append((score, ids))
            continue
        for start, ids, gain in reversed(graph.ends[at]):
            after = score + gain
            serial -= 1  # what was left last is gone on with first
            heapq.heappush(agenda, (-(after + graph.best[start]), serial, start, after, (ids, tail)))
    return found


def one_best(word: str, vocabulary: Vocabulary) -> tuple[float, float, list[int]]:
    """Score, cheapest detour and ids of the best segmentation of one word, as ``viterbi`` finds them for many."""
    graph = lattice(word, vocabulary)
    at, extra, parts = len(word), float("inf"), []
    while at:
        ranked = sorted(((graph.best[i] + s, i, ids) for i, ids, s in graph.ends[at]), key=lambda e: (-e[0], -e[1]))
        if len(ranked) > 1:
            extra = min(extra, ranked[0][0] - ranked[1][0])
        _, at, ids = ranked[0]
        parts.append(ids)
    return graph.best[-1], extra, [i for ids in reversed(parts) for i in ids]


def viterbi(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary):
    """Best scores, best pieces and cheapest detour of many words at once.

    Returns (score, extra, counts, ids): ``extra`` is what the second-best segmentation loses (inf if there is
    none); ``ids`` holds -1 - position for a character without a piece.
    """
    size = ends - starts
    words, width = len(size), int(size.max(initial=0))
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    alive = np.searchsorted(-size, -np.arange(width + 1), side="right")  # words of at least so many characters
    sums = running_hash(_codes(points))
    best = np.full((width + 1, words), -np.inf)
    best[0] = 0.0
    back = np.zeros((width + 1, words), np.int64)
    piece = np.full((width + 1, words), -1, np.int64)
    second = np.full((width + 1, words), np.inf)
    for j in range(1, width + 1):
        n = alive[j]
        at = starts[:n] + j
        edges = []
        for i in range(max(0, j - vocabulary.longest), j):
            hit = vocabulary.find(span_hashes(sums, at - (j - i), at))
            value = np.where(hit >= 0, best[i, :n] + (vocabulary.scores[hit] if len(vocabulary.scores) else 0), -np.inf)
            if i == j - 1:
                none = hit < 0
                value[none] = best[i, :n][none] + vocabulary.unknown
                hit = np.where(none, -2, hit)
            edges.append((i, hit, value))
        values = np.stack([v for _, _, v in edges])
        # of equal scores the shortest last piece wins
        top = len(edges) - 1 - values[::-1].argmax(0)
        lane = np.arange(n)
        best[j, :n] = values[top, lane]
        back[j, :n] = np.array([i for i, _, _ in edges])[top]
        piece[j, :n] = np.stack([h for _, h, _ in edges])[top, lane]
        if len(edges) > 1:
            values[top, lane] = -np.inf
            second[j, :n] = best[j, :n] - values.max(0)
    extra = np.full(words, np.inf)
    place, lane = size.copy(), np.arange(words)
    taken = []
    while True:
        live = place > 0
        if not live.any():
            break
        lane = lane[live]
        place = place[live]
        extra[lane] = np.minimum(extra[lane], second[place, lane])
        chosen = piece[place, lane]
        position = starts[lane] + place - 1
        taken.append((lane, np.where(chosen >= 0, vocabulary.ids[chosen], -1 - position)))
        place = back[place, lane]
    lanes = np.concatenate([a for a, _ in taken]) if taken else np.zeros(0, np.int64)
    ids = np.concatenate([b for _, b in taken]) if taken else np.zeros(0, np.int64)
    step = np.concatenate([np.full(len(a), k) for k, (a, _) in enumerate(taken)]) if taken else lanes
    arrange = np.lexsort((-step, order[lanes]))
    score, loss = np.empty(words), np.empty(words)
    score[order], loss[order] = best[size, np.arange(words)], extra
    return score, loss, np.bincount(order[lanes], minlength=words), ids[arrange]


class Segmenter:
    """The n best segmentations of texts."""

    def __init__(self, path: str, n: int = N_BEST):
        self.vocabulary, self.n = Vocabulary(path), n
        self.searched: dict[str, list] = {}

    def _search(self, word: str):
        if word not in self.searched:
            if len(self.searched) > 50_000:
                self.searched.clear()
            self.searched[word] = n_best(word, self.vocabulary, self.n)
        return self.searched[word]

    def _words(self, texts: list[str]):
        """Code points of all texts with a mark in front, and the words: marks and what follows them."""
        joined = "".join(MARK + t.replace(" ", MARK) for t in texts if t)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        size = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        offsets = np.append(0, np.cumsum(size))
        mark = points == ord(MARK)
        start = mark.copy()
        start[1:] &= ~mark[:-1]
        start[offsets[:-1][size > 0]] = True
        starts = np.flatnonzero(start)
        return joined, points, starts, np.append(starts[1:], len(points)), np.searchsorted(offsets, starts, side="right") - 1

    def encode(self, texts: list[str]) -> list[list[tuple[float, np.ndarray]]]:
        """For every text its (score, ids), best first. An empty text has one segmentation, the empty one."""
        joined, points, starts, ends, doc = self._words(texts)
        key = span_hashes(running_hash(_codes(points)), starts, ends)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        score, extra, counts, begin, ids = self._distinct(joined, points, starts[first], ends[first])
        per = counts[which]
        flat = ids[np.repeat(begin[which], per) + ragged(per)]
        total = np.bincount(doc, score[which], len(texts))
        bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
        upto = np.append(0, np.cumsum(per))
        odd = np.flatnonzero(flat < 0)
        narrow = odd[points[-1 - flat[odd]] < 128]
        flat[narrow] = self.vocabulary.bytes[points[-1 - flat[narrow]]]
        odd = np.flatnonzero(flat < 0)
        out = []
        for d in range(len(texts)):
            a, b = bounds[d], bounds[d + 1]
            here = flat[upto[a] : upto[b]]
            cuts = upto[a : b + 1] - upto[a]
            if len(odd) and (here < 0).any():
                here, cuts = self._spelled(here, cuts, joined)
            out.append(self._combined(total[d], here, cuts, extra[which[a:b]], starts[a:b], ends[a:b], joined))
        return out

    def _distinct(self, joined, points, starts, ends):
        """Viterbi over distinct words: short ones all at once, long ones one by one."""
        n = len(starts)
        score, extra, counts, begin = np.zeros(n), np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        short = np.flatnonzero(ends - starts <= LONG)
        score[short], extra[short], counts[short], ids = viterbi(points, starts[short], ends[short], self.vocabulary)
        begin[short] = np.cumsum(counts[short]) - counts[short]
        flat, size = [ids], len(ids)
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            score[i], extra[i], own = one_best(joined[starts[i] : ends[i]], self.vocabulary)
            counts[i], begin[i] = len(own), size
            flat.append(np.array(own, np.int64))
            size += len(own)
        return score, extra, counts, begin, np.concatenate(flat)

    def _spelled(self, ids, cuts, joined):
        """Characters without a piece become their byte pieces."""
        parts = [[i] if i >= 0 else self.vocabulary.spell(joined[-1 - i]) for i in ids.tolist()]
        grown = np.append(0, np.cumsum([len(p) for p in parts]))
        return np.array([x for p in parts for x in p], np.int64), grown[cuts]

    def _combined(self, total, ids, cuts, extra, starts, ends, joined):
        """The best combinations of the words' segmentations: a segmentation of the text among its n best leaves
        the best one only at the n - 1 words that lose least by it."""
        wanted = self.n - 1
        open_ = np.flatnonzero(extra < np.inf)
        if len(open_) > wanted > 0:
            least = np.partition(extra[open_], wanted - 1)[wanted - 1]
            open_ = open_[extra[open_] <= least]
            open_ = open_[np.argsort(extra[open_], kind="stable")][:wanted]
        found = [(0.0, ())]
        for w in sorted(open_.tolist()) if wanted else []:
            choices = self._search(joined[starts[w] : ends[w]])
            top = choices[0][0]
            mixed = [(loss + top - s, (*change, (w, k))) if k else (loss, change) for loss, change in found for k, (s, _) in enumerate(choices)]
            found = heapq.nsmallest(self.n, mixed)
        out = []
        for loss, change in found[: self.n]:
            parts, last = [], 0
            for w, k in change:
                parts += [ids[last : cuts[w]], np.array(self._search(joined[starts[w] : ends[w]])[k][1], np.int64)]
                last = cuts[w + 1]
            out.append((float(total - loss), np.concatenate([*parts, ids[last:]]).astype(np.int64)))
        return out


def segment(docs: DataFrame, model: str, n: int = N_BEST) -> DataFrame:
    """doc_id, rank (from 1), score, n_pieces and ids (array) of the ``n`` best segmentations of every text.

    A null text counts as empty and has one segmentation without pieces; a text with fewer than ``n``
    has all of them. A character without a piece is spelled in byte pieces. Equal scores keep the order in which
    words and detours stand in the text. Repeated rows are segmented each for itself; extra columns are ignored.
    """

    def run(batches):
        segmenter = Segmenter(model, n)
        for batch in batches:
            for first, end, _, _ in text_blocks(batch.column(1), BLOCK):
                texts = ["" if t is None else t for t in batch.column(1).slice(first, end - first).to_pylist()]
                found = segmenter.encode(texts)
                counts = [len(x) for x in found]
                lists = [ids for x in found for _, ids in x]
                at = np.append(0, np.cumsum([len(x) for x in lists])).astype(np.int32)
                flat = np.concatenate(lists).astype(np.int32) if lists else np.zeros(0, np.int32)
                owner = np.repeat(np.arange(first, end), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(owner)),
                        pa.array((ragged(np.array(counts)) + 1).astype(np.int32)),
                        pa.array([s for x in found for s, _ in x], pa.float64()),
                        pa.array(np.diff(at).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(flat)),
                    ],
                    names=["doc_id", "rank", "score", "n_pieces", "ids"],
                )

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id bigint, rank int, score double, n_pieces bigint, ids array<int>")


def decode(rows: DataFrame, model: str, column: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids; null ids give null. The first blank of a text goes with its mark."""
    keep = rows.columns
    place = keep.index(column)

    def run(batches):
        vocabulary = Vocabulary(model)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return rows.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", decoded string")


def digests(docs: DataFrame, model: str, n: int = N_BEST) -> DataFrame:
    """What ``segment`` finds with a checksum of the ids (little-endian 32-bit) and whether they decode to the text.

    ``round_trip`` is false for a text that holds the sign for a blank itself, which decodes to a blank.
    """

    def run(batches):
        segmenter = Segmenter(model, n)
        table = segmenter.vocabulary
        raw, mark = [table.is_byte.get(i, p.encode()) for i, p in enumerate(table.pieces)], MARK.encode()
        for batch in batches:
            for first, end, _, _ in text_blocks(batch.column(1), BLOCK):
                texts = ["" if t is None else t for t in batch.column(1).slice(first, end - first).to_pylist()]
                rows = []
                for doc, text, found in zip(batch.column(0).slice(first, end - first).to_pylist(), texts, segmenter.encode(texts), strict=True):
                    wanted = text.encode()
                    for k, (score, ids) in enumerate(found, 1):
                        decoded = b"".join([raw[i] for i in ids.tolist()]).replace(mark, b" ").removeprefix(b" ")
                        same = decoded == wanted
                        rows.append((doc, k, score, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), same))
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip"])

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id bigint, rank int, score double, n_pieces bigint, ids_crc32 bigint, round_trip boolean")
