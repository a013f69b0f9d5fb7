"""Byte-level BPE: pre-tokens found by scanning transition functions, merged pair by pair, decoded by offsets.

Every code point is one of a few symbols (letter, number, blank before a word, ..), read from an array of
classes. A small automaton tells where pre-tokens begin. Each symbol is a function on its states, and
composition of functions is associative: a text block is laid out in columns that are scanned
side by side, the columns' functions are composed, and only then the state before every code point is known. No
regular expression runs over the text. The slices between boundaries are looked up in a cache of merged
slices, byte for byte; new ones are merged together, one pair a round. For every id the end of its bytes is kept, so that any
span of ids can be mapped to the text or decoded.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import BLOCK_BYTES, BYTE_CODES, Finder, ragged, running_hash, span_hashes, text_blocks

KEPT = 250_000
#: Bytes scanned at once.
BLOCK = BLOCK_BYTES // 2
#: Slices longer than this are merged one by one with a heap.
SHORT = 64
ENCODED = "doc_id long, n_tokens long, ids binary, ends binary"
DECODED = "doc_id long, n_tokens long, bytes binary"

# Classes of code points.
OTHER, LETTER, NUMBER, SPACE = range(4)
# Symbols of the automaton: a class, or what the next code points make of it.
QUOTE_1, QUOTE_2, SPACE_INSIDE, BLANK_LAST = range(4, 8)
# States: what the last code point left open.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACE, ONE_MORE, TWO_MORE = range(8)
# The contractions that the public pattern splits off.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point, by the Unicode tables of the library whose ids are to be met."""
    import tiktoken

    table = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = bytes(tiktoken.Encoding("class", pat_str=name, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        table[np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)] = kind
    return table


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(state after [state, symbol], is a boundary [state, symbol], function of each symbol, products, function[state]).

    The functions that symbols compose to are few; they are numbered, and ``products[f, g]`` is f, then g.
    """
    begins = {OTHER: IN_OTHERS, LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, SPACE: FRESH, QUOTE_1: ONE_MORE, QUOTE_2: TWO_MORE, SPACE_INSIDE: IN_SPACE, BLANK_LAST: AFTER_BLANK}
    stays = {
        IN_LETTERS: {LETTER: IN_LETTERS}, IN_NUMBERS: {NUMBER: IN_NUMBERS}, IN_OTHERS: dict.fromkeys((OTHER, QUOTE_1, QUOTE_2), IN_OTHERS),
        AFTER_BLANK: {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS} | dict.fromkeys((OTHER, QUOTE_1, QUOTE_2), IN_OTHERS),
        IN_SPACE: {SPACE_INSIDE: IN_SPACE}, ONE_MORE: dict.fromkeys(range(8), FRESH), TWO_MORE: dict.fromkeys(range(8), ONE_MORE),
    }
    after, boundary = np.zeros((8, 8), np.uint8), np.ones((8, 8), bool)
    for state in range(8):
        for symbol in range(8):
            inside = stays.get(state, {}).get(symbol)
            boundary[state, symbol] = inside is None
            after[state, symbol] = begins[symbol] if inside is None else inside
    # 8 symbols, and again 8 for those that open a text, whatever was before
    first = [tuple(after[:, s].tolist()) for s in range(8)] + [(begins[s],) * 8 for s in range(8)]
    functions = {f: i for i, f in enumerate(dict.fromkeys([tuple(range(8)), *first]))}
    queue = list(functions)
    for f in queue:
        for g in first:
            both = tuple(g[s] for s in f)
            if both not in functions:
                functions[both] = len(functions)
                queue.append(both)
    values = np.array(list(functions), np.uint8)
    code = (values.astype(np.int64) << (3 * np.arange(8))).sum(1)
    order = np.argsort(code)
    products = np.stack([order[np.searchsorted(code[order], (g[values].astype(np.int64) << (3 * np.arange(8))).sum(1))] for g in values], axis=1)
    return after, boundary, np.array([functions[f] for f in first]), products.astype(np.uint16), values


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and where each begins."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.uint32)
    if len(at) == len(data):
        return lead, at
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.uint32) & 0x3F
    two, three, four = lead >= 0xC0, lead >= 0xE0, lead >= 0xF0
    code = np.where(four, lead & 7, np.where(three, lead & 15, np.where(two, lead & 31, lead)))
    for i, more in ((1, two), (2, three), (3, four)):
        code = np.where(more, (code << 6) | padded[at + i], code)
    return np.minimum(code, 0x10FFFF), at  # a character cut off at the end has any code


def symbols(code: np.ndarray, text_first: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``text_first`` marks those that open a text."""
    kind = classes()[code]
    out = kind.copy()
    n = len(code)
    same = np.append(~text_first[1:], False)
    space = kind == SPACE
    # white space goes with what follows: more of it, the end of the text, or a word
    word_next = np.zeros(n, bool)
    word_next[:-1] = same[:-1] & ~space[1:]
    out[space & ~word_next] = SPACE_INSIDE
    out[space & word_next & (code == 32)] = BLANK_LAST
    quote = np.flatnonzero(code == 39)
    if len(quote):
        padded, joined = np.append(code, np.zeros(2, code.dtype)), np.append(same, np.zeros(2, bool))
        a, b = padded[quote + 1], padded[quote + 2]
        one = joined[quote]
        two = one & joined[quote + 1]
        for letters in CONTRACTIONS:
            if len(letters) == 1:
                out[quote[one & (a == ord(letters))]] = QUOTE_1
            else:
                out[quote[two & (a == ord(letters[0])) & (b == ord(letters[1]))]] = QUOTE_2
    return out


def states_before(function: np.ndarray) -> np.ndarray:
    """The automaton's state before every code point, from the number of each one's function.

    Columns of the block are scanned in step: prefix products down each column, then the columns' own products in a row,
    then the state with which each column was entered.
    """
    _, _, _, products, values = automaton()
    n = len(function)
    height = max(1, min(1024, int(np.sqrt(n)) + 1))
    width = -(-n // height)
    identity = 0
    grid = np.full(width * height, identity, np.uint16)
    grid[:n] = function
    grid = np.ascontiguousarray(grid.reshape(width, height).T)
    flat, size = products.reshape(-1), np.uint32(len(products))
    upto = np.empty_like(grid)
    running = np.zeros(width, np.uint16)
    for i in range(height):
        upto[i] = running
        running = flat[running * size + grid[i]]
    entry = np.empty(width, np.uint8)
    state = FRESH
    for column, f in enumerate(running.tolist()):
        entry[column] = state
        state = values[f, state]
    return values[upto, entry[None, :]].T.reshape(-1)[:n]


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte positions at which pre-tokens of texts in a row begin."""
    if not len(data):
        return np.zeros(0, np.int64)
    code, at = code_points(data)
    first = np.zeros(len(code), bool)
    first[np.searchsorted(at, offsets[:-1][offsets[:-1] < offsets[1:]])] = True
    _, boundary, function, _, _ = automaton()
    symbol = symbols(code, first)
    before = states_before(function[symbol + np.where(first, 8, 0)])
    return at[first | boundary[before, symbol]]


class Vocabulary:
    """Byte strings by rank, and which rank two neighbours merge to."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        lengths = np.zeros(self.size, np.int64)
        for piece, rank in ranks.items():
            lengths[rank] = len(piece)
        self.first = np.cumsum(lengths) - lengths
        self.lengths = lengths
        by_rank = {rank: piece for piece, rank in ranks.items()}
        self.bytes = np.frombuffer(b"".join(by_rank.get(i, b"") for i in range(self.size)), np.uint8)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    @functools.cached_property
    def pair(self) -> dict[int, int]:
        """Rank that each pair of neighbours (left * size + right) merges to. Decoding needs none of it."""
        found = {}
        for piece, rank in self.ranks.items():
            for cut in range(1, len(piece)):
                left, right = self.ranks.get(piece[:cut]), self.ranks.get(piece[cut:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        return found

    @functools.cached_property
    def _pairs(self) -> tuple[Finder, np.ndarray]:
        pairs = np.array(sorted(self.pair), np.uint64)
        return Finder(pairs), np.array([self.pair[int(p)] for p in pairs] + [self.size], np.int64)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """A rank file: a line has the base64 of a byte string and its rank."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in lines if line.strip())})

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks that pairs of neighbours merge to; ``size`` where they do not."""
        finder, merged = self._pairs
        return merged[finder.find((left * self.size + right).astype(np.uint64))]

    def merge_all(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each slice). In every round each slice merges its first pair of lowest rank."""
        lengths = ends - starts
        ids = self.single[data[np.repeat(starts, lengths) + ragged(lengths)]]
        owner = np.repeat(np.arange(len(starts)), lengths)
        done_ids, done_owner = [], []
        while len(ids):
            pair = np.full(len(ids), self.size, np.int64)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            pair[inner] = self.rank_of(ids[inner], ids[inner + 1])
            head = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            length = np.diff(np.append(head, len(ids)))
            lowest = np.minimum.reduceat(pair, head)
            open_ = lowest < self.size
            closed = np.repeat(~open_, length)
            done_ids.append(ids[closed])
            done_owner.append(owner[closed])
            hit = np.flatnonzero((pair == np.repeat(lowest, length)) & ~closed)
            hit = hit[np.append(True, owner[hit][1:] != owner[hit][:-1])] if len(hit) else hit
            ids[hit] = pair[hit]
            keep = ~closed
            keep[hit + 1] = False
            ids, owner = ids[keep], owner[keep]
        ids, owner = np.concatenate(done_ids or [ids]), np.concatenate(done_owner or [owner])
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(starts))

    def merge_one(self, piece: bytes) -> list[int]:
        """Ids of a long slice: the same merges, found through a heap of (rank, place)."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := self.pair.get(ids[i] * self.size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    r = self.pair.get(ids[a] * self.size + ids[after[a]])
                    if r is not None:
                        heapq.heappush(heap, (r, a, ids[a], ids[after[a]]))
        return [x for x in ids if x >= 0]


class Encoder:
    """Ids of blocks of texts, with a bounded cache of merged slices that are compared byte for byte."""

    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT):
        self.vocabulary, self.kept = vocabulary, kept
        self.forget()

    def forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.at, self.length, self.first, self.count = (np.zeros(0, np.int64) for _ in range(4))
        self.known, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.int64)
        self.finder = Finder(self.keys)

    def merged(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids) of slices that are not in the cache. A slice that is in the vocabulary is one id."""
        words = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        whole = np.array([self.vocabulary.ranks.get(w, -1) for w in words], np.int64)
        lists: dict[int, np.ndarray] = {}
        short = np.flatnonzero((whole < 0) & (ends - starts <= SHORT))
        ids, count = self.vocabulary.merge_all(data, starts[short], ends[short])
        counts = np.ones(len(words), np.int64)
        counts[short] = count
        for i in np.flatnonzero((whole < 0) & (ends - starts > SHORT)).tolist():
            lists[i] = np.array(self.vocabulary.merge_one(words[i]), np.int64)
            counts[i] = len(lists[i])
        first = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        out[first[whole >= 0]] = whole[whole >= 0]
        out[np.repeat(first[short], count) + ragged(count)] = ids
        for i, own in lists.items():
            out[first[i] : first[i] + len(own)] = own
        return out, counts

    def learn(self, keys, data, starts, ends):
        """Take slices with new keys into the cache."""
        ids, count = self.merged(data, starts, ends)
        length = ends - starts
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        both = lambda a, b: np.concatenate([a, b])[order]
        self.at = both(self.at, len(self.known) + np.cumsum(length) - length)
        self.length = both(self.length, length)
        self.first = both(self.first, len(self.ids) + np.cumsum(count) - count)
        self.count = both(self.count, count)
        self.keys = both(self.keys, keys)
        self.known = np.concatenate([self.known, data[np.repeat(starts, length) + ragged(length)]])
        self.ids = np.concatenate([self.ids, ids])
        self.finder = Finder(self.keys)

    def slices(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, number of ids of each slice)."""
        keys = span_hashes(running_hash(BYTE_CODES[data]), starts, ends)
        at = self.finder.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh, where = np.unique(keys[new], return_index=True)
            where = new[where]
            if len(self.keys) and len(self.keys) + len(fresh) > self.kept:
                self.forget()
                fresh, where = np.unique(keys, return_index=True)
            self.learn(fresh, data, starts[where], ends[where])
            at = self.finder.find(keys)
        length = ends - starts
        alike = self.length[at] == length
        steps = ragged(length)
        mine = data[np.repeat(starts, length) + steps]
        theirs = self.known[np.minimum(np.repeat(self.at[at], length) + steps, len(self.known) - 1)]
        if len(length):
            alike &= np.add.reduceat(mine != theirs, np.cumsum(length) - length) == 0
        count = self.count[at]
        if alike.all():
            return self.ids[np.repeat(self.first[at], count) + ragged(count)], count
        # two slices of one key: those that differ from the cached one are merged each for itself
        parts = [self.ids[f : f + c] for f, c in zip(self.first[at].tolist(), count.tolist(), strict=True)]
        for i in np.flatnonzero(~alike).tolist():
            parts[i], _ = self.merged(data, starts[i : i + 1], ends[i : i + 1])
        return np.concatenate(parts), np.array([len(p) for p in parts])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids in a row, the byte at which each ends, number of ids of each text) of texts in a row."""
        starts = boundaries(data, offsets)
        ids, count = self.slices(data, starts, np.append(starts[1:], len(data))) if len(starts) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        ends = np.cumsum(self.vocabulary.lengths[ids])
        per = np.diff(np.append(0, np.cumsum(count))[np.searchsorted(starts, offsets)])
        return ids, ends, per

    def encode_long(self, data: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends) of one long text, part by part.

        A part ends at a boundary that the bytes after it cannot move: four code points before the end of what was read. A slice longer
        than a part is read on until it ends.
        """
        done, size = 0, limit
        while done < len(data):
            part = data[done : done + size]
            starts = boundaries(part, np.array([0, len(part)]))
            if done + size < len(data):
                sure = np.flatnonzero((part & 0xC0) != 0x80)[-4:][0]
                starts = starts[starts <= sure]
                if starts[-1] == 0:
                    size *= 2
                    continue
                starts, end = starts[:-1], int(starts[-1])
            else:
                end = len(part)
            ids, _ = self.slices(part, starts, np.append(starts[1:], end))
            yield ids, done + np.cumsum(self.vocabulary.lengths[ids])
            done, size = done + end, limit


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", limit: int = BLOCK) -> DataFrame:
    """(doc_id, n_tokens, ids, ends) of every whole text, by the rank file at ``path``.

    ``ids`` and ``ends`` are little-endian unsigned 32-bit numbers: the id of each token, and the byte of the text at which
    it ends. A null text counts as empty and has no ids. Every row is encoded for itself (repeated rows
    alike), a null id stays null, other columns are ignored. Texts come in blocks of ``limit`` bytes, longer texts in parts.
    Any Unicode text is encoded in full, strings of special tokens as ordinary text.
    """

    def run(batches):
        encoder = Encoder(Vocabulary.load(path))
        for batch in batches:
            numbers = batch.column(0)
            for a, b, data, offsets in text_blocks(batch.column(1), limit):
                if len(data) > limit:
                    parts = list(encoder.encode_long(data, limit))
                    ids, ends = (np.concatenate(x) for x in zip(*parts, strict=True))
                    per = np.array([len(ids)])
                else:
                    ids, ends, per = encoder.encode(data, offsets)
                upto = np.append(0, np.cumsum(per))
                ends = ends - np.repeat(offsets[:-1], per)
                raw = [x.astype("<u4").tobytes() for x in (ids, ends)]
                rows = [pa.array([x[4 * i : 4 * j] for i, j in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)], pa.binary()) for x in raw]
                yield pa.RecordBatch.from_arrays([numbers.slice(a, b - a), pa.array(per, pa.int64()), *rows], names=["doc_id", "n_tokens", "ids", "ends"])

    rows = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, path: str, *carried: str) -> DataFrame:
    """(doc_id, n_tokens, bytes) and the ``carried`` columns of rows with doc_id and ids, as ``encode`` gives them.

    Bytes are those of the ids in a row; any run of ids decodes, also one that cuts a character. No ids give no bytes.
    """
    fields = [encoded.schema[c] for c in carried]

    def run(batches):
        vocabulary = Vocabulary.load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                raw = [x or b"" for x in part.column(1).to_pylist()]
                count = np.array([len(x) // 4 for x in raw])
                ids = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
                length = vocabulary.lengths[ids]
                text = vocabulary.bytes[np.repeat(vocabulary.first[ids], length) + ragged(length)].tobytes()
                cut = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(count))].tolist()
                rows = pa.array([text[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(count, pa.int64()), rows, *part.columns[2:]], names=["doc_id", "n_tokens", "bytes", *carried])

    schema = DECODED + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in fields)
    return encoded.select("doc_id", "ids", *carried).mapInArrow(run, schema)
