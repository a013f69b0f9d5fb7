"""Byte-pair ids of whole columns of text: every distinct pre-token of a block is encoded once.

The tokenizer's own pre-tokens never share ids, so a text's ids are those of its pre-tokens in a
row. Texts with characters beyond ``PLAIN`` or with a special token in them go to the tokenizer whole.
The merges of a single pre-token are done by a bare byte-pair coder over the tokenizer's own
vocabulary, where ids are in the order of merges; else by the tokenizer.
"""

from __future__ import annotations

import json
import unicodedata
from itertools import chain

import numpy as np

from panelkit.llm.common import Finder, mix, ragged, running_hash, span_hashes

PLAIN = 0x250
SPACE, LETTER, NUMBER, OTHER = range(4)
SPACES = {9, 10, 11, 12, 13, 32, 0x85, 0xA0}
KINDS = np.array(
    [SPACE if c in SPACES else {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(PLAIN)],
    np.uint8,
)
CODES = mix(np.arange(1, PLAIN + 1, dtype=np.uint64)) | np.uint64(1)
# The contractions that the vocabulary's published pattern splits off.
SHORT = ("s", "t", "m", "d")
LONG = ("re", "ve", "ll")
KEPT = 400_000


def pretokens(code: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each pre-token begins. ``code``: the code points of texts in a row, none of them empty.

    Runs of letters, of numbers and of other signs are pre-tokens, each with one blank before it
    if there is one; so are contractions, and runs of white space but for a last
    character that a word follows.
    """
    n = len(code)
    kind = KINDS[code]
    new_text = np.zeros(n, bool)
    new_text[offsets[:-1]] = True
    blank = kind == SPACE
    before = np.append(True, blank[:-1])
    changed = np.append(True, kind[1:] != kind[:-1])
    last = np.append(new_text[1:], True)
    after = np.append(blank[1:], True)
    start = new_text | (changed & blank) | (changed & ~before)
    start |= blank & ~after & ~last
    start[1:] |= ~blank[1:] & blank[:-1] & (code[:-1] != 32)
    quote = np.flatnonzero((code == 39) & (changed | new_text))
    quote = quote[new_text[quote] | ~((quote > 0) & (code[quote - 1] == 32))]
    if len(quote):
        text_end = offsets[np.searchsorted(offsets, quote, side="right")]
        pad = np.append(code, np.zeros(3, code.dtype))
        a, b = pad[quote + 1], pad[quote + 2]
        short = np.isin(a, [ord(x) for x in SHORT]) & (quote + 2 <= text_end)
        long = np.zeros(len(quote), bool)
        for x, y in LONG:
            long |= (a == ord(x)) & (b == ord(y)) & (quote + 3 <= text_end)
        for at, width in ((quote[short], 2), (quote[long & ~short], 3)):
            for i in range(1, width):
                start[at + i] = False
            next_ = at + width
            next_ = next_[next_ < n]
            stays = ~(blank[next_] & new_text[next_])
            start[next_[stays]] = True
    return np.flatnonzero(start)


def _single_pieces(tokenizer):
    """A function from one pre-token's bytes to its ids, if the vocabulary allows it."""
    import tiktoken

    model = json.loads(tokenizer.to_str())["model"]
    vocab, merges = model["vocab"], [x if isinstance(x, list) else x.split(" ") for x in model.get("merges", [])]
    if model["type"] != "BPE" or any(vocab[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in vocab.items() if all(c in byte for c in piece) and i < 256 + len(merges)}
    if len(ranks) != 256 + len(merges):
        return None
    return tiktoken.Encoding("pieces", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class Encoder:
    """Ids of many texts at once; remembers a bounded number of pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.piece = _single_pieces(self.tokenizer)
        self.forget()

    def forget(self):
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.size = [np.zeros(0, np.uint32)], 0

    def _learn(self, keys, words):
        if len(self.keys) + len(keys) > KEPT and len(self.keys):
            self.forget()
            return False
        if self.piece:
            lists = [self.piece(w.encode()) for w in words]
        else:
            lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), np.uint32, int(count.sum()))
        first = self.size + np.cumsum(count) - count
        self.flat = [np.concatenate([*self.flat, flat])]
        self.size += len(flat)
        order = np.argsort(np.concatenate([self.keys, keys]), kind="stable")
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]
        self.keys = np.concatenate([self.keys, keys])[order]
        return True

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, number of ids of each text), as the tokenizer gives them without special tokens."""
        counts = np.zeros(len(texts), np.int64)
        plain, odd = [], []
        for i, text in enumerate(texts):
            if text:
                (odd if any(t.content in text for t in self.special) else plain).append(i)
        joined = "".join(texts[i] for i in plain)
        code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        offsets = np.append(0, np.cumsum([len(texts[i]) for i in plain])).astype(np.int64)
        if len(code) and code.max() >= PLAIN:
            wide = np.add.reduceat(code >= PLAIN, offsets[:-1]) > 0
            odd += [i for i, w in zip(plain, wide, strict=True) if w]
            plain = [i for i, w in zip(plain, wide, strict=True) if not w]
            joined = "".join(texts[i] for i in plain)
            code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            offsets = np.append(0, np.cumsum([len(texts[i]) for i in plain])).astype(np.int64)
        pieces = {}
        for i in odd:
            pieces[i] = np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        if len(code):
            start = pretokens(code, offsets)
            end = np.append(start[1:], len(code))
            key = span_hashes(running_hash(CODES[code]), start, end)
            at = Finder(self.keys).find(key)
            new = np.flatnonzero(at < 0)
            if len(new):
                fresh, where = np.unique(key[new], return_index=True)
                where = new[where]
                if not self._learn(fresh, [joined[a:b] for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)]):
                    fresh, where = np.unique(key, return_index=True)
                    self._learn(fresh, [joined[a:b] for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)])
                at = Finder(self.keys).find(key)
            per = self.count[at]
            ids = self.flat[0][np.repeat(self.first[at], per) + ragged(per)]
            upto = np.append(0, np.cumsum(per))
            cut = upto[np.searchsorted(start, offsets)]
            counts[plain] = np.diff(cut)
            if not odd:
                return ids, counts
            pieces.update(zip(plain, np.split(ids, cut[1:-1]), strict=True))
        for i in odd:
            counts[i] = len(pieces[i])
        return (np.concatenate([pieces[i] for i in sorted(pieces)]) if pieces else np.zeros(0, np.uint32)), counts
