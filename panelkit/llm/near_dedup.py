"""Near-duplicate detection with DartMinHash signatures (Christiani, 2020).

A document is a weighted set: its five-word shingles, weighted by how often they occur. Every
element owns a plane of weight x rank, on which a hash of the element throws darts; a document
keeps the darts below the element's weight and, per coordinate, the one of lowest rank. Two
documents agree in a coordinate with probability equal to their weighted Jaccard similarity.
Bands of coordinates are joined, candidates are verified exactly, and links give classes.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import (
    IS_WORD,
    LOWER,
    components,
    mix,
    ragged,
    running_hash,
    span_hashes,
    spans,
    text_blocks,
)
from panelkit.operators.skew import BROADCAST_BYTES, sized_join
from panelkit.session import stage, stage_sized, unstage

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 48
ROWS = 7
BLOCK = 1 << 19
HUBS = 16
PAIRS = 128
#: Pairs per document that are listed before any hub was compared.
FEW = 2
EMPTY = np.uint64(2**64 - 1)

# Darts in a cell of area 1: Poisson(1), by 16 bits of the cell's hash.
_mass = [math.exp(-1) / math.factorial(i) for i in range(12)]
DARTS = np.searchsorted(np.cumsum(_mass), (np.arange(65536) + 0.5) / 65536).astype(np.int64)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """(text, element, weight) of the word shingles, elements as 40-bit numbers, and two digests a text.

    Words are runs of letters, digits and non-ASCII bytes, ASCII letters lower-cased. A text of fewer
    than ``size`` words has one shingle of all its words; one without words has none.
    """
    n = len(offsets) - 1
    lowered = LOWER[data]
    start, end, doc = spans(IS_WORD[data], offsets)
    word = span_hashes(running_hash(lowered), start, end)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    salts = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    usable = max(0, len(word) - size + 1)
    key = np.zeros(usable, np.uint64)
    for i in range(size):
        key += word[i : i + usable] * salts[i]
    whole = doc[:usable] == doc[size - 1 : size - 1 + usable]
    keys, owners = [mix(key[whole])], [doc[:usable][whole]]
    for k in range(1, size):
        short = np.flatnonzero(count == k)
        key = np.full(len(short), k, np.uint64)
        for i in range(k):
            key += word[first[short] + i] * salts[i]
        keys.append(mix(key))
        owners.append(short)
    mixed = (np.concatenate(owners).astype(np.uint64) << np.uint64(40)) | (np.concatenate(keys) >> np.uint64(24))
    mixed.sort()
    new = np.flatnonzero(np.append(True, mixed[1:] != mixed[:-1])) if len(mixed) else np.zeros(0, np.int64)
    weight = np.diff(np.append(new, len(mixed)))
    text = (mixed[new] >> np.uint64(40)).astype(np.int64)
    element = mixed[new] & np.uint64(2**40 - 1)
    sums = running_hash(word)
    digests = span_hashes(sums, first, first + count), span_hashes(running_hash(mix(word)), first, first + count)
    return text, element, weight, count, digests


def _throw(text, element, weight, reach, t, out):
    """Put the darts of all elements below their weight and the text's ``reach`` into ``out``."""
    level = 0
    while True:
        low = 2.0**level - 1
        inside = np.flatnonzero(weight > low)
        if not len(inside):
            return
        cells = np.ceil(reach[text[inside]] * 2.0**level).astype(np.int64)
        owner = np.repeat(inside, cells)
        row = ragged(cells)
        cell = mix(element[owner] * np.uint64(0xD6E8FEB86659FD93) + row.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(level + 1))
        darts = DARTS[(cell >> np.uint64(48)).astype(np.int64)]
        number = ragged(darts)
        owner, row = np.repeat(owner, darts), np.repeat(row, darts)
        dart = mix(np.repeat(cell, darts) + (number + 1).astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
        rank = (row + (dart & np.uint64(0xFFFFFF)).astype(np.float64) / 2**24) / 2.0**level
        other = mix(dart)
        at = low + (other >> np.uint64(40)).astype(np.float64) / 2**24 * 2.0**level
        hit = (at < weight[owner]) & (rank < reach[text[owner]])
        owner, rank, dart, other = owner[hit], rank[hit], dart[hit], other[hit]
        coordinate = ((dart >> np.uint64(24)) % np.uint64(t)).astype(np.int64)
        order = (rank / reach[text[owner]] * (2**32 - 1)).astype(np.uint64)
        np.minimum.at(out, text[owner] * t + coordinate, (order << np.uint64(32)) | (other & np.uint64(0xFFFFFFFF)))
        level += 1


def signatures(text, element, weight, n: int, t: int) -> np.ndarray:
    """The 32-bit mark of the lowest-ranked dart of each coordinate (text, coordinate).

    Every text gets about t (ln t + 3) darts at first; the few with an empty coordinate throw
    again twice as far, until all are filled. Texts without elements keep marks of all ones.
    """
    out = np.full(n * t, EMPTY)
    total = np.bincount(text, weight, n)
    reach = t * (math.log(t) + 3) / np.maximum(total, 1e-9)
    _throw(text, element, weight, reach, t, out)
    while True:
        open_ = ((out.reshape(n, t) == EMPTY).any(1)) & (total > 0)
        if not open_.any():
            return out.reshape(n, t).astype(np.uint32)
        out.reshape(n, t)[open_] = EMPTY
        reach[open_] *= 2
        again = open_[text]
        _throw(text[again], element[again], weight[again], reach, t, out)


def _digested(docs: DataFrame, kind: str, column: str, made) -> DataFrame:
    """doc_id, number of words and digests of the word sequence of every text, and a ``column`` that ``made`` makes of its shingles."""

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in text_blocks(batch.column(1), BLOCK):
                n = end - first
                text, element, weight, count, digests = shingles(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(count), *(pa.array(d.view(np.int64)) for d in digests), made(n, text, element, weight, count)],
                    names=["doc_id", "words", "d1", "d2", column],
                )

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, f"doc_id bigint, words bigint, d1 bigint, d2 bigint, {column} {kind}")


def sketches(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, number of words, digests of the word sequence and band keys of every text. A text without words has no keys."""
    t = bands * rows
    salt = mix(np.arange(1, t + 1, dtype=np.uint64)) | np.uint64(1)

    def made(n, text, element, weight, count):
        marks = signatures(text, element, weight.astype(np.float64), n, t).astype(np.uint64) * salt
        keys = mix(marks.reshape(n, bands, rows).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
        some = count > 0
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(some * bands)).astype(np.int32)), pa.array(keys[some].reshape(-1).view(np.int64)))

    return _digested(docs, "array<bigint>", "keys", made)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """doc_id, number of words, digests of the word sequence and shingles of every text, a sorted multiset of 32-bit numbers."""

    def made(n, text, element, weight, count):
        marks = np.repeat((element >> np.uint64(8)).astype(np.uint32), weight)
        ends = 4 * np.append(0, np.cumsum(np.bincount(text, weight, n))).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(marks))])

    return _digested(docs, "binary", "shingles", made)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted multisets."""
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[i], cb[j]).sum())


def _verify(similarity: float):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32)
                if min(len(a), len(b)) < similarity * max(len(a), len(b)):
                    keep.append(False)
                    continue
                both = shared(a, b)
                keep.append(both >= similarity * (len(a) + len(b) - both) - 1e-9)
            flag = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(flag), batch.column(1).filter(flag)], names=["a", "b"])

    return run


def _elements(batches):
    for batch in batches:
        ids, sets = batch.column(0).to_numpy(), batch.column(1)
        sizes = np.array([len(x.as_buffer()) // 4 for x in sets], np.int64)
        first = 0
        while first < len(sizes):
            end = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), BLOCK, side="right")) + first)
            value = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in sets.slice(first, end - first)])
            owner = np.repeat(np.arange(first, end), sizes[first:end])
            new = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]))) if len(value) else np.zeros(0, np.int64)
            weight = np.diff(np.append(new, len(value))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(ids[owner[new]]), pa.array(value[new].view(np.int32)), pa.array(weight)], names=["id", "shingle", "weight"])
            first = end


def shared_weights(sets: DataFrame) -> DataFrame:
    """(id, size, common) of texts (id, shingles): ``common`` leaves out the shingles that no other of the texts has.

    The intersection of two of these texts is at most the smaller ``common``. Counts are combined in every
    task before the shuffle, so a shingle of all texts is no hot key.
    """
    each = sets.select("id", "shingles").mapInArrow(_elements, "id bigint, shingle int, weight int")
    alone = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"), F.min("weight").alias("weight")).where("n = 1")
    alone = alone.groupBy("id").agg(F.sum("weight").alias("alone"))
    sized = sets.select("id", F.floor(F.octet_length("shingles") / 4).alias("size"))
    return sized.join(alone, "id", "left").select("id", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("common"))


def near_classes(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    pick: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(doc_id, class_id, copies) for every distinct non-null doc_id: class_id is the smallest doc_id of its class.

    Two texts are linked if the weighted Jaccard similarity of their shingles is ``similarity`` or
    more; classes are what links connect. Texts with the same words are one node of that graph, so
    exact copies cost nothing further; ``copies`` says how many there are. A text without words
    (null, empty, punctuation) is alone. Repeated rows of one id count once (the copy with the
    smallest digest decides), and null ids have no class. Extra columns are ignored.

    The texts are read twice: all of them for the band keys, and for the shingles those that share a bucket with another
    one; of these ``pick`` gives doc_id and text for a table of their doc_id, if there is a shorter way than to filter ``docs``.

    A pair at the threshold shares no band with probability (1 - s^rows)^bands, about 1e-5.
    Within a band bucket no pairs are listed while there are many: the member with most company is
    compared with all members of other classes, classes are joined, and what is still split goes
    on with the next ``HUBS`` such members. After the first round, pairs (and texts) whose shingles
    found in any other text still in question are too few for ``similarity`` are left out, which loses no link. Once the pairs between different classes that were not
    compared are at most ``PAIRS`` per document over all bands (``FEW`` before the first round, which joins a large group of near
    copies by its hubs), each such pair is compared once, so no link is lost. The rows of a bucket's largest class are not joined with each
    other there, and hubs, once compared, leave their bucket.
    """
    sketch = stage(sketches(docs, bands, rows), "near-sketch")
    none = F.col("words") == 0
    identity = F.struct(none.alias("none"), F.when(none, 0).otherwise(F.col("d1")).alias("d1"), F.when(none, F.col("doc_id")).otherwise(F.col("d2")).alias("d2"))
    ids = stage(sketch.where("doc_id is not null").groupBy("doc_id").agg(F.min(identity).alias("text")), "near-ids")
    groups = stage(ids.groupBy("text").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies")), "near-texts")
    nodes = groups.where("not text.none").select(F.col("node").alias("doc_id"), "text")

    def of_nodes(found, column):
        """One row (id, ``column``) of each node; the distinct uses the shuffle of the join."""
        mine = found.where("words > 0").select("doc_id", identity.alias("text"), column)
        return mine.join(nodes, ["doc_id", "text"]).dropDuplicates(["doc_id", "text"]).select(F.col("doc_id").alias("id"), column)

    chosen = stage(of_nodes(sketch, "keys"), "near-keys")
    unstage(sketch)
    banded = chosen.select("id", F.posexplode("keys").alias("band", "key"))
    sizes, _, size_bytes = stage_sized(banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-sizes")
    members = banded.join(F.broadcast(sizes) if size_bytes <= BROADCAST_BYTES else sizes, "key")
    # a text has one place a band at most
    people = stage(members.groupBy("id").agg(F.sum("n").alias("company"), F.collect_list(F.struct("key", "band")).alias("places")), "near-people")
    if pick is None:
        pick = lambda wanted: sized_join(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), wanted, ["doc_id"], "left_semi")
    member_sets = stage(of_nodes(shingle_sets(pick(people.select(F.col("id").alias("doc_id")))), "shingles"), "near-sets")
    marked = stage(chosen.join(people.select("id"), "id"), "near-marked")
    unstage(chosen, sizes)
    texts = groups.count()
    unknown = {c: F.lit(0).cast("long") for c in ("size", "common")}
    state, open_rows, _ = stage_sized(people.select("id", "company", F.col("id").alias("label"), F.inline("places")).withColumns(unknown), "near-state")
    labels = stage(people.select("id", F.col("id").alias("label")), "near-labels")
    unstage(people)
    # an intersection c is enough for the similarity s of sizes a and b if c (1 + s) >= s (a + b)
    enough = lambda c, sizes: c * (1 + similarity) + 1e-6 >= sizes * similarity
    fits = enough(F.least("common", "hub_common"), F.col("size") + F.col("hub_size"))
    hubs, weighed, first = 1, False, True
    while open_rows:
        named = state if "label" in state.columns else state.join(labels, "id")
        labelled = stage(named.withColumn("main", F.lit(False)), "near-labelled")
        unstage(state)
        per_label = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
        split = per_label.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"), F.max(F.struct("n", "label"))["label"].alias("largest"))
        # a bucket is done when all its members that were not compared with everyone are of one class
        open_ = stage(split.select("key", "largest", ((F.col("n") * F.col("n") - F.col("within")) / 2).alias("pairs")).where("pairs > 0"), "near-open")
        cost = open_.agg(F.sum("pairs")).first()[0] or 0
        if not cost:
            unstage(labelled, open_)
            break
        if first:  # every text is a class, so every bucket is open
            rest, first = labelled, False
        else:  # written, as all that follows in this round reads it
            rest = stage(labelled.join(open_.select("key", "largest"), "key").withColumn("main", F.col("label") == F.col("largest")).drop("largest"), "near-rest")
            unstage(labelled)
        unstage(open_)
        if hubs > 1 and not weighed:
            weighed = True
            weights = shared_weights(member_sets.join(rest.select("id").distinct(), "id"))
            able = weights.where(enough(F.col("common"), F.col("size") * (1 + similarity)))
            state, open_rows, _ = stage_sized(rest.drop("size", "common", "main").join(able, "id"), "near-state")
            unstage(rest)
            continue
        last = cost <= (PAIRS if weighed else FEW) * texts
        if last:
            # the largest class of a bucket is met by all others and not by itself: the rows that meet are at most twice the pairs between classes
            chosen = rest.where(~F.col("main"))
        else:
            by_company = Window.partitionBy("key").orderBy(F.desc("company"), "id")
            chosen = rest.withColumn("place", F.row_number().over(by_company)).where(F.col("place") <= hubs)
            hubs = HUBS
        chosen = chosen_hubs = stage(chosen.select("key", *[F.col(c).alias("hub" if c == "id" else f"hub_{c}") for c in ("id", "label", "size", "common")]), "near-hubs")
        if last:
            # a pair that shares an earlier band is left to that one
            signs = marked.select("id", "keys")
            mine = rest.join(signs, "id")
            chosen = chosen.join(signs.select(F.col("id").alias("hub"), F.col("keys").alias("hub_keys")), "hub")
            first_band = ~F.arrays_overlap(F.slice("keys", 1, F.col("band")), "hub_keys")
            once = F.col("main") | (F.col("id") < F.col("hub"))
            pairs = mine.join(chosen, (mine["key"] == chosen["key"]) & once & (F.col("label") != F.col("hub_label")) & fits & first_band)
        else:
            pairs = rest.join(chosen, "key").where((F.col("label") != F.col("hub_label")) & fits)
        pairs = pairs.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b"))
        held = member_sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
        other = member_sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
        tested = pairs.distinct().join(held, "a").join(other, "b").select("a", "b", "sa", "sb")
        links = stage(tested.mapInArrow(_verify(similarity), "a bigint, b bigint"), "near-links")
        ends = [labels.select(F.col("id").alias(x), F.col("label").alias("l" + x)) for x in "ab"]
        joined = components(links.join(ends[0], "a").join(ends[1], "b").select(F.col("la").alias("a"), F.col("lb").alias("b")), "near-roots")
        relabelled = stage(labels.join(joined.select(F.col("id").alias("label"), "root"), "label", "left").select("id", F.coalesce("root", "label").alias("label")), "near-labels")
        unstage(labels, links)
        labels = relabelled
        if last:
            unstage(rest, chosen_hubs, marked, member_sets)
            break
        # a hub was compared with every other class of its bucket and is done there
        others = rest.join(chosen.select("key", F.col("hub").alias("id")), ["key", "id"], "left_anti")
        state, open_rows, _ = stage_sized(others.select("key", "band", "id", "company", "size", "common"), "near-state")
        unstage(rest, chosen_hubs)
    classes = groups.join(labels.withColumnRenamed("id", "node"), "node", "left")
    classes = classes.select("text", F.coalesce("label", "node").alias("class_id"), "copies")
    return ids.join(classes, "text").select("doc_id", "class_id", "copies")
