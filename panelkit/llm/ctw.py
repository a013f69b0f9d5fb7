"""Language-model scoring by context-tree weighting over bytes.

Every byte is eight binary decisions, and every decision has a tree of contexts: the 0, 1, .. DEPTH
bytes before it. A ninth decision before each byte says whether the text ends there (``ends``). Zeros and ones are counted in the training texts at every node; a node's
Krichevsky-Trofimov estimate is weighted with what its children achieve, which mixes the
estimates of all depths. The counts, the weights and the code lengths are tables that grow with the corpus and
are made by grouping and joining; nothing is broadcast.

Texts are dealt into blocks. A block asks only for its distinct contexts and tokens, so
that the joins carry each of them once a block and not once a position.
"""

from __future__ import annotations

import math
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import LOWER, Finder, held_out, running_hash, span_hashes, spans, text_blocks
from panelkit.session import stage, unstage

DEPTH = 5
#: Rows of one Arrow batch of a block's keys.
TOLD = 1 << 17
BLOCK = 40 << 20
#: Set in the hash of a word, which tells it from a gram; as a signed number it is negative.
WORD = 1 << 63
#: Marks a gram whose last place is the end of the text instead of a byte.
END = 1 << 56
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def grams(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For every byte the number made of the ``depth`` bytes before it and itself; zero bytes stand before a text."""
    out = data.astype(np.uint64)
    size = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    for back in range(1, depth + 1):
        before = np.zeros(len(data), np.uint64)
        before[back:] = data[:-back]
        before[place < back] = 0
        out |= before << np.uint64(8 * back)
    return out


def end_grams(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For every text the number made of its last ``depth`` bytes and its end; zero bytes stand before a text."""
    size, out = np.diff(offsets), np.full(len(offsets) - 1, END, np.uint64)
    for back in range(1, depth + 1):
        far = np.flatnonzero(size >= back)
        out[far] |= data[offsets[1:][far] - back].astype(np.uint64) << np.uint64(8 * back)
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every word of lower-cased text: runs of other bytes than ASCII white space."""
    start, end, doc = spans(~BLANK[data], offsets)
    return span_hashes(running_hash(data), start, end) | np.uint64(WORD), doc


def _counted(keys: np.ndarray, learns: np.ndarray):
    """Distinct keys with their number in learning texts and in all texts."""
    taught, out = np.sort(keys[learns]), np.sort(keys)
    first = np.flatnonzero(np.append(True, out[1:] != out[:-1])) if len(out) else np.zeros(0, np.int64)
    distinct = out[first]
    total = np.diff(np.append(first, len(out)))
    known = np.searchsorted(taught, distinct, side="right") - np.searchsorted(taught, distinct, side="left")
    return distinct, known, total


def _packed(rows: pa.RecordBatch) -> bytes:
    """Rows as compressed Arrow data."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return out.getvalue().to_pybytes()


def _unpacked(rows: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def _blocked(limit: int):
    """Give consecutive rows of a partition a common block number until they hold ``limit`` bytes; about 1 MB of texts is packed into one row."""

    def run(batches):
        block, held = TaskContext.get().partitionId() << 24, 0
        for batch in batches:
            for first, end, data, _ in text_blocks(batch.column(2), 1 << 20):
                if held and held + len(data) > limit:
                    block, held = block + 1, 0
                held += len(data)
                part = pa.RecordBatch.from_arrays(batch.slice(first, end - first).columns, names=["doc_id", "held_out", "text"])
                taught = end - first - part.column(1).true_count
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([taught], pa.int64()), pa.array([_packed(part)], pa.binary())], names=["block", "taught", "rows"])

    return run


def _ask(batches, ends: bool = False):
    """The distinct words and contexts of each block with their counts; a block that two tasks read is told twice."""

    def merged(*parts):
        """Counted keys of several parts as one; every part has distinct keys in order."""
        key, known, total = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.argsort(key, kind="stable")
        key, known, total = key[order], known[order], total[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        return key[first], *(np.add.reduceat(x, first) if len(first) else x for x in (known, total))

    def taken(stack, part):
        """Put a part on a stack whose parts at least halve in size, so that merging copies little and holds few keys twice."""
        stack.append(tuple(x if x.dtype == np.uint64 else x.astype(np.int32) for x in part))
        while len(stack) > 1 and len(stack[-2][0]) < 2 * len(stack[-1][0]):
            last = stack.pop()
            stack.append(merged(stack.pop(), last))

    def told(block, found):
        for stack in found:
            while len(stack) > 1:
                last = stack.pop()
                stack.append(merged(stack.pop(), last))
            key, known, total = stack.pop() if stack else (np.zeros(0, np.uint64),) * 3
            for i in range(0, len(key), TOLD):
                part = slice(i, i + TOLD)
                columns = {"block": np.full(len(key[part]), block, np.int64), "key": key[part].view(np.int64)}
                yield pa.RecordBatch.from_pydict(columns | {"known": known[part].astype(np.int64), "total": total[part].astype(np.int64)})

    block, found = None, None
    for batch in batches:
        for number, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if number != block:
                if found:
                    yield from told(block, found)
                block, found = number, ([], [])
            texts = _unpacked(rows)
            learns = ~texts.column("held_out").to_numpy().astype(bool)
            for first, end, data, offsets in text_blocks(texts.column("text")):
                low, taught = LOWER[data], learns[first:end]
                key, doc = words(low, offsets)
                taken(found[0], _counted(key, taught[doc]))
                taken(found[1], _counted(grams(low, offsets), np.repeat(taught, np.diff(offsets))))
                if ends:
                    taken(found[1], _counted(end_grams(low, offsets), taught))
    if found:
        yield from told(block, found)


def log_gamma(x: Column) -> Column:
    """ln gamma(x) for x >= 1/2 by Stirling's series at x + 7."""
    y = x + 7
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    shift = F.log(x)
    for i in range(1, 7):
        shift = shift + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def kt(zeros: Column, ones: Column) -> Column:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def _bits(ends: bool) -> str:
    """The eight decisions of the last byte of ``gram``: decision node (a one and the bits so far) and bit. With ``ends`` node 0 comes first: a one if the text ends."""
    byte = "transform(sequence(0, 7), k -> struct(cast(shiftright((gram & 255) | 256, 8 - k) as int) AS m, cast(shiftright(gram & 255, 7 - k) & 1 as int) AS bit))"
    if ends:
        byte = f"CASE WHEN gram >= {END} THEN array(struct(0 AS m, 1 AS bit)) ELSE concat(array(struct(0 AS m, 0 AS bit)), {byte}) END"
    return byte


def _context() -> Column:
    """The bytes before the last place of ``gram``."""
    return F.shiftright(F.col("gram").bitwiseAND(END - 1), 8)


def _without_last(context: str, depth: int) -> Column:
    """The context with its farthest byte left out."""
    return F.col(context).bitwiseAND((1 << (8 * (depth - 1))) - 1)


def context_tree(counts: DataFrame, depth: int = DEPTH, ends: bool = False) -> list[DataFrame]:
    """The weighted tree of (gram, n), a table per depth with (x, m, p1): context, decision node, chance of a one. The deepest is not written; read it once.

    ``p1`` mixes the estimates of all depths down to this one; a context seen no deeper stops here.
    """
    deep = counts.select(_context().alias("x"), "n", F.explode(F.expr(_bits(ends))).alias("b"))
    zero = F.sum(F.when(F.col("b.bit") == 0, F.col("n")).otherwise(0))
    one = F.sum(F.when(F.col("b.bit") == 1, F.col("n")).otherwise(0))
    level = deep.groupBy("x", F.col("b.m").alias("m")).agg(zero.alias("zeros"), one.alias("ones"))
    estimate = kt(F.col("zeros").cast("double"), F.col("ones").cast("double"))
    level = stage(level.withColumn("weighted", estimate), "ctw-up")
    levels = {depth: level}
    for d in range(depth - 1, -1, -1):
        up = levels[d + 1].groupBy(_without_last("x", d + 1).alias("x"), "m").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
        up = up.withColumn("estimate", estimate)
        top, low = F.greatest("estimate", "below"), F.least("estimate", "below")
        levels[d] = stage(up.withColumn("weighted", top + F.log1p(F.exp(low - top)) - math.log(2)).drop("estimate", "below"), "ctw-up")
    found = []
    above = None
    for d in range(depth + 1):
        here = levels[d].withColumn("own", (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0))
        here = here.withColumn("share", F.lit(1.0) if d == depth else F.exp(estimate - math.log(2) - F.col("weighted")))
        if above is None:
            here = here.withColumn("mixed", F.lit(0.0)).withColumn("left", F.lit(1.0))
        else:
            here = here.withColumn("up", _without_last("x", d)).join(above, ["up", "m"]).drop("up")
        here = here.select("x", "m", "own", "share", "mixed", "left")
        p1 = (F.col("mixed") + F.col("left") * F.col("own")).alias("p1")
        if d == depth:
            found.append(here.select("x", "m", p1))
            break
        table = stage(here.select("x", "m", p1, (F.col("mixed") + F.col("left") * F.col("share") * F.col("own")).alias("mixed"), (F.col("left") * (1 - F.col("share"))).alias("left")), "ctw-down")
        unstage(levels[d])
        found.append(table)
        above = table.select(F.col("x").alias("up"), "m", "mixed", "left")
    return found


def code_lengths(asked: DataFrame, counts: DataFrame, depth: int = DEPTH, ends: bool = False) -> DataFrame:
    """(gram, value): log10 probability of the last byte (or of the end) of each distinct ``asked`` gram after the bytes before it.

    A decision never seen in a context is taken from the longest shorter context that saw it; one never
    seen at all has probability one half.
    """
    tree = context_tree(counts, depth, ends)
    # a gram asks a context once for all its decisions; only those not met there go on to a shorter one
    steps = _bits(ends)
    open_ = asked.select("gram", F.lit(None).cast("array<double>").alias("p"))
    value = f"CASE WHEN forall(p, x -> x IS NOT NULL) THEN aggregate(zip_with({steps}, p, (s, x) -> log10(IF(s.bit = 1, x, 1 - x))), 0D, (a, b) -> a + b) END"
    values = []
    for d in range(depth, -1, -1):
        nodes = tree[d].select("x", "m", "p1").groupBy("x").agg(F.map_from_entries(F.collect_list(F.struct("m", "p1"))).alias("nodes"))
        met = open_.withColumn("x", _context().bitwiseAND((1 << (8 * d)) - 1)).join(nodes, "x", "left")
        met = met.select("gram", F.expr(f"transform({steps}, (s, i) -> coalesce(p[i], try_element_at(nodes, s.m)))").alias("p"))
        met = met.withColumn("value", F.expr(value))
        met = stage(met.select("gram", "value", F.when(F.col("value").isNull(), F.col("p")).alias("p")), "ctw-met")
        unstage(tree[d])  # the deepest is no table, and all that it reads is kept
        values.append(met.where("value is not null").select("gram", "value"))
        open_ = met.where("value is null").select("gram", "p")
    never = open_.withColumn("p", F.expr("transform(p, x -> coalesce(x, 0.5D))"))
    return reduce(DataFrame.unionByName, [*values, never.select("gram", F.expr(value).alias("value"))])


def _score(unknown: float, ends: bool):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        texts = pa.concat_tables([_unpacked(rows) for rows in texts.column("rows")])
        key = answers.column("key").to_numpy().view(np.uint64)
        value = answers.column("value").to_numpy()
        sets = []
        for of_words in (True, False):
            own = np.flatnonzero((key >= np.uint64(WORD)) == of_words)
            distinct, first = np.unique(key[own], return_index=True)
            sets.append((Finder(distinct), value[own][first]))
        learns = ~texts.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        out = {"n_words": [], "n_seen": [], "n_bytes": [], "base": [], "score": []}
        for first, end, data, offsets in text_blocks(texts.column("text")):
            n = end - first
            low = LOWER[data]
            found, doc = words(low, offsets)
            at = sets[0][0].find(found)
            # a word that stands once in all texts has no answer: it is known only to its own text, if that one teaches
            count = np.where(at >= 0, sets[0][1][at] if len(sets[0][1]) else 0, learns[first:end][doc])
            out["n_words"].append(np.bincount(doc, minlength=n))
            out["n_bytes"].append(np.diff(offsets))
            out["n_seen"].append(np.bincount(doc[count > 0], minlength=n))
            out["base"].append(np.bincount(doc, np.log10(count + 1), n) + unknown * np.bincount(doc, minlength=n))
            where = sets[1][0].find(grams(low, offsets))
            if len(where) and where.min() < 0:
                raise ValueError("a context of this block has no code length")
            upto = np.append(0, np.cumsum(sets[1][1][where] if len(where) else []))
            total = upto[offsets[1:]] - upto[offsets[:-1]]
            if ends:
                where = sets[1][0].find(end_grams(low, offsets))
                if len(where) and where.min() < 0:
                    raise ValueError("an end of this block has no code length")
                total = total + sets[1][1][where]
            out["score"].append(total)
        columns = {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}
        return pa.Table.from_arrays(
            [texts.column("doc_id"), texts.column("held_out"), *(pa.array(columns[k], t) for k, t in (("n_words", pa.int64()), ("n_seen", pa.int64()), ("n_bytes", pa.int64()), ("base", pa.float64()), ("score", pa.float64())))],
            names=["doc_id", "held_out", "n_words", "n_seen", "n_bytes", "base", "score"],
        )

    return run


def score(docs: DataFrame, n: int = 7, rest: int = 2, block_bytes: int = BLOCK, ends: bool = False, code_length: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and, with ``code_length``, code_bits_per_byte of every row.

    Learned from the rows outside the held-out fold. ``base_score`` is that of a smoothed unigram over
    lower-cased words and one end per text; ``score`` the log10 probability of the bytes of the lower-cased text,
    with ``ends`` also of no end before each byte and of the end after the last, so that the texts' probabilities sum to one.
    ``code_bits_per_byte`` is the code length that the score stands for, per byte of the text; null for an empty text.
    A null text is an empty one, with the end as its only token (score 0 without ``ends``). Rows that repeat
    count and are scored each for itself; null ids are learned from; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(n, rest).alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = stage(rows.mapInArrow(_blocked(block_bytes), "block bigint, taught bigint, rows binary"), "ctw-texts")
    asked = stage(texts.select("block", "rows").mapInArrow(partial(_ask, ends=ends), "block bigint, key bigint, known bigint, total bigint"), "ctw-asked")
    taught = texts.agg(F.sum("taught")).first()[0] or 0
    counted = stage(asked.groupBy("key").agg(F.sum("known").alias("known"), F.sum("total").alias("total")), "ctw-counted")
    totals = counted.where("key < 0 and known > 0").agg(F.sum("known"), F.count(F.lit(1))).first()
    tokens, distinct = (totals[0] or 0) + taught, totals[1] + (1 if taught else 0)
    whole = counted.where("key >= 0").select(F.col("key").alias("gram"), F.col("known").alias("n"))
    lengths = code_lengths(whole.select("gram"), whole.where("n > 0"), ends=ends).select(F.col("gram").alias("key"), "value")
    often = counted.where("key < 0 and total > 1").select("key", F.col("known").cast("double").alias("value"))
    values = often.unionByName(lengths)
    answers = asked.select("block", "key").join(values, "key")
    unknown = -math.log10(tokens + distinct + 1)
    scored = texts.select("block", "rows").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(unknown, ends), "doc_id bigint, held_out boolean, n_words bigint, n_seen bigint, n_bytes bigint, base double, score double"
    )
    end_known = F.lit(1 if taught else 0)
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * math.log2(10) / F.col("n_bytes")).alias("code_bits_per_byte")
    return scored.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_seen") + end_known).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(taught + 1) + unknown).alias("base_score"),
        "score",
        *([bits] if code_length else []),
    )


