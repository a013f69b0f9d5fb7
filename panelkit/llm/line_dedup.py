"""Line deduplication by a suffix array of line ids, made with distributed prefix doubling.

Only lines that occur more than once can belong to a repeated run, so the array covers just
them. Round by round the rank of a suffix by its first 1, 2, 4, .. lines is made from two ranks of
half the length, until no rank is told apart any more: then suffixes of one rank are equal to the
end of their runs. Neighbouring ranks are compared for their longest common prefix, and cutting the
array wherever that is shorter than m lines leaves the intervals of suffixes that share m lines. Of
every interval whose m lines are long enough all places but the first in the corpus are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import ranked
from panelkit.operators.skew import sized_join
from panelkit.session import stage, stage_sized, unstage

MIN_WORDS = 30
#: White space of any script, a letter of a script without blanks, and all other signs, as Java's regular expressions name them.
SPACE = r"\p{IsWhite_Space}"
_UNSPACED = "Han Hiragana Katakana Bopomofo Yi Thai Lao Khmer Myanmar Tibetan Tai_Le New_Tai_Lue Tai_Tham Tai_Viet Javanese Balinese"
LETTER = "[\\p{L}&&[" + "".join(rf"\p{{Is{x}}}" for x in _UNSPACED.split()) + "]]"
OTHER = f"[^{SPACE}{LETTER}]"


def line_table(docs: DataFrame) -> DataFrame:
    """(d1, d2, pos, h1, h2, words) of every line. d1, d2 identify a document by its id and its text.

    A line id is two hashes of the line without outer blanks. Its words are runs without white space, with
    every letter of a script written without blanks a word of its own; a line without words counts as one.
    """
    text = F.col("text").cast("string")
    lines = docs.where(text.isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long")).alias("d1"),
        F.xxhash64(text).alias("d2"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    line = F.btrim("line", F.lit(" \t\r"))
    return lines.select("d1", "d2", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line).alias("h2"), words_of(line).alias("words"))


def words_of(line: Column) -> Column:
    """The number of words of a line, by counting blanks where that is enough.

    It is not for lines with white space beyond ASCII or signs from U+0E00 on, where the scripts without blanks
    lie, nor for those with several blanks in a row; they go through a regular expression.
    """
    plain = F.btrim(F.translate(line, "\t\v\f\r", "    "))
    # each word, with the white space around it, becomes one sign
    signs = F.length(F.regexp_replace(line, rf"{SPACE}*(?:{LETTER}\p{{M}}*|{OTHER}+){SPACE}*", "x"))
    by_sign = F.when(line.rlike(r"[^\p{IsWhite_Space}]"), signs).otherwise(1)
    blanks = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit("")))
    ascii_ = F.octet_length(plain) == F.length(plain)
    other = ~ascii_ & plain.rlike(r"[\x{85}\x{a0}\x{0e00}-\x{10ffff}]")
    return F.when(plain == "", 1).when(F.contains(plain, F.lit("  ")) | other, by_sign).otherwise(blanks + 1)


def suffix_ranks(runs: DataFrame) -> tuple[DataFrame, int]:
    """``runs`` with ``line``, the number of the line id, and ``rank``, that of the suffix; and the number of ranks.

    Ranks are 0, 1, .. in the order of a suffix array over the line numbers; a run that ends early counts as followed
    by -1. Equal ranks mean equal suffixes. Doubling ends with the first round that tells no two suffixes apart, as no later one would.
    """
    keys = ranked(runs.select("h1", "h2").distinct(), ["h1", "h2"], "line", "line-keys")
    table = stage(sized_join(runs, keys, ["h1", "h2"], "inner").drop("h1", "h2").withColumn("rank", F.col("line")), "line-ranks")
    known, step = keys.count(), 1
    unstage(keys)
    while True:
        along = Window.partitionBy("d1", "d2", "run").orderBy("pos")
        ahead = F.coalesce(F.lead("rank", step).over(along), F.lit(-1).cast("long"))
        paired = stage(table.withColumn("ahead", ahead), "line-pairs")
        pairs = ranked(paired.select("rank", "ahead").distinct(), ["rank", "ahead"], "longer", "line-keys")
        found = pairs.count()
        if found == known:
            unstage(paired, pairs)
            return table, known
        longer = stage(sized_join(paired, pairs, ["rank", "ahead"], "inner").drop("ahead", "rank").withColumnRenamed("longer", "rank"), "line-ranks")
        unstage(table, paired, pairs)
        table, known, step = longer, found, 2 * step


def common_prefixes(table: DataFrame, longest: int) -> DataFrame:
    """(rank, lcp) of every rank of ``suffix_ranks``: how many lines it shares with the rank before it.

    Lines are compared up to ``longest``. The first rank shares none.
    """
    onward = Window.partitionBy("d1", "d2", "run").orderBy("pos").rowsBetween(0, longest - 1)
    suffixes = table.select("rank", F.collect_list("line").over(onward).alias("lines"))
    classes = stage(suffixes.groupBy("rank").agg(F.first("lines").alias("lines")), "line-suffixes")
    above = classes.select((F.col("rank") + 1).alias("rank"), F.col("lines").alias("above"))
    # the shorter one is filled up with nulls, which equal no line
    differs = F.array_position(F.zip_with("lines", "above", lambda x, y: x.eqNullSafe(y)), False)
    shared = F.when(F.col("above").isNull(), 0).when(differs == 0, F.size("lines")).otherwise(differs - 1)
    found = stage(classes.join(above, "rank", "left").select("rank", shared.cast("int").alias("lcp")), "line-prefixes")
    unstage(classes)
    return found


def interval_starts(prefixes: DataFrame, count: int, longest: int) -> DataFrame:
    """(rank, starts) of every rank: ``starts[m - 1]`` is the first rank of the interval that shares m lines with it, m up to ``longest``.

    That is the last rank, up to its own, whose common prefix is shorter than m. The array is scanned in pieces of consecutive
    ranks, at most 10,000 of them; what a piece hands on to the next are ``longest`` numbers.
    """
    size = max(1 << 14, -(-count // 10_000))
    pieces = prefixes.withColumn("piece", F.floor(F.col("rank") / size))
    names = [f"s{m}" for m in range(1, longest + 1)]
    cuts = [F.max(F.when(F.col("lcp") < m, F.col("rank"))) for m in range(1, longest + 1)]
    ends = pieces.groupBy("piece").agg(*[c.alias(n) for n, c in zip(names, cuts, strict=True)])
    before = Window.partitionBy(F.lit(0)).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select("piece", *[F.max(n).over(before).alias(n) for n in names])
    within = Window.partitionBy("piece").orderBy("rank")
    scanned = pieces.select("rank", "piece", *[c.over(within).alias(f"own_{n}") for n, c in zip(names, cuts, strict=True)])
    joined = scanned.join(F.broadcast(handed), "piece")
    return joined.select("rank", F.array(*[F.coalesce(f"own_{n}", n) for n in names]).alias("starts"))


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d1, d2, spans) of documents with lines to delete; spans: array of (first line, end line).

    A line goes if it lies in a run of lines with ``min_words`` words or more (an empty line
    counts as one) that also stands earlier: in a document of smaller id, or higher up in the same one.
    """
    lines = stage(line_table(docs), "lines")
    often = lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    often, _, bytes_ = stage_sized(often, "line-often")
    repeated = sized_join(lines, often, ["h1", "h2"], "inner", measured=bytes_).dropDuplicates(["d1", "d2", "pos"])
    in_doc = Window.partitionBy("d1", "d2").orderBy("pos")
    run = Window.partitionBy("d1", "d2", "run").orderBy("pos")
    runs = (
        repeated.withColumn("run", F.col("pos") - F.row_number().over(in_doc))
        .withColumn("upto", F.sum("words").over(run))
        .withColumn("total", F.sum("words").over(Window.partitionBy("d1", "d2", "run")))
        .withColumn("before", F.col("upto") - F.col("words"))
    )
    ahead = Window.partitionBy("d1", "d2", "run").orderBy("before").rangeBetween(0, min_words - 1)
    behind = Window.partitionBy("d1", "d2", "run").orderBy("upto").rangeBetween(-(min_words - 1), 0)
    runs = stage(
        runs.withColumn("forward", F.when(F.col("total") - F.col("before") >= min_words, F.count(F.lit(1)).over(ahead)))
        .withColumn("backward", F.when(F.col("upto") >= min_words, F.count(F.lit(1)).over(behind)))
        .where(F.col("total") >= min_words)
        .drop("words", "upto", "before", "total"),
        "line-runs",
    )
    unstage(lines, often)
    longest = runs.agg(F.max(F.greatest("forward", "backward"))).first()[0] or 1
    table, count = suffix_ranks(runs)
    place = ["d1", "d2", "run", "pos"]
    back = table.where("backward is not null").select("d1", "d2", "run", (F.col("pos") - F.col("backward") + 1).cast("int").alias("pos"), F.col("backward").alias("m"))
    stretches = (
        table.where("forward is not null").select(*place, "rank", F.col("forward").alias("m"))
        .unionByName(back.join(table.select(*place, "rank"), place))
        .select("d1", "d2", "pos", "m", "rank")
        .distinct()
    )
    stretches = stage(stretches, "line-stretches")
    prefixes = common_prefixes(table, longest)
    starts, _, bytes_ = stage_sized(interval_starts(prefixes, count, longest), "line-intervals")
    unstage(runs, table, prefixes)
    both = sized_join(stretches, starts, ["rank"], "inner", measured=bytes_).select("d1", "d2", "pos", "m", F.expr("starts[m - 1]").alias("start"))
    both = stage(both, "line-places")
    unstage(stretches, starts)
    first = both.groupBy("m", "start").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d1", "d2", "pos")).alias("first")).where("n > 1").drop("n")
    later = sized_join(both, first, ["m", "start"], "inner").where("struct(d1, d2, pos) > first").select("d1", "d2", F.col("pos").alias("s"), (F.col("pos") + F.col("m")).cast("int").alias("e"))
    by_doc = Window.partitionBy("d1", "d2").orderBy("s", "e")
    reached = F.max("e").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.distinct().withColumn("new", F.when(F.coalesce(reached, F.lit(-1)) < F.col("s"), 1).otherwise(0)).withColumn("island", F.sum("new").over(by_doc))
    merged = islands.groupBy("d1", "d2", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return merged.groupBy("d1", "d2").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated runs of lines taken out of ``text``, and n_lines, dropped_lines.

    Of every run of lines with ``min_words`` words or more that occurs more than once, whether in
    one document or in several, the first copy by (doc_id, line) stays. All rows are returned; a text of which
    nothing stays is empty. Null and empty texts are unchanged (0 and 1 lines); rows equal in id and
    text are one document and fare alike; a null id comes before all others. Other columns stay as they are.
    """
    spans, _, bytes_ = stage_sized(repeated_spans(docs, min_words), "line-spans")
    text = F.col("text").cast("string")
    keyed = docs.withColumn("__d1", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)).cast("long"))).withColumn("__d2", F.xxhash64(text))
    side = spans.select(F.col("d1").alias("__d1"), F.col("d2").alias("__d2"), F.col("spans").alias("__spans"))
    joined = sized_join(keyed, side, ["__d1", "__d2"], "left", measured=2 * bytes_)
    lines = F.split(text, "\n", -1)
    outside = lambda _, i: ~F.exists("__spans", lambda s: (i >= s["s"]) & (i < s["e"]))
    kept = F.filter(lines, outside)
    has = F.col("__spans").isNotNull()
    return (
        joined.withColumn("n_lines", F.when(text.isNull(), 0).otherwise(F.size(lines)))
        .withColumn("dropped_lines", F.when(has, F.aggregate("__spans", F.lit(0), lambda n, s: n + s["e"] - s["s"])).otherwise(0))
        .withColumn("text", F.when(has, F.array_join(kept, "\n")).otherwise(text))
        .drop("__d1", "__d2", "__spans")
    )
