"""Fill-in-middle by counted quantifiers: one regular-expression match cuts a text into prefix, middle and suffix.

``regexp_count`` tells how many units (lines) a text has. Two numbers drawn from the id's hash then make a
pattern of the row's own, ``(unit{a}+)(unit{b-a}+)(rest)``, and a single replacement by it writes
the three groups in the order of the form. The quantifiers are possessive: the engine walks them in a loop and keeps
no state to go back to, so texts of any number of lines fit the stack. All of it are SQL functions; a row
needs no other row, nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its end, or a last line without one.
LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(id: Column, seed: int) -> list[Column]:
    """Four numbers from 0 to 2^32 - 1 that the id and the seed alone decide; a null id draws as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, unit: str = LINE, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(``id``, n, form, prefix_chars, middle_chars, output) of every row.

    ``n`` units are cut after the smaller and the larger of two draws. ``rate`` per cent of the rows are rearranged, ``spm``
    per cent of these with the suffix first; the others stay ``plain``, and so do empty texts and those that hold one of
    the signs ``<P>``, ``<S>``, ``<M>``. A null text counts as empty. Lengths are code points, null for plain rows.
    Rows stand for themselves: repeated ids draw alike, null ids draw as one more id. Other columns are
    ignored, whatever their names. ``unit`` must match a text from end to end without gaps, never an empty string, and
    have no capturing groups.
    """
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id}`").alias("id"), whole.alias("whole"), *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col(f"`{id}`"), seed), 1)])
    rows = rows.withColumn("n", F.regexp_count("whole", F.lit(unit)).cast("long"))
    signs = F.contains("whole", F.lit(PREFIX)) | F.contains("whole", F.lit(SUFFIX)) | F.contains("whole", F.lit(MIDDLE))
    form = F.when((F.col("n") == 0) | signs | (F.col("h3") % 100 >= rate), PLAIN).when(F.col("h4") % 100 < spm, SPM).otherwise(PSM)
    cuts = [F.col("h1") % (F.col("n") + 1), F.col("h2") % (F.col("n") + 1)]
    rows = rows.select("id", "whole", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    part = f"((?:{unit})".replace("%", "%%") + "{%d}+)"
    pattern = F.format_string(rf"(?s)\A{part}{part}(.*+)\z", "a", F.col("b") - F.col("a"))
    order = F.when(F.col("form") == SPM, f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == PLAIN, F.col("whole")).otherwise(F.regexp_replace("whole", pattern, order))
    rows = rows.select("id", "n", "form", output.alias("output"))
    at = {sign: F.locate(sign, F.col("output")).cast("long") for sign in (PREFIX, SUFFIX, MIDDLE)}
    head = F.when(F.col("form") == PSM, at[SUFFIX] - at[PREFIX]).when(F.col("form") == SPM, at[MIDDLE] - at[PREFIX]) - len(PREFIX)
    tail = F.when(F.col("form") != PLAIN, F.char_length("output") - at[MIDDLE] + 1 - len(MIDDLE)).cast("long")
    return rows.select(F.col("id").alias(id), "n", "form", head.alias("prefix_chars"), tail.alias("middle_chars"), "output")


def restored(form: Column, output: Column) -> Column:
    """The text that ``fill_in_middle`` rearranged. The signs are in no rearranged text, so the first of each is the one that was set."""
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\z", "$2$3$1")
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
