"""The corpus pipeline: toxic and unreadable texts go, then repeated lines, then near copies; the rest is packed.

Every stage works on all documents its predecessor kept. Its result is written below
``spark.checkpoint.dir`` and read again, so a lost executor never costs more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import langid, line_dedup, near_dedup, packing, toxicity
from panelkit.llm.common import held_out, ranked
from panelkit.llm.queries import tokenizer_path
from panelkit.operators.skew import sized_join
from panelkit.session import stage, unstage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a model learned from these documents and the labels of ``sf_dir``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters in which the network finds a language about as surely as where it is known to be right.

    The bound is the lowest score of a rightly predicted document of the held-out fold; without such there
    is none. A document predicted as it is labelled stays whatever its score.
    """
    rows = langid.predict(docs, langid.fit(docs)).withColumn("held_out", held_out(5, 0))
    found = stage(rows, "language-found")
    right = F.coalesce(F.col("lang_pred") == F.col("lang"), F.lit(False))
    least = found.where(right & F.col("held_out") & (F.col("lang_pred") != "und")).agg(F.min("score")).first()[0] or 0.0
    return found.where((F.col("lang_pred") != "und") & (right | (F.col("score") >= least))).select(*COLUMNS)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated line runs; those of which nothing is left go."""
    found = line_dedup.dedup_lines(docs)
    kept = found.where("dropped_lines = 0 or trim(text) <> ''")
    return kept.withColumn("n_chars", F.when(F.col("dropped_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, that of the smallest id; rows without id come last.

    Every distinct pair of id and text (two hashes) is numbered, in order of the ids, and compared under its number. What stays
    is decided on numbers; the texts are only read again and filtered. Of rows equal in id and text that with the smallest
    other columns stays.
    """
    text = F.col("text").cast("string")
    digests = [F.xxhash64(text.isNull(), text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]
    keys = ["doc_id", "h1", "h2"]
    hashed = docs.select(*COLUMNS, *digests)
    pairs = hashed.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).withColumn("none", F.col("doc_id").isNull())
    numbers = stage(ranked(pairs, ["none", *keys], "number", "corpus-order"), "corpus-numbers")
    numbered = sized_join(hashed.select(*keys, "text"), numbers.select(*keys, "number"), keys, "inner")
    rows = numbered.select(F.col("number").alias("doc_id"), "text")

    def pick(wanted: DataFrame) -> DataFrame:
        """The texts of some numbers, found by the keys of these alone."""
        some = sized_join(numbers, wanted.withColumnRenamed("doc_id", "number"), ["number"], "left_semi")
        return sized_join(hashed.select(*keys, "text"), some.select(*keys, "number"), keys, "inner").select(F.col("number").alias("doc_id"), "text")

    classes = stage(near_dedup.near_classes(rows, pick=pick), "corpus-classes")
    first = classes.groupBy("class_id").agg(F.min("doc_id").alias("number")).select("number")
    winners = stage(sized_join(numbers, first, ["number"], "left_semi").select(*keys, "copies"), "corpus-winners")
    unstage(classes, numbers)
    kept = sized_join(hashed, winners, keys, "inner")
    rest = [c for c in COLUMNS if c != "doc_id"]
    once = kept.where("copies = 1").select(*COLUMNS)
    several = kept.where("copies > 1").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return once.unionByName(several.select("doc_id", "row.*"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token sequences: one row per piece of a document."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("language", known_language),
    ("line_dedup", distinct_lines),
    ("near_dedup", one_of_each),
    ("packing", packed),
]

#: Learned models, suffix arrays and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return docs
