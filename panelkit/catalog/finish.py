"""Periods in the registry, quality reports, labels, chunks and sinks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelkit.catalog.base import query, table
from panelkit.catalog.basics import NEW_PERIODS_SQL, new_periods
from panelkit.operators import quality as Q
from panelkit.operators.labels import LabelSource, label_table, labels_in_use, metric_labels, present_labels
from panelkit.operators.lookup import lookup, miss_counts
from panelkit.operators.ranks import with_chunk
from panelkit.operators.registry import attach_periods, in_latest_batch, register_periods
from panelkit.operators.union import union_all
from panelkit.session import stage, staging_path
from panelkit.sources import sinks


def _registry(spark, sf_dir):
    """The periods before 1999, numbered in label order, one batch a year.

    There are at most four durations in each month, so one task can number them.
    """
    old = new_periods(spark, sf_dir).filter("year < 1999")
    periods = old.select("period_lbl", "label_num", "year").distinct()
    number = F.row_number().over(Window.orderBy("label_num"))
    return periods.select(
        "period_lbl",
        "label_num",
        F.lit("2024-01-01").alias("date_added"),
        number.alias("period_code"),
        (F.col("year") - 1994).alias("period_batch"),
    )


REGISTRY_SQL = f"""WITH labelled AS ({NEW_PERIODS_SQL}),
    old AS (SELECT period_lbl, label_num, '2024-01-01' AS date_added,
        CAST(row_number() OVER (ORDER BY label_num) AS INTEGER) AS period_code,
        CAST("year" - 1994 AS INTEGER) AS period_batch
      FROM (SELECT DISTINCT period_lbl, label_num, "year" FROM labelled WHERE "year" < 1999)),
    registry AS (SELECT * FROM old UNION ALL
      SELECT period_lbl, label_num, '2024-06-01',
        CAST((SELECT max(period_code) FROM old) + row_number() OVER (ORDER BY "year", "month", duration) AS INTEGER),
        CAST((SELECT max(period_batch) FROM old) + 1 AS INTEGER)
      FROM (SELECT DISTINCT duration, "year", "month", period_lbl, label_num FROM labelled
        WHERE period_lbl NOT IN (SELECT period_lbl FROM old)))"""


def _registered(spark, sf_dir):
    """The registry with the later periods added, through a written version."""
    path = staging_path(spark, "registry")
    sinks.write_version(_registry(spark, sf_dir), path, 1)
    registry, version = sinks.latest_version(spark, path)
    grown = register_periods(new_periods(spark, sf_dir), registry, "2024-06-01")
    sinks.write_version(grown, path, version + 1)
    return sinks.latest_version(spark, path)[0]


@query(f"{REGISTRY_SQL} SELECT * FROM registry")
def period_registry(spark, sf_dir):
    return _registered(spark, sf_dir)


@query(
    f"""{REGISTRY_SQL} SELECT o_orderkey, duration, "year", label_num, date_added, period_code AS period_lbl,
      CAST(CASE time_period_type WHEN '3MMT/ 12we' THEN 1 WHEN 'MAT/ 52 we' THEN 2 WHEN '2MATs/ 104 we' THEN 3
        ELSE 4 END AS INTEGER) AS time_period_type
    FROM labelled LEFT JOIN registry USING (period_lbl, label_num)"""
)
def period_attach(spark, sf_dir):
    facts = new_periods(spark, sf_dir)
    code = F.when(F.col("duration") == 3, 1).when(F.col("duration") == 12, 2).when(F.col("duration") == 24, 3)
    types = facts.select("time_period_type", code.otherwise(4).alias("time_period_code")).distinct()
    return attach_periods(facts, _registered(spark, sf_dir), types)


@query(
    f"""{REGISTRY_SQL} SELECT o_orderkey, period_code FROM labelled JOIN registry USING (period_lbl)
    WHERE period_batch = (SELECT max(period_batch) FROM registry)"""
)
def latest_batch(spark, sf_dir):
    registry = _registered(spark, sf_dir)
    facts = new_periods(spark, sf_dir).join(registry.select("period_lbl", "period_code"), "period_lbl")
    return in_latest_batch(facts.select("o_orderkey", "period_code"), registry, "period_code")


def _labelled_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query(
    """WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
    SELECT * FROM (SELECT 'quality' AS column_name, count(*) - count(quality) AS nulls FROM d
      UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM d
      UNION ALL SELECT 'lang', count(*) - count(lang) FROM d) WHERE nulls > 0"""
)
def null_report(spark, sf_dir):
    return Q.null_counts(_labelled_documents(spark, sf_dir))


@query(
    """WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
    SELECT 'quality' AS variable, count(*) - count(quality) AS misses FROM d
    UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM d"""
)
def unmatched_report(spark, sf_dir):
    """Documents without a label, counted per looked-up column."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return miss_counts(lookup(documents, table(spark, sf_dir, "labels"), ["doc_id"]), ["quality", "toxic"])


@query(
    """WITH g AS (SELECT count(*) AS n FROM documents GROUP BY text, lang)
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows,
      CAST(sum(n) - count(*) AS BIGINT) AS repeated_rows FROM g"""
)
def duplicate_report(spark, sf_dir):
    """Documents with the same text and language; whole texts are compared by their digest,
    so that no text is shuffled."""
    documents = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text"), "lang")
    return Q.duplicate_counts(documents, ignore=["doc_id"])


@query(
    """SELECT 'documents' AS step, count(*) AS n_rows, 4 AS n_columns FROM documents
    UNION ALL SELECT 'with labels', count(*), 6 FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'labelled', count(*), 6 FROM documents JOIN labels USING (doc_id)"""
)
def shape_report(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    both = _labelled_documents(spark, sf_dir)
    return union_all(
        [Q.shape(documents, "documents"), Q.shape(both, "with labels"), Q.shape(both.dropna(subset=["quality"]), "labelled")]
    )


@query(
    """WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
    SELECT count(*) AS n_rows, count(*) - count(quality) AS missing_quality FROM d"""
)
def counts_while_writing(spark, sf_dir):
    """Row and null counts taken by the write itself, without a second pass."""
    df, seen = Q.observed(_labelled_documents(spark, sf_dir), "documents")
    sinks.write_parquet(df, staging_path(spark, "observed"), level=12)
    counts = seen.get
    return spark.createDataFrame(
        [(counts["__rows"], counts["quality"])], "n_rows long, missing_quality long"
    )


def _coded_customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.nullif("c_nationkey", F.lit(3)).alias("nation"), F.col("c_mktsegment").alias("segment"), "c_acctbal"
    )


def _label_sources(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").filter("n_regionkey <> 0")
    customer = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    return [
        LabelSource("nation", nation, "n_nationkey", "n_name"),
        LabelSource("segment", customer, "c_mktsegment", "c_name"),
        LabelSource("absent", table(spark, sf_dir, "region"), "r_regionkey", "r_name"),
    ]


LABELS_SQL = """labels_long AS (
      SELECT 'nation' AS variable, CAST(n_nationkey AS VARCHAR) AS code, n_name AS label FROM nation WHERE n_regionkey <> 0
      UNION ALL SELECT 'segment', c_mktsegment, max(c_name) FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 2
      UNION ALL SELECT 'absent', CAST(r_regionkey AS VARCHAR), r_name FROM region)"""


@query(f"WITH {LABELS_SQL} SELECT * FROM labels_long WHERE variable IN ('nation', 'segment')")
def label_table_present(spark, sf_dir):
    """All labels of the variables in the data; of repeated codes the last label counts."""
    labels = label_table(_label_sources(spark, sf_dir))
    return present_labels(labels, _coded_customers(spark, sf_dir))


USED_SQL = """used AS (SELECT DISTINCT 'nation' AS variable, CAST(nullif(c_nationkey, 3) AS VARCHAR) AS code FROM customer
      UNION SELECT DISTINCT 'segment', c_mktsegment FROM customer)"""


def _uncovered(spark, sf_dir):
    labels = label_table(_label_sources(spark, sf_dir))
    return Q.uncovered_codes(_coded_customers(spark, sf_dir), labels, ["nation", "segment", "absent"])


@query(f"WITH {USED_SQL} SELECT * FROM used")
def codes_in_use(spark, sf_dir):
    return Q.codes_in_use(_coded_customers(spark, sf_dir), ["nation", "segment"])


@query(
    f"""WITH {LABELS_SQL}, {USED_SQL} SELECT u.* FROM used u WHERE NOT EXISTS (
      SELECT 1 FROM labels_long l WHERE l.variable = u.variable AND l.code IS NOT DISTINCT FROM u.code)"""
)
def code_coverage(spark, sf_dir):
    return _uncovered(spark, sf_dir)


@query(
    f"""WITH {LABELS_SQL}, {USED_SQL} SELECT l.* FROM labels_long l WHERE EXISTS (
      SELECT 1 FROM used u WHERE l.variable = u.variable AND l.code = u.code)"""
)
def label_table_in_use(spark, sf_dir):
    used = Q.codes_in_use(_coded_customers(spark, sf_dir), ["nation", "segment"])
    return labels_in_use(label_table(_label_sources(spark, sf_dir)), used)


@query(
    """SELECT DISTINCT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS "year", c_mktsegment, n_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
)
def coverage_table(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return Q.coverage(joined, ["o_orderstatus", "year", "c_mktsegment", "n_name"])


@query(
    """SELECT o_orderkey, o_orderstatus,
      (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS chunk FROM orders"""
)
def chunk_numbers(spark, sf_dir):
    """Chunks the way they are numbered when a category does not fit one task."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return with_chunk(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], 1000, one_task_rows=0).drop("o_orderdate")


@query("SELECT o_orderstatus, count(*) AS n_rows, true AS within_limit FROM orders GROUP BY 1")
def chunk_files(spark, sf_dir):
    """Files of at most 1,000 rows below one folder per category."""
    path = staging_path(spark, "chunks")
    sinks.write_chunks(table(spark, sf_dir, "orders"), path, "o_orderstatus", 1000)
    per_file = spark.read.parquet(path).groupBy("o_orderstatus", F.col("_metadata.file_path").alias("f")).count()
    return per_file.groupBy("o_orderstatus").agg(
        F.sum("count").alias("n_rows"), (F.max("count") <= 1000).alias("within_limit")
    )


@query(
    """SELECT o_orderstatus, chunk, count(*) AS n_rows FROM (SELECT o_orderstatus, CAST((row_number() OVER
      (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey) - 1) // 1000 AS INTEGER) AS chunk FROM orders)
    GROUP BY ALL"""
)
def numbered_chunk_folders(spark, sf_dir):
    path = staging_path(spark, "numbered")
    orders = table(spark, sf_dir, "orders")
    chunked = with_chunk(orders, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], 1000)
    sinks.write_numbered_chunks(chunked, path, "o_orderstatus")
    return spark.read.parquet(path).groupBy("o_orderstatus", "chunk").agg(F.count("*").alias("n_rows"))


@query(
    f"""WITH {LABELS_SQL} SELECT variable, code, label FROM labels_long WHERE variable IN ('nation', 'segment')
    UNION ALL SELECT 'nation', NULL, 'nation' UNION ALL SELECT 'segment', NULL, 'segment'
    UNION ALL SELECT 'c_acctbal', NULL, 'Account balance'"""
)
def label_sidecar(spark, sf_dir):
    """Value labels and variable labels written beside the data and read back."""
    df = _coded_customers(spark, sf_dir)
    path = staging_path(spark, "sidecar")
    values = present_labels(label_table(_label_sources(spark, sf_dir)), df)
    sinks.write_labels(path, values, metric_labels(spark, df, {"c_acctbal": "Account balance"}))
    written = [spark.read.parquet(f"{path}/{part}") for part in ("value_labels", "variable_labels")]
    return union_all(written, fill=True)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O') UNION ALL SELECT o_orderkey, 'again' FROM orders WHERE o_orderstatus = 'P'")
def publish_reload_append(spark, sf_dir):
    """A reload replaces what was published before, an append adds to it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = staging_path(spark, "published")
    sinks.publish([orders], path, "append")
    sinks.publish([orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus = 'O'")], path, "reload")
    late = orders.filter("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("again"))
    sinks.publish([late], path, "append")
    return sinks.published(spark, path)


@query("SELECT c_mktsegment, count(*) AS n_customers FROM customer GROUP BY 1")
def staged_reuse(spark, sf_dir):
    """The second call finds the stored result and does not build another."""
    counts = table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("n_customers"))
    path = staging_path(spark, "reused")
    sinks.reuse_or_build(spark, path, lambda: counts)
    return sinks.reuse_or_build(spark, path, lambda: counts.limit(0))


@query(
    f"""WITH {LABELS_SQL}, {USED_SQL} SELECT u.* FROM used u WHERE NOT EXISTS (
      SELECT 1 FROM labels_long l WHERE l.variable = u.variable AND l.code IS NOT DISTINCT FROM u.code)"""
)
def report_write(spark, sf_dir):
    report = stage(_uncovered(spark, sf_dir), "report")
    path = staging_path(spark, "uncovered")
    sinks.write_report(report, path)
    return spark.read.parquet(path)


@query(
    """SELECT 'unlabelled' AS finding, 'o_orderkey' AS column_name, count(o_orderkey) AS n_values FROM orders
    UNION ALL SELECT 'unlabelled', 'o_custkey', count(o_custkey) FROM orders
    UNION ALL SELECT 'unlabelled', 'o_orderdate', count(o_orderdate) FROM orders
    UNION ALL SELECT 'unlabelled', 'o_orderpriority', count(o_orderpriority) FROM orders
    UNION ALL SELECT 'missing', 'o_margin', 0"""
)
def column_report(spark, sf_dir):
    """Wanted columns that are absent, and key columns without labels, with their values."""
    orders = table(spark, sf_dir, "orders")
    missing = Q.missing_columns(orders, ["o_orderkey", "o_margin"])
    unlabelled = Q.columns_without_labels(orders, ["o_orderstatus"])
    counts = orders.agg(
        *[F.count(c).alias(c) for c in unlabelled], *[F.lit(0).cast("long").alias(c) for c in missing]
    ).unpivot([], [*unlabelled, *missing], "column_name", "n_values")
    finding = F.when(F.col("column_name").isin(missing), "missing").otherwise("unlabelled")
    return counts.select(finding.alias("finding"), "column_name", "n_values")
