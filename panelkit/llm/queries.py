"""The registered queries of the text operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import byte_bpe, ctw, fim, fp_tree, hilbert, langid, line_dedup, near_dedup, packing, pieces, quality, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    """WITH parts AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    v AS (SELECT vec_id, i, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM parts),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score FROM v q JOIN v c ON q.i = c.i
          WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id GROUP BY ALL),
    r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""
)
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's 20 highest integer inner products over all embeddings."""
    rows = read(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where("vec_id % 20 = 0"), 20)


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(read(spark, sf_dir, "documents"))


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of repeated line runs."""
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "dropped_lines", F.length("text").cast("long").alias("kept_chars"), "text")


@query()
def op6_sentencepiece_n_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four best segmentations of every document, as checksums of their ids, and whether they decode to the text."""
    return pieces.digests(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query()
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies of every document."""
    return near_dedup.near_classes(read(spark, sf_dir, "documents"))


@query()
def op8_space_filling_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's 5 nearest embeddings by cosine, as far as the curves find them."""
    rows = read(spark, sf_dir, "embeddings")
    return hilbert.neighbours(rows, rows.where("vec_id % 50 = 0"), 5)


@query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens, with the checksum of their ids."""
    pieces = packing.pack(read(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query()
def op10_context_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document with its end under the context tree, and under smoothed unigrams."""
    return ctw.score(read(spark, sf_dir, "documents"), ends=True, code_length=True)


@query()
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of the ids of every document and of the bytes that they decode to."""
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents"), path).withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = byte_bpe.decode(encoded, path, "ids_sha256")
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))


@query(
    """WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
    h AS (SELECT *, string_split(t, chr(10)) AS parts, [CAST('0x' || s[1 + 8 * i:8 + 8 * i] AS BIGINT) FOR i IN range(4)] AS h FROM t),
    n AS (SELECT *, CAST(len(parts) - CASE WHEN parts[len(parts)] = '' THEN 1 ELSE 0 END AS BIGINT) AS n FROM h),
    c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
               WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n),
    u AS (SELECT *, CASE WHEN a = 0 THEN '' WHEN a = n THEN t ELSE array_to_string(parts[1:a], chr(10)) || chr(10) END AS p,
          CASE WHEN b = 0 THEN '' WHEN b = n THEN t ELSE array_to_string(parts[1:b], chr(10)) || chr(10) END AS pm FROM c),
    v AS (SELECT *, substr(pm, length(p) + 1) AS m, substr(t, length(pm) + 1) AS r FROM u)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || r || '<M>' || m ELSE '<S>' || r || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256 FROM v"""
)
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut at two of its line ends and rearranged, and what the rearranged text restores to."""
    found = fim.fill_in_middle(read(spark, sf_dir, "documents"))
    back = fim.restored(F.col("form"), F.col("output"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")]
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = rf"regexp_extract_all({LOW}, '{fp_tree.TERM}')"


@query(
    rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS ts FROM documents),
    q AS (SELECT item_id, unnest({TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark) WHERE item_id IS NOT NULL),
    a AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
    n AS (SELECT count(*) AS docs, CAST(sum(len(ts)) AS BIGINT) AS terms FROM d WHERE len(ts) > 0),
    p AS (SELECT r, doc_id, 25 + (75 * CAST(len(ts) AS BIGINT) * docs) // terms AS m, unnest(ts) AS term FROM d, n WHERE len(ts) > 0),
    f AS (SELECT r, doc_id, m, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM a) GROUP BY ALL),
    w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, n GROUP BY term, docs),
    s AS (SELECT item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM a JOIN f USING (term) JOIN w USING (term) GROUP BY ALL),
    k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""
)
def op13_fp_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest-scoring documents of every benchmark item."""
    return fp_tree.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
