"""One query per operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampertide.llm.common import prepare
from ampertide.llm.decontaminate import contamination
from ampertide.llm.embedding_dedup import embedding_dedup
from ampertide.llm.exact_dedup import exact_dedup
from ampertide.llm.html_text import labelled_sample, learn, main_text
from ampertide.llm.language_id import fit, held_out, identify
from ampertide.llm.line_dedup import line_dedup, passage_array
from ampertide.llm.mixing import placements
from ampertide.llm.near_dup import near_dup
from ampertide.llm.sharding import shard_documents
from ampertide.llm.source_divergence import source_divergence
from ampertide.llm.token_alignment import align, with_pair_counts
from ampertide.llm.token_counts import piece_scores, token_counts
from ampertide.llm.token_files import read_tokens, write_tokens

TOKENIZER = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, table reader) under its own name."""

    def register(function):
        name = function.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepare(spark)
            return function(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query()
def op1_main_text(table):
    pages = table("pages")
    return main_text(pages, learn(labelled_sample(pages)))


@query(
    r"""
    WITH d AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    ), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """
)
def op2_exact_dedup(table):
    return exact_dedup(table("documents"))


def vocabulary(name: str = TOKENIZER) -> str:
    """Where this machine keeps the public vocabulary; the same place on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op3_token_files(table):
    return read_tokens(write_tokens(table("documents"), vocabulary()))


@query()
def op4_language_id(table):
    docs = table("documents")
    predicted = identify(docs.select("doc_id", "text"), fit(docs))
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query()
def op5_shard_documents(table):
    return shard_documents(table("documents"))


@query()
def op6_decontaminate(table):
    return contamination(table("documents"), table("benchmark"))


@query()
def op7_token_counts(table):
    return token_counts(table("documents"), piece_scores(vocabulary(PIECES)))


@query()
def op8_line_dedup(table):
    return line_dedup(table("documents"), passage_array)


@query()
def op9_mix_sources(table):
    rows, placed = placements(table("documents"))
    copies = placed.groupBy("_row").agg(F.count(F.lit(1)).alias("_copies"))
    return rows.join(copies, "_row", "left").select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("_size") * F.coalesce("_copies", F.lit(0))).alias("taken"),
        F.coalesce("_copies", F.lit(0)).alias("copies"),
        "source",
    )


@query()
def op10_near_dup(table):
    return near_dup(table("documents"), words=2)


@query()
def op11_embedding_dedup(table):
    return embedding_dedup(table("embeddings"))


@query(
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
        FROM documents
    ), w AS (
        SELECT r, lang, source, unnest(regexp_extract_all(low, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
    ), kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
    g AS (SELECT DISTINCT lang, source FROM d),
    c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
    cells AS (
        SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::HUGEINT AS n
        FROM g JOIN kept k ON g.lang = k.lang
        LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
    ), shares AS (
        SELECT lang, source, term, n,
            1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source))::HUGEINT AS p
        FROM cells
    ), whole AS (
        SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang))::HUGEINT AS q
        FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM cells GROUP BY lang, term)
    ), sums AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source
    ), vals AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
        UNION ALL
        SELECT s.lang, s.source, 'term', s.term, (((s.p - t.q) * (s.p - t.q)) // t.q)::BIGINT
        FROM shares s JOIN whole t ON s.lang = t.lang AND s.term = t.term
        WHERE s.n > 0 AND s.p > t.q
    )
    SELECT lang, source, part, item, value, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM vals
    ) WHERE part = 'pair' OR rank <= 200
    """
)
def op12_source_divergence(table):
    return source_divergence(table("documents"))


@query()
def op13_align_tokens(table):
    aligned = align(table("documents"), vocabulary(BYTES), vocabulary(PIECES))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))
    return with_pair_counts(aligned.withColumn("groups_sha256", digest).drop("groups"), 1 << 16)
