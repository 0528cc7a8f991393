"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineledger.llm.bpe import decode, encode, tables
from lineledger.llm.chunk_dedup import dedup_substrings
from lineledger.llm.decontaminate import contamination
from lineledger.llm.embedding_dups import near_duplicates as near_vectors
from lineledger.llm.embedding_whitening import whiten
from lineledger.llm.html_extract import extract
from lineledger.llm.language_id import languages
from lineledger.llm.packing import pack
from lineledger.llm.simhash import near_duplicates
from lineledger.llm.suffix_dedup import dedup_exact
from lineledger.llm.token_alignment import Tokenizers, align_corpus
from lineledger.llm.token_counts import count_tokens, piece_vocabulary
from lineledger.llm.warc import archive_and_read, page_digests

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_file(name: str) -> str:
    """Content of one of the public tokenizer files."""
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from the documents that are not held out."""
    return languages(table(spark, sf_dir, "documents"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written, read back and assembled to one row per capture."""
    return page_digests(archive_and_read(table(spark, sf_dir, "pages")))


ORACLES["op2_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS kept FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM k
"""


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses to documents with a smaller id, and a digest of what it keeps."""
    found = dedup_substrings(table(spark, sf_dir, "documents"), F.col("doc_id"))
    return found.select("doc_id", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that windows of 13 benchmark words cover."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


ORACLES["op4_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS span, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM i WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, span, p, array_to_string(w[p : p + span - 1], ' ') AS words
  FROM (SELECT doc_id, w, span, unnest(range(1, len(w) - span + 2)) AS p
        FROM d, (SELECT DISTINCT span FROM iw) WHERE len(w) >= span)
), m AS (
  SELECT doc_id, item_id, p, span FROM dw JOIN iw USING (span, words)
), h AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + span)) AS place FROM m) GROUP BY 1
), k AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@query
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return extract(table(spark, sf_dir, "pages"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 ids, a row per piece."""
    docs = table(spark, sf_dir, "documents")
    return pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=2, size=1024, keep_ids=False)


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text under a unigram model with the pieces and scores of a public vocabulary."""
    docs = table(spark, sf_dir, "documents")
    vocabulary = piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return count_tokens(docs, vocabulary, F.col("doc_id"), F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removes every byte inside a 50-byte string that a document with a smaller id has, too."""
    found = dedup_exact(table(spark, sf_dir, "documents"), length=50)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op9_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked by a cosine of at least 0.95, whatever their labels."""
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.95)


ORACLES["op9_embedding_dups"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), u AS (
  SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM v
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.95
), r(vec_id, reached) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, l.b FROM r JOIN l ON l.a = r.reached
), c AS (
  SELECT vec_id, min(reached) AS component_id FROM r GROUP BY 1
), n AS (
  SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY 1
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM c LEFT JOIN n USING (vec_id)
"""


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of 3-word shingles; fingerprints at most two bits apart are linked."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading components of all distinct vectors, with variance 1 on each."""
    return whiten(table(spark, sf_dir, "embeddings"), F.col("vec_id"), components=4, scale=256)


@query
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the text that they stand for, as digests."""
    bpe = tables(tokenizer_file("byte_bpe_50k.json"))
    ids = encode(table(spark, sf_dir, "documents"), bpe, F.col("doc_id"))
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256")
    counted = ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest, "ids")
    text = decode(counted, bpe, *(F.col(c) for c in ("doc_id", "n_tokens", "ids_sha256")))
    return text.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies whose ends meet in each text, and how usual their pairs are in all texts."""
    docs = table(spark, sf_dir, "documents")
    pieces = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    files = Tokenizers(tokenizer_file("byte_bpe_50k.json"), pieces)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    return align_corpus(docs, files, "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)
