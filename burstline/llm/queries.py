"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm import (
    bm25,
    lines,
    minhash,
    packing,
    periods,
    pii,
    quality,
    sentencepiece,
    suffixes,
    token_files,
    vectors,
    warc,
    whitening,
)
from burstline.sources.tables import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    documents = table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, tokenizer("byte_bpe_50k.json"))


# A sequence of instruction data: any of the three may be what a conversation no longer fits.
CONVERSATION_LIMITS = packing.Limits(tokens=2048, segments=4, loss_tokens=1024)


def pack_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations whole, in sequences limited in tokens, segments and loss-bearing tokens."""
    conversations = table(spark, sf_dir, "conversations")
    examples = packing.conversation_examples(conversations, tokenizer("byte_bpe_50k.json"))
    return packing.pack_examples(examples, CONVERSATION_LIMITS, id_column="conv_id")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of all documents, decoded again."""
    documents = table(spark, sf_dir, "documents")
    sampled = sentencepiece.segmented(documents, "doc_id", tokenizer("piece_bpe_32k.model"))
    return sampled.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by 75 of 100 common five-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=75, words=5)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in all documents."""
    return pii.detect(table(spark, sf_dir, "documents")).drop("pii")


def op5_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents most like each document whose id is divisible by 50, by all its words."""
    documents = table(spark, sf_dir, "documents")
    return bm25.search(documents.filter(F.col("doc_id") % 50 == 0), documents, 10, query_terms=None)


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all embeddings linked by a cosine of 0.9."""
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), least_cosine=0.9)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that five or more of them hold."""
    kept = lines.dedup_lines(table(spark, sf_dir, "documents"), min_documents=5, min_chars=40)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through a WARC archive."""
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without bytes that a 100-byte string found earlier covers."""
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents"), least=100)
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", digest)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model that has not seen the held-out labels."""
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~quality.held_out())
    scored = quality.with_score(documents, quality.fit(documents, labels))
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP_FROM).cast("int").alias("predicted"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings along the eight components of largest variance, each with variance one."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through files of coded token ids."""
    documents = table(spark, sf_dir, "documents")
    return token_files.round_trip(documents, tokenizer("word_bpe_49k.json"), end_id=2)


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in all documents, a tenth of which get some."""
    documents = periods.planted(table(spark, sf_dir, "documents"))
    found = periods.collapse_runs(documents)
    lines_of = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    best = F.col("best")
    return found.select(
        "doc_id",
        "n_runs",
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines_of, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_minhash": op3_minhash,
    "op4_pii": op4_pii,
    "op5_bm25": op5_bm25,
    "op6_vectors": op6_vectors,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_suffixes": op9_suffixes,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_token_files": op12_token_files,
    "op13_periods": op13_periods,
    "pack_conversations": pack_conversations,
}

# Candidates share a shingle; components are the transitive closure of the links.
OP3_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(
            translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'),
        lambda x: x <> '') AS w
    FROM documents
),
sets AS (
    SELECT DISTINCT doc_id, array_to_string(
        w[n : n + least(5, len(w)) - 1], ' ') AS shingle
    FROM (
        SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS n
        FROM words WHERE len(w) > 0
    )
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
        GROUP BY ALL
    ) p JOIN sizes s ON s.doc_id = p.a JOIN sizes t ON t.doc_id = p.b
    WHERE 100 * shared >= 75 * (s.n + t.n - shared)
),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
grouped AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT g.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, component_id,
    g.doc_id = component_id AS kept
FROM grouped g LEFT JOIN sizes s ON s.doc_id = g.doc_id
"""

OP5_SQL = r"""
WITH words AS (
    SELECT doc_id, unnest(list_filter(
        regexp_split_to_array(
            translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+'),
        lambda x: x <> '')) AS word
    FROM documents
),
tf AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(n) AS words FROM tf GROUP BY doc_id),
total AS (
    SELECT count(*) AS docs, (SELECT sum(words) FROM lengths) / count(*)::DOUBLE AS mean
    FROM documents
),
idf AS (
    SELECT word, ln(1 + (docs - count(*) + 0.5) / (count(*) + 0.5)) AS idf
    FROM tf, total GROUP BY word, docs
),
queries AS (
    SELECT doc_id AS query_id, word, idf FROM tf JOIN idf USING (word) WHERE doc_id % 50 = 0
),
scores AS (
    SELECT q.query_id, t.doc_id, round(sum(
        q.idf * t.n * 2.2 / (t.n + 1.2 * (0.25 + 0.75 * l.words / total.mean))), 6) AS score
    FROM queries q JOIN tf t USING (word) JOIN lengths l ON l.doc_id = t.doc_id, total
    GROUP BY q.query_id, t.doc_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank,
    doc_id, score
FROM scores QUALIFY rank <= 10
"""

OP6_SQL = """
WITH RECURSIVE clean AS (
    SELECT vec_id, embedding::DOUBLE[] AS v,
        sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
    FROM embeddings
),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM clean x JOIN clean y
    ON x.vec_id <> y.vec_id AND x.norm > 0 AND y.norm > 0
    WHERE list_dot_product(x.v, y.v) / (x.norm * y.norm) >= 0.9
),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
),
grouped AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degrees AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT g.vec_id, coalesce(d.n_links, 0)::BIGINT AS n_links, component_id,
    g.vec_id = component_id AS kept
FROM grouped g LEFT JOIN degrees d ON d.vec_id = g.vec_id
"""

_LINES = """
lines AS (
    SELECT doc_id, n, string_split(body, chr(10))[n] AS line
    FROM (
        SELECT doc_id, body, unnest(range(1, len(string_split(body, chr(10))) + 1)) AS n
        FROM (SELECT doc_id, coalesce(text, '') AS body FROM documents)
    )
),
keyed AS (
    SELECT *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
repeated AS (
    SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
kept AS (
    SELECT k.doc_id, k.n, k.line, (r.owner IS NOT NULL AND r.owner <> k.doc_id) AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)"""

OP7_SQL = f"""
WITH {_LINES}
SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), ''))
        AS kept_sha256
FROM kept GROUP BY doc_id
"""

OP8_SQL = """
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM (
    SELECT *, CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first
        FROM (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                sha256(coalesce(html, '')) AS payload_digest
            FROM pages
        )
    )
)
"""

ORACLES: dict[str, str] = {
    "op3_minhash": OP3_SQL,
    "op5_bm25": OP5_SQL,
    "op6_vectors": OP6_SQL,
    "op7_line_dedup": OP7_SQL,
    "op8_warc": OP8_SQL,
}
