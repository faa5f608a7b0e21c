"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (
    ann_tree,
    bagminhash,
    byte_bpe,
    divergence,
    dual_tree,
    fingerprints,
    line_dedup,
    packing,
    quality,
    suffix_dedup,
    url_filter,
    warc_zip,
    weak_rules,
)
from orderlake.llm.common import ship, table
from orderlake.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(tune(spark))
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


URL_RULES = (
    url_filter.Rule("block", "net/"),
    url_filter.Rule("allow", "example.net/en/"),
    url_filter.Rule("block", "example.com/de/"),
    url_filter.Rule("allow", "org/fr/"),
)


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, else by trees trained on the URLs the rules decide."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("block_probability", 6).alias("block_probability"))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(F.coalesce(~quality.held_out(), F.lit(True)))
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select("doc_id", F.coalesce(quality.held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that also start anywhere else."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.remove_repeats(docs, min_bytes=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op8_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record into ZIP archives and read back from them by range."""
    archives = warc_zip.write_archives(table(spark, sf_dir, "pages"))
    records = warc_zip.read_archives(archives)
    return records.select(
        warc_zip.key_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc_zip.key_of(F.col("refers_to")).alias("refers_to"),
    )


# Base32 from the SHA-1's hexadecimal digits: ten digits, forty bits, are eight letters.
ORACLE_SQL["op8_warc_zip"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS hex FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, octet_length(body) AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex, (i // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::BIGINT, 1)
           FOR i IN range(32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, length=4096)
    return packed.select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, and the bytes they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, decoded_into="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sketch, compared with its edited text and with the next document."""
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document: five-word shingles with counts, similarity 0.8 or more."""
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=0.8)


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of chunks that an earlier document, or an earlier place of it, has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = line_dedup.remove_repeated_chunks(docs)
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return clean.select("doc_id", "n_lines", "n_removed", "n_chunks_removed", kept)


ORACLE_SQL["op2_line_dedup"] = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
     line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM split),
     flagged AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) <> '' AS solid FROM line),
     numbered AS (SELECT *, sum(solid::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS u FROM flagged),
     hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM numbered WHERE solid),
     rolled AS (SELECT *, (h + 1000003 * lag(h) OVER w) % 2147483647 AS r, lag(line) OVER w AS b1, lag(line, 2) OVER w AS b2,
                       lead(line) OVER w AS a1 FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY u)),
     compared AS (SELECT *, lag(r) OVER w AS r_before, lead(r) OVER w AS r_after FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY u)),
     border AS (SELECT * FROM compared WHERE r <= r_before OR r <= r_after OR (r IS NOT NULL AND b2 IS NULL AND a1 IS NULL)),
     chunk AS (SELECT doc_id, u - 1 AS first, 2 AS n, b1 || chr(10) || line AS body FROM border
               UNION SELECT doc_id, u - 2, 3, b2 || chr(10) || b1 || chr(10) || line FROM border WHERE b2 IS NOT NULL
               UNION SELECT doc_id, u - 1, 3, b1 || chr(10) || line || chr(10) || a1 FROM border WHERE a1 IS NOT NULL),
     placed AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, first) > 1 AS again FROM chunk),
     gone AS (SELECT DISTINCT doc_id, unnest(range(first::BIGINT, (first + n)::BIGINT)) AS u FROM placed WHERE again),
     marked AS (SELECT l.doc_id, l.line, l.i, greatest(l.u, 1) AS u, g.u IS NOT NULL AS gone
                FROM numbered l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.u = greatest(l.u, 1)),
     turned AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM marked)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (starts) AS n_chunks_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM turned GROUP BY doc_id
"""


@query
def op5_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    index = ann_tree.build(table(spark, sf_dir, "embeddings"), k=10)
    return ann_tree.search(index, F.col("vec_id") % 100 == 0, k=10)


@query
def op11_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, and whether the rules' votes say that it is good."""
    judged = weak_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return judged.select("doc_id", *weak_rules.COUNTS, F.round("posterior", 6).alias("posterior"), "base_failed", "kept")


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's distance to the other sources of its language, and the terms it has most above the language."""
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=30, smoothing=5, top=50)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op12_source_divergence"] = rf"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOWER} AS body FROM documents),
     o AS (SELECT i, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT i) >= 30),
     g AS (SELECT DISTINCT lang, source FROM d),
     c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN kept USING (lang, term) GROUP BY ALL),
     v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
     dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
     p AS (SELECT dense.lang, source, term, n,
                  1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY dense.lang, source) + 5 * v) AS p
           FROM dense JOIN v ON dense.lang = v.lang),
     q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * any_value(v)) AS q
           FROM dense JOIN v USING (lang) GROUP BY lang, term),
     pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0)::BIGINT AS value
              FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
              GROUP BY ALL),
     term AS (SELECT lang, source, term AS item, (p - q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
     ranked AS (SELECT lang, source, 'pair' AS part, item, value,
                       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pair
                UNION ALL
                SELECT lang, source, 'term', item, value,
                       row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) FROM term)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query
def op13_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    return dual_tree.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


ORACLE_SQL["op13_dual_tree"] = rf"""
WITH o AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
     i AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
     tf AS (SELECT doc_id, term, count(*) AS tf FROM o GROUP BY ALL),
     doc AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
     corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM doc),
     m AS (SELECT doc_id, 75 + (25 * n * docs) // terms AS m FROM doc, corpus),
     w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
           FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus),
     s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
           FROM i JOIN tf USING (term) JOIN m USING (doc_id) JOIN w USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""
