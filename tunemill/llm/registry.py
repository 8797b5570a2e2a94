"""Registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from tunemill.llm import audit, contain, lines, pieces, quality, ranking, secrets, simhash, spans, tokens, toxicity, urls, warc
from tunemill.llm.common import read_table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(function, sql=None):
    """Register ``function(spark, sf_dir)`` under its own name, with its SQL if there is any."""
    QUERIES[function.__name__] = function
    if sql is not None:
        ORACLE[function.__name__] = sql
    return function


def checked(sql: str):
    """Decorator: register a function with the SQL that gives the same rows."""
    return lambda function: query(function, sql)


@query
def op2_simhash_pivots(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fingerprint").alias("fingerprint"),
                        "component_id")


@query
def op3_pieces_viterbi(spark, sf_dir):
    """Ids of every document, their number, and whether they decode to the very text."""
    return pieces.round_trip(read_table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark, sf_dir):
    """Bytes and tokens of every document."""
    return tokens.token_counts(read_table(spark, sf_dir, "documents"))


@query
def op4_benchmark_containment(spark, sf_dir):
    """Documents and the test items that they hold to 0.8 or more."""
    return contain.contained(read_table(spark, sf_dir, "documents"),
                             read_table(spark, sf_dir, "benchmark"))


@checked(f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, {warc.digest_sql("html")} AS payload_digest
            FROM payloads),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM digests GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM digests JOIN firsts USING (payload_digest)""")
def op6_warc_index(spark, sf_dir):
    """Every page written to WARC archives, found again through the index, and read back."""
    return warc.archived(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@checked(quality.measured_sql())
def op8_line_cleaning(spark, sf_dir):
    """Counts and verdict of every document."""
    return quality.measured(read_table(spark, sf_dir, "documents")).drop("clean_text")


@query
def op9_url_model_ratio(spark, sf_dir):
    """Host, path, rule and verdict of every page's URL."""
    return urls.judged(read_table(spark, sf_dir, "pages"))


@query
def op10_secret_network(spark, sf_dir):
    """Secrets of every document: those of the patterns, and those that the network adds."""
    return secrets.found(read_table(spark, sf_dir, "documents"))


@query
def op1_toxicity_channel(spark, sf_dir):
    """Toxicity score of every document, learnt from the labels of those not held out."""
    return toxicity.scored(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op5_line_similarity(spark, sf_dir):
    """Lines of every document, and which of them repeat an earlier line."""
    return lines.line_report(read_table(spark, sf_dir, "documents"), least_words=1)


@checked(audit.audited_sql())
def op13_filter_diagrams(spark, sf_dir):
    """Steps of all orders of five filters, by language."""
    return audit.audited(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@checked(spans.deduplicated_sql())
def op11_debruijn_spans(spark, sf_dir):
    """Words of every document that are left without long sequences that stand elsewhere too."""
    return spans.deduplicated(read_table(spark, sf_dir, "documents"))


@checked(ranking.ranked_sql())
def op12_blocked_ranking(spark, sf_dir):
    """The 50 documents of the highest scores for every test item."""
    return ranking.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
