"""Line-first cleaning: rules per line, failing lines removed, then documents judged by what is left.

DataFrame functions only. A text is never exploded: its words and lines are arrays of its row, so
nothing is shuffled and a hot source or a long document costs no more than its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A document must have so many words, and at most this share of them in repeated windows.
LEAST_WORDS = 50
REPEATED_PERCENT = 50
WINDOW = 3
#: Share of a document's words that its lines must keep.
LEAST_KEPT = 0.5

#: Symbols that are counted, as a class of a pattern.
SYMBOLS = "[#*$%&|<>]"
#: Rules per line. Punctuation: a line ends a sentence (what closes one may follow), has few symbols
#: and isn't all capitals. Navigation: bars and bullets between entries. Boilerplate: in short lines.
ENDS = ".!?:;…。！？"
CLOSING = " \t\r\x0b\x0c\"'”’»)]*_"
SYMBOLS_PER_WORD = 0.2
CAPITALS_WORDS = 4
NAVIGATION = "[|»›·]"
NAVIGATION_MARKS = 2
NAVIGATION_WORDS = 3
BOILERPLATE_WORDS = 15
BOILERPLATE = (
    "cookie|privacy policy|terms of (use|service)|all rights reserved|javascript|subscribe|"
    "sign (in|up)|log ?in|share (this|on)|click here|read more|powered by|"
    "licen[cs]ed under|released under|copyright")
_WORD_POSITION = 30


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \t-\r]+"), lambda w: w != "")


def repeated_words(words: Column) -> list[tuple[str, Column]]:
    """Columns, one on top of the other, that end in ``n_repeat_words``.

    Where all hashes of windows differ there is nothing to do. Else hashes are sorted with the
    position in the low bits; only neighbours of the same hash can repeat. Those are sorted by their
    words, so that the hash decides nothing.
    """
    size = F.size(words)
    hashed = F.transform(F.sequence(F.lit(0), size - WINDOW),
                         lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))
    none = F.array().cast("array<bigint>")

    def same(sorted_rows, key):
        return F.filter(sorted_rows, lambda x, i: (
            F.coalesce(key(x) == key(F.get(sorted_rows, i + 1)), F.lit(False))
            | F.coalesce((i > 0) & (key(x) == key(F.get(sorted_rows, F.greatest(i - 1, F.lit(0))))), F.lit(False))))

    hashes, codes, alike, windows, hits = (
        F.col(c) for c in ("_hashes", "_codes", "_alike", "_windows", "_hits"))
    low = (1 << _WORD_POSITION) - 1
    return [
        ("_hashes", F.when(size > WINDOW, hashed).otherwise(none)),
        ("_codes", F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(
            F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(~low).bitwiseOR(i.cast("long")))))),
        ("_alike", same(codes, lambda x: x.bitwiseAND(~low))),
        ("_windows", F.sort_array(F.transform(
            F.transform(alike, lambda x: x.bitwiseAND(low).cast("int")),
            lambda at: F.struct(F.concat_ws(" ", *(F.get(words, at + k) for k in range(WINDOW))).alias("words"),
                                at.alias("at"))))),
        ("_hits", F.sort_array(F.transform(same(windows, lambda x: x["words"]), lambda x: x["at"]))),
        ("n_repeat_words", F.aggregate(
            F.transform(hits, lambda p, i: F.least(
                F.lit(WINDOW), F.coalesce(F.get(hits, i + 1) - p, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda total, step: total + step)),
    ]


def line_fails(line: Column, n_words: Column) -> Column:
    """Whether a line with words breaks a rule for lines."""
    last = F.substring(F.rtrim(line, F.lit(CLOSING)), -1, 1)
    marks = F.regexp_count(line, F.lit(NAVIGATION))
    return (
        (F.instr(F.lit(ENDS), last) == 0) | (last == "")
        | (F.regexp_count(line, F.lit(SYMBOLS)) > SYMBOLS_PER_WORD * n_words)
        | ((n_words >= CAPITALS_WORDS) & (F.upper(line) == line) & (F.lower(line) != line))
        | (marks >= NAVIGATION_MARKS)
        | ((n_words <= NAVIGATION_WORDS) & (marks > 0))
        | ((n_words <= BOILERPLATE_WORDS) & F.lower(line).rlike(BOILERPLATE)))


def measured(docs: DataFrame) -> DataFrame:
    """One row for every row of ``docs``: counts, verdict, and the text of the lines that stay.

    Columns: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, n_lines`` (with a word), ``n_lines_removed, words_left, clean_text``. A NULL text is no
    text: all counts are 0 and it is not kept. Other columns are ignored whatever their names; NULL
    and repeated doc_ids stay as they are; an empty table gives no rows.
    """
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
            .withColumns({"_words": _words(F.col("_text")), "_lines": F.split("_text", "\n", -1)}))
    for name, column in repeated_words(F.col("_words")):
        rows = rows.withColumn(name, column)
    rows = rows.withColumn("_full", F.filter(
        F.transform("_lines", lambda x: F.struct(x.alias("line"), F.size(_words(x)).alias("words"))),
        lambda x: x["words"] > 0))
    rows = rows.withColumn("_good", F.filter("_full", lambda x: ~line_fails(x["line"], x["words"])))
    left = F.aggregate("_good", F.lit(0).cast("long"), lambda total, x: total + x["words"])
    rows = rows.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.concat_ws("", "_words")).cast("long"),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)).cast("long"),
        "n_lines": F.size("_full").cast("long"),
        "n_dup_lines": (F.size("_full") - F.size(F.array_distinct("_full.line"))).cast("long"),
        "n_lines_removed": (F.size("_full") - F.size("_good")).cast("long"),
        "words_left": left,
        "clean_text": F.concat_ws("\n", "_good.line"),
    })
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")))
    verdict = ~F.col("base_failed") & (F.col("words_left") >= LEAST_KEPT * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn("kept", verdict)
    # one struct to unfold: filters on the result stay above it instead of repeating all of the above
    return rows.select(F.inline(F.array(F.struct(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_lines_removed", "words_left", "clean_text"))))


def clean(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of the documents that are kept, without the lines that failed."""
    return measured(docs).where("kept").select("doc_id", F.col("clean_text").alias("text"))


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def measured_sql() -> str:
    """DuckDB SQL for :func:`measured` over ``documents``, without the texts."""
    words = r"list_filter(string_split_regex({}, '[ \t-\r]+'), lambda x: x <> '')"
    last = f"right(rtrim(line, {_sql_text(CLOSING)}), 1)"
    marks = f"len(regexp_extract_all(line, '{NAVIGATION}'))"
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT r, doc_id, t, {words.format("t")} AS ws FROM texts),
windows AS (SELECT r, unnest(range(1, len(ws) - {WINDOW - 2}))::BIGINT AS i, ws FROM split WHERE len(ws) >= {WINDOW}),
keyed AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k FROM windows),
repeated AS (SELECT r, i FROM keyed QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
covered AS (SELECT r, count(DISTINCT i + s)::BIGINT AS n_repeat_words FROM repeated, range({WINDOW}) AS g(s) GROUP BY r),
cut AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM texts),
lines AS (SELECT r, line, len({words.format("line")}) AS n FROM cut WHERE len({words.format("line")}) > 0),
judged AS (SELECT r, line, n, (
    instr({_sql_text(ENDS)}, {last}) = 0 OR {last} = ''
    OR len(regexp_extract_all(line, '{SYMBOLS}')) > {SYMBOLS_PER_WORD}::DOUBLE * n
    OR (n >= {CAPITALS_WORDS} AND upper(line) = line AND lower(line) <> line)
    OR {marks} >= {NAVIGATION_MARKS} OR (n <= {NAVIGATION_WORDS} AND {marks} > 0)
    OR (n <= {BOILERPLATE_WORDS} AND regexp_matches(lower(line), '{BOILERPLATE}'))) AS fails FROM lines),
by_text AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (fails) AS n_lines_removed, coalesce(sum(n) FILTER (NOT fails), 0)::BIGINT AS words_left
    FROM judged GROUP BY r),
counted AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '{SYMBOLS}'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_lines_removed, 0)::BIGINT AS n_lines_removed,
    coalesce(words_left, 0)::BIGINT AS words_left
    FROM split LEFT JOIN covered USING (r) LEFT JOIN by_text USING (r)),
based AS (SELECT *, (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words) AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND words_left >= {LEAST_KEPT}::DOUBLE * n_words AS kept, n_lines, n_lines_removed, words_left
FROM based"""
