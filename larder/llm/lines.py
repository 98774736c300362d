"""Line dedup: winnowing over the hashes of whole lines.

A window is the shortest run of whole, non-blank lines with at least
``min_words`` words that starts, or that ends, at a line. Of each window the line
with the smallest hash (the first of equals) is selected: neighbouring windows
mostly select the same line, so a few positions of a document are fingerprints.
Equal windows select the same line of themselves, so a run of ``min_words`` words
or more that occurs twice has equal fingerprints at two positions at least, and a
fingerprint found at one position only proves that no window that selected it
occurs again. Those windows go before windows are compared.

Positions that share a fingerprint are joined with the first position around
which the same window lies, and the match is extended both ways: windows that
start at a line carry it on to the right and those that end at a line carry it to
the left, each with its own first position, as the rest of a run can have been seen
elsewhere. Together they are the maximal run, of which every occurrence but the first is deleted,
with the blank lines inside it.

Words of a line are its spaces plus one. Occurrences are ordered by document id
(null last), content and line. A line is known by two 64-bit hashes.

Cases: rows equal in id and text are one document repeated, and lose the same
lines; a null text has nothing to lose and stays null; a text whose lines all
go becomes empty; blank lines alone are never deleted; a run that repeats inside one document, even
overlapping itself, loses its later occurrences there; all other columns are
passed on, but those with the names of the two counts, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.columns import content_key, others, same_key, text_of

MIN_WORDS = 50


def line_words(line: Column) -> Column:
    return (F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long")


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(_id, _content, _i, _h, _w): place, hashes and words of each non-blank line of each distinct document."""
    text = text_of(docs)
    exploded = docs.select(*content_key(docs, text), F.posexplode(F.split(text, "\n")).alias("_i", "_line"))
    return exploded.where(F.trim("_line") != "").select(
        "_id", "_content", "_i",
        F.struct(F.xxhash64("_line").alias("a"), F.xxhash64(F.lit(1), "_line").alias("b")).alias("_h"),
        line_words(F.col("_line")).alias("_w"),
    ).distinct()


def windows(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _content, _from, _to, _mark, _at, _a, _b): all complete windows, their fingerprints, the positions of these, and hashes of the windows."""
    document = Window.partitionBy("_id", "_content")
    sized = lines.withColumn("_end", F.sum("_w").over(document.orderBy("_i")))
    sized = sized.withColumn("_start", F.col("_end") - F.col("_w"))
    right = document.orderBy("_start").rangeBetween(Window.currentRow, min_words - 1)
    left = document.orderBy("_end").rangeBetween(1 - min_words, Window.currentRow)
    lowest = F.min(F.struct(F.col("_h.a").alias("mark"), F.col("_i").alias("at")))

    def run(side, start: Column, end: Column) -> Column:
        of = lambda value, name: value.over(side).alias(name)
        return F.struct(
            start.alias("from"), end.alias("to"), of(F.collect_list("_h"), "run"), of(F.sum("_w"), "words"), of(lowest, "low")
        )

    both = F.array(run(right, F.col("_i"), F.max("_i").over(right)), run(left, F.min("_i").over(left), F.col("_i")))
    return sized.select("_id", "_content", both.alias("_both")).select("_id", "_content", F.inline("_both")).where(F.col("words") >= min_words).select(
        "_id", "_content", F.col("from").alias("_from"), F.col("to").alias("_to"), F.col("low.mark").alias("_mark"), F.col("low.at").alias("_at"),
        F.xxhash64("run").alias("_a"), F.xxhash64(F.lit(1), "run").alias("_b"),
    )


def shared_fingerprints(found: DataFrame) -> DataFrame:
    """(_mark): the fingerprints selected at more than one position."""
    position = F.xxhash64("_id", "_content", "_at")
    ends = found.groupBy("_mark").agg(F.min(position).alias("_low"), F.max(position).alias("_high"))
    return ends.where("_low < _high").select("_mark")


def extended(spans: Column) -> Column:
    """The lines of sorted windows, each once: a window goes on behind the end of the one before (both ends only grow)."""
    behind = lambda s, k: F.greatest(s["from"], F.coalesce(F.get(spans, k - 1)["to"] + 1, F.lit(0)))
    none = F.array().cast("array<int>")
    return F.flatten(F.transform(spans, lambda s, k: F.when(behind(s, k) <= s["to"], F.sequence(behind(s, k), s["to"])).otherwise(none)))


def repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _content, _gone): the places of the lines to delete, for documents that have any."""
    found = windows(hashed_lines(docs), min_words)
    shared = found.join(shared_fingerprints(found), "_mark", "left_semi")
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_content").alias("content"), F.col("_from").alias("at"))
    first = shared.groupBy("_mark", "_a", "_b").agg(F.min(place).alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    later = shared.join(first, ["_mark", "_a", "_b"]).where(place > F.col("_first"))
    spans = F.sort_array(F.collect_set(F.struct(F.col("_from").alias("from"), F.col("_to").alias("to"))))
    matched = later.groupBy("_id", "_content").agg(spans.alias("_spans"))
    return matched.select("_id", "_content", extended(F.col("_spans")).alias("_gone"))


def deduped(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(_row, _text, _n, _lost): each row of ``docs`` whole, its new text, and its counts of lines: before, and deleted."""
    text = text_of(docs)
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), *content_key(docs, text), text.alias("_text"))
    gone = repeated(docs, min_words)
    joined = rows.join(gone, same_key(rows, gone), "left")
    lines = F.split("_text", "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_gone")), lambda i: F.get(lines, i))
    new_text = F.when(F.col("_gone").isNull(), F.col("_row")["text"]).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        "_row", new_text.alias("_text"),
        F.size(lines).cast("long").alias("_n"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("_lost"),
    )


def line_dedup(
    docs: DataFrame, min_words: int = MIN_WORDS, counts: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """All columns of ``docs``, later repeated runs deleted from ``text``, and two counts of lines: before, and deleted."""
    return deduped(docs, min_words).select(
        *[(F.col("_text") if c == "text" else F.col("_row")[c]).alias(c) for c in others(docs, counts)],
        F.col("_n").alias(counts[0]), F.col("_lost").alias(counts[1]),
    )


SQL = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
listed AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS i FROM split),
sized AS (
  SELECT *, CAST(sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS c
  FROM (SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS w FROM listed WHERE trim(line) <> '')),
runs AS (
  SELECT doc_id, i AS a, max(i) OVER f AS b, list(line) OVER f AS run, sum(w) OVER f AS words FROM sized
  WINDOW f AS (PARTITION BY doc_id ORDER BY c - w RANGE BETWEEN CURRENT ROW AND {MIN_WORDS - 1} FOLLOWING)
  UNION ALL
  SELECT doc_id, min(i) OVER g, i, list(line) OVER g, sum(w) OVER g FROM sized
  WINDOW g AS (PARTITION BY doc_id ORDER BY c RANGE BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW)),
ranked AS (
  SELECT doc_id, a, b, rank() OVER (PARTITION BY run ORDER BY doc_id, a) AS place FROM runs WHERE words >= {MIN_WORDS}),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(a, b + 1)) AS i FROM ranked WHERE place > 1),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS text FROM listed l
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = l.doc_id AND g.i = l.i) GROUP BY l.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(s.lines) AS BIGINT) AS n_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_removed,
       CASE WHEN c.n IS NULL THEN d.text ELSE coalesce(k.text, '') END AS text
FROM documents d JOIN split s USING (doc_id) LEFT JOIN counts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
