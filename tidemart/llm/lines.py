"""Line deduplication over content-defined chunks of lines, with built-in functions only.

A rolling hash over the hashes of two neighbouring lines decides where a chunk ends: h(line) * 1 + h(next line) * ROLL_BASE with
base -1, so a chunk ends where the line hashes fall, every two lines on average.  An inserted line moves only the chunks around
it, and equal lines in a row stay together.  A chunk of several lines that occurs more than once keeps its first occurrence
(smallest doc_id, then first line); the others go after their bytes were compared with the first's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import let, saved

ROLL_BASE = -1
LEAST_LINES = 2
ADDED = ["n_lines", "n_chunks", "n_removed_lines"]


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n")


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _chunks(lines: Column) -> Column:
    """The chunks of an array of lines: structs (first, n) of line numbers from 0."""
    def ends_at(k: Column, hashes: Column, last: Column) -> Column:
        return (k == last) | (F.get(hashes, k) + F.get(hashes, k + 1) * ROLL_BASE > 0)

    def cut(hashes: Column) -> Column:
        last = F.size(hashes) - 1
        return F.filter(F.sequence(F.lit(0), last), lambda k: ends_at(k, hashes, last))

    def spans(ends: Column) -> Column:
        return F.transform(ends, lambda end, j: F.struct(
            (F.coalesce(F.get(ends, j - 1), F.lit(-1)) + 1).alias("first"),
            (end - F.coalesce(F.get(ends, j - 1), F.lit(-1))).alias("n")))

    return let(F.transform(lines, _line_hash), lambda hashes: let(cut(hashes), spans))


def _chunk_text(lines: Column, chunk: Column) -> Column:
    return F.array_join(F.slice(lines, chunk["first"] + 1, chunk["n"]), "\n")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, cuts): per document the chunks that an earlier one repeats, as (first, n, text of the first occurrence)."""
    keyed = docs.filter("doc_id is not null").select("doc_id", "text")

    def chunk_rows(rows: DataFrame) -> DataFrame:
        chunks = let(_lines(), lambda lines: F.transform(
            F.filter(_chunks(lines), lambda c: c["n"] >= LEAST_LINES),
            lambda c: F.struct(c["first"].alias("first"), c["n"].alias("n"), _chunk_text(lines, c).alias("chunk"))))
        return rows.select("doc_id", F.inline(chunks))

    marks = saved(chunk_rows(keyed).select("doc_id", "first", "n", F.unhex(F.md5("chunk")).alias("digest")))
    places = marks.groupBy("digest").agg(F.min(F.struct("doc_id", "first")).alias("kept"),
                                         F.max(F.struct("doc_id", "first")).alias("latest"))
    shared = places.filter("kept != latest").select("digest", "kept")
    later = marks.join(shared, "digest").filter(F.struct("doc_id", "first") != F.col("kept"))
    # The bytes of the kept occurrences, from their documents alone.
    origin = shared.select(F.col("kept.doc_id").alias("doc_id"), F.col("kept.first").alias("first"), "digest")
    sources = keyed.join(origin.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = chunk_rows(sources).withColumn("digest", F.unhex(F.md5("chunk"))).join(origin, ["doc_id", "first", "digest"], "left_semi")
    texts = texts.groupBy("digest").agg(F.min("chunk").alias("chunk"))
    return later.join(texts, "digest").groupBy("doc_id").agg(F.collect_set(F.struct("first", "n", "chunk")).alias("cuts"))


def drop_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` with the text left after the cuts, plus n_lines, n_chunks and n_removed_lines (bigint).

    A null text is one empty line and stays null; a document that loses every line has an empty text.  Rows
    that repeat a doc_id are judged as one document.  Rows with a null doc_id keep their text.  Extra columns
    stay, but for cuts, left and the names added, which are replaced.
    """
    docs = docs.drop(*ADDED, "cuts", "left")
    cuts = repeated_chunks(docs)

    def judged(lines: Column) -> Column:
        same = F.filter(F.col("cuts"), lambda c: _chunk_text(lines, c) == c["chunk"])
        gone = F.flatten(F.transform(same, lambda c: F.sequence(c["first"], c["first"] + c["n"] - 1)))
        return let(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(gone, F.array().cast("array<int>"))),
                   lambda kept: F.struct(
                       F.size(lines).cast("long").alias("n_lines"), F.size(_chunks(lines)).cast("long").alias("n_chunks"),
                       (F.size(lines) - F.size(kept)).cast("long").alias("n_removed_lines"),
                       F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n").alias("text")))

    rows = docs.join(cuts, "doc_id", "left").withColumn("left", let(_lines(), judged))
    text = F.when(F.col("left.n_removed_lines") > 0, F.col("left.text")).otherwise(F.col("text"))
    return rows.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns],
                       *[F.col(f"left.{c}") for c in ADDED])
