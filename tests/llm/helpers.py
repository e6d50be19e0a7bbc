"""Small tables with every awkward case, and brute-force versions."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, texts, first=0):
    """A documents table; a text may be (doc_id, text), too."""
    rows = [t if isinstance(t, tuple) else (first + k, t) for k, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], SCHEMA)


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, repeated ids, clashing extra columns."""
    long = " ".join(f"word{k % 977} tail{k}." + ("\n" if k % 9 == 0 else "") for k in range(12_000))
    rows = [(1, "One line here.\nAnd a second line of it.", "en", "a", 38), (2, "", "en", "a", 0), (3, None, None, None, None),
            (None, "no id at all, but some text", "en", "b", 27), (None, None, None, None, None), (4, "   \n \t ", "de", "b", 6),
            (5, "same row", "en", "a", 8), (5, "same row", "en", "a", 8), (6, "one text of six", "fr", "c", 1),
            (6, "another text of six", "fr", "c", 1), (7, long, "en", "a", len(long)), (8, "é日本 🙂 ñandú", "es", "c", 12),
            (9, "a", "en", "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = ["lines", "chunks", "cuts", "left", "n_lines", "hashes", "node", "n", "heads", "text_", "row", "tag", "doc", "at", "lane",
             "ids", "start", "token", "df", "root", "part", "signatures", "toxic", "low", "n_bytes", "n_tokens", "digest", "form"]
    return df.selectExpr("*", *[f"'x' as {c}" for c in extra])


def shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1)))


def linked(sets):
    """doc_id -> smallest doc_id of its component, from doc_id -> set, comparing all pairs."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}
