"""Exact token counts; huge documents are encoded in overlapping chunks that are spliced where both agree.

A cut is placed at a blank that follows a character other than white space: the pre-tokenizer's patterns never
run from a visible character into a blank, so a token ends there whatever surrounds it.  Each chunk is
encoded with an overlap before and after its cuts, and the offsets of its tokens must show both cuts as token
boundaries; where one does not, the overlaps are widened, at last to the whole document.  Documents short
enough to be read at once are counted piece by piece between the same kind of cuts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

CHUNK_CHARS = 1 << 16   # characters between two cuts of a huge document
OVERLAP_CHARS = 256     # encoded beyond a cut on either side
BLOCK_BYTES = 1 << 21   # text whose new pieces are encoded in one call
KNOWN_PIECES = 1_000_000
_CUT = re.compile(r"(?<=\S) ")
_MARKED = re.compile(r"[A-Za-z][.,]\Z")
_COUNTS: dict[str, dict[str, int]] = {}
_LOADED: dict[str, object] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str):
    """The tokenizer of a file, loaded once per worker; one thread, as Spark runs a worker per core."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def _byte_characters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: printable Latin-1 as itself, the others by characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


_SPELL = _byte_characters()
BLANK = _SPELL[32]


def spelled(word: str) -> str | None:
    """The byte-level spelling of a word of Latin letters alone, which splitters keep whole; None for others."""
    if word.isalpha() and max(word) < "\u0250":
        return word if word.isascii() else word.encode().decode("latin-1").translate(_SPELL)
    return None


def cuts(text: str, size: int) -> list[int]:
    """Places to cut ``text``, about ``size`` apart: a place without a fit blank moves on to the next one."""
    out, at = [0], size
    while at < len(text):
        found = _CUT.search(text, at)
        if not found:
            break
        out.append(found.start())
        at = found.start() + size
    return [*out, len(text)]


def count_between(encode, text: str, lo: int, hi: int, overlap: int, before: bool = False,
                  after: bool = False) -> tuple[int, bool]:
    """Tokens of ``text`` between two cuts, from an encoding of what lies up to ``overlap`` around them.

    ``before`` and ``after`` say that ``text`` itself is cut out of a longer one.  The second value is false
    if even all of ``text`` shows no token boundary at a cut.
    """
    while True:
        start, end = max(0, lo - overlap), min(len(text), hi + overlap)
        spans = encode(text[start:end]).offsets
        begins, ends = {a + start for a, _ in spans}, {b + start for _, b in spans}
        left = lo in begins and lo in ends or lo == 0 and not before
        right = hi in begins and hi in ends or hi == len(text) and not after
        if left and right or start == 0 and end == len(text):
            return sum(1 for a, _ in spans if lo <= a + start < hi), left and right
        overlap *= 4


def _chunk_rows(batches: Iterator[pd.DataFrame], size: int, overlap: int) -> Iterator[pd.DataFrame]:
    """Chunks with their surroundings: (row, lo, hi, has_before, has_after, text); lo and hi count within text."""
    for batch in batches:
        for row, text in zip(batch["row"], batch["text"], strict=True):
            places, reach = cuts(text, size), 4 * overlap
            out = []
            for lo, hi in zip(places, places[1:], strict=False):
                start, end = max(0, lo - reach), min(len(text), hi + reach)
                out.append((row, lo - start, hi - start, start > 0, end < len(text), text[start:end]))
                if len(out) == 64:
                    yield pd.DataFrame(out, columns=["row", "lo", "hi", "has_before", "has_after", "text"])
                    out = []
            if out:
                yield pd.DataFrame(out, columns=["row", "lo", "hi", "has_before", "has_after", "text"])


def _encode_chunks(batches: Iterator[pd.DataFrame], path: str, overlap: int) -> Iterator[pd.DataFrame]:
    """(row, n, fits): tokens of each chunk; ``fits`` is false if the surroundings sent along showed no boundary."""
    encode = lambda text: tokenizer(path).encode(text, add_special_tokens=False)
    for batch in batches:
        found = [count_between(encode, text, lo, hi, overlap, before, after) for lo, hi, before, after, text in zip(
            batch["lo"], batch["hi"], batch["has_before"], batch["has_after"], batch["text"], strict=True)]
        yield pd.DataFrame({"row": batch["row"], "n": [n for n, _ in found], "fits": [f for _, f in found]})


def distinct_parts(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """What blanks separate: the distinct parts, the number of each part in order, and where each text's begin."""
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), lists.offsets.to_numpy()


def text_blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes, a longer text on its own."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        start = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, start + size, "right")))
        yield texts.slice(first, last - first)
        first = last


class PieceCounts:
    """Token counts of texts as sums over their pieces between cuts; counts of pieces are remembered."""

    def __init__(self, path: str):
        self.coder, self.known = tokenizer(path), _COUNTS.setdefault(path, {})

    def _plain(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.coder.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, parts: set[str]) -> None:
        """``known`` holds pieces that follow a blank, without it."""
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        missing = parts.difference(self.known)
        # A mark alone at the end of a word is a token of its own.
        marked = {p for p in missing if _MARKED.search(p)}
        stems, rest, split = (missing - marked | {p[:-1] for p in marked}).difference(self.known), [], self.coder.model.tokenize
        for stem in stems:
            word = spelled(stem)
            if word is None:
                rest.append(stem)
            else:  # one word for the vocabulary, so its model is asked directly
                self.known[stem] = len(split(BLANK + word))
        self.known.update(zip(rest, self._plain([f" {p}" for p in rest]), strict=True))
        self.known.update((p, self.known[p[:-1]] + 1) for p in marked)

    def of(self, texts: pa.Array) -> np.ndarray:
        """The counts of the texts of one block."""
        # A blank behind other white space is no cut; texts with one are taken apart by the pattern.
        odd = pc.match_substring_regex(texts, r"[\s\v\x{1c}-\x{1f}\x{85}\p{Z}] ").to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), dtype=np.int64)
        plain, numbers, begin = distinct_parts(texts.filter(pa.array(~odd)))
        held = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        self._learn(set(plain).union(*[parts[1:] for parts in held]))
        counts = np.fromiter(map(self.known.__getitem__, plain), dtype=np.int64, count=len(plain))[numbers]
        if len(begin) > 1:
            counts[begin[:-1]] = 0  # a text's first part follows no blank
            out[~odd] = np.add.reduceat(counts, begin[:-1]) + self._plain([plain[k] for k in numbers[begin[:-1]]])
        out[odd] = [n + sum(map(self.known.__getitem__, parts[1:]))
                    for n, parts in zip(self._plain([p[0] for p in held]), held, strict=True)]
        return out


def _count_short(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter = PieceCounts(path)
    for batch in batches:
        counts = [counter.of(block) for block in text_blocks(batch.column("text"))]
        counts = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts)],
                                         ["doc_id", "n_bytes", "n_tokens"])


def _count_whole(batches: Iterator[pd.DataFrame], path: str, size: int, overlap: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        coder = tokenizer(path)
        encode = lambda text: coder.encode(text, add_special_tokens=False)
        counts = []
        for text in batch["text"]:
            places = cuts(text, size)
            counts.append(sum(count_between(encode, text, lo, hi, overlap)[0]
                              for lo, hi in zip(places, places[1:], strict=False)))
        yield pd.DataFrame({"row": batch["row"], "n_tokens": counts})


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 1024, chunk_chars: int = CHUNK_CHARS,
                 overlap: int = OVERLAP_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    Null texts count as empty; repeated rows and null ids are counted row by row; other columns are ignored.
    Documents of up to ``chunk_chars`` characters are counted whole.  The chunks of longer ones are
    dealt to all tasks and their counts summed; a document with a chunk whose surroundings show no common
    boundary is encoded again with wider ones.
    """
    path = path or vocabulary("byte_bpe_50k.json")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    is_short = F.length("text") <= chunk_chars
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, n_tokens long"
    short = rows.filter(is_short).mapInArrow(lambda it: _count_short(it, path), schema)
    # A row is known by its id and text, so repeated rows share one count.
    huge = rows.filter(~is_short).withColumn("row", F.sha2("text", 256))
    texts = huge.select("row", "text").dropDuplicates(["row"])
    chunks = texts.mapInPandas(lambda it: _chunk_rows(it, chunk_chars, overlap),
                               "row string, lo long, hi long, has_before boolean, has_after boolean, text string")
    counted = chunks.repartition(F.xxhash64("row", "lo", "text")).mapInPandas(
        lambda it: _encode_chunks(it, path, overlap), "row string, n long, fits boolean")
    summed = counted.groupBy("row").agg(F.sum("n").alias("n"), F.min("fits").alias("fits"))
    # Wider surroundings than were sent along: from the whole text, few documents if any.
    again = texts.join(summed.filter("not fits").select("row"), "row").mapInPandas(
        lambda it: _count_whole(it, path, chunk_chars, 16 * overlap), "row string, n_tokens long")
    fitting = summed.filter("fits").select("row", F.col("n").alias("n_tokens"))
    long = huge.select("doc_id", "n_bytes", "row").join(fitting.unionByName(again), "row")
    found = short.unionByName(long.select("doc_id", "n_bytes", "n_tokens"))
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
