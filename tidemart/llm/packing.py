"""Mixture-controlled packing of documents into fixed windows by deficit round-robin.

Documents are encoded once into a saved table and dealt to lanes by hash.  In a lane every source is a queue;
each window gives every source credit for its target share, sources are visited in turn and send while they
have credit, and what a window leaves of it is carried to the next.  A lane starts with the deficits that the
lanes before it left, which follow from counts alone: share times all tokens before, less the source's own.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tidemart.llm.common import give_back, rows_at_once, saved
from tidemart.llm.tokens import distinct_parts, spelled, text_blocks, tokenizer, vocabulary

WINDOW = 2048
END_ID = 1
LANE_TOKENS = 1 << 20   # tokens of a lane, about; one task packs a lane
RUN_TOKENS = 1 << 16    # tokens of a row of the saved table at most
LEAST_SEND = 256        # a visited source sends so many tokens even on less credit, and owes them
ROWS_AT_ONCE = 1000     # texts that a worker gets at once
KNOWN_WORDS = 1 << 17   # words after which a worker starts a new list of words and their ids; it keeps the last two lists
_WORDS: dict[str, list[dict[str, bytes]]] = {}


class WordIds:
    """Ids of texts, word by word: no token of this kind of vocabulary runs across a blank or line end."""

    def __init__(self, path: str):
        self.coder, self.lists = tokenizer(path), _WORDS.setdefault(path, [{}, {}])
        self.kind = np.dtype("<u2" if self.coder.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.packers = [struct.Struct(f"<{n}{self.code}").pack for n in range(8)]

    @staticmethod
    def spread(texts: pa.Array) -> pa.Array:
        """Texts with blanks between words.

        Fewer different words by steps that the vocabulary's own normalizer and splitter take anyway: ASCII lower
        case (not where it could spell a special token), and a mark alone after a letter as a word of its own.
        """
        low = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        low = pc.replace_substring_regex(low, r"([a-z])([.,!?])([ \n]|\z)", r"\1 \2\3")
        return pc.replace_substring(low, "\n", " ")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts of one block one after the other, and where each text's begin and the last end."""
        words, numbers, begin = distinct_parts(self.spread(texts))
        if len(self.lists[0]) > KNOWN_WORDS:
            self.lists[:] = {}, self.lists[0]
        known, older = self.lists
        rest, split = [], self.coder.model.tokenize
        for word in words:
            if word in known:
                continue
            if word in older:
                known[word] = older[word]
                continue
            low = spelled(word.lower()) if "\u0130" not in word else None
            if low is None:
                rest.append(word)
            else:  # one word for the vocabulary, so its model is asked directly
                found = [t.id for t in split(low)]
                known[word] = self.packers[len(found)](*found) if len(found) < 8 else struct.pack(f"<{len(found)}{self.code}", *found)
        for word, found in zip(rest, self.coder.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[word] = np.array(found.ids, dtype=self.kind).tobytes()
        held = [known[w] for w in words]
        pool = np.frombuffer(b"".join(held), dtype=self.kind)
        sizes = np.fromiter(map(len, held), dtype=np.int64, count=len(held)) // self.kind.itemsize
        first = np.cumsum(sizes) - sizes
        sizes, first = sizes[numbers], first[numbers]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return pool[np.repeat(first - ends[:-1], sizes) + np.arange(ends[-1])], ends[begin]


def _runs(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    coder = WordIds(path)
    end = np.array([END_ID], dtype=coder.kind)
    for batch in batches:
        row, start, n, total, parts = [], [], [], [], []
        for block in text_blocks(batch.column("text")):
            ids, bounds = coder.encode(block)
            first = row[-1] + 1 if row else 0
            for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                own = np.concatenate((ids[a:b], end))
                for at in range(0, len(own), RUN_TOKENS):
                    part = own[at:at + RUN_TOKENS]
                    row.append(first + k)
                    start.append(at)
                    n.append(len(part))
                    total.append(len(own))
                    parts.append(part.tobytes())
        at = pa.array(row, pa.int64())
        columns = [batch.column("doc_id").take(at), batch.column("source").take(at), *[pa.array(x, pa.int64()) for x in (start, n, total)],
                   pa.array(parts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "source", "start", "n", "doc_tokens", "ids"])
    give_back()


def token_runs(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, source, start, n, doc_tokens, ids): the ids of every document with its end id, in little-endian runs."""
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), F.coalesce("text", F.lit("")).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(lambda it: _runs(it, path),
                           f"doc_id {kind}, source string, start long, n long, doc_tokens long, ids binary")


def window_sizes(total: int, window: int) -> list[int]:
    """Full windows, then the rest as powers of two: nothing is padded."""
    rest = total % window
    return [window] * (total // window) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


class Queue:
    """The runs of one source in a lane, in order; ``sent`` tokens of run ``at`` are gone."""

    __slots__ = ("runs", "at", "sent", "share", "credit")

    def __init__(self, share: float, credit: float):
        self.runs, self.at, self.sent, self.share, self.credit = [], 0, 0, share, credit


def fill(queues: list[Queue], lengths: list[int], sizes: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(run, start in it, length, window, offset) of every piece; the queues end empty."""
    turn, active = 0, [q for q in queues if q.runs]
    for number, size in enumerate(sizes):
        offset = idle = 0
        for q in active:
            q.credit += q.share * size
        while offset < size:
            if idle >= len(active):  # nobody has credit: the one that is owed most goes on
                turn, idle = max(range(len(active)), key=lambda k: active[k].credit), -1
            turn %= len(active)
            q = active[turn]
            if q.credit <= 0 and idle >= 0:
                turn, idle = turn + 1, idle + 1
                continue
            run, room = q.runs[q.at], min(size - offset, max(LEAST_SEND, int(q.credit)))
            length = min(room, lengths[run] - q.sent)
            yield run, q.sent, length, number, offset
            offset, idle = offset + length, 0
            q.sent, q.credit = q.sent + length, q.credit - length
            if q.sent == lengths[run]:
                q.at, q.sent = q.at + 1, 0
                if q.at == len(q.runs):
                    active.pop(turn)
                    continue
            if q.credit <= 0:
                turn += 1


def _pack_lane(runs: pd.DataFrame, carry: pd.DataFrame, window: int, width: int) -> pd.DataFrame:
    runs = runs.sort_values(["doc_id", "start", "doc_tokens", "ids"], kind="stable", ignore_index=True)
    queues = {s: Queue(share, credit) for s, share, credit in zip(carry["source"], carry["share"], carry["credit"], strict=True)}
    for k, source in enumerate(runs["source"]):
        queues[source].runs.append(k)
    lengths = runs["n"].tolist()
    pieces = list(fill([queues[s] for s in sorted(queues)], lengths, window_sizes(sum(lengths), window)))
    run, at, length, number, offset = (np.array(x, dtype=np.int64) for x in zip(*pieces, strict=True))
    ids = [np.frombuffer(runs["ids"].iat[r], dtype=f"<u{width}")[a:a + n].astype("<u4").tobytes()
           for r, a, n, _, _ in pieces]
    return pd.DataFrame({
        "doc_id": runs["doc_id"].to_numpy()[run], "source": runs["source"].to_numpy()[run],
        "start": runs["start"].to_numpy()[run] + at, "length": length, "doc_tokens": runs["doc_tokens"].to_numpy()[run],
        "sequence_id": int(carry["first_sequence"].iat[0]) + number, "offset": offset, "ids": ids})


BLOCK_LANES = 1024


def _before(lanes: DataFrame, values: list[str], keys: list[str]) -> DataFrame:
    """Adds ``before_<value>``: the sum over the smaller lanes of the same ``keys``, in blocks of lanes."""
    blocked = lanes.withColumn("block", F.floor(F.col("lane") / BLOCK_LANES))
    inside = Window.partitionBy(*keys, "block").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    outside = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocked.groupBy(*keys, "block").agg(*[F.sum(v).alias(v) for v in values])
    blocks = blocks.select(*keys, "block", *[F.coalesce(F.sum(v).over(outside), F.lit(0)).alias(f"block_{v}") for v in values])
    sums = [(F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"block_{v}")).alias(f"before_{v}") for v in values]
    return blocked.join(blocks, [*keys, "block"]).select(*lanes.columns, *sums)


def pack(docs: DataFrame, path: str | None = None, mixture: DataFrame | None = None, window: int = WINDOW,
         lane_tokens: int = LANE_TOKENS) -> DataFrame:
    """Pieces (doc_id, source, start, length, doc_tokens, sequence_id, offset, ids) that fill all sequences gapless.

    ``ids`` are little-endian unsigned 32-bit ids.  ``mixture`` gives (source, weight); without it the target
    shares are those of the corpus.  Sources without a weight share nothing and go where room is left.  All
    documents are packed once: null texts hold their end id alone, a null source is the source '', repeated
    rows are documents of their own, and an empty table gives no piece.  Other columns are ignored.
    """
    path = path or vocabulary("word_bpe_49k.json")
    with rows_at_once(docs.sparkSession, ROWS_AT_ONCE):
        runs = saved(token_runs(docs, path))
    totals = runs.groupBy("source").agg(F.sum("n").alias("weight"))
    lanes = max(1, round((totals.agg(F.sum("weight")).first()[0] or 0) / lane_tokens))
    shares = _shares(totals if mixture is None else mixture.groupBy("source").agg(F.sum("weight").alias("weight")))
    runs = runs.withColumn("lane", F.pmod(F.xxhash64("doc_id", "start"), F.lit(lanes)))
    held = runs.groupBy("lane", "source").agg(F.sum("n").alias("n"))
    own = _before(held, ["n"], ["source"]).withColumnRenamed("before_n", "own")
    rest = F.col("n") % window
    sequences = (F.floor(F.col("n") / window) + F.bit_count(rest)).cast("long")
    by_lane = held.groupBy("lane").agg(F.sum("n").alias("n")).withColumn("sequences", sequences)
    by_lane = _before(by_lane.withColumn("one", F.lit(1)), ["n", "sequences"], ["one"])
    carry = own.select("lane", "source", "own").join(
        by_lane.select("lane", F.col("before_n").alias("all"), F.col("before_sequences").alias("first_sequence")), "lane")
    carry = carry.join(shares, "source", "left").select(
        "lane", "source", "first_sequence", F.coalesce("share", F.lit(0.0)).alias("share"),
        (F.coalesce("share", F.lit(0.0)) * F.col("all") - F.col("own")).alias("credit"))
    carry = saved(carry)
    width = 2 if tokenizer(path).get_vocab_size() <= 1 << 16 else 4
    kind = dict(docs.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, source string, start long, length long, doc_tokens long, sequence_id long, offset long, "
              "ids binary")
    return runs.groupBy("lane").cogroup(carry.groupBy("lane")).applyInPandas(
        lambda r, c: _pack_lane(r, c, window, width), schema)


def _shares(weights: DataFrame) -> DataFrame:
    total = weights.agg(F.sum("weight")).first()[0] or 1
    return weights.select("source", (F.col("weight") / float(total)).alias("share"))
