"""Exact removal of repeated byte strings by a column-wise multi-document suffix order.

Strings of LENGTH bytes that can be equal are brought together by content: the smallest hash of an ANCHOR-byte
string inside such a window names it, and runs of windows with one anchor make a strip.  Equal strips are one,
named by their hashes; strips that share an anchor but differ are compared.  For that the suffixes of a
collection of strips are ordered column by column: each round puts one more symbol in front of every strip's
suffix, finds the places from the transform of the round before, and merges symbols and common prefixes in
one sequential pass.  Neighbours with a common prefix of LENGTH bytes are the repeated windows.

A strip is at most LENGTH + (LENGTH - ANCHOR) bytes long, which bounds the rounds, and a collection at most
COLLECTION_BYTES, which bounds the columns; so these stay in memory where the method in general reads and
writes files, and no task depends on a local folder.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import BLOCK_BYTES, Hasher, mix64, saved, split_by_filter

LENGTH = 100
ANCHOR = 24
COLLECTION_BYTES = 1 << 19   # of strips looked at together, a group of one anchor at least
CROWD = 4000                 # different strips of one anchor from which they are cut into single windows
SETTLED_BLOCKS = 16          # blocks of text among which equal strips are found before they are sent
DOCS_AT_ONCE = 500           # documents whose bytes are cut out before they are sent
TAG_SHIFT = 32               # a place is the tag of its text, of 31 bits, times 2**32 plus its offset
NO_ID = -(1 << 63)


# -- strips ---------------------------------------------------------------------------------

def _pieces(keys: Iterable[int], tags: Iterable[int], texts: Iterable[bytes], length: int):
    """Blocks (data, key, tag, offset of the piece in its text, bounds in data); long texts in overlapping pieces."""
    held, size = [], 0
    for key, tag, text in zip(keys, tags, texts, strict=True):
        for at in range(0, max(1, len(text) - length + 1), BLOCK_BYTES):
            piece = text[at:at + BLOCK_BYTES + length - 1]
            if len(piece) < length:
                continue
            if held and size + len(piece) > BLOCK_BYTES:
                yield held
                held, size = [], 0
            held.append((key, tag, at, piece))
            size += len(piece)
    if held:
        yield held


def strips(held: list, length: int, anchor: int) -> pd.DataFrame:
    """(doc, at, n, anchor, strip) of a block: n windows from ``at`` share an anchor; ``strip`` hashes all their bytes."""
    data = np.frombuffer(b"".join(p for *_, p in held), dtype=np.uint8)
    sizes = np.array([len(p) for *_, p in held])
    begin = np.concatenate(([0], np.cumsum(sizes)))
    hasher = Hasher(data)
    grams = np.arange(len(data) - anchor + 1)
    hashes = hasher.of(grams, grams + anchor)
    # Upper bits of the hash, then the place: the smallest is the leftmost of the smallest hashes.
    low = np.uint64((1 << 24) - 1)
    best = (hashes & ~low) | grams.astype(np.uint64)
    span, width = length - anchor + 1, 1
    while 2 * width <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[:len(best) - (span - width)], best[span - width:])
    places = (best & low).astype(np.int64)
    windows = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(begin, begin[1:], strict=False)])
    owner = np.repeat(np.arange(len(held)), sizes - length + 1)
    places = places[windows]
    first = np.flatnonzero(np.concatenate(([True], (places[1:] != places[:-1]) | (owner[1:] != owner[:-1]))))
    n = np.diff(np.append(first, len(windows)))
    start, own = windows[first], owner[first]
    key, tag, offset = (np.array(x, dtype=np.int64) for x in zip(*[(k, t, o) for k, t, o, _ in held], strict=True))
    at = (tag[own] << TAG_SHIFT) + offset[own] + start - begin[own]
    return pd.DataFrame({"doc": key[own], "at": at, "n": n.astype(np.int32), "anchor": hashes[places[first]].view(np.int64),
                         "strip": hasher.of(start, start + n + length - 1).view(np.int64)})


def settled(rows: pd.DataFrame) -> pd.DataFrame:
    """Adds ``repeat``: strips that occur earlier among ``rows``.  Neighbouring ones become one row each."""
    rows = rows.sort_values(["anchor", "strip", "doc", "at"], ignore_index=True)
    def as_before(frame: pd.DataFrame, *columns: str) -> np.ndarray:
        equal = np.zeros(len(frame), dtype=bool)  # on arrays: a shifted column would turn to floats
        equal[1:] = np.logical_and.reduce([frame[c].to_numpy()[1:] == frame[c].to_numpy()[:-1] for c in columns])
        return equal

    rows["repeat"] = as_before(rows, "anchor", "strip")
    again = rows[rows["repeat"]].sort_values(["doc", "at"])
    again = again.assign(end=again["at"] + again["n"])
    joined = as_before(again, "doc")
    joined[1:] &= again["at"].to_numpy()[1:] == again["end"].to_numpy()[:-1]
    run = (~joined).cumsum()
    merged = again.groupby(run, sort=False).agg(doc=("doc", "first"), at=("at", "first"), n=("n", "sum"))
    merged = merged.assign(anchor=mix64(merged["at"].to_numpy(dtype=np.int64).view(np.uint64)
                                        ^ merged["doc"].to_numpy(dtype=np.int64).view(np.uint64)).view(np.int64),
                           strip=0, repeat=True)
    return pd.concat([rows[~rows["repeat"]], merged], ignore_index=True).astype({"n": "int32", "repeat": "bool"})


def _find_strips(batches: Iterator[pd.DataFrame], length: int, anchor: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        parts = []
        for held in _pieces(batch["doc"], batch["tag"], (t.encode() for t in batch["text"]), length):
            parts.append(strips(held, length, anchor))
            if len(parts) == SETTLED_BLOCKS:
                yield settled(pd.concat(parts, ignore_index=True))
                parts = []
        if parts:
            yield settled(pd.concat(parts, ignore_index=True))


STRIP_COLUMNS = ["doc", "at", "n", "anchor", "strip", "repeat"]
STRIP_SCHEMA = "doc long, at long, n int, anchor long, strip long, repeat boolean"
FOUND_SCHEMA = "doc long, at long, n int, anchor long, repeat boolean"


def _first_and_later(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """From strips sorted by anchor, strip and place: repeats, and first strips of anchors that have several.

    Holds one row between batches: whether an anchor's first strip is its only one shows with the next strip.
    """
    last, waiting = None, None
    for batch in batches:
        done = batch[batch["repeat"]]
        rows = batch[~batch["repeat"]]
        out = [done.drop(columns="strip")]
        if len(rows):
            anchor, strip = rows["anchor"].to_numpy(), rows["strip"].to_numpy()
            before = (np.concatenate(([last[0] if last else ~anchor[0]], anchor[:-1])),
                      np.concatenate(([last[1] if last else 0], strip[:-1])))
            new_anchor = anchor != before[0]
            new_strip = new_anchor | (strip != before[1])
            other = new_strip & ~new_anchor
            if waiting is not None and (new_anchor.any() or other.any()):
                end = int(np.argmax(new_anchor)) if new_anchor.any() else len(rows)
                if other[:end].any():
                    out.append(waiting)
                waiting = None
            group = np.cumsum(new_anchor)
            several = np.bincount(group, other) > 0
            opening = new_anchor & several[group]
            later = rows[~new_strip].assign(repeat=True)
            out += [later.drop(columns="strip"), rows[other | opening].drop(columns="strip")]
            if new_anchor.any():
                tail = int(np.flatnonzero(new_anchor)[-1])
                waiting = None if several[group[tail]] else rows.iloc[[tail]].drop(columns="strip")
            last = (anchor[-1], strip[-1])
        found = pd.concat(out, ignore_index=True)
        if len(found):
            yield found


def _sorted_out(found: DataFrame) -> DataFrame:
    """(doc, at, n, anchor, repeat) of strips that occur earlier or have to be compared."""
    dealt = found.repartition("anchor").sortWithinPartitions("anchor", "strip", "doc", "at")
    return dealt.mapInPandas(_first_and_later, FOUND_SCHEMA)


# -- ordering the suffixes of a collection ----------------------------------------------------

def suffix_order(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, common prefix with the one before, at most 255) of all suffixes in order, built column by column.

    A text's end sorts before every byte, and ends sort by the number of their text.
    """
    count = len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    joined = np.frombuffer(b"".join(texts), dtype=np.uint8)
    used = np.unique(joined)
    code = np.zeros(256, dtype=np.uint8 if len(used) < 256 else np.uint16)
    code[used] = np.arange(1, len(used) + 1)
    joined, begin = code[joined], np.concatenate(([0], np.cumsum(sizes)))[:-1]
    # Round 0: the empty suffixes.  ``front`` is the symbol before a suffix, 0 where the text is used up.
    common = np.zeros(count, dtype=np.uint8)
    front = np.where(sizes > 0, joined[np.maximum(begin + sizes - 1, 0)] if len(joined) else 0, 0).astype(code.dtype)
    grown = np.flatnonzero(sizes > 0)   # texts that grow in this round, and the places of their newest suffixes
    newest = grown.copy()
    for step in range(1, int(sizes.max(initial=0)) + 1):
        # The new order behind the empty suffixes is that of (symbol before, old place).
        order, bounds = _by_symbol(front)
        slot = _slots(order, bounds, front[newest], newest)
        turn = np.argsort(slot, kind="stable")
        slot, grown = slot[turn], grown[turn]
        # Common prefixes change at the new suffixes and right behind them.
        total = len(order)
        touched = np.sort(np.concatenate((slot, slot + 1)))
        touched = touched[(touched > 0) & (touched < total) & (np.diff(touched, prepend=-1) > 0)]
        left, right = order[touched - 1], order[touched]
        same = front[left] == front[right]
        lo, hi = left[same] + 1, right[same] + 1
        fresh = np.zeros(len(touched), dtype=np.uint8)
        if len(lo):
            ranges = np.empty(2 * len(lo), dtype=np.int64)
            ranges[::2], ranges[1::2] = lo[::-1], hi[::-1]  # from the end, so the ranges between hold one entry
            least = np.minimum.reduceat(np.append(common, np.uint8(255)), ranges)[::2][::-1]
            fresh[same] = np.minimum(least, 254) + 1
        # One sequential pass merges the new symbols and prefixes into the old ones.
        place, size = slot + count, len(front) + len(slot)
        old = np.ones(size, dtype=bool)
        old[place] = False
        rest = sizes[grown] - step
        merged = np.empty(size, dtype=front.dtype)
        merged[old] = front
        merged[place] = np.where(rest > 0, joined[np.maximum(begin[grown] + rest - 1, 0)], 0)
        front, before = merged, common
        common = np.zeros(size, dtype=np.uint8)
        common[old] = before
        common[touched + count] = fresh
        grown, newest = grown[rest > 0], place[rest > 0]
    # Whose suffix lies where: from the empty suffixes backwards through the finished transform.
    owner, length = np.empty(len(front), dtype=np.int32), np.zeros(len(front), dtype=np.int64)
    order, bounds = _by_symbol(front)
    rank = np.empty(len(front), dtype=np.int64)
    rank[order] = np.arange(len(order))
    texts_left = place = np.arange(count)
    step = 0
    while len(texts_left):
        owner[place], length[place] = texts_left, step
        more = front[place] != 0
        texts_left, place, step = texts_left[more], rank[place[more]] + count, step + 1
    return owner, sizes[owner] - length, common


def _by_symbol(front: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places by their symbol, used-up texts left out, and where each symbol's begin."""
    counts = np.bincount(front, minlength=2)
    counts[0], used_up = 0, counts[0]
    return np.argsort(front, kind="stable")[used_up:], np.concatenate(([0], np.cumsum(counts)))


def _slots(order: np.ndarray, bounds: np.ndarray, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Where each place stands in ``order``."""
    slot = np.empty(len(places), dtype=np.int64)
    for symbol in np.flatnonzero(np.bincount(symbols)):
        own = symbols == symbol
        slot[own] = bounds[symbol] + np.searchsorted(order[bounds[symbol]:bounds[symbol + 1]], places[own])
    return slot


def _compare(batches: Iterator[pd.DataFrame], length: int, anchor: int) -> Iterator[pd.DataFrame]:
    """Repeated windows of strips, which come sorted by anchor; whole anchors are gathered into collections."""
    held, size, last = [], 0, None
    for batch in batches:
        anchors = batch["anchor"].to_numpy()
        upto = np.concatenate(([0], np.cumsum([len(t) for t in batch["text"]])))
        edges = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        start = 0
        for edge in (edges if last is None or last == anchors[0] else np.concatenate(([0], edges))).tolist():
            if size + upto[edge] - upto[start] > COLLECTION_BYTES:
                yield _compared(pd.concat([*held, batch.iloc[start:edge]], ignore_index=True), length, anchor)
                held, size, start = [], 0, edge
        held.append(batch.iloc[start:])
        size, last = size + upto[-1] - upto[start], anchors[-1]
    if held:
        yield _compared(pd.concat(held, ignore_index=True), length, anchor)


def worth_comparing(texts: list[bytes], anchors: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """Whether a strip can share a window with another one.

    A window has length - anchor bytes beside the anchor, of which some lie to the left.  Whatever their number, the
    window holds one of a few strings around the anchor that differ in where the anchor lies; strips that share
    none of them share no window.
    """
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    begin = ends - sizes
    hasher, grams = Hasher(data), np.arange(len(data) - anchor + 1)
    found = np.flatnonzero(hasher.of(grams, grams + anchor) == np.repeat(anchors.view(np.uint64), sizes)[:len(grams)])
    place = found[np.minimum(np.searchsorted(found, begin), len(found) - 1)]  # its leftmost one is a strip's anchor
    side = length - anchor
    step, worth = max(1, side // 4), np.zeros(len(texts), dtype=bool)
    for left in range(0, side, step):
        lo, hi = place - left, place + anchor + max(0, side - left - step)
        inside = np.flatnonzero((lo >= begin) & (hi <= ends))
        _, number, times = np.unique(hasher.of(lo[inside], hi[inside]), return_inverse=True, return_counts=True)
        worth[inside] |= times[number] > 1
    return worth


def _compared(rows: pd.DataFrame, length: int, anchor: int) -> pd.DataFrame:
    rows = rows[worth_comparing(rows["text"].tolist(), rows["anchor"].to_numpy(), length, anchor)]
    if not len(rows):
        return pd.DataFrame({"doc": [], "at": [], "n": []}).astype({"doc": "int64", "at": "int64", "n": "int32"})
    rows = rows.sort_values(["doc", "at"], ignore_index=True)  # so the number of a strip tells which is earlier
    owner, start, common = suffix_order(rows["text"].tolist())
    run = np.cumsum(common < length) - 1
    heads = np.flatnonzero(common < length)
    key = owner.astype(np.int64) * (1 << 16) + start
    first = np.minimum.reduceat(key, heads)
    again = np.sort(key[key > first[run]])
    cut = np.flatnonzero(np.concatenate(([True], again[1:] != again[:-1] + 1))) if len(again) else np.zeros(0, dtype=int)
    n = np.diff(np.append(cut, len(again)))
    text, at = again[cut] >> 16, again[cut] & 0xFFFF
    return pd.DataFrame({"doc": rows["doc"].to_numpy()[text], "at": rows["at"].to_numpy()[text] + at, "n": n.astype(np.int32)})


def _single_windows(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """The windows of strips of crowded anchors, each a strip of its own that nothing but itself is near."""
    for batch in batches:
        parts = []
        for doc, at, n, text in zip(batch["doc"], batch["at"], batch["n"], batch["text"], strict=True):
            hasher, begin = Hasher(np.frombuffer(text, dtype=np.uint8)), np.arange(n)
            half = length // 2
            parts.append(pd.DataFrame({
                "doc": doc, "at": at + begin, "n": np.int32(1), "anchor": hasher.of(begin, begin + length).view(np.int64),
                "strip": hasher.of(begin, begin + half).view(np.int64)}))
        if parts:
            yield settled(pd.concat(parts, ignore_index=True))[STRIP_COLUMNS]


# -- documents ------------------------------------------------------------------------------

def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    # Texts without an id are documents of their own, named by their hashes, below all ids.
    unnamed = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64(text), 2)
    return docs.select("doc_id", text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("doc"),
                       F.shiftrightunsigned(F.xxhash64(text), 33).alias("tag"))


def _tag_of(at: Column) -> Column:
    return F.shiftright(at, TAG_SHIFT)


def _cut_out(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    """The bytes of the strips asked for."""
    for batch in batches:
        doc = np.repeat(batch["doc"].to_numpy(), [len(x) for x in batch["at"]])
        at, n, anchor, crowded = (np.concatenate(batch[c].to_list()) for c in ("at", "n", "anchor", "crowded"))
        cut = []
        for text, places, sizes in zip(batch["text"], batch["at"], batch["n"], strict=True):
            data = text.encode()
            cut += [data[a:a + k + length - 1] for a, k in zip((places & (1 << TAG_SHIFT) - 1).tolist(), sizes.tolist(), strict=True)]
        yield pd.DataFrame({"doc": doc, "at": at, "n": n, "anchor": anchor, "crowded": crowded, "text": cut})


def repeated_windows(keyed: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc, at, n): n windows from each place occur earlier; ``keyed`` has doc, tag and text."""
    found = keyed.mapInPandas(lambda it: _find_strips(it, length, anchor), STRIP_SCHEMA)
    found = saved(_sorted_out(found))
    unclear = found.filter("not repeat")
    crowds = unclear.groupBy("anchor").agg(F.count("*").alias("strips")).filter(F.col("strips") > CROWD)
    unclear = unclear.join(crowds, "anchor", "left").withColumn("crowded", F.col("strips").isNotNull())
    asked = unclear.groupBy("doc", _tag_of(F.col("at")).alias("tag")).agg(
        F.collect_list(F.struct("at", "n", "anchor", "crowded")).alias("asked"))
    some, _ = split_by_filter(keyed, unclear.select("doc").distinct(), "doc")
    texts = some.dropDuplicates(["doc", "tag"]).join(asked, ["doc", "tag"]).select(
        "doc", "text", *[F.col(f"asked.{c}").alias(c) for c in ("at", "n", "anchor", "crowded")]).mapInPandas(
        lambda it: _cut_out(it, length), "doc long, at long, n int, anchor long, crowded boolean, text binary")
    texts = saved(texts)
    dealt = texts.filter("not crowded").repartition("anchor").sortWithinPartitions("anchor")
    compared = dealt.select("doc", "at", "anchor", "text").mapInPandas(lambda it: _compare(it, length, anchor), "doc long, at long, n int")
    single = texts.filter("crowded").mapInPandas(lambda it: _single_windows(it, length), STRIP_SCHEMA)
    again = _sorted_out(single).filter("repeat")
    columns = ["doc", "at", "n"]
    return found.filter("repeat").select(columns).unionByName(compared).unionByName(again.select(columns))


def _remove(batches: Iterator[pd.DataFrame], length: int) -> Iterator[pd.DataFrame]:
    for batch in (b.iloc[k:k + DOCS_AT_ONCE] for b in batches for k in range(0, len(b), DOCS_AT_ONCE)):
        removed, spans, kept = [], [], []
        for text, at, n in zip(batch["text"], batch["at"], batch["n"], strict=True):
            data = np.frombuffer(text.encode(), dtype=np.uint8)
            change = np.zeros(len(data) + 1, dtype=np.int32)
            if at is not None:
                at = at & (1 << TAG_SHIFT) - 1
                np.add.at(change, at, 1)
                np.add.at(change, at + n + length - 1, -1)
            gone = np.cumsum(change[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))) if len(gone) else 0)
            kept.append(data[~gone].tobytes())
        yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_removed": removed, "n_spans": spans,
                            "kept": kept})


def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per row of ``docs``; ``kept`` holds the bytes left.

    Every byte goes that is covered by a string of ``length`` bytes which also starts earlier: in a smaller
    doc_id, or before in the same text.  Null texts are empty, rows without a doc_id come before all others in the order
    of their texts' hashes (ids below -2**62 would mix with them), rows that repeat a doc_id, or have none, and the text are one
    document, other texts of a doc_id come in the order of their hashes.
    Other columns are ignored.
    """
    keyed = _keyed(docs)
    windows = saved(repeated_windows(keyed, length, anchor))
    cuts = windows.groupBy("doc", _tag_of(F.col("at")).alias("tag")).agg(F.collect_list(F.struct("at", "n")).alias("cuts"))
    cuts = cuts.select("doc", "tag", F.col("cuts.at").alias("at"), F.col("cuts.n").cast("array<long>").alias("n"))
    some, others = split_by_filter(keyed, windows.select("doc").distinct(), "doc")
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    kind = dict(docs.dtypes)["doc_id"]
    some = some.join(cuts, ["doc", "tag"], "left").select("doc_id", n_bytes, "text", "at", "n").mapInPandas(
        lambda it: _remove(it, length), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    zero = F.lit(0).cast("long")
    others = others.select("doc_id", n_bytes, zero.alias("n_removed"), zero.alias("n_spans"), F.col("text").cast("binary").alias("kept"))
    return some.unionByName(others)
