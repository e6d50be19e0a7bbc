"""Operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.compare import connect
from tests.llm.helpers import SCHEMA, awkward, documents, linked, shingles
from tidemart.llm import (chat, decontaminate, jaccard, licence_table, licences, lines, oracle, packing, quality, repeats, spotsigs,
                          tokens)
from tidemart.llm.common import components, next_lower

LABELS = "doc_id long, quality int, toxic int"

@pytest.fixture(scope="module")
def odd(spark):
    return awkward(spark).cache()

@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

# -- 1 packing --------------------------------------------------------------------------------

def test_packing_of_awkward_and_empty_tables(odd, none):
    pieces = packing.pack(odd).toPandas()
    assert packing.pack(none).count() == 0
    coder = tokens.tokenizer(tokens.vocabulary("word_bpe_49k.json"))
    total = sum(len(coder.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in odd.collect())
    assert pieces["length"].sum() == total
    used = pieces.groupby("sequence_id")["length"].sum()
    assert all(n == 2048 or n & (n - 1) == 0 for n in used)
    assert pieces["doc_id"].isna().any()  # rows without an id are packed as well

def test_deficits_keep_every_window_near_the_mixture():
    queues = [packing.Queue(0.5, 0.0), packing.Queue(0.3, 0.0), packing.Queue(0.2, 0.0)]
    lengths, sizes = [], packing.window_sizes(100_000, 2048)
    for q, total in zip(queues, (50_000, 30_000, 20_000), strict=True):
        for at in range(0, total, 1000):
            q.runs.append(len(lengths))
            lengths.append(min(1000, total - at))
    owner = {run: k for k, q in enumerate(queues) for run in q.runs}
    sent, seen = np.zeros(3), {}
    for run, start, length, window, offset in packing.fill(queues, lengths, sizes):
        assert seen.get(window, 0) == offset
        seen[window] = offset + length
        sent[owner[run]] += length
        if seen[window] == sizes[window] and sizes[window] == 2048:
            assert np.abs(sent - sent.sum() * np.array([0.5, 0.3, 0.2])).max() <= 2 * packing.LEAST_SEND
    assert [seen[k] for k in range(len(sizes))] == sizes

def test_lanes_carry_deficits(spark):
    docs = documents(spark, [f"{w} " * 40 for w in ("alpha", "beta", "gamma") for _ in range(60)])
    pieces = packing.pack(docs, lane_tokens=1500).toPandas()
    assert pieces["sequence_id"].nunique() == pieces["sequence_id"].max() + 1
    assert pieces.groupby(["doc_id"])["length"].sum().eq(pieces.groupby("doc_id")["doc_tokens"].first()).all()

def test_word_ids_equal_whole_encodings():
    random.seed(5)
    parts = ["foo", "É", "日本", " ", "  ", "\n", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "12", "!!", "🙂", "a" * 50, "́", "\t", "ΑΣ",
             "\x1c", " ", "İ", "it's.", "a.", "b,", ". ", "Ünder", "ªº", "fooBar", "A. b. c."]
    texts = ["".join(random.choice(parts) for _ in range(50)) for _ in range(400)] + ["", " "]
    word, byte = tokens.vocabulary("word_bpe_49k.json"), tokens.vocabulary("byte_bpe_50k.json")
    ids, counts = packing.WordIds(word), tokens.PieceCounts(byte)
    for block in tokens.text_blocks(pa.array(texts), 3000):
        found, ends = ids.encode(block)
        for text, a, b in zip(block.to_pylist(), ends, ends[1:], strict=False):
            assert found[a:b].tolist() == tokens.tokenizer(word).encode(text, add_special_tokens=False).ids
        whole = [len(tokens.tokenizer(byte).encode(t, add_special_tokens=False).ids) for t in block.to_pylist()]
        assert counts.of(block).tolist() == whole

# -- 2 spot signatures --------------------------------------------------------------------------

def test_spot_signatures_of_awkward_and_empty_tables(odd, none):
    found = spotsigs.compared_with_next(odd).toPandas()
    assert len(found) == odd.count() and spotsigs.compared_with_next(none).count() == 0
    assert found[found["doc_id"].isna()]["near_next"].isna().all()
    assert found[found["doc_id"] == 2]["signatures"].str.len().eq(0).all()

def test_near_duplicates_by_signatures(spark):
    base = "the cat sat on the old mat and the small dog ran to the big red house of a friend in the long green garden by the sea"
    far = "is there any reason for a storm that was on land or in hills with trees and lakes which are not near"
    docs = documents(spark, [base, base, base + " tomorrow", far, "", None])
    members, links = spotsigs.near_duplicates(spotsigs.fingerprints(docs))
    assert {(r["doc_id"], r["class"]) for r in members.collect()} == {(0, 0), (1, 0), (2, 2), (3, 3)}
    assert [(r["a"], r["b"]) for r in links.collect()] == [(0, 2)]

def test_next_lower_over_several_levels(spark):
    ids = [0, 1, 5, 4096, 4097, 9000, 20_000_000, 20_000_001, 1 << 40, -7]
    found = next_lower(spark.createDataFrame([(i,) for i in [*ids, 5, None]], "doc_id long"), "doc_id").collect()
    ordered = sorted(ids)
    assert {r["doc_id"]: r["next_id"] for r in found} == dict(zip(ordered, ordered[-1:] + ordered[:-1], strict=True))

# -- 3 quality ----------------------------------------------------------------------------------

def test_quality_of_awkward_and_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 1), (6, None, None), (None, 1, 1), (5, 0, 1)], LABELS)
    assert quality.judge(odd, labels).count() == odd.count()
    assert quality.judge(none, labels).count() == 0
    assert quality.judge(odd, labels.limit(0)).filter("rejected").count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns

def test_rejected_rows_without_an_id_go(spark):
    rng = random.Random(8)
    good, bad = [f"calm{k}" for k in range(30)], [f"vile{k}" for k in range(30)]
    words = lambda kind: " ".join(rng.choices(kind, k=20))
    rows = [(k, words(bad if k % 3 == 0 else good), "en", "a", 1) for k in range(300)]
    unnamed = [(None, words(bad if k % 2 else good), "en", "a", 1) for k in range(40)] + [(None, None, None, None, None)]
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(300)], LABELS)
    docs = spark.createDataFrame(rows + unnamed, SCHEMA)
    rejected = quality.judge(docs, labels).filter("rejected and doc_id is null").count()
    kept = [r["text"] for r in quality.keep_good(docs, labels).filter("doc_id is null").collect()]
    assert rejected == 20 and len(kept) == len(unnamed) - rejected and not any("vile" in (t or "") for t in kept)

def test_sparse_sites_are_shrunk_more(spark):
    rows = [(k, f"plain text {k} about nothing much", "en", "big", 1) for k in range(200)]
    rows += [(1000 + k, f"plain text {k} about nothing much", "en", f"small{k}", 1) for k in range(20)]
    labels = spark.createDataFrame([(k, 0 if k % 2 else 1, 0) for k in range(200)] + [(1000 + k, 1, 0) for k in range(20)], LABELS)
    found = {r["doc_id"]: r["low"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA), labels).collect()}
    assert found[0] > found[1000] > 0  # the full site keeps its rate, a site of one good page is not taken as all good

# -- 4 licences ---------------------------------------------------------------------------------

def test_licence_texts_in_other_spellings(spark, odd, none):
    known = licences.known_licences(spark)
    mit = licences.KNOWN[2][1].upper().replace("LIMITED", "limited").replace(", ", ",\n")
    docs = documents(spark, ["Copyright (c) 2020 Somebody\n" + mit, "some words\nReleased under the M.I.T. Licence!\nmore", None, "",
                             "some words\n* Released under the MIT Licence *\nLICENSED UNDER CC BY NC 4 0"])
    found = {r["doc_id"]: (r["licence"], r["n_notices"], r["notices"]) for r in licences.scan_licences(docs, known).collect()}
    assert found[0][0] == "MIT" and found[2] == (None, 0, "") and found[3] == (None, 0, "")
    assert found[1] == (None, 0, "") and found[4] == (None, 2, "CC-BY-NC-4.0,MIT")
    assert licences.scan_licences(odd, known).count() == 10
    assert licences.scan_licences(none, known).count() == 0
    assert licences.scan_licences(docs, known.limit(0)).filter("licence is not null").count() == 0


def test_common_licences_are_known(spark, tmp_path):
    """Whole texts as shipped, filled in, titled and wrapped anew, and usual notices; the SQL agrees."""
    text = licence_table._text
    unwrapped = lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n"))
    wholes = {"Apache-2.0": text("Apache-2.0").replace("[yyyy] [name of copyright owner]", "2024 Somebody"),
              "GPL-3.0-only": text("GPL-3.0-only"), "GPL-2.0-only": text("GPL-2.0-only").split("END OF TERMS")[0] + "END OF TERMS AND CONDITIONS\n",
              "LGPL-2.1-only": text("LGPL-2.1-only"), "MPL-2.0": unwrapped(text("MPL-2.0")), "BSL-1.0": text("BSL-1.0").upper(),
              "Unlicense": text("Unlicense").replace("http:", "https:"), "CC0-1.0": text("CC0-1.0"), "GFDL-1.3-only": text("GFDL-1.3-only"),
              "BSD-2-Clause": "Copyright (c) 2020, Me\nAll rights reserved.\n\n" + text("BSD-2-Clause"),
              "BSD-3-Clause": "BSD 3-Clause License\n\nCopyright (c) 2020, Me\nAll rights reserved.\n\n" + text("BSD-3-Clause"),
              "MIT": "The MIT License (MIT)\n\nCopyright (c) 2020 Me\n\n" + text("MIT"), "ISC": "The ISC License\n\n" + text("ISC")}
    lines = {"Apache-2.0": ' * Licensed under the Apache License, Version 2.0 (the "License");', "MPL-2.0": "# SPDX-License-Identifier: MPL-2.0",
             "BSD-3-Clause": "This project is licensed under the BSD 3-Clause License - see the [LICENSE](LICENSE) file for details.",
             "GPL-3.0-or-later": "// SPDX-License-Identifier: GPL-3.0-or-later */", "CC-BY-SA-4.0":
             "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."}
    docs = documents(spark, [*wholes.values(), *(f"some words\n{line}\nmore words" for line in lines.values()), "some words"])
    found = sorted(licences.scan_licences(docs, licences.known_licences(spark)).collect())
    assert [r["licence"] for r in found] == [*wholes, *[None] * (len(lines) + 1)]
    assert [r["notices"] for r in found[len(wholes):]] == [*lines, ""]
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    expected = connect(str(tmp_path)).execute(oracle.statements()["op4_licence_scan"]).fetchall()
    assert [tuple(r) for r in found] == sorted(expected)

# -- 5 decontamination ----------------------------------------------------------------------------

def greedy_tiles(item, doc, least):
    """Greedy string tiling as published: longest unmarked matches first, compared symbol by symbol."""
    a, b, covered = [False] * len(item), [False] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and item[i + k] == doc[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < least:
            return covered
        for k in range(best[0]):
            a[best[1] + k] = b[best[2] + k] = True
        covered += best[0]

def test_tiles_cover_as_much_as_brute_force():
    random.seed(11)
    for _ in range(60):
        item = [random.choice("abcd") for _ in range(random.randint(3, 25))]
        doc = [random.choice("abcd") for _ in range(random.randint(3, 40))]
        names = lambda letters: np.array([ord(c) * 0x9E3779B97F4A7C15 % (1 << 64) for c in letters], dtype=np.uint64)
        tiles = decontaminate.tiles_between(names(item), names(doc), 3, 1)
        for i, j, n in tiles:
            assert item[i:i + n] == doc[j:j + n]
        for side in (0, 1):
            marked = [k for t in tiles for k in range(t[side], t[side] + t[2])]
            assert len(marked) == len(set(marked))
        covered = sum(n for _, _, n in tiles)
        assert abs(covered - greedy_tiles(item, doc, 3)) <= 3  # equal lengths may be taken in another order

def test_repetitive_texts_are_tiled_in_little_memory(spark):
    words = np.full(100_000, 0x9E3779B97F4A7C15, dtype=np.uint64)
    decontaminate.powers(10)  # its table is made once
    tracemalloc.start()
    assert decontaminate.tiles_between(words[:500], words, 5, 250) == [(0, 0, 500)]
    assert tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()
    docs = documents(spark, ["word " * 100_000, "word " * 3, "a " * 60 + "b " * 60, " ".join(f"u{k}" for k in range(50))])
    items = spark.createDataFrame([(1, "word " * 500), (2, "a " * 100 + "b " * 100)], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"], r["covered"]) for r in found} == {(0, 1, 500), (2, 2, 120)}

def test_reordered_passages_are_caught(spark, odd, none):
    item = [f"w{k}" for k in range(30)]
    docs = documents(spark, [" ".join(item), "intro " + " ".join(item[20:] + ["gap"] + item[10:20] + ["gap"] + item[:10]) + " outro",
                             " ".join(item[:14]) + " other", " ".join(reversed(item)), None, "", "Two, WORDS there"])
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "two words")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): (r["covered"], len(r["tiles"])) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(0, 1): (30, 1), (1, 1): (30, 3), (6, 4): (2, 1)}
    assert decontaminate.contaminated(odd, items).count() == 0 and decontaminate.contaminated(none, items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.without_contaminated(odd, items).count() == odd.count()

def test_contaminated_rows_without_an_id_go(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = documents(spark, [(None, f"before {item} after"), (None, f"before {item} after"), (None, "clean words"), (None, None), (1, item),
                             (2, "clean words"), (2, "clean words")])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.without_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in left.collect()) == [
        ("2", "clean words"), ("2", "clean words"), ("None", "None"), ("None", "clean words")]

# -- 6 repeated bytes -----------------------------------------------------------------------------

def test_suffix_order_equals_sorting():
    random.seed(3)
    for _ in range(40):
        texts = ["".join(random.choice("abc") for _ in range(random.randint(0, 14))).encode() for _ in range(random.randint(1, 9))]
        owner, start, common = repeats.suffix_order(texts)
        got = [texts[i][k:] for i, k in zip(owner, start, strict=True)]
        assert got == sorted(texts[i][k:] for i in range(len(texts)) for k in range(len(texts[i]) + 1))
        for a, b, n in zip(got, got[1:], common[1:], strict=False):
            assert n == next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))

def expected_left(docs, length):
    seen, out = set(), {}
    for doc, text in docs:
        data = text.encode()
        gone = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - length + 1):
            if data[k:k + length] in seen:
                gone[k:k + length] = True
            seen.add(data[k:k + length])
        out[doc] = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
    return out

@pytest.mark.parametrize("crowd", [1000, 2])
def test_repeated_bytes_with_copies_and_common_passages(spark, monkeypatch, crowd):
    """With ``crowd`` 2 nearly every anchor takes the path of single windows."""
    monkeypatch.setattr(repeats, "CROWD", crowd)
    random.seed(8)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(random.randint(1, 8)))
    passage = " ".join(word() for _ in range(40))
    texts = [" ".join(word() for _ in range(30)) + " " + passage + " " + " ".join(word() for _ in range(30)) for _ in range(12)]
    texts += [texts[0]] * 5 + ["ab" * 400, "ab" * 300 + "x", "", "é" * 120, passage[:99], passage[:100]]
    docs = documents(spark, texts)
    got = {r["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(docs.repartition(4)).collect()}
    assert got == expected_left(list(enumerate(texts)), 100)

def test_repeated_bytes_of_awkward_and_empty_tables(odd, none):
    found = repeats.without_repeats(odd).toPandas()
    assert len(found) == odd.count() and repeats.without_repeats(none).count() == 0
    assert found[found["doc_id"] == 3]["n_bytes"].tolist() == [0]

def test_many_texts_without_an_id(spark):
    rows = [(None, f"{k:07d}" + "".join(f" shared{j}" for j in range(14)) + f" {k}") for k in range(9000)]
    found = repeats.without_repeats(documents(spark, rows)).select("n_bytes", "n_removed").toPandas()
    first = found[found["n_removed"] == 0]
    assert len(found) == 9000 and len(first) == 1  # whichever hash is the smallest
    assert (found["n_bytes"] - found["n_removed"]).max() == first["n_bytes"].iloc[0]

# -- 7 lines --------------------------------------------------------------------------------------

def test_shifted_blocks_of_lines_are_removed(spark, odd, none):
    block = [f"shared line number {k}" for k in range(40)]
    own = lambda n, m: [f"own line {n} {k}" for k in range(m)]
    docs = documents(spark, ["\n".join(own(0, 5) + block + own(10, 3)), "\n".join(own(1, 8) + block + own(11, 4)),
                             "\n".join(own(2, 1) + block)])
    rows = {r["doc_id"]: r for r in lines.drop_repeated_chunks(docs).collect()}
    assert rows[0]["n_removed_lines"] == 0 and rows[0]["text"].count("\n") == 47
    for doc in (1, 2):
        assert rows[doc]["n_removed_lines"] >= 12
        assert all(line in rows[doc]["text"] for line in own(doc, 1))
    left = lines.drop_repeated_chunks(odd)
    assert left.count() == odd.count() and lines.drop_repeated_chunks(none).count() == 0
    assert left.filter("text is null").count() == 2


def test_shared_passages_of_few_lines(spark):
    """Passages of 2 to 6 lines between lines of their own, in two documents each: how many lose a line in the second, never in the first."""
    import random
    dice = random.Random(5)
    line = lambda: " ".join(str(dice.randrange(10 ** 6)) for _ in range(12))
    texts, own = [], {}
    for n in range(2, 7):
        for _ in range(200):
            shared = [line() for _ in range(n)]
            for _ in range(2):
                around = [[line() for _ in range(4)] for _ in range(2)]
                own[len(texts)] = around[0] + around[1]
                texts.append("\n".join(around[0] + shared + around[1]))
    rows = {r["doc_id"]: r for r in lines.drop_repeated_chunks(documents(spark, texts)).collect()}
    assert all(rows[i]["n_removed_lines"] == 0 for i in range(0, len(texts), 2))
    assert all(set(own[i]) <= set(rows[i]["text"].split("\n")) for i in own)
    touched = {n: sum(rows[(n - 2) * 400 + 2 * i + 1]["n_removed_lines"] > 0 for i in range(200)) / 200 for n in range(2, 7)}
    for n, least in {3: 0.2, 4: 0.35, 5: 0.5, 6: 0.6}.items():
        assert touched[n] >= least

# -- 8 token counts ---------------------------------------------------------------------------------

def test_chunked_counts_equal_whole_encodings(spark, odd, none):
    path = tokens.vocabulary("byte_bpe_50k.json")
    coder = tokens.tokenizer(path)
    expected = sorted(len(coder.encode(r["text"] or "", add_special_tokens=False).ids) for r in odd.collect())
    for chunk, overlap in ((1 << 16, 256), (40, 2)):
        found = tokens.count_tokens(odd, chunk_chars=chunk, overlap=overlap)
        assert sorted(r["n_tokens"] for r in found.collect()) == expected
    assert tokens.count_tokens(none).count() == 0
    run = documents(spark, ["x" * 5000, "ab" * 3000 + " " + "日本" * 900, "\n" * 3000])
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(run, chunk_chars=64, overlap=4).collect()}
    assert got == {r["doc_id"]: len(coder.encode(r["text"], add_special_tokens=False).ids) for r in run.collect()}

def test_overlaps_widen_until_both_cuts_show():
    coder = tokens.tokenizer(tokens.vocabulary("byte_bpe_50k.json"))
    asked = []

    def encode(text):
        asked.append(len(text))
        return coder.encode(text, add_special_tokens=False)

    text = "a" * 300 + "b" * 300
    assert not tokens.count_between(encode, text, 301, 600, 1)[1]  # inside a run of letters no cut is sure
    assert asked[0] == 300 and asked[-1] == 600
    assert tokens.count_between(encode, "one two three", 3, 13, 1) == (2, True)

# -- 9 Jaccard --------------------------------------------------------------------------------------

def varied(seed, groups, copies, words, edits):
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    out = []
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(rng.randint(*words))] + (passage if g % 2 else [])
        for _ in range(rng.randint(1, copies)):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(len(text))] = f"e{rng.random()}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return out

@pytest.mark.parametrize("words,edits", [((1, 12), 1), ((5, 60), 2), ((60, 200), 6), ((300, 600), 20)])
def test_components_equal_all_pairs(spark, monkeypatch, words, edits):
    monkeypatch.setattr(jaccard, "FEW", 3)  # so that some lists are fuller in a small table
    texts = varied(len(str(words)) + edits, 25, 8, words, edits)
    sets = {k: shingles(t) for k, t in enumerate(texts)}
    found = jaccard.similar_documents(documents(spark, texts))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == {
        k: (len(sets[k]), root) for k, root in linked(sets).items()}

def test_long_sets_link_at_exactly_the_threshold(spark):
    """Sets of 400 to 5000 shingles whose Jaccard is 0.8, or one shingle less."""
    def run(name, n):
        return [f"{name}w{k}" for k in range(n)]

    texts = []
    for n in (405, 900, 2250, 4995):
        for less in (0, 1):
            head = run(f"h{n}-{less}", 8 * n // 9 + 4 - less)  # of n shingles each, 8 n / 9 are shared
            texts += [" ".join(head + run(f"t{n}-{less}-{k}", n // 9 + less)) for k in range(2)]
    for n in (500, 5000):
        for less in (0, 1):
            whole = run(f"s{n}-{less}", n + 4)
            texts += [" ".join(whole), " ".join(whole[:4 * n // 5 + 4 - less])]  # one set within the other
    sets = {k: shingles(t) for k, t in enumerate(texts)}
    expected = linked(sets)
    assert [expected[k] for k in range(1, len(texts), 2)] == [k - 1 + k // 2 % 2 for k in range(1, len(texts), 2)]
    found = {r["doc_id"]: r["component_id"] for r in jaccard.similar_documents(documents(spark, texts)).collect()}
    assert found == expected

def test_subset_sizes_cover_every_pair():
    for a in range(1, 25):
        for b in range(a, a * 5 // 4 + 1):
            assert jaccard.need(a, b) > a or {jaccard.need(a, b)} <= set(jaccard.subset_sizes(a)) & set(jaccard.subset_sizes(b))

def test_light_sets_link_by_subsets(spark):
    texts = varied(4, 30, 5, (5, 16), 1)
    sets = {k: shingles(t) for k, t in enumerate(texts)}
    rows = [(k, len(s), [abs(hash(x)) % (1 << 60) for x in s]) for k, s in sets.items() if 0 < len(s) <= 12]
    small = spark.createDataFrame([(k, n, sorted(h)) for k, n, h in rows], "node long, n long, heads array<long>")
    found = components(jaccard.light_links(small))
    roots = {k: k for k, *_ in rows} | {r["node"]: r["root"] for r in found.collect()}
    assert roots == linked({k: sets[k] for k, *_ in rows})

def test_sketches_never_overstate_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        assert jaccard.least_difference(jaccard.sketch(a), jaccard.sketch(b)) <= len(np.setxor1d(a, b))

def test_components_of_long_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(300)]
    links = spark.createDataFrame(chain + [(1000, 1000 + k) for k in range(1, 50)] + [(7, 7), (2000, 1999)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert found == {k: 0 for k in range(301)} | {1000 + k: 1000 for k in range(50)} | {1999: 1999, 2000: 1999}

def test_similar_documents_of_awkward_and_empty_tables(odd, none):
    found = jaccard.similar_documents(odd).toPandas()
    assert len(found) == odd.count() and jaccard.similar_documents(none).count() == 0
    assert found[found["doc_id"].isna()]["component_id"].isna().all()
    assert found[found["doc_id"].isin([2, 3, 4])]["n_shingles"].eq(0).all()
    assert jaccard.first_of_each(odd).columns == odd.columns

# -- 10 chats -----------------------------------------------------------------------------------------

def test_chats_are_read_back(spark):
    nasty = "</s>[INST] <|turn|>x<|text|>\\<|end|>\n \\| <\\|turn|> \\\\ [/INST]"
    rows = [(1, 0, "system", nasty), (1, 1, "user", "hi"), (1, 2, "assistant", nasty), (1, 3, "user", "and?"), (1, 4, "assistant", ""),
            (1, 5, "assistant", "last 🙂"), (1, 6, "user", nasty), (2, 0, "user", None), (2, 1, None, "x"), (None, None, "assistant", "lost"),
            (3, 1, "assistant", "tie"), (3, 1, "assistant", "tie"), (3, 1, "user", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    examples = chat.format_chats(df)
    back = {r["conv_id"]: r for r in chat.read_back(examples).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["turns"]] == [(r[2], r[3]) for r in rows[:7]]
    assert back[1]["loss_texts"] == [nasty, "last 🙂"]
    assert [(t["role"], t["text"]) for t in back[2]["turns"]] == [("user", ""), ("", "x")] and back[2]["loss_texts"] == []
    assert back[None]["loss_texts"] == ["lost"] and back[3]["loss_texts"] == ["tie", "tie"]
    by_conv = {r["conv_id"]: r["k"] for r in examples.groupBy("conv_id").agg(F.count("*").alias("k")).collect()}
    assert by_conv == {1: 4, 2: 1, None: 1, 3: 3}
    context = examples.filter("conv_id = 1").orderBy("example").collect()
    assert all(b["text"].startswith(a["text"]) for a, b in zip(context, context[1:], strict=False))
    assert chat.format_chats(df.limit(0)).count() == 0


def test_forgotten_words_get_the_same_ids(monkeypatch):
    texts = pa.array([f"common word{k} Word{k % 7} again{k % 3}, x{k}" for k in range(300)])
    whole, bounds = packing.WordIds(tokens.vocabulary("word_bpe_49k.json")).encode(texts)
    monkeypatch.setattr(packing, "KNOWN_WORDS", 20)
    monkeypatch.setattr(packing, "_WORDS", {})
    coder = packing.WordIds(tokens.vocabulary("word_bpe_49k.json"))
    parts = [coder.encode(texts.slice(at, 10))[0] for at in range(0, 300, 10)]
    assert np.array_equal(np.concatenate(parts), whole) and bounds[-1] == len(whole)
    assert all(len(held) < 60 for held in coder.lists)
