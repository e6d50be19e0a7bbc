"""The registered queries against SQL and against brute force on the smallest tables."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from checks.compare import connect, differences
from tests.conftest import SF_DIR
from tests.llm.helpers import linked, shingles
from tidemart.llm import oracle, queries, spotsigs, tokens

SQL = oracle.statements()


def run(spark, name):
    return queries.registry()[name](spark, SF_DIR).toPandas()


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(spark, SF_DIR, queries.registry()[name], SQL[name], connect(SF_DIR)) is None


def test_packing_is_an_exact_round_trip(spark, texts):
    found = run(spark, "op1_pack_mixture")
    coder = tokens.tokenizer(tokens.vocabulary("word_bpe_49k.json"))
    ids = {i: coder.encode(t, add_special_tokens=False).ids + [1] for i, t in texts.items()}
    assert set(found["doc_id"]) == set(ids)
    for doc, rows in found.sort_values("start").groupby("doc_id"):
        at = 0
        for row in rows.itertuples():
            assert row.start == at and row.doc_tokens == len(ids[doc])
            at += row.length
            assert row.ids_crc32 == zlib.crc32(np.array(ids[doc][row.start:at], dtype="<u4").tobytes())
        assert at == len(ids[doc])
    sizes = []
    for _, rows in found.sort_values("offset").groupby("sequence_id"):
        assert rows["offset"].tolist() == [0, *rows["length"].cumsum().tolist()[:-1]]
        sizes.append(rows["length"].sum())
    assert all(n == 2048 or n < 2048 and n & (n - 1) == 0 for n in sizes)
    assert found["sequence_id"].nunique() == found["sequence_id"].max() + 1


def test_spot_signatures_equal_brute_force(spark, texts):
    common = set(spotsigs.COMMON)

    def signatures(text):
        words, out = re.findall(r"[^\W_]+", text.lower()), set()
        for k, word in enumerate(words):
            content = [w for w in words[k + 1:] if w not in common][:2] if word in common else []
            if len(content) == 2:
                out.add((word, *content))
        return out

    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    jaccard = lambda a, b: len(a & b) / len(a | b)
    prints = {}
    for row in run(spark, "op2_spot_signatures").itertuples():
        text, half = texts[row.doc_id], len(texts[row.doc_id]) // 2
        edited = text[:len(text) - half] + texts[after[row.doc_id]][:half]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, cut, other = (signatures(t) for t in (text, edited, texts[after[row.doc_id]]))
        if own and cut and other:
            assert abs(row.near_edited - jaccard(own, cut)) < 1e-9 and abs(row.near_next - jaccard(own, other)) < 1e-9
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint


def test_classifier_keeps_good_and_drops_toxic_held_out(spark):
    """Learnt on half of the labels of sf0.01, judged on the other half."""
    from tidemart.llm import quality

    sf = SF_DIR.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "is_toxic")
    found = quality.judge(docs, labels.filter("doc_id % 2 = 0")).join(held, "doc_id").toPandas()
    good = found[(found["quality"] == 1) & (found["is_toxic"] == 0)]
    assert good["rejected"].mean() < 0.05
    assert found[found["is_toxic"] == 1]["rejected"].mean() > 0.6
    kept = set(run(spark, "op3_quality_classifier")["doc_id"])
    assert kept and kept <= {r[0] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}


def test_decontamination_finds_every_whole_item(spark, texts):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    words = lambda t: " " + " ".join(re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", t.translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))) + " "
    spread = {i: words(t) for i, t in texts.items()}
    whole = {(i, k) for k, t in items.items() for i, s in spread.items() if words(t) in s}
    found = run(spark, "op5_decontaminate")
    pairs = set(zip(found["doc_id"], found["item_id"], strict=True))
    assert whole and whole <= pairs and len(pairs - whole) <= 1


def test_repeated_bytes_equal_brute_force(spark, texts):
    seen, expected = set(), {}
    for doc in sorted(texts):
        data = texts[doc].encode()
        gone = np.zeros(len(data), dtype=bool)
        for k in range(len(data) - 99):
            if data[k:k + 100] in seen:
                gone[k:k + 100] = True
            seen.add(data[k:k + 100])
        kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
        spans = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))) if len(gone) else 0
        expected[doc] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    found = run(spark, "op6_repeated_bytes")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found.itertuples()}
    assert got == expected and any(v[1] for v in expected.values())


def test_token_counts_equal_whole_encodings(spark, texts):
    coder = tokens.tokenizer(tokens.vocabulary("byte_bpe_50k.json"))
    found = run(spark, "op8_token_counts")
    assert len(found) == len(texts)
    for row in found.itertuples():
        n = len(coder.encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_tokens, row.over_limit, row.n_bytes) == (n, n > 1024, len(texts[row.doc_id].encode()))


def test_similar_documents_equal_brute_force(spark, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    roots = linked(sets)
    found = run(spark, "op9_jaccard_join")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.itertuples()} == {i: (len(sets[i]), roots[i]) for i in sets}


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.registry()) == list(range(1, 14))


def test_results_hold_flat_columns(spark):
    for name, query in queries.registry().items():
        kinds = dict(query(spark, SF_DIR).select("*").dtypes)
        assert not any(k.startswith(("array", "map", "struct")) for k in kinds.values()), name
