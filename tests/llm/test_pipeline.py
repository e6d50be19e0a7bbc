"""The pipeline's stages, each on what its predecessor kept, against brute force."""

import re

import pytest

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.helpers import linked, shingles
from tidemart.llm import quality, tokens
from tidemart.llm.common import saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns, by name; under '' the documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = saved(stage(spark, docs, SF_DIR))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_stages_and_columns(kept):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "packing"]
    assert all(kept[name].columns == COLUMNS for name in names[:-1])
    sizes = [kept[name].count() for name in ["", *names[:-1]]]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[1] and sizes[-1] > 0


def test_quality_stage_drops_the_rejected_alone(spark, kept):
    found = quality.judge(kept[""], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rejected = {r["doc_id"] for r in found.filter("rejected").collect()}
    before, after = texts(kept[""]), texts(kept["quality classifier"])
    assert rejected and after == {i: t for i, t in before.items() if i not in rejected}


def chunks(text):
    import hashlib

    lines = (text or "").split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, first = [], 0
    for k in range(len(lines)):
        if k == len(lines) - 1 or hashes[k] > hashes[k + 1]:
            out.append(tuple(lines[first:k + 1]))
            first = k + 1
    return out


def test_line_stage_keeps_first_occurrences(kept):
    seen, expected = set(), {}
    for doc, text in sorted(texts(kept["quality classifier"]).items()):
        left = []
        for chunk in chunks(text):
            if len(chunk) < 2 or chunk not in seen:
                left += chunk
            seen.add(chunk)
        new = "\n".join(left)
        if new == (text or "") or new.strip(" "):
            expected[doc] = new
    assert texts(kept["line dedup"]) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in kept["line dedup"].collect())


def test_near_duplicate_stage_keeps_one_of_each_component(kept):
    before = texts(kept["line dedup"])
    roots = linked({i: shingles(t) for i, t in before.items()})
    assert texts(kept["n-gram Jaccard join"]) == {i: t for i, t in before.items() if roots[i] == i}


def test_decontamination_stage_drops_documents_with_an_item(spark, kept):
    words = lambda t: " " + " ".join(re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", t.translate(str.maketrans(
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))) + " "
    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = texts(kept["n-gram Jaccard join"]), texts(kept["benchmark decontamination"])
    whole = {i for i, t in before.items() if any(w in words(t or "") for w in items)}
    assert set(after) == set(before) - whole and all(after[i] == before[i] for i in after)


def test_packing_stage_packs_all_that_is_left(kept):
    coder = tokens.tokenizer(tokens.vocabulary("word_bpe_49k.json"))
    expected = {i: len(coder.encode(t or "", add_special_tokens=False).ids) + 1
                for i, t in texts(kept["benchmark decontamination"]).items()}
    found = kept["packing"].groupBy("doc_id").sum("length").collect()
    assert {r["doc_id"]: r["sum(length)"] for r in found} == expected
