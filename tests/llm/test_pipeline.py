"""The pipeline on the small tables: every stage against the labels and a plain scan."""

import os
import re

import public_tokenizers
import tiktoken

import corpus_pipeline
from spanlake.llm import bpe
from spanlake.llm.common import load

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_stages_keep_columns_and_clean_documents(spark):
    docs = load(spark, SF_DIR, "documents")
    labels = {r.doc_id: r for r in load(spark, SF_DIR, "labels").collect()}
    before, columns = {r.doc_id for r in docs.collect()}, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR).cache()
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and now <= before
        if name in ("toxicity", "quality_rules"):
            wrong = [i for i in before - now if i in labels and not labels[i].toxic and labels[i].quality]
            assert len(wrong) <= 0.05 * len(labels)
        before = now
    tokens = {r.doc_id: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()}
    assert set(tokens) == before and all(len(r.ids) == r.n_tokens for r in tokens.values())
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()} == before


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(text):
    found = words(text)
    return {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()


def test_near_duplicates_against_all_pairs(spark):
    """The document of smallest id of every connected set of texts stays, and no other."""
    docs = [tuple(r) for r in load(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            near = docs[i][1] == docs[j][1] or (a and b and len(a & b) >= 0.8 * len(a | b))
            if near and root[i] != root[j]:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    stay = {min(docs[k][0] for k in range(len(docs)) if root[k] == r) for r in set(root)}
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    made = stage(spark, load(spark, SF_DIR, "documents"), SF_DIR)
    assert {r.doc_id for r in made.collect()} == stay and len(stay) < len(docs)


def test_decontamination_drops_verbatim_items(spark):
    """No document that is kept has all words of an item in a row, and most are kept."""
    items = [f" {' '.join(words(r.text))} " for r in load(spark, SF_DIR, "benchmark").collect()]
    docs = load(spark, SF_DIR, "documents")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF_DIR).collect()}
    has = {
        r.doc_id for r in docs.collect()
        if any(i in f" {' '.join(words(r.text))} " for i in items)
    }
    assert has and not has & kept
    assert len(kept) >= 0.9 * docs.count()


def test_ids_equal_the_library(spark):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = load(spark, SF_DIR, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    made = dict(corpus_pipeline.STAGES)["bpe"](spark, docs, SF_DIR).collect()
    assert len(made) == len(texts)
    assert all(r.ids == library.encode_ordinary(texts[r.doc_id] or "") for r in made)


def test_no_documents(spark):
    docs = load(spark, SF_DIR, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR)
        assert made.count() == 0
