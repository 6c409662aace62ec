"""The alignment of two tokenisers against both libraries on whole texts and plain loops."""

import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from spanlake.llm import token_alignment as ta
from spanlake.llm.common import load
from spanlake.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def models():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(models, text):
    """``(id, begin, end)`` of both tokenisations of a whole text; nothing where it has no tokens."""
    a, b = models
    if not text:
        return [], []
    whole, made = b" " + text.encode(), []
    by_char = ta._byte_alphabet()
    ids = a.encode(" " + text, add_special_tokens=False).ids
    raw = [bytes(by_char[c] for c in a.id_to_token(i)) for i in ids]
    pieces = b.encode(text)
    shown = [b.id_to_piece(i) for i in pieces]
    raw_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in zip(pieces, shown)
    ]
    for found, parts in ((ids, raw), (pieces, raw_b)):
        if b"".join(parts) != whole:
            return [], []
        at, one = 0, []
        for i, p in zip(found, parts):
            one.append((i, at, at + len(p)))
            at += len(p)
        made.append(one)
    return made[0], made[1]


def expected(models, rows):
    """Row of the query for each ``(doc_id, text)``."""
    links_of, groups_of, sizes, counts = [], [], [], Counter()
    for _, text in rows:
        a, b = tokens(models, text)
        ends = sorted({t[2] for t in a} & {t[2] for t in b})
        places = {}
        for side, some in enumerate((a, b)):
            for i, _, end in some:
                places.setdefault((end, side), []).append(i)
        links = [(x, y) for e in ends for x in places[e, 0] for y in places[e, 1]]
        counts.update(links)
        shown, last = [], 0
        for e in ends:
            parts = [",".join(str(t[0]) for t in some if last < t[2] <= e) for some in (a, b)]
            shown.append("|".join(parts))
            last = e
        links_of.append(links)
        groups_of.append(";".join(shown))
        sizes.append((len(a), len(b), len(ends), len(links)))
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return [
        (
            doc_id, *size, sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        )
        for (doc_id, _), links, groups, size in zip(rows, links_of, groups_of, sizes)
    ]


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "u") for i, t in rows], "doc_id long, text string, n_a int, _block string")
    parts = ta.align(df.repartition(3), A, B)
    made = ta.with_pair_counts(parts)
    assert "_block" in made.columns and "text" not in made.columns
    assert all(r._block == "u" for r in made.collect())
    return sorted(
        (
            (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
             hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
            for r in made.collect()
        ),
        key=repr,
    )


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "a\n \nb", "\n", "\t a", "x▁y", "▁",
    "<s> </s> <unk>", "<|endoftext|> a <|endoftext|>", "<0x41>", "\x00 a", "café naïve", "café é",
    "中文 文字", "\U0001f600 \U0001f468‍\U0001f469 ok", "a b c　d", "a\x1cb \x1c c", "I'll 's don't",
    "1 23 456", "① ½ x¹", "a​ b", "لا كتاب", "a" * 3000, "ab " * 500, "x\r\n y \r\n", "﻿ a", "a� b", ". . .", "᠎ a",
]


def test_odd_texts_equal_the_libraries(spark, models):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "a"), (None, "a b"), (3, "a")]
    assert run(spark, rows) == sorted(expected(models, rows), key=repr)


def test_random_texts_equal_the_libraries(spark, models):
    rng = random.Random(4)
    parts = [*"ab1.,' \n\t", "  ", " the", "ing", "é", "中", " ß", " ", "'s", "\U0001f600", "́", "_", " \n", "The "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for i in range(600)]
    assert run(spark, rows) == sorted(expected(models, rows), key=repr)


def test_query_equals_the_libraries(spark, models):
    rows = [tuple(r) for r in load(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    made = QUERIES["op11_token_alignment"](spark, SF_DIR)
    assert made.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert sorted(map(tuple, made.collect())) == sorted(expected(models, rows))


def test_no_rows(spark):
    assert run(spark, []) == []


def test_units_move_between_tables_and_are_forgotten(monkeypatch):
    """A full table makes room; what is known again or learnt anew is the same."""
    monkeypatch.setattr(ta, "CACHE_BYTES", 4 * ta.UNIT_BYTES)
    pair, fresh = ta.Pair(A, B), ta.Pair(A, B)
    texts = ["the cat sat", "the dog", "a▁b cat", "the cat"] * 3
    for t in texts:
        made = [[p and [k.groups[i] for i in p] for p in x.places([t])] for x, k in ((pair, pair.young), (fresh, fresh.young))]
        assert made[0] == made[1]
        pair.turn()
    assert len(pair.young.place) < 4 and len(fresh.young.place) == 5


def dense(m, width):
    made = np.zeros((len(m.begins) - 1, width), np.int64)
    np.add.at(made, (m.rows, m.columns), m.values)
    return made


def test_products_equal_dense_ones():
    rng = np.random.default_rng(1)
    for _ in range(100):
        rows, inner, width = rng.integers(1, 9, 3)
        a, b = rng.integers(0, 3, (rows, inner)), rng.integers(0, 3, (inner, width))
        sparse = []
        for m in (a, b):
            begins = np.concatenate([[0], np.cumsum((m > 0).sum(1))])
            sparse.append(ta.Csr(begins, np.nonzero(m)[1], m[m > 0]))
        made = ta.product(*sparse)
        assert (dense(made, width) == a @ b).all()
        assert (dense(ta.transposed(sparse[1], width), inner) == b.T).all()
        assert (ta.times(sparse[0], np.arange(inner)) == a @ np.arange(inner)).all()


def test_overlaps_links_and_groups_by_hand():
    found = ta.aligned(np.array([2, 1, 3]), np.array([1, 2, 1, 2]))  # ab|c|def and a|bc|d|ef
    assert dense(found.overlaps, 4).tolist() == [[1, 1, 0, 0], [0, 1, 0, 0], [0, 0, 1, 2]]
    assert found.links.tolist() == [[1, 1], [2, 3]]
    assert dense(ta.shared_groups(found), 4).tolist() == [[1, 1, 0, 0], [1, 1, 0, 0], [0, 0, 1, 1]]
