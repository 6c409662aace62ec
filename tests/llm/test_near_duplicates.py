"""Near duplicates against all pairs, and the components they rest on."""

import random
import re

import numpy as np
import pytest

from spanlake.llm import near_duplicates as nd
from spanlake.llm.components import components

SCHEMA = "doc_id long, text string, key string, links int"


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def by_all_pairs(rows):
    """Class, smallest id of the text and links of each row."""
    last = float("inf")
    reps, sets = {}, {}
    for i, text, *_ in rows:
        text = text or ""
        reps[text] = min(reps.get(text, last), last if i is None else i)
        sets[text] = shingles(text)
    texts = sorted(reps, key=lambda t: (reps[t], t))
    links, root = dict.fromkeys(texts, 0), {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            union = len(sets[a] | sets[b])
            if union and len(sets[a] & sets[b]) >= 0.8 * union - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)), key=lambda t: (reps[t], t))
                root[y] = x
    plain = lambda n: None if n == last else n
    return sorted(
        ((i, plain(reps[top(t or "")]), plain(reps[t or ""]), links[t or ""]) for i, t, *_ in rows),
        key=repr,
    )


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    word = lambda: "".join(draw.choices("abcdefgh", k=4))
    made, number = [], 0

    def add(text, i=0):
        nonlocal number
        made.append((number if i is not None else None, text, "k", 1))
        number += 1

    for size in (6, 40, 200):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 2, 4, 8):
            changed = list(base)
            for _ in range(edits * size // 200 + (edits > 0)):
                changed[draw.randrange(size)] = word()
            add(" ".join(changed))
    big = [word() for _ in range(120)]
    for _ in range(60):  # a group whose members are linked to some others only
        changed = list(big)
        for _ in range(draw.randrange(4)):
            changed[draw.randrange(120)] = word()
        add(" ".join(changed))
    for _ in range(30):
        add(" ".join(word() for _ in range(50)))
    for text in (None, "", "?!", "one", "One!", "one two", None, "   "):
        add(text)
    add(" ".join(big), None)
    add("only without an id", None)
    add(" ".join(f"w{i}" for i in range(30_000)))
    add(" ".join(f"w{i}" for i in range(30_010)))
    made += made[:3]
    return made


def found(df):
    return sorted(((r.doc_id, r.class_id, r.text_id, r.n_links) for r in df.collect()), key=repr)


@pytest.mark.parametrize("how", [{}, {"block": 7}, {"block_bytes": 8000}])
def test_links_and_classes_equal_all_pairs(spark, rows, how):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(nd.join_counts(docs, **how)) == by_all_pairs(rows)


@pytest.mark.parametrize("block", [nd.BLOCK, 7, 2])
def test_one_of_each_class_stays(spark, rows, block):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = nd.keep_one(docs, block=block)
    assert kept.columns == docs.columns
    # Of the texts without any id nothing but the text tells which class they are.
    wanted = {c for _, c, _, _ in by_all_pairs(rows)}
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted(wanted, key=repr)


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nd.join_counts(none).count() == nd.keep_one(none).count() == 0


def test_the_prefix_is_shortened_to_the_recall():
    for trees, recall in ((16, 0.999), (8, 0.9), (32, 0.99)):
        length = nd.prefix_length(0.8, trees, 8, recall)
        assert length == 1 or 1 - (1 - 0.8**length) ** trees >= recall
        assert length == 8 or 1 - (1 - 0.8 ** (length + 1)) ** trees < recall


def test_least_similarity_of_small_sets():
    for threshold in (0.5, 0.75, 0.8):
        for size in range(1, 40):
            possible = [
                c / (size + other - c)
                for other in range(1, 3 * size)
                for c in range(1, min(size, other) + 1)
                if c >= threshold * (size + other - c) - 1e-9
            ]
            assert nd.least_similarity(size, threshold) == pytest.approx(min(possible))
    assert nd.least_similarity(0) == 1 and nd.least_similarity(1000) == nd.THRESHOLD


def trie_matches(texts, shortest):
    """The length that each text's prefix in each tree is shortened to, step by step from the whole label."""
    wanted = {}
    for t in texts:
        for tree, label in enumerate(t.labels or []):
            below = lambda length: {
                o.key for o in texts if o.labels and o.labels[tree].startswith(label[: length * nd.STEP])
            }
            if len(below(shortest)) < 2:
                continue
            length = nd.DEPTH
            while below(length) != below(t.least):
                length -= 1
            if len(below(length)) > 1:
                wanted[bytes(t.key), tree] = length
    return wanted


def test_prefixes_differ_between_texts_and_trees(spark, rows):
    short = [(900 + i, f"a b c d e{i}", "k", 1) for i in (1, 1, 2)] + [
        (950, "v w x y z r s", "k", 1),
        (951, "v w x y z r s t", "k", 1),
    ]
    docs = spark.createDataFrame(rows[::3] + short, SCHEMA)
    texts = nd.distinct_texts(docs, "doc_id", "text")
    shortest = nd.prefix_length()
    got = {
        (bytes(r.key), r.tree): r.length
        for r in nd.matched(nd.paths(texts, shortest, nd.DEPTH)).collect()
    }
    assert got == trie_matches(texts.collect(), shortest)
    assert len(set(got.values())) > 2
    by_text = {}
    for (key, _), length in got.items():
        by_text.setdefault(key, set()).add(length)
    assert max(len(v) for v in by_text.values()) > 1 and len(set(map(frozenset, by_text.values()))) > 1


def test_recall_of_pairs_just_above_the_threshold(spark):
    """Two thousand pairs of 90 shingles with 80 to 82 in common: a similarity of 0.80 to 0.837."""
    draw = random.Random(11)
    rows, pairs = [], 0
    for n in range(2000):
        base = [f"{draw.getrandbits(40):x}" for _ in range(94)]
        cut = draw.choice((8, 9, 10))
        other = base[: 94 - cut] + [f"{draw.getrandbits(40):x}" for _ in range(cut)]
        a, b = shingles(" ".join(base)), shingles(" ".join(other))
        pairs += len(a & b) >= 0.8 * len(a | b) - 1e-9
        rows += [(2 * n, " ".join(base), "k", 1), (2 * n + 1, " ".join(other), "k", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    met = nd.join_counts(docs).where("n_links > 0 and class_id <> doc_id").count()
    assert pairs == 2000 and pairs * 0.995 <= met <= pairs


def test_shared_entries_of_lists():
    lists = [[1, 2], [], [2, 3], [4], [3, 4, 5], []]
    wanted = [[not set(a).isdisjoint(b) for b in lists] for a in lists]
    assert nd.share_any(lists).tolist() == wanted
    assert not nd.share_any([[], []]).any()


def test_blocks_of_sets_compare_like_pairs():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 60, 50).astype(np.uint64)) for _ in range(40)]
    linked = nd.linked_pairs(sets, 0.6)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            same = len(np.intersect1d(a, b)) >= 0.6 * len(np.union1d(a, b)) - 1e-9
            assert linked[i, j] == (same and i != j)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    roots = components(spark.createDataFrame(edges, "a int, b int"))
    assert {(r.node, r.root) for r in roots.collect()} == {(i, 0) for i in range(41)} | {
        (i, 100) for i in range(100, 140)
    }
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0
