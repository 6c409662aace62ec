"""Decontamination and chat formatting on fixtures with known answers and against plain Python."""

import collections
import os
import random
import re

import duckdb
from pyspark.sql import functions as F

from spanlake.llm import chat
from spanlake.llm import decontamination as dc
from spanlake.llm.common import load
from spanlake.llm.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

ITEM = (
    "Tom has 3 boxes of 12 pencils and gives Anna 5 km of string before Tom walks home"
    " with the rest of his boxes"
)
OTHER = (
    "Maria has 7 boxes of 40 pencils and gives Peter 9 miles of string before Maria walks home"
    " with the rest of his boxes"
)
MIXED = ITEM.replace("before Tom", "before Kate").replace("Tom has", "Luke has").replace(
    "Anna", "Kate"
)
FILLER = "plain words that stand around the passage without any meaning at all "


def test_template_and_values_are_aligned(spark):
    texts = [ITEM, "A1b2 3km 4,5 m d'Un ÉTÉ Été 10% l'été", "", None, "x" * 50_000, "É 3 Tage!"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, v in rows.select(dc.template(F.col("t")), dc.values(F.col("t"))).collect():
        assert len(t) == len(v)
        assert all(a == b or a in dc.PLACEHOLDERS for a, b in zip(t, v))
    names, numbers, units = (
        [v for t, v in zip(*spark.createDataFrame([(ITEM,)], "t string").select(
            dc.template(F.col("t")), dc.values(F.col("t"))).first()) if t == kind]
        for kind in dc.PLACEHOLDERS
    )
    assert names == ["tom", "anna", "tom"] and numbers == ["3", "12", "5"] and units == ["km"]


def report(spark, texts, items):
    docs = spark.createDataFrame(
        [(i, t, "x") for i, t in texts], "doc_id long, text string, item string"
    ).repartition(3)
    known = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, tuple(r.item_ids or ())) for r in dc.report(docs, known).collect()}


def test_renamed_questions_are_found_and_inconsistent_ones_are_not(spark):
    item = ITEM.replace("km", "miles")
    texts = [
        (1, FILLER + item + ". " + FILLER),
        (2, FILLER * 50 + OTHER),
        (3, item[:40]),
        (4, FILLER),
        (None, OTHER),
        (5, None),
        (6, ""),
        (1, FILLER + item + ". " + FILLER),
        (7, "2 " * 60_000 + OTHER),
    ]
    items = [(10, item), (11, item), (12, None), (13, "too short"), (None, FILLER * 2)]
    wanted = {(1, (10, 11)), (2, (10, 11)), (3, ()), (4, ()), (None, (10, 11)), (5, ()), (6, ()), (7, (10, 11))}
    assert report(spark, texts, items[:4]) == wanted
    swapped = "Tom has 3 boxes and Tom gives 5 boxes to Anna and Tom keeps 3 boxes while Anna keeps 5"
    broken = "Ida has 4 boxes and Bob gives 6 boxes to Eve and Sam keeps 7 boxes while Joe keeps 8"
    renamed = "Ida has 4 boxes and Ida gives 6 boxes to Eve and Ida keeps 4 boxes while Eve keeps 6"
    assert report(spark, [(1, broken), (2, renamed)], [(1, swapped)]) == {(1, ()), (2, (1,))}


def test_empty_tables(spark):
    assert report(spark, [], [(1, ITEM)]) == set()
    assert report(spark, [(1, ITEM)], []) == {(1, ())}


def test_shuffled_windows_give_the_same(spark, monkeypatch):
    texts, items = [(1, FILLER + OTHER), (2, FILLER)], [(1, ITEM.replace("km", "miles"))]
    whole = report(spark, texts, items)
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    assert report(spark, texts, items) == whole == {(1, (1,)), (2, ())}


def test_keep_clean_keeps_columns_and_repeated_rows(spark):
    docs = spark.createDataFrame(
        [(1, FILLER, "a"), (1, FILLER, "a"), (2, OTHER, "b"), (3, None, "c")],
        "doc_id long, text string, key string",
    )
    known = spark.createDataFrame([(1, ITEM.replace("km", "miles"))], "item_id long, text string")
    kept = dc.keep_clean(docs, known)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 1, 3]


def test_exact_passages_of_the_given_tables_are_found(spark):
    """Every document with all words of an item in a row, by a scan of all items."""
    words = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    docs, items = load(spark, SF_DIR, "documents"), load(spark, SF_DIR, "benchmark")
    known = {r.item_id: words(r.text) for r in items.collect()}
    wanted = {
        (r.doc_id, i) for r in docs.collect() for i, w in known.items() if w in words(r.text or "")
    }
    found = {(r.doc_id, i) for r in dc.report(docs, items).collect() for i in r.item_ids or ()}
    assert wanted <= found
    assert len({d for d, _ in found} - {d for d, _ in wanted}) <= 0.02 * docs.count()


GERMAN = (
    "Der Lehrer Hans Meier kaufte 12 Hefte, 3 Stifte und 5 Bücher im Laden Schmidt in Köln."
    " Dann ging er nach Hause."
)
FEW_LITERALS = [
    GERMAN,
    "The President Of The United States Lives In The White House In Washington",
    "What is 17 + 25 - 4 * 3 / 2 + 9 - 8 + 6",
    "Alice Bob Carol Dave Erin Frank Grace Heidi Ivan Judy met in Paris on Monday",
]


def by_scan(spark, texts, items):
    """Found pairs of places by comparing every window of every item with every one of every text."""

    def split(rows):
        made = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "n int, x string").select(
            "n", dc.plain_words(F.col("x")), dc.template(F.col("x")), dc.values(F.col("x")), dc.starts(F.col("x"))
        )
        return [tuple(r)[1:] for r in sorted(made.collect())]

    def places(words, size):
        return [(i, tuple(words[i : i + size])) for i in range(len(words) - size + 1)]

    def common(mine, theirs, size, fits=lambda w: True):
        return {(at, i - at) for at, w in places(theirs, size) if fits(w) for i, x in places(mine, size) if w == x}

    def agreement(slots):
        renamed = collections.Counter(slots)
        one, other = {}, {}
        for (a, b), n in renamed.items():
            one[a], other[b] = max(one.get(a, 0), n), max(other.get(b, 0), n)
        return min(sum(one.values()), sum(other.values())) / len(slots) if slots else 1

    tells = lambda w: sum(x not in dc.PLACEHOLDERS for x in w) >= dc.MIN_LITERALS
    found = set()
    given = split(items)
    for d, (p, t, mine, _) in enumerate(split(texts)):
        for k, (q, u, theirs, starts) in enumerate(given):
            covered = {at + j for at, _ in common(p, q, dc.WINDOW) for j in range(dc.WINDOW)}
            diagonals, slotted = {}, set()
            for size in (dc.WINDOW, dc.MIN_WORDS):
                for at, shift in common(t, u, size, tells):
                    diagonals.setdefault(shift, set()).update(range(at, at + size))
            for shift, ats in diagonals.items():
                slots = [(theirs[a], mine[a + shift]) for a in ats if u[a] in dc.PLACEHOLDERS]
                if agreement(slots) >= dc.MIN_AGREEMENT:
                    slotted |= ats
            covered |= {starts[a] for a in slotted}
            for enough, size in ((len(covered), len(q)), (len(slotted), len(u))):
                if size >= dc.WINDOW and enough >= min(size, dc.MIN_WORDS):
                    found.add((d, k))
    return found


def in_spark(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    known = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    return {(r.doc_id, i) for r in dc.report(docs, known).collect() for i in r.item_ids or ()}


def test_findings_equal_a_scan_of_all_windows(spark):
    draw = random.Random(3)
    items = [r.text for r in load(spark, SF_DIR, "benchmark").collect()][:40]
    items += [ITEM, MIXED, "what is the value of the sum of three numbers", "seven words are not a whole window"]
    stems = ["What is the value of the following sum if every", "Read the passage and say which of the answers"]
    items += [f"{draw.choice(stems)} {' '.join(draw.choices('a b c d Tom Anna 3 17 km'.split(), k=12))}" for _ in range(20)]
    texts = [OTHER, None, "", FILLER] + [r.text for r in load(spark, SF_DIR, "documents").collect()][:60]
    for item in items:
        words = item.split()
        cut = draw.randrange(len(words))
        texts.append(FILLER + " ".join(words[cut:] + words[:cut]))
        texts.append(" ".join(words[: draw.randrange(6, 20)]) + " " + FILLER + draw.choice(stems))
        texts.append(re.sub(r"\d+", lambda m: str(int(m[0]) + draw.choice((1, 1, 5))), item).replace("Tom", "Kate"))
    wanted = by_scan(spark, texts, items)
    assert in_spark(spark, texts, items) == wanted and 60 < len(wanted) < len(texts) * len(items) / 4


def test_a_phrase_of_all_items_makes_no_pairs(spark):
    draw = random.Random(4)
    word = lambda: "".join(draw.choices("abcdefghij", k=5))
    phrase = "what is the value of the sum of all the numbers"
    items = [f"{phrase} {' '.join(word() for _ in range(12))}" for _ in range(300)]
    texts = [f"{' '.join(word() for _ in range(20))} {phrase} {word()}" for _ in range(299)] + [FILLER + items[7]]
    known = spark.createDataFrame(list(enumerate(items)), "id int, x string").select(
        dc.text_key(F.col("x")).alias("item"),
        dc.plain_words(F.col("x")).alias("p"),
        dc.template(F.col("x")).alias("t"),
        dc.starts(F.col("x")).alias("starts"),
    )
    given = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("key", dc.text_key(F.col("text")))
    found = dc.matches(given, dc.item_windows(known), known)
    assert found.select("key", "item").distinct().count() == 1 and found.count() < 100
    assert in_spark(spark, texts, items) == {(299, 7)}


def test_items_of_few_literal_words_are_found(spark):
    texts = [(i, FILLER + t + " " + FILLER) for i, t in enumerate(FEW_LITERALS)] + [
        (9, "What is 1 + 2 - 3 * 4 / 5 + 6 - 7 + 8"),
        (10, FILLER + GERMAN.replace("Hans", "Karl").replace("12", "7").replace("Köln", "Bonn")),
    ]
    wanted = {(i, (i,)) for i in range(4)} | {(9, ()), (10, (0,))}
    assert report(spark, texts, list(enumerate(FEW_LITERALS))) == wanted


def test_other_units_are_a_renaming(spark):
    drive = "A car drives 12 {0} in one hour and then 30 more {1} on 2 {0} of road; how far is it in all?"
    texts = [(0, OTHER)] + [
        (i, drive.format(unit, unit).replace("12", "17"))
        for i, unit in enumerate(["miles", "meters", "Kilometer", "metros", "mètres", "yards"], 1)
    ]
    found = report(spark, texts, [(1, ITEM), (2, drive.format("km", "km"))])
    assert found == {(0, (1,))} | {(i, (2,)) for i in range(1, 7)}


def test_names_of_other_lengths_and_texts_in_another_case_are_found(spark):
    item = "A shop in Boston sells 12 apples to Mary and 5 pears to Tom; how many are left?"
    longer = item.replace("Boston", "San Francisco").replace("Mary", "Ann Lee")
    texts = [(1, item), (2, longer), (3, item.lower()), (4, item.upper()), (5, longer.replace("San ", "San\n"))]
    assert report(spark, texts, [(1, item)]) == {(i, (1,)) for i in range(1, 6)}
    assert report(spark, texts[:1], [(1, longer)]) == {(1, (1,))}


def test_runs_of_names_are_aligned(spark):
    texts = ["Ann Lee, Bob. 5 Kilometer Hans-Georg Fuchs sah X Ypsilon 3-inch Tom", "Ab " * 50_000, "É. Été", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        dc.template(F.col("t")), dc.values(F.col("t")), dc.starts(F.col("t")), dc.plain_words(F.col("t"))
    )
    for t, v, at, words in rows.collect():
        assert len(t) == len(v) == len(at)
        assert " ".join(v).split() == words
        assert [v[i].split()[0] for i in range(len(v))] == [words[i] for i in at]
        assert all(a == b or a in dc.PLACEHOLDERS for a, b in zip(t, v))


def test_texts_of_one_item_and_items_without_id(spark):
    short = "which small bird sings before the first morning light"
    known = [(1, ITEM), (1, short), (2, FILLER), (None, GERMAN)]
    texts = [(1, short), (2, OTHER), (3, GERMAN), (4, "other " * 20), (5, short + ". " + GERMAN)]
    wanted = {(1, (1,)), (2, (1,)), (3, (None,)), (4, ()), (5, (None, 1))}
    assert report(spark, texts, known) == wanted
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    kept = dc.keep_clean(docs, spark.createDataFrame(known, "item_id long, text string"))
    assert [r.doc_id for r in kept.collect()] == [4]


TALK = [
    (1, 0, "user", "Which tree grows fastest?\nAnd how tall is it?"),
    (1, 1, "assistant", "Poplar grows fast."),
    (1, 2, "user", "On Monday Ann wrote:\n> Which tree grows   FASTEST?\n> And how tall is it?\nI asked twice."),
    (1, 3, "assistant", "> Poplar grows fast.\nIndeed."),
    (1, 4, "user", ">> poplar grows fast.\n> Indeed.\nThanks.\n"),
    (1, 5, None, "> never said by anyone\nOdd."),
    (2, 0, "user", "Poplar grows fast."),
    (2, 1, "user", "> Indeed.\nOther talk."),
    (None, 0, "user", "> Poplar grows fast."),
    (1, None, "user", "> Indeed."),
    (3, 0, "user", None),
    (3, 1, "user", ""),
    (3, 2, "user", "long " * 50_000),
    (2, 1, "user", "> Indeed.\nOther talk."),
]


def test_replies_follow_their_quotations(spark):
    talk = spark.createDataFrame(
        [(*r, "x") for r in TALK], "conv_id long, turn long, role string, text string, parent string"
    ).repartition(3)
    found = chat.conversations(talk).collect()
    assert len(found) == len(TALK)
    by = {(r.conv_id, r.turn): r for r in found}
    links = {k: (r.parent, r.thread, r.depth) for k, r in by.items() if r.parent is not None}
    assert links == {(1, 2): (0, 0, 1), (1, 3): (1, 1, 1), (1, 4): (3, 1, 2)}
    assert by[1, 2].text == "I asked twice." and by[1, 2].n_quoted == 2
    assert by[1, 4].text == "Thanks." and by[1, 5].text == "Odd." and by[None, 0].text == ""
    assert by[1, 5].formatted == "<|unknown|>\nOdd.\n<|end|>" and by[3, 0].text == ""
    order = sorted((r.thread, r.turn) for r in found if r.conv_id == 1 and r.turn is not None)
    assert [t for _, t in order] == [0, 2, 1, 3, 4, 5]
    assert chat.conversations(talk.limit(0)).count() == 0


def test_long_chains_of_quotations(spark):
    rows = [(1, 0, "user", "message 0")] + [
        (1, i, "user", f"> message {i - 1}\nmessage {i}") for i in range(1, 70)
    ]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.conversations(talk).collect()
    assert {(r.thread, r.depth) for r in found} == {(0, i) for i in range(70)}


def test_quotations_equal_sql(spark):
    """The given conversations hold no quotation, so the SQL is also run on these."""
    rows = TALK + [(4, i, "user", f"> message {i - 1}\nmessage {i}") for i in range(9)]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    db = duckdb.connect()
    db.register("conversations", talk.toArrow())
    wanted = db.sql(ORACLES["op6_chat"]).to_arrow_table()
    made = chat.conversations(talk).toArrow().select(wanted.column_names)
    listed = lambda t: sorted(map(repr, t.to_pylist()))
    assert listed(made) == listed(wanted)
