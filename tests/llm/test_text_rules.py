"""Quality rules, url rules and toxicity on small rows, against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from spanlake.llm import quality_rules as qr
from spanlake.llm import toxicity as tox
from spanlake.llm import url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = "one two three four five six seven eight nine ten"
TEXTS = [
    None,
    "",
    " \n\t",
    "short text",
    f"{PASSAGE} and {PASSAGE}",
    f"{PASSAGE} {PASSAGE} {PASSAGE}",
    "same line\nother line\nsame line\n\n\nsame line",
    "##** symbols $$ %% " * 10,
    "LOUD WORDS EVERYWHERE " * 10,
    "a a a b b b c c c d d d " * 3,
    "non\u00a0breaking\x1fspace are words \U0001f600 é",
    " ".join(f"w{i}" for i in range(30_000)),
    "tie " * 5_000,
]


def repeated(words):
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for starts in seen.values():
        if len(starts) > 1:
            for s in starts:
                covered.update(range(s, s + 8))
    return len(covered)


def test_counts_equal_plain_python(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    text = F.col("text")
    found = rows.select(
        "i",
        F.size(qr.words(text)),
        qr.repeated_positions(qr.words(text)),
        qr.word_chars(text),
        qr.symbols(text),
        qr.repeated_lines(text),
    ).collect()
    for i, *got in map(tuple, found):
        t = TEXTS[i] or ""
        words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
        assert got == [
            len(words),
            repeated(words),
            sum(map(len, words)),
            sum(t.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)),
        ]


def test_cascade_order_does_not_change_the_verdict(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)) * 2, "rejected_by int, text string")
    rules = qr.default_rules(F.col("text"))
    kept = {tuple(sorted(r.rejected_by for r in rows.where(qr.rejected_by(o).isNull()).collect()))
            for o in (rules, rules[::-1], [m[0] for m in qr.ordered_by_yield(rows, rules)])}
    assert kept == {tuple(sorted([11, 11]))}
    assert qr.keep_good(rows.limit(0)).count() == 0
    assert qr.keep_good(rows).columns == rows.columns


RULES = [
    ("org", "/", "allow"),
    ("Example.ORG", "/es/", "block"),
    ("example.org", "/es/", "allow"),
    ("example.org", "/en/1", "block"),
    ("example.org", "/es/deep", "allow"),
    ("a.example.org", None, "block"),
    (None, "/", "block"),
    ("com", "/", "maybe"),
]
URLS = [
    None,
    "",
    "no scheme/es/",
    "http://example.org/es/1",
    "HTTP://M.EXAMPLE.org/es/deep/x?q",
    "http://badexample.org/es/1",
    "http://a.example.org",
    "http://x.a.example.org/es/deeper",
    "http://example.org?es",
    "http://example.org/en/12#f",
    "http://example.org:80/es/",
    "http://x.com/fr/",
    "x://y://example.org/",
    "http://..org/",
    "http://example.org/" + "long/" * 5_000,
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for h, p, v in RULES:
        if not h or v not in ("allow", "block"):
            continue
        h, p = h.lower(), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            key = (len(h + p), len(h), v == "block", h + p, v)
            best = max(best, key) if best else key
    return host, path, best and best[3], best[4] if best else "allow"


def test_url_verdicts_equal_a_scan_of_all_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] * 2
    urls = spark.createDataFrame(rows, "_part int, url string, host string").repartition(4)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = url_rules.judge(urls, rules).collect()
    assert sorted(r._part for r in found) == sorted(r[0] for r in rows)
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == judged(URLS[r._part])
    assert url_rules.judge(urls.limit(0), rules).count() == 0
    assert {r.verdict for r in url_rules.judge(urls, rules.limit(0)).collect()} == {"allow"}


def test_grammar_composes_the_steps():
    lexicon = tox.Lexicon({"idiot": 2.0}, {"scum": 1.0})
    match = tox.Matcher(lexicon)
    kinds = lambda t: {k for k, v in zip(tox.KINDS, match(t)) if v}
    assert kinds("an idiot") == {"insult_plain"}
    assert kinds("you idiot") == kinds("idiot, you") == {"insult_aimed"}
    assert kinds("you are not an idiot") == {"insult_negated"}
    assert kinds("he said you idiot") == {"insult_reported"}
    assert kinds("he said so. Idiot") == {"insult_plain"}
    assert kinds("I will kill you") == {"threat_aimed"}
    assert kinds("scumbag") == {"insult_plain"} and kinds("nothing here") == kinds("") == set()
    assert len(tox.compose(*tox.GRAMMAR).move) == 16


@pytest.fixture(scope="module")
def labelled(spark):
    draw, rows = random.Random(3), []
    for i in range(600):
        bad = i % 4 == 0
        text = " ".join("".join(draw.choices("aeiounst", k=4)) for _ in range(30))
        if bad:
            text += " you grolk" + draw.choice("abcdefg") + ". Another grolk."
        rows.append((i, text, int(bad), "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int, score string")


def test_held_out_accuracy(spark, labelled):
    model = tox.fit(labelled.drop("toxic"), labelled.select("doc_id", "toxic"))
    found = tox.scores(labelled, model).where(tox.held_out("doc_id")).collect()
    right = sum((r.score >= 0.5) == bool(r.toxic) for r in found)
    assert len(found) > 50 and right / len(found) > 0.95


def test_toxicity_of_odd_rows(spark, labelled):
    model = tox.fit(labelled.drop("toxic"), labelled.select("doc_id", "toxic"))
    odd = spark.createDataFrame(
        [(1, None), (None, ""), (1, None), (2, "you grolka " * 20_000)], "doc_id long, text string"
    )
    found = {r.text: r.score for r in tox.scores(odd, model).collect()}
    assert found[None] == found[""] < 0.5 < found["you grolka " * 20_000]
    assert tox.keep_civil(odd, model).count() == 3
    assert tox.scores(odd.limit(0), model).count() == 0
    none = tox.fit(odd, labelled.limit(0).select("doc_id", "toxic"))
    assert all(r.score < 0.5 for r in tox.scores(odd, none).collect())
