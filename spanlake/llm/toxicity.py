"""Toxicity by a weighted finite-state grammar over clauses.

A lexical step maps each word to a symbol: insult, threat, target, negation, reported speech, clause
end or other.  Small transducers read the symbols: one opens a window after a negation, one marks
what follows reported speech, one remembers a target, and one names the clause by its head.  They are
composed once into a single table, which is run over each clause.  A clause counts by its kind
(insult or threat; plain, aimed at someone, negated or reported) with the weights of its heads, so
an isolated word never decides: the score of a text is a logistic function of its matched clauses.

Insults and their stems are learned from labelled texts, as are the weights of the clause kinds.
The other lists are fixed.  NULL and empty texts match no clause and get the lowest score.  Equal
texts get equal scores; an empty table gives an empty one.  Without labels of both kinds the
grammar knows no insults, and only threats score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.common import bounded_sample, let, text_chunks, written

SAMPLE_ROWS = 12_000
"""Labelled rows, at most, that the grammar is fitted on."""

STEMS = (4, 5, 6, 7)
"""Lengths of word beginnings that may become insults."""

CACHE_WORDS = 400_000

# Function words and verbs of the four languages.
TARGETS = """you your you're u he she they them him her du dich dir ihr euch dein deine sie tu te
toi vous ton ta votre tú ti vosotros usted ustedes vuestro""".split()
NEGATIONS = """not no never isn't aren't don't nicht kein keine nie niemals pas jamais aucun non
nunca jamás ningún""".split()
REPORTS = """said says say claims claimed wrote called quoted sagte sagt schrieb nannte behauptet
dit disait écrit appelle prétend dijo dice escribió llamó afirma""".split()
THREATS = """kill hurt destroy shoot stab strangle murder töten umbringen erschießen verprügeln
tuer frapper abattre étrangler matar golpear disparar degollar""".split()

OTHER, TARGET, NEGATION, REPORT, END, INSULT, THREAT = range(7)
MODES = ("plain", "aimed", "negated", "reported")
KINDS = [f"{head}_{mode}" for head in ("insult", "threat") for mode in MODES]
PRIOR = np.array([1.0, 1.2, 0.6, 0.7, 0.4, 1.0, 0.2, 0.3])
"""Weights of the kinds before any label is seen; :func:`fit_weights` starts from them."""

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[.!?;\n]")
BREAKS = frozenset(".!?;\n")

Step = Callable[[int, int], tuple[int, int]]


def negation(state: int, symbol: int) -> tuple[int, int]:
    """State: words left of the window after a negation.  Output 1 inside the window."""
    if symbol == END:
        return 0, 0
    return (3 if symbol == NEGATION else max(state - 1, 0)), int(state > 0)


def reporting(state: int, symbol: int) -> tuple[int, int]:
    """State 1 from reported speech to the end of its clause; the output is the state."""
    return (0 if symbol == END else int(state or symbol == REPORT)), state


def aiming(state: int, symbol: int) -> tuple[int, int]:
    """State 1 once the clause has named a target; the output is the new state."""
    state = 0 if symbol == END else int(state or symbol == TARGET)
    return state, state


def heading(state: int, symbol: int) -> tuple[int, int]:
    """Output 1 for an insult and 2 for a threat, else 0."""
    return 0, {INSULT: 1, THREAT: 2}.get(symbol, 0)


@dataclass
class Machine:
    """Table of a composed transducer: ``move[state][symbol] = (state, outputs)``."""

    move: list[list[tuple[int, tuple[int, ...]]]]


def compose(*steps: Step) -> Machine:
    """The transducers side by side: a state per reachable tuple of their states."""
    start = (0,) * len(steps)
    number, move, todo = {start: 0}, [], [start]
    while todo:
        states = todo.pop(0)
        row = []
        for symbol in range(THREAT + 1):
            made = [step(s, symbol) for step, s in zip(steps, states)]
            after = tuple(m[0] for m in made)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append((number[after], tuple(m[1] for m in made)))
        move.append(row)
    return Machine(move)


GRAMMAR = (negation, reporting, aiming, heading)


@dataclass
class Lexicon:
    """Weights of insults: whole words, and beginnings that stand for all their words."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)

    def symbol(self, word: str) -> tuple[int, float]:
        if word in BREAKS:
            return END, 0.0
        weight = self.words.get(word)
        if weight is None:
            weight = max((self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n), default=0)
        if weight:
            return INSULT, weight
        for symbol, known in FIXED.items():
            if word in known:
                return symbol, 1.0
        return OTHER, 0.0


FIXED = {
    TARGET: frozenset(TARGETS),
    NEGATION: frozenset(NEGATIONS),
    REPORT: frozenset(REPORTS),
    THREAT: frozenset(THREATS),
}


class Matcher:
    """Weights of the matched clauses of a text, by kind."""

    def __init__(self, lexicon: Lexicon, cache: int = CACHE_WORDS):
        self.lexicon, self.most = lexicon, cache
        self.machine = compose(*GRAMMAR)
        self.symbols: dict[str, int] = {}
        self.weights: dict[str, float] = {}

    def __call__(self, text: str) -> np.ndarray:
        found = np.zeros(len(KINDS))
        tokens = TOKEN.findall(text.lower())
        symbols = list(map(self.symbols.get, tokens))
        if None in symbols:
            symbols = [self._learn(t) if s is None else s for t, s in zip(tokens, symbols)]
        if not symbols or max(symbols) < INSULT:
            return found
        state, move = 0, self.machine.move
        heads: list[tuple[int, int, int, float]] = []
        aimed = 0
        for token, symbol in zip([*tokens, "."], [*symbols, END]):
            if symbol == END:
                for head, negated, reported, weight in heads:
                    mode = 3 if reported else 2 if negated else aimed
                    found[(head - 1) * len(MODES) + mode] += weight
                heads, aimed = [], 0
            state, (negated, reported, target, head) = move[state][symbol]
            aimed = target
            if head:
                heads.append((head, negated, reported, self.weights[token]))
        return np.log1p(found)

    def _learn(self, token: str) -> int:
        if len(self.symbols) >= self.most:
            # Heads of the text at hand must stay known.
            kept = {t: s for t, s in self.symbols.items() if s >= INSULT}
            self.symbols.clear()
            self.symbols.update(kept)
        symbol, weight = self.lexicon.symbol(token)
        self.symbols[token] = symbol
        if symbol >= INSULT:
            self.weights[token] = weight
        return symbol


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        return 1 / (1 + math.exp(-min(max(self.bias + float(found @ self.weights), -30), 30)))


def learn_lexicon(rows: DataFrame, text: str, label: str) -> Lexicon:
    """Words and beginnings that labelled texts use far more often when toxic.

    An entry must be as rare by chance as one in twenty among all entries that toxic texts use.  A
    beginning must be so without its most frequent word: a single word stands for itself only.  Near
    copies of a text count once: texts are told apart by the smallest hash of their word triples.
    """
    words = F.filter(F.split(F.lower(text), r"[^\p{L}']+"), lambda w: F.length(w) > 2)

    def triple(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - 2, F.lit(1)))
        return F.array_min(F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, 3))))

    def entries(w: Column) -> Column:
        made = [
            F.transform(
                w, lambda x: F.struct(x.alias("entry"), F.lit(0).alias("stem"), x.alias("word"))
            )
        ]
        for n in STEMS:
            size = F.lit(n)
            longer = F.filter(w, lambda x: F.length(x) > size)
            made.append(
                F.transform(
                    longer,
                    lambda x: F.struct(
                        F.left(x, size).alias("entry"), F.lit(1).alias("stem"), x.alias("word")
                    ),
                )
            )
        return F.flatten(F.array(*made))

    # Words are bound in a lambda: as a column they would be split anew for every use.
    made = let(
        F.array_distinct(words),
        lambda w: F.struct(entries(w).alias("entries"), triple(w).alias("near")),
    )
    texts = rows.select(made.alias("_made"), F.col(label).alias("_toxic"))
    counted = written(
        texts.select(F.explode("_made.entries").alias("e"), "_made.near", "_toxic")
        .select("e.*", "near", "_toxic")
        .distinct()
        .groupBy("entry", "stem", "word")
        .agg(
            F.count_if(F.col("_toxic") == 1).alias("bad"),
            F.count_if(F.col("_toxic") == 0).alias("good"),
        )
        .groupBy("entry", "stem")
        .agg(
            F.expr("sum(bad) - IF(stem = 1, max(bad), 0)").alias("bad"),
            F.sum("good").alias("good"),
        )
        .where("bad > 0"),
        "entries",
    )
    totals = rows.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    bad_texts, good_texts = totals[0], totals[1]
    if not bad_texts or not good_texts:
        return Lexicon()
    base = bad_texts / (bad_texts + good_texts)
    share = F.col("bad") / (F.col("bad") + F.col("good"))
    gain = (F.col("bad") + F.col("good")) * (
        F.when(share > 0, share * F.log(share / base)).otherwise(0.0)
        + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    )
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)) - math.log(bad_texts / good_texts)
    tried = max(counted.count(), 1)
    strong = counted.where((share > 0.5) & (gain > math.log(20 * tried))).select(
        "entry", "stem", F.least(odds, F.lit(6.0)).alias("weight")
    )
    lexicon = Lexicon()
    for entry, stem, weight in strong.toLocalIterator():
        (lexicon.stems if stem else lexicon.words)[entry] = weight
    return lexicon


def fit_weights(found: np.ndarray, toxic: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Logistic regression held near :data:`PRIOR`, so a kind that labels never show keeps it."""
    x = np.hstack([found, np.ones((len(found), 1))])
    start = np.append(PRIOR, -3.0)
    pull = np.append(np.full(len(PRIOR), 1.0), 0.01)
    w = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - toxic) + pull * (w - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return np.maximum(w[:-1], 0.0), float(w[-1])


def held_out(doc_id: str | Column) -> Column:
    """Rows that no model is fitted on: a fifth of the ids, by their checksum."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
) -> Model:
    """Grammar fitted on at most ``rows`` labelled texts that are not held out."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~held_out(doc_id))
    known = known.groupBy(doc_id).agg(F.max(label).cast("int").alias("_label"))
    sample = F.broadcast(bounded_sample(known, rows, doc_id))
    texts = docs.select(doc_id, F.coalesce(text, F.lit("")).alias("_text")).join(sample, doc_id)
    # The exact cut of a sample ends in one task; from there it is dealt out anew.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = written(
        bounded_sample(texts.select("_text", "_label"), rows, "_text").repartition(tasks),
        "labelled",
    )
    lexicon = learn_lexicon(texts, "_text", "_label")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch, chunk in text_chunks(batches, "_text"):
            found = [matcher(t).tolist() for t in chunk]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.float64())), batch.column("_label")], ["x", "y"]
            )

    table = texts.mapInArrow(match, "x array<double>, y int").toArrow()
    if table.num_rows == 0:
        return Model(lexicon, PRIOR, -3.0)
    x = np.array(table.column("x").to_pylist(), float)
    y = np.array(table.column("y").to_pylist(), float)
    return Model(lexicon, *fit_weights(x, y))


def scores(
    df: DataFrame, model: Model, text: str = "text", out: str = "score"
) -> DataFrame:
    """Input rows with their score in ``out``; a column of that name is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value.lexicon)
        for batch, chunk in text_chunks(batches, text):
            made = pa.array([shared.value.score(matcher(t)) for t in chunk], pa.float64())
            columns = [c for c in batch.schema.names if c != out]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), made], [*columns, out]
            )

    fields = [f for f in df.schema.fields if f.name != out]
    return df.mapInArrow(score, T.StructType([*fields, T.StructField(out, T.DoubleType())]))


def keep_civil(
    df: DataFrame, model: Model, text: str = "text", limit: float = 0.5
) -> DataFrame:
    """Rows that score below ``limit``, with their columns as they are."""
    out = "_score"
    while out in df.columns:
        out += "_"
    return scores(df, model, text, out).where(F.col(out) < limit).drop(out)
