"""Token counts of whole texts by a two-tier lookup on the map side.

A sentencepiece model without pieces that reach across a space encodes the stretches between
spaces on their own.  So the count of a text is the sum over its words.  Lengths of frequent words
come from a table that is fitted on a bounded sample and sent to the workers; the other words are
encoded by the library, each once per worker as long as its cache holds it.  Nothing is shuffled.

NULL counts as the empty text, which has no tokens.  Each row is counted by itself: repeated rows
get equal counts, an empty table gives an empty one, and columns of any other name stay as they
are.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.common import bounded_sample, text_chunks

SAMPLE_ROWS = 4_000
"""Texts on which the table of frequent words is fitted."""

TABLE_WORDS = 200_000
"""Words of the broadcast table at most, a few megabytes."""

CACHE_WORDS = 400_000
"""Words that a worker's cache holds before it starts anew."""

SPACE = "▁"
_RUNS = re.compile(r" *[^ ]+| +$")


def separable(model: sentencepiece.SentencePieceProcessor) -> bool:
    """No piece goes on after a space, and text is taken as it is but for a leading space."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return all(SPACE not in p.lstrip(SPACE) for p in pieces) and (
        model.encode(" a  b ", out_type=str)[0].startswith(SPACE)
        and model.decode(model.encode("a  ÅＡ b ")) == "a  ÅＡ b "
    )


class Counts:
    """Counts per text; ``table`` maps frequent words to their lengths."""

    def __init__(self, path: str, table: dict[str, int], cache: int = CACHE_WORDS):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.separable = separable(self.model)
        self.table, self.cache, self.most = table, {}, cache
        self.trailing = len(self.model.encode("a"))

    def of_run(self, run: str) -> int:
        """Tokens of spaces and a word, the first space left out: the library puts it in front."""
        if run and not run.strip(" "):
            return len(self.model.encode("a " + run)) - self.trailing
        return len(self.model.encode(run)) if run else len(self.model.encode("a ")) - self.trailing

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if not self.separable or SPACE in text:
            return len(self.model.encode(text))
        if "  " in text or text[0] == " " or text[-1] == " ":
            runs = [r[1:] for r in _RUNS.findall(" " + text)]
        else:
            runs = text.split(" ")
        lengths = list(map(self.table.get, runs))
        if None in lengths:
            cache = self.cache
            for i, n in enumerate(lengths):
                if n is None:
                    run = runs[i]
                    n = cache.get(run)
                    if n is None:
                        if len(cache) >= self.most:
                            cache.clear()
                        n = cache[run] = self.of_run(run)
                    lengths[i] = n
        return sum(lengths)


def frequent_words(
    df: DataFrame, path: str, text: str = "text", rows: int = SAMPLE_ROWS, most: int = TABLE_WORDS
) -> dict[str, int]:
    """Token lengths of the words that occur twice or more in a sample, at most ``most``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_chunks(batches, text):
            found: Counter[str] = Counter()
            for t in texts:
                found.update(t.split(" "))
            found.pop("", None)
            yield pa.RecordBatch.from_pydict(
                {"word": list(found), "n": pa.array(found.values(), pa.int64())}, names
            )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path, {})
        for batch in batches:
            words = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {"word": words, "n": [counts.of_run(w) for w in words]}, names
            )

    names = pa.schema([("word", pa.string()), ("n", pa.int64())])
    ddl = "word string, n long"
    top = (
        bounded_sample(df.select(text), rows, text)
        .repartition(df.sparkSession.sparkContext.defaultParallelism)
        .mapInArrow(count, ddl)
        .where(~F.col("word").contains(SPACE))
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
        .orderBy(F.col("n").desc(), "word")
        .limit(most)
    )
    lengths = top.mapInArrow(encode, ddl).toArrow()
    return dict(zip(lengths.column("word").to_pylist(), lengths.column("n").to_pylist()))


def token_counts(
    df: DataFrame, path: str, text: str = "text", out: str = "n_tokens", **sample: int
) -> DataFrame:
    """Input rows with their token counts in ``out``; a column of that name is replaced.

    ``path`` is the model's file, which every executor has.
    """
    spark = df.sparkSession
    table = spark.sparkContext.broadcast(frequent_words(df, path, text, **sample))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(path, table.value)
        for batch, texts in text_chunks(batches, text):
            n = pa.array([counts(t) for t in texts], pa.int64())
            columns = [c for c in batch.schema.names if c != out]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), n], [*columns, out]
            )

    fields = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*fields, T.StructField(out, T.LongType())])
    return df.mapInArrow(count, schema)
