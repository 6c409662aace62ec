"""Byte-level BPE by encoding each distinct word once, and decoding by the token-byte table.

Texts are cut into the matches of the pre-token pattern.  The texts of a block (some megabytes) share
a list of their distinct words and keep, by position, an index into it: so a word is shuffled once
per block, not once per occurrence.  All blocks' words meet in one shuffle by word, where each
distinct word is encoded once and its ids go back to every block that asked; there the texts are
put together again by position.  The words that a block sends to one task travel as one row.

The input must give the same rows in the same partitions when a task is run again, as a stored table
does: blocks are named by partition.

NULL is the empty text and has no ids.  Repeated rows are all kept.  An empty table gives an empty
one.  Other columns pass through; working columns take names that the input does not have.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.common import text_chunks

BLOCK_CHARS = 8 << 20
"""Characters of a block's texts; a longer text is a block by itself."""

BLOCK_WORDS = 150_000
"""Distinct words from which a block is closed."""

CACHE_WORDS = 1_000_000
"""Words whose ids a task remembers before it starts anew."""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def word_encoder(path: str) -> tiktoken.Encoding:
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={}
    )


def _fresh(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _packed(numbers: list[int] | np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Compressed numbers, all lowest bytes first, then the next; the first byte counts the bytes."""
    made = np.asarray(numbers, "<u4")
    width = 4 if len(made) and made.max() >= 1 << 16 else 2
    planes = made.view(np.uint8).reshape(-1, 4)[:, :width].T
    return bytes([width]) + packer.compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(raw: bytes, unpacker: zstandard.ZstdDecompressor) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(unpacker.decompress(raw[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1)


def _framed(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _parts(raw: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(raw):
        size = int.from_bytes(raw[at : at + 4], "little")
        yield raw[at + 4 : at + 4 + size]
        at += 4 + size


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Input rows without ``text``, with their ids in ``out`` (``array<int>``).

    ``path`` is the file of ranks, which every executor has.
    """
    kept = [f for f in df.schema.fields if f.name not in (text, out)]
    taken = [f.name for f in kept] + [text]
    block, place, part, key = (_fresh(n, taken) for n in ("_block", "_place", "_part", "_key"))
    extra = [
        T.StructField(block, T.LongType()),
        T.StructField(place, T.BinaryType()),
        T.StructField(part, T.IntegerType()),
    ]
    names = [f.name for f in kept]
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks: their rows with places in the word list, then the words for each task."""
        match = regex.compile(public_tokenizers.PATTERN).findall
        packer = zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32
        known: dict[str, int] = defaultdict()
        known.default_factory = known.__len__
        size = 0

        def listed() -> pa.RecordBatch:
            sent: list[list[bytes]] = [[] for _ in range(tasks)]
            places: list[list[int]] = [[] for _ in range(tasks)]
            for i, word in enumerate(known):
                raw = word.encode()
                to = zlib.crc32(raw) % tasks
                sent[to].append(raw)
                places[to].append(i)
            used = [i for i in range(tasks) if sent[i]]
            made = [
                _framed(
                    _packed(np.diff(places[i], prepend=0), packer),
                    _packed(list(map(len, sent[i])), packer),
                    packer.compress(b"".join(sent[i])),
                )
                for i in used
            ]
            return pa.RecordBatch.from_arrays(
                [
                    *(pa.nulls(len(used), f.type) for f in fields),
                    pa.array([number] * len(used), pa.int64()),
                    pa.array(made, pa.binary()),
                    pa.array(used, pa.int32()),
                ],
                [*names, block, place, part],
            )

        fields: list[pa.Field] = []
        for batch in batches:
            fields = [batch.schema.field(n) for n in names]
            begin, places = 0, []
            for i, t in enumerate(t for _, some in text_chunks([batch], text) for t in some):
                places.append(_packed(list(map(known.__getitem__, match(t))), packer))
                size += len(t)
                full = size >= BLOCK_CHARS or len(known) >= BLOCK_WORDS
                if full or i + 1 == batch.num_rows:
                    rows = batch.slice(begin, i + 1 - begin)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(rows.column(n) for n in names),
                            pa.array([number] * len(places), pa.int64()),
                            pa.array(places, pa.binary()),
                            pa.nulls(len(places), pa.int32()),
                        ],
                        [*names, block, place, part],
                    )
                    begin, places = i + 1, []
                if full and known:
                    yield listed()
                    known.clear()
                if full:
                    number, size = number + 1, 0
        if fields and known:
            yield listed()

    sent = df.select(text, *[F.col(f"`{n}`") for n in names]).mapInArrow(
        cut, T.StructType([*(T.StructField(f.name, f.dataType) for f in kept), *extra])
    )
    # One exchange for words, by the task of their hash, and for rows, by block.  It is used twice:
    # filters are left to the functions, since below the exchange they would make two of it.
    met = sent.withColumn(key, F.coalesce(F.col(part), F.xxhash64(block))).repartition(tasks, key)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All blocks' uses of a word come to one task, which encodes it when it first appears."""
        model, packer = word_encoder(path), zstandard.ZstdCompressor(level=1)
        unpacker = zstandard.ZstdDecompressor()
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            made, numbers = [], []
            for raw, number, is_word in zip(
                batch.column(place).to_pylist(),
                batch.column(block).to_pylist(),
                batch.column(part).is_valid().to_pylist(),
            ):
                if not is_word:
                    continue
                places, lengths, joined = _parts(raw)
                joined = unpacker.decompress(joined)
                ends = np.cumsum(_unpacked(lengths, unpacker), dtype=np.int64).tolist()
                ids = []
                for begin, end in zip([0, *ends], ends):
                    word = joined[begin:end]
                    found = known.get(word)
                    if found is None:
                        if len(known) >= CACHE_WORDS:
                            known.clear()
                        found = known[word] = model.encode_ordinary(word.decode())
                    ids.append(found)
                numbers.append(number)
                made.append(
                    _framed(
                        places,
                        _packed(list(map(len, ids)), packer),
                        _packed(list(chain.from_iterable(ids)), packer),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(made, pa.binary())], ["block", "answer"]
            )

    answered = (
        met.mapInArrow(encode_words, "block long, answer binary")
        .select(F.xxhash64("block").alias("key"), "block", "answer")
        .repartition(tasks, "key")
    )

    def join_ids(asked: pa.Table, answers: pa.Table) -> pa.Table:
        """The rows of a block with their ids; words that came along are left out."""
        unpacker = zstandard.ZstdDecompressor()
        rows = asked.filter(asked.column(part).is_null())
        table = _word_table(answers.column("answer").to_pylist(), unpacker)
        made = [
            _gathered(*table, _unpacked(raw, unpacker)) for raw in rows.column(place).to_pylist()
        ]
        offsets = np.cumsum([0, *map(len, made)])
        flat = np.concatenate([np.zeros(0, np.int32), *made])
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
        return pa.Table.from_arrays([*(rows.column(n) for n in names), ids], [*names, out])

    schema = T.StructType(
        [
            *(T.StructField(f.name, f.dataType) for f in kept),
            T.StructField(out, T.ArrayType(T.IntegerType())),
        ]
    )
    return met.groupBy(key).cogroup(answered.groupBy("key")).applyInArrow(join_ids, schema)


def _word_table(
    answers: list[bytes], unpacker: zstandard.ZstdDecompressor
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a block's words, and where each word's ids begin and how many they are."""
    if not answers:
        empty = np.zeros(0, np.int64)
        return empty.astype(np.int32), empty, empty
    unpacked = [[_unpacked(p, unpacker).astype(np.int64) for p in _parts(raw)] for raw in answers]
    places = np.concatenate([np.cumsum(a[0]) for a in unpacked])
    counts, ids = (np.concatenate([a[i] for a in unpacked]) for i in (1, 2))
    begins, lengths = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    begins[places], lengths[places] = np.cumsum(counts) - counts, counts
    return ids.astype(np.int32), begins, lengths


def _gathered(
    flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, wanted: np.ndarray
) -> np.ndarray:
    """The stretches of ``flat`` that ``wanted`` names, one after the other."""
    if not len(wanted):
        return flat[:0]
    size = lengths[wanted]
    shift = np.repeat(begins[wanted] - (np.cumsum(size) - size), size)
    return flat[shift + np.arange(len(shift))]


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Input rows with the bytes of their ids in ``out``; a column of that name is replaced.

    The token-byte table has as many rows as the vocabulary, so every task holds it and joins its
    ids by position.  A NULL list, or one with an id that the table lacks, gives NULL.
    """
    kept = [f for f in df.schema.fields if f.name != out]
    names = [f.name for f in kept]

    def join_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {rank: token for token, rank in read_ranks(path).items()}
        tokens = [table.get(i, b"") for i in range(max(table, default=-1) + 1)]
        known = np.array([i in table for i in range(len(tokens))] + [False])
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        begins = np.cumsum(lengths) - lengths
        for batch in batches:
            column, made = batch.column(ids), []
            for i in range(len(column)):
                if not column[i].is_valid:
                    made.append(None)
                    continue
                part = column[i].values.to_numpy(zero_copy_only=False)
                whole = not len(part) or (
                    part.min() >= 0
                    and part.max() < len(tokens)
                    and bool(known[part.astype(np.int64)].all())
                )
                made.append(_gathered(flat, begins, lengths, part).tobytes() if whole else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(made, pa.binary())], [*names, out]
            )

    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])
    return df.mapInArrow(join_bytes, schema)
