"""Token ids in binary shard files, each document compressed with a shared dictionary.

A zstandard dictionary is trained on serialised id arrays of sampled short documents.  Every shard
keeps its hash, one compressed frame per document and an index of offsets, so a short document is
read without its neighbours.  Documents lie in ascending order over the shards.

Shard: magic, dictionary hash (32 bytes), frames, index (one entry per document), footer (index
offset, documents, magic).  Ids are little-endian unsigned 32-bit integers.

A NULL text is the empty text: only the end id is stored.  NULL ids come last.  Repeated rows are
all kept, next to each other.  An empty table gives no shard and no row.  Columns other than id and
text are not stored.
"""

from __future__ import annotations

import hashlib
import re
import string
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm.common import bounded_sample, store, text_chunks, written
from spanlake.session import scratch_path

MAGIC = b"SPLKIDS1"
ENTRY = "<qBQII"  # id, id is NULL, offset of the frame, its length, tokens
FOOTER = "<QQ8s"

DICTIONARY_BYTES = 112_640
SAMPLE_ROWS = 1_000
SAMPLE_CHARS = 8_000
"""The dictionary is trained on at most this many documents, none longer than this."""

CACHE_WORDS = 1_000_000
"""Stretches that a worker remembers, half of them in each of two tables."""

CHUNK_CHARS = 1 << 20
"""Characters of the texts that are encoded at once."""

BATCH_WORDS = 1_000
"""New words that the library gets at once; more take longer each."""

FIRST = "\x00"
"""Marks the beginning of a text; texts that contain it are encoded whole."""

LEVEL = 3


BREAK = re.compile(r"(?<=[!-~])\n(?=[!-~])")
SIGNS = ".,;:!?"
LETTERS = frozenset(string.ascii_letters + string.digits)


def pieces(part: str) -> list[str]:
    """The stretch cut where a byte-level pre-tokeniser always cuts it, pieces without a space marked as beginnings.

    That is at a single line break between visible ASCII characters, and between an ASCII letter or digit
    and the signs that end a line.
    """
    made = []
    for line in BREAK.split(part) if "\n" in part else [part]:
        if made:
            made.append(FIRST + "\n")
            line = FIRST + line
        word = line.rstrip(SIGNS)
        if len(word) < len(line) and word and word[-1] in LETTERS:
            made += [word, FIRST + line[len(word) :]]
        else:
            made.append(line)
    return made


class Encoder:
    """Ids of whole texts by the library, remembering the stretches between spaces.

    The pre-tokeniser always starts a token at a space that follows other text, so a text is the
    sequence of its stretches; those not seen yet are encoded together.  Texts with double or
    closing spaces or special strings are encoded whole.  A stretch with punctuation at its end or a line
    break is put together from its pieces, so the library gets a word once and not with each sign after it.

    Stretches are remembered in two tables.  When the younger one is full it becomes the older one, whose
    stretches move over when they are met again; so frequent ones stay known.
    """

    known: dict[str, Encoder] = {}

    def __init__(self, path: str, cache: int = CACHE_WORDS):
        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        tokens = self.model.get_vocab()
        self.leads = np.zeros(max(tokens.values()) + 1, bool)
        self.leads[[i for t, i in tokens.items() if t.startswith("Ġ")]] = True
        cut = self.model.pre_tokenizer and self.model.pre_tokenizer.pre_tokenize_str("a.\nb c")
        self.pieces = [t for t, _ in cut or ()] == ["a", ".", "Ċ", "b", "Ġc"]
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most = cache

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder, with what it has seen in earlier tasks."""
        if path not in cls.known:
            cls.known[path] = cls(path)
        return cls.known[path]

    def whole(self, texts: list[str]) -> list[bytes]:
        made = self.model.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def separable(self, text: str) -> bool:
        return (
            "  " not in text
            and FIRST not in text
            and not text.startswith(" ")
            and not text.endswith(" ")
            and not any(s in text for s in self.special)
        )

    def _learn(self, parts: list[str]) -> None:
        """Enter stretches that neither table has: from the library, or from their pieces if they have any."""
        cache, old, new = self.cache, self.old, {}
        cut, counts, flat = [], [], []  # no list for each stretch, which the garbage collector would visit
        for part in parts:
            own = pieces(part) if self.pieces else [part]
            if len(own) == 1:
                new[part] = None
                continue
            cut.append(part)
            counts.append(len(own))
            flat += own
            for piece in own:
                if piece not in cache:
                    ids = old.pop(piece, None)
                    if ids is None:
                        new[piece] = None
                    else:
                        cache[piece] = ids
        self._encode([part for part in new if part not in cache])
        at = 0
        for part, count in zip(cut, counts):
            cache[part] = b"".join(map(cache.__getitem__, flat[at : at + count]))
            at += count

    def _encode(self, parts: list[str]) -> None:
        """Encode stretches; those of text beginnings are marked and have no space before them."""
        first = [p for p in parts if p.startswith(FIRST)]
        rest = [p for p in parts if not p.startswith(FIRST)]
        self.cache.update(zip(first, self.whole([p[1:] for p in first])))
        for k in range(0, len(rest), BATCH_WORDS):
            some = rest[k : k + BATCH_WORDS]
            ids = np.array(self.whole_ids(" " + " ".join(some)), "<u4")
            begins = (np.flatnonzero(self.leads[ids]) * 4).tolist()
            raw = ids.tobytes()
            for part, i, j in zip(some, begins, [*begins[1:], len(raw)], strict=True):
                self.cache[part] = raw[i:j]

    def whole_ids(self, text: str) -> list[int]:
        return self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts; stretches that are not known are looked up together."""
        made: list[bytes] = [b""] * len(texts)
        apart, others = [], []
        for i, text in enumerate(texts):
            if text:
                (apart if self.separable(text) else others).append(i)
        for i, ids in zip(others, self.whole([texts[i] for i in others])):
            made[i] = ids
        if len(self.cache) > self.most // 2:
            self.cache, self.old = {}, self.cache
        cache, waiting, missing = self.cache, [], {}
        for i in apart:
            parts = (FIRST + texts[i]).split(" ")
            found = list(map(cache.get, parts))
            gaps = [k for k, ids in enumerate(found) if ids is None]
            if gaps:
                waiting.append((i, parts, found, gaps))
                for k in gaps:
                    missing[parts[k]] = None
            else:
                made[i] = b"".join(found)
        unknown = []
        for part in missing:
            ids = self.old.pop(part, None)
            if ids is None:
                unknown.append(part)
            else:
                cache[part] = ids
        if unknown:
            self._learn(unknown)
        for i, parts, found, gaps in waiting:
            for k in gaps:
                found[k] = cache[parts[k]]
            made[i] = b"".join(found)
        return made


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """Dictionary of the samples; their plain contents where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _compression(dictionary: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def sample_dictionary(df: DataFrame, path: str, text: str, end_id: int) -> bytes:
    short = df.select(text).where(F.length(text) <= SAMPLE_CHARS)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(path), struct.pack("<I", end_id)
        for _, texts in text_chunks(batches, text):
            yield pa.RecordBatch.from_pydict({"ids": [i + end for i in encoder(texts)]})

    rows = bounded_sample(short, SAMPLE_ROWS, text).mapInArrow(encode, "ids binary").toArrow()
    return train_dictionary(sorted(rows.column("ids").to_pylist()))


def write_token_files(
    df: DataFrame,
    path: str,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
) -> DataFrame:
    """Write the shards and return their manifest, one row per shard.

    ``path`` is the tokeniser's file, which every executor has; ``folder`` is shared.  A task that
    runs again writes a file of a new name; only files of finished tasks enter the manifest.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    spark, dictionary = df.sparkSession, sample_dictionary(rows, path, "text", end_id)
    digest = hashlib.sha256(dictionary).digest()
    files, root = store(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{digest.hex()}.zdict") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(path), struct.pack("<I", end_id)
        packer = zstandard.ZstdCompressor(level=LEVEL, **_compression(shared.value))
        out, index, offset, tokens = None, bytearray(), 0, 0
        for batch, texts in text_chunks(batches, "text", CHUNK_CHARS):
            if out is None:
                fs_, root_ = store(folder)
                name = f"{uuid.uuid4().hex}.ids"
                out = fs_.open_output_stream(f"{root_}/{name}")
                offset = out.write(MAGIC + digest)
            for key, ids in zip(batch.column("id").to_pylist(), encoder(texts)):
                frame = packer.compress(ids + end)
                count = len(ids) // 4 + 1
                index += struct.pack(ENTRY, key or 0, key is None, offset, len(frame), count)
                out.write(frame)
                offset += len(frame)
                tokens += count
        if out is None:
            return
        count = len(index) // struct.calcsize(ENTRY)
        out.write(bytes(index))
        out.write(struct.pack(FOOTER, offset, count, MAGIC))
        out.close()
        shard = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {"shard": [shard], "file": [name], "documents": [count], "tokens": [tokens]}
        )

    order = [F.col("id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    shards = (
        rows.repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
        .mapInArrow(write, "shard long, file string, documents long, tokens long")
    )
    # One file: each that an executor creates on a local disk starts other processes to set its mode.
    manifest = written(shards.repartition(1), "manifest")
    # One row per shard, so a window over all of them is small.
    return manifest.selectExpr(
        "*",
        "coalesce(sum(tokens) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING"
        " AND 1 PRECEDING), 0) AS start",
    )


class Shard:
    """An open shard; frames are read one by one."""

    def __init__(self, files, path: str):
        self.file, size = files.open_input_file(path), files.get_file_info(path).size
        end = struct.calcsize(FOOTER)
        offset, count, magic = struct.unpack(FOOTER, self.file.read_at(end, size - end))
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        digest = self.file.read_at(32, len(MAGIC))
        with files.open_input_stream(f"{path.rpartition('/')[0]}/{digest.hex()}.zdict") as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"the dictionary of {path} has another hash")
        index = self.file.read_at(count * struct.calcsize(ENTRY), offset)
        self.entries = list(struct.iter_unpack(ENTRY, index))
        self.unpacker = zstandard.ZstdDecompressor(**_compression(dictionary))

    def __getitem__(self, i: int) -> bytes:
        _, _, offset, length, tokens = self.entries[i]
        return self.unpacker.decompress(self.file.read_at(length, offset), tokens * 4)


def read_document(folder: str, file: str, i: int) -> np.ndarray:
    """Ids of one document of a shard, without the other frames."""
    files, root = store(folder)
    return np.frombuffer(Shard(files, f"{root}/{file}")[i], "<u4")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Documents of the shards: ``id``, ``start``, ``n_tokens`` and ``ids`` (bytes)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                shard, start = Shard(files, f"{root}/{row['file']}"), row["start"]
                rows: list[tuple] = []
                size = 0
                for i, (key, is_null, _, _, tokens) in enumerate(shard.entries):
                    rows.append((None if is_null else key, start, tokens, shard[i]))
                    start, size = start + tokens, size + tokens
                    if size > 1 << 19 or i + 1 == len(shard.entries):
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(c, t)
                                for c, t in zip(
                                    zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                                )
                            ],
                            ["id", "start", "n_tokens", "ids"],
                        )
                        rows, size = [], 0

    shards = max(manifest.count(), 1)
    return manifest.repartitionByRange(shards, "shard").mapInArrow(
        read, "id long, start long, n_tokens long, ids binary"
    )


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
