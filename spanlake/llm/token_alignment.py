"""Alignment of two tokenisations of the same text by token-byte incidence matrices.

Both tokenisers cut a text's bytes.  A matrix of tokens by bytes, in compressed sparse rows, has an entry
where a token covers a byte.  The product A·Bᵀ, made row by row (Gustavson), has an entry for each pair
of tokens that overlap: the number of bytes they share.  Pairs that also end together are the links; a
link closes a group, the least stretch that both tokenisers cut out.  Group-incidence matrices (group
by token) and their product give the pairs that share a group.

Between two words that one space parts, both tokenisers cut and no token reaches across, so a text is the
sequence of its units, and its matrices are blocks on a diagonal, one for each unit.  A worker aligns a
unit when it first meets it and remembers it, bounded by bytes.  Texts are dealt out in blocks of some
megabytes; a block lists its units and the distinct id pairs they link.  Pairs are counted by a shuffle
of these lists, and the counts go back to the blocks, where a matrix of units by pairs takes them
to the units and the texts.  Counts of pairs cover all texts; of one pair a block sends one row.

A text that is NULL or empty, or whose tokens' bytes are not a space and the text, has no tokens and
nothing but zeros.  Repeated rows are all kept, and count.  An empty table gives an empty one.
Columns of other names pass through; working columns take names that the input does not have.

The input must give the same rows in the same partitions when a task is run again, as a stored table
does: blocks are named by partition.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.common import text_lengths, written
from spanlake.llm.token_counts import SPACE, separable

BLOCK_CHARS = 4 << 20
"""Characters of a block's texts; a longer text is a block by itself."""

CACHE_BYTES = 96 << 20
"""Units and their alignments that a worker remembers, half of it in each of two tables."""

UNIT_BYTES = 230
"""What a unit takes besides its texts and pairs."""

LEARNT_UNITS = 5_000
"""Units that are aligned at once."""

SLICE_CHARS = 1 << 20
"""Characters of the texts that a task hands over at once."""

_CUT = re.compile(r"(?<=\S) (?=\S)")


class Csr(NamedTuple):
    """Compressed sparse rows: the entries of row ``i`` are ``begins[i]`` to ``begins[i + 1]``."""

    begins: np.ndarray
    columns: np.ndarray
    values: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """Row of every entry."""
        return np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))


def incidence(lengths: np.ndarray) -> Csr:
    """Rows that cover as many columns each, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(total), np.ones(total, np.int64))


def transposed(m: Csr, width: int) -> Csr:
    order = np.argsort(m.columns, kind="stable")
    begins = np.concatenate([[0], np.cumsum(np.bincount(m.columns, minlength=width))])
    return Csr(begins, m.rows[order], m.values[order])


def product(a: Csr, b: Csr) -> Csr:
    """Gustavson's row products: row ``i`` adds up the rows of ``b`` that the entries of row ``i`` name.

    Each entry of ``a`` brings a whole row of ``b``; entries of one place are added up.
    """
    sizes = np.diff(b.begins)[a.columns]
    owner = np.repeat(a.rows, sizes)
    shift = np.repeat(b.begins[a.columns] - (np.cumsum(sizes) - sizes), sizes)
    at = shift + np.arange(len(shift))
    columns, values = b.columns[at], np.repeat(a.values, sizes) * b.values[at]
    ahead = np.diff(owner) > 0
    if not (ahead | (np.diff(columns) >= 0)).all():
        order = np.lexsort((columns, owner))
        owner, columns, values = owner[order], columns[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (columns[1:] != columns[:-1])
    first = np.flatnonzero(new)
    values = np.add.reduceat(values, first) if len(first) else values
    count = np.bincount(owner[first], minlength=len(a.begins) - 1)
    return Csr(np.concatenate([[0], np.cumsum(count)]), columns[first], values)


def times(m: Csr, vector: np.ndarray) -> np.ndarray:
    """Matrix by vector."""
    total = np.concatenate([[0], np.cumsum(m.values * vector[m.columns])])
    return total[m.begins[1:]] - total[m.begins[:-1]]


class Alignment(NamedTuple):
    """Two tokenisations of the same bytes."""

    overlaps: Csr
    """Tokens of A by tokens of B: the bytes they share."""
    links: np.ndarray
    """Pairs of tokens that end together, two columns of places."""
    groups_a: Csr
    """Groups by tokens of A."""
    groups_b: Csr


def aligned(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Alignment:
    """Alignment of tokens of so many bytes each; both cover the same bytes, no token is empty."""
    a, b = incidence(a_lengths), incidence(b_lengths)
    overlaps = product(a, transposed(b, len(a.columns)))
    left, right = overlaps.rows, overlaps.columns
    together = a.begins[left + 1] == b.begins[right + 1]
    links = np.stack([left[together], right[together]], axis=1)
    group_ends = [np.diff(links[:, i], prepend=-1) for i in (0, 1)]
    return Alignment(overlaps, links, *(incidence(n) for n in group_ends))


def shared_groups(found: Alignment) -> Csr:
    """Tokens of A by tokens of B: 1 where both lie in one group."""
    width = len(found.groups_a.columns)
    return product(transposed(found.groups_a, width), found.groups_b)


def _byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Known:
    """Units that were aligned, by place."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.size = 0
        self.bad: set[int] = set()
        self.groups: list[str] = []
        self.n_a, self.n_b, self.begins = array("q"), array("q"), array("q", [0])
        self.pairs = array("q")

    def add(self, unit: str, groups: str, n_a: int, n_b: int) -> None:
        """One more unit, whose pairs have been put behind the others."""
        self.place[unit] = len(self.place)
        self.groups.append(groups)
        self.n_a.append(n_a)
        self.n_b.append(n_b)
        self.begins.append(len(self.pairs))
        self.size += len(unit) + len(groups) + 8 * (self.begins[-1] - self.begins[-2]) + UNIT_BYTES

    def take(self, unit: str, other: Known) -> None:
        """The unit as another table knows it."""
        i = other.place[unit]
        self.pairs.extend(other.pairs[other.begins[i] : other.begins[i + 1]])
        if i in other.bad:
            self.bad.add(len(self.place))
        self.add(unit, other.groups[i], other.n_a[i], other.n_b[i])


class Pair:
    """Both tokenisers, and what a worker has aligned so far.

    Units are remembered in two tables.  When the younger one is full it becomes the older one, whose units
    move over when they are met again; so frequent units stay known.
    """

    known: dict[tuple[str, str], Pair] = {}

    def __init__(self, a_path: str, b_path: str):
        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in alphabet for c in token):
                self.a_bytes[i] = bytes(alphabet[c] for c in token)
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.a_length, self.b_length = (
            np.array([len(x) for x in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes)
        )
        # An id as it is shown within and at the end of a group's part.
        self.a_shown, self.b_shown = (
            np.array([[f"{i},", f"{i}{end}"] for i in range(len(tokens))], object)
            for tokens, end in ((self.a_bytes, "|"), (self.b_bytes, ";"))
        )
        # A piece across a space, or one that the other tokeniser joins to it, forbids cutting.
        self.cuts = separable(self.b) and self.a_cuts()
        self.young, self.old = Known(), Known()

    def a_cuts(self) -> bool:
        """A space between two words starts a token, whatever surrounds it."""
        probes = ["a b", "a's b", "1 2", ". .", "é 中", "a\nb c", "中 é", "x¹ y", "_ _", "'s 's"]
        return all(
            [i for p in _CUT.split(t) for i in self._encode_a([p])[0]] == self._encode_a([t])[0]
            for t in probes
        )

    @classmethod
    def of(cls, a_path: str, b_path: str) -> Pair:
        key = (a_path, b_path)
        if key not in cls.known:
            cls.known[key] = cls(a_path, b_path)
        return cls.known[key]

    def turn(self) -> None:
        """Make room if there is none; places found before are no longer valid then."""
        if self.young.size > CACHE_BYTES // 2:
            self.young, self.old = Known(), self.young

    def units(self, text: str) -> list[str]:
        return _CUT.split(text) if self.cuts else [text]

    def _encode_a(self, units: list[str]) -> list[list[int]]:
        made = self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)
        return [e.ids for e in made]

    def learn(self, units: list[str]) -> None:
        """Align units that are not known yet: one product for all of them, a block for each."""
        a_ids, b_ids = self._encode_a(units), self.b.encode(units, num_threads=1)
        raw = [b" " + u.encode() for u in units]
        # Seldom does a unit fail, so they are checked together first.
        if not self._covers(a_ids, b_ids, raw):
            good = [self._covers([a], [b], [r]) for a, b, r in zip(a_ids, b_ids, raw)]
            a_ids, b_ids = ([x if ok else [] for x, ok in zip(ids, good)] for ids in (a_ids, b_ids))
        a_counts, b_counts = ([len(x) for x in ids] for ids in (a_ids, b_ids))
        a_flat, b_flat = (np.array(list(chain.from_iterable(x)), np.int64) for x in (a_ids, b_ids))
        found = aligned(self.a_length[a_flat], self.b_length[b_flat])
        codes = (a_flat[found.links[:, 0]] << 32) | b_flat[found.links[:, 1]]
        a_ends, b_ends = found.groups_a.begins, found.groups_b.begins
        # A group's ids of A stand behind all ids of earlier groups, those of B behind them.
        shown = np.empty(len(a_flat) + len(b_flat), object)
        for ids, ends, others, table in (
            (a_flat, a_ends, b_ends[:-1], self.a_shown),
            (b_flat, b_ends, a_ends[1:], self.b_shown),
        ):
            closes = np.zeros(len(ids), np.int64)
            closes[ends[1:] - 1] = 1
            shown[np.arange(len(ids)) + np.repeat(others, np.diff(ends))] = table[ids, closes]
        shown = shown.tolist()
        # A unit's groups are those up to the one that its last token closes.
        last = np.searchsorted(a_ends, np.cumsum(a_counts)).tolist()
        young, begin, from_ = self.young, 0, 0
        to = (a_ends + b_ends)[last].tolist()
        codes = array("q", codes.tobytes())
        for unit, n_a, n_b, end, until in zip(units, a_counts, b_counts, last, to):
            if not n_a:
                young.bad.add(len(young.place))
            young.pairs.extend(codes[begin:end])
            young.add(unit, "".join(shown[from_:until]), n_a, n_b)
            begin, from_ = end, until

    def _covers(self, a_ids: list[list[int]], b_ids: list[list[int]], raw: list[bytes]) -> bool:
        """Both lists of ids stand for the units' bytes, no token is empty and none reaches across."""
        whole, ends = b"".join(raw), np.cumsum([len(r) for r in raw])
        for ids, tokens, length in ((a_ids, self.a_bytes, self.a_length), (b_ids, self.b_bytes, self.b_length)):
            flat = list(chain.from_iterable(ids))
            if b"".join([tokens[i] for i in flat]) != whole:
                return False
            lengths = length[flat]
            counts = np.cumsum([len(x) for x in ids])
            if not lengths.all() or not np.array_equal(np.cumsum(lengths)[counts - 1], ends):
                return False
        return True

    def places(self, texts: list[str | None]) -> list[list[int] | None]:
        """For each text the places of its units; None where it has no tokens."""
        split = [self.units(t) if t else [] for t in texts]
        place, old = self.young.place, self.old.place
        missing = dict.fromkeys(u for units in split for u in units if u not in place)
        new = [u for u in missing if u not in old]
        for unit in missing:
            if unit in old:
                self.young.take(unit, self.old)
        for begin in range(0, len(new), LEARNT_UNITS):
            self.learn(new[begin : begin + LEARNT_UNITS])
        found = [[place[u] for u in units] for units in split]
        bad = self.young.bad
        return [p if p and (not bad or bad.isdisjoint(p)) else None for p in found]


def _fresh(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def _pack(numbers: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    return packer.compress(np.ascontiguousarray(numbers).tobytes())


def _unpack(raw: bytes, kind: type, unpacker: zstandard.ZstdDecompressor) -> np.ndarray:
    return np.frombuffer(unpacker.decompress(raw), kind)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCK, UNITS, BEGINS, PLACES, PAIRS, TIMES = "_block", "_units", "_begins", "_places", "_pairs", "_times"


class Parts(NamedTuple):
    """What :func:`align` makes: a row for each text, and one for each block (``texts`` is false)."""

    rows: DataFrame
    names: dict[str, str]


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> Parts:
    """Rows of ``docs`` without ``text``, with ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``groups``.

    ``groups`` shows the ids of each group, as ``a1,a2|b1;a3|b2,b3``.  ``a_path`` is a byte-level BPE of
    the tokenizers library, ``b_path`` a sentencepiece model; every executor has both files.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, "groups", *COUNTS)]
    names = [f.name for f in kept]
    own = {n: _fresh(n, [*names, text]) for n in (BLOCK, UNITS, BEGINS, PLACES, PAIRS, TIMES)}
    made = [*COUNTS, "groups", own[BLOCK], own[UNITS], own[BEGINS], own[PLACES], own[PAIRS], own[TIMES]]
    types = [pa.int64()] * 4 + [pa.string(), pa.int64()] + [pa.binary()] * 5
    spark_types = [T.LongType()] * 4 + [T.StringType(), T.LongType()] + [T.BinaryType()] * 5
    schema = T.StructType(
        [*(T.StructField(f.name, f.dataType) for f in kept)]
        + [T.StructField(n, t) for n, t in zip(made, spark_types)]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, packer = Pair.of(a_path, b_path), zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = text_lengths(batch, text)
            begin = done = size = part = 0
            places: list[list[int] | None] = []
            for i, length in enumerate(lengths):
                size += length
                part += length
                last = size >= BLOCK_CHARS or i + 1 == len(lengths)
                if part >= SLICE_CHARS or last:
                    places += pair.places(batch.column(text).slice(done, i + 1 - done).to_pylist())
                    done, part = i + 1, 0
                if last:
                    rows = batch.slice(begin, i + 1 - begin)
                    yield from block(pair.young, packer, rows, lengths[begin : i + 1], places, number)
                    number, begin, size, places = number + 1, i + 1, 0, []
                    pair.turn()

    def block(known, packer, rows, lengths, places, number) -> Iterator[pa.RecordBatch]:
        """Rows of the texts in slices, then one of the block's units and pairs."""
        flat = [np.array(p or [], np.int64) for p in places]
        used, inverse = np.unique(np.concatenate(flat), return_inverse=True)
        ends = np.cumsum([len(f) for f in flat])
        n_a, n_b, begins, codes = (
            np.array(x, np.int64) for x in (known.n_a, known.n_b, known.begins, known.pairs)
        )
        n_a, n_b, n_links = n_a[used], n_b[used], np.diff(begins)[used]
        begin = size = 0
        for i, length in enumerate(lengths):
            size += length
            if size < SLICE_CHARS and i + 1 < len(lengths):
                continue
            columns: list[list] = [[] for _ in made]
            for k in range(begin, i + 1):
                mine = inverse[ends[k] - len(flat[k]) : ends[k]]
                links = int(n_links[mine].sum())
                groups = "".join([known.groups[p] for p in places[k] or ()])[:-1]
                packed = _pack(mine.astype(np.uint32), packer)
                values = [int(n_a[mine].sum()), int(n_b[mine].sum()), links, links, groups, number, packed]
                for column, value in zip(columns, [*values, None, None, None, None]):
                    column.append(value)
            yield batch_of([rows.column(n).slice(begin, i + 1 - begin) for n in names], columns)
            begin, size = i + 1, 0
        if len(used):
            shift = np.repeat(begins[used] - (np.cumsum(n_links) - n_links), n_links)
            pairs, at = np.unique(codes[shift + np.arange(len(shift))], return_inverse=True)
            weight = np.repeat(np.bincount(inverse, minlength=len(used)), n_links)
            occurs = np.bincount(at, weight, minlength=len(pairs)).astype(np.int64)
            rows_begin = np.concatenate([[0], np.cumsum(n_links)])
            packed = [rows_begin.astype(np.uint32), at.astype(np.uint32), pairs, occurs]
            values = [None] * 5 + [number, None] + [_pack(p, packer) for p in packed]
            nothing = [pa.nulls(1, rows.column(n).type) for n in names]
            yield batch_of(nothing, [[v] for v in values])

    def batch_of(first: list[pa.Array], columns: list[list]) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays([*first, *arrays], [*names, *made])

    columns = [text, *(n for n in names if n != text)]
    rows = docs.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(cut, schema)
    return Parts(rows, own)


def texts_of(parts: Parts) -> DataFrame:
    """The texts' rows only, without working columns."""
    rows = parts.rows.where(F.col(parts.names[UNITS]).isNotNull())
    return rows.drop(*parts.names.values())


def pair_counts(parts: Parts) -> DataFrame:
    """``pair`` (A id times 2^32 plus B id), ``n`` links, and whether that is its B id's ``best``."""
    counts = _block_pairs(parts).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "pairs")
    # A row for each id of a vocabulary at most.
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(F.broadcast(top), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _block_pairs(parts: Parts) -> DataFrame:
    """``block``, ``pair`` and how often the block's texts link it."""
    own = parts.names

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for block, pairs, n in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "n"))):
                pairs, n = (_unpack(x, np.int64, unpacker) for x in (pairs, n))
                blocks = np.full(len(pairs), block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks), pa.array(pairs), pa.array(n)], ["block", "pair", "n"]
                )

    rows = parts.rows.where(F.col(own[PAIRS]).isNotNull()).select(
        F.col(own[BLOCK]).alias("block"), F.col(own[PAIRS]).alias("pairs"), F.col(own[TIMES]).alias("n")
    )
    return rows.mapInArrow(unpack, "block bigint, pair bigint, n bigint")


def with_pair_counts(parts: Parts) -> DataFrame:
    """The texts' rows with ``n_best`` and ``count_sum``.

    ``count_sum`` adds up, over the links of a text, how many links of all texts hold the same pair of
    ids; ``n_best`` counts the links whose pair is the most frequent one of its B id, ties included.
    Columns of ``parts.rows`` may have been added, or dropped but for the working ones.
    """
    own = parts.names
    stored = Parts(written(parts.rows, "aligned"), own)
    schema = stored.rows.schema
    kept = [f for f in schema.fields if f.name not in own.values() and f.name not in ("n_best", "count_sum")]
    names = [f.name for f in kept]
    block = own[BLOCK]
    answers = (
        _block_pairs(stored)
        .join(pair_counts(stored).withColumnRenamed("n", "total"), "pair")
        .select("block", "pair", "total", "best")
    )

    def gather(rows: pa.Table, found: pa.Table) -> pa.Table:
        """The rows of one block with what became of its pairs."""
        unpacker = zstandard.ZstdDecompressor()
        is_text = rows.column(own[UNITS]).is_valid()
        texts = rows.filter(is_text)
        lists = rows.filter(rows.column(own[PAIRS]).is_valid())
        per_unit = np.zeros((2, 0), np.int64)
        if lists.num_rows:
            begins, at = (
                _unpack(lists.column(own[c])[0].as_py(), np.uint32, unpacker).astype(np.int64)
                for c in (BEGINS, PLACES)
            )
            pairs = _unpack(lists.column(own[PAIRS])[0].as_py(), np.int64, unpacker)
            order = np.searchsorted(pairs, found.column("pair").to_numpy())
            values = np.zeros((2, len(pairs)), np.int64)
            values[0, order] = found.column("best").to_numpy()
            values[1, order] = found.column("total").to_numpy()
            units_by_pairs = Csr(begins, at, np.ones(len(at), np.int64))
            per_unit = np.stack([times(units_by_pairs, v) for v in values])
        sums = [
            per_unit[:, _unpack(raw, np.uint32, unpacker)].sum(axis=1).tolist()
            for raw in texts.column(own[UNITS]).to_pylist()
        ]
        made = [pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1)]
        return pa.Table.from_arrays(
            [*(texts.column(n) for n in names), *made], [*names, "n_best", "count_sum"]
        )

    out = T.StructType([*kept, T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])
    return stored.rows.groupBy(block).cogroup(answers.groupBy("block")).applyInArrow(gather, out)
