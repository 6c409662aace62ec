"""Token files, byte-level BPE and token counts against the libraries on whole texts."""

import base64
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import tokenizers

from spanlake.llm import bpe, token_counts
from spanlake.llm import token_files as tf
from spanlake.llm.common import text_lengths

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    None,
    "",
    " ",
    "a",
    "a ",
    "  two  spaces ",
    "It's a text.\nWith lines,\n\n and \t tabs  and\u00a0more!! ",
    "naïve Straße Ünï 12345 67,89 日本語 \U0001f600\U0001f468\u200d\U0001f469",
    "<|endoftext|> inside <s> and </s> <unk>",
    "nul\x00 and \x01 ▁ mark",
    "It's a text.\nWith lines,\n\n and \t tabs  and\u00a0more!! ",
    "word " * 30_000 + "end",
    "x" * 20_000,
]
ROWS = [(i if i != 4 else None, t, "extra", i) for i, t in enumerate(TEXTS)] + [(0, None, "again", 0)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        ROWS, "doc_id long, text string, ids string, _block int"
    ).repartition(3)


def library_ids():
    model = tokenizers.Tokenizer.from_file(JSON)
    return {t: model.encode(t or "", add_special_tokens=False).ids for t in TEXTS}


def test_token_files_hold_what_the_library_gives(spark, docs):
    folder = tf.new_folder(spark)
    manifest = tf.write_token_files(docs, JSON, folder)
    found = tf.read_token_files(manifest, folder).orderBy("start").collect()
    known, start = library_ids(), 0
    order = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    assert [r.id for r in found] == [r[0] for r in order]
    for got, row in zip(found, order):
        ids = np.array([*known[row[1]], 2], "<u4")
        assert (got.start, got.n_tokens) == (start, len(ids))
        assert zlib.crc32(got.ids) == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_the_manifest_of_many_shards_is_one_file(spark, docs):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = tf.write_token_files(docs, JSON, tf.new_folder(spark))
        rows = manifest.orderBy("shard").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) > 2 and sum(r.documents for r in rows) == len(ROWS)
    assert [r.start for r in rows] == [sum(r.tokens for r in rows[:k]) for k in range(len(rows))]
    assert len(manifest.inputFiles()) == 1


def test_one_document_is_read_alone(spark, docs):
    folder = tf.new_folder(spark)
    first = tf.write_token_files(docs, JSON, folder).orderBy("shard").first()
    assert tf.read_document(folder, first.file, 0).tolist()[-1] == 2


def test_token_files_of_no_rows(spark, docs):
    folder = tf.new_folder(spark)
    assert tf.read_token_files(tf.write_token_files(docs.limit(0), JSON, folder), folder).count() == 0


def test_a_dictionary_with_another_hash_is_refused(spark, docs):
    folder = tf.new_folder(spark)
    first = tf.write_token_files(docs, JSON, folder).first()
    files, root = tf.store(folder)
    for info in files.get_file_info(tf.pa.fs.FileSelector(root)):
        if info.path.endswith(".zdict"):
            with files.open_output_stream(info.path) as out:
                out.write(b"other")
    with pytest.raises(ValueError, match="another hash"):
        tf.read_document(folder, first.file, 0)


def test_bpe_equals_the_library_and_decodes_to_the_text(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    named = docs.withColumnRenamed("ids", "kept")
    found = bpe.decode(bpe.encode(named, RANKS), RANKS).collect()
    assert sorted(found[0].asDict()) == ["_block", "decoded", "doc_id", "ids", "kept"]
    wanted = sorted((r[3], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in ROWS)
    assert sorted((r._block, r.ids, bytes(r.decoded)) for r in found) == wanted


def test_bpe_of_no_rows_and_unknown_ids(spark, docs):
    assert bpe.encode(docs.limit(0), RANKS).count() == 0
    odd = spark.createDataFrame([([1, 2],), (None,), ([60_000],), ([],)], "ids array<int>")
    assert [r.decoded is None for r in bpe.decode(odd, RANKS).collect()] == [False, True, True, False]


def test_bpe_blocks_of_any_size_give_the_same(spark, docs, monkeypatch):
    whole = sorted((r._block, r.ids) for r in bpe.encode(docs, RANKS).collect())
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 3)
    assert sorted((r._block, r.ids) for r in bpe.encode(docs, RANKS).collect()) == whole


def test_token_counts_equal_the_library(spark, docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_counts.token_counts(docs, PIECES)
    wanted = sorted((r[3], len(model.encode(r[1] or ""))) for r in ROWS)
    assert sorted((r._block, r.n_tokens) for r in found.collect()) == wanted
    assert token_counts.token_counts(docs.limit(0), PIECES).count() == 0


def test_a_small_cache_gives_the_same_counts():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counts = token_counts.Counts(PIECES, {"text.": 99}, cache=2)
    counts.table = {}
    assert [counts(t or "") for t in TEXTS] == [len(model.encode(t or "")) for t in TEXTS]


def test_frequent_stretches_stay_known_in_a_small_cache(monkeypatch):
    encoder, learnt = tf.Encoder(JSON, cache=8), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda parts: (learnt.extend(parts), learn(parts)))
    texts = [f"begin often {' '.join(f'w{i}x{j}' for j in range(5))}" for i in range(6)]
    wanted = [encoder.whole([t])[0] for t in texts]
    assert [encoder([t])[0] for t in texts] == wanted
    assert learnt.count("often") == 1 and len(encoder.cache) + len(encoder.old) <= 8 + 2 * 7


def test_a_known_word_is_not_encoded_again_with_a_sign_or_a_line_break(monkeypatch):
    encoder, asked = tf.Encoder(JSON), []
    whole_ids = encoder.whole_ids
    monkeypatch.setattr(encoder, "whole_ids", lambda text: (asked.append(text), whole_ids(text))[1])
    encoder(["The word and next"])
    asked.clear()
    text = "The word, and word. next: word.\nThe next?! and\nThe"
    assert encoder([text]) == encoder.whole([text])
    assert not asked


def test_stretches_put_together_from_pieces_have_the_librarys_ids():
    random = np.random.default_rng(11)
    bits = ["a", "Zq", "it's", "'s", "don't.", "7", "½", "é", "é", "ß,", "中。", "a.b", ".", "?!", "...", "-", "\n", "\n\n"]
    bits += ["\r\n", "\t", "\x85", "\xa0", "\u2028", "\x1c", "'", "_", "😀", "\x00", "e\u0301", " ", " ", " ", ";", ":", ","]
    texts = ["".join(random.choice(bits, 12)) for _ in range(4000)]
    for cache in (50, 100_000):
        encoder = tf.Encoder(JSON, cache=cache)
        made = [ids for k in range(0, 4000, 100) for ids in encoder(texts[k : k + 100])]
        assert made == encoder.whole(texts)


def test_text_chunks_hold_one_slice_of_texts():
    texts = ["é" * 30, None, "b" * 5, "", "c" * 40, "d"]
    batch = tf.pa.RecordBatch.from_pydict({"n": list(range(6)), "text": texts})
    parts = list(tf.text_chunks([batch], "text", 35))
    assert [t for _, some in parts for t in some] == [t or "" for t in texts]
    assert [part.column("n").to_pylist() for part, _ in parts] == [[0, 1, 2], [3, 4], [5]]


def test_a_chunk_of_texts_takes_memory_for_its_own_only():
    batch = tf.pa.RecordBatch.from_pydict({"text": ["x" * 100_000] * 200})
    tracemalloc.start()
    try:
        for _, some in tf.text_chunks([batch], "text", 1 << 20):
            del some
        assert tracemalloc.get_traced_memory()[1] < 5 << 20
    finally:
        tracemalloc.stop()


def test_text_lengths_count_characters():
    texts = ["é中😀", None, "", "ab\n"]
    batch = tf.pa.RecordBatch.from_pydict({"text": texts})
    assert text_lengths(batch, "text") == [len(t or "") for t in texts]
