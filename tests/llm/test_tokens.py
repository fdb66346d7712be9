"""Token records and byte-level BPE against the public libraries."""

import base64
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltworks.llm import byte_bpe, token_records
from siltworks.llm.queries import QUERIES

from .helpers import SF, documents, empty, needs_tables

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def expected_records(rows):
    tokenizer, found, start = Tokenizer.from_file(WORDS), [], 0
    encoded = [(r["doc_id"], [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in rows]
    for doc_id, ids in sorted(encoded, key=lambda x: (x[0] is not None, x[0] or 0, np.array(x[1], "<u2").tobytes())):
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


@needs_tables
def test_records_of_whole_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert sorted(map(tuple, QUERIES["op1_token_records"](spark, SF).collect())) == sorted(expected_records(rows))


def test_records_of_awkward_rows(spark):
    docs = documents(spark)
    written = token_records.write_records(docs, WORDS, end_id=2, shards=4)
    got = written.read(written.index(spark)).select("doc_id", "start", F.octet_length("ids") / 4, F.crc32("ids")).collect()
    key = lambda r: (r[1], r[2])
    assert sorted(map(tuple, got), key=key) == sorted(expected_records(docs.collect()), key=key)


def test_pieces_at_random(spark):
    rng = random.Random(5)
    parts = ["a", "B", "é", "ß", "É", "e\u0301", "İ", "Σ", "'s", "'", ".", ",", "!", "1", " ", "\n", "<|endoftext|>", "<|ENDOFTEXT|>", "|", "中", "ll", "\u0345"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    docs = documents(spark, texts, clash=False)
    written = token_records.write_records(docs, WORDS, end_id=2, shards=4)
    got = written.read(written.index(spark)).select("doc_id", "start", F.octet_length("ids") / 4, F.crc32("ids")).collect()
    assert sorted(map(tuple, got)) == sorted(expected_records(docs.collect()))


def test_signs_digits_and_latin_letters_are_pieces_of_their_own():
    text = "the*** 12a (été)$ l'été ×= e\u0301. <|endoftext|>".encode()
    pieces, first = token_records.pieces_of(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    wanted = ["the", "***", "1", "2", "a", "(", "été", ")$", "l'été", "×=", "e\u0301.", "<|endoftext|>"]
    assert [p.decode() for p in pieces.to_pylist()] == wanted and first.tolist() == [0, len(wanted)]


def test_pieces_at_random_with_signs_digits_and_marks():
    rng = random.Random(6)
    parts = ["a", "É", "ß", "×", "÷", "\u0301", "\u0338", "=", "<", ">", "$", "#", "'s", "'", "_", "\\", "{", "12", "½", "²", "\u0100", " ", "<|endoftext|>", "|", "中", "\u0308"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(5000)]
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    pieces, first = token_records.pieces_of(np.frombuffer(data, np.uint8), offsets)
    ids, lengths = token_records.word_encoder(WORDS)(pieces)
    ends = np.concatenate([[0], np.cumsum(lengths)])[first]
    wanted = Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [e.ids for e in wanted]


def test_a_slice_of_text_is_encoded_in_bounded_memory():
    words = " ".join(random.Random(7).choices(["the", "running", "naïve", "x1", "Grüße", "..."], k=400_000)).encode()
    column = pa.record_batch([pa.array([words[i : i + 4000].decode("utf-8", "ignore") for i in range(0, len(words), 4000)])], names=["text"])
    byte_bpe.vocabulary(RANKS), byte_bpe.tables()
    for _, data, offsets in byte_bpe.slices([column], size=byte_bpe.ENCODED_BYTES):
        tracemalloc.start()
        byte_bpe.encode_texts(data, offsets, RANKS)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 30 << 20


def test_shuffled_reads_hold_the_same_records(spark):
    written = token_records.write_records(documents(spark), WORDS, end_id=2, shards=3)
    plain = [tuple(r) for r in written.read(written.index(spark)).collect()]
    mixed, again = ([tuple(r) for r in written.shuffled(spark, 7).collect()] for _ in range(2))
    assert mixed == again and mixed != plain
    assert sorted(mixed, key=str) == sorted(plain, key=str)


def test_an_empty_table_gives_an_empty_index(spark):
    written = token_records.write_records(empty(spark), WORDS, end_id=2)
    assert written.read(written.index(spark)).count() == 0


def test_damaged_records_are_noticed():
    record = token_records.frame(b"payload")
    assert token_records.unframe(record) == b"payload"
    for at in range(len(record)):
        damaged = record[:at] + bytes([record[at] ^ 1]) + record[at + 1 :]
        with pytest.raises(ValueError):
            token_records.unframe(damaged)


def plain_encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check_bpe(rows, encoding):
    for doc_id, text, n_tokens, ids, decoded in rows:
        want = encoding.encode_ordinary(text or "")
        assert np.frombuffer(ids, "<u4").tolist() == want, (doc_id, text)
        assert n_tokens == len(want) and bytes(decoded) == (text or "").encode()


def coded(docs):
    both = byte_bpe.decode(byte_bpe.encode(docs, RANKS), RANKS)
    return docs.select("doc_id", "text").distinct().join(both.distinct(), docs["doc_id"].eqNullSafe(both["doc_id"])).select(
        docs["doc_id"], "text", "n_tokens", "ids", "decoded"
    )


def test_bpe_of_awkward_rows(spark):
    check_bpe(coded(documents(spark).filter("doc_id is not null")).collect(), plain_encoding())
    assert byte_bpe.encode(documents(spark), RANKS).count() == documents(spark).count()
    assert byte_bpe.decode(byte_bpe.encode(empty(spark), RANKS), RANKS).count() == 0


def test_bpe_boundaries_at_random(spark):
    rng = random.Random(3)
    parts = ["a", "'", "s", "t", "ll", "re", " ", "  ", "\n", "1", "²", "é", "中", "!", " ", "😀", "'ve", "\x1c", "d", "m", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    check_bpe(coded(documents(spark, texts, clash=False)).collect(), plain_encoding())


def test_offsets_trace_ids_to_their_pieces(spark):
    text = "Grüße, it's 12 dogs"
    row = byte_bpe.encode(documents(spark, [text]), RANKS, offsets=True).first()
    begins = np.frombuffer(row["begins"], "<u4")
    assert len(begins) == row["n_tokens"] and begins[0] == 0
    raw = text.encode()
    pieces = {raw[a:b].decode() for a, b in zip(sorted(set(begins)), [*sorted(set(begins))[1:], len(raw)])}
    assert pieces == {"Grüße", ",", " it", "'s", " 12", " dogs"}


@needs_tables
def test_bpe_query(spark):
    encoding = plain_encoding()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op10_byte_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = encoding.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("limit", [1, 8, byte_bpe.LONG_PIECE])
def test_long_pieces_at_random(monkeypatch, limit):
    monkeypatch.setattr(byte_bpe, "LONG_PIECE", limit)
    rng, vocabulary, encoding = random.Random(limit), byte_bpe.Vocabulary(RANKS), library()
    for _ in range(300):
        letters = rng.choice(["ab", "aeinrst", "=-", "中文é", "xyz"])
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 400)))
        assert vocabulary.merge([text.encode()]) == [tuple(encoding._core_bpe.encode_single_piece(text.encode()))]


@pytest.mark.parametrize("letter", ["a", "=", "中", "xy"])
def test_a_piece_of_very_many_bytes(letter):
    import time

    text = letter * (200_000 // len(letter))
    raw, began = np.frombuffer(text.encode(), np.uint8), time.process_time()
    ids, _, _ = byte_bpe.encode_texts(raw, np.array([0, len(raw)]), RANKS)
    assert time.process_time() - began < 30
    assert ids.tolist() == library().encode_ordinary(text)
