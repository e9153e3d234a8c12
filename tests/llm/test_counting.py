"""Token counts, encoders, token files and packing against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from assayer.llm.bpe import TextCounter, count_tokens
from assayer.llm.encoding import Encoder
from assayer.llm.packing import cut, pack, sequences
from assayer.llm.token_files import occurrences, read_documents, token_count, write_token_shards
from assayer.llm.wavelet import BLOCK, WaveletMatrix

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "aaaaaaaaaaa", "  \n\n x", "it's  don't", "<|endoftext|>a<|endoftext|>", "<|endoftext", "é" * 99, "\x1c\x85 x", "Σας ΟΔΟΣ İI", "ab" * 999]


@pytest.fixture(scope="module")
def bytes_counter():
    return TextCounter(BYTES), Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def word_encoder():
    return Encoder(WORDS), Tokenizer.from_file(WORDS)


def _ids(tokenizer, text: str) -> np.ndarray:
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_counts_equal_the_librarys(bytes_counter, texts):
    ours, library = bytes_counter
    texts = [*texts, *ODD]
    assert list(ours.counts(texts)) == [len(_ids(library, t)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_encoder_equals_the_library(word_encoder, text):
    ours, library = word_encoder
    for t in (text, *ODD, "a\x01b \x01", "e\ńx"):
        assert ours.encode(t) == _ids(library, t).tobytes()


def test_encoder_leaves_other_tokenizers_whole_texts():
    ours, library = Encoder(BYTES), Tokenizer.from_file(BYTES)
    assert ours.encode("two  words\n") == _ids(library, "two  words\n").tobytes()


def test_count_tokens_of_documents(spark, odd_docs, odd_rows, no_docs):
    library = Tokenizer.from_file(BYTES)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(odd_docs, BYTES, limit=500).collect())
    want = Counter((i, len((t or "").encode()), n := len(_ids(library, t)), n > 500) for i, t, *_ in odd_rows)
    assert got == want
    assert count_tokens(no_docs, BYTES).count() == 0


@pytest.mark.parametrize("size", [0, 1, 7, BLOCK, BLOCK + 1, 9000])
def test_wavelet_matrix_round_trip_rank_select(size):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, 300, size)
    matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids).to_bytes())
    assert (matrix.decode() == ids).all()
    for at in rng.integers(0, size, 30).tolist() if size else []:
        assert matrix.access(at) == ids[at]
    for token in (0, 1, 17, 299, 5000):
        assert matrix.count(token) == (ids == token).sum()
        assert matrix.count(token, size // 3, size // 2) == (ids[size // 3 : size // 2] == token).sum()
        assert matrix.positions(token) == np.flatnonzero(ids == token).tolist()
    with pytest.raises(IndexError):
        matrix.access(size)


def test_token_files_round_trip(spark, odd_docs, odd_rows, no_docs, tmp_path):
    library = Tokenizer.from_file(WORDS)
    write_token_shards(odd_docs, str(tmp_path / "shards"), WORDS, shard_tokens=500)
    got = sorted(read_documents(spark, str(tmp_path / "shards")).collect(), key=lambda r: r.start)
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, all_ids = 0, []
    for row, (key, text, *_) in zip(got, ordered, strict=True):
        ids = np.append(_ids(library, text), np.array([2], dtype="<u4")).astype("<u4")
        assert (row.key, row.start, row.n_tokens, row.ids_crc32) == (key, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        all_ids.append((key, ids))
    token = int(all_ids[1][1][0])
    found = Counter((r.key, r.position) for r in occurrences(spark, str(tmp_path / "shards"), token).collect())
    assert found == Counter((key, int(p)) for key, ids in all_ids for p in np.flatnonzero(ids == token))
    assert token_count(spark, str(tmp_path / "shards"), token).first().n == sum(found.values())


@given(st.integers(1, 20_000), st.sampled_from([64, 1000, 4096]))
def test_cut_gives_whole_documents_in_their_classes(length, capacity):
    pieces = cut(length, capacity)
    assert sum(n for n, _ in pieces) == length
    for n, kind in pieces:
        assert 0 < n <= capacity
        assert n == -kind if kind < 0 else n * kind <= capacity


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_keeps_every_id_once(spark, odd_docs, odd_rows, capacity):
    library = Tokenizer.from_file(WORDS)
    packed = pack(odd_docs, WORDS, capacity=capacity, with_ids=True).cache()
    pieces = packed.collect()
    by_doc = defaultdict(list)
    for p in pieces:
        assert zlib.crc32(bytes(p.ids)) == p.ids_crc32 and len(p.ids) == 4 * p.length
        by_doc[p.doc_id].append(p)
    texts = defaultdict(list)
    for i, t, *_ in odd_rows:
        texts[i].append(np.append(_ids(library, t), 2))
    for key, copies in texts.items():
        got = Counter((p.start, p.length, p.ids_crc32) for p in by_doc[key])
        covered = Counter(at for p in by_doc[key] for at in range(p.start, p.start + p.length))
        assert covered == Counter(at for ids in copies for at in range(len(ids)))
        assert all(n % len(copies) == 0 for n in got.values())
    for row in sequences(packed).collect():
        mine = sorted((p for p in pieces if p.sequence_id == row.sequence_id), key=lambda p: p.offset)
        assert [p.offset for p in mine] == np.concatenate(([0], np.cumsum([p.length for p in mine])[:-1])).tolist()
        assert row.length <= capacity and bytes(row.ids) == b"".join(bytes(p.ids) for p in mine)
    assert {p.sequence_id for p in pieces} == set(range(len({p.sequence_id for p in pieces})))
    packed.unpersist()


def test_packing_wastes_little(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, " ".join(rng.choices(["red", "blue", "green"], k=rng.randint(1, 3000)))) for i in range(600)], "doc_id bigint, text string")
    pieces = pack(docs, WORDS).collect()
    used, sequences_used = sum(p.length for p in pieces), len({p.sequence_id for p in pieces})
    assert used / (4096 * sequences_used) > 0.98
    assert len(pieces) < 3 * 600


def test_packing_of_nothing(spark, no_docs):
    assert pack(no_docs, WORDS).count() == 0
