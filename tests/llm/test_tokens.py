"""Token counts, byte pairs, token files and packing against the libraries themselves."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakestrata.llm import packing, token_files
from lakestrata.llm.byte_bpe import BytePairs, bpe_round_trip, read_ranks, text_encoder
from lakestrata.llm.library_ids import library_encoder
from lakestrata.llm.token_counts import cut_safely, safe_cut_model, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = "".join(["ab", " ", "\n", "\t", "\x1c", " ", "　", "Zé", "é", "漢", "😀", "1२", "'s", ".,!|", "<>▁"])


def u4(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))},
        special_tokens={},
    )


@pytest.fixture(scope="module")
def encoder():
    return text_encoder(read_ranks(open(RANKS, "rb").read()), public_tokenizers.PATTERN)


def test_token_counts(spark, odd_documents, odd_texts, no_documents):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_counts(odd_documents, PIECES).collect()
    assert len(found) == len(odd_texts) + 2
    for r in found:
        text = "no id" if r.doc_id is None else odd_texts[r.doc_id] or ""
        n = len(model.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)
    assert token_counts(no_documents, PIECES).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=ODD, max_size=60), st.integers(1, 20))
def test_cuts_do_not_change_counts(text, size):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert sum(len(model.encode(p)) for p in cut_safely(text, size)) == len(model.encode(text))


def test_the_model_has_safe_cuts():
    assert safe_cut_model(open(PIECES, "rb").read())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ODD, max_size=60))
def test_byte_pairs_as_the_library(encoder, library, text):
    encode, pairs = encoder
    (packed,) = encode([text])
    assert packed == u4(library.encode_ordinary(text))
    assert pairs.decode(np.frombuffer(packed, "<u4").tolist()) == text.encode()


@pytest.mark.parametrize("piece", ["a" * 4001, "ab" * 3000, "aab" * 999, "漢字" * 500, "x"])
def test_very_long_pre_tokens(encoder, library, piece):
    assert encoder[1].encode(piece.encode()) == library.encode_ordinary(piece)


def test_the_queue_takes_a_lower_rank_that_a_merge_brings():
    ranks = {bytes([i]): i + 3 for i in range(256)} | {b"bc": 1000, b"abc": 0, b"ca": 2000, b"bcb": 1}
    own, library = BytePairs(ranks), tiktoken.Encoding("t", pat_str=".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcabc", "bcbc", "bcbcabcab", "cabcbca"):
        assert own.encode(text.encode()) == library.encode_ordinary(text)


def test_round_trip(odd_documents, odd_texts, no_documents, library):
    found = bpe_round_trip(odd_documents, RANKS, public_tokenizers.PATTERN, ids=True).collect()
    assert len(found) == len(odd_texts) + 2
    for r in found:
        text = "no id" if r.doc_id is None else odd_texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids) == (len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(u4(ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe_round_trip(no_documents, RANKS, public_tokenizers.PATTERN).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_give_the_ids_of_whole_texts(name):
    rng = random.Random(1)
    path = public_tokenizers.path(name)
    encode, library = library_encoder(open(path, "rb").read()), Tokenizer.from_file(path)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 50))) for _ in range(1500)]
    texts += ["it's  they'll\n\n x", "<|endoftext|> a<|startoftext|>|", " \n", "a\n b.\nc,"]
    wanted = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert encode(texts) == [u4(ids) for ids in wanted]


@pytest.mark.parametrize("high", [1, 2, 200, 49408, 2**32 - 1])
@pytest.mark.parametrize("n", [0, 1, 7, 1023, 1024, 1025, 5000])
def test_blocks_round_trip(high, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, dtype=np.uint32, endpoint=True)
    ids[rng.random(n) < 0.9] //= 1000
    data = token_files.pack_ids(ids)
    assert (token_files.unpack_ids(data) == ids).all()
    assert (token_files.unpack_ids(data, n // 3, n // 2) == ids[n // 3 : n // 2]).all()


def test_outliers_are_exceptions():
    ids = np.full(1024, 5, np.uint32)
    ids[::100] = 40_000
    assert len(token_files.pack_block(ids)) < 7 + 1024 // 8 + 11 * 6


def test_token_files(spark, odd_documents, odd_texts, no_documents, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 200)
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(odd_documents, str(tmp_path / "a"), path, end_id=1)
    found = token_files.read_token_files(spark, str(tmp_path / "a"), tokens=True).collect()
    library = Tokenizer.from_file(path)

    def ids(doc_id):
        text = "no id" if doc_id is None else odd_texts[doc_id] or ""
        return [*library.encode(text, add_special_tokens=False).ids, 1]

    at = 0
    found.sort(key=lambda r: r.start)
    assert [r.doc_id for r in found] == [None, *sorted([*range(len(odd_texts)), 7])]
    for r in found:
        assert (r.start, r.ids, r.n_tokens) == (at, ids(r.doc_id), len(ids(r.doc_id)))
        assert r.ids_crc32 == zlib.crc32(u4(r.ids))
        at += r.n_tokens
    token_files.write_token_files(no_documents, str(tmp_path / "b"), path, end_id=1)
    assert token_files.read_token_files(spark, str(tmp_path / "b")).collect() == []


def check_packing(rows, size=1024):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing(odd_documents, odd_texts, no_documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    found = packing.pack_documents(odd_documents, path, end_id=2).collect()
    bins = check_packing(found)
    assert bins <= -(-sum(r.length for r in found) // 1024) + 1
    by_doc = defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == {None, *range(len(odd_texts))}
    for doc_id, rows in by_doc.items():
        text = "no id" if doc_id is None else odd_texts[doc_id] or ""
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        first = (len(ids) - 1) % 1024 + 1
        starts = [0, *range(first, len(ids), 1024)]
        wanted = [(i, a, b - a, zlib.crc32(u4(ids[a:b]))) for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
        copies = 2 if doc_id == 7 else 1
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(wanted * copies)
    assert packing.pack_documents(no_documents, path, end_id=2).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), max_size=8), st.integers(1, 60))
def test_the_fullest_filling(counts, size):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * i for s in sums for i in range(n + 1) if s + length * i <= size}
    taken = packing.fullest(counts, size)
    assert sum(n * u for n, u in taken.items()) == max(sums)
    assert all(u <= counts[n] for n, u in taken.items())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_fillings_use_everything_once(lengths):
    plan = packing.minimum_bin_slack(Counter(lengths), 40)
    used = Counter()
    for filling, times in plan:
        assert sum(n * u for n, u in filling.items()) <= 40
        for n, u in filling.items():
            used[n] += u * times
    assert used == Counter(lengths)


def test_packing_is_close_to_the_bound():
    rng = np.random.default_rng(2)
    histogram = Counter(np.minimum(1024, rng.lognormal(5, 1, 20_000).astype(int) + 1).tolist())
    bins = sum(times for _, times in packing.minimum_bin_slack(histogram, 1024))
    assert bins <= -(-sum(n * c for n, c in histogram.items()) // 1024) + 2
