"""Tree encoding, the compiled tokenizer and packing, against the libraries."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillstone.llm import bpe_tree, packing, token_counts
from quillstone.llm.transducer import NEXT, PieceTokenizer, kinds, run_states

from .conftest import AWKWARD

RANKS = P.path("byte_bpe_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


CODEC = bpe_tree.TreeCodec(open(RANKS, "rb").read(), P.PATTERN, leaf_chars=7, leaf_tokens=3)
PIECES = PieceTokenizer(open(WORDS, "rb").read(), keep=50)
WHOLE = Tokenizer.from_file(WORDS)
BITS = st.lists(st.sampled_from(["a", "th", "ing", "'s", "'", "'re", "'r", "'l", "'ll", " ", "  ", "\n", "\n\n", "1", "23", "!", "!!", "é", "é", "Σ", "İ", "日本", "😀", "\t", "x" * 40, "9" * 30, "?" * 20, "<|endoftext|>", "<|", "\x85", "\xa0"])).map("".join)


@settings(max_examples=150, deadline=None)
@given(BITS)
def test_tree_equals_the_library(library, text):
    ids = CODEC.encode(text)
    assert ids == library.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


@settings(max_examples=30, deadline=None)
@given(st.text("etaoinshr", min_size=40, max_size=600))
def test_tree_joins_inside_one_match(library, text):
    assert CODEC.encode(text) == library.encode_ordinary(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(BITS, max_size=4))
def test_pieces_equal_the_library(texts):
    want = [x.ids for x in WHOLE.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in PIECES.encode(texts)] == want and PIECES.counts(texts).tolist() == [len(x) for x in want]


@given(st.text("a's r e1!v\nlt", max_size=300), st.integers(1, 9))
@settings(max_examples=100, deadline=None)
def test_prefix_scan_equals_one_pass(text, chunk):
    kind = kinds()[np.array([ord(c) for c in text], int)]
    state, want = 0, []
    for k in kind:
        state = NEXT[state, k]
        want.append(state)
    assert run_states(kind, chunk).tolist() == want


def test_op1_rows(awkward, empty, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_tree.encode_documents(awkward, RANKS, P.PATTERN).collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in AWKWARD:
        ids = library.encode_ordinary(t or "")
        want.append((i is None, i or 0, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want)
    assert bpe_tree.encode_documents(empty, RANKS, P.PATTERN).count() == 0


def test_op9_rows(awkward, empty):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(awkward, WORDS).collect())
    sizes = [(i, len((t or "").encode()), len(WHOLE.encode(t or "", add_special_tokens=False).ids)) for i, t in AWKWARD]
    assert got == sorted((i is None, i or 0, b, n, n > 2048) for i, b, n in sizes)
    assert token_counts.count_tokens(empty, WORDS).count() == 0


def test_best_fit_takes_the_tightest_bin():
    packer = packing.BestFit(10, bins=2)
    assert [packer.place(n) for n in (6, 7, 3, 4, 8, 5, 2)] == [(0, 0), (1, 0), (1, 7), (0, 6), (2, 0), (3, 0), (2, 8)]
    packer = packing.BestFit(10, bins=1)
    assert [packer.place(n)[0] for n in (6, 7, 3, 4)] == [0, 1, 1, 2]  # bin 0 was closed for bin 1
    with pytest.raises(ValueError):
        packer.place(11)


def test_op5_pieces_and_places(awkward, empty):
    rows = packing.pack(awkward, WORDS, with_ids=True).collect()
    by_doc, bins = {}, {}
    for r in rows:
        ids = np.array(r.ids, "<u4")
        assert len(ids) == r.length <= 2048 and zlib.crc32(ids.tobytes()) == r.ids_crc32 and r.start == 2048 * r.piece
        by_doc.setdefault((r.doc_id, r.piece), []).append(r.ids)
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    want = {}
    for i, t in AWKWARD:
        ids = [*WHOLE.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            want.setdefault((i, k // 2048), []).append(ids[k : k + 2048])
    assert {k: sorted(v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(empty, WORDS).count() == 0


def test_packing_is_tight(rows):
    docs = rows("doc_id long, text string", *[(i, "word " * (37 * i % 1500)) for i in range(400)])
    got = packing.pack(docs.coalesce(1), WORDS).collect()
    assert len({r.sequence_id for r in got}) <= 1.02 * sum(r.length for r in got) / 2048 + 1
