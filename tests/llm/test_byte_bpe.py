"""Byte-level BPE against the library on whole texts and against a plain merge loop."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from acctrisk.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "", "a", " ", "\n\n  x  y\t\tz ", "don't we'll 'sab it's", "Größe déjà vu 123abc 4.5%",
    "日本語 テキスト 🙂🙂", "a  b  \x1c c", "<|endoftext|> text", "x" * 3000,
    "word, " * 30_000, " " * 2000 + "end",
]


@pytest.fixture(scope="module")
def encoding():
    return byte_bpe.load(PATH)


def merged(ranks, piece):
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        found = [(ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(found)
        if rank == 1 << 60:
            break
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[x] for x in parts]


@pytest.mark.parametrize("text", TEXTS[:9])
def test_ids_equal_a_plain_merge_loop(encoding, text):
    ranks = encoding._mergeable_ranks
    want = [i for m in regex.findall(public_tokenizers.PATTERN, text)
            for i in merged(ranks, m.encode())]
    assert byte_bpe.encode_text(encoding, text).tolist() == want


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=" \n\tab'sé \x1c1!.", max_size=120))
def test_pieces_encode_like_the_whole(encoding, text):
    pieces = list(byte_bpe.long_pieces(text, 5))
    assert "".join(pieces) == text
    assert [i for p in pieces for i in encoding.encode_ordinary(p)] == \
        encoding.encode_ordinary(text)


def test_rows(spark, frame, encoding):
    docs = frame("doc_id long, text string, ids string, n_tokens string",
                 *[(i, t, "x", "y") for i, t in enumerate(TEXTS)],
                 (1, "a", "x", "y"), (None, None, None, None))
    rows = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs, PATH), PATH)).collect()
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)

    def row(i, text):
        ids = encoding.encode_ordinary(text)
        return (str(i), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest())

    assert got == sorted([row(i, t) for i, t in enumerate(TEXTS)] + [row(1, "a"), row(None, "")])


def test_empty_table_and_null_ids(frame):
    assert byte_bpe.encode(frame("doc_id long, text string"), PATH).count() == 0
    tokens = frame("doc_id long, n_tokens long, ids binary", (1, None, None), (2, 0, b""))
    assert [r.decoded for r in byte_bpe.decode(tokens, PATH).collect()] == [None, b""]


def test_decoding_gives_raw_bytes(frame, encoding):
    ids = np.array(encoding.encode_ordinary("🙂"), dtype="<u4")[:1]
    tokens = frame("doc_id long, n_tokens long, ids binary", (1, 1, ids.tobytes()))
    assert "🙂".encode().startswith(bytes(byte_bpe.decode(tokens, PATH).collect()[0].decoded))


@pytest.fixture(scope="module")
def plain_first():
    return byte_bpe.PlainFirst(PATH)


@pytest.mark.parametrize("text", [*TEXTS, "\0<never>\0 a", "one\n\ntwo\n \nthree" + " words" * 300])
def test_plain_pattern_gives_the_same_ids(encoding, plain_first, text):
    assert plain_first.encode_text(text).tolist() == byte_bpe.encode_text(encoding, text).tolist()
    assert plain_first.plain.n_vocab == encoding.n_vocab


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tab'sé\x1c1!.\x85\xa0　​", max_size=60), st.sampled_from([0, 2, 256]))
def test_plain_pattern_gives_the_same_ids_of_odd_white_space(encoding, plain_first, text, few):
    before, byte_bpe.FEW_RUNS = byte_bpe.FEW_RUNS, few
    try:
        assert plain_first.encode_text(text).tolist() == byte_bpe.encode_text(encoding, text).tolist()
    finally:
        byte_bpe.FEW_RUNS = before
