"""Packing against a plain first-fit search, and whole documents back from their pieces."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from acctrisk.llm import byte_bpe, packing, queries
from acctrisk.llm.common import table

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def plain_first_fit(lengths, capacity):
    free, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if at == len(free):
            free.append(capacity)
        out[i] = (at, capacity - free[at])
        free[at] -= lengths[i]
    return out


def test_tree_equals_plain_first_fit():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50, 400):
        for most in (3, 64, 100):
            lengths = rng.integers(1, most + 1, n)
            got = packing.first_fit_decreasing(lengths, 64 if most <= 64 else 100)
            want = plain_first_fit(lengths.tolist(), 64 if most <= 64 else 100)
            assert list(zip(*(x.tolist() for x in got))) == want


def check(rows, texts, capacity):
    """Pieces make up the documents; sequences are gapless and within the capacity."""
    tokenizer, by_doc, by_sequence = library(), {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, (text, copies) in texts.items():
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], dtype="<u4")
        parts = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in by_doc[doc_id])
        cuts = range(0, len(ids), capacity)
        assert parts == sorted(
            (s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes()), len(ids))
            for s in cuts for _ in range(copies))
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_sequence


def test_given_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = packing.pack(docs, group_docs=50).collect()
    sequences = check(rows, {r.doc_id: (r.text, 1) for r in docs.collect()}, 1024)
    used = sum(r.length for r in rows)
    assert used / (1024 * len(sequences)) > 0.95


def test_odd_rows(frame):
    texts = {1: "", 2: "a" * 9000 + " b" * 9000, 3: "<|endoftext|> it's", 4: "Größe 🙂\n\n x"}
    docs = frame("doc_id long, text string, copy string, part string, length string",
                 *[(k, v, "1", "1", "1") for k, v in texts.items()],
                 (None, None, None, None, None), *[(5, "same row", "2", "2", "2")] * 30)
    rows = packing.pack(docs, group_docs=4).collect()
    want = {k: (v, 1) for k, v in texts.items()} | {None: ("", 1), 5: ("same row", 30)}
    check(rows, want, 1024)
    assert len({r.sequence_id >> 32 for r in rows if r.doc_id == 5}) > 2
    kept = packing.pack(docs, group_docs=4, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in kept)


def test_empty_table(frame):
    assert packing.pack(frame("doc_id long, text string")).count() == 0


def test_vocabulary_file_gives_the_ids_of_the_library():
    encoding, tokenizer = byte_bpe.load(PATH), library()
    for text in ("it's 'sab\n\n  x   y", "déjà <|endoftext|> 123", "\x1c\x00 ~" * 50):
        assert byte_bpe.encode_text(encoding, text).tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_as_the_library_does_by_default(spark, frame):
    tokenizer, end = Tokenizer.from_file(PATH), "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f"x  \n{end}\n\n y{end}", f"<|endoftext|{end}|>",
             f"it's {'long ' * 40_000}{end} {'long ' * 40_000}", "none", f"日本{end}語"]
    docs = frame("doc_id long, text string", *enumerate(texts))
    want = {i: tokenizer.encode(x, add_special_tokens=False).ids + [packing.END_ID]
            for i, x in enumerate(texts)}
    assert want[0] == [64, 220, 50256, 275, 0]
    got = {}
    for r in sorted(packing.pack(docs, with_ids=True, added=True).collect(),
                    key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert got == want


def test_query_and_pipeline_give_added_tokens_their_ids(spark, frame, tmp_path):
    docs = frame("doc_id long, text string", (1, "a <|endoftext|> b"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = np.array([64, 220, 50256, 275, 0], "<u4").tobytes()
    for rows in (queries.op6_packing(spark, str(tmp_path)),
                 corpus_pipeline.pack(spark, docs, str(tmp_path))):
        assert [(r.doc_tokens, r.ids_crc32) for r in rows.collect()] == [(5, zlib.crc32(ids))]
