"""Encoding, token shards and packing against the tokenizers library."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridflow.llm import chunks, grammar, packing
from gridflow.llm.common import Scratch
from gridflow.llm.tokens import Encoder, byte_strings, default_path
from .llm_corpus import corpus

BYTES, WORDS = default_path("byte_bpe_50k.json"), default_path("word_bpe_49k.json")
TEXT = st.text(alphabet=st.sampled_from(list(" \n\t\r.,'sd#*aB9éÉßüµ²½İ   \x1c中😀́")), max_size=60)
byte_codes, word_codes = Encoder(BYTES, False), Encoder(WORDS, True, limit=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_encoder_equals_the_library(texts):
    for codes in (byte_codes, word_codes):
        assert codes.encode(texts) == codes.library(texts)


def test_special_tokens_and_words():
    texts = ["<|endoftext|>", "a<|endoftext|>b c", *corpus(1, 60)]
    for codes in (byte_codes, word_codes):
        assert codes.encode(texts) == codes.library(texts)


def test_each_piece_is_learnt_once_when_first_looked_up():
    texts = [*corpus(5, 60), "Été, été: ÉTÉ? word word. word.. (word) \nword", "été word.", "\nword  word"]
    for path, drops_space in ((BYTES, False), (WORDS, True)):
        codes, asked = Encoder(path, drops_space), []
        learn = codes.known.learn
        codes.known.learn = lambda key: (asked.append(key), learn(key))[1]
        assert codes.encode(texts) == codes.encode(texts) == codes.library(texts)
        assert len(asked) == len(set(asked)) == len(codes.known)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=5), st.integers(0, 3))
def test_chunks_equal_whole_texts(texts, repeat):
    store, table = chunks.ChunkStore(byte_codes, most=2000), byte_strings(BYTES)
    texts = [t * (1 + 40 * repeat) for t in texts] + [" ".join(texts) * 3]
    raws = [t.encode() for t in texts]
    ends = chunks.cut_places(raws)
    parts = [[r[a:b] for a, b in zip([0, *e], e)] for r, e in zip(raws, ends)]
    assert [b"".join(p) for p in parts] == raws and all(len(c) <= chunks.MOST + 4 for p in parts for c in p)
    ids = store.encode(parts)
    assert ids == byte_codes.library(texts)
    for text, own in zip(texts, ids):
        numbers = np.frombuffer(own, "<u4").tolist()
        assert b"".join(table[i] for i in numbers).decode() == text
        assert byte_codes.tokenizer.decode(numbers, skip_special_tokens=False) == text


def test_shared_chunks_are_encoded_once():
    passage = " ".join(corpus(2, 200))[:40_000]
    raws = [("x" * k + passage).encode() for k in range(5)]
    parts = [[r[a:b] for a, b in zip([0, *e], e)] for r, e in zip(raws, chunks.cut_places(raws))]
    store = chunks.ChunkStore(byte_codes)
    store.encode(parts)
    assert store.encoded < sum(map(len, parts)) / 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=60), min_size=1, max_size=8), st.integers(2, 6))
def test_grammar_round_trip(documents, least):
    flat = np.concatenate([np.array(d, np.uint32) for d in documents])
    starts = np.zeros(len(flat), bool)
    starts[np.cumsum([0, *map(len, documents[:-1])])] = True
    symbols, marks, left, right = grammar.replace_pairs(flat, starts, 6, least, saved=0)
    rules = grammar.expansions(left, right, 6)
    assert np.array_equal(grammar.expand(symbols, rules, 6), flat)
    assert marks.sum() == len(documents)
    assert [len(grammar.expand(np.array([6 + i]), rules, 6)) for i in range(len(left))] == rules[2].tolist()


def test_grammar_shrinks_and_reads_anywhere():
    texts = corpus(3, 300)
    ids = [b + b"\0\0\0\0" for b in byte_codes.encode(texts * 4)]
    shard = grammar.Shard(grammar.write_shard([None, *range(1, len(ids))], ids, 50257))
    assert len(shard.symbols) < 0.6 * sum(map(len, ids)) / 4
    rng = np.random.default_rng(1)
    assert shard.doc_ids[0] is None
    for doc in rng.integers(0, len(ids), 40).tolist():
        own = np.frombuffer(ids[doc], "<u4")
        a, b = sorted(rng.integers(0, len(own) + 1, 2).tolist())
        assert np.array_equal(shard.ids(doc), own) and np.array_equal(shard.ids(doc, a, b - a), own[a:b])


def rows_by(frame):
    return [r.asDict() for r in frame.collect()]


def test_token_shards(spark, odd_docs):
    written = Scratch(spark, "t").save(grammar.encode_shards(odd_docs, BYTES, 0, 50257), "shards")
    found = sorted(rows_by(grammar.read_documents(written)), key=lambda r: r["start"])
    docs = [(r.doc_id, r.text or "") for r in odd_docs.collect()]
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d or 0))
    sums = defaultdict(list)
    for doc, text in docs:
        sums[doc].append(zlib.crc32(byte_codes.library([text])[0] + b"\0\0\0\0"))
    at = 0
    for r in found:
        assert r["start"] == at and r["ids_crc32"] in sums[r["doc_id"]]
        at += r["n_tokens"]


def test_chunked_query(odd_docs):
    found = rows_by(chunks.encode_chunked(odd_docs, BYTES))
    wanted = []
    for r in odd_docs.collect():
        ids = byte_codes.library([r.text or ""])[0]
        wanted.append((r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                       hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(str, (tuple(r.values()) for r in found))) == sorted(map(str, wanted))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=40), st.booleans())
def test_packing_places_every_token_once(lengths, scaled):
    lengths = [n * 30 if scaled and n % 7 == 0 else n for n in lengths]
    covered = [[] for _ in lengths]
    for tier, window in packing.pack_lengths(lengths):
        total = sum(p[2] for p in window)
        assert total <= tier and total & (total - 1) == 0
        for doc, start, length in window:
            assert length > 0
            covered[doc].append((start, length))
    for n, pieces in zip(lengths, covered):
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == n


def test_step_groups_are_balanced():
    sizes = [4096] * 100 + [2048] * 50 + [512] * 301 + [1, 2, 4]
    dealt = packing.step_groups(sizes, 65536)
    loads = [sum(s for s, g in zip(sizes, dealt) if g == k) for k in range(max(dealt) + 1)]
    assert max(loads) - min(loads) <= 512 and len(loads) == round(sum(sizes) / 65536)


def test_packed_documents(odd_docs):
    found = packing.pack(odd_docs, WORDS, 2, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == own[0].sequence_tokens <= 4096 and at & (at - 1) == 0
    for r in odd_docs.where("doc_id is not null and doc_id <> 6").collect():
        ids = word_codes.library([r.text or ""])[0] + b"\2\0\0\0"
        assert b"".join(p.ids for p in sorted(pieces[r.doc_id], key=lambda p: p.start)) == ids
        assert all(p.doc_tokens == len(ids) // 4 for p in pieces[r.doc_id])
    assert sum(r.length for r in found if r.doc_id == 6) == 2 * found[[r.doc_id for r in found].index(6)].doc_tokens


def test_empty_tables(spark, no_docs):
    written = Scratch(spark, "t").save(grammar.encode_shards(no_docs, BYTES, 0, 50257), "shards")
    assert grammar.read_documents(written).isEmpty()
    assert chunks.encode_chunked(no_docs, BYTES).isEmpty() and packing.pack(no_docs, WORDS, 2).isEmpty()


@pytest.mark.parametrize("text", ["", "x", "é" * 10_000])
def test_cuts_end_between_characters(text):
    raw = text.encode()
    for part in zip([0, *chunks.cut_places([raw])[0]], chunks.cut_places([raw])[0]):
        raw[slice(*part)].decode()


def test_repair_of_runs_and_of_all_frequent_pairs():
    """A long run of one id does not end the grammar, and no pair that could still be replaced is left."""
    rng = np.random.default_rng(4)
    own = np.concatenate([np.full(4000, 7), np.tile([1, 2, 3], 60), rng.integers(10, 5000, 40_000)]).astype(np.uint32)
    starts = np.zeros(len(own), bool)
    starts[[0, 4000, 4180]] = True
    symbols, marks, left, right = grammar.replace_pairs(own, starts, 5000)
    assert (grammar.expand(symbols, grammar.expansions(left, right, 5000), 5000) == own).all() and marks.sum() == 3
    assert np.flatnonzero(marks)[1] < 100 and np.flatnonzero(marks)[2] - np.flatnonzero(marks)[1] < 100
