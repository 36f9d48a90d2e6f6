"""Encoding by content-defined chunks: a chunk that documents share is encoded once, and where chunks meet, ids are
repaired by encoding anew up to the places where both sides must agree."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from .common import ready, rows_out, texts_of
from .tokens import byte_strings, encoder

#: Bytes of a chunk: at least, on average about (a power of two) more than that, and at most.
LEAST, MORE_BITS, MOST = 256, 10, 8192
#: Bytes of chunks that a worker remembers.
STORE_BYTES = 48_000_000
#: The rolling hash's value of each byte.
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
#: A place that the tokenizer always splits: before a blank or line end that follows something else.
FIRST, LAST = re.compile(r"\S(?=[ \n])"), re.compile(r"(?s).*\S(?=[ \n])")
CUT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("cuts", pa.list_(pa.int32())), ("route", pa.int64())])
ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                     ("decoded_sha256", pa.string())])


def rolling(data):
    """A hash of the 32 bytes that end at each place, by doubling the window five times."""
    h = GEAR[data]
    for shift in (1, 2, 4, 8, 16):
        wider = h.copy()
        wider[shift:] += h[:-shift] << np.uint32(shift)
        h = wider
    return h


def cut_places(raws):
    """For each byte string, the ends of its chunks; a chunk ends between characters."""
    data = np.frombuffer(b"".join(raws), np.uint8)
    marks = np.flatnonzero(rolling(data) >> np.uint32(32 - MORE_BITS) == 0) + 1 if len(data) else np.zeros(0, int)
    ends, begin = [], 0
    for raw in raws:
        size, at, own = len(raw), 0, []
        near = marks[np.searchsorted(marks, begin + LEAST):np.searchsorted(marks, begin + size)] - begin
        for place in [*near.tolist(), size]:
            if place < at + LEAST and place < size:
                continue
            while place - at > MOST:
                at = past_character(raw, at + MOST)
                own.append(at)
            place = past_character(raw, place)
            if place > at:
                own.append(place)
                at = place
        ends.append(own)
        begin += size
    return ends


def past_character(raw, place):
    while place < len(raw) and raw[place] & 0xC0 == 0x80:
        place += 1
    return place


class ChunkStore:
    """The ids of chunks by their bytes. A chunk is (head, ids, tail): the ids are those of the text between its first
    and last sure split; head and tail depend on the neighbours. None: it has no sure split."""

    def __init__(self, codes, most=STORE_BYTES):
        self.codes, self.most, self.size, self.known, self.encoded = codes, most, 0, {}, 0

    def learn(self, chunks):
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if self.size > self.most:
            self.known, self.size, new = {}, 0, list(dict.fromkeys(chunks))
        texts = [c.decode() for c in new]
        spans = []
        for text in texts:
            first = FIRST.search(text)
            spans.append((first.end(), LAST.match(text).end()) if first else None)
        bodies = self.codes.encode([t[s[0]:s[1]] for t, s in zip(texts, spans) if s])
        for chunk, text, span in zip(new, texts, spans):
            self.known[chunk] = (text[:span[0]], bodies.pop(0), text[span[1]:]) if span else None
        self.size += sum(map(len, new))
        self.encoded += len(new)

    def encode(self, documents):
        """The ids of documents, each a list of chunks (bytes)."""
        self.learn([c for chunks in documents for c in chunks])
        laid, joins = [], []
        for chunks in documents:
            parts, open_text = [], ""
            for chunk in chunks:
                if (held := self.known[chunk]) is None:
                    open_text += chunk.decode()
                    continue
                head, ids, tail = held
                parts += [len(joins), ids]
                joins.append(open_text + head)
                open_text = tail
            parts.append(len(joins))
            joins.append(open_text)
            laid.append(parts)
        repaired = self.codes.encode(joins)
        return [b"".join(repaired[p] if isinstance(p, int) else p for p in parts) for parts in laid]


_stores = {}


def store_of(tokenizer):
    if tokenizer not in _stores:
        _stores[tokenizer] = (ChunkStore(encoder(tokenizer, drops_space=False)), byte_strings(tokenizer))
    return _stores[tokenizer]


def encode_chunked(docs, tokenizer):
    """Encode every whole text and decode it again: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    Null text counts as empty (no ids); repeated and null doc_ids keep their own rows; other columns are ignored; an
    empty table gives none. Documents are dealt out by the smallest hash among their chunks, so that documents with
    the same chunks mostly meet in one task, whose store encodes each chunk once. Adaptive execution splits a hot
    route and joins small ones; the result does not depend on who meets whom.
    """

    def cut(batches):
        for batch in batches:
            raws = [t.encode() for t in batch["text"].to_pylist()]
            ends = cut_places(raws)
            routes = []
            for raw, own in zip(raws, ends):
                hashes = [xxhash.xxh3_64_intdigest(raw[a:b]) >> 1 for a, b in zip([0, *own], own)]
                routes.append(min(hashes, default=0))
            yield rows_out(CUT, [batch["doc_id"].cast(pa.int64()), batch["text"].cast(pa.string()), ends, routes])

    def encoded(batches):
        store, table = store_of(tokenizer)
        for batch in batches:
            documents = []
            for text, own in zip(batch["text"].to_pylist(), batch["cuts"].to_pylist()):
                raw = text.encode()
                documents.append([raw[a:b] for a, b in zip([0, *own], own)])
            ids = store.encode(documents)
            back = [b"".join(map(table.__getitem__, np.frombuffer(i, "<u4").tolist())).decode("utf-8", "replace")
                    for i in ids]
            yield rows_out(ENCODED, [batch["doc_id"], [len(i) // 4 for i in ids],
                                     [hashlib.sha256(i).hexdigest() for i in ids],
                                     [hashlib.sha256(b.encode()).hexdigest() for b in back]])

    ready(docs.sparkSession)
    pieces = texts_of(docs, "doc_id").mapInArrow(cut, "doc_id long, text string, cuts array<int>, route long")
    dealt = pieces.hint("rebalance", F.col("route"))
    return dealt.select("doc_id", "text", "cuts").mapInArrow(
        encoded, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
