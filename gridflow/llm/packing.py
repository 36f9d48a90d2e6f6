"""Hierarchical packing: documents are routed to context-size tiers, each tier is packed, gaps of long windows are filled
from shorter tiers, and sequences are dealt to step groups of equal token counts."""

import heapq
import zlib
from bisect import bisect_right, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import types as T

from .common import ready, rows_out, texts_of
from .tokens import encoder

TIERS = (512, 1024, 2048, 4096)
#: Documents, or tokens, that are packed together in one task's memory.
BLOCK_DOCS, BLOCK_TOKENS = 8192, 4_000_000
#: Tokens of a training step.
STEP_TOKENS = 64 * 4096

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
    ("sequence_tokens", pa.int32()), ("step_group", pa.int64())])


def route(length, tiers=TIERS):
    """The shortest tier that holds a whole piece of this length."""
    return next(t for t in tiers if length <= t)


def pack_lengths(lengths, tiers=TIERS):
    """Sequences for documents of the given lengths: a list of (tier, [(document, start, length), ...]).

    Whole longest windows come first. What is left of each document goes to the shortest tier that holds it. From the
    longest tier down, a window takes its own tier's piece and fills its gap with the longest pieces that fit; where
    none fits, it cuts the shortest. What the last window lacks is not padded: its content is cut into powers of two.
    """
    longest, made, pool = tiers[-1], [], []
    for doc, length in enumerate(lengths):
        full = length // longest * longest
        made += [(longest, [(doc, start, longest)]) for start in range(0, full, longest)]
        if length > full:
            pool.append((length - full, doc, full))
    pool.sort()
    while pool:
        length, doc, start = pool.pop()
        tier = route(length, tiers)
        window, gap = [(doc, start, length)], tier - length
        while gap and pool:
            at = bisect_right(pool, (gap, float("inf"), 0)) - 1
            length, doc, start = pool.pop(max(at, 0))
            taken = min(length, gap)
            window.append((doc, start, taken))
            gap -= taken
            if taken < length:
                insort(pool, (length - taken, doc, start + taken))
        made += [(tier, window)] if not gap else [(tier, part) for part in powers_of_two(window)]
    return made


def powers_of_two(window):
    """The pieces of an unfinished window as sequences whose lengths are powers of two, longest first."""
    total, parts, at = sum(p[2] for p in window), [], 0
    for bit in reversed(range(total.bit_length())):
        need, part = total & (1 << bit), []
        while need:
            doc, start, length = window[at]
            taken = min(length, need)
            part.append((doc, start, taken))
            need -= taken
            if taken == length:
                at += 1
            else:
                window[at] = (doc, start + taken, length - taken)
        if part:
            parts.append(part)
    return parts


def step_groups(sizes, step_tokens=STEP_TOKENS):
    """A group for each sequence: the longest first, always to the group with the fewest tokens so far."""
    groups = [(0, g) for g in range(max(1, round(sum(sizes) / step_tokens)))]
    dealt = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        tokens, group = heapq.heappop(groups)
        dealt[i] = group
        heapq.heappush(groups, (tokens + sizes[i], group))
    return dealt


def pack(docs, tokenizer, end_id, with_ids=False, tiers=TIERS):
    """Pack all documents (doc_id, text) into sequences; one row per piece.

    Null text counts as empty, so such a document is just its end id; repeated and null doc_ids are documents of their
    own; other columns are ignored; an empty table gives no rows. Documents are packed in blocks of at most 8192
    documents or 4 million tokens (a longer one is a block of its own), inside the task that tokenizes them: nothing is
    shuffled, and since unfinished windows are cut into powers of two, nothing is padded at a block's end either.
    sequence_id and step_group carry the partition's number, so the table should be stable (a file, or a written table).
    """
    schema = PIECES.append(pa.field("ids", pa.binary())) if with_ids else PIECES
    end = end_id.to_bytes(4, "little")

    def block_rows(doc_ids, ids, base):
        lengths = [len(b) // 4 for b in ids]
        made = pack_lengths(lengths, tiers)
        sizes = [sum(p[2] for p in window) for _, window in made]
        groups = step_groups(sizes)
        columns = [[] for _ in schema]
        for k, (tier, window) in enumerate(made):
            offset = 0
            for doc, start, length in window:
                own = ids[doc][4 * start:4 * (start + length)]
                row = [doc_ids[doc], start, length, zlib.crc32(own), lengths[doc], base + k, offset, tier, sizes[k],
                       base + groups[k]]
                for column, value in zip(columns, row + [own] * with_ids):
                    column.append(value)
                offset += length
        return rows_out(schema, columns), len(made)

    def packed(batches):
        codes = encoder(tokenizer, drops_space=True)
        base, doc_ids, ids, tokens = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in batches:
            for doc_id, own in zip(batch["doc_id"].to_pylist(), codes.encode(batch["text"].to_pylist())):
                doc_ids.append(doc_id)
                ids.append(own + end)
                tokens += len(own) // 4 + 1
                if len(ids) >= BLOCK_DOCS or tokens >= BLOCK_TOKENS:
                    rows, made = block_rows(doc_ids, ids, base)
                    yield rows
                    base, doc_ids, ids, tokens = base + made, [], [], 0
        if ids:
            yield block_rows(doc_ids, ids, base)[0]

    ready(docs.sparkSession)
    kinds = {pa.int64(): T.LongType(), pa.int32(): T.IntegerType(), pa.binary(): T.BinaryType()}
    out = T.StructType([T.StructField(f.name, kinds[f.type]) for f in schema])
    return texts_of(docs, "doc_id").mapInArrow(packed, out)
