"""Secret scan: fixed rules for known forms, and two character Markov models, of random strings and of ordinary
identifiers, whose log-likelihood ratio finds further ones."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import ready, rows_out, texts_of

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: The base kinds in the order in which equal starts are listed, and the models' kind.
KINDS = ("assign", "access", "hex")
MODEL = "random"
#: What stands for a secret in a masked text.
MASK = "[secret]"
#: Runs that the models judge: long, and not a piece of a longer word in any script.
RUN = re.compile(r"(?<![\w+/=-])[A-Za-z0-9+/_=-]{16,}(?![\w+/=-])")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
PLACE = {c: i for i, c in enumerate(LETTERS)}
EDGE = len(LETTERS)
#: Documents whose runs are the labelled samples; seeded random strings of each alphabet that are added to them.
SAMPLE_DOCS, MADE = 20_000, 1500
ALPHABETS = {"hex": LETTERS[52:62] + "abcdef", "base32": LETTERS[:26] + "234567", "base62": LETTERS[:62],
             "base64": LETTERS[:64], "url": LETTERS[:62] + "_-"}
FOUND = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                   ("n_random", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def base_spans(text):
    """(start, kind's place, end) of all base matches, leftmost and not overlapping within a kind."""
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return sorted(spans)


def joined(spans, kinds):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def codes_of(string):
    return [EDGE, *[PLACE.get(c, EDGE) for c in string], EDGE]


class Markov:
    """Log-probability of a string by its character pairs, start and end included, with add-half smoothing."""

    def __init__(self, strings):
        counts = np.full((EDGE + 1, EDGE + 1), 0.5)
        for string in strings:
            at = codes_of(string)
            np.add.at(counts, (at[:-1], at[1:]), 1)
        self.log = np.log(counts / counts.sum(1, keepdims=True))


class Judge:
    """The two models and the ratio per character from which on a run counts as random."""

    def __init__(self, random, ordinary):
        self.ratio = Markov(random).log - Markov(ordinary).log
        scores = np.sort([self.score(s) for s in ordinary]) if ordinary else np.zeros(1)
        caught = np.sort([self.score(s) for s in random]) if random else np.zeros(1)
        top = scores[int(0.9995 * (len(scores) - 1))]
        self.least = max(0.25, min(1.0, float((top + caught[int(0.05 * (len(caught) - 1))]) / 2)))

    def score(self, string):
        at = codes_of(string)
        return float(self.ratio[at[:-1], at[1:]].mean())

    def is_random(self, string):
        return self.score(string) >= self.least


def made_strings(rng, each=MADE):
    """Seeded random strings of 16 to 48 characters in the usual alphabets."""
    for letters in ALPHABETS.values():
        for _ in range(each):
            yield "".join(rng.choice(list(letters), rng.integers(16, 49)))


def labelled_runs(docs, sample=SAMPLE_DOCS):
    """(string, is_random) from a sample of documents, the first by a hash of doc_id: runs that base rules find are random, other runs and long
    words are ordinary."""

    def label(batches):
        for batch in batches:
            strings, random = [], []
            for text in batch["text"].to_pylist():
                spans = base_spans(text)
                covered = [(a, b) for a, _, b in spans]
                for a, kind, b in spans:
                    value = text[a:b] if kind else ASSIGN.match(text, a)[2]
                    strings.append(value[:256])
                    random.append(True)
                for m in re.finditer(r"(?<![\w+/=-])[A-Za-z0-9+/_=-]{12,256}(?![\w+/=-])", text):
                    if not any(a < m.end() and m.start() < b for a, b in covered):
                        strings.append(m[0])
                        random.append(False)
            yield pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(random, pa.bool_())],
                                             names=["string", "is_random"])

    ready(docs.sparkSession)
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(sample)
    own = texts_of(docs, "doc_id").join(F.broadcast(chosen), "doc_id", "left_semi")
    return own.mapInArrow(label, "string string, is_random boolean")


def train(samples, most=40_000, seed=5):
    """A judge from labelled samples (string, is_random): at most `most` of each label, distinct, the first by a hash."""
    def some(flag):
        own = samples.where(F.col("is_random") == flag).select("string").distinct()
        return [r["string"] for r in own.orderBy(F.xxhash64("string"), "string").limit(most).collect()]

    random, ordinary = some(True), some(False)
    return Judge(random + list(made_strings(np.random.default_rng(seed))), ordinary)


def model_spans(text, base, judge):
    """What the models add to the base spans."""
    return [(m.start(), 3, m.end()) for m in RUN.finditer(text)
            if not any(a < m.end() and m.start() < b for a, _, b in base) and judge.is_random(m[0])]


def masked(text, spans, mark=MASK):
    """The text with every stretch of overlapping spans replaced by a mark."""
    parts, at, last = [], 0, -1
    for a, _, b in sorted(spans):
        if a >= last:
            parts += [text[at:a], mark]
        last = max(last, b)
        at = last
    return "".join([*parts, text[at:]])


def mask(docs, judge):
    """The documents with their secrets masked, all columns as they were but text and, where it counts characters,
    n_chars. Null stays null, and a text without secrets stays as it is."""
    names = docs.columns
    at = names.index("text")

    def changed(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = []
            for text in texts:
                base = base_spans(text or "")
                spans = base + model_spans(text or "", base, judge)
                new.append(masked(text, spans) if spans else text)
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                counts = columns[k].to_pylist()
                columns[k] = pa.array([len(b) if a is not b else n for a, b, n in zip(texts, new, counts)],
                                      batch.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    ready(docs.sparkSession)
    return docs.mapInArrow(changed, docs.schema)


def scan(docs, judge):
    """Secrets of every whole text, one row per document.

    Base spans stay as they are; the models add runs of 16 or more characters that overlap no base span and look more
    random than ordinary. Null and empty texts have none; repeated and null doc_ids keep their own rows; other columns
    are ignored; an empty table gives no rows. Spans count code points, the end exclusive, as kind:start:end by start.
    """
    kinds = (*KINDS, MODEL)

    def found(batches):
        for batch in batches:
            columns = [[] for _ in FOUND]
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                base = base_spans(text)
                more = model_spans(text, base, judge)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                digest = hashlib.sha256(joined(base, kinds).encode()).hexdigest()
                row = [doc_id, *counts, len(more), digest, joined(sorted(base + more), kinds)]
                for column, value in zip(columns, row):
                    column.append(value)
            yield rows_out(FOUND, columns)

    ready(docs.sparkSession)
    return texts_of(docs, "doc_id").mapInArrow(
        found, "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")
