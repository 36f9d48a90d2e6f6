"""Personal data: fixed rules for four kinds, and a character-level bidirectional LSTM with CRF transitions, trained in
numpy from labelled spans, whose overlapping windows are joined before one decoding of each stretch."""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import ready, rows_out, texts_of

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
#: What every kind contains: no stretch without one of these characters can hold personal data.
TRIGGER = re.compile(r"[0-9@]+")
#: Characters of a window, and how far one begins after the other.
WINDOW, STRIDE = 64, 32
#: Documents whose labelled spans train the network, windows of each kind of content, hidden units a direction, steps.
SAMPLE_DOCS, WINDOWS, HIDDEN, STEPS = 20_000, 800, 20, 400
#: Tags: outside, then begin and inside of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Character codes: 0 padding, 1 any other, 2 a letter beyond ASCII, then ASCII.
CODES = 3 + 128
#: Lowest mean probability of the tags of a span that the network adds.
SURE = 0.9
FOUND = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("n_added", pa.int64()),
                   ("base_sha256", pa.string()), ("spans", pa.string())])


def digits(text):
    return NOT_DIGIT.sub("", text)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text):
    """Leftmost matches, found from each @ outwards so that long runs cost no more than their length."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text):
    """(start, kind's place, end) of all base matches, leftmost and not overlapping within a kind."""
    spans = [(a, 0, b) for a, b in emails(text)]
    if not TRIGGER.search(text):
        return spans
    for m in IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            number = digits(m[0])
            if 12 <= len(number) <= 19 and luhn(number):
                spans.append((m.start(), 2, m.end()))
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(spans)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def could_be(kind, text):
    """The loose form that an added span must have."""
    n = len(digits(text))
    if kind == 0:
        return bool(re.fullmatch(r"\S+@\S+", text))
    if kind == 1:
        return bool(re.fullmatch(r"[0-9]{1,3}(?:\s*[.:]\s*[0-9]{1,3}){3}", text))
    return 12 <= n <= 19 if kind == 2 else 9 <= n <= 15


def codes_of(text):
    return np.array([3 + ord(c) if ord(c) < 128 else 2 if c.isalpha() else 1 for c in text], np.int32)


def stretches(text):
    """The parts of a text around its triggers, half a window to each side, joined where they meet."""
    parts = []
    for m in TRIGGER.finditer(text):
        a, b = max(0, m.start() - STRIDE), min(len(text), m.end() + STRIDE)
        if parts and a <= parts[-1][1]:
            parts[-1] = (parts[-1][0], b)
        else:
            parts.append((a, b))
    return parts


def window_starts(length):
    """Where the windows of a stretch begin: every half window, and none past what is needed to reach the end."""
    return range(0, max(1, length - WINDOW + STRIDE), STRIDE)


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """The network. `w` holds, per direction, input rows by character code, recurrent weights, and bias; then the output
    layer and the CRF's transitions and starts."""

    def __init__(self, seed=11, hidden=HIDDEN):
        rng, h = np.random.default_rng(seed), hidden
        self.h = h
        self.w = {"out": rng.normal(0, 0.1, (2 * h, TAGS)), "out_b": np.zeros(TAGS),
                  "move": rng.normal(0, 0.01, (TAGS, TAGS)), "start": np.zeros(TAGS)}
        for d in "fb":
            self.w["in" + d] = rng.normal(0, 0.3, (CODES, 4 * h))
            self.w["re" + d] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h))
            self.w["bi" + d] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])

    def run(self, x, d, keep=False):
        """Hidden states (time, batch, h) of one direction over codes (batch, time)."""
        h, steps = self.h, x.shape[1]
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        into, back, bias = self.w["in" + d], self.w["re" + d], self.w["bi" + d]
        state, cell = np.zeros((len(x), h)), np.zeros((len(x), h))
        out, tape = np.zeros((steps, len(x), h)), []
        for t in order:
            z = into[x[:, t]] + state @ back + bias
            gates, new = sigmoid(z[:, :3 * h]), np.tanh(z[:, 3 * h:])
            i, f, o = gates[:, :h], gates[:, h:2 * h], gates[:, 2 * h:]
            before, was = cell, state
            cell = f * before + i * new
            squashed = np.tanh(cell)
            state = o * squashed
            out[t] = state
            if keep:
                tape.append((t, i, f, o, new, before, squashed, was))
        return (out, tape) if keep else out

    def run_back(self, x, d, tape, grad, into):
        """Gradients of one direction, put into `into`; grad is (time, batch, h)."""
        back, at, dzs = self.w["re" + d].T, [], []
        d_state, d_cell = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        for t, i, f, o, new, before, squashed, _ in reversed(tape):
            ds = grad[t] + d_state
            dc = d_cell + ds * o * (1 - squashed * squashed)
            dz = np.concatenate([dc * new * i * (1 - i), dc * before * f * (1 - f), ds * squashed * o * (1 - o),
                                 dc * i * (1 - new * new)], axis=1)
            at.append(t)
            dzs.append(dz)
            d_state, d_cell = dz @ back, dc * f
        flat = np.concatenate(dzs)
        seen = np.zeros((len(flat), CODES))
        seen[np.arange(len(flat)), x[:, at].T.ravel()] = 1
        into["in" + d] = seen.T @ flat
        into["re" + d] = np.concatenate([step[7] for step in reversed(tape)]).T @ flat
        into["bi" + d] = flat.sum(0)

    def emissions(self, x):
        """Scores of the tags (batch, time, tags)."""
        both = np.concatenate([self.run(x, "f"), self.run(x, "b")], axis=2)
        return (both @ self.w["out"] + self.w["out_b"]).transpose(1, 0, 2)

    def gradients(self, x, tags, real):
        """Loss and gradients of the CRF's negative log-likelihood, by the scaled forward and backward pass; `real`
        marks characters that are no padding, which only stands at a window's end."""
        (hf, tf), (hb, tb) = self.run(x, "f", True), self.run(x, "b", True)
        both = np.concatenate([hf, hb], axis=2)
        e = both @ self.w["out"] + self.w["out_b"]
        steps, n, rows, on = x.shape[1], len(x), np.arange(len(x)), real.T
        top = e.max(2, keepdims=True)
        local, move, start = np.exp(e - top), np.exp(self.w["move"]), np.exp(self.w["start"])
        alpha, beta, scale = np.zeros_like(e), np.ones_like(e), np.ones((steps, n))
        for t in range(steps):
            a = (alpha[t - 1] @ move if t else start) * local[t]
            scale[t] = np.where(on[t], a.sum(1), 1)
            alpha[t] = np.where(on[t][:, None], a / scale[t][:, None], alpha[t - 1])
        ahead = np.zeros_like(e)
        for t in range(steps - 1, 0, -1):
            ahead[t] = local[t] * beta[t] / scale[t][:, None] * on[t][:, None]
            beta[t - 1] = np.where(on[t][:, None], ahead[t] @ move.T, beta[t])
        gold = np.zeros_like(e)
        np.put_along_axis(gold, tags.T[:, :, None], 1.0, 2)
        gold *= on[:, :, None]
        de = alpha * beta * on[:, :, None] - gold
        g = {"start": de[0].sum(0), "out_b": de.sum((0, 1)), "out": both.reshape(-1, both.shape[2]).T @ de.reshape(-1, TAGS)}
        pairs = np.tensordot(alpha[:-1], ahead[1:], ((0, 1), (0, 1))) * move
        g["move"] = pairs - np.tensordot(gold[:-1] * on[1:, :, None], gold[1:], ((0, 1), (0, 1)))
        steps_gold = self.w["move"][tags.T[:-1], tags.T[1:]] * on[1:]
        total = (np.log(scale) + top[:, :, 0] * on).sum()
        loss = total - (e * gold).sum() - steps_gold.sum() - self.w["start"][tags[:, 0]].sum()
        d_both = de @ self.w["out"].T
        self.run_back(x, "f", tf, d_both[:, :, :self.h], g)
        self.run_back(x, "b", tb, d_both[:, :, self.h:], g)
        return float(loss / n), {k: v / n for k, v in g.items()}

    def fit(self, x, tags, real, steps=STEPS, batch=32, rate=0.03, seed=1):
        """Adam over shuffled batches, a fixed number of steps; the rate falls to a tenth."""
        rng, mean, square, step, last = np.random.default_rng(seed), {}, {}, 0, steps
        while step < steps:
            order = rng.permutation(len(x))
            for a in range(0, min(len(x), (steps - step) * batch), batch):
                own = order[a:a + batch]
                self.loss, g = self.gradients(x[own], tags[own], real[own])
                step += 1
                for k, v in g.items():
                    v = np.clip(v, -1, 1)
                    mean[k] = 0.9 * mean.get(k, 0) + 0.1 * v
                    square[k] = 0.999 * square.get(k, 0) + 0.001 * v * v
                    self.w[k] -= rate * (1 - 0.9 * step / last) * (mean[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def joint_emissions(self, texts):
        """Scores for every character of each stretch: windows overlap by half, and where they do their scores are
        averaged, those near a window's middle counting most."""
        codes = [codes_of(t) for t in texts]
        at = [(k, s) for k, c in enumerate(codes) for s in window_starts(len(c))]
        weight = 1.0 + np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1])
        sums = [np.zeros((len(c), TAGS)) for c in codes]
        shares = [np.zeros(len(c)) for c in codes]
        for a in range(0, len(at), 256):
            x = np.zeros((len(at[a:a + 256]), WINDOW), np.int32)
            for row, (k, s) in zip(x, at[a:a + 256]):
                row[:len(codes[k][s:s + WINDOW])] = codes[k][s:s + WINDOW]
            for scores, (k, s) in zip(self.emissions(x), at[a:a + 256]):
                n = len(codes[k][s:s + WINDOW])
                sums[k][s:s + n] += scores[:n] * weight[:n, None]
                shares[k][s:s + n] += weight[:n]
        return [s / w[:, None] for s, w in zip(sums, shares)]

    def decode(self, scores):
        """The best tags of a whole stretch by Viterbi."""
        move, best, came = self.w["move"], self.w["start"] + scores[0], []
        for e in scores[1:]:
            paths = best[:, None] + move
            came.append(paths.argmax(0))
            best = paths.max(0) + e
        tags = [int(best.argmax())]
        for step in reversed(came):
            tags.append(int(step[tags[-1]]))
        return tags[::-1]

    def spans(self, text, offset, scores):
        """(start, kind, end) of the decoded spans that are sure enough and have their kind's loose form."""
        tags, out, a = self.decode(scores), [], 0
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        while a < len(tags):
            kind, b = (tags[a] - 1) // 2, a + 1
            if tags[a]:
                while b < len(tags) and tags[b] == 2 + 2 * kind:
                    b += 1
                if p[np.arange(a, b), tags[a:b]].mean() >= SURE and could_be(kind, text[a:b]):
                    out.append((offset + a, kind, offset + b))
            a = b
        return out


def tags_of(spans, start, length):
    """Tags of a window from the base spans of its text; where kinds overlap, the first listed counts."""
    tags = np.zeros(length, np.int64)
    for a, kind, b in sorted(spans, key=lambda s: -s[1]):
        a, b = max(a - start, 0), min(b - start, length)
        if a < b:
            tags[a:b] = 2 + 2 * kind
            tags[a] = 1 + 2 * kind
    return tags


def labelled_windows(docs, sample=SAMPLE_DOCS):
    """(window, tags, kind) from a sample of documents, the first by a hash of doc_id; kind -1: nothing is in it."""

    def label(batches):
        for batch in batches:
            windows, tags, kinds = [], [], []
            for text in batch["text"].to_pylist():
                spans = base_spans(text)
                for a, b in stretches(text):
                    for s in window_starts(b - a):
                        window = text[a + s:min(a + s + WINDOW, b)]
                        own = tags_of(spans, a + s, len(window))
                        windows.append(window)
                        tags.append(own.tolist())
                        kinds.append(int((own.max() - 1) // 2))
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), pa.array(tags, pa.list_(pa.int32())),
                                              pa.array(kinds, pa.int32())], names=["window", "tags", "kind"])

    ready(docs.sparkSession)
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id")).limit(sample)
    own = texts_of(docs, "doc_id").join(F.broadcast(chosen), "doc_id", "left_semi")
    return own.mapInArrow(label, "window string, tags array<int>, kind int")


def arrays_of(rows):
    x, tags = np.zeros((len(rows), WINDOW), np.int32), np.zeros((len(rows), WINDOW), np.int64)
    real = np.zeros((len(rows), WINDOW), bool)
    for i, row in enumerate(rows):
        n = len(row["window"])
        x[i, :n], tags[i, :n], real[i, :n] = codes_of(row["window"]), row["tags"], True
    return x, tags, real


def train(windows, most=WINDOWS, steps=STEPS):
    """A tagger from labelled windows, at most `most` distinct ones of each kind and of none; None without any."""
    rows = []
    for kind in range(-1, len(KINDS)):
        own = windows.where(F.col("kind") == kind).dropDuplicates(["window"])
        rows += own.orderBy(F.xxhash64("window"), "window").limit(most).collect()
    rows.sort(key=lambda r: r["window"])
    return Tagger().fit(*arrays_of(rows), steps=steps) if rows else None


def scan(docs, tagger):
    """Personal data of every whole text, one row per document.

    Base spans stay as they are; the network adds spans that overlap none of them. Windows cover every stretch within
    half a window of a digit or an @, without which no kind can occur. Null and empty texts have nothing; repeated and
    null doc_ids keep their own rows; other columns are ignored; an empty table gives no rows. Spans count code points,
    the end exclusive, as kind:start:end by start.
    """

    def found(batches):
        for batch in batches:
            texts = batch["text"].to_pylist()
            bases = [base_spans(t) for t in texts]
            parts = [(k, a, t[a:b]) for k, t in enumerate(texts) for a, b in stretches(t)] if tagger else []
            added = [[] for _ in texts]
            for (k, a, part), scores in zip(parts, tagger.joint_emissions([p for _, _, p in parts]) if parts else []):
                added[k] += [s for s in tagger.spans(part, a, scores)
                             if not any(s[0] < b[2] and b[0] < s[2] for b in bases[k])]
            counts = [[sum(s[1] == kind for s in base) for base in bases] for kind in range(len(KINDS))]
            yield rows_out(FOUND, [batch["doc_id"].cast(pa.int64()), *counts, [len(a) for a in added],
                                   [hashlib.sha256(joined(b).encode()).hexdigest() for b in bases],
                                   [joined(sorted(b + a)) for b, a in zip(bases, added)]])

    ready(docs.sparkSession)
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    return texts_of(docs, "doc_id").mapInArrow(
        found, f"doc_id long, {counted}, n_added long, base_sha256 string, spans string")
