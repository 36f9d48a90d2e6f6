"""The filter audit and the source divergence audit against plain versions."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridflow.llm import divergence, filteraudit

LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4, 8, 9, 1000, 5003])
def test_positional_counts(count):
    words = np.random.default_rng(count).integers(0, 1 << 32, count, dtype=np.uint32)
    assert filteraudit.positional_counts(words).tolist() == [int((words >> i & 1).sum()) for i in range(32)]


def test_survival_words():
    for failed, word in enumerate(filteraudit.survival_words().tolist()):
        assert all((word >> s & 1) == (s & failed == 0) for s in range(32))


def plain_failures(rows):
    """The names of the filters that each row (doc_id, text, lang) fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        failed = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words))
        failed += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
        smaller = doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        out.append(failed + "E" * smaller)
    return out


def plain_audit(rows, labels):
    good, toxic = ({i for i, *l in labels if i is not None and l[k] == 1} for k in (0, 1))
    parts = defaultdict(list)
    for (doc_id, _, lang), failed in zip(rows, plain_failures(rows)):
        parts[lang or ""].append((doc_id, set(failed)))
    out, total = {}, Counter()
    for part, docs in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                before = set(order[:step - 1])
                removed = [i for i, f in docs if name in f and not f & before]
                out[part, order, step] = [
                    sum(not f & (before | {name}) for _, f in docs), len(removed),
                    sum(name in f and bool(f & before) for _, f in docs), sum(f == {name} for _, f in docs),
                    sum(i in good for i in removed), sum(i in toxic for i in removed)]
                total[part, name] += len(removed)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def filter_rows(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "#", "Z" * 500]
    for _ in range(60):
        words = rng.choices(["aa", "b", "ccc", "Dd", "EEE", "é", "f$", "　"], k=rng.choice([0, 5, 199, 200, 260]))
        texts.append(rng.choice([" ", "\n", "\x0b "]).join(words))
        texts.append(" ".join(f"w{rng.randrange(500)}" + "A" * rng.choice([0, 0, 0, 1]) for _ in range(rng.choice([199, 230]))))
    rows = [(i, rng.choice(texts), rng.choice(["x", "x", "y", None])) for i in range(200)]
    rows += [(None, texts[3], "x"), (None, texts[3], "x"), *rows[:4], (3, rows[5][1], "y"), (250, "long " * 200_000, "y")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 200, 2)]
    return rows, labels + [(None, 1, 1), (4, 1, 0), (4, 0, 1), (9999, 1, 1)]


def audit_frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], "doc_id long, text string, lang string, part int, digest string, "
                                                                "failed int").repartition(3)
    return docs, spark.createDataFrame([(*x, "t") for x in labels], "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("held", [1 << 18, 7])
def test_filter_audit(spark, held, monkeypatch):
    monkeypatch.setattr(filteraudit, "HELD_WORDS", held)
    rows, labels = filter_rows(4)
    found = filteraudit.audit(*audit_frames(spark, rows, labels)).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in found} == plain_audit(rows, labels)
    assert len(found) == 3 * 600


def test_filter_audit_of_empty_tables(spark):
    docs, labels = audit_frames(spark, *filter_rows(5))
    assert filteraudit.audit(docs.limit(0), labels).isEmpty()
    assert all(r.good_lost == r.toxic_lost == 0 for r in filteraudit.audit(docs, labels.limit(0)).collect())


def test_sorted_pointers():
    rng = random.Random(1)
    for _ in range(200):
        texts = ["".join(rng.choices(["a", "B", "ä", "zz", "abcdefgh", "abcdefghabcdefgh", " ", "-", "9", "中"],
                                     k=rng.choice([0, 1, 5, 30]))) for _ in range(rng.choice([0, 1, 3, 9]))]
        raw = [t.encode() for t in texts]
        group = np.sort(np.array([rng.randrange(3) for _ in texts], np.int64))
        terms, term, groups, counts, docs = divergence.count_shard(
            np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw]), group)
        occurs, within = Counter(), Counter()
        for text, own in zip(texts, group.tolist()):
            found = [t.translate(LOWER) for t in LETTERS.findall(text)]
            occurs.update((t, own) for t in found)
            within.update((t, own) for t in set(found))
        assert terms == sorted({t for t, _ in occurs}, key=str.encode)
        assert {(terms[a], b): (c, d) for a, b, c, d in zip(*(x.tolist() for x in (term, groups, counts, docs)))} == {
            k: (n, within[k]) for k, n in occurs.items()}


def test_shares_are_exact():
    for count, total in ((0, 2), (0, 3), (5, 12), (10 ** 15, 3 * 10 ** 15 + 7), (9 * 10 ** 15 - 4, 9 * 10 ** 15)):
        found = divergence.shares(np.array([count]), np.array([total]))
        assert found.tolist() == [1 + 10 ** 9 * (count + 2) // total]


def plain_divergence(rows):
    docs = [(lang or "", source or "", [t.translate(LOWER) for t in LETTERS.findall(text or "")]) for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [(s, t) for x, s, t in docs if x == lang]
        within = Counter(w for _, t in own for w in set(t))
        kept = sorted(w for w, n in within.items() if n >= 10)
        counts = {s: Counter() for s, _ in own}
        for s, t in own:
            counts[s].update(w for w in t if within[w] >= 10)
        whole = sum(counts.values(), Counter())

        def share(c, w, kept=kept):
            return 1 + 10 ** 9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))

        def measure(p, q):
            return (p - q) ** 2 // (p + q)

        for s, c in counts.items():
            pairs = [(o, sum(measure(share(c, w), share(d, w)) for w in kept)) for o, d in counts.items() if o != s]
            terms = [(w, measure(share(c, w), share(whole, w))) for w in kept if c[w] and share(c, w) > share(whole, w)]
            for part, values in (("pair", pairs), ("term", terms)):
                order = sorted(values, key=lambda v: (-v[1], v[0].encode()))
                out |= {(lang, s, part, item, value, i) for i, (item, value) in enumerate(order, 1) if part == "pair" or i <= 10}
    return out


def divergence_rows(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeABCDEéß\U0001f600　", k=rng.randint(1, 19))) for _ in range(60)]
    rows = []
    for _ in range(300):
        source = rng.choice(["a", "a", "a", "b", "c", None, "\U0001f600", "￿"])
        text = rng.choice([" ", "-", "\n"]).join(rng.choices(words, [1 + i % (2 if source == "a" else 7) for i in range(60)],
                                                             k=rng.choice([0, 1, 9, 40])))
        rows.append((text, rng.choice(["x", "y", None]), source))
    rows += [(None, "x", "silent"), (None, None, None), ("lonely words", "one", "only"), ("few", "none", "p"), ("few", "none", "q"),
             *[rows[0]] * 12, ("long " * 100_000 + "x" * 70_000, "x", "a"), ("y" * 70_000 + " " + "y" * 69_999, "x", "a")]
    return rows


@pytest.mark.parametrize("shard, held, block", [(1 << 24, 1 << 20, 1 << 16), (2000, 50, 20)])
def test_source_divergence(spark, shard, held, block, monkeypatch):
    for name, value in (("SHARD_BYTES", shard), ("HELD", held), ("BLOCK_COUNTS", block), ("SOURCES", 2 if block == 20 else 64)):
        monkeypatch.setattr(divergence, name, value)
    rows = divergence_rows(2)
    extra = "term string, count int, docs int, value double, rank string, n int, v int"
    docs = spark.createDataFrame([(*r, "t", 1, 2, 0.5, "r", 3, 4) for r in rows],
                                 f"text string, lang string, source string, {extra}").repartition(3)
    found = [tuple(r) for r in divergence.audit(docs).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_divergence(rows)


def test_source_divergence_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert divergence.audit(docs).isEmpty()
