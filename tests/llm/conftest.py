import random

import pytest

from .llm_corpus import SHARED


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and blank texts, repeated rows, a very long text, and columns named like results."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    long_text = " ".join(rng.choices(words, k=30_000))
    rows = [(None, "no id at all"), (None, "no id at all"), (1, None), (2, ""), (3, " \n\t \x0b "), (4, "Same Text"),
            (5, "same text"), (6, "same text"), (6, "same text"), (7, long_text), (8, "é ü ß İ Σς   　 ½²"),
            (9, "tab\there  two   blanks \r\n and <|endoftext|> inside"), (10, SHARED), (11, SHARED + " more"),
            (12, "\U0001f600\U0001f1e9\U0001f1ea ȩ́ \x1c\x1d x"), (13, "0"), (14, "x" * 5000), (15, "#" * 5000)]
    extra = "shard int, slot long, bucket string, row long, n int, kept boolean, spans string, name string, h long, ids string"
    rows = [(i, t, 1, 2, "b", 3, 4, True, "s", "n", 5, "i") for i, t in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
