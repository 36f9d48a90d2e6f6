"""Made-up texts for tests."""

import random

SHARED = "A passage that many documents hold, word for word, so that it is common everywhere it is looked for."


def corpus(seed, size, groups=6):
    """Texts with groups of near copies, exact copies, one passage that half of them share, and short texts."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(300)]
    texts = []
    for _ in range(size // 4):
        texts.append(" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 4, 5, 8, 20, 60, 150]))))
    for _ in range(size // 4):
        texts.append(SHARED + " " + " ".join(rng.choices(words, k=rng.randint(1, 30))))
    bases = [rng.choices(words, k=rng.choice([12, 30, 60, 120, 300])) for _ in range(groups)]
    while len(texts) < size:
        own = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(w.upper() if rng.random() < 0.01 else w for w in own))
    rng.shuffle(texts)
    return texts
