"""Small documents with the cases that every operator has to stand."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, key string, size long"


def prose(rng: random.Random, words: int) -> str:
    parts = ["the", "ing", "re", "st", "ou", "an", "er", "ble", "he", "on", "ti", "ha"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


def documents(seed: int = 1, n: int = 60) -> list[tuple]:
    """Random prose with near copies, exact copies, repeated rows, blanks, nulls, short and very long texts."""
    rng = random.Random(seed)
    texts: list[str | None] = []
    for _ in range(n):
        base = prose(rng, rng.randint(1, 120))
        texts.append(base)
        if rng.random() < 0.5:
            for _ in range(rng.randint(1, 4)):
                words = base.split()
                for _ in range(rng.randint(0, 3)):
                    words[rng.randrange(len(words))] = prose(rng, 1)
                texts.append(" ".join(words))
        if rng.random() < 0.2:
            texts.append(base.upper().replace(" ", "  \n"))
    texts += [None, None, "", " \t\n", "one", "One two", "one two", prose(rng, 20_000), "x" * 50_000, "日本 ü é\x0b日本 ü é"]
    rows = [(i, t, "en", f"src{i % 5}" if i % 7 else None, len(t or ""), True, "k", 1) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return [*rows, rows[0], rows[1], (None, "a null id", None, None, None, None, None, None)]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)


def components(ids, links):
    """Smallest id reachable from each id."""
    parent = {i: i for i in ids}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}
