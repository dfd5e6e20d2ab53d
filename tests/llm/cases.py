"""Awkward documents that every operator must take."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "shard int, length int, rid string")


def documents(spark, texts, ids=None):
    """Rows with clashing extra columns; ``texts`` may hold None."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), 7, 9, "x")
            for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def mixed(seed=1, n=40):
    """Nulls, empties, repeats, ties, one very long text, other scripts."""
    rng = random.Random(seed)
    texts = [words(rng, rng.randrange(1, 120)) for _ in range(n)]
    texts += [None, "", " \n\t", "a", "x" * 5000, texts[0], texts[0], texts[1].upper(),
              "Ünïcödé \U0001F600 表語文字 " * 9, words(rng, 30_000, 3000), None, ""]
    return texts
