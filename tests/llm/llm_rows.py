"""Rows that the tests of the corpus operators share."""

import random

#: Extra columns named like the operators' own.
CLASHING = ["row", "digest", "copies", "size", "key", "n", "rate", "document", "id", "_stays", "root", "token", "batch", "held_out"]


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(100_000)}x" for _ in range(n))


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
