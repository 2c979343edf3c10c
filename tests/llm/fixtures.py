"""Small documents with every awkward case, and brute-force helpers."""

import random
import re

SCHEMA = "doc_id bigint, text string, class string, n bigint, size string, range string"


def awkward(spark, extra=()):
    """Null id, null and empty text, white space, ties, a repeated row, a very long text, clashing columns."""
    long_text = " ".join(f"word{i % 977} x{i}" for i in range(40_000))
    rows = [(1, "alpha beta gamma delta epsilon"), (2, None), (3, ""), (4, " \n\t "), (5, "alpha beta gamma delta epsilon"),
            (5, "alpha beta gamma delta epsilon"), (None, "no id here at all"), (7, long_text), (8, "one"),
            (9, "ÄÖÜ été ñandú 日本語 \U0001f600"), *extra]
    return spark.createDataFrame([(i, t, "c", 1, "s", "r") for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, words, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def words_of(text, pattern):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(pattern, lowered)


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
