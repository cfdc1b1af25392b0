"""Small inputs shared by the tests: edge rows, and generated prose."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, n_words int, shard string, kept string, text_crc32 string"


def prose(seed: int, n: int, vocab: int = 4000) -> str:
    r = random.Random(seed)
    words = ["".join(r.choice(["ba", "ke", "li", "mo", "nu", "ra", "so", "ti"]) for _ in range(r.randint(1, 4)))
             + str(r.randrange(vocab)) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + ("." if i % 12 == 11 or i == n - 1 else ""))
    return " ".join(out)


def edited(text: str, every: int) -> str:
    w = text.split(" ")
    return " ".join(x + "x" if i % every == every - 1 else x for i, x in enumerate(w))


LONG = prose(1, 30_000)
EDGE = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one two three four five."), (None, "null id here."),
        (7, prose(7, 80)), (7, prose(7, 80)), (8, prose(7, 80)), (9, prose(9, 80)), (None, prose(10, 90)),
        (None, prose(10, 90)), (11, LONG), (12, LONG), (13, "ünï cödé — “x” 你好 \U0001F600 end."), (14, None), (-5, "neg.")]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "s", "k", "c") for i, t in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
