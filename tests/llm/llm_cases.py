"""Shared rows of the tests."""

import random

SMOKE = "/root/testdata/sf0.001"
#: Null, empty, blank, short, repeated and very long texts; ids out of order.
PASSAGE = "".join(random.Random(5).choice("abcdé \n") for _ in range(300))
EDGES = [
    (3, None), (1, ""), (2, " \n\t "), (4, "one"), (5, "one"), (9, "one two three four five"),
    (8, "One TWO three four five"), (10, PASSAGE), (11, "x" + PASSAGE + "y"), (12, "q" * 5000), (13, "word " * 4000),
    (14, "é ü 日本 🙂 " * 20), (15, PASSAGE[:49]), (16, PASSAGE[:50])]


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
