"""Rows with one doc_id or none are told apart by all columns."""

import random
from collections import Counter

from pricehouse.llm import simhash

SCHEMA = "doc_id bigint, text string"


def test_rows_are_told_apart_by_all_columns(workers):
    rng = random.Random(2)
    a, b, c = (" ".join(rng.choices([f"u{i}" for i in range(500)], k=60)) for _ in range(3))
    rows = [(3, a), (5, a), (5, b), (5, b), (None, a), (None, c), (None, c), (None, b)]
    got = simhash.keep_first(workers.createDataFrame(rows, SCHEMA)).collect()
    assert Counter(map(tuple, got)) == Counter([(3, a), (5, b), (None, c)])
