"""Passages of over 50 words that repeat across documents: from 400 bytes on they go, shorter ones stay."""

import random

from tests.llm.helpers import frame
from tests.llm.test_repeats import brute, run, words


def test_planted_passages_go_from_the_length_on(spark):
    rnd = random.Random(12)
    short = [" ".join(rnd.choice(["an", "of", "to", "the", "day", "sea"]) + str(rnd.randrange(9)) for _ in range(55)) for _ in range(4)]
    long = [words(rnd, 90) for _ in range(4)]
    assert max(len(p.encode()) for p in short) < 380 and min(len(p.encode()) for p in long) >= 400
    rows = [(i, words(rnd, 80) + " " + p + " " + words(rnd, 80)) for i, p in enumerate([*short, *long] * 3)]
    rows += [(100 + i, words(rnd, 200)) for i in range(20)]
    got = run(frame(spark, rows), 400)
    assert sorted(got) == sorted(brute(rows, 400))
    removed = {d: n for d, _, n, _, _ in got}
    assert all((removed[i] > 0) == (i % 8 >= 4) for i in range(24))
    assert not any(removed[i] for i in removed if i >= 100)
