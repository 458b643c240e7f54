import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenure.llm import repeats
from tenure.llm.queries import op12_repeats
from tests.llm.helpers import SF, documents, edge_rows, frame, same


def brute(rows, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept) from a dictionary of all strings of ``length`` bytes."""
    raws = [(t or "").encode() for _, t in rows]
    starts = defaultdict(list)
    for i, raw in enumerate(raws):
        for s in range(len(raw) - length + 1):
            starts[raw[s : s + length]].append((i, s))
    hit = [np.zeros(len(raw) + 1, int) for raw in raws]
    for places in starts.values():
        if len(places) > 1:
            for i, s in places:
                hit[i][s] += 1
                hit[i][min(s + length, len(raws[i]))] -= 1
    out = []
    for (d, _), raw, h in zip(rows, raws, hit, strict=True):
        on = np.cumsum(h)[:-1] > 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~on])
        out.append((d, len(raw), int(on.sum()), int((np.diff(np.r_[0, on.astype(int)]) == 1).sum()), kept))
    return out


def run(docs, length):
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.without_repeats(docs, length).collect()]


def words(rnd, n):
    return " ".join("".join(rnd.choices("abcdefghijklmnopqrstuvwxyzäé", k=rnd.randrange(2, 9))) for _ in range(n))


def planted(rnd, length):
    """Passages around the limit, copies, near copies, runs and periods."""
    passages = [words(rnd, 400).encode()[:n].decode(errors="ignore") for n in (length - 1, length, length + 1, length + 60, 3 * length, 5 * length)]
    base = words(rnd, 300)
    rows = [(i, words(rnd, rnd.randrange(1, 60)) + p + words(rnd, rnd.randrange(1, 60))) for i in range(8) for p in (rnd.choice(passages),)]
    rows += [(100 + i, base) for i in range(3)]
    for i in range(12):
        at = rnd.randrange(len(base))
        rows.append((200 + i, base[:at] + "#%d" % i + base[at + 1 :]))
    rows += [(300, "a" * (length + 50)), (301, "x" + "a" * (length + 10)), (302, "ab" * length), (303, words(rnd, 5) + "ab" * length)]
    rows += [(400, passages[-1] + words(rnd, 30) + passages[-1]), (401, "a" * (length - 1))]
    return rows + edge_rows()


@pytest.mark.parametrize("length", (100, 400))
def test_planted(spark, length):
    rnd = random.Random(length)
    rows = planted(rnd, length)
    same(run(frame(spark, rows).repartition(4), length), brute(rows, length))


def test_large_groups(spark, monkeypatch):
    """Groups beyond GROUP are halved; buffers and arrays of any size give the same."""
    monkeypatch.setattr(repeats, "GROUP", 3)
    monkeypatch.setattr(repeats, "ARRAY", 500)
    monkeypatch.setattr(repeats, "BUFFER", 700)
    rnd = random.Random(9)
    rows = planted(rnd, 120)
    passage = words(rnd, 40)[:150]
    rows += [(500 + i, words(rnd, 20) + passage + words(rnd, 20)) for i in range(40)]
    same(run(frame(spark, rows).repartition(3), 120), brute(rows, 120))


def test_defined_cases(spark):
    df = frame(spark, edge_rows())
    assert repeats.without_repeats(df.limit(0)).count() == 0
    same(run(frame(spark, [(None, None), (None, "")]), 400), [(None, 0, 0, 0, b"")] * 2)
    # no ids: rows are told apart by their texts
    rows = [(None, "z" * 500)] * 3 + [(None, words(random.Random(1), 200))]
    same(run(frame(spark, rows), 400), brute(rows, 400))


def test_suffix_array():
    rnd = random.Random(2)
    for _ in range(50):
        pieces = [bytes(rnd.choices(b"ab", k=rnd.randrange(0, 30))) for _ in range(rnd.randrange(1, 6))]
        codes, ends, _ = repeats.repeat_groups(pieces, 3)
        order, common = repeats.suffix_array(codes)
        suffixes = sorted(range(len(codes)), key=lambda i: codes[i:].tolist())
        assert order.tolist() == suffixes
        for k in range(1, len(order)):
            a, b = codes[order[k - 1] :].tolist(), codes[order[k] :].tolist()
            assert common[k] == next(n for n in range(len(a) + 1) if a[: n + 1] != b[: n + 1])


def test_maximal_repeat_groups():
    """All occurrences of each string that can't be made longer on either side without losing one."""
    rnd = random.Random(3)
    for _ in range(60):
        pieces = [bytes(rnd.choices(b"abc", k=rnd.randrange(0, 25))) for _ in range(rnd.randrange(1, 5))]
        codes, ends, groups = repeats.repeat_groups(pieces, 2)
        got = sorted((size, sorted(places.tolist())) for size, places in groups)
        where = defaultdict(list)
        text = codes.tolist()
        for i in range(len(text)):
            for j in range(i + 2, len(text) + 1):
                if all(c < 256 for c in text[i:j]):
                    where[tuple(text[i:j])].append(i)
        want = []
        for s, at in where.items():
            if len(at) > 1 and len({text[i - 1] for i in at}) > 1 and len({text[i + len(s)] for i in at}) > 1:
                want.append((len(s), at))
        assert got == sorted(want)


def test_extents_depend_on_the_window_alone():
    rnd = random.Random(4)
    inner = words(rnd, 200).encode()
    found = []
    for before in (b"", b"q" * 10, words(rnd, 30).encode()):
        data = np.frombuffer(before + inner + b"tail", np.uint8)
        lo, hi, anchor, key = repeats.extents(data, np.array([len(data)]), 100)
        at = {}
        for a, b, c, k in zip(lo, hi, anchor, key, strict=True):
            at.update({s: (c - s, k) for s in range(a, b + 1)})
        assert sorted(at) == list(range(len(data) - 99))
        found.append([at[len(before) + s] for s in range(len(inner) - 99)])
    assert found[0] == found[1] == found[2]


def test_query(spark):
    rows = [r[:2] for r in documents()]
    want = [(d, n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, n, gone, spans, kept in brute(rows, 400)]
    assert sum(w[2] for w in want) > 0
    same(op12_repeats(spark, SF).collect(), want)
