import numpy as np

from tenure.llm import mixing
from tenure.llm.queries import op8_mixing
from tests.llm.helpers import WORD, documents, edge_rows, frame


def water(sizes, weights=(1, 2, 3), most=3.0):
    """Targets by filling source after source: stop, share the excess, again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        free = [s for s in names if s not in stopped]
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return {s: most * sizes[s] if s in stopped else share[s] for s in names}
        stopped |= over


def size(t):
    return len(WORD.findall(t or ""))


def check(rows, got, slack):
    """rows: (doc_id, text, source); got: the query's rows."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = water(sizes)
    own = lambda r: (r[0] is None, r[0], r[1], r[2], round(r[3], 4))
    assert sorted(own((d, size(t), sizes[s], want[s])) for d, t, s in rows) == sorted(own((r.doc_id, r["size"], r.source_size, r.target)) for r in got)
    assert all(0 <= r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0) for r in got)
    taken = {}
    for r in got:
        key = (r.source_size, round(r.target, 4))
        taken[key] = taken.get(key, 0) + r.taken
    for (_, target), n in taken.items():
        assert abs(n - target) <= slack(target)


def test_pivot_keeps_sum_and_expectation():
    p = np.array([0.2, 0.7, 0.5, 0.9, 0.35, 0.0, 1.0, 0.35])
    hits = np.zeros(len(p))
    for seed in range(3000):
        out, left, a = mixing.pivot(p, seed, True)
        assert left < 0 and abs(out.sum() - p.sum()) < 1 + 1e-9
        hits += out
        part, left, a = mixing.pivot(p, seed, False)
        assert abs(part.sum() + (a if left >= 0 else 0) - p.sum()) < 1e-6
    assert np.abs(hits / 3000 - p).max() < 0.04


def test_tree_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 7)
    rows = [(i, "w " * (1 + i * 37 % 50)) for i in range(900)]
    df = frame(spark, rows)
    got = mixing.per_document(mixing.mix(df)).collect()
    check([(r.doc_id, r.text, r.source) for r in df.collect()], got, lambda t: 50 + 0.01 * t)
    again = mixing.per_document(mixing.mix(df.repartition(5))).collect()
    key = lambda r: (r.doc_id, r["size"], r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_targets_that_stop(spark):
    rows = [("a", 10), ("b", 1000), ("c", 1), (None, 0), ("d", 7), ("é", 900), ("z", 5)]
    df = spark.createDataFrame([(s, n, 1) for s, n in rows], "source string, source_size long, n_texts long")
    got = {r.source: r.target for r in mixing.targets(df, (1, 2, 3), 3.0).collect()}
    want = water(dict(rows))
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)
    few = df.filter("source in ('a', 'c')")
    got = {r.source: r.target for r in mixing.targets(few, (1, 2, 3), 3.0).collect()}
    assert abs(sum(got.values()) - 11) < 1e-9 and abs(got["c"] - 3) < 1e-9
    assert mixing.targets(df.limit(0), (1,), 3.0).count() == 0
    assert mixing.targets(df.filter("source_size = 0"), (1,), 3.0).first().target == 0


def test_edges(spark):
    df = frame(spark, edge_rows())
    rows = [(r.doc_id, r.text, r.source) for r in df.collect()]
    got = mixing.per_document(mixing.mix(df)).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = water(sizes)
    assert sorted((str(r.doc_id), r["size"], round(r.target, 6)) for r in got) == sorted((str(d), size(t), round(want[s], 6)) for d, t, s in rows)
    assert mixing.per_document(mixing.mix(df.limit(0))).count() == 0
    out = mixing.mixed_rows(df)
    assert out.columns == df.columns
    taken = {}
    for r in mixing.mix(df).collect():
        taken[r.doc_id, r["size"]] = taken.get((r.doc_id, r["size"]), 0) + r.copies * r.times
    found = {}
    for r in out.collect():
        found[r.doc_id, size(r.text)] = found.get((r.doc_id, size(r.text)), 0) + 1
    assert found == {k: v for k, v in taken.items() if v}


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = op8_mixing(spark, sf).collect()
    largest = max(size(t) for _, t, _ in documents(sf))
    check(documents(sf), got, lambda t: largest)
    again = op8_mixing(spark, sf).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
