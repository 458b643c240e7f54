import random

import numpy as np
import xxhash

from tenure.llm import simhash
from tenure.llm.components import components
from tenure.llm.queries import op4_simhash
from tests.llm.helpers import SF, WORD, documents, edge_rows, frame, same

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def slow_fingerprint(text):
    ws = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(ws[i : i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else [" ".join(ws)] if ws else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(fps, max_bits=2):
    """Least member of each fingerprint's component, by all pairs."""
    own = sorted(set(fps))
    root = {f: f for f in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in own}


def brute(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    g = groups(fps)
    least = {}
    for (d, _), f in zip(rows, fps, strict=True):
        if d is not None:
            least[g[f]] = min(d, least.get(g[f], d))
    return [(d, f"{f:016x}", least.get(g[f])) for (d, _), f in zip(rows, fps, strict=True)]


def test_golay_keys_meet_within_one_bit():
    r = np.random.default_rng(1)
    v = r.integers(0, 1 << 23, 3000)
    near = [set(x) - {-1} for x in simhash.golay_indices(v).tolist()]
    for bit in range(23):
        other = simhash.golay_indices(v ^ (1 << bit)).tolist()
        assert all(a & set(b) for a, b in zip(near, other, strict=True))


def test_fuzzy_keys_meet_within_two_bits():
    rnd = random.Random(2)
    for _ in range(300):
        a = rnd.getrandbits(64)
        for bits in (rnd.sample(range(64), 2), rnd.sample(range(64), 1)):
            b = a
            for i in bits:
                b ^= 1 << i
            rows, keys = simhash.fuzzy_keys(np.array([a, b], np.uint64))
            assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_links_against_all_pairs(spark):
    rnd = random.Random(3)
    fps = [0, (1 << 64) - 1] + [rnd.getrandbits(64) for _ in range(200)]
    for _ in range(150):  # chains that drift away from one point
        fps.append(fps[-1] ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)))
    hub = rnd.getrandbits(64)  # a bucket far larger than PAIRWISE
    fps += [hub ^ (1 << i) ^ (1 << j) for i in range(0, 40) for j in range(i + 1, 40, 3)]
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bits in (0, 1, 2):
        pairs = simhash.links(df, max_bits=bits)
        assert pairs.filter(f"bit_count(a ^ b) > {bits} or a >= b").count() == 0
        got = {r.node: r.root for r in components(pairs, "a", "b").collect()}
        # the least signed value of each group, as the operator works on longs
        g = groups([f % (1 << 64) for f in signed], bits)
        least = {}
        for f in signed:
            least.setdefault(g[f % (1 << 64)], f)
        assert {f: got.get(f, f) for f in signed} == {f: least[g[f % (1 << 64)]] for f in signed}


def test_components_of_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(4).shuffle(order)
    df = spark.createDataFrame(list(zip(order, order[1:], strict=False)) + [(7, 7), (None, 3), (1000, 1001)], "a long, b long")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}
    assert components(df.limit(0), "a", "b").count() == 0


def test_edges(spark):
    df = frame(spark, edge_rows())
    got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
    same(got, brute(edge_rows()))
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    fps = [slow_fingerprint(t) for _, t in edge_rows()]
    g = groups(fps)
    want = {g[f]: c for f, (_, _, c) in zip(fps, brute(edge_rows()), strict=True)}.values()
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(map(str, want))


def test_query(spark):
    rows = [r[:2] for r in documents()]
    same(op4_simhash(spark, SF).collect(), brute(rows))
