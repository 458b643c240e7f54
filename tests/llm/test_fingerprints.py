import hashlib
import struct

import xxhash

from tenure.llm import fingerprints as M
from tenure.llm.queries import op6_fingerprints
from tests.llm.helpers import SF, WORD, documents, edge_rows, frame, same

MASK = (1 << 64) - 1


def chained(values):
    """The 64-bit hash of several longs: each hashed with the hash so far as its seed."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<Q", v), h)
    return h


def shingles(text):
    ws = WORD.findall(text)
    if len(ws) < M.SHINGLE:
        return {xxhash.xxh64_intdigest(" ".join(ws).encode(), 42)}
    hs = [xxhash.xxh64_intdigest(w.encode(), 42) for w in ws]
    return {chained(hs[i : i + M.SHINGLE]) for i in range(len(hs) - M.SHINGLE + 1)}


def slow(text):
    bins = [None] * M.BINS
    for h in shingles(text):
        b = ((h >> M._SHIFT) + M.BINS // 2) % M.BINS  # signed order of the hashes
        v = h & M._LOW
        if bins[b] is None or v < bins[b]:
            bins[b] = v
    start, stride = M._orders()
    full = [next(v for k in range(M.BINS) if (v := bins[(s + k * t) % M.BINS]) is not None) if bins[i] is None else bins[i] for i, (s, t) in enumerate(zip(start, stride, strict=True))]
    return "".join(f"{v % (1 << M.BITS):x}" for v in full)


def near(a, b):
    equal = sum(x == y for x, y in zip(a, b, strict=True)) / M.BINS
    c = 1 / (1 << M.BITS)
    return max(0.0, (equal - c) / (1 - c))


def brute(rows):
    """rows: (doc_id, text) in order."""
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        a, b, c = slow(t), slow(edited), slow(nxt)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(near(a, b), 9), round(near(a, c), 9)))
    return out


def got_rows(df):
    return [(*r[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in df.collect()]


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def in_order(rows):
    th = lambda t: signed(xxhash.xxh64_intdigest((t or "").encode(), 42))
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, th(r[1])))


def test_edges(spark):
    df = frame(spark, edge_rows())
    same(got_rows(M.edited_likeness(df)), brute(in_order(edge_rows())))
    assert M.edited_likeness(df.limit(0)).count() == 0
    one = [(None, None)]
    same(got_rows(M.edited_likeness(frame(spark, one))), brute(one))


def test_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ROWS", 9)
    rows = edge_rows() + [(i * i, f"text {i} of some more words {i % 3} " * (i % 5)) for i in range(20, 90)] + [(500, f"same id {i}") for i in range(30)]
    same(got_rows(M.edited_likeness(frame(spark, rows))), brute(in_order(rows)))


def test_likeness_is_close_to_resemblance(spark):
    base = [f"w{i}" for i in range(1000)]
    for share in (0.0, 0.3, 0.7, 0.95):
        k = int(1000 * share)
        a, b = " ".join(base), " ".join(base[:k] + [f"x{i}" for i in range(1000 - k)])
        x, y = shingles(a), shingles(b)
        assert abs(near(slow(a), slow(b)) - len(x & y) / len(x | y)) < 0.11


def test_query(spark):
    got = got_rows(op6_fingerprints(spark, SF))
    same(got, brute([r[:2] for r in documents()]))
    texts = {}
    for _, _, _, f, _, _, _ in got:
        texts[f] = texts.get(f, 0) + 1
    assert len(got) == 200
