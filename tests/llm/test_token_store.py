import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tenure.llm import token_store
from tenure.llm.common import shared_path
from tenure.llm.huffman import Coder, canonical, code_lengths
from tenure.llm.queries import op3_token_store
from tests.llm.helpers import SF, documents, edge_rows, frame, same

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def huffman_cost(counts):
    import heapq

    h = [c for c in counts if c]
    heapq.heapify(h)
    total = 0
    while len(h) > 1:
        s = heapq.heappop(h) + heapq.heappop(h)
        total += s
        heapq.heappush(h, s)
    return total


def limited_cost(counts, most):
    """Least cost of codes of at most ``most`` bits by dynamic programming over the Kraft sum."""
    ws = sorted((c for c in counts if c), reverse=True)
    best = {1 << most: 0}
    for w in ws:
        new = {}
        for room, cost in best.items():
            for n in range(1, most + 1):
                if (r := room - (1 << (most - n))) >= 0:
                    new[r] = min(new.get(r, 1 << 60), cost + w * n)
        best = new
    return min(best.values())


def test_code_lengths():
    rnd = random.Random(3)
    for _ in range(60):
        counts = np.array([rnd.choice([0, 1, 2, 5, 100, 10**6, 2**rnd.randrange(30)]) for _ in range(rnd.randrange(2, 14))])
        n = int((counts > 0).sum())
        for most in (max(1, (max(n, 1) - 1).bit_length()), 5, 30):
            if n > 1 << most:
                continue
            lens = code_lengths(counts, most)
            assert ((lens > 0) == (counts > 0)).all() and lens.max(initial=0) <= most
            if n > 1:
                assert abs(sum(2.0 ** -x for x in lens[lens > 0].tolist()) - 1) < 1e-12
                assert int((lens * counts).sum()) == (huffman_cost(counts.tolist()) if most == 30 else limited_cost(counts.tolist(), most))
    with pytest.raises(ValueError):
        code_lengths(np.ones(5, int), 2)


def test_codes_are_prefix_free():
    lens = code_lengths(np.array([5, 0, 1, 1, 9, 30, 2]), 4)
    codes = canonical(lens)
    bits = [f"{int(c):0{n}b}" for c, n in zip(codes, lens, strict=True) if n]
    assert not any(a != b and b.startswith(a) for a in bits for b in bits)


def test_round_trip():
    r = np.random.default_rng(4)
    for n, top in ((1, 1), (5, 3), (511, 40), (512, 40), (513, 40), (20_000, 50_000), (70_000, 2)):
        ids = np.minimum(r.zipf(1.3, n) - 1, top - 1).astype(np.int64)
        code = Coder(code_lengths(np.bincount(ids, minlength=top), 16))
        for every in (7, 512, 100_000):
            bits, marks = code.pack(ids, every)
            assert (code.unpack(bits, marks, n, every) == ids).all()
    assert code.pack(ids[:0], 512)[1].size == 0


def brute(library, rows, end=2):
    """In ascending id order, null last; rows of one id are only compared by their ids' sum."""
    out, at = [], 0
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [end]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_pieces_against_library(library):
    rnd = random.Random(5)
    parts = ["the", " a", "  ", "\n", "\n\n", "\t", "don't", "É", "日本語", "😀", "\x1c", "\r\n", "$$$", "12345", "<|endoftext|>", "ing", " superb", "Ġ", "Ċ"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(1, 30))) for _ in range(1500)] + [" ".join(rnd.choices(parts, k=20)) for _ in range(500)] + ["", None]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "a <|endoftext|>.", "tail\u3000", "two\u00a0\u2003spaces", "one\u2003space", "x\x85y"]
    enc = token_store.LibraryEncoder(open(PATH, encoding="utf-8").read())
    for at in range(0, len(texts), 100):
        ids, n = enc.ids(pa.array(texts[at : at + 100], pa.string()))
        for t, own in zip(texts[at : at + 100], np.split(ids, np.cumsum(n)[:-1]), strict=True):
            assert own.tolist() == (library.encode(t, add_special_tokens=False).ids if t else []), repr(t)
    assert len(enc.ids(pa.array([], pa.string()))[0]) == 0


def test_edges(spark, library, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_IDS", 40)
    df = frame(spark, edge_rows())
    for rows, frame_ in ((edge_rows(), df), ([], df.limit(0)), ([(None, None)], frame(spark, [(None, None)]))):
        path = shared_path(spark, "t")
        token_store.write_tokens(frame_.repartition(3), path, open(PATH, encoding="utf-8").read(), 2)
        got = token_store.read_tokens(spark, path).orderBy("start").collect()
        own = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got]
        same([(d, str(x)) for d, x in own], [(d, str(library.encode(t or "", add_special_tokens=False).ids + [2])) for d, t in rows])
        assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
        order = [(r.doc_id is None, r.doc_id or 0) for r in got]
        assert order == sorted(order)
        if len(rows) > 3:
            assert spark.read.parquet(f"{path}/blocks").count() > 3


def test_ids_of_other_types(spark, library):
    for kind in ("date", "decimal(10,0)", "smallint"):
        df = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, "c")], "n int, text string")
        df = df.select((F.date_add(F.lit("2024-01-01").cast("date"), "n") if kind == "date" else F.col("n").cast(kind)).alias("doc_id"), "text")
        path = shared_path(spark, "kinds")
        token_store.write_tokens(df, path, open(PATH, encoding="utf-8").read(), 2)
        got = token_store.read_tokens(spark, path, kind).orderBy("doc_id").collect()
        assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == [[64, 220, 50256, 275, 2], [66, 2]]


def test_query(spark, library):
    same(op3_token_store(spark, SF).collect(), brute(library, [r[:2] for r in documents()]))
