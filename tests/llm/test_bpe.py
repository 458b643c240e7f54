import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tenure.llm import bpe
from tenure.llm.queries import op2_byte_bpe
from tests.llm.helpers import SF, documents, edge_rows, frame, same

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.load(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(enc, text):
    import numpy as np

    return np.frombuffer(enc(text), "<u4").tolist()


def test_perfect_hash():
    keys = [f"key{i}".encode() for i in range(5000)]
    h = bpe.PerfectHash(keys)
    assert [h.get(k) for k in keys] == list(range(5000))
    assert sorted(h.slot(k) for k in keys) == list(range(5000))
    assert all(h.get(f"other{i}".encode()) == -1 for i in range(2000))


def test_against_library(own, library):
    enc = bpe.Encoder(own)
    rnd = random.Random(5)
    parts = ["the", " a", "  ", "\n", "\n\n", "\t", " \n", "don't", "'s", "É", "ß9", "日本語", "😀", " ", " ", "\x1c", "\r\n", "#", "$$$", "12345", "<|endoftext|>", "aaaaaaa", "x" * 50, "ing", " supercalifragilistic", "_", "\x00", "á"]
    texts = ["".join(rnd.choices(parts, k=rnd.randrange(1, 30))) for _ in range(3000)]
    texts += [" ".join(rnd.choices(parts, k=20)) for _ in range(1000)] + [t for _, t in edge_rows() if t] + ["ab" * 5000, " " * 3000]
    for t in texts:
        assert ids(enc, t) == library.encode_ordinary(t), repr(t)


def test_merge_alone(own, library):
    rnd = random.Random(6)
    for _ in range(2000):
        w = "".join(rnd.choices("etaoinshrdlu", k=rnd.randrange(1, 25)))
        assert own.encode_piece(w.encode()) == library.encode_ordinary(w)


def test_memo_starts_anew():
    m = bpe.Memo(lambda k: k * 2, limit=3)
    assert [m[i] for i in range(10)] == [i * 2 for i in range(10)] and len(m) <= 3


def brute(library, rows):
    out = []
    for d, t in rows:
        x = library.encode_ordinary(t or "")
        out.append((d, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def test_edges(spark, library):
    df = frame(spark, edge_rows())
    same(bpe.tokens(df, PATH, public_tokenizers.PATTERN).collect(), brute(library, edge_rows()))
    assert bpe.tokens(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_decode_nulls_and_columns(spark, own):
    df = spark.createDataFrame([(1, [50, 51], "x"), (2, None, "y"), (3, [], None)], "a int, ids array<int>, decoded string")
    got = bpe.decode(df, own)
    assert got.columns == ["a", "ids", "decoded"]
    assert [bytes(r.decoded) for r in got.orderBy("a").collect()] == [own.decode(__import__("numpy").array([50, 51])), b"", b""]


def test_ids_are_decoded_by_the_worker_that_made_them(spark, own):
    """One Python pass, with the same bytes as the decoder of its own."""
    df = frame(spark, edge_rows())
    both = bpe.encode(df, own, decoded=True)
    assert both.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(str, both.collect())) == sorted(map(str, bpe.decode(bpe.encode(df, own), own).collect()))
    plan = bpe.tokens(df, PATH, public_tokenizers.PATTERN)._jdf.queryExecution().analyzed().toString()
    assert plan.count("MapInArrow") == 1


def test_query(spark, library):
    same(op2_byte_bpe(spark, SF).collect(), brute(library, [r[:2] for r in documents()]))
