"""Byte-level BPE encoding and decoding.

Two tiers: a minimal perfect hash over the vocabulary resolves whole
pre-tokens; a pre-token that is no vocabulary entry is merged by a heap over
its linked bytes. Bounded memos in front keep what a worker has met.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import picked
from tenure.llm.pieces import cut

#: Entries that each of two generations of a worker's memos holds: of pre-tokens, and of
#: pieces that are found among these with little work.
MEMO, MEMO_PIECES = 350_000, 60_000
#: Ids decoded at once.
DECODE_IDS = 1 << 18
#: Low bits of a heap entry that hold the position in a pre-token (below 2**40 bytes).
_AT = 40
_AT_MASK = (1 << _AT) - 1
_ODD_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PerfectHash:
    """A minimal perfect hash: n keys to the slots 0 .. n-1, one pilot per bucket.

    Keys are dealt to buckets by one part of their 64-bit hash. Large buckets
    first, each looks for a pilot that sends its keys to free slots; buckets of
    one key take what is left and store the slot itself (as -1 - slot).
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.buckets = n // 4 + 1
        self.seed, done = 0, False
        while not done:
            h = np.fromiter((xxhash.xxh64_intdigest(k, self.seed) for k in keys), np.uint64, n)
            done = len(np.unique(h)) == n and self._build(h)
            self.seed += not done
        slots = [self.slot(k) for k in keys]
        assert len(set(slots)) == n
        self.values = [0] * n
        self.keys = [b""] * n
        for i, s in enumerate(slots):
            self.keys[s], self.values[s] = keys[i], i

    def _slots(self, h: np.ndarray, pilots: np.ndarray) -> np.ndarray:
        mixed = (h[None, :] ^ (pilots[:, None] * _ODD_MULTIPLIER)) * _ODD_MULTIPLIER
        return ((mixed >> np.uint64(32)) % np.uint64(self.n)).astype(np.int64)

    def _build(self, h: np.ndarray) -> bool:
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        parts = np.split(order, np.cumsum(np.bincount(bucket, minlength=self.buckets))[:-1])
        free, self.pilots, single = np.ones(self.n, bool), [0] * self.buckets, []
        for b in sorted(range(self.buckets), key=lambda b: -len(parts[b])):
            if len(parts[b]) == 1:
                single.append(b)
            elif len(parts[b]):
                for at in range(0, 1 << 20, 256):
                    s = self._slots(h[parts[b]], np.arange(at, at + 256, dtype=np.uint64))
                    good = free[s].all(1) & (np.diff(np.sort(s, 1), axis=1) > 0).all(1)
                    if good.any():
                        k = int(good.argmax())
                        self.pilots[b], free[s[k]] = at + k, False
                        break
                else:
                    return False
        for b, s in zip(single, np.flatnonzero(free).tolist(), strict=False):
            self.pilots[b] = -1 - s
        return True

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh64_intdigest(key, self.seed)
        p = self.pilots[h % self.buckets]
        if p < 0:
            return -1 - p
        m = 0x9E3779B97F4A7C15
        return (((h ^ (p * m & 0xFFFFFFFFFFFFFFFF)) * m & 0xFFFFFFFFFFFFFFFF) >> 32) % self.n

    def get(self, key: bytes) -> int:
        """The key's number in the list it was built from, -1 if it isn't there."""
        s = self.slot(key)
        return self.values[s] if self.keys[s] == key else -1


class ByteBpe:
    """A byte-level BPE vocabulary: token bytes by rank, and the pattern of pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        tokens = sorted(ranks, key=ranks.__getitem__)
        self.ids = [ranks[t] for t in tokens]
        self.hash = PerfectHash(tokens)
        self.shift = self.ids[-1].bit_length()
        #: id of a pair's merge by the ids of its two sides, from every split of every token
        self.pairs = {
            ranks[t[:k]] << self.shift | ranks[t[k:]]: r for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
        }
        self.of_byte = [ranks[bytes([b])] for b in range(256)]
        top = self.ids[-1] + 1
        by_id = [b""] * top
        for t, r in ranks.items():
            by_id[r] = t
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        self.lengths = np.fromiter(map(len, by_id), np.int64, top)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self._encoder: Encoder | None = None

    def encoder(self) -> Encoder:
        """One encoder for all tasks of a worker, so that its memos stay warm."""
        self._encoder = self._encoder or Encoder(self)
        return self._encoder

    def __getstate__(self):
        return self.__dict__ | {"pattern": self.pattern.pattern, "_encoder": None}

    def __setstate__(self, state):
        self.__dict__ = state | {"pattern": regex.compile(state["pattern"])}

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: again and again the pair of least rank (leftmost first) is merged."""
        ids, get, shift = [*map(self.of_byte.__getitem__, piece)], self.pairs.get, self.shift
        n = len(ids)
        # rank of the pair that starts at a position (-1: none), and the positions beside it
        rank = [get(a << shift | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
        nxt, prv = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [r << _AT | i for i, r in enumerate(rank) if r >= 0]
        rank.append(-1)
        heapify(heap)
        while heap:
            least = heappop(heap)
            i = least & _AT_MASK
            r = rank[i]
            if r != least >> _AT:
                continue  # one of the two has been merged meanwhile
            j = nxt[i]
            k, p = nxt[j], prv[i]
            ids[i], ids[j], rank[j], nxt[i] = r, -1, -1, k
            if k < n:
                prv[k] = i
                rank[i] = q = get(r << shift | ids[k], -1)
                if q >= 0:
                    heappush(heap, q << _AT | i)
            else:
                rank[i] = -1
            if p >= 0:
                rank[p] = q = get(ids[p] << shift | r, -1)
                if q >= 0:
                    heappush(heap, q << _AT | p)
        return [x for x in ids if x >= 0]

    def encode_piece(self, piece: bytes) -> list[int]:
        k = self.hash.get(piece)
        return [self.ids[k]] if k >= 0 else self.merged(piece)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids' tokens."""
        out = []
        for at in range(0, len(ids), DECODE_IDS):
            part = ids[at : at + DECODE_IDS]
            n = self.lengths[part]
            shift = self.starts[part] - (np.cumsum(n) - n)
            out.append(self.blob[np.repeat(shift, n) + np.arange(n.sum())].tobytes())
        return b"".join(out)


class Memo(dict):
    """A dict that computes what it lacks. Once full it starts anew, and what is met
    again comes over from the generation before."""

    def __init__(self, make, limit: int = MEMO):
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key):
        value = self.before[key] if key in self.before else self.make(key)
        if len(self) >= self.limit:
            self.before = {}  # goes before the copy is made, so that no third generation stands beside two
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes texts to little-endian 32-bit ids."""

    def __init__(self, bpe: ByteBpe):
        self.find = bpe.pattern.findall
        self.tokens = Memo(lambda p: struct.pack(f"<{len(x)}I", *x) if (x := bpe.encode_piece(p.encode())) else b"")
        self.pieces = Memo(self.piece, MEMO_PIECES)

    def piece(self, p: str) -> bytes:
        """A piece of ``cut``; one of letters alone, or with a mark behind them, needs no matching."""
        if p.isalpha():
            return self.tokens[" " + p]
        if p[-1:] in (",", ".") and p[:-1].isalpha():
            return self.tokens[" " + p[:-1]] + self.tokens[p[-1]]
        return self.whole(p if p[:1] == "\n" else " " + p)

    def whole(self, text: str) -> bytes:
        return b"".join([self.tokens[p] for p in self.find(text)])

    def __call__(self, text: str) -> bytes:
        parts = cut(text)
        if parts is None:
            return self.whole(text)
        return self.whole(parts[0]) + b"".join(map(self.pieces.__getitem__, parts[1]))


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line a token in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def load(path: str, pattern: str) -> ByteBpe:
    """Read on the driver; jobs get it as a broadcast, whose size is the vocabulary's."""
    return ByteBpe(read_ranks(path), pattern)


def id_lists(buffers: list[bytes]) -> pa.ListArray:
    sizes = np.fromiter(map(len, buffers), np.int64, len(buffers)) // 4
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(buffers), "<i4")))


def slices(b: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of the column, so that long texts don't add up."""
    at = size = 0
    col = b.column(column)
    for i in range(b.num_rows):
        size += len(x.as_buffer()) if hasattr(x := col[i], "as_buffer") and x.is_valid else 0
        if size >= most:
            yield b.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < b.num_rows:
        yield b.slice(at)


def encoded_batches(bpe: ByteBpe, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches ``doc_id, text`` to batches ``doc_id, ids``."""
    enc = bpe.encoder()
    for whole in batches:
        for b in slices(whole, "text"):
            bufs = [enc(t) if t else b"" for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), id_lists(bufs)], ["doc_id", "ids"])


def decoded_batches(bpe: ByteBpe, batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches with a further column ``decoded``, the bytes of the ids in column ``at``."""
    for whole in batches:
        for b in (whole.slice(k, 512) for k in range(0, whole.num_rows, 512)):
            col = b.column(at)
            texts = [bpe.decode(v.values.to_numpy(zero_copy_only=False)) if (v := col[i]).is_valid else b"" for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())], [*b.schema.names, "decoded"])


def encode(docs: DataFrame, bpe: ByteBpe, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, ids`` (array of ints), each pre-token encoded separately.

    ``decoded``: also a column of that name, as ``decode`` adds it, by the same worker: the ids
    aren't sent to a second one, which would hold vocabulary and memos once more.

    Defined cases: a null text is the empty text, whose ids are an empty array;
    null and repeated ids get a row per input row; an empty table gives an empty
    table; other columns are ignored. Texts of any length are encoded whole.

    Scale: one narrow pass, no shuffle. Per task the memory is one Arrow batch,
    memos of bounded size and the broadcast vocabulary.
    """
    own = picked(docs, doc_id=id_col, text=text_col)
    shared = own.sparkSession.sparkContext.broadcast(bpe)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = encoded_batches(shared.value, batches)
        return decoded_batches(shared.value, out, 1) if decoded else out

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {kind}, ids array<int>" + (", decoded binary" if decoded else ""))


def decode(encoded: DataFrame, bpe: ByteBpe, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the bytes of the ids (null ids: no bytes). Other columns stay.

    A byte string, as ids may cut a character; the decoded ids of a whole text are its UTF-8.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(bpe)
    keep = [c for c in encoded.columns if c != "decoded"]
    at = keep.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoded_batches(shared.value, batches, at)

    schema = encoded.select(*keep).schema.add("decoded", "binary")
    return encoded.select(*keep).mapInArrow(run, schema)


def tokens(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode again, and sum up per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    bpe = load(path, pattern)
    out = encode(docs, bpe, id_col, text_col, decoded=True)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

