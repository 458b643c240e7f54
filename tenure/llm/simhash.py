"""SimHash near-dedup by Golay-code fuzzy hashing.

Fingerprints are 64-bit majority bits of shingle hashes. A fingerprint is cut
into three segments. Two fingerprints that differ in at most two bits agree on
one segment and differ in at most one bit on the next one (cyclically), so
each fingerprint gets the keys (exact segment, Golay codeword index near the
next segment). Fingerprints meet on a key and are verified by bit distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import picked, written
from tenure.llm.components import components

#: The (23, 12) Golay code's generator x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY_POLY, GOLAY_BITS, GOLAY_CHECK = 0xC75, 23, 11
#: First bit and width of the fingerprint's segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MAX_BITS = 2
#: Buckets up to this size are verified pair by pair; larger ones by shared midpoints.
PAIRWISE = 32


def _remainder(v: int) -> int:
    for bit in range(GOLAY_BITS - 1, GOLAY_CHECK - 1, -1):
        if v >> bit & 1:
            v ^= GOLAY_POLY << (bit - GOLAY_CHECK)
    return v


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and high 11 bits, and per syndrome the error
    patterns of weight four or less (six columns; -1 where there are fewer)."""
    bit = [_remainder(1 << i) for i in range(GOLAY_BITS)]

    def syndromes(first: int, n: int) -> np.ndarray:
        out = np.zeros(1 << n, np.int64)
        for i in range(n):
            out[1 << i : 2 << i] = out[: 1 << i] ^ bit[first + i]
        return out

    errors: list[list[int]] = [[] for _ in range(1 << GOLAY_CHECK)]
    for weight in range(5):
        for at in combinations(range(GOLAY_BITS), weight):
            s = 0
            for i in at:
                s ^= bit[i]
            errors[s].append(sum(1 << i for i in at))
    return syndromes(0, 12), syndromes(12, 11), np.array([e + [-1] * (6 - len(e)) for e in errors], np.int64)


_TABLES: list = []


def golay_indices(v: np.ndarray) -> np.ndarray:
    """Per 23-bit word the 12-bit indices of all codewords within distance four (-1: none).

    The code is perfect with radius three, so a word has one codeword within
    three bits, and words three bits away from it have five more at four bits.
    Two words one bit apart therefore always share an index.
    """
    if not _TABLES:
        _TABLES.append(golay_tables())
    low, high, errors = _TABLES[0]
    e = errors[low[v & 0xFFF] ^ high[v >> 12]]
    return np.where(e < 0, -1, (v[:, None] ^ e) >> GOLAY_CHECK)


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, keys) of unsigned 64-bit fingerprints; see the module's text."""
    seg = [((fp >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    rows, keys = [], []
    for s in range(3):
        near = golay_indices(seg[(s + 1) % 3])
        r, c = np.nonzero(near >= 0)
        rows.append(r)
        keys.append((s << 40) | (seg[s][r] << 12) | near[r, c])
    return np.concatenate(rows), np.concatenate(keys)


_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANES = np.arange(8) * 256


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned SimHash: bit set where over half of the shingle hashes have it.

    A-Z lower-cased, words split at space and 09-0D, shingles joined by a
    space and hashed by XXH64 with seed 42, repeats included. Fewer words than
    a shingle: the whole sequence; no word (also null): zero.
    """
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    if len(ws) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(ws), 42)
    n = len(ws) - shingle + 1
    grams = map(b" ".join, zip(*(ws[k : n + k] for k in range(shingle)), strict=True))
    h = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), np.uint64, n)
    counts = np.zeros((8, 256), np.int64)
    for at in range(0, n, 1 << 16):
        lanes = h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8) + _LANES
        counts += np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
    on = (counts @ _BITS).ravel() * 2 > n
    return int(np.packbits(on, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, th, fp)`` per row: id, hash of the text, fingerprint as a signed long."""
    own = picked(docs, doc_id=id_col, text=text_col).withColumn("th", F.xxhash64(F.coalesce("text", F.lit(""))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column("text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(fps.view(np.int64))], ["doc_id", "th", "fp"])

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.select("doc_id", "th", "text").mapInArrow(run, f"doc_id {kind}, th bigint, fp bigint")


def links(fps: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct ``(a, b)``, a < b: links that connect all fingerprints at most ``max_bits`` (0 to 2) apart.

    Buckets of up to ``PAIRWISE`` fingerprints give every verified pair. In a
    larger bucket pairs would grow with its square; its members give the 65
    points within one bit instead. Two fingerprints lie within two bits exactly if
    they share such a point, a point has 65 neighbours at most, and all of them
    are within two bits of each other, so each point links its members to the
    least one: no link between components is lost, and no pair is listed. (For
    ``max_bits`` below two, large buckets use the flips the smaller radius needs.)
    """
    one = fps.select(F.col(fp).alias("fp")).distinct()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("fp").to_numpy(zero_copy_only=False)
            rows, keys = fuzzy_keys(v.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(v[rows])], ["key", "fp"])

    keys = written(one.mapInArrow(keyed, "key bigint, fp bigint"), "golay_keys")
    # a table of its own, so that AQE can split a hot key's rows in the join
    sizes = written(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "golay_sizes")
    met = written(keys.join(sizes, "key"), "golay_buckets")
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= max_bits
    small = met.filter(F.col("n") <= PAIRWISE).groupBy("key").agg(F.collect_list("fp").alias("m"))
    pairs = small.select(
        F.explode(
            F.flatten(
                F.transform("m", lambda x: F.transform(F.filter("m", lambda y: (x < y) & near(x, y)), lambda y: F.struct(x.alias("a"), y.alias("b"))))
            )
        ).alias("p")
    ).select("p.a", "p.b")
    large = met.filter(F.col("n") > PAIRWISE).select("fp").distinct()
    bits = F.array(*[F.lit(1).cast("long") * (1 << i) if i < 63 else F.lit(-(1 << 63)) for i in range(64)])
    if max_bits >= 2:
        points = F.concat(F.array("fp"), F.transform(bits, lambda x: F.col("fp").bitwiseXOR(x)))
        hung = (
            large.select("fp", F.explode(points).alias("point"))
            .groupBy("point")
            .agg(F.collect_set("fp").alias("m"))
            .filter(F.size("m") > 1)
            .select(F.array_min("m").alias("a"), F.explode("m").alias("b"))
            .filter("a != b")
        )
    elif max_bits == 1:
        flips = large.select(F.col("fp").alias("a"), F.explode(F.transform(bits, lambda x: F.col("fp").bitwiseXOR(x))).alias("b"))
        hung = flips.join(large.select(F.col("fp").alias("b")), "b").select("a", "b").filter("a < b")
    else:
        hung = pairs.limit(0)
    return pairs.union(hung).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per input row: ``doc_id, th, fingerprint, component_id``.

    ``th`` is the text's hash, ``fingerprint`` 16 lowercase hex digits,
    ``component_id`` the smallest id reachable over fingerprints at most
    ``max_bits`` bits apart (itself included).

    Defined cases: null, empty and blank texts have fingerprint zero and link
    like any other; a null id is never a component's id unless the component
    has no other (then null); repeated rows come back each; an empty table gives
    an empty table; other columns are ignored.

    Scale: copies collapse to one fingerprint before any key is made; pairs are
    bounded per bucket; components run on distinct linked fingerprints only.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the segments and keys hold for bit distances 0 to 2")
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return with_components(fps, max_bits).select(
        "doc_id", "th", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def with_components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fps`` (doc_id, th, fp) with ``component_id``; fps should be a written table."""
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    root = components(links(fps, "fp", max_bits), "a", "b")
    rooted = first.join(root.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(rooted.join(least, "root").select("fp", "component_id"), "fp")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the least id (null last), then the least text hash.

    Repeated rows (same id and text) leave one. All columns are kept.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "th")).alias("f"))
    root = components(links(fps, "fp", max_bits), "a", "b")
    keep = (
        first.join(root.withColumnRenamed("node", "fp"), "fp", "left")
        .groupBy(F.coalesce("root", "fp").alias("root"))
        .agg(F.min("f").alias("f"))
        .select(F.col("f.doc_id").alias("keep_id"), F.col("f.th").alias("keep_th"))
    )
    th = F.xxhash64(F.coalesce(docs[f"`{text_col}`"], F.lit("")))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{id_col}`"].alias("row_id"), th.alias("row_th"))
    kept = rows.join(keep, F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("row_th") == F.col("keep_th")))
    return kept.dropDuplicates(["row_id", "row_th"]).select("row.*")
