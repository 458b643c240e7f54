"""Repeated byte strings: maximal repeats from common-prefix intervals of a suffix array.

Every string of ``length`` bytes has one anchor: its least k-gram by hash. Equal
strings have equal anchors at the same place, so texts are compared anchor by
anchor. The strings of neighbouring starts that share an anchor make one extent.
Equal extents are found by hash; extents that differ but share the anchor's k-gram
are laid side by side in an enhanced suffix array, whose stack scan outputs the
maximal repeat groups. Nothing else of a text leaves its row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tenure.llm.bpe import slices
from tenure.llm.common import picked, written

#: Bytes of an anchor's k-gram.
GRAM = 64
#: Different extents of one k-gram that one task lays side by side; larger groups are halved by offset first.
GROUP = 1000
#: Bytes of one buffer (a longer text is cut, with an overlap); bytes of extents in one suffix array.
BUFFER, ARRAY = 1 << 20, 1 << 19
#: Odd base of the rolling hash and odd factors of its mixing.
BASE, MIX = 0x9E3779B97F4A7C15, (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse (modulo 2^64), kept for later calls."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 2 * BUFFER)
        _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of each k-gram of the bytes ``data``."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: len(data) + 1 - k]
    for shift, factor in zip((30, 27), MIX, strict=True):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    return h ^ (h >> np.uint64(31))


def window_least(values: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbouring values: running minima from both ends of blocks of ``w``."""
    n = len(values)
    blocks = np.full(-(-n // w) * w, np.iinfo(values.dtype).max, values.dtype)
    blocks[:n] = values
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


def extents(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(lo, hi, anchor, key) of the extents of the texts that end at ``ends`` in ``data``.

    Starts ``lo`` to ``hi`` have the anchor, whose k-gram hashes to ``key``. Ties go to the
    first place, so a start's anchor depends on its own ``length`` bytes only.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    h = gram_hashes(data, GRAM)
    bits = np.uint64((1 << int(len(data)).bit_length()) - 1)
    order = (h & ~bits) | np.arange(len(h), dtype=np.uint64)
    anchor = (window_least(order, length - GRAM + 1) & bits).astype(np.int64)
    starts = np.r_[0, ends[:-1]]
    step = np.zeros(len(anchor) + 1, np.int8)
    whole = ends - starts >= length
    np.add.at(step, starts[whole], 1)
    np.add.at(step, np.minimum(ends[whole] - length + 1, len(anchor)), -1)
    inside = np.cumsum(step[:-1]) > 0
    anchor[~inside] = -1
    cuts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1], True])
    # neighbouring texts never share an anchor: a window lies in one text
    lo, hi = cuts[:-1], cuts[1:] - 1
    real = anchor[lo] >= 0
    lo, hi = lo[real], hi[real]
    return lo, hi, anchor[lo], h[anchor[lo]]


def buffers(column: pa.Array, length: int) -> Iterator[tuple[bytes, list[int], list[int], list[int]]]:
    """(bytes, ends, rows, offsets): texts strung together, longer ones in overlapping parts."""
    parts, ends, rows, bases, size = [], [], [], [], 0
    for row, text in enumerate(column):
        data = text.as_buffer().to_pybytes() if text.is_valid else b""
        for base in range(0, max(1, len(data) - length + 1), BUFFER):
            part = data[base : base + BUFFER + length - 1]
            if size and size + len(part) > 2 * BUFFER - length:
                yield b"".join(parts), ends, rows, bases
                parts, ends, rows, bases, size = [], [], [], [], 0
            parts.append(part)
            size += len(part)
            ends.append(size)
            rows.append(row)
            bases.append(base)
    if parts:
        yield b"".join(parts), ends, rows, bases


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted (start, end) rows of the union of (start, end) rows."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(spans) - 1]
    return np.c_[spans[new, 0], reach[last]]


EXTENT = "key bigint, ext bigint, lo int, hi int, off int, m int, spans array<int>"


def text_extents(docs: DataFrame, length: int) -> DataFrame:
    """The different extents of each text: ``doc_id, th``, the hashes ``key`` (anchor) and ``ext``
    (extent), the first place (starts ``lo`` to ``hi``, the anchor ``off`` behind ``lo``), how often
    the text has it, and the bytes that these places cover as start, end, start, end ..."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                for raw, ends, rows, bases in buffers(b.column("text"), length):
                    yield table(b, raw, np.array(ends), np.array(rows), np.array(bases))

    def table(b: pa.RecordBatch, raw: bytes, ends: np.ndarray, rows: np.ndarray, bases: np.ndarray) -> pa.RecordBatch:
        data, view = np.frombuffer(raw, np.uint8), memoryview(raw)
        lo, hi, anchor, key = extents(data, ends, length)
        part = np.searchsorted(ends, lo, side="right")
        off, to = anchor - lo, hi + length
        ext = np.fromiter((xxhash.xxh3_64_intdigest(view[s:e], o) for s, e, o in zip(lo.tolist(), to.tolist(), off.tolist(), strict=True)), np.uint64, len(lo))
        shift = bases[part] - np.r_[0, ends[:-1]][part]
        found = rows[part], key.view(np.int64), ext.view(np.int64), lo + shift, hi + shift, off
        # equal extents of one text (runs, repeated lines) are one row
        sort = np.lexsort((found[3], found[2], found[1], found[0]))
        row, key, ext, lo, hi, off = (v[sort] for v in found)
        new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (ext[1:] != ext[:-1])]) if len(row) else np.zeros(0, np.int64)
        m = np.diff(np.r_[new, len(row)])
        spans = np.c_[lo, hi + length]
        many = m > 1
        if many.any():
            each = np.split(spans, new[1:])
            covered = [merged(s).ravel() for s in each]
            flat, sizes = np.concatenate(covered), np.fromiter(map(len, covered), np.int64, len(covered))
        else:
            flat, sizes = spans.ravel(), np.full(len(new), 2)
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat.astype(np.int32)))
        take = pa.array(row[new])
        small = [pa.array(v[new].astype(np.int32)) for v in (lo, hi, off)]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(take), b.column("th").take(take), pa.array(key[new]), pa.array(ext[new]), *small, pa.array(m.astype(np.int32)), lists],
            ["doc_id", "th", "key", "ext", "lo", "hi", "off", "m", "spans"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"doc_id {kind}, th bigint, {EXTENT}")


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before) by prefix doubling.

    The last code stands nowhere else. A suffix leaves the sort when no other shares
    its prefix; the ranks of every round are kept and give the common prefixes.
    """
    n = len(codes)
    at, p, rank, h, levels = np.arange(n), codes.astype(np.int64), np.zeros(n, np.int64), 0, []
    while len(at):
        sort = np.argsort(p, kind="stable")
        at, p = at[sort], p[sort]
        first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
        size = np.diff(np.r_[first, len(p)])
        # a class is ranked by its place among those it was one class with
        old = rank[at[first]]
        head = np.r_[True, old[1:] != old[:-1]]
        rank = rank.copy()
        rank[at] = np.repeat(old + first - first[head][np.cumsum(head) - 1], size)
        levels.append(rank)
        h = max(1, 2 * h)
        at = at[np.repeat(size > 1, size)]
        p = rank[at] * n + rank[np.minimum(at + h, n - 1)]
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    got = np.zeros(n, np.int64)
    i, j = order[:-1], order[1:]
    for k in range(len(levels) - 1, -1, -1):
        got[1:] += (levels[k][i + got[1:]] == levels[k][j + got[1:]]).astype(np.int64) << k
    return order, got


def maximal_repeats(order: np.ndarray, common: np.ndarray, before: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, bytes): ranges of ``order`` whose suffixes share ``bytes`` (``length`` or more) bytes,
    no more, and don't all have the same byte before them (``before``, by place in ``order``).

    A scan with a stack: an interval is pushed where the common prefix grows and done
    where it shrinks; what all its suffixes have before them is handed up, or -1 where it varies.
    """
    places = np.flatnonzero(common >= length)
    stack: list[list[int]] = []
    for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1) if len(places) else ():
        a, e = int(run[0]), int(run[-1]) + 2
        left = before[a - 1 : e - 1].tolist()
        for i, shared in enumerate([*common[a : e - 1].tolist(), 0], a):
            begin, same = i - 1, left[i - a]
            while stack and stack[-1][0] > shared:
                size, begin, own = stack.pop()
                same = own if own == same else -1
                if same == -1:
                    yield begin, i - 1, size
            if shared and stack and stack[-1][0] == shared:
                if stack[-1][2] != same:
                    stack[-1][2] = -1
            elif shared:
                stack.append([shared, begin, same])


def repeat_groups(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[int, np.ndarray]]]:
    """(codes, ends, groups) of strings: each group is (bytes, places in the codes) of a maximal repeat.

    Strings are parted by codes of their own, so no match crosses them, and the
    start of a string differs from whatever stands before a match elsewhere.
    """
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes + 1)
    codes = np.empty(int(ends[-1]) + 1, np.int64)
    codes[0] = 256
    codes[ends] = 257 + np.arange(len(pieces))
    mask = np.ones(len(codes), bool)
    mask[0] = mask[ends] = False
    codes[mask] = np.frombuffer(b"".join(pieces), np.uint8)
    order, common = suffix_array(codes)
    found = maximal_repeats(order, common, codes[order - 1], length)
    return codes, ends, ((size, order[a : b + 1]) for a, b, size in found)


def repeated_spans(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """Per string the (start, end) rows of what its maximal repeats cover."""
    codes, ends, groups = repeat_groups(pieces, length)
    change = np.zeros(len(codes) + 1, np.int64)
    for size, places in groups:
        change[places] += 1
        change[places + size] -= 1
    covered = np.cumsum(change) > 0
    edges = np.flatnonzero(np.diff(np.r_[False, covered, False])).reshape(-1, 2)
    starts = np.r_[0, ends[:-1]] + 1
    part = np.searchsorted(ends, edges[:, 0])
    cuts = np.searchsorted(part, np.arange(1, len(pieces)))
    return np.split(edges - starts[part][:, None], cuts)


def compared(pieces: DataFrame, length: int) -> DataFrame:
    """``doc_id, th, spans``: what maximal repeats between extents of one key cover.

    ``pieces`` are ``doc_id, th, key, ext, lo, bytes``. They are dealt by key and
    sorted; whole groups are strung together up to ``ARRAY`` bytes.
    """

    def chunk(rows: list[tuple]) -> pa.RecordBatch:
        spans = repeated_spans([r[4] for r in rows], length)
        hit = [(r[0], r[1], (s + r[2]).ravel().tolist()) for r, s in zip(rows, spans, strict=True) if len(s)]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*hit) if hit else ((), (), ()), kinds, strict=True)], schema=out)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for whole in batches:
            for b in slices(whole, "bytes"):
                for doc_id, th, key, ext, lo, data in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "key", "ext", "lo", "bytes")), strict=True):
                    if (key, ext) == last:  # copies of one row
                        continue
                    if rows and size >= ARRAY and key != last[0]:
                        yield chunk(rows)
                        rows, size = [], 0
                    rows.append((doc_id, th, lo, key, data))
                    size += len(data) + 1
                    last = key, ext
        if rows:
            yield chunk(rows)

    id_type = pieces.schema["doc_id"].dataType
    shape = f"doc_id {id_type.simpleString()}, th bigint, spans array<int>"
    kinds = [to_arrow_type(id_type), pa.int64(), pa.list_(pa.int32())]
    out = pa.schema(list(zip(("doc_id", "th", "spans"), kinds, strict=True)))
    dealt = pieces.select("doc_id", "th", "key", "ext", "lo", "bytes").repartition("key").sortWithinPartitions("key", "ext")
    return dealt.mapInArrow(task, shape)


def halves(pieces: DataFrame, length: int) -> DataFrame:
    """Each extent as two: windows whose anchor lies under, or from, the middle of ``d0 .. d1 - 1``.

    All windows of a half share some bytes around the anchor; their hash is the half's
    new key, so equal windows meet again.
    """
    mid = F.floor((F.col("d0") + F.col("d1")) / 2).cast("int")
    both = F.array(F.struct(F.col("d0").alias("x"), mid.alias("y")), F.struct(mid.alias("x"), F.col("d1").alias("y")))
    cut = pieces.withColumn("half", F.explode(both)).select("*", "half.x", "half.y")
    # offsets of the anchor in the windows that this extent has in the half
    cut = cut.withColumn("far", F.least(F.col("off"), F.col("y") - 1)).withColumn("near", F.greatest(F.col("off") - F.col("hi") + F.col("lo"), F.col("x")))
    cut = cut.filter("far >= near").withColumn("skip", F.col("off") - F.col("far"))
    core = F.substring("bytes", F.col("off") - F.col("x") + 1, F.lit(length + 1) - F.col("y") + F.col("x"))
    own = F.substring("bytes", F.col("skip") + 1, F.col("far") - F.col("near") + length)
    return cut.select(
        "doc_id", "th",
        F.xxhash64("key", "x", core).alias("key"), F.xxhash64("far", own).alias("ext"),
        (F.col("lo") + F.col("skip")).alias("lo"), (F.col("lo") + F.col("off") - F.col("near")).alias("hi"), F.col("far").alias("off"),
        own.alias("bytes"), F.col("x").alias("d0"), F.col("y").alias("d1"),
    )


def covered(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, th, spans``: the bytes of each text (``th``, its hash) that a repeated string covers."""
    found = written(text_extents(docs, length), "extents", compression="zstd")
    per_extent = found.groupBy("key", "ext").agg(F.sum("m").alias("n"))
    per_key = per_extent.groupBy("key").agg(F.count("*").alias("kinds"), F.max("n").alias("n")).filter("kinds > 1 or n > 1")
    # tables of their own: next to plain exchanges AQE can split what a hot key or extent joins
    again = written(found.join(written(per_key.select("key", "kinds"), "repeated_keys"), "key"), "repeated", compression="zstd")
    place = F.min(F.struct("doc_id", "th", "lo", "hi", "off")).alias("at")
    extent = written(again.groupBy("key", "ext").agg(F.sum("m").alias("n"), F.first("kinds").alias("kinds"), place), "repeated_extents")
    parts = [again.join(extent.filter("n > 1").select("key", "ext"), ["key", "ext"]).select("doc_id", "th", "spans")]

    # what shares a key but differs: one place of each extent, with its bytes
    wanted = extent.filter("kinds > 1").select("key", "ext", "kinds", "at.*")
    per_text = written(wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("key", "ext", "kinds", "lo", "hi", "off")).alias("wanted")), "wanted", compression="zstd")
    keyed = docs.alias("d").join(per_text.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th")))
    raw = keyed.select("d.doc_id", "d.th", F.encode("text", "utf-8").alias("raw"), F.explode("wanted").alias("e")).select("doc_id", "th", "raw", "e.*")
    cut = F.substring("raw", F.col("lo") + 1, F.col("hi") - F.col("lo") + length).alias("bytes")
    whole = F.lit(length - GRAM + 1)
    pieces = written(raw.select("doc_id", "th", "key", "ext", "kinds", "lo", "hi", "off", cut, F.lit(0).alias("d0"), whole.alias("d1")), "pieces", compression="zstd")
    while True:
        parts.append(compared(pieces.filter(F.col("kinds") <= GROUP), length))
        large = pieces.filter(F.col("kinds") > GROUP)
        if large.isEmpty():
            break
        # an exact way for large groups: half the windows at a time, until extents meet or part
        half = written(halves(large.dropDuplicates(["key", "ext"]), length), "halves", compression="zstd")
        sizes = half.groupBy("key", "ext").agg(F.count("*").alias("n"))
        met = written(sizes.filter("n > 1").select("key", "ext"), "met")
        rows = half.join(met, ["key", "ext"])
        parts.append(rows.select("doc_id", "th", F.array("lo", (F.col("hi") + length).cast("int")).alias("spans")))
        kinds = written(sizes.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "kinds")
        pieces = written(half.join(kinds, "key"), "pieces", compression="zstd")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    spans = out.groupBy("doc_id", "th").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    return written(spans, "covered", compression="zstd")


def without_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept`` of every text's UTF-8 bytes.

    Each byte in a string of ``length`` bytes that also starts anywhere else (in the
    same text too, overlaps counted) is removed; ``spans`` are the maximal removed runs
    (start, end, start, end ...) and ``kept`` the other bytes.

    Defined cases: a null text is empty; a text under ``length`` bytes keeps all;
    null and repeated ids and repeated rows get a row each (a repeated row is another
    place, so it loses all from ``length`` bytes on); matches are judged on the input and
    never cross texts; an empty table gives an empty table; other columns are ignored.

    Scale: a text of b bytes gives about 2 b / (``length`` - ``GRAM``) rows of hashes, the only thing
    shuffled of texts that share nothing; counts are summed per task first, so a
    passage or text that a third of the rows hold is one row per task there, and its rows
    are split in the joins. Texts are shuffled twice, to be cut and to be cleaned. A task holds
    ``ARRAY`` bytes of extents, or ``GROUP`` extents; beyond that groups are halved.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    own = picked(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    own = own.withColumn("th", F.xxhash64("text"))
    spans = covered(own, length)
    joined = own.alias("d").join(spans.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.th") == F.col("s.th")), "left")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text"):
                raws, cuts, kept = [x.as_buffer().to_pybytes() for x in b.column("text")], [], []
                for raw, found in zip(raws, b.column("spans"), strict=True):
                    s = merged(found.values.to_numpy().reshape(-1, 2)) if found.is_valid else np.zeros((0, 2), np.int32)
                    cuts.append(s.ravel())
                    at = [0, *s.ravel().tolist(), len(raw)]
                    kept.append(b"".join(raw[i:j] for i, j in zip(at[::2], at[1::2], strict=True)))
                n, left = (np.fromiter(map(len, v), np.int64, len(v)) for v in (raws, kept))
                flat = np.concatenate(cuts).astype(np.int32) if cuts else np.zeros(0, np.int32)
                sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat))
                columns = [b.column("doc_id"), pa.array(n), pa.array(n - left), pa.array(sizes // 2), lists, pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    kind = own.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<int>, kept binary"
    return joined.select("d.doc_id", "d.text", "s.spans").mapInArrow(clean, shape)
