"""Document fingerprints: one-permutation MinHash with packed low-order bits.

DataFrame functions only. Every shingle is hashed once; the hash's high bits
are its bin and the least hash of a bin is the bin's value. Empty bins take the
value of a full bin by optimal densification: every bin has a random order of
its own over all bins and copies from the first full one. The low-order bits of
all bins are packed; likeness is corrected for bits that agree by chance.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.llm.common import SPACES, fresh

#: Words of a shingle; bins (a power of two) and bits kept of each.
SHINGLE, BINS, BITS = 5, 256, 4
_SHIFT = 64 - (BINS.bit_length() - 1)
_LOW = (1 << _SHIFT) - 1
_PER_LONG = 64 // BITS
#: Rows that a range of neighbouring documents has about, and ranges at most.
RANGE_ROWS, MOST_RANGES = 4_000, 1 << 16


def _longs(values: list[int]) -> Column:
    """A constant array of (signed) longs, as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: One value per bin that is larger than any hash of the bin.
_SENTINELS = [_signed(i << _SHIFT | _LOW) for i in range(BINS)]


def _orders() -> tuple[list[int], list[int]]:
    """Start and (odd) stride of each bin's own way through all bins."""
    rnd = random.Random(BINS)
    return [rnd.randrange(BINS) for _ in range(BINS)], [rnd.randrange(BINS // 2) * 2 + 1 for _ in range(BINS)]


def _densified(df: DataFrame, bins: str, out: str, names: list[str]) -> DataFrame:
    """Column ``out``: ``bins`` (longs, null where a bin is empty) with every bin filled."""
    start, stride = (_longs(x) for x in _orders())
    empty = lambda a: F.size(F.filter(a, lambda v: v.isNull()))

    def rounds(state: Column, first: int, last: int) -> Column:
        def one(acc: Column, k: Column) -> Column:
            new = F.transform(
                acc["a"],
                lambda v, i: F.coalesce(v, F.get(F.col(bins), ((F.get(start, i) + k * F.get(stride, i)) % BINS).cast("int"))),
            )
            step = F.transform(F.array(new), lambda a: F.struct(a.alias("a"), empty(a).alias("n")))[0]
            return F.when(acc["n"] > 0, step).otherwise(acc)

        return F.aggregate(F.sequence(F.lit(0).cast("long") + first, F.lit(0).cast("long") + last), state, one)

    state, near = names
    df = df.withColumn(state, F.struct(F.col(bins).alias("a"), empty(F.col(bins)).alias("n")))
    # most texts fill up within a few rounds; the way through all bins is only gone where it is needed
    df = df.withColumn(near, F.when(F.col(f"{state}.n") > 0, rounds(F.col(state), 0, 15)).otherwise(F.col(state)))
    return df.withColumn(out, F.when(F.col(f"{near}.n") > 0, rounds(F.col(near), 16, BINS - 1)["a"]).otherwise(F.col(f"{near}.a")))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the packed fingerprint (array of longs) of the column ``text``.

    Words are runs of ``[^\\x20\\x09-\\x0D]``, shingles have five words; a text of
    fewer words has one shingle, all of it, and a null or blank text the shingle
    of no word, so it is like other blank texts and unlike any other.
    """
    ws, wh, hs, sorted_, first, bins, state, near, dense = fresh(df, *(f"_{out}_{k}" for k in range(9)))
    # each column that a lambda reads stands for itself: it is computed once, by generated code
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(SPACES))
    df = df.withColumn(ws, F.split(trimmed, r"[\x20\x09-\x0D]+"))
    df = df.withColumn(wh, F.transform(ws, lambda w: F.xxhash64(w)))
    grams = F.transform(
        F.sequence(F.lit(0), F.size(wh) - SHINGLE), lambda i: F.xxhash64(*[F.get(F.col(wh), i + j) for j in range(SHINGLE)])
    )
    df = df.withColumn(hs, F.when(F.size(wh) >= SHINGLE, grams).otherwise(F.array(F.xxhash64(F.array_join(ws, " ")))))
    df = df.withColumn(sorted_, F.sort_array(F.concat(hs, _longs(_SENTINELS))))
    bin_of = lambda x: F.shiftrightunsigned(x, _SHIFT)
    firsts = F.filter(sorted_, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(sorted_), i - 1))))
    df = df.withColumn(first, firsts)
    value = lambda x: x.bitwiseAND(F.lit(_LOW))
    df = df.withColumn(bins, F.transform(first, lambda x: F.when(value(x) != _LOW, value(x))))
    df = _densified(df, bins, dense, [state, near])
    pack = F.transform(
        F.sequence(F.lit(0), F.lit(BINS // _PER_LONG - 1)),
        lambda j: F.aggregate(
            F.slice(F.col(dense), j * _PER_LONG + 1, F.lit(_PER_LONG)),
            F.lit(0).cast("long"),
            lambda acc, v: F.shiftleft(acc, BITS).bitwiseOR(v.bitwiseAND(F.lit((1 << BITS) - 1))),
        ),
    )
    return df.withColumn(out, F.when(F.size(dense) == BINS, pack)).drop(ws, wh, hs, sorted_, first, bins, state, near, dense)


def likeness(a: Column, b: Column) -> Column:
    """Estimated resemblance of two packed fingerprints, 0 to 1: the share of equal bins,
    less what equal low-order bits owe to chance."""
    ones = _signed(int("0001" * _PER_LONG, 2))

    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        any_bit = z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseOR(F.shiftrightunsigned(z, 2)).bitwiseOR(F.shiftrightunsigned(z, 3))
        return F.bit_count(any_bit.bitwiseAND(F.lit(ones)))

    differ = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, n: s + n)
    chance = 1 / (1 << BITS)
    return F.greatest(F.lit(0.0), (1 - differ / BINS - chance) / (1 - chance))


def hexed(packed: Column) -> Column:
    return F.lower(F.array_join(F.transform(packed, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def ranged(docs: DataFrame, id_col: str) -> tuple[DataFrame, list[int]]:
    """``docs`` with ``_range``: the number of its range of neighbouring ids (nulls last)."""
    n = docs.count()
    parts = min(MOST_RANGES, n // RANGE_ROWS + 1)
    bounds: list[int] = []
    if parts > 1:
        at = [k / parts for k in range(1, parts)]
        bounds = sorted(set(docs.agg(F.percentile_approx(id_col, at, 100 * parts)).first()[0] or []))
    if not bounds:
        return docs.withColumn("_range", F.when(F.col(id_col).isNull(), 1).otherwise(0)), bounds
    # how many bounds are below the id, by halving
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    below = F.aggregate(
        _longs(steps), F.lit(0).cast("long"), lambda acc, s: F.when(F.get(_longs(bounds), (acc + s - 1).cast("int")) < F.col(id_col), acc + s).otherwise(acc)
    ).cast("int")
    return docs.withColumn("_range", F.when(F.col(id_col).isNull(), len(bounds) + 1).otherwise(below)), bounds


def with_next(docs: DataFrame, key: list[str], carry: dict[str, str], prepare=lambda df: df) -> DataFrame:
    """``docs`` with the next row's columns (``carry``: new name to column), in ascending
    order of ``key`` (an integer id, nulls last, and a hash); the first row's after the last.

    Rows are dealt by ranges of the id; the first row of a range is handed to the
    range before as well. The driver gets one key per range. ``prepare`` adds
    columns once a row is where it is needed.
    """
    parted, _ = ranged(docs, key[0])
    least = F.min(F.struct(F.col(key[0]).isNull().alias("x"), *key)).alias("k")
    heads = sorted((r["_range"], r["k"][key[0]], r["k"][key[1]]) for r in parted.groupBy("_range").agg(least).collect())
    if not heads:
        heads = [(0, None, None)]
    before = [(heads[i - 1][0], *heads[i][1:]) for i in range(len(heads))]
    kind = docs.schema[key[0]].dataType.simpleString()
    given = docs.sparkSession.createDataFrame(before, f"_to int, _k0 {kind}, _k1 bigint")
    met = parted[key[0]].eqNullSafe(F.col("_k0")) & parted[key[1]].eqNullSafe(F.col("_k1"))
    # equal rows are the same neighbour: one of them is handed over
    extra = parted.join(F.broadcast(given), met).dropDuplicates(["_to"]).withColumn("_range", F.col("_to")).select(*parted.columns)
    rows = prepare(parted.withColumn("_extra", F.lit(0)).union(extra.withColumn("_extra", F.lit(1))))
    w = Window.partitionBy("_range").orderBy("_extra", F.col(key[0]).asc_nulls_last(), key[1])
    for new, old in carry.items():
        rows = rows.withColumn(new, F.lead(old).over(w))
    return rows.filter("_extra = 0").drop("_extra", "_range")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text has the last half (rounded down, in code points) replaced by
    the first as many (or all) of the next document's, in ascending order of the
    id; after the last comes the first. The nears are the fingerprint's likeness to
    the edited text's and to the next document's.

    Defined cases: a null text is the empty text; null ids come last; rows of one
    id follow by their text's hash, repeated rows follow each other; a single row is
    its own neighbour; an empty table gives an empty table; other columns are
    ignored. The id is an integer column.

    Scale: a text is shuffled once, to its id's range of about ``RANGE_ROWS``
    rows (larger beyond ``MOST_RANGES`` ranges); ranges are cut at quantiles, so
    they follow the ids' distribution, and a window spills what it cannot hold.
    """
    own = docs.select(docs[f"`{id_col}`"].alias("doc_id"), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"))
    own = own.withColumn("th", F.xxhash64("text"))
    rows = with_next(own, ["doc_id", "th"], {"next_text": "text", "next_fp": "fp"}, lambda df: with_fingerprint(df, "text", "fp"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).select("doc_id", "n_chars", "fp", "next_fp", "edited")
    rows = with_fingerprint(rows.withColumn("edited_sha256", F.sha2("edited", 256)), "edited", "edited_fp")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", hexed(F.col("fp")).alias("fingerprint"), hexed(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
