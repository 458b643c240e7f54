"""Token ids in binary files: canonical length-limited Huffman codes in blocks.

A store is a folder with two tables: ``codebook`` (id, bits: the code lengths,
from the ids' counts over all documents) and ``blocks`` (per block: its
documents, the bits, and the bit offsets of every ``CHECKPOINT``-th id, so that
a block is decoded for itself and in parallel stretches). Blocks lie in folders
``shard=N`` in ascending order of documents.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tenure.llm.bpe import slices
from tenure.llm.common import picked, written
from tenure.llm.huffman import Coder, code_lengths

CODE_BITS = 16
BLOCK_IDS = 1 << 20
CHECKPOINT = 128
#: Pieces in each of the two generations of a worker's memo.
MEMO = 400_000
#: Marks that a word mostly has behind it.
_MARKS = (",", ".")
_MARKED = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[,.]$"
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Byte-level BPE writes bytes as visible characters: those that Latin-1 shows as they are, the others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = [b for b in range(256) if b not in _SHOWN]
_VISIBLE = "".join(chr(b if b in _SHOWN else 256 + _HIDDEN.index(b)) for b in range(256))
#: Two white-space characters side by side, or one at the end (as ``pieces.cut`` has it): only
#: there does the pre-tokenising pattern look beyond a single space or line end.
_SPACE = "[\\x09-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
_ODD = f"{_SPACE}{_SPACE}|{_SPACE}\\z"
#: Bytes of text that are cut and looked up together.
SLICE = 8 << 20


class LibraryEncoder:
    """Encodes with the tokenizers library; each new piece of text once.

    A batch of texts is cut at spaces and line ends, where the pattern never looks
    across; the batch's different pieces are looked up, and each text's ids are gathered
    from one table by piece numbers. Of what a worker hasn't met, words of letters are one
    match of the pattern and go to the library's model, other pieces are strung together
    and encoded in one call: each starts with a space or line end and holds no other,
    so a new piece starts at each token that begins with one of the two. A text with odd
    white space, or with the string of an added token, is encoded whole.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.starts = np.fromiter((t[:1] in ("Ġ", "Ċ") for t in tokens), bool, size)  # space, line end
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.marks = np.array([0, *(self.tokenizer.encode(m, add_special_tokens=False).ids[0] for m in _MARKS)], self.kind)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def learn(self, pieces: list[str]) -> None:
        """Have all these pieces, none of which it holds, in the memo's newer generation."""
        if len(self.new) > MEMO:
            self.old, self.new = self.new, {}
        new = self.new
        known = [*map(self.old.get, pieces)]
        new.update((p, k) for p, k in zip(pieces, known, strict=True) if k is not None)
        tokenize, code, others = self.tokenizer.model.tokenize, "H" if self.kind.itemsize == 2 else "I", []
        for p in (p for p, k in zip(pieces, known, strict=True) if k is None):
            if p.isascii() and p.isalpha():  # one match of the pattern
                new[p] = array(code, [t.id for t in tokenize("Ġ" + p)]).tobytes()
            elif _LETTERS(p):
                new[p] = array(code, [t.id for t in tokenize("Ġ" + p.encode().decode("latin-1").translate(_VISIBLE))]).tobytes()
            else:
                others.append(p)
        for at in range(0, len(others), 4096):
            part = others[at : at + 4096]
            text = "".join(p if p[:1] == "\n" else " " + p for p in part)
            whole = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(whole.ids, self.kind)
            first = np.flatnonzero(self.starts[ids])
            if len(first) == len(part):
                data, cuts = ids.tobytes(), [*(first * self.kind.itemsize).tolist(), len(ids) * self.kind.itemsize]
                new.update((p, data[i:j]) for p, i, j in zip(part, cuts, cuts[1:]))
            else:
                new.update((p, self.encode(p if p[:1] == "\n" else " " + p)) for p in part)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text) of a column of texts; a null is empty."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD)
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        cuts = pc.split_pattern(pc.replace_substring(pc.if_else(odd, "", texts), "\n", " \n"), " ")
        flat, offsets = cuts.flatten(), cuts.offsets.to_numpy().astype(np.int64)
        first = offsets[:-1] - offsets[0]  # what stands before the first space has none before it
        heads = strings(flat.take(pa.array(first)))
        pieces = flat.dictionary_encode()
        # letters and the mark behind them are two matches: only the letters are looked up
        marked = pc.match_substring_regex(pieces.dictionary, _MARKED)
        cores = pc.if_else(marked, pc.utf8_slice_codeunits(pieces.dictionary, 0, -1), pieces.dictionary).dictionary_encode()
        commas = pc.and_(marked, pc.ends_with(pieces.dictionary, _MARKS[0])).to_numpy(zero_copy_only=False)
        mark = np.where(commas, 1, np.where(marked.to_numpy(zero_copy_only=False), 2, 0))
        known = self.known(strings(cores.dictionary))
        piece = pieces.indices.to_numpy()
        number, mark = cores.indices.to_numpy()[piece].astype(np.int64), mark[piece]
        number[first], mark[first] = np.arange(len(known), len(known) + len(first)), 0
        known += [self.encode(h) if h else b"" for h in heads]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            known[i - len(first)] = self.encode(texts[i].as_py())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // self.kind.itemsize
        known.append(bytes(self.kind.itemsize))
        table = np.frombuffer(b"".join(known), self.kind)
        begins = np.cumsum(sizes) - sizes
        each = sizes[number] + (mark > 0)
        ends = np.cumsum(each)
        out = table[np.repeat(begins[number] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
        at = np.flatnonzero(mark)
        out[ends[at] - 1] = self.marks[mark[at]]  # what the gathering put there stands behind the letters
        return out, np.add.reduceat(each, first) if len(first) else each

    def known(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces; memos are looked up once, what is missing is learnt and filled in."""
        found = [*map(self.new.get, pieces)]
        gaps = [i for i, v in enumerate(found) if v is None]
        if gaps:
            self.learn([pieces[i] for i in gaps])
            for i in gaps:
                found[i] = self.new[pieces[i]]
        return found


def strings(column: pa.Array) -> list[str]:
    """The values as a list, through numpy, which is quicker than one Arrow scalar each."""
    return column.to_numpy(zero_copy_only=False).tolist()


_KEPT: dict[str, LibraryEncoder] = {}


def kept_encoder(spec: str) -> LibraryEncoder:
    """One encoder for all tasks of a worker, so that its memo stays warm."""
    if spec not in _KEPT:
        _KEPT.clear()
        _KEPT[spec] = LibraryEncoder(spec)
    return _KEPT[spec]


def write_tokens(docs: DataFrame, path: str, spec: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id`` to each, and write the store at ``path``.

    ``spec`` is the text of a tokenizer file of the tokenizers library. Defined
    cases: a null or empty text has the end id alone; documents stand in
    ascending order of the id, null ids last, rows of one id in order of their text's
    hash; the string of an added token is encoded as the library does by default; an empty table gives a store without blocks; other columns are ignored.

    Scale: texts are range-partitioned by id once and encoded where they lie; the
    ids are written once to the shared folder, with each task's counts, and read once. The
    driver gets one number per partition and one count per vocabulary entry. A
    block holds whole documents of about ``BLOCK_IDS`` ids.
    """
    spark = docs.sparkSession
    own = picked(docs, doc_id=id_col, text=text_col).withColumn("th", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("th")]
    parted = own.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    shared = spark.sparkContext.broadcast(spec)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = kept_encoder(shared.value), 0
        end, counts = enc.kind.type(end_id), np.zeros(1 << 16, np.int64)
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                ids, n = enc.ids(b.column("text"))
                ids, n = np.insert(ids, np.cumsum(n), end), n + 1
                begin = at + np.cumsum(n) - n
                at += len(ids)
                c = np.bincount(ids, minlength=len(counts))
                counts = c + np.pad(counts, (0, len(c) - len(counts)))
                offsets = np.r_[0, np.cumsum(n)].astype(np.int32) * np.int32(enc.kind.itemsize)
                data = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([b.column("shard"), b.column("doc_id"), pa.array(begin), pa.array(n), data], names)
        # the task's counts as a row of their own, behind its documents
        own = [pa.array([-1], pa.int32()), pa.nulls(1, id_type), pa.array([-1]), pa.array([0]), pa.array([counts.astype("<i8").tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(own, names)

    names = ["shard", "doc_id", "begin", "n", "ids"]
    kind = own.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(own.schema["doc_id"].dataType)
    table = written(parted.mapInArrow(encode, f"shard int, doc_id {kind}, begin bigint, n bigint, ids binary"), "ids", compression="zstd")
    ids = table.filter("shard >= 0")
    sums = ids.groupBy("shard").agg(F.sum("n").alias("n"), F.sum(F.length("ids")).alias("bytes")).orderBy("shard").collect()
    width = np.dtype("<u2" if not sums or sum(r["bytes"] for r in sums) == 2 * sum(r["n"] for r in sums) else "<u4")
    first, total = {}, 0
    for r in sums:
        first[r["shard"]] = total
        total += r["n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column("ids"):
                counts = np.frombuffer(x.as_buffer(), "<i8")
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["id", "n"])

    each = table.filter("shard < 0").select("ids").mapInArrow(count, "id int, n bigint")
    counted = {r["id"]: r["n"] for r in each.groupBy("id").agg(F.sum("n").alias("n")).collect()}
    counts = np.zeros(max(counted, default=0) + 1, np.int64)
    counts[list(counted)] = list(counted.values())
    lengths = code_lengths(counts, max(CODE_BITS, int(len(counted)).bit_length()))
    book = [(i, int(lengths[i])) for i in sorted(counted)]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    coder = spark.sparkContext.broadcast(lengths)

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Coder(coder.value)
        names = ["shard", "start", "doc_ids", "lengths", "checkpoints", "bits"]
        kinds = [pa.int32(), pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

        def close(rows) -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(r[3] for r in rows), width)
            bits, marks = code.pack(flat, CHECKPOINT)
            row = [rows[0][0], rows[0][1], [r[2] for r in rows], [len(r[3]) // width.itemsize for r in rows], marks.tolist(), bits]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

        rows, size, follows = [], 0, None
        for b in batches:
            for shard, doc_id, begin, n, x in zip(*(b.column(c).to_pylist() for c in ("shard", "doc_id", "begin", "n")), b.column("ids"), strict=True):
                start = first[shard] + begin
                if rows and (size >= BLOCK_IDS or follows != (shard, start)):
                    yield close(rows)
                    rows, size = [], 0
                rows.append((shard, start, doc_id, x.as_py()))
                size, follows = size + n, (shard, start + n)
        if rows:
            yield close(rows)

    shape = f"shard int, start bigint, doc_ids array<{kind}>, lengths array<bigint>, checkpoints array<bigint>, bits binary"
    blocks = ids.mapInArrow(block, shape)
    blocks.write.partitionBy("shard").option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, kind: str = "bigint") -> DataFrame:
    """``doc_id, start, n_tokens, ids`` per document of a store; ``ids`` as little-endian
    unsigned 32-bit integers, ``start`` the ids of all documents before it."""
    book = {r["id"]: r["bits"] for r in spark.read.schema("id int, bits int").parquet(f"{path}/codebook").collect()}
    lengths = np.zeros(max(book, default=0) + 1, np.int64)
    lengths[list(book)] = list(book.values())
    coder = spark.sparkContext.broadcast(lengths)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Coder(coder.value)
        for b in batches:
            for k in range(b.num_rows):
                start, docs, n, marks, bits = (b.column(c)[k] for c in ("start", "doc_ids", "lengths", "checkpoints", "bits"))
                n = n.values.to_numpy()
                ends = np.cumsum(n)
                ids = code.unpack(bits.as_buffer(), marks.values.to_numpy(), int(ends[-1]), CHECKPOINT).astype("<u4")
                own = [ids[e - m : e].tobytes() for e, m in zip(ends.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([docs.values, pa.array(start.as_py() + ends - n), pa.array(n), pa.array(own, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    shape = f"start bigint, doc_ids array<{kind}>, lengths array<bigint>, checkpoints array<bigint>, bits binary"
    blocks = spark.read.schema(shape).parquet(f"{path}/blocks")
    return blocks.mapInArrow(decode, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary")
