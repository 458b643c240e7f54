"""Secret scans: fixed patterns, and a linear-chain conditional random field.

The patterns give base spans. The random field tags small tokens as secret
begin, inside or outside, from the token's shape, the tokens around it and
features of the file, and is decoded by Viterbi; what it finds beside the base
spans is added. It is trained on base spans of a bounded sample of texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.bpe import Memo, slices
from tenure.llm.common import picked, written

#: Fixed kinds and patterns: (kind, pattern, group that is measured, least length of it).
KINDS = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: The kind of spans that the random field adds, listed last.
ADDED = "crf"
_HEX_RUN = re.compile(r"[0-9a-f]{24}")
#: A token with the white space before it: letters, digits, or one other character.
_TOKEN = re.compile(r"\s*(?:[^\W\d_]+|\d+|[^\w\s]|_)")
#: Tokens before and after that a token's features look at.
AROUND = (-3, -2, -1, 0, 1)
#: Tags, and a span that the field adds must have this many code points (as an assigned base secret).
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
LEAST_ADDED = 6


def base_spans(text: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, kind, start and end of the measured part) by start, then kind; leftmost matches per kind."""
    out = []
    for kind, pattern, group, least in KINDS:
        if kind == "hex" and not _HEX_RUN.search(text) or kind == "access" and "AKIA" not in text:
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((*m.span(), kind, *m.span(group)))
    order = [k for k, *_ in KINDS]
    return sorted(out, key=lambda s: (s[0], order.index(s[2])))


_VOWELS = frozenset("aeiouyäöüáéíóúàèêâîôûœæ")


def shape(token: str) -> str:
    """White space before it, class, and length class of a token."""
    core = token.lstrip()
    glued = "g" if len(core) == len(token) else "n" if "\n" in token else "s"
    low = core.lower()
    if core.isdigit():
        kind = "d"
    elif core.isalpha():
        kind = "x" if all("a" <= c <= "f" for c in low) else "a"
        kind += "U" if core.isupper() else "l" if core == low else "T" if core[1:] == low[1:] else "M"
        kind += "v" if not _VOWELS.isdisjoint(low) else "c"
    else:
        kind = core if core.isascii() else "u"
    n = len(core)
    return f"{glued}{kind}{n if n < 5 else 5 if n < 8 else 8 if n < 16 else 16}"


def word(token: str) -> str:
    """What a token's identity is to others: short words and symbols, no numbers."""
    core = token.strip().lower()
    return core if len(core) <= 12 and not core.isdigit() else ""


#: What stands before and after a text.
EDGE = ""


def token_features(token: str) -> list[str]:
    s = shape(token) if token else "^"
    return [f"s{s}", f"g{s[:1]}", f"k{s[1:3]}", f"w{word(token)}"]


def file_features(text: str, n_tokens: int) -> list[str]:
    """Coarse features of the whole text: how dense assignments, quotes, braces and lines are."""

    def level(n: int) -> int:
        return min(4, 20 * n // max(1, n_tokens))

    return [f"F={level(text.count('=') + text.count(':'))}", f'F"{level(text.count(chr(34)))}', f"F{{{level(text.count('{'))}", f"Fl{level(text.count(chr(10)))}"]


def tokens_of(text: str) -> list[str]:
    return _TOKEN.findall(text)


@dataclass
class Field:
    """``weights``: feature at an offset (or of the file) to one weight per tag; ``steps``: tag to tag."""

    weights: dict[str, np.ndarray]
    steps: np.ndarray

    def rows(self, features: list[str]) -> np.ndarray:
        """What a token with these features adds to the tokens around it: (offset, tag)."""
        zero = np.zeros(3)
        return np.array([sum((self.weights.get(f"{o}{f}", zero) for f in features), zero) for o in AROUND])

    def file(self, text: str, n_tokens: int) -> np.ndarray:
        zero = np.zeros(3)
        return sum((self.weights.get(f, zero) for f in file_features(text, n_tokens)), zero)


def viterbi(scores: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Best tags of (n, 3) scores; the sequence starts and ends outside."""
    n = len(scores)
    best, back = scores[0] + steps[OUTSIDE], np.zeros((n, 3), np.int64)
    for i in range(1, n):
        options = best[:, None] + steps
        back[i] = options.argmax(0)
        best = options.max(0) + scores[i]
    tags = np.zeros(n, np.int64)
    tags[-1] = (best + steps[:, OUTSIDE]).argmax()
    for i in range(n - 1, 0, -1):
        tags[i - 1] = back[i, tags[i]]
    return tags


class Tagger:
    """Tags texts with the best path of a field; a worker keeps one.

    A token's part in the scores depends on its shape and, for words that the
    field knows, the word, so scores are sums of rows of two small tables.
    """

    def __init__(self, field: Field):
        self.field, t = field, field.steps
        # what another tag can gain on both sides of a token at most: past this margin the best path is outside there
        self.margin = max(t[p, x] + t[x, q] - t[p, OUTSIDE] - t[OUTSIDE, q] for p in range(3) for q in range(3) for x in (BEGIN, INSIDE))
        known = sorted({f[len(str(o)) + 1 :] for f in field.weights for o in AROUND if f.startswith(f"{o}w")} - {""})
        self.words = {w: i + 1 for i, w in enumerate(known)}
        self.by_word = np.stack([field.rows([f"w{w}"]) for w in ["", *known]])
        self.shapes: dict[str, int] = {}
        self.by_shape: list[np.ndarray] = []
        self.number = Memo(self._number, 150_000)

    def _number(self, token: str) -> int:
        s = shape(token) if token else "^"
        if s not in self.shapes:
            self.shapes[s] = len(self.by_shape)
            self.by_shape.append(self.field.rows([f"s{s}", f"g{s[:1]}", f"k{s[1:3]}"]))
        return self.shapes[s] * len(self.by_word) + self.words.get(word(token), 0)

    def tags(self, texts: list[str], tokens: list[list[str]]) -> list[np.ndarray | None]:
        """Per text the tags of its tokens, None where all are outside."""
        pad = [EDGE] * 3
        flat = np.array([*map(self.number.__getitem__, pad)], np.int64)
        parts, starts, at = [flat], [], 3
        for ws in tokens:
            starts.append(at)
            parts += [np.fromiter(map(self.number.__getitem__, ws), np.int64, len(ws)), flat]
            at += len(ws) + 3
        flat = np.concatenate(parts)
        a, b = np.stack(self.by_shape), self.by_word
        shapes, own = np.divmod(flat, len(b))
        scores = np.zeros((len(flat), 3))
        for k, o in enumerate(AROUND):
            part = a[shapes, k] + b[own, k]
            if o < 0:
                scores[-o:] += part[:o]
            elif o:
                scores[:-o] += part[o:]
            else:
                scores += part
        inside = np.zeros(len(flat), bool)
        for s, t, ws in zip(starts, texts, tokens, strict=True):
            scores[s : s + len(ws)] += self.field.file(t, len(ws))
            inside[s : s + len(ws)] = True
        open_ = inside & (scores[:, OUTSIDE] - scores[:, 1:].max(1) <= self.margin)
        edges = np.flatnonzero(np.diff(open_.astype(np.int8), prepend=0, append=0))
        found = np.zeros(len(flat), np.int64)
        for i, j in edges.reshape(-1, 2).tolist():
            found[i:j] = viterbi(scores[i:j], self.field.steps)
        return [x if (x := found[s : s + len(ws)]).any() else None for s, ws in zip(starts, tokens, strict=True)]


def spans_of(text: str, tags: np.ndarray) -> list[tuple[int, int]]:
    """Spans of begin and inside tags; white space ends a span."""
    out: list[list[int]] = []
    open_ = False
    for m, tag in zip(_TOKEN.finditer(text), tags.tolist(), strict=True):
        core = m.end() - len(m.group().lstrip())
        if tag == OUTSIDE:
            open_ = False
        elif tag == INSIDE and open_ and core == out[-1][1]:
            out[-1][1] = m.end()
        else:
            out.append([core, m.end()])
            open_ = True
    return [(a, b) for a, b in out]


def taught_tags(text: str) -> tuple[list[str], np.ndarray]:
    """Tokens of a text, and tags that the measured parts of its base spans give them."""
    tokens, tags, at = [], [], 0
    parts = sorted((a, b) for _, _, _, a, b in base_spans(text))
    k = 0
    for m in _TOKEN.finditer(text):
        tokens.append(m.group())
        at = m.end() - len(m.group().lstrip())
        while k < len(parts) and parts[k][1] <= at:
            k += 1
        if k < len(parts) and parts[k][0] < m.end():
            tags.append(BEGIN if at <= parts[k][0] or not tags or tags[-1] == OUTSIDE else INSIDE)
        else:
            tags.append(OUTSIDE)
    return tokens, np.array(tags, np.int64)


#: A stretch to learn from: its tokens with those around it, its tags, the file's features.
Lesson = tuple[list[str], np.ndarray, list[str]]


def lessons(text: str, near: int = 15, most: int = 4) -> list[Lesson]:
    """Stretches of a text to learn from: around base spans, around other numbers and
    symbols, and elsewhere, at most ``most`` of each kind."""
    tokens, tags = taught_tags(text)
    file = file_features(text, len(tokens))
    padded = [EDGE] * -AROUND[0] + tokens + [EDGE] * AROUND[-1]
    taught = np.flatnonzero(tags == BEGIN).tolist()
    other = [i for i, t in enumerate(tokens) if tags[i] == OUTSIDE and not t.strip().isalpha()]
    plain = [int(xxhash.xxh64_intdigest(text.encode(), k) % len(tokens)) for k in range(2)] if tokens else []
    out, done = [], -1
    for i in sorted(taught[:most] + other[:: max(1, len(other) // most)][:most] + plain):
        first, last = max(i - near, done + 1), min(i + near, len(tokens) - 1)
        if first <= last:
            done = last
            out.append((padded[first : last + 1 + len(AROUND) - 1], tags[first : last + 1], file))
    return out


def fit(stretches: list[Lesson], least: int = 3, rounds: int = 6, rate: float = 0.3, seed: int = 5) -> Field:
    """Maximum likelihood by forward-backward and AdaGrad over small batches.

    Features met fewer than ``least`` times are left out. The same stretches give the same field.
    """
    index: dict[str, int] = {}
    number = lambda f: index.setdefault(f, len(index))
    of_token: dict[str, np.ndarray] = {}
    coded = []
    for padded, tags, file in stretches:
        for t in padded:
            if t not in of_token:
                fs = token_features(t)
                of_token[t] = np.array([[number(f"{o}{f}") for f in fs] for o in AROUND], np.int32)
        own, n = np.stack([of_token[t] for t in padded]), len(tags)
        parts = [own[o - AROUND[0] : o - AROUND[0] + n, k] for k, o in enumerate(AROUND)]
        whole = np.broadcast_to(np.array([number(f) for f in file], np.int32), (n, len(file)))
        coded.append((np.concatenate([*parts, whole], 1), tags))
    seen = np.zeros(len(index), np.int64)
    for x, _ in coded:
        np.add.at(seen, x.ravel(), 1)
    kept = np.flatnonzero(seen >= least)
    none = len(kept)
    place = np.full(len(index), none, np.int32)
    place[kept] = np.arange(none)
    coded = [(place[x], tags) for x, tags in coded]
    w, g2 = np.zeros((none + 1, 3)), np.full((none + 1, 3), 1e-2)
    steps, s2 = np.zeros((3, 3)), np.full((3, 3), 1e-2)
    rnd = np.random.default_rng(seed)
    for _ in range(rounds):
        for part in np.array_split(rnd.permutation(len(coded)), max(1, len(coded) // 64)):
            dw, ds = _gradient([coded[i] for i in part], w, steps)
            dw, ds = dw / len(part) - 1e-4 * w, ds / len(part) - 1e-4 * steps
            dw[none] = 0
            g2 += dw**2
            s2 += ds**2
            w += rate * dw / np.sqrt(g2)
            steps += rate * ds / np.sqrt(s2)
    return Field({f: w[place[i]] for f, i in index.items() if place[i] != none and np.abs(w[place[i]]).max() > 1e-3}, steps)


def _gradient(part, w: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the log-likelihood of stretches, which start and end outside."""
    n, most = len(part), max(len(t) for _, t in part)
    scores, live, gold = np.zeros((n, most, 3)), np.zeros((n, most), bool), np.zeros((n, most), np.int64)
    for k, (x, t) in enumerate(part):
        scores[k, : len(t)], live[k, : len(t)], gold[k, : len(t)] = w[x].sum(1), True, t
    scores[~live] = [0.0, -1e4, -1e4]  # past the end: outside
    top = lambda a, axis: (m := a.max(axis)) + np.log(np.exp(a - np.expand_dims(m, axis)).sum(axis))
    fwd, bwd = np.zeros((most, n, 3)), np.zeros((most, n, 3))
    fwd[0] = steps[OUTSIDE] + scores[:, 0]
    for i in range(1, most):
        fwd[i] = top(fwd[i - 1][:, :, None] + steps, 1) + scores[:, i]
    bwd[-1] = steps[:, OUTSIDE]
    for i in range(most - 2, -1, -1):
        bwd[i] = top(steps + (scores[:, i + 1] + bwd[i + 1])[:, None, :], 2)
    total = top(fwd[-1] + bwd[-1], 1)
    own = np.exp(fwd + bwd - total[None, :, None])  # (step, stretch, tag)
    miss = np.eye(3)[gold] - own.transpose(1, 0, 2)
    dw = np.zeros_like(w)
    for k, (x, t) in enumerate(part):
        for j in range(3):
            dw[:, j] += np.bincount(x.ravel(), np.repeat(miss[k, : len(t), j], x.shape[1]), len(w))
    ds = np.zeros((3, 3))
    for i in range(1, most):
        both = np.exp(fwd[i - 1][:, :, None] + steps + (scores[:, i] + bwd[i])[:, None, :] - total[:, None, None])
        on = live[:, i]
        ds -= both[on].sum(0)
        np.add.at(ds, (gold[on, i - 1], gold[on, i]), 1)
    np.add.at(ds, (np.zeros(n, np.int64), gold[:, 0]), 1)
    ds[OUTSIDE] -= own[0].sum(0)
    last = live.sum(1) - 1
    np.add.at(ds, (gold[np.arange(n), last], np.zeros(n, np.int64)), 1)
    ds[:, OUTSIDE] -= own[last, np.arange(n)].sum(0)
    return dw, ds


def train(docs: DataFrame, text_col: str = "text", max_texts: int = 1_000, near: int = 15, most: int = 4) -> Field | None:
    """A field from at most ``max_texts`` distinct texts with an assignment, key or hex run
    and half as many others (least text hashes first); None where no text has one.
    ``near`` and ``most`` bound what one text teaches (``lessons``).

    The sample is all that comes to the driver, as a few short stretches of tokens
    per text; which texts are in it depends on the texts alone.
    """
    own = picked(docs, text=text_col).filter("text is not null").withColumn("th", F.xxhash64("text"))
    likely = r"(?i)(?:passw|secret|token|api_?key)[^\n]{0,4}[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"
    # written once: both samples are taken from it, and texts are matched in one pass
    keys = written(own.select("th", F.col("text").rlike(likely).alias("likely")).distinct(), "likely")
    some = keys.filter("likely").orderBy("th").limit(max_texts).union(keys.filter("not likely").orderBy("th").limit(max_texts // 2))
    rows = own.join(F.broadcast(some.select("th")), "th").dropDuplicates(["th"])

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for th, t in zip(b.column("th").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = lessons(t, near, most)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([th] * len(found), pa.int64()), pa.array(range(len(found)), pa.int64()), pa.array([x[0] for x in found], pa.list_(pa.string())),
                     pa.array([x[1].tolist() for x in found], pa.list_(pa.int64())), pa.array([x[2] for x in found], pa.list_(pa.string()))],
                    ["th", "k", "tokens", "tags", "file"])

    shape_ = "th bigint, k bigint, tokens array<string>, tags array<bigint>, file array<string>"
    taught = sorted(rows.select("th", "text").mapInArrow(teach, shape_).collect(), key=lambda r: (r["th"], r["k"]))
    stretches = [(r["tokens"], np.array(r["tags"], np.int64), r["file"]) for r in taught]
    return fit(stretches) if any((t == BEGIN).any() for _, t, _ in stretches) else None


def scan(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, base, added``, arrays of (start, end, kind) spans in
    code points, end exclusive, by start and kind.

    ``base`` holds the leftmost non-overlapping matches of each pattern, ``added`` the
    field's spans of ``LEAST_ADDED`` code points or more that no base span covers: where
    a pattern catches only a part of a secret, the whole of it is added beside the part.

    Defined cases: a null or empty text has no span; null and repeated ids get a row
    per input row; without a field (nothing to learn from) nothing is added; an
    empty table gives an empty table; other columns are ignored.

    Scale: one narrow pass; memory per task is one Arrow batch in parts and the
    field, which grows with the training sample only.
    """
    own = picked(docs, doc_id=id_col, text=text_col)
    shared = own.sparkSession.sparkContext.broadcast(field)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    as_rows = lambda spans: [{"start": a, "end": b, "kind": k} for a, b, k in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value) if shared.value else None
        for whole in batches:
            for b in slices(whole, "text", 1 << 20):
                texts = [t or "" for t in b.column("text").to_pylist()]
                bases = [[s[:3] for s in base_spans(t)] for t in texts]
                added: list[list] = [[] for _ in texts]
                for k, tags in enumerate(tagger.tags(texts, [*map(tokens_of, texts)]) if tagger else []):
                    if tags is not None:
                        free = [(x, y) for x, y in spans_of(texts[k], tags) if y - x >= LEAST_ADDED]
                        added[k] = [(x, y, ADDED) for x, y in free if not any(s <= x and y <= e for s, e, _ in bases[k])]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([*map(as_rows, bases)], span), pa.array([*map(as_rows, added)], span)], ["doc_id", "base", "added"])

    kind = own.schema["doc_id"].dataType.simpleString()
    kind_of = "array<struct<start:int,end:int,kind:string>>"
    return own.mapInArrow(run, f"doc_id {kind}, base {kind_of}, added {kind_of}")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then kind as listed."""
    order = F.array(*[F.lit(k) for k, *_ in KINDS], F.lit(ADDED))
    by = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("n"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(by, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_texts: int = 1_000, near: int = 15, most: int = 4) -> DataFrame:
    """Train on a sample of ``docs``, scan all of them, and list the spans of every row."""
    found = scan(docs, train(docs, text_col, max_texts, near, most), id_col, text_col)
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
    )
