"""Toxicity by maximum-scoring segments.

Words get log-odds between toxic and other labelled texts with a Dirichlet
prior from the whole corpus; a linear scan finds every maximal-scoring passage
of a text; passages are judged by extreme-value statistics, and their evidence
becomes a probability by a logistic fit on the training rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.llm.bpe import Memo
from tenure.llm.common import fresh, picked, written

_WORD = re.compile(r"[^\W\d_]+")
#: Lengths of a word's prefixes that count as tokens beside the word: inflected
#: and compound forms that no training text holds back off to them.
PREFIXES = range(3, 9)
#: Words in each generation of a worker's memo.
MEMO = 150_000
#: Evidence beyond this counts as this: what is certain need not pull the fit.
SATURATED = 15.0


@dataclass
class Model:
    """``tokens``: token (a word, or a prefix and ``*``) to log-odds; ``rest``: the score of any other word."""

    tokens: dict[str, float] = field(default_factory=dict)
    rest: float = -0.01
    lam: float = 1.0
    k: float = 1.0
    intercept: float = 0.0
    slope: float = 0.0

    def word_score(self, word: str) -> float:
        own = [s for t in word_tokens(word.lower()) if (s := self.tokens.get(t)) is not None]
        return max(own) if own else self.rest

    def evidence(self, n: int, scores: list[float]) -> float:
        """Summed significance (minus the log of the expected number by chance) of a text's passages."""
        return sum(max(0.0, self.lam * s - math.log(max(self.k * n, 1e-9))) for s in scores)

    def probability(self, evidence: float) -> float:
        x = self.intercept + self.slope * min(evidence, SATURATED)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def word_tokens(word: str) -> list[str]:
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def segments(at: list[int], score: list[float], rest: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments of a sequence, in linear time.

    ``at`` and ``score`` list the positions with a positive score in order; all
    other positions score ``rest`` (negative). Returns (first, last, sum).
    """
    found: list[list] = []  # first, last, sum before it, sum with it
    total, before = 0.0, -1
    for i, s in zip(at, score, strict=True):
        total += rest * (i - before - 1)
        before = i
        new = [i, i, total, total + s]
        total += s
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
        found.append(new)
    return [(a, b, r - left) for a, b, left, r in found]


class Scorer:
    """Scores texts; a worker keeps one."""

    def __init__(self, model: Model):
        self.model, self.scores = model, Memo(model.word_score, MEMO)

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Words of the text, and its segments in words."""
        ws = _WORD.findall(text or "")
        scores = np.fromiter(map(self.scores.__getitem__, ws), float, len(ws))
        at = np.flatnonzero(scores > 0)
        if len(at):  # a word said again and again is said once
            at = at[[i == 0 or ws[i] != ws[i - 1] for i in at.tolist()]]
        return len(ws), segments(at.tolist(), scores[at].tolist(), self.model.rest) if len(at) else []


def _counted(rows: DataFrame, n: str) -> DataFrame:
    """Sums of ``n`` per token from (word, n)."""
    w = F.col("word")
    prefixes = [F.when(F.length(w) > k, F.concat(w.substr(1, k), F.lit("*"))) for k in PREFIXES]
    tokens = rows.select(F.explode(F.array_compact(F.array(w, *prefixes))).alias("token"), n)
    return tokens.groupBy("token").agg(F.sum(n).alias(n))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    usable: Column | None = None,
    max_labelled: int = 12_000,
    prior_words: float = 10_000.0,
    min_count: int = 3,
    min_z: float = 3.0,
    min_odds: float = 2.5,
) -> Model:
    """Fit the model on at most ``max_labelled`` labelled rows (least id hashes first).

    ``usable`` is a condition on the labels' id column. A word counts once
    per document that holds it, on both sides and in the whole corpus, so a passage
    that many documents hold counts as often. The Dirichlet prior of all tokens is worth ``prior_words`` words (at most a
    tenth of those in other labelled texts), shared out by its frequency in the whole corpus. Tokens with a z-score under
    ``min_z`` or log-odds under ``min_odds`` are left to the rest. Null ids, texts and labels, and labels without
    a document, are not used; of several labels of an id the largest counts.
    Without rows of both labels the model scores every text by the smoothed rate.

    The sample and all that is collected from it are bounded by
    ``max_labelled``; corpus counts cover every document, with partial sums per
    task for the candidate tokens.
    """
    own = labels.select(labels[f"`{id_col}`"].alias("doc_id"), labels[f"`{label_col}`"].cast("int").alias("toxic"))
    own = own.filter("doc_id is not null and toxic in (0, 1)")
    if usable is not None:
        own = own.filter(usable)
    sample = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = picked(docs, doc_id=id_col, text=text_col)
    rows = written(texts.join(F.broadcast(sample), "doc_id").filter("text is not null").select("doc_id", "text", "toxic"), "labelled")
    by_label = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_all, n_toxic = sum(by_label.values()), by_label.get(1, 0)
    rate = (n_toxic + 1) / (n_all + 2)
    flat = Model(intercept=math.log(rate / (1 - rate)))
    if not n_toxic or n_toxic == n_all:
        return flat

    def words_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            count = Counter(w for t in b.column("text").to_pylist() for w in {x.lower() for x in _WORD.findall(t)})
            yield pa.RecordBatch.from_arrays([pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], ["word", "n"])

    def held(label: int, n: str) -> DataFrame:
        words = rows.filter(F.col("toxic") == label).select("text").mapInArrow(words_held, "word string, n bigint")
        return written(words.groupBy("word").agg(F.sum("n").alias(n)), f"{n}_words")

    toxic, other = held(1, "seen"), held(0, "other")
    n_t, n_o = (float(df.agg(F.sum(c)).first()[0] or 0) for df, c in ((toxic, "seen"), (other, "other")))
    candidates = (
        _counted(toxic, "seen")
        .filter(F.col("seen") >= min_count)
        .join(_counted(other, "other"), "token", "left")
        .fillna({"other": 0})
        .filter((F.col("seen") / n_t) > 4 * (F.col("other") / max(n_o, 1.0)))
        .collect()
    )
    prior_words = min(prior_words, n_o / 10)
    corpus, n_c = corpus_counts(texts, [r["token"] for r in candidates])
    tokens, mass_t, mass_o = {}, 0.0, 0.0
    for r in candidates:
        prior = prior_words * (corpus[r["token"]] + 1) / (n_c + 1)
        a, b = r["seen"] + prior, r["other"] + prior
        odds = math.log(a / max(n_t + prior_words - a, 1.0)) - math.log(b / max(n_o + prior_words - b, 1.0))
        if odds >= min_odds and odds / math.sqrt(1 / a + 1 / b) >= min_z:
            tokens[r["token"]] = odds
            if not r["token"].endswith("*"):
                mass_t, mass_o = mass_t + a / (n_t + prior_words), mass_o + b / (n_o + prior_words)
    if not tokens:
        return flat
    model = Model(tokens, rest=min(-1e-3, math.log(max(1 - mass_t, 0.01) / max(1 - mass_o, 0.01))))
    fit = scored(rows.select("doc_id", "text", "toxic"), model, "text", keep=["toxic"]).select("toxic", "passages", "n_words").collect()
    others = [(r["n_words"], max((p["score"] for p in r["passages"]), default=0.0)) for r in fit if r["toxic"] == 0]
    # maximum likelihood of K for the largest passage of the other texts, given lambda (1 for log-odds scores)
    model.k = min(1.0, len(others) / max(sum(max(n, 1) * math.exp(-model.lam * s) for n, s in others), 1.0))
    x = np.array([min(SATURATED, model.evidence(r["n_words"], [p["score"] for p in r["passages"]])) for r in fit])
    model.intercept, model.slope = logistic(x, np.array([r["toxic"] for r in fit], float))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.02) -> tuple[float, float]:
    """Intercept and non-negative slope of a one-variable logistic fit (Newton steps, small ridge)."""
    design, w = np.stack([np.ones_like(x), x / 10], 1), np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (p - y) + ridge * w * [0, 1]
        hess = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-6, ridge])
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), max(0.0, float(w[1] / 10))


def corpus_counts(texts: DataFrame, tokens: list[str]) -> tuple[dict[str, int], int]:
    """How many (text, word of it) pairs hold each of ``tokens``, and all such pairs."""
    index = {t: i for i, t in enumerate(tokens)}
    shared = texts.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        which = Memo(lambda w: [index[t] for t in word_tokens(w) if t in index], MEMO)
        counts, total = Counter(), 0
        for b in batches:
            for t in b.column("text").to_pylist():
                ws = {w.lower() for w in _WORD.findall(t or "")}
                total += len(ws)
                for hit in filter(None, map(which.__getitem__, ws)):
                    counts.update(hit)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *counts], pa.int32()), pa.array([total, *counts.values()], pa.int64())], ["i", "n"])

    sums = {r["i"]: r["n"] for r in texts.select("text").mapInArrow(run, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    return {t: sums.get(i, 0) for t, i in index.items()}, sums.get(-1, 0)


_PASSAGE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None, names: tuple[str, str, str] = ("score", "n_words", "passages")) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default: all) and three more: the probability, the
    words, and the passages as (start, end, score) with code point offsets, end exclusive.

    A null, empty or wordless text has no passage and the lowest score.
    """
    keep = docs.columns if keep is None else keep
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = [*keep, *names]
    inputs = [*keep, *([] if text_col in keep else [text_col])]
    at = inputs.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scorer = Scorer(model)
        for b in batches:
            score, words, spans = [], [], []
            for t in b.column(at).to_pylist():
                n, found = scorer.passages(t)
                score.append(model.probability(model.evidence(n, [s for *_, s in found])))
                words.append(n)
                where = [m.span() for m in _WORD.finditer(t)] if found else []
                spans.append([{"start": where[i][0], "end": where[j][1], "score": s} for i, j, s in found])
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(score, pa.float64()), pa.array(words, pa.int32()), pa.array(spans, pa.list_(_PASSAGE))], out)

    schema = docs.select(*[f"`{c}`" for c in keep]).schema
    passage = T.StructType().add("start", T.IntegerType()).add("end", T.IntegerType()).add("score", T.DoubleType())
    schema.add(names[0], T.DoubleType()).add(names[1], T.IntegerType()).add(names[2], T.ArrayType(passage))
    return docs.select(*[f"`{c}`" for c in inputs]).mapInArrow(run, schema)


def usable_label() -> Column:
    """Rows that may teach: crc32 of the id as text leaves no remainder 1 by 3."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.7) -> DataFrame:
    """``docs`` without the rows that score ``least`` or more; all columns stay."""
    model = train(docs, labels, id_col, text_col, usable=usable_label())
    names = fresh(docs, "score", "n_words", "passages")
    return scored(docs, model, text_col, names=tuple(names)).filter(F.col(names[0]) < least).drop(*names)
