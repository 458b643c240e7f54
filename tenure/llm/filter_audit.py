"""Filter interaction audit: what each filter removes, in every order.

Documents become failure masks; masks are counted per part; per part a
count-weighted decision diagram of the masks is built. The orders are visited by
adjacent level swaps of that diagram, and each order's all-pass path gives its
steps, so no document and no mask is visited again for another order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.llm.common import UPPER, picked, words, written

#: A document with one of these fails filter D.
SYMBOLS = "[#$%&*|]"


class Diagram:
    """A reduced diagram of weighted masks, one level per variable.

    A node is (pass child, fail child); a leaf is the weights of one mask, a tuple.
    Equal nodes are one node (``nodes`` has each under its own value), and no level is
    left out, so a node's weights are the sum over its children.
    """

    def __init__(self, masks: dict[int, tuple], variables: int, weights: int):
        self.order = list(range(variables))
        self.zero = (0,) * weights
        self.leaves, self.nodes, self.children, self.sums = {}, {}, {}, {}
        self.root = self._build(masks, 0)

    def _leaf(self, weights: tuple) -> int:
        key = self.leaves.setdefault(weights, len(self.leaves) + len(self.nodes))
        self.sums[key] = weights
        return key

    def node(self, passes: int, fails: int) -> int:
        if (passes, fails) not in self.nodes:
            key = self.nodes[passes, fails] = len(self.leaves) + len(self.nodes)
            self.sums[key] = tuple(a + b for a, b in zip(self.sums[passes], self.sums[fails], strict=True))
            self.children[key] = (passes, fails)
        return self.nodes[passes, fails]

    def _build(self, masks: dict[int, tuple], level: int) -> int:
        if level == len(self.order):
            return self._leaf(masks.get(0, self.zero))
        bit = 1 << self.order[level]
        return self.node(
            self._build({m: w for m, w in masks.items() if not m & bit}, level + 1),
            self._build({m ^ bit: w for m, w in masks.items() if m & bit}, level + 1),
        )

    def swap(self, level: int) -> None:
        """Exchange the variables of ``level`` and ``level + 1``; only nodes down to the upper one change."""
        seen: dict[int, int] = {}

        def rebuilt(node: int, above: int) -> int:
            if node not in seen:
                a, b = self.children[node]
                if above:
                    seen[node] = self.node(rebuilt(a, above - 1), rebuilt(b, above - 1))
                else:
                    (a0, a1), (b0, b1) = self.children[a], self.children[b]
                    seen[node] = self.node(self.node(a0, b0), self.node(a1, b1))
            return seen[node]

        self.root = rebuilt(self.root, level)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, tuple, tuple]]:
        """(variable, weights kept, weights removed) along the all-pass path."""
        out, at = [], self.root
        for v in self.order:
            at, failed = self.children[at]
            out.append((v, self.sums[at], self.sums[failed]))
        return out


def plain_changes(n: int) -> Iterator[int]:
    """Levels of the adjacent swaps that visit all n! orders, each once."""
    if n > 1:
        down = True
        inner = plain_changes(n - 1)
        while True:
            yield from range(n - 2, -1, -1) if down else range(n - 1)
            move = next(inner, None)
            if move is None:
                return
            yield move + down  # the last variable stands first after a way down
            down = not down


def part_audit(masks: dict[int, tuple], filters: str) -> Iterator[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, losses..., shapley) of one part."""
    k, weights = len(filters), len(next(iter(masks.values())))
    diagram = Diagram(masks, k, weights)
    fails = [sum(w[0] for m, w in masks.items() if m >> v & 1) for v in range(k)]
    alone = [masks.get(1 << v, diagram.zero)[0] for v in range(k)]
    found = {tuple(diagram.order): diagram.steps()}
    for level in plain_changes(k):
        diagram.swap(level)
        found[tuple(diagram.order)] = diagram.steps()
    shapley = [0] * k
    for steps in found.values():
        for v, _, removed in steps:
            shapley[v] += removed[0]
    for order in sorted(found):
        name = "".join(filters[v] for v in order)
        for i, (v, kept, removed) in enumerate(found[order], 1):
            yield (name, i, kept[0], removed[0], fails[v] - removed[0], alone[v], *removed[1:], shapley[v])


def audit(docs: DataFrame, filters: str, part_col: str, losses: tuple[str, ...] = ()) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails``, a column per
    name of ``losses``, and ``shapley``: one row per part, order of ``filters`` and step.

    ``docs`` has a boolean column ``fails_X`` per letter X of ``filters`` (null: passes)
    and a boolean column per loss (null: false); a null part is the empty string.
    An empty table has no part and no row.

    Scale: documents are reduced to counts per (part, mask, losses) before the
    shuffle; a part is one group of at most 2^k rows, whatever its size.
    """
    mask = sum((F.coalesce(F.col(f"fails_{x}"), F.lit(False)).cast("int") * (1 << i) for i, x in enumerate(filters)), F.lit(0))
    n = F.col("n") if "n" in docs.columns else F.lit(1)
    counted = [F.sum(n).cast("long").alias("n")]
    counted += [F.sum(F.when(F.coalesce(F.col(c), F.lit(False)), n).otherwise(0)).cast("long").alias(f"w_{c}") for c in losses]
    counts = docs.groupBy(F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), mask.alias("mask")).agg(*counted)
    names = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *losses, "shapley"]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        part = pdf["part"].iloc[0]
        weights = ["n", *(f"w_{c}" for c in losses)]
        masks = {int(m): tuple(map(int, w)) for m, w in zip(pdf["mask"], pdf[weights].itertuples(index=False), strict=True)}
        return pd.DataFrame([(part, *row) for row in part_audit(masks, filters)], columns=names)

    shape = ", ".join(f"{c} {'string' if c in ('part', 'filter_order') else 'int' if c == 'step' else 'bigint'}" for c in names)
    return counts.groupBy("part").applyInPandas(one, shape)


def own_failures(text: Column) -> dict[str, Column]:
    """Filters A to D of a text that isn't null."""
    return {
        "A": F.col("n_words") < 100,
        "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
        "C": 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))) > 10 * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def text_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``doc_id, lang, text_key, fails_A .. fails_D``: one row per document.

    A: under 100 words; B: under 80 % of the words distinct; C: over 10 % of the
    code points in A-Z; D: a symbol of ``SYMBOLS``. ``text_key`` is the SHA-256 of the
    text, by which ``with_losses`` adds E (the same text under a smaller id). A
    null text is empty, and an empty text fails A alone of these.
    """
    own = picked(docs, doc_id=id_col, text=text_col, lang=part_col).withColumn("text", F.coalesce("text", F.lit("")))
    ws = own.withColumn("ws", words(F.col("text")))
    sized = ws.select("doc_id", "lang", "text", F.size("ws").alias("n_words"), F.size(F.array_distinct("ws")).alias("n_distinct"))
    flags = [c.alias(f"fails_{x}") for x, c in own_failures(F.col("text")).items()]
    return sized.select("doc_id", "lang", F.unhex(F.sha2("text", 256)).alias("text_key"), *flags)


def with_losses(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **losses: str) -> DataFrame:
    """Counted rows ``lang, fails_A .. fails_E, <losses>, n`` of what ``text_failures`` returns.

    ``losses`` names columns by the label column that is 1 for them; a document
    without a label loses nothing, and several labels of one id count once, as 1
    if one of them is. A document fails E if its text stands under a smaller id
    anywhere in the table; rows of one id and null ids are no smaller than each other,
    and a null id is after all others.

    Scale: texts stay where they are; the rows moved are ids, keys and flags. A text that
    a third of the rows hold is reduced, before the shuffle by its key, to one row per
    task, part and set of losses.
    """
    flags = [c for c in docs.columns if c.startswith("fails_")]
    marks = [F.max((F.col(c) == 1).cast("int")).alias(f"is_{c}") for c in dict.fromkeys(losses.values())]
    known = picked(labels, label_id=id_col, **{c: c for c in losses.values()}).filter("label_id is not null").groupBy("label_id").agg(*marks)
    lost = [F.coalesce(F.col(f"is_{c}") == 1, F.lit(False)).alias(name) for name, c in losses.items()]
    joined = docs.join(known, docs["doc_id"] == F.col("label_id"), "left").select("doc_id", "lang", "text_key", *flags, *lost)
    # one row per key, part and losses: how many rows, and how many of them have the least id
    group = ["text_key", "lang", *losses]
    rank = F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id").alias("id"))
    per_id = joined.groupBy(*group, "doc_id").agg(F.count("*").alias("n"), *[F.first(f).alias(f) for f in flags])
    groups = per_id.groupBy(*group).agg(F.sum("n").alias("n"), F.min(F.struct(rank.alias("rank"), F.col("n").alias("n"))).alias("first"), *[F.first(f).alias(f) for f in flags])
    groups = written(groups, "text_groups")
    least = groups.groupBy("text_key").agg(F.min("first.rank").alias("least"))
    met = groups.join(least, "text_key")
    at_least = F.when(F.col("first.rank") == F.col("least"), F.col("first.n")).otherwise(F.lit(0))
    rows = met.select("lang", *flags, *losses, F.explode(F.array(
        F.struct(F.lit(False).alias("e"), at_least.alias("n")), F.struct(F.lit(True).alias("e"), (F.col("n") - at_least).alias("n"))
    )).alias("x"))
    return rows.select("lang", *flags, F.col("x.e").alias("fails_E"), *losses, F.col("x.n").alias("n")).filter("n > 0")
