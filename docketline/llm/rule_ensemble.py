"""Quality classifier: a sparse rule ensemble over text statistics.

1. One pass over the texts gives a struct of statistics (counts and shares over
   the whole text, no labels, language, source or id).
2. A small random forest is grown on the labelled rows by Spark ML. Each path
   from a root to a node is a conjunctive rule over the statistics.
3. Logistic regression with a lasso penalty on all rules gives most of them
   weight zero.
4. The rest are compiled into one Spark column expression: the sigmoid of the
   intercept and the weights of the rules that hold. Scoring needs no model
   object and no Python.

All labelled rows are used, equal ones as one with a weight; training is
distributed, and the driver holds only trees and weights. How the tables are laid
out has no part in the trees; the weights' sums may differ in their last digits.

Defined results: null and empty texts have zero statistics and a score like any
other text; rows whose label is null don't train; a document with several labels
trains once with each; with no labels, or one kind only, the score is the share
of label 1 (0.5 without any). Ties and repeated rows get equal scores. Other
columns pass through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketline.llm.common import CONTINUATION, fresh, materialize, text_struct

TREES = 10
DEPTH = 3
LASSO = 0.001
THRESHOLD = 0.3
#: Labelled rows a training partition.
PART_ROWS = 5000

STATISTICS = ["n_words", "n_lines", "chars_per_word", "upper_share", "digit_share", "symbol_share", "mark_share", "bar_share",
              "space_share", "distinct_share", "top_word_share", "repeat_next_share", "distinct_line_share", "words_per_line",
              "end_mark_share", "other_letter_share", "longest_word"]
#: The bytes counted as symbols and as marks.
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&<>@^~\\{}[]=_+", "mark": b"!?.,;:",
            "bar": b"|", "space": b" \t\n\x0b\x0c\r"}


def statistics(text: bytes | None) -> tuple:
    """The values of STATISTICS for one text."""
    if not text:
        return (0.0,) * len(STATISTICS)
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    points = len(text.translate(None, CONTINUATION))
    n = len(words) or 1
    share = {k: (len(text) - len(text.translate(None, v))) / points for k, v in _CLASSES.items()}
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words] or [0])
    ends = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    plain = len(text.translate(None, bytes(range(128, 256))))
    return (float(len(words)), float(len(lines)), points * (1 - share["space"]) / n, share["upper"], share["digit"], share["symbol"],
            share["mark"], share["bar"], share["space"], len(number) / n, float(np.bincount(ids).max()) / n,
            float((ids[1:] == ids[:-1]).sum()) / n, len(set(lines)) / max(1, len(lines)), len(words) / max(1, len(lines)),
            ends / max(1, len(lines)), (points - plain) / points, float(max(map(len, words), default=0)))


def with_statistics(docs: DataFrame, text_col: str, out: str) -> DataFrame:
    fields = pa.struct([(k, pa.float64()) for k in STATISTICS])
    udf = text_struct(lambda: statistics, fields, ", ".join(f"{k} double" for k in STATISTICS))
    return docs.withColumn(out, udf(F.col(f"`{text_col}`")))


Rule = tuple[tuple[int, bool, float], ...]  # (statistic, at most, threshold) conditions


def tree_rules(model) -> list[Rule]:
    """The conditions on the way to every node of every tree but the roots,
    with those on the same statistic drawn together, and without repeats."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[int, bool], float]) -> None:
        if path:
            found.setdefault(tuple(sorted((f, le, t) for (f, le), t in path.items())))
        if node.getClass().getSimpleName() != "InternalNode":
            return
        f, t = node.split().featureIndex(), node.split().threshold()
        walk(node.leftChild(), path | {(f, True): min(t, path.get((f, True), t))})
        walk(node.rightChild(), path | {(f, False): max(t, path.get((f, False), t))})

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(found)


def holds(rule: Rule, stats: Callable[[str], Column]) -> Column:
    out = F.lit(True)
    for f, at_most, t in rule:
        x = stats(STATISTICS[f])
        out = out & ((x <= t) if at_most else (x > t))
    return out.cast("double")


class Ensemble:
    """Weighted rules and an intercept."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self, stats: Callable[[str], Column]) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.lit(weight) * holds(rule, stats)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def weighted_rows(train: DataFrame, stats_col: str, label_col: str) -> DataFrame:
    """(statistics, y, weight): equal labelled rows as one with their number as
    weight. The forest draws by partition and place there, so rows are placed and
    ordered by their values, in a number of partitions that follows from theirs."""
    stats = [F.col(f"`{stats_col}`")[k].alias(k) for k in STATISTICS]
    names = [*STATISTICS, "y"]
    rows = train.where(F.col(label_col).isNotNull()).select(*stats, F.col(label_col).cast("double").alias("y"))
    rows = materialize(rows.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("weight")), "training-rows")
    return rows.repartition(1 + rows.count() // PART_ROWS, F.xxhash64(*names)).sortWithinPartitions(*names)


def fit(train: DataFrame, stats_col: str, label_col: str, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Ensemble:
    """Grow trees on the labelled rows, extract rules, fit sparse weights."""
    counts = {int(r[0]): r[1] for r in train.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).cast("int")).count().collect()}
    total, ones = sum(counts.values()), counts.get(1, 0)
    if len(counts) < 2 or set(counts) - {0, 1}:
        if set(counts) - {0, 1}:
            raise ValueError("labels must be 0 or 1")
        share = min(max(ones / total if total else 0.5, 1e-6), 1 - 1e-6)
        return Ensemble([], math.log(share / (1 - share)))
    rows = weighted_rows(train, stats_col, label_col)
    rows = rows.select("*", array_to_vector(F.array(*STATISTICS)).alias("x"))
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", weightCol="weight", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird",
                                    minInstancesPerNode=5, seed=1, maxBins=48).fit(rows)
    rules = tree_rules(forest)
    if not rules:
        return Ensemble([], math.log(ones / (total - ones)))
    design = rows.select("y", "weight", array_to_vector(F.array(*[holds(r, F.col) for r in rules])).alias("r"))
    model = LogisticRegression(featuresCol="r", labelCol="y", weightCol="weight", regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=60).fit(design)
    return Ensemble([(r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w], float(model.intercept))


def held_out(id_: Column) -> Column:
    """The fold that labels are never learnt from: crc32(id as text) mod 5 = 0."""
    return F.pmod(F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def learn(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "quality",
          **kw) -> tuple[Ensemble, DataFrame]:
    """The ensemble, and the written table (id, held_out, stats) of all rows."""
    table = with_statistics(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "text", "stats")
    table = materialize(table.select("id", held_out(F.col("id")).alias("held_out"), "stats"), "text-statistics")
    y = labels.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{label_col}`").alias("label"))
    train = table.where(~F.col("held_out")).join(y, F.col("id") == F.col("label_id")).select("stats", "label")
    train = materialize(train, "labelled-statistics")  # training passes over it many times
    return fit(train, "stats", "label", **kw), table


def score_table(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """(id, held_out, score, predicted) of every document."""
    model, table = learn(docs, labels, **kw)
    score = model.score(lambda k: F.col("stats")[k])
    return table.select("id", "held_out", score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))


def quality_filter(docs: DataFrame, labels: DataFrame, text_col: str = "text", threshold: float = THRESHOLD, **kw) -> DataFrame:
    """The documents that the ensemble accepts. Texts are read once more
    instead of being written with their statistics."""
    model, _ = learn(docs, labels, text_col, **kw)
    stats = fresh(docs, "stats")
    scored = with_statistics(docs, text_col, stats)
    return scored.where(model.score(lambda k: F.col(stats)[k]) >= threshold).drop(stats)
