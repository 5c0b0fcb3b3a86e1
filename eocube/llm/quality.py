"""Quality classifier: a sparse rule ensemble over text statistics.

Shallow trees are grown on labelled rows; every path from a root is a rule, a conjunction
of comparisons of statistics. A logistic regression with an L1 penalty weighs the rules and
sets most weights to zero; the rest compiles into one Spark column expression, so that
scoring is plain arithmetic on the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eocube.llm.spans import IS_SPACE, U, mix, pieces, range_hashes, words
from eocube.llm.tables import free_name, written

STATISTICS = (
    "log_bytes", "letter_share", "digit_share", "upper_share", "stop_share", "symbol_share", "line_share",
    "mean_word", "longest_word", "distinct_words", "repeated_next", "distinct_triples", "bare_words",
    "marked_words", "top_word", "distinct_lines",
)

BYTE = np.arange(256)
UPPER = (BYTE >= 65) & (BYTE <= 90)
LETTER = UPPER | ((BYTE >= 97) & (BYTE <= 122)) | (BYTE >= 128)
DIGIT = (BYTE >= 48) & (BYTE <= 57)
STOP = np.isin(BYTE, np.frombuffer(b".,;:!?'\"-()", np.uint8))
SYMBOL = (BYTE > 32) & (BYTE < 127) & ~LETTER & ~DIGIT & ~STOP


def statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row per text, one column per name in ``STATISTICS``; zeros for an empty text."""
    n = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    letters = LETTER[buf]
    digits = DIGIT[buf]
    start, end, first = words(buf, offsets)
    count = np.diff(first).astype(float)
    some = np.maximum(count, 1)

    def per_word(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return (sums[first[1:]] - sums[first[:-1]]).astype(float)

    word = range_hashes(buf, start, end)
    solid = np.concatenate([[0], np.cumsum(letters | digits, dtype=np.int64)])
    bare = solid[end] == solid[start]
    lone = ~(letters | digits | IS_SPACE[buf])
    marked = np.zeros(len(word), bool)
    wide = end - start >= 3
    marked[wide] = lone[end[wide] - 1] & lone[end[wide] - 2]
    owner = np.repeat(np.arange(n), np.diff(first))
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    triples = mix(word[:-2] * U(3) + word[1:-1] * U(5) + word[2:] * U(7)) if len(word) > 2 else np.zeros(0, U)
    breaks = np.flatnonzero(buf == 10)
    line_start, line_end = _lines(breaks, offsets)
    line = range_hashes(buf, line_start, line_end)
    line_first = np.searchsorted(line_start, offsets)
    distinct = np.zeros((4, n))
    for r in range(n):
        a, z = first[r], first[r + 1]
        if z > a:
            w = np.sort(word[a:z])
            edge = np.flatnonzero(np.r_[True, w[1:] != w[:-1], True])
            distinct[0, r] = (len(edge) - 1) / (z - a)
            distinct[1, r] = np.diff(edge).max() / (z - a)
            if z - a > 2:
                t = np.sort(triples[a : z - 2])
                distinct[2, r] = (1 + (t[1:] != t[:-1]).sum()) / len(t)
        a, z = line_first[r], line_first[r + 1]
        if z > a:
            distinct[3, r] = len(np.unique(line[a:z])) / (z - a)
    longest = np.zeros(n)
    np.maximum.at(longest, owner, (end - start).astype(float))
    out = np.stack(
        [
            np.log1p(np.diff(offsets)), total(letters) / size, total(digits) / size,
            total(UPPER[buf]) / np.maximum(total(letters), 1), total(STOP[buf]) / size, total(SYMBOL[buf]) / size,
            total(buf == 10) / size, per_word(end - start) / some, np.log1p(longest), distinct[0],
            per_word(same) / some, distinct[2], per_word(bare) / some, per_word(marked) / some, distinct[1], distinct[3],
        ],
        axis=1,
    )
    out[np.diff(offsets) == 0] = 0
    return out


def _lines(breaks: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the non-empty lines of all texts."""
    edges = np.unique(np.concatenate([offsets, breaks + 1]))
    start, end = edges[:-1], edges[1:].copy()
    end[np.isin(end - 1, breaks)] -= 1
    keep = end > start
    return start[keep], end[keep]


def with_statistics(docs: DataFrame, text: str = "text", into: str = "_stats") -> DataFrame:
    """All columns of ``docs`` and a struct of the statistics of a text column."""
    kinds = T.StructType([T.StructField(s, T.DoubleType(), False) for s in STATISTICS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [statistics(buf, offsets) for _, _, buf, offsets in pieces(b.column(text))]
            table = np.concatenate([np.zeros((0, len(STATISTICS))), *found])
            stats = pa.StructArray.from_arrays([pa.array(c) for c in table.T.copy()], names=list(STATISTICS))
            yield pa.RecordBatch.from_arrays([*b.columns, stats], names=[*b.schema.names, into])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(into, kinds, False)]))


Condition = tuple[int, bool, float]  # statistic, whether above, threshold


@dataclass(frozen=True)
class RuleModel:
    """Rules with weights; a rule is a conjunction of ``(statistic, above, threshold)``."""

    intercept: float
    rules: tuple[tuple[float, tuple[Condition, ...]], ...]

    def score(self, stats: str = "_stats") -> Column:
        """The probability of the label 1 as a column expression."""
        z = F.lit(self.intercept)
        for weight, rule in self.rules:
            z = z + F.when(rule_column(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def rule_column(rule: tuple[Condition, ...], stats: str = "_stats") -> Column:
    out = F.lit(True)
    for name, above, threshold in rule:
        value = F.col(f"{stats}.{STATISTICS[name]}")
        out = out & (value > threshold if above else value <= threshold)
    return out


def tree_rules(text: str) -> set[tuple[Condition, ...]]:
    """The paths of a printed tree or forest as rules, each statistic with its tightest bounds."""
    rules: set[tuple[Condition, ...]] = set()
    path: list[tuple[int, Condition]] = []
    for line in text.splitlines():
        found = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+\d.eE]+)\)", line)
        if line.strip().startswith("Tree"):
            path = []
        if not found:
            continue
        depth = len(found[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (int(found[3]), found[4] == ">", float(found[5]))))
        tight: dict[tuple[int, bool], float] = {}
        for _, (name, above, threshold) in path:
            old = tight.get((name, above), threshold)
            tight[name, above] = max(old, threshold) if above else min(old, threshold)
        rules.add(tuple(sorted((n, a, t) for (n, a), t in tight.items())))
    return rules


def learning_rows(stats: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """Labelled rows outside the held-out fold, at most ``max_rows``, chosen by a hash of the id."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(label).cast("double").alias("label")
    )
    open_rows = stats.where(~held_out(F.col("doc_id"))).select("doc_id", "_stats")
    joined = open_rows.join(known, "doc_id")
    return joined.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select("_stats", "label")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_rules(
    rows: DataFrame, *, trees: int = 16, depth: int = 4, penalty: float = 0.002, least_support: float = 0.002, seed: int = 7
) -> RuleModel:
    """Fit the ensemble on ``(_stats, label)``, labels 0 and 1.

    Without rows, with one label only or one so rare that no rule has enough support, the model has no rules and a constant score, the
    smoothed share of label 1.
    """
    rows = written(rows, "learning-rows")
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = (ones + 1) / (n + 2)
    constant = RuleModel(float(np.log(share / (1 - share))), ())
    if ones in (0, n):
        return constant
    flat = rows.select("_stats.*", "label")
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(flat)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, subsamplingRate=0.7, featureSubsetStrategy="0.5", minInstancesPerNode=5, seed=seed
    ).fit(vectors)
    rules = sorted(tree_rules(forest.toDebugString))
    if rules:
        support = rows.agg(*(F.avg(rule_column(r).cast("double")).alias(f"r{k}") for k, r in enumerate(rules))).first()
        rules = [r for r, s in zip(rules, support) if least_support <= s <= 1 - least_support]
    if not rules:  # none at all, or all of them hold for nearly no or nearly every row
        return constant
    flags = F.array(*(rule_column(r).cast("double") for r in rules))
    ruled = rows.select(array_to_vector(flags).alias("features"), "label")
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=penalty, maxIter=100, standardization=False, featuresCol="features", labelCol="label"
    ).fit(ruled)
    weights = lasso.coefficients.toArray()
    kept = tuple((float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6)
    return RuleModel(float(lasso.intercept), kept)


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = 20_000, threshold: float = 0.3
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``(doc_id, text)``.

    At most ``max_rows`` labelled rows outside the held-out fold are learnt from; every row
    is scored by its whole text, null and empty texts by statistics of zero. A document with
    several labels counts with the largest. Only the text enters a score. Repeated rows are scored
    each, a row without id too; an empty table gives an empty result; other columns are ignored;
    a text of any length is measured whole, one at a time beyond 2 MB.
    """
    rows = docs.select("doc_id", "text")
    stats = written(with_statistics(rows).drop("text"), "statistics")
    model = fit_rules(learning_rows(stats, labels, label, max_rows))
    return stats.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, *, label: str = "quality", max_rows: int = 20_000, threshold: float = 0.3
) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier accepts.

    Null, empty and long texts, repeated rows and rows without id as in :func:`quality_scores`;
    without labels the constant score decides on all rows alike; an empty table stays empty.
    """
    known = labels.where(F.col(label).isNotNull()).select("doc_id").distinct()
    learnt = with_statistics(docs.select("doc_id", "text").join(known, "doc_id", "left_semi")).drop("text")
    model = fit_rules(learning_rows(learnt, labels, label, max_rows))
    stats = free_name(docs, "_stats")
    return with_statistics(docs, into=stats).where(model.score(stats) >= threshold).drop(stats)
