"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Every path from the root of a tree to one of its nodes is a conjunction of bounds. The paths of a small forest are the
candidate rules, a logistic regression under the lasso gives most of them weight zero, and the others are compiled
into one column expression, so that scoring is a projection.

The forest and the lasso learn from at most ``sample_rows`` labelled texts (the first ones by a hash of the key, one a
key, the smallest where rows share it), which bounds the fit whatever the corpus; all rows are scored. Only the text enters a score. Null and empty texts have
statistics of 0 and are scored by them. Rows are scored one by one. Null labels are left out; of several labels of one key the
larger one counts. Without rows of both classes every score is the smoothed share of label 1.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlens.llm.quality_rules import measures
from shiftlens.llm.text import LOWER, UPPER, shared_folder, stored, words


@dataclass(frozen=True)
class Fit:
    """Bounds and settings of the fit."""

    sample_rows: int = 20_000
    trees: int = 24
    depth: int = 4
    bins: int = 64
    lasso: float = 5e-4
    seed: int = 17


#: A rule: for each statistic its exclusive lower and inclusive upper bound.
Rule = dict[str, tuple[float, float]]
_ALL = (float("-inf"), float("inf"))


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules and the intercept."""

    intercept: float
    rules: tuple[tuple[float, Rule], ...]

    def score(self) -> Column:
        """The probability of label 1 as a column over the statistics."""
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule) -> Column:
    bounds = []
    for name, (low, high) in rule.items():
        bounds += [F.col(name) > low] if low > _ALL[0] else []
        bounds += [F.col(name) <= high] if high < _ALL[1] else []
    return reduce(and_, bounds)


def statistics(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, list[str]]:
    """The key and the statistics of each text."""
    said = F.coalesce(F.col("_text"), F.lit(""))
    share = lambda part, whole: F.coalesce(F.try_divide(part, whole), F.lit(0.0)).cast("double")
    kind = lambda characters: F.char_length(said) - F.char_length(F.translate(said, characters, ""))
    counts = measures(F.col("_text")) | {
        "n_chars": F.char_length(said).cast("long"), "n_upper": kind(UPPER).cast("long"), "n_lower": kind(LOWER).cast("long"),
        "n_digits": kind("0123456789").cast("long"), "n_stops": kind(".,;:?").cast("long"),
        "n_different": F.size(F.array_distinct("_words")).cast("long"),
    }
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), words(F.col(text)).alias("_words"))
    counted = rows.select("_key", *(column.alias(name) for name, column in counts.items()))
    chars, n = F.col("n_chars"), F.col("n_words")
    stats = {
        "words": n.cast("double"), "word_length": share(F.col("word_chars"), n), "line_words": share(n, F.col("n_lines")),
        "symbols": share(F.col("n_symbols"), n), "shouts": share(F.col("n_shouts"), n), "stop_words": share(F.col("n_stop_words"), n),
        "repeated": share(F.col("n_repeat_words"), n), "doubled": share(F.col("n_doubled_words"), n), "dup_lines": share(F.col("n_dup_lines"), F.col("n_lines")),
        "different": share(F.col("n_different"), n), "upper": share(F.col("n_upper"), chars), "lower": share(F.col("n_lower"), chars),
        "digits": share(F.col("n_digits"), chars), "stops": share(F.col("n_stops"), n),
    }
    return counted.select("_key", *(column.alias(name) for name, column in stats.items())), list(stats)


_NODE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$", re.MULTILINE)


def paths(description: str, names: list[str]) -> list[Rule]:
    """The rules on the way to every node but the root, from a tree's printed form."""
    found: list[Rule] = []
    above: dict[int, Rule] = {}
    for indent, feature, side, bound in _NODE.findall(description):
        depth = len(indent)
        rule = dict(max(((d, r) for d, r in above.items() if d < depth), default=(0, {}), key=lambda x: x[0])[1])
        low, high = rule.get(names[int(feature)], _ALL)
        value = float(bound)
        rule[names[int(feature)]] = (max(low, value), high) if side == ">" else (low, min(high, value))
        above = {d: r for d, r in above.items() if d < depth} | {depth: rule}
        found.append(rule)
    return found


def learn(train: DataFrame, names: list[str], fit: Fit) -> Ensemble:
    """Rules from labelled statistics: ``train`` holds ``names`` and ``label`` and at most ``sample_rows`` rows."""
    rows = stored(train.repartition(1).sortWithinPartitions("_key").select("label", F.array(*names).alias("stats"), *names))
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if positive in (0, n):
        return Ensemble(math.log((positive + 1) / (n - positive + 1)), ())
    forest = RandomForestClassifier(
        numTrees=fit.trees, maxDepth=fit.depth, maxBins=fit.bins, seed=fit.seed, featuresCol="vector", minInstancesPerNode=5,
    ).fit(rows.select("label", array_to_vector("stats").alias("vector")))
    rules: list[Rule] = []
    for tree in forest.trees:
        rules += [rule for rule in paths(tree.toDebugString, names) if rule not in rules]
    if not rules:
        return Ensemble(math.log(positive / (n - positive)), ())
    held = F.array(*(F.when(holds(rule), 1.0).otherwise(0.0) for rule in rules))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=fit.lasso, standardization=False, maxIter=200, featuresCol="vector")
    model = lasso.fit(rows.select("label", array_to_vector(held).alias("vector")))
    weighted = zip(model.coefficients.toArray().tolist(), rules, strict=True)
    return Ensemble(float(model.intercept), tuple((w, rule) for w, rule in weighted if w != 0.0))


def score_quality(docs: DataFrame, labels: DataFrame, held_out: Column, fit: Fit = Fit(), key: str = "doc_id", text: str = "text", label: str = "quality") -> tuple[DataFrame, Ensemble]:
    """Per row the key, ``held_out``, ``score`` and ``predicted``; and the rules.

    ``held_out`` is a column over the key. No label of such a row is read by the fit.
    """
    shared_folder(docs.sparkSession)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out).groupBy(key).agg(F.max(label).cast("double").alias("label"))
    sample = stored(known.orderBy(F.xxhash64(key), key).limit(fit.sample_rows)).withColumnRenamed(key, "_sampled")
    # One text a key, the smallest: rows that share a key count once, so the bound holds for rows.
    told = docs.select(F.col(key).alias("_told"), F.col(text).alias("_said"))
    met = told.join(F.broadcast(sample), F.col("_told") == F.col("_sampled"))
    labelled = met.groupBy("_sampled", "label").agg(F.min("_said").alias("_said"))
    boxed = labelled.select(F.struct("_sampled", "label").alias("_id"), "_said")
    stats, names = statistics(boxed, "_id", "_said")
    ensemble = learn(stats.select(F.col("_key._sampled").alias("_key"), F.col("_key.label").alias("label"), *names), names, fit)
    scored, _ = statistics(docs, key, text)
    result = scored.select(F.col("_key").alias(key), ensemble.score().alias("score"))
    return result.select(key, held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")), ensemble
