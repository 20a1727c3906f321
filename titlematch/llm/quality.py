"""Quality classifier: a sparse rule ensemble compiled to Spark columns.

Statistics of a text are Column expressions.  A random forest is fitted on them;
every path from a root to a node is a conjunction of comparisons, a rule.  A
lasso logistic regression over the rules keeps a few of them, and those are
compiled back into one Column expression, so scoring is a plain projection over
the documents.  Both fits are distributed; only trees and weights, whose size
the parameters below fix, come to the driver.  They use at most about ``SAMPLE``
labelled documents, picked by a hash of the id.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import few, staged, text_of, word_count

TREES, DEPTH, SEED = 24, 3, 11
#: Labelled documents that are learnt from.
SAMPLE = 200_000
LASSO, STEPS = 0.0005, 60
STATISTICS = [
    "words",
    "word_length",
    "symbols",
    "marks",
    "shouts",
    "bars",
    "capitals",
    "digits",
    "letters",
    "wide",
    "distinct_words",
    "distinct_lines",
    "words_a_line",
]
#: Folds of crc32(doc_id as text); labels of the held-out one are never read.
FOLDS, HELD_OUT = 3, 1


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def counts(text: Column) -> list[Column]:
    """What the statistics are made of."""
    lines, tokens = F.split(text, "\n"), F.split(text, r"[\x20\x09-\x0D]+")
    found = {
        "symbols": r"[#$%&*@^~|<>{}\[\]_=+\\]",
        "marks": r"[.,;:!?]",
        "shouts": r"!",
        "bars": r"\|",
        "capitals": r"\p{Lu}",
        "digits": r"[0-9]",
        "letters": r"\p{L}+",
    }
    sizes = {
        "chars": F.length(text),
        "bytes": F.octet_length(text),
        "words": word_count(text),
        "tokens": F.size(F.array_distinct(tokens)),
        "lines": F.size(lines),
        "own_lines": F.size(F.array_distinct(lines)),
    } | {name: F.regexp_count(text, F.lit(pattern)) for name, pattern in found.items()}
    return [c.cast("double").alias(f"n_{name}") for name, c in sizes.items()]


def statistics(count: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """The ``STATISTICS`` of a text from its counts; 0 where it has no words."""

    def per(part: Column, of: str) -> Column:
        return F.when(count(f"n_{of}") > 0, part / count(f"n_{of}")).otherwise(F.lit(0.0))

    return {
        "words": count("n_words"),
        "word_length": per(count("n_chars"), "words"),
        "symbols": per(count("n_symbols"), "chars"),
        "marks": per(count("n_marks"), "words"),
        "shouts": per(count("n_shouts"), "words"),
        "bars": per(count("n_bars"), "words"),
        "capitals": per(count("n_capitals"), "chars"),
        "digits": per(count("n_digits"), "chars"),
        "letters": per(count("n_letters"), "words"),
        "wide": per(count("n_bytes") - count("n_chars"), "chars"),
        "distinct_words": per(count("n_tokens"), "words"),
        "distinct_lines": per(count("n_own_lines"), "lines"),
        "words_a_line": per(count("n_words"), "lines"),
    }


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, '<=' or '>', bound)."""

    terms: tuple[tuple[str, str, float], ...]

    def column(self, statistic: Callable[[str], Column] = F.col) -> Column:
        out = F.lit(True)
        for name, sign, bound in self.terms:
            out &= (statistic(name) <= bound) if sign == "<=" else (statistic(name) > bound)
        return out.cast("double")


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """The rules of a tree printed by ``toDebugString``."""
    rules, path = [], []
    for line in description.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line):
            path = [p for p in path if p[0] < len(m[1])] + [(len(m[1]), (names[int(m[2])], m[3], float(m[4])))]
            tightest: dict[tuple[str, str], float] = {}
            for _, (name, sign, bound) in path:
                old = tightest.get((name, sign))
                tightest[name, sign] = bound if old is None else (min if sign == "<=" else max)(old, bound)
            rules.append(Rule(tuple(sorted((n, s, b) for (n, s), b in tightest.items()))))
    return rules


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[float, Rule], ...]

    def score(self, statistic: Callable[[str], Column] = F.col) -> Column:
        """Probability of label 1, over columns named as the statistics."""
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            total += F.lit(weight) * rule.column(statistic)
        return 1.0 / (1.0 + F.exp(-total))


def fit(rows: DataFrame) -> RuleModel:
    """``rows``: the statistics and ``label`` (0.0 or 1.0).  With one label or
    none the model is that constant (0.5 without rows)."""
    n, ones = rows.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or ones in (0, n):
        return RuleModel(0.0 if not n else 20.0 if ones else -20.0, ())
    features = VectorAssembler(inputCols=STATISTICS, outputCol="_x").transform(rows.select("label", *STATISTICS))
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="_x", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", maxBins=64
    ).fit(features)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in tree_rules(tree.toDebugString, STATISTICS)))
    if not rules:
        return RuleModel(math.log(ones / (n - ones)), ())
    matched = rows.select("label", array_to_vector(F.array(*[r.column() for r in rules])).alias("_r"))
    lasso = LogisticRegression(
        labelCol="label", featuresCol="_r", regParam=LASSO, elasticNetParam=1.0, maxIter=STEPS, standardization=False
    ).fit(matched)
    kept = tuple((float(w), r) for w, r in zip(lasso.coefficients, rules, strict=True) if abs(w) > 1e-6)
    return RuleModel(float(lasso.intercept), kept)


def described(docs: DataFrame) -> DataFrame:
    counted = docs.select("doc_id", *counts(text_of()))
    made = statistics()
    return counted.select("doc_id", *[made[name].alias(name) for name in STATISTICS])


def learnt(labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """``_id, label`` of what is learnt from: labels whose fold is not the held-out
    one, about ``SAMPLE`` of them if there are more.  Null labels are skipped."""
    known = labels.filter(F.col("quality").isin(0, 1) & (fold_of(F.col("doc_id"), folds) != held_out))
    share = min(1.0, SAMPLE / max(known.count(), 1))
    place = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 30) - 1))
    return known.filter(place < int(share * (1 << 30))).select(
        F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("label")
    )


def train(stats: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> RuleModel:
    """Learns from the ``learnt`` labels."""
    known = few(learnt(labels, folds, held_out))
    rows = stats.join(known, F.col("doc_id") == F.col("_id")).select("label", *STATISTICS)
    return fit(staged(rows, "quality-rows"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    A null text counts as empty; empty and blank texts are scored by statistics
    of 0.  A null id has the fold of the empty string.  An empty table gives an
    empty result.  Of ``docs`` only ``doc_id`` and ``text`` are read, and of the
    labels ``doc_id`` and ``quality``; only texts are inputs of a score.
    """
    stats = staged(described(docs), "quality-statistics")
    score = train(stats, labels).score()
    return stats.select(
        "doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with a score of 0.5 or more, all their columns.  Texts are
    counted once for the scores, and those that are learnt from once before."""
    own = docs.select("doc_id", "text").join(few(learnt(labels).select("_id")), F.col("doc_id") == F.col("_id"), "left_semi")
    model = train(staged(described(own), "quality-statistics"), labels)
    # as a lambda's argument the counts are taken once a row; as columns under a
    # filter they would be pulled into every rule

    def scored(counted: Column) -> Column:
        made = statistics(lambda name: counted[name])
        return model.score(lambda name: made[name])

    return docs.filter(F.transform(F.array(F.struct(*counts(text_of()))), scored)[0] >= 0.5)
