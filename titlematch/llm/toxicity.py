"""Toxicity: a linear-chain CRF tags spans, its marginals score documents.

Training uses a bounded sample of labelled documents (``SAMPLE`` of them, picked
by a hash of the id) from the folds that are not held out, in two parts:

* The larger part counts, per word and per word prefix, the toxic and the clean
  documents it stands in.  All that lean to toxic documents make the lexicon; how
  strongly and how often is their evidence class.  A token enters the CRF as the class of its word, or else the best
  class of its prefixes, or else class 0.
* The other part labels tokens: tokens with evidence in toxic documents are
  offending, all tokens of clean documents are not.  The CRF is fitted to
  windows of these; because words that were toxic by chance turn up in clean
  documents here, their classes get little weight.  A logistic regression on
  the document's marginals gives the score.

Scoring goes over all documents in one pass without a shuffle: tokens become
classes, forward-backward runs over the windows of ``WINDOW`` tokens that hold
any evidence (all others have one and the same marginals), and runs of tokens
with a marginal of at least 0.5 are the offending spans.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlematch.llm.base import staged, text_of
from titlematch.llm.crf import Crf, fit_logistic
from titlematch.llm.quality import fold_of
from titlematch.llm.tokens import slices

FOLDS, HELD_OUT = 5, 0
#: Bounds of what is trained on; toxic documents a feature of the lexicon needs.
SAMPLE, WINDOWS, LEAST = 60_000, 8_000, 3
#: One document in this many trains the CRF, the others the lexicon.
SPLIT = 4
PREFIXES = (5, 7)
WINDOW = 64
LEVELS = 9
CLASSES = 1 + 2 * LEVELS
#: Words a worker remembers the class of, their longest, and features a task counts at once.
KNOWN, LONGEST, COUNTED = 1_000_000, 64, 400_000
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’…¡¿"
_TOKEN = re.compile(r"\S+")


def word_of(token: str) -> str:
    return token.lower().strip(_EDGES)


def features_of(word: str) -> list[str]:
    return [word, *[f"{n} {word[:n]}" for n in PREFIXES if len(word) > n]]


def evidence(toxic: int, clean: int, all_toxic: int, all_clean: int) -> int:
    """0, or 1 to ``LEVELS`` by log odds and by the number of toxic documents."""
    odds = math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))
    if toxic < LEAST or odds < 1:
        return 0
    return 1 + 3 * (0 if odds < 2 else 1 if odds < 3.5 else 2) + (0 if toxic < 6 else 1 if toxic < 15 else 2)


@dataclass
class ToxicModel:
    lexicon: dict[str, int]
    crf: Crf
    weights: np.ndarray
    _known: dict[str, int] = field(default_factory=dict, repr=False)

    def class_of(self, token: str) -> int:
        word = word_of(token)
        if own := self.lexicon.get(word):
            return own
        best = max((self.lexicon.get(f, 0) for f in features_of(word)[1:]), default=0)
        return best + LEVELS if best else 0

    def classes(self, text: str) -> tuple[np.ndarray, list[int]]:
        """The class of every token; the indices of tokens with evidence that
        only repeat the token before."""
        known, parts, again, at = self._known, [], [], 0
        for part in slices(text):
            if len(known) > KNOWN:
                known.clear()
            tokens = part.split()
            new = set(tokens).difference(known)
            for t in new:
                known[t] = self.class_of(t)
            parts.append(np.fromiter(map(known.__getitem__, tokens), np.uint8, len(tokens)))
            for t in new:
                if len(t) > LONGEST:
                    del known[t]
            again += [at + i for i in np.flatnonzero(parts[-1]).tolist() if i and tokens[i] == tokens[i - 1]]
            at += len(tokens)
        return np.concatenate(parts), again

    def tag(self, texts: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Features of each text, and its tokens in windows with evidence: their
        indices and marginals."""
        rows, owner, tagged = [], [], []
        for i, text in enumerate(texts):
            classes, again = self.classes(text)
            hit = np.unique(np.flatnonzero(classes) // WINDOW)
            padded = np.zeros((len(hit), WINDOW), np.uint8)
            for k, w in enumerate(hit):
                part = classes[w * WINDOW : (w + 1) * WINDOW]
                padded[k, : len(part)] = part
            rows.append(padded)
            owner.append((hit, len(classes), again))
        marginals = self.crf.marginals(np.concatenate(rows) if rows else np.zeros((0, WINDOW), np.uint8))
        x, at = np.zeros((len(texts), 4)), 0
        for i, (hit, n, again) in enumerate(owner):
            p = marginals[at : at + len(hit)].ravel()
            at += len(hit)
            places = (hit[:, None] * WINDOW + np.arange(WINDOW)).ravel()
            p, places = p[places < n], places[places < n]
            tagged.append((places, p))
            if again:  # a word repeated in a row counts once
                p = np.where(np.isin(places, again), 0.0, p)
            if len(p):
                nearly = -np.log1p(-np.minimum(p, 0.999)).sum()
                x[i] = (p.max(), min(nearly, 20.0), math.log1p(p.sum()), math.log1p(p.sum()) / math.log(n + 2))
        return x, tagged

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def spans_of(text: str, places: np.ndarray, p: np.ndarray) -> list[tuple[int, int]]:
    """Offsets (code points, end exclusive) of runs of offending tokens."""
    wanted = set(places[p >= 0.5].tolist())
    spans: list[tuple[int, int]] = []
    if wanted:
        last, top = -2, max(wanted)
        for i, m in enumerate(_TOKEN.finditer(text)):
            if i in wanted:
                if i == last + 1:
                    spans[-1] = (spans[-1][0], m.end())
                else:
                    spans.append((m.start(), m.end()))
                last = i
            if i >= top:
                break
    return spans


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic, part`` of the sampled labelled documents."""
    known = labels.filter(F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id"), FOLDS) != HELD_OUT))
    total = max(known.count(), 1)
    place = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 30) - 1))
    picked = known.filter(place < int(min(1.0, SAMPLE / total) * (1 << 30))).select(
        F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"), F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SPLIT)).alias("part")
    )
    # bounded by SAMPLE rows of three numbers
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "toxic", "part")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pa.RecordBatch:
        keys = list(counts[0].keys() | counts[1].keys())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *[pa.array([c[k] for k in keys], pa.int64()) for c in counts]], names=["feature", "clean", "toxic"]
        )
        for c in counts:
            c.clear()
        return batch

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            found: set[str] = set()
            for part in slices(text):
                for word in {word_of(t) for t in set(part.split())}:
                    if word:
                        found.update(features_of(word))
            found.add("")  # counts the documents
            counts[toxic].update(found)
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield out()
    yield out()


def train(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    sample = _sample(docs, labels)
    counted = sample.filter("part <> 0").select("text", "toxic").mapInArrow(_count, "feature string, clean long, toxic long")
    counted = counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = staged(counted.filter((F.col("toxic") >= LEAST) | (F.col("feature") == "")), "toxic-features")
    totals = next(((r.toxic, r.clean) for r in counted.filter("feature = ''").collect()), (0, 0))
    # a little below where ``evidence`` begins; as many as the sample's words allow
    odds = F.log((F.col("toxic") + 0.5) / (totals[0] + 1)) - F.log((F.col("clean") + 0.5) / (totals[1] + 1))
    leaning = counted.filter((F.col("feature") != "") & (odds >= 0.999)).collect()
    lexicon = {r.feature: c for r in leaning if (c := evidence(r.toxic, r.clean, *totals))}
    model = ToxicModel(lexicon, Crf.fit(np.zeros((0, WINDOW), np.uint8), np.zeros((0, WINDOW), np.int64), CLASSES), np.zeros(5))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic")), strict=True):
                classes, _ = model.classes(text)
                hit = np.unique(np.flatnonzero(classes) // WINDOW).tolist()
                plain = [0] if len(classes) and 0 not in hit else []  # and one without evidence
                out += [(doc_id, w, toxic, classes[w * WINDOW : (w + 1) * WINDOW].tobytes()) for w in hit + plain]
            columns = zip(*out, strict=True) if out else [()] * 4
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "number", "toxic", "window"])

    learning = sample.filter("part = 0").select(F.col("doc_id").cast("long"), "text", "toxic")
    # picked by where a window stands, not by its content: equal windows are many
    place = [F.xxhash64("doc_id", "number"), "doc_id", "number", "toxic", "window"]
    rows = learning.mapInArrow(windows, "doc_id long, number long, toxic int, window binary").orderBy(*place).limit(WINDOWS).collect()
    x = np.zeros((len(rows), WINDOW), np.uint8)
    for i, r in enumerate(rows):
        x[i, : len(r.window)] = np.frombuffer(r.window, np.uint8)
    toxic = np.array([r.toxic for r in rows], dtype=np.int64).reshape(-1, 1)
    model.crf = Crf.fit(x, (x > 0) * toxic, CLASSES)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, _ = model.tag(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array(f[:, i]) for i in range(4)]], names=["toxic", "a", "b", "c", "d"])

    seen = np.array(learning.select("text", "toxic").mapInArrow(describe, "toxic int, a double, b double, c double, d double").collect(), dtype=float).reshape(-1, 5)
    model.weights = fit_logistic(seen[:, 1:], seen[:, 0])
    model._known.clear()
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, spans``.

    ``spans`` lists the offending offsets as ``start:end``, comma-joined.  A null
    text counts as empty; empty texts get the score of a text without evidence.
    Rows are scored one by one, so repeated rows and null ids do no harm (a null
    id has the fold of the empty string).  Without labels every score is 0.5.  An
    empty table gives an empty result.  Of ``docs`` only ``doc_id`` and ``text``
    are read, and of the labels ``doc_id`` and ``toxic``; only texts are inputs.
    """
    model = train(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column("text").to_pylist()
                x, tagged = model.tag(texts)
                spans = [",".join(f"{a}:{b}" for a, b in spans_of(t, *found)) for t, found in zip(texts, tagged, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(model.scores(x)), pa.array(spans, pa.string())],
                    names=["doc_id", "held_out", "score", "spans"],
                )

    held_out = fold_of(F.col("doc_id"), FOLDS) == HELD_OUT
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), text_of().alias("text"))
    scored = rows.mapInArrow(score, "doc_id long, held_out boolean, score double, spans string")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
