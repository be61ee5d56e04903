"""Toxic spans and document scores by a linear-chain CRF (operator 3).

Two states, clean and toxic, over the letter runs of the whole text.  The
emission of a token is the sum of the weights of its features (the lower-case
word and its prefixes of 3 to 7 letters); the transitions and the start
weights are learned with them by gradient ascent on the conditional
likelihood, forward and backward over labelled tokens.

Labels mark documents, so the tokens are labelled from them: features found
almost only in toxic training documents mark the toxic tokens there, and all
other tokens are clean.  Learning uses the labelled rows the caller passes,
at most ``TRAIN_DOCS`` of them (those with the least hash of their id) and at
most ``FEATURES`` features and ``SNIPPETS`` token windows, of a text at most
``PLACES`` windows around featured tokens, spread from its first to its last
one; these bounds are parameters of the model alone.  Scoring always covers whole texts.

Most tokens carry no feature and share one emission, so a stretch of L of
them is one power of a 2x2 matrix.  Forward and backward passes step from
one token with features to the next; the marginals equal those of a pass over
every token, and a text of any length needs memory for its featured tokens
only.

Defined cases: null and empty texts have no tokens and get the score of a
document without evidence; repeated rows get equal scores; labels for unknown
ids and repeated labels are ignored (one label per id, toxic if any row says
so; equal texts are one example, toxic if any copy is); with no labelled document of either kind every score is the share of
toxic labels, or 0 without labels; an empty table gives an empty table.  Other
columns pass through; columns named like the score or the spans are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareflow.llm.common import Shared, saved, with_text, worker_state

TRAIN_DOCS = 6000
FEATURES = 4000
SNIPPETS = 6000
REACH = 8
# Featured tokens of a training text that get a window, spread over all of it.
PLACES = 6
PREFIXES = (3, 4, 5, 6, 7)
MIN_DOCS, MIN_SHARE, MIN_PRECISION = 3, 0.01, 0.8
SPAN_PROBABILITY = 0.5
TOXIC = 0.3  # score from which a document is predicted toxic
CACHE_WORDS = 300_000

_TOKEN = re.compile(r"[^\W\d_]+")
_EVIDENCE = 2


@dataclass
class Model:
    """Weights of the chain and of the document score that rests on it."""

    weights: dict[str, float] = field(default_factory=dict)
    start: tuple[float, float] = (0.0, 0.0)
    moves: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    bias: float = 0.0
    document: tuple[float, ...] | None = None
    share: float = 0.0


def token_features(word: str) -> list[str]:
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


# ---- the chain ------------------------------------------------------------

def _power(m: np.ndarray, n: int) -> np.ndarray:
    """m**n scaled to a largest entry of 1."""
    out = np.eye(2)
    while n:
        if n & 1:
            out = out @ m
            out /= out.max()
        m = m @ m
        m = m / m.max()
        n >>= 1
    return out


class Chain:
    """Marginals of the toxic state at featured tokens and beside them."""

    def __init__(self, model: Model):
        self.move = np.exp(np.array(model.moves))
        self.begin = np.exp(np.array(model.start))
        self.plain = np.exp(np.array([0.0, model.bias]))
        self.bias = model.bias
        self._powers: dict[int, np.ndarray] = {}

    def stretch(self, n: int) -> np.ndarray:
        """Transition over n plain tokens, their emissions included."""
        got = self._powers.get(n)
        if got is None:
            got = _power(self.move * self.plain, n)
            if len(self._powers) < 20_000:
                self._powers[n] = got
        return got

    def marginals(self, total: int, at: list[int], emission: list[float]) -> tuple[list[int], np.ndarray]:
        """Toxic marginals at the tokens ``at`` and the plain ones next to them.

        ``emission[i]`` is the toxic weight of token ``at[i]``; every other
        token of the ``total`` is plain.  Positions are returned with them.
        """
        here = dict(zip(at, emission))
        points = sorted({p for a in at for p in (a - 1, a, a + 1) if 0 <= p < total} | {0, total - 1})
        emit = np.array([[1.0, math.exp(min(here.get(p, 0.0) + self.bias, 300.0))] for p in points])
        steps = [self.stretch(b - a - 1) @ self.move if b - a > 1 else self.move
                 for a, b in zip(points, points[1:])]
        n = len(points)
        forward, backward = np.empty((n, 2)), np.empty((n, 2))
        v = self.begin * emit[0]
        forward[0] = v / v.sum()
        for i in range(1, n):
            v = forward[i - 1] @ steps[i - 1] * emit[i]
            forward[i] = v / v.sum()
        backward[n - 1] = 1.0
        for i in range(n - 2, -1, -1):
            v = steps[i] @ (emit[i + 1] * backward[i + 1])
            backward[i] = v / v.sum()
        both = forward * backward
        return points, both[:, 1] / both.sum(axis=1)


class Tagger:
    def __init__(self, model: Model):
        self.model, self.chain = model, Chain(model)
        self.cache: dict[str, float] = {}
        self.without: dict[int, float] = {}

    def weight(self, word: str) -> float:
        """Summed feature weights of a lower-case word; 0 for a plain token."""
        got = self.cache.get(word)
        if got is None:
            w = self.model.weights
            got = 0.0
            for f in token_features(word):
                got += w.get(f, 0.0)
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[word] = got
        return got

    def evidence(self, text: str) -> tuple[tuple[float, ...], list[tuple[int, int]]]:
        """Document evidence (largest marginal, expected toxic tokens) and spans."""
        words = list(map(str.lower, _TOKEN.findall(text)))
        if not words:
            return (0.0,) * _EVIDENCE, []
        get, weight = self.cache.get, self.weight
        weights = [weight(w) if (x := get(w)) is None else x for w in words]
        at = [i for i, x in enumerate(weights) if x]
        if not at:
            n = len(words)
            if n not in self.without:
                if len(self.without) > 50_000:
                    self.without.clear()
                _, p = self.chain.marginals(n, [], [])
                self.without[n] = float(p.max())
            return (self.without[n], 0.0), []
        points, p = self.chain.marginals(len(words), at, [weights[i] for i in at])
        toxic = {points[i] for i in np.flatnonzero(p >= SPAN_PROBABILITY)}
        spans = [m.span() for i, m in enumerate(_TOKEN.finditer(text)) if i in toxic] if toxic else []
        return (float(p.max()), float(p[p >= SPAN_PROBABILITY].sum())), spans

    def score(self, evidence: tuple[float, ...]) -> float:
        if self.model.document is None:
            return self.model.share
        a, b, c = self.model.document
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * evidence[0] + c * math.log1p(evidence[1])))))


# ---- learning -------------------------------------------------------------

def fit_chain(x: np.ndarray, y: np.ndarray, mask: np.ndarray, n_features: int,
              rounds: int = 120, rate: float = 2.0, decay: float = 1e-4) -> tuple:
    """Gradient ascent on the conditional log-likelihood of labelled windows.

    ``x[s, t, k]`` holds feature numbers (-1 for none), ``y[s, t]`` the states
    and ``mask`` the tokens that exist.  All windows step together.
    """
    s, t, _ = x.shape
    w = np.zeros(n_features + 1)
    move, start, bias = np.zeros((2, 2)), np.zeros(2), 0.0
    n = mask.sum()
    # Gradients are sums over tokens of (observed - expected); each weight is
    # scaled by how often it can occur, so that rare features learn too.
    often = np.bincount(x[mask].ravel() + 1, minlength=n_features + 1).astype(float)[1:]
    for _ in range(rounds):
        emit = w[x].sum(axis=2) + bias
        e = np.exp(np.stack([np.zeros((s, t)), np.clip(emit, -50, 50)], axis=2))
        m = np.exp(move)
        fw, bw = np.empty((t, s, 2)), np.ones((t, s, 2))
        v = np.exp(start) * e[:, 0]
        fw[0] = v / v.sum(axis=1, keepdims=True)
        for i in range(1, t):
            v = (fw[i - 1] @ m) * e[:, i]
            v /= v.sum(axis=1, keepdims=True)
            fw[i] = np.where(mask[:, i:i + 1], v, fw[i - 1])
        for i in range(t - 2, -1, -1):
            v = (e[:, i + 1] * bw[i + 1]) @ m.T
            v /= v.sum(axis=1, keepdims=True)
            bw[i] = np.where(mask[:, i + 1:i + 2], v, 1.0)
        p = fw * bw
        p = (p / p.sum(axis=2, keepdims=True))[:, :, 1].T
        gap = np.where(mask, y - p, 0.0)
        grad = np.bincount(x.ravel() + 1, weights=np.repeat(gap.ravel(), x.shape[2]), minlength=n_features + 1)[1:]
        w[:n_features] += rate * (grad / (often + 5.0) - decay * w[:n_features])
        bias += rate * (gap.sum() / n - decay * bias)
        pair = mask[:, 1:]
        seen, expect = np.zeros((2, 2)), np.zeros((2, 2))
        joint = fw[:-1].transpose(1, 0, 2)[:, :, :, None] * m * (e[:, 1:] * bw[1:].transpose(1, 0, 2))[:, :, None, :]
        joint /= joint.sum(axis=(2, 3), keepdims=True)
        expect = joint[pair].sum(axis=0)
        for a in (0, 1):
            for b in (0, 1):
                seen[a, b] = ((y[:, :-1] == a) & (y[:, 1:] == b) & pair).sum()
        move += rate * ((seen - expect) / max(1, pair.sum()) - decay * move)
        first = np.array([(y[:, 0] == 0).sum() - (1 - p[:, 0]).sum(), (y[:, 0] == 1).sum() - p[:, 0].sum()])
        start += rate * (first / max(1, s) - decay * start)
    return w[:n_features], move, start, bias


def fit_document(evidence: np.ndarray, label: np.ndarray) -> tuple[float, ...]:
    """Logistic weights of a document's evidence, by Newton steps with a ridge."""
    x = np.column_stack([np.ones(len(evidence)), evidence[:, 0], np.log1p(evidence[:, 1])])
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3)
        step = np.linalg.solve(h, x.T @ (label - p) - 0.05 * b)
        b += step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(v) for v in b)


def _features_of(text):
    """Distinct features of a text, by built-in functions."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1)))
    prefixes = [F.transform(F.filter(words, lambda w, k=k: F.length(w) > k),
                            lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*"))) for k in PREFIXES]
    return F.array_distinct(F.concat(words, *prefixes))


def _windows(texts: DataFrame, features: dict[str, int], snippets: int, places: int = PLACES) -> DataFrame:
    """Token windows for learning: around featured tokens, and plain ones.

    ``(feats array<int> flattened, y, length)``.  At most ``places`` featured
    tokens a document, evenly spread from its first to its last one, so that
    no long document takes the sample over and no part of a text is left out.
    """
    width = 2 * REACH + 1
    per = len(PREFIXES) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = list(map(str.lower, _TOKEN.findall(text)))
                feats = [[features[f] for f in token_features(w) if f in features] for w in words]
                hits = [i for i, f in enumerate(feats) if f]
                step = max(1.0, len(hits) / places)
                centres = [hits[int(k * step)] for k in range(min(places, len(hits)))] + [len(words) // 2, len(words) // 5]
                for c in centres if words else []:
                    x = np.full((width, per), -1, np.int32)
                    y = np.full(width, -1, np.int32)
                    for k, i in enumerate(range(max(0, c - REACH), min(len(words), c + REACH + 1))):
                        x[k, :len(feats[i])] = feats[i]
                        y[k] = 1 if toxic and feats[i] else 0
                    xs.append(x.ravel().tolist())
                    ys.append(y.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.int32())), pa.array(ys, pa.list_(pa.int32()))],
                                             names=["x", "y"])

    made = texts.mapInArrow(run, "x array<int>, y array<int>")
    order = F.xxhash64("x", "y")
    return made.orderBy(order).limit(snippets)


def train(docs: DataFrame, marks: DataFrame, train_docs: int = TRAIN_DOCS, max_features: int = FEATURES,
          snippets: int = SNIPPETS, places: int = PLACES) -> Model:
    """Learn from the texts of ``docs`` marked by ``marks (doc_id, toxic)``.

    The sample is picked by ids alone; only its rows' texts are then read on.
    """
    texts = with_text(docs)
    known = marks.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    ids = F.broadcast(chosen)  # at most train_docs ids
    # Equal texts count once, as toxic if any copy is marked so.
    sample = saved(texts.join(ids, "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic")), "sample")
    counts = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    n, t = counts["n"] or 0, counts["t"] or 0
    if not 0 < t < n:
        return Model(share=float(t) / n if n else 0.0)
    seen = sample.select("toxic", F.explode(_features_of(F.col("text"))).alias("feature")).groupBy("feature").agg(
        F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    least = max(MIN_DOCS, MIN_SHARE * t)
    kept = seen.where((F.col("a") >= least) & ((F.col("a") + 0.5) / (F.col("n") + 1.0) >= MIN_PRECISION))
    rows = kept.orderBy(F.desc("a"), "feature").limit(max_features).collect()
    if not rows:
        return Model(share=float(t) / n)
    names = {r["feature"]: i for i, r in enumerate(rows)}
    got = _windows(sample, names, snippets, places).toPandas()
    width, per = 2 * REACH + 1, len(PREFIXES) + 1
    x = np.array(got["x"].tolist(), np.int64).reshape(-1, width, per)
    y = np.array(got["y"].tolist(), np.int64).reshape(-1, width)
    mask = y >= 0
    w, move, start, bias = fit_chain(x, np.maximum(y, 0), mask, len(names))
    model = Model({f: float(w[i]) for f, i in names.items() if abs(w[i]) > 1e-6},
                  (float(start[0]), float(start[1])),
                  tuple(tuple(float(v) for v in row) for row in move), float(bias), share=float(t) / n)
    evidence = np.array([(r["p"], r["e"], r["toxic"]) for r in _evidence(sample, model).select("p", "e", "toxic").collect()])
    model.document = fit_document(evidence[:, :2], evidence[:, 2])
    return model


# ---- scoring --------------------------------------------------------------

def _tagger(shared) -> Tagger:
    """One tagger per Python worker and model."""
    return worker_state(shared.name, lambda: Tagger(shared.value))


def _evidence(docs: DataFrame, model: Model) -> DataFrame:
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shared)
        for batch in batches:
            found = [tagger.evidence(t)[0] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()),
                 batch.column("toxic").cast(pa.int32())], names=["p", "e", "toxic"])

    return docs.mapInArrow(run, "p double, e double, toxic int")


def tag(docs: DataFrame, model: Model, score: str = "score", spans: str = "spans") -> DataFrame:
    """Add ``score`` and ``spans``: probability and offending offsets.

    ``spans`` is an array of (start, end) code point offsets, end exclusive,
    of the tokens whose toxic marginal is at least one half.  Columns of the
    same names are replaced; all others pass through.
    """
    shared = Shared(docs.sparkSession, model)
    kept = docs.drop(score, spans)
    schema = T.StructType(kept.schema.fields + [
        T.StructField(score, T.DoubleType()), T.StructField(spans, T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shared)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [tagger.evidence(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names[:-2]] + [
                    pa.array([tagger.score(e) for e, _ in found], pa.float64()),
                    pa.array([[{"start": a, "end": b} for a, b in s] for _, s in found], span)],
                names=names)

    return kept.mapInArrow(run, schema)


def held_out(doc_id="doc_id"):
    """Documents kept out of learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, **bounds) -> Model:
    """Train on the labelled documents that are not held out."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return train(docs, marks, **bounds)
