"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Training, on a bounded sample of labelled rows (``TRAIN_DOCS`` rows, ``TRAIN_CHARS``
characters; rows held out are never in it):

1. Token labels.  Labels are given for documents, so tokens are labelled from them:
   a feature (the word, its prefixes and suffixes) that occurs in toxic documents
   nearly only is a marker; a token of a toxic document with a marker is toxic, all
   others, and all tokens of clean documents, are not.
2. The CRF (states: other, toxic) gets a weight for every feature and for every
   transition, by gradient ascent on the conditional log-likelihood with an L2 penalty, on
   at most ``MAX_SEGMENTS`` runs of ``SEGMENT`` tokens.
3. Document score.  Forward-backward marginals of the sample's whole texts are
   summed up per document (noisy-or, largest, length), and a logistic function of
   these is fitted to the documents' labels.

Scoring is a map over all documents and whole texts: the weights are broadcast
(bounded by the sample), tokens get their emission by look-up, and forward-backward
runs for all texts of a batch at once, place by place.
"""

from __future__ import annotations

import gc
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.text import release

TRAIN_DOCS = 4000
TRAIN_CHARS = 24_000_000
SEGMENT = 128
MAX_SEGMENTS = 6000
MARKER_DOCS, MARKER_RATE = 4, 0.8
STEPS, RATE, PENALTY = 120, 0.3, 1e-3
TOKENS_AT_ONCE = 500_000
MEMO = 500_000             # words whose emission a task remembers

_WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    w = word.lower()
    return [f"={w}", *(f"^{w[:n]}" for n in range(3, 9) if len(w) > n), *(f"${w[-n:]}" for n in range(3, 6) if len(w) > n)]


class Model(NamedTuple):
    weights: dict[str, float]     # emission of toxic against other
    bias: float
    start: float                  # log odds of toxic at the first token
    move: np.ndarray              # log weights [from, to], other = 0 and toxic = 1
    doc: np.ndarray               # of the document's score
    mean: np.ndarray
    scale: np.ndarray


class _Emissions(dict):
    """word -> emission, filled when asked for."""

    def __init__(self, model: Model):
        super().__init__()
        self.weights, self.bias = model.weights, model.bias

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO:
            self.clear()
        get = self.weights.get
        value = self[word] = self.bias + sum(get(f, 0.0) for f in features(word))
        return value


def marginals(emission: np.ndarray, at: np.ndarray, start: float, move: np.ndarray) -> np.ndarray:
    """P(toxic) of each token.  Texts are tokens at[i] .. at[i + 1]; two states, so one ratio each way is enough."""
    x = np.exp(np.clip(emission, -30, 30))
    a = np.exp(move)
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    begin, size = at[:-1][order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), "left")        # texts with more than t tokens
    forward, ratio = np.empty(len(x)), np.full(len(size), np.exp(start))
    for t in range(longest):
        n = active[t]
        i = begin[:n] + t
        r = ratio[:n]
        if t:
            r = (a[0, 1] + r * a[1, 1]) / (a[0, 0] + r * a[1, 0])
        ratio[:n] = forward[i] = np.clip(r * x[i], 1e-30, 1e30)
    out, ratio = np.empty(len(x)), np.ones(len(size))
    for t in range(longest - 1, -1, -1):
        n = active[t]
        i = begin[:n] + t
        more = active[t + 1] if t + 1 < longest else 0
        y = x[i[:more] + 1] * ratio[:more]
        ratio[:more] = (a[1, 0] + a[1, 1] * y) / (a[0, 0] + a[0, 1] * y)
        odds = forward[i] * ratio[:n]
        out[i] = odds / (1 + odds)
    return out


def _doc_inputs(p: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text: log of the noisy-or exponent, largest marginal, log length."""
    n = np.diff(at)
    some = n > 0
    total, top = np.zeros(len(n)), np.zeros(len(n))
    if some.any():
        starts = at[:-1][some]
        total[some] = np.add.reduceat(-np.log1p(-np.minimum(p, 1 - 1e-9)), starts)
        top[some] = np.maximum.reduceat(p, starts)
    return np.stack([np.log(total + 1e-4), top, np.log1p(n)], axis=1)


def _scores(model: Model, inputs: np.ndarray) -> np.ndarray:
    z = ((inputs - model.mean) / model.scale) @ model.doc[1:] + model.doc[0]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# ---- training ------------------------------------------------------------------------------------------------------

class _Corpus(NamedTuple):
    tokens: np.ndarray        # word number of each token
    at: np.ndarray            # texts
    flat: np.ndarray          # feature numbers of all words, one word after the other
    cut: np.ndarray           # word w: flat[cut[w]] .. flat[cut[w + 1]]
    names: list[str]


def _corpus(texts: list[str]) -> _Corpus:
    words: dict[str, int] = {}
    tokens, at = [], [0]
    for text in texts:
        ids = np.fromiter((words.setdefault(w, len(words)) for w in _WORD.findall(text)), np.int32)
        tokens.append(ids)
        at.append(at[-1] + len(ids))
    names: dict[str, int] = {}
    flat, cut = [], [0]
    for w in words:
        flat += [names.setdefault(f, len(names)) for f in features(w)]
        cut.append(len(flat))
    return _Corpus(np.concatenate(tokens) if tokens else np.zeros(0, np.int32), np.array(at), np.array(flat, np.int64),
                   np.array(cut), list(names))


def token_labels(corpus: _Corpus, toxic: np.ndarray) -> np.ndarray:
    """1 for the tokens of toxic documents that have a marker."""
    count = np.zeros((2, len(corpus.names)), np.int64)
    for d, label in enumerate(toxic):
        seen = np.unique(corpus.tokens[corpus.at[d]:corpus.at[d + 1]])
        if len(seen):
            found = np.unique(np.concatenate([corpus.flat[corpus.cut[w]:corpus.cut[w + 1]] for w in seen]))
            count[int(label), found] += 1
    rate = (count[1] + 0.5) / (count.sum(axis=0) + 1)
    marker = (count[1] >= MARKER_DOCS) & (rate >= MARKER_RATE)
    of_word = np.logical_or.reduceat(marker[corpus.flat], corpus.cut[:-1]) if len(corpus.cut) > 1 else np.zeros(0, bool)
    in_toxic = np.repeat(toxic.astype(bool), np.diff(corpus.at))
    return (of_word[corpus.tokens] & in_toxic).astype(float)


def _segments(corpus: _Corpus, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first token, size) of the runs to train on: those with toxic tokens first, at most MAX_SEGMENTS."""
    starts, sizes = [], []
    for a, b in zip(corpus.at[:-1], corpus.at[1:]):
        s = np.arange(a, b, SEGMENT)
        starts.append(s)
        sizes.append(np.minimum(b - s, SEGMENT))
    starts, sizes = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (starts, sizes))
    if len(starts) > MAX_SEGMENTS:
        has = np.add.reduceat(labels, starts) > 0
        rank = np.random.default_rng(5).random(len(starts)) - has * (np.arange(len(has)) % 4 > 0)
        keep = np.sort(np.argsort(rank, kind="stable")[:MAX_SEGMENTS])
        starts, sizes = starts[keep], sizes[keep]
    return starts, sizes


def _fit_chain(corpus: _Corpus, labels: np.ndarray) -> tuple[np.ndarray, float, float, np.ndarray]:
    starts, sizes = _segments(corpus, labels)
    at = np.concatenate([[0], np.cumsum(sizes)])
    pick = np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])
    word, y = corpus.tokens[pick], labels[pick]
    used, word = np.unique(word, return_inverse=True)
    size = np.diff(corpus.cut)[used]
    feature = corpus.flat[np.repeat(corpus.cut[used] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
    first = np.concatenate([[0], np.cumsum(size)[:-1]])
    m = len(corpus.names)
    params = np.zeros(m + 6)                    # features, bias, start, moves
    params[m] = -4.0
    pair = np.ones(len(y), bool)
    pair[at[:-1][sizes > 0]] = False
    pair = np.flatnonzero(pair)
    heads = at[:-1][sizes > 0]
    seen = np.array([[((1 - y[pair - 1]) * (1 - y[pair])).sum(), ((1 - y[pair - 1]) * y[pair]).sum()],
                     [(y[pair - 1] * (1 - y[pair])).sum(), (y[pair - 1] * y[pair]).sum()]])
    memory = np.full(len(params), 1e-8)
    n = max(1, len(sizes))
    for _ in range(STEPS):
        w, bias, begin, move = params[:m], params[m], params[m + 1], params[m + 2:].reshape(2, 2)
        emission = bias + np.add.reduceat(w[feature], first)[word]
        p = marginals(emission, at, begin, move)
        # Pair marginals from the two neighbours' marginals: P(a, b) is proportional to forward * move * emission * backward.
        a = np.exp(move)
        f, g = _messages(emission, at, begin, move)
        both = np.stack([a[0, 0] * np.ones(len(pair)), a[0, 1] * g[pair], f[pair - 1] * a[1, 0], f[pair - 1] * a[1, 1] * g[pair]])
        both /= both.sum(axis=0)
        residual = y - p
        per_word = np.bincount(word, residual, len(used))
        gradient = np.concatenate([np.bincount(feature, np.repeat(per_word, size), m), [residual.sum()],
                                   [residual[heads].sum()], (seen - both.sum(axis=1).reshape(2, 2)).ravel()]) / n
        gradient -= PENALTY * params * np.concatenate([np.ones(m), np.zeros(6)])
        memory += gradient ** 2
        params += RATE * gradient / np.sqrt(memory)
    return params[:m], params[m], params[m + 1], params[m + 2:].reshape(2, 2)


def _messages(emission, at, start, move) -> tuple[np.ndarray, np.ndarray]:
    """Per token: forward ratio with its own emission; emission times backward ratio."""
    x, a, size = np.exp(np.clip(emission, -30, 30)), np.exp(move), np.diff(at)
    f, g = np.empty(len(x)), np.empty(len(x))
    for t in range(int(size.max(initial=0))):
        i = at[:-1][size > t] + t
        r = np.full(len(i), np.exp(start)) if t == 0 else (a[0, 1] + f[i - 1] * a[1, 1]) / (a[0, 0] + f[i - 1] * a[1, 0])
        f[i] = np.clip(r * x[i], 1e-30, 1e30)
    for t in range(int(size.max(initial=0))):
        i = at[1:][size > t] - 1 - t
        q = np.ones(len(i)) if t == 0 else (a[1, 0] + a[1, 1] * g[i + 1]) / (a[0, 0] + a[0, 1] * g[i + 1])
        g[i] = np.clip(q * x[i], 1e-30, 1e30)
    return f, g


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge
        w = w + np.linalg.solve(h, x.T @ (y - p) - ridge @ w)
    return w


def train(texts: list[str], toxic: list[int]) -> Model:
    """Fits the tagger and the document score.  Without a label of each kind the score is the share of toxic labels."""
    y = np.array(toxic, float)
    corpus = _corpus(texts)
    labels = token_labels(corpus, y)
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
    base = np.log(max(share, 1e-6) / (1 - min(share, 1 - 1e-6)))
    if labels.sum() == 0 or y.min() == y.max():
        return Model({}, -4.0, 0.0, np.zeros((2, 2)), np.array([base, 0, 0, 0]), np.zeros(3), np.ones(3))
    w, bias, start, move = _fit_chain(corpus, labels)
    keep = np.flatnonzero(np.abs(w) > 1e-3)
    model = Model({corpus.names[i]: float(w[i]) for i in keep}, float(bias), float(start), move, np.zeros(4), np.zeros(3), np.ones(3))
    del corpus, labels, w, keep
    release()
    score = _Emissions(model)
    parts = []
    for text in texts:                                # a text at a time: only its three inputs are kept
        e = np.fromiter(map(score.__getitem__, _WORD.findall(text)), float)
        parts.append((e, len(e)))
    at = np.concatenate([[0], np.cumsum([n for _, n in parts])])
    inputs = _doc_inputs(marginals(np.concatenate([e for e, _ in parts]), at, start, move), at)
    mean, scale = inputs.mean(axis=0), inputs.std(axis=0) + 1e-9
    return model._replace(doc=_fit_logistic((inputs - mean) / scale, y), mean=mean, scale=scale)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of doc_id as text is a multiple of 5 (NULL: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Model:
    """Trains on a sample of labelled rows that are not held out, chosen by a hash of doc_id.

    The sample ends at `train_chars` characters.  A text over a hundredth of that comes after all
    others, the shortest first, so it never takes the place of the rows behind it.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(train_docs)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")) \
        .join(F.broadcast(known), F.col("doc_id") == F.col("_id")) \
        .orderBy(F.xxhash64("_id"), "_id", "text").limit(train_docs)
    order = Window.orderBy(F.greatest(F.length("text"), F.lit(train_chars // 100)), F.xxhash64("_id"), "_id", "text")
    chars = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    rows = sample.withColumn("chars", chars).where(F.col("chars") <= train_chars).select("text", "toxic").collect()
    if not rows and not sample.isEmpty():
        raise ValueError(f"every labelled text of the sample is longer than {train_chars} characters")
    texts, toxic = [r.text for r in rows], [int(r.toxic) for r in rows]
    del rows
    model = train(texts, toxic)
    del texts
    gc.collect()
    release()                                        # the driver goes on: it need not keep what training took
    return model


# ---- scoring -------------------------------------------------------------------------------------------------------

RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
_ARROW = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of tokens that are likelier toxic than not, as code point offsets."""
    if not len(p) or p.max() < 0.5:
        return []
    out: list[dict] = []
    last = False
    for m, x in zip(_WORD.finditer(text), p >= 0.5):
        if x and last:
            out[-1]["end"] = m.end()
        elif x:
            out.append({"start": m.start(), "end": m.end()})
        last = x
    return out


def tagger(spark: SparkSession, model: Model):
    """A column function: text -> struct(score, spans)."""
    shared = spark.sparkContext.broadcast(tuple(model))

    @F.arrow_udf(RESULT)
    def tag(text: pa.Array) -> pa.Array:
        model = Model(*shared.value)
        emissions = _Emissions(model)
        out: list[dict] = []
        waiting: list[tuple[str, np.ndarray]] = []

        def flush() -> None:
            at = np.concatenate([[0], np.cumsum([len(e) for _, e in waiting])]).astype(np.int64)
            p = marginals(np.concatenate([e for _, e in waiting]), at, model.start, model.move)
            for score, (t, _), a, b in zip(_scores(model, _doc_inputs(p, at)).tolist(), waiting, at[:-1], at[1:]):
                out.append({"score": score, "spans": _spans(t, p[a:b])})
            waiting.clear()

        n = 0
        for value in text:
            t = value.as_py() or ""
            waiting.append((t, np.fromiter(map(emissions.__getitem__, _WORD.findall(t)), float)))
            n += len(waiting[-1][1]) + 1
            if n >= TOKENS_AT_ONCE:
                flush()
                n = 0
        if waiting:
            flush()
        return pa.array(out, _ARROW)

    return tag


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, spans (toxic runs, code points).

    NULL texts count as empty; those get the score of a text without tokens.  Very long texts are
    scored whole, repeated rows each.  An empty table gives an empty result; without labels every score is 0.
    """
    tag = tagger(docs.sparkSession, fit(docs, labels))
    scored = docs.select("doc_id", tag(F.col("text")).alias("t"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("t.score").alias("score"),
                         (F.col("t.score") >= 0.5).cast("int").alias("predicted"), F.col("t.spans").alias("spans"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    tag = tagger(docs.sparkSession, fit(docs, labels))
    return docs.where(tag(F.col("`text`"))["score"] < 0.5)
