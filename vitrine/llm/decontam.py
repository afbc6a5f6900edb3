"""Benchmark decontamination: BM25 over an inverted index of test items, with block-max WAND.

The index is made of the benchmark in blocks of about ``index_bytes`` of text; each
block is broadcast in turn, so what is broadcast is bounded, and all documents are
read against it (a block of queries against all rows).  Document frequencies, the number of items, their mean
length and the longest are those of the whole benchmark, counted once in Spark, so the blocks do not
change any score.  A map over the documents:

1. Every text is cut into passages of ``2 * h`` words that overlap by ``h``, where ``h``
   is the longest item's number of words: an item copied into a text lies whole in a
   passage.  Each passage is a query of its distinct terms.
2. Scores are shares: an item's BM25 contributions divided by their sum over all its
   terms, so 1 means that the passage has every term of the item.  WAND's test comes
   first: a passage whose terms' largest contributions do not add up to the threshold
   cannot reach it for any item.  Then the block-max test: items are kept in groups of
   ``GROUP``, each term has its largest contribution within each group, and only groups
   whose sum reaches the threshold have their postings read.  Both bounds are upper
   bounds, so every (passage, item) at or above the threshold is retrieved.
3. Each retrieved pair is verified on the passage's words: the share of the n-grams of
   the item's question that are in it, and of its answer, must reach their thresholds.
   Question and answer are the parts before and after the last question mark, else
   before and in the last sentence, else the first two thirds and the last third.

Passages are never joined with items, and no document leaves its task.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.session import materialize

K1, B = 1.2, 0.75
THRESHOLD = 0.6
QUESTION, ANSWER = 0.6, 0.5
GRAM = 3
GROUP = 8
INDEX_BYTES = 4 << 20
TOKENS_AT_ONCE = 400_000

_WORD = re.compile(r"\w+")


def item_parts(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer."""
    lower = text.lower()
    head, mark, tail = lower.rpartition("?")
    if not (mark and _WORD.search(head) and _WORD.search(tail)):
        sentences = [m.span() for m in re.finditer(r"[^.!?]*\w[^.!?]*[.!?]*", lower)]
        if len(sentences) > 1:
            head, tail = lower[:sentences[-1][0]], lower[sentences[-1][0]:]
        else:
            found = _WORD.findall(lower)
            cut = -(-2 * len(found) // 3)
            return found[:cut], found[cut:]
    return _WORD.findall(head), _WORD.findall(tail)


def _grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index(NamedTuple):
    terms: dict[str, int]
    top: np.ndarray            # largest contribution of each term
    at: np.ndarray             # postings of term t: at[t] .. at[t + 1]
    item: np.ndarray           # posting: item number
    share: np.ndarray          # posting: contribution as a share of the item's sum
    group_at: np.ndarray       # the same by groups of items
    group: np.ndarray
    group_top: np.ndarray
    ids: list[int]
    parts: list[tuple[set, set]]
    longest: int


class Figures(NamedTuple):
    """Of the whole benchmark: items with words, their mean and largest number of words, items of each term (of those asked for)."""
    items: int
    average: float
    longest: int
    frequency: dict[str, int]


def build_index(items: list[tuple[int, str]], whole: Figures | None = None) -> Index:
    """Index of a block of items; ``whole``: the benchmark's figures (None: the block is all of it).

    Items without words are left out: nothing can hold them."""
    split = [(i, *item_parts(t or "")) for i, t in items]
    split = [(i, q, a) for i, q, a in split if q or a]
    terms: dict[str, int] = {}
    rows = []
    for number, (_, q, a) in enumerate(split):
        count: dict[int, int] = {}
        for w in q + a:
            t = terms.setdefault(w, len(terms))
            count[t] = count.get(t, 0) + 1
        rows += [(t, number, c) for t, c in count.items()]
    size = np.array([len(q) + len(a) for _, q, a in split], float)
    term, item, tf = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    n = len(split)
    df = np.bincount(term, minlength=len(terms)) if whole is None else np.array([whole.frequency[t] for t in terms], np.int64)
    every, average, longest = (n, size.mean() if n else 1.0, int(size.max()) if n else 1) if whole is None else whole[:3]
    idf = np.log1p((every - df + 0.5) / (df + 0.5))
    weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size[item] / average)) if n else np.zeros(0)
    share = weight / np.bincount(item, weight, n)[item] if n else weight
    order = np.lexsort((item, term))
    term, item, share = term[order], item[order], share[order]
    at = np.searchsorted(term, np.arange(len(terms) + 1))
    top = np.maximum.reduceat(share, at[:-1]) if n else np.zeros(0)
    # Largest share of each (term, group of items).
    key = term * (n // GROUP + 1) + item // GROUP
    first = np.flatnonzero(np.diff(key, prepend=-1)) if n else np.zeros(0, np.int64)
    return Index(terms, top, at, item, share, np.searchsorted(term[first], np.arange(len(terms) + 1)), item[first] // GROUP,
                 np.maximum.reduceat(share, first) if n else np.zeros(0), [i for i, _, _ in split],
                 [(_grams(q), _grams(a)) for _, q, a in split], longest)


def _postings(at: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each term its postings: (which of the given terms, place of the posting)."""
    size = at[term + 1] - at[term]
    owner = np.repeat(np.arange(len(term)), size)
    return owner, np.arange(size.sum()) + np.repeat(at[term] - (np.cumsum(size) - size), size)


def retrieve(index: Index, term: np.ndarray, text_at: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, int, int, int, float]]:
    """(text, first word, end, item, score) of every passage and item at or above the threshold.

    ``term``: term number of every word, -1 where no item has it; texts are term[text_at[i]:text_at[i + 1]].
    """
    h = index.longest
    least = threshold - 1e-9
    starts, ends, owner = [], [], []
    for i, (a, b) in enumerate(zip(text_at[:-1].tolist(), text_at[1:].tolist())):
        s = np.arange(a, max(a + 1, b - h), h)
        starts.append(s)
        ends.append(np.minimum(s + 2 * h, b))
        owner.append(np.full(len(s), i))
    if not starts:
        return []
    start, end, owner = (np.concatenate(x) for x in (starts, ends, owner))
    # WAND's test, with repeated terms counted each time: still an upper bound.
    best = np.concatenate([[0], np.cumsum(np.where(term >= 0, index.top[term] if len(index.top) else 0, 0))])
    keep = best[end] - best[start] >= least
    start, end, owner = start[keep], end[keep], owner[keep]
    out: list[tuple[int, int, int, int, float]] = []
    step = max(1, TOKENS_AT_ONCE // (4 * h))
    for lo in range(0, len(start), step):
        s, e, o = start[lo:lo + step], end[lo:lo + step], owner[lo:lo + step]
        size = e - s
        passage = np.repeat(np.arange(len(s)), size)
        t = term[np.arange(size.sum()) + np.repeat(s - (np.cumsum(size) - size), size)]
        known = t >= 0
        pair = np.unique(passage[known] * len(index.terms) + t[known])
        passage, t = pair // len(index.terms), pair % len(index.terms)
        able = np.bincount(passage, index.top[t], len(s)) >= least                # the same test, terms counted once
        passage, t = passage[able[passage]], t[able[passage]]
        groups = int(index.group.max()) + 1
        which, place = _postings(index.group_at, t)
        bound = passage[which] * groups + index.group[place]
        cell, inverse = np.unique(bound, return_inverse=True)
        alive = cell[np.bincount(inverse, index.group_top[place], len(cell)) >= least]      # the block-max test
        if not len(alive):
            continue
        some = np.isin(passage, alive // groups)
        passage, t = passage[some], t[some]
        which, place = _postings(index.at, t)
        held = np.isin(passage[which] * groups + index.item[place] // GROUP, alive)
        which, place = which[held], place[held]
        cell, inverse = np.unique(passage[which] * len(index.ids) + index.item[place], return_inverse=True)
        score = np.bincount(inverse, index.share[place], len(cell))
        for c, x in zip(cell[score >= least].tolist(), score[score >= least].tolist()):
            p, item = divmod(c, len(index.ids))
            out.append((int(o[p]), int(s[p]), int(e[p]), item, x))
    return out


_HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                                 T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType()),
                                 T.StructField("passage_start", T.LongType()), T.StructField("passage_end", T.LongType())]))
_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()),
                             ("answer_overlap", pa.float64()), ("passage_start", pa.int64()), ("passage_end", pa.int64())]))


def _overlap(grams: set, found: set) -> float:
    return len(grams & found) / len(grams) if grams else 1.0


def _passage_grams(words: list[str], sizes: set[int]) -> set:
    return {tuple(words[i:i + n]) for n in sizes for i in range(len(words) - n + 1)}


def find_leaks(index: Index, texts: list[str], threshold: float, question: float, answer: float) -> list[list[dict]]:
    """The verified items of each text, each once with its best passage (words are counted as runs of \\w)."""
    get = index.terms.get
    out: list[list[dict]] = [[] for _ in texts]
    waiting: list[int] = []
    terms: list[np.ndarray] = []

    def flush() -> None:
        at = np.concatenate([[0], np.cumsum([len(x) for x in terms])]).astype(np.int64)
        best: dict[tuple[int, int], dict] = {}
        words: tuple[int, list[str]] = (-1, [])
        for o, s, e, item, score in retrieve(index, np.concatenate(terms), at, threshold):
            text = waiting[o]
            if words[0] != text:
                words = (text, _WORD.findall(texts[text].lower()))
            a, b = s - int(at[o]), e - int(at[o])
            q, r = index.parts[item]
            found = _passage_grams(words[1][a:b], {len(g) for g in q | r})
            overlaps = _overlap(q, found), _overlap(r, found)
            hit = {"item_id": index.ids[item], "score": score, "question_overlap": overlaps[0], "answer_overlap": overlaps[1],
                   "passage_start": a, "passage_end": b}
            old = best.get((text, item))
            if overlaps[0] >= question and overlaps[1] >= answer and (old is None or score > old["score"]):
                best[text, item] = hit
        for (text, _), hit in sorted(best.items()):
            out[text].append(hit)
        waiting.clear()
        terms.clear()

    n = 0
    for i, text in enumerate(texts):
        found = _WORD.findall(text.lower())
        terms.append(np.fromiter((get(w, -1) for w in found), np.int64, len(found)))
        waiting.append(i)
        n += len(found)
        if n >= TOKENS_AT_ONCE:
            flush()
            n = 0
    if waiting:
        flush()
    return out


def leak_finder(spark: SparkSession, index: Index, threshold: float, question: float, answer: float):
    """A column function: text -> array of verified hits."""
    shared = spark.sparkContext.broadcast(tuple(index))

    @F.arrow_udf(_HIT)
    def leaks(text: pa.Array) -> pa.Array:
        return pa.array(find_leaks(Index(*shared.value), [t or "" for t in text.to_pylist()], threshold, question, answer), _ARROW)

    return leaks


@F.arrow_udf(T.ArrayType(T.StringType()))
def _item_words(text: pa.Array) -> pa.Array:
    return pa.array([sum(item_parts(t or ""), []) for t in text.to_pylist()], pa.list_(pa.string()))


def _indexes(benchmark: DataFrame, index_bytes: int):
    """The benchmark's blocks, one at a time on the driver: about index_bytes of text each, and the figures of their terms."""
    items = benchmark.where(F.col("text").isNotNull()).groupBy("item_id", "text").agg(F.lit(1).alias("one")).drop("one")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // index_bytes))
    if blocks == 1:
        index = build_index([(r.item_id, r.text) for r in items.orderBy("item_id", "text").collect()])
        if index.ids:
            yield index
        return
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block")
    words = materialize(items.select("item_id", "text", block, _item_words("text").alias("words")), "decontam-items")
    size = F.size("words")
    count = words.where(size > 0).agg(F.count(F.lit(1)).alias("n"), F.avg(size).alias("average"), F.max(size).alias("longest")).first()
    terms = words.select("block", F.explode(F.array_distinct("words")).alias("term"))
    frequency = materialize(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "decontam-terms")
    for b in range(blocks):
        rows = words.where(F.col("block") == b).select("item_id", "text").orderBy("item_id", "text").collect()
        own = frequency.join(terms.where(F.col("block") == b).select("term").distinct(), "term").collect()
        index = build_index([(r.item_id, r.text) for r in rows], Figures(count.n, count.average or 1.0, count.longest or 1, {r.term: r.df for r in own}))
        if index.ids:
            yield index


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION,
                 answer: float = ANSWER, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document and test item that it holds: doc_id, item_id, score, question_overlap, answer_overlap,
    passage_start, passage_end (in words).

    Clean documents have no row.  NULL and empty texts, and items without words, have
    none.  Very long texts are read whole, passage by passage.  Repeated rows give repeated rows.  Other columns
    are ignored.  Empty tables give an empty result.
    """
    found = None
    for index in _indexes(benchmark, index_bytes):
        leaks = leak_finder(docs.sparkSession, index, threshold, question, answer)
        part = docs.select("doc_id", leaks(F.col("text")).alias("hits")).select("doc_id", F.explode("hits").alias("hit"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.select("doc_id", F.lit(None).cast(_HIT.elementType).alias("hit")).where(F.lit(False))
    return found.select("doc_id", "hit.*")


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION,
                        answer: float = ANSWER, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    for index in _indexes(benchmark, index_bytes):
        leaks = leak_finder(docs.sparkSession, index, threshold, question, answer)
        docs = docs.where(F.size(leaks(F.col("`text`"))) == 0)
    return docs
