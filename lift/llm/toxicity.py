"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed vectors of the word and of its
beginnings, so that words of one stem share most of it. Filters of several widths
slide over the words; of each filter the largest response over the whole text is
kept (max pooling after a rectifier), and a logistic layer makes the score. As a
filter is a sum over its words, its responses are sums of rows of a table with a
row for each different word.

Learning takes at most ``max_rows`` labelled documents of ``max_bytes`` in all,
chosen by a hash of the id; that is the documented bound of the sample. A quarter of the sample is kept
back to scale the scores and to set a threshold for each language, which only
says from which score on a document is rejected: the language is no input of a
score. A language with few positives there shares the common threshold.

Defined results: a null or empty text is scored like any text without words;
with labels of one kind only, or none, the score is their mean (0 without
any); several labels of an id count as the largest; null labels teach
nothing; repeated rows get one result row each; ids may be null or repeat; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import copy
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.llm.batches import held_out, id_and_text, map_slices, may_learn, slices, strings, type_of
from lift.sources.shared import materialise

WORD = re.compile(r"[^\W_]+")
BUCKETS = 1 << 18
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
#: Lengths of the beginnings that count beside the whole word.
BEGINNINGS = (3, 4, 5, 6, 7)
PARTS = len(BEGINNINGS) + 1
REMEMBERED = 500_000


@dataclass
class ToxicityModel:
    """Trained weights, their tables for scoring, and thresholds by language."""

    embedding: np.ndarray  # (BUCKETS + 1, DIMENSIONS); the last row is zero, for padding
    filters: list[np.ndarray]  # by width: (width, DIMENSIONS, FILTERS)
    bias: np.ndarray  # one per filter of any width
    weights: np.ndarray
    offset: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5
    constant: float | None = None

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        raw = np.maximum(pooled + self.bias, 0) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * raw + self.scale[1], -30, 30)))


def parts_of(word: str) -> list[int]:
    """The buckets of a word and of its beginnings that are shorter."""
    found = [xxhash.xxh32_intdigest(word.encode(), 1) % BUCKETS]
    found += [xxhash.xxh32_intdigest(word[:n].encode(), 2) % BUCKETS for n in BEGINNINGS if n < len(word)]
    return found + [BUCKETS] * (PARTS - len(found))


def words_of(text: str) -> list[str]:
    """The words of a text; a text is padded with empty ones to the widest filter."""
    found = WORD.findall(text.lower())
    return found + [""] * (max(WIDTHS) - len(found))


class Words:
    """Different words by number, with the buckets of each; the empty word is number 0."""

    def __init__(self) -> None:
        self.number = {"": 0}
        self.flat = array("i", [BUCKETS] * PARTS)

    def ids(self, words: list[str]) -> np.ndarray:
        number = self.number
        for word in sorted(set(words).difference(number)):  # numbers, and so sums, come out alike in every process
            number[word] = len(number)
            self.flat.extend(parts_of(word))
        return np.fromiter(map(number.__getitem__, words), np.int32, len(words))

    def parts(self, begin: int = 0) -> np.ndarray:
        """The buckets of the words from number ``begin`` on."""
        return np.array(self.flat[begin * PARTS :], np.int32).reshape(-1, PARTS)


class Scorer:
    """Responses of every word met so far, for one set of weights."""

    def __init__(self, embedding: np.ndarray, filters: list[np.ndarray]) -> None:
        self.embedding, self.kernel = embedding.astype(np.float32), np.concatenate([part for one in filters for part in one], axis=1).astype(np.float32)
        self.forget()

    def forget(self) -> None:
        self.words = Words()
        self.table = np.zeros((1, self.kernel.shape[1]), np.float32)

    def pool(self, texts: list[str]) -> np.ndarray:
        """The largest response of each filter over each text."""
        if len(self.table) > REMEMBERED:
            self.forget()
        ids = [self.words.ids(words_of(text)) for text in texts]
        new = self.words.parts(len(self.table))
        if len(new):
            self.table = np.concatenate((self.table, self.embedding[new].sum(axis=1) @ self.kernel))
        return np.array([np.concatenate([found.max(axis=0) for found in responses(self.table[one])]) for one in ids]).reshape(len(texts), -1)


def responses(rows: np.ndarray) -> list[np.ndarray]:
    """For each width, the filters' responses at every place, from what each word adds in each place of a filter."""
    found, column = [], 0
    for width in WIDTHS:
        count = len(rows) - width + 1
        total = rows[:count, column : column + FILTERS]
        for place in range(1, width):
            total = total + rows[place : place + count, column + place * FILTERS : column + (place + 1) * FILTERS]
        found.append(total)
        column += width * FILTERS
    return found


def train(texts: list[str], labels: np.ndarray, check: tuple[list[str], np.ndarray] | None = None, epochs: int = 10, batch: int = 64,
          rate: float = 0.01, seed: int = 7, least_texts: int = 5) -> ToxicityModel:
    """Fit by Adam on small batches; gradients flow through the pooled places only.

    Buckets of fewer than ``least_texts`` texts keep a zero vector, as a rare
    word could only be learned by heart. Of all epochs the one with the least
    loss on ``check`` is kept.
    """
    rng = np.random.default_rng(seed)
    words = Words()
    ids = [words.ids(words_of(text)) for text in texts]
    parts = words.parts()
    del words, texts
    model = ToxicityModel(rng.normal(0, 0.01, (BUCKETS + 1, DIMENSIONS)).astype(np.float32), [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)) for w in WIDTHS],
                          np.zeros(len(WIDTHS) * FILTERS), rng.normal(0, 0.3, len(WIDTHS) * FILTERS), 0.0)
    texts_of = np.zeros(BUCKETS + 1, np.int64)
    for one in ids:
        texts_of[np.unique(parts[np.unique(one)])] += 1
    alive = texts_of >= least_texts
    alive[BUCKETS] = False
    model.embedding[~alive] = 0
    best, least_loss = None, np.inf
    dense = [*model.filters, model.bias, model.weights]
    first, second = [np.zeros_like(x) for x in dense], [np.zeros_like(x) for x in dense]
    e_first, e_second = np.zeros_like(model.embedding), np.zeros_like(model.embedding)
    o_first = o_second = 0.0
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(ids))
        for a in range(0, len(ids), batch):
            rows = order[a : a + batch]
            some, want = [ids[i] for i in rows], labels[rows]
            used, place_of = np.unique(np.concatenate(some), return_inverse=True)
            vectors = model.embedding[parts[used]].sum(axis=1, dtype=np.float64)
            table = vectors @ np.concatenate([part for one in model.filters for part in one], axis=1)
            top, places, at = [], [], 0
            for one in some:
                found = responses(table[place_of[at : at + len(one)]])
                where = [x.argmax(axis=0) for x in found]
                top.append(np.concatenate([x[w, np.arange(FILTERS)] for x, w in zip(found, where)]))
                places.append(np.concatenate(where))
                at += len(one)
            top, places = np.array(top), np.array(places)
            hidden = np.maximum(top + model.bias, 0)
            drop = (rng.random(hidden.shape) < 0.8) / 0.8
            raw = (hidden * drop) @ model.weights + model.offset
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - want) / len(rows)
            g_hidden = np.outer(error, model.weights) * drop * (hidden > 0)
            grads = [np.zeros_like(x) for x in model.filters]
            touched, pushed = [], []
            for k, kernel in enumerate(model.filters):
                columns = slice(k * FILTERS, (k + 1) * FILTERS)
                g = g_hidden[:, columns]
                for j in range(len(kernel)):
                    word = np.array([one[places[r, columns] + j] for r, one in enumerate(some)])  # (rows, FILTERS)
                    grads[k][j] = np.einsum("rfd,rf->df", vectors[np.searchsorted(used, word)], g)
                    touched.append(parts[word].reshape(-1, PARTS))
                    pushed.append((g[:, :, None] * kernel[j].T[None]).reshape(-1, DIMENSIONS))
            bucket, g = np.concatenate(touched).ravel(), np.repeat(np.concatenate(pushed), PARTS, axis=0)
            bucket, g = bucket[alive[bucket]], g[alive[bucket]]
            unique, at = np.unique(bucket, return_inverse=True)
            g_embedding = np.zeros((len(unique), DIMENSIONS))
            np.add.at(g_embedding, at, g)
            step += 1
            low, high = 1 - 0.9**step, 1 - 0.999**step
            for x, g, m, v in zip(dense, [*grads, g_hidden.sum(axis=0), (hidden * drop).T @ error + 1e-4 * model.weights], first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / low) / (np.sqrt(v / high) + 1e-8)
            e_first[unique] += 0.1 * (g_embedding - e_first[unique])
            e_second[unique] += 0.001 * (g_embedding**2 - e_second[unique])
            model.embedding[unique] -= rate * (e_first[unique] / low) / (np.sqrt(e_second[unique] / high) + 1e-8)
            g = error.sum()
            o_first, o_second = o_first + 0.1 * (g - o_first), o_second + 0.001 * (g * g - o_second)
            model.offset -= rate * (o_first / low) / (np.sqrt(o_second / high) + 1e-8)
        if check:
            chance = np.clip(model.scores(Scorer(model.embedding, model.filters).pool(check[0])), 1e-6, 1 - 1e-6)
            loss = -np.mean(np.log(np.where(check[1] > 0, chance, 1 - chance)))
            if loss < least_loss:
                best, least_loss = copy.deepcopy(model), loss
    return best or model


def calibrate(model: ToxicityModel, pooled: np.ndarray, labels: np.ndarray, langs: list[str | None], least: int = 20) -> None:
    """Scale the scores to the labels that were kept back, and set the thresholds."""
    raw = np.maximum(pooled + model.bias, 0) @ model.weights + model.offset
    a, b = 1.0, 0.0
    for _ in range(200):  # Newton steps for the two numbers, held near (1, 0)
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        g = np.array([((p - labels) * raw).sum() + 0.1 * (a - 1), (p - labels).sum() + 0.1 * b])
        w = p * (1 - p)
        h = np.array([[(w * raw * raw).sum() + 0.1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 0.1]])
        move = np.linalg.solve(h, g)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-9:
            break
    model.scale = (max(a, 0.05), b)
    score = model.scores(pooled)
    model.threshold = best_threshold(score, labels)
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        if labels[own].sum() >= least:
            model.thresholds[lang] = best_threshold(score[own], labels[own])


def best_threshold(score: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap in the scores that gives the best F1; 0.5 if there is nothing to find."""
    if not labels.any():
        return 0.5
    order = np.argsort(-score, kind="stable")
    score, labels = score[order], labels[order]
    hit = np.cumsum(labels)
    f1 = 2 * hit / (np.arange(1, len(labels) + 1) + labels.sum())
    last = np.append(score[:-1] != score[1:], True)  # equal scores are not divided
    k = int(np.argmax(np.where(last, f1, -1)))
    below = score[k + 1] if k + 1 < len(score) else 0.0
    return float((score[k] + below) / 2)


def gather(df: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_col: str, max_rows: int, max_bytes: int) -> list[Row]:
    """At most ``max_rows`` labelled documents of ``max_bytes`` in all, in an order that depends on their ids alone.

    A text that doesn't fit into what is left is passed over; the next ones may fit.
    """
    usable = labels.where(may_learn(named(id_col)) & named(label_col).isNotNull())
    picked = usable.groupBy(named(id_col).alias("key")).agg(F.max(named(label_col)).alias("label")).orderBy(F.xxhash64("key"), "key").limit(max_rows)
    # at most max_rows narrow rows: their bound makes the broadcast safe
    read = df.select(named(id_col).alias("own"), F.coalesce(named(text_col), F.lit("")).alias("text"), named(lang_col).cast("string").alias("lang"))
    rows = read.join(F.broadcast(picked), F.col("own") == F.col("key")).select("key", "text", "lang", F.col("label").cast("int").alias("label"))
    one_each = materialise(rows.groupBy("key").agg(F.min(F.struct("text", "lang", "label")).alias("row")).select("key", "row.*"), "toxicity-sample")
    order = (F.xxhash64("key"), "key")
    left, passed, kinds = max_bytes, [], [set(), set()]
    for row in one_each.select("key", F.octet_length("text").alias("size"), "label").orderBy(*order).collect():  # max_rows narrow rows
        fits = row["size"] <= left
        left -= row["size"] if fits else 0
        kinds[fits].add(bool(row["label"]))
        if not fits:
            passed.append(row["key"])
    if len(kinds[False] | kinds[True]) == 2 > len(kinds[True]):
        raise ValueError(f"no labelled text of one kind fits into max_bytes={max_bytes}")
    kept = one_each.where(~F.col("key").isin(passed)) if passed else one_each
    return kept.orderBy(*order).collect()


def learn(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic",
          max_rows: int = 8_000, max_bytes: int = 64 << 20) -> ToxicityModel:
    """Train on the rows that are not held out; the score depends on the text alone."""
    return fit(gather(df, labels, id_col, text_col, lang_col, label_col, max_rows, max_bytes))


def fit(rows: list[Row]) -> ToxicityModel:
    """Train on three quarters of the rows, calibrate on the rest."""
    texts, langs = [row["text"] for row in rows], [row["lang"] for row in rows]
    want = np.array([1.0 if row["label"] else 0.0 for row in rows])
    if len(set(want.tolist())) < 2:
        empty = train([], np.zeros(0), epochs=0)
        empty.constant = float(want.mean()) if len(want) else 0.0
        return empty
    back = np.arange(len(rows)) % 4 == 3
    rows.clear()  # the texts are held once
    if want[~back].sum() in (0, (~back).sum()):
        back[:] = False
    check = ([one for one, b in zip(texts, back) if b], want[back]) if want[back].any() else None
    model = train([one for one, b in zip(texts, back) if not b], want[~back], check)
    use = back if check else np.ones(len(texts), bool)
    pooled = Scorer(model.embedding, model.filters).pool([one for one, u in zip(texts, use) if u])
    calibrate(model, pooled, want[use], [lang for lang, u in zip(langs, use) if u])
    return model


def scorer(df: DataFrame, model: ToxicityModel) -> Callable[[list[str]], np.ndarray]:
    """A function of texts, with the weights sent once to each worker."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    own: list[Scorer] = []

    def run(texts: list[str]) -> np.ndarray:
        known = shared.value
        if known.constant is not None:
            return np.full(len(texts), known.constant)
        if not own:
            own.append(Scorer(known.embedding, known.filters))
        return known.scores(own[0].pool(texts)) if texts else np.zeros(0)

    return run


def score(df: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """``(id, score)`` for every row; with ``lang_col`` also ``rejected``, whether the score reaches the threshold of the row's language."""
    run = scorer(df, model)
    own, common = model.thresholds, model.threshold

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = run(strings(batch.column("text")))
        columns = {"id": batch.column(0), "score": pa.array(scores, pa.float64())}
        if lang_col:
            columns["rejected"] = pa.array(scores >= np.array([own.get(lang, common) for lang in batch.column(2).to_pylist()]), pa.bool_())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    narrow = id_and_text(df, id_col, text_col, *([lang_col] if lang_col else []))
    schema = f"id {type_of(df, id_col)}, score double" + (", rejected boolean" if lang_col else "")
    return map_slices(narrow, work, schema).withColumnRenamed("id", id_col)


def accepted(df: DataFrame, model: ToxicityModel, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``df``, whole, whose score stays below the threshold of their language."""
    run = scorer(df, model)
    own, common = model.thresholds, model.threshold

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                limits = np.array([own.get(lang, common) for lang in part.column(lang_col).to_pylist()])
                yield part.filter(pa.array(run(strings(part.column(text_col))) < limits))

    return df.mapInArrow(keep, df.schema)


def toxicity_scores(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The score of every document, with the documents that nothing was learned from marked."""
    found = score(df, learn(df, labels), lang_col="lang")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"), "rejected")
