"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of up to ``order`` bytes with the
counts of the bytes that followed them. A byte seen in the longest known context
costs its share there; otherwise an escape is paid and the next shorter context
is asked, without the bytes that the longer one has already ruled out, down to
all 256 bytes alike. The escape probability is that of method C: as many escapes
as different bytes have been seen. The statistics are frozen: scoring a text
doesn't change them. The language whose code for the whole text is shortest wins.

Each language's tree is flattened into a table: for each of its own contexts and
bytes the code length in units of 2^-16 bits. The tables grow with what a language has been seen to use, and
another language adds its own table and nothing to the others'. Sums are of
integers, so they are exact and don't depend on how the rows are dealt out.

Learning takes about ``per_language`` documents of each language, chosen by a
hash of the id; that is the documented bound of the sample, and of the tables.

Defined results: a null text, an empty one and one without a letter is ``und``
with score 0; with nothing to learn from every text is; rows with a null
language teach nothing; repeated rows get one result row each; ids may be null
or repeat; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.llm.batches import held_out, id_and_text, map_slices, may_learn, slices, strings, type_of, utf8

#: Letters, and numbers of other kinds than digits, such as fractions.
LETTER = re.compile(r"[^\W\d_]")
UNIT = 1 << 16
#: Stands for the bytes before a text.
BEFORE = 0
BLOCK = 1 << 20


@dataclass
class ContextTable:
    """One language: ``lengths[context * symbols + symbol]``."""

    order: int
    code_of: np.ndarray  # byte -> symbol
    symbols: int
    contexts: list[np.ndarray]  # by context length: sorted codes
    first: list[int]  # by context length: number of its first context
    direct: np.ndarray | None  # code of the longest context -> number of the longest known context
    lengths: np.ndarray

    def rows_of(self, codes: np.ndarray) -> np.ndarray:
        """For each symbol the row of the table: its longest known context and itself."""
        history = np.zeros(len(codes), np.int64)
        for back in range(self.order, 0, -1):
            shifted = np.zeros(len(codes), np.int64)
            shifted[back:] = codes[:-back]
            history = history * self.symbols + shifted
        if self.direct is not None:
            node = self.direct[history].astype(np.int64)
        else:
            node = self.longest(history)
        return node * self.symbols + codes

    def longest(self, history: np.ndarray) -> np.ndarray:
        """The number of the longest known context that ends each history."""
        node = np.zeros(len(history), np.int64)
        for size in range(1, self.order + 1):
            tail = history % self.symbols**size
            known = self.contexts[size]
            at = np.minimum(np.searchsorted(known, tail), max(len(known) - 1, 0))
            if len(known):
                node = np.where(known[at] == tail, self.first[size] + at, node)
        return node


@dataclass
class LanguageModel:
    """The tables of all languages."""

    languages: list[str]
    order: int
    tables: list[ContextTable]

    @property
    def direct(self) -> list[np.ndarray | None]:
        return [table.direct for table in self.tables]

    @direct.setter
    def direct(self, value: None) -> None:
        """Do without the tables of codes, as languages of very many bytes do."""
        for table in self.tables:
            table.direct = value

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """The exact code length of each text in each language, in units."""
        total = np.zeros((len(self.tables), len(texts)), np.int64)
        pad = bytes(self.order)
        sizes = np.array([len(t) + self.order for t in texts], np.int64)
        flat = np.frombuffer(b"".join(part for t in texts for part in (pad, t)), np.uint8)
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        own = np.repeat(np.arange(len(texts)), sizes)
        is_pad = np.zeros(len(flat), bool)
        for k in range(self.order):
            is_pad[begins + k] = True
        for a in range(0, len(flat), BLOCK):
            lead = min(self.order, a)
            use = ~is_pad[a : a + BLOCK]
            owner = own[a : a + BLOCK][use]
            if not len(owner):
                continue
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            for sums, table in zip(total, self.tables):
                codes = np.where(is_pad[a - lead : a + BLOCK], BEFORE, table.code_of[flat[a - lead : a + BLOCK]])
                sums[owner[starts]] += np.add.reduceat(table.lengths[table.rows_of(codes)[lead:][use]], starts, dtype=np.int64)
        return total.T


def gather_counts(sample: DataFrame, order: int) -> DataFrame:
    """``(lang, gram, times)`` over a sample ``(lang, text)``: how often each run of ``order`` + 1 bytes occurs.

    A gram is a number in base 257; 0 stands for the time before the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                langs = np.array(part.column("lang").to_pylist(), object)
                texts = utf8(part.column("text"))
                for lang in dict.fromkeys(langs.tolist()):
                    grams = [grams_of(texts[i], order) for i in np.flatnonzero(langs == lang).tolist()]
                    values, times = np.unique(np.concatenate(grams), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(times)], ["lang", "gram", "times"])

    return sample.select("lang", "text").mapInArrow(run, "lang string, gram long, times long").groupBy("lang", "gram").agg(F.sum("times").alias("times"))


def grams_of(text: bytes, order: int) -> np.ndarray:
    symbols = np.concatenate((np.zeros(order, np.int64), np.frombuffer(text, np.uint8).astype(np.int64) + 1))
    grams = np.zeros(len(text), np.int64)
    for k in range(order + 1):
        grams = grams * 257 + symbols[k : k + len(text)]
    return grams


def build_model(lang: np.ndarray, gram: np.ndarray, times: np.ndarray, order: int) -> LanguageModel:
    """Flatten the context trees of all languages."""
    languages = sorted(set(lang.tolist()))
    return LanguageModel(languages, order, [context_table(gram[lang == one], times[lang == one], order) for one in languages])


def context_table(gram: np.ndarray, times: np.ndarray, order: int) -> ContextTable:
    """The code lengths of one language."""
    digits = np.stack([gram // 257 ** (order - k) % 257 for k in range(order + 1)], axis=1).astype(np.int64)
    used = np.unique(digits[:, -1])  # byte + 1
    # symbol 0: before the text, symbol 1: any byte the sample doesn't have
    symbols = len(used) + 2
    code_of = np.ones(256, np.int64)
    code_of[used - 1] = np.arange(len(used)) + 2
    recode = np.concatenate(([BEFORE], code_of))
    digits = recode[digits]
    width = np.ones(symbols)  # how many bytes a symbol stands for
    width[BEFORE], width[1] = 0, 256 - len(used)
    contexts, first, n_nodes = [np.zeros(1, np.int64)], [0], 1
    history = np.zeros(len(digits), np.int64)
    histories = [history]
    for size in range(1, order + 1):
        history = history + digits[:, order - size] * symbols ** (size - 1)
        histories.append(history)
        contexts.append(np.unique(history))
        first.append(n_nodes)
        n_nodes += len(contexts[-1])
    lengths = np.empty((n_nodes, symbols), np.int32)
    below = np.tile(width / 256, (1, 1))  # of one context: the empty one before any byte
    for size in range(order + 1):
        nodes = contexts[size]
        # a context's next shorter one is its history without the oldest byte
        parent = below[np.searchsorted(contexts[size - 1], nodes % symbols ** (size - 1))] if size else below
        at = np.searchsorted(nodes, histories[size])
        counts = np.zeros((len(nodes), symbols))
        np.add.at(counts, (at, digits[:, order]), times)
        seen = counts > 0
        kinds, total = seen.sum(axis=1, keepdims=True), counts.sum(axis=1, keepdims=True)
        rest = np.where(seen, 0, parent)
        left = rest.sum(axis=1, keepdims=True)
        # nothing left below: no escape possible
        escape = np.where(left > 0, kinds / (total + kinds), 0.0)
        share = counts / total * (1 - escape)
        below = share + escape * rest / np.where(left > 0, left, 1)
        bits = -np.log2(np.maximum(below, 2.0**-60) / np.maximum(width, 1))
        lengths[first[size] : first[size] + len(nodes)] = np.rint(bits * UNIT)
    table = ContextTable(order, code_of, symbols, contexts, first, None, lengths.reshape(-1))
    if symbols**order <= 1 << 24:
        table.direct = table.longest(np.arange(symbols**order, dtype=np.int64)).astype(np.int32)
    return table


def has_letter(text: str) -> bool:
    return any(found.group().isalpha() for found in LETTER.finditer(text))


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = 3, per_language: int = 400) -> LanguageModel:
    """Fit on about ``per_language`` documents of each language among those that are not held out."""
    rows = df.where(may_learn(named(id_col)) & named(lang_col).isNotNull()).select(
        named(id_col).alias("id"), named(lang_col).alias("lang"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    counts = {row["lang"]: row["n"] for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    every = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, max(1, n // per_language))]) if counts else F.lit(None)
    sample = rows.where(F.pmod(F.xxhash64("id"), every[F.col("lang")]) == 0) if counts else rows.limit(0)
    table = gather_counts(sample, order).toArrow()  # bounded by the sample
    return build_model(np.array(table["lang"].to_pylist(), object), table["gram"].to_numpy(), table["times"].to_numpy(), order)


def identify(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` for every row; the score is the language's share of all models' probability."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value
        texts = utf8(batch.column("text"))
        spoken = np.array([has_letter(t) for t in strings(batch.column("text"))])
        names, scores = np.full(len(texts), "und", object), np.zeros(len(texts))
        if known.languages:
            bits = known.code_lengths(texts) / UNIT
            best = bits.argmin(axis=1)
            chance = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
            names[spoken] = np.array(known.languages, object)[best[spoken]]
            scores[spoken] = chance[spoken]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["id", "lang_pred", "score"])

    narrow = id_and_text(df, id_col, text_col)
    return map_slices(narrow, work, f"id {type_of(df, id_col)}, lang_pred string, score double").withColumnRenamed("id", id_col)


def predicted_languages(df: DataFrame) -> DataFrame:
    """The prediction for every document, with the documents that nothing was learned from marked."""
    found = identify(df, learn(df))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
