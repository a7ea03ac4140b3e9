"""Language identification and toxicity."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from lift.llm import langid, toxicity
from lift.llm.queries import QUERIES
from tests.llm.helpers import no_documents, odd_documents, pairs

FOLDER = "/root/testdata/sf0.1"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")
TEXTS = {"de": ["und der schnee fällt", "ich und du", "der hund"], "en": ["the snow falls", "you and the dog", "then"], "xx": ["qqq zzz qq"]}


def plain_length(text, lang, order):
    """Bits of a text, by asking the contexts of its language one after the other."""
    counts = Counter()
    for one in TEXTS[lang]:
        raw = [-1] * order + list(one.encode())
        for i in range(order, len(raw)):
            for size in range(order + 1):
                counts[tuple(raw[i - size : i]), raw[i]] += 1

    def chance(context, byte):
        own = {b: n for (c, b), n in counts.items() if c == context}
        lower = (lambda b: chance(context[1:], b)) if context else (lambda b: 1 / 256)
        if not own:
            return lower(byte)
        left = sum(lower(b) for b in range(256) if b not in own)
        total, kinds = sum(own.values()), len(own)
        escape = kinds / (total + kinds) if left > 0 else 0
        return own[byte] / total * (1 - escape) if byte in own else escape * lower(byte) / left

    raw = [-1] * order + list(text.encode())
    return sum(-math.log2(chance(tuple(raw[i - order : i]), raw[i])) for i in range(order, len(raw)))


@pytest.mark.parametrize("direct", [True, False])
def test_code_lengths_equal_plain_version(spark, direct):
    rows = [(lang, text) for lang, texts in TEXTS.items() for text in texts]
    table = langid.gather_counts(spark.createDataFrame(rows, "lang string, text string").repartition(3), 2).toArrow()
    model = langid.build_model(np.array(table["lang"].to_pylist(), object), table["gram"].to_numpy(), table["times"].to_numpy(), 2)
    if not direct:
        model.direct = None
    texts = ["und", "the end", "", "Zé!", "qzqz the"]
    found = model.code_lengths([t.encode() for t in texts]) / langid.UNIT
    for i, text in enumerate(texts):
        for k, lang in enumerate(model.languages):
            assert abs(found[i, k] - plain_length(text, lang, 2)) < 1e-3


def test_only_letters_make_a_language(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(["½ ² ①", "٣ 12", "²a", "ß", None, "the snow"] * 4)], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predicted_languages(docs).collect()}
    assert [found[i] for i in range(6)] == ["und", "und", "en", "en", "und", "en"]


def test_long_texts_are_passed_over(spark):
    """The bound on bytes passes over what doesn't fit and goes on; it never ends with nothing learned."""
    ids = [i for i in range(200) if toxicity_may_learn(i)]
    texts = {i: ("long " * 2000 if n in (0, 7) else f"text {n}") for n, i in enumerate(ids)}
    docs = spark.createDataFrame([(i, t, "en") for i, t in texts.items()], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, toxic int")
    rows = toxicity.gather(docs, labels, "doc_id", "text", "lang", "toxic", 1000, 9000)
    assert sorted(r["text"] for r in rows) == sorted(t for t in texts.values() if len(t) < 9000)
    with pytest.raises(ValueError, match="max_bytes"):
        toxicity.gather(docs, labels, "doc_id", "text", "lang", "toxic", 1000, 3)


def toxicity_may_learn(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 != 2


def test_block_borders_change_nothing(monkeypatch):
    grams = langid.grams_of("the snow falls and then".encode(), 3)
    model = langid.build_model(np.array(["en"] * len(grams), object), grams, np.ones(len(grams), np.int64), 3)
    texts = [b"the end", b"", b"snow and then some"]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(langid, "BLOCK", 5)
    assert (model.code_lengths(texts) == whole).all()


@needs_tables
def test_languages_of_documents_that_nothing_was_learned_from(spark):
    found = QUERIES["op7_language_id"](spark, FOLDER).where("held_out")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) > 2000 and sum(r["lang"] == r["lang_pred"] for r in rows) > 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_rows(spark):
    docs = odd_documents(spark)
    model = langid.learn(docs)
    rows = langid.identify(docs, model).collect()
    texts = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert len(rows) == sum(texts.values())
    for r in rows:
        assert r["lang_pred"] in ("en", "de", "und")
    silent = {i for i, t in texts if not any(c.isalpha() for c in t or "")}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in rows if r["doc_id"] in silent - {None})
    assert {r["lang_pred"] for r in langid.identify(docs, langid.learn(no_documents(spark))).collect()} == {"und"}
    assert langid.identify(no_documents(spark), model).collect() == []


def labelled(spark, n):
    rng = random.Random(2)
    words = [f"{a}{b}{c}" for a in "klm" for b in "aeiou" for c in "nrstx"]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            text.insert(rng.randrange(len(text)), "grumble" + rng.choice(["", "s", "d", "r", "st", "ty"]))
        rows.append((i, " ".join(text), rng.choice(["en", "de", None]), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")


def test_scores_equal_plain_network(spark):
    docs = labelled(spark, 500)
    model = toxicity.learn(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    for row in docs.collect()[:60]:
        words = toxicity.words_of(row["text"])
        vectors = np.array([model.embedding[toxicity.parts_of(w)].sum(axis=0) if w else np.zeros(toxicity.DIMENSIONS) for w in words])
        top = [max(sum(vectors[t + j] @ kernel[j][:, f] for j in range(len(kernel))) for t in range(len(words) - len(kernel) + 1))
               for kernel in model.filters for f in range(toxicity.FILTERS)]
        raw = np.maximum(np.array(top) + model.bias, 0) @ model.weights + model.offset
        assert abs(found[row["doc_id"]] - 1 / (1 + math.exp(-(model.scale[0] * raw + model.scale[1])))) < 1e-4


def test_toxic_documents_go_and_others_stay(spark):
    docs = labelled(spark, 1500)
    model = toxicity.learn(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    kept = {r["doc_id"] for r in toxicity.accepted(docs, model).collect()}
    rows = docs.collect()
    assert sum(r["doc_id"] in kept for r in rows if r["toxic"]) <= 0.05 * len(rows) * 0.2
    assert sum(r["doc_id"] not in kept for r in rows if not r["toxic"]) <= 0.02 * len(rows)


@needs_tables
def test_toxicity_of_documents_that_nothing_was_learned_from(spark):
    found = QUERIES["op1_toxicity"](spark, FOLDER).where("held_out")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").collect()
    toxic, clean = [r["predicted"] for r in rows if r["toxic"]], [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) > 0.8 * len(toxic) and sum(clean) < 0.02 * len(clean)


def test_toxicity_rows(spark):
    docs, none = odd_documents(spark), no_documents(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    assert toxicity.score(docs, model).count() == docs.count()
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, model).collect())
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns and toxicity.accepted(none, model).collect() == []
    for some in (labels.where("toxic = 1"), labels.where("false")):
        one = toxicity.learn(docs, some)
        assert {r["score"] for r in toxicity.score(docs, one).collect()} == {1.0 if some.count() else 0.0}
    assert toxicity.score(none, toxicity.learn(none, labels)).collect() == []
    assert pairs(toxicity.score(docs, model), "doc_id")[0]


def test_thresholds_use_the_gap():
    assert toxicity.best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == pytest.approx(0.5)
    assert toxicity.best_threshold(np.array([0.1, 0.2]), np.array([0, 0])) == 0.5
    assert re.fullmatch(r"\d+", str(toxicity.BUCKETS))
