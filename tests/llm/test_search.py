"""Exact top-k, decontamination and license notices against plain versions."""

from __future__ import annotations

import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lift.llm import decontaminate, licenses, topk
from lift.llm.decontaminate import allowed, clean_documents, contaminated, edits, words_of
from lift.llm.license_texts import TEMPLATES
from lift.llm.licenses import license_notices, occurrences, regions
from lift.llm.topk import top_k
from tests.llm.helpers import no_documents, odd_documents, pairs


def plain_top(rows, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(64 * x) for x in v]
            vectors[i] = min(vectors.get(i, q), q)
    out = []
    for i, v in vectors.items():
        if i % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors.items() if j != i and len(w) == len(v))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_in_block", [1 << 16, 50])
def test_top_k_equals_plain_version(spark, monkeypatch, rows_in_block):
    monkeypatch.setattr(topk, "BLOCK_ROWS", rows_in_block)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 4)
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(9)]) for i in range(240)]
    rows += [(300 + i, [0.5] * 9) for i in range(60)]  # many that tie
    rows += [(400, None), (401, [None] * 9), (402, [float("nan")] * 9), (403, [float("inf")] * 9), (404, []), (420, []), (406, [1.0, -2.0]), (440, [1.0, 3.0]), (None, [0.1] * 9)]
    rows += [rows[20], rows[20], (40, [0.25] * 9), (460, [-300.0, 200.0] + [0.0] * 6 + [1.0])]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "vec_id long, embedding array<double>, id string, v int").repartition(4)
    assert pairs(top_k(df, F.col("id") % 20 == 0), "query_id", "rank", "vec_id", "score") == plain_top(rows, 20)


def test_huge_components_are_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "HUGE_ROWS", 9)
    monkeypatch.setattr(topk, "GROUP_QUERIES", 2)
    rng = random.Random(7)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * rng.choice([1.0, 1.0, 2e7, 3e15, 1e300]) for _ in range(3)]) for i in range(80)]
    rows += [(100, [2e7, 1.0, 0.0]), (101, [2e7, 1.0, 0.0]), (102, [2.0**80, 0.0, 0.0]), (103, [2.0**80, 0.0, 0.0])]

    def plain():
        near = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
        ints = {i: [math.floor(64 * Fraction(x)) for x in v] for i, v in rows}
        for i, v in ints.items():
            if i % 20 == 0:
                scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ints.items() if j != i)
                yield from ((i, r, j, near(-s)) for r, (s, j) in enumerate(scores[:20], 1))

    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert pairs(top_k(df, F.col("id") % 20 == 0), "query_id", "rank", "vec_id", "score") == sorted(plain(), key=str)
    small = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2e7, 1.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert pairs(top_k(small, F.col("id") % 20 == 0), "query_id", "rank", "vec_id") == [(0, 1, 1), (0, 2, 2)]


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("id") % 20 == 0).collect() == []
    one = spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")
    assert top_k(one, F.col("id") % 20 == 0).collect() == []


def plain_edits(item, run):
    """Least cost over all runs of words, by the whole table."""
    cost = [0] * (len(run) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(run, 1):
            new.append(min(cost[j - 1] + (a != b), cost[j] + 1, new[j - 1] + 1))
        cost = new
    return min(cost)


def test_edits_equal_plain_version():
    rng = np.random.default_rng(3)
    for _ in range(300):
        item, run = rng.integers(0, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(0, 15))
        cost, begin, end = edits(item, run)
        assert cost == plain_edits(item.tolist(), run.tolist())
        own = run[begin:end].tolist()  # the run that it names has that cost as a whole
        assert plain_edits([-1, *item.tolist(), -2], [-1, *own, -2]) == cost


def passages(seed, edit):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "er", "ist", "ol", "um", "ey", "ax", "ip")]
    items = [(i, " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed"]) for _ in range(rng.randint(9, 50)))) for i in range(12)] + [(90, "too short"), (91, None)]
    docs, planted = [], set()
    for d in range(60):
        body = [rng.choice(words) for _ in range(rng.randint(0, 200))]
        if d % 3 == 0:
            item = items[rng.randrange(12)]
            copy = item[1].split()
            for _ in range(allowed(len(copy), 0.8) if edit else 0):
                at = rng.randrange(len(copy))
                kind = rng.randrange(3)
                if kind == 0:
                    copy[at] = "changed"
                elif kind == 1:
                    del copy[at]
                else:
                    copy.insert(at, "added")
            at = rng.randint(0, len(body))
            body[at:at] = copy
            planted.add((d, item[0]))
        docs.append((d, " ".join(body).title() if d % 2 else ", ".join(body)))
    return items, docs, planted


@pytest.mark.parametrize("edit", [False, True])
def test_passages_equal_plain_version(spark, edit):
    caught = total = 0
    for seed in (1, 2, 3):
        items, docs, planted = passages(seed, edit)
        found = contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
        found = {(r["id"], r["item"]): r["edits"] for r in found.collect()}
        want = {}
        for d, text in docs:
            for i, item in items:
                words = words_of(item or "")
                cost = plain_edits(words, words_of(text))
                if len(words) >= 5 and cost <= allowed(len(words), 0.8):
                    want[d, i] = cost
        assert planted <= set(want) and all(want[k] <= v for k, v in found.items()) and set(found) <= set(want)
        caught, total = caught + len(found), total + len(want)
    assert caught == total if not edit else caught >= 0.9 * total


def test_recall_of_class_is_measured():
    items, _, _ = passages(5, False)
    benchmark = decontaminate.Benchmark([(i, t or "") for i, t in items], 0.8, 0.98, 5)
    assert benchmark.keys == list(range(12)) and all(len(one.keys) >= 2 for one in benchmark.classes)


def test_clean_documents_are_whole_rows(spark):
    docs = odd_documents(spark)
    items = spark.createDataFrame([(1, "some text with password hunter2hunter2 and mail"), (2, None), (3, "")], "item_id long, text string")
    kept = clean_documents(docs, items)
    gone = [r for r in docs.collect() if r["text"] and "hunter2" in r["text"].lower()]
    assert kept.columns == docs.columns and kept.count() == docs.count() - len(gone) and len(gone) == 6
    assert contaminated(docs, items).count() == 6
    none = items.where("false")
    assert clean_documents(docs, none).count() == docs.count() and contaminated(docs, none).collect() == []
    assert contaminated(no_documents(spark), items).collect() == [] and clean_documents(no_documents(spark), items).collect() == []


def test_items_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_BYTES", 300)
    items, docs, planted = passages(4, False)
    df, table = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert planted <= {(r["id"], r["item"]) for r in contaminated(df, table).collect()}
    assert {d for d, _ in planted}.isdisjoint(r["doc_id"] for r in clean_documents(df, table).collect())


@pytest.mark.parametrize("size", [150, 300, 600])
def test_edited_copies_of_long_items_are_found(size):
    """A fifth of the words edited: walks over so many words are out of step."""
    rng = np.random.default_rng(size)
    item = lambda: " ".join(f"w{k}" for k in rng.integers(0, 3000, size))
    benchmark = decontaminate.Benchmark([(i, item()) for i in range(4)], 0.8, 0.98, 5)
    back = dict(zip(benchmark.number.values(), benchmark.number)) | {0: "other"}
    texts = [f"{item()} {' '.join(back[k] for k in benchmark.edited(benchmark.words[i % 4], rng).tolist())} {item()}" for i in range(40)]
    found = {(doc, i) for doc, i, *_ in benchmark.passages(texts)}
    assert sum((doc, doc % 4) in found for doc in range(40)) >= 39
    assert all(one.recall >= 0.98 for one in benchmark.classes)


def test_license_notices(spark):
    mit = TEMPLATES["MIT"][1]
    texts = {
        1: "Intro.\nReleased under the MIT License.\nEnd.",
        2: "x\nLicensed under CC BY-NC 4.0.\nand then Licensed under CC BY 4.0.",
        3: "A word. " + mit.replace("sell copies", "give copies").replace(". ", ".\n * ") + " More.",
        4: "This work is licensed under the GNU General Public License, version 3.",
        5: "There is no license for this and no permission is given.",
        6: "Licensed under CC BY-ND 4.0.",
        7: "This work is licensed under the GNU General Public License, version 2.",
    }
    found = license_notices(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    rows = sorted((r["doc_id"], r["license"], r["changed_words"]) for r in found.collect())
    assert rows == [(1, "MIT", 0), (2, "CC-BY-4.0", 0), (2, "CC-BY-NC-4.0", 0), (3, "MIT", 1), (4, "GPL-3.0", 0), (7, "GPL-2.0", 0)]
    for r in found.collect():
        assert texts[r["doc_id"]][r["start"] : r["end"]].split()[0] in ("Released", "Licensed", "Permission", "This") and r["saved"] > 0


def test_pieces_of_long_items():
    for words in [*range(5, 400), 1200, 6000]:
        cut = decontaminate.pieces_of(words)
        assert sum(length for _, length in cut) == words and [a for a, _ in cut] == [0, *np.cumsum([length for _, length in cut])[:-1]]
        assert len(cut) == 1 if words <= 60 else all(30 <= length <= 60 for _, length in cut)
        # however the edits fall, some piece has at most its share
        assert sum(allowed(length, 0.8) + 1 for _, length in cut) > allowed(words, 0.8)
        assert all(decontaminate.class_size(length) <= length < 1.2 * decontaminate.class_size(length) + 1 for _, length in cut)


@pytest.mark.parametrize("size", [1200, 6000])
def test_very_long_items_in_a_long_text(size):
    """Found within a text of 20,000 words over the item's own words, most edits made, and not where too many are."""
    rng = np.random.default_rng(size)
    item = " ".join(f"w{k}" for k in rng.integers(0, 500, size))
    benchmark = decontaminate.Benchmark([(7, item)], 0.8, 0.98, 5)
    assert not any(one.exact for one in benchmark.classes) and max(one.size for one in benchmark.classes) <= 60
    back = dict(zip(benchmark.number.values(), benchmark.number)) | {0: "other"}
    around = [f"w{k}" for k in rng.integers(0, 500, 20000 - size)]
    copy = [back[k] for k in benchmark.edited(benchmark.words[0], rng).tolist()]
    broken = list(copy)
    for at in rng.choice(len(copy), size // 8, replace=False):
        broken[at] = "broken"
    found = benchmark.passages([" ".join([*around[:5000], *text, *around[5000:]]) for text in (copy, broken, [])])
    (doc, item_at, cost, a, b), = found
    assert (doc, item_at) == (0, 0) and cost <= allowed(size, 0.8) and abs(a - 5000) < 20 and abs(b - 5000 - len(copy)) < 20


def test_each_item_has_the_recall_it_is_promised():
    """New copies, which ended no measuring; items of few words over and over among them."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfgh" for b in ("an", "er", "ist", "ol")]
    texts = [" ".join(rng.choice(words[: rng.choice([3, 8, 24])]) for _ in range(n)) for n in (5, 6, 9, 12, 15, 15, 20, 30, 45, 60, 75, 130)] + ["one " * 12, "a b " * 9]
    benchmark = decontaminate.Benchmark(list(enumerate(texts)), 0.8, 0.98, 5)
    back = dict(zip(benchmark.number.values(), benchmark.number)) | {0: "other"}
    fresh = np.random.default_rng(1)
    for i, item in enumerate(benchmark.words):
        found = benchmark.passages([" ".join(back[k] for k in benchmark.edited(item, fresh).tolist()) for _ in range(200)])
        assert sum(hit[1] == i for hit in found) >= 190, (i, texts[i])


def test_items_are_measured_in_tasks(spark):
    items, _, _ = passages(5, False)
    listed, = decontaminate.parts(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 0.8, 0.98, 5)
    for key, text, repeats, recall in listed:
        words = words_of(text)
        assert (repeats, recall) == (decontaminate.calibrated(words, 0.8, 0.98, decontaminate.SEED) if len(words) >= 5 else (0, 1.0))


def test_every_template_is_confirmed_by_its_wording(spark):
    rng = random.Random(1)
    every = [(name, text) for name, some in TEMPLATES.items() for text in some]
    vocabulary = ["data", "license", "permission", "copyright", "the", "of", "and", "to"] + [f"w{i}" for i in range(300)]
    other = [" ".join(rng.choice(vocabulary) for _ in range(2000)) for _ in every]
    rows = [(0, "\n".join(text for _, text in every))] + [(i, f"{x[:6000]}\n{text}\n{x[6000:]}") for i, (x, (_, text)) in enumerate(zip(other, every), 1)]
    found = license_notices(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    wanted = sorted([(0, name) for name, _ in every] + [(i, name) for i, (name, _) in enumerate(every, 1)])
    assert pairs(found, "doc_id", "license") == sorted(wanted, key=str)


def plain_occurrences(wanted, run, limit, a, b):
    cost, begin, end = edits(wanted, run[a:b])
    if cost > limit or end == begin:
        return []
    return plain_occurrences(wanted, run, limit, a, a + begin) + [(cost, a + begin, a + end)] + plain_occurrences(wanted, run, limit, a + end, b)


def test_occurrences_equal_plain_version():
    rng = np.random.default_rng(5)
    several = 0
    for _ in range(500):
        wanted = rng.integers(-1, 4, rng.integers(1, 9))
        run = rng.integers(0, 7, rng.integers(1, 60))
        limit = int(rng.integers(0, 4))
        found = [(c, a + x, a + y) for a, b in regions(wanted, run, limit, 7) for c, x, y in occurrences(wanted, run[a:b], limit)]
        assert sorted(found, key=lambda x: x[1]) == plain_occurrences(wanted, run, limit, 0, len(run))
        several += len(found) > 2
    assert several > 50


def edited_words(words, edits, rng, first):
    """``edits`` words of a text changed, left out or followed by another, those at ``first`` before others."""
    places = list(first) + rng.sample([i for i in range(len(words)) if i not in set(first)], len(words) - len(first))
    out = list(words)
    for at in sorted(places[:edits], reverse=True):
        kind = rng.randrange(3)
        out[at:at + 1] = [["changed"], [], [out[at], "added"]][kind]
    return out


def brute_notices(text, scanner):
    """Every run of words of every template, over the whole text."""
    spans = [m for m in licenses.WORD.finditer(text)]
    numbers = np.array([scanner.numbers[m.group()] for m in spans], np.int64)
    found = []
    for k, wanted in enumerate(scanner.words):
        for cost, begin, end in plain_occurrences(wanted, numbers, min(scanner.limits[k], len(wanted) - 1), 0, len(numbers)):
            found.append((-scanner.reduction(text[spans[begin].start():spans[end - 1].end()], k), cost, scanner.names[k], begin, end))
    chosen = []
    for less, cost, name, begin, end in sorted(found):
        if all(end <= a or b <= begin for *_, a, b in chosen):
            chosen.append((name, cost, spans[begin].start(), spans[end - 1].end(), begin, end))
    return sorted((name, cost, a, b) for name, cost, a, b, *_ in chosen)


def test_every_template_is_found_with_any_edits_within_the_limit(spark):
    """The words that mark licenses are edited first: nothing but the wording as a whole tells a notice."""
    rng = random.Random(11)
    cue = re.compile("licen|permission|redistribut|free|public|domain|copyright|creative|commons|source|unencumbered", re.IGNORECASE)
    texts, scanner = [], licenses.Scanner(TEMPLATES, 0.9)
    vocabulary = ["the", "of", "and", "to", "license", "software"] + [f"w{i}" for i in range(200)]
    for (name, text), limit in zip([(n, t) for n, some in TEMPLATES.items() for t in some], scanner.limits):
        words = text.split()
        marked = [i for i, w in enumerate(words) if cue.search(w)]
        for first in (marked, []):
            some = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
            while True:
                copy = " ".join(edited_words(words, limit, rng, first[:limit]))
                if edits(scanner.words[scanner.texts.index(text)], np.array([scanner.numbers[w] for w in licenses.WORD.findall(copy)]))[0] <= limit:
                    break
            texts.append((name, " ".join([*some[:20], copy, *some[20:]])))
    rows = [(i, text) for i, (_, text) in enumerate(texts)]
    found = {}
    for r in license_notices(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        found.setdefault(r["doc_id"], []).append((r["license"], r["changed_words"], r["start"], r["end"]))
    assert {i: sorted(v) for i, v in found.items()} == {i: brute_notices(text, scanner) for i, text in rows}
    assert sum(name in {x[0] for x in found[i]} for i, (name, _) in enumerate(texts)) >= len(texts) - 2  # a fellow's wording may be nearer


def test_savings_decide_between_equal_wordings(monkeypatch):
    """Two templates of the same words: the bytes that a template saves pick the one whose writing it is."""
    templates = {"A": ("grant, to all! of the: work",), "B": ("grant to (all) of the work",)}
    names = lambda text: [n.license for _, n in licenses.Scanner(templates, 0.9).notices([text])]
    assert names("x Grant, to all! of the: work x") == ["A"] and names("x Grant to (all) of the work x") == ["B"]
    monkeypatch.setattr(licenses.Scanner, "reduction", lambda *_: 0)
    assert names("x Grant to (all) of the work x") == ["A"]


def test_thousands_of_copies_of_a_notice(spark):
    line = "Licensed under CC BY 4.0.\n"
    found = license_notices(spark.createDataFrame([(1, line * 4000), (2, line)], "doc_id long, text string"))
    assert found.groupBy("doc_id", "license", "changed_words").count().orderBy("doc_id").collect() == [(1, "CC-BY-4.0", 0, 4000), (2, "CC-BY-4.0", 0, 1)]
    assert found.where("doc_id = 1").select("start").distinct().count() == 4000


def test_license_rows(spark):
    assert license_notices(odd_documents(spark)).collect() == [] and license_notices(no_documents(spark)).collect() == []
