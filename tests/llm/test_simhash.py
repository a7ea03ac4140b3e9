from __future__ import annotations

import random
from collections import defaultdict

import pytest
import xxhash

from lift.llm.components import component_map
from lift.llm.simhash import POSITION_SETS, near_copies, one_of_each
from tests.llm.helpers import no_documents, odd_documents, odd_rows, pairs


def plain_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in "\x20\x09\x0a\x0b\x0c\x0d":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(edges, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in edges:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def plain_copies(rows):
    prints = [(i, plain_print(text)) for i, text in rows]
    distinct = sorted({p for _, p in prints})
    group = plain_groups([(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2], distinct)
    least = defaultdict(list)
    for i, p in prints:
        if i is not None:
            least[group[p]].append(i)
    return sorted([(i, f"{p:016x}", min(least[group[p]], default=None)) for i, p in prints], key=str)


def test_position_sets_meet_any_two_differing_positions():
    assert all(any(not {x, y} & set(one) for one in POSITION_SETS) for x in range(8) for y in range(8))


def near_rows(n):
    """Groups of copies of which some differ in a word or two."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(n):
        if i % 3 or not rows:
            text = [rng.choice(words) for _ in range(rng.randint(1, 150))]
        else:
            text = rows[rng.randrange(len(rows))][1].split()
            if rng.random() < 0.6:
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    base = [rng.choice(words) for _ in range(400)]
    for k in range(120):  # one large group of near copies
        text = list(base)
        text[rng.randrange(400)] = rng.choice(words)
        rows.append((n + k, " ".join(text)))
    return rows


@pytest.mark.parametrize("list_length", [1, 64])
def test_equals_plain_version(spark, list_length):
    rows = near_rows(300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = pairs(near_copies(df, list_length=list_length), "doc_id", "fingerprint", "component_id")
    assert found == plain_copies(rows)
    assert len({c for _, _, c in found}) < len(rows) - 100


def test_odd_rows(spark):
    rows = [(row[0], row[1]) for row in odd_rows()]
    assert pairs(near_copies(odd_documents(spark)), "doc_id", "fingerprint", "component_id") == plain_copies(rows)
    assert near_copies(no_documents(spark)).collect() == []


def test_one_of_each_keeps_whole_rows(spark):
    docs = odd_documents(spark)
    kept = one_of_each(docs, "doc_id", near_copies)
    assert kept.columns == docs.columns
    found = plain_copies([(row[0], row[1]) for row in odd_rows()])
    ids = sorted(row["doc_id"] for row in kept.collect() if row["doc_id"] is not None)
    assert ids == sorted({i for i, _, c in found if i is not None and i == c})
    assert one_of_each(no_documents(spark), "doc_id", near_copies).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    edges = [(a, b) for a, b in edges if a != b]
    nodes = {x for e in edges for x in e}
    want = plain_groups(edges, nodes)
    found = {row["v"]: row["component"] for row in component_map(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(found) == nodes
    assert len({(want[n], found[n]) for n in nodes}) == len(set(want.values())) == len(set(found.values()))


def test_no_edges(spark):
    assert component_map(spark.createDataFrame([], "a long, b long")).collect() == []
