"""License notices in texts, by conditional compression.

A candidate is a run of words that is some template but for a few words changed, left out or added.
Runs are found without loss: within ``d`` changes, a run of a template of ``n`` words has at least
``n - d`` words that the template has, among ``n + d`` in a row, and that is counted for all
templates over all words of all texts. Where it holds, the exact wording differences confirm or refuse the template.

Several templates may confirm runs that overlap, as licenses are made from each other's wording. Each run is
compressed alone, and again with its template as a raw zstandard dictionary. The runs are ranked
by the bytes that the dictionary saves, and the winner of overlapping ones is the one that saves most: its
template explains most of what stands there, punctuation and order included. Only equal savings are settled by the fewer
changed words, then by the name.

Defined results: a null or empty text has no notices; a notice that stands twice in a text gives two
rows; repeated rows give their notices once each; ids may be null or
repeat; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from lift.llm.batches import id_and_text, slices, strings, type_of
from lift.llm.decontaminate import edit_row
from lift.llm.license_texts import TEMPLATES

WORD = re.compile(r"\w+")
#: Results and words that a worker remembers at a time.
REMEMBERED = 50_000
LEVEL = 3


class Numbers(dict):
    """Words as they stand in texts, by the number of their lower case; 0 for words of no template."""

    def __init__(self, known: Mapping[str, int]) -> None:
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> int:
        if len(self) > 20 * REMEMBERED:
            self.clear()
        self[word] = number = self.known.get(word.lower(), 0)
        return number


@dataclass(frozen=True)
class Notice:
    license: str
    start: int
    end: int
    saved: float
    changed: int
    words: int


class Scanner:
    """The templates as words and as dictionaries, and how much of a wording may differ."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], similarity: float) -> None:
        self.names, self.texts = zip(*[(name, text) for name, some in templates.items() for text in some])
        words = [[w.lower() for w in WORD.findall(text)] for text in self.texts]
        known = {word: i for i, word in enumerate(sorted({w for some in words for w in some}), 1)}
        self.numbers, self.known = Numbers(known), len(known)
        self.words = [np.array([known[w] for w in some], np.int64) for some in words]
        self.limits = [int(len(some) * (1 - similarity) + 1e-9) for some in words]
        self.member = np.zeros((len(words), len(known) + 1), bool)
        for k, some in enumerate(self.words):
            self.member[k, some] = True
        plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.plain = plain
        self.packers = []
        for text in self.texts:
            dictionary = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False))
        self.most = [max(1, self.reduction(text, k)) for k, text in enumerate(self.texts)]
        self.confirmed: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}

    def reduction(self, run: str, k: int) -> int:
        """The bytes that template ``k`` as a dictionary saves."""
        raw = run.lower().encode()
        return len(self.plain.compress(raw)) - len(self.packers[k].compress(raw))

    def notices(self, texts: list[str]) -> Iterator[tuple[int, Notice]]:
        """The notices of each text, by place."""
        lists = [WORD.findall(text) for text in texts]
        words = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))
        offset = np.concatenate(([0], np.cumsum([len(some) for some in lists])))
        held: dict[int, list[int]] = {}
        for k, wanted in enumerate(self.words):
            size = len(wanted) + self.limits[k]
            known = np.concatenate(([0], np.cumsum(self.member[k][words], dtype=np.int32)))
            # a run of size words from each place on; it may reach into the next text, which only adds candidates
            has = known[np.minimum(np.arange(len(words)) + size, len(words))] - known[:-1]
            begins = np.flatnonzero(has >= max(1, len(wanted) - self.limits[k]))
            for row in np.unique(np.searchsorted(offset, begins, side="right") - 1).tolist():
                held.setdefault(row, []).append(k)
        for row in sorted(held):
            for notice in self.judge(texts[row], words[offset[row]:offset[row + 1]], held[row]):
                yield row, notice

    def judge(self, text: str, run: np.ndarray, templates: list[int]) -> list[Notice]:
        """Confirm templates by their wording, and give overlapping runs to the one that saves most."""
        confirmed = [(k, cost, a + begin, a + end) for k in templates for a, b in regions(self.words[k], run, self.limits[k], self.known)
                     for cost, begin, end in self.within(k, run[a:b]) if end > begin]
        if not confirmed:
            return []
        spans = [m.span() for m in WORD.finditer(text)]
        saving: dict[tuple[int, str], int] = {}
        ranked = []
        for k, cost, begin, end in confirmed:
            own = text[spans[begin][0]:spans[end - 1][1]]
            if (k, own) not in saving:
                saving[k, own] = self.reduction(own, k)
            ranked.append((-saving[k, own], cost, self.names[k], k, begin, end))
        taken, found = np.zeros(len(run), bool), []
        for less, cost, name, k, begin, end in sorted(ranked):
            if not taken[begin:end].any():
                taken[begin:end] = True
                found.append(Notice(name, spans[begin][0], spans[end - 1][1], round(-less / self.most[k], 4), cost, len(self.words[k])))
        return sorted(found, key=lambda n: n.start)

    def within(self, k: int, run: np.ndarray) -> list[tuple[int, int, int]]:
        """``occurrences`` of a template, reckoned once for equal runs."""
        key = k, run.tobytes()
        if key not in self.confirmed:
            if len(self.confirmed) >= REMEMBERED:
                self.confirmed.clear()
            self.confirmed[key] = occurrences(self.words[k], run, self.limits[k])
        return self.confirmed[key]


def regions(wanted: np.ndarray, run: np.ndarray, limit: int, numbers: int) -> Iterator[tuple[int, int]]:
    """Where the words can lie within ``limit`` changes: a run of at most ``len(wanted) + limit`` words has all but ``limit`` of them."""
    member = np.zeros(numbers + 1, bool)
    member[wanted] = True  # a word that the block lacks, -1, marks the last place, which no word of the run has
    known = np.concatenate(([0], np.cumsum(member[run])))
    size = min(len(wanted) + limit, len(run))
    begins = np.flatnonzero(known[size:] - known[: len(known) - size] >= max(1, len(wanted) - limit))
    if len(begins):
        cut = np.flatnonzero(np.diff(begins) > size)
        yield from zip(begins[np.concatenate(([0], cut + 1))].tolist(), (begins[np.concatenate((cut, [len(begins) - 1]))] + size).tolist())


def occurrences(wanted: np.ndarray, run: np.ndarray, limit: int) -> list[tuple[int, int, int]]:
    """``(changes, begin, end)`` of runs of words within ``limit`` changes: the best, the first of equals, and again on both sides of it.

    The costs of all ends are computed once. What is taken bounds what lies behind it, but only ends so near that a run
    could reach back into it have to be computed again.
    """
    limit = min(limit, len(wanted) - 1)  # of a notice, one word at least is in place
    cost, begin = edit_row(wanted, run)
    far = len(wanted) + limit
    open_ends = [(c, e) for c, e in zip(cost.tolist(), range(len(cost))) if c <= limit]
    heapify(open_ends)
    free = np.ones(len(run) + 1, bool)  # ends that nothing taken covers
    found = []
    while open_ends:
        c, e = heappop(open_ends)
        if not free[e] or cost[e] != c:  # taken, or computed again since
            continue
        a = int(begin[e])
        found.append((c, a, e))
        free[a + 1 : e + 1] = False
        taken = np.flatnonzero(~free[e + 1 : e + far + 1])
        to = e + int(taken[0]) if len(taken) else min(len(run), e + far)
        near, origin = edit_row(wanted, run[e:to])
        old = cost[e + 1 : to + 1].copy()
        cost[e + 1 : to + 1], begin[e + 1 : to + 1] = near[1:], origin[1:] + e
        for at in np.flatnonzero((near[1:] <= limit) & (near[1:] != old)).tolist():
            heappush(open_ends, (int(near[at + 1]), e + 1 + at))
    return found


def license_notices(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
                    similarity: float = 0.9) -> DataFrame:
    """``(id, license, start, end, saved, changed_words, template_words)`` of every notice; places count code points.

    ``saved`` is what the template saves on the notice, as a share of what it saves on its own text.
    """
    narrow = id_and_text(df, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, similarity)
        types = (pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
        for batch in batches:
            for part in slices(batch):
                rows, hits = [], []
                for row, n in scanner.notices(strings(part.column("text"))):
                    rows.append(row)
                    hits.append((n.license, n.start, n.end, n.saved, n.changed, n.words))
                columns = zip(*hits) if hits else [()] * len(types)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                                 ["id", "license", "start", "end", "saved", "changed_words", "template_words"])

    schema = f"id {type_of(df, id_col)}, license string, start long, end long, saved double, changed_words int, template_words int"
    return narrow.mapInArrow(run, schema).withColumnRenamed("id", id_col)
