"""Benchmark passages in documents, within an edit distance.

Texts are compared as sequences of lower-cased words. The random walk of the CGK
embedding moves over a sequence and copies the word it stands on, then moves on
or stays by a random bit of that word; after few edits two walks meet again, so
a small edit distance becomes a small Hamming distance. Of the embedding of every
window of an item's size a few places are sampled; windows and items
that agree in all of them are candidates. The sampling is repeated with other
random bits, as often as ``recall`` asks for, and candidates are verified by the
exact edit distance of the item to the best run of the document's words.

Walks over many words fall out of step, so an item of more than 60 words is cut into pieces of
some 40. If at most a fifth of its words are edited, some piece has at most its share of the edits; a piece that is
found points to where the item would begin, and the whole item is verified there.

Windows are only embedded where an item or piece can be: after at most ``d`` edits, a window
of ``n`` words from where it begins has at least ``n - d`` words that items of
its class have, for any ``n`` up to its size, and at least as many different
ones as its first ``n`` words, less ``d``. These tests lose nothing.

``recall`` is the target for a passage with the most edits that are allowed,
spread at random; exact copies are always found. Each item has as many repetitions as it needs: they are added
until two sets of edited copies of the item itself are found, the first as often as ``recall``
says, the second at least 0.95 times, and half as many again for good measure. This is measured in tasks, a share of the items each. An
item that the most repetitions don't suffice for, as it may be if it is one word over and over,
is not sampled: every window that passes the tests for it is verified.

Defined results: a null or empty text has no passages; items of fewer than
``least_words`` words take no part; a document that repeats as a row gets its
passages once for each row; ids may be null or repeat; empty tables give an
empty result; other columns are not looked at. Items are compared in parts of
a bounded size, one pass over the documents each.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.functions.columns import named
from lift.llm.batches import id_and_text, slices, strings, type_of
from lift.sources.shared import materialise

WORD = re.compile(r"\w+")
SAMPLED = 3
#: Longer items are cut into pieces of about so many words.
LONGEST, PIECE = 60, 40
#: Edited copies in each of an item's two sets, the share of the second to be found, and the pieces of a long item that are measured.
COPIES, FRESH, MEASURED = 64, 0.95, 8
#: So many times the repetitions that were enough are used: the copies that end the measuring flatter it.
MARGIN = 1.5
#: Item sizes of one class differ by less than this factor; its windows have the least of them.
CLASS = 1.2
MOST_REPEATS = 96
SEED = 11
#: Bytes of items compared in one pass.
PART_BYTES = 8 << 20
WINDOWS = 1 << 14


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def allowed(words: int, similarity: float) -> int:
    """The most edits of an item of so many words."""
    return int(words * (1 - similarity) + 1e-9)


def edits(item: np.ndarray, run: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of the item to a run of words within ``run``, and where that begins and ends."""
    cost, begin = edit_row(item, run)
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def edit_row(item: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every end in ``run``, the least edit distance of the item to a run of words up to there, and where that begins."""
    cost = np.zeros(len(run) + 1, np.int64)
    begin = np.arange(len(run) + 1)
    places = np.arange(len(run) + 1)
    for i, word in enumerate(item.tolist(), 1):
        swap = cost[:-1] + (run != word)
        drop = cost[1:] + 1
        best = np.concatenate(([i], np.minimum(swap, drop)))
        origin = np.concatenate(([0], np.where(swap <= drop, begin[:-1], begin[1:])))
        # an inserted word: the least of what lies left, one more for each place
        reach = np.minimum.accumulate(best - places)
        source = np.maximum.accumulate(np.where(best - places == reach, places, 0))
        cost, begin = reach + places, origin[source]
    return cost, begin


def pieces_of(words: int) -> list[tuple[int, int]]:
    """Where the pieces of an item of so many words begin, and how long they are; a short item is one piece."""
    count = 1 if words <= LONGEST else round(words / PIECE)
    cuts = [words * k // count for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def class_size(words: int) -> int:
    """The size of the windows that pieces of so many words are looked for in."""
    size = 1
    while (larger := max(size + 1, int(size * CLASS))) <= words:
        size = larger
    return size


def walk_bits(hashes: np.ndarray, repeat: int, size: int, seed: int) -> np.ndarray:
    """The random bits of every word for the steps of a walk over windows of this size."""
    spans = np.arange((2 * size + 63) // 64, dtype=np.uint64)[None, :]
    mixed = hashes[:, None] + (spans + np.uint64(repeat * 7919 + size * 104729 + seed)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return mixed ^ (mixed >> np.uint64(31))


def sampled_places(size: int, repeat: int, seed: int) -> np.ndarray:
    """The steps of a walk that one repetition compares."""
    return np.sort(np.random.default_rng([seed, size, repeat]).choice(2 * size, min(SAMPLED, 2 * size), replace=False))


def edited_copy(words: np.ndarray, most: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """A copy with ``most`` edits at random places, and the place in the item that each of its words stands for (-1: added)."""
    copy, origin = words.tolist(), list(range(len(words)))
    for _ in range(most):
        at, kind = int(rng.integers(len(copy))), int(rng.integers(3))
        if kind == 0:
            copy[at] = 0
        elif kind == 1 and len(copy) > 1:
            del copy[at], origin[at]
        else:
            copy.insert(at, 0)
            origin.insert(at, -1)
    return np.array(copy, np.int64), np.array(origin, np.int64)


def hash_of(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode())


def calibrated(words: list[str], similarity: float, recall: float, seed: int) -> tuple[int, float]:
    """The repetitions that an item needs, and the share of its edited copies found with them; (0, 1.0) if sampling doesn't suffice."""
    number = {word: i for i, word in enumerate(sorted(set(words)), 1)}
    hashes = np.array([0, *map(hash_of, number)], np.uint64)
    item = np.array([number[w] for w in words], np.int64)
    rng = np.random.default_rng([seed, len(words), hash_of(" ".join(words))])
    copies = [edited_copy(item, allowed(len(item), similarity), rng) for _ in range(2 * COPIES)]
    flat = np.concatenate([copy for copy, _ in copies])
    start = np.concatenate(([0], np.cumsum([len(copy) for copy, _ in copies])))
    looked = []  # by piece: its size and begin, the windows of the copies near it, their ends, the copies
    for offset, length in pieces_of(len(item))[:MEASURED]:
        size, near = class_size(length), allowed(length, similarity) + 2
        at = np.array([min(int(np.argmax(origin >= offset)), len(copy) - 1) for copy, origin in copies])
        begins = at[:, None] + np.arange(-near, near + 1)[None, :]
        owner = np.broadcast_to(np.arange(len(copies))[:, None], begins.shape)
        inside = (begins >= 0) & (begins < np.diff(start)[:, None])
        begins, owner = (begins + start[:-1, None])[inside], owner[inside]
        looked.append((size, offset, begins, np.minimum(begins + size, start[owner + 1]), owner))
    caught, enough = np.zeros(len(copies), bool), 0
    for repeat in range(MOST_REPEATS):
        tables = {size: (walk_bits(hashes, repeat, size, seed), sampled_places(size, repeat, seed)) for size in {x[0] for x in looked}}
        for size, offset, begins, ends, owner in looked:
            open_ones = ~caught[owner]
            if open_ones.any():
                key = embed_keys(item, np.array([offset]), np.array([offset + size]), *tables[size])
                caught[owner[open_ones][embed_keys(flat, begins[open_ones], ends[open_ones], *tables[size]) == key]] = True
        if not enough and repeat and caught[:COPIES].mean() >= recall and caught[COPIES:].mean() >= min(FRESH, recall):
            enough = repeat + 1
        if enough and repeat + 1 >= MARGIN * enough and caught.mean() >= recall:
            return repeat + 1, float(caught.mean())
    return 0, 1.0


@dataclass
class SizeClass:
    """Items and pieces of about one size, their sampled places, and the pieces of each sampled key."""

    size: int
    most_edits: int
    member: np.ndarray  # by word: does a piece of the class have it?
    kinds: int  # so many different words an edited piece has at least in a window
    recall: float  # of edited copies, the least of the items
    exact: list[int] = field(default_factory=list)  # the pieces for which every window is verified
    places: list[np.ndarray] = field(default_factory=list)  # by repetition, as are the next two
    keys: list[np.ndarray] = field(default_factory=list)
    pieces: list[np.ndarray] = field(default_factory=list)


def embed_keys(words: np.ndarray, begins: np.ndarray, ends: np.ndarray, bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Keys of the sampled places of the walks that start at ``begins`` and end before ``ends``.

    ``bits[word]`` are the word's random bits; in step j the walk moves on if bit j is set. Behind the end it stands on word 0.
    """
    at, key = begins.copy(), np.zeros(len(begins), np.uint64)
    last = int(places[-1])
    sampled = set(places.tolist())
    for step in range(last + 1):
        word = np.where(at < ends, words[np.minimum(at, len(words) - 1)], 0)
        if step in sampled:
            key = (key + word.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        at += (bits[word, step >> 6] >> np.uint64(step & 63) & np.uint64(1)).astype(np.int64)
    return key


def varied(words: np.ndarray, begins: np.ndarray, ends: np.ndarray, one: SizeClass) -> np.ndarray:
    """The windows with as many different words of items as an edited item must have."""
    places = begins[:, None] + np.arange(one.size)
    inside = places < ends[begins][:, None]
    window = np.where(inside, words[np.minimum(places, len(words) - 1)], 0)
    window = np.sort(np.where(one.member[window], window, 0), axis=1)
    kinds = (window[:, 1:] != window[:, :-1]).sum(axis=1) + (window[:, 0] > 0)
    return begins[kinds >= one.kinds]


class Benchmark:
    """The items of one part, ready to be looked for.

    An item is ``(key, text)``, or ``(key, text, repetitions, recall)`` where those have been measured.
    """

    def __init__(self, items: list[tuple], similarity: float, recall: float, least_words: int, seed: int = SEED) -> None:
        self.similarity, self.seed = similarity, seed
        listed = [(item[0], words, item[2:] or calibrated(words, similarity, recall, seed))
                  for item, words in ((item, words_of(item[1])) for item in items) if len(words) >= least_words]
        self.keys = [key for key, _, _ in listed]
        self.number = {word: i for i, word in enumerate(sorted({w for _, words, _ in listed for w in words}), 1)}  # 0: a word of no item
        self.hashes = np.array([0, *map(hash_of, self.number)], np.uint64)
        self.words = [np.array([self.number[w] for w in words], np.int64) for _, words, _ in listed]
        self.pieces = [(i, *piece) for i, words in enumerate(self.words) for piece in pieces_of(len(words))]
        by_size: dict[int, list[int]] = defaultdict(list)
        for p, (_, _, length) in enumerate(self.pieces):
            by_size[class_size(length)].append(p)
        measured = [how for _, _, how in listed]
        self.classes = [self.size_class(size, by_size[size], measured) for size in sorted(by_size)]

    def size_class(self, size: int, members: list[int], measured: list[tuple[int, float]]) -> SizeClass:
        """The sampled keys of pieces, in as many repetitions as their items need."""
        member = np.zeros(len(self.number) + 1, bool)
        own = [self.words[i][offset:offset + length] for i, offset, length in (self.pieces[p] for p in members)]
        member[np.concatenate(own)] = True
        most = max(allowed(len(words), self.similarity) for words in own)
        kinds = min(len(np.unique(words[:size])) for words in own) - most
        repeats = np.array([measured[self.pieces[p][0]][0] for p in members])
        found = SizeClass(size, most, member, kinds, min(measured[self.pieces[p][0]][1] for p in members),
                          exact=[p for p, n in zip(members, repeats.tolist()) if not n])
        for repeat in range(int(repeats.max(initial=0))):
            some = np.flatnonzero(repeats > repeat)
            flat = np.concatenate([own[k][:size] for k in some])
            begins = np.arange(len(some)) * size
            places = sampled_places(size, repeat, self.seed)
            keys = embed_keys(flat, begins, begins + size, walk_bits(self.hashes, repeat, size, self.seed), places)
            order = np.argsort(keys, kind="stable")
            found.places.append(places)
            found.keys.append(keys[order])
            found.pieces.append(np.array(members)[some[order]])
        return found

    def edited(self, words: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """A copy with the most edits that are allowed, at random places."""
        return edited_copy(words, allowed(len(words), self.similarity), rng)[0]

    def candidates(self, words: np.ndarray, document: np.ndarray) -> dict[tuple[int, int], list[int]]:
        """``(document, item) -> begins`` that items would have by the windows that agree with a piece of theirs in a sample."""
        cut = np.flatnonzero(np.concatenate((document[1:] != document[:-1], [True]))) + 1  # the ends of the documents
        end_of = cut[np.searchsorted(cut, np.arange(len(words)), side="right")]
        found: dict[tuple[int, int], list[int]] = defaultdict(list)

        def add(window: int, piece: int) -> None:
            item, offset, _ = self.pieces[piece]
            found[int(document[window]), item].append(window - offset)

        for one in self.classes:
            known = np.concatenate(([0], np.cumsum(one.member[words], dtype=np.int32)))
            ends = np.minimum(np.arange(len(words)) + one.size, end_of)
            begins = np.flatnonzero(known[ends] - known[:-1] >= max(1, one.size - one.most_edits))
            for a in range(0, len(begins), WINDOWS):
                some = varied(words, begins[a : a + WINDOWS], ends, one)
                if one.exact and len(some):
                    self.verify(one, words, some, ends, add)
                for repeat, (places, keys, pieces) in enumerate(zip(one.places, one.keys, one.pieces)):
                    seen = embed_keys(words, some, ends[some], self.tables(repeat, one.size), places)
                    first, last = np.searchsorted(keys, seen), np.searchsorted(keys, seen, side="right")
                    for w in np.flatnonzero(last > first).tolist():
                        for k in range(first[w], last[w]):
                            add(int(some[w]), int(pieces[k]))
        return found

    def verify(self, one: SizeClass, words: np.ndarray, some: np.ndarray, ends: np.ndarray, add: Callable[[int, int], None]) -> None:
        """Add all windows that have enough words of a piece."""
        low, high = int(some[0]), int(ends[some].max())
        for piece in one.exact:
            item, offset, length = self.pieces[piece]
            in_piece = np.zeros(len(self.number) + 1, bool)
            in_piece[self.words[item][offset:offset + length]] = True
            known = np.concatenate(([0], np.cumsum(in_piece[words[low:high]])))
            for w in some[known[ends[some] - low] - known[some - low] >= one.size - allowed(length, self.similarity)].tolist():
                add(w, piece)

    def tables(self, repeat: int, size: int) -> np.ndarray:
        cache = self.__dict__.setdefault("_tables", {})
        if (repeat, size) not in cache:
            cache[repeat, size] = walk_bits(self.hashes, repeat, size, self.seed)
        return cache[repeat, size]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def passages(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """``(text, item, edits, start, end)`` of the best place of each item in each text, in words."""
        if not self.words:
            return []
        find = self.number.get
        lists = [[find(w, 0) for w in words_of(text)] for text in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        words = np.concatenate([np.array(x, np.int64) for x in lists]) if lists else np.zeros(0, np.int64)
        if not len(words):
            return []
        document = np.repeat(np.arange(len(texts)), sizes)
        offset = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        results = []
        for (doc, item), begins in sorted(self.candidates(words, document).items()):
            wanted = self.words[item]
            most = allowed(len(wanted), self.similarity)
            best = None
            times = np.bincount(wanted, minlength=len(self.number) + 1)
            for a, b in regions(sorted(set(begins)), len(wanted), most, int(offset[doc]), int(offset[doc] + sizes[doc])):
                if b <= a or np.minimum(np.bincount(words[a:b], minlength=len(times)), times).sum() < len(wanted) - most:
                    continue  # too few of its words for so few edits
                cost, begin, end = edits(wanted, words[a:b])
                if cost <= most and (best is None or cost < best[0]):
                    best = cost, a + begin - int(offset[doc]), a + end - int(offset[doc])
            if best:
                results.append((doc, item, *best))
        return results


def regions(begins: list[int], size: int, slack: int, least: int, most: int) -> Iterator[tuple[int, int]]:
    """Where the item can lie for windows that begin there; regions that touch become one."""
    at = None
    for begin in begins:
        a, b = max(least, begin - 2 * slack), min(most, begin + size + 2 * slack)
        if at and a <= at[1]:
            at = at[0], max(b, at[1])
        else:
            if at:
                yield at
            at = a, b
    if at:
        yield at


def parts(items: DataFrame, item_col: str, item_text: str, similarity: float, recall: float, least_words: int) -> Iterator[list[tuple]]:
    """The items with their repetitions, in parts whose size is checked before they are brought together."""
    rows = items.select(named(item_col).alias("item"), F.coalesce(named(item_text), F.lit("")).alias("text")).distinct()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = [words_of(text) for text in strings(batch.column("text"))]
            found = [calibrated(words, similarity, recall, SEED) if len(words) >= least_words else (0, 1.0) for words in listed]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("text"), pa.array([n for n, _ in found], pa.int32()),
                                              pa.array([share for _, share in found], pa.float64())], ["item", "text", "repeats", "recall"])

    # dealt out by turns: the partitioning of the distinct rows would be kept, and its small partitions made one
    spread = rows.repartition(int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = materialise(spread.mapInArrow(measure, f"item {type_of(items, item_col)}, text string, repeats int, recall double"), "benchmark")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = -(-size // PART_BYTES)
    for part in range(count):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == part) if count > 1 else rows
        yield [tuple(row) for row in own.orderBy("item", "text").collect()]


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 similarity: float = 0.8, recall: float = 0.98, least_words: int = 5) -> DataFrame:
    """``(id, item, edits, item_words, start_word, end_word)``: the best passage of each item in each row that has one."""
    narrow = id_and_text(df, id_col, text_col)
    kinds = type_of(df, id_col), type_of(items, item_col)
    schema = f"id {kinds[0]}, item {kinds[1]}, edits int, item_words int, start_word int, end_word int"
    found = None
    for part in parts(items, item_col, item_text, similarity, recall, least_words):
        shared = df.sparkSession.sparkContext.broadcast(Benchmark(part, similarity, recall, least_words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            benchmark = shared.value
            for batch in batches:
                for one in slices(batch):
                    hits = benchmark.passages(strings(one.column("text")))
                    rows = np.array(hits, np.int64).reshape(-1, 5)
                    numbers = [rows[:, 2], np.array([len(benchmark.words[i]) for i in rows[:, 1]], np.int64), rows[:, 3], rows[:, 4]]
                    yield pa.RecordBatch.from_arrays(
                        [one.column(0).take(pa.array(rows[:, 0])), pa.array([benchmark.keys[i] for i in rows[:, 1]], one_type),
                         *[pa.array(x.astype(np.int32)) for x in numbers]], ["id", "item", "edits", "item_words", "start_word", "end_word"])

        one_type = arrow_type(items, item_col)
        hits = narrow.mapInArrow(run, schema)
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else df.sparkSession.createDataFrame([], schema)


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    return df.select(named(name)).limit(0).toArrow().schema.field(0).type


def clean_documents(df: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                    similarity: float = 0.8, recall: float = 0.98, least_words: int = 5) -> DataFrame:
    """The rows of ``df``, whole, that hold no passage of any item."""
    for part in parts(items, item_col, item_text, similarity, recall, least_words):
        shared = df.sparkSession.sparkContext.broadcast(Benchmark(part, similarity, recall, least_words))

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for one in slices(batch, text_col):
                    mask = np.ones(one.num_rows, bool)
                    mask[[hit[0] for hit in shared.value.passages(strings(one.column(text_col)))]] = False
                    yield one.filter(pa.array(mask))

        df = df.mapInArrow(keep, df.schema)
    return df
