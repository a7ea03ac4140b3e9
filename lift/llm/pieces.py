"""SentencePiece BPE with byte fallback, encoded by vectorised merge rounds.

Text is cut where no piece can reach across, at every run of blanks that follows
something else; what lies between is a word, and equal words are encoded once per
slice. All words of a slice lie in one flat array of symbols. A round finds the
lowest pair rank of every word, merges the leftmost pair of that rank in each
word (all of them at once, left to right without overlap, where no merge could
give a better pair), and closes the gaps. Words without a pair leave the array.

Only the vocabulary with its scores is read from the model file; it is a
parameter and nothing is trained.

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated rows get one result row each; a text of any length is encoded whole;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lift.llm.batches import id_and_text, map_slices, strings, type_of

SPACE = "▁"
#: A run of blanks and the word behind it. A first word without blanks gets its blank from the dummy prefix.
WORD = re.compile(SPACE + "+[^" + SPACE + "]*")
#: Words kept with their ids between slices; beyond it the memory starts anew.
REMEMBERED = 400_000
#: A word of more symbols whose merges must be made one by one goes through a queue.
LONG = 64
NONE = np.iinfo(np.int32).max


class PieceModel:
    """A piece vocabulary as arrays: merges by pair, byte pieces, and the bytes of every id."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.unknown = model.unk_id()
        pieces = [model.id_to_piece(i) for i in range(size)]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(size)]
        by_text = {piece: i for i, (piece, use) in enumerate(zip(pieces, plain)) if use}
        order = {score: rank for rank, score in enumerate(sorted({model.get_score(i) for i in by_text.values()}, reverse=True))}
        self.byte_ids = np.full(256, self.unknown, np.int32)
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(pieces[i][1:-1], 16)] = i
        self.has_bytes = bool((self.byte_ids != self.unknown).all())
        # symbols: ids of pieces, then one more for any character that is no piece
        self.other = size
        self.char_ids = np.full(0x110000, self.other, np.int32)
        for piece, i in by_text.items():
            if len(piece) == 1:
                self.char_ids[ord(piece)] = i
        merges = [(by_text[piece[:cut]], by_text[piece[cut:]], i) for piece, i in by_text.items()
                  for cut in range(1, len(piece)) if piece[:cut] in by_text and piece[cut:] in by_text]
        table = np.array(sorted(merges), np.int64).reshape(-1, 3)
        self.pair_keys = table[:, 0] * (size + 1) + table[:, 1]
        self.pair_to = table[:, 2].astype(np.int32)
        self.pair_of = {(a, b): to for a, b, to in merges}
        self.rank_of = np.full(size + 1, NONE, np.int32)
        for i in by_text.values():
            self.rank_of[i] = order[model.get_score(i)]
        # ids whose merging can give a pair that is due no later than they were
        self.hasty = np.zeros(size + 1, bool)
        for side in (0, 1):
            early = self.rank_of[table[:, 2]] <= self.rank_of[table[:, side]]
            self.hasty[table[early, side]] = True
        self.raw = [bytes([int(p[1:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else
                    " ⁇ ".encode() if model.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.is_byte = [model.is_byte(i) for i in range(size)]
        self.words: dict[str, bytes] = {}
        digits = [f"{i},".encode() for i in range(size)]
        width = max(map(len, digits))
        self.digits = np.frombuffer(b"".join(d.ljust(width) for d in digits), np.uint8).reshape(size, width)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair of symbols merges to, or -1."""
        keys = left.astype(np.int64) * (self.other + 1) + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), max(len(self.pair_keys) - 1, 0))
        if not len(self.pair_keys):
            return np.full(len(keys), -1, np.int32)
        return np.where(self.pair_keys[at] == keys, self.pair_to[at], -1).astype(np.int32)

    def merge_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as 32-bit integers in bytes."""
        text = "".join(words)
        symbols = self.char_ids[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        # what a symbol covers, to get back the characters that are no piece
        begin = np.arange(len(text))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        to = self.pairs(symbols, word)
        while len(symbols):
            rank = np.where(to >= 0, self.rank_of[to], NONE)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(word)))
            finished = np.repeat(least == NONE, sizes)
            if finished.any():
                done.append((word[finished], begin[finished], symbols[finished]))
                left = ~finished
                symbols, word, begin, to, rank = symbols[left], word[left], begin[left], to[left], rank[left]
                starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else starts[:0]
                sizes, least = sizes[least != NONE], least[least != NONE]
                if not len(symbols):
                    break
            due = np.flatnonzero(rank == np.repeat(least, sizes))
            at, slow = self.leftmost(due, word, to, np.repeat(sizes, sizes))
            if len(slow):  # long words that must go pair by pair leave for the queue
                for one in slow.tolist():
                    a, b = np.searchsorted(word, (one, one + 1))
                    at_ends, ids = self.in_turn(symbols[a:b].tolist())
                    done.append((np.full(len(ids), one), begin[a:b][at_ends], np.array(ids, np.int32)))
                left = ~np.isin(word, slow)
                symbols, word, begin, to = symbols[left], word[left], begin[left], to[left]
                continue
            symbols[at] = to[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            symbols, word, begin, to = symbols[keep], word[keep], begin[keep], to[keep]
            at = moved[at]
            again = np.concatenate((at, at[at > 0] - 1))
            to[again] = self.pairs_at(again, symbols, word)
        order = [np.concatenate([part[k] for part in done]) if done else np.zeros(0, np.int64) for k in range(3)]
        by_place = np.argsort(order[1], kind="stable")
        word, begin, symbols = order[0][by_place], order[1][by_place], order[2][by_place]
        return self.with_bytes(text, len(words), word, begin, symbols)

    def pairs(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        """For each symbol, what it merges to with the next one of its word, or -1."""
        to = np.full(len(symbols), -1, np.int32)
        if len(symbols) > 1:
            to[:-1] = np.where(word[:-1] == word[1:], self.merged(symbols[:-1], symbols[1:]), -1)
        return to

    def pairs_at(self, at: np.ndarray, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        after = np.minimum(at + 1, len(symbols) - 1)
        same = (after > at) & (word[at] == word[after])
        return np.where(same, self.merged(symbols[at], symbols[after]), -1)

    def leftmost(self, due: np.ndarray, word: np.ndarray, to: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs of lowest rank are merged in this round, and the long words that allow only one a round."""
        first = np.concatenate(([True], word[due[1:]] != word[due[:-1]]))
        group = np.cumsum(first) - 1
        # a run of adjoining pairs overlaps: take every other one from its left
        fresh = first | np.concatenate(([True], np.diff(due) > 1))
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(due)), 0))
        free = (np.arange(len(due)) - run_start) % 2 == 0
        # a merge that can give a pair due at once, or pairs of equal rank that are different pieces: one at a time keeps the order
        alone = np.zeros(group[-1] + 1, bool)
        alone[group[self.hasty[to[due]] | (to[due] != to[due[first]][group])]] = True
        heads = due[first]
        many = np.bincount(group) > 1
        slow = word[heads[alone & many & (size[heads] > LONG)]]
        return due[np.where(alone[group], first, free)], slow

    def in_turn(self, ids: list[int]) -> tuple[list[int], list[int]]:
        """Merge one word pair by pair, lowest rank first, then leftmost: places and ids of what remains."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue: list[tuple[int, int, int, int, int]] = []

        def offer(lefts: list[int]) -> None:
            lefts = [x for x in lefts if x >= 0 and after[x] < len(ids)]
            pairs = [self.pair_of.get((ids[x], ids[after[x]]), -1) for x in lefts]
            for x, to in zip(lefts, pairs):
                if to >= 0:
                    heappush(queue, (int(self.rank_of[to]), x, to, ids[x], ids[after[x]]))

        offer(list(range(len(ids) - 1)))
        while queue:
            _, x, to, left, right = heappop(queue)
            y = after[x]
            if ids[x] != left or y >= len(ids) or ids[y] != right:
                continue
            ids[x], ids[y] = to, -1
            after[x] = after[y]
            if after[y] < len(ids):
                before[after[y]] = x
            offer([before[x], x])
        places = [i for i, value in enumerate(ids) if value >= 0]
        return places, [ids[i] for i in places]

    def with_bytes(self, text: str, n_words: int, word: np.ndarray, begin: np.ndarray, symbols: np.ndarray) -> list[bytes]:
        """Cut the flat ids by word, with the bytes of characters that are no piece."""
        strange = np.flatnonzero(symbols == self.other)
        if len(strange):
            spelled = [self.byte_ids[list(text[b].encode())] if self.has_bytes else np.array([self.unknown], np.int32) for b in begin[strange].tolist()]
            counts = np.ones(len(symbols), np.int64)
            counts[strange] = [len(s) for s in spelled]
            symbols = np.repeat(symbols, counts)
            word = np.repeat(word, counts)
            symbols[symbols == self.other] = np.concatenate(spelled)
        ids, cuts = symbols.astype(np.int32).tobytes(), (4 * np.searchsorted(word, np.arange(n_words + 1))).tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without begin and end ids."""
        cut = [WORD.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in texts]
        words = self.words
        if len(words) > REMEMBERED:
            words.clear()
        new = list(set().union(*cut).difference(words))
        if new:
            words.update(zip(new, self.merge_words(new)))
        ids = [np.frombuffer(b"".join(map(words.__getitem__, one)), np.int32) for one in cut]
        if not self.has_bytes:  # neighbouring unknowns are one id
            ids = [one[np.concatenate(([True], (one[1:] != self.unknown) | (one[:-1] != self.unknown)))] if len(one) else one for one in ids]
        return ids

    def listed(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        found = self.digits[ids].ravel()
        return found[found != 32].tobytes()[:-1]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: blanks for marks, no dummy prefix, bytes that are no UTF-8 each as U+FFFD."""
        find = self.raw.__getitem__
        joined = b"".join(map(find, ids))
        try:
            text = joined.decode()
        except UnicodeDecodeError:
            text = self.decode_runs(ids)
        first = next((i for i in ids if self.raw[i]), self.unknown)
        return text[1:] if first != self.unknown and not self.is_byte[first] and text[:1] == " " else text

    def decode_runs(self, ids: list[int]) -> str:
        parts, run = [], bytearray()
        for i in [*ids, -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.raw[i]
                continue
            while run:
                size = next((n for n in (1, 2, 3, 4) if whole(run[:n])), 0)
                parts.append(run[:size].decode() if size else "�")
                del run[: size or 1]
            if i >= 0:
                parts.append(self.raw[i].decode())
        return "".join(parts)


def whole(some: bytearray) -> bool:
    """Is this exactly one character?"""
    try:
        return len(some.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    """One per worker and file."""
    return PieceModel(path)


def encode_documents(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids array<int>, decoded)`` for every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = piece_model(model_path)
        ids = model.encode_all(strings(batch.column("text")))
        decoded = [model.decode(one.tolist()) for one in ids]
        counts = [len(one) for one in ids]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), listing(ids, counts), pa.array(decoded, pa.string())],
                                          ["id", "n_tokens", "ids", "decoded"])

    narrow = id_and_text(df, id_col, text_col)
    return map_slices(narrow, work, f"id {type_of(df, id_col)}, n_tokens long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def listing(ids: list[np.ndarray], counts: list[int]) -> pa.Array:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(flat))


def token_digests(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` of every row, and the ids themselves if asked for."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = piece_model(model_path)
        ids = model.encode_all(strings(batch.column("text")))
        listed = [hashlib.sha256(model.listed(one)).hexdigest() for one in ids]
        decoded = [hashlib.sha256(model.decode(one.tolist()).encode()).hexdigest() for one in ids]
        counts = [len(one) for one in ids]
        more = [listing(ids, counts)] if with_ids else []
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(listed, pa.string()), pa.array(decoded, pa.string()), *more],
                                          ["id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])])

    narrow = id_and_text(df, id_col, text_col)
    schema = f"id {type_of(df, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return map_slices(narrow, work, schema).withColumnRenamed("id", id_col)
