"""Personal data: patterns, and the terms that give away what the patterns found.

The patterns find e-mail addresses, IP addresses, card and phone numbers. These
are the protected entities. A term close to an entity gives it away if it occurs
with that entity and hardly anywhere else. Its disclosure is the share of the
entity's information that the term carries, estimated over the whole corpus:

    pmi(term, entity) / information(entity),
    pmi = log2(p(term, entity) / (p(term) p(entity))),  information = -log2 p(entity)

with p taken over distinct passages, so that copies of a passage count once. This holds
for the words of the whole corpus too: a word close to an entity or inside it counts once
for each distinct passage of that entity (of the first one, if it is close to several);
what lies apart from entities is cut into passages of about the same size, at
places that the words themselves decide, and the words of equal ones count once. Terms
at or above ``remove`` are removed by the sanitiser, those at or above
``generalise`` give way to their kind. A term needs ``support`` distinct
passages with the entity, as a term seen once always seems to tell everything.

Defined results: a null or empty text has no spans; repeated rows get one
result row each; ids may be null or repeat; an empty table gives an empty
result; other columns are not looked at. Places count code points.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lift.llm.batches import id_and_text, map_slices, slices, strings, type_of
from lift.sources.shared import materialise

#: Patterns that the results are defined by (fixed values).
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
WORD = re.compile(r"[^\W\d_]{3,}")
MASKS = {"email": "[email]", "ip": "[ip]", "card": "[card]", "phone": "[phone]", "term": "[term]"}
#: Words on each side of an entity that count as its passage.
REACH = 8
#: Remainders by which the words that are counted are told from others.
MARKS = 1 << 20

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """Only text around an @ can match: the run before it, up to the last match, and the domain behind it."""
    begin, at = 0, text.find("@")
    while at >= 0:
        left = at
        while left > begin and LOCAL.fullmatch(text[left - 1]):
            left -= 1
        found = DOMAIN.match(text, at) if left < at else None
        if found:
            begin = found.end()
            yield "email", left, begin
        else:
            begin = at + 1  # no local part reaches over an @
        at = text.find("@", max(begin, at + 1))


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind and then start; matches that fail their test are dropped."""
    spans = list(emails(text))
    parts = lambda m: [part.lstrip("0") for part in m.group().split(".")]
    spans += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(part) <= 3 and int(part or "0") <= 255 for part in parts(m))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    spans += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return spans


def hash_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode()) - (1 << 63)


def merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Where runs of overlapping spans start and end."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def outside(starts: list[int], ends: list[int], m: re.Match) -> bool:
    """Does the match lie outside of all the runs?"""
    k = bisect_right(ends, m.start())
    return k == len(ends) or starts[k] >= m.end()


def near(text: str, spans: list[Span], reach: int) -> Iterator[tuple[int, int, int, int, list[re.Match]]]:
    """``(entity, passage, start, end, words)`` for every span: the words are those close to it and outside all spans."""
    starts, ends = merged(spans)
    for _, a, b in spans:
        behind = []
        for m in WORD.finditer(text, b, min(len(text), b + 32 * reach)):
            behind.append(m)
            if len(behind) == reach:
                break
        before = list(WORD.finditer(text, max(0, a - 32 * reach), a))[-reach:]
        close = [m for m in before + behind if outside(starts, ends, m)]
        yield hash_of(text[a:b]), hash_of(" ".join(m.group().lower() for m in close)), a, b, close


def mentions(text: str, spans: list[Span], reach: int) -> list[tuple[int, int, int, int, int]]:
    """``(term, entity, passage, start, end)`` for every word close to an entity and outside all of them."""
    return [(hash_of(m.group().lower()), entity, passage, m.start(), m.end()) for entity, passage, _, _, close in near(text, spans, reach) for m in close]


class Codes(dict):
    """A number for every word."""

    def __missing__(self, word: str) -> int:
        self[word] = code = xxhash.xxh64_intdigest(word.encode())
        return code


def cut(words: list[str], begin: int, end: int, reach: int, codes: Codes) -> Iterator[tuple[int, int]]:
    """Passages of ``reach`` to five times as many words, cut before every eighth pair of words or so, by the pair's hash; a run of fewer words is one."""
    reach = max(1, reach)
    if end - begin < 2 * reach:
        yield begin, end
        return
    code = np.fromiter(map(codes.__getitem__, words[begin:end]), np.uint64, end - begin)
    mixed = code[1:] * np.uint64(0x9E3779B97F4A7C15) + code[:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    marks = (np.flatnonzero(mixed >> np.uint64(61) == 0) + begin + 1).tolist()
    while begin < end:
        k = bisect_left(marks, begin + reach)
        to = min(begin + 4 * reach, end, *marks[k : k + 1])
        to = end if end - to < reach else to
        yield begin, to
        begin = to


def passages(text: str, reach: int, codes: Codes) -> Iterator[tuple[int, str]]:
    """``(passage, words)``: every word of the text in one passage; equal passages are copies, with equal words."""
    spans = base_spans(text)
    if not spans:
        words = " ".join(WORD.findall(text)).lower().split()
        runs = [(0, len(words))]
    else:
        places: dict[Span, None] = {}
        for entity, passage, a, b, close in near(text, spans, reach):
            for m in [*WORD.finditer(text, a, b), *close]:
                place = "", m.start(), m.end()
                if place not in places:
                    places[place] = None
                    word = m.group().lower()
                    yield hash_of(f"{entity} {passage} {word}"), word
        starts, ends = merged([*spans, *places])
        found = list(WORD.finditer(text))
        words = [m.group().lower() for m in found]
        taken = [-1, *[k for k, m in enumerate(found) if not outside(starts, ends, m)], len(found)]
        runs = [(a + 1, b) for a, b in zip(taken, taken[1:])]
    for begin, end in runs:
        for a, b in cut(words, begin, end, reach, codes) if begin < end else ():
            own = " ".join(words[a:b])
            # so few words are equal by chance: those around them must be, too
            around = [" ".join(words[max(0, a - reach) : a]), own, " ".join(words[b : b + reach])] if b - a < reach else [own]
            yield hash_of("\n".join(around)), own


def find_base(df: DataFrame, id_col: str, text_col: str, reach: int) -> DataFrame:
    """``(id, digest, spans, mentions)`` for every row."""
    span = "struct<kind:string,start:int,end:int>"
    mention = "struct<term:long,entity:long,passage:long,start:int,end:int>"
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    mention_type = pa.list_(pa.struct([("term", pa.int64()), ("entity", pa.int64()), ("passage", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = strings(batch.column("text"))
        spans = [base_spans(text) for text in texts]
        near = [mentions(text, one, reach) if one else [] for text, one in zip(texts, spans)]
        names = ("kind", "start", "end"), ("term", "entity", "passage", "start", "end")
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(hash_of, texts), pa.int64()), pa.array([[dict(zip(names[0], x)) for x in one] for one in spans], span_type),
             pa.array([[dict(zip(names[1], x)) for x in one] for one in near], mention_type)], ["id", "digest", "spans", "mentions"])

    narrow = id_and_text(df, id_col, text_col)
    return map_slices(narrow, work, f"id {type_of(df, id_col)}, digest long, spans array<{span}>, mentions array<{mention}>")


def marks(pairs: DataFrame) -> bytes:
    """A byte for each remainder of the terms' hashes, set if some term has it; of bounded size, whatever the vocabulary."""
    held = np.zeros(MARKS, np.uint8)
    held[[row["mark"] for row in pairs.select(F.pmod("term", F.lit(MARKS)).cast("int").alias("mark")).distinct().collect()]] = 1
    return held.tobytes()


def term_counts(df: DataFrame, pairs: DataFrame, id_col: str, text_col: str, reach: int) -> DataFrame:
    """``(term, times)``: how often each word of ``pairs`` occurs in the distinct passages of the corpus; a null term has the count of all words.

    Other words are left out of what is moved, except for a few whose hashes agree with one of theirs.
    """
    wanted = df.sparkSession.sparkContext.broadcast(marks(pairs))

    def cut_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, held, known, asked = Codes(), {}, {}, wanted.value
        for text in strings(batch.column("text")):
            for passage, words in passages(text, reach, codes):
                if passage not in held:
                    split = words.split()
                    for word in split:
                        if word not in known:
                            known[word] = asked[hash_of(word) % MARKS]
                    held[passage] = len(split), " ".join([word for word in split if known[word]])
        sizes, kept = zip(*held.values()) if held else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(sizes, pa.int32()), pa.array(kept, pa.string())], ["passage", "size", "words"])

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = Counter(" ".join(strings(batch.column("words"))).split())
        terms, times = [None, *map(hash_of, counts)], [pa.compute.sum(batch.column("size")).as_py() or 0, *counts.values()]
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), pa.array(times, pa.int64())], ["term", "times"])

    cuts = map_slices(id_and_text(df, id_col, text_col), cut_up, "passage long, size int, words string")
    distinct = cuts.groupBy("passage").agg(F.first("size").alias("size"), F.first("words").alias("words"))
    return map_slices(distinct.select("size", "words"), count, "term long, times long", "words").groupBy("term").agg(F.sum("times").alias("times"))


def close_terms(found: DataFrame, support: int) -> tuple[DataFrame, DataFrame]:
    """``(term, entity, n_pair)`` of the pairs with enough distinct passages, and ``(entity, n_entity)``."""
    mention = found.select(F.explode("mentions").alias("m")).select("m.term", "m.entity", "m.passage").distinct()
    passages = mention.select("entity", "passage").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    return mention.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("n_pair")).where(F.col("n_pair") >= support), passages


def disclosing(pairs: DataFrame, passages: DataFrame, words: DataFrame, reach: int, generalise: float) -> DataFrame:
    """``(term, entity, disclosure)`` of the pairs whose term gives the entity away."""
    total = words.where(F.col("term").isNull()).agg(F.sum("times").alias("words"))  # one row
    # a passage is 2 * reach words: the distinct ones of the corpus hold that many passages, and a word's count bounds those with it
    p = lambda n: F.col(n) * 2 * reach / F.col("words")
    scored = pairs.join(passages, "entity").join(words, "term").crossJoin(F.broadcast(total))
    scored = scored.withColumn("n_term", F.greatest("times", "n_pair"))
    information = -F.log2(p("n_entity"))
    pmi = F.log2(p("n_pair") / (p("n_term") * p("n_entity")))
    return scored.select("term", "entity", F.when(information > 0, pmi / information).otherwise(F.lit(0.0)).alias("disclosure")).where(
        F.col("disclosure") >= generalise)


def find_all(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH, support: int = 3,
             generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """One row per row of ``df``: ``(id, digest, spans, terms)``.

    ``spans`` are those of the patterns; ``terms`` the words that give an entity
    away, with ``disclosure`` and ``action`` (``generalise`` or ``remove``).
    """
    found = materialise(find_base(df, id_col, text_col, reach), "pii-spans")
    near = found.where(F.size("mentions") > 0)
    pairs, of_entity = close_terms(near, support)
    pairs = materialise(pairs, "pii-pairs")
    # read twice, for the total and for the terms; written, so that the passages are counted once
    words = materialise(term_counts(df, pairs, id_col, text_col, reach), "pii-words")
    telling = disclosing(pairs, of_entity, words, reach, generalise)
    places = near.select("id", "digest", F.explode("mentions").alias("m")).select("id", "digest", "m.term", "m.entity", "m.start", "m.end")
    hits = places.join(telling, ["term", "entity"]).groupBy("id", "digest", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    action = F.when(F.col("disclosure") >= remove, "remove").otherwise("generalise")
    terms = hits.groupBy(F.col("id").alias("t_id"), F.col("digest").alias("t_digest")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end", "disclosure", action.alias("action")))).alias("terms"))
    none = F.array().cast(terms.schema["terms"].dataType)
    joined = near.join(terms, F.col("id").eqNullSafe(F.col("t_id")) & (F.col("digest") == F.col("t_digest")), "left")
    return joined.select("id", "digest", "spans", F.coalesce("terms", none).alias("terms")).unionByName(
        found.where(F.size("mentions") == 0).select("id", "digest", "spans", none.alias("terms")))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))


def pii_digests(df: DataFrame) -> DataFrame:
    """The digest columns of every document."""
    found = find_all(df)
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    terms = F.transform("terms", lambda x: F.struct(F.lit("term").alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    return found.select(F.col("id").alias("doc_id"), *[count(kind) for kind in KINDS], F.sha2(joined(F.col("spans")), 256).alias("base_sha256"),
                        joined(F.concat("spans", terms)).alias("spans"), F.size("terms").cast("long").alias("n_terms"))


def sanitise(text: str, spans: list[tuple[str, int, int]], terms: list[tuple[int, int, str]]) -> str:
    """The text with entities and terms replaced; where spans overlap, the first one's mask stands for all."""
    parts, at = [], 0
    marks = [(a, b, MASKS[kind]) for kind, a, b in spans] + [(a, b, "" if action == "remove" else MASKS["term"]) for a, b, action in terms]
    for a, b, mask in sorted(marks):
        if a >= at:
            parts += [text[at:a], mask]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def sanitise_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: float) -> DataFrame:
    """``(id, text)`` of every row of ``df`` with personal data replaced."""
    found = find_all(df, id_col, text_col, **settings).dropDuplicates(["id", "digest"])
    kind = type_of(df, id_col)

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = strings(batch.column("text"))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column("text"), pa.array(map(hash_of, texts), pa.int64())], ["key", "text", "d"])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(strings(batch.column("text")), batch.column("spans").to_pylist(), batch.column("terms").to_pylist())
        clean = [sanitise(text, [(x["kind"], x["start"], x["end"]) for x in spans], [(x["start"], x["end"], x["action"]) for x in terms])
                 for text, spans, terms in rows]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(clean, pa.string())], ["id", "text"])

    texts = map_slices(id_and_text(df, id_col, text_col), digest, f"key {kind}, text string, d long")
    rows = texts.join(found, F.col("key").eqNullSafe(F.col("id")) & (F.col("d") == F.col("digest"))).select("key", "text", "spans", "terms")
    return map_slices(rows, work, f"id {kind}, text string").withColumnRenamed("id", id_col)
