from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from lift.llm.pieces import PieceModel, encode_documents, token_digests
from tests.llm.helpers import no_documents, odd_documents, odd_rows, pairs

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def same(model, text):
    ids = model.encode_all([text])[0].tolist()
    assert ids == LIBRARY.encode(text)
    assert model.decode(ids) == LIBRARY.decode(ids)
    assert model.listed(model.encode_all([text])[0]).decode() == ",".join(map(str, ids))


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aaabeth ing  ▁.\n\t1"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    same(MODEL, text)


MODEL = PieceModel(PATH)


@pytest.mark.parametrize("text", ["a" * 20000, "=" * 3000, " " * 20000, "ab" * 5000, " a" * 3000, "the" * 4000, "漢字" * 500, "\U0001f600" * 300, "▁" * 500, "<s></s><unk>"])
def test_long_runs(model, text):
    same(model, text)


def test_many_words_at_once(model):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdeinorst  ") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    assert [x.tolist() for x in model.encode_all(texts)] == LIBRARY.encode(texts)


def test_decoding_of_any_ids(model):
    rng = random.Random(4)
    for _ in range(1500):
        ids = [rng.choice([rng.randrange(300), rng.randrange(32000), 28705, 259]) for _ in range(rng.randint(0, 9))]
        assert model.decode(ids) == LIBRARY.decode(ids), ids


def test_rows(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = []
    for row in odd_rows():
        ids = LIBRARY.encode(row[1] or "")
        want.append((row[0], len(ids), sha(",".join(map(str, ids))), sha(LIBRARY.decode(ids))))
    docs = odd_documents(spark)
    assert pairs(token_digests(docs, PATH), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)
    whole = [(row["doc_id"], list(row["ids"]), row["decoded"]) for row in encode_documents(docs, PATH).collect()]
    assert sorted(whole, key=str) == sorted([(row[0], LIBRARY.encode(row[1] or ""), row[1] or "") for row in odd_rows()], key=str)
    assert token_digests(no_documents(spark), PATH).collect() == []
