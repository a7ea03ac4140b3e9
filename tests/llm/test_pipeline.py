"""Each stage against a plain version of it, on its own input."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from lift.llm.decontaminate import allowed, words_of
from tests.llm.helpers import no_documents, odd_documents
from tests.llm.test_search import plain_edits
from tests.llm.test_simhash import plain_copies

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(12)
    words = [f"{a}{b}{c}" for a in "klmbd" for b in "aeiou" for c in "nrst"]
    items = [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(4)]
    rows, labels = [], []
    for i in range(900):
        text = [rng.choice(words) for _ in range(rng.randint(20, 90))]
        toxic = rng.random() < 0.15
        if toxic:
            text.insert(5, "grumble")
        if i % 50 == 7:
            text[9:9] = items[i % 4][1].split()
        if i % 40 == 3:
            text += ["token", "=", f"{rng.getrandbits(160):040x}"]
        if i % 9 == 4 and not toxic:
            text = rows[rng.randrange(len(rows))][1].split()
            toxic = "grumble" in text
        rows.append((i, " ".join(text), "en", f"s{i % 5}", len(" ".join(text))))
        labels.append((i, 0, int(toxic)))
    home = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{home}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{home}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{home}/benchmark.parquet")
    return home


def test_stages_equal_plain_version(spark, folder):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = [i for i, r in rows.items() if "grumble" not in r["text"]]
    kept = [i for i, _, c in plain_copies([(i, rows[i]["text"]) for i in kept]) if i == c]
    near = lambda text: any(plain_edits(words_of(item), words_of(text)) <= allowed(len(words_of(item)), 0.8) for item in items)
    kept = [i for i in kept if not near(rows[i]["text"])]
    want = {i: library.encode(re.sub("token = [0-9a-f]{40}", "[secret]", rows[i]["text"])) for i in kept}
    found = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.run(spark, folder).collect()}
    assert found == want and 500 < len(found) < 800


def test_stages_take_odd_and_empty_documents(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "sentencepiece"]
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            if name != "sentencepiece":
                assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
