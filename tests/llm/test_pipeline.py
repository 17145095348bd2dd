"""The corpus pipeline against a plain version of its decisions."""

import random

import pytest
from test_operators import brute_classes, check_bins

import corpus_pipeline
from lakeloom.llm import language_id, mixing, packing
from lakeloom.llm.queries import tokenizer_path


@pytest.fixture
def folder(spark, tmp_path):
    rng = random.Random(11)
    words = {"en": ["the", "and", "there", "other", "thing", "with"], "de": ["der", "und", "nicht", "schön", "einer", "mit"]}
    rows = []
    for i in range(160):
        la = rng.choice(["en", "de"])
        if rows and rng.random() < 0.3:
            rows.append((i, rows[rng.randrange(len(rows))][1], la, "s1", 0))
        else:
            rows.append((i, " ".join(rng.choice(words[la]) + str(rng.randrange(50)) for _ in range(rng.randint(1, 300))), la, rng.choice(["s0", "s1", None]), 0))
    rows += [(500, None, None, None, 0), (501, "12 34", "en", "s0", 0), (502, "", "de", "s1", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), rows


def test_stages_make_their_decisions(spark, folder):
    path, rows = folder
    text = {r[0]: r[1] for r in rows}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    first = corpus_pipeline.settle(stages[0](spark, docs, path))
    assert first.columns == list(corpus_pipeline.COLUMNS)
    assert {r["doc_id"] for r in first.collect()} == {i for i in text if i < 500}
    second = corpus_pipeline.settle(stages[1](spark, first, path))
    kept = {i for i, _, c in brute_classes([(i, t) for i, t in text.items() if i < 500]) if i == c}
    assert {r["doc_id"] for r in second.collect()} == kept
    third = corpus_pipeline.settle(stages[2](spark, second, path))
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(second).collect()}
    assert sorted(r["doc_id"] for r in third.collect()) == sorted(i for i, n in copies.items() for _ in range(n))
    last = stages[3](spark, third, path).collect()
    check_bins([(r["length"], r["sequence_id"], r["offset"]) for r in last], packing.CAPACITY)
    want = packing.pieces(third, tokenizer_path()).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"]))
    assert sorted(map(key, last)) == sorted(map(key, want))


def test_run_equals_its_stages(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, path))
    key = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(tuple, docs.select(key).collect())) == sorted(map(tuple, corpus_pipeline.run(spark, path).select(key).collect()))


def test_rows_without_numbers_of_their_own(spark, tmp_path):
    rng = random.Random(5)
    text = lambda: " ".join("the" + rng.choice("abcdef") + str(rng.randrange(90)) for _ in range(60))
    one, other, third = text(), text(), text()
    rows = [(7, one, "en", "s0", 0)] * 3 + [(7, other, "en", "s0", 0), (None, one, "en", "s1", 0), (None, third, "en", None, 0), (None, third, "en", None, 0), (9, third, "en", "s1", 0), (None, text(), None, "s1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = [f for _, f in corpus_pipeline.STAGES]
    first = corpus_pipeline.settle(stages[0](spark, docs, ""))
    assert first.count() == len(rows)
    second = corpus_pipeline.settle(stages[1](spark, first, ""))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in second.collect()) == sorted([(7, one), (7, other), (9, third), (0, rows[-1][1])])
    for table in (first, second):
        third_stage = stages[2](spark, table, "").collect()
        mixed = mixing.mix(table).collect()
        assert sum(r["copies"] for r in mixed) == len(third_stage)
        assert sum(r["taken"] for r in mixed) == sum(len(r["text"].split()) for r in third_stage)
        assert max(r["copies"] for r in mixed) <= 2
    assert stages[3](spark, second, "").count() == 4


def test_documents_in_three_languages_stay(spark):
    rng = random.Random(2)
    words = {"aa": ["kala", "muna", "tiko", "sapu"], "bb": ["strx", "grmf", "plok", "drsh"], "cc": ["wiewy", "hjeoj", "zzuvi", "qoeb"]}
    text = lambda la, n: " ".join(rng.choice(words[la]) for _ in range(n))
    rows = [(i, text(la, 30), la, "s", 0) for i, la in enumerate(["aa", "bb", "cc"] * 40)]
    mixed = " ".join([text("aa", 45), text("bb", 35), text("cc", 20)])
    rows += [(900, mixed, None, "s", 0), (901, "12 34", "aa", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = language_id.predict_held_out(docs).where("doc_id = 900").first()
    assert len(found["languages"]) == 3 and found["score"] < 0.5
    kept = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert set(kept) == {r[0] for r in rows} - {901} and kept[900] == found["lang_pred"]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
