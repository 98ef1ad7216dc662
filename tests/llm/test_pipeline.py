import numpy as np
from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_dart_minhash import brute_classes
from tests.llm.test_unit_dedup import brute_force, cut

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "substring_dedup", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, FOLDER)
    assert clean.columns == docs.columns
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean.collect()}
    assert all(labels.get(i) != 0 for i in {r.doc_id for r in docs.collect()} - kept)
    clean = spark.createDataFrame(clean.collect(), docs.schema)

    single = stages["near_duplicates"](spark, clean, FOLDER)
    assert single.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in clean.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(brute_classes(rows)))

    single = spark.createDataFrame(single.collect(), docs.schema)
    short = stages["substring_dedup"](spark, single, FOLDER)
    assert short.columns == docs.columns
    texts = {r.doc_id: r.text for r in single.collect()}
    spans = brute_force(list(texts.items()))
    for r in short.collect():
        assert r.text == cut(texts[r.doc_id], spans[r.doc_id, texts[r.doc_id]])
        assert r.n_chars == len(r.text)

    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    wanted = {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 2] for r in short.collect()}
    found = {}
    for r in sorted(pieces, key=lambda r: r.start):
        found.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert found == wanted


def test_one_of_each_keeps_rows_without_id(spark):
    from registrum.llm.dart_minhash import one_of_each

    text = "some text of more than five words in all"
    rows = [(4, text, "a"), (2, text, "b"), (2, text, "b"), (2, "other words under the same id here", "c"),
            (None, text, "d"), (None, "words without any id at all here", "e"), (None, "words without any id at all here", "e")]
    found = one_of_each(spark.createDataFrame(rows, "doc_id long, text string, label string")).collect()
    assert sorted(r.label for r in found) == ["b", "c", "e"]
