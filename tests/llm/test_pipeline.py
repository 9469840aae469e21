"""The pipeline's stages: columns, what goes and what stays."""

import public_tokenizers
import tokenizers

import corpus_pipeline
from tessera.llm import langid, quality, secrets
from tessera.sources.tables import read_table

SMALL = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = read_table(spark, SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SMALL).persist()
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before)
        seen[name] = (before, after)

    before, after = seen["language_id"]
    assert len(after) > 0.97 * len(before)
    assert all(langid.gram_counts(before[i].text.encode()) is not None for i in after)

    before, after = seen["quality_rules"]
    for i, r in before.items():
        words = r.text.encode().split()
        if len(words) < 20 or quality.repeated_words(words) > 0.3 * len(words):
            assert i not in after
    good = {r.doc_id for r in read_table(spark, SMALL, "labels").where("quality = 1").collect()} & set(before)
    assert sum(i not in after for i in good) <= 0.08 * len(good)

    before, after = seen["simhash_near_dedup"]
    first = {}
    for i in sorted(before):
        first.setdefault(before[i].text, i)
    assert all(first[r.text] == i for i, r in after.items())
    assert len({r.text for r in after.values()}) == len(after)

    before, after = seen["secret_scans"]
    assert set(before) == set(after)
    for i, r in after.items():
        old = before[i]
        assert r.n_chars == len(r.text)
        spans = secrets.find_secrets(old.text.encode())[1]
        assert r.text == (secrets.masked(old.text.encode(), spans, "[secret]") if spans else old.text)
        assert (r.lang, r.source) == (old.lang, old.source)

    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: len(library.encode(r.text, add_special_tokens=False)) + 1 for r in docs.collect()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == tokens
    ran = corpus_pipeline.run(spark, SMALL)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in ran.collect()} == {(r.doc_id, r.piece, r.ids_crc32) for r in packed}


def test_stages_on_odd_documents(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "x", None, None, 1), (3, "word " * 30, "en", "s", 150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, some, SMALL).collect()
