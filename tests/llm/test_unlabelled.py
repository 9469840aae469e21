"""Language ID of a table without labels."""

from tessera.llm import langid


def test_without_a_model_only_texts_without_a_letter_go(spark):
    rows = [(1, "plain words", None), (2, "12 !", None), (3, None, None), (4, "слова", None), (None, "ever", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r.doc_id for r in langid.keep_known(docs).collect()} == {1, 4, None}
    assert langid.keep_known(docs).columns == docs.columns
    assert langid.keep_known(docs.limit(0)).count() == 0
