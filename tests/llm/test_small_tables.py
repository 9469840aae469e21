"""The packing program: valid plans, never above best fit, near its lower bound."""

import numpy as np
import pytest

from tessera.llm import packing


def histogram(lengths, capacity):
    values, counts = np.unique(np.clip(lengths.astype(int), 1, capacity), return_counts=True)
    return dict(zip(values.tolist(), counts.tolist()))


def cases():
    rng = np.random.default_rng(4)
    for n in (40, 500, 5_000, 200_000):
        yield f"uniform {n}", rng.integers(1, 2049, n), {40: 1.12, 500: 1.05, 5_000: 1.01}.get(n, 1.005)
    yield "log-normal", rng.lognormal(5.5, 1, 50_000), 1.005
    yield "400 to 900", rng.integers(400, 900, 50_000), 1.005
    yield "three fit", rng.integers(600, 661, 20_000), 1.1
    yield "thirds", rng.choice([350, 682, 683, 684, 1000, 1024, 1025], 5_000), 1.05
    yield "one length", np.full(1_000, 700), 1.6
    yield "full and empty", np.array([2048] * 9 + [1] * 5), 2.0


@pytest.mark.parametrize("name, lengths, near", list(cases()))
def test_plans_hold_all_pieces_and_few_sequences(name, lengths, near):
    given = histogram(lengths, 2048)
    plan = packing.plan_packing(given, 2048)
    got = {}
    for config, n in plan:
        assert n > 0 and 0 < sum(config) <= 2048
        for length in config:
            got[length] = got.get(length, 0) + n
    assert got == given
    used = packing.sequences(plan)
    assert used <= packing.sequences(packing.best_fit(given, 2048))
    # no packing has fewer sequences than tokens need, nor two pieces over a half in one
    least = max(sum(n * c for n, c in given.items()) / 2048, sum(c for n, c in given.items() if n > 1024))
    assert used <= near * least + 1


def test_the_program_takes_the_place_of_best_fit_where_lengths_must_be_combined():
    given = histogram(np.random.default_rng(1).integers(400, 900, 20_000), 2048)
    best_fit = packing.sequences(packing.best_fit(given, 2048))
    assert packing.sequences(packing.plan_packing(given, 2048)) < 0.96 * best_fit


@pytest.mark.parametrize("lengths", [np.random.default_rng(4).integers(1, 2049, 20_000), np.full(1_000, 1024), np.array([700, 900])])
def test_the_program_runs_for_every_histogram(lengths, monkeypatch):
    """Also where best fit is near the least number of sequences."""
    given, solved = histogram(lengths, 2048), []
    real = packing.solve_fractional
    monkeypatch.setattr(packing, "solve_fractional", lambda *a, **k: solved.append(a) or real(*a, **k))
    plan = packing.plan_packing(given, 2048)
    assert solved and packing.sequences(plan) <= packing.sequences(packing.best_fit(given, 2048))


def test_bounds_are_bounds():
    """Of a program whose best packing is known: pairs that fill a sequence."""
    lengths, demand = np.array([700, 800, 1200, 1300]), np.array([90.0, 60.0, 60.0, 90.0])
    use, covered, bound = packing.solve_fractional(lengths, demand, 2000)
    assert 149 < bound <= 150.0001 and covered.min() > 0
    assert packing.plan_packing({}, 2000) == []


def test_repeated_rows_are_no_evidence(spark):
    """Verdicts do not change when rows are repeated: one good labelled document
    that stands 2,000 times is one document."""
    from tessera.llm import quality
    rng = np.random.default_rng(3)
    words = ["plain", "words", "of", "some", "length", "that", "are", "quite", "good"]
    texts = [" ".join(rng.choice(words, 40)) for _ in range(60)]
    texts += [" ".join([*rng.choice(words, 30), *["#$%&#$%&"] * 6]) for _ in range(60)]
    docs = [(i, "en", t) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(0, 120, 2)], "doc_id bigint, quality int")

    def kept(rows):
        df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
        return {(r.doc_id, r.kept) for r in quality.quality_rules(df, labels).collect()}

    once = kept(docs)
    assert kept(docs + [docs[0]] * 2000 + docs[60:70] * 30) == once
    # one good document alone never proves a cutoff
    alone = spark.createDataFrame([(0, 1), (60, 0)], "doc_id bigint, quality int")
    df = spark.createDataFrame([docs[0]] * 2000 + docs, "doc_id bigint, lang string, text string")
    base = {r.doc_id for r in quality.quality_rules(df, alone).where("NOT base_failed AND NOT kept").collect()}
    assert not base
    # an id with different texts is left out, not counted
    mixed = [(0, "en", texts[0]), (0, "en", texts[70])] + docs[1:]
    gone = labels.where("doc_id > 0")
    want = {(r.doc_id, r.kept) for r in quality.quality_rules(
        spark.createDataFrame(mixed, "doc_id bigint, lang string, text string"), gone).collect()}
    assert kept(mixed) == want


def test_a_repeated_text_is_not_sampled_in_all_its_copies(spark, monkeypatch):
    """The sample behind the table of frequent pre-tokens is bounded."""
    import pyspark.sql.functions as F
    import tokenizers
    import public_tokenizers
    from tessera.llm import token_counts
    text = "the same words again " * 3
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, text).otherwise(
        F.concat(F.lit("other "), F.col("id").cast("string"))).alias("text"))
    low, _ = token_counts.frequent_pretokens(docs, sample=40)
    assert 0 < low.size < 200
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, path, sample=40).collect()}
    want = {r.doc_id: len(library.encode(r.text, add_special_tokens=False)) for r in docs.collect()}
    assert got == want


def test_a_text_that_could_not_be_scanned_to_its_end_goes(spark, monkeypatch):
    """An encoded run inside compressed data that is longer than the hard stop."""
    import base64
    import gzip

    from pyspark.sql import functions as F

    from tessera.llm import secrets
    monkeypatch.setattr(secrets, "WINDOW", 1 << 16)
    monkeypatch.setattr(secrets, "OVERLAP", 1 << 10)
    monkeypatch.setattr(secrets, "LONGEST", 1 << 17)
    body = base64.b64encode(gzip.compress(b"A" * (1 << 20)))
    got = secrets._masked("[secret]")([b"clean", b"data " + body, None, b""])
    assert got == {"text": ["clean", "data " + body.decode(), None, ""], "cut": [False, True, False, False]}
    # the stage leaves marked texts out
    monkeypatch.setattr(secrets, "masked_text", lambda c: F.struct(F.upper(c).alias("text"), F.coalesce(c == "bad", F.lit(False)).alias("cut")))
    docs = spark.createDataFrame([(1, "clean", 9), (2, "bad", 9), (3, None, None), (4, "", 9)], "doc_id int, text string, n_chars int")
    left = secrets.mask_secrets(docs)
    assert left.columns == docs.columns
    assert {tuple(r) for r in left.collect()} == {(1, "CLEAN", 5), (3, None, None), (4, "", 0)}
