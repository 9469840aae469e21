"""Language ID against plain Python: n-gram features, loss-weighted decoding and the
flag of ambiguous texts."""

import math

import numpy as np

from tessera.llm import langid

MASK = (1 << 32) - 1


def letters(text):
    """Lower-case code points of letters, one break (0) for whatever stands between,
    before and after them."""
    points = []
    for c in text:
        low = c.lower()
        points.append((ord(low) if len(low) == 1 else ord(c)) if c.isalpha() else 0)
    out = [0]
    for p in points + [0]:
        if p or out[-1]:
            out.append(p)
    return out


def grams(text, dimensions=langid.DIMENSIONS):
    points, counts = letters(text), [0] * dimensions
    if not any(points):
        return None
    bits = 32 - (dimensions.bit_length() - 1)
    for n in range(1, langid.LONGEST_GRAM + 1):
        for i in range(len(points) - n + 1):
            h = 0
            for k in range(n):
                h = ((h ^ points[i + k]) * int(langid._FACTORS[k])) & MASK
            h ^= h >> 15
            h = ((h + n) * 0x27D4EB2F) & MASK
            counts[h >> bits] += 1
    return counts


def decode(model, counts):
    """Language, probability and runner-up by the weighted loss of each codeword."""
    whole = max(1, sum(counts))
    x = [math.sqrt(c / whole) for c in counts]
    margins = [sum(v * float(w) for v, w in zip(x, model.weights[:, b])) + float(model.bias[b]) for b in range(model.code.shape[1])]
    loss = [sum(float(model.trust[b]) * math.log1p(math.exp(-int(word[b]) * margins[b])) for b in range(len(margins))) for word in model.code]
    fit = [math.exp(min(loss) - v) for v in loss]
    chance = [f / sum(fit) for f in fit]
    order = sorted(range(len(chance)), key=lambda k: (-chance[k], k))
    return order, chance


def test_features_like_plain_python():
    texts = ["", "Hello, World!", "été ÀÉ ß İ ǅ", "a", " .,; ", "one  two\n\tthree 4 five", "漢字かな", "x" * 50, "\0a\0", "Ünï-cödé's"]
    for t in texts:
        got = langid.gram_counts(t.encode())
        want = grams(t)
        assert (got is None) == (want is None) and (want is None or got.tolist() == want)


def test_features_of_long_texts_do_not_depend_on_parts(monkeypatch):
    text = "some words, and more of them; " * 40
    whole = langid.gram_counts(text.encode())
    for part in (3, 7, 64, 1001):
        monkeypatch.setattr(langid, "PART", part)
        assert langid.gram_counts(text.encode()).tolist() == whole.tolist() == grams(text)


def test_predictions_of_200_documents_like_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs)
    some = docs.orderBy("doc_id").limit(200)
    got = {r.doc_id: r.p for r in some.select("doc_id", langid.predict(some, model, some["text"]).alias("p")).collect()}
    unsure = 0
    for r in some.collect():
        p, counts = got[r.doc_id], grams(r.text[:3000]) if r.text else None
        if r.text and len(r.text) > 3000:  # a long text's counts come from the operator, tested above
            counts = langid.gram_counts(r.text.encode()).tolist()
        if counts is None:
            assert (p.lang_pred, p.score) == (langid.UNKNOWN, 0.0)
            continue
        order, chance = decode(model, counts)
        assert abs(p.score - chance[order[0]]) < 1e-3
        if chance[order[0]] - chance[order[1]] > 1e-3:
            assert p.lang_pred == model.languages[order[0]]
        gap = chance[order[0]] - chance[order[1]]
        if abs(gap - langid.AMBIGUOUS) > 1e-3:
            assert p.ambiguous == (gap < langid.AMBIGUOUS)
        unsure += p.ambiguous
    assert unsure < 20


def test_codewords_differ_and_use_every_bit():
    for k in (2, 3, 4, 6, 12):
        code = langid.codewords(k)
        assert len({tuple(r) for r in code.tolist()}) == k
        assert (np.abs(code.astype(int).sum(axis=0)) < k).all()
