"""Language ID, quality rules, near-dedup, fingerprints, sharding and URL
filters against brute force, with nulls, empties, ties, repeated rows, clashing
columns and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from tessera.llm import fingerprints, langid, quality, sharding, simhash, url_filter
from tessera.sources.tables import TABLES, read_table, table_path
from tools.oracle_check import rows_of

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "the quick brown fox " * 20_000


def documents(spark, rows, extra="keys string, cells int, h int, fp string, s int"):
    """Rows of (doc_id, text) with columns whose names operators use inside."""
    n = len(extra.split(","))
    values = [(i, t, *["1" if "string" in c else 1 for c in extra.split(",")]) for i, t in rows]
    assert n == len(values[0]) - 2 if values else True
    return spark.createDataFrame(values, f"doc_id bigint, text string, {extra}")


# --- SQL oracles -------------------------------------------------------------

@pytest.mark.parametrize("name", ["op3_url_filters", "op7_sharding", "op8_quality_rules"])
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    got = entry.queries()[name](spark, SMALL)
    expected = con.execute(entry.oracle_sql()[name])
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == \
        rows_of([d[0] for d in expected.description], expected.fetchall())


# --- language ID -------------------------------------------------------------

def test_languages_of_held_out_documents(spark):
    got = entry.queries()["op1_language_id"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r for r in read_table(spark, "/root/testdata/sf0.01", "documents").collect()}
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(spark):
    rows = [(1, "der und die " * 9, "de"), (3, "the and of " * 9, "en"), (5, None, "en"), (6, "123 !!", "de"),
            (7, "", None), (None, "der die", None), (8, LONG, None), (1, "der und die " * 9, "de")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, score string")
    got = {r.doc_id: r for r in langid.language_ids(df).collect()}
    assert langid.language_ids(df).count() == len(rows)
    assert [got[i].lang_pred for i in (5, 6, 7)] == ["und"] * 3
    assert got[None].lang_pred == "de" and got[8].lang_pred == "en" and not got[None].held_out
    assert {r.doc_id for r in langid.keep_known(df).collect()} == {1, 3, None, 8}
    assert langid.keep_known(df).columns == df.columns
    none = df.where("lang is null")
    assert {r.lang_pred for r in langid.language_ids(none).collect()} == {"und"}
    assert langid.language_ids(df.limit(0)).count() == 0


def test_grams_in_parts_equal_the_whole(monkeypatch):
    text = "".join(random.Random(5).choice("aB é1,世 ") for _ in range(500)).encode()
    whole = langid.gram_counts(text)
    for part in (7, 50):
        monkeypatch.setattr(langid, "PART", part)
        assert np.array_equal(langid.gram_counts(text), whole)
    assert langid.gram_counts(b"12 !") is None


@pytest.mark.parametrize("k", [1, 2, 3, 6, 7, 30])
def test_codewords_differ(k):
    code = langid.codewords(k).astype(int)
    assert code.shape[0] == k
    if k > 1:
        gaps = [np.count_nonzero(code[a] != code[b]) for a, b in itertools.combinations(range(k), 2)]
        assert min(gaps) >= (1 if k == 2 else 2 if k == 3 else 4)


# --- quality -----------------------------------------------------------------

def _stats(text):
    words, lines, seen, dup = WORD.findall(text), text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    cover = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_quality_statistics(spark):
    rng = random.Random(2)
    texts = ["", " \n ", "a", "é b\x1cc d", "x\ny\nx\n\nx ", "a b " * 12, "#| <a> " * 25] + [
        "".join(rng.choice(["a ", "b ", "c\n", "#", "É", "  "]) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, None), (0, "")]
    df = spark.createDataFrame([(*r, None, "x") for r in rows], "doc_id bigint, text string, lang string, kept string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    for r in quality.quality_rules(df, labels).collect():
        text = texts[r.doc_id] if r.doc_id is not None else ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _stats(text)
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)  # without labels the base rules decide
    assert quality.quality_rules(df.limit(0), labels).count() == 0


def test_repeated_words_when_sums_collide(monkeypatch):
    monkeypatch.setattr(quality, "_MIX", np.ones(8, np.uint64))  # windows of the same words in any order collide
    rng = random.Random(4)
    for _ in range(300):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 40))]
        assert quality.repeated_words(words) == _stats(" ".join(w.decode() for w in words))[4]


@pytest.mark.parametrize("n,p", [(1, 0.3), (20, 0.01), (300, 0.2), (900, 0.008)])
def test_binomial_tail_is_exact(n, p):
    for k in range(0, n + 1, max(1, n // 17)):
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_cdf(k, n, p) == pytest.approx(exact, abs=1e-10)


def _prose(rng, symbols=""):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randint(0, 999)) + symbols for _ in range(40))


def test_cutoffs_hold_per_stratum(spark):
    """Chosen cutoffs equal a direct computation; small strata get none."""
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(2400):
        bad = k % 6 == 0
        lang = "en" if k % 4 else ("xx" if k % 40 == 0 else "de")
        rows.append((k, _prose(rng, "#" if bad or k % 97 == 1 else ""), lang))
        labels.append((k, 0 if bad else 1))
    labels += [(5, 1), (None, 1), (7, None), (9, 0)]  # 9 now has both labels
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    alpha = 0.3
    stats = df.select("doc_id", "lang", quality.text_stats(df.text).alias("s"))
    got = {r.stratum: r for r in quality.choose_cutoffs(stats, marks, "s", alpha=alpha).collect()}
    share = alpha / len(quality.CUTOFFS)
    good = {k: v for k, v in labels if k is not None and v is not None and k != 9}
    strata = {lang for k, _, lang in rows if good.get(k) == 1}
    level = quality.DELTA / (len(strata) * len(quality.CUTOFFS))
    for lang in strata:
        value = {k: sum(c == "#" for c in t) / len(t.split()) for k, t, x in rows if x == lang and k in good}
        best = None
        for c in quality.CUTOFFS["symbols"]:
            n = sum(good[k] for k in value)
            k_good = sum(v > c for k, v in value.items() if good[k])
            k_bad = sum(v > c for k, v in value.items() if not good[k])
            if quality.binomial_cdf(k_good, n, share) > level:
                break
            gain = k_bad / max(1, len(value) - n) - k_good / n
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, c)
        assert (got[lang].symbols if lang in got else None) == (best and best[1]), lang
    assert got["en"].symbols is not None and "xx" not in got
    kept = {r.doc_id for r in quality.keep_good(df, marks, alpha=alpha).collect()}
    lost = [k for k, _, lang in rows if lang == "en" and good.get(k) == 1 and k not in kept]
    assert len(lost) <= alpha * sum(1 for k, _, lang in rows if lang == "en" and good.get(k) == 1)
    assert not [k for k, _, lang in rows if lang == "en" and k % 6 == 0 and k in kept]


# --- SimHash -----------------------------------------------------------------

def _fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(codes, limit):
    up = list(range(len(codes)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k
    for a, b in itertools.combinations(range(len(codes)), 2):
        if (codes[a] ^ codes[b]).bit_count() <= limit:
            up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(codes))]


def _codes(rng, n):
    """Clusters, chains of one-bit steps, and strays."""
    out = []
    for _ in range(n):
        c = rng.getrandbits(64) if rng.random() < 0.4 or not out else rng.choice(out)
        for _ in range(rng.randint(0, 3)):
            c ^= 1 << rng.randrange(64)
        out.append(c)
    return sorted(set(out))


@pytest.mark.parametrize("limit", [0, 2, 5])
def test_index_finds_exactly_the_neighbours(limit):
    codes = np.array(_codes(random.Random(limit), 700), np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    index = simhash.GrayIndex(codes, np.full(codes.size, simhash.FULL))
    got = {(int(q), int(n)) for qs, ns in index.search(codes, limit) for q, n in zip(qs, ns)}
    differ = codes[:, None] ^ codes[None, :]
    near = (np.bitwise_count(differ) <= limit) & (np.bitwise_count(differ >> np.uint64(32)) <= limit // 2)
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near))))


@pytest.mark.parametrize("block,hot", [(5, 1), (40, 100), (8192, 100)])
def test_components(spark, block, hot):
    rng = random.Random(block)
    codes = _codes(rng, 160) + [0, 3, 7]
    rows = [(k, codes[k % len(codes)]) for k in range(2 * len(codes))] + [(900 + k, codes[1]) for k in range(30)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(i, c - (1 << 64) if c >> 63 else c) for i, c in rows], "doc_id bigint, fp bigint")
    got = {r.doc_id: r.component_id for r in simhash.component_ids(df, 2, hot, block).collect()}
    roots = _roots([c for _, c in rows], 2)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, i), i)
    assert got == {i: least[r] for (i, _), r in zip(rows, roots)}


def test_long_chains_end(spark):
    links = spark.createDataFrame([(k + 1, k) if k % 2 else (k, k + 1) for k in range(300)], "a bigint, b bigint").repartition(7)
    assert {(r.node, r.root) for r in simhash.components(links).collect()} == {(k, 0) for k in range(1, 301)}


def test_near_duplicates(spark):
    base = "one two three four five six seven eight nine ten eleven twelve " * 9
    rows = [(4, base), (2, base.upper()), (9, base + "x"), (3, "other words entirely here " * 9), (None, None), (7, ""),
            (8, " \n"), (8, " \n"), (None, "null id text alone"), (11, "short"), (12, "two words"), (13, LONG), (14, LONG + "é")]
    df = documents(spark, rows)
    got = simhash.near_duplicates(df).collect()
    assert sorted(map(str, (r.doc_id for r in got))) == sorted(str(i) for i, _ in rows)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(f"{_fingerprint(t):016x}")
    assert all(r.fingerprint in texts[r.doc_id] for r in got)
    component = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert component[4] == component[2] == 2 and component[7] == component[8] == 7 and component[3] == 3
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(8) == 0 and {2, 3, 7, 11, 12} <= set(ids) and 4 not in ids
    assert sum(i is None for i in ids) == 1  # the null text goes with 7, the null id's own text stays
    assert simhash.near_duplicates(df.limit(0)).count() == 0 and simhash.keep_first(df.limit(0)).count() == 0


# --- fingerprints ------------------------------------------------------------

def _paragraphs(text):
    return {x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")}


def _like(a, b):
    a, b = _paragraphs(a), _paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark):
    rng = random.Random(8)
    lines = [f"line {k} é" for k in range(400)]
    texts = ["", None, "\n \n", "a", LONG] + ["\n".join(rng.choices(lines, k=rng.choice([1, 3, 9, 40, 300]))) for _ in range(30)]
    rows = [(7 * k % 101, t) for k, t in enumerate(texts)] + [(None, "x\ny"), (3, "p\nq\n" * 3), (3, "p\nq\n" * 3)]
    got = fingerprints.edit_fingerprints(documents(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    order = sorted(((i, t or "") for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0), reverse=True)
    ids = [i for i, _ in order]
    shown = {}
    for k, (i, t) in enumerate(order):
        if ids.count(i) > 1:
            continue
        near = (order[(k + 1) % len(order)][1])
        if ids.count(ids[(k + 1) % len(order)]) > 1:
            near = "p\nq\n" * 3 if i != 3 else near
        half = len(t) // 2
        edited = t[:len(t) - half] + near[:half]
        r = next(x for x in got if x.doc_id == i)
        assert r.n_chars == len(t)
        if ids[(k + 1) % len(order)] != 3:  # ids that repeat are ordered by a hash
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.near_edited == pytest.approx(_like(t, edited))
            assert r.near_next == pytest.approx(_like(t, near))
        assert shown.setdefault(r.fingerprint, t) == t
    assert len({r.fingerprint for r in got if r.doc_id == 3}) <= ids.count(3)
    one = fingerprints.edit_fingerprints(documents(spark, [(1, "a\nb")])).collect()
    assert one[0].near_next == 1.0
    assert fingerprints.edit_fingerprints(documents(spark, [(1, "a")]).limit(0)).count() == 0


def test_differences_are_recovered_at_any_size(spark):
    rng = random.Random(1)
    pairs = []
    for k, n in enumerate([0, 1, 5, 30, 200, 1500]):
        a = [f"{k} {j}" for j in range(n)]
        b = [x for x in a if rng.random() < 0.6] + [f"new {k} {j}" for j in range(n // 3)]
        rng.shuffle(b)
        pairs.append((k, "\n".join(a), "\n".join(b + b[:3])))
    df = spark.createDataFrame(pairs + [(99, None, "z")], "k int, a string, b string")
    got = fingerprints.paragraph_differences(df, "a", "b")
    digest = {r.t: r.d for t in [got] for r in spark.createDataFrame(
        [(x,) for _, a, b in pairs for x in (a + "\n" + b).split("\n")] + [("z",)], "t string").selectExpr("t", "xxhash64(t) d").collect()}
    for r in got.collect():
        a, b = _paragraphs(r.a or ""), _paragraphs(r.b)
        assert {(x.key, x.n) for x in r.differences} == {(digest[x], 1) for x in a - b} | {(digest[x], -1) for x in b - a}
        assert len(r.differences) == len(a ^ b)


# --- sharding ----------------------------------------------------------------

def test_shards_fit(spark):
    rng = random.Random(6)
    rows = [(k, "é" * rng.randint(0, 60)) for k in range(300)] + [(None, "abc"), (5000, "x" * 5000), (17, None)]
    rows += [(1, "y" * 90)] * 100  # one id with a large share of the bytes
    got = sharding.assign_shards(documents(spark, rows), 1000).collect()
    assert len(got) == len(rows)
    assert sorted(r.n_bytes for r in got) == sorted(len((t or "").encode()) for _, t in rows)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    for bits, members in shards.items():
        total = sum(r.n_bytes for r in members)
        assert {(r.depth, r.shard_bytes, r.shard_docs) for r in members} == {(len(bits), total, len(members))}
        assert total <= 1000 and not members[0].oversize or len(members) == 1 and members[0].oversize
        if bits:  # only a bucket that was too large was split
            above = [r for b, m in shards.items() if b.startswith(bits[:-1]) for r in m]
            assert sum(r.n_bytes for r in above) > 1000
    for a, b in itertools.permutations(shards, 2):
        assert not b.startswith(a)
    assert sharding.assign_shards(documents(spark, rows).limit(0), 10).count() == 0


def test_shards_are_written(spark, tmp_path):
    df = spark.createDataFrame([(k, "x" * 50) for k in range(60)], "doc_id bigint, text string")
    shards = sharding.assign_shards(df, 400)
    sharding.write_shards(df, shards, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 60 and back.groupBy("shard").count().agg({"count": "max"}).first()[0] <= 8


# --- URL filters -------------------------------------------------------------

def _judge(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(LOWER)
    path = re.match(r"[^/?#]*([^?#]*)", rest).group(1)
    best = None
    for h, p, v in rules:
        h, p = h.translate(LOWER), p or ""
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best, (len(h + p), len(h), h + p, v)) if best else (len(h + p), len(h), h + p, v)
    return host, path, best[2] if best else None, best[3] if best else default


def test_url_rules(spark):
    rng = random.Random(3)
    labels, paths = ["a", "b", "aa", "com", "x!", "é", ""], ["", "/", "/a", "/a/", "/a/b", "/é", "//", "/a/bc"]
    name = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = list({(name(), rng.choice(paths)): None for _ in range(60)})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules] + [("COM", "/a", "block"), ("com", "/a", "allow")]
    dup = {}
    for h, p, v in rules:
        key = (h.translate(LOWER), p)
        dup[key] = "block" if "block" in (v, dup.get(key)) else v
    urls = [f"{rng.choice(['http', 'ftp', ''])}://{name().upper() if rng.random() < 0.2 else name()}"
            f"{rng.choice(paths)}{rng.choice(['', '?q=/a', '#/a', 'c/d'])}" for _ in range(500)]
    urls += [None, "", "no scheme", "://", "http:///a", "a://b://c/d", "http://a.com/a"] + ["http://a.com/a/b"] * 400
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(urls)] + [(None, "http://com/", "x", 1)],
                                  "page_id bigint, url string, host string, key int").repartition(6)
    table = spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, table, "allow", hot_rows=50).collect()
    assert len(got) == len(urls) + 1
    rules = [(h, p, v) for (h, p), v in dup.items()]
    for r in got:
        url = urls[r.page_id] if r.page_id is not None else "http://com/"
        assert (r.host, r.path, r.rule, r.verdict) == _judge(url, rules, "allow"), url
    allowed = url_filter.filter_urls(pages, table)
    assert allowed.columns == pages.columns
    assert sorted(str(r.url) for r in allowed.collect()) == sorted(
        str(u) for u in [*urls, "http://com/"] if _judge(u, rules, "allow")[3] == "allow")
    assert url_filter.judge_urls(pages.limit(0), table).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, table.limit(0), "allow").collect()} == {"allow"}


def test_url_plan_has_no_python(spark):
    plan = entry.queries()["op3_url_filters"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
