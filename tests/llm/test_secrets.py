"""Secret scan: base spans against the stated patterns, and nested layers."""

import base64
import gzip
import hashlib
import re
import urllib.parse
import zlib

import pytest

from tessera.llm import secrets as S

KEY = "AKIA" + "ABCDEFGH12345678"
PLAIN = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'


def spans(text):
    base, every = S.find_secrets(text.encode())
    return base, every


def brute(text):
    """The patterns as stated, over code points, failing matches dropped."""
    out = []
    for m in re.finditer(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append(("assign", *m.span()))
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda x: (x[1], S.KINDS.index(x[0])))


@pytest.mark.parametrize("text", [
    "", "nothing here", PLAIN, f"é{PLAIN} ü {KEY}", "secret=token:abcdefgh", "PASSWORD: 'a.b-c=d'", "token=abc",
    "api_key=x apikey = 123456", "AKIAAKIAAKIA", f"{KEY}{KEY}", "0" * 23, "0" * 24, "ſecret=abcdefgh", "toKen=abcdefgh",
    "token" + " " * 500 + "=" + " " * 3 + "abcdef", "token\n=abcdef", "x" * 100_000 + PLAIN])
def test_base_spans_are_the_stated_patterns(text):
    assert spans(text)[0] == brute(text)


def _url(s):
    return "".join(f"%{b:02X}" for b in s.encode())


def _unicode(s):
    return "".join(f"\\u{ord(c):04x}" for c in s)


def _b64(s):
    return base64.b64encode(s.encode()).decode()


LAYERS = {
    "url": _url, "quote": lambda s: urllib.parse.quote(s, safe=""), "unicode": _unicode,
    "entity": lambda s: "".join(f"&#{ord(c)};" for c in s), "b64": _b64,
    "b64url": lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    "zlib": lambda s: base64.b64encode(zlib.compress(s.encode())).decode(),
    "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    "url b64": lambda s: _url(_b64(s)), "b64 unicode": lambda s: _b64(_unicode(s)),
    "b64 gzip url": lambda s: base64.b64encode(gzip.compress(_url(s).encode())).decode(),
    "four": lambda s: _b64(_b64(_b64(_b64(s)))),
}


@pytest.mark.parametrize("name", LAYERS)
@pytest.mark.parametrize("secret", [PLAIN, KEY])
def test_nested_secrets_map_to_the_encoded_place(name, secret):
    body = LAYERS[name](secret)
    text = f"Größe vorher {body} nachher"
    base, every = spans(text)
    at = text.index(body)
    kind = "assign" if secret == PLAIN else "access"
    assert any(k == kind and at <= s and e <= at + len(body) for k, s, e in every), every
    assert set(base) <= set(every)
    # masking takes the secret out for good
    left = S.masked(text.encode(), every, "[secret]")
    assert not [x for x in S.find_secrets(left.encode())[1] if x[0] == kind]


def test_partly_encoded_text_maps_exactly():
    text = "é pass%77ord=abcdef%67h end"
    base, every = spans(text)
    assert base == []
    assert every == [("assign", 2, 23)]
    assert text[2:23] == "pass%77ord=abcdef%67h"


def test_clean_text_has_no_spans_and_cycles_end():
    assert spans("internationalisationofcharactersets words " * 50)[1] == []
    assert spans(_b64(_b64("plain words only here")) + " %41%42 \\u0041")[1] == []
    assert spans("%2525252525252541" * 10)[1] == []
    data = b"word " * 1000
    for _ in range(5):
        data = zlib.compress(data)
    assert spans(base64.b64encode(data).decode())[1] == []


def test_table(spark):
    rows = [(1, PLAIN, "x"), (1, PLAIN, "x"), (None, None, None), (2, "", "y"), (3, f"a {_b64(KEY)} b", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.spans) for r in S.secret_spans(df).collect()}
    assert (1, 1, 0, 1, "assign:0:49,hex:9:49") in got
    assert (None, 0, 0, 0, "") in got and (2, 0, 0, 0, "") in got
    assert (3, 0, 0, 0, "access:2:30") in got
    assert S.secret_spans(df).count() == 5
    digest = {r.base_sha256 for r in S.secret_spans(df).where("doc_id = 2").collect()}
    assert digest == {hashlib.sha256(b"").hexdigest()}
    assert S.secret_spans(df.limit(0)).count() == 0
    out = S.mask_secrets(df)
    assert out.columns == df.columns
    assert {r.text for r in out.collect()} == {"[secret]\"", None, "", "a [secret] b"}
