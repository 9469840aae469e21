"""Secret scan: layers that are not plain text, wrapped and glued base64, and
compressed data of several members."""

import base64
import bz2
import gzip
import io
import lzma
import random
import tarfile
import zlib

import pytest

from tessera.llm import secrets as S

KEY = "AKIA" + "ABCDEFGH12345678"


def found(text):
    return {k for k, _, _ in S.find_secrets(text.encode())[1]}


def b64(data):
    return base64.b64encode(data).decode()


def _tar_gz(data):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        info = tarfile.TarInfo("config")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    return out.getvalue()


LINE = f"user = é; key {KEY}; more"
DATA = {
    "control byte": LINE.encode() + b"\x0c\x1b", "delete": LINE.encode() + b"\x7f", "latin-1": LINE.encode("latin-1"),
    "binary": b"\x00\xff\xfe\x80" + LINE.encode() + b"\x00" * 9, "tar.gz": _tar_gz(LINE.encode()),
    "utf-16": LINE.encode("utf-16"), "utf-16-le": LINE.encode("utf-16-le"), "utf-16-be": LINE.encode("utf-16-be"),
    "odd utf-16": b"x" + LINE.encode("utf-16-be"), "utf-16 gzip": gzip.compress(LINE.encode("utf-16")),
    "nested": b"\x00\xff" + b64(b"\x00\xff" + LINE.encode()).encode() + b"\x00",
}


@pytest.mark.parametrize("name", DATA)
def test_layers_with_any_bytes_are_scanned(name):
    text = f"Größe {b64(DATA[name])} nachher"
    every = S.find_secrets(text.encode())[1]
    assert ("access", 6, len(text) - 8) in every
    assert not found(S.masked(text.encode(), every, "[secret]"))


def _wrapped(data, width, indent="", end="\n"):
    body = b64(data)
    return (end + indent).join(body[k:k + width] for k in range(0, len(body), width))


LONG = ("some words before it, " * 20 + LINE + " and after it" * 30).encode()
WRAPPED = {
    "mime": _wrapped(LONG, 76), "crlf": _wrapped(LONG, 76, end="\r\n"), "pem": _wrapped(LONG, 64),
    "indented": _wrapped(LONG, 60, "    "), "narrow": _wrapped(LONG, 12), "escaped": _wrapped(LONG, 64, end="\\n"),
    "gzip": _wrapped(gzip.compress(LONG), 76), "zlib": _wrapped(zlib.compress(LONG, 4), 64, "\t"),
    "glued zlib": "-----BEGIN DATA-----\n" + _wrapped(zlib.compress(LONG), 64),
    "short tail": _wrapped(b"x" * 54 + KEY.encode(), 76),
}


@pytest.mark.parametrize("name", WRAPPED)
def test_wrapped_base64_is_joined(name):
    text = f"Größe: é\n\n  {WRAPPED[name]} nachher"
    every = S.find_secrets(text.encode())[1]
    at = text.index(WRAPPED[name])
    assert any(k == "access" and at <= s < e <= at + len(WRAPPED[name]) for k, s, e in every), every
    assert not found(S.masked(text.encode(), every, "[secret]"))


@pytest.mark.parametrize("lead", ["/v/", "/ab/", "abc/", "a-", "ab_", "abc-", "x", "xy", "xyz", "/a/b/cd/"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("tail", ["", "/x", "-end"])
def test_glued_base64_is_decoded_in_every_alignment(lead, pack, tail):
    body = base64.urlsafe_b64encode(pack(LINE.encode())).decode().rstrip("=")
    text = f"https://é.example{lead}{body}{tail} nachher"
    every = S.find_secrets(text.encode())[1]
    assert "access" in {k for k, _, _ in every}
    assert not found(S.masked(text.encode(), every, "[secret]"))


def test_a_wrapped_secret_maps_to_its_lines():
    lines = ["A" * 64, b64(LINE.encode()), "nothing here\n"]
    text = "\n".join(lines)
    assert [text[s:e] for k, s, e in S.find_secrets(text.encode())[1] if k == "access"] == [lines[1]]


PACKERS = {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress}


@pytest.mark.parametrize("name", PACKERS)
@pytest.mark.parametrize("between", [b"", b"\0" * 8])
def test_every_member_is_unpacked(name, between):
    pack = PACKERS[name]
    data = between.join([pack(b"first member " * 9)] * 20 + [pack(LINE.encode())])
    assert "access" in found(f"a {b64(data)} b")
    assert "access" in found(f"a {b64(gzip.compress(data))} b")


@pytest.mark.parametrize("name", PACKERS)
def test_long_content_is_unpacked_whole(name):
    data = b"\0" * (66 << 20) + LINE.encode()
    every, cut = S.find_all(f"a {b64(PACKERS[name](data))} b".encode())[1:]
    assert "access" in {k for k, _, _ in every} and not cut


def test_the_same_payload_many_times_is_read_everywhere():
    body = b64(gzip.compress(b"\0" * (30 << 20) + LINE.encode()))
    text = f"{body} %41 \\u0041 {body} {body}"
    assert len({s for k, s, _ in S.find_secrets(text.encode())[1] if k == "access"}) == 3


def test_secrets_and_payloads_across_windows(monkeypatch):
    monkeypatch.setattr(S, "WINDOW", 1 << 16)
    monkeypatch.setattr(S, "OVERLAP", 1 << 10)
    inner = b64(gzip.compress(random.Random(3).randbytes(100_000) + LINE.encode()))
    for lead in range((1 << 16) - 40, (1 << 16) + 3, 3):
        assert "access" in found(b64(gzip.compress(b"." * lead + LINE.encode())))
    for lead in (0, 60_000, 65_530, 120_000):
        assert "access" in found(b64(gzip.compress(b"." * lead + inner.encode() + b"." * 70_000)))
    body = b64(gzip.compress(b"A" * (40 << 16)))
    assert not S.find_all(body.encode())[2]
    monkeypatch.setattr(S, "LONGEST", 1 << 17)
    assert S.find_all(body.encode())[2]


def test_a_run_longer_than_the_hard_stop_is_scanned_whole(monkeypatch):
    """The secret lies behind a long encoded run in compressed data; the text stays, masked."""
    monkeypatch.setattr(S, "WINDOW", 1 << 16)
    monkeypatch.setattr(S, "OVERLAP", 1 << 10)
    monkeypatch.setattr(S, "LONGEST", 1 << 17)
    inner = base64.b64encode(b"A" * (1 << 19) + b" " + LINE.encode() + b" ")
    text = b"data " + base64.b64encode(gzip.compress(inner)) + b" end"
    assert S.find_all(text)[2]
    assert "access" in {k for k, _, _ in S.find_whole(text)[1]}
    assert S._masked("[secret]", whole=True)([text, b"clean", None]) == {"text": ["data [secret] end", "clean", None], "cut": [False] * 3}
