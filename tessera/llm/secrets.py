"""Secret scan with a recursive decoding worklist.

A text is the first layer.  Every layer is scanned for secrets; then whatever
in it is encoded is unwrapped, and what comes out is put on the worklist as a
layer of its own, until nothing new appears:

* percent escapes and Unicode escapes (``\\uXXXX``, ``\\u{X}``, ``\\xXX``,
  ``&#N;``, ``&#xX;``) are replaced throughout the layer;
* each run of base64 (either alphabet, padded or not, also over line breaks and
  indentation) is a layer in each of its four alignments, and so is what zlib,
  gzip, bzip2 or xz data at any place in it holds, whatever bytes these are;
* ASCII in UTF-16 (either order, at any place of a decoded layer) is a layer.

A layer keeps for each character the interval of the original text it comes
from, so a secret found ten layers down is reported as a span of the original.
A layer that has been seen with the same content at the same place is not
looked at again, which ends cycles (compressed data can hold itself).
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import itertools
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.columns import RunFn, free_name, struct_of

KINDS = ("assign", "access", "hex")
#: Base patterns over bytes (all that they match is ASCII).
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: Base64: one long run, or runs joined over line breaks (also escaped ones).
_BASE64 = re.compile(rb"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]{16,}+(?:BREAK[A-Za-z0-9+/_-]++)*+"
                     rb"|[A-Za-z0-9+/_-]++(?:BREAK[A-Za-z0-9+/_-]++)++)={0,2}"
                     .replace(b"BREAK", rb"[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+"))
_BREAK = re.compile(rb"[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+")
#: Shorter runs of base64 hold no secret.
LEAST_BASE64 = 16
#: Where compressed data begins; other zlib headers are tried where a run, a
#: line or a segment begins.
_PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|\x78[\x01\x5e\x9c\xda]", re.S)
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4})+|\\u\{([0-9A-Fa-f]{1,6})\}|\\x([0-9A-Fa-f]{2})"
                     r"|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
#: ASCII characters in UTF-16, little and big endian.
_WIDE = (re.compile("(?:[\x01-\x7f]\x00){12,}"), re.compile("(?:\x00[\x01-\x7f]){12,}"))
#: All secrets, plain or encoded, have at least so many ASCII characters together.
_WORTH = re.compile(rb"[\t\n\r -~]{12}|(?:[\t\n\r -~]\x00){11}")
_NO_TEXT = bytes(c for c in range(256) if c not in b"\t\n\r" and not 32 <= c < 127)
#: What compressed data holds is scanned in windows of about so many bytes, each
#: with the end of the one before: an encoded run that goes on, up to LONGEST
#: bytes (a longer one is cut and the text marked; ``find_whole`` then scans it anew
#: in larger windows), or OVERLAP.  Blocks are decompressed at a time.
WINDOW, OVERLAP, LONGEST, BLOCK = 1 << 22, 1 << 18, 1 << 24, 1 << 16
_ENCODED = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\&#;{} \t\r\n"
#: Compressed data right within compressed data is unpacked so many times in one
#: go; what is deeper is a layer of its own.
LEVELS = 16

Span = tuple[str, int, int]
_ZLIB = type(zlib.decompressobj())


def base_matches(text: bytes) -> list[tuple[str, int, int]]:
    """Base spans in bytes: per kind leftmost and non-overlapping."""
    found: list[Span] = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if b"AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST_ACCESS]
    # runs are maximal, so asking for 24 characters finds the same as dropping shorter runs
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


class _Points:
    """Code point positions of byte positions, asked for in any order."""

    def __init__(self, text: bytes):
        self.plain = text.isascii()
        if not self.plain:
            lead = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
            self.before = np.concatenate([[0], np.cumsum(lead)])

    def __call__(self, at: int) -> int:
        return at if self.plain else int(self.before[at])


@dataclass
class Layer:
    """A decoded text and, for each of its characters, where the original
    characters it comes from begin and end."""
    text: str
    start: np.ndarray
    end: np.ndarray


def _percent(m: re.Match) -> list[tuple[str, int, int]]:
    """Characters of a run of percent escapes, each with its place in the
    run.  Bytes that are no UTF-8 stand for themselves."""
    data = bytes.fromhex(m.group().replace("%", ""))
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                c = data[at:at + size].decode("utf-8")
            except UnicodeDecodeError:
                continue
            if len(c) == 1:
                break
        else:
            c, size = chr(data[at]), 1
        size = min(size, len(data) - at)
        out.append((c, 3 * at, 3 * (at + size)))
        at += size
    return out


def _escape(m: re.Match) -> list[tuple[str, int, int]]:
    whole = m.group()
    for g in range(1, 5):
        if m.group(g) is not None:
            point = int(m.group(g), 10 if g == 3 else 16)
            ok = point <= 0x10FFFF and not 0xD800 <= point < 0xE000
            return [(chr(point), 0, len(whole))] if ok else [(c, k, k + 1) for k, c in enumerate(whole)]
    units = [int(whole[k + 2:k + 6], 16) for k in range(0, len(whole), 6)]
    out, k = [], 0
    while k < len(units):
        a = units[k]
        pair = 0xD800 <= a < 0xDC00 and k + 1 < len(units) and 0xDC00 <= units[k + 1] < 0xE000
        n = 2 if pair else 1
        point = 0x10000 + ((a - 0xD800) << 10) + (units[k + 1] - 0xDC00) if pair else a
        out.append(("�" if 0xD800 <= point < 0xE000 else chr(point), 6 * k, 6 * (k + n)))
        k += n
    return out


def _replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every match replaced by what it stands for."""
    text, starts, ends, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        text.append(layer.text[at:m.start()])
        starts.append(layer.start[at:m.start()])
        ends.append(layer.end[at:m.start()])
        chars = decode(m)
        text.append("".join(c for c, _, _ in chars))
        starts.append(layer.start[[m.start() + a for _, a, _ in chars]])
        ends.append(layer.end[[m.start() + b - 1 for _, _, b in chars]])
        at = m.end()
    if not at:
        return None
    text.append(layer.text[at:])
    starts.append(layer.start[at:])
    ends.append(layer.end[at:])
    return Layer("".join(text), np.concatenate(starts), np.concatenate(ends))


def _zlib_header(data: bytes) -> bool:
    return len(data) > 1 and data[0] & 15 == 8 and data[0] >> 4 <= 7 and (data[0] << 8 | data[1]) % 31 == 0


def _opener(head: bytes):
    """A decompressor of the data that begins so, else None."""
    if head[:3] == b"\x1f\x8b\x08" or _zlib_header(head[:2]):
        return zlib.decompressobj(47)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


class _Source:
    """Blocks of bytes, of which what was not needed can be given back;
    ``whole`` is where the last complete member ended."""

    def __init__(self, blocks: Iterator[bytes]):
        self.blocks, self.kept, self.taken, self.whole = blocks, b"", 0, 0

    def take(self) -> bytes:
        got, self.kept = self.kept or next(self.blocks, b""), b""
        self.taken += len(got)
        return got

    def give(self, data: bytes) -> None:
        self.taken -= len(data)
        self.kept = data + self.kept

    def head(self, size: int = 6) -> bytes:
        got = b""
        while len(got) < size and (more := self.take()):
            got += more
        self.give(got)
        return got


def _blocks(data: bytes, begin: int) -> Iterator[bytes]:
    for at in range(begin, len(data), BLOCK):
        yield data[at:at + BLOCK]


def _members(source: _Source) -> Iterator[bytes]:
    """What all members of compressed data hold, one after the other."""
    first = True
    while first or source.head():
        if not first:  # padding between members
            while (got := source.take()) and not got.lstrip(b"\0"):
                pass
            source.give(got.lstrip(b"\0"))
        opened = _opener(source.head())
        if opened is None:
            return
        first = False
        data = b""
        try:
            while not opened.eof:
                # what is pending goes first: zlib gives back input, the others hold it
                wants = not data if isinstance(opened, _ZLIB) else opened.needs_input
                if wants:
                    data = source.take()
                    if not data:
                        return
                out = opened.decompress(data, BLOCK)
                data = opened.unconsumed_tail if isinstance(opened, _ZLIB) else b""
                if out:
                    yield out
                while isinstance(opened, _ZLIB) and len(out) == BLOCK and not data and not opened.eof:
                    out = opened.decompress(b"", BLOCK)
                    if out:
                        yield out
            source.give(opened.unused_data)
            source.whole = source.taken
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return


def _content(source: _Source) -> Iterator[bytes]:
    """What compressed data holds, through any further compression."""
    for _ in range(LEVELS):
        source = _Source(_members(source))
        if _opener(source.head()) is None:
            break
        # text may look like a header
        trial = _Source(iter([source.head(BLOCK)]))
        if next(_members(trial), None) is None:
            break
    while got := source.take():
        yield got


def _windows(blocks: Iterator[bytes], cut: list[bool], times: int = 1) -> Iterator[bytes]:
    """Blocks put together to windows ``times`` as large; every one begins with the
    end of the last one."""
    parts, size, kept = [], 0, 0
    for got in blocks:
        parts.append(got)
        size += len(got)
        if size - kept >= max(times * WINDOW, kept):
            window = b"".join(parts)
            yield window
            kept = max(times * OVERLAP, size - len(window.rstrip(_ENCODED)))
            if kept > times * LONGEST:
                cut[0], kept = True, times * OVERLAP
            parts, size = [window[-kept:]], kept
    if size > kept or not kept:
        yield b"".join(parts)


def _as_text(data: bytes) -> str | None:
    """Decoded data with a character for each byte (the patterns are ASCII), if
    it can hold a secret."""
    if len(data.translate(None, _NO_TEXT)) < 11:  # at once for long stretches of zeros
        return None
    return data.decode("latin-1") if _WORTH.search(data) else None


class _Run:
    """A match of _BASE64: its characters without line breaks, and the lines
    they are from."""

    def __init__(self, m: re.Match):
        whole, at = m.group(), m.start()
        self.starts, self.ends, parts = [], [], []
        last = 0
        for x in [*_BREAK.finditer(whole), None]:
            end = x.start() if x else len(whole)
            parts.append(whole[last:end])
            self.starts.append(at + last)
            self.ends.append(at + end)
            last = x.end() if x else end
        self.body = b"".join(parts).rstrip(b"=")
        self.first = np.cumsum([0, *map(len, parts[:-1])])  # of each line in the body

    def decoded(self, shift: int) -> bytes:
        body = self.body[shift:].translate(bytes.maketrans(b"-_", b"+/"))
        if len(body) % 4 == 1:
            body = body[:-1]
        return base64.b64decode(body + b"=" * (-len(body) % 4))

    def places(self, shift: int, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Per decoded byte where its lines begin and end."""
        if len(self.starts) == 1:
            return np.broadcast_to(self.starts[0], end - begin), np.broadcast_to(self.ends[0], end - begin)
        bits = 8 * np.arange(begin, end)
        low = np.searchsorted(self.first, shift + bits // 6, side="right") - 1
        high = np.searchsorted(self.first, shift + (bits + 7) // 6, side="right") - 1
        return np.array(self.starts)[low], np.array(self.ends)[high]

    def packed(self, shift: int, data: bytes) -> list[int]:
        """Bytes at which compressed data may begin."""
        found = {m.start() for m in _PACKED.finditer(data)}
        heads = [*self.first.tolist(), shift, *(m.end() for m in re.finditer(rb"[/_-]", self.body))]
        tried = {(h - shift) // 4 * 3 for h in heads if h >= shift and (h - shift) % 4 == 0}
        return sorted(found | {k for k in tried if _zlib_header(data[k:k + 2])})


def find_secrets(text: bytes) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those of decoded layers; code points,
    by start, then kind."""
    return find_all(text)[:2]


def find_whole(text: bytes) -> tuple[list[Span], list[Span]]:
    """As ``find_secrets``, without a hard stop: a text that was left at one is
    scanned anew in ever larger windows until all of it was."""
    times = 1
    while True:
        base, every, cut = find_all(text, times)
        if not cut:
            return base, every
        times *= 16


def find_all(text: bytes, times: int = 1) -> tuple[list[Span], list[Span], bool]:
    """As ``find_secrets``, and whether some compressed data was left at a hard
    stop (see WINDOW); windows and stop are ``times`` as large."""
    place = None
    base: list[Span] = []
    matches = base_matches(text)
    if matches:
        place = _Points(text)
        base = [(kind, place(s), place(e)) for kind, s, e in matches]
    every = set(base)
    seen: set[tuple] = set()
    cut = [False]

    def new(content: bytes, start: int, end: int) -> bool:
        key = (hashlib.sha256(content).digest(), start, end)
        fresh = key not in seen
        seen.add(key)
        return fresh

    def unpacked(data: bytes, begins: list[int], place, whole: bool) -> Iterator[Layer]:
        """Layers of the compressed data that begins at some of ``begins``;
        ``place`` gives where in the original bytes of ``data`` are from."""
        done = 0
        for begin in begins:
            if begin < done or _opener(data[begin:begin + 6]) is None:
                continue  # within data that was unpacked
            s, e = place(begin, len(data))
            source = _Source(_blocks(data, begin))
            content = _content(source)
            got = next(content, None)
            if got is None or not new(b"packed" + data[begin:], int(s[0]), int(e[-1])):
                continue
            for window in _windows(itertools.chain([got], content), cut, times):
                held = _as_text(window)
                if held is None and _PACKED.search(window):
                    held = window.decode("latin-1")
                if held is not None:
                    to = e[max(0, source.taken - 1)]
                    yield Layer(held, np.broadcast_to(s[0], len(held)), np.broadcast_to(to, len(held)))
            done = begin + source.whole
            if not whole and begin + source.taken >= len(data) and done < len(data):
                cut[0] = True  # goes on in the next window

    def inside(layer_text: str, layer: Layer | None, raw: bytes) -> Iterator[Layer]:
        """The layers found in one: ``layer`` is None for the original."""
        if ("%" in layer_text and _PERCENT.search(layer_text)) or \
                (("\\" in layer_text or "&#" in layer_text) and _ESCAPE.search(layer_text)):
            held = layer
            if held is None:
                n = len(layer_text)
                held = Layer(layer_text, np.arange(n), np.arange(1, n + 1))
            for got in (_replaced(held, _PERCENT, _percent), _replaced(held, _ESCAPE, _escape)):
                if got is not None:
                    yield got
        if layer is not None and "\0" in layer_text:
            for pattern in _WIDE:
                for m in pattern.finditer(layer_text):
                    s, e = m.span()
                    yield Layer(layer_text[s:e].replace("\0", ""), layer.start[s:e:2], layer.end[s + 1:e:2])
        points = None
        for m in _BASE64.finditer(raw):
            if m.end() - m.start() < LEAST_BASE64:
                continue
            run = _Run(m)
            if len(run.body) < LEAST_BASE64:
                continue
            for shift in range(4):
                data = run.decoded(shift)
                held, begins = _as_text(data), run.packed(shift, data)
                if held is None and not begins:
                    continue
                if layer is None and points is None and not text.isascii():
                    points = _Points(raw)

                def place(begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
                    s, e = run.places(shift, begin, end)
                    if layer is not None:
                        return layer.start[s], layer.end[e - 1]
                    return (s, e) if points is None else (points.before[s], points.before[e])

                if held is not None:
                    yield Layer(held, *place(0, len(data)))
                yield from unpacked(data, begins, place, True)

    def children(layer: Layer) -> Iterator[Layer]:
        raw = layer.text.encode("ascii", "replace")  # a byte for each character; "?" is in no pattern
        for kind, s, e in base_matches(raw):
            every.add((kind, int(layer.start[s]), int(layer.end[e - 1])))
        yield from inside(layer.text, layer, raw)
        data = layer.text.encode("latin-1", "replace")
        begins = [m.start() for m in _PACKED.finditer(data)]
        yield from unpacked(data, begins, lambda s, e: (layer.start[s:e], layer.end[s:e]), len(data) < times * WINDOW)

    if b"%" in text or b"\\" in text or b"&#" in text:
        work = [inside(text.decode("utf-8", "replace"), None, text)]
    else:
        work = [inside("", None, text)]
    while work:  # depth first, so few windows are held at a time
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif layer.text and new(layer.text.encode("utf-8", "surrogatepass"), int(layer.start[0]), int(layer.end[-1])):
            work.append(children(layer))
    order = lambda x: (x[1], KINDS.index(x[0]), x[2])
    return sorted(base, key=order), sorted(every, key=order), cut[0]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind, s, e in spans)


def masked(text: bytes, spans: list[Span], mask: str) -> str:
    """The text with every span replaced by ``mask``; spans that touch or
    overlap become one."""
    chars, out, at = text.decode("utf-8", "replace"), [], 0
    ordered = sorted((s, e) for _, s, e in spans)
    k = 0
    while k < len(ordered):
        s, e = ordered[k]
        while k + 1 < len(ordered) and ordered[k + 1][0] <= e:
            k += 1
            e = max(e, ordered[k][1])
        out += [chars[at:s], mask]
        at = e
        k += 1
    return "".join(out) + chars[at:]


SCHEMA = T.StructType([
    T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
    T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()), T.StructField("cut", T.BooleanType())])


def _digests() -> RunFn:
    def work(run: list[bytes | None]) -> dict:
        out: dict[str, list] = {f.name: [] for f in SCHEMA.fields}
        for text in run:
            base, every = find_whole(text or b"")
            for kind in KINDS:
                out[f"n_{kind}"].append(sum(x[0] == kind for x in base))
            out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
            out["spans"].append(_joined(every))
            out["cut"].append(False)
        return out

    return work


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, counts of base spans per kind,
    base_sha256, ``spans``, all spans as kind:start:end, and ``cut``, whether
    some compressed data was left unscanned (none is: see ``find_whole``).

    Null and empty texts have none.  Repeated rows, null ids and further
    columns are allowed."""
    kept = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    name = free_name(kept, "secrets")
    return kept.select("doc_id", struct_of(F.col("text"), SCHEMA, _digests).alias(name)).select("doc_id", f"{name}.*")


MASKED = T.StructType([T.StructField("text", T.StringType()), T.StructField("cut", T.BooleanType())])


def _masked(mask: str, whole: bool = False) -> RunFn:
    """``whole``: without a hard stop; else a text left at one is marked."""
    def work(run: list[bytes | None]) -> dict:
        out: dict[str, list] = {"text": [], "cut": []}
        for t in run:
            _, every, cut = ([], [], False) if not t else (*find_whole(t), False) if whole else find_all(t)
            out["text"].append(masked(t, every, mask) if every else None if t is None else t.decode("utf-8", "replace"))
            out["cut"].append(cut)
        return out

    return work


def masked_text(text: Column, mask: str = "[secret]") -> Column:
    """A struct column: ``text`` with all spans masked (null stays null), and
    ``cut``, whether some compressed data was left unscanned (none is)."""
    return struct_of(text, MASKED, lambda: _masked(mask, whole=True), filtered=True)


def mask_secrets(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in ``text`` and, where there is such a
    column, ``n_chars`` counted anew; all other columns as they are.  Every text is
    scanned to its end and stays (one that ``masked_text`` marked would not)."""
    name = free_name(docs, "masked")
    out = docs.withColumn(name, masked_text(F.col(f"`{text}`"))).where(~F.col(f"{name}.cut")).withColumn(text, F.col(f"{name}.text"))
    if n_chars and n_chars in docs.columns:
        kind = docs.schema[n_chars].dataType
        out = out.withColumn(n_chars, F.char_length(F.col(text)).cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
