"""Secret scans with a recursive decoding worklist.

A layer is a text together with the span of the document that each of its characters
comes from. The document is the first layer. Every layer is scanned for the three
kinds of secret, then unwrapped: URL escapes and Unicode escapes replace the
layer's escapes all at once, and each base64 run becomes layers of bytes, read from each of its first
four characters as it may follow a prefix in base64's own letters; runs on
neighbouring lines are also read as one. Escapes are read as
bytes too when gzip or zlib data begins among them. A layer of bytes is a layer of
text (of UTF-8 or, if it is none, of a character for each byte) whenever a run of ASCII in it is long enough for a
secret, since patterns and encodings are ASCII, and each compressed stream in it (all gzip members that follow one
another are one stream) is inflated to a further layer of bytes. New layers join the worklist;
a layer whose content was met before in the document at the same place is not taken again, so cycles
end and the work stops at a fixpoint. Spans found in a layer are mapped back: to the very characters
for escapes, to the four-character groups for base64, to the whole run for compressed data.

Kinds and patterns are those of ``PATTERNS`` with a least length each; what a match
takes is leftmost and not overlapping within its kind, and too short matches are
dropped after they have been taken. In layers below the first only matches that touch decoded characters count.

Edge cases: a null text is empty and has no spans. Very long texts are scanned whole. A
stream of more than ``HELD`` bytes is scanned in pieces of that size, each overlapping the next by half. One of
more than ``MAX_INFLATED`` bytes is reported whole as a span of kind ``oversize`` instead of being read; a run or stream
inside a large one that no piece holds whole is read as far as the piece goes and reported so as well. Repeated rows are scanned alike; other columns pass
through (``spans`` is replaced). An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import functools
import hashlib
import lzma
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import arrow_map, documents

KINDS = ("assign", "access", "hex")
OVERSIZE = "oversize"
_ORDER = {k: i for i, k in enumerate((*KINDS, OVERSIZE))}
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
#: Runs shorter than these cannot count, and no part of such a run can either.
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]{12,}"), re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST = 8
_KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
#: Names of characters by number: of string literals (four, eight or braced digits, or bytes), of scripts, and of HTML.
_NUMBERED = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})|%u([0-9A-Fa-f]{4})|&#[xX]([0-9A-Fa-f]{1,6});"
                       r"|&#([0-9]{1,7});|((?:\\x[0-9A-Fa-f]{2})+)")
UNICODE = re.compile("(?:" + re.sub(r"\((?!\?)", "(?:", _NUMBERED.pattern) + ")+")
_NUMBER_SIGNS = ("\\u", "\\U", "\\x", "%u", "&#")
#: Base64 in either alphabet; shorter runs than this cannot hold a secret.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Runs that follow one another over single line breaks, as in wrapped base64 of any width.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:\r?\n[\t ]*+[A-Za-z0-9+/_-]++)++={0,2}")
_BREAK = re.compile(r"\r?\n[\t ]*")
#: Inflated bytes of one run that are held at a time, and that are read at all: the limit bounds the time.
HELD, MAX_INFLATED = 16 << 20, 4 << 30
#: Memory that reading an xz stream may take; one that asks for more is no stream.
XZ_MEMORY = 128 << 20
#: A byte at which every match and every encoded run ends.
_BOUNDARY = re.compile(rb"""[^A-Za-z0-9+/_.=%\\\r\n\t :"'-]""")
#: No secret, encoded or not, is found in bytes without such a run (the shortest is ``token=`` and its value).
READABLE = re.compile(rb"[\t\n\r -~]{%d}" % (len("token=") + ASSIGN_LEAST))
#: The same for text in two bytes a character, little or big end first.
WIDE = re.compile(rb"(?:[\t\n\r -~]\0){%d}|(?:\0[\t\n\r -~]){%d}" % (len("token=") + ASSIGN_LEAST, len("token=") + ASSIGN_LEAST))
#: Escapes of a string literal, read as one byte each when they hide compressed data.
LITERAL = re.compile(r"""(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|\\["\\/bfnrt])+""")
_ONE_ESCAPE = re.compile(r"""\\u(....)|\\x(..)|\\(.)""")
_SHORT = dict(zip("bfnrt", "\b\f\n\r\t"))
#: First bytes of gzip, bzip2 and xz data, or of zlib data without a preset dictionary.
COMPRESSED = re.compile(b"|".join([rb"\x1f\x8b\x08", rb"BZh[1-9]1AY&SY", rb"\xfd7zXZ\x00", *(
    b"%s[%s]" % (re.escape(bytes([c])), b"".join(re.escape(bytes([f])) for f in range(256) if not f & 32 and (c << 8 | f) % 31 == 0))
    for c in range(8, 128, 16))]), re.S)

Span = tuple[str, int, int]


def scan(text: str) -> list[Span]:
    """The spans of one layer's text."""
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


_HEX = np.full(256, -1, np.int16)
_HEX[np.frombuffer(b"0123456789abcdefABCDEF", np.uint8)] = [*range(16), *range(10, 16)]


def _url_arrays(text: str, as_bytes: bool) -> tuple[str, np.ndarray, np.ndarray] | None:
    """``text`` with all URL escapes read at once: the new text, which characters are kept, and which of these are decoded.

    None if an escape is not ASCII, unless each is one character of its own (``as_bytes``)."""
    try:
        codes = np.frombuffer(text.encode("latin-1"), np.uint8)
        back = "latin-1"
    except UnicodeEncodeError:
        codes, back = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), "utf-32-le"
    at = np.flatnonzero(codes[:-2] == ord("%"))
    high, low = (_HEX[np.minimum(codes[at + i], 255)] for i in (1, 2))
    good = (high >= 0) & (low >= 0)
    at, value = at[good], (high * 16 + low)[good]
    if not as_bytes and (value >= 0x80).any():
        return None
    keep, new, out = np.ones(len(codes), bool), np.zeros(len(codes), bool), codes.copy()
    keep[at + 1] = keep[at + 2] = False
    out[at], new[at] = value, True
    return out[keep].tobytes().decode(back, "surrogatepass" if back != "latin-1" else "strict"), keep, new[keep]


def _unescape(text: str, pattern: re.Pattern, read) -> tuple[str, np.ndarray, np.ndarray, np.ndarray] | None:
    """``text`` with every escape run decoded: the new text, and each character's start, end and whether it was decoded."""
    if pattern is URL and (found := _url_arrays(text, read is _url_bytes)):
        out, keep, new = found
        starts = np.flatnonzero(keep)
        return (out, starts, starts + 1 + 2 * new, new) if new.any() else None
    parts, starts, ends, new, at = [], [], [], [], 0
    for m in pattern.finditer(text):
        found = read(m.group())
        if found is None:
            continue
        piece, a, b = found
        plain = np.arange(at, m.start())
        parts += [text[at:m.start()], piece]
        starts += [plain, m.start() + a]
        ends += [plain + 1, m.start() + b]
        new += [np.zeros(len(plain), bool), np.ones(len(piece), bool)]
        at = m.end()
    if not parts:
        return None
    rest = np.arange(at, len(text))
    return ("".join([*parts, text[at:]]), np.concatenate([*starts, rest]), np.concatenate([*ends, rest + 1]),
            np.concatenate([*new, np.zeros(len(rest), bool)]))


@functools.lru_cache(1 << 16)
def _piece(read, run: str) -> str:
    return read(run)[0]


def _unescape_placeless(text: str, pattern: re.Pattern, read, marks: bool) -> tuple[str, np.ndarray | None] | None:
    """As :func:`_unescape` without places: the new text and, with ``marks``, whether each character was decoded."""
    if pattern is URL and (found := _url_arrays(text, read is _url_bytes)):
        return (found[0], found[2]) if found[2].any() else None

    def piece(run: str) -> str:
        return _piece(read, run) if len(run) <= 16 else read(run)[0]  # short runs are few

    if not marks:
        out, n = pattern.subn(lambda m: piece(m.group()), text)
        return (out, None) if n else None
    parts, new, at = [], [], 0
    for m in pattern.finditer(text):
        decoded = piece(m.group())
        parts += [text[at:m.start()], decoded]
        new += [bytes(m.start() - at), b"\1" * len(decoded)]
        at = m.end()
    if not parts:
        return None
    return "".join([*parts, text[at:]]), np.frombuffer(b"".join([*new, bytes(len(text) - at)]), bool)


def _read_url(run: str):
    raw = bytes.fromhex(run.replace("%", ""))
    try:
        piece = raw.decode()
    except UnicodeDecodeError:
        piece = raw.decode("latin-1")
    sizes = np.array([len(c.encode()) for c in piece] if len(piece) != len(raw) else [1] * len(raw))
    ends = np.cumsum(sizes) * 3
    return piece, ends - sizes * 3, ends


def _read_unicode(run: str):
    pieces, starts, ends = [], [], []
    for m in _NUMBERED.finditer(run):
        if m[7]:
            raw = bytes.fromhex(m[7].replace("\\x", ""))
            try:
                text = raw.decode()
            except UnicodeDecodeError:
                text = raw.decode("latin-1")
            at = m.start()
            for c in text:
                n = 4 * (len(c.encode()) if len(text) != len(raw) else 1)
                pieces.append(c)
                starts.append(at)
                ends.append(at := at + n)
            continue
        code = int(m[6]) if m[6] else int(m[1] or m[2] or m[3] or m[4] or m[5], 16)
        if 0xDC00 <= code < 0xE000 and pieces and 0xD800 <= ord(pieces[-1]) < 0xDC00 and ends[-1] == m.start():
            pieces[-1], ends[-1] = chr(0x10000 + (ord(pieces[-1]) - 0xD800) * 0x400 + code - 0xDC00), m.end()
        else:
            pieces.append(chr(code) if code <= 0x10FFFF else "\ufffd")
            starts.append(m.start())
            ends.append(m.end())
    # halves of pairs that stand alone are no characters
    text = "".join("\ufffd" if 0xD800 <= ord(c) < 0xE000 else c for c in pieces)
    return text, np.array(starts), np.array(ends)


def _url_bytes(run: str):
    ends = np.arange(3, len(run) + 1, 3)
    return bytes.fromhex(run.replace("%", "")).decode("latin-1"), ends - 3, ends


def _literal_bytes(run: str):
    found = list(_ONE_ESCAPE.finditer(run))
    piece = "".join(chr(int(m[1] or m[2], 16)) if m[1] or m[2] else _SHORT.get(m[3], m[3]) for m in found)
    return piece, np.array([m.start() for m in found]), np.array([m.end() for m in found])


class _Zlib:
    """zlib's decompressor with the interface of the other two."""

    def __init__(self, bits: int):
        self._d = zlib.decompressobj(bits)

    def decompress(self, data, most: int) -> bytes:
        return self._d.decompress(self._d.unconsumed_tail + bytes(data) if self._d.unconsumed_tail else data, most)

    eof = property(lambda self: self._d.eof)
    unused_data = property(lambda self: self._d.unused_data)


def _opened(raw: memoryview, at: int):
    first = bytes(raw[at:at + 3])
    if first == b"BZh":
        return bz2.BZ2Decompressor()
    return lzma.LZMADecompressor(lzma.FORMAT_XZ, memlimit=XZ_MEMORY) if first == b"\xfd7z" else _Zlib(47)


def _parts(raw: memoryview, state: dict, bare: bool = False):
    """What the streams that follow one another from the start of ``raw`` hold, at most a megabyte at a time.

    ``state`` tells where they ``end``, whether the last is ``whole``, and how many of the bytes are ``good``. A ``bare`` stream is
    deflated data without a head."""
    state |= {"end": 0, "whole": False, "good": 0}
    at = size = 0
    while bare or COMPRESSED.match(raw, at):
        d, fed, step = _Zlib(-15) if bare else _opened(raw, at), at, 256
        try:
            # in growing pieces, so that neither a false start nor a short member copies what follows it
            while not d.eof and fed < len(raw):
                piece = d.decompress(raw[fed:fed + step], 1 << 20)
                while piece:
                    size += len(piece)
                    yield piece
                    piece = d.decompress(b"", 1 << 20) if not d.eof else b""
                fed, step = min(fed + step, len(raw)), min(step * 2, 1 << 20)
        except (zlib.error, OSError, lzma.LZMAError, EOFError):
            return
        at = fed - len(d.unused_data)
        state |= {"end": at, "whole": d.eof, "good": size}
        if bare or not d.eof:
            return
        pad = at
        while pad < len(raw) and not raw[pad]:  # gzip files may be padded with zeros between members
            pad += 1
        at = pad if COMPRESSED.match(raw, pad) else at


def _bare(raw: bytes) -> bool:
    """Whether ``raw`` may be deflated data without a head: its first bytes inflate to something readable."""
    d = zlib.decompressobj(-15)
    try:
        out = d.decompress(raw[:512], 4_096)
    except zlib.error:
        return False
    if not (d.eof or len(raw) > 512 or d.unconsumed_tail):
        return False
    return bool(READABLE.search(out) or COMPRESSED.search(out) or WIDE.search(out)) or len(out) > 8 and _bare(out)


def _streams(raw: bytes, escaped: np.ndarray | None = None):
    """The compressed streams of ``raw``: start, end, whether whole, and their bytes (None if more than can be held); ``escaped`` ones have an escape near the start."""
    view, at, held = memoryview(raw), 0, min(HELD, MAX_INFLATED)
    while m := COMPRESSED.search(raw, at):
        at, state, out, size = m.start(), {"end": 0}, [], 0
        if escaped is None or escaped[at:at + 32].any():
            for piece in _parts(view[at:], state):
                out.append(piece)
                size += len(piece)
                if size > held:
                    break
        if size > held:
            yield at, len(raw), True, None
            return
        if state["end"]:
            yield at, at + state["end"], state["whole"], b"".join(out)[:state["good"]]
        at += state["end"] if state["end"] and state["whole"] else 1


def _overlapping(raw: memoryview, bare: bool = False):
    """Pieces of large streams and whether more follows; each begins with the last half of the one before it."""
    held, rest = min(HELD, MAX_INFLATED), bytearray()
    for piece in _parts(raw, {}, bare):
        rest += piece
        if len(rest) > held:
            yield bytes(rest[:held]), True
            del rest[:held // 2]
    yield bytes(rest), False


def _decode64(run: str) -> bytes | None:
    core = run.rstrip("=").translate({45: 43, 95: 47})
    if len(core) % 4 == 1:
        core = core[:-1]
    try:
        return base64.b64decode(core + "=" * (-len(core) % 4))
    except (binascii.Error, ValueError):
        return None


class Layer:
    """A text and where it comes from: for each character its span in the document and whether a decoder made it.

    What was compressed comes as a whole from one span, which is then held once (``whole``) and not for each character.
    """

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None, new: np.ndarray | None = None,
                 whole: tuple[int, int] | None = None):
        self.text, self.starts, self.ends, self.new, self.whole = text, starts, ends, new, whole

    def place(self, a: int, b: int) -> tuple[int, int]:
        """Document span of the characters ``a`` to ``b``."""
        if self.whole:
            return self.whole
        if self.starts is None:
            return a, b
        return int(self.starts[a:b].min()), int(self.ends[a:b].max())

    def lifted(self, text: str, starts: np.ndarray, ends: np.ndarray, new: np.ndarray) -> Layer:
        """The layer of ``text``, whose characters come from this layer's ``starts`` to ``ends``."""
        if self.whole:
            return Layer(text, whole=self.whole)
        if self.starts is None:
            return Layer(text, starts, ends, new)
        return Layer(text, self.starts[starts], self.ends[ends - 1], new | self.new[starts])

    def name(self):
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), self.place(0, len(self.text))

    def spans(self) -> list[Span]:
        """Document spans of the matches that touch decoded characters."""
        return [(kind, *self.place(a, b)) for kind, a, b in scan(self.text) if self.whole or self.new[a:b].any()]

    def _decoded(self, pattern: re.Pattern, read) -> Layer | None:
        if self.whole:
            found = _unescape_placeless(self.text, pattern, read, False)
            return found and Layer(found[0], whole=self.whole)
        found = _unescape(self.text, pattern, read)
        return found and self.lifted(*found)

    def children(self):
        """Layers one decoding further."""
        t = self.text
        if "%" in t and (u := self._decoded(URL, _read_url)):
            yield u
            yield from self._escaped_bytes(URL, _url_bytes)
        if any(sign in t for sign in _NUMBER_SIGNS) and (u := self._decoded(UNICODE, _read_unicode)):
            yield u
            if "\\" in t:
                yield from self._escaped_bytes(LITERAL, _literal_bytes)
        for m in BASE64.finditer(t):
            yield from self._base64(m.group(), m.start(), m.end(), [])
        if "\n" in t:
            for m in WRAPPED.finditer(t):
                yield from self._base64(_BREAK.sub("", m.group()), m.start(), m.end(), list(_BREAK.finditer(t, m.start(), m.end())))

    def _base64(self, run: str, start: int, end: int, breaks: list[re.Match]):
        """Layers of bytes of a run without its line ``breaks``, read from each of four characters: a prefix may be of any length."""
        found = [(k, raw, bare) for k in range(min(4, len(run))) if (raw := _decode64(run[k:])) and (
            not (bare := _bare(raw)) and (READABLE.search(raw) or COMPRESSED.search(raw) or WIDE.search(raw)) or bare)]
        if not found:
            return
        stop = self.place(start, end)[1]
        if self.whole:
            for k, raw, bare in found:
                yield Bytes(raw, self, stop, bare=bare)
            return
        lost = np.zeros(end - start, bool)
        for b in breaks:
            lost[b.start() - start:b.end() - start] = True
        places = start + np.flatnonzero(~lost)
        for k, raw, bare in found:
            after = np.arange(1, len(raw) + 1)
            first, last = places[k + (after - 1) * 4 // 3], places[k - 1 - (-after * 4 // 3)] + 1
            yield Bytes(raw, self.lifted("", first, last, np.ones(len(raw), bool)), stop, bare=bare)

    def _escaped_bytes(self, pattern: re.Pattern, read):
        """Layers of bytes of which compressed data was escaped, with the characters that needed no escape."""
        if self.whole:
            found, at = _unescape_placeless(self.text, pattern, read, pattern is URL), self
            if found and found[1] is None and COMPRESSED.search(found[0].encode("latin-1", "replace")):
                found = _unescape_placeless(self.text, pattern, read, True)
        else:
            text, *where = _unescape(self.text, pattern, read) or (None,)
            found, at = (text, where[2]) if text is not None else None, None
        if not found:
            return
        raw = found[0].encode("latin-1", "replace")
        for r in {raw, raw.replace(b"+", b" ")} if pattern is URL else (raw,):
            if COMPRESSED.search(r):
                at = at or self.lifted("", *where)
                yield Bytes(r, at, at.whole[1] if at.whole else int(at.ends[-1]), found[1])


class Bytes:
    """Decoded bytes, where they come from (as in a layer), and where their run ends; ``more`` if their stream goes on; those of
    which some are ``escaped`` have been read as text already; ``bare`` ones may be deflated data without a head."""

    def __init__(self, raw: bytes, at: Layer, end: int, escaped: np.ndarray | None = None, more: bool = False, bare: bool = False):
        self.raw, self.at, self.end, self.escaped, self.more, self.bare = raw, at, end, escaped, more, bare

    def name(self):
        return hashlib.blake2b(self.raw, digest_size=16).digest(), self.escaped is None, self._span(0, len(self.raw))

    def spans(self) -> list[Span]:
        return []

    def _span(self, a: int, b: int) -> tuple[int, int]:
        """Document span of the bytes ``a`` to ``b``; to the end of the run if they reach the end of the bytes."""
        if self.at.whole:
            return self.at.whole
        return int(self.at.starts[a]), int(self.at.ends[b - 1]) if b < len(self.raw) else self.end

    def _text(self, text: str, first: np.ndarray | None, last: np.ndarray | None) -> Layer:
        """The layer of ``text``, whose characters are the bytes ``first`` to ``last`` (of all, one each)."""
        if self.at.whole:
            return Layer(text, whole=self.at.whole)
        starts, ends = self.at.starts, self.at.ends
        if first is not None:
            starts, ends = starts[first], ends[last]
        return Layer(text, starts, ends, np.ones(len(text), bool))

    def _texts(self):
        """The text of one byte or UTF-8 a character, and that of two bytes a character."""
        if READABLE.search(self.raw):
            try:
                text = self.raw.decode()
            except UnicodeDecodeError:
                text = self.raw.decode("latin-1")
            first = last = None
            if not self.at.whole and not text.isascii() and len(text) < len(self.raw):
                codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                after = np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF))
                first, last = np.concatenate(([0], after[:-1])), after - 1
            yield self._text(text, first, last)
        wide = WIDE.finditer(self.raw) if b"\0" in self.raw else ()
        for odd, name in sorted({(m.start() % 2, "utf-16-be" if m.group()[:1] == b"\0" else "utf-16-le") for m in wide}):
            cut = self.raw[odd:len(self.raw) - (len(self.raw) - odd) % 2]
            text = cut.decode(name, "replace")
            first = last = None
            if not self.at.whole:
                codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
                after = odd + 2 * np.cumsum(1 + (codes > 0xFFFF))
                after = np.minimum(after, len(cut) + odd)
                first, last = np.concatenate(([odd], after[:-1])), after - 1
            yield self._text(text, first, last)

    def children(self):
        """The texts, the bytes of compressed streams, and streams that are too large."""
        if self.escaped is None:
            yield from self._texts()
        half = len(self.raw) // 2
        if self.more and not _BOUNDARY.search(self.raw, half):
            yield OVERSIZE, self._span(0, 1)[0], self.end
        if self.bare:
            yield from self._inflated(0, *_whole(self.raw), bare=True)
        for a, b, whole, out in _streams(self.raw, self.escaped):
            if self.more and not whole and a < half and b == len(self.raw):
                yield OVERSIZE, self._span(a, b)[0], self.end
            yield from self._inflated(a, b, out)

    def _inflated(self, a: int, b: int, out: bytes | None, bare: bool = False):
        """The layer of the stream from ``a`` to ``b``, or layers of overlapping pieces of it, unless it would take too long."""
        span = self._span(a, b)
        if out is not None:
            if out:
                yield Bytes(out, Layer("", whole=span), span[1], bare=_bare(out))
            return
        size = 0
        for piece in _parts(memoryview(self.raw)[a:], {}, bare):
            size += len(piece)
            if size > MAX_INFLATED:
                yield OVERSIZE, *span
                return
        for piece, more in _overlapping(memoryview(self.raw)[a:], bare):
            yield Bytes(piece, Layer("", whole=span), span[1], more=more)


def _whole(raw: bytes) -> tuple[int, bytes | None]:
    """End and bytes of a bare stream: no bytes if it does not end, None if more than can be held."""
    state, out, size = {}, [], 0
    for piece in _parts(memoryview(raw), state, True):
        out.append(piece)
        size += len(piece)
        if size > min(HELD, MAX_INFLATED):
            return len(raw), None
    return state["end"], b"".join(out) if state["whole"] else b""


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans of ``text``, and all spans with those of its decoded layers, each in order."""
    base = sorted(scan(text or ""), key=_key)
    every, seen = set(base), set()
    work = [Layer(text or "").children()]  # depth first, so that one piece of a large stream is held at a time
    while work:
        child = next(work[-1], None)
        if child is None:
            work.pop()
        elif isinstance(child, tuple):
            every.add(child)
        elif (name := child.name()) not in seen:
            seen.add(name)
            every.update(child.spans())
            work.append(child.children())
    return base, sorted(every, key=_key)


def _key(s: Span):
    return s[1], _ORDER[s[0]], s[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``spans``: an array of ``(kind, start, end, decoded)``, ``decoded`` true if only a layer shows it."""
    docs = docs.drop("spans")
    at = docs.columns.index("text")
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("decoded", T.BooleanType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("spans", T.ArrayType(span))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("decoded", pa.bool_())]))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for t in b.column(at):
            base, every = find(t.as_py())
            known = set(base)
            out.append([{"kind": s[0], "start": s[1], "end": s[2], "decoded": s not in known} for s in every])
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(out, kind)], [*b.schema.names, "spans"])

    return arrow_map(docs, run, schema)


def summary(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_decoded)`` in one pass."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [find(t.as_py()) for t in b.column(1)]
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS]
        return pa.RecordBatch.from_arrays(
            [b.column(0), *counts, pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in rows]),
             pa.array([joined(every) for _, every in rows]), pa.array([len(e) - len(b) for b, e in rows], pa.int64())],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_decoded"])

    return arrow_map(docs.select("doc_id", "text"), run,
                     "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_decoded long")


def query(spark, sf_dir):
    return summary(documents(spark, sf_dir))
