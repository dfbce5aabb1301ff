"""Layer kinds of the secret scan, and its memory on layers full of escapes."""

import base64
import bz2
import gzip
import html
import json
import lzma
import random
import tracemalloc
import urllib.parse
import zlib

import pytest

from tessera.llm import secret_scan

SECRET = "token=abcdefgh1234"
B64 = lambda b: base64.b64encode(b).decode()


def deflated(b: bytes) -> bytes:
    d = zlib.compressobj(9, zlib.DEFLATED, -15)
    return d.compress(b) + d.flush()


KINDS = {
    "bytes": "".join(f"\\x{ord(c):02x}" for c in SECRET), "script": "".join(f"%u{ord(c):04X}" for c in SECRET),
    "braced": "".join(f"\\u{{{ord(c):x}}}" for c in SECRET), "long": "".join(f"\\U{ord(c):08x}" for c in SECRET),
    "html": "".join(f"&#{ord(c)};" for c in SECRET), "html16": "".join(f"&#x{ord(c):X};" for c in SECRET),
    "utf16le": B64(SECRET.encode("utf-16-le")), "utf16be": B64(SECRET.encode("utf-16-be")), "utf16bom": B64(SECRET.encode("utf-16")),
    "deflate": B64(deflated(SECRET.encode())), "bz2": B64(bz2.compress(SECRET.encode())), "xz": B64(lzma.compress(SECRET.encode())),
    "deflate twice": B64(deflated(deflated(SECRET.encode() * 3))), "bz2 of xz": B64(bz2.compress(lzma.compress(SECRET.encode()))),
    "gzip of utf16": B64(gzip.compress(SECRET.encode("utf-16"))), "url of bz2": urllib.parse.quote(bz2.compress(SECRET.encode())),
    "bytes of gzip": "".join(f"\\x{b:02x}" for b in gzip.compress(SECRET.encode())), "url of script": urllib.parse.quote("".join(f"%u{ord(c):04x}" for c in SECRET)),
    "html of url": "".join(f"&#{ord(c)};" for c in urllib.parse.quote(SECRET))}


@pytest.mark.parametrize("name", KINDS)
def test_every_kind_is_unwrapped_and_mapped_back(name):
    t = f"héllo {KINDS[name]} bye"
    base, every = secret_scan.find(t)
    assert not base and {k for k, _, _ in every} == {"assign"}
    # short texts are stored as they are by some packers, and then show inside the whole too
    assert any(t[a:b] in KINDS[name] and len(t[a:b]) >= len(KINDS[name]) - 8 for _, a, b in every)
    assert all(t[a:b] in KINDS[name] for _, a, b in every)


def test_mixed_escapes_map_to_their_characters():
    t = "x \\u0074oken\\x3d%61bcdef&#103;h1234 y \\ud83d\\ude00 \\xc3\\xa9 &#99999999; %zz \\u{110000}"
    assert [s for s in secret_scan.find(t)[1]] == [("assign", t.index("\\u0074"), t.index(" y"))]
    text, a, b = secret_scan._read_unicode("\\ud83d\\ude00\\xc3\\xa9\\udc00&#65;")
    assert text == "\U0001f600é�A" and a.tolist() == [0, 12, 20, 26] and b.tolist() == [12, 20, 26, 31]


def test_whole_array_escapes_equal_run_by_run():
    rng = random.Random(5)
    for _ in range(500):
        t = "".join(rng.choices(["%41", "%", "%e9", "%C3%A9", "a", "é", "中", "%4", "41", "\U0001f600", "%%30"], k=rng.randint(0, 12)))
        for read in (secret_scan._read_url, secret_scan._url_bytes):
            got = secret_scan._unescape(t, secret_scan.URL, read)
            free = secret_scan._unescape_placeless(t, secret_scan.URL, read, True)
            parts, at = [], 0
            for m in secret_scan.URL.finditer(t):
                piece, a, b = read(m.group())
                parts += [(c, i, i + 1, False) for i, c in enumerate(t[at:m.start()], at)]
                parts += [(c, m.start() + x, m.start() + y, True) for c, x, y in zip(piece, a.tolist(), b.tolist())]
                at = m.end()
            parts += [(c, i, i + 1, False) for i, c in enumerate(t[at:], at)]
            if not any(p[3] for p in parts):
                assert got is None and free is None
                continue
            assert (got[0], got[1].tolist(), got[2].tolist(), got[3].tolist()) == ("".join(p[0] for p in parts), *([p[i] for p in parts] for i in (1, 2, 3)))
            assert free[0] == got[0] and free[1].tolist() == got[3].tolist()


@pytest.mark.parametrize("unit", ["abc%41 ", "ab\\u0041 ", "a%2541&#65;", "%e9%41é"])
def test_small_documents_with_large_escaped_layers_stay_small(unit):
    text = B64(gzip.compress((unit * (4_000_000 // len(unit)) + SECRET).encode()))
    assert len(text) < 60_000
    tracemalloc.start()
    spans = secret_scan.find(f"x {text}")[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {k for k, _, _ in spans} == {"assign"} and peak < 150e6


def test_an_escaped_secret_in_a_literal_still_shows():
    assert secret_scan.find(json.dumps({"a": SECRET}))[0][0][0] == "assign"
    assert {s[0] for s in secret_scan.find(html.escape('token="') + "&#97;&#98;cdefgh1234")[1]} <= {"assign"}


def test_noise_ends():
    rng = random.Random(7)
    for n in (20, 200, 5_000):
        assert isinstance(secret_scan.find(B64(rng.randbytes(n)))[1], list)
