import base64
import bz2
import gzip
import lzma
import random
import re
import zlib
from urllib.parse import quote

import pytest
import zstandard

from larkspire.llm import secret_scan as S
from tests.llm.helpers import documents, rows

SECRET = "password=hunter2hunter2"
b64 = lambda x: base64.b64encode(x if isinstance(x, bytes) else x.encode()).decode()


def brute(text):
    """The plain kinds by the patterns as they are stated."""
    found = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        found += [(m.start(), 0, m.end(), "assign")] * (len(m[2]) >= 8)
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32)):
        found += [(m.start(), S.ORDER[kind], m.end(), kind) for m in re.finditer(pattern, text) if m.end() - m.start() >= least]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def test_base_matches_brute_force():
    random.seed(6)
    parts = ["password", "PassWd", "api_key", "apikey", "token", "ſecret", "secret", "=", ":", " ", "'", '"', "abcdefgh1", "AKIA", "Z9" * 7, "deadbeef" * 4, "é", "0f", "\n", "x"]
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randrange(14)))
        assert S.scan(text)[0] == brute(text)


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_layers_in_layers(depth):
    random.seed(depth)
    layers = [
        lambda t: b64(t),
        lambda t: b64(t).rstrip("="),
        lambda t: base64.urlsafe_b64encode(t.encode()).decode(),
        lambda t: quote(t, safe=""),
        lambda t: "".join(f"%{b:02X}" for b in t.encode()),
        lambda t: "".join(f"\\u{ord(c):04x}" for c in t),
        lambda t: "".join(f"\\x{ord(c):02x}" for c in t),
        lambda t: b64(gzip.compress(t.encode())),
        lambda t: b64(zlib.compress(t.encode())),
        lambda t: b64(bz2.compress(t.encode())),
        lambda t: b64(lzma.compress(t.encode())),
        lambda t: b64(zstandard.compress(t.encode())),
    ]
    for _ in range(60):
        text = SECRET
        for _ in range(depth):
            if len(text) < 5000:
                text = random.choice(layers)(text)
        whole = f"é before {text} after"
        base, spans = S.scan(whole)
        assert not [m for m in base if m[2] != "hex"] or text == SECRET or "password" in text
        assert any(k == "assign" and 9 <= a < b <= 9 + len(text) for a, b, k in spans), text


def test_spans_map_to_the_original():
    assert S.scan("a %70assword=hunter2hunter2 b")[1] == [(2, 27, "assign")]
    assert S.scan("x=%20&" + SECRET)[1] == [(6, 6 + len(SECRET), "assign")]
    inner = b64("zzz " + SECRET)
    ((a, b, _),) = S.scan(f"go {inner} on")[1]
    assert 3 <= a <= 3 + 4 * 4 // 3 + 1 and b <= 3 + len(inner)


@pytest.mark.parametrize("text", ['{"password": "\\u0068unter2hunter2"}', "password = %68unter2hunter2", '"password":"%68unter2hunter2"', "%70assword = hunter2hunter2", r"\x70assword: '%68unter2hunter2'", 'token: "api_key":"\\u0068unter2hunter2"'])
def test_key_and_value_apart(text):
    whole = f"é {text} z"
    assert any(k == "assign" and whole[b - 4 : b] == "ter2" for _, b, k in S.scan(whole)[1])


COMPRESS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress]


@pytest.mark.parametrize("outer", COMPRESS)
@pytest.mark.parametrize("inner", COMPRESS)
def test_compressed_layers_unwrap_to_a_fixpoint(outer, inner):
    secret = f"caf\xe9 {SECRET}".encode("latin-1")
    found = lambda data: {k for _, _, k in S.scan(f"a {b64(data)} b")[1]} == {"assign"}
    assert found(outer(inner(secret))) and found(outer(outer(inner(SECRET.encode()))))
    assert found(outer(b"first") + outer(inner(secret)[:0]) + outer(secret))
    assert found(outer(secret) + b"trailing bytes")
    assert found(secret) and found(b"\xff\xfe/" + SECRET.encode())


@pytest.mark.parametrize("width", [19, 40, 64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_wrapped_base64(width, end):
    random.seed(width)
    noise = " ".join(str(random.random()) for _ in range(40))
    for lead in range(90):
        for data in (f"{noise[:lead]} {SECRET}".encode(), gzip.compress(f"{noise} {SECRET} {noise[:lead]}".encode())):
            text = b64(data)
            lines = end.join(text[i : i + width] for i in range(0, len(text), width))
            whole = f"é data{end}{lines}{end}more words"
            at = len(f"é data{end}")
            assert any(k == "assign" and at <= a < b <= at + len(lines) for a, b, k in S.scan(whole)[1]), (lead, whole)
            wrapped = "".join(f"%{b:02x}" for b in whole.encode())
            assert [k for _, _, k in S.scan(wrapped)[1]].count("assign") >= 1


@pytest.mark.parametrize("compress", COMPRESS)
def test_long_layers_are_scanned_whole_in_bounded_pieces(compress, monkeypatch):
    monkeypatch.setattr(S, "LAYER_BYTES", 1 << 10)
    texts, made = [], S.Layer.__init__
    monkeypatch.setattr(S.Layer, "__init__", lambda self, text, *a, **k: (texts.append(len(text)), made(self, text, *a, **k))[1])
    for lead in (0, 1, 500, 1000, 1015, 1024, 1500, 3001, 200_000):
        data = ("é" * (lead // 2) + "x" * (lead % 2) + " " + SECRET + " é" * 2000).encode()
        whole = b64(compress(data))
        texts.clear()
        assert S.scan(whole)[1] == [(0, len(whole), "assign")], lead
        assert max(texts[1:]) <= 1 << 10
        assert S.scan(b64(compress(compress(data))))[1]
    assert S.scan(b64(compress(b"z " * 3000 + b64(SECRET).encode() + b" z" * 3000)))[1]


def test_damage_keeps_what_is_before_it():
    random.seed(2)
    data = zlib.compress((SECRET + " ").encode() + random.randbytes(5000).hex().replace("0", "g").encode())
    assert ("assign" in [k for _, _, k in S.scan(b64(data[:-900]))[1]])
    plain = b64(b"x^ " + SECRET.encode())  # begins as zlib data does
    assert S.scan(plain)[1] == [(4, len(plain.rstrip("=")), "assign")]


def test_cycles_end():
    text = "aGVsbG8gd29ybGQgaGVsbG8gd29ybGQ=" * 3 + "%25%32%35%2525"
    assert S.scan(text)[1] == []


def test_query(spark):
    texts = [SECRET, None, "", b64(SECRET), "AKIA" + "Q" * 12, "f" * 40, SECRET]
    out = S.scan_secrets(documents(spark, texts + [(None, SECRET)]).selectExpr("*", "1 AS spans", "2 AS n_hex"))
    got = rows(out, "doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans")
    plain = "assign:0:23"
    want = [(0, 1, 0, 0, plain, plain), (1, 0, 0, 0, "", ""), (2, 0, 0, 0, "", ""), (3, 0, 0, 0, "", "assign:0:31"), (4, 0, 1, 0, "access:0:16", "access:0:16"), (5, 0, 0, 1, "hex:0:40", "hex:0:40"), (6, 1, 0, 0, plain, plain), (None, 1, 0, 0, plain, plain)]
    assert got == sorted(want, key=repr)
    assert S.scan_secrets(documents(spark, [])).count() == 0
