"""Secret scan with a recursive decoding worklist.

A text is scanned for secrets; then every encoded stretch in it (URL escapes, Unicode escapes, base64, also wrapped into lines,
and compressed data inside base64) is decoded into a layer, which is scanned and searched for encoded stretches in turn until nothing new
appears. A layer that was seen before at the same place is not entered again, so cycles end. Every layer keeps, for each of
its characters, the span of the original text that it came from, so a secret found in it is reported at that span.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import gzip
import lzma
import re
import zlib
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import map_chunks

KINDS = ("assign", "access", "hex")
#: Bytes read from a stream at once.
READ_BYTES = 1 << 16
ORDER = {k: i for i, k in enumerate(KINDS)}
#: Decompressed data is scanned in pieces of so many bytes, each half of which the next piece has, too; this bounds memory, not
#: what is scanned. Only an encoded stretch in decompressed data that is longer than half of it may be cut.
LAYER_BYTES = 32 << 20
#: The shortest secret has 14 characters, which need 19 characters of base64.
BASE64_CHARS = 19

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
URL = re.compile(r"[^\s\"'<>]+")
URL_BYTES = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"[^\s<>]+")
ESCAPE_UNITS = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2})+")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % BASE64_CHARS)
#: Base64 wrapped into lines; the padding may stand on a line of its own.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:\r?\n[A-Za-z0-9+/_-]+)+(?:(?:\r?\n)?={1,2})?" % BASE64_CHARS)
LINE = re.compile(r"[^\r\n]+")
#: What bytes must hold, read as Latin-1, to have a secret or an encoded stretch in them.
CARRIER = re.compile(rb"(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{32}|%%[0-9A-Fa-f]{2}|\\[ux]|[A-Za-z0-9+/_-]{%d}" % BASE64_CHARS)


def base_matches(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the secrets that stand plainly in text."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


class Layer:
    """Decoded text; character i came from origin[i] of the original, or all of it from one span."""

    __slots__ = ("text", "starts", "ends", "span")

    def __init__(self, text, starts=None, ends=None, span=None):
        self.text, self.starts, self.ends, self.span = text, starts, ends, span

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.span:
            return self.span
        if self.starts is None:
            return start, end
        return self.starts[start], self.ends[end - 1]


class _Source:
    """Pieces of bytes as a file to read from."""

    def __init__(self, head: bytes, more: Iterator[bytes]):
        self.rest, self.more = memoryview(head), more

    def read(self, n: int = READ_BYTES) -> bytes:
        found = bytearray()
        while len(found) < n:
            if not self.rest and (piece := next(self.more, None)) is None:
                break
            if not self.rest:
                self.rest = memoryview(piece)
            take = n - len(found)
            found += self.rest[:take]
            self.rest = self.rest[take:]
        return bytes(found)


def _zlib_pieces(source: _Source) -> Iterator[bytes]:
    data, stream = source.read(), zlib.decompressobj()
    while data:
        piece = stream.decompress(data, READ_BYTES)
        if piece:
            yield piece
        data = stream.unconsumed_tail or (stream.unused_data if stream.eof else b"")
        if stream.eof:
            data, stream = data or source.read(), zlib.decompressobj()
            if len(data) < 2:
                data += source.read()
            if not _is_zlib(data):
                return
        data = data or source.read()
        if not data:
            yield from filter(None, (stream.flush(),))
            raise EOFError


def _is_zlib(data: bytes) -> bool:
    return len(data) > 2 and data[0] & 15 == 8 and (data[0] * 256 + data[1]) % 31 == 0


class _Inflated:
    """The content of compressed data, all its streams, in pieces up to where it ends or is damaged."""

    def __init__(self, head: bytes, source: _Source):
        self.damaged, self.pieces = False, None
        if head[:2] == b"\x1f\x8b":
            self.pieces = self.read(gzip.GzipFile(fileobj=source))
        elif head[:3] == b"BZh":
            self.pieces = self.read(bz2.BZ2File(source))
        elif head[:6] == b"\xfd7zXZ\x00":
            self.pieces = self.read(lzma.LZMAFile(source))
        elif head[:4] == b"\x28\xb5\x2f\xfd":
            import zstandard

            self.pieces = self.read(zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True))
        elif _is_zlib(head):
            self.pieces = _zlib_pieces(source)

    @staticmethod
    def read(file) -> Iterator[bytes]:
        while piece := file.read1(READ_BYTES):
            yield piece

    def __iter__(self) -> _Inflated:
        return self

    def __next__(self) -> bytes:
        try:
            return next(self.pieces)
        except StopIteration:
            raise
        except Exception:  # damaged data of any of these formats ends there
            self.damaged = True
            raise StopIteration from None


def _take(pieces: Iterator[bytes]) -> bytes:
    """The next LAYER_BYTES, or what there is."""
    found, size = [], 0
    while size < LAYER_BYTES and (piece := next(pieces, None)) is not None:
        found.append(piece)
        size += len(piece)
    return b"".join(found)


def _unwrapped(head: bytes, more: Iterator[bytes], damage: list[bool], seen: set[bytes]) -> Iterator[str]:
    """The texts inside compressed data, unwrapped until nothing is compressed; head is its start, more what follows.

    Nothing comes of data without a known format. Damaged data gives what comes before the damage, and damage is noted.
    """
    key = sha256(head).digest()
    inflated = _Inflated(head, _Source(head, more))
    if inflated.pieces is None or key in seen:
        return
    seen.add(key)
    first = _take(inflated)
    if first:
        deeper, inner = False, []
        for text in _unwrapped(first, inflated, inner, seen):
            deeper = True
            yield text
        if not deeper or inner:
            yield from _texts(first, inflated)
    if inflated.damaged or not first:
        damage.append(True)


def _texts(head: bytes, more: Iterator[bytes]) -> Iterator[str]:
    """The bytes as text in pieces that overlap by half; characters cut at a piece's ends are whole in its neighbour."""
    source = _Source(head, more)
    data = new = source.read(LAYER_BYTES)
    while new:
        yield data.decode(errors="replace")
        new = source.read(LAYER_BYTES // 2)
        data = data[len(data) - LAYER_BYTES // 2 :] + new if new else b""


def _pieces(layer: Layer, start: int, end: int, pattern: re.Pattern, decode) -> Layer | None:
    """A layer of text[start:end] with each match of pattern decoded; decode returns characters with their source offsets."""
    text, out, starts, ends, at = layer.text[start:end], [], [], [], 0

    def plain(a: int, b: int) -> None:
        out.append(text[a:b])
        if layer.starts is not None:
            starts.extend(layer.starts[start + a : start + b]), ends.extend(layer.ends[start + a : start + b])
        elif not layer.span:
            starts.extend(range(start + a, start + b)), ends.extend(range(start + a + 1, start + b + 1))

    for m in pattern.finditer(text):
        decoded = decode(m[0])
        plain(at, m.start())
        for char, a, b in decoded:
            out.append(char)
            if not layer.span:
                s, e = layer.origin(start + m.start() + a, start + m.start() + b)
                starts.append(s), ends.append(e)
        at = m.end()
    plain(at, len(text))
    made = "".join(out)
    if not made or made == text:
        return None
    return Layer(made, span=layer.span) if layer.span else Layer(made, starts, ends)


def _decoded(layer: Layer, around: re.Pattern, pattern: re.Pattern, decode) -> Iterator[Layer]:
    """All matches of pattern decoded in one layer, as a key and its value may be blanks and quotes apart, and each stretch by itself."""
    text = layer.text
    if not pattern.search(text):
        return
    if whole := _pieces(layer, 0, len(text), pattern, decode):
        yield whole
    for m in around.finditer(text):
        if m.end() - m.start() < len(text) and pattern.search(text, m.start(), m.end()) and (x := _pieces(layer, m.start(), m.end(), pattern, decode)):
            yield x


def _url(run: str) -> list[tuple[str, int, int]]:
    data, out, i = bytes.fromhex(run.replace("%", "")), [], 0
    while i < len(data):
        width = 1 if data[i] < 0x80 else 2 if data[i] < 0xE0 else 3 if data[i] < 0xF0 else 4
        try:
            char = data[i : i + width].decode()
        except UnicodeDecodeError:
            width, char = 1, chr(data[i])
        out.append((char, 3 * i, 3 * (i + width)))
        i += width
    return out


def _units(run: str) -> list[tuple[str, int, int]]:
    out, i = [], 0
    while i < len(run):
        width = 6 if run[i + 1] == "u" else 4
        code, end = int(run[i + 2 : i + width], 16), i + width
        if 0xD800 <= code < 0xDC00 and run[end : end + 2] == "\\u" and 0xDC00 <= (low := int(run[end + 2 : end + 6], 16)) < 0xE000:
            code, end = 0x10000 + ((code - 0xD800) << 10) + low - 0xDC00, end + 6
        out.append((chr(code) if not 0xD800 <= code < 0xE000 else "�", i, end))
        i = end
    return out


def _base64(layer: Layer, start: int, run: str) -> Iterator[Layer]:
    """Layers of one stretch of base64 letters, and unless they are text without errors, of its parts between path separators."""
    body = run.rstrip("=")
    clean = False
    if len(body) % 4 != 1:
        try:
            data = base64.b64decode(body.translate({45: 43, 95: 47}) + "=" * (-len(body) % 4))
        except binascii.Error:
            data = b""
        damage: list[bool] = []
        for text in _unwrapped(data, iter(()), damage, set()):
            clean = True
            yield Layer(text, span=layer.origin(start, start + len(run)))
        if not clean or damage:
            clean = False
            try:
                text = data.decode()
                clean = bool(text)
            except UnicodeDecodeError:
                text = data.decode("latin-1") if CARRIER.search(data) else ""
            if text and layer.span:
                yield Layer(text, span=layer.span)
            elif text:
                starts, ends, at = [], [], 0
                for char in text:
                    n = len(char.encode()) if clean else 1
                    s, _ = layer.origin(start + at * 4 // 3, start + at * 4 // 3 + 1)
                    last = min((at + n) * 8 // 6 + ((at + n) * 8 % 6 > 0), len(body))
                    starts.append(s), ends.append(layer.origin(start + last - 1, start + last)[1])
                    at += n
                yield Layer(text, starts, ends)
    if not clean and re.search("[/_-]", body):
        for m in re.finditer(r"[A-Za-z0-9+]{%d,}" % BASE64_CHARS, body):
            if m[0] != body:
                yield from _base64(layer, start + m.start(), m[0])


def _blocks(lines: list[tuple[int, int]], text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of lines of one width, alone and with the shorter line after them, which may also be a word of what follows."""
    i = 0
    while i < len(lines):
        width, j = lines[i][1] - lines[i][0], i + 1
        while j < len(lines) and lines[j][1] - lines[j][0] == width:
            j += 1
        if width >= BASE64_CHARS:
            if j - i > 1:
                yield lines[i:j]
            last = j
            if last < len(lines) and len(text[slice(*lines[last])].rstrip("=")) <= width:
                last += 1
                if last < len(lines) and text[lines[last][0]] == "=":
                    last += 1
            if last > j:
                yield lines[i:last]
        i = j


def _joined(layer: Layer, lines: list[tuple[int, int]]) -> Layer:
    """The lines without the breaks between them."""
    made = "".join(layer.text[a:b] for a, b in lines)
    if layer.span:
        return Layer(made, span=layer.span)
    places = [x for a, b in lines for x in range(a, b)]
    if layer.starts is None:
        return Layer(made, places, [x + 1 for x in places])
    return Layer(made, [layer.starts[x] for x in places], [layer.ends[x] for x in places])


def layers_of(layer: Layer) -> Iterator[Layer]:
    text = layer.text
    if "%" in text:
        yield from _decoded(layer, URL, URL_BYTES, _url)
    if "\\" in text:
        yield from _decoded(layer, ESCAPE, ESCAPE_UNITS, _units)
    for m in BASE64.finditer(text):
        yield from _base64(layer, m.start(), m[0])
    for m in WRAPPED.finditer(text):
        for lines in _blocks([x.span() for x in LINE.finditer(text, m.start(), m.end())], text):
            joined = _joined(layer, lines)
            yield from _base64(joined, 0, joined.text)


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The plain secrets, and all secrets with those of decoded layers, each sorted by start, then kind."""
    by = lambda x: (x[0], ORDER[x[2]], x[1])
    base = sorted(base_matches(text), key=by)
    spans, work, seen = set(base), [layers_of(Layer(text))], set()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        key = (layer.origin(0, len(layer.text)), sha256(layer.text.encode(errors="replace")).digest())
        if key not in seen:
            seen.add(key)
            spans.update((*layer.origin(a, b), kind) for a, b, kind in base_matches(layer.text))
            work.append(layers_of(layer))
    return base, sorted(spans, key=by)


def shown(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan_secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_spans, spans (kind:start:end, comma-joined).

    Places count code points, ends are exclusive. A null text is the empty text, without secrets. Repeated rows are each
    scanned. An empty table gives an empty result. Only the two named columns are read.
    """

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        rows = [scan(x or "") for x in t.column(1).to_pylist()]
        counts = [pa.array([sum(m[2] == k for m in base) for base, _ in rows], pa.int64()) for k in KINDS]
        return pa.record_batch([t.column(0), *counts, pa.array([shown(b) for b, _ in rows], pa.string()), pa.array([shown(s) for _, s in rows], pa.string())], names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return map_chunks(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")), run, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_spans string, spans string")
