"""Secret scans that look through URL, Unicode, base64 and compressed layers."""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import apart, documents, sliced

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|\\U([0-9A-Fa-f]{8})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
_LETTER = "[A-Za-z0-9+/_-]"
_LINE_END = re.compile(r"[ \t]*+(?:\r\n?|\n|\\r\\n|\\n)[ \t]*+")
_BASE64 = re.compile(_LETTER + "{16,}={0,2}")
_BASE64_PART = re.compile(r"[A-Za-z0-9+]{16,}={0,2}")
#: Runs of base64 letters that only line ends break, also those written as escapes; short ones are left out later.
_BASE64_RUN = re.compile(rf"(?<!{_LETTER})(?:{_LETTER}{{16,}}+|{_LETTER}{{1,15}}+(?={_LINE_END.pattern}{_LETTER}))(?:{_LINE_END.pattern}{_LETTER}++)*+={{0,2}}")
_MAGIC = re.compile(rb"\x1f\x8b\x08|BZh[1-9]1AY&SY|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
#: Bytes that are no text are read on only if they hold the beginning of a secret or of a further layer.
_HINT = re.compile(rb"passw|secret|token|api_?key|akia[a-z0-9]{16}|[0-9a-f]{24}|%[0-9a-f]{2}|\\[ux][0-9a-f]|&#x?[0-9a-f]|[a-z0-9+/_-]{8}", re.I)
#: Streamed chunks, what neighbours share, and how often compressed data in compressed data is streamed.
_CHUNK, _OVERLAP, _LEVELS = 1 << 20, 1 << 16, 64
_BROKEN = (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError)
_TEXT_BYTES = bytes(range(32, 127)) + b"\t\n\r\f\v"


def matches(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain patterns, in code points, leftmost and non-overlapping per kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return found


@dataclass
class Layer:
    """A text and the layer it was decoded from; the document itself has none. Not all layers are readable: some are bytes as Latin-1."""

    text: str
    parent: Layer | None = None
    readable: bool = True

    def above(self, start: int, end: int) -> tuple[int, int]:
        """The part of the parent's text that characters start to end - 1 stem from."""
        raise NotImplementedError

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The part of the document that these characters stem from."""
        layer = self
        while layer.parent is not None:
            start, end = layer.above(start, end)
            layer = layer.parent
        return start, end


@dataclass
class Unpacked(Layer):
    """All of it stems from one part of the parent. Of data too large to be held there is no text, only the kinds found in it."""

    low: int = 0
    high: int = 0
    kinds: frozenset[str] = frozenset()

    def above(self, start: int, end: int) -> tuple[int, int]:
        return self.low, self.high


@dataclass
class Substituted(Layer):
    """Pieces of the parent: from at[i] on, characters stem from lows[i] to highs[i] as a whole, or one by one where highs[i] is None."""

    at: list[int] = field(default_factory=list)
    lows: list[int] = field(default_factory=list)
    highs: list[int | None] = field(default_factory=list)

    def above(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, max(start, end - 1)) - 1
        low = self.lows[i] + (start - self.at[i] if self.highs[i] is None else 0)
        return low, self.lows[j] + end - self.at[j] if self.highs[j] is None else self.highs[j]


@dataclass
class Decoded(Layer):
    """Base64 letters of a run from letter first on: byte b stems from its letters 4b/3 to 4(b+1)/3."""

    run: Run | None = None
    first: int = 0
    sizes: list[int] | None = None

    def above(self, start: int, end: int) -> tuple[int, int]:
        if self.readable and not self.text.isascii():
            if self.sizes is None:
                self.sizes = [0, *accumulate(len(c.encode()) for c in self.text)]
            start, end = self.sizes[start], self.sizes[end]
        return self.run.place(self.first + start * 4 // 3, self.first - (-end * 4 // 3))


@dataclass
class Run:
    """The base64 letters of text[low:high] without line ends, and where each line begins: its first letter and its place."""

    letters: str
    at: list[int]
    places: list[int]
    high: int

    @classmethod
    def of(cls, text: str, low: int, high: int) -> Run:
        parts, at, places, n = [], [], [], 0
        for m in [*_LINE_END.finditer(text, low, high), None]:
            part = text[low : m.start() if m else high]
            parts.append(part)
            at.append(n)
            places.append(low)
            n += len(part)
            low = m.end() if m else high
        return cls("".join(parts).rstrip("=").replace("-", "+").replace("_", "/"), at, places, high)

    def place(self, first: int, after: int) -> tuple[int, int]:
        """The part of the text that holds letters first to after - 1."""
        i, j = bisect_right(self.at, first) - 1, bisect_right(self.at, max(first, after - 1)) - 1
        return self.places[i] + first - self.at[i], min(self.high, self.places[j] + after - self.at[j])

    def data(self, first: int = 0) -> bytes:
        token = self.letters[first:]
        if len(token) % 4 == 1:
            token = token[:-1]
        return base64.b64decode(token + "=" * (-len(token) % 4))


def _substituted(layer: Layer, pattern: re.Pattern, decoded) -> Layer | None:
    """The layer with every match decoded; every character keeps its place."""
    parts, starts, lows, highs, at, n = [], [], [], [], 0, 0

    def put(text: str, low: int, high: int | None) -> None:
        nonlocal n
        if text:
            parts.append(text)
            starts.append(n)
            lows.append(low)
            highs.append(high)
            n += len(text)

    for m in pattern.finditer(layer.text):
        pieces = decoded(m)
        if pieces is None:
            continue
        put(layer.text[at : m.start()], at, None)
        for low, high, char in pieces:
            put(char, low, high)
        at = m.end()
    if not at:
        return None
    put(layer.text[at:], at, None)
    return Substituted("".join(parts), layer, layer.readable, starts, lows, highs)


def _url_pieces(m: re.Match) -> list[tuple[int, int, str]]:
    """Each UTF-8 character of a percent-encoded run with the place of its bytes; a stray byte is Latin-1."""
    data = bytes.fromhex(m[0].replace("%", ""))
    out, i = [], 0
    while i < len(data):
        for size in (1, 2, 3, 4):
            try:
                char = data[i : i + size].decode()
                break
            except UnicodeDecodeError:
                continue
        else:
            size, char = 1, chr(data[i])
        out.append((m.start() + 3 * i, m.start() + 3 * (i + size), char))
        i += size
    return out


def _unicode_pieces(m: re.Match) -> list[tuple[int, int, str]] | None:
    code = int(m[5]) if m[5] else int(next(g for g in m.groups() if g), 16)
    if code > 0x10FFFF or 0xD800 <= code < 0xE000:
        return None
    return [(m.start(), m.end(), chr(code))]


def _opened(data: bytes | memoryview):
    """A decompressor for data that begins with a compressed member."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 2 and (data[0] << 8 | data[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _chunks(packed: Iterator[bytes | memoryview]) -> Iterator[bytes]:
    """What compressed data expands to, member after member, as chunks; fails where the data is broken."""
    held = next(packed, b"")
    while True:
        while len(held) < 6 and (more := next(packed, None)) is not None:
            held = bytes(held) + more
        stream = _opened(held)
        if stream is None:
            return
        while True:
            out = stream.decompress(held, _CHUNK)
            held = getattr(stream, "unconsumed_tail", b"")
            if out:
                yield out
            if stream.eof:
                break
            if getattr(stream, "needs_input", not held and len(out) < _CHUNK) and (held := next(packed, None)) is None:
                return
        held = stream.unused_data.lstrip(b"\0")


def _expanded(data: bytes | memoryview, limit: int) -> tuple[bytes, bool] | None:
    """Decompressed data up to a broken place, and whether there is more than limit of it; None if there is none."""
    out, size = [], 0
    try:
        for chunk in _chunks(iter([data])):
            out.append(chunk)
            size += len(chunk)
            if size > limit:
                return b"", True
    except _BROKEN:
        pass
    return (b"".join(out), False) if out else None


def _readable(data: bytes) -> str | None:
    """Text if the bytes are UTF-8 and hold no more than a few control characters."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    if text.isascii() and len(data.translate(None, _TEXT_BYTES)) > 0.1 * len(data):
        return None
    return text if text and sum(c < " " for c in text) <= 0.1 * len(text) + text.count("\n") + text.count("\t") else None


def _text(data: bytes) -> tuple[str, bool] | None:
    """Bytes as text, and whether they are readable. Others are Latin-1, None if nothing in them may be a secret or lead to one."""
    text = _readable(data)
    if text is not None:
        return text, True
    return (data.decode("latin-1"), False) if _HINT.search(data) else None


def _unpacked(layer: Layer, data: bytes | memoryview, low: int, high: int, limit: int) -> Layer | None:
    """The layer of compressed data that stands in text[low:high], through any further compression in it."""
    seen = set()
    while (inner := _expanded(data, limit)) is not None:
        if inner[1]:
            return Unpacked("", layer, False, low, high, _streamed(data, limit))
        if inner[0] in seen:
            break
        data = inner[0]
        seen.add(data)
    found = _text(data) if seen else None
    return Unpacked(found[0], layer, found[1], low, high) if found else None


def _streamed(data: bytes | memoryview, limit: int) -> frozenset[str]:
    """The kinds of secrets in what data expands to, read as overlapping chunks; equal ones are read once."""
    kinds, seen, chunks, tail = set(), set(), _chunks(iter([data])), b""
    try:
        for _ in range(_LEVELS):
            first = next(chunks, b"")
            chunks = chain([first], chunks)
            if _expanded(first, 0) is None:
                break
            chunks = _chunks(chunks)
        for chunk in chunks:
            window = tail + chunk
            tail = window[-_OVERLAP:]
            mark = hashlib.blake2b(window, digest_size=16).digest()
            if mark not in seen:
                seen.add(mark)
                if found := _text(window):
                    kinds.update(kind for _, _, kind in scan(found[0], limit)[1])
            if len(kinds) == len(KINDS):
                break
    except _BROKEN:
        pass
    return frozenset(kinds)


def _packed_url_layers(layer: Layer, limit: int) -> Iterator[Layer]:
    """Percent-encoded compressed data."""
    for m in _URL.finditer(layer.text):
        found = _unpacked(layer, bytes.fromhex(m[0].replace("%", "")), *m.span(), limit)
        if found is not None:
            yield found


def _base64_layers(layer: Layer, limit: int) -> Iterator[Layer]:
    """What each run of base64 letters decodes to.

    A run that is text as a whole is one layer. Of others, lines and the parts
    between the letters that paths use too are taken where they are text, and the
    run is read at its four alignments, one of which fits any token in it; these
    need not be text, and compressed data may begin at any byte of them.
    """
    for m in _BASE64_RUN.finditer(layer.text):
        run = Run.of(layer.text, *m.span())
        if len(run.letters) < 16:
            continue
        whole = _whole(layer, m.span(), limit)
        if whole is not None:
            yield whole
            if isinstance(whole, Decoded):
                continue
        else:
            for line in _BASE64.finditer(layer.text, *m.span()):
                found = _whole(layer, line.span(), limit) if line.span() != m.span() else None
                if found is not None:
                    yield found
                    continue
                for part in _BASE64_PART.finditer(layer.text, *line.span()):
                    found = _whole(layer, part.span(), limit) if part.span() != line.span() else None
                    if found is not None:
                        yield found
        for first in range(min(4, len(run.letters) - 1)):
            yield from _aligned(layer, run, first, limit)


def _whole(layer: Layer, span: tuple[int, int], limit: int) -> Layer | None:
    """The layer of one token if it holds text or compressed data."""
    run = Run.of(layer.text, *span)
    raw = run.data()
    found = _unpacked(layer, raw, *span, limit)
    if found is not None:
        return found
    text = _readable(raw)
    return None if text is None else Decoded(text, layer, True, run)


def _aligned(layer: Layer, run: Run, first: int, limit: int) -> Iterator[Layer]:
    """A run read from letter first on, whatever its bytes are, and the compressed data in it."""
    raw = run.data(first)
    if found := _text(raw):
        yield Decoded(found[0], layer, found[1], run, first)
    for m in _MAGIC.finditer(raw):
        if first or m.start():
            inner = _unpacked(layer, memoryview(raw)[m.start() :], *run.place(first + m.start() * 4 // 3, len(run.letters)), limit)
            if inner is not None:
                yield inner


def scan(text: str, limit: int = 1 << 26) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]], int]:
    """Base spans, all spans, and the number of decoded layers of one document: those that are text or hold a secret.

    A worklist holds the layers still to be read. Each is scanned, its spans are
    mapped to the document, and what decodes in it joins the list, until nothing
    new appears. A layer whose text was seen at the same place before is left
    out, so cycles end. limit bounds the bytes that one compressed piece may
    expand to and be held; a larger one is read as a stream of overlapping chunks
    and is no layer. Its secrets span the whole piece.
    """
    base = matches(text)
    spans, layers = set(base), 0
    work, seen = deque([Layer(text)]), set()
    while work:
        layer = work.popleft()
        if layer.parent is not None:
            found = matches(layer.text)
            spans.update((*layer.span(a, b), kind) for a, b, kind in found)
            layers += layer.readable or bool(found)
            if isinstance(layer, Unpacked):
                spans.update((*layer.span(0, 0), kind) for kind in layer.kinds)
        after = []
        if "%" in layer.text:
            after.append(_substituted(layer, _URL, _url_pieces))
            after += _packed_url_layers(layer, limit)
        if "\\" in layer.text or "&#" in layer.text:
            after.append(_substituted(layer, _UNICODE, _unicode_pieces))
        after += _base64_layers(layer, limit)
        for inner in after:
            if inner is None:
                continue
            place = inner.span(0, len(inner.text)) if inner.text or isinstance(inner, Unpacked) else (0, 0)
            mark = (place, hashlib.blake2b(inner.text.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            if mark not in seen:
                seen.add(mark)
                work.append(inner)
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    return sorted(base, key=order), sorted(spans, key=order), layers


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans, layers) per document, base and spans as arrays of (kind, start, end).

    Positions are code points of the whole text, ends exclusive; spans holds the
    base ones and those found in decoded layers, mapped to the part of the
    document they stem from. A null or empty text has none. Every row is
    answered, repeated rows each; a null doc_id stays null.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    made = lambda spans: [{"kind": k, "start": a, "end": b} for a, b, k in spans]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [scan(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([made(f[0]) for f in found], pa.list_(span)),
                    pa.array([made(f[1]) for f in found], pa.list_(span)),
                    pa.array([f[2] for f in found], pa.int32()),
                ],
                ["doc_id", "base", "spans", "layers"],
            )

    one = "array<struct<kind:string,start:int,end:int>>"
    return documents(docs).mapInArrow(work, f"doc_id bigint, base {one}, spans {one}, layers int")


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts per kind and the joined spans of find_secrets."""
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(k) for k in KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), "layers",
    )


@apart
def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """docs with every span found, overlapping ones merged, replaced by mask; n_chars follows.

    All rows and columns stay. Rows whose text has no span, null texts too, stay as they are.
    """
    others = [c for c in docs.columns if c != "text"]

    def clean(text: str | None) -> str | None:
        spans = scan(text)[1] if text else []
        if not spans:
            return text
        out, at = [], 0
        for start, end, _ in spans:
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            at = batch.schema.get_field_index("text")
            before = batch.column(at).to_pylist()
            texts = [clean(t) for t in before]
            masked = pa.array([a != b for a, b in zip(before, texts)], pa.bool_())
            yield batch.set_column(at, pa.field("text", pa.string()), pa.array(texts, pa.string())).append_column("masked", masked)

    rows = docs.select(*others, F.col("text").cast("string").alias("text"))
    done = rows.mapInArrow(work, rows.withColumn("masked", F.lit(True)).schema)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col("masked"), length).otherwise(F.col("n_chars")))
    return done.select(docs.columns)
