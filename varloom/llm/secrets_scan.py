"""Secret scans: a recursive decoding worklist with span mapping.

A text is the first layer of a worklist.  Each layer is scanned for secrets,
then unwrapped: an escape that was escaped again nine times or more is taken back
to one escape in one step, other percent and Unicode escapes are decoded in place within
the layer, base64 words are decoded into layers of their own, and gzip or zlib
data in them are unpacked.  Lines of base64 with single line breaks between them
are also joined to words: all lines together, and each stretch of lines of equal
length with the shorter line that ends it, as text around wrapped base64 may look
like base64, too.  New layers join the list until none is left; a layer
whose content was seen before in the text is not taken again, so cycles end, and
every layer is shorter than what it came from or unpacked under a bound.

Each layer carries, per character, the code points of the *original* text it
stems from; a secret found at any depth is reported as the smallest original
range that holds it.  Base spans are those of depth 0.

Packed data are unpacked as often as they are packed, until content comes back
that was there before; of damaged or cut off data what comes before the damage is
a layer, beside the data as they are.  A layer need not be text throughout: bytes that are not
UTF-8, escaped or coded, and escapes of no character stand in it as single signs.  An unpacked layer of more than MOST_UNPACKED
bytes is a stream that is scanned in windows of that size, OVERLAP bytes of each
again in the next one, so only a coded word longer than that may be cut.

Cases: a null text is an empty one; texts of any length are whole; equal spans
of several layers count once; an empty table gives an empty one;
other input columns are not looked at.
"""

from __future__ import annotations

import binascii
import hashlib
import itertools
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carry, slices

KINDS = ("assign", "access", "hex")
#: Bytes of an unpacked layer that are held at once, and of them those seen again in the next window.
MOST_UNPACKED, OVERLAP = 16 << 20, 4 << 20

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# a run that is long enough starts where the run starts, so the least length can stand in the pattern
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
# signs escaped again and again: one level a layer would take as many layers as there are levels
_NESTED = re.compile(r"%(?:25){9,}|\\(?:u005[cC]|x5[cC]|U0000005[cC]|u\{0{0,4}5[cC]\}){9,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPED = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|\\u\{[0-9A-Fa-f]{1,6}\})+")
_ONE_ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# the rest of a base64 line and the lines after it; it starts where a line's last run starts
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n|\n|\r)[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
# what one alphabet alone makes of a word that has signs of the other: a name and a word joined by a sign
_ONE_ALPHABET = ((re.compile(r"[-_]"), re.compile(r"[A-Za-z0-9+/]{16,}={0,2}")), (re.compile(r"[+/]"), re.compile(r"[A-Za-z0-9_-]{16,}={0,2}")))
_PLAIN = re.compile(rb"[\t\n\r\x20-\x7E\x80-\xFF]*\Z")
# no secret, plain or wrapped, is shorter
_READABLE = re.compile(rb"[\t\n\r\x20-\x7E]{16}")


class Layer:
    """A text and, per character, the original range it stems from (None for
    the original itself)."""

    __slots__ = ("depth", "first", "last", "text")

    def __init__(self, text: str, first: np.ndarray | None, last: np.ndarray | None, depth: int):
        self.text, self.first, self.last, self.depth = text, first, last, depth

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.first is None:
            return start, end
        return int(self.first[start:end].min()), int(self.last[start:end].max())

    def ranges(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        if self.first is None:
            at = np.arange(start, end, dtype=np.int64)
            return at, at + 1
        return self.first[start:end], self.last[start:end]


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= 12:
            yield "assign", m.start(), m.end()
    for m in _ACCESS.finditer(text):
        yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def _in_place(layer: Layer, found: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer | None:
    """The layer with ranges replaced; each replacement lists, per character,
    the layer's range it stands for."""
    if not found:
        return None
    texts, firsts, lasts, at = [], [], [], 0
    for start, end, text, own in found:
        a, b = layer.ranges(at, start)
        texts += [layer.text[at:start], text]
        firsts.append(a)
        lasts.append(b)
        spans = [layer.span(x, y) for x, y in own]
        firsts.append(np.array([s[0] for s in spans], np.int64))
        lasts.append(np.array([s[1] for s in spans], np.int64))
        at = end
    a, b = layer.ranges(at, len(layer.text))
    return Layer("".join([*texts, layer.text[at:]]), np.concatenate([*firsts, a]), np.concatenate([*lasts, b]), layer.depth + 1)


def unwrap_nested(layer: Layer) -> Layer | None:
    """Each sign that was escaped again and again as that sign, once."""
    return _in_place(layer, [(m.start(), m.end(), m[0][0], [m.span()]) for m in _NESTED.finditer(layer.text)])


def unwrap_percent(layer: Layer) -> Layer | None:
    found = []
    for m in _PERCENT.finditer(layer.text):
        text = bytes.fromhex(m[0].replace("%", "")).decode(errors="surrogateescape")
        own, at = [], m.start()
        for c in text:
            size = 3 if "\ud800" <= c <= "\udfff" else 3 * len(c.encode())
            own.append((at, at + size))
            at += size
        found.append((m.start(), m.end(), text, own))
    return _in_place(layer, found)


def unwrap_escapes(layer: Layer) -> Layer | None:
    found = []
    for m in _ESCAPED.finditer(layer.text):
        units = [(x.start(), x.end(), int(x[1] or x[2] or x[3] or x[4], 16)) for x in _ONE_ESCAPE.finditer(layer.text, m.start(), m.end())]
        text, own, k = [], [], 0
        while k < len(units):
            start, end, code = units[k]
            if 0xD800 <= code < 0xDC00 and k + 1 < len(units) and 0xDC00 <= units[k + 1][2] < 0xE000:
                code, end, k = 0x10000 + (code - 0xD800 << 10) + units[k + 1][2] - 0xDC00, units[k + 1][1], k + 1
            k += 1
            text.append(chr(code) if code <= 0x10FFFF else "\ufffd")
            own.append((start, end))
        found.append((m.start(), m.end(), "".join(text), own))
    return _in_place(layer, found)


def looks_packed(data: bytes) -> bool:
    return data[:2] == b"\x1f\x8b" or len(data) > 2 and data[0] & 0x0F == 8 and data[0] >> 4 <= 7 and (data[0] << 8 | data[1]) % 31 == 0


class Unpacked:
    """The parts of what gzip (all members) or zlib data in parts hold;
    ``taken`` counts the bytes they took.  Raises zlib.error where the data
    are broken or cut off."""

    def __init__(self, parts: Iterator[bytes]):
        self.parts, self.taken = parts, 0

    def __iter__(self) -> Iterator[bytes]:
        machine, many = zlib.decompressobj(47), None
        for part in self.parts:
            many = part[:2] == b"\x1f\x8b" if many is None else many
            while True:
                before = machine.copy()
                try:
                    out = machine.decompress(part, 1 << 20)
                except zlib.error:
                    yield from _readable(before, part)
                    raise
                rest = machine.unused_data if machine.eof else machine.unconsumed_tail
                self.taken += len(part) - len(rest)
                part = rest
                if out:
                    yield out
                if machine.eof:
                    if not many or part[:2] != b"\x1f\x8b":
                        return
                    machine = zlib.decompressobj(47)
                elif not part and len(out) < 1 << 20:
                    break
        if not machine.eof:
            raise zlib.error("cut off")


def _readable(machine, part: bytes) -> Iterator[bytes]:
    """What comes out before the damage: larger pieces as long as they can be
    read, then smaller ones."""
    at, size = 0, 1 << 14
    while size:
        if at >= len(part):
            return
        before = machine.copy()
        try:
            out = machine.decompress(part[at : at + size])
        except zlib.error:
            machine, size = before, size // 8
            continue
        if out:
            yield out
        if machine.eof:
            return
        at += size


def unpacked(data: bytes) -> tuple[int, bytes, Iterator[bytes], bytes | None]:
    """(bytes taken of the data, 0 if they are not packed; what is in them when
    all that is packed is unpacked, or its first MOST_UNPACKED bytes; more; the
    data that turned out to be damaged, if any)."""
    taken, more, seen, damaged = 0, iter(()), set(), None
    while looks_packed(data):
        key = hashlib.blake2b(data).digest()
        if key in seen:
            break
        seen.add(key)
        machine = Unpacked(itertools.chain([data], more))
        parts, held, size = iter(machine), [], 0
        try:
            while size < MOST_UNPACKED and (part := next(parts, None)) is not None:
                held.append(part)
                size += len(part)
        except zlib.error:
            damaged = data
            if not held:
                break
            # what could be read goes on; it took all there is
            parts, machine.taken = iter(()), len(data)
        data, more, taken = b"".join(held), parts, taken or machine.taken
    return taken, data, more, damaged


def windows(data: bytes, more: Iterator[bytes]) -> Iterator[bytes]:
    """The windows after the first one."""
    held, size = [data[-OVERLAP:]], OVERLAP
    try:
        for part in more:
            held.append(part)
            size += len(part)
            if size >= MOST_UNPACKED:
                data = b"".join(held)
                yield data
                held, size = [data[-OVERLAP:]], OVERLAP
    except zlib.error:
        pass
    if len(held) > 1:
        yield b"".join(held)


def text_of(data: bytes) -> str | None:
    """Bytes as text, if there may be something to find; those that are not
    UTF-8 are a surrogate each."""
    if _PLAIN.match(data):
        try:
            return data.decode()
        except UnicodeDecodeError:
            pass
    return data.decode(errors="surrogateescape") if _READABLE.search(data) else None


def base64_words(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every run of both alphabets, whole, and of the runs of
    one alphabet within it."""
    for m in _BASE64.finditer(text):
        yield m.span()
        for other, own in _ONE_ALPHABET:
            if other.search(text, *m.span()):
                for x in own.finditer(text, *m.span()):
                    yield x.span()


def wrapped_words(text: str) -> Iterator[tuple[list[tuple[int, int]], list[tuple[int, int]]]]:
    """The (start, end) of neighbouring lines, and the words (first line, line
    behind the last) they may form, longer ones first."""
    for m in _WRAPPED.finditer(text):
        if m.end() - m.start() < 16:
            continue
        lines = [x.span() for x in _RUN.finditer(text, *m.span())]
        sizes = [b - a for a, b in lines]
        lines[-1] = lines[-1][0], m.end()
        # a line such as -----BEGIN X----- is not the data's
        armour = [i for i, (a, b) in enumerate(lines) if text.find("-----", a, b) >= 0]
        words = {(0, len(lines)), *((i + 1, j) for i, j in zip([-1, *armour], [*armour, len(lines)], strict=True))}
        i = 0
        while i < len(lines):
            j = i + 1
            while j < len(lines) and sizes[j] == sizes[i]:
                j += 1
            for end in [j, j + 1] if j < len(lines) and sizes[j] < sizes[i] else [j]:
                words.add((i, end))
                if i == 1:
                    # the first line may begin behind other text
                    words.add((0, end))
            i = j
        yield lines, sorted(((i, j) for i, j in words if j - i > 1), key=lambda w: (w[0], -w[1]))


def unwrap_base64(layer: Layer) -> Iterator[Layer]:
    for start, end in base64_words(layer.text):
        for inner, _ in decoded(layer, [(start, end)]):
            yield inner
    for lines, words in wrapped_words(layer.text):
        at = np.cumsum([0, *(b - a for a, b in lines)]).tolist()
        read: list[tuple[int, int]] = []
        for i, j in words:
            read = [w for w in read if w[1] > i]
            # part of a text that was read whole
            if at[j] - at[i] < 16 or any(j <= w[1] and (at[i] - at[w[0]]) % 4 == 0 for w in read):
                continue
            for inner, packed in decoded(layer, lines[i:j]):
                yield inner
                if not packed:
                    read.append((i, j))


def decoded(layer: Layer, lines: list[tuple[int, int]]) -> Iterator[tuple[Layer, bool]]:
    """The layer that a word, of one or more lines, holds, and whether it was
    packed."""
    word = "".join([layer.text[a:b] for a, b in lines]).rstrip("=")
    if len(word) % 4 == 1:
        return
    coded = word.replace("-", "+").replace("_", "/") + "=" * (-len(word) % 4)
    try:
        data = binascii.a2b_base64(coded, strict_mode=True)
    except binascii.Error:
        # stray low bits at the end: take the whole quanta
        try:
            data = binascii.a2b_base64(coded)
        except binascii.Error:
            return
    whole = len(data)
    taken, data, more, damaged = unpacked(data)
    # where each sign of the word stands
    at = np.concatenate([np.arange(a, b, dtype=np.int64) for a, b in lines])
    if taken:
        a, b = layer.span(lines[0][0], lines[-1][1] if taken == whole else int(at[-(-taken * 4 // 3) - 1]) + 1)
        for part in itertools.chain([data], windows(data, more), [] if damaged is None else [damaged]):
            text = text_of(part)
            if text:
                yield Layer(text, np.broadcast_to(np.int64(a), len(text)), np.broadcast_to(np.int64(b), len(text)), layer.depth + 1), True
    elif text := text_of(data):
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.where((code >= 0xDC80) & (code < 0xDD00), 1, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)).astype(np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        lo, hi = at[begins * 4 // 3], at[np.minimum(-(-ends * 4 // 3), len(word)) - 1] + 1
        if layer.first is not None:
            spans = [layer.span(int(x), int(y)) for x, y in zip(lo, hi, strict=True)]
            lo, hi = np.array([s[0] for s in spans]), np.array([s[1] for s in spans])
        yield Layer(text, lo, hi, layer.depth + 1), False


def _inner(layer: Layer) -> Iterator[Layer]:
    if (x := unwrap_nested(layer)) is not None:
        # its escapes come one level deeper, and are not taken apart here level by level
        yield x
        yield from unwrap_base64(layer)
        return
    if "%" in layer.text and (x := unwrap_percent(layer)) is not None:
        yield x
    if "\\" in layer.text and (x := unwrap_escapes(layer)) is not None:
        yield x
    yield from unwrap_base64(layer)


def _key(text: str) -> str | bytes:
    return text if len(text) < 64 else hashlib.blake2b(text.encode("utf-8", "surrogatepass")).digest()


def scan_text(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, kind's number, depth) of every secret, each range and kind
    once with its least depth, by start, then kind, then end."""
    spans: dict[tuple[int, int, int], int] = {}
    seen = {_key(text)}
    work = deque([iter([Layer(text, None, None, 0)])])
    while work:
        layer = next(work[0], None)
        if layer is None:
            work.popleft()
            continue
        if layer.depth:
            key = _key(layer.text)
            if key in seen:
                continue
            seen.add(key)
        for kind, a, b in base_spans(layer.text):
            a, b = layer.span(a, b)
            key = (a, KINDS.index(kind), b)
            spans[key] = min(spans.get(key, layer.depth), layer.depth)
        # what is in a window of a stream comes before the next window, so that one window is held
        (work.appendleft if len(layer.text) >= OVERLAP else work.append)(_inner(layer))
    return [(a, b, k, spans[a, k, b]) for a, k, b in sorted(spans)]


SPAN = "struct<start:bigint,end:bigint,kind:string,depth:int>"


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id_col, [keep], spans): the secrets of every whole text."""
    rows, names, own, text, schema = carry(df, id_col, text_col, keep)
    listed = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("depth", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = [[{"start": a, "end": b, "kind": KINDS[k], "depth": d} for a, b, k, d in scan_text(x or "")] for x in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(found, listed)], [*names, "spans"])

    out = rows.mapInArrow(run, schema + f"spans array<{SPAN}>")
    return out.select(*(F.col(n).alias(c) for c, n in zip(own, names, strict=True)), "spans")


def listing(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each range, united where they overlap, replaced by a
    mark of the first one's kind."""
    out, at = [], 0
    for start, end, kind in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redacted(df: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """The rows with their secrets marked out of the text and the spans gone."""
    columns = [c for c in df.columns if c != spans_col]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != spans_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = []
            for text, spans in zip(batch.column(text_col).to_pylist(), batch.column(spans_col).to_pylist(), strict=True):
                texts.append(redact(text, [(s["start"], s["end"], s["kind"]) for s in spans]) if spans else text)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in columns], columns)

    # texts without secrets, nearly all, stay in the JVM
    found = df.where(F.size(spans_col) > 0).mapInArrow(run, schema)
    return df.where(F.size(spans_col) == 0).drop(spans_col).unionByName(found)
