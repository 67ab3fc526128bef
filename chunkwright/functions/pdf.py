"""[S9] Text of PDF pages, from the standard library alone: Flate streams, object streams, text operators, ToUnicode maps.

Encrypted files and fonts without a map beyond Latin-1 give what their bytes give; scanned pages give none.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

_OBJECT = re.compile(rb"(?<!\d)(\d+)\s+\d+\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"stream\r?\n(.*?)\r?\n?endstream", re.S)
_TOKEN = re.compile(rb"\((?:[^()\\]|\\.|\((?:[^()\\]|\\.)*\))*\)|<[0-9A-Fa-f\s]*>|\[|\]|/[^\s/\[\]()<>]+|[-+]?\d*\.?\d+|[A-Za-z'\"*]+", re.S)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|\r?\n|.)", re.S)
_SPECIAL = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
GAP = -200  # a step back in a string array that is wider than this, in thousandths, is a blank


def _refs(body: bytes, key: bytes) -> list[int]:
    """The objects that a dictionary's entry names, one or an array of them."""
    m = re.search(rb"/" + key + rb"\s*(?:\[([^\]]*)\]|(\d+\s+\d+\s+R))", body)
    return [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R", m[1] if m[1] is not None else m[2])] if m else []


def _stream(body: bytes) -> bytes:
    m = _STREAM.search(body)
    if not m:
        return b""
    if b"/FlateDecode" not in body[: m.start()]:
        return m[1]
    try:
        return zlib.decompressobj().decompress(m[1])
    except zlib.error:
        return b""


def _objects(content: bytes) -> dict[int, bytes]:
    found = {int(n): body for n, body in _OBJECT.findall(content)}
    for body in list(found.values()):
        if b"/ObjStm" in body[:300]:
            data, n, first = _stream(body), re.search(rb"/N\s+(\d+)", body), re.search(rb"/First\s+(\d+)", body)
            if data and n and first:
                head = [int(x) for x in data[: int(first[1])].split()[: 2 * int(n[1])]]
                starts = [*head[1::2], len(data)]
                for number, a, b in zip(head[::2], starts, starts[1:], strict=False):
                    found.setdefault(number, data[int(first[1]) + a : int(first[1]) + b])
    return found


def _pages(objects: dict[int, bytes]) -> Iterator[tuple[bytes, list[bytes]]]:
    """Page dictionaries in reading order, each with those above it, whose entries it inherits."""
    inside = {k for body in objects.values() for k in _refs(body, b"Kids")}
    roots = [n for n, body in sorted(objects.items()) if re.search(rb"/Type\s*/Pages\b", body) and n not in inside]
    stack: list[tuple[int, list[bytes]]] = [(n, []) for n in reversed(roots)]
    seen = set()
    while stack:
        n, above = stack.pop()
        body = objects.get(n, b"")
        if n in seen:
            continue
        seen.add(n)
        if re.search(rb"/Type\s*/Page\b", body):
            yield body, above
        else:
            stack += [(k, [body, *above]) for k in reversed(_refs(body, b"Kids"))]


def _unicode_map(cmap: bytes) -> tuple[int, dict[int, str]]:
    """Bytes a code and the text of each code."""
    out: dict[int, str] = {}
    wide = 1
    read = lambda h: bytes.fromhex(h.decode() + "0" * (len(h) % 2)).decode("utf-16-be", "replace")
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", cmap, re.S):
        for a, b in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            wide, out[int(a, 16)] = max(wide, len(a) // 2), read(b)
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", cmap, re.S):
        for a, b, c in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            wide, base = max(wide, len(a) // 2), read(c)
            for i in range(int(a, 16), min(int(b, 16), int(a, 16) + 65535) + 1):
                out[i] = base[:-1] + chr(ord(base[-1]) + i - int(a, 16)) if base else ""
    return wide, out


def _fonts(objects: dict[int, bytes], page: bytes, above: list[bytes]) -> dict[bytes, tuple[int, dict[int, str]]]:
    out: dict[bytes, tuple[int, dict[int, str]]] = {}
    for holder in (page, *above):
        for body in (holder, *(objects.get(n, b"") for n in _refs(holder, b"Resources"))):
            tables = re.findall(rb"/Font\s*<<(.*?)>>", body, re.S) + [objects.get(n, b"") for n in _refs(body, b"Font")]
            for name, number in (x for t in tables for x in re.findall(rb"/([^\s/<>\[\]()]+)\s+(\d+)\s+\d+\s+R", t)):
                for cmap in _refs(objects.get(int(number), b""), b"ToUnicode"):
                    out.setdefault(name, _unicode_map(_stream(objects.get(cmap, b""))))
    return out


def _string(token: bytes, font: tuple[int, dict[int, str]] | None) -> str:
    if token[:1] == b"<":
        digits = re.sub(rb"\s", b"", token[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = _ESCAPE.sub(lambda m: bytes([int(m[1], 8) & 255]) if m[1][:1].isdigit() else b"" if m[1].endswith(b"\n") else _SPECIAL.get(m[1], m[1]), token[1:-1])
    if font and font[1]:
        wide, table = font
        return "".join(table.get(int.from_bytes(raw[i : i + wide], "big"), "") for i in range(0, len(raw), wide))
    return raw[2:].decode("utf-16-be", "replace") if raw[:2] == b"\xfe\xff" else raw.decode("latin-1")


def _text(data: bytes, fonts: dict[bytes, tuple[int, dict[int, str]]]) -> str:
    out: list[str] = []
    held: list[bytes] = []
    font = None
    for token in _TOKEN.findall(data):
        if token[:1] in b"(<[]/" or token[:1] in b"-+.0123456789":
            held.append(token)
            continue
        if token == b"Tf":
            font = next((fonts.get(t[1:]) for t in held if t[:1] == b"/"), None)
        elif token in (b"Tj", b"TJ", b"'", b'"'):
            if token in (b"'", b'"'):
                out.append("\n")
            for t in held:
                if t[:1] in b"(<":
                    out.append(_string(t, font))
                elif token == b"TJ" and t[:1] not in b"[]/" and float(t) < GAP:
                    out.append(" ")
        elif token in (b"Td", b"TD"):
            numbers = [t for t in held if t[:1] in b"-+.0123456789"]
            out.append("\n" if len(numbers) > 1 and float(numbers[-1]) else " ")
        elif token in (b"T*", b"Tm", b"ET"):
            out.append("\n")
        held = []
    return re.sub(r"\s*\n\s*", "\n", re.sub(r"[ \t]+", " ", "".join(out))).strip()


def pdf_pages(content: bytes | None) -> list[str]:
    """The text of every page in order; a blank page is empty, bytes that are no PDF have no pages."""
    objects = _objects(content or b"")
    out = []
    for page, above in _pages(objects):
        data = b"\n".join(_stream(objects.get(n, b"")) for n in _refs(page, b"Contents"))
        out.append(_text(data, _fonts(objects, page, above)))
    return out


def pdf_rows(files: DataFrame) -> DataFrame:
    """[S9] ``(path, slide_number, text)`` of binary files: a row for each page that isn't blank, numbered over all pages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(path, n, text) for path, content in pdf[["path", "content"]].itertuples(index=False) for n, text in enumerate(pdf_pages(content), 1) if text]
            yield pd.DataFrame(rows, columns=["path", "slide_number", "text"])

    return files.select("path", "content").mapInPandas(run, "path string, slide_number long, text string")
