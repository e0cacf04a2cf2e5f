"""A reader of PDF files whose text is text: lines with their places, and where pictures lie.

Enough of the format for exam papers as word processors write them: objects
plain or in object streams, Flate streams, simple and two-byte fonts with a
ToUnicode table. Scans hold no text; ``with_ocr`` hands pages that say too
little to a function of the caller.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from examloom.sources.pages import Reader

#: A page with fewer characters than this says too little.
SPARSE_CHARS = 40
#: Pages with this share of characters that stand for nothing are as good as empty.
UNREADABLE = 0.3
LINE_SLACK, WORD_GAP, COLUMN_GAP = 3.0, 0.2, 2.0
WIDTH, HEIGHT = 595.3, 841.9
MOST_DEPTH = 20

_TOKEN = re.compile(rb"""\s*(?:%[^\r\n]*[\r\n])*\s*(?P<t><<|>>|\[|\]|/[^\s<>\[\]()/%{}]*|\d+\s+\d+\s+R\b|[+-]?(?:\d+\.?\d*|\.\d+)|<[0-9A-Fa-f\s]*>|\(|[A-Za-z'"*][A-Za-z0-9'"*]*|[{}])""")
_STREAM = re.compile(rb"stream\r?\n")
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


class Name(str):
    pass


class Ref(int):
    pass


class Operator(str):
    pass


def _string(data: bytes, at: int) -> tuple[bytes, int]:
    """A string in brackets, from behind the opening one."""
    out, depth = bytearray(), 1
    while at < len(data):
        c = data[at : at + 1]
        at += 1
        if c == b"\\":
            c = data[at : at + 1]
            octal = re.match(rb"[0-7]{1,3}", data[at : at + 3])
            if octal:
                out.append(int(octal[0], 8) & 0xFF)
                at += len(octal[0])
                continue
            at += 1
            if c not in b"\r\n":
                out += _ESCAPES.get(c, c)
            continue
        depth += (c == b"(") - (c == b")")
        if not depth:
            break
        out += c
    return bytes(out), at


def values(data: bytes, at: int = 0) -> Iterator[Any]:
    """The values of a stretch of PDF: numbers, names, strings (bytes), lists, dicts, references and operators."""
    open_: list[list] = []
    while True:
        m = _TOKEN.match(data, at)
        if not m:
            return
        t, at = m["t"], m.end()
        if t in (b"[", b"<<"):
            open_.append([t])
            continue
        if t in (b"]", b">>"):
            if not open_:
                continue
            inner = open_.pop()[1:]
            value: Any = inner if t == b"]" else {k: v for k, v in zip(inner[::2], inner[1::2]) if isinstance(k, Name)}
        elif t == b"(":
            value, at = _string(data, at)
        elif t[:1] == b"/":
            value = Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda h: bytes([int(h[1], 16)]), t[1:]).decode("latin-1"))
        elif t[:1] == b"<":
            digits = re.sub(rb"[^0-9A-Fa-f]", b"", t)
            value = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
        elif t.endswith(b"R") and t[:1].isdigit():
            value = Ref(t.split()[0])
        elif t[:1] in b"+-.0123456789":
            value = float(t) if b"." in t else int(t)
        else:
            value = {b"true": True, b"false": False, b"null": None}.get(t, Operator(t.decode("latin-1")))
        if open_:
            open_[-1].append(value)
        else:
            yield value


class File:
    """The objects of a file, found by looking for them: no cross-reference table is needed, so broken ones do no harm."""

    def __init__(self, content: bytes):
        if b"%PDF" not in content[:1024]:
            raise ValueError("no PDF file")
        self.found: dict[int, tuple[Any, bytes | None]] = {}
        for m in re.finditer(rb"(?<![0-9])(\d+)\s+\d+\s+obj\b", content):
            end = content.find(b"endobj", m.end())
            value = next(values(content[m.end() : end if end >= 0 else None]), None)
            stream = None
            begin = _STREAM.search(content, m.end()) if isinstance(value, dict) else None
            if begin and (end < 0 or begin.start() < end):
                length = value.get("Length")
                stop = begin.end() + length if isinstance(length, int) and not isinstance(length, Ref) else content.find(b"endstream", begin.end())
                stream = content[begin.end() : stop]
            self.found[int(m[1])] = value, stream
        if re.search(rb"/Encrypt\s+\d", content):
            raise ValueError("an encrypted PDF file")
        for value, stream in list(self.found.values()):
            if isinstance(value, dict) and value.get("Type") == "ObjStm" and stream is not None:
                data, first = self.unpacked(value, stream), self.value(value.get("First"))
                heads = [v for v in values(data[:first]) if isinstance(v, int)]
                for number, place in zip(heads[::2], heads[1::2]):
                    self.found.setdefault(number, (next(values(data, first + place), None), None))

    def value(self, v: Any) -> Any:
        for _ in range(MOST_DEPTH):
            if not isinstance(v, Ref):
                return v
            v = self.found.get(int(v), (None, None))[0]
        return None

    def unpacked(self, head: dict, stream: bytes) -> bytes:
        filters = self.value(head.get("Filter")) or []
        for f in filters if isinstance(filters, list) else [filters]:
            if self.value(f) != "FlateDecode":
                return b""
            stream = zlib.decompressobj().decompress(stream)
        return stream

    def stream(self, v: Any) -> bytes:
        if isinstance(v, list):
            return b"\n".join(self.stream(x) for x in v)
        value, stream = self.found.get(int(v), (None, None)) if isinstance(v, Ref) else (None, None)
        if isinstance(value, list):
            return self.stream(value)
        return self.unpacked(value, stream) if stream is not None and isinstance(value, dict) else b""

    def pages(self) -> list[dict]:
        """Pages in order, each with what it inherits."""
        out: list[dict] = []

        def walk(node: Any, given: dict, depth: int) -> None:
            node = self.value(node)
            if not isinstance(node, dict) or depth > MOST_DEPTH:
                return
            given = given | {k: node[k] for k in ("Resources", "MediaBox") if k in node}
            if "Kids" in node:
                for kid in self.value(node["Kids"]) or []:
                    walk(kid, given, depth + 1)
            else:
                out.append(given | node)

        roots = [v for v, _ in self.found.values() if isinstance(v, dict) and v.get("Type") == "Catalog"]
        if roots:
            walk(roots[-1].get("Pages"), {}, 0)
        return out


class Font:
    """What the codes of a font mean, and how wide they are."""

    def __init__(self, file: File, head: dict):
        self.two = head.get("Subtype") == "Type0"
        self.text: dict[int, str] = {}
        table = file.stream(head["ToUnicode"]) if "ToUnicode" in head else b""
        for block in re.findall(rb"beginbfchar(.*?)endbfchar", table, re.S):
            pairs = list(values(block))
            for code, to in zip(pairs[::2], pairs[1::2]):
                self.text[int.from_bytes(code, "big")] = to.decode("utf-16-be", "replace")
        for block in re.findall(rb"beginbfrange(.*?)endbfrange", table, re.S):
            found = list(values(block))
            for low, high, to in zip(found[::3], found[1::3], found[2::3]):
                low, high = int.from_bytes(low, "big"), int.from_bytes(high, "big")
                for i in range(min(high - low + 1, 65536)):
                    one = to[i] if isinstance(to, list) and i < len(to) else to
                    if isinstance(one, bytes):
                        last = one.decode("utf-16-be", "replace")
                        self.text[low + i] = last if isinstance(to, list) or not last else last[:-1] + chr(min(ord(last[-1]) + i, 0x10FFFF))
        self.widths: dict[int, float] = {}
        self.usual = 500.0
        if self.two:
            inner = file.value((file.value(head.get("DescendantFonts")) or [None])[0]) or {}
            self.usual, listed = float(file.value(inner.get("DW")) or 1000), file.value(inner.get("W")) or []
            i = 0
            while i + 1 < len(listed):
                first, second = listed[i], file.value(listed[i + 1])
                if isinstance(second, list):
                    self.widths |= {first + k: float(w) for k, w in enumerate(second)}
                    i += 2
                else:
                    self.widths |= dict.fromkeys(range(first, min(second, first + 65535) + 1), float(listed[i + 2]))
                    i += 3
        else:
            first = file.value(head.get("FirstChar")) or 0
            self.widths = {first + k: float(file.value(w) or 0) for k, w in enumerate(file.value(head.get("Widths")) or [])}

    def read(self, data: bytes) -> list[tuple[str, float, bool]]:
        """Text, width in ems, and whether it is a word's space, of each code."""
        codes = [int.from_bytes(data[i : i + 2], "big") for i in range(0, len(data) - 1, 2)] if self.two else list(data)
        known = lambda c: self.text.get(c, ("�" if self.two else bytes([c]).decode("cp1252", "replace")))
        return [(known(c), self.widths.get(c, self.usual) / 1000, c == 32 and not self.two) for c in codes]


def _times(a: tuple, b: tuple) -> tuple:
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


UNIT = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


class Canvas:
    """Follows the operators of a page: runs of text and boxes of pictures, with y growing downwards."""

    def __init__(self, file: File, height: float):
        self.file, self.height = file, height
        self.runs: list[tuple[float, float, float, float, str, int]] = []  # baseline, x0, x1, size, text, block
        self.images: list[tuple[float, float, float, float]] = []
        self.block, self.fonts = 0, {}

    def font(self, resources: dict, name: str) -> Font:
        head = self.file.value((self.file.value(resources.get("Font")) or {}).get(name))
        key = id(head)
        if key not in self.fonts:
            self.fonts[key] = Font(self.file, head if isinstance(head, dict) else {})
        return self.fonts[key]

    def draw(self, content: bytes, resources: dict, matrix: tuple = UNIT, depth: int = 0) -> None:
        kept, stack = [], []
        font, size, lead, spread, word, scale, rise = None, 1.0, 0.0, 0.0, 0.0, 1.0, 0.0
        text = line = UNIT

        def show(items: list) -> None:
            nonlocal text
            for item in items:
                if isinstance(item, (int, float)):
                    text = _times((1, 0, 0, 1, -item / 1000 * size * scale, 0), text)
                elif isinstance(item, bytes) and font is not None:
                    before, out = _times((1, 0, 0, 1, 0, rise), _times(text, matrix)), ""
                    for char, width, space in font.read(item):
                        out += char
                        text = _times((1, 0, 0, 1, (width * size + spread + (word if space else 0)) * scale, 0), text)
                    after = _times(text, matrix)
                    if out.strip():
                        high = abs(size) * (before[2] ** 2 + before[3] ** 2) ** 0.5
                        self.runs.append((self.height - before[5], before[4], after[4], high, out, self.block))

        for v in values(content):
            if not isinstance(v, Operator):
                stack.append(v)
                continue
            numbers = [float(x) for x in stack if isinstance(x, (int, float)) and not isinstance(x, bool)]
            if v == "q":
                kept.append((matrix, font, size, lead, spread, word, scale, rise))
            elif v == "Q" and kept:
                matrix, font, size, lead, spread, word, scale, rise = kept.pop()
            elif v == "cm" and len(numbers) == 6:
                matrix = _times(tuple(numbers), matrix)
            elif v == "BT":
                text = line = UNIT
                self.block += 1
            elif v == "Tf" and numbers and isinstance(stack[0], Name):
                font, size = self.font(resources, stack[0]), numbers[-1]
            elif v == "Tm" and len(numbers) == 6:
                text = line = tuple(numbers)
            elif v in ("Td", "TD") and len(numbers) == 2:
                lead = -numbers[1] if v == "TD" else lead
                text = line = _times((1, 0, 0, 1, *numbers), line)
            elif v in ("TL", "Tc", "Tw", "Tz", "Ts") and numbers:
                lead, spread, word, scale, rise = (numbers[0] if v == "TL" else lead, numbers[0] if v == "Tc" else spread, numbers[0] if v == "Tw" else word, numbers[0] / 100 if v == "Tz" else scale, numbers[0] if v == "Ts" else rise)
            elif v in ("T*", "'", '"'):
                if v == '"' and len(numbers) == 2:
                    word, spread = numbers
                text = line = _times((1, 0, 0, 1, 0, -lead), line)
                show(stack[-1:] if v != "T*" else [])
            elif v == "Tj":
                show(stack[-1:])
            elif v == "TJ" and stack and isinstance(stack[-1], list):
                show(stack[-1])
            elif v == "Do" and stack and isinstance(stack[-1], Name):
                self.place((self.file.value(resources.get("XObject")) or {}).get(stack[-1]), resources, matrix, depth)
            stack = []

    def place(self, ref: Any, resources: dict, matrix: tuple, depth: int) -> None:
        head = self.file.value(ref)
        if not isinstance(head, dict) or depth > MOST_DEPTH:
            return
        if head.get("Subtype") == "Image":
            xs = (matrix[4], matrix[4] + matrix[0], matrix[4] + matrix[2], matrix[4] + matrix[0] + matrix[2])
            ys = (matrix[5], matrix[5] + matrix[1], matrix[5] + matrix[3], matrix[5] + matrix[1] + matrix[3])
            self.images.append((min(xs), self.height - max(ys), max(xs), self.height - min(ys)))
        elif head.get("Subtype") == "Form":
            own = self.file.value(head.get("Matrix")) or list(UNIT)
            self.draw(self.file.stream(ref), self.file.value(head.get("Resources")) or resources, _times(tuple(map(float, own)), matrix), depth + 1)


def lines_of(runs: list[tuple]) -> list[dict[str, Any]]:
    """Runs of text on one baseline as lines: near ones joined, with a space where there is a gap, and apart where there is a column's."""
    out: list[dict[str, Any]] = []
    for base, x0, x1, size, text, block in sorted(runs, key=lambda r: (round(r[0] / LINE_SLACK), r[1])):
        last = out[-1] if out else None
        same = last is not None and abs(last["base"] - base) <= LINE_SLACK and -size < x0 - last["x1"] <= COLUMN_GAP * size
        if same:
            gap = x0 - last["x1"] > WORD_GAP * size and not last["text"].endswith(" ") and not text.startswith(" ")
            last["text"] += " " * gap + text
            last |= {"x1": max(last["x1"], x1), "y0": min(last["y0"], base - size), "font_size": max(last["font_size"], size)}
        else:
            out.append({"text": text, "base": base, "x0": x0, "y0": base - size, "x1": x1, "y1": base + 0.2 * size, "block_index": block, "font_size": size, "flags": 0})
    kept = [line | {"text": " ".join(line["text"].split())} for line in out if line["text"].strip()]
    return [{k: v for k, v in line.items() if k != "base"} | {"line_no": i} for i, line in enumerate(kept)]


def pdf_reader(content: bytes) -> Iterable[dict[str, Any]]:
    """Pages of a PDF file as ``pages.Reader`` gives them; it finds no tables."""
    file = File(content)
    for number, page in enumerate(file.pages(), 1):
        box = [float(file.value(v)) for v in file.value(page.get("MediaBox")) or (0, 0, WIDTH, HEIGHT)]
        width, height = box[2] - box[0], box[3] - box[1]
        canvas = Canvas(file, height)
        content_ = page.get("Contents")
        canvas.draw(file.stream(content_), file.value(page.get("Resources")) or {}, (1.0, 0.0, 0.0, 1.0, -box[0], -box[1]))
        lines = lines_of(canvas.runs)
        images = [{"x0": a, "y0": b, "x1": c, "y1": d, "block_index": i} for i, (a, b, c, d) in enumerate(canvas.images)]
        yield {"page": number, "width": width, "height": height, "raw_text": "\n".join(line["text"] for line in lines), "used_ocr": False, "lines": lines, "images": images, "tables": []}


def is_sparse(text: str | None) -> bool:
    """Whether a page says too little to be read as text, or says it in characters that stand for nothing."""
    plain = "".join((text or "").split())
    return len(plain) < SPARSE_CHARS or sum(c == "�" or not c.isprintable() for c in plain) > UNREADABLE * len(plain)


def with_ocr(reader: Reader, ocr: Callable[[bytes, int], str], force: bool | None = None) -> Reader:
    """A reader that hands pages which say too little (or all with ``force``, none with False) to ``ocr``, a function of the file and the page number; its lines get made-up places."""

    def read(content: bytes) -> Iterable[dict[str, Any]]:
        for page in reader(content):
            if force or force is None and is_sparse(page.get("raw_text")):
                text = ocr(content, page["page"])
                usable = [s for s in map(str.strip, text.splitlines()) if s]
                height = page["height"] / (len(usable) + 2)
                lines = [{"text": s, "x0": 72.0, "y0": 40 + i * height, "x1": page["width"] - 40, "y1": 40 + (i + 1) * height, "block_index": i, "line_no": 0} for i, s in enumerate(usable)]
                page = page | {"raw_text": text, "used_ocr": True, "lines": lines}
            yield page

    return read


def cell_matrix(cells: Iterable[dict[str, Any]]) -> tuple[list[str], list[list[str]]]:
    """Headers and rows of a table given as cells (row, column, text, row_span, column_span, header): a cell fills all places that it spans; rows all of whose cells are headers go first and give the headers."""
    placed: dict[tuple[int, int], str] = {}
    heads: dict[int, bool] = {}
    for c in cells:
        for r in range(c["row"], c["row"] + max(1, c.get("row_span") or 1)):
            heads[r] = heads.get(r, True) and bool(c.get("header"))
            for k in range(c["column"], c["column"] + max(1, c.get("column_span") or 1)):
                placed[r, k] = " ".join((c.get("text") or "").split())
    if not placed:
        return [], []
    width = max(k for _, k in placed) + 1
    rows = [[placed.get((r, k), "") for k in range(width)] for r in sorted(heads)]
    first = [heads[r] for r in sorted(heads)]
    return (rows[0], rows[1:]) if first[0] else ([], rows)
