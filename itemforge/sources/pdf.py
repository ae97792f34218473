"""Booklet files as page primitives, by a small reader of the public PDF format on the standard library.

``spark.dataSource.register(PdfSource)``, then ``spark.read.format("itemforge_pdf").option("kind", k).load(paths)`` with
``k`` one of ``page``, ``span``, ``drawing``, ``image``.  One file is one partition.  The reader knows object and
cross-reference streams, Flate compression, simple and two-byte fonts with code maps or differences, the text and path
operators and image placement; encrypted files and other filters give a row with ``error``.  Coordinates run from the
page's upper left corner, in points.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from itemforge.functions import fonts

_TOKEN = re.compile(rb"%[^\r\n]*|<<|>>|\[|\]|/[^\s()<>\[\]{}/%]*|\((?:\\.|[^()\\])*\)|<[0-9A-Fa-f\s]*>|[+-]?(?:\d+\.?\d*|\.\d+)|[^\s()<>\[\]{}/%]+|[(){}]", re.S)
_SPACE = b" \t\r\n\f\0"


class Ref(tuple):
    """Number of an indirect object."""


class Name(str):
    """A name, without its slash."""


def _string(raw: bytes) -> bytes:
    out, k = bytearray(), 0
    table = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}
    while k < len(raw):
        c = raw[k : k + 1]
        if c == b"\\":
            n = raw[k + 1 : k + 2]
            if m := re.match(rb"[0-7]{1,3}", raw[k + 1 :]):
                out.append(int(m.group(), 8) & 255)
                k += 1 + m.end()
                continue
            out += table.get(n, b"" if n in b"\r\n" else n)
            k += 2
            continue
        out += c
        k += 1
    return bytes(out)


def tokens(raw: bytes, at: int = 0) -> Iterator[tuple[object, int]]:
    """Values of a PDF fragment: numbers, names, strings (bytes), arrays, dictionaries, references and bare words (str)."""
    stack: list[tuple[str, list]] = []

    def close(kind: str):
        items = stack.pop()[1]
        if kind == "[":
            return items
        return {items[k]: items[k + 1] for k in range(0, len(items) - 1, 2) if isinstance(items[k], str)}

    for m in _TOKEN.finditer(raw, at):
        t = m.group()
        if t[:1] == b"%":
            continue
        if t in (b"<<", b"["):
            stack.append((t.decode(), []))
            continue
        if t in (b">>", b"]"):
            if not stack:
                continue
            value: object = close(stack[-1][0])
        elif t[:1] == b"/":
            value = Name(re.sub(rb"#([0-9A-Fa-f]{2})", lambda x: bytes([int(x.group(1), 16)]), t[1:]).decode("latin-1"))
        elif t[:1] == b"(" and len(t) > 1:
            value = _string(t[1:-1])
        elif t[:1] == b"<":
            h = re.sub(rb"\s", b"", t[1:-1])
            value = bytes.fromhex((h + b"0" if len(h) % 2 else h).decode())
        elif re.fullmatch(rb"[+-]?(?:\d+\.?\d*|\.\d+)", t):
            value = float(t) if b"." in t else int(t)
        else:
            value = t.decode("latin-1")
        if stack:
            held = stack[-1][1]
            if value == "R" and len(held) > 1 and all(isinstance(x, int) for x in held[-2:]):
                value = Ref((held.pop(-2), held.pop()))
            held.append({"true": True, "false": False, "null": None}.get(value, value) if isinstance(value, str) and not isinstance(value, Name) else value)
        else:
            yield value, m.end()


class Document:
    """Objects of a file, found by scanning for them, so that damaged cross-reference tables do no harm."""

    def __init__(self, raw: bytes):
        if b"/Encrypt" in raw:
            raise ValueError("encrypted file")
        self.objects: dict[int, object] = {}
        self.streams: dict[int, bytes] = {}
        for m in re.finditer(rb"(?:^|(?<=[\s]))(\d+)\s+(\d+)\s+obj\b", raw):
            number = int(m.group(1))
            value, end = next(tokens(raw, m.end()), (None, m.end()))
            if isinstance(value, int) and (r := re.match(rb"\s*\d+\s+(\d+)\s+R", raw[m.end() :])):
                value = Ref((value, int(r.group(1))))
            self.objects[number] = value
            if isinstance(value, dict) and (s := re.match(rb"\s*stream\r?\n", raw[end : end + 20])):
                begin = end + s.end()
                length = value.get("Length")
                stop = begin + length if isinstance(length, int) and raw[begin + length : begin + length + 20].lstrip(_SPACE).startswith(b"endstream") else raw.find(b"endstream", begin)
                self.streams[number] = raw[begin:stop]
        for number, value in list(self.objects.items()):
            if isinstance(value, dict) and value.get("Type") == "ObjStm" and number in self.streams:
                data = self.data(number)
                first, heads = int(self.get(value["First"])), [int(x) for x in data[: int(self.get(value["First"]))].split()]
                for n, offset in zip(heads[::2], heads[1::2]):
                    self.objects.setdefault(n, next(tokens(data, first + offset), (None, 0))[0])

    def get(self, x):
        """A value with references followed."""
        for _ in range(20):
            if not isinstance(x, Ref):
                return x
            x = self.objects.get(x[0])
        return None

    def data(self, number: int) -> bytes:
        """A stream's bytes, decompressed."""
        head, raw = self.objects[number], self.streams[number]
        filters = self.get(head.get("Filter")) or []
        for f in filters if isinstance(filters, list) else [filters]:
            if f != "FlateDecode":
                raise ValueError(f"filter {f}")
            raw = zlib.decompressobj().decompress(raw)
        return raw

    def pages(self) -> list[dict]:
        """Pages in order, with inherited resources and boxes."""
        out: list[dict] = []

        def walk(node, inherited: dict, depth: int) -> None:
            node = self.get(node)
            if not isinstance(node, dict) or depth > 50:
                return
            here = inherited | {k: node[k] for k in ("Resources", "MediaBox") if k in node}
            if "Kids" in node:
                for kid in self.get(node["Kids"]) or []:
                    walk(kid, here, depth + 1)
            else:
                out.append(node | here)

        root = next((o for o in self.objects.values() if isinstance(o, dict) and o.get("Type") == "Catalog"), None)
        if root:
            walk(root.get("Pages"), {}, 0)
        return out


class Font:
    """Widths and texts of a font's codes."""

    def __init__(self, doc: Document, ref):
        f = doc.get(ref) or {}
        self.name = fonts.style(str(f.get("BaseFont", "")))
        self.wide = f.get("Subtype") == "Type0"
        self.first, self.widths = doc.get(f.get("FirstChar")) or 0, [doc.get(w) for w in doc.get(f.get("Widths")) or []]
        self.chars: dict[int, str] = {}
        enc = doc.get(f.get("Encoding"))
        if isinstance(enc, dict):
            self.chars |= fonts.differences(doc.get(enc.get("Differences")) or [])
        elif "symbol" in self.name.lower() and not self.wide:
            self.chars |= fonts.SYMBOL
        if isinstance(f.get("ToUnicode"), Ref):
            self.chars |= fonts.code_map(doc.data(f["ToUnicode"][0]).decode("latin-1"), self.name)

    def decode(self, raw: bytes) -> list[tuple[str, float]]:
        """(text, width in thousandths) of each code."""
        codes = [int.from_bytes(raw[k : k + 2], "big") for k in range(0, len(raw) - 1, 2)] if self.wide else list(raw)
        out = []
        for c in codes:
            k = c - self.first
            width = self.widths[k] if 0 <= k < len(self.widths) and self.widths[k] is not None else 1000 if self.wide else 500
            text = self.chars.get(c) or ("�" if self.wide else bytes([c]).decode("cp1252", "replace"))
            out.append((text, float(width)))
        return out


def _times(a, b):
    return (a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3], a[4] * b[0] + a[5] * b[2] + b[4], a[4] * b[1] + a[5] * b[3] + b[5])


def primitives(raw: bytes) -> Iterator[tuple[str, dict]]:
    """(kind, fields) of everything on the pages of a file."""
    doc = Document(raw)
    for page_no, page in enumerate(doc.pages()):
        box = [float(doc.get(x)) for x in doc.get(page.get("MediaBox")) or (0, 0, 595, 842)]
        high = box[3]
        yield "page", {"page_no": page_no, "x0": 0.0, "y0": 0.0, "x1": box[2] - box[0], "y1": box[3] - box[1]}
        res = doc.get(page.get("Resources")) or {}
        known = {k: Font(doc, v) for k, v in (doc.get(res.get("Font")) or {}).items()}
        images = doc.get(res.get("XObject")) or {}
        parts = doc.get(page.get("Contents"))
        refs = [page["Contents"]] if isinstance(page.get("Contents"), Ref) and not isinstance(parts, list) else parts or []
        content = b"\n".join(doc.data(r[0]) for r in refs if isinstance(r, Ref) and r[0] in doc.streams)
        yield from _run(content, page_no, high, known, images, doc)


def _run(content: bytes, page_no: int, high: float, known: dict, images: dict, doc: Document) -> Iterator[tuple[str, dict]]:
    ctm, saved, args = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0), [], []
    line = text = ctm
    font, size, lead, char_space, word_space, rise = None, 1.0, 0.0, 0.0, 0.0, 0.0
    path: list[tuple[str, list]] = []
    fill, stroke, width, dash = [0.0], [0.0], 1.0, ""
    spot = (0.0, 0.0)

    def point(x: float, y: float) -> tuple[float, float]:
        return ctm[0] * x + ctm[2] * y + ctm[4], high - (ctm[1] * x + ctm[3] * y + ctm[5])

    def show(raws: list):
        nonlocal text
        shown, begin, edges = "", None, []
        for r in raws:
            if isinstance(r, (int, float)):
                text = _times((1, 0, 0, 1, -r / 1000 * size, 0), text)
                if r < -200 and shown and not shown.endswith(" "):
                    shown += " "
                    edges.append(edges[-1])
                continue
            for c, w in font.decode(r) if font and isinstance(r, bytes) else ():
                if begin is None:
                    begin = _times(text, ctm)
                edges += [_times(text, ctm)[4]] * len(c)
                shown += c
                text = _times((1, 0, 0, 1, w / 1000 * size + char_space + (word_space if c == " " else 0), 0), text)
        if begin is not None and shown.strip():
            end = _times(text, ctm)
            scale = abs(begin[3]) or abs(begin[1]) or 1.0
            base = high - begin[5] - rise * scale
            yield "span", {"page_no": page_no, "x0": begin[4], "y0": base - 0.8 * size * scale, "x1": end[4], "y1": base + 0.2 * size * scale, "text": shown, "size": size * scale, "base": base, "font": font.name, "dir_y": begin[1], "xs": [*edges, end[4]]}

    def paint(fills: bool, strokes: bool):
        pts = [p for _, ps in path for p in ps]
        if pts:
            items = [{"cmd": c, "pts": [{"x": x, "y": y} for x, y in ps]} for c, ps in path]
            yield "drawing", {
                "page_no": page_no, "x0": min(p[0] for p in pts), "y0": min(p[1] for p in pts), "x1": max(p[0] for p in pts), "y1": max(p[1] for p in pts), "type": "f" * fills + "s" * strokes,
                "fill": list(fill) if fills else None, "color": list(stroke) if strokes else None, "width": width, "dashes": dash, "items": items,
            }

    for value, _ in tokens(content):
        if not isinstance(value, str) or isinstance(value, Name):
            args.append(value)
            continue
        a, op, args = args, value, []
        n = [x for x in a if isinstance(x, (int, float))]
        if op == "q":
            saved.append((ctm, fill, stroke, width, dash))
        elif op == "Q" and saved:
            ctm, fill, stroke, width, dash = saved.pop()
        elif op == "cm" and len(n) == 6:
            ctm = _times(n, ctm)
        elif op == "BT":
            line = text = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
        elif op == "Tf" and len(a) == 2:
            font, size = known.get(str(a[0])), float(a[1])
        elif op in ("Td", "TD") and len(n) == 2:
            lead = -n[1] if op == "TD" else lead
            line = text = _times((1, 0, 0, 1, *n), line)
        elif op == "Tm" and len(n) == 6:
            line = text = tuple(map(float, n))
        elif op == "T*":
            line = text = _times((1, 0, 0, 1, 0, -lead), line)
        elif op in ("TL", "Tc", "Tw", "Ts") and n:
            lead, char_space, word_space, rise = (n[0] if op == o else v for o, v in (("TL", lead), ("Tc", char_space), ("Tw", word_space), ("Ts", rise)))
        elif op == "Tj":
            yield from show(a)
        elif op == "TJ" and a:
            yield from show(a[0] if isinstance(a[0], list) else a)
        elif op in ("'", '"'):
            line = text = _times((1, 0, 0, 1, 0, -lead), line)
            yield from show(a[-1:])
        elif op == "m" and len(n) == 2:
            spot = n
        elif op == "l" and len(n) == 2:
            path.append(("l", [point(*spot), point(*n)]))
            spot = n
        elif op in ("c", "v", "y") and len(n) >= 4:
            full = {"c": n, "v": [*spot, *n], "y": [*n, *n[-2:]]}[op]
            path.append(("c", [point(*spot), *[point(*full[k : k + 2]) for k in range(0, 6, 2)]]))
            spot = n[-2:]
        elif op == "re" and len(n) == 4:
            path.append(("re", [point(n[0], n[1]), point(n[0] + n[2], n[1] + n[3])]))
        elif op in ("f", "F", "f*", "S", "s", "B", "B*", "b", "b*", "n"):
            if op != "n":
                yield from paint(op[0] in "fFBb", op[0] in "SsBb")
            path = []
        elif op in ("rg", "g", "k", "sc", "scn"):
            fill = _rgb(n)
        elif op in ("RG", "G", "K", "SC", "SCN"):
            stroke = _rgb(n)
        elif op == "w" and n:
            width = float(n[0])
        elif op == "d" and a:
            dash = f"{a[0]} {a[1] if len(a) > 1 else 0}".replace(",", "")
        elif op == "Do" and a:
            x = doc.get(images.get(str(a[0])))
            if isinstance(x, dict) and x.get("Subtype") == "Image":
                c = [point(u, v) for u in (0, 1) for v in (0, 1)]
                yield "image", {"page_no": page_no, "x0": min(p[0] for p in c), "y0": min(p[1] for p in c), "x1": max(p[0] for p in c), "y1": max(p[1] for p in c)}


def _rgb(n: list) -> list[float]:
    if len(n) == 4:
        return [(1 - min(1, x)) * (1 - n[3]) for x in n[:3]]
    return [float(n[0])] * 3 if len(n) == 1 else [float(x) for x in n]


_BOX = "path string, name string, page_no int, ord int, x0 double, y0 double, x1 double, y1 double"
SCHEMAS = {
    "page": _BOX + ", error string",
    "span": _BOX + ", text string, size double, base double, font string, dir_y double, xs array<double>, error string",
    "drawing": _BOX + ", type string, fill array<double>, color array<double>, width double, dashes string, items array<struct<cmd:string,pts:array<struct<x:double,y:double>>>>, error string",
    "image": _BOX + ", error string",
}


class PdfSource(DataSource):
    """Primitives of one kind from booklet files."""

    @classmethod
    def name(cls) -> str:
        return "itemforge_pdf"

    def schema(self) -> str:
        return SCHEMAS[self.options.get("kind", "page")]

    def reader(self, schema) -> DataSourceReader:
        return PdfReader([p for p in self.options.get("path", "").split(",") if p], self.options.get("kind", "page"))


class PdfReader(DataSourceReader):
    def __init__(self, paths: list[str], kind: str):
        self.paths, self.kind = paths, kind

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        names = [f.split()[0] for f in re.sub(r"<[^,]*(?:<.*>)?>", "", SCHEMAS[self.kind].replace("items array<struct<cmd:string,pts:array<struct<x:double,y:double>>>>", "items x")).split(", ")]
        ord_ = 0
        try:
            with open(path.removeprefix("file:"), "rb") as f:
                raw = f.read()
            for kind, fields in primitives(raw):
                if kind == self.kind:
                    row = {"path": path, "name": path.rsplit("/", 1)[-1], "ord": ord_, "error": None} | fields
                    if "items" in row:
                        row["items"] = [(i["cmd"], [(float(p["x"]), float(p["y"])) for p in i["pts"]]) for i in row["items"]]
                    yield tuple(row.get(n) for n in names)
                    ord_ += 1
        except Exception as e:  # one unreadable file is reported, not fatal
            yield tuple({"path": path, "name": path.rsplit("/", 1)[-1], "error": f"{type(e).__name__}: {e}"}.get(n) for n in names)


def cover_text(raw: bytes) -> tuple[int, str]:
    """(pages, text of the first page; of the first two if the first has fewer than 80 characters)."""
    by_page: dict[int, list[str]] = {}
    pages = 0
    for kind, f in primitives(raw):
        pages += kind == "page"
        if kind == "span" and f["page_no"] < 2:
            by_page.setdefault(f["page_no"], []).append(f["text"])
    first = "\n".join(by_page.get(0, []))
    return pages, first if len(first.strip()) >= 80 or pages < 2 else first + "\n" + "\n".join(by_page.get(1, []))
