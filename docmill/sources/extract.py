"""Source files to block lists: HTML, Markdown, CSV and Office Open XML with the standard library; other formats by
registered parsers."""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.schemas import BLOCKS

#: Version of the parsers, kept with every document they made.
PARSER_VERSION = "docmill-2"
Block = tuple[str, int | None, str, int | None]  # kind, level, text, page
_SKIPPED = {"script", "style", "template", "noscript"}
_ENDS = {"p", "div", "li", "tr", "td", "th", "table", "ul", "ol", "br", "section", "article", "blockquote", "pre", "dt", "dd", "title", "body", "header", "footer", "nav", "caption"}


def _decode(data: bytes | str, html: bool = False) -> str:
    if isinstance(data, str):
        return data.removeprefix("\ufeff")
    if data.startswith(b"\xef\xbb\xbf"):
        return data[3:].decode("utf-8", "replace")
    declared = re.search(rb"""charset=["']?([\w-]+)""", data[:2048]) if html else None
    for name in ([declared[1].decode()] if declared else []) + ["utf-8"]:
        try:
            return data.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return data.decode("cp1252", "replace")


class _Html(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.kind, self.level, self.skip, self.row, self.title = "text", None, "", None, ""

    def _flush(self, kind: str = "text", level: int | None = None) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            if self.row is not None:
                self.row.append(text)
            elif self.kind == "title":
                self.title = self.title or text
            else:
                self.blocks.append((self.kind, self.level, text, None))
        self.text, self.kind, self.level = [], kind, level

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in _SKIPPED:
            self.skip = tag
        elif re.fullmatch(r"h[1-6]", tag):
            self._flush("heading", int(tag[1]))
        elif tag == "tr":
            self._flush()
            self.row = []
        elif tag in _ENDS:
            self._flush("title" if tag == "title" else "list_item" if tag == "li" else "code" if tag == "pre" else "text")

    def handle_endtag(self, tag: str) -> None:
        if tag == self.skip:
            self.skip = ""
        elif tag == "tr":
            self._flush()
            if self.row:
                self.blocks.append(("table_row", None, " | ".join(self.row), None))
            self.row = None
        elif tag in _ENDS or re.fullmatch(r"h[1-6]", tag):
            self._flush()

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.text.append(data)


def parse_html(data: bytes | str) -> tuple[str | None, list[Block]]:
    parser = _Html()
    parser.feed(_decode(data, html=True))
    parser.close()
    parser._flush()
    if parser.row:
        parser.blocks.append(("table_row", None, " | ".join(parser.row), None))
    return parser.title or next((t for k, _, t, _ in parser.blocks if k == "heading"), None), parser.blocks


def parse_markdown(data: bytes | str) -> tuple[str | None, list[Block]]:
    blocks: list[Block] = []
    held: list[str] = []
    fence: list[str] | None = None

    def flush() -> None:
        if held:
            blocks.append(("text", None, " ".join(" ".join(held).split()), None))
            held.clear()

    for line in _decode(data).splitlines():
        s = line.strip()
        if fence is not None:
            if s.startswith(("```", "~~~")):
                blocks.append(("code", None, "\n".join(fence), None))
                fence = None
            else:
                fence.append(line)
        elif s.startswith(("```", "~~~")):
            flush()
            fence = []
        elif m := re.match(r"(#{1,6})\s+(.*?)\s*#*$", s):
            flush()
            blocks.append(("heading", len(m[1]), m[2], None))
        elif re.fullmatch(r"([-*_]\s*){3,}", s) or not s:
            flush()
        elif m := re.match(r"(?:[-*+]|\d+[.)])\s+(.*)", s):
            flush()
            blocks.append(("list_item", None, m[1], None))
        elif s.startswith("|"):
            flush()
            if not re.fullmatch(r"[|:\-\s]+", s):
                blocks.append(("table_row", None, " | ".join(c.strip() for c in s.strip("|").split("|")), None))
        else:
            held.append(s)
    flush()
    if fence:
        blocks.append(("code", None, "\n".join(fence), None))
    return next((t for k, _, t, _ in blocks if k == "heading"), None), blocks


def parse_csv(data: bytes | str) -> tuple[str | None, list[Block]]:
    rows = [r for r in csv.reader(io.StringIO(_decode(data))) if any(c.strip() for c in r)]
    return None, [("table_row", None, " | ".join(c.strip() for c in r), None) for r in rows]


def parse_text(data: bytes | str) -> tuple[str | None, list[Block]]:
    parts = re.split(r"\n\s*\n", _decode(data))
    return None, [("text", None, " ".join(p.split()), None) for p in parts if p.strip()]


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _joined(node, name: str = "t") -> str:
    return "".join(x.text or "" for x in node.iter() if _local(x.tag) == name)


def parse_docx(data: bytes) -> tuple[str | None, list[Block]]:
    root = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(data)).read("word/document.xml"))
    blocks: list[Block] = []
    body = next(x for x in root if _local(x.tag) == "body")
    for node in body:
        if _local(node.tag) == "p" and (text := _joined(node).strip()):
            style = next((v for x in node.iter() if _local(x.tag) == "pStyle" for k, v in x.attrib.items() if _local(k) == "val"), "")
            m = re.fullmatch(r"Heading(\d)|(Title)", style)
            blocks.append(("heading", int(m[1] or 1), text, None) if m else ("list_item" if "List" in style else "text", None, text, None))
        elif _local(node.tag) == "tbl":
            for row in (x for x in node if _local(x.tag) == "tr"):
                blocks.append(("table_row", None, " | ".join(_joined(c).strip() for c in row if _local(c.tag) == "tc"), None))
    return next((t for k, _, t, _ in blocks if k == "heading"), None), blocks


def parse_pptx(data: bytes) -> tuple[str | None, list[Block]]:
    z = zipfile.ZipFile(io.BytesIO(data))
    slides = sorted((n for n in z.namelist() if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
    blocks: list[Block] = []
    for page, name in enumerate(slides, 1):
        for n, para in enumerate(x for x in ElementTree.fromstring(z.read(name)).iter() if _local(x.tag) == "p"):
            if text := _joined(para).strip():
                blocks.append(("heading", 2, text, page) if n == 0 else ("text", None, text, page))
    return next((t for k, _, t, _ in blocks if k == "heading"), None), blocks


def parse_xlsx(data: bytes) -> tuple[str | None, list[Block]]:
    z = zipfile.ZipFile(io.BytesIO(data))
    shared = [_joined(si) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")) if _local(si.tag) == "si"] if "xl/sharedStrings.xml" in z.namelist() else []
    blocks: list[Block] = []
    sheets = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[0]))
    for page, name in enumerate(sheets, 1):
        for row in (x for x in ElementTree.fromstring(z.read(name)).iter() if _local(x.tag) == "row"):
            cells = []
            for c in row:
                value = _joined(c, "v") or _joined(c)
                cells.append(shared[int(value)] if c.attrib.get("t") == "s" and value else value)
            if any(cells):
                blocks.append(("table_row", None, " | ".join(cells), page))
    return None, blocks


def parse_pdf(data: bytes) -> tuple[str | None, list[Block]]:
    """Pages by whichever PDF library is installed (pypdf or pdfminer); without one an error that says so."""
    try:
        from pypdf import PdfReader
    except ImportError:
        try:
            from pdfminer.high_level import extract_pages
            from pdfminer.layout import LTTextContainer
        except ImportError:
            raise ValueError("PDF needs pypdf or pdfminer, or a parser given to register()") from None
        pages = ["\n\n".join(x.get_text() for x in page if isinstance(x, LTTextContainer)) for page in extract_pages(io.BytesIO(data))]
        title = None
    else:
        reader = PdfReader(io.BytesIO(data))
        pages = [page.extract_text() or "" for page in reader.pages]
        title = reader.metadata.title if reader.metadata else None
    blocks: list[Block] = []
    for n, text in enumerate(pages, 1):
        blocks += [("text", None, " ".join(part.split()), n) for part in re.split(r"\n\s*\n", text) if part.strip()]
    return title, blocks


PARSERS: dict[str, Callable[[bytes], tuple[str | None, list[Block]]]] = {
    ".html": parse_html, ".htm": parse_html, ".md": parse_markdown, ".csv": parse_csv, ".txt": parse_text, ".docx": parse_docx, ".pptx": parse_pptx, ".xlsx": parse_xlsx, ".pdf": parse_pdf,
}


def register(suffix: str, parser: Callable[[bytes], tuple[str | None, list[Block]]]) -> None:
    """Adds or replaces the parser of a suffix."""
    PARSERS[suffix.lower()] = parser


def parse(name: str, data: bytes | str, parsers: dict[str, Callable] | None = None) -> tuple[str | None, list[Block]]:
    ending = re.search(r"\.[^./]+$", name or "")
    parser = (PARSERS if parsers is None else parsers).get(ending[0].lower() if ending else "")
    if parser is None:
        raise ValueError(f"no parser for {name}")
    return parser(data)


def extract(files: DataFrame, *, name: str = "path", content: str = "content") -> DataFrame:
    """Adds title, blocks and error to rows of (name, content); a file that cannot be parsed keeps an error text and
    null blocks and does not disturb the others."""
    parsers = dict(PARSERS)  # travels with the function: what is registered on the driver holds for the tasks
    kept = [f for f in files.schema.fields if f.name != content]
    schema = files.select(*[f.name for f in kept]).schema.add("title", "string").add("blocks", BLOCKS).add("error", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            titles, blocks, errors = [], [], []
            for n, c in zip(batch.column(name).to_pylist(), batch.column(content).to_pylist()):
                try:
                    if c is None:
                        raise ValueError("no content")
                    title, found = parse(n, c, parsers)
                    titles.append(title)
                    blocks.append([{"kind": k, "level": v, "text": t, "page": p} for k, v, t, p in found])
                    errors.append(None)
                except Exception as e:
                    titles.append(None)
                    blocks.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            kind = pa.list_(pa.struct([("kind", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("page", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(titles, pa.string()), pa.array(blocks, kind), pa.array(errors, pa.string())], [*(f.name for f in kept), "title", "blocks", "error"])

    return files.mapInArrow(run, schema)


def page_text(content):
    """The text of an HTML column in generated code: scripts and tags out, white space folded (for counts and search)."""
    c = F.regexp_replace(content, r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"\s+", " "))
