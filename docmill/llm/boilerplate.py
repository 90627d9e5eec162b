"""The main body of web pages, by a linear-chain conditional random field over leaf blocks (problem 4).

A page is the sequence of its blocks: the lines that have a letter or digit outside of tags. A stack of open elements
over the page's lines gives each block its ancestors; an element that is never closed holds nothing, and a line of
nothing but tags is no empty line. Each block has features of its markup (leaf and ancestor tags, list, link, heading), its text (whole line, words, length, marks,
likeness to the title and to the host's name), its place and its neighbours. The field has four states (frame
before the article, article, frame within it, frame after it) and two transition tables, one for neighbours with
an empty line between them. It is trained by maximum likelihood on labelled pages and decoded by Viterbi.

Labelled pages are a table of the caller's (``labels``: source_id, line_no, is_frame), or a bounded sample
(``SAMPLE_PAGES``, chosen by a hash of the id) that is labelled without any list of phrases, from the crawl itself: of
every short line of every page it is counted on how many pages and hosts it recurs, whether it stands before titles and
behind last paragraphs, is a title, a heading or a link, and whether links hang on it (``COUNTS``). From these counts
``Lexicon`` tells topics, menu entries, list heads and other frame; the title line splits top frame and article. Pages
where these signs contradict each other are left out of training; every page is decoded by the field alone. The most
frequent ``LEXICON_LINES`` lines go to the driver. ``trained`` keeps the weights in the shared folder under a fingerprint
of the table, so a table is trained on once.

Defined results: null and empty content has no blocks and no rows; lines are counted at line feeds, from 0;
repeated pages are decoded each for itself; a table with no page that can be labelled yields no frame lines.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmill.pointer import Pointer
from docmill.session import shared_dir

#: Version of features and training; stored weights of others are not used.
VERSION = 3
SAMPLE_PAGES = 2000
#: Pages on which a line must recur to tell anything, and the lines (the most frequent ones) whose counts go to the driver.
MIN_PAGES, LEXICON_LINES = 5, 200_000
WIDTH = 1 << 17  # hashed features
TOP, ARTICLE, WITHIN, AFTER = range(4)

_TAG = regex.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)[^<>]*>|<[^<>]*>")
_LINK = regex.compile(r"\[([^\[\]]*)\]\([^()]*\)")
_WORDY = regex.compile(r"[\p{L}\p{N}]")
_BULLET = regex.compile(r"^\s*(?:[-*•+]\s+|\d{1,3}[.)]\s+)+")
_TAIL = regex.compile(r"(?:\(\d+\)|\[[0-9a-f]+\]|[–-]\s[\w-]+)$")
_WORD = regex.compile(r"[\p{L}\p{M}]+|\p{N}+")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]")
_DIGITS = regex.compile(r"\d+")
_FILE = regex.compile(r"\(\d[\d.,]* ?[KMG]i?B\)$|\.\w{2,5}$")
_DATE = regex.compile(r"\d{4}-\d\d-\d\d")
_COUNTER = regex.compile(r"\(\d+\)$|\[[0-9a-f]+\]$")
_LEVEL = regex.compile(r"h[1-6]")
_END = regex.compile(r"</([a-zA-Z][a-zA-Z0-9]*)[^<>]*>")
#: Parts of a page, the elements that can hold lines, and those that end where the next of their kind begins.
_REGIONS = frozenset("nav footer aside header main article section form table".split())
_HOLDERS = _REGIONS | frozenset("a address blockquote body center dd details dialog div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 html li menu ol p pre span summary tbody td tfoot th thead tr ul".split())
_SIBLINGS = frozenset("dd dt li p td th tr".split())
_SEPARATED = regex.compile(r"(?<!\s)\s?[|/>›»·]\s+|\s{2,}(?:[|/>›»·]\s+)?")


def _untailed(low: str) -> str:
    """A line without the counter, mark or host name at its end."""
    return _TAIL.sub("", low.strip()).rstrip()


class Block:
    __slots__ = ("line", "tags", "text", "full", "low", "words", "gap", "link", "bullet", "head", "whole", "size", "path", "region")

    def __init__(self, line: int, raw: str, gap: int, path: tuple[str, ...] = ()):
        self.line, self.gap, self.path = line, gap, path
        self.region = next((x for x in reversed(path) if x in _REGIONS), "")
        tags = [m[2].lower() for m in _TAG.finditer(raw) if m[2] and not m[1]] if "<" in raw else []
        text = _TAG.sub(" ", raw).strip() if "<" in raw else raw.strip()
        self.head = len(text) - len(text.lstrip("#")) if text.startswith("#") else next((int(x[1]) for x in (*tags[:1], *path[-1:]) if _LEVEL.fullmatch(x)), 0)
        text = text.lstrip("#").strip()
        self.bullet = bool(_BULLET.match(text)) or "li" in tags or "li" in path[-2:]
        linked = "](" in text
        self.full = (_LINK.sub(r"\1", text) if linked else text).strip().lower()
        plain = _BULLET.sub("", text)
        self.link = "a" in tags or "a" in path or (linked and bool(_LINK.search(plain)))
        self.text = (_LINK.sub(r"\1", plain) if linked else plain).strip()
        self.tags = tags
        self.low = _untailed(self.text.lower())
        self.words = _WORD.findall(self.low)
        self.size = _bucket(len(self.text))
        self.whole = _DIGITS.sub("0", self.low) if len(self.text) < 160 else ""


def blocks_of(content: str | None) -> list[Block]:
    """The blocks of a page."""
    out: list[Block] = []
    gap = 0
    content = content or ""
    ends = Counter(name.lower() for name in _END.findall(content)) if "</" in content else Counter()
    stack: list[str] = []
    for n, raw in enumerate(content.split("\n")):
        path, at = None, 0
        for m in _TAG.finditer(raw) if "<" in raw else ():
            if path is None and _WORDY.search(raw, at, m.start()):
                path = tuple(stack)
            at = m.end()
            name = (m[2] or "").lower()
            if name not in _HOLDERS:
                continue
            if m[1]:
                ends[name] -= 1
                if name in stack:
                    while stack.pop() != name:
                        pass
            else:
                if name in _SIBLINGS and stack[-1:] == [name]:
                    stack.pop()
                if ends[name] > stack.count(name) and not m[0].endswith("/>"):
                    stack.append(name)
        if path is None and _WORDY.search(raw, at):
            path = tuple(stack)
        if path is not None:
            out.append(Block(n, raw, gap, path))
            gap = 0
        elif not at or _TAG.sub("", raw).strip():
            gap += 1
    return out


def host_words(path: str | None) -> str:
    """The host's name as words, as a site writes its own name."""
    part = (path or "").split("/")
    host = part[1] if len(part) > 1 else ""
    return host.rsplit(".", 1)[0].replace("-", " ").lower()


def _joined(low: str) -> list[str]:
    parts = [p for p in _SEPARATED.split(low) if p]
    return parts if len(parts) > 1 else []


def line_key(text: str) -> int:
    """A 64-bit number of a line's text."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


#: What is counted of a line's text over the whole crawl. ``pages``: pages with it; ``before``, ``after``: occurrences before
#: and after the title line; ``tail``: of the latter, those behind the last paragraph; ``marked``, ``head``: occurrences on
#: pages with marked headings, and as one; ``linked``, ``link``: on pages with links, and as one; ``led``, ``leads``: those
#: on pages with links that another line follows at once, and where that is a link; ``titles``: pages of that title.
COUNTS = ("pages", "before", "after", "tail", "marked", "head", "linked", "link", "led", "leads", "titles")
_SENTENCE = regex.compile(r"[.!?。！？…]$")
_RECORD = regex.compile(r"\d{4}-\d\d-\d\d[T ]\d\d|[0-9a-f]{6,}:|```|>>>|\|")
_LEAD = regex.compile(r"^([^:：]{3,40})\s?[:：]\s?(?=\S)")


def _is_paragraph(b: Block) -> bool:
    return not b.link and not b.head and b.text[:1] != "|" and len(b.text) >= (50 if _CJK.search(b.low) else 120)


def title_at(blocks: list[Block], title: str | None) -> int:
    """The block that is the page's title, the first of them; -1 if there is none."""
    name = (title or "").strip().lower()
    return next((n for n, b in enumerate(blocks) if name and name in (b.full, b.text.lower())), -1)


def bare(text: str) -> str:
    """A line's text without the colon at its end."""
    return text.rstrip(":： ") or text


def keys_of(b: Block) -> list[int]:
    """The texts a line is counted under: itself without counters and figures, and what leads it up to a colon."""
    if not b.whole:
        return []
    out = [line_key(bare(b.whole))]
    if m := _LEAD.match(b.whole):
        out.append(line_key(m[1] + ":"))
    return out


def count_lines(pages: Iterator[tuple[str | None, str | None, str | None]]) -> dict[tuple[int, str], np.ndarray]:
    """(line, host) -> COUNTS over some pages (path, title, content)."""
    out: dict[tuple[int, str], np.ndarray] = {}
    for path, title, content in pages:
        blocks, site = blocks_of(content), host_words(path)
        at = title_at(blocks, title)
        marked, linked = any(b.head for b in blocks), any(b.link for b in blocks)
        last = max((n for n, b in enumerate(blocks) if _is_paragraph(b)), default=len(blocks))
        seen: set[int] = set()
        for n, b in enumerate(blocks):
            follows = linked and n + 1 < len(blocks) and not blocks[n + 1].gap
            fact = (0, at >= 0 and n < at, at >= 0 and n > at, at >= 0 and n > max(at, last), marked, b.head > 0, linked, b.link, follows, follows and blocks[n + 1].link, 0)
            for key in keys_of(b):
                row = out.get((key, site))
                if row is None:
                    row = out[key, site] = np.zeros(len(COUNTS), np.int64)
                row += fact
                if key not in seen:
                    seen.add(key)
                    row[0] += 1
        if title and title.strip():
            key = line_key(_DIGITS.sub("0", _untailed(title.strip().lower())))
            out.setdefault((key, site), np.zeros(len(COUNTS), np.int64))[-1] += 1
    return out


class Lexicon:
    """Kinds of the lines that recur over the crawl, from their counts alone.

    A line that recurs on ``MIN_PAGES`` pages is a ``topic`` if it is a title or a heading somewhere. Of the others a link
    (or a line of a crawl without links) that stands before titles, and elsewhere at times without being one, is a ``menu`` entry, which counts only beside other frame; what links hang on is the
    head of a ``list`` (a ``lead-in`` if it stands in the text only); what is mostly a link itself, stands before titles at times, or mostly there and behind last
    paragraphs, or on one host only, is ``frame``; a short rest on several hosts, on pages where headings are marked, is an ``advert``. ``lead`` is what a line
    with a topic behind its colon begins with.
    """

    def __init__(self, rows: dict[int, tuple]):
        self.kinds: dict[int, str] = {}
        for key, (hosts, *counts) in rows.items():
            c = dict(zip(COUNTS, counts))
            if c["titles"] or c["head"] > 0.1 * c["marked"]:
                self.kinds[key] = "topic"
            if c["pages"] < MIN_PAGES or key in self.kinds:
                continue
            total = max(1, c["before"] + c["after"])
            edge = (c["before"] + c["tail"]) / total
            linked = c["link"] / max(1, c["linked"])
            if (linked >= 0.3 or not c["linked"]) and c["before"] >= (0.2 if linked < 0.98 else 0.5) * total:
                self.kinds[key] = "menu"
            elif c["led"] >= 3 and c["leads"] > 0.5 * c["led"] and linked <= 0.1 and hosts > 1:
                self.kinds[key] = "list" if c["before"] >= 0.1 * total else "lead-in"
            elif linked >= 0.6 or (c["linked"] and c["before"] >= 0.2 * total) or edge >= 0.6 or (hosts == 1 and edge >= 0.3):
                self.kinds[key] = "frame"
            elif hosts >= 3 and c["marked"] >= 3:
                self.kinds[key] = "advert"

    def of(self, text: str) -> str | None:
        return self.kinds.get(line_key(bare(text)))

    def kind(self, b: Block, site: str) -> str | None:
        """The kind of a line: ``site``, ``frame``, ``list``, ``lead-in``, ``menu``, ``advert`` or None."""
        if site and b.low == site:
            return "site"
        if not b.whole or b.head or _FILE.search(b.text) or _RECORD.match(b.text):
            return None
        if "©" in b.text:
            return "frame"
        kind = self.of(b.whole)
        if kind == "topic":
            return None
        if kind is None and (m := _LEAD.match(b.whole)) and line_key(m[1] + ":") in self.kinds and self.of(b.whole[m.end() :]) == "topic":
            return "advert"
        if kind == "advert" and (_SENTENCE.search(b.whole) or b.whole[-1] in ":：" or len(b.whole) > 40 or b.bullet):
            return None
        if kind is None and (parts := _joined(b.low)):
            known = [self.of(_DIGITS.sub("0", _untailed(p))) for p in parts]
            if sum(k in ("frame", "list", "lead-in") for k in known) * 2 >= len(parts) or (sum(k in ("menu", "topic") for k in known) == len(parts) and "menu" in known):
                return "frame"
        return kind


def label_page(blocks: list[Block], title: str | None, site: str, lexicon: Lexicon) -> list[int] | None:
    """States of the blocks of a page from its title and the lines that recur; None if the signs are missing or
    contradict each other."""
    name = (title or "").strip().lower()
    kinds = [lexicon.kind(b, site) for b in blocks]
    for n, kind in enumerate(kinds):
        if kind == "lead-in":  # a list of menu entries in the text is one that the article speaks of
            kinds[n] = None if n + 1 < len(kinds) and kinds[n + 1] == "menu" else "list"
    at = title_at(blocks, title)
    if at < 0:
        known = sum(k is not None for k in kinds)
        if name and known >= 3 and known * 2 >= len(blocks) and not any(_is_paragraph(b) for b in blocks):
            return [TOP] * len(blocks)  # nothing but frame
        return None
    if any(b.text[:1] == "|" or len(b.text) > 220 or _RECORD.match(b.text) for b in blocks[:at]):
        return None  # that was not the title's first place
    states = [TOP] * at + [ARTICLE] * (len(blocks) - at)
    mode, hanging = "", 0
    for n in range(at + 1, len(blocks)):
        b, kind = blocks[n], kinds[n]
        if kind == "menu":
            kind = "frame" if not b.gap and states[n - 1] == WITHIN and mode != "advert" else None
        if kind:
            states[n], mode, hanging = WITHIN, kind, 0
            continue
        if b.gap or b.head:
            mode = ""
            continue
        hanging += 1
        if (mode == "list" and b.text[:1] != "|") or (mode == "site" and hanging <= 3):
            states[n] = WITHIN
    # the last lines that hang together, from the first frame line among them that only short lines follow
    start = len(blocks)
    for n in range(len(blocks) - 1, at, -1):
        if states[n] == WITHIN:
            start = n
        elif _is_paragraph(blocks[n]) and states[n] == ARTICLE and not any(states[k] == WITHIN for k in range(max(at + 1, n - 2), n)):
            break
        if blocks[n].gap and states[n] == ARTICLE:
            break
        if blocks[n].gap and n - 1 > at and states[n - 1] == ARTICLE:
            break
    for n in range(start, len(blocks)):
        states[n] = AFTER
    return states


class _Names(dict):
    """Feature name -> hashed number."""

    def __missing__(self, name: str) -> int:
        value = self[name] = zlib.crc32(name.encode("utf-8", "surrogatepass")) % WIDTH
        return value


_NAMES = _Names()


class _Texts(dict):
    """A line's text (whole line, lower case) -> number of its joined parts, hashed features of its words and parts."""

    def __missing__(self, key: tuple[str, str]) -> tuple[int, list[int]]:
        whole, low = key
        parts = _joined(low)
        f = [f"W{whole}"] if whole else []
        f += ["P" + _DIGITS.sub("0", _untailed(p)) for p in parts]
        if len(low) < 120:
            f += [f"w{w}" for w in _WORD.findall(low)]
            if _CJK.search(low):
                f += [f"b{low[at : at + 3]}" for at in range(len(low))]
        value = len(parts), list(map(_NAMES.__getitem__, f))
        if len(low) < 400:  # lines that can recur
            if len(self) > 50_000:
                self.clear()
            self[key] = value
        return value


_TEXTS = _Texts()


def _bucket(n: int) -> int:
    return n if n < 4 else 4 + int(np.log2(n / 4) * 2)


_BUCKETS = [_bucket(n) for n in range(4096)]


class _Groups(dict):
    """Values of features that go together -> their hashed numbers. Few combinations occur, so a look-up stands for many."""

    def __init__(self, names):
        super().__init__()
        self.names = names

    def __missing__(self, key: tuple) -> list[int]:
        if len(self) > 50_000:
            self.clear()
        value = self[key] = list(map(_NAMES.__getitem__, self.names(*key)))
        return value


def _form(k, words, end, gap, tags, head, kind, parts, path, region, link, upper, marks) -> list[str]:
    tag = tags[0] if tags else ""
    return [
        f"l{k}", f"n{words}", f"e{end}", f"g{gap}", f"t{'.'.join(tags)}", f"h{head}", f"a{kind}", f"s{min(parts, 5)}", f"le{k}{end}", f"tg{tag}{kind}{k}", f"gl{gap}{k}",
        f"A{'>'.join(path[-3:])}", f"R{region}", f"RK{region}{k}{link:d}", *{f"I{x}" for x in path}, f"U{upper:d}", *marks,
    ]


def _place(title, seen, k, end, crumb, site, within, gap, ahead, behind) -> list[str]:
    return [
        f"T{title:d}", f"S{seen:d}", f"SL{seen:d}{k}{end}", f"C{crumb}", f"H{site:d}{within:d}", f"G{min(ahead, 3)}{min(behind, 3)}", f"GA{min(ahead, 2)}{k}{end}", f"GS{min(ahead, 2)}{seen:d}{gap}",
    ]


def _beside(label, size, site, tag, kind, head, own, regions, gap) -> list[str]:
    out = [f"{label}l{size}", f"{label}h{site:d}", f"{label}t{tag}{kind}{head}", f"{label}ll{size},{own}", f"{label}R{regions[0]}>{regions[1]}"]
    return [*out, f">g{gap}"] if label == ">" else out


_FORMS, _PLACES, _BESIDE = _Groups(_form), _Groups(_place), _Groups(_beside)
_ENDS = frozenset(".!?。！？:：…)]")


def features(blocks: list[Block], title: str | None, site: str) -> list[list[int]]:
    """Hashed features of each block."""
    name = (title or "").strip().lower()
    n = len(blocks)
    if len(_NAMES) > 500_000:
        for table in (_NAMES, _TEXTS, _FORMS, _PLACES, _BESIDE):
            table.clear()
    look = _NAMES.__getitem__
    gaps = np.cumsum([min(b.gap, 1) for b in blocks]).tolist()
    seen = False
    out = []
    kinds = [f"{b.link:d}{b.bullet:d}" for b in blocks]
    at_site = [b.low == site for b in blocks]
    whole = [look("<W" + b.whole) for b in blocks], [look(">W" + b.whole) for b in blocks]
    alone = look("<none"), look(">none")
    for i, b in enumerate(blocks):
        low, k, gap, text = b.low, b.size, min(b.gap, 2), b.text
        last = text[-1:] or " "
        end = last if last in _ENDS else "w" if last.isalpha() else "n" if last.isdigit() else "o"
        parts, of_text = _TEXTS[b.whole, low]
        words = len(b.words)
        marks = (
            ("copyright",) * ("©" in text) + ("file",) * bool(_FILE.search(text)) + ("row",) * (text[:1] == "|")
            + ((f"date{text[10:11] == 'T':d}",) if _DATE.match(text) else ()) + ("counter",) * bool(_COUNTER.search(text))
        )
        is_title = bool(name) and name in (b.full, text.lower())
        seen = seen or is_title or (not name and b.head == 1)
        crumb = f"{bool(name) and not is_title and low.endswith(name):d}{min(parts, 3)}"
        f = [
            *_FORMS[k, _BUCKETS[words] if words < 4096 else _bucket(words), end, gap, tuple(b.tags[:2]), b.head, kinds[i], min(parts, 5), b.path, b.region, b.link, text.isupper(), marks],
            *_PLACES[is_title, seen, k, end, crumb, at_site[i], bool(site) and site in low, gap, min(gaps[-1] - gaps[i], 3), min(gaps[i], 3)],
            look(f"p{min(i, 12)}"), look(f"q{min(n - 1 - i, 12)}"), *of_text,
        ]
        if b.whole:  # the line's own words count for short lines; long ones tell little by them
            f.append(look(f"WS{seen:d}{b.whole}"))
        for side, (label, j) in enumerate((("<", i - 1), (">", i + 1))):
            if 0 <= j < n:
                o = blocks[j]
                f += _BESIDE[label, o.size, at_site[j], o.tags[0] if o.tags else "", kinds[j], o.head, k, (o.region, b.region), min(o.gap, 2)]
                f.append(whole[side][j])
            else:
                f.append(alone[side])
        out.append(f)
    return out


class Field:
    """Weights of the field: ``emit`` (feature, state), ``move`` (gap, from, to), ``first`` (state)."""

    def __init__(self) -> None:
        self.emit = np.zeros((WIDTH, 4), np.float32)
        self.move = np.zeros((2, 4, 4), np.float64)
        self.first = np.zeros(4, np.float64)

    def scores(self, feats: list[list[int]]) -> np.ndarray:
        if not feats:
            return np.zeros((0, 4))
        flat = np.fromiter((x for f in feats for x in f), np.int64)
        starts = np.concatenate([[0], np.cumsum([len(f) for f in feats])[:-1]])
        return np.add.reduceat(self.emit[flat], starts, axis=0).astype(np.float64)

    def decode(self, feats: list[list[int]], gaps: list[int]) -> list[int]:
        """The likeliest states (Viterbi)."""
        e = self.scores(feats)
        if not len(e):
            return []
        best = self.first + e[0]
        back = np.zeros((len(e), 4), np.int8)
        for t in range(1, len(e)):
            total = best[:, None] + self.move[min(gaps[t], 1)]
            back[t] = total.argmax(0)
            best = total.max(0) + e[t]
        path = [int(best.argmax())]
        for t in range(len(e) - 1, 0, -1):
            path.append(int(back[t, path[-1]]))
        return path[::-1]

    def train(self, pages: list[tuple[list[list[int]], list[int], list[int]]], *, rounds: int = 6, rate: float = 0.25, decay: float = 1e-5, seed: int = 5) -> None:
        """Maximum likelihood by AdaGrad on batches of pages (features, gaps, states)."""
        rng = np.random.default_rng(seed)
        order = np.argsort([len(p[2]) for p in pages], kind="stable")
        batches = [_Batch([pages[i] for i in order[at : at + 32]]) for at in range(0, len(order), 32)]
        used, dense = np.unique(np.concatenate([b.flat for b in batches]), return_inverse=True)
        at = 0
        for b in batches:  # features by their place among those that occur
            b.flat, at = dense[at : at + len(b.flat)], at + len(b.flat)
        emit = self.emit[used].astype(np.float64)
        square = np.full(emit.shape, 1e-2)
        square_move, square_first = np.full((2, 4, 4), 1e-2), np.full(4, 1e-2)
        for _ in range(rounds):
            for k in rng.permutation(len(batches)):
                b = batches[k]
                e = np.zeros((len(b.sizes), b.most, 4))
                e[b.row, b.col] = np.add.reduceat(emit[b.flat], b.starts, axis=0)
                alpha, beta = np.zeros_like(e), np.zeros_like(e)
                alpha[:, 0] = self.first + e[:, 0]
                for t in range(1, b.most):
                    new = _lse(alpha[:, t - 1, :, None] + self.move[b.gap[:, t]], 1) + e[:, t]
                    alpha[:, t] = np.where(b.live[:, t, None], new, alpha[:, t - 1])
                for t in range(b.most - 2, -1, -1):
                    new = _lse(self.move[b.gap[:, t + 1]] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                    beta[:, t] = np.where(b.live[:, t + 1, None], new, 0)
                total = _lse(alpha[:, -1], 1)[:, None, None]
                node = np.exp(alpha + beta - total)
                node[~b.live] = 0
                grad_node = -node
                grad_node[b.row, b.col, b.gold[b.row, b.col]] += 1
                grad_move = np.zeros((2, 4, 4))
                if b.most > 1:
                    pair = np.exp(alpha[:, :-1, :, None] + self.move[b.gap[:, 1:]] + (e + beta)[:, 1:, None, :] - total[..., None])[b.live[:, 1:]]
                    gap = b.gap[:, 1:][b.live[:, 1:]]
                    for g in (0, 1):
                        grad_move[g] -= pair[gap == g].sum(0)
                    np.add.at(grad_move, (gap, b.gold[:, :-1][b.live[:, 1:]], b.gold[:, 1:][b.live[:, 1:]]), 1.0)
                g = np.repeat(grad_node[b.row, b.col], b.count, axis=0)
                grad = np.stack([np.bincount(b.flat, g[:, s], len(emit)) for s in range(4)], 1)
                hit = np.bincount(b.flat, minlength=len(emit)) > 0
                grad[hit] -= decay * emit[hit]
                square += grad * grad
                emit += rate * grad / np.sqrt(square)
                square_move += grad_move**2
                self.move += rate * grad_move / np.sqrt(square_move)
                grad_first = grad_node[:, 0].sum(0)
                square_first += grad_first**2
                self.first += rate * grad_first / np.sqrt(square_first)
        self.emit[used] = emit


class _Batch:
    """Pages of about one length as arrays."""

    def __init__(self, pages: list[tuple[list[list[int]], list[int], list[int]]]):
        self.sizes = np.array([len(p[2]) for p in pages])
        self.most = int(self.sizes.max())
        self.flat = np.fromiter((x for p in pages for f in p[0] for x in f), np.int64)
        self.count = np.fromiter((len(f) for p in pages for f in p[0]), np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.count)[:-1]])
        self.row = np.repeat(np.arange(len(pages)), self.sizes)
        self.col = np.concatenate([np.arange(s) for s in self.sizes])
        self.gap, self.gold = np.zeros((2, len(pages), self.most), int)
        self.gap[self.row, self.col] = np.minimum(np.concatenate([p[1] for p in pages]), 1)
        self.gold[self.row, self.col] = np.concatenate([p[2] for p in pages])
        self.live = np.arange(self.most)[None, :] < self.sizes[:, None]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def _merged(counts: Iterable[tuple[int, str, tuple]]) -> dict[int, tuple]:
    """line -> (hosts, *COUNTS)."""
    out: dict[int, np.ndarray] = {}
    for key, _, row in counts:
        got = out.get(key)
        if got is None:
            got = out[key] = np.zeros(len(COUNTS) + 1, np.int64)
        got[0] += row[0] > 0
        got[1:] += row
    return {k: tuple(map(int, v)) for k, v in out.items()}


def states_of(blocks: list[Block], frame: set[int]) -> list[int]:
    """States of a page whose frame lines are known."""
    article = [n for n, b in enumerate(blocks) if b.line not in frame]
    if not article:
        return [TOP] * len(blocks)
    first, last = article[0], article[-1]
    return [ARTICLE if b.line not in frame else TOP if n < first else AFTER if n > last else WITHIN for n, b in enumerate(blocks)]


def train_field(pages: list[tuple[str | None, str | None, str | None]], lexicon: Lexicon | None = None, frames: list[set[int]] | None = None, **settings) -> Field | None:
    """A field trained on the pages (path, title, content) with their ``frames`` (line numbers), or on those of them that
    can be labelled by the lexicon (else that of the pages themselves); None if there are none."""
    if frames is None and lexicon is None:
        lexicon = Lexicon(_merged((k, h, v) for (k, h), v in count_lines(iter(pages)).items()))
    rows = []
    for n, (path, title, content) in enumerate(pages):
        blocks, site = blocks_of(content), host_words(path)
        states = (states_of(blocks, frames[n]) if frames is not None else label_page(blocks, title, site, lexicon)) if blocks else None
        if states:
            gaps = [b.gap for b in blocks]
            rows.append((features(blocks, title, site), gaps, states))
            if title and zlib.crc32(site.encode()) + len(blocks) & 7 == 0:  # some pages have no title: learn to do without
                rows.append((features(blocks, None, site), gaps, states))
    if not rows:
        return None
    field = Field()
    field.train(rows, **settings)
    return field


def crawl_lexicon(sources: DataFrame) -> Lexicon:
    """Counts of the recurring lines of all pages: summed in each task first, then by line and host, then by line."""
    schema = "line long, host string, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                found = count_lines(zip(*(batch.column(c).to_pylist() for c in ("path", "title", "content"))))
                if found:
                    counts = np.array(list(found.values()), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in found], pa.int64()), pa.array([h for _, h in found]), *(pa.array(counts[:, n]) for n in range(len(COUNTS)))], ["line", "host", *COUNTS]
                    )

    rows = sources.select("path", "title", "content").where("content is not null").mapInArrow(run, schema)
    by_host = rows.groupBy("line", "host").agg(*[F.sum(c).alias(c) for c in COUNTS])
    lines = by_host.groupBy("line").agg(F.count_if(F.col("pages") > 0).alias("hosts"), *[F.sum(c).alias(c) for c in COUNTS]).where(F.col("pages") >= MIN_PAGES)
    top = lines.orderBy(F.desc("pages"), "line").limit(LEXICON_LINES).toArrow()  # the most frequent lines, a bounded number
    columns = [top.column(c).to_pylist() for c in ("line", "hosts", *COUNTS)]
    return Lexicon({row[0]: row[1:] for row in zip(*columns)})


def _sampled(sources: DataFrame, pages: int, of: int) -> DataFrame:
    """About ``pages`` of ``of`` rows, by a hash of the id alone."""
    return sources.where(F.pmod(F.xxhash64("source_id"), F.lit(1 << 30)) < int(min(1.0, pages / max(1, of)) * (1 << 30)))


def fit(sources: DataFrame, sample_pages: int = SAMPLE_PAGES, labels: DataFrame | None = None) -> Field | None:
    """The field for a table of pages, trained on about ``sample_pages`` of them, or of those in ``labels``."""
    columns = ["source_id", "path", "title", "content"]
    if labels is not None:
        known = labels.where("source_id is not null").groupBy("source_id").agg(F.collect_set(F.when(F.col("is_frame"), F.col("line_no"))).alias("frame"))
        pages = sources.join(known, "source_id").select(*columns, "frame")
        sample = _sampled(pages, sample_pages, known.count()).collect()
    else:
        sample = _sampled(sources, sample_pages, sources.count()).select(*columns).collect()
    sample.sort(key=lambda r: (r.source_id is None, r.source_id, r.content or ""))
    given = [(r.path, r.title, r.content) for r in sample]
    if labels is not None:
        return train_field(given, frames=[set(r.frame) for r in sample])
    return train_field(given, crawl_lexicon(sources))


def trained(sources: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Field | None:
    """The field of a table, trained once: its weights are kept in the shared folder under a fingerprint of all rows."""
    spark = sources.sparkSession
    row = sources.agg(F.count("*").alias("n"), F.sum(F.xxhash64("source_id", "path", "title", "content").cast("decimal(38,0)")).alias("sum")).first()
    mark = hashlib.blake2b(f"{VERSION} {row.n} {row['sum']} {sample_pages}".encode(), digest_size=12).hexdigest()
    folder = f"{shared_dir(spark)}/docmill/field-{mark}"
    files = Pointer(spark, folder)
    if not files.fs.exists(files.path(f"{folder}/_SUCCESS")):
        field = fit(sources, sample_pages)
        rows = [(bytearray(x.astype("<f4").tobytes()),) for x in ((field.emit, field.move, field.first) if field else ())]
        frame = spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "part int, weights binary")
        frame.coalesce(1).write.mode("overwrite").parquet(folder)
    parts = spark.read.schema("part int, weights binary").parquet(folder).orderBy("part").collect()
    if not parts:
        return None
    field = Field()
    field.emit, field.move, field.first = (np.frombuffer(bytes(p.weights), "<f4").reshape(shape).astype(kind) for p, shape, kind in zip(parts, ((WIDTH, 4), (2, 4, 4), (4,)), (np.float32, np.float64, np.float64)))
    return field


def decode_page(model: Field | None, path: str | None, title: str | None, content: str | None) -> tuple[list[Block], list[int]]:
    """The blocks of a page and their states."""
    blocks = blocks_of(content)
    if model is None:
        return blocks, [ARTICLE] * len(blocks)
    return blocks, model.decode(features(blocks, title, host_words(path)), [b.gap for b in blocks])


def _mapped(sources: DataFrame, field: Field | None, sample_pages: int, schema: str, rows_of) -> DataFrame:
    """Each page through ``rows_of(id, blocks, states)``; the field (a fixed number of weights, 2 MB) is broadcast."""
    spark = sources.sparkSession
    field = field or trained(sources, sample_pages)
    shared = spark.sparkContext.broadcast((field.emit, field.move, field.first) if field else None)
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        if shared.value is not None:
            model = Field()
            model.emit, model.move, model.first = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                batch = whole.slice(at, 200)
                rows = []
                for sid, path, title, content in zip(*(batch.column(c).to_pylist() for c in ("source_id", "path", "title", "content"))):
                    rows += rows_of(sid, *decode_page(model, path, title, content))
                columns = zip(*rows) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, types)], names)

    rows = sources.select(F.col("source_id").cast("long").alias("source_id"), "path", "title", "content")
    return rows.mapInArrow(run, schema)


def classify(sources: DataFrame, *, field: Field | None = None, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """(source_id, line_no, is_frame, text) of every block of every page; no shuffle."""

    def rows_of(sid, blocks, states):
        return [(sid, b.line, s != ARTICLE, b.text) for b, s in zip(blocks, states)]

    return _mapped(sources, field, sample_pages, "source_id long, line_no long, is_frame boolean, text string", rows_of)


def bodies(sources: DataFrame, *, field: Field | None = None, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """(source_id, body): the article's blocks, an empty line where the page has one; one row for each page, null
    where nothing of the page is article."""

    def rows_of(sid, blocks, states):
        kept = [b for b, s in zip(blocks, states) if s == ARTICLE]
        text = "".join(("\n\n" if b.gap else "\n") + b.text for b in kept).strip()
        return [(sid, text or None)]

    return _mapped(sources, field, sample_pages, "source_id long, body string", rows_of)
