"""Sentence units across languages and scripts, by cascading segmentation rule tables (problem 8).

A text is taken apart by tables only, each an ordered list in which the first match decides.

* ``LINES`` knows the lines that are units of their own: headings, list items with their marker, table rows, code and
  log lines. What is left is running text, which a single line break does not end.
* ``SPANS`` knows quotations and brackets. A possible end inside one never ends a unit; where one closes, the rules
  are asked again.
* ``PLACES`` says where a unit can end: behind a run of sentence marks (Unicode's sentence terminals and the dots) with
  its closing quotes and brackets, in Thai text at white space.
* ``TABLES`` decide each such place: a rule is a pair of regular expressions, for what stands before and after it, and
  says break or no break. ``CASCADES`` names the tables of each kind of text in the order in which they are tried.

The kind of a stretch of running text follows from its script, then from the text's language tag; a text without a
known tag is of the Latin language of which it has the most function words (``FUNCTION_WORDS``). Texts of one tag hold
sentences of other languages, so their tables are tried behind the own one, without what is a word there (``ORDINARY``).

Defined results: null, empty and blank texts have no units; a unit runs from its first to after its last
non-white character, in code points; pieces without a letter or digit are dropped. Unpaired quotes and brackets
are ignored. Language tags are cut at the hyphen and lower-cased. Time is linear in the text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Abbreviations by what may follow them, one table for each language.
#: Never the end of a sentence: titles and introductions of a name or an example.
BOUND = {
    "en": "Dr Mr Mrs Ms Prof Gov Sen Rep Gen Col Capt Lt Sgt Rev Hon Messrs e.g i.e viz cf vs al esp incl resp",
    "de": "Dr Prof Hr Fr Frl Hrn z.B d.h u.a o.ä i.d.R bzw ca vgl inkl evtl ggf sog bspw",
    "fr": "Dr M Mme Mlle MM Mgr Me Ste c.-à-d p.ex cf env",
    "es": "Dr Dra Sr Sra Srta D Dña Ud Uds Prof Lic Ing p.ej aprox",
}
#: Not the end before a number: figures, pages, paragraphs.
NUMBERED = {
    "en": "Fig Figs Sec Art par p pp col no No Nos Vol vol Ch ch Eq eq approx Ref ref Tab Ex",
    "de": "Abb Nr Nrn Art Abs Kap S Bd Tab Ziff",
    "fr": "fig art p pp n chap vol env",
    "es": "pág págs fig art núm n cap vol",
}
#: The end only before a capital: words that close a list or follow a number.
OPEN = {
    "en": "etc yr yrs hr hrs min a.m p.m approx Corp Inc Ltd Co Rd Ave Blvd Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec Mon Tue Tues Wed Thu Thurs Fri Sat Sun dept est ed eds",
    "de": "usw etc Std Min Sek Jh Mio Mrd Tsd Jan Feb Apr Aug Sept Okt Nov Dez Str GmbH",
    "fr": "etc av boul hab janv févr avr juil sept oct nov déc",
    "es": "etc hab aprox ene feb abr ago sept oct nov dic",
}
#: Not the end before a noun, which German writes with a capital, if they follow a number.
COUNTED = {"de": "Mio Mrd Tsd"}
#: Words that begin a sentence and no name: behind an initial, initials in a row or a saint's or street's ``St.`` they show its end.
STARTERS = {
    "en": "The This That These Those It Its He She We They You There Here In On At An If When While After Before But And So However His Her Their Our My As For From To Then Each Every All Some Many Most What Why How Where Who",
    "de": "Der Die Das Dies Diese Dieser Dieses Es Er Sie Wir Ich Ein Eine Im In Am Auf Bei Mit Nach Für Wenn Aber Und Doch Dann Danach Hier Dort Jede Jeder Alle Kein Keine Zum Zur Vor Wer Was Wie Wo Warum",
    "fr": "Les Un Une Ce Cette Ces Il Elle Ils Elles On Nous Vous Je Dans En Au Aux À Pour Par Sur Si Quand Mais Et Puis Chaque Tous Toutes Aucun Aucune Qui Pourquoi Comment Où",
    "es": "Los Las Un Una Este Esta Estos Estas Se No En Con Por Para Si Cuando Pero Y Cada Todos Todas Ningún Ninguna Qué Quién Cómo Dónde",
}
#: The commonest function words, for texts without a known tag.
FUNCTION_WORDS = {
    "en": "the of and to is in that for was with are on by it at from not this be as",
    "de": "der die das und ist nicht ein eine mit den von zu im auf für dem des sich wird es",
    "fr": "le les des et est une dans pour que sur par du au ce il ne pas sont aux plus",
    "es": "el los las y es una en para con por del al no se su lo más como son sin",
}
#: Abbreviations of other languages that are ordinary words here, so they do not count in a text of this language.
ORDINARY = {"en": "Me", "de": "Me", "fr": "Col", "es": "Me"}
ORDINAL_NOUNS = "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Quartal|Halbjahr|Jahrhundert|Platz|Stock|Tag|Woche|Monat|Mal|Teil|Kapitel|Auflage|Klasse"

Rule = tuple[bool, str, str]
_CLOSE = r"""["'”’“»)\]」』）］】›]"""
#: Sentence marks: the terminals of Unicode (property Sentence_Break, values STerm and ATerm), ellipsis and Tibetan strokes.
_END = r"\p{SB=ST}\p{SB=AT}…།༎"
#: Terminals that no other table speaks of; scripts that have them need no space behind them.
_TERMINAL = r"[\p{SB=ST}།༎--[!?؟۔।॥。！？]]"


def _any(words: str, but: str = "") -> str:
    return "|".join(regex.escape(w) for w in sorted(set(words.split()) - set(but.split()), key=len, reverse=True))


def _latin(language: str, within: str | None = None) -> list[Rule]:
    """The table of a language; ``within``: for its sentences in a text of another language."""
    edge = r"(?<![\p{L}\p{N}.])"
    words = ORDINARY.get(within or "", "")
    starts = rf"\s+(?:{_any(STARTERS[language])})\b"
    rules: list[Rule] = [
        (False, rf"{edge}(?:{_any(BOUND[language], words)})\.", r"\s"),
        (False, rf"{edge}(?:{_any(NUMBERED[language], words)})\.", r"\s*\p{N}"),
        (False, rf"{edge}(?:{_any(OPEN[language], words)})\.", r"\s+(?![\p{Lu}\p{Lo}\"“„«(¿¡‘'])"),
    ]
    if not within:
        rules[1:1] = [(True, rf"{edge}(?:St|(?:\p{{L}}\.)*\p{{L}})\.", starts), (False, rf"{edge}St\.", r"\s")]
    if language in COUNTED:
        counted = rf"\p{{N}}\s?(?:{_any(COUNTED[language])})\."
        rules += [(True, counted, starts), (False, counted, r"\s")]
    rules.append((True, rf"{edge}(?:{_any(OPEN[language], words)})\.", r"\s"))
    if language == "de":
        rules.insert(0, (False, r"(?<![\p{L}\p{N}.,])\p{N}{1,2}\.", rf"\s+(?:{ORDINAL_NOUNS})\b"))
        if not within:
            rules.insert(1, (False, r"\b(?:[Aa]m|[Ii]m|[Vv]om|[Zz]um|[Bb]eim|[Dd]er|[Dd]ie|[Dd]as|[Dd]em|[Dd]en|[Dd]es)\s+\p{N}{1,2}\.", r"\s"))
    return rules


TABLES: dict[str, list[Rule]] = {
    **{language: _latin(language) for language in BOUND},
    **{f"{language} within {own}": _latin(language, own) for own in BOUND for language in BOUND if language != own},
    "initials": [
        (True, r"\p{N}\s?°?\p{L}\.", r"\s+\p{Lu}"),  # a unit of measure
        (False, r"(?<![\p{L}\p{N}.\-])\p{L}\p{M}*\.", r"\s"),
        (False, r"(?<![\p{L}\p{N}])(?:\p{Lu}\.){2,}", r"\s"),
        (False, r"(?<!\p{L})डॉ\.", r"\s"),
    ],
    "spaced": [
        # a quotation or bracket that closes within the sentence
        (False, rf"[.!?…؟।॥]\s?{_CLOSE}+", r"\s*[\p{Ll},;:–—]"),
        (False, r"(?:…|\.\.\.)", r"\s*[\p{Ll},;:]"),
        (True, rf"[.!?…؟۔।॥]\s?{_CLOSE}*", r"\s"),
        (True, r"[\p{Ll}\p{N})]{2}[.!?]", r"\p{Lu}[\p{Ll}\s]"),
        (True, r"[\p{Arabic}][.؟!]", r"\p{Arabic}"),
    ],
    "danda": [
        (False, rf"[।॥.!?]\s?{_CLOSE}+", r"\s*\p{L}"),
        (True, r"[।॥]+", r""),
    ],
    "arabic": [
        (False, rf"[.!؟?…]\s?{_CLOSE}+", r"\s*\p{L}"),
        (True, r"[؟۔]+", r""),
    ],
    "japanese": [
        (False, rf"[。！？…]{_CLOSE}+", r"\s*(?:と|って|という|など|[はがをにでのもやへ、，])"),
        (False, r"[。！？]+[）)]", r"\s*\S"),
        (True, rf"[。！？]+{_CLOSE}*", r""),
        (False, r"…+", r"\S"),
    ],
    "chinese": [
        (False, r"[。！？]+[）)]", r"\s*\S"),
        (False, rf"[。！？…]{_CLOSE}+", r"\s*[，、；：的地得]"),
        (True, rf"[。！？]+{_CLOSE}*", r""),
        (False, r"…+", r"\S"),
    ],
    "terminal": [
        (False, rf"{_TERMINAL}\s?{_CLOSE}+", r"\s*[\p{Ll},;:–—]"),
        (True, rf"{_TERMINAL}+\s?{_CLOSE}*", r""),
    ],
    "thai": [
        (False, r"(?<!(?<!\S)\p{N}{1,9})", r"[ \u00a0]+\p{N}+(?!\S)"),  # a heading's number stays with it
        (True, r"\S", r"\s"),
    ],
}
#: Tables of each kind of text, in the order in which they are tried.
CASCADES: dict[str, tuple[str, ...]] = {
    **{own: (own, "initials", *(f"{language} within {own}" for language in BOUND if language != own), "spaced", "terminal") for own in BOUND},
    "hi": ("initials", "danda", "en", "spaced", "terminal"),
    "ar": ("initials", "arabic", "en", "spaced", "terminal"),
    "ja": ("japanese", "en", "initials", "spaced", "terminal"),
    "zh": ("chinese", "en", "initials", "spaced", "terminal"),
    "th": ("thai",),
}
#: Lines that are units of their own; the first that matches the line's beginning names it.
LINES: list[tuple[str, str]] = [
    ("heading", r"\#{1,6}\s"),
    ("list", r"[-*•+–‣◦·]\s"),
    ("numbered", r"(?:\p{N}{1,3}[.)]|\([a-z0-9]{1,2}\))\s"),
    ("row", r"\|"),
    ("log", r"\p{N}{4}-\p{N}{2}-\p{N}{2}[T ]\p{N}{2}:\p{N}{2}|[0-9a-f]{6,}:\s|\[?\p{N}{2}:\p{N}{2}:\p{N}{2}"),
    ("code", r"```|(?:>>>|\$)\s|def \w+\(|class \w+[:(]|import [\w.]+\s*$|from [\w.]+ import |SELECT\s|INSERT\s+INTO\s|CREATE\s+TABLE\s"),
]
#: What encloses: a possible end within does not count.
SPANS = (r"“[^“”]*”", r"„[^„“”]*[“”]", r"«[^«»]*»", r"「[^「」]*」", r"『[^『』]*』", r"（[^（）]*）", r"\([^()]*\)", r"\"[^\"]*\"")
#: Where a unit can end, by kind of text: behind the match, or before it in Thai.
PLACES = {"": rf"[{_END}]+(?:[\s ]?[»]|{_CLOSE})*", "th": r"(?=\s)(?<=\S)"}

_LINES = regex.compile(r"\s*(?:" + "|".join(f"(?P<{name}>{begin})" for name, begin in LINES) + ")")
_LINE = regex.compile(r"[^\r\n]*(?:\r\n|[\r\n]|\Z)")
_SPAN = regex.compile("|".join(SPANS))
_OPENER = regex.compile("[" + "".join(dict.fromkeys(regex.sub(r"^\\", "", span)[0] for span in SPANS)) + "]")
_PLACES = {kind: regex.compile(places, regex.V1) for kind, places in PLACES.items()}
_WORDY = regex.compile(r"[\p{L}\p{N}]")
_MARK = regex.compile(rf"[{_END}:：]", regex.V1)
_CLOSERS = _CLOSE[1:-1].replace("\\", "")
_FUNCTION = {language: frozenset(words.split()) for language, words in FUNCTION_WORDS.items()}


def _compiled(names: tuple[str, ...]) -> tuple[regex.Pattern, list[bool]]:
    """The rules of a cascade as one alternation, tried in order at a place; the group that took part names the rule."""
    rules = [rule for name in names for rule in TABLES[name]]
    return regex.compile("|".join(f"(?<={before})(?={after})()" for _, before, after in rules), regex.V1), [True, *(b for b, _, _ in rules)]


_RULES = {kind: _compiled(names) for kind, names in CASCADES.items()}
_SCRIPTS = [("th", regex.compile(r"\p{Thai}")), ("hi", regex.compile(r"\p{Devanagari}")), ("ar", regex.compile(r"\p{Arabic}")), ("ja", regex.compile(r"[\p{Hiragana}\p{Katakana}]")), ("zh", regex.compile(r"\p{Han}"))]
_PLAIN = regex.compile(r"[\x00-ɏ -⁯₠-⅏]*")


def language_of(text: str) -> str:
    """The Latin language with the most function words in a text; English if there are none."""
    found = Counter(text.lower().split())
    return max(_FUNCTION, key=lambda language: sum(found[w] for w in _FUNCTION[language]))


def kind_of(text: str, language: str) -> str:
    """The cascade of a stretch of running text: by script, then by the language."""
    if not _PLAIN.fullmatch(text):
        letters = len(text)
        for kind, script in _SCRIPTS:
            if kind == "ja":
                if script.search(text):
                    return kind
                continue
            if len(script.findall(text)) * 5 > letters:
                return kind
    return language if language in BOUND else "en"


def _running(text: str, a: int, b: int, language: str, out: list[tuple[int, int]]) -> None:
    """Units of the running text in a..b."""
    part = text[a:b]
    kind = kind_of(part, language)
    start = 0
    pattern, breaks = _RULES[kind]
    decide = pattern.match
    # a space of Thai text ends a unit within a quotation, too
    spans = [m.span() for m in _SPAN.finditer(part)] if kind not in _PLACES and _OPENER.search(part) else []
    k = 0
    for m in _PLACES.get(kind, _PLACES[""]).finditer(part):
        i, end = m.span()
        while k < len(spans) and spans[k][1] <= i:
            k += 1
        if k < len(spans) and spans[k][0] < i and end < spans[k][1]:
            continue  # inside a quotation or bracket that goes on
        if end >= len(part):
            break
        rule = decide(part, end)
        if rule and breaks[rule.lastindex]:
            _unit(text, a + start, a + end, out)
            start = end
    _unit(text, a + start, b, out)


def _unit(text: str, a: int, b: int, out: list[tuple[int, int]]) -> None:
    part = text[a:b]
    if _WORDY.search(part):
        a += len(part) - len(part.lstrip())
        out.append((a, a + len(part.strip())))


def _ended(line: str, before: bool) -> bool:
    """Whether what a line ends has come to its end; a line of nothing but closing marks leaves it as it was."""
    bare = line.rstrip().rstrip(_CLOSERS).rstrip()
    return bool(_MARK.match(bare[-1])) if bare else before


def units(text: str | None, language: str | None = None) -> list[tuple[int, int]]:
    """(start, end) of every unit of a text, in order."""
    if not text or text.isspace():
        return []
    language = (language or "").split("-")[0].lower()
    if language not in CASCADES:
        language = language_of(text)
    out: list[tuple[int, int]] = []
    open_at, item, ended = -1, False, False  # where the running text or list item began, and whether it has ended

    def close(at: int) -> None:
        nonlocal open_at
        if open_at >= 0:
            if item:
                _unit(text, open_at, at, out)
            else:
                _running(text, open_at, at, language, out)
        open_at = -1

    pos, n = 0, len(text)
    while pos < n:
        end = _LINE.match(text, pos).end()
        line = text[pos:end]
        if line.isspace():
            close(pos)
        elif (special := _LINES.match(line)) and not (special.lastgroup == "numbered" and open_at >= 0 and not item and not ended):
            # (a number that a line break happened to bring to the start of a line of running text is none)
            close(pos)
            if special.lastgroup in ("list", "numbered"):
                open_at, item, ended = pos, True, False
            else:
                _unit(text, pos, end, out)
        elif open_at < 0:
            open_at, item, ended = pos, False, False
        elif item and ended:
            close(pos)  # a list item that has ended; running text follows
            open_at, item, ended = pos, False, False
        if open_at >= 0:
            ended = _ended(line, ended)
        pos = end
    close(n)
    return out


def split_documents(documents: DataFrame, *, key: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """(key, start_char, end_char) of every unit of every document; no shuffle. Other columns are not read."""
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                row, flat = [], []
                for n, (t, lang) in enumerate(zip(batch.column("t").to_pylist(), batch.column("l").to_pylist())):
                    found = units(t, lang)
                    row.append(len(found))
                    flat.extend(found)
                spans = np.array(flat, np.int64).reshape(-1, 2)
                rows = pa.array(np.repeat(np.arange(len(row)), row))
                yield pa.RecordBatch.from_arrays([batch.column("k").take(rows), pa.array(spans[:, 0]), pa.array(spans[:, 1])], ["k", "start_char", "end_char"])

    rows = documents.where(documents[text].isNotNull()).select(documents[key].alias("k"), documents[text].alias("t"), documents[language].alias("l"))
    return rows.mapInArrow(run, f"k {kind}, start_char long, end_char long").withColumnRenamed("k", key)
