"""Personal data, also behind disguises, at its place in the source text.

Four kinds are found in the text as it stands: e-mail addresses, IPv4
addresses, card numbers (Luhn) and phone numbers.  A chain of transducers then
rewrites disguises - look-alike and compatibility characters to ASCII, spelled
digits to digits, "(at)" / " arroba " and "(dot)" / " punkt " to their signs, in
English, German, French and Spanish - while every output character keeps the
source span it came from.  The same detectors run on the rewritten text, and a
span that rests on a rewritten character and meets no plain span of its kind is
mapped back and added.

A bare English " at " is a sign only if a character of the name or the host is
disguised too, the host ends in a known top-level domain and the name is not one
of the words that stand before "at" in a sentence: "jane at example.com" reads
like "meet us at example.com", and "meet me at foo dot com" names no person.

Every step is linear in the text's length: patterns that begin with white space
start only where none precedes, and repeats that cannot give back are possessive.

Offsets count code points; ends are exclusive.  The rewriting runs only on
texts that hold something to rewrite, and always on the whole of such a text.

Defined results: null and empty texts have no span.  Repeated rows each get
their own row.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import flat
from tidemark.llm.store import text_input

KINDS = ("email", "ip", "card", "phone")

# fixed values: the contract's patterns (a digit run is entered at its start,
# which changes no match and keeps long runs linear)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# fixed values: letters that look like ASCII ones
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "С": "C", "Е": "E",
    "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z",
    "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", " ": " ", " ": " ",
}
# fixed values: spelled digits of the four languages
_DIGIT_WORDS = {w: str(d) for d, words in enumerate((
    "zero null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres", "four vier quatre cuatro",
    "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve"))
    for w in words.split()}
# fixed values: words for the signs, and those that are nothing else in a sentence
_AT_WORDS = ("at", "ät", "arroba", "arobase", "arrobase", "klammeraffe")
_DOT_WORDS = ("dot", "punkt", "point", "punto")
# fixed values: words before a bare "at" that are no name
_NO_NAMES = frozenset("""a am are arrive arrived be been begin begins call day end go him her here home is it life live look looked looking
looks made me meet meeting met not now off on one open out party people place see sent shop start stay them there time today us visit was we
were work works you""".split())
# fixed values: top-level domains accepted after a bare "at"
_DOMAINS = frozenset("com org net edu gov int info biz io eu de fr es at ch uk us ca mx ar be nl it co me app dev test example".split())


def _homoglyphs() -> dict[int, str]:
    """One character for one: those whose compatibility form (NFKC) is one ASCII
    character, digits of other scripts, and the look-alikes above.  Raised and
    lowered digits and letters stay, as they do not read like plain ones."""
    out: dict[int, str] = {}
    for c in [*range(0x80, 0xD800), *range(0xF900, 0x20000)]:
        form = unicodedata.normalize("NFKC", chr(c))
        if len(form) == 1 and form.isascii() and not unicodedata.decomposition(chr(c)).startswith(("<super>", "<sub>")):
            out[c] = form
        elif unicodedata.category(chr(c)) == "Nd":
            out[c] = str(unicodedata.digit(chr(c)))
    return out | {ord(k): v for k, v in _LOOKALIKES.items()}


def _one_of(words) -> str:
    return "|".join(map(re.escape, sorted(words, key=len, reverse=True)))


_GLYPHS = _homoglyphs()
_INVISIBLE_SET = "\u200b\u200c\u200d\u2060\ufeff"
_IS_GLYPH = np.zeros(max(_GLYPHS) + 2, bool)
_IS_GLYPH[[*_GLYPHS, *map(ord, _INVISIBLE_SET)]] = True
_INVISIBLE = re.compile(f"[{_INVISIBLE_SET}]+")
_SPELLED = rf"(?:{_one_of(_DIGIT_WORDS)})(?!\w)"
_DIGIT_WORD = re.compile(rf"(?<!\w){_SPELLED}", re.I)
_JOIN = re.compile(rf"(?<!\w){_SPELLED}(?:[\s,-]++{_SPELLED})++", re.I)
#: A spelled digit beside a numeral.
_SINGLE = re.compile(rf"(?<!\w)(?:(?<=[0-9][\s-]){_SPELLED}|{_SPELLED}(?=[\s-][0-9]))", re.I)
_DOT = re.compile(rf"(?<=[A-Za-z0-9])(?:\s*+[(\[{{<]\s*+(?:{_one_of(_DOT_WORDS)}|\.)\s*+[)\]}}>]\s*+|\s++(?:{_one_of(_DOT_WORDS)})\s++)(?=[A-Za-z0-9])", re.I)
_AT = re.compile(rf"(?<!\s)(?:\s*+[(\[{{<]\s*+(?:{_one_of(_AT_WORDS)}|@)\s*+[)\]}}>]\s*+|\s++(?P<word>{_one_of(_AT_WORDS)})\s++)(?=[A-Za-z0-9-])", re.I)
_BRACKETED = re.compile(rf"[(\[{{<]\s*+(?:{_one_of(_AT_WORDS + _DOT_WORDS)}|[@.])\s*+[)\]}}>]")
_CLEAR_WORDS = frozenset(("dot", "punkt", *_AT_WORDS[1:]))
_WORD = re.compile(r"\w+")

Span = tuple[int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches: the signs before "@" start at the run's first
    character, and fail or match as a whole."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def detect(text: str) -> dict[str, list[Span]]:
    """Spans of each kind in a text as it stands."""
    out: dict[str, list[Span]] = {"email": _emails(text)}
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    out["card"] = []
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out["card"].append(m.span())
    out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m.group())) <= 15] if "+" in text else []
    return out


class _Tape:
    """A text under rewriting; each character knows its source span and
    whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text), dtype=np.int32)
        self.end = self.start + 1
        self.changed = np.zeros(len(text), bool)

    def translate(self, table: dict[int, str]) -> None:
        """One character for one."""
        new = self.text.translate(table)
        self.changed |= _points(new) != _points(self.text)
        self.text = new

    def replace(self, pattern: re.Pattern, rewrite) -> None:
        """Every match becomes rewrite(match), unless that is None; its characters share the match's source span."""
        text: list[str] = []
        first, last, size = array("q"), array("q"), array("q")
        at = 0
        for m in pattern.finditer(self.text):
            new = rewrite(m)
            if new is not None:
                a, b = m.span()
                text += (self.text[at:a], new)
                first.append(a)
                last.append(b)
                size.append(len(new))
                at = b
        if not text:
            return
        a, b, n = (np.array(x, np.int64) for x in (first, last, size))
        edge = np.zeros(len(self.text) + 1, np.int8)
        np.add.at(edge, a, 1)
        np.add.at(edge, b, -1)
        keep = np.cumsum(edge[:-1], dtype=np.int8) == 0
        where = np.repeat(a - (np.cumsum(b - a) - (b - a)), n)
        self.start = np.insert(self.start[keep], where, np.repeat(self.start[a], n))
        self.end = np.insert(self.end[keep], where, np.repeat(self.end[b - 1], n))
        self.changed = np.insert(self.changed[keep], where, True)
        self.text = "".join(text) + self.text[at:]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _may_spell(words: list[str]) -> bool:
    """Whether a spelled digit stands beside another one or a numeral."""
    n = len(words)
    for i in [i for i, w in enumerate(words) if w in _DIGIT_WORDS]:
        if i + 1 < n and (words[i + 1] in _DIGIT_WORDS or words[i + 1][0].isdigit()) or i and words[i - 1][-1].isdigit():
            return True
    return False


def _spelled_run(m: re.Match) -> str:
    return "".join(_DIGIT_WORDS[w.group().lower()] for w in _DIGIT_WORD.finditer(m.group()))


def _at_sign(tape: _Tape):
    """Whether a disguised at sign stands between a name and a host; dots are rewritten by now."""
    def rewrite(m: re.Match) -> str | None:
        text, start = m.string, m.start()
        while start > 0 and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, m.end()) if start < m.start() else None
        if not host:
            return None
        if m["word"] and m["word"].lower() == "at":
            name = text[start:m.start()].lower()
            if name in _NO_NAMES or host.group().rsplit(".", 1)[1].lower() not in _DOMAINS:
                return None
            if not (tape.changed[start:m.start()].any() or tape.changed[m.end():host.end()].any()):
                return None
        return "@"

    return rewrite


def disguised(text: str, plain: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Further spans that show only after rewriting, in source offsets."""
    none: dict[str, list[Span]] = {k: [] for k in KINDS}
    low = text.lower()
    words = _WORD.findall(low)
    glyphs = not text.isascii() and bool(_IS_GLYPH[np.minimum(_points(text), len(_IS_GLYPH) - 1)].any())
    spelled = _may_spell(words)
    signs = not _CLEAR_WORDS.isdisjoint(words) or any(b in low for b in "([{<") and bool(_BRACKETED.search(low))
    if not (glyphs or spelled or signs):
        return none
    tape = _Tape(text)
    if glyphs:
        tape.translate(_GLYPHS)
        tape.replace(_INVISIBLE, lambda m: "")
    if spelled or glyphs:
        tape.replace(_JOIN, _spelled_run)
        tape.replace(_SINGLE, _spelled_run)
    if signs or glyphs:
        tape.replace(_DOT, lambda m: ".")
        tape.replace(_AT, _at_sign(tape))
    for kind, spans in detect(tape.text).items():
        known = sorted(plain[kind])
        for a, b in spans:
            if tape.changed[a:b].any():
                s, e = int(tape.start[a]), int(tape.end[b - 1])
                before = bisect_left(known, (e, e))  # plain spans do not overlap: only the last that begins before e can meet
                if not before or known[before - 1][1] <= s:
                    none[kind].append((s, e))
    return none


def _listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in flat.sliced(batches, "text"):
        cols: list[list] = [[] for _ in range(7)]
        for text in batch.column(1).to_pylist():
            base = detect(text or "")
            more = disguised(text, base) if text else base
            for col, kind in zip(cols, KINDS):
                col.append(len(base[kind]))
            listed = _listed(base)
            cols[4].append(hashlib.sha256(listed.encode()).hexdigest())
            every = {k: base[k] + more[k] for k in KINDS} if text else base
            cols[5].append(_listed(every))
            cols[6].append(sum(map(len, more.values())) if text else 0)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                         names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"])


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_disguised)
    for every row of docs.  The n_ of a kind counts its plain spans; spans
    lists plain and disguised ones, n_disguised counts the latter."""
    return text_input(docs).mapInArrow(
        _scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long")
