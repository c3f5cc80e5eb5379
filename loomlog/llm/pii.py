"""Personal data with offset-preserving deobfuscation.

Base detection finds e-mail addresses, IP addresses, card numbers and phone numbers by fixed patterns. On top, a chain of
transducers rewrites disguised text into plain text and keeps, for every character it writes, the source characters it
stands for: look-alike letters, digits and signs; characters without width, which go; spelled digits that stand in a row, and
a spoken plus before them; and "at" and "dot" in brackets, or as words between parts of an address. Identifiers found in the
rewritten text are mapped back to the source characters. Base spans stay as they are. A mapped span is added where it changed
something and every base span that it overlaps lies inside it: it is then the longer reading of a part that was plain.
Masking covers both.

Only texts with a sign of disguise are rewritten: a look-alike or invisible character, a bracketed or worded sign, or a row
with spelled digits.

Nulls: a null text is empty and holds nothing; a null doc_id is kept. Repeated rows are searched each. Extra columns are
ignored by :func:`personal_data` and carried along by :func:`masked`. Empty table: no rows. Work on a text grows with its
length, also for long runs of digits, letters or signs.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.llm.common import texts_of

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}")  # a class comes first: a search skips to it
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SEPARATORS = re.compile("[ -]")

#: Characters that look like ASCII ones. Full-width forms follow a rule, see :func:`look_alikes`.
LOOK_ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T",
    "Х": "X", "α": "a", "ο": "o", "ν": "v", "ι": "i", "κ": "k", "ρ": "p", "ɡ": "g", "ı": "i", "ⅼ": "l",
    "․": ".", "。": ".", "﹒": ".", "﹫": "@", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", " ": " ", " ": " ", " ": " ",
}
#: Spelled digits.
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}


#: Characters that are not seen: soft hyphen, zero-width space, joiners, word joiner, byte order mark.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"


def look_alikes() -> dict[str, str]:
    """All single characters that stand for an ASCII one or for nothing.

    The fixed ones, full-width forms, decimal digits of other scripts, and mathematical, letter-like and circled letters, which
    the compatibility form names.
    """
    shaped = {chr(c): plain for a, b in ((0x1D400, 0x1D800), (0x2100, 0x2150), (0x24B6, 0x24EA))
              for c in range(a, b) if len(plain := unicodedata.normalize("NFKC", chr(c))) == 1 and plain.isascii()}
    wide = {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
    digits = {chr(start + d): str(d) for start in (0x660, 0x6F0, 0x966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
    return shaped | LOOK_ALIKE | wide | digits | dict.fromkeys(INVISIBLE, "")


_PLAIN = look_alikes()
#: Look-alikes; beyond U+FFFF, where a class is tried item by item, the whole block of mathematical letters.
_ALIKE = re.compile("[" + "".join(re.escape(c) for c in _PLAIN if c <= "\uffff") + "\U0001d400-\U0001d7ff]")
_DIGIT_WORD = "(?:" + "|".join(SPELLED) + ")"
#: At least four spelled or written digits in a row, one of them spelled.
_SPELLED_RUN = re.compile(rf"(?<![A-Za-z0-9])(?:{_DIGIT_WORD}|[0-9])(?:(?:[ ,.-]|, )?(?:{_DIGIT_WORD}|[0-9])){{3,}}+(?![A-Za-z])", re.I)
_ONE_DIGIT = re.compile(rf"{_DIGIT_WORD}|[0-9]", re.I)
_ANY_SPELLED = re.compile(rf"\b{_DIGIT_WORD}\b", re.I)
_AFTER_WORD = "(?:" + "|".join(f"(?<={word}.)" for word in SPELLED) + ")"
#: In lower case, a sign between two spelled digits or a spelled and a written one; every row with a spelled digit has one.
_SPELLED_PAIR = re.compile(rf"[ ,.-](?= ?(?:{_DIGIT_WORD}|[0-9]))(?:{_AFTER_WORD}|(?<=[0-9].)(?! ?[0-9]))")
_ANY_BRACKETED = re.compile(r"[\[({<] ?(?:at|dot|@|\.) ?[\])}>]", re.I)
_BRACKETED = re.compile(r" ?[\[({<] ?(at|dot|@|\.) ?[\])}>] ?", re.I)
#: "name at host dot org": the words only count together, the dot word right after one label.
_WORDED = re.compile(r"(?<=[A-Za-z0-9._%+-])( at )(?=[A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)+)", re.I)
_DOT_WORD = re.compile(r"(?: dot (?=[A-Za-z0-9-]))", re.I)
_DOT_CHAIN = re.compile(r"(?<=@)[A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)+", re.I)
#: Numbers of an address with a spoken dot between some of them.
_DOT_NUMBERS = re.compile(r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:(?: dot |\.)[0-9]{1,3}){3}(?![A-Za-z0-9])", re.I)
_PLUS = re.compile(r"(?<![A-Za-z0-9])plus $", re.I)


def emails(text: str) -> list[Span]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            done = match.end()
        else:
            done = at + 1  # nothing before this sign can be part of a later address
        at = text.find("@", max(done, at + 1))
    return found


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in m[0].split("."))]


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _DIGITS.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(digits := _SEPARATORS.sub("", m[0])) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    numbers = bool(re.search("[0-9]", text))
    return {"email": emails(text), "ip": ips(text) if numbers else [], "card": cards(text) if numbers else [], "phone": phones(text) if "+" in text else []}


class Traced:
    """A text and, for each of its characters, the source span it stands for."""

    def __init__(self, text: str, starts: list[int], ends: list[int]):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def of(cls, text: str, offset: int = 0) -> Traced:
        places = list(range(offset, offset + len(text)))
        return cls(text, places, [p + 1 for p in places])

    def replaced(self, edits: list[tuple[int, int, str]]) -> Traced:
        """``edits``: start, end and new text of parts, in order and apart; a new text stands for its whole part."""
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            starts += self.starts[at:a] + [self.starts[a]] * len(new)
            ends += self.ends[at:a] + [self.ends[b - 1]] * len(new)
            at = b
        return Traced("".join([*text, self.text[at:]]), starts + self.starts[at:], ends + self.ends[at:])


def plain_characters(t: Traced) -> Traced:
    return t.replaced([(m.start(), m.end(), _PLAIN[m[0]]) for m in _ALIKE.finditer(t.text) if m[0] in _PLAIN])


def plain_digits(t: Traced) -> Traced:
    """Digits of a row that has spelled ones, without what stands between them."""
    edits = []
    for m in _SPELLED_RUN.finditer(t.text):
        if _ANY_SPELLED.search(m[0]):
            digits = list(_ONE_DIGIT.finditer(t.text, m.start(), m.end()))
            if plus := _PLUS.search(t.text[max(0, m.start() - 6):m.start()]):
                edits.append((m.start() - len(plus[0]), m.start(), "+"))
            for k, d in enumerate(digits):
                end = digits[k + 1].start() if k + 1 < len(digits) else d.end()
                edits.append((d.start(), end, SPELLED.get(d[0].lower(), d[0])))
    return t.replaced(edits)


def plain_signs(t: Traced) -> Traced:
    t = t.replaced([(m.start(), m.end(), {"at": "@", "dot": "."}.get(m[1].lower(), m[1])) for m in _BRACKETED.finditer(t.text)])
    t = t.replaced([(m.start(), m.end(), "@") for m in _WORDED.finditer(t.text)])
    for chain in (_DOT_CHAIN, _DOT_NUMBERS):
        t = t.replaced([(d.start(), d.end(), ".") for m in chain.finditer(t.text) for d in _DOT_WORD.finditer(t.text, m.start(), m.end())])
    return t


def disguised(text: str) -> bool:
    """Whether a transducer might rewrite anything."""
    lower = text.lower()
    return bool(
        (not text.isascii() and _ALIKE.search(text))
        or _ANY_BRACKETED.search(text)
        or (" dot " in lower and (_WORDED.search(text) or _DOT_CHAIN.search(text) or _DOT_NUMBERS.search(text)))
        or ((_SPELLED_PAIR.search(lower) or "ſ" in text or "İ" in text) and any(_ANY_SPELLED.search(m[0]) for m in _SPELLED_RUN.finditer(text))))


def uncovered_spans(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans of disguised identifiers, by kind, that overlap no base span or hold all that they overlap."""
    if not disguised(text):
        return {k: [] for k in KINDS}
    t = plain_signs(plain_digits(plain_characters(Traced.of(text))))
    taken = sorted(s for spans in base.values() for s in spans)
    found = {}
    for kind, spans in base_spans(t.text).items():
        mapped = [(t.starts[a], t.ends[b - 1]) for a, b in spans]
        fresh = [s for s, (a, b) in zip(mapped, spans) if text[s[0]:s[1]] != t.text[a:b]]
        found[kind] = _apart(fresh, taken)
    return found


def _apart(spans: list[Span], taken: list[Span]) -> list[Span]:
    """Those of ``spans`` (in order) that cut none of ``taken`` (in order) and are none of them."""
    out, k = [], 0
    for a, b in spans:
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        over = itertools.takewhile(lambda x: x[0] < b, itertools.islice(taken, k, None))
        if all(a <= x[0] and x[1] <= b and (a, b) != x for x in over):
            out.append((a, b))
    return out


def all_spans(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans and all spans by kind."""
    base = base_spans(text)
    more = uncovered_spans(text, base)
    return base, {k: sorted(base[k] + more[k]) for k in KINDS}


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in spans[k])


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of spans by kind, the digest of the base spans and all spans of every row."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, text in zip(b.doc_id, b.text):
                base, spans = all_spans(text)
                out.append((doc_id, *[len(spans[k]) for k in KINDS], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")]).astype({"doc_id": "Int64"})
    return texts_of(docs).mapInPandas(search, FOUND)


def mask_text(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become the first one's kind."""
    spans = sorted((a, -b, k) for k, found in all_spans(text)[1].items() for a, b in found)
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, -b)
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; null texts stay null, and n_chars, if there, is the new length."""
    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else mask_text(t))
    out = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
