"""Personal data in texts, also behind disguises, with spans in source characters.

Plain identifiers are found by patterns and checks. Then transducers rewrite a copy of the text -
character references, look-alike and wide characters to ASCII, invisible ones to nothing, spelled
digits (English, German, French, Spanish) to digits, "at" and "dot" disguises to ``@`` and ``.`` - and carry for every character of their output the
source characters it came from. Identifiers found in the rewritten text are mapped back; spans
that the plain search has not covered are added. A text without a trace of a disguise is not
rewritten. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")

# --- plain identifiers ------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits can only match from its start, so the look-behind changes nothing but the time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    """What ``local+@label(.label)+`` finds from left to right. Local characters exclude the at sign,
    so a match starts where its run of them does, and each at sign is looked at once."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return found


def _is_ip(value: str) -> bool:
    return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in value.split("."))


def _is_card(value: str) -> bool:
    digits = [int(c) for c in value if c not in " -"] if len(value) < 40 else []
    if not 12 <= len(digits) <= 19:
        return False
    doubled = [2 * d - 9 * (d > 4) if k % 2 else d for k, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def _is_phone(value: str) -> bool:
    return 9 <= sum("0" <= c <= "9" for c in value) <= 15


def plain_spans(text: str) -> dict[str, list[Span]]:
    """The plain identifiers of each kind; matches that fail their check are dropped."""
    return {
        "email": emails(text),
        "ip": [m.span() for m in _IP.finditer(text) if _is_ip(m[0])],
        "card": [m.span() for m in _CARD.finditer(text) if _is_card(m[0])],
        "phone": [m.span() for m in _PHONE.finditer(text) if _is_phone(m[0])] if "+" in text else [],
    }


# --- transducers ------------------------------------------------------------------------------


@dataclass
class Mapped:
    """A rewritten text; each character came from source characters ``start`` to ``end``."""

    text: str
    start: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, text: str) -> Mapped:
        return cls(text, np.arange(len(text)), np.arange(1, len(text) + 1))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replaces pieces (in order, apart); new characters came from all that they replace."""
        if not edits:
            return self
        parts, start, end, at = [], [], [], 0
        for i, j, new in edits:
            parts += [self.text[at:i], new]
            start += [self.start[at:i], np.full(len(new), self.start[i])]
            end += [self.end[at:i], np.full(len(new), self.end[j - 1])]
            at = j
        return Mapped(
            "".join([*parts, self.text[at:]]),
            np.concatenate([*start, self.start[at:]]), np.concatenate([*end, self.end[at:]]),
        )

    def source(self, span: Span) -> Span:
        return int(self.start[span[0]]), int(self.end[span[1] - 1])


# Letters of other scripts that look like the ASCII letter below them. Characters that
# Unicode itself relates to an ASCII character come from its data.
_ALIKE = "АВЕКМНОРСТУХаеорсухіјѕԁһԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧον"
_ASCII = "ABEKMHOPCTYXaeopcyxijsdhqwABEZHIKMNOPTYXov"
_STYLED = ("<wide>", "<font>", "<small>", "<narrow>", "<circle>", "<super>", "<sub>", "<noBreak>", "<compat>", "<square>")
_LETTER = re.compile(r"LATIN (?:LETTER SMALL CAPITAL|SMALL LETTER (?:SCRIPT|DOTLESS|CLOSED|BARRED)) ([A-Z])")
_STOP = re.compile(r"(?:HALFWIDTH )?(?:IDEOGRAPHIC|ARABIC|SYRIAC SUPRALINEAR|ETHIOPIC) FULL STOP|ONE DOT LEADER")


@cache
def _alike() -> np.ndarray:
    """For every code point the ASCII character it stands for, itself, or -1 to leave it out.

    Digits of any script and styled forms (wide, circled, raised, mathematical) stand for the plain ones, small
    capitals for their letters, every space and dash for the ASCII one, other full stops for the dot;
    format characters and variation selectors are left out.
    """
    table = np.arange(0x110000, dtype=np.int64)
    for code in range(0x80, 0x110000):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind in ("Cn", "Co", "Cs"):
            continue
        name = unicodedata.name(char, "")
        digit = unicodedata.decimal(char, None)
        if digit is not None:
            table[code] = 48 + digit
        elif kind == "Cf" or name.startswith("VARIATION SELECTOR"):
            table[code] = -1
        elif kind == "Zs":
            table[code] = 32
        elif kind == "Pd" or name == "MINUS SIGN":
            table[code] = 45
        elif letter := _LETTER.fullmatch(name):
            table[code] = ord(letter[1].lower())
        elif _STOP.fullmatch(name):
            table[code] = 46
        elif unicodedata.decomposition(char).startswith(_STYLED):
            plain = unicodedata.normalize("NFKC", char)
            if len(plain) == 1 and plain.isascii():
                table[code] = ord(plain)
    for char, plain in zip(_ALIKE, _ASCII):
        table[ord(char)] = ord(plain)
    return table


_REFERENCE = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|commat|period|hyphen|dash|nbsp|plus|lowbar);")


def unescape(text: Mapped) -> Mapped:
    """HTML character references to their characters."""
    if "&" not in text.text:
        return text
    edits = [(*m.span(), new) for m in _REFERENCE.finditer(text.text) if len(new := html.unescape(m[0])) == 1]
    return text.rewrite(edits)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def straighten(text: Mapped) -> Mapped:
    """Look-alike characters to ASCII, invisible ones to nothing."""
    if text.text.isascii():
        return text
    codes = _codes(text.text)
    new = _alike()[codes]
    if (new == codes).all():
        return text
    keep = new >= 0
    plain = new[keep].astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass")
    return Mapped(plain, text.start[keep], text.end[keep])


# The digits in English, German, French and Spanish, from zero on.
_DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_DIGITS = {word: str(k) for words in _DIGIT_WORDS for k, word in enumerate(words.split())} | {
    "oh": "0", "ein": "1", "zwo": "2", "fuenf": "5", "une": "1",
}
_TIMES = {"double": 2, "doppel": 2, "doble": 2, "triple": 3}
_PLUS = ("plus", "más", "mas")
_NAMES = "|".join(sorted([*_DIGITS, *_TIMES], key=len, reverse=True))
# Blanks, commas and dashes, also over one line break.
_BETWEEN = r"(?:[ \t,-]+(?:\r?\n[ \t,-]*)?|\r?\n[ \t,-]*)"
_DOTS = "dot|punto|punkt|point"
_DOTTED = rf"(?:\.|[ \t]+(?:{_DOTS})[ \t]+)"
# Three or more in a row, spelled or plain, at least one of them spelled, perhaps after a spelled plus. No
# identifier has more than 19 digits, so no more plain ones need stand before the first spelled one.
_SPELLED = re.compile(
    rf"(?i)(?<![^\W_])(?:(?:{'|'.join(_PLUS)}){_BETWEEN}|\+[ ]?)?"
    rf"(?:[0-9]+(?:{_DOTTED}|{_BETWEEN})){{0,19}}+(?:{_NAMES})(?:(?:{_DOTTED}|{_BETWEEN})(?:{_NAMES}|[0-9]+))+(?![^\W_])"
)
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\+")


def spell_digits(text: Mapped) -> Mapped:
    """Runs of spelled digits to digits, without the gaps between them; dots between them stay."""
    edits = []
    for run in _SPELLED.finditer(text.text):
        tokens = [m for m in _TOKEN.finditer(text.text, run.start(), run.end()) if m[0].lower() not in _DOTS.split("|")]
        if sum(m[0] != "+" and m[0].lower() not in _PLUS for m in tokens) < 3:
            continue
        times, end = 1, run.start()
        for m in tokens:
            word = m[0].lower()
            between = text.text[end: m.start()]
            if between:
                dotted = "." in between or bool(re.search(rf"(?i){_DOTS}", between))
                edits.append((end, m.start(), "." if dotted else ""))
            if word in _TIMES:
                times = _TIMES[word]
                edits.append((*m.span(), ""))
            elif word in _DIGITS:
                edits.append((*m.span(), _DIGITS[word] * times))
                times = 1
            elif word in _PLUS:
                edits.append((*m.span(), "+"))
            else:
                times = 1
            end = m.end()
    return text.rewrite(edits)


_OPEN, _CLOSE, _SPACE = r"[\[({<]", r"[\])}>]", r"[ \t]{0,2}"
_ATS = "at|arroba|arobase|klammeraffe"
_WRAPPED_AT = rf"{_SPACE}{_OPEN}{_SPACE}(?:{_ATS}|@){_SPACE}{_CLOSE}{_SPACE}"
_AT = re.compile(
    rf"(?i)(?P<sure>{_WRAPPED_AT})|[ \t]{{1,3}}(?:{_ATS})[ \t]{{1,3}}|[ \t]{{0,2}}[-_*]{{1,3}}(?:{_ATS})[-_*]{{1,3}}[ \t]{{0,2}}|@"
)
_DOT = (
    rf"(?:{_SPACE}{_OPEN}{_SPACE}(?:{_DOTS}|\.){_SPACE}{_CLOSE}{_SPACE}|[ \t]{{1,3}}(?:{_DOTS})[ \t]{{1,3}}"
    rf"|[ \t]{{0,2}}[-_*]{{1,3}}(?:{_DOTS})[-_*]{{1,3}}[ \t]{{0,2}})"
)
_HIDDEN_DOT = re.compile(rf"(?i){_DOT}")
_LABEL = rf"(?:(?!{_DOT})[A-Za-z0-9-])+"
_HIDDEN_DOMAIN = re.compile(rf"(?i){_LABEL}(?:(?:\.|{_DOT}){_LABEL})+")
_DOT_BEFORE = re.compile(rf"(?i){_DOT}$")
_DOT_WIDTH = 16  # the widest disguised dot, with its spaces
_DIGIT_DOT = re.compile(rf"(?i)(?<=[0-9]){_DOT}(?=[0-9])")
# A bare "at" between words is an address where the word before it is no plain word, or a cue leads to it.
_NAMED = re.compile(r"[A-Za-z][A-Za-z0-9%+-]*[._0-9][A-Za-z0-9._%+-]*")
_CUE = re.compile(r"(?i)(?:e-?mail|mail|contact|kontakt|correo|courriel|write|address|adresse)(?:[ \t]+(?:me|us|to|is|an|à|a))?[ \t:]*$")
_TOP_LABEL = re.compile(r"[A-Za-z]{2,12}")


def undisguise(text: Mapped) -> Mapped:
    """Disguised at signs and dots of addresses, and dots between digits, to what they stand for.

    A word "at" in brackets is one. Without them it counts before a domain with a disguised dot; before a
    plain domain if what stands before it has a dot, digit or underscore or follows a cue such as
    "mail" or "contact".
    """
    s, edits, free = text.text, [], 0
    for at in _AT.finditer(s):
        if at.start() < free:
            continue
        domain = _HIDDEN_DOMAIN.match(s, at.end())
        if not domain:
            continue
        dots = [(*m.span(), ".") for m in _HIDDEN_DOT.finditer(s, domain.start(), domain.end())]
        start, before = at.start(), []
        while True:
            local = start
            while local > free and s[local - 1] in _LOCAL:
                local -= 1
            if local == start:
                break
            start = local
            dot = _DOT_BEFORE.search(s, max(free, local - _DOT_WIDTH), local)
            if not dot or dot.start() == free or s[dot.start() - 1] not in _LOCAL:
                break
            before.append((*dot.span(), "."))
            start = dot.start()
        if start == at.start():
            continue
        if not dots and at["sure"] is None:
            if at[0] == "@" or not _TOP_LABEL.fullmatch(domain[0].rsplit(".", 1)[1]):
                continue
            if not _NAMED.fullmatch(s[start: at.start()]) and not _CUE.search(s, max(0, start - 24), start):
                continue
        edits += [*reversed(before), (*at.span(), "@"), *dots]
        free = domain.end()
    changed = text.rewrite(edits)
    return changed.rewrite([(*m.span(), ".") for m in _DIGIT_DOT.finditer(changed.text)])


_DOT_TRACE = re.compile(rf"(?i){_OPEN}{_SPACE}(?:{_ATS}|{_DOTS}|@|\.){_SPACE}{_CLOSE}|[ \t_*-](?:{_DOTS})[ \t_*-]|[ \t_*-](?:{_ATS})[ \t_*-]+[a-z0-9-]+\.[a-z]")


def rewritten(text: str) -> Mapped | None:
    """The text after all transducers, None if none of them has anything to do."""
    mapped = Mapped.of(text)
    mapped = straighten(unescape(mapped))
    plain = mapped.text
    spelled, dotted = _SPELLED.search(plain), _DOT_TRACE.search(plain)
    if plain == text and not spelled and not dotted:
        return None
    return undisguise(spell_digits(mapped) if spelled else mapped)


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """``kind, start, end, plain`` of all identifiers, by start, kind and end; null is empty."""
    if not text:
        return []
    plain = plain_spans(text)
    spans = [(kind, *span, True) for kind in KINDS for span in plain[kind]]
    other = rewritten(text)
    if other is not None:
        for kind, found in plain_spans(other.text).items():
            starts = np.array([s for s, _ in plain[kind]], np.int64)
            for start, end in map(other.source, found):
                k = int(np.searchsorted(starts, start, "right")) - 1
                if k < 0 or plain[kind][k][1] < end:  # not inside a plain span
                    spans.append((kind, start, end, False))
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("plain", T.BooleanType()),
])


def detect(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text`` but with ``spans``: array of ``kind, start, end, plain``.

    Whole texts are searched; a null or empty text has no spans. Rows are independent, so
    repeated rows, other columns and an empty table need nothing special; a column named
    ``spans`` is replaced.
    """
    kept = [c for c in docs.columns if c not in ("text", "spans")]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("plain", pa.bool_())]))

    def run(batches):
        for batch in batches:
            found = [
                [{"kind": k, "start": s, "end": e, "plain": p} for k, s, e, p in find(t.as_py())]
                for t in batch.column(batch.num_columns - 1)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], [*kept, "spans"])

    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("spans", T.ArrayType(_SPAN))])
    return docs.select(*kept, "text").mapInArrow(run, schema)
