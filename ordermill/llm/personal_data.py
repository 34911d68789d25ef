"""Personal data in texts, in plain form and in disguise, with offsets in the original text.

Three transducers rewrite a text and keep where every piece came from: the first folds look-alike
characters and drops invisible ones, the second turns spelled digits into digits, the third `at` and
`dot` into signs. The detectors run on the text itself and on what each transducer makes of it; spans
found there are mapped back to the source characters.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm.batches import map_rows, table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DIGIT = re.compile("[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Characters that look like a Latin letter or a sign, by what they look like.
LOOK_ALIKES = {
    "a": "аαɑ",
    "b": "Ьƅвβ",
    "c": "сϲⅽ",
    "d": "ԁⅾ",
    "e": "еҽε",
    "g": "ɡ",
    "h": "һн",
    "i": "іιı",
    "j": "јϳ",
    "k": "κкҝ",
    "l": "ӏⅼ",
    "m": "ⅿм",
    "n": "ո",
    "o": "оοօ",
    "p": "рρ",
    "q": "ԛ",
    "r": "г",
    "s": "ѕ",
    "t": "тτ",
    "u": "υս",
    "v": "ѵνⅴ",
    "w": "ԝ",
    "x": "хχⅹ",
    "y": "уγ",
    "z": "ᴢ",
    "A": "АΑ",
    "B": "ВΒᏴ",
    "C": "СϹⅭ",
    "D": "Ⅾ",
    "E": "ЕΕ",
    "G": "Ԍ",
    "H": "НΗ",
    "I": "ІΙⅠ",
    "J": "Ј",
    "K": "КΚ",
    "L": "Ⅼ",
    "M": "МΜⅯ",
    "N": "Ν",
    "O": "ОΟ",
    "P": "РΡ",
    "Q": "Ԛ",
    "S": "ЅՏ",
    "T": "ТΤ",
    "U": "Ս",
    "V": "Ѵ",
    "W": "Ԝ",
    "X": "ХΧⅩ",
    "Y": "УΥ",
    "Z": "Ζ",
    "-": "‐‑‒–−",
    ".": "․。",
    "@": "﹫",
}
# Digits as words, in the languages of the corpora at hand.
DIGIT_WORDS = {
    "0": "zero oh null cero zéro",
    "1": "one eins uno un",
    "2": "two zwei dos deux",
    "3": "three drei tres trois",
    "4": "four vier cuatro quatre",
    "5": "five fünf cinco cinq",
    "6": "six sechs seis",
    "7": "seven sieben siete sept",
    "8": "eight acht ocho huit",
    "9": "nine neun nueve neuf",
}
# Words for signs.
AT_WORDS = "at|arroba"
DOT_WORDS = "dot|punkt|punto|point"
PLUS_WORDS = "plus"
# Endings that a domain spoken as mere words has to have; any will do where another sign of an address is there.
TOP_LEVELS = "com|org|net|edu|gov|mil|int|info|biz|io|co|me|ai|app|dev|xyz|eu"
# Country codes, without those that are English words: am, as, at, by, do, in, is, my, no, pm, so, to.
COUNTRIES = (
    "ad|ae|af|ag|al|ao|aq|ar|au|aw|ax|az|ba|bb|bd|be|bf|bg|bh|bi|bj|bm|bn|bo|br|bs|bt|bw|bz|ca|cc|cd|cf|cg|ch|ci|ck|cl|cm|cn|cr|"
    "cu|cv|cw|cx|cy|cz|de|dj|dk|dm|dz|ec|ee|eg|er|es|et|fi|fj|fk|fm|fo|fr|ga|gd|ge|gf|gg|gh|gi|gl|gm|gn|gp|gq|gr|gs|gt|gu|gw|gy|hk|"
    "hm|hn|hr|ht|hu|id|ie|il|im|iq|ir|it|je|jm|jo|jp|ke|kg|kh|ki|km|kn|kp|kr|kw|ky|kz|la|lb|lc|li|lk|lr|ls|lt|lu|lv|ly|ma|mc|md|mg|"
    "mh|mk|ml|mm|mn|mo|mp|mq|mr|ms|mt|mu|mv|mw|mx|mz|na|nc|ne|nf|ng|ni|nl|np|nr|nu|nz|om|pa|pe|pf|pg|ph|pk|pl|pn|pr|ps|pt|pw|py|qa|"
    "re|ro|rs|ru|rw|sa|sb|sc|sd|se|sg|sh|si|sk|sl|sm|sn|sr|ss|st|su|sv|sx|sy|sz|tc|td|tf|tg|th|tj|tk|tl|tm|tn|tr|tt|tv|tw|tz|ua|ug|"
    "uk|us|uy|uz|va|vc|ve|vg|vi|vn|vu|wf|ws|ye|yt|za|zm|zw"
)
# Fixed value: a domain name has at most this many labels, by the rules of the name system.
LABELS = 127
INVISIBLE = "­​‌‍⁠﻿"


def digits_of(text: str) -> str:
    return "".join(char for char in text if "0" <= char <= "9")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(digit), 10)) for digit in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    """A match holds one `@`, as no other part of it can: from there the parts on both sides are taken."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield "email", start, done
        at = text.find("@", max(done, at + 1))


def detect(text: str) -> list[Span]:
    """Spans of all kinds in their plain form, by kind and start; leftmost, none overlapping its kind."""
    spans = list(emails(text))
    if not _DIGIT.search(text):
        return spans
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found[0].split(".")):
            spans.append(("ip", found.start(), found.end()))
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 16:
            digits = digits_of(found[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", found.start(), found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 8 <= len(digits_of(found[0])) <= 15:
                spans.append(("phone", found.start(), found.end()))
    return spans


class Rewritten:
    """A text and its source: stretches that were copied, and places that were replaced."""

    def __init__(self, source: str):
        self.source, self.parts = source, []
        self.outs, self.froms, self.copied = [], [], []
        self.size = self.at = 0

    def _put(self, text: str, start: int, copied: bool) -> None:
        if text or not copied:
            self.outs.append(self.size)
            self.froms.append(start)
            self.copied.append(copied)
            self.parts.append(text)
            self.size += len(text)

    def replace(self, start: int, end: int, new: str) -> None:
        """The source from `start` to `end` becomes `new`; what lies before is copied."""
        self._put(self.source[self.at : start], self.at, True)
        self._put(new, start, False)
        self.at = end

    def close(self) -> str:
        self._put(self.source[self.at :], self.at, True)
        return "".join(self.parts)

    def _stretch(self, place: int) -> int:
        return bisect_right(self.outs, place) - 1

    def begin_of(self, place: int) -> int:
        """Where the character at `place` starts in the source."""
        i = self._stretch(place)
        return self.froms[i] + (place - self.outs[i] if self.copied[i] else 0)

    def end_of(self, place: int) -> int:
        """Where the character before `place` ends in the source."""
        i = self._stretch(place - 1)
        if self.copied[i]:
            return self.froms[i] + place - self.outs[i]
        return self.froms[i + 1] if i + 1 < len(self.froms) else self.at

    def touched(self, start: int, end: int) -> bool:
        """Something between the two places was replaced."""
        return not all(self.copied[self._stretch(start) : self._stretch(end - 1) + 1])


@lru_cache(maxsize=1)
def _folding() -> tuple[re.Pattern, dict[str, str]]:
    fold = {char: "" for char in INVISIBLE}
    fold |= {char: plain for plain, chars in LOOK_ALIKES.items() for char in chars}
    fold |= {chr(code): chr(code - 0xFEE0) for code in range(0xFF01, 0xFF5F)}  # full-width forms
    for code in (*range(0x660, 0x1000), *range(0x1D7CE, 0x1D800)):
        digit = unicodedata.digit(chr(code), None)
        if digit is not None:
            fold[chr(code)] = str(digit)
    for code in range(0x1D400, 0x1D7CE):  # letters of mathematics
        plain = unicodedata.normalize("NFKC", chr(code))
        if len(plain) == 1 and plain.isascii():
            fold[chr(code)] = plain
    return re.compile("[" + re.escape("".join(fold)) + "]"), fold


@lru_cache(maxsize=1)
def _disguises() -> tuple[re.Pattern, re.Pattern, re.Pattern, re.Pattern, re.Pattern, re.Pattern, re.Pattern, dict[str, str]]:
    gap, lead = r"[ \t]*+", r"(?<![ \t])[ \t]*+"
    bracketed = lambda words: rf"{lead}(?:\[{gap}(?:{words}){gap}\]|\({gap}(?:{words}){gap}\)|\{{{gap}(?:{words}){gap}\}}|<{gap}(?:{words}){gap}>){gap}"
    spoken = lambda words: rf"(?<![ \t])[ \t]++(?:{words})[ \t]++"
    label = r"[A-Za-z0-9-]++"
    rest = f"{{0,{LABELS - 1}}}"
    bracketed_dot = rf"(?:{bracketed(DOT_WORDS)}|{bracketed(re.escape('.'))})"
    dots = rf"(?:{bracketed_dot}|{spoken(DOT_WORDS)})"
    ats = rf"(?:{bracketed(AT_WORDS)}|{bracketed('@')})"
    apart = r"(?:(?<![ \t])[ \t]++@[ \t]*+|@[ \t]++)"
    apart_dot = r"[ \t]\.[ \t]"
    any_dot = rf"(?:\.|{dots})"
    wide_dot = rf"(?:\.|{apart_dot})"
    name = r"[A-Za-z0-9_%+-]++"
    # no word of prose: a dot or a sign in it, or a digit
    formed = rf"(?=[_%+-]*+[A-Za-z0-9])(?=[A-Za-z]*+(?:[0-9_%+-]|{any_dot}))"
    listed = rf"(?:{TOP_LEVELS}|{COUNTRIES})(?![A-Za-z0-9-])"
    any_ending = r"[A-Za-z]{2,}+(?![A-Za-z0-9-])"
    after_formed = "|".join(
        (
            rf"{spoken(AT_WORDS)}{label}(?:{any_dot}{label}){rest}{any_dot}{any_ending}",
            rf"{apart}{label}(?:{wide_dot}{label}){rest}{wide_dot}{any_ending}",
        )
    )
    after_name = "|".join(
        (
            rf"(?:{ats}|@){label}(?:{any_dot}{label}){{1,{LABELS}}}",
            # `at` as a mere word counts where a dot is disguised as well
            rf"{spoken(AT_WORDS)}{label}(?:{any_dot}{label}){rest}{bracketed_dot}(?:{label}{any_dot}){rest}{any_ending}",
            rf"{spoken(AT_WORDS)}{label}(?:{any_dot}{label}){rest}{dots}(?:{label}{any_dot}){rest}{listed}",
            # a name of a reader may stand behind a space and `@`, with a dot in it
            rf"(?:(?:(?<![ \t])[ \t]*+)?@[ \t]++)(?:{label}\.){{1,{LABELS}}}{any_ending}",
            rf"{apart}{label}(?:{wide_dot}{label}){rest}{wide_dot}{listed}",
        )
    )
    names = rf"{name}(?:{any_dot}{name}){rest}"
    mail = rf"(?:{formed}{names}(?:{after_formed})|{names}(?:{after_name}))"
    address = rf"[0-9]{{1,3}}(?:{any_dot}[0-9]{{1,3}}){{3}}"
    words = {word: digit for digit, names in DIGIT_WORDS.items() for word in names.split()}
    number = rf"(?:{'|'.join(sorted(words, key=len, reverse=True))})"
    more = rf"(?:[ \t-]{{1,3}}(?:{number}|[0-9](?![0-9])))"
    octet = rf"(?:{number}{more}{{0,2}}|[0-9]{{1,3}})(?!\w)"
    sign = rf"(?:{any_dot}|{ats}|{spoken(AT_WORDS)}|{apart}|@)"
    flags = re.IGNORECASE
    return (
        re.compile(rf"(?<![A-Za-z0-9_%+-])(?:{mail}|{address})(?![A-Za-z0-9])", flags),
        re.compile(rf"{ats}|{apart}|{spoken(AT_WORDS)}", flags),
        re.compile(rf"{dots}|{apart_dot}", flags),
        re.compile(rf"(?<!\w){octet}(?:{any_dot}{octet}){{3}}", flags),
        re.compile(rf"({sign})?(?<![^\W0-9])({number}{more}+)(?![^\W0-9])", flags),
        re.compile(sign, flags),
        re.compile(rf"(?<![^\W0-9])(?:({PLUS_WORDS})|({number}))(?![^\W0-9])|[0-9]+", flags),
        words,
    )


_BRACKETED = re.compile(rf"[\[({{<][ \t]*(?:{AT_WORDS}|{DOT_WORDS}|@|\.)[ \t]*[\])}}>]", re.IGNORECASE)
_SPOKEN = re.compile(rf"[ \t](?:{DOT_WORDS})[ \t]")
_SPOKEN_AT = re.compile(rf"[ \t](?:{AT_WORDS})[ \t]++[a-z0-9-]++\.")


def hints_of_signs(text: str, low: str) -> bool:
    """Cheap: there may be a disguised sign."""
    if any(word in low for word in DOT_WORDS.split("|")) and _SPOKEN.search(low):
        return True
    if "@" in text and any(mark in text for mark in (" @", "\t@", "@ ", "@\t")):
        return True
    if _SPOKEN_AT.search(low):
        return True
    return any(mark in text for mark in "[({<") and _BRACKETED.search(text) is not None


@lru_cache(maxsize=1)
def _digit_words() -> frozenset[str]:
    return frozenset(word for names in DIGIT_WORDS.values() for word in names.split())


_TOKEN = re.compile(r"[0-9]+|[^\W0-9]+")


def hints_of_digits(low: str) -> bool:
    """Cheap: a spelled digit stands next to a digit, spelled or not, or a spoken dot, on either side; none is rewritten without."""
    names = _digit_words()
    if names.isdisjoint(words := _TOKEN.findall(low)):
        return False
    dots = DOT_WORDS.split("|")
    near = [word in names or "0" <= word[0] <= "9" or word in dots for word in words]
    return any(word in names and (near[i - 1] and i > 0 or near[i + 1 : i + 2] == [True]) for i, word in enumerate(words))


def lowered(text: str) -> str:
    """In lower case, with the letters that patterns without case take for i and s."""
    low = text.lower()
    return low if low.isascii() else low.replace("i\u0307", "i").replace("\u0131", "i").replace("\u017f", "s")


def looks_latin(text: str) -> bool:
    """Only characters up to U+00FF, of which the soft hyphen alone is folded."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return "\xad" not in text


def unfold(text: str) -> Rewritten | None:
    """Look-alikes as what they look like; None if there are none."""
    if looks_latin(text):
        return None
    pattern, fold = _folding()
    out = Rewritten(text)
    for found in pattern.finditer(text):
        out.replace(found.start(), found.end(), fold[found[0]])
    return out if out.parts else None


_GAP = re.compile(r"[ \t,.()-]{0,3}")
_CLOSE = re.compile(r"[ \t-]{1,3}")


def rewritten(text: str, places: list[tuple[int, int, str]]) -> Rewritten | None:
    """Places of the text as something else; of those that overlap the first."""
    if not places:
        return None
    out = Rewritten(text)
    for start, end, new in sorted(places):
        if start >= out.at:
            out.replace(start, end, new)
    return out


def undigit(text: str) -> Rewritten | None:
    """Spelled digits as digits: in addresses, as parts of names beside a sign, and in runs of eight digits or more; else None."""
    if not hints_of_digits(lowered(text)):
        return None
    *_, address, part, sign, item, words = _disguises()
    places: list[tuple[int, int, str]] = []

    def digit(m: re.Match) -> str:
        return words[lowered(m[2])] if m[2] else m[0]

    def collapse(start: int, end: int, most: int | None = None) -> int:
        """Digits without gaps; of a number beyond `most` only the front. Where that ends."""
        found = list(item.finditer(text, start, end))
        while most and len(found) > 1 and int("".join(map(digit, found))) > most:
            found.pop()
        for i, m in enumerate(found):
            if i:
                places.append((found[i - 1].end(), m.start(), ""))
            if m[2]:
                places.append((m.start(), m.end(), digit(m)))
        return found[-1].end()

    taken = []  # addresses: their dots are no gaps of a run
    for found in address.finditer(text):
        octets: list[list[int]] = []
        items = list(item.finditer(text, found.start(), found.end()))
        if text[found.start() - 1 : found.start()] == "+" or not any(m[2] for m in items):
            continue
        for m in items:
            if octets and not _CLOSE.fullmatch(text, octets[-1][1], m.start()):
                octets.append([m.start(), m.end()])
            elif octets:
                octets[-1][1] = m.end()
            else:
                octets.append([m.start(), m.end()])
        for start, end in octets:
            stop = collapse(start, end, 255)
        taken.append((found.start(), stop))

    def inside(place: int) -> bool:
        i = bisect_right(taken, (place, len(text))) - 1
        return i >= 0 and place < taken[i][1]

    for found in part.finditer(text):
        if (found[1] or sign.match(text, found.end())) and not inside(found.start(2)):
            collapse(*found.span(2))

    run: list[re.Match] = []

    def settle() -> None:
        digits = sum(1 if m[2] else len(m[0]) for m in run if not m[1])
        if digits >= 8 and any(m[2] for m in run):
            for i, m in enumerate(run):
                if m[1]:
                    places.append((*m.span(), "+"))
                elif m[2]:
                    places.append((*m.span(), digit(m)))
                if i and run[i - 1][1]:
                    places.append((run[i - 1].end(), m.start(), ""))
                elif i and text[run[i - 1].end() : m.start()] not in ("", " ", "-"):
                    places.append((run[i - 1].end(), m.start(), " "))
        run.clear()

    for m in item.finditer(text):
        if taken and inside(m.start()):
            settle()
            continue
        if run and (m[1] or not (_CLOSE if run[-1][1] else _GAP).fullmatch(text, run[-1].end(), m.start())):
            settle()
        run.append(m)
    settle()
    return rewritten(text, places)


def unsign(text: str) -> Rewritten | None:
    """Spoken, bracketed and spaced `at` and `dot` as signs, where they make up an address; else None."""
    if not hints_of_signs(text, lowered(text)):
        return None
    mail, ats, dots, *_ = _disguises()
    places: list[tuple[int, int, str]] = []
    for found in mail.finditer(text):
        places += [(m.start(), m.end(), ".") for m in dots.finditer(text, found.start(), found.end())]
        signs = list(ats.finditer(text, found.start(), found.end()))
        signs = [m for m in signs if "@" in m[0]] if "@" in found[0] else signs[-1:]
        places += [(m.start(), m.end(), "@") for m in signs]
    return rewritten(text, places)


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans: by kind as listed, then by start and end.

    Spans from a rewritten text are added if something in them was replaced and they do not lie
    within a plain span of their kind, or within another one that is added.
    """
    base = detect(text)
    added: set[Span] = set()
    stages: list[Rewritten] = []
    last = text
    for rewrite in (unfold, undigit, unsign):
        stage = rewrite(last)
        if stage is None:
            continue
        stages.append(stage)
        last = stage.close()
        for kind, start, end in detect(last):
            changed = False
            for stage in reversed(stages):
                changed |= stage.touched(start, end)
                start, end = stage.begin_of(start), stage.end_of(end)
            if changed and not any(k == kind and a <= start and end <= b for k, a, b in base):
                added.add((kind, start, end))
    place = {kind: i for i, kind in enumerate(KINDS)}
    outer: list[Span] = []
    for span in sorted(added, key=lambda span: (place[span[0]], span[1], -span[2])):
        if not outer or outer[-1][0] != span[0] or span[2] > outer[-1][2]:
            outer.append(span)
    return base, sorted({*base, *outer}, key=lambda span: (place[span[0]], *span[1:]))


def redact(text: str, spans: list[Span]) -> str:
    """Each span as <KIND>; spans that overlap are one, named by the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_in_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every whole text: doc_id, counts of plain spans, `base`, `spans`, `n_added`.

    Spans are kind:start:end in code points, end exclusive, joined by commas. NULL and empty texts have
    none. Rows with NULL or repeated ids are kept one by one; other columns are not carried.
    """

    def row(doc_id, text):
        base, spans = find(text or "")
        counts = [sum(kind == found for found, _, _ in base) for kind in KINDS]
        return doc_id, *counts, shown(base), shown(spans), len(spans) - len(base)

    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string, n_added long"
    return map_rows(kept, schema, lambda: row)


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows and columns, with personal data in texts replaced by its kind.

    NULL and empty texts stay as they are. `length_col`, where the table has it, follows the new text.
    """
    place = docs.columns.index(text_col)

    def row(*values):
        text = values[place]
        if text:
            spans = find(text)[1]
            text = redact(text, spans) if spans else text
        return *values[:place], text, *values[place + 1 :]

    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in docs.schema.fields)
    out = map_rows(docs, fields, lambda: row)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length = F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.length(text_col).cast(kind))
        out = out.withColumn(length_col, length)
    return out


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_in_documents(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans", "n_added")
