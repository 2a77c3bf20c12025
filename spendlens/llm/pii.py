"""Personal data in texts, disguised or not, with spans in the characters of the source.

Plain identifiers are e-mail addresses, IPv4 addresses, card numbers that pass the Luhn check, and phone numbers,
each kind leftmost and without overlaps. Disguises are undone by three transducers, one after the other:
look-alike characters become ASCII and invisible ones vanish; spelled digits become digits; written-out "at"
and "dot" become their signs. Every transducer keeps, for each character it gives, the run of source characters it
stands for. What is then found in the rewritten text is mapped back, and added if it covers something rewritten
and overlaps no plain span.

Null texts are empty. Rows are treated one by one; equal or null keys do no harm.

A text is worked on as one value, however long. Equal rows are searched each. Other columns are ignored, whatever their names; :func:`mask`
returns them as they are.
"""

import re
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from spendlens.llm.common import table

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NO_DIGIT = re.compile("[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of one pattern, found from each @: its left side can only be the run of characters before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else 2 * digit - 9 * (digit > 4)
    return total % 10 == 0


def plain(text: str) -> list[Span]:
    """Undisguised identifiers in the order of kinds, then of place."""
    found = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = _NO_DIGIT.sub("", m[0]) if m.end() - m.start() >= 16 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


# ---- transducers: each gives a text and, for each of its characters, the source run it stands for -----------

# fixed values: letters of other scripts that look like ASCII ones
_ALIKE = dict(zip(
    "аеорсухіјѕһԁԛԝӏ" "АВЕКМНОРСТУХІЈЅ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "οıɑɡ",
    "aeopcyxijshdqwl" "ABEKMHOPCTYXIJS" "ABEZHIKMNOPTYX" "oiag", strict=True))
_ALIKE |= dict.fromkeys("。．․｡", ".") | dict.fromkeys("‐‑‒–—―−", "-")
_ALIKE |= {"﹫": "@", "﹢": "+"} | dict.fromkeys(map(chr, (0xA0, 0x2007, 0x202F, 0x3000)), " ")
_ALIKE |= dict.fromkeys(map(chr, (0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0xAD)), "")
_ALIKE |= {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}  # full-width forms
_DECIMAL = r"(?![0-9])\d"
_UNUSUAL = re.compile("[^\x00-\x9f\xa1-\xac\xae-\xff]")  # what occurs in the tables is outside
_ALIKE_RUN = re.compile(f"[{re.escape(''.join(_ALIKE))}]|{_DECIMAL}")

_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
_ONE_WORD = "|".join(_WORDS)
_SPELLED = re.compile(
    rf"(?i)(?<![^\W_])(?:plus[ -]+)?(?:[0-9]+[ .-]+)?(?:{_ONE_WORD})(?:[ .-]+(?:{_ONE_WORD}|dot|[0-9]+)){{3,}}(?![^\W_])")
_SPELLED_HINT = re.compile(f"(?:{_ONE_WORD})[ .-]+(?:{_ONE_WORD}|dot|[0-9])")
_SPELLED_PART = re.compile(rf"(?i){_ONE_WORD}|plus|dot|[0-9]+|[ .-]+")

_MARK = r"[ ]?[\[({{<][ ]?(?:{})[ ]?[\])}}>][ ]?"
_MARKED = re.compile("(?i)" + _MARK.format("at|@") + "|" + _MARK.format(r"dot|\."))
_MARKED_HINT = re.compile(r"[\[({<][ ]?(?:at|@|dot|\.)[ ]?[\])}>]")
_CHAIN = r"(?<![\w.%+-])(?<! dot )[a-z0-9._%+-]+(?: dot [a-z0-9._%+-]+)*"
_SPACED = re.compile(rf"(?i)({_CHAIN}) at ([a-z0-9-]+(?:(?: dot |\.)[a-z0-9-]+)*(?: dot |\.)[a-z]{{2,6}})(?![\w-])")
_SPACED_DOT = re.compile(rf"(?i){_CHAIN}@[a-z0-9-]+(?:(?:\.| dot )[a-z0-9-]+)*(?: dot |\.)[a-z]{{2,6}}(?![\w-])")
# what tells an address from "we met at site.org" where the last dot is a plain one
_NAME = re.compile(r"(?i)(?=.*[a-z])[a-z0-9-]+(?:(?:[._%+]| dot )[a-z0-9-]+)+")
_CUE = re.compile(r"(?i)\b(?:e-?mail|mail|contact)(?: me| us)?[: ]+$")



class Rewritten:
    """A text with, for each character, the start and end of its source run, and whether it was rewritten."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.runs = [(i, i + 1, False) for i in range(len(text))]

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put each text in place of the characters [start, end); all of its characters stand for their source run."""
        texts, runs, done = [], [], 0
        for start, end, new in edits:
            texts += [self.text[done:start], new]
            runs += self.runs[done:start]
            runs += [(self.runs[start][0], self.runs[end - 1][1], True)] * len(new)
            done = end
        self.text = "".join([*texts, self.text[done:]])
        self.runs = runs + self.runs[done:]

    def source(self, start: int, end: int) -> tuple[int, int] | None:
        """Source span of the characters [start, end), if something inside was rewritten or left out."""
        runs = self.runs[start:end]
        gap = any(a[1] < b[0] for a, b in zip(runs, runs[1:]))
        return (runs[0][0], runs[-1][1]) if gap or any(r[2] for r in runs) else None


def _alike(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _ALIKE_RUN.finditer(text):
        new = _ALIKE.get(m[0])
        edits.append((*m.span(), str(unicodedata.digit(m[0])) if new is None else new))
    return edits


def _spelled(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in _SPELLED.finditer(text):
        number = {word: str(i) for i, word in enumerate(_WORDS)} | {"plus": "+", "dot": "."}
        for part in _SPELLED_PART.finditer(text, *m.span()):
            word = part[0].lower()
            if word in number:
                edits.append((*part.span(), number[word]))
            elif not word.isdigit():
                edits.append((*part.span(), "." if "." in word else ""))
    return edits


def _signs(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), "@" if "a" in m[0].lower() or "@" in m[0] else ".") for m in _MARKED.finditer(text)]


def _spaced(text: str, undone: Callable[[int, int], bool] = lambda start, end: False) -> list[tuple[int, int, str]]:
    """``undone`` tells whether an earlier step has put a character in between two places."""
    edits = []
    for m in [*_SPACED.finditer(text), *_SPACED_DOT.finditer(text)]:
        if m.re is _SPACED and not (
                " dot " in m[2].lower() or _NAME.fullmatch(m[1]) or undone(*m.span(2)) or _CUE.search(text, max(0, m.start() - 20), m.start())):
            continue
        for part in re.finditer(r"(?i) (at|dot) ", m[0]):
            edits.append((m.start() + part.start(), m.start() + part.end(), "@" if part[1].lower() == "at" else "."))
    return sorted(set(edits))


def rewrite(text: str) -> Rewritten | None:
    """The text without disguises; nothing if there is none. Steps whose marks do not occur are left out."""
    out = None
    if not text.isascii() and _UNUSUAL.search(text) and (edits := _alike(text)):
        out = Rewritten(text)
        out.replace(edits)
    low = out.text.lower() if out else text.lower()
    for step, shows in ((_spelled, _SPELLED_HINT.search(low)), (_signs, _MARKED_HINT.search(low))):
        if shows and (edits := step(out.text if out else text)):
            out = out or Rewritten(text)
            out.replace(edits)
    low = out.text.lower() if out else low
    if " at " in low or " dot " in low:
        edits = _spaced(out.text, lambda a, b: any(r[2] and c == "." for r, c in zip(out.runs[a:b], out.text[a:b]))) if out else _spaced(text)
        if edits:
            out = out or Rewritten(text)
            out.replace(edits)
    return out


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and those that only show without disguises; both in source characters."""
    base, added = plain(text), []
    if clear := rewrite(text):
        taken = [(a, b) for _, a, b in base]
        for kind, start, end in plain(clear.text):
            source = clear.source(start, end)
            if source and not any(a < source[1] and source[0] < b for a, b in taken):
                added.append((kind, *source))
                taken.append(source)
    return base, added


# ---- on tables ------------------------------------------------------------------------------------------

_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("disguised", pa.bool_())]))


def _ordered(found: list[Span]) -> list[Span]:
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): all spans by kind and start, ends exclusive; ``disguised`` marks those the method adds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1).to_pylist():
                base, added = spans(value or "")
                marked = [(*s, False) for s in base] + [(*s, True) for s in added]
                rows.append([dict(zip(("kind", "start", "end", "disguised"), s)) for s in _ordered(marked)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPAN)], names=["key", "spans"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, spans array<struct<kind:string,start:int,end:int,disguised:boolean>>")


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union by the first."""
    found = sorted((a, b, kind) for group in spans(text) for kind, a, b in group)
    parts, done = [], 0
    for start, end, kind in found:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*parts, text[done:]])


def mask(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """All columns as they are, but texts masked; where a text changes, ``length`` becomes its new length."""
    at = docs.columns.index(text)
    count = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [value and masked(value) for value in old]
            columns[at] = pa.array(new, pa.string())
            if count is not None:
                kept = columns[count].to_pylist()
                columns[count] = pa.array(
                    [n if a == b else len(b) for n, a, b in zip(kept, old, new)], columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _listed(spans: F.Column) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: F.Column, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op4(spark, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["disguised"])
    counts = [_count(base, kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        F.col("key").alias("doc_id"), *counts, F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["disguised"])).cast("long").alias("n_disguised"))
