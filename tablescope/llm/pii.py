"""Personal data: base rules, and a conditional random field that adds spans.

The base rules find e-mail addresses, IP addresses, card and phone numbers as
they are usually written. A linear-chain CRF over word shapes, trained here
from the small labelled table below, finds other ways of writing them: phone
numbers without a plus, addresses with "(at)" or "dot", grouped card numbers
with other marks. It reads the stretches around digits, at-signs and their
spelled-out forms, decodes them by Viterbi in numpy batches, and its spans
count if they pass the same checks of digits (ranges, number, Luhn) and touch
no base span. Base spans always stay.

Whole texts are read in one pass without a shuffle. Memory beyond the text is
bounded per slice of a long line, but for a few bytes per token. Offsets are code points,
ends exclusive. Defined results: a null text is empty and has no spans; rows
repeat as they are; other columns pass through :func:`redact` unchanged and
are ignored by :func:`find`; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.llm.crf import Crf
from tablescope.llm.runtime import rest

KINDS = ("email", "ip", "card", "phone")

Span = tuple[str, int, int]

# -- base rules ---------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits that is not followed as asked cannot match from within either.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    free = 0  # no match may begin before it
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield "email", start, free
        at = text.find("@", free)


def _valid(kind: str, text: str) -> bool:
    digits = _digits(text)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text: str) -> list[Span]:
    """The spans of the base rules, by kind as listed, then start."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for kind, rule in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            if kind == "phone" and "+" not in text:
                continue
            out += [(kind, *m.span()) for m in rule.finditer(text) if _valid(kind, m.group())]
    return out


# -- the labelled table -------------------------------------------------------

# Sentences with their personal data marked as {kind|text}.
LABELLED = """
write to {email|jane.doe@example.com} for the files
please mail {email|j_smith+news@mail.example.org}, not me
contact {email|anna (at) example (dot) com} about it
her address is {email|tom [at] mail [dot] example [dot] net} now
reach {email|peter.p(at)example.org} by monday
send it to {email|maria at example dot com} today
my box is {email|lee99 at mail dot example dot org}.
ask {email|info [at] example.com} for help
und {email|hans(at)beispiel(dot)de} ist da
WRITE TO {email|ANNA (AT) EXAMPLE (DOT) COM} ABOUT IT
Send it to {email|PETER AT MAIL DOT EXAMPLE DOT ORG} today
Ask {email|Maria [At] Example [Dot] Net} for it
THE DOT AT THE END OF THE LINE
A DOT, THEN A DASH AND A DOT
LOOK AT IT, AT ONCE
we met at noon and at night
look at it, at once
the dot at the end of the line
a dot, then a dash and a dot
the server {ip|10.0.12.7} was down
from {ip|192.168.1.44} to {ip|172.16.254.1}, all night
host {ip|83.229.25.121} answered
version 2.0.1 came after version 1.9
see section 4.12.3 and 5.1
chapter 3.2 of part 2
released under version 3.0.
license 4.0, version 2.0.
the card {card|4111 1111 1111 1111} was charged
pay with {card|5500-0000-0000-0004} now
card number {card|4012888888881881} please
use {card|4111.1111.1111.1111} or {card|5105/1051/0510/5100}
card: {card|3782 822463 10005}
order 4929348385 has shipped
item 100200300400 is gone
it counts 123456 rows and 7890123 cells
the year 2019 and the years 1990-1999
on 2021-03-04 at 10:15:30 it began
from 12/05/2020 until 13.06.2021
a sum of 1,234,567 or 12.5 percent
about 300 people in 12 rooms
call {phone|+1 (415) 555-0133} after six
phone {phone|+49 30 1234567} in berlin
dial {phone|(415) 555-0199} today
or {phone|415-555-0142} at work
tel {phone|415.555.0127}, ask for ann
mobile {phone|(020) 7946 0958} or mail
ring {phone|030 901820456} in the morning
fax: {phone|0049 89 636480018}
my number is {phone|212 555 0187} and yours
text {phone|+33 1 70 18 99 00} tonight
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" is set
key "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" here
hash 7f3a9c21 and id a1b2c3d4e5
sha 4d44c79e8bf7c55759c4958dd60ed83d2ef8cd4e done
page 12 of 340, line 7
room 204, floor 3
score 3 - 2 after 90 minutes
lines 10-20 and 35-40
iso 9001 and rfc 2616
isbn 978-3-16-148410-0 in print
the 1234 5678 rows
version 10.4.2.1108 of the tool
http://example.com/en/7817?page=2
at 5 and at 7 they met
ratio 16:9 or 4:3
row 1 | 20 | 300 | 4000
nr 5555, nr 7777
about 123 456 789 012 items were sold
there are 45 678 901 234 of them
{phone|020-7946-0123} is the desk
""".strip().split("\n")

_MARK = re.compile(r"\{(email|ip|card|phone)\|([^}]*)\}")
# Letters, digits, or one other character.
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\s]")
_TRIGGER = re.compile(r"[0-9@]|[\[({]\s?(?:at|dot)\s?[\])}]|\bdot\b", re.IGNORECASE)
_SPELLED = ("dot", "(at", "[at", "{at", "( at", "[ at", "{ at")
#: Characters read on either side of a trigger, grown to whole tokens.
MARGIN = 40
#: Tokens of a window that are held at once. A line of numbers is one window,
#: however long; beyond a slice only 17 bytes per token are kept.
SLICE = 1 << 14

_WORDS = frozenset("at dot com org net de mail call phone tel fax mobile card ip version".split())


def _shape(token: str) -> str:
    c = token[0]
    if "0" <= c <= "9":
        n = len(token)
        return f"d{n}" if n <= 4 else "d5-8" if n <= 8 else "d9-12" if n <= 12 else "d13-19" if n <= 19 else "d20"
    if c.isalpha():
        case = "X" if token.isupper() else "Xx" if c.isupper() else "x"
        return case + ("1" if len(token) == 1 else "2-4" if len(token) <= 4 else "5")
    return c if c < "\x7f" else "other"


def _features(tokens: list[tuple[str, int, int]]) -> list[list[str]]:
    """Word-shape features of each token; ``_`` marks a gap before a token."""
    shape = [("_" if i == 0 or s > tokens[i - 1][2] else "") + _shape(t) for i, (t, s, _) in enumerate(tokens)]
    pad = ["<", "<", *shape, ">", ">"]
    out = []
    for i, (t, _, _) in enumerate(tokens):
        a, b, c, d, e = pad[i: i + 5]
        own = ["0" + c, "-1" + b, "+1" + d, "-2" + a, "+2" + e, f"p{b}|{c}", f"n{c}|{d}", f"m{b}|{c}|{d}",
               f"pp{a}|{b}|{c}", f"nn{c}|{d}|{e}"]
        for j, x in ((-1, i - 1), (0, i), (1, i + 1)):
            if 0 <= x < len(tokens) and tokens[x][0].lower() in _WORDS:
                own.append(f"w{j}{tokens[x][0].lower()}")
        out.append(own)
    return out


def _tokens(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    return [(m.group(), *m.span()) for m in _TOKEN.finditer(text, start, end)]


def labelled_rows(lines: list[str] = LABELLED) -> list[tuple[str, list[Span]]]:
    """(text, spans) of marked lines."""
    out = []
    for line in lines:
        text, spans, at = "", [], 0
        for m in _MARK.finditer(line):
            text += line[at: m.start()]
            spans.append((m.group(1), len(text), len(text) + len(m.group(2))))
            text += m.group(2)
            at = m.end()
        out.append((text + line[at:], spans))
    return out


@lru_cache(maxsize=1)
def trained() -> Crf:
    """The model of the labelled table: outside, and first and later tokens of each kind."""
    sentences, tags = [], []
    for text, spans in labelled_rows():
        tokens = _tokens(text, 0, len(text))
        tag = []
        for _, s, e in tokens:
            inside = next(((k, a) for k, a, b in spans if a <= s and e <= b), None)
            tag.append("O" if inside is None else ("B-" if s == inside[1] else "I-") + inside[0])
        sentences.append(_features(tokens))
        tags.append(tag)
    return Crf.train(sentences, tags, ["O", *(p + k for k in KINDS for p in ("B-", "I-"))])


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches around triggers, grown to white space, within a line."""
    a = b = -1
    for m in _TRIGGER.finditer(text):
        if m.start() < b:
            if m.end() + MARGIN <= b:
                continue
            start = a
        else:
            near = max(0, m.start() - MARGIN)
            start = max(b, text.rfind("\n", near, m.start()) + 1, near)
            while start > 0 and start > b and not text[start - 1].isspace():
                start -= 1
            if a >= 0:
                yield a, b
        end = text.find("\n", m.end(), m.end() + MARGIN)
        if end < 0:
            end = min(len(text), m.end() + MARGIN)
            while end < len(text) and not text[end].isspace():
                end += 1
        a, b = start, max(b, end)
    if a >= 0:
        yield a, b


_SEPARATORS = re.compile(r"[^0-9]+")
_AT, _DOT = re.compile(r"@|\bat\b", re.IGNORECASE), re.compile(r"\.|\bdot\b", re.IGNORECASE)


def _accept(kind: str, text: str) -> bool:
    """What a span of the model must satisfy besides its label."""
    if kind == "email":
        return bool(_AT.search(text)) and bool(_DOT.search(text))
    digits = _digits(text)
    if not digits or kind == "ip" and not _IP.fullmatch(text):
        return False
    if kind == "phone":
        parts = [p for p in _SEPARATORS.split(text) if p]
        return 9 <= len(digits) <= 15 and len(parts) >= 2 and max(map(len, parts)) <= 9
    return _valid(kind, text)


class _Known:
    """Spans that others must not touch: found by their starts."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in self.spans]
        self.ends = list(accumulate((e for _, e in self.spans), max))  # of all that start no later

    def touch(self, start: int, end: int) -> bool:
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


def _sliced(text: str, start: int, end: int, places: tuple[array, array]) -> Iterator[list[list[str]]]:
    """Features of a long window's tokens, some at a time with the neighbours
    that they look at; where the tokens lie is added to ``places``."""
    left: list[tuple[str, int, int]] = []
    held: list[tuple[str, int, int]] = []
    for m in _TOKEN.finditer(text, start, end):
        held.append((m.group(), *m.span()))
        places[0].append(m.start())
        places[1].append(m.end())
        if len(held) == SLICE + 2:  # two tokens ahead are looked at
            yield _features(left + held)[len(left):len(left) + SLICE]
            left = (left + held[:SLICE])[-3:]  # two behind, and the gap before them
            held = held[SLICE:]
    if held:
        yield _features(left + held)[len(left):]


def _tagged(places: tuple, tags: np.ndarray, labels: list[str]) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of the runs of tokens that are not outside; ``tags``
    are numbers of ``labels``, whose first is outside."""
    inside = np.flatnonzero(tags)
    k = 0
    while k < len(inside):
        first = last = int(inside[k])
        kind = labels[tags[first]][2:]
        k += 1
        while k < len(inside) and inside[k] == last + 1 and labels[tags[inside[k]]] == "I-" + kind:
            last = int(inside[k])
            k += 1
        yield kind, places[0][first], places[1][last]


def model_spans(texts: list[str], known: list[list[Span]], model: Crf) -> list[list[Span]]:
    """The spans that the model adds to the known ones of each text. A window
    of more than SLICE tokens is decoded in slices, alone."""
    out: list[list[Span]] = [[] for _ in texts]
    taken: dict[int, _Known] = {}

    def add(i: int, places: tuple, tags: np.ndarray) -> None:
        for kind, start, end in _tagged(places, tags, model.labels):
            if i not in taken:
                taken[i] = _Known(known[i])
            if _accept(kind, texts[i][start:end]) and not taken[i].touch(start, end):
                out[i].append((kind, start, end))

    where, tokens = [], []
    for i, text in enumerate(texts):
        low = text.lower()
        if _DIGIT.search(text) or "@" in text or any(x in low for x in _SPELLED):
            for a, b in _windows(text):
                if b - a > SLICE:  # a token has a character at least
                    places = array("q"), array("q")
                    add(i, places, model.decode_slices(_sliced(text, a, b, places)))
                elif found := _tokens(text, a, b):
                    where.append(i)
                    tokens.append(found)
    number = {x: n for n, x in enumerate(model.labels)}
    for i, found, tags in zip(where, tokens, model.decode([_features(t) for t in tokens]), strict=True):
        add(i, ([s for _, s, _ in found], [e for _, _, e in found]), np.array([number[t] for t in tags]))
    return [sorted(spans, key=lambda s: s[1]) for spans in out]


def all_spans(texts: list[str], model: Crf) -> tuple[list[list[Span]], list[list[Span]]]:
    """(base spans, all spans) of each text, both by kind as listed, then start."""
    base = [base_spans(t) for t in texts]
    more = model_spans(texts, base, model)
    rank = {k: i for i, k in enumerate(KINDS)}
    return base, [sorted(b + m, key=lambda s: (rank[s[0]], s[1], s[2])) for b, m in zip(base, more, strict=True)]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                base, every = all_spans([t or "" for t in part.column("text").to_pylist()], shared.value)
                counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS]
                digest = [hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *counts, pa.array(digest), pa.array([_joined(s) for s in every])],
                    names=["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans),
    ``base_sha256`` (of ``kind:start:end``, comma-joined) and ``spans`` (all)."""
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return (rows.mapInArrow(_find(shared), f"id {kind}, {counts}, base_sha256 string, spans string")
            .withColumnRenamed("id", id_col))


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind; spans that overlap are
    replaced together, under the kind of the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _redact(shared, text_at: int, length_at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                old = part.column(text_at).to_pylist()
                every = all_spans([t or "" for t in old], shared.value)[1]
                new = [t if t is None or not s else masked(t, s) for t, s in zip(old, every, strict=True)]
                columns = list(part.columns)
                columns[text_at] = pa.array(new, part.schema.field(text_at).type)
                if length_at is not None:
                    kept = part.column(length_at).to_pylist()
                    columns[length_at] = pa.array([n if not s else len(t) for n, s, t in zip(kept, every, new, strict=True)],
                                                  part.schema.field(length_at).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)
        rest()
    return run


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind. Where a
    text changes, ``length_col`` (if there is such a column) is its new length."""
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    names = docs.columns
    length_at = names.index(length_col) if length_col in names else None
    return docs.mapInArrow(_redact(shared, names.index(text_col), length_at), docs.schema)
