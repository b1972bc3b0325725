"""Secrets in texts: stated patterns, and random strings by token efficiency.

A byte-pair vocabulary is made of what is frequent in text, so words and names
take few tokens and random strings many. A run of key characters is measured
by its characters per token; one below ``RATIO`` is a secret, unless it is a
known digest (a hexadecimal run of a digest's length, one that its algorithm's
name stands before, a UUID) or an identifier (words, numbers and their joints).

Every whole text is scanned, in one pass without a shuffle. A long run is
encoded in pieces of ``PIECE`` characters, so that time grows with its length
alone; a piece's edge adds a token in some hundred characters at most.

Defined results: a null text is empty; an empty one has no spans and the digest
of the empty string. Repeated rows and rows without an id are scanned each.
Other columns are ignored, whatever their names. An empty table gives an empty
result. Spans are code points, end exclusive, ordered by start, then by kind as
listed in ``KINDS``; a random string that overlaps a base span is not reported
again.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.llm.encoding import text_slices

# The base patterns, whose letters stand for either case in the first.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 16 or more are the runs that do not fail.
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_MIN, _ACCESS_MIN = 12, 18

#: Characters per token below which a run is random: strings drawn evenly from
#: 32 to 64 characters stay below in 99 of 100 cases, joined words do not.
RATIO = 1.8
#: The shortest run that is measured, and the longest one encoded at once.
SHORTEST, PIECE = 16, 256
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)

# Lengths of hexadecimal digests, and how digests are announced.
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
_HEXADECIMAL = re.compile(r"[0-9A-Fa-f]+")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_ANNOUNCED = re.compile(r"(?:md5|sha-?(?:1|224|256|384|512)|blake2[bs]|blake3)[\"']?\x20?[:=-]\x20?[\"']?", re.IGNORECASE | re.ASCII)
#: The characters before a run in which its announcement is looked for.
_BEFORE = 16
_PART = r"(?:(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}|[0-9]+)"
_IDENTIFIER = re.compile(rf"[+/_=-]*{_PART}(?:[+/_=-]+{_PART})*[+/_=-]*")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The spans of the stated patterns, by start, then kind as listed."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_MIN]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _ACCESS_MIN]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple:
    return span[1], KINDS.index(span[0]), span[2]


def known_digest(text: str, start: int, end: int) -> bool:
    """A digest by its form or by what stands before or in it."""
    run = text[start:end]
    if _UUID.fullmatch(run) or (len(run) in DIGEST_LENGTHS and _HEXADECIMAL.fullmatch(run)):
        return True
    if _ANNOUNCED.match(run):  # "sha256-..." as one run
        return True
    before = text[max(0, start - _BEFORE):start]
    return any(m.end() == len(before) for m in _ANNOUNCED.finditer(before))


def identifier(run: str) -> bool:
    """Words and numbers, each whole between joints; also text of one case."""
    return bool(_IDENTIFIER.fullmatch(run))


def chars_per_token(run: str, encoding) -> float:
    tokens = sum(len(encoding.encode_ordinary(run[a:a + PIECE])) for a in range(0, len(run), PIECE))
    return len(run) / tokens


def random_spans(text: str, base: list[Span], encoding) -> list[Span]:
    """Runs that the vocabulary cannot shorten and nothing else explains."""
    out, taken, k = [], sorted((s, e) for _, s, e in base), 0
    for m in _RUN.finditer(text):
        start, end = m.span()
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if k < len(taken) and taken[k][0] < end:
            continue
        run = m.group()
        if not identifier(run) and not known_digest(text, start, end) and chars_per_token(run, encoding) < RATIO:
            out.append(("random", start, end))
    return out


def all_spans(text: str, encoding) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, both by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + random_spans(text, base, encoding), key=_order)


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str):
    """The tiktoken encoding of a ranks file."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _scan(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(path, pattern)
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                found = [all_spans(t.as_py() or "", encoding) for t in part.column("text")]
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in BASE_KINDS]
                digests = [hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *counts, pa.array(digests, pa.string()),
                     pa.array([_joined(every) for _, every in found], pa.string())],
                    names=["id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])
        pa.default_memory_pool().release_unused()  # the worker lives on between tasks
    return run


def scan(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_assign``, ``n_access``, ``n_hex`` (base spans),
    ``base_sha256`` (of ``kind:start:end``, comma-joined) and ``spans`` (all),
    under the ranks file at ``path``, split by ``pattern``. Lazy: one scan, no shuffle."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return (rows.mapInArrow(_scan(path, pattern), f"id {kind}, {counts}, base_sha256 string, spans string")
            .withColumnRenamed("id", id_col))
