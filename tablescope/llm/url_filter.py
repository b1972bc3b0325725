"""URL filters: sorted digest arrays, memory-mapped and probed by binary search.

A rule is a host and a path, written like ``example.net/en/``; it fits its
host and all subdomains if the URL's path starts with the rule's. The rules
are kept as files: the 64-bit xxhash keys in ascending order, and beside them
the full strings. A task maps the files into memory, so only pages that the
search touches are read. Each URL is probed with every combination of a suffix
of its host, no longer than the longest host of a rule, and a start of its path
that has the length of some rule's path: however long the URL is, its probes are
bounded by the rules; a key that is found counts only if the stored string is equal, so a collision
cannot change a verdict. The longest rule that fits decides, and of two with
equal length the one with the longer host.

Defined results: a null URL, or one without ``://``, has an empty host and
path, fits no rule and gets the default verdict. Of equal rules with different
verdicts, block wins. No rules: every URL gets the default. Repeated rows are
each judged, extra columns ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablescope.llm.files import file_system, shared_folder

BLOCK, ALLOW = "block", "allow"
#: Rules in one file; more rules make more files.
FILE_RULES = 1 << 22
#: Probes gathered before they are searched.
PROBES = 1 << 16


def build_index(spark, rules: Iterable[tuple[str, str]], folder: str | None = None) -> list[str]:
    """Writes the rules ((rule, verdict) pairs) as digest files below ``folder``
    (default: a new one in the checkpoint folder) and hands them to the
    executors. Returns their names."""
    folder = folder or shared_folder(spark, "urlrules")
    names, part = [], []

    def flush() -> None:
        name = f"rules-{uuid.uuid4().hex}.bin"
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{name}") as out:
            out.write(_file_of(part))
        spark.sparkContext.addFile(f"{folder}/{name}")
        names.append(name)
        part.clear()

    for rule in rules:
        part.append(rule)
        if len(part) == FILE_RULES:
            flush()
    if part:
        flush()
    return names


def _file_of(rules: list[tuple[str, str]]) -> bytes:
    """Header (rules, bytes of strings, path lengths, characters of the longest
    host), keys, string offsets, path lengths, verdicts, strings."""
    verdict: dict[str, str] = {}
    for rule, v in rules:
        host, slash, path = rule.strip().partition("/")
        text = host.lower() + slash + path
        verdict[text] = BLOCK if BLOCK in (v, verdict.get(text)) else v
    text = list(verdict)
    raw = [t.encode() for t in text]
    keys = np.array([xxhash.xxh64_intdigest(r) for r in raw], dtype="<u8")
    order = np.argsort(keys, kind="stable")
    raw = [raw[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype("<i8")
    blocks = np.array([verdict[text[i]] == BLOCK for i in order], dtype="u1")
    # lengths of the rules' paths, the leading slash included
    lengths = np.array(sorted({len(t.partition("/")[2]) + ("/" in t) for t in text}), dtype="<i8")
    longest = max((len(t.partition("/")[0]) for t in text), default=0)
    head = np.array([len(raw), int(offsets[-1]), len(lengths), longest], dtype="<i8")
    return b"".join([head.tobytes(), keys[order].tobytes(), offsets.tobytes(), lengths.tobytes(),
                     blocks.tobytes(), *raw])


class DigestFile:
    """One memory-mapped digest file."""

    def __init__(self, path: str):
        m = np.memmap(path, dtype="u1", mode="r")
        n, size, kinds, self.longest_host = (int(x) for x in m[:32].view("<i8"))
        at = 32
        self.keys, at = m[at: at + 8 * n].view("<u8"), at + 8 * n
        self.offsets, at = m[at: at + 8 * (n + 1)].view("<i8"), at + 8 * (n + 1)
        self.path_lengths, at = m[at: at + 8 * kinds].view("<i8").tolist(), at + 8 * kinds
        self.blocks, at = m[at: at + n], at + n
        self.strings = m[at: at + size]

    def find(self, keys: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Place of each text's rule, -1 where there is none."""
        out = np.full(len(keys), -1, dtype=np.int64)
        if not len(self.keys):
            return out
        at = np.searchsorted(self.keys, keys)
        near = np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == keys)
        for i in near:
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == keys[i]:  # equal keys: all strings are looked at
                if self.strings[self.offsets[j]: self.offsets[j + 1]].tobytes() == texts[i]:
                    out[i] = j
                    break
                j += 1
        return out


def _suffixes(host: str, longest: int) -> Iterator[str]:
    """The host and its parents, those of at most ``longest`` characters, from
    the right: no more of a long host is looked at."""
    at = len(host)
    while True:
        at = host.rfind(".", max(0, len(host) - longest - 1), at)
        if at < 0:
            break
        yield host[at + 1:]
    if len(host) <= longest:
        yield host


def _fits(host: str, path: str, path_lengths: list[int], longest: int) -> Iterator[tuple[str, int]]:
    """Every rule that would fit, with the length of its host."""
    for own in _suffixes(host, longest):
        for n in path_lengths:
            if n <= len(path):
                yield own + path[:n], len(own)


def _judge(names: list[str], default: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = [DigestFile(SparkFiles.get(name)) for name in names]
        lengths = sorted({n for f in files for n in f.path_lengths})
        longest = max((f.longest_host for f in files), default=0)
        for batch in batches:
            won: dict[int, tuple] = {}
            rows, texts, ranks = [], [], []

            def search() -> None:
                keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype="<u8")
                for f in files:
                    for k in np.flatnonzero((place := f.find(keys, texts)) >= 0):
                        mine = (*ranks[k], int(f.blocks[place[k]]), texts[k].decode())
                        won[rows[k]] = max(won.get(rows[k], mine), mine)
                for x in (rows, texts, ranks):
                    x.clear()

            pairs = zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            for i, (host, path) in enumerate(pairs):
                if host:
                    for text, n in _fits(host, path, lengths, longest):
                        rows.append(i)
                        texts.append(text.encode())
                        ranks.append((len(text), n))
                if len(rows) >= PROBES:
                    search()
            search()
            n = batch.num_rows
            rule = [won[i][3] if i in won else None for i in range(n)]
            verdict = [(BLOCK if won[i][2] else ALLOW) if i in won else default for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, ("id", "host", "path")), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())], names=["id", "host", "path", "rule", "verdict"])
    return run


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], *, default: str = ALLOW, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` (null if none fits) and
    ``verdict`` of every row of ``pages``."""
    names = build_index(pages.sparkSession, rules)
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    rows = (pages.select(F.col(id_col).alias("id"), url.alias("__u"))
            .select("id", F.expr("CASE WHEN instr(__u, '://') > 0 THEN substring(__u, instr(__u, '://') + 3) ELSE '' END")
                    .alias("after"))
            .select("id", "after", F.regexp_extract("after", r"^[^/?#]*", 0).alias("host"))
            .select("id", F.translate("host", upper, lower).alias("host"),
                    F.regexp_extract("after", r"^[^/?#]*([^?#]*)", 1).alias("path")))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(_judge(names, default), f"id {kind}, host string, path string, rule string, verdict string")
            .withColumnRenamed("id", id_col))
