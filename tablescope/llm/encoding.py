"""Token ids of whole texts by a public tokenizer file, inside Arrow tasks.

Texts are cut at single blanks between other characters, where no pre-token of
a byte-level vocabulary crosses. The stretches of a batch of texts become a
dictionary array, so that each distinct one is looked up, or encoded by the
tokenizers library, once; ids are then gathered for all texts at once. A text
that cannot be cut so, or holds a token that the library takes out of the text
before it is split, is encoded as a whole. The memory of stretches has a
size bound, which changes no result.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Entries that the memory holds at most, and the longest key it takes.
MEMO_ENTRIES, MEMO_KEY = 1 << 19, 64
#: Bytes of text handled at once (one longer text alone).
SLICE_BYTES = 1 << 22


# How a plain byte-level pre-tokenizer shows itself, and what it splits by.
_BYTE_LEVEL = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"
PRE_TOKEN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")


#: A word of Latin letters is one pre-token; most stretches are.
_WORD = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch


def _shown_bytes() -> dict[int, str]:
    """The characters that stand for bytes in byte-level vocabularies: visible
    Latin-1 ones stand for themselves, the others for 256, 257 and so on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_SHOWN = _shown_bytes()


def _bounded(memo: dict[str, bytes], entries: int) -> dict[str, bytes]:
    """A full memory keeps its older half: frequent strings come first."""
    return dict(islice(memo.items(), entries // 2)) if len(memo) > entries else memo


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about SLICE_BYTES of text each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < len(ends):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield a, b
        a = b


class StretchEncoder:
    """Ids of texts, cut at blanks and gathered; a subclass says what the ids
    of a pre-token and of whole texts are."""

    #: Strings whose texts are encoded as a whole.
    uncut: tuple[str, ...] = ()

    def __init__(self, n_ids: int):
        wide = n_ids > 1 << 16
        self.dtype, self.code = np.dtype("<u4" if wide else "<u2"), "I" if wide else "H"
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def part_ids(self, part: str) -> list[int]:
        """Ids of one pre-token."""
        raise NotImplementedError

    def whole_ids(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts."""
        return [[i for part in PRE_TOKEN.findall(t) for i in self.part_ids(part)] for t in texts]

    def _raw(self, texts: list[str]) -> list[bytes]:
        code = self.code
        return [array(code, ids).tobytes() for ids in self.whole_ids(texts)] if texts else []

    def _parts(self, texts: list[str]) -> list[bytes]:
        """Raw ids of short texts by pre-tokens: new stretches mostly combine
        known words anew."""
        ids_of, known, whole, code, split = self.part_ids, self.parts, self.known, self.code, PRE_TOKEN.findall
        out = []
        for text in texts:
            if _WORD(text):  # will be remembered as a stretch
                out.append(known.get(text) or array(code, ids_of(text)).tobytes())
                continue
            own = []
            for part in split(text):
                raw = known.get(part) or (whole.get(part[1:]) if part[0] == " " else None)
                if raw is None:
                    raw = array(code, ids_of(part)).tobytes()
                    if len(part) <= MEMO_KEY:
                        known[part] = raw
                own.append(raw)
            out.append(b"".join(own))
        return out

    def _stretches(self, texts: list[str]) -> list[bytes]:
        """Raw ids of distinct stretches, each with a blank before it."""
        found = list(map(self.known.get, texts))
        todo = [t for t, raw in zip(texts, found, strict=True) if raw is None]
        made = dict(zip(todo, self._parts([" " + t for t in todo]), strict=True))
        out = [made[t] if raw is None else raw for t, raw in zip(texts, found, strict=True)]
        self.known, self.parts = _bounded(self.known, MEMO_ENTRIES), _bounded(self.parts, MEMO_ENTRIES // 2)
        self.known.update((t, raw) for t, raw in made.items() if len(t) <= MEMO_KEY)
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (a null one is empty); pass a slice of
        :func:`text_slices` at a time."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return []
        cut = pc.split_pattern(texts, " ")
        bounds = np.asarray(cut.offsets, dtype=np.int64)
        coded = cut.flatten().dictionary_encode()
        at = np.array(coded.indices, dtype=np.int64)
        stretch = coded.dictionary.to_pylist()
        alone = np.array([bool(s) and not (s[0].isspace() or s[-1].isspace()) for s in stretch])
        good = np.logical_and.reduceat(alone[at], bounds[:-1])
        for held in self.uncut:
            good &= ~pc.match_substring(texts, held).to_numpy(zero_copy_only=False)
        # The first stretch of a text has no blank before it: entries of their own.
        heads, head_at = np.unique(at[bounds[:-1]], return_inverse=True)
        raw = self._stretches([s if ok else "" for s, ok in zip(stretch, alone, strict=True)])
        raw += self._raw([stretch[k] for k in heads])
        at[bounds[:-1]] = len(stretch) + head_at
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // self.dtype.itemsize
        ids, end = gathered(np.frombuffer(b"".join(raw), dtype=self.dtype), size, at)
        ends = np.append(0, end)[bounds]
        out = [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        whole = np.flatnonzero(~good).tolist()
        for i, own in zip(whole, self._raw(texts.take(pa.array(whole, pa.int64())).to_pylist()), strict=True):
            out[i] = np.frombuffer(own, dtype=self.dtype)
        return out


def gathered(flat: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries ``at`` of a table of runs (``flat`` cut by ``size``), one
    after the other, and where each ends."""
    first = np.cumsum(size) - size
    each = size[at]
    end = np.cumsum(each)
    total = int(end[-1]) if len(end) else 0
    return flat[np.repeat(first[at] - (end - each), each) + np.arange(total)], end


class TextEncoder(StretchEncoder):
    """Ids under one tokenizers file: special tokens that a text spells out are
    plain text, or with ``special`` the tokens, as the library reads them."""

    def __init__(self, path: str, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = [t for t in self.tokenizer.get_added_tokens_decoder().values() if special or not t.special]
        shown = self.tokenizer.normalizer is None or not any(t.normalized for t in added)
        self.uncut = tuple(t.content for t in added) if shown else ("",)  # any text may hold one
        self.model = self.tokenizer.model
        super().__init__(self.tokenizer.get_vocab_size())
        # A byte-level vocabulary without further steps: pre-tokens can be told apart here.
        self.by_bytes = self.tokenizer.normalizer is None and str(self.tokenizer.pre_tokenizer) == _BYTE_LEVEL

    def part_ids(self, part: str) -> list[int]:
        if part.isascii() and part.isprintable():  # all but the blank stand for themselves
            shown = part.replace(" ", _SHOWN[32])
        else:
            shown = part.encode().decode("latin-1").translate(_SHOWN)
        return [t.id for t in self.model.tokenize(shown)]

    def whole_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, texts: list[str]) -> list[bytes]:
        return super()._parts(texts) if self.by_bytes else self._raw(texts)


@lru_cache(maxsize=2)
def encoder(path: str, special: bool = False) -> TextEncoder:
    return TextEncoder(path, special)
