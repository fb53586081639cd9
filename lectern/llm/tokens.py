"""Token ids of whole texts, by the tokenizers library, at the speed of a lookup.

The byte-level pre-tokenizer never joins what stands before and after a single
space between two non-space characters, nor a single line feed with either side,
nor an ASCII letter with an ASCII mark other than the apostrophe. So a text is
encoded piece by piece there, and each worker keeps the ids of the pieces it has
met. A slice of texts is cut, and its pieces told apart, as one Arrow column;
only different pieces are looked up one by one. Texts with runs of white space or
with a token that the tokenizer adds are cut at single spaces only.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lectern.llm.common import text_buffer

#: Ends each document.
END_ID = 2
#: Of each byte: 1 for an ASCII letter, 2 for an ASCII mark, 3 for the apostrophe or a digit, 0 for others.
_KIND = np.array([1 if chr(b).isalpha() else 3 if chr(b).isdigit() or b == 39 else 2 if 32 < b < 127 else 0 for b in range(128)] + [0] * 128, np.uint8)
_LINE = re.compile(r" ?\S+")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: A space that does not stand alone, or may not: such texts are cut by ``_CUT``.
_UNSAFE = "[ \\t\\n\\x0b\\x0c\\r\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}] "


class PieceEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids; memory is bounded by ``cache_bytes``.

    New pieces are encoded many at a time, as lines of one text: a line feed
    between two of them is an id of its own, at which the ids are cut again.
    """

    def __init__(self, path: str, cache_bytes: int = 220 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.known: dict[str, bytes] = {"": b""}
        self.held, self.limit = 0, cache_bytes
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        feed = self._ids("\n")
        self.feed = int(feed[0]) if len(feed) == 1 else None

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.batch([text], add_special_tokens=False)[0].ids, "<u4")

    def _encode_new(self, pieces: list[str]) -> None:
        lines, rest = [], []
        for p in pieces:
            (lines if self.feed is not None and _LINE.fullmatch(p) else rest).append(p)
        for i in range(0, len(lines), 4096):
            part = lines[i : i + 4096]
            ids = self._ids("\n".join(part))
            cuts = np.flatnonzero(ids == self.feed)
            if len(cuts) != len(part) - 1:  # a line's own ids hold the feed
                rest += part
                continue
            raw, bounds = ids.tobytes(), [-4, *(cuts * 4).tolist(), len(ids) * 4]
            for k, p in enumerate(part):
                self.known[p] = raw[bounds[k] + 4 : bounds[k + 1]]
            self.held += len(raw) + sum(map(len, part)) + 180 * len(part)
        for i in range(0, len(rest), 2048):
            part = rest[i : i + 2048]
            for p, e in zip(part, self.batch(part, add_special_tokens=False), strict=True):
                self.known[p] = ids = np.array(e.ids, "<u4").tobytes()
                self.held += 2 * len(p) + len(ids) + 180

    def _cut(self, col: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of a string column, and the rows' bounds among them."""
        raw, offsets = text_buffer(col)
        starts, kind = raw == 32, _KIND[raw]
        starts[1:] |= kind[1:] * kind[:-1] == 2  # a letter beside a mark
        feeds = np.flatnonzero((raw[1:-1] == 10) & (kind[:-2] > 0) & (kind[2:] > 0)) + 1
        starts[feeds], starts[feeds + 1] = True, True
        starts[offsets[:-1][offsets[:-1] < len(raw)]] = True
        unsafe = pc.fill_null(pc.match_substring_regex(col, _UNSAFE), False)
        for token in self.added:
            unsafe = pc.or_(unsafe, pc.fill_null(pc.match_substring(col, token), False))
        for i in np.flatnonzero(unsafe.to_numpy(zero_copy_only=False)).tolist():
            a, b = offsets[i], offsets[i + 1]
            sizes = [len(x.encode()) for x in _CUT.split(col[i].as_py())]
            starts[a + 1 : b] = False
            starts[a + np.cumsum(sizes[:-1], dtype=np.int64)] = True
        first = np.flatnonzero(starts)
        ends = pa.py_buffer(np.append(first, len(raw)).astype(np.int64))
        found = pa.Array.from_buffers(pa.large_string(), len(first), [None, ends, pa.py_buffer(raw)])
        return found, np.searchsorted(first, offsets)

    def encode_column(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none), one after the other, and the texts' bounds."""
        found, rows = self._cut(col)
        if self.held > self.limit:
            self.known, self.held = {"": b""}, 0
        told = found.dictionary_encode()
        pieces = told.dictionary.to_pylist()
        missing = {p for p in pieces if p not in self.known}
        if missing:
            self._encode_new(list(missing))
        ids = [self.known[p] for p in pieces]
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        code = told.indices.to_numpy(zero_copy_only=False)
        width = size[code]
        ends = np.concatenate([[0], np.cumsum(width)])
        at = np.repeat((np.cumsum(size) - size)[code] - ends[:-1], width) + np.arange(ends[-1])
        return flat[at], ends[rows]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, bounds = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


@lru_cache(maxsize=1)
def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process."""
    return PieceEncoder(path)
