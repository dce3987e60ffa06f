"""Token ids of texts by a public word-level BPE vocabulary (``tokenizers``), with repeated words looked up.

The vocabulary drops white space and never merges across it, so the ids of a
text are those of its white-space-free pieces, one after another.  Pieces seen
before come from a table of bounded size that lasts as long as a task (emptied when
it is full, and when the task ends: Spark keeps worker processes).  New pieces made of printable ASCII and Latin-1 letters only are lower-cased, cut by
the vocabulary's own pattern and merged directly; for these, normalisation does
nothing else.  All other pieces go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# Many pieces, each on a line.
_SIMPLE_LINES = re.compile("[!-~À-ÖØ-öø-ÿ\n]*")
# Fixed value: the pattern by which this vocabulary cuts a piece, for the characters of _SIMPLE and line by line.
_CUT_LINES = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+")
_TABLE_BYTES = 64 << 20
_PART_BYTES = 200         # of Python objects for a part, besides its letters and ids


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level BPE writes for each byte (public rule)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class TokenTable:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs the tasks side by side
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {"\n": 0}                 # row 0: no ids
        self.ids = np.zeros(0, dtype=np.uint16)
        self.ends = np.zeros(2, dtype=np.int64)
        self.held = 0                                       # bytes, about

    def _rows(self, parts: list[str], ids_of: Callable[[str], list[int]]) -> np.ndarray:
        """The table rows of ``parts``, with new ones added."""
        rows = np.array([self.at.get(p, -1) for p in parts], dtype=np.int64)
        missing = np.flatnonzero(rows < 0).tolist()
        if missing:
            new = list(dict.fromkeys(parts[i] for i in missing))
            ids = [ids_of(p) for p in new]
            base = len(self.ends) - 1
            self.at.update(zip(new, range(base, base + len(new)), strict=True))
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(x) for x in ids])])
            self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], dtype=np.uint16)])
            self.held += sum(map(len, new)) + _PART_BYTES * len(new) + 2 * int(self.ends[-1] - self.ends[base])
            rows[missing] = [self.at[parts[i]] for i in missing]
        return rows

    def _merged(self, part: str) -> list[int]:
        text = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(text)]

    def _whole(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _pieces(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces (one on a line), one after another, and how many each has."""
        if self.held > _TABLE_BYTES:
            self.clear()
        if _SIMPLE_LINES.fullmatch(joined) and "<|" not in joined:
            rows = self._rows(_CUT_LINES.findall(joined.lower() + "\n"), self._merged)
            last = np.flatnonzero(rows == 0)
        else:
            pieces = joined.split("\n")
            simple = np.array([bool(_SIMPLE.fullmatch(p)) and "<|" not in p for p in pieces])
            of = {True: [p for p, x in zip(pieces, simple, strict=True) if x], False: [p for p, x in zip(pieces, simple, strict=True) if not x]}
            parts = self._rows(_CUT_LINES.findall("".join(f"{p}\n" for p in of[True]).lower()), self._merged)
            whole = self._rows(of[False], self._whole)
            cuts = np.flatnonzero(parts == 0)                  # behind each simple piece
            at = np.zeros(len(pieces), dtype=np.int64)         # where a piece's rows end among the simple ones
            at[simple] = cuts + 1
            at = np.maximum.accumulate(at)
            rows = np.insert(parts, np.repeat(at[~simple], 2), np.column_stack([whole, np.zeros(len(whole), np.int64)]).ravel())
            last = np.flatnonzero(rows == 0)
        begin, length = self.ends[rows], self.ends[rows + 1] - self.ends[rows]
        upto = np.cumsum(length)
        ids = self.ids[np.repeat(begin - upto + length, length) + np.arange(int(length.sum()))]
        return ids, np.diff(upto[last], prepend=0)

    def encode(self, texts: pa.Array, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), each followed by ``last``, and how many each text has."""
        parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        per_text = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        words = parts.flatten().dictionary_encode()
        n = len(words.dictionary)
        ids, counts = np.zeros(0, np.uint16), np.zeros(0, np.int64)
        if n:
            ids, counts = self._pieces(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), words.dictionary), "\n")[0].as_py())
        # the end of a text is a piece of its own, with the one id ``last``
        ends = np.cumsum(per_text)
        rows = np.insert(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), ends, n)
        ids, counts = np.append(ids, np.uint16(last)), np.append(counts, 1)
        begin, length = (np.cumsum(counts) - counts)[rows], counts[rows]
        upto = np.cumsum(length)
        out = ids[np.repeat(begin - upto + length, length) + np.arange(int(length.sum()))]
        return out, np.diff(upto[ends + np.arange(len(ends))], prepend=0)


@lru_cache(maxsize=1)
def _table(path: str) -> TokenTable:
    """The table of this worker process."""
    return TokenTable(path)


@contextmanager
def token_table(path: str) -> Iterator[TokenTable]:
    """The table of this worker process, for one task: it is empty afterwards and Arrow's free memory is given back."""
    table = _table(path)
    try:
        yield table
    finally:
        table.clear()
        pa.default_memory_pool().release_unused()


def vocabulary_size(path: str) -> int:
    """Ids that the vocabulary can give, special ones included."""
    return _table(path).tokenizer.get_vocab_size(with_added_tokens=True)
