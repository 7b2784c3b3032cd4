"""Texts cut where tokenizers cut them anyway, so that a part seen before is looked up, not encoded again."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A worker forgets parts when those it knows take more bytes.
KNOWN_BYTES = 64_000_000

_CUT = re.compile(r" (?=\S)(?<=\S )")
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\pZ]"
_EDGES = f"^ | $|{_SPACE} | {_SPACE}"


def cut(text: str) -> list[str]:
    """The parts of a text: cut at every space between two characters that are not white space; the space goes.

    Byte-level pieces and sentence pieces begin at such a space whatever stands on either side, so the ids of
    a text are those of its first part and of a space and the part for all later ones.
    """
    return _CUT.split(text)


def cut_all(texts: pa.Array) -> pa.ListArray:
    """The parts of each text. Where no space stands at an edge or beside other white space, every space is a cut."""
    odd = pc.match_substring_regex(texts, _EDGES)
    if not pc.any(odd).as_py():
        return pc.split_pattern(texts, " ")
    plain = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    cut_odd = pa.array([cut(t.as_py()) for t in texts.filter(odd)], plain.type)
    number = np.cumsum(odd.to_numpy(zero_copy_only=False))
    place = np.where(odd.to_numpy(zero_copy_only=False), len(plain) + number - 1, np.arange(len(texts)) - number)
    return pa.concat_arrays([plain, cut_odd]).take(pa.array(place))


def groups(texts: pa.Array, size: int) -> Iterator[pa.StringArray]:
    """The texts, NULL as empty, in slices of up to ``size`` bytes, one text at least."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield texts.slice(first, last - first).cast(pa.string())
        first = last


class Parts:
    """What is known of up to ``most`` parts, in Arrow arrays: the parts, and columns of what ``encode`` made of them.

    ``encode`` takes new parts and gives a row for each in some columns. When there are too many, those stay that the
    texts at hand have, so frequent parts are not forgotten.
    """

    def __init__(self, encode: Callable[[list[str]], list[pa.Array]], most: int):
        self.encode, self.most = encode, most
        self.words, self.columns = pa.array([], pa.string()), []

    def look_up(self, parts: pa.StringArray) -> tuple[np.ndarray, list[pa.Array]]:
        """For each part its row, and the columns."""
        coded = parts.dictionary_encode()
        found = pc.index_in(coded.dictionary, self.words)
        unknown = found.is_null()
        row = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = coded.dictionary.filter(unknown)
        if len(self.words) + len(new) > self.most or self.words.nbytes > KNOWN_BYTES:
            kept = found.drop_null()
            self.words, self.columns = self.words.take(kept), [c.take(kept) for c in self.columns]
            row[row >= 0] = np.arange(len(kept))
        if len(new) or not self.columns:
            row[row < 0] = np.arange(len(self.words), len(self.words) + len(new))
            made = self.encode(new.to_pylist())
            self.words = pa.concat_arrays([self.words, new])
            self.columns = [pa.concat_arrays([c, m]) for c, m in zip(self.columns, made)] if self.columns else made
        return row[coded.indices.to_numpy()], self.columns


def gathered(rows: np.ndarray, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The lists' values one after another in the order of ``rows``, and where each ends."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    begins = (offsets[:-1] - offsets[0])[rows]
    taken = np.diff(offsets)[rows]
    ends = np.cumsum(taken)
    places = np.repeat(begins - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)
    return lists.flatten().to_numpy()[places], ends
