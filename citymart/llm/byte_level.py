"""Token ids by a byte-level tokenizer, looked up part by part."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from citymart.llm.parts import Parts, cut_all, gathered, groups

#: How a byte-level vocabulary spells a space, and how many new parts are encoded as one text.
SPACE, JOINED_PARTS = "\u0120", 20_000
#: Texts are cut and looked up together up to so many bytes.
GROUP_BYTES = 16_000_000
#: A worker knows so many parts at most; one takes about 40 bytes.
KNOWN_PARTS = 3_000_000


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.zeros(0, np.uint32)])))


class ByteLevel:
    """Ids by a byte-level tokenizer, part by part."""

    def __init__(self, tokenizer_file: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.known = Parts(lambda parts: [self.later_parts(parts)], KNOWN_PARTS)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, np.uint32) for f in found]

    def later_parts(self, parts: list[str]) -> pa.ListArray:
        """The ids of a space and each part. Parts without spaces go in as one text: each begins at the one id that
        spells its space."""
        joined = [p for p in parts if " " not in p]
        lists = [self._joined(joined[k : k + JOINED_PARTS]) for k in range(0, len(joined), JOINED_PARTS)]
        if len(joined) == len(parts):
            return pa.concat_arrays(lists) if lists else _lists([])
        other = [p for p in parts if " " in p]
        lists.append(_lists(self.whole([f" {p}" for p in other])))
        odd = np.array([" " in p for p in parts])
        place = np.where(odd, len(joined) + np.cumsum(odd) - 1, np.cumsum(~odd) - 1)
        return pa.concat_arrays(lists).take(pa.array(place))

    def _joined(self, parts: list[str]) -> pa.ListArray:
        [ids] = self.whole(["".join([f" {p}" for p in parts])])
        begins = np.flatnonzero(self.spaced[ids])
        if len(begins) == len(parts):
            return pa.ListArray.from_arrays(pa.array(np.append(begins, len(ids)), pa.int32()), pa.array(ids))
        return _lists(self.whole([f" {p}" for p in parts]))

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; NULL counts as empty. A text with the string of an added token is encoded whole,
        since such a token cuts the white space beside it too."""
        for group in groups(texts, GROUP_BYTES):
            special = np.zeros(len(group), bool)
            for string in self.added:
                special |= pc.match_substring(group, string).to_numpy(zero_copy_only=False)
            parts = cut_all(pc.if_else(pa.array(special), "", group))
            offsets = parts.offsets.to_numpy().astype(np.int64)
            values = parts.flatten()
            later = np.ones(len(values), bool)
            later[offsets[:-1] - offsets[0]] = False
            begins = values.filter(pa.array(~later)).to_pylist()
            for row in np.flatnonzero(special).tolist():
                begins[row] = group[row].as_py()
            begins = self.whole(begins)
            rows, [ids] = self.known.look_up(values.filter(pa.array(later)))
            found, ends = gathered(rows, ids)
            ends = np.append(0, ends)[offsets - offsets[0] - np.arange(len(offsets))]
            for begin, first, last in zip(begins, ends[:-1].tolist(), ends[1:].tolist()):
                yield np.concatenate([begin, found[first:last]])


@cache
def byte_level(tokenizer_file: str) -> ByteLevel:
    """One per Python worker, kept between tasks."""
    return ByteLevel(tokenizer_file)
