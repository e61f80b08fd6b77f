"""Token ids of many texts: split at spaces and newlines, encode each different piece once, gather.

Words repeat, so a worker keeps the ids of the pieces it has met (up to MEMO_PIECES; then those
met only once go, which costs time only) and assembles documents with array operations. The
splits are places that no pre-token of the vocabulary crosses, so the ids equal those of the
whole text; texts whose white space would break that rule are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_PIECES = 350_000
_FIRST = itemgetter(0)

#: White space that is special to a pattern with look-ahead: a space after white space, and
#: characters that some libraries count as white space and others do not.
_UNSAFE = (
    r"[ \t\n\r] |[\x00-\x08\x0b-\x1f\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
)


def ragged(storage: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of storage[starts[i] : starts[i] + lengths[i]]."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return storage[:0]
    return storage[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in order, and the number of ids of each row."""
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    return (np.concatenate(rows) if len(rows) else np.empty(0, np.uint32)), counts


def merged(chosen: np.ndarray, one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and their numbers of all rows, in order: the next row of ``one`` where ``chosen``, of ``other`` elsewhere."""
    counts = np.empty(len(chosen), np.int64)
    counts[chosen], counts[~chosen] = one[1], other[1]
    of = np.repeat(chosen, counts)
    ids = np.empty(len(of), np.uint32)
    ids[of], ids[~of] = one[0], other[0]
    return ids, counts


class Pieces:
    """Texts to ids. ``encode`` maps a list of strings to all their ids and the number of each one's.

    ``at_newlines``: no pre-token crosses from a character that is no white space to a newline; where
    white space is dropped (not ``keeps_space``), a newline is the same as a space.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], keeps_space: bool, at_newlines: bool = False,
                 vocabulary: int | None = None):
        self.encode, self.keeps_space, self.at_newlines, self.vocabulary = encode, keeps_space, at_newlines, vocabulary
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.again = np.zeros(MEMO_PIECES + 1, bool)  # met more than once

    def _keep_repeated(self) -> None:
        kept = [(k, s) for k, s in self.slot.items() if self.again[s]]
        old = np.fromiter((s for _, s in kept), np.int64, len(kept))
        ids, start = self.ids, self.start
        self._forget()
        lengths = start[old + 1] - start[old]
        self.ids = np.append(ragged(ids, start[old], lengths), np.empty(1 << 16, np.uint32))
        self.start = np.concatenate([[0], np.cumsum(lengths), np.zeros(1 << 14, np.int64)])
        self.used = int(lengths.sum())
        self.slot = {k: i for i, (k, _) in enumerate(kept)}

    def _add(self, keys: list[str]) -> None:
        for at in range(0, len(keys), 50_000):
            part = keys[at : at + 50_000]
            ids, lengths = self.encode(part)
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            n = len(self.slot)
            while n + len(part) + 1 > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.start[n + 1 : n + 1 + len(part)] = self.used + np.cumsum(lengths)
            self.used += len(ids)
            self.slot.update(zip(part, range(n, n + len(part)), strict=True))

    def _slots(self, keys: list[str]) -> np.ndarray:
        """The memo slot of each of these different keys."""
        slots = self._known(keys)
        missing = np.flatnonzero(slots < 0)
        if len(self.slot) + len(missing) > MEMO_PIECES:
            self._keep_repeated()
            if len(self.slot) + len(keys) > MEMO_PIECES:
                self._forget()
            slots = self._known(keys)
            missing = np.flatnonzero(slots < 0)
        before = len(self.slot)
        if before + len(missing) > len(self.again):  # one slice with more than the memo holds
            self.again = np.zeros(before + len(missing), bool)
        self.again[slots[slots >= 0]] = True
        if len(missing):
            self._add([keys[i] for i in missing.tolist()])
            slots[missing] = before + np.arange(len(missing))
        return slots

    def _known(self, keys: list[str]) -> np.ndarray:
        """The memo slots of the keys; -1 where there is none."""
        return np.fromiter(map(self.slot.get, keys, repeat(-1)), np.int64, len(keys))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order (uint32), and the number of ids of each text."""
        texts = texts.cast(pa.large_string())
        if not self.keeps_space:
            return self._split(texts)
        whole = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._split(texts)
        safe_ids, safe_n = self._split(texts.filter(pa.array(~whole)))
        return merged(whole, self.encode(texts.filter(pa.array(whole)).to_pylist()), (safe_ids, safe_n))

    def _cut(self, texts: pa.LargeStringArray) -> pa.LargeListArray:
        """The pieces of each text; where white space counts, a piece keeps that before it."""
        if not self.keeps_space:
            return pc.split_pattern(pc.replace_substring(texts, "\n", " ") if self.at_newlines else texts, " ")
        if self.at_newlines:
            # A zero marks a cut: texts with one are encoded whole. No cut inside white space.
            inside = pc.match_substring_regex(texts, r"[ \t\n]\n")
            marked = pc.replace_substring(texts, "\n", "\0\n")
            if pc.any(inside).as_py():
                rare = pc.replace_substring_regex(pc.if_else(inside, texts, ""), r"([^ \t\n])\n", "\\1\0\n")
                marked = pc.if_else(inside, rare, marked)
            texts = marked
        return pc.split_pattern(pc.replace_substring(texts, " ", "\0 "), "\0")

    def _split(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        lists = self._cut(texts)
        offsets = lists.offsets.to_numpy()
        pieces = lists.flatten().dictionary_encode()
        index = pieces.indices.to_numpy()
        keys = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = self._slots(keys)[index]
        starts = self.start[slots]
        lengths = self.start[slots + 1] - starts
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets - offsets[0]]
        return ragged(self.ids, starts, lengths), np.diff(ends)


_cached: dict[tuple, Pieces] = {}


def library_pieces(path: str, keeps_space: bool, special_as_text: bool = True) -> Pieces:
    """Pieces encoded by the tokenizers library; one set for each Python worker and file.

    Missing pieces are encoded together as one text, cut where a token begins with a piece's white
    space or else by the ids' offsets; pieces with white space inside, or strings of special tokens, are encoded one by one.
    """
    key = (path, keeps_space, special_as_text)
    if key in _cached:
        return _cached[key]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = special_as_text
    special = [t.content for t in library.get_added_tokens_decoder().values()]
    lead = "[ \n]" if keeps_space else ""
    plain_piece = rf"^{lead}(?:[!-~]{'+' if keeps_space else '{2,}'}|[.,]+\pL+[.,]*|\pL+[.,]+|\pL{'+' if keeps_space else '{2,}'})$"

    # Where a plain piece has its only space or newline in front, so has its first token, and no other.
    vocabulary = library.get_vocab()
    begins = np.zeros(max(vocabulary.values()) + 1, bool)
    begins[[i for token, i in vocabulary.items() if token[:1] in ("Ġ", "Ċ")]] = True

    def alone(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return flat([np.array(x.ids, np.uint32) for x in library.encode_batch_fast(keys, add_special_tokens=False)])

    def by_offsets(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = library.encode(("" if keeps_space else " ").join(keys), add_special_tokens=False)
        lengths = np.fromiter(map(len, keys), np.int64, len(keys)) + (not keeps_space)
        at = np.fromiter(map(_FIRST, found.offsets), np.int64, len(found))
        ends = np.searchsorted(at, np.cumsum(lengths))
        return np.array(found.ids, np.uint32), np.diff(ends, prepend=0)

    def joined(keys: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        groups = [keys[at : at + 256] for at in range(0, len(keys), 256)]
        if not keeps_space:
            return [by_offsets(group) for group in groups]
        parts = []
        for group, found in zip(groups, library.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, np.uint32)
            first = np.flatnonzero(begins[ids])
            parts.append((ids, np.diff(first, append=len(ids))) if len(first) == len(group) else by_offsets(group))
        return parts

    def encode(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        column = pa.array(keys, pa.large_string())
        plain = pc.match_substring_regex(column, plain_piece)
        for content in special:
            plain = pc.and_not(plain, pc.match_substring(column, content))
        told = plain.to_numpy(zero_copy_only=False)
        parts = joined(list(compress(keys, told.tolist())))
        ids = np.concatenate([np.empty(0, np.uint32), *(p[0] for p in parts)])
        counts = np.concatenate([np.empty(0, np.int64), *(p[1] for p in parts)])
        return merged(told, (ids, counts), alone(list(compress(keys, (~told).tolist()))))

    _cached[key] = Pieces(encode, keeps_space, at_newlines=True, vocabulary=library.get_vocab_size())
    return _cached[key]
