"""Byte-level BPE with a rank queue: a hierarchical bitmap over merge ranks.

Every merge rank that can be applied now has a bucket, a heap of positions in the linked list
of parts. A bitmap of two levels says which buckets have entries: finding the next rank is
two find-first-set operations. Entries whose pair has changed since are skipped when met. A
pre-token of n bytes takes O(n log n) however long it is.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush
from itertools import islice, pairwise

import numpy as np

#: Pre-tokens whose ids a worker remembers; then the older half goes, which costs time only.
MEMO_TOKENS = 300_000
_MEMO_LENGTH = 64


class RankQueue:
    """Positions by rank; lowest rank first, then lowest position.

    It is empty between pre-tokens, so that one queue serves them all.
    """

    def __init__(self, ranks: int = 1 << 16):
        self.bucket: list[list[int]] = [[] for _ in range(ranks)]
        self.low = [0] * (ranks // 256 + 1)
        self.top = 0

    def push(self, rank: int, position: int) -> None:
        held = self.bucket[rank]
        if held:
            heappush(held, position)
            return
        held.append(position)
        block = rank >> 8
        self.low[block] |= 1 << (rank & 255)
        self.top |= 1 << block

    def pop(self) -> tuple[int, int] | None:
        top = self.top
        if not top:
            return None
        block = (top & -top).bit_length() - 1
        bits = self.low[block]
        rank = block << 8 | (bits & -bits).bit_length() - 1
        held = self.bucket[rank]
        position = heappop(held)
        if not held:
            self.low[block] = bits = bits & bits - 1
            if not bits:
                self.top = top & top - 1
        return rank, position


def merge(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """The ids of one pre-token: the lowest rank first, of equal ranks the first position."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    get = ranks.get
    # The queue's own steps, written out: they run several times for each byte, calls would cost as much again.
    bucket, low, top = queue.bucket, queue.low, queue.top
    end = list(range(1, n + 1))  # where the part that begins here ends
    before = list(range(-1, n - 1))  # where the part before it begins
    rank_at: list[int | None] = [get(piece[i : i + 2]) for i in range(n - 1)]  # rank of this part joined with the next
    rank_at.append(None)
    for i, rank in enumerate(rank_at):
        if rank is not None:
            held = bucket[rank]
            if not held:
                low[rank >> 8] |= 1 << (rank & 255)
                top |= 1 << (rank >> 8)
            held.append(i)  # they come in order, which is a heap
    while top:
        block = (top & -top).bit_length() - 1
        bits = low[block]
        bit = bits & -bits
        rank = block << 8 | bit.bit_length() - 1
        held = bucket[rank]
        if len(held) > 1:
            i = heappop(held)
        else:
            i = held.pop()
            low[block] = bits = bits ^ bit
            if not bits:
                top &= top - 1
        if rank_at[i] != rank:  # stale
            continue
        j = end[i]
        end[i] = k = end[j]
        rank_at[j] = None
        if k < n:
            before[k] = i
            rank_at[i] = rank = get(piece[i : end[k]])
            if rank is not None:
                held = bucket[rank]
                if held:
                    heappush(held, i)
                else:
                    held.append(i)
                    low[rank >> 8] |= 1 << (rank & 255)
                    top |= 1 << (rank >> 8)
        else:
            rank_at[i] = None
        if i:
            h = before[i]
            rank_at[h] = rank = get(piece[h:k])
            if rank is not None:
                held = bucket[rank]
                if held:
                    heappush(held, h)
                else:
                    held.append(h)
                    low[rank >> 8] |= 1 << (rank & 255)
                    top |= 1 << (rank >> 8)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class ByteBpe:
    """A rank file with its pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file)}
        self.find = regex.compile(pattern).findall
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.memo: dict[str, list[int]] = {}
        words = {rank: word for word, rank in self.ranks.items()}
        sizes = np.zeros(max(words) + 2, np.int64)
        for rank, word in words.items():
            sizes[rank + 1] = len(word)
        self.ends = np.cumsum(sizes)
        self.bytes = np.frombuffer(b"".join(words[r] for r in sorted(words)), np.uint8)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        memo = self.memo
        for token in self.find(text):
            found = memo.get(token)
            if found is None:
                found = merge(token.encode(), self.ranks, self.queue)
                if len(token) <= _MEMO_LENGTH:
                    if len(memo) >= MEMO_TOKENS:
                        for old in list(islice(memo, MEMO_TOKENS // 2)):
                            del memo[old]
                    memo[token] = found
            ids += found
        return ids

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        ids: list[int] = []
        cuts = [0]
        for text in texts:
            ids += self.encode(text)
            cuts.append(len(ids))
        every = np.array(ids, np.uint32)
        return [every[a:b] for a, b in pairwise(cuts)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids, and the number of bytes of each id."""
        from avspark.llm.pieces import ragged

        starts = self.ends[ids]
        sizes = self.ends[ids.astype(np.int64) + 1] - starts
        return ragged(self.bytes, starts, sizes), sizes
