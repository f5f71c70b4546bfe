"""Distinct pieces of text with what they were turned into, as arrays."""

from __future__ import annotations

import numpy as np

from marlstone.llm.batches import word_hashes


class Ragged:
    """Rows of differing length in one array; row i is flat[at[i] : at[i + 1]]."""

    def __init__(self, flat: np.ndarray, at: np.ndarray) -> None:
        self.flat, self.at = flat, at

    def __len__(self) -> int:
        return len(self.at) - 1

    def take(self, rows: np.ndarray) -> Ragged:
        size = self.at[rows + 1] - self.at[rows]
        upto = np.concatenate([[0], np.cumsum(size)])
        return Ragged(self.flat[np.repeat(self.at[rows] - upto[:-1], size) + np.arange(int(upto[-1]))], upto)

    def equal(self, rows: np.ndarray, other: Ragged, theirs: np.ndarray) -> np.ndarray:
        """Whether each of ``rows`` is the row of ``other`` it is put beside."""
        size = self.at[rows + 1] - self.at[rows]
        out = size == other.at[theirs + 1] - other.at[theirs]
        check = np.flatnonzero(out & (size > 0) & ((rows != theirs) | (other is not self)))
        if len(check):
            n = size[check]
            heads = np.cumsum(n) - n
            inner = np.arange(int(n.sum())) - np.repeat(heads, n)
            differs = self.flat[inner + np.repeat(self.at[rows[check]], n)] != other.flat[inner + np.repeat(other.at[theirs[check]], n)]
            out[check] = ~np.logical_or.reduceat(differs, heads)
        return out


class Memo:
    """Chunks with their ids, sorted by hash; new ones wait until they are worth a merge."""

    def __init__(self, kind: np.dtype, most: int) -> None:
        self.most = most
        self.hashes = np.zeros(0, np.uint64)
        self.chunks, self.ids = Ragged(np.zeros(0, np.uint8), np.zeros(1, np.int64)), Ragged(np.zeros(0, kind), np.zeros(1, np.int64))
        self.waiting: list[tuple[np.ndarray, Ragged, Ragged]] = []
        self.n_waiting = 0

    def find(self, hashes: np.ndarray, texts: Ragged, rows: np.ndarray) -> np.ndarray:
        """The place of each chunk, or -1; bytes are compared, not hashes alone."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        out = np.full(len(hashes), -1)
        out[hit] = np.where(texts.equal(rows[hit], self.chunks, at[hit]), at[hit], -1)
        return out

    def add(self, hashes: np.ndarray, chunks: Ragged, ids: Ragged) -> None:
        if len(self.hashes) >= self.most or not len(hashes):
            return
        self.waiting.append((hashes, chunks, ids))
        self.n_waiting += len(hashes)
        if self.n_waiting * 4 < len(self.hashes):
            return
        parts = [(self.hashes, self.chunks, self.ids), *self.waiting]
        hashes, first = np.unique(np.concatenate([p[0] for p in parts]), return_index=True)
        chunks, ids = (Ragged(np.concatenate([p[k].flat for p in parts]), np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[k].at) for p in parts]))])) for k in (1, 2))
        self.hashes, self.chunks, self.ids = hashes, chunks.take(first), ids.take(first)
        self.waiting, self.n_waiting = [], 0

    def with_rows(self, made: Ragged, known: np.ndarray, new: np.ndarray) -> Ragged:
        """What is remembered with ``made`` after it; the places ``new`` of ``known`` are set to the latter."""
        known[new] = len(self.ids) + np.arange(len(new))
        return Ragged(np.concatenate([self.ids.flat, made.flat]), np.concatenate([self.ids.at, self.ids.at[-1] + made.at[1:]]))


def distinct(rows: Ragged) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and first occurrence of each distinct row, and which one every row is; rows whose hashes collide are kept apart."""
    hashes, first, which = np.unique(word_hashes(rows.flat, rows.at[:-1], rows.at[1:]), return_index=True, return_inverse=True)
    odd = np.flatnonzero(~rows.equal(np.arange(len(rows)), rows, first[which]))
    if len(odd):
        hashes, first = np.concatenate([hashes, hashes[which[odd]]]), np.concatenate([first, odd])
        which[odd] = len(first) - len(odd) + np.arange(len(odd))
    return hashes, first, which
