"""The character map of a SentencePiece model, compiled from the double-array trie it comes as.

The map rewrites the longest known sequence of characters at each place; characters without an
entry stay. Spaces are then squeezed and stripped where the model asks for it.
"""

from __future__ import annotations

import re
from typing import Any

import numpy as np

_SPACE = "▁"


def entries(blob: bytes) -> dict[str, str]:
    """Every sequence of the map with what it becomes.

    The blob holds the trie's size, the trie as 32-bit units, and the results, each ended by a
    zero byte. Of a unit, bits 0-7 are a label and bit 31 must be clear for it, bit 8 says that a
    result follows, and bits 10-30 are an offset, in steps of 256 if bit 9 is set.
    """
    size = int.from_bytes(blob[:4], "little")
    units, results = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64), blob[4 + size :]

    def base(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << np.where(unit & (1 << 9), 8, 0)

    out: dict[str, str] = {}
    label = np.arange(1, 256)
    at, names = base(units[:1]), [b""]
    while len(at):
        spots = at[:, None] ^ label
        found = np.where(spots < len(units), units[np.minimum(spots, len(units) - 1)], -1)
        row, col = np.nonzero((found & ((1 << 31) | 0xFF)) == label)
        unit = found[row, col]
        at = spots[row, col] ^ base(unit)
        names = [names[r] + bytes([c]) for r, c in zip(row.tolist(), label[col].tolist())]
        for i in np.flatnonzero(unit >> 8 & 1).tolist():
            begin = int(units[at[i]] & 0x7FFFFFFF)
            out[names[i].decode()] = results[begin : results.index(b"\0", begin)].decode()
    return out


class Normaliser:
    """What a model's normaliser makes of a text, with spaces still spaces."""

    def __init__(self, spec: Any) -> None:
        if not spec.escape_whitespaces:
            raise ValueError("only normalisers that escape white space are compiled")
        known = entries(spec.precompiled_charsmap) if spec.precompiled_charsmap else {}
        self.squeezes = spec.remove_extra_whitespaces
        self.single = {ord(k): v for k, v in known.items() if len(k) == 1 and k != v}
        self.many = {k: v for k, v in known.items() if len(k) > 1}
        self.longest = max(map(len, self.many), default=1)
        follow = sorted({k[1] for k in self.many})
        self.joins = re.compile("[" + "".join(map(re.escape, follow)) + "]") if follow else None

    @property
    def identity(self) -> bool:
        return not (self.squeezes or self.single or self.many)

    def __call__(self, text: str) -> str:
        if self.joins is not None and self.joins.search(text):
            text = self._longest(text)
        elif self.single:
            text = text.translate(self.single)
        if self.squeezes:  # trailing marks go like spaces, leading ones stay
            text = re.sub(" +", " ", text).lstrip(" ").rstrip(" " + _SPACE)
        return text

    def _longest(self, text: str) -> str:
        out, i = [], 0
        while i < len(text):
            for n in range(min(self.longest, len(text) - i), 1, -1):
                made = self.many.get(text[i : i + n])
                if made is not None:
                    break
            else:
                n, made = 1, self.single.get(ord(text[i]), text[i])
            out.append(made)
            i += n
        return "".join(out)
