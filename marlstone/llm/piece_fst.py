"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled to one transducer, the composition of

* N, the normaliser: the model's character map (the longest sequence at each place is
  rewritten), spaces squeezed if the model asks for it, then U+2581 for spaces, and one more in
  front of the text;
* L, the lexicon: an arc for every piece, from its characters to its id, and for a character
  without a piece an arc to its UTF-8 bytes' ids (byte fallback), or to the unknown piece;
* B, an acceptor over pairs of successive ids.

Composed with an input, this is a lattice over the input's positions, and the encoding is its
shortest path in the tropical semiring (min, +). For a unigram model an arc of L weighs the
piece's negated score and B is free. For a BPE model B weighs 0 where merging would leave the
two pieces side by side and infinity where it would not, as decided by the pieces' own last
merges. Exactly one path of finite weight is left then, and it is what merging gives, so ids
equal those of the sentencepiece library. As every prefix has one such path too, a state needs
only its position and the last id.

The lattice is solved for many words at once: position by position, all arcs that end there
are looked up by hash and relaxed as arrays. The characters along a path are then compared with the
input; a word that a hash led astray is solved again by the pieces' texts. Texts are cut where no
piece can reach across, and a worker remembers the ids of words.

Runs of spaces: pieces of several U+2581 share one score, so ties are broken from the left, as
merging does; weights on pairs can't say that. A run is an arc of its own, whose ids are found
once for each length.

Cases: a null text has null ids and null decoding; an empty text has no ids. Repeated rows each
get their ids. Texts and words of any length are encoded whole. Control pieces never arise from
text. Of equally good paths the one whose last piece is shortest wins. Decoding gives the normalised text.
An empty table gives no rows. Columns named like a result column are replaced.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable
from itertools import groupby
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marlstone.llm.batches import as_utf8, map_texts, powers, raw
from marlstone.llm.charsmap import Normaliser
from marlstone.llm.chunks import Memo, Ragged, distinct

#: Words whose ids a worker remembers, words solved at once, and their characters with padding.
MEMO, TOGETHER, CELLS = 200_000, 16_384, 1 << 18
_SPACE = "▁"
_MARK = _SPACE.encode()
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NONE = -1
_BEYOND = -(1 << 31)

RESULT = [T.StructField("n_ids", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]


class _Table:
    """uint64 keys to int32 values by open addressing; a missing key gives _NONE."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        bits = max(8, int(len(keys) * 4 - 1).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, _NONE, np.int32)
        self.longest = 1
        left, at = np.arange(len(keys)), (keys * _BASE >> np.uint64(64 - bits)).astype(np.int64)
        self.shift = np.uint64(64 - bits)
        while len(left):
            free = self.values[at] == _NONE
            slot, who = np.unique(np.where(free, at, -1), return_index=True)
            who = who[slot >= 0]
            self.keys[at[who]] = keys[left[who]]
            self.values[at[who]] = values[left[who]]
            rest = np.ones(len(left), bool)
            rest[who] = False
            left, at = left[rest], (at[rest] + 1) & int(self.mask)
            self.longest += bool(len(left))

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = (keys * _BASE >> self.shift).astype(np.int64)
        out = np.where(self.keys[at] == keys, self.values[at], _NONE)
        open_ = np.flatnonzero((out == _NONE) & (self.values[at] != _NONE))
        where = at[open_]
        while len(open_):
            where = (where + 1) & int(self.mask)
            hit = (self.keys[where] == keys[open_]) & (self.values[where] != _NONE)
            out[open_[hit]] = self.values[where[hit]]
            go = ~hit & (self.values[where] != _NONE)
            open_, where = open_[go], where[go]
        return out


def _proto(path: str) -> Any:
    from sentencepiece import sentencepiece_model_pb2 as model

    out = model.ModelProto()
    with open(path, "rb") as f:
        out.ParseFromString(f.read())
    return out


class Transducer:
    """A compiled model: ``encode`` and ``decode`` for lists of texts."""

    def __init__(self, path: str) -> None:
        proto = _proto(path)
        spec = proto.normalizer_spec
        if proto.trainer_spec.treat_whitespace_as_suffix or proto.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models with white space in front of words are compiled")
        self.normal = Normaliser(spec)
        self.bpe = proto.trainer_spec.model_type == 2
        self.prefix = spec.add_dummy_prefix
        self.names = [p.piece for p in proto.pieces]
        self.scores = np.array([p.score for p in proto.pieces])
        kinds = [p.type for p in proto.pieces]  # 1 normal, 2 unknown, 3 control, 4 user defined, 6 byte
        self.unknown = kinds.index(2)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.names, kinds)) if k == 6}
        self.spelled = [bytes([int(p[3:5], 16)]) if k == 6 else p.replace(_SPACE, " ").encode() if k in (1, 4) else b"" for p, k in zip(self.names, kinds)]
        self.lexicon = {p: i for i, (p, k) in enumerate(zip(self.names, kinds)) if k in (1, 4)}
        spelled = [p if k in (1, 4) else "" for p, k in zip(self.names, kinds)]
        self.texts = Ragged(np.frombuffer("".join(spelled).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum([len(p) for p in spelled])]))
        self.longest = max(map(len, self.lexicon), default=1)
        inner = {c for p in self.lexicon for c in p}
        if self.bpe and not inner <= self.lexicon.keys():
            raise ValueError("a character of a piece is no piece itself")
        crosses = any(a != _SPACE and b == _SPACE for p in self.lexicon for a, b in zip(p, p[1:]))
        self.cuts_words, self.cuts_lines = not crosses, not crosses and "\n" not in inner
        self._compile()
        self.memo = Memo(np.dtype("<i4"), MEMO)
        self.runs: dict[int, list[int]] = {}

    # -- compilation -----------------------------------------------------------------

    def _compile(self) -> None:
        pieces = list(self.lexicon.items())
        self.pieces = _Table(_text_hashes([p for p, _ in pieces]), np.array([i for _, i in pieces], np.int32))
        if not self.bpe:
            return
        n = len(self.names)
        # rank: the order of merges, 0 first. Characters come before every merge and have none.
        self.rank = np.full(n + 1, -1, np.int64)
        merged = [(i, p) for p, i in pieces if len(p) > 1]
        for r, (i, _) in enumerate(sorted(merged, key=lambda x: (-self.scores[x[0]], x[0]))):
            self.rank[i] = r
        self.left, self.right = np.full(n + 1, _NONE, np.int32), np.full(n + 1, _NONE, np.int32)
        pairs: dict[tuple[int, int], int] = {}
        for i, p in merged:
            for k in range(1, len(p)):
                a, b = self.lexicon.get(p[:k]), self.lexicon.get(p[k:])
                if a is not None and b is not None:
                    pairs[a, b] = i
        key = np.array([(a << 32) | b for a, b in pairs], np.uint64)
        self.joined = _Table(key, np.array(list(pairs.values()), np.int32))
        self.reached = np.ones(n + 1, bool)
        self.reached[n] = False
        for i, p in merged:
            last = merge([self.lexicon[c] for c in p], pairs, self.scores, until=i)
            if last is None:
                self.reached[i] = False
            else:
                self.left[i], self.right[i] = last
        self.known = np.zeros(1 << 20, np.uint64)  # pairs that were decided, with the answer in the lowest bit
        self.pair_list = pairs

    def beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """B: whether merging leaves the pieces a and b side by side; remembered by pair."""
        key = ((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)) << np.uint64(1)
        slot = ((key * _BASE) >> np.uint64(44)).astype(np.int64)
        found = self.known[slot]
        fresh = (found | np.uint64(1)) != (key | np.uint64(1))
        out = (found & np.uint64(1)).astype(bool)
        if fresh.any():
            new, back = np.unique(key[fresh], return_inverse=True)
            answer = self._beside((new >> np.uint64(33)).astype(np.int64), ((new >> np.uint64(1)) & np.uint64(0xFFFFFFFF)).astype(np.int64))
            out[fresh] = answer[back]
            self.known[((new * _BASE) >> np.uint64(44)).astype(np.int64)] = new | answer.astype(np.uint64)
        return out

    def _beside(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the pieces' merges from the last; a merge across the border that would have come first parts them.

        Walking back, the piece whose merge is later is opened, on its side of the border. A
        pair across the border that merges before the merge just undone would have been taken.
        """
        ok = np.ones(len(a), bool)
        on = np.arange(len(a))
        x, y = a.copy(), b.copy()
        limit_rank = np.full(len(a), np.iinfo(np.int64).max)
        limit_left = np.zeros(len(a), bool)  # the undone merge lies left of the border: it wins a tie
        while len(on):
            joined = self.joined.get((x[on].astype(np.uint64) << np.uint64(32)) | y[on].astype(np.uint64))
            rank = np.where(joined == _NONE, np.iinfo(np.int64).max, self.rank[joined])
            lost = (joined != _NONE) & ((rank < limit_rank[on]) | ((rank == limit_rank[on]) & ~limit_left[on]))
            ok[on[lost]] = False
            on = on[~lost]
            rx, ry = self.rank[x[on]], self.rank[y[on]]
            on, rx, ry = on[(rx >= 0) | (ry >= 0)], rx[(rx >= 0) | (ry >= 0)], ry[(rx >= 0) | (ry >= 0)]
            # Of two merges the later one: the higher rank, or at equal rank the one on the right.
            take = rx > ry
            limit_rank[on] = np.where(take, rx, ry)
            limit_left[on] = take
            x[on[take]] = self.right[x[on[take]]]
            y[on[~take]] = self.left[y[on[~take]]]
        return ok

    # -- the lattice -----------------------------------------------------------------

    def solve(self, inputs: list[str]) -> Ragged:
        """The ids along the shortest paths of normalised inputs."""
        order = sorted(range(len(inputs)), key=lambda i: -len(inputs[i]))
        size = np.array([len(inputs[i]) for i in order], np.int64)
        if not len(size) or not size[0]:
            return Ragged(np.zeros(0, "<i4"), np.zeros(len(inputs) + 1, np.int64))
        longest = int(size[0])
        points = np.zeros((len(order), longest), np.uint64)
        flat = np.frombuffer("".join(inputs[i] for i in order).encode("utf-32-le"), np.uint32)
        inside = np.arange(longest)[None] < size[:, None]
        points[inside] = flat
        prefix = np.zeros((longest + 1, len(order)), np.uint64)
        for t in range(longest):
            prefix[t + 1] = prefix[t] * _BASE + points[:, t] + np.uint64(1)
        power = powers(self.longest + 1, int(_BASE))
        best = np.full((longest + 1, len(order)), np.inf)
        best[0] = 0
        last = np.full((longest + 1, len(order)), len(self.names), np.int32)
        span = np.ones((longest + 1, len(order)), np.int16)
        for end in range(1, longest + 1):
            live = int(np.searchsorted(-size, -end, side="right"))
            for length in range(1, min(self.longest, end) + 1):
                start = end - length
                if self.bpe:
                    open_ = np.flatnonzero(np.isinf(best[end, :live]))
                    if not len(open_):
                        break
                else:
                    open_ = np.arange(live)
                piece = self.pieces.get(prefix[end, open_] - prefix[start, open_] * power[length])
                hit = piece != _NONE
                open_, piece = open_[hit], piece[hit]
                if self.bpe:
                    before = last[start, open_]
                    fits = self.reached[piece] & np.isfinite(best[start, open_])
                    check = np.flatnonzero(fits & (before < len(self.names)))
                    fits[check] = self.beside(before[check], piece[check])
                    open_, piece = open_[fits], piece[fits]
                    cost = np.zeros(len(open_))
                else:
                    cost = best[start, open_] - self.scores[piece]
                    better = cost < best[end, open_]
                    open_, piece, cost = open_[better], piece[better], cost[better]
                best[end, open_], last[end, open_], span[end, open_] = cost, piece, length
            # A character without a piece: an arc to its bytes, and nothing merges with it.
            missing = np.flatnonzero(np.isinf(best[end, :live])) if self.bpe else np.flatnonzero(self.pieces.get(points[:live, end - 1] + np.uint64(1)) == _NONE)
            if len(missing):
                bare = missing[self.pieces.get(points[missing, end - 1] + np.uint64(1)) == _NONE]
                step = best[end - 1, bare] + (0 if self.bpe else 10 - float(self.scores.min()))
                bare, step = bare[step < best[end, bare]], step[step < best[end, bare]]
                best[end, bare], last[end, bare], span[end, bare] = step, len(self.names) + 1 + points[bare, end - 1].astype(np.int32), 1
        at, rows = size.copy(), np.arange(len(order))
        paths: list[np.ndarray] = []
        while (at > 0).any():
            paths.append(np.where(at > 0, last[at, rows], _BEYOND))
            at = np.where(at > 0, at - span[at, rows], 0)
        found = np.stack(paths[::-1], axis=1)
        back = np.empty(len(order), np.int64)
        back[order] = rows
        found = found[back]
        inside = found != _BEYOND
        arcs = Ragged(found[inside].astype(np.int64), np.concatenate([[0], np.cumsum(inside.sum(axis=1))]))
        astray = self._astray(arcs, inputs)
        out = self._outputs(arcs)
        if not len(astray):
            return out
        parts = [out.flat[a:b] for a, b in zip(out.at[:-1], out.at[1:])]
        for i in astray:
            parts[i] = np.array(self.solve_plainly(inputs[i]), "<i4")
        return Ragged(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])]))

    def _bare(self, arcs: Ragged) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the arcs of characters without a piece, those characters, and which is at each place."""
        at = np.flatnonzero(arcs.flat > len(self.names))
        return at, *np.unique(arcs.flat[at] - len(self.names) - 1, return_inverse=True)

    def _spread(self, arcs: Ragged, table: Ragged, more: list[list[int]], at: np.ndarray, which: np.ndarray) -> Ragged:
        """Each arc's row of ``table``, or of ``more`` for the arcs ``at``, for each input in a row."""
        row = arcs.flat.copy()
        row[at] = len(table) + which
        flat = np.concatenate([table.flat, np.array([x for m in more for x in m], table.flat.dtype)])
        made = Ragged(flat, np.concatenate([table.at, table.at[-1] + np.cumsum([len(m) for m in more], dtype=np.int64)])).take(row)
        return Ragged(made.flat, made.at[arcs.at])

    def _outputs(self, arcs: Ragged) -> Ragged:
        """The ids that arcs write: a piece's own, or a character's bytes."""
        at, chars, which = self._bare(arcs)
        if not len(at):
            return Ragged(arcs.flat.astype("<i4"), arcs.at)
        own = Ragged(np.arange(len(self.names), dtype="<i4"), np.arange(len(self.names) + 1))
        out = self._spread(arcs, own, [self._fallback(chr(c)) for c in chars.tolist()], at, which)
        return Ragged(out.flat.astype("<i4"), out.at)

    def _astray(self, arcs: Ragged, inputs: list[str]) -> np.ndarray:
        """Inputs that the characters along their paths don't spell: hashes are no proof."""
        at, chars, which = self._bare(arcs)
        read = self._spread(arcs, self.texts, [[c] for c in chars.tolist()], at, which)
        size = np.array([len(i) for i in inputs], np.int64)
        wanted = Ragged(np.frombuffer("".join(inputs).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(size)]))
        return np.flatnonzero(~read.equal(np.arange(len(inputs)), wanted, np.arange(len(inputs))))

    def solve_plainly(self, line: str) -> list[int]:
        """The ids of one normalised input by the pieces' texts, without hashes."""
        if self.bpe:
            out: list[int] = []
            for known, part in groupby(line, key=lambda c: c in self.lexicon):
                out += merge([self.lexicon[c] for c in part], self.pair_list, self.scores) if known else [x for c in part for x in self._fallback(c)]
            return out
        best: list[tuple[float, list[int]]] = [(0.0, [])]
        worst = 10 - float(self.scores.min())
        for end in range(1, len(line) + 1):
            ways = [(best[a][0] - float(self.scores[self.lexicon[line[a:end]]]), best[a][1] + [self.lexicon[line[a:end]]]) for a in range(max(0, end - self.longest), end) if line[a:end] in self.lexicon]
            if line[end - 1] not in self.lexicon:
                ways.append((best[end - 1][0] + worst, best[end - 1][1] + self._fallback(line[end - 1])))
            best.append(min(ways, key=lambda w: w[0]))
        return best[-1][1]

    def _fallback(self, c: str) -> list[int]:
        return [self.bytes[b] for b in c.encode("utf-8")] if self.bytes else [self.unknown]

    def _run(self, n: int) -> list[int]:
        """n times U+2581 by itself."""
        if n not in self.runs:
            if self.bpe:
                self.runs[n] = merge([self.lexicon[_SPACE]] * n, self.pair_list, self.scores)
            else:
                self.runs[n] = self.solve([_SPACE * n]).flat.tolist()
        return self.runs[n]

    def _words(self, chunks: list[str]) -> Ragged:
        """Ids of chunks: spaces, then other characters."""
        if not self.bpe:
            return self.solve([c.replace(" ", _SPACE) for c in chunks])
        spaces = [len(c) - len(c.lstrip(" ")) for c in chunks]
        found = self.solve([(_SPACE if s else "") + c[s:] if len(c) > s else "" for c, s in zip(chunks, spaces)])
        many = [i for i, (c, s) in enumerate(zip(chunks, spaces)) if s > 1 or len(c) == s]
        if not many:
            return found
        # Merges of spaces come last of all, so the last space belongs to the word where it merged with it.
        mark, rows = self.lexicon.get(_SPACE), [found.flat[a:b] for a, b in zip(found.at[:-1], found.at[1:])]
        for i in many:
            ids, s = rows[i].tolist(), spaces[i]
            ids = self._run(s) + ids[1:] if not ids or ids[0] == mark else self._run(s - 1) + ids
            rows[i] = np.array(ids, "<i4")
        return Ragged(np.concatenate(rows), np.concatenate([[0], np.cumsum([len(r) for r in rows])]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and where each text's begin (n + 1); null counts as empty."""
        if not self.normal.identity:
            texts = pa.array([self.normal(t or "") for t in texts.to_pylist()], pa.large_string())
        data, offsets = raw(texts)
        if _MARK in data.tobytes():
            data, offsets = raw(pc.replace_substring(as_utf8(texts), _SPACE, " "))
        if self.prefix:
            full = np.diff(offsets) > 0
            data = np.insert(data, offsets[:-1][full], 32)
            offsets = offsets + np.concatenate([[0], np.cumsum(full)])
        if not len(data):
            return np.zeros(0, "<i4"), np.zeros(len(offsets), np.int64)
        space, line = data == 32, (data == 10) & self.cuts_lines
        begins = np.zeros(len(data), bool)
        if self.cuts_words:
            begins[1:] = line[1:] | line[:-1] | (space[1:] & ~space[:-1])
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(begins)
        rows = Ragged(data, np.append(start, len(data)))
        hashes, first, which = distinct(rows)
        known = self.memo.find(hashes, rows, first)
        new = np.flatnonzero(known < 0)
        chunks = rows.take(first[new])
        made = self._chunks(chunks)
        out = self.memo.with_rows(made, known, new).take(known[which])
        self.memo.add(hashes[new], chunks, made)
        at = out.at[np.searchsorted(start, offsets)]
        return (out.flat, at) if self.bytes else self._one_unknown(out.flat, at)

    def _one_unknown(self, flat: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without byte pieces, unknown characters in a row are one unknown piece."""
        again = np.zeros(len(flat), bool)
        again[1:] = (flat[1:] == self.unknown) & (flat[:-1] == self.unknown)
        again[at[:-1][at[:-1] < len(flat)]] = False
        return flat[~again], at - np.concatenate([[0], np.cumsum(again)])[at]

    def _chunks(self, chunks: Ragged) -> Ragged:
        """Ids of distinct chunks, solved in groups of like length."""
        whole, size = chunks.flat.tobytes(), np.diff(chunks.at)
        order = np.argsort(size, kind="stable")
        texts = [whole[a:b].decode() for a, b in zip(chunks.at[order].tolist(), chunks.at[order + 1].tolist())]
        found: list[Ragged] = []
        lo = 0
        while lo < len(texts):
            hi = lo + max(1, min(TOGETHER, CELLS // max(1, len(texts[min(lo + TOGETHER, len(texts)) - 1]))))
            found.append(self._words(texts[lo:hi]))
            lo = hi
        n = np.concatenate([np.zeros(0, np.int64), *[np.diff(f.at) for f in found]])
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return Ragged(np.concatenate([np.zeros(0, "<i4"), *[f.flat for f in found]]), np.concatenate([[0], np.cumsum(n)])).take(back)

    def decode(self, ids: list[list[int] | None]) -> list[str | None]:
        """The inverse transducer: pieces to characters, runs of byte pieces to what they spell."""
        out: list[str | None] = []
        for row in ids:
            if row is None:
                out.append(None)
                continue
            text = b"".join([self.spelled[i] for i in row]).decode("utf-8", errors="replace")
            out.append(text[1:] if self.prefix and text[:1] == " " else text)
        return out


def _text_hashes(texts: list[str]) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        h = 0
        for c in t:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        out[i] = h
    return out


def merge(ids: list[int], pairs: dict[tuple[int, int], int], scores: np.ndarray, until: int | None = None):
    """Merge neighbours, best score first and leftmost of equals, until none is left.

    With ``until``: the pair whose merge makes that piece as a whole, or None if merging doesn't end in it.
    """
    ids, n = list(ids), len(ids)
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[float, int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i] if i >= 0 else n
        if i >= 0 and j < n:
            m = pairs.get((ids[i], ids[j]))
            if m is not None:
                heapq.heappush(heap, (-float(scores[m]), i, ids[i], ids[j], m))

    for i in range(n):
        offer(i)
    left, last = n, None
    while heap:
        _, i, a, b, m = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
            continue
        last, left = (a, b), left - 1
        ids[i], alive[j], after[i] = m, False, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    if until is not None:
        return last if left == 1 and ids[0] == until else None
    return [x for x, live in zip(ids, alive) if live]


_OPEN: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The compiled model of this process; a worker keeps it from task to task."""
    if path not in _OPEN:
        _OPEN[path] = Transducer(path)
    return _OPEN[path]


def encode(docs: DataFrame, model: str, text: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, but not ``without``, with n_ids and ids."""

    def work() -> Callable[[pa.RecordBatch], dict[str, Any]]:
        machine = transducer(model)

        def one(part: pa.RecordBatch) -> dict[str, Any]:
            texts = part.column(part.schema.get_field_index(text))
            flat, at = machine.encode(texts)
            null = texts.is_null()
            n = pc.if_else(null, None, pa.array(np.diff(at)))
            return {"n_ids": n, "ids": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat), mask=null)}

        return one

    return map_texts(docs, text, RESULT, work, without=without)


def decode(rows: DataFrame, model: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the text that ``ids`` spell."""
    schema = T.StructType([f for f in rows.schema if f.name.lower() != to.lower()] + [T.StructField(to, T.StringType())])

    def run(batches):
        machine = transducer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = pa.array(machine.decode(part.column(part.schema.get_field_index(ids)).to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([made if n == to else part.column(part.schema.get_field_index(n)) for n in schema.names], names=schema.names)

    return rows.mapInArrow(run, schema)


def verify(docs: DataFrame, model: str, text: str = "text", without: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, but not ``without``, with n_ids, ids_crc32 (of the ids as little-endian 32-bit integers) and round_trip: whether decoding gives the text again.

    Encoding and decoding happen in one pass, and ids don't leave the worker.
    """

    def work() -> Callable[[pa.RecordBatch], dict[str, Any]]:
        machine = transducer(model)

        def one(part: pa.RecordBatch) -> dict[str, Any]:
            column = part.column(part.schema.get_field_index(text))
            flat, at = machine.encode(column)
            null, data = column.is_null().to_pylist(), flat.tobytes()
            ids = [None if z else flat[a:b].tolist() for z, a, b in zip(null, at[:-1], at[1:])]
            sums = [None if z else zlib.crc32(data[4 * a : 4 * b]) for z, a, b in zip(null, at[:-1].tolist(), at[1:].tolist())]
            same = [a == b for a, b in zip(machine.decode(ids), column.to_pylist())]
            return {"n_ids": pa.array([None if i is None else len(i) for i in ids], pa.int64()), "ids_crc32": pa.array(sums, pa.int64()), "round_trip": pa.array(same)}

        return one

    return map_texts(docs, text, [T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType())], work, without=without)
