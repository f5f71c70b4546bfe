"""Quality rules: a linear-chain CRF marks each line as content or boilerplate.

A line with a word is an element of its document's chain. Two labels, content and
boilerplate, are scored by the line's features and by the transition from the line before;
Viterbi decoding picks the best chain. A document stays if the content lines hold at least the
share ``share`` of its word characters and its base rules hold.

The weights and the share are fitted on all lines of all labelled documents. Labels are of documents, so
those of lines are inferred first: a line starts with its document's label, a logistic regression on
single lines is fitted, and lines of junk documents that look like content become content, lines of good
documents that surely look like boilerplate become boilerplate; this is done RELABEL times, and a junk
document keeps its worst line. The chain weights are then fitted to these labels, which change within
documents, and the share that best tells good from junk documents is taken. A first guess comes from the
first TRAIN_DOCS rows of the label table in hash order, of each at most TRAIN_SEGMENTS stretches of SEGMENT
lines, spread evenly; sums over all lines then correct it until the gradient over all lines ends the fit.
Without labels of both kinds the prior weights are used.

Cases: a null text has no words, fails the base rules and goes. Rows with equal ids or texts
are judged one by one; of contradictory labels of an id junk counts. Equally good chains: content
wins. Columns named like a result column are replaced. Lines of any length and texts of any
length are read whole. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import WHITE, map_texts, raw, words
from marlstone.storage import materialize

#: Labelled documents, and stretches of SEGMENT lines of each, that give the first guess.
TRAIN_DOCS, TRAIN_SEGMENTS, SEGMENT = 3000, 4, 32
MIN_SHARE = 0.5  # share of content where nothing is fitted
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
RELABEL, SURE = 3, 0.95  # rounds of relabelling lines, and what a line of a good document must reach to be boilerplate
ROUNDS, STILL = 150, 1e-3  # steps of the fit at most, and the gradient that ends them
CORRECTIONS = 8  # sums over all lines at most, for the chain weights and for each regression
FEW_LABELS = 1_000_000  # labels that are broadcast; of more, lines are measured first and joined by shuffling
BINS = 1024

# What counts as a symbol, and the marks of lists and shouting.
SYMBOLS = b"#*$%&|<>"
_CLASSES = {
    "white": WHITE,
    "symbol": SYMBOLS,
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "digit": bytes(range(48, 58)),
    "bang": b"!?",
    "mark": b".,;:'\"()-",
    "code": b"{}[]=_\\/@~^+`",
}
_FEATURES = ["symbols", "shouting", "digits", "bangs", "code", "marks", "short", "long_words", "repeated_line", "repeated_words", "symbol_words", "bias"]
# Prior weights of boilerplate against content.
_PRIOR = np.array([12.0, 3.0, 4.0, 8.0, 6.0, 0.0, 0.3, 0.5, 2.0, 3.0, 2.0, -2.0])
_TABLE = np.zeros(256, np.uint8)
for _bit, _members in enumerate(_CLASSES.values()):
    _TABLE[list(_members)] |= 1 << _bit

RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("n_lines", T.LongType()),
    T.StructField("n_content_lines", T.LongType()),
    T.StructField("content_share", T.DoubleType()),
    T.StructField("kept", T.BooleanType()),
]


def repeated(tokens: list[bytes]) -> np.ndarray:
    """Which words lie in a three-word window that the text has twice or more."""
    marks = np.zeros(len(tokens), bool)
    windows = list(zip(tokens, tokens[1:], tokens[2:]))
    if len(set(windows)) == len(windows):
        return marks
    seen: set = set()
    twice = {w for w in windows if w in seen or seen.add(w)}
    hit = np.fromiter((w in twice for w in windows), bool, len(windows))
    for shift in range(3):
        marks[shift : shift + len(hit)] |= hit
    return marks


def measure(texts: pa.Array) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Base counts by document; for lines with a word: features, word characters, and the first line of each document (n + 1)."""
    data, offsets = raw(texts)
    n = len(offsets) - 1
    flags = _TABLE[data]
    breaks = np.flatnonzero(data == 10)
    starts, ends = np.sort(np.concatenate([offsets[:-1], breaks + 1])), np.sort(np.concatenate([breaks, offsets[1:]]))
    owner = np.repeat(np.arange(n), 1 + np.searchsorted(breaks, offsets[1:]) - np.searchsorted(breaks, offsets[:-1]))

    def total(mask: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])

    sums = {name: total((flags >> bit) & 1) for bit, name in enumerate(_CLASSES)}
    sums["point"] = total((data & 0xC0) != 0x80)
    by_line = {k: v[ends] - v[starts] for k, v in sums.items()}
    by_doc = {k: v[offsets[1:]] - v[offsets[:-1]] for k, v in sums.items()}
    w_start, w_end, w_first = words(data, offsets)
    used = by_line["point"] > by_line["white"]
    starts, ends, owner = starts[used], ends[used], owner[used]
    line = {k: v[used].astype(float) for k, v in by_line.items()}
    first = np.searchsorted(owner, np.arange(n + 1))
    w_from, w_upto = np.searchsorted(w_start, starts), np.searchsorted(w_start, ends)

    whole = data.tobytes()
    dup_line, again = np.zeros(len(starts), bool), np.zeros(len(w_start), bool)
    dup_lines = np.zeros(n, np.int64)
    for d in range(n):
        lo, hi = int(offsets[d]), int(offsets[d + 1])
        tokens = whole[lo:hi].split()
        if len(tokens) > 2:
            again[w_first[d] : w_first[d + 1]] = repeated(tokens)
        lines = [whole[starts[i] : ends[i]] for i in range(first[d], first[d + 1])]
        if len(set(lines)) < len(lines):
            seen: set = set()
            dup_line[first[d] : first[d + 1]] = dup = [x in seen or bool(seen.add(x)) for x in lines]
            dup_lines[d] = sum(dup)
    again_sum = total(again)
    symbol_word = total((_TABLE[data[w_end - 1]] | _TABLE[data[w_start]]) & 2 > 0) if len(w_start) else np.zeros(1, np.int64)
    count = np.maximum(w_upto - w_from, 1)
    chars = line["point"] - line["white"]
    letters = np.maximum(line["upper"] + line["lower"], 1)
    features = np.stack(
        [
            line["symbol"] / chars,
            line["upper"] / letters,
            line["digit"] / chars,
            line["bang"] / chars,
            line["code"] / chars,
            line["mark"] / chars,
            (count < 4).astype(float),
            np.minimum(chars / count / 20, 2),
            dup_line.astype(float),
            (again_sum[w_upto] - again_sum[w_from]) / count,
            (symbol_word[w_upto] - symbol_word[w_from]) / count,
            np.ones(len(starts)),
        ],
        axis=1,
    )
    docs = {
        "n_words": np.diff(w_first).astype(np.int64),
        "word_chars": by_doc["point"] - by_doc["white"],
        "n_symbols": by_doc["symbol"],
        "n_dup_lines": dup_lines,
        "n_repeat_words": again_sum[w_first[1:]] - again_sum[w_first[:-1]],
    }
    return docs, features, chars, first


def prior_weights() -> dict[str, np.ndarray]:
    """Label 0 is content, label 1 boilerplate."""
    return {"emit": np.stack([np.zeros_like(_PRIOR), _PRIOR], axis=1), "move": np.array([[0.5, -0.5], [-0.5, 0.5]]), "start": np.zeros(2), "share": np.array(MIN_SHARE)}


def viterbi(emit: np.ndarray, first: np.ndarray, weights: dict[str, np.ndarray]) -> np.ndarray:
    """The best label of every line, for many chains at once; ties go to content."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    heads, size = first[:-1][order], size[order]
    back = np.zeros((len(emit), 2), np.int8)
    labels = np.zeros(len(emit), np.int8)
    live = int(np.count_nonzero(size))
    if not live:
        return labels
    score = emit[heads[:live]] + weights["start"]
    final = np.zeros((live, 2))
    for t in range(1, int(size[0]) + 1):
        now = int(np.searchsorted(-size, -t, side="left"))  # chains longer than t
        final[now:live] = score[now:live]
        if not now:
            break
        ways = score[:now, :, None] + weights["move"][None]
        at = heads[:now] + t
        back[at] = ways.argmax(axis=1)
        score = ways.max(axis=1) + emit[at]
        live = now
    picked = final.argmax(axis=1).astype(np.int8)
    ends = heads[: len(final)] + size[: len(final)] - 1
    for t in range(int(size[0])):
        on = size[: len(final)] > t
        at = ends[on] - t
        labels[at] = picked[on]
        picked[on] = back[at, picked[on]]
    return labels


def _line_kinds(x: np.ndarray, first: np.ndarray, kinds: np.ndarray, w: np.ndarray | None) -> np.ndarray:
    """1.0 for lines that count as boilerplate by the weights of a regression; without them, lines of junk."""
    junk = np.repeat(kinds, np.diff(first)) == 1
    if w is None:
        return junk.astype(float)
    score = x @ w
    worst = np.maximum.reduceat(score, first[:-1])
    return np.where(junk, (score > 0) | (score == np.repeat(worst, np.diff(first))), score > np.log(SURE / (1 - SURE))).astype(float)


def _joined(chains: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(chains), np.concatenate([[0], np.cumsum([len(c) for c in chains])])


def line_weights(chains: list[np.ndarray], kinds: np.ndarray) -> list[np.ndarray]:
    """The weights of each round's regression."""
    x, first = _joined(chains)
    found: list[np.ndarray] = []
    for _ in range(RELABEL):
        found.append(_logistic(x, _line_kinds(x, first, kinds, found[-1] if found else None)))
    return found


def line_labels(chains: list[np.ndarray], kinds: np.ndarray, w: np.ndarray | None = None) -> list[np.ndarray]:
    """A label for each line of documents of which only the kind (1: junk) is known; ``w``: weights of the last regression, if not of these lines."""
    x, first = _joined(chains)
    y = _line_kinds(x, first, kinds, line_weights(chains, kinds)[-1] if w is None else w)
    return [y[a:b].astype(np.int64) for a, b in zip(first[:-1], first[1:])]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Weights of a logistic regression by Newton steps; both labels weigh the same."""
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 10 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return w


class _Batch:
    """Chains of like length, padded."""

    def __init__(self, chains: list[np.ndarray], labels: list[np.ndarray]) -> None:
        self.size = np.array([len(c) for c in chains])
        shape = (len(chains), int(self.size.max()))
        self.x, self.y = np.zeros((*shape, len(_FEATURES))), np.zeros(shape, np.int64)
        for i, (c, l) in enumerate(zip(chains, labels)):
            self.x[i, : len(c)], self.y[i, : len(c)] = c, l
        self.inside = np.arange(shape[1])[None] < self.size[:, None]


def _batches(chains: list[np.ndarray], labels: list[np.ndarray]) -> tuple[list[_Batch], int]:
    """Stretches of the chains by like length, and the number of their lines."""
    parts = [(x[i : i + SEGMENT], y[i : i + SEGMENT]) for x, y in zip(chains, labels) for i in range(0, len(x), SEGMENT)]
    parts.sort(key=lambda p: len(p[0]))
    batches, lo = [], 0
    while lo < len(parts):  # a batch's longest chain has at most twice its shortest one's lines
        hi = lo + 1
        while hi < len(parts) and len(parts[hi][0]) <= 2 * len(parts[lo][0]):
            hi += 1
        batches.append(_Batch([p[0] for p in parts[lo:hi]], [p[1] for p in parts[lo:hi]]))
        lo = hi
    return batches, sum(len(x) for x, _ in parts)


def _slope(batches: list[_Batch], w: dict[str, np.ndarray], scale: float) -> dict[str, np.ndarray]:
    """The likelihood's gradient, each line weighing ``scale``."""
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    for b in batches:
        for k, g in _gradient(b.x, b.x @ w["emit"], w, b.y, b.inside, b.size, np.full(len(b.size), scale)).items():
            grad[k] = grad[k] + g
    return grad


def _pull(w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The gradient that holds weights near the prior ones."""
    prior = prior_weights()
    return {k: -1e-4 * (v - prior[k]) for k, v in w.items()}


def fit(chains: list[np.ndarray], labels: list[np.ndarray], begin: dict[str, np.ndarray] | None = None, shift: dict[str, np.ndarray] | None = None) -> dict[str, np.ndarray]:
    """Maximum likelihood of the lines' labels by Adam; forward-backward gives the gradient, to which ``shift`` is added."""
    w = dict(begin or prior_weights())
    share = w.pop("share")
    batches, lines = _batches(chains, labels)
    scale = 1 / max(lines, 1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    for step in range(1, ROUNDS + 1):
        pull, slope = _pull(w), _slope(batches, w, scale)
        grad = {k: pull[k] + slope[k] + (shift[k] if shift else 0) for k in w}
        if max(np.abs(g).max() for g in grad.values()) < STILL * (0.5 if shift else 1):
            break
        for k, g in grad.items():
            m, v = moments[k]
            m[:], v[:] = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w[k] = w[k] + (0.03 if shift else 0.15) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w | {"share": share}


def _unpacked(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(c, np.float32).reshape(-1, len(_FEATURES) + 1).astype(float) for c in column.to_pylist()]


def _sums(measured: DataFrame, add: Callable[[list[np.ndarray], np.ndarray], np.ndarray]) -> np.ndarray:
    """``add`` of chains and kinds, summed over all labelled documents with a line; a row for each slice comes to the driver."""

    def run(batches: Any) -> Any:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                chains = [c[:, :-1] for c in _unpacked(part.column(1))]
                total = add(chains, part.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([np.asarray(total, np.float64).tobytes()], pa.binary())], names=["sums"])

    return np.sum([np.frombuffer(r.sums) for r in measured.select("junk", "chain").mapInArrow(run, "sums binary").collect()], axis=0)


def _regression(measured: DataFrame, before: np.ndarray | None, w: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """``_logistic`` over all lines, whose labels the weights ``before`` give, from ``w`` on."""
    f = len(w)
    for _ in range(CORRECTIONS):

        def add(chains: list[np.ndarray], kinds: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            x, first = _joined(chains)
            y = _line_kinds(x, first, kinds, before)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            bend = np.maximum(p * (1 - p), 1e-6)
            return np.concatenate([part for on in (y == 1, y != 1) for part in ([on.sum()], x[on].T @ (p - y)[on], ((x[on] * bend[on, None]).T @ x[on]).ravel())])

        sides = _sums(measured, add).reshape(2, 1 + f + f * f)
        slope, bend = ridge * w, ridge * np.eye(f)
        for side in sides:
            weight = 0.5 / max(side[0], 1)
            slope, bend = slope + weight * side[1 : 1 + f], bend + weight * side[1 + f :].reshape(f, f)
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 10 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-4:
            break
    return w


def _fit_all(measured: DataFrame, last: np.ndarray, chains: list[np.ndarray], kinds: np.ndarray, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """``weights`` corrected until the gradient over all lines is still: the sample is fitted anew with the difference of both gradients added."""
    labels = line_labels(chains, kinds, last)
    batches, lines = _batches(chains, labels)
    for _ in range(CORRECTIONS):
        w = {k: v for k, v in weights.items() if k != "share"}

        def add(chains: list[np.ndarray], kinds: np.ndarray, w: dict[str, np.ndarray] = w) -> np.ndarray:
            parts, n = _batches(chains, line_labels(chains, kinds, last))
            return np.concatenate([[n], *[g.ravel() for g in _slope(parts, w, 1.0).values()]])

        total = _sums(measured, add)
        whole, at = {}, 1
        for k, v in w.items():
            whole[k] = (total[at : at + v.size] / max(total[0], 1)).reshape(v.shape)
            at += v.size
        pull, mine = _pull(w), _slope(batches, w, 1 / max(lines, 1))
        if max(np.abs(whole[k] + pull[k]).max() for k in w) < STILL:
            break
        weights = fit(chains, labels, weights, {k: whole[k] - mine[k] for k in w})
    return weights


def _share_all(measured: DataFrame, weights: dict[str, np.ndarray]) -> float:
    """``best_share`` of all labelled documents. Shares are counted in bins; only bins that can hold the best cut are gathered, by their distinct shares."""

    def run(batches: Any) -> Any:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                lines = _unpacked(part.column(1))
                x, first = _joined(lines)
                content = viterbi(x[:, :-1] @ weights["emit"], first, weights) == 0
                shares = np.add.reduceat(x[:, -1] * content, first[:-1]) / np.add.reduceat(x[:, -1], first[:-1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shares)], names=["junk", "share"])

    counts = measured.select("junk", "chain").mapInArrow(run, "junk int, share double").groupBy("share", "junk").agg(F.count("*").alias("n"))
    counts = materialize(counts.withColumn("bin", F.floor(F.col("share") * BINS).cast("int")), "crf-shares")
    bins = sorted(counts.groupBy("bin").agg(F.sum(F.col("n") * F.col("junk")).alias("junk"), F.sum(F.col("n") * (1 - F.col("junk"))).alias("good"), F.min("share").alias("least"), F.max("share").alias("most")).collect())
    junk, good = (np.array([r[k] for r in bins], float) for k in ("junk", "good"))
    junk, good = junk / max(junk.sum(), 1), good / max(good.sum(), 1)
    before = np.concatenate([[0.0], np.cumsum(junk - good)])
    open_ = [r.bin for r, start, most in zip(bins, before, junk) if r.least < r.most and start + most >= before.max() - 1e-9]
    inside = {b: [] for b in open_}
    for r in counts.where(F.col("bin").isin(open_)).collect() if open_ else []:
        inside[r.bin].append((r.share, r.junk, r.n))
    # The other bins count as one share each for what lies before their end; their own ends bound the cut.
    shares, kinds, n = [], [], []
    for r in bins:
        for share, kind, count in inside.get(r.bin) or [(r.least, 1, 0), (r.most, 1, r.junk), (r.most, 0, r.good)]:
            shares, kinds, n = [*shares, share], [*kinds, kind], [*n, count]
    return best_share(np.array(shares), np.array(kinds), np.array(n, float))


def best_share(shares: np.ndarray, kinds: np.ndarray, n: np.ndarray | None = None) -> float:
    """The least share of content that tells good documents (kind 0) from junk best, each kind weighing the same; midway to the next share below. ``n``: how often each is there."""
    order = np.argsort(shares, kind="stable")
    at, kind = shares[order], kinds[order]
    often = np.ones(len(at)) if n is None else n[order]
    junk, good = often * (kind == 1), often * (kind == 0)
    right = np.cumsum(junk) / max(junk.sum(), 1) - np.cumsum(good) / max(good.sum(), 1)
    right = np.concatenate([[0.0], right])  # with the first i documents rejected
    cut = np.flatnonzero(np.concatenate([[True], at[1:] > at[:-1], [True]]))
    i = int(cut[np.argmax(right[cut])])
    low, high = (at[i - 1] if i else 0.0), (at[i] if i < len(at) else 1.0)
    return float((low + high) / 2)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradient(x, emit, w, labels, inside, size, scale):
    n, length, _ = emit.shape
    ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = emit[:, 0] + w["start"]
    for t in range(1, length):
        ahead[:, t] = _lse(ahead[:, t - 1, :, None] + w["move"][None], 1) + emit[:, t]
    for t in range(length - 2, -1, -1):
        step = _lse(w["move"][None] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        behind[:, t] = np.where(inside[:, t + 1, None], step, 0)
    norm = _lse(ahead[np.arange(n), size - 1], 1)
    gamma = np.exp(ahead + behind - norm[:, None, None]) * inside[..., None]
    truth = np.zeros_like(gamma)
    np.put_along_axis(truth, labels[..., None], inside[..., None].astype(float), axis=2)
    grad = {"emit": np.einsum("ntf,ntl,n->fl", x, truth - gamma, scale), "start": ((truth - gamma)[:, 0] * scale[:, None]).sum(0), "move": np.zeros((2, 2))}
    if length > 1:
        pair = np.exp(ahead[:, :-1, :, None] + w["move"] + (emit + behind)[:, 1:, None, :] - norm[:, None, None, None])
        both = inside[:, 1:, None, None]
        real = truth[:, :-1, :, None] * truth[:, 1:, None, :]
        grad["move"] = np.einsum("ntij,n->ij", (real - pair) * both, scale)
    return grad


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", good: str = "quality") -> dict[str, np.ndarray]:
    """Fit on all labelled documents; label 1 of ``good`` is content."""
    kinds = labels.where(F.col(good).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), (F.col(good) == 0).cast("int").alias("junk")).groupBy("doc_id").agg(F.max("junk").alias("junk"))
    kinds = materialize(kinds, "crf-labels")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    few = kinds.count() <= FEW_LABELS
    if few:
        rows = rows.join(F.broadcast(kinds), "doc_id").select("doc_id", "junk", "text")

    def work() -> Callable[[pa.RecordBatch], dict[str, Any]]:
        def one(part: pa.RecordBatch) -> dict[str, Any]:
            _, features, chars, first = measure(part.column(part.schema.get_field_index("text")))
            rows = np.concatenate([features, chars[:, None]], axis=1).astype(np.float32)
            return {"chain": pa.array([rows[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())}

        return one

    measured = map_texts(rows, "text", [T.StructField("chain", T.BinaryType())], work, without=("text",))
    measured = (measured if few else measured.join(kinds, "doc_id")).select("doc_id", "junk", "chain").where(F.length("chain") > 0)
    measured = materialize(measured, "crf-lines")
    first = kinds.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS).select("doc_id")
    got = sorted(measured.join(F.broadcast(first), "doc_id", "left_semi").mapInArrow(_cut, measured.schema).collect(), key=lambda r: (r.doc_id, bytes(r.chain)))
    if len({r.junk for r in measured.select("junk").distinct().collect()}) < 2:
        return prior_weights()
    chains = [np.frombuffer(r.chain, np.float32).reshape(-1, len(_FEATURES) + 1).astype(float)[:, :-1] for r in got]
    sampled = np.array([r.junk for r in got], np.int64)
    guesses = line_weights(chains, sampled) if chains else [np.zeros(len(_FEATURES))] * RELABEL
    last = None
    for guess in guesses:
        last = _regression(measured, last, guess)
    weights = fit(chains, line_labels(chains, sampled, last)) if chains else prior_weights()
    if chains:
        weights = _fit_all(measured, last, chains, sampled, weights)
    return weights | {"share": np.array(_share_all(measured, weights))}


def _cut(batches: Any) -> Any:
    """Chains to the lines that the first guess is made from."""
    for batch in batches:
        at, size = batch.schema.get_field_index("chain"), 4 * (len(_FEATURES) + 1)
        cut = [np.frombuffer(c, np.float32).reshape(-1, size // 4)[_sampled(len(c) // size)].tobytes() for c in batch.column(at).to_pylist()]
        yield batch.set_column(at, "chain", pa.array(cut, pa.binary()))


def _sampled(n: int) -> np.ndarray:
    """Which of a document's n lines are fitted on: all, or stretches of SEGMENT that begin at even distances."""
    if n <= TRAIN_SEGMENTS * SEGMENT:
        return np.arange(n)
    starts = np.arange(TRAIN_SEGMENTS) * (n - SEGMENT) // (TRAIN_SEGMENTS - 1)
    return (starts[:, None] + np.arange(SEGMENT)).ravel()


def judge(texts: pa.Array, weights: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The result columns of a slice of documents."""
    docs, features, chars, first = measure(texts)
    labels = viterbi(features @ weights["emit"], first, weights)
    content = np.concatenate([[0], np.cumsum(chars * (labels == 0))])
    good = np.concatenate([[0], np.cumsum(labels == 0)])
    docs["n_lines"] = np.diff(first).astype(np.int64)
    docs["n_content_lines"] = good[first[1:]] - good[first[:-1]]
    docs["content_share"] = (content[first[1:]] - content[first[:-1]]) / np.maximum(docs["word_chars"], 1)
    docs["base_failed"] = (docs["n_words"] < MIN_WORDS) | (100 * docs["n_repeat_words"] > MAX_REPEATED_PERCENT * docs["n_words"])
    docs["kept"] = ~docs["base_failed"] & (docs["content_share"] >= float(weights["share"]))
    return docs


def annotate(docs: DataFrame, weights: dict[str, np.ndarray], text: str = "text", only_kept: bool = False, without: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the columns of RESULT but not ``without``; ``only_kept`` leaves out what the rules reject."""

    def work() -> Callable[[pa.RecordBatch], dict[str, Any]]:
        def one(part: pa.RecordBatch) -> dict[str, Any]:
            found = judge(part.column(part.schema.get_field_index(text)), weights)
            return {f.name: pa.array(found[f.name]) for f in RESULT}

        return one

    return map_texts(docs, text, RESULT, work, (lambda made: made["kept"]) if only_kept else None, without)
