import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from edges import TEXTS, documents, labels, prose

from marlstone.llm import line_crf, queries


def base(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count = Counter(zip(words, words[1:], words[2:]))
    marked = {j for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    n = len(words)
    return n, sum(map(len, words)), symbols, dup, len(marked), n < 50 or 100 * len(marked) > 50 * n


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_counts(spark):
    got = line_crf.annotate(documents(spark).drop("lang"), line_crf.prior_weights()).collect()
    assert Counter((r.doc_id, *(r[c] for c in BASE)) for r in got) == Counter((i, *base(t)) for i, t in TEXTS)
    assert all(not r.kept for r in got if r.base_failed)
    assert line_crf.annotate(documents(spark, []), line_crf.prior_weights()).count() == 0


def test_query(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op2_quality_rules(spark, sf).collect()}
    assert {i: tuple(r[c] for c in BASE) for i, r in got.items()} == {i: base(t) for i, t in docs.items()}


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    weights = {"emit": rng.normal(size=(4, 2)), "move": rng.normal(size=(2, 2)), "start": rng.normal(size=2)}
    sizes = [0, 1, 5, 7, 0, 3, 7]
    first = np.concatenate([[0], np.cumsum(sizes)])
    emit = rng.normal(size=(first[-1], 2))
    labels_ = line_crf.viterbi(emit, first, weights)
    for a, b in zip(first, first[1:]):
        def score(path):
            return sum(emit[a + t, y] for t, y in enumerate(path)) + weights["start"][path[0]] + sum(weights["move"][p] for p in zip(path, path[1:]))

        if b > a:
            best = max(itertools.product((0, 1), repeat=b - a), key=score)
            assert tuple(labels_[a:b]) == best


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2, 3, 2))
    w = {"emit": rng.normal(size=(2, 2)), "move": rng.normal(size=(2, 2)), "start": rng.normal(size=2)}
    labels_, size, scale = np.array([[0, 1, 1], [1, 0, 0]]), np.array([3, 2]), np.array([0.5, 2.0])
    inside = np.arange(3)[None] < size[:, None]

    def likelihood(w):
        total = 0.0
        for i in range(2):
            def score(path):
                return sum((x[i, t] @ w["emit"])[y] for t, y in enumerate(path)) + w["start"][path[0]] + sum(w["move"][p] for p in zip(path, path[1:]))

            every = [score(p) for p in itertools.product((0, 1), repeat=size[i])]
            total += scale[i] * (score(tuple(labels_[i, : size[i]])) - np.logaddexp.reduce(every))
        return total

    grad = line_crf._gradient(x, x @ w["emit"], w, labels_, inside, size, scale)
    for k, v in w.items():
        for at in np.ndindex(v.shape):
            up, down = ({n: a.copy() for n, a in w.items()} for _ in range(2))
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            assert np.isclose(grad[k][at], (likelihood(up) - likelihood(down)) / 2e-5, atol=1e-5)


def test_held_out_accuracy(spark, sf):
    base_dir = sf.replace("sf0.001", "sf0.01")
    docs, marks = spark.read.parquet(f"{base_dir}/documents.parquet"), spark.read.parquet(f"{base_dir}/labels.parquet")
    weights = line_crf.train(docs, marks.where("doc_id % 2 = 0"))
    got = line_crf.annotate(docs.select("doc_id", "text"), weights).join(marks.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in got)
    clean = [r for r in got if r.quality == 1]
    assert right / len(got) > 0.97 and sum(r.kept for r in clean) / len(clean) > 0.98


def test_without_labels(spark):
    assert np.array_equal(line_crf.train(documents(spark), labels(spark))["emit"], line_crf.prior_weights()["emit"])
    assert np.array_equal(line_crf.train(documents(spark), labels(spark, [(4, 1, 0), (99, 0, 0), (5, None, 0)]))["emit"], line_crf.prior_weights()["emit"])


def test_fitted_weights_tell_lines_apart(spark, sf):
    """With fitted weights labels change within documents, and verdicts are those of the best of all paths."""
    base_dir = sf.replace("sf0.001", "sf0.01")
    docs, marks = spark.read.parquet(f"{base_dir}/documents.parquet"), spark.read.parquet(f"{base_dir}/labels.parquet")
    weights = line_crf.train(docs, marks)
    rows = {r.doc_id: r for r in line_crf.annotate(docs.select("doc_id", "text"), weights).collect()}
    assert sum(0 < r.content_share < 1 for r in rows.values()) > 30
    good = "\n".join(prose(30, i) for i in range(6))
    bad = "\n".join("BUY!! NOW!! ###*** CLICK!! $$$ &&& |||" for _ in range(12))
    for text in (f"{good}\n{bad}", f"{bad}\n{good}"):
        out = line_crf.judge(pa.array([text]), weights)
        assert out["n_lines"][0] == 18 and 0 < out["content_share"][0] < 1 and abs(int(out["n_content_lines"][0]) - 6) <= 1
    checked = 0
    for r in rows.values():
        if 2 <= r.n_lines <= 9:
            _, x, chars, _ = line_crf.measure(pa.array([r.text]))
            emit = x @ weights["emit"]

            def score(path):
                return sum(emit[t, y] for t, y in enumerate(path)) + weights["start"][path[0]] + sum(weights["move"][p] for p in zip(path, path[1:]))

            best = np.array(max(itertools.product((0, 1), repeat=len(x)), key=score))
            share = chars[best == 0].sum() / r.word_chars
            assert r.content_share == share and r.kept == (not base(r.text)[-1] and share >= weights["share"])
            checked += 1
    assert checked > 300


def test_lines_of_labelled_documents(spark):
    rng = np.random.default_rng(0)
    plain, odd = (lambda n: rng.normal([0.0, 1.0, 0.0], [0.1, 0, 0.1], (n, 3))), (lambda n: rng.normal([3.0, 1.0, 0.0], [0.1, 0, 0.1], (n, 3)))
    chains = [plain(8) for _ in range(20)] + [np.concatenate([plain(3), odd(5)]) for _ in range(20)] + [plain(2)]
    got = line_crf.line_labels(chains, np.array([0] * 20 + [1] * 21))
    assert all(not g.any() for g in got[:20]) and all(g.tolist() == [0] * 3 + [1] * 5 for g in got[20:40])
    assert got[40].sum() == 1  # a junk document keeps its worst line
    assert line_crf.best_share(np.array([1.0, 0.9, 0.2, 0.1]), np.array([0, 0, 1, 1])) == 0.55


def test_mixed_document():
    good = "\n".join(prose(12, i) for i in range(6))
    bad = "\n".join("BUY!! NOW!! ###*** CLICK!! $$$ &&& |||" for _ in range(12))
    out = line_crf.judge(pa.array([good + "\n" + bad]), line_crf.prior_weights())
    assert out["n_lines"][0] == 18 and 0 < out["content_share"][0] < 1


def test_threshold_and_model_are_of_all_labels(spark, monkeypatch):
    """The first guess sees few documents; the share is the best one of all, and the gradient over all lines is still."""
    import numpy as np

    from marlstone.llm import line_crf

    rng = np.random.default_rng(6)
    docs, labels = [], []
    for i in range(400):
        lines = [" ".join(f"word{rng.integers(500)}" for _ in range(9)) if rng.random() < (0.85 if i % 2 else 0.3) else "BUY $$$ NOW !!! ### <<< " + "!" * int(rng.integers(1, 9)) for _ in range(int(rng.integers(2, 14)))]
        docs.append((i, "\n".join(lines)))
        labels.append((i, i % 2))
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")
    monkeypatch.setattr(line_crf, "TRAIN_DOCS", 40)
    weights = line_crf.train(d, l)
    _, features, chars, first = line_crf.measure(pa.array([t for _, t in docs]))
    features, chars = features.astype(np.float32).astype(float), chars.astype(np.float32).astype(float)
    content = line_crf.viterbi(features @ weights["emit"], first, weights) == 0
    shares = np.add.reduceat(chars * content, first[:-1]) / np.add.reduceat(chars, first[:-1])
    kinds = np.array([1 - q for _, q in labels])
    assert float(weights["share"]) == line_crf.best_share(shares, kinds)
    chains = [features[a:b] for a, b in zip(first[:-1], first[1:])]
    last = line_crf.line_weights(chains, kinds)[-1]
    batches, n = line_crf._batches(chains, line_crf.line_labels(chains, kinds, last))
    w = {k: v for k, v in weights.items() if k != "share"}
    slope, pull = line_crf._slope(batches, w, 1 / n), line_crf._pull(w)
    assert max(np.abs(slope[k] + pull[k]).max() for k in w) < 2 * line_crf.STILL
