"""Secret scanning: a random forest tells secrets from look-alikes.

A wide net takes candidates from whole texts: runs of at least ``MIN_RUN`` characters of
``[A-Za-z0-9_+/=.~-]`` with a letter and a digit; values of eight or more after a name such as
``password``, ``"api_key"`` or ``secret_token`` and ``=`` or ``:``; passwords in addresses
(``scheme://user:password@host``); and what begins as issued keys do, of letters alone too. A
forest trained on labelled findings then decides, by the
candidate's length and character classes, its character transitions, the share of it that
dictionary words cover, its path and the words beside it. Which transitions and which
neighbouring words speak for a secret is learned from the same findings, as log odds.

The labelled findings come as a table (``path``, ``before``, ``candidate``, ``after``, ``secret``);
the first TRAIN_FINDINGS rows in hash order are used.
``labelled_findings`` makes the one that ships: seeded random keys, passwords and tokens against
identifiers, versions, file names, checksums, addresses and slugs in their usual contexts.

Cases: a null or empty text has no finding. Repeated rows give their findings each. A null path
counts as an empty one. Texts are scanned whole, in time linear in their length; a run of any length is one candidate. An empty
table gives no rows. Columns named like a result column are replaced.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.batches import map_texts, slices

MIN_RUN, MIN_VALUE = 16, 8
CONTEXT = 48  # characters read on either side of a candidate
#: Findings that the forest is trained on at most, in hash order.
TRAIN_FINDINGS = 20_000
TREES, DEPTH, MIN_LEAF = 40, 10, 3
CUTOFF = 0.5
MASK = "<secret>"

_RUN = re.compile(r"[A-Za-z0-9_+/=.~-]{%d,}" % MIN_RUN)
_NAME = re.compile(r"(?i)passw(?:or)?d|passphrase|secret|token|(?:api|access|private)[_-]?key|credential")
_VALUE = re.compile(r"[A-Za-z0-9_-]{0,24}[\"']?\s*(?::=|=>|[:=])\s*[\"']?([^\s\"',;]{%d,})" % MIN_VALUE)
_URL = re.compile(r"://[^\s/:@\"']{1,64}:([^\s/@\"']{%d,})@" % MIN_VALUE)
_DIGIT, _LETTER, _WORD = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]"), re.compile(r"[a-z_0-9]+")
OFTEN = 8  # findings that a word must stand beside to count

# How keys that well-known services issue begin.
_ISSUED = ("AKIA", "ASIA", "AIza", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "glpat-", "sk-", "sk_live_", "xoxb-", "xoxa-", "xoxp-")
_BEGINS = re.compile(r"(?<![A-Za-z0-9_])(?:%s)[A-Za-z0-9_-]{5,}" % "|".join(_ISSUED))
# Common name parts.
_DICTIONARY = sorted(
    set(
        "access account action admin agent alpha and api app archive array auth author backup base batch beta block board book branch build cache call case chain change channel chapter class client cloud code color column com commit config content context control copy core count course create data database date default delta demo design dev device digest disk doc document domain draft edit email engine entry error event example export factory feature field figure file filter final first flag folder font form format frame from full game gamma global graph group guide handler hash header help home host html http https image img import index info input install item java job json key label lang large last layout lib library license line link linux list local lock log login main manager map master media member menu message meta method mobile mode model module music name net network news node note number object online open option order org output package page panel parser part patch path photo picture plugin point policy port post process product profile project public query queue read record release remote report request reset result review role root route row sample schema script search section security sensor server service session set setting shared shop simple site size small snapshot source spark stable stage start state static status step storage store stream string style summary support system table tag task team temp template test text the theme thread time title token tool topic total tree type unit update upload url user util value vector version video view web widget window with word work worker year zone".split()
    )
)

RESULT = [
    T.StructField(
        "findings",
        T.ArrayType(
            T.StructType(
                [
                    T.StructField("start", T.LongType()),
                    T.StructField("length", T.LongType()),
                    T.StructField("rule", T.StringType()),
                    T.StructField("score", T.DoubleType()),
                    T.StructField("secret", T.BooleanType()),
                ]
            )
        ),
    )
]
FINDING = T.StructType([T.StructField(n, T.StringType()) for n in ("path", "before", "candidate", "after")] + [T.StructField("secret", T.BooleanType())])


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, rule) in code points, in order, disjoint.

    A value, password or issued key inside a run is one candidate with what follows it there;
    what stands before it in the run, as a name and an equals sign do, is not part of it.
    """
    if not text:
        return []
    sure = [(m.start(1), m.end(1), "value") for n in _NAME.finditer(text) if (m := _VALUE.match(text, n.end()))]
    if "://" in text:
        sure += [(*m.span(1), "url") for m in _URL.finditer(text)]
    if any(x in text for x in _ISSUED):
        sure += [(*m.span(), "issued") for m in _BEGINS.finditer(text)]
    runs = [m.span() for m in _RUN.finditer(text) if _DIGIT.search(m[0]) and _LETTER.search(m[0])] if _DIGIT.search(text) else []
    found: list[tuple[int, int, str]] = []
    for a, b, rule in sorted(sure):
        if found and a < found[-1][1]:
            found[-1] = (found[-1][0], max(b, found[-1][1]), found[-1][2])
        else:
            found.append((a, b, rule))
    out, i = [], 0
    for a, b, rule in found:
        while i < len(runs) and runs[i][1] <= a:
            out.append((*runs[i], "run"))
            i += 1
        while i < len(runs) and runs[i][0] < b:
            b = max(b, runs[i][1])
            i += 1
        if out and out[-1][1] > a:  # a run that reached over the one before
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2])
        else:
            out.append((a, b, rule))
    return out + [(*r, "run") for r in runs[i:]]


@lru_cache(maxsize=1)
def _word_pattern() -> re.Pattern:
    return re.compile("|".join(sorted((re.escape(w) for w in _DICTIONARY if len(w) > 2), key=len, reverse=True)))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _beside(before: str, after: str) -> tuple[list[str], list[str]]:
    """The four words before and the two after, and each part of a joined name."""
    left, right = _WORD.findall(before.lower())[-4:], _WORD.findall(after.lower())[:2]
    return [p for w in left for p in {w, *w.split("_")}], right


def features(path: str, before: str, candidate: str, after: str, pairs: np.ndarray | None = None, words: dict[str, float] | None = None) -> list[float]:
    """What the forest sees of a finding. ``pairs`` and ``words``: log odds of character pairs and of words beside, from training."""
    n = len(candidate)
    kinds = [_kind(c) for c in candidate]
    share = [kinds.count(k) / n for k in range(4)]
    counts = {c: candidate.count(c) for c in set(candidate)}
    entropy = -sum(v / n * math.log2(v / n) for v in counts.values())
    moves = sum(a != b for a, b in zip(kinds, kinds[1:])) / max(n - 1, 1)
    low = candidate.lower()
    covered = sum(len(m[0]) for m in _word_pattern().finditer(low)) / n
    odds = float(np.mean([pairs[ord(a) & 127, ord(b) & 127] for a, b in zip(candidate, candidate[1:])])) if pairs is not None and n > 1 else 0.0
    hexa = sum(c in "0123456789abcdefABCDEF" for c in candidate) / n
    parts = [p for p in re.split(r"[-_./+=~]", candidate) if p]
    words = words or {}
    left, right = ([words.get(w, 0.0) for w in side] for side in _beside(before, after))
    assigned = bool(re.search(r"[:=]\s*[\"']?$", before))
    quoted = before[-1:] in ("'", '"') and before[-1:] == after[:1]
    where = path.lower()
    return [
        float(n),
        *share,
        entropy,
        moves,
        covered,
        odds,
        hexa,
        float(len(parts)),
        max(map(len, parts), default=0) / n,
        float(candidate.count("/")) / n,
        float(candidate.count("-")) / n,
        float(candidate.count(".")) / n,
        max(left, default=0.0),
        min(left, default=0.0),
        sum(right),
        float(assigned),
        float(quoted),
        float(before.endswith(("/", ":", "@")) or "://" in before[-24:]),
        float(any(x in where for x in (".env", "config", "secret", "credential", ".pem", "key"))),
        float(any(x in where for x in ("test", "lock", "sum", "doc", "example", "vendor"))),
    ]


def _log_odds(rows: list[tuple]) -> np.ndarray:
    counts = np.ones((2, 128, 128))
    for _, _, candidate, _, secret in rows:
        for a, b in zip(candidate, candidate[1:]):
            counts[int(secret), ord(a) & 127, ord(b) & 127] += 1
    share = counts / counts.sum(axis=2, keepdims=True)
    return np.log(share[1] / share[0])


def _word_odds(rows: list[tuple]) -> dict[str, float]:
    """Log odds of a secret for each word that stands beside OFTEN findings or more."""
    counts: dict[str, list[int]] = {}
    for _, before, _, after, secret in rows:
        for w in {w for side in _beside(before, after) for w in side}:
            counts.setdefault(w, [0, 0])[int(secret)] += 1
    total = [sum(r[4] == k for r in rows) for k in (False, True)]
    return {w: math.log((yes + 1) / (total[1] + 2)) - math.log((no + 1) / (total[0] + 2)) for w, (no, yes) in counts.items() if no + yes >= OFTEN}


class Forest:
    """Bagged trees on Gini impurity; a node looks at the square root of the features."""

    def __init__(self, trees: list[np.ndarray], pairs: np.ndarray | None = None, words: dict[str, float] | None = None) -> None:
        self.trees, self.pairs, self.words = trees, pairs, words

    @staticmethod
    def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7) -> Forest:
        rng, grown = np.random.default_rng(seed), []
        for _ in range(trees):
            pick = rng.integers(0, len(x), len(x))
            nodes: list[list[float]] = []
            _grow(x[pick], y[pick], depth, rng, nodes)
            grown.append(np.array(nodes))
        return Forest(grown)

    def score(self, x: np.ndarray) -> np.ndarray:
        """The mean share of secrets in the leaves."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = t[at, 0] >= 0
                if not inner.any():
                    break
                node = t[at]
                goes = np.where(x[rows, np.maximum(node[:, 0], 0).astype(int)] <= node[:, 1], node[:, 2], node[:, 3]).astype(np.int64)
                at = np.where(inner, goes, at)
            total += t[at, 4]
        return total / len(self.trees)


def _grow(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator, nodes: list[list[float]]) -> int:
    """Append the node of these rows (feature, threshold, left, right, share) and give its index."""
    me, share = len(nodes), float(y.mean())
    nodes.append([-1, 0, 0, 0, share])
    if depth == 0 or len(y) < 2 * MIN_LEAF or share in (0.0, 1.0):
        return me
    best = (2 * share * (1 - share) - 1e-9, -1, 0.0)
    for f in rng.permutation(x.shape[1])[: max(1, int(math.sqrt(x.shape[1])) + 1)]:
        order = np.argsort(x[:, f], kind="stable")
        v, c = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        fits = (v[1:] > v[:-1]) & (n >= MIN_LEAF) & (len(y) - n >= MIN_LEAF)
        if not fits.any():
            continue
        p, q = c[:-1] / n, (c[-1] - c[:-1]) / (len(y) - n)
        cost = np.where(fits, (2 * p * (1 - p) * n + 2 * q * (1 - q) * (len(y) - n)) / len(y), np.inf)
        i = int(cost.argmin())
        if cost[i] < best[0]:
            best = (float(cost[i]), int(f), float((v[i] + v[i + 1]) / 2))
    if best[1] >= 0:
        left = x[:, best[1]] <= best[2]
        a = _grow(x[left], y[left], depth - 1, rng, nodes)
        b = _grow(x[~left], y[~left], depth - 1, rng, nodes)
        nodes[me] = [best[1], best[2], a, b, share]
    return me


def findings_made(seed: int = 11, n: int = 4000) -> list[tuple]:
    """Labelled findings from a seed, half of them secrets."""
    rng = random.Random(seed)
    hexa, base, url = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"

    def some(letters: str, size: int) -> str:
        return "".join(rng.choice(letters) for _ in range(size))

    def words(k: int, sep: str) -> str:
        return sep.join(rng.choice(_DICTIONARY) for _ in range(k))

    def secret() -> tuple:
        value = rng.choice([some(hexa, rng.choice([32, 40, 48, 64])), some(base, rng.choice([24, 32, 40, 44])), some(url, rng.randint(20, 60)), some(base[:62], rng.randint(8, 15)), "AKIA" + some(base[:26], 16), "AK" + some("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 18), "sk-" + some(base[:62], 40), "gh" + rng.choice("pos") + "_" + some(base[:62], 36), rng.choice(_DICTIONARY).title() + some("0123456789", rng.randint(2, 5)) + some("!@#$%_-", 1) + some(base[:62], rng.randint(3, 8))])
        name = rng.choice(["token", "secret", "password", "api_key", "apikey", "auth_token", "access_token", "private_key", "client_secret"])
        quote = rng.choice(['"', "'", ""])
        before = rng.choice([f"{name} = {quote}", f"{name}: {quote}", f"{name}={quote}", f"set {name} {quote}", f"Authorization: Bearer {quote}", f'"{name}": {quote}', f"{name}_{rng.choice(_DICTIONARY)} = {quote}", f"{rng.choice(['https', 'postgres', 'redis'])}://{rng.choice(_DICTIONARY)}:"])
        if not before.startswith("Auth") and rng.random() < 0.5:
            before = f"{words(rng.randint(1, 4), ' ')} {before}"
        after = ("@" + words(2, ".") if "://" in before else quote) + rng.choice([" ", "\n", f" {words(2, ' ')}"])
        return (rng.choice(["src3", "", ".env", "config/app.yml", "src/main.py"]), before, value, after, True)

    def plain() -> tuple:
        kind = rng.randrange(10)
        quote = rng.choice(['"', "", ""])
        if kind == 0:
            return ("go.sum", rng.choice(["commit ", "sha1 ", "checksum: ", "md5 = ", "integrity="]) + quote, some(hexa, rng.choice([32, 40, 64])), quote + " ", False)
        if kind == 1:
            return ("", rng.choice(["id: ", "uuid = ", "request id "]), "-".join(some(hexa, s) for s in (8, 4, 4, 4, 12)), rng.choice(["\n", " "]), False)
        if kind == 2:
            return ("docs/index.html", rng.choice(["see ", "href=", "https://", "at www."]), words(2, ".") + "/" + words(3, "/") + f"/{rng.randint(1, 9999)}", " ", False)
        if kind == 3:
            return ("src7", words(3, " ") + " ", words(rng.randint(3, 5), rng.choice(["_", "-"])) + f"{rng.choice(['_', '-', ''])}{rng.randint(1, 2030)}", " ", False)
        if kind == 4:
            return ("src2", words(2, " ") + rng.choice([" ", "= "]), f"{words(1, '')}-{rng.randint(1, 20)}.{rng.randint(0, 20)}.{rng.randint(0, 99)}-{rng.choice(['alpha', 'beta', 'rc1', 'linux', 'x86_64'])}.tar.gz", " ", False)
        if kind == 5:
            return ("", rng.choice(["published ", "at ", "on "]), f"20{rng.randint(10, 29)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}T{rng.randint(0, 23):02}-{rng.randint(0, 59):02}Z", " ", False)
        if kind == 6:
            return ("test/example.py", rng.choice(["password = ", "token: ", "secret="]) + quote, rng.choice(["example", "changeme", "placeholder", "your-token-here", "xxxxxxxx"]) + rng.choice(["123", "1", "12345", "-000000000"]), quote + "\n", False)
        if kind == 7:
            return ("src1", words(2, " ") + rng.choice([" ", "@"]), f"mail{rng.randint(1, 20)}.{words(2, '.')}.{rng.choice(['com', 'org', 'net'])}", " ", False)
        if kind == 8:  # a sentence about secrets
            return ("src4", words(rng.randint(0, 3), " ") + rng.choice([" password: ", " token: ", " secret = ", " api key: ", ' "token": "']), rng.choice([words(2, ""), words(2, "-"), words(3, "_"), words(1, "") + "ation"])[:30].ljust(8, "s"), " ", False)
        return ("src5", words(2, " ") + " ", f"{words(1, '')}{rng.randint(10, 999)}{words(2, '')}{rng.randint(1, 9)}", rng.choice([" ", ", "]), False)

    def anywhere(finding: tuple) -> tuple:
        """Half of the findings lie in files that tell nothing."""
        return (rng.choice(["", "src1", "src2", "src3", "src5", "src7", "notes.txt"]), *finding[1:]) if rng.random() < 0.5 else finding

    return [anywhere(secret() if i % 2 else plain()) for i in range(n)]


def labelled_findings(spark: SparkSession, seed: int = 11, n: int = 4000) -> DataFrame:
    return spark.createDataFrame(findings_made(seed, n), FINDING)


def train(findings: DataFrame) -> Forest:
    """A forest from a table of labelled findings; rows without a candidate or label are left out."""
    known = findings.select(*FINDING.names).where("candidate <> '' and secret is not null")
    known = known.orderBy(F.xxhash64(*FINDING.names), *FINDING.names).limit(TRAIN_FINDINGS)
    rows = [(r.path or "", r.before or "", r.candidate, r.after or "", r.secret) for r in known.collect()]
    if len({r[4] for r in rows}) < 2:
        raise ValueError("findings of both kinds are needed")
    pairs, words = _log_odds(rows), _word_odds(rows)
    forest = Forest.train(np.array([features(*r[:4], pairs, words) for r in rows]), np.array([float(r[4]) for r in rows]))
    forest.pairs, forest.words = pairs, words
    return forest


def findings_in(texts: list[str | None], paths: list[str | None], forest: Forest) -> list[list[dict]]:
    """The judged candidates of each text."""
    spots = [(i, *c) for i, t in enumerate(texts) for c in candidates(t or "")]
    out: list[list[dict]] = [[] for _ in texts]
    for at in range(0, len(spots), 4096):
        part = spots[at : at + 4096]
        x = np.array([features(paths[i] or "", texts[i][max(0, a - CONTEXT) : a], texts[i][a:b], texts[i][b : b + CONTEXT], forest.pairs, forest.words) for i, a, b, _ in part])
        for (i, a, b, rule), s in zip(part, forest.score(x).tolist()):
            out[i].append({"start": a, "length": b - a, "rule": rule, "score": round(s, 6), "secret": s >= CUTOFF})
    return out


_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("rule", pa.string()), ("score", pa.float64()), ("secret", pa.bool_())]))


def _named(part: pa.RecordBatch, name: str | None) -> list:
    return part.column(part.schema.get_field_index(name)).to_pylist() if name else [None] * part.num_rows


def scan(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = "source", without: tuple[str, ...] = ()) -> DataFrame:
    """``docs``, but not ``without``, with ``findings``: every candidate with its span, rule, score and verdict."""

    def work():
        return lambda part: {"findings": pa.array(findings_in(_named(part, text), _named(part, path), forest), _ARROW)}

    return map_texts(docs, text, RESULT, work, without=without)


def redact(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = "source", size: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by MASK; ``size`` names the column of the text's length."""
    schema = docs.schema
    size = size if size in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                texts = _named(part, text)
                clean = list(texts)
                for i, found in enumerate(findings_in(texts, _named(part, path), forest)):
                    for f in reversed([f for f in found if f["secret"]]):
                        clean[i] = clean[i][: f["start"]] + MASK + clean[i][f["start"] + f["length"] :]
                columns = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                changed = [i for i, (a, b) in enumerate(zip(texts, clean)) if a is not b]
                if changed:
                    columns[text] = pa.array(clean, part.schema.field(text).type)
                    if size:
                        old = columns[size].to_pylist()
                        for i in changed:
                            old[i] = len(clean[i])
                        columns[size] = pa.array(old, part.schema.field(size).type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, schema)
