"""Toxic spans by a linear-chain conditional random field.

Labels name whole documents, the field tags tokens.  Token labels come from the
labelled sample itself: a feature (a word or the beginning of one) that toxic
documents hold far more often than clean ones is a seed, and the tokens of toxic
documents that carry a seed count as toxic, all others as not.  A two-state
linear chain over feature weights and transitions is fitted to these tokens by
its exact gradient (forward-backward), so weights spread to features the seeds do
not name and neighbours count.  Scoring takes the forward-backward marginal of
every token; expected number, density and largest marginal of a document go
through a logistic regression fitted on labelled documents the field has not
seen (near copies of the sample count once), and tokens of at least one half are reported with their offsets.

The labelled sample is bounded: ``TOXIC`` and ``CLEAN`` documents of at most
``LONGEST`` characters, chosen by a hash of the id.  Everything else covers whole
texts of all documents.

Defined cases: a NULL text is empty (a score like any other text without
tokens); labels that are NULL or contradict each other are left out; a NULL id
is not held out and has no label; repeated rows each get their row; without
labels of both kinds every score is the share of toxic ones (0 without labels);
an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of the labelled sample.
TOXIC, CLEAN, LONGEST = 1500, 3000, 10_000
#: A seed: held by this many toxic documents, with this many standard errors
#: between the shares of toxic and clean ones, and with this many times as many
#: tokens a document (of one document at most ``MOST_TOKENS`` count).
SEED_DOCS, SEED_Z, SEED_RATIO, MOST_TOKENS = 5, 4.0, 6.0, 4
#: Features of the field: at least this support, at most so many.
FEATURE_DOCS, FEATURE_Z, FEATURES = 3, 2.0, 20_000
#: Tokens of one training sequence.
SEQUENCE = 32
OFFENDING = 0.5
_TOKEN = re.compile(r"[^\W_]+")
_BEGINNINGS = (3, 4, 5, 6)
#: Words whose odds a worker remembers.
CACHE_WORDS, CACHE_LENGTH = 200_000, 32


def features(word: str) -> list[str]:
    """Features of a lower-case word: itself and its beginnings."""
    return ["=" + word[:64], *[word[:k] for k in _BEGINNINGS if len(word) >= k]]


@dataclass
class Model:
    """Weights of the field (state toxic against not), its transitions and the
    document regression."""
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    enter: float = 0.0      # not -> toxic
    leave: float = 0.0      # toxic -> not
    stay: float = 0.0       # toxic -> toxic
    document: tuple[float, ...] = ()
    prior: float = 0.0

    def odds(self, word: str) -> float:
        """Exponential of a token's own score."""
        w = self.weights
        total = self.bias + sum(w[f] for f in features(word.lower()) if f in w)
        return math.exp(min(30.0, max(-30.0, total)))

    def score(self, marginals: list[float]) -> float:
        if not self.document:
            return self.prior
        z = sum(a * b for a, b in zip(self.document, summary(marginals)))
        return 1 / (1 + math.exp(-min(500.0, max(-500.0, z))))


def marginals(odds: list[float], enter: float, leave: float, stay: float) -> list[float]:
    """Probability of the toxic state at every token: forward and backward
    ratios of the two states."""
    b, c, a = math.exp(enter), math.exp(leave), math.exp(stay)
    forward, r = [], None
    for e in odds:
        r = e if r is None else e * (r * a + b) / (r * c + 1)
        forward.append(r)
    out, x = [0.0] * len(odds), None
    for t in range(len(odds) - 1, -1, -1):
        s = 1.0 if x is None else (c + a * x) / (1 + b * x)
        o = forward[t] * s
        out[t] = o / (1 + o)
        x = odds[t] * s
    return out


def summary(probabilities: list[float]) -> tuple[float, ...]:
    """What the document regression sees."""
    expected = sum(probabilities) + 0.01
    return (1.0, math.log(expected), math.log(expected / (len(probabilities) + 20)), max(probabilities, default=0.0))


# ---- fitting ---------------------------------------------------------------------


def without_copies(texts: list[tuple[list[str], int]], minima: int = 16) -> list[tuple[list[str], int]]:
    """The sample without near copies: a text that has half of its word minima
    in common with an earlier one is left out.  Otherwise the chance words of a
    text that was copied many times would pass for evidence."""
    rng = np.random.default_rng(7)
    times = rng.integers(1, 2 ** 32, (minima, 1), dtype=np.uint64) | np.uint64(1)
    seen: dict[tuple[int, int], list[int]] = {}
    kept = []
    for words, label in texts:
        codes = np.array([zlib.crc32(w.encode()) for w in set(words)], dtype=np.uint64)
        if len(codes):
            least = [*enumerate(((times * codes) & np.uint64(0xFFFFFFFF)).min(axis=1).tolist())]
            common = Counter(i for key in least for i in seen.get(key, ()))
            if common and max(common.values()) >= minima // 2:
                continue
            for key in least:
                seen.setdefault(key, []).append(len(kept))
        kept.append((words, label))
    return kept


def _feature_counts(documents: list[list[str]]) -> tuple[Counter, Counter]:
    """Documents that hold each feature, and its tokens, of one document at most
    ``MOST_TOKENS``."""
    held: Counter = Counter()
    tokens: Counter = Counter()
    for words in documents:
        own: Counter = Counter()
        for w, n in Counter(words).items():
            for f in features(w):
                own[f] += n
        held.update(own.keys())
        tokens.update({f: min(n, MOST_TOKENS) for f, n in own.items()})
    return held, tokens


def choose(toxic: list[list[str]], clean: list[list[str]]) -> tuple[set[str], list[str]]:
    """Seeds, and the features of the field in order of their evidence."""
    (held, often), (other, rarely) = _feature_counts(toxic), _feature_counts(clean)
    n, m = len(toxic), len(clean)
    seeds, scored = set(), []
    for f, a in held.items():
        if a < FEATURE_DOCS:
            continue
        b = other.get(f, 0)
        share = (a + b) / (n + m)
        z = (a / n - b / m) / math.sqrt(max(share * (1 - share), 1e-9) * (1 / n + 1 / m))
        ratio = (often[f] + .5) / (n + 1) / ((rarely.get(f, 0) + .5) / (m + 1))
        if a >= SEED_DOCS and z >= SEED_Z and ratio >= SEED_RATIO:
            seeds.add(f)
        if z >= FEATURE_Z:
            scored.append((-z, f))
    return seeds, [f for _, f in sorted(scored)[:FEATURES]]


def fit_field(toxic: list[list[str]], clean: list[list[str]], steps: int = 60, rate: float = 0.5,
              penalty: float = 1.0) -> Model:
    """The field's weights by full-batch adaptive gradient steps on the exact
    log-likelihood of the token labels."""
    seeds, names = choose(toxic, clean)
    index = {f: i for i, f in enumerate(names)}
    ids: dict[str, list[int]] = {}
    token, feature, label, lengths = [], [], [], []
    total = 0
    for words, is_toxic in [*((w, True) for w in toxic), *((w, False) for w in clean)]:
        for at in range(0, len(words), SEQUENCE):
            part = words[at:at + SEQUENCE]
            lengths.append(len(part))
            for w in part:
                own = ids.get(w)
                if own is None:
                    own = ids[w] = [index[f] for f in features(w) if f in index]
                if own:
                    feature += own
                    token += [total] * len(own)
                label.append(is_toxic and any(names[i] in seeds for i in own))
                total += 1
    if not total:
        return Model()
    token, feature = np.array(token, dtype=np.int64), np.array(feature, dtype=np.int64)
    lengths = np.array(lengths)
    # tokens of all sequences, place by place: sequence s, place t
    place = np.full((len(lengths), SEQUENCE), total)
    inside = np.arange(SEQUENCE) < lengths[:, None]
    place[inside] = np.arange(total)
    y = np.append(np.array(label, dtype=float), 0.0)
    observed = np.array([np.sum(inside[:, 1:] * (1 - y[place[:, :-1]]) * y[place[:, 1:]]),
                         np.sum(inside[:, 1:] * y[place[:, :-1]] * (1 - y[place[:, 1:]])),
                         np.sum(inside[:, 1:] * y[place[:, :-1]] * y[place[:, 1:]])])
    w, extra = np.zeros(len(names)), np.array([-3.0, 0.0, 0.0, 0.0])      # bias, enter, leave, stay
    gw, ge = np.full(len(names), 1e-6), np.full(4, 1e-6)
    for _ in range(steps):
        u = np.bincount(token, weights=w[feature], minlength=total + 1) + extra[0]
        p, pairs = _expected(np.clip(u, -30, 30)[place], inside, np.exp(extra[1:]))
        flat = np.zeros(total + 1)
        flat[place[inside]] = p[inside]
        rest = y - flat
        rest[total] = 0
        grad = np.bincount(feature, weights=rest[token], minlength=len(names)) - penalty * w
        more = np.append(rest.sum(), observed - pairs)
        gw += grad * grad
        ge += more * more
        w += rate * grad / np.sqrt(gw)
        extra += rate * more / np.sqrt(ge)
    return Model({f: float(x) for f, x in zip(names, w) if abs(x) > 1e-3}, *map(float, extra))


def _expected(u: np.ndarray, inside: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of all sequences, and the expected numbers of the moves
    not -> toxic, toxic -> not, toxic -> toxic."""
    b, c, a = moves
    e = np.exp(u)
    n, length = u.shape
    forward, back = np.empty_like(u), np.ones_like(u)
    forward[:, 0] = e[:, 0]
    for t in range(1, length):
        r = forward[:, t - 1]
        forward[:, t] = e[:, t] * (r * a + b) / (r * c + 1)
    for t in range(length - 2, -1, -1):
        x = e[:, t + 1] * back[:, t + 1]
        back[:, t] = np.where(inside[:, t + 1], (c + a * x) / (1 + b * x), 1.0)
    odds = forward * back
    p = np.where(inside, odds / (1 + odds), 0.0)
    r, x = forward[:, :-1], e[:, 1:] * back[:, 1:]
    whole = 1 + b * x + c * r + a * r * x
    pair = inside[:, 1:] / whole
    return p, np.array([np.sum(pair * b * x), np.sum(pair * c * r), np.sum(pair * a * r * x)])


def fit_documents(rows: list[tuple[float, ...]], labels: list[int], penalty: float = 0.05, steps: int = 40) -> tuple[float, ...]:
    """Logistic regression by Newton steps, damped by a ridge."""
    x, y = np.array(rows), np.array(labels, dtype=float)
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-6, *[penalty] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def fit(sample: list[tuple[str, int]]) -> Model:
    """The model of (text, label) rows; two thirds fit the field, the rest the
    document regression."""
    texts = [([w.lower() for w in _TOKEN.findall(t or "")], y) for t, y in sample]
    prior = sum(y for _, y in texts) / len(texts) if texts else 0.0
    texts = without_copies(texts)
    halves: dict[int, list[list[list[str]]]] = {0: [[], []], 1: [[], []]}
    for k in (0, 1):
        for i, words in enumerate(w for w, y in texts if y == k):
            halves[k][i % 3 == 2].append(words)
    if not all(halves[k][h] for k in (0, 1) for h in (0, 1)):
        return Model(prior=prior)
    model = fit_field(halves[1][0], halves[0][0])
    model.prior = prior
    known: dict[str, float] = {}
    rows, labels = [], []
    for k in (0, 1):
        for words in halves[k][1]:
            for w in words:
                if w not in known:
                    known[w] = model.odds(w)
            rows.append(summary(marginals([known[w] for w in words], model.enter, model.leave, model.stay)))
            labels.append(k)
    model.document = fit_documents(rows, labels)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, *, toxic: int = TOXIC, clean: int = CLEAN,
                    longest: int = LONGEST) -> list[tuple[str, int]]:
    """The bounded sample of (text, label) rows to learn from: of each kind the
    first by a hash of the id.  ``docs`` has ``id`` and ``text``, ``labels`` has
    ``id`` and ``toxic``."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most")).filter("toxic = _most")
    order = lambda: (F.xxhash64(F.col("id").cast("string")), F.col("id"))
    chosen = (known.filter("toxic = 1").orderBy(*order()).limit(toxic)
              .union(known.filter("toxic = 0").orderBy(*order()).limit(clean)))
    chosen = chosen.select(F.col("id").alias("label_id"), "toxic")
    # at most toxic + clean rows are broadcast
    rows = (docs.select("id", "text").filter(F.col("text").isNotNull() & (F.length("text") <= longest))
            .join(F.broadcast(chosen), F.col("id") == F.col("label_id")))
    rows = rows.orderBy(*order(), "text").limit(toxic + clean).select("text", "toxic")
    return [(r.text, r.toxic) for r in rows.collect()]


# ---- scoring ---------------------------------------------------------------------


def tagger(model: Model):
    """text -> (score, [(start, end)] of offending tokens in code points)."""
    known: dict[str, float] = {}

    def tag(text: str | None) -> tuple[float, list[tuple[int, int]]]:
        words = _TOKEN.findall(text or "")
        odds = []
        for w in words:
            o = known.get(w)
            if o is None:
                o = model.odds(w)
                if len(known) >= CACHE_WORDS:
                    known.clear()
                if len(w) <= CACHE_LENGTH:
                    known[w] = o
            odds.append(o)
        p = marginals(odds, model.enter, model.leave, model.stay)
        spans = []
        if p and max(p) >= OFFENDING:
            spans = [m.span() for m, q in zip(_TOKEN.finditer(text), p) if q >= OFFENDING]
        return model.score(p), spans

    return tag


_SCORED = "score double, n_offending long, spans string"


def score(docs: DataFrame, model: Model, *, threshold: float = 0.7) -> DataFrame:
    """``id, held_out, score, predicted, n_offending, spans`` of every row of
    ``docs`` (``id``, ``text``); ``spans`` lists start:end of the offending tokens
    (code points, end exclusive)."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = tagger(model)
        for batch in batches:
            rows = [tag(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("id")), pa.array([s for s, _ in rows], pa.float64()),
                 pa.array([len(x) for _, x in rows], pa.int64()),
                 pa.array([",".join(f"{a}:{b}" for a, b in x) for _, x in rows], pa.string())],
                names=["id", "score", "n_offending", "spans"])

    kind = docs.schema["id"].dataType.simpleString()
    out = docs.select("id", "text").mapInArrow(scored, f"id {kind}, {_SCORED}")
    return out.select("id", held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "n_offending", "spans")
