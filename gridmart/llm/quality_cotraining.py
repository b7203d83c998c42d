"""Quality classifier by co-training two views.

The text view sees hashed character trigrams and a few shape statistics; the
metadata view sees language, source and length only. Each is a logistic
regression. In every round each view labels the unlabelled documents that it is
calibrated to be confident about, and both are fitted again on the labels and on
what the other view handed over. At the end each view is calibrated on held-out
labels, and the two log-odds are added (their common prior counted once) to
score all documents.

Fitting is on bounded samples, chosen by a hash of the key: ``max_labelled``
labelled and ``max_pool`` unlabelled documents, one row of each key, whose features
(not texts) reach the driver. Scoring covers every document, whole texts, in one pass without a
shuffle.

Edge cases: null or empty text has only zero features, null metadata its own
category; a document with several labels counts once, as bad if any says so;
null labels are ignored; without labels of both kinds every document scores the
prior (1 if there is none) and is kept; repeated rows score alike; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridmart.llm.common import one_per_key

#: Documented bounds of the fitting samples (rows).
MAX_LABELLED = 3000
MAX_POOL = 3000
ROUNDS = 3
#: A pseudo-label needs this calibrated probability (or one minus it).
CONFIDENT = 0.95
REJECT_BELOW = 0.5

TRIGRAMS = 256
_STATS = 8
META = 128
_CHUNK = 1 << 20
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>!=~^_{}\\/@", np.uint8))
_BLANK = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))


def text_features(text: str | None) -> np.ndarray:
    """Trigram frequencies (hashed, square-rooted) and shape statistics of a whole text."""
    out = np.zeros(TRIGRAMS + _STATS, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return out
    counts = np.zeros(TRIGRAMS, np.int64)
    for i in range(0, max(len(data) - 2, 0), _CHUNK):
        part = data[i:i + _CHUNK + 2].astype(np.uint32)
        code = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761)
        counts += np.bincount(code >> np.uint32(24), minlength=TRIGRAMS)
    out[:TRIGRAMS] = np.sqrt(counts / max(counts.sum(), 1))
    hist = np.bincount(data, minlength=256)
    ws = text.split()
    n = max(len(ws), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = max(int(hist[65:91].sum() + hist[97:123].sum()), 1)
    out[TRIGRAMS:] = [
        min(hist[_SYMBOL].sum() / n, 4.0),
        hist[65:91].sum() / letters,
        min(sum(map(len, ws)) / n / 10, 3.0),
        1 - len(set(ws)) / n,
        sum(a == b for a, b in zip(ws, ws[1:])) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        min(np.log1p(n) / 10, 2.0),
        1.0 if n < 10 else 0.0,
    ]
    return out


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """One-hot language, source (hashed) and length band."""
    out = np.zeros(META, np.float32)
    out[crc32(f"lang={lang}".encode("utf-8", "surrogatepass")) % 32] = 1
    out[32 + crc32(f"source={source}".encode("utf-8", "surrogatepass")) % 64] = 1
    band = 0 if n_chars is None else 1 + min(int(np.log2(max(n_chars, 0) + 1)), 30)
    out[96 + band] = 1
    return out


@dataclass
class Logistic:
    """L2-regularised logistic regression by Newton steps, with Platt calibration."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    scale: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 8) -> "Logistic":
        x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
        w = np.zeros(x.shape[1])
        ridge = np.full(len(w), l2)
        ridge[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - y) + ridge * w
            s = np.maximum(p * (1 - p), 1e-6)
            w = w - np.linalg.solve((x * s[:, None]).T @ x + np.diag(ridge), grad)
        return Logistic(w)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights[:-1] + self.weights[-1]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> "Logistic":
        """Platt scaling on held-out rows, with the usual smoothed targets."""
        pos, neg = float(y.sum()), float(len(y) - y.sum())
        if not pos or not neg:
            return self
        target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
        platt = Logistic.fit(self.raw(x)[:, None], target, l2=1e-3, steps=25)
        self.scale, self.shift = float(platt.weights[0]), float(platt.weights[1])
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.scale * self.raw(x) + self.shift, -12, 12)


@dataclass
class CoTrained:
    """The two calibrated views; ``text`` is None where no fit was possible."""

    text: Logistic | None
    meta: Logistic | None
    prior: float  # log-odds
    handed_over: list = field(default_factory=list)  # per round: pseudo-labels from text, from metadata

    def scores(self, xt: np.ndarray, xm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality by the text view, the metadata view and both."""
        if self.text is None:
            p = np.full(len(xt), 1 / (1 + np.exp(-self.prior)))
            return p, p, p
        t, m = self.text.logit(xt), self.meta.logit(xm)
        return tuple(1 / (1 + np.exp(-z)) for z in (t, m, t + m - self.prior))

    def keeps(self, both: np.ndarray) -> np.ndarray:
        """Where the score of both views keeps a document; everywhere without a fit."""
        return (both >= REJECT_BELOW) | (self.text is None)


def co_train(xt: np.ndarray, xm: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = ROUNDS,
             confident: float = CONFIDENT) -> CoTrained:
    """Fit on rows with ``y`` 0 or 1 (``held`` ones calibrate only); -1 marks the pool."""
    known = y >= 0
    good = float((y == 1).sum())
    total = float(known.sum())
    prior = float(np.log((good + 1) / (total - good + 1))) if total else 12.0
    train, hold = known & ~held, known & held
    if len(set(y[train])) < 2 or len(set(y[hold])) < 2:
        return CoTrained(None, None, prior)
    pool = np.flatnonzero(y < 0)
    given = {"text": np.full(len(y), -1), "meta": np.full(len(y), -1)}  # labels for that view
    bound = np.log(confident / (1 - confident))
    log = []
    for r in range(rounds + 1):
        views = {}
        for name, x in (("text", xt), ("meta", xm)):
            label = np.where(train, y, given[name])
            use = label >= 0
            views[name] = Logistic.fit(x[use], label[use]).calibrate(x[hold], y[hold])
        if r == rounds:
            break
        moved = []
        for name, other, x in (("text", "meta", xt), ("meta", "text", xm)):
            z = views[name].logit(x[pool])
            sure = pool[np.abs(z) >= bound]
            given[other][pool] = -1
            given[other][sure] = (z[np.abs(z) >= bound] > 0).astype(int)
            moved.append(len(sure))
        log.append(tuple(moved))
    return CoTrained(views["text"], views["meta"], prior, log)


def _feature_columns(docs: DataFrame, text: str, lang: str, source: str, length: str) -> list:
    return [F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
            F.col(source).cast("string").alias("source"), F.col(length).cast("long").alias("n_chars")]


def _matrices(texts: list, langs: list, sources: list, lengths: list) -> tuple[np.ndarray, np.ndarray]:
    return (np.array([text_features(t) for t in texts], np.float32).reshape(-1, TRIGRAMS + _STATS),
            np.array([meta_features(*m) for m in zip(langs, sources, lengths)], np.float32).reshape(-1, META))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL,
        rounds: int = ROUNDS, key: str = "doc_id", text: str = "text", lang: str = "lang",
        source: str = "source", length: str = "n_chars") -> CoTrained:
    """Co-train on bounded samples of the labelled and the unlabelled documents."""
    truth = (labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.min("quality").cast("int").alias("quality")))
    order = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 20))
    n_truth, n_docs = truth.count(), docs.count()

    def share(bound: int, n: int) -> int:  # a little under the bound, as hashes scatter
        return 1 << 20 if n <= bound else int((1 << 20) * 0.95 * bound / n)

    # At most about max_labelled rows of two numbers.
    sample = truth.where(order < share(max_labelled, n_truth))
    rows = docs.select(F.col(key).alias("doc_id"), *_feature_columns(docs, text, lang, source, length))
    marked = rows.join(F.broadcast(sample), "doc_id", "left")
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(13)), F.lit(4)) == 0
    chosen = marked.where(F.col("quality").isNotNull() | (order < share(max_pool, n_docs)))
    chosen = chosen.select(
        "doc_id", F.coalesce("quality", F.lit(-1)).alias("y"), fold.alias("held"), "text", "lang", "source", "n_chars",
        F.xxhash64("text", "lang", "source", "n_chars").alias("__mark"))

    def features(b: pa.RecordBatch) -> list[tuple]:
        xt, xm = _matrices(*[b.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars")])
        return list(zip(b.column("y").to_pylist(), b.column("held").to_pylist(),
                        [x.tobytes() for x in xt], [x.tobytes() for x in xm]))

    schema = T.StructType([T.StructField("y", T.IntegerType()), T.StructField("held", T.BooleanType()),
                           T.StructField("xt", T.BinaryType()), T.StructField("xm", T.BinaryType())])
    got = one_per_key(chosen, features, "doc_id", schema).toArrow()
    # A fixed row order makes the fit the same on every run.
    rows_ = sorted(zip(got["y"].to_pylist(), got["held"].to_pylist(), got["xt"].to_pylist(), got["xm"].to_pylist()),
                   key=lambda r: (r[2], r[3], r[0], bool(r[1])))
    load = lambda i, width: np.frombuffer(b"".join(r[i] for r in rows_), np.float32).reshape(-1, width)
    y = np.array([r[0] for r in rows_], int)
    held = np.array([bool(r[1]) for r in rows_], bool)
    return co_train(load(2, TRIGRAMS + _STATS), load(3, META), y, held, rounds)


def score(docs: DataFrame, model: CoTrained, key: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source", length: str = "n_chars") -> DataFrame:
    """``doc_id, text_score, meta_score, score, kept`` for every row."""
    schema = T.StructType([T.StructField("doc_id", docs.schema[key].dataType)] + [
        T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score")
    ] + [T.StructField("kept", T.BooleanType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t, m, both = sent.value.scores(
                *_matrices(*[b.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars")]))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(x.astype(np.float64)) for x in (t, m, both)],
                 pa.array(sent.value.keeps(both))], names=schema.names)

    return docs.select(F.col(key).alias("doc_id"), *_feature_columns(docs, text, lang, source, length)
                       ).mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: CoTrained, text: str = "text", lang: str = "lang",
              source: str = "source", length: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` that the model keeps, columns unchanged, without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = [docs.columns.index(c) for c in (text, lang, source, length)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, both = sent.value.scores(*_matrices(*[b.column(i).to_pylist() for i in at]))
            yield b.filter(pa.array(sent.value.keeps(both)))

    return docs.mapInArrow(run, docs.schema)
