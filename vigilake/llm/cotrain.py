"""Quality classifier by co-training a text view and a metadata view.

View one is dense statistics of the whole text, view two what is known about the page without reading it
(language, source, stated length and how they go together). Each view has a logistic classifier. In every
round each classifier, fitted on the labelled rows and on what the other one has handed it, scores unlabelled
documents; those it is surest of become pseudo-labels for the other. At the end each view is calibrated on
labelled rows that were never fitted on, and the two calibrated log-odds are combined, each weighted by how
well it separates that holdout.

Fitting uses bounded samples picked by a hash of the document id, at most about `labelled` rows with labels
and `unlabelled` without; statistics are computed on every document's whole text and every document is
scored. The features go to a table in the shared folder, so texts are read once.

Defined cases: null and empty texts have statistics of zero; null metadata is a value of its own; rows of one
id are scored each; contradicting labels of an id count as bad; with labels of one class only (or none)
nothing is learnt and every document has the score of the labels' share (0.5 without labels); an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.session import materialise

HASHED = 24  # hashed metadata values per field
TEXT_FEATURES = (
    "words", "mean_word", "long_words", "short_words", "distinct_words", "top_word", "same_as_before", "repeated_pairs", "capital_letters",
    "capital_words", "digits", "symbols", "marks", "stops", "commas", "odd_ends", "lines", "repeated_lines", "bars", "line_words", "sentence_words",
)
META_FIELDS = ("lang", "source")
ODD = "#*$%&|<>=_~^\\{}[]@+"


def text_statistics(text: str | None) -> list[float]:
    """The text view's features of one text; shares lie in [0, 1], sizes are logarithms."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(TEXT_FEATURES)
    lengths = np.fromiter(map(len, words), np.int64, n)
    letters = int(lengths.sum())
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    count = text.count
    capitals = len(re.findall("[A-ZÀ-ÖØ-Þ]", text))
    odd = sum(map(count, ODD))
    stops = count(".")
    return [
        float(np.log1p(n)),
        letters / n / 10,
        float((lengths > 14).mean()),
        float((lengths < 3).mean()),
        len(seen) / n,
        max(seen.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(zip(words, words[1:]))) / max(1, n - 1),
        capitals / letters,
        sum(w.isupper() for w in words) / n,
        len(re.findall("[0-9]", text)) / letters,
        odd / letters,
        min(1.0, (count("!") + count("?")) / n),
        min(1.0, stops / n),
        min(1.0, count(",") / n),
        sum(not w[-1].isalnum() and w[-1] not in ".,;:" for w in words) / n,
        float(np.log1p(len(lines))),
        1 - len(set(lines)) / len(lines),
        min(1.0, count("|") / n),
        float(np.log1p(n / len(lines))),
        float(np.log1p(n / (stops + 1))),
    ]


def meta_features(values: list, n_chars) -> np.ndarray:
    """The metadata view of one document: hashed fields, their pair, and the stated length."""
    out = np.zeros(HASHED * (len(values) + 1) + 3, np.float32)
    texts = ["\0" if v is None else str(v) for v in values]
    for i, v in enumerate([*texts, "\1".join(texts)]):
        out[HASHED * i + zlib.crc32(v.encode()) % HASHED] = 1
    length = 0.0 if n_chars is None else float(np.log1p(max(0, n_chars)))
    out[-3:] = [length / 10, (length / 10) ** 2, n_chars is None]
    return out


def features(docs: DataFrame, doc: str = "doc_id", text: str = "text", fields: tuple[str, ...] = META_FIELDS, size: str = "n_chars") -> DataFrame:
    """doc_id, a (text view), b (metadata view) as arrays of floats."""
    width = HASHED * (len(fields) + 1) + 3

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            a = np.array([text_statistics(t) for t in batch["text"].to_pylist()], np.float32).reshape(n, len(TEXT_FEATURES))
            meta = zip(*(batch[f"f{i}"].to_pylist() for i in range(len(fields))))
            b = np.array([meta_features(list(v), c) for v, c in zip(meta, batch["size"].to_pylist())], np.float32).reshape(n, width)
            lists = [pa.ListArray.from_arrays(np.arange(0, n * m.shape[1] + 1, m.shape[1], dtype=np.int32), pa.array(m.reshape(-1))) for m in (a, b)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *lists], names=["doc_id", "a", "b"])

    narrow = docs.select(
        F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text"), *[F.col(f).cast("string").alias(f"f{i}") for i, f in enumerate(fields)],
        F.col(size).cast("long").alias("size"),
    )
    return narrow.mapInArrow(run, "doc_id long, a array<float>, b array<float>")


class Logistic:
    """Ridge logistic regression on standardised features by Newton's method, then a calibrated slope and offset."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        self.slope, self.offset, self.weight = 1.0, 0.0, 1.0
        z = self._standard(x)
        self.w = self._newton(z, y.astype(float), np.r_[0.0, np.full(z.shape[1] - 1, ridge)], steps)

    def _standard(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(float) - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((len(z), 1)), z], axis=1)

    @staticmethod
    def _newton(z: np.ndarray, y: np.ndarray, ridge: np.ndarray, steps: int) -> np.ndarray:
        w = np.zeros(z.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(ridge + 1e-6)
            move = np.linalg.solve(hessian, z.T @ (y - p) - ridge * w)
            w += np.clip(move, -5, 5)
            if np.abs(move).max() < 1e-6:
                break
        return w

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._standard(x) @ self.w

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Calibrated log-odds."""
        return self.offset + self.slope * self.raw(x)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Slope and offset on rows that were not fitted on (Platt), and the view's weight: how far it beats chance."""
        raw = np.clip(self.raw(x), -30, 30)
        z = np.stack([np.ones(len(raw)), raw], axis=1)
        # smoothed targets keep a perfect view from infinite odds
        good, bad = y.sum(), len(y) - y.sum()
        target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
        self.offset, self.slope = self._newton(z, target, np.array([1e-3, 1e-3]), 50)
        order = np.argsort(raw, kind="stable")
        ranks = np.empty(len(raw))
        ranks[order] = np.arange(1, len(raw) + 1)
        area = (ranks[y > 0].sum() - good * (good + 1) / 2) / max(1.0, good * bad)
        self.weight = float(max(0.0, 2 * area - 1))


class Model:
    """Two calibrated views; `share` answers when nothing could be learnt."""

    def __init__(self, a: Logistic | None, b: Logistic | None, share: float):
        self.a, self.b, self.share = a, b, share

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Probability of good quality."""
        if self.a is None or self.b is None:
            return np.full(len(a), self.share)
        prior = np.log(self.share / (1 - self.share))
        # evidence of a view is what it adds to the prior
        total = prior + self.a.weight * (self.a.odds(a) - prior) + self.b.weight * (self.b.odds(b) - prior)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def sure(odds: np.ndarray, share: float, per_round: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the surest rows and their pseudo-labels, in the proportion of the labels."""
    good = min(int(per_round * share) + 1, len(odds) // 2)
    bad = min(int(per_round * (1 - share)) + 1, len(odds) // 2)
    order = np.argsort(odds, kind="stable")
    low = order[:bad][odds[order[:bad]] < -1.0]
    high = order[::-1][:good]
    high = high[odds[high] > 1.0]
    return np.concatenate([low, high]), np.concatenate([np.zeros(len(low)), np.ones(len(high))])


def cotrain(a: np.ndarray, b: np.ndarray, y: np.ndarray, ua: np.ndarray, ub: np.ndarray, rounds: int = 4, per_round: int = 400) -> Model:
    """Co-train on labelled rows (a, b, y) and unlabelled rows (ua, ub); every third labelled row is held out for calibration."""
    if not len(y):
        return Model(None, None, 0.5)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    held = np.arange(len(y)) % 3 == 0
    if min(len(set(y[held])), len(set(y[~held]))) < 2:
        return Model(None, None, share)
    fit_y = y[~held]
    own = {"a": a[~held], "b": b[~held]}
    free = {"a": ua, "b": ub}
    extra: dict[str, dict[int, float]] = {"a": {}, "b": {}}  # pseudo-labels that a view has been handed

    def fitted(view: str) -> Logistic:
        at = np.fromiter(extra[view], np.int64, len(extra[view]))
        labels = np.fromiter(extra[view].values(), float, len(at))
        return Logistic(np.concatenate([own[view], free[view][at]]), np.concatenate([fit_y, labels]))

    def calibrated(view: str) -> Logistic:
        model = fitted(view)
        model.calibrate({"a": a, "b": b}[view][held], y[held])
        return model

    for _ in range(rounds if len(ua) else 0):
        models = {v: calibrated(v) for v in ("a", "b")}
        for teacher, pupil in (("a", "b"), ("b", "a")):
            # a view that does not beat chance on the holdout has nothing to teach
            if models[teacher].weight < 0.2:
                continue
            rest = np.setdiff1d(np.arange(len(ua)), np.fromiter(extra[pupil], np.int64, len(extra[pupil])))
            if len(rest):
                at, labels = sure(models[teacher].odds(free[teacher][rest]), share, per_round)
                extra[pupil].update(zip(rest[at].tolist(), labels.tolist()))
    return Model(calibrated("a"), calibrated("b"), share)


def picked(rows: DataFrame, n: int, most: int, seed: int, met=lambda x: x) -> DataFrame:
    """Of `rows` a sample by a hash of the whole row, about `most` (at most twice as many) of the `n` that `met` leaves; equal rows are taken once."""
    every = max(1, n // max(1, most))
    hashed = rows.withColumn("_h", F.xxhash64(*rows.columns, F.lit(seed)))
    return met(hashed.filter(F.pmod("_h", F.lit(every)) == 0)).dropDuplicates(["_h"]).drop("_h")


def fit(rows: DataFrame, labels: DataFrame, labelled: int = 6_000, unlabelled: int = 12_000, rounds: int = 4, found=lambda x: x) -> Model:
    """The model from rows with `doc_id` and labels (doc_id, quality); `found` turns rows into features, after the sampling.

    Samples of bounded size come to the driver, mixed by a hash of the id. They are picked by whole rows, so
    that many rows of one id do not come together.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_known")).agg(F.min("quality").alias("y"))
    columns, same = rows.columns, F.col("_known") == F.col("doc_id")
    n = rows.select("doc_id").join(known, same, "left_semi").count()
    # twice in use, and dealt out by the hash: written once
    some = materialise(picked(rows, n, labelled, 1, lambda x: known.join(x, same)), "labelled")
    truth = {r["_known"]: r["y"] for r in some.select("_known", "y").distinct().toLocalIterator()}
    with_y = found(some.select(*columns)).toArrow()
    free = found(picked(rows, rows.count(), unlabelled, 2, lambda x: x.join(known, same, "left_anti")).select(*columns)).toArrow()

    def matrix(table: pa.Table, column: str) -> np.ndarray:
        flat = table[column].combine_chunks().flatten() if table.num_rows else pa.array([], pa.float32())
        return np.asarray(flat, dtype=np.float32).reshape(table.num_rows, -1 if table.num_rows else 1)

    def mixed(table: pa.Table) -> pa.Table:
        ids = np.asarray(table["doc_id"].combine_chunks().fill_null(-1), dtype=np.int64)
        return table.take(pa.array(np.lexsort((ids, (ids * 2_654_435_761) % 1_000_003))))

    with_y, free = mixed(with_y), mixed(free)
    y = np.array([float(truth[i] >= 1) for i in with_y["doc_id"].to_pylist()])
    return cotrain(matrix(with_y, "a"), matrix(with_y, "b"), y, matrix(free, "a"), matrix(free, "b"), rounds)


def scored(found: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of a feature table."""

    @F.arrow_udf("double")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        n = len(a)
        flat = [np.asarray(x.flatten(), dtype=np.float32).reshape(n, -1) for x in (a, b)]
        return pa.array(model.score(*flat))

    return found.select("doc_id", run("a", "b").alias("score"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """doc_id, score, kept of every row of `docs`."""
    found = materialise(features(docs), "features")
    return scored(found, fit(found, labels)).withColumn("kept", F.col("score") >= cutoff)


def accepted(docs: DataFrame, labels: DataFrame, cutoff: float = 0.5, fields: tuple[str, ...] = META_FIELDS) -> DataFrame:
    """The rows of `docs` that the classifier keeps. Features are taken of the samples to fit, then of each row as it is judged: no join, no table."""
    model = fit(docs.select("doc_id", "text", *fields, "n_chars"), labels, found=features)

    @F.arrow_udf("boolean")
    def run(texts: pa.Array, sizes: pa.Array, *meta: pa.Array) -> pa.Array:
        a = np.array([text_statistics(t) for t in texts.to_pylist()], np.float32).reshape(len(texts), -1)
        values = zip(*(m.to_pylist() for m in meta))
        b = np.array([meta_features(list(v), c) for v, c in zip(values, sizes.to_pylist())], np.float32).reshape(len(texts), -1)
        return pa.array(model.score(a, b) >= cutoff) if len(texts) else pa.array([], pa.bool_())

    return docs.filter(run("text", F.col("n_chars").cast("long"), *[F.col(f).cast("string") for f in fields]))
