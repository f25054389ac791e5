"""Quality scores learned from preference pairs (Bradley-Terry).

A document has a latent score, linear in features of its text. That a good document is preferred to a bad one has the
probability sigmoid(score difference), so the weights are those of a logistic loss on feature differences of pairs. The
cut between good and bad is the quantile of the learned scores at which the share of bad documents lies.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import text_of

#: Labelled rows that the model is fitted on at most (chosen by a hash of doc_id), and pairs drawn from them per good
#: and bad document of the rarer kind. Everything else is computed over all rows.
FIT_ROWS, PAIRS_PER_ROW = 12_000, 24
SEED, RIDGE, STEPS = 11, 1e-3, 60

_BYTES = np.arange(256)
_CLASSES = {
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "space": _BYTES == 32,
    "line": _BYTES == 10,
    "stop": np.isin(_BYTES, [33, 44, 46, 58, 59, 63]),
    "shout": _BYTES == 33,
    "sign": np.isin(_BYTES, list(b"#$%&*+<=>@\\^_`{|}~/")),
    "bar": _BYTES == 124,
    "quote": np.isin(_BYTES, list(b"\"'()[]-")),
    "high": _BYTES >= 128,
    "control": (_BYTES < 32) & (_BYTES != 10),
}
_SHARES = np.stack(list(_CLASSES.values())).astype(np.float64)
FEATURES = [
    *_CLASSES, "log_words", "word_length", "distinct_words", "same_as_last", "top_word", "words_per_line",
    "distinct_lines", "long_words", "signed_words", "upper_words", "words_per_stop", "single_letters", "has_words",
]


def features(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    shares = _SHARES @ counts / max(1, len(raw))
    words = raw.split()
    if not words:
        return [*shares, *[0.0] * (len(FEATURES) - len(_CLASSES))]
    n = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    kinds, times = np.unique(np.fromiter(map(hash, words), dtype=np.int64, count=n), return_counts=True)
    same = sum(a == b for a, b in zip(words, words[1:])) / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    stops = _CLASSES["stop"] @ counts
    return [
        *shares,
        np.log1p(n),
        min(lengths.mean(), 40.0) / 10,
        len(kinds) / n**0.75,
        same,
        times.max() / n,
        np.log1p(n / len(lines)),
        len(set(lines)) / len(lines),
        (lengths > 20).mean(),
        sum(not w[-1:].isalpha() and w[-1] < 128 for w in words) / n,
        sum(w.isupper() for w in words) / n,
        np.log1p(n / (1 + stops)),
        (lengths == 1).mean(),
        1.0,
    ]


@dataclasses.dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def scores(self, found: np.ndarray) -> np.ndarray:
        """0 to 1; 0.5 at the cut."""
        latent = self.latent(found) - self.cut
        return 1 / (1 + np.exp(-np.clip(latent, -500, 500)))

    def latent(self, found: np.ndarray) -> np.ndarray:
        return (np.clip((found - self.mean) / self.scale, -8, 8)) @ self.weights


def fit(found: np.ndarray, good: np.ndarray) -> Model:
    """Weights from preference pairs, by Newton steps on the logistic loss. Without both kinds: weights of zero."""
    width = found.shape[1] if found.ndim == 2 else len(FEATURES)
    if good.all() or not good.any():
        return Model(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    mean, scale = found.mean(axis=0), found.std(axis=0) + 1e-6
    x = np.clip((found - mean) / scale, -8, 8)
    draw = np.random.default_rng(SEED)
    up, down = x[good], x[~good]
    n = PAIRS_PER_ROW * min(len(up), len(down))
    n = max(n, len(up), len(down))
    pairs = up[draw.permutation(n) % len(up)] - down[draw.permutation(n) % len(down)]
    w = np.zeros(width)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(pairs @ w, -500, 500)))  # probability of the wrong order
        slope = pairs.T @ p / n - RIDGE * w
        curve = (pairs * (p * (1 - p))[:, None]).T @ pairs / n + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, slope)
        w = w + step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    latent = x @ w
    return Model(mean, scale, w, _between(latent, float((~good).mean())))


def _between(latent: np.ndarray, share: float) -> float:
    """The quantile at `share`, midway in the gap to the next score."""
    ranked = np.sort(latent)
    at = min(max(round(share * len(ranked)), 1), len(ranked) - 1)
    return float((ranked[at - 1] + ranked[at]) / 2)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on at most `rows` labelled documents that are not held out; only their features come to the driver.

    Labels without doc_id or quality are left out.
    """
    chosen = labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)").where(~is_held_out(F.col("doc_id")))
    chosen = chosen.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    texts = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")  # at most `rows` rows

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"quality": b["quality"], "found": [features(t) for t in b["text"]], "doc_id": b["doc_id"]})

    got = texts.select("doc_id", "quality", "text").mapInPandas(read, "quality int, found array<double>, doc_id long").toPandas()
    if got.empty:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0, dtype=bool))
    got = got.assign(key=[tuple(x) for x in got["found"]]).sort_values(["doc_id", "quality", "key"])
    return fit(np.array(got["found"].tolist()), got["quality"].to_numpy() == 1)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs` (doc_id, text); a missing text counts as empty.

    Only the text is read. Rows without doc_id are not held out. Without labels of both kinds every score is 0.5.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = np.array([features(t) for t in b["text"]]).reshape(-1, len(FEATURES))
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": model.scores(found)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(read, "doc_id long, score double")
    return rows.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_ones(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` that the model does not reject, whole and in order; nothing is shuffled."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
        return pd.Series(model.scores(found))

    return docs.where(score(text_of()) >= 0.5)
