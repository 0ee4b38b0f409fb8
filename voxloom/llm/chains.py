"""Toxicity by a classifier chain.

The categories are predicted one after the other. Each has a linear model over hashed
words and letter sequences; later models also see the probabilities of the categories
before them. For training these come from models of other folds, so that a later
model learns from the errors it will meet.

The models are trained in numpy on a bounded sample of labelled rows; every document
is scored, whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import SPACE, checked, id_hash, utf8, with_columns
from voxloom.session import cut_lineage

#: Labelled rows to train on, of those with and of those without the last category.
MAX_ROWS = 4000
#: Hash slots of the features, those a model uses, and bytes in a letter sequence.
SLOTS = 1 << 16
SELECTED = 200
GRAM = 5
FOLDS = 4
#: Training: steps of Newton's method and the weight of the squared coefficients.
STEPS = 8
PENALTY = 3.0
#: Letters and digits of words: all bytes but ASCII punctuation, controls and space.
_WORD = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def slots_of(text: bytes) -> tuple[np.ndarray, int]:
    """A slot for each word and each letter sequence of a text, and its number of words.

    ASCII letters are lower-cased and words are cut at ASCII punctuation.
    """
    data = np.frombuffer(text.lower(), dtype=np.uint8)
    inside = _WORD[data]
    padded = np.concatenate([[False], inside, [False]])
    change = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = change[::2], change[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.int64), 0
    multiplier = np.uint64(0x100000001B3)
    # Words: a polynomial of their bytes, from sums of bytes times powers by position.
    lengths = ends - starts
    place = np.arange(len(data)) - np.repeat(
        np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]]))
    )
    powers = np.cumprod(np.full(int(lengths.max()), multiplier, dtype=np.uint64))
    terms = np.zeros(len(data), dtype=np.uint64)
    at = np.flatnonzero(inside)
    terms[at] = (data[at].astype(np.uint64) + np.uint64(1)) * powers[place[at]]
    words = np.add.reduceat(terms, starts)
    # Letter sequences: the same inside words, over GRAM bytes.
    n = len(data) - GRAM + 1
    grams = np.empty(0, dtype=np.uint64)
    if n > 0:
        run = np.concatenate([[0], np.cumsum(inside)])
        whole = np.flatnonzero(run[GRAM:] - run[:-GRAM] == GRAM)
        grams = np.full(len(whole), 7, dtype=np.uint64)
        for k in range(GRAM):
            grams = grams * multiplier + data[whole + k]
    mixed = np.concatenate([words, grams])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(48)).astype(np.int64) % SLOTS, len(starts)


def features_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Slots of a text and the roots of their counts per word."""
    slots, words = slots_of(text)
    found, counts = np.unique(slots, return_counts=True)
    return found, np.sqrt(counts / max(1, words))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic regression, the last being the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), PENALTY)
    penalty[-1] = 1e-6
    # The two classes weigh the same.
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    for _ in range(STEPS):
        p = _logistic(x @ w)
        gradient = x.T @ (share * (p - y)) + penalty * w
        curve = (x * (share * p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        w -= np.linalg.solve(curve, gradient)
    return w


@dataclass
class Model:
    """A category's linear model: weights of slots, of earlier categories, constant."""

    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def predict(self, features: tuple[np.ndarray, np.ndarray], before: list[float]) -> float:
        slots, values = features
        score = self.weights[slots] @ values + self.earlier @ np.array(before) + self.constant
        return float(_logistic(np.float64(score)))


def telling_slots(present: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The slots whose presence tells most about a category.

    ``present`` counts, without and with the category, the rows that have each slot, and
    ``n`` all such rows. Of slots that tell as much the smaller come first.
    """
    rate = (present + 0.5) / (np.maximum(n, 1)[:, None] + 1)
    return np.argsort(-((rate[1] - rate[0]) ** 2) / rate.mean(axis=0), kind="stable")[:SELECTED]


def presence(rows: list, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What ``telling_slots`` asks of rows of features and their labels."""
    present = np.zeros((2, SLOTS))
    for (slots, _), label in zip(rows, y, strict=True):
        present[int(label)][slots] += 1
    return present, np.array([(y == k).sum() for k in (0, 1)])


def train_model(rows: list, y: np.ndarray, before: np.ndarray, chosen: np.ndarray) -> Model:
    """Fit the weights of the chosen slots and of the earlier categories."""
    column = np.full(SLOTS, -1)
    column[chosen] = np.arange(len(chosen))
    x = np.zeros((len(rows), len(chosen)))
    for i, (slots, values) in enumerate(rows):
        c = column[slots]
        x[i, c[c >= 0]] = values[c >= 0]
    scale = np.sqrt((x**2).mean(axis=0)) + 1e-9
    w = _fit(np.hstack([x / scale, before]), y)
    weights = np.zeros(SLOTS)
    weights[chosen] = w[: len(chosen)] / scale
    return Model(weights, w[len(chosen) : -1], float(w[-1]))


def train_chain(rows: list, labels: np.ndarray, slots: list | None = None) -> tuple[list[Model], np.ndarray]:
    """Models of the categories, in order, and their out-of-fold probabilities.

    ``rows`` are (slots, values) and ``labels`` has a column of 0 and 1 per category.
    ``slots`` has the chosen slots of each category, for each fold that is left out and
    for all rows; without it they are chosen from the rows.
    """
    fold = np.arange(len(rows)) % FOLDS
    models, held_out = [], np.zeros((len(rows), 0))
    for j, y in enumerate(labels.T):

        def model(train: np.ndarray, left_out: int, j: int = j, y: np.ndarray = y) -> Model:
            some = [rows[i] for i in train]
            chosen = slots[j][left_out] if slots else telling_slots(*presence(some, y[train]))
            return train_model(some, y[train], held_out[train], chosen)

        own = np.zeros(len(rows))
        for k in range(FOLDS):
            train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            if len(train):
                part = model(train, k)
                own[test] = [part.predict(rows[i], held_out[i].tolist()) for i in test]
        models.append(model(np.arange(len(rows)), FOLDS))
        held_out = np.column_stack([held_out, own])
    return models, held_out


def best_threshold(p: np.ndarray, y: np.ndarray, weight: float = 1.0) -> float:
    """The probability, midway between two rows, that gives the best F1 score.

    A row without the category stands for ``weight`` such rows.
    """
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    hits, misses = np.cumsum(y), np.cumsum(1 - y) * weight
    f1 = 2 * hits / (hits + misses + max(1, y.sum()))
    f1[:-1][p[:-1] == p[1:]] = -1
    k = int(np.argmax(f1))
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0)) / 2)


@dataclass
class Chain:
    categories: list[str]
    models: list[Model]
    threshold: float

    def probabilities(self, text: bytes) -> list[float]:
        features, found = features_of(text), []
        for model in self.models:
            found.append(model.predict(features, found))
        return found


def sample_of(labels: DataFrame, id_column: str, categories: dict[str, str], max_rows: int) -> DataFrame:
    """Ids and labels (0 or 1) of at most twice ``max_rows`` rows, the same each time."""
    flags = [F.coalesce(F.expr(e).cast("int"), F.lit(0)).alias(c) for c, e in categories.items()]
    rows = labels.where(F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").alias("id"), *flags
    )
    order = [id_hash("id"), F.col("id")]
    last = list(categories)[-1]
    parts = [rows.where(F.col(last) == k).orderBy(*order).limit(max_rows) for k in (0, 1)]
    return reduce(DataFrame.unionByName, parts)


def _features(rows: pa.Array) -> pa.Array:
    found = [features_of(t) for t in utf8(rows)]
    return _as_structs([(s.astype(np.int32), v.astype(np.float32)) for s, v in found])


def _as_structs(rows: list) -> pa.Array:
    slots = pa.array([s for s, _ in rows], type=pa.list_(pa.int32()))
    return pa.StructArray.from_arrays([slots, pa.array([v for _, v in rows], type=pa.list_(pa.float32()))], names=["slots", "values"])


def _as_rows(structs: pa.Array) -> list:
    pairs = zip(structs.field(0), structs.field(1), strict=True)
    return [(slots.values.to_numpy(), values.values.to_numpy()) for slots, values in pairs]


def _arrow(f, column: str) -> Column:
    f.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(f, "struct<slots: array<int>, values: array<float>>")(F.col(column))


def _chosen_slots(rows: DataFrame, flags: list[str], labels: np.ndarray) -> list[list[np.ndarray]]:
    """For each category the slots to use without each fold, and with all rows.

    Spark counts the rows of each fold that have a slot; the counts are as many as
    folds and slots, however long the texts are.
    """
    counts = (
        rows.select("fold", *flags, F.explode("f.slots").alias("slot"))
        .groupBy("fold", "slot")
        .agg(F.count(F.lit(1)).alias("present"), *(F.sum(c).alias(c) for c in flags))
        .toArrow()
    )
    at = counts.column("fold").to_numpy(), counts.column("slot").to_numpy()
    fold, found = np.arange(len(labels)) % FOLDS, []
    for flag, y in zip(flags, labels.T, strict=True):
        seen = np.zeros((2, FOLDS, SLOTS))
        seen[1][at] = counts.column(flag).to_numpy()
        seen[0][at] = counts.column("present").to_numpy() - seen[1][at]
        n = np.array([[((fold == k) & (y == label)).sum() for k in range(FOLDS)] for label in (0, 1)])
        without = [(seen.sum(axis=1) - seen[:, k], n.sum(axis=1) - n[:, k]) for k in range(FOLDS)]
        found.append([telling_slots(*counted) for counted in [*without, (seen.sum(axis=1), n.sum(axis=1))]])
    return found


def fit(documents: DataFrame, labels: DataFrame, categories: dict[str, str],
        id_column: str = "doc_id", text_column: str = "text", max_rows: int = MAX_ROWS) -> Chain | None:
    """A chain trained on a sample of the labelled documents.

    ``categories`` names each category, in the chain's order, and gives the SQL
    expression of its label, 1 where it holds. The sample has at most ``max_rows``
    rows with the last category and as many without it, chosen by hash, ties by id.
    Rows labelled twice, or whose id several documents have, count each time, up to the
    sample's size in all. Null and empty texts have no features; null labels are 0 and
    null ids have none. None without rows of both kinds, so for empty tables.

    Very long texts are used whole. The driver gets keys and labels of the sample, counts
    by slot, and of the rows' features only those a model uses, so a number of bytes
    that does not depend on the texts.
    """
    checked(documents, id_column, text_column)
    checked(labels, id_column)
    spark = documents.sparkSession
    sample = sample_of(labels, id_column, categories, max_rows)
    flags = [f"c{i}" for i in range(len(categories))]
    found = documents.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text")
    ).join(F.broadcast(sample), "id")
    rows = found.select(
        *(F.col(f"`{c}`").alias(flag) for c, flag in zip(categories, flags, strict=True)),
        id_hash("id", "text").alias("h"),
        F.monotonically_increasing_id().alias("n"),
        _arrow(_features, "text").alias("f"),
    )
    rows = cut_lineage(spark, rows, "toxicity-features")
    # An id that many documents share must not outgrow the sample.
    keys = rows.groupBy("h", *flags).agg(F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"))
    keys = keys.orderBy("h", *flags).limit(2 * max_rows).toArrow()
    copies = np.minimum(keys.column("copies").to_numpy(), 2 * max_rows)
    at = np.repeat(np.arange(len(copies)), copies)[: 2 * max_rows]
    labels_of = np.column_stack([keys.column(c).to_numpy() for c in flags])[at].astype(float)
    if len(set(labels_of[:, -1])) < 2:
        return None
    numbers = keys.column("n").to_numpy()[at]
    picked = spark.createDataFrame(
        pa.table({"n": numbers, "fold": (np.arange(len(at)) % FOLDS).astype(np.int32)})
    )
    slots = _chosen_slots(rows.join(F.broadcast(picked), "n"), flags, labels_of)
    used = np.zeros(SLOTS, dtype=bool)
    used[np.concatenate([s for of_category in slots for s in of_category])] = True

    def narrowed(rows: pa.Array) -> pa.Array:
        return _as_structs([(s[used[s]], v[used[s]]) for s, v in _as_rows(rows)])

    got = rows.join(F.broadcast(picked), "n", "left_semi").select("n", _arrow(narrowed, "f").alias("f")).toArrow()
    features = [row for chunk in got.column("f").chunks for row in _as_rows(chunk)]
    features = dict(zip(got.column("n").to_pylist(), features, strict=True))
    models, held_out = train_chain([features[n] for n in numbers.tolist()], labels_of, slots)
    last = labels_of[:, -1]
    share = labels.agg(F.avg(F.coalesce(F.expr(list(categories.values())[-1]).cast("int"), F.lit(0))))
    # As many rows without the category as the labelled rows have, for each row with it.
    weight = max(1.0, (1 / share.first()[0] - 1) * last.sum() / (1 - last).sum())
    return Chain(list(categories), models, best_threshold(held_out[:, -1], last, weight))


def score(df: DataFrame, chain: Chain | None, text_column: str = "text") -> DataFrame:
    """Add ``p_<category>`` for each category and ``toxic``, the verdict on the last.

    Null and empty texts and those of white space alone are not toxic; nor is anything
    without a chain, where there are no probabilities. Very long texts are judged whole.
    A probability of the threshold itself is toxic. Repeated rows are judged alike. Columns of
    the input with the names of the results are replaced.
    """
    checked(df, text_column)
    if chain is None:
        return with_columns(df, {"toxic": F.lit(False)})
    df = df.withColumn("_llm_p", _probabilities(chain, text_column))
    new = {f"p_{c}": F.get("_llm_p", F.lit(i)) for i, c in enumerate(chain.categories)}
    new["toxic"] = _verdict(F.col("_llm_p"), chain, text_column)
    return with_columns(df, new).drop("_llm_p")


def toxic(df: DataFrame, chain: Chain | None, text_column: str = "text") -> Column:
    """The verdict of ``score`` on each row of ``df``, as a condition."""
    checked(df, text_column)
    if chain is None:
        return F.lit(False)
    return _verdict(_probabilities(chain, text_column), chain, text_column)


def _probabilities(chain: Chain, text_column: str) -> Column:
    def apply(texts: pa.Array) -> pa.Array:
        found = [chain.probabilities(t) for t in utf8(texts)]
        return pa.array(found, type=pa.list_(pa.float64()))

    apply.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "array<double>")(F.col(f"`{text_column}`"))


def _verdict(probabilities: Column, chain: Chain, text_column: str) -> Column:
    has_words = F.coalesce(F.col(f"`{text_column}`").rlike(f"[^{SPACE}]"), F.lit(False))
    last = F.get(probabilities, F.lit(len(chain.categories) - 1))
    return has_words & (last >= chain.threshold)
