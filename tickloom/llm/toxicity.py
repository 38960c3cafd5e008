"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other; the probability of each is a feature of all later models.
For training, those probabilities come from models that did not see the row (``FOLDS`` folds), so later
models learn from the same kind of value that they meet when scoring. Features are counts of hashed words
and of their first letters, and some figures of the whole text (length, lines, share of distinct words, of digits,
marks, capitals and other letters); the models are logistic with an L1 penalty on the former, which leaves
most of those weights at 0.

Training takes a bounded sample of labelled rows (``TRAIN_ROWS`` with and ``TRAIN_ROWS * CLEAN_PER_TOXIC``
without the last category, lowest hash of the id first) in one task; its model of at most ``FEATURES``
weights per category goes to the scoring tasks. Every document is scored over its whole text.

Defined cases: a null text counts as empty; several labels of one document: the worst counts; rows with a
null label or id are not trained on; without both kinds of labels a category has its observed share as a
constant probability (0 when there is no label at all); repeated rows are scored alike; other columns
are kept in ``_rest`` (see ``text.restored``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.text import as_strings, lowered_words, shielded, slices, tidied, tidied_group

TRAIN_ROWS = 3_000
CLEAN_PER_TOXIC = 3
FOLDS = 3
FEATURES = 1 << 18
HEADS = (3, 4, 5, 6)
LEAST_DOCS = 4
PENALTY = 2e-4
STEPS = 80
THRESHOLD = 0.5
#: Bytes of texts that are scored at a time; each distinct word among them is hashed once.
SCORED_BYTES = 12 << 20
#: Features of training texts that are counted at a time.
COUNTED_FEATURES = 1 << 20
#: Columns of ``figures``.
FIGURES = 11
MARKS = ".,;:!?()[]{}\"'*%#$&"


def word_features(word: str) -> list[int]:
    """Hashed features of one word: itself and its first letters."""
    word = word.strip(MARKS)
    parts = {word + "$", *(word[:n] for n in HEADS if len(word) >= n)}
    return [zlib.crc32(p.encode()) % FEATURES for p in parts]


class Words:
    """Words of a batch of texts with the features of its distinct words."""

    def __init__(self, texts: pa.Array):
        self.codes, words, self.starts = lowered_words(texts)
        found = [word_features(w) for w in words.to_pylist()]
        self.ends = np.cumsum([0, *map(len, found)])
        self.features = np.fromiter((f for own in found for f in own), np.int64, int(self.ends[-1]))

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """The sum of the weights of all features in each text."""
        per_word = np.diff(np.concatenate([[0.0], np.cumsum(weights[self.features])])[self.ends])
        running = np.concatenate([[0.0], np.cumsum(per_word[self.codes])])
        return running[self.starts[1:]] - running[self.starts[:-1]]

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, feature and count of each distinct pair; the documents are gone through a few at a time."""
        number = np.diff(self.ends)
        per_doc = np.add.reduceat(np.append(number[self.codes], 0), self.starts[:-1]) if len(self.starts) > 1 else []
        per_doc = np.where(np.diff(self.starts) > 0, per_doc, 0)
        part = np.cumsum(per_doc) // COUNTED_FEATURES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(self.starts) - 1]
        found = [(np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32))]
        for begin, end in zip(edges, edges[1:]):
            codes = self.codes[self.starts[begin]:self.starts[end]]
            lengths = number[codes]
            doc_of = np.repeat(np.arange(begin, end), np.diff(self.starts[begin:end + 1]))
            until = np.cumsum(lengths)
            spots = np.repeat(self.ends[codes] - (until - lengths), lengths) + np.arange(int(lengths.sum()))
            distinct, counts = np.unique(np.repeat(doc_of, lengths) * FEATURES + self.features[spots], return_counts=True)
            found.append(((distinct // FEATURES).astype(np.int32), (distinct % FEATURES).astype(np.int32),
                          counts.astype(np.float32)))
        doc, feature, count = (np.concatenate(column) for column in zip(*found))
        return doc, feature, count


def byte_shares(texts: pa.Array) -> np.ndarray:
    """Shares of digits, marks, capitals, bytes of other letters and line ends among the bytes of each text."""
    kinds = np.zeros((5, 256), bool)
    kinds[0, ord("0"):ord("9") + 1] = True
    kinds[1, [b for b in range(33, 127) if not chr(b).isalnum()]] = True
    kinds[2, ord("A"):ord("Z") + 1] = True
    kinds[3, 128:] = True
    kinds[4, ord("\n")] = True
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    raw, offsets = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
    running, shares = np.zeros(len(raw) + 1, np.int32), []
    for kind in kinds:
        np.cumsum(kind[raw], out=running[1:])
        shares.append((running[offsets[1:]] - running[offsets[:-1]]) / np.maximum(np.diff(offsets), 1))
    return np.column_stack(shares)


def figures(texts: pa.Array, words: Words) -> np.ndarray:
    """Some figures of each text, each of them between 0 and about 2 for ordinary texts."""
    if not len(texts):
        return np.empty((0, FIGURES))
    shares = np.concatenate([byte_shares(own) for own in slices(texts)])
    size, number = np.asarray(pc.binary_length(texts)), np.diff(words.starts)
    doc_of = np.repeat(np.arange(len(number)), number)
    width = int(words.codes.max(initial=0)) + 1
    own = np.unique(doc_of * width + words.codes) // width
    distinct = np.bincount(own, minlength=len(number)) / np.maximum(number, 1)
    return np.column_stack([np.log1p(number) / 5, distinct, size / np.maximum(number, 1) / 10, shares[:, :4],
                            20 * shares[:, 4], distinct ** 2, np.sqrt(shares[:, 0]), np.sqrt(shares[:, 1])])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Sparse rows: document, column and value of each entry, sorted by document, and once more by column.

    Values are counts, kept as 32-bit floats, which hold them exactly; all sums are in double precision.
    """

    def __init__(self, doc: np.ndarray, column: np.ndarray, value: np.ndarray, docs: int, columns: int):
        self.doc, self.column, self.value, self.docs, self.columns = doc, column, value, docs, columns
        self.by_doc = np.flatnonzero(np.diff(doc, prepend=-1))
        order = np.argsort(column, kind="stable")
        self.turned_doc, self.turned_value, column = doc[order], value[order], column[order]
        self.by_column = np.flatnonzero(np.diff(column, prepend=-1))
        self.some_docs, self.some_columns = doc[self.by_doc], column[self.by_column]

    def times(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.docs)
        if len(self.by_doc):
            out[self.some_docs] = np.add.reduceat(self.value * weights[self.column], self.by_doc)
        return out

    def back(self, errors: np.ndarray) -> np.ndarray:
        out = np.zeros(self.columns)
        if len(self.by_column):
            out[self.some_columns] = np.add.reduceat(self.turned_value * errors[self.turned_doc], self.by_column)
        return out

    def only(self, keep: np.ndarray) -> Rows:
        number = (np.cumsum(keep) - 1).astype(np.int32)
        mine = keep[self.doc]
        return Rows(number[self.doc[mine]], self.column[mine], self.value[mine], int(keep.sum()), self.columns)


def fit(rows: Rows, dense: np.ndarray, goal: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of the sparse columns, of the dense ones, and the bias (accelerated proximal steps)."""
    share = goal.mean() if len(goal) else 0.0
    bias0 = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
    if share in (0.0, 1.0):
        return np.zeros(rows.columns), np.zeros(dense.shape[1]), bias0
    n, split = rows.docs, rows.columns
    middle = dense.mean(0)
    dense = dense - middle  # put back into the bias at the end
    square = np.bincount(rows.column, rows.value.astype(np.float64) ** 2, rows.columns) / n
    scale = 1.0 / np.sqrt(np.concatenate([square + 1e-3, (dense ** 2).mean(0) + 1e-6, [1.0]]))
    state = np.zeros(split + dense.shape[1] + 1)
    state[-1] = bias0
    ahead, momentum, step = state.copy(), 1.0, 1.0
    punished = np.ones(len(state))
    punished[split:] = 0.0

    def drawn(w):
        return rows.times((w * scale)[:split]) + dense @ (w * scale)[split:-1] + w[-1] * scale[-1]

    def loss_of(z):
        return np.logaddexp(0, z).mean() - (goal * z).mean()

    z_state = z_ahead = drawn(state)
    for _ in range(STEPS):
        loss = loss_of(z_ahead)
        error = (sigmoid(z_ahead) - goal) / n
        slope = np.concatenate([rows.back(error), error @ dense, [error.sum()]]) * scale
        while True:
            moved = ahead - step * slope
            new = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY * punished, 0)
            change, z_new = new - ahead, drawn(new)
            if loss_of(z_new) <= loss + slope @ change + change @ change / (2 * step) + 1e-12:
                break
            step /= 2
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        push = (momentum - 1) / following
        ahead, z_ahead = new + push * (new - state), z_new + push * (z_new - z_state)  # both are linear
        state, z_state, momentum = new, z_new, following
        step *= 1.3
    whole = state * scale
    return whole[:split], whole[split:-1], float(whole[-1] - middle @ whole[split:-1])


def fold_of(doc_ids: list[int], folds: int) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % folds for i in doc_ids], np.int64)


MODEL_DDL = "category int, bias double, features binary, weights binary, earlier array<double>"


def _train(categories: list[str], folds: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        texts = as_strings(table["text"])
        words = Words(texts)
        told = figures(texts, words)
        doc, feature, count = words.counted()
        docs = np.bincount(feature, minlength=FEATURES)
        common = docs[feature] >= LEAST_DOCS
        kept = np.flatnonzero(docs >= LEAST_DOCS)
        column = (np.cumsum(docs >= LEAST_DOCS) - 1).astype(np.int32)[feature[common]]
        rows = Rows(doc[common], column, count[common], table.num_rows, len(kept))
        del words, doc, feature, count, common, column, texts  # the rows alone are worked on
        fold = fold_of(table["doc_id"].to_pylist(), folds)
        earlier = told
        models = []
        for number, name in enumerate(categories):
            goal = np.asarray(table[name].to_pylist(), np.float64)
            weights, dense, bias = fit(rows, earlier, goal)
            used = weights != 0
            models.append({"category": number, "bias": bias, "features": kept[used].astype("<i8").tobytes(),
                           "weights": weights[used].astype("<f8").tobytes(), "earlier": dense.tolist()})
            if number + 1 < len(categories):
                unseen = np.zeros(table.num_rows)
                for f in range(folds):
                    out = fold == f
                    w, d, b = fit(rows.only(~out), earlier[~out], goal[~out])
                    unseen[out] = sigmoid(rows.times(w) + earlier @ d + b)[out]
                earlier = np.column_stack([earlier, unseen])
        return pa.Table.from_pylist(models, schema=pa.schema([
            ("category", pa.int32()), ("bias", pa.float64()), ("features", pa.binary()),
            ("weights", pa.binary()), ("earlier", pa.list_(pa.float64()))]))
    return run


def training_rows(docs: DataFrame, labels: DataFrame, categories: dict[str, str]) -> DataFrame:
    """The bounded sample: doc_id, text and one 0/1 column per category.

    ``categories`` maps a name to an SQL condition over the labels. At most ``TRAIN_ROWS`` and
    ``TRAIN_ROWS * CLEAN_PER_TOXIC`` labels are broadcast, so documents are not shuffled.
    """
    goals = [F.max(F.expr(condition).cast("int")).alias(name) for name, condition in categories.items()]
    worst = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*goals).dropna()
    last = list(categories)[-1]
    order = F.xxhash64("doc_id")
    toxic = worst.where(F.col(last) == 1).orderBy(order, "doc_id").limit(TRAIN_ROWS)
    clean = worst.where(F.col(last) == 0).orderBy(order, "doc_id").limit(TRAIN_ROWS * CLEAN_PER_TOXIC)
    sample = toxic.unionByName(clean)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"])


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], folds: int = FOLDS) -> list[dict]:
    """The chain's models, one per category."""
    rows = training_rows(docs, labels, categories).withColumn("_all", F.lit(1))
    found = rows.groupBy("_all").applyInArrow(tidied_group(_train(list(categories), folds)), MODEL_DDL).collect()
    models = [None] * len(categories)
    for row in found:
        models[row["category"]] = {
            "bias": row["bias"], "earlier": list(row["earlier"]),
            "features": np.frombuffer(bytes(row["features"]), "<i8"),
            "weights": np.frombuffer(bytes(row["weights"]), "<f8")}
    nothing = {"bias": -30.0, "earlier": [], "features": np.empty(0, np.int64), "weights": np.empty(0)}
    return [m or nothing for m in models]


def score(docs: DataFrame, models: list[dict], names: list[str]) -> DataFrame:
    """``docs`` with the probability of each category as ``p_<name>``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = []
        for model in models:
            weights = np.zeros(FEATURES)
            weights[model["features"]] = model["weights"]
            whole.append(weights)
        for batch in batches:
            found = [np.empty((0, len(names)))]
            for texts in slices(as_strings(batch["text"]), SCORED_BYTES):
                words = Words(texts)
                chain = list(figures(texts, words).T)
                for model, weights in zip(models, whole):
                    z = words.sums(weights) + model["bias"]
                    for factor, earlier in zip(model["earlier"], chain):
                        z = z + factor * earlier
                    chain.append(sigmoid(z))
                found.append(np.column_stack(chain[FIGURES:]))
            for name, p in zip(names, np.concatenate(found).T):
                batch = batch.append_column(f"p_{name}", pa.array(np.ascontiguousarray(p)))
            yield batch
    fields = [T.StructField(f.name, f.dataType) for f in docs.schema]
    fields += [T.StructField(f"p_{name}", T.DoubleType()) for name in names]
    return docs.mapInArrow(tidied(run), T.StructType(fields))


#: The labels' categories in chain order; the last one decides.
CATEGORIES = {"poor": "quality = 0", "toxic": "toxic = 1"}


def classify(docs: DataFrame, labels: DataFrame, categories=None, threshold: float = THRESHOLD) -> DataFrame:
    """``shielded(docs)`` with ``p_<category>`` and ``_rejected``: the last category reaches ``threshold``."""
    categories = categories or CATEGORIES
    names = list(categories)
    docs = shielded(docs, "doc_id", "text")
    scored = score(docs, train(docs, labels, categories), names)
    return scored.withColumn("_rejected", F.col(f"p_{names[-1]}") >= threshold)
