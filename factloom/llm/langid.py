"""Language identification with a string kernel.

The kernel is the blended-spectrum presence kernel: how many n-grams (n = 1, 2, 3) of lowered letters, with runs of
anything else as one blank, two texts share, divided by the root of how many each has; n-grams that no landmark has are
left out of both. N-grams of all scripts are hashed to ``2 ** SLOTS`` places. ``landmarks`` texts give the Nyström map;
kernel ridge regression, one language against the rest, is fitted in that space. A batch of texts is scored by a matrix
product of its presence matrix with the landmarks' and another with the regression's coefficients.

The classifier is fitted on a bounded sample of labelled rows: at most ``per_language`` rows of each label, those with the
least hash of the id, then of the text. Every label is learned. Predictions read whole texts and nothing else.

A letter is a code point of Unicode's categories L. A text that is null or has no letter is ``und`` with score 0; so is
everything if there is nothing to learn from. A null label is not learned; a null id counts as an empty one. Rows that
repeat id and text are one row of the sample; each row is judged by itself. Ties of scores go to the label that sorts
first. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PER_LANGUAGE, LANDMARKS, RIDGE = 150, 64, 1e-3
FOLDS, HELD_OUT = 4, 2
SLOTS = 22
#: Texts scored by one matrix product.
BLOCK = 64


def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams(text: str) -> np.ndarray:
    """Places of all n-grams of a text; n is part of what is hashed."""
    x = _points(text)
    x = np.where(_is_letter()[x], x, 0).astype(np.uint64)
    x = np.concatenate([[0], x, [0]]).astype(np.uint64)
    x = x[np.r_[True, (x[1:] > 0) | (x[:-1] > 0)]]  # a run of blanks is one
    with np.errstate(over="ignore"):
        one = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        two = (one[:-1] ^ (one[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + one[1:]
        three = (two[:-1] ^ (two[:-1] >> np.uint64(31))) * np.uint64(0x94D049BB133111EB) + one[2:]
        every = np.concatenate([one, two ^ np.uint64(0x5851F42D4C957F2D), three ^ np.uint64(0x14057B7EF767814F)])
        every = (every ^ (every >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (every >> np.uint64(64 - SLOTS)).astype(np.int64)


def _places(text: str | np.ndarray) -> np.ndarray:
    return text if isinstance(text, np.ndarray) else grams(text)


class KernelRidge:
    """``texts``: texts, or the places of their n-grams."""

    def __init__(self, texts: list[str | np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE):
        self.labels = sorted(set(labels))
        pick: list[int] = []  # landmarks: the languages in turn
        by = {l: [i for i, x in enumerate(labels) if x == l] for l in self.labels}
        for rank in range(max(map(len, by.values()))):
            pick += [by[l][rank] for l in self.labels if rank < len(by[l])]
        pick = pick[: max(landmarks, len(self.labels))]
        vocabulary = np.unique(np.concatenate([_places(texts[i]) for i in pick]))
        self.width = len(vocabulary)
        self.column = np.full(1 << SLOTS, self.width, np.int32)
        self.column[vocabulary] = np.arange(self.width)
        marks = self.presence([texts[i] for i in pick])
        self.marks = (marks / np.sqrt(np.maximum(marks.sum(axis=1, keepdims=True), 1))).T.copy()
        values, vectors = np.linalg.eigh(self.marks.T.astype(np.float64) @ self.marks)
        ok = values > 1e-8 * values.max()
        root = vectors[:, ok] / np.sqrt(values[ok])
        z = np.vstack([self.kernel(texts[i : i + BLOCK]) for i in range(0, len(texts), BLOCK)]).astype(np.float64) @ root
        z = np.hstack([z, np.ones((len(z), 1))])
        y = np.array([[1.0 if l == m else -1.0 for m in self.labels] for l in labels])
        beta = np.linalg.solve(z.T @ z + ridge * len(z) * np.eye(z.shape[1]), z.T @ y)
        self.coefficients, self.bias = (root @ beta[:-1]).astype(np.float32), beta[-1].astype(np.float32)

    def presence(self, texts: list[str]) -> np.ndarray:
        p = np.zeros((len(texts), self.width + 1), np.float32)
        for i, t in enumerate(texts):
            p[i, self.column[_places(t)]] = 1
        return p[:, :-1]

    def kernel(self, texts: list[str]) -> np.ndarray:
        p = self.presence(texts)
        return (p @ self.marks) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.coefficients + self.bias


def sample(docs: DataFrame, id_col: str, text_col: str, label_col: str, per_language: int) -> DataFrame:
    """(label, k, text) of the bounded sample. Only hashes compete for a place; texts are read for those that won."""
    rows = docs.where(~held_out(F.col(id_col)) & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(label_col).cast("string").alias("label"), F.struct(F.xxhash64(F.lit(4), F.col(id_col)).alias("a"), F.xxhash64(F.lit(5), F.col(text_col)).alias("b")).alias("k"), F.col(text_col).alias("text"))
    # A few buckets per label first, so that a label with most of the rows is not one task's.
    keyed = rows.select("label", "k").withColumn("bucket", F.pmod(F.col("k.a"), F.lit(64)))
    few = keyed.withColumn("r", F.dense_rank().over(Window.partitionBy("label", "bucket").orderBy("k"))).where(F.col("r") <= per_language).select("label", "k").distinct()
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("k"))).where(F.col("r") <= per_language)
    most = few.groupBy("label").agg(F.max("k").alias("top"))
    return rows.join(F.broadcast(most), "label").where(F.col("k") <= F.col("top")).groupBy("label", "k").agg(F.first("text").alias("text"))


def learned(won: DataFrame) -> list[tuple[np.ndarray, str]]:
    """(places of n-grams, label) of the sample's texts with a letter. Executors read the texts; the driver gets distinct places,
    ``2 ** SLOTS`` of a text at most, however long it is."""

    def run(batches):
        for batch in batches:
            for i, t in enumerate(batch.column(3).to_pylist()):
                if has_letter(t):
                    places = np.unique(grams(t)).astype(np.int32).tobytes()
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in range(3)), pa.array([places], pa.binary())], names=["label", "a", "b", "places"])

    rows = won.select("label", "k.a", "k.b", "text").mapInArrow(run, "label string, a long, b long, places binary").collect()
    return [(np.frombuffer(r.places, np.int32), r.label) for r in sorted(rows, key=lambda r: (r.a, r.b, r.label))]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> DataFrame:
    """(id_col, held_out, lang_pred, score) for each row."""
    spark = docs.sparkSession
    got = learned(sample(docs, id_col, text_col, label_col, per_language))
    model = spark.sparkContext.broadcast(KernelRidge([t for t, _ in got], [l for _, l in got], landmarks) if got else None)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches):
        m = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                texts = [t or "" for t in part.column(2).to_pylist()]
                ok = np.array([m is not None and has_letter(t) for t in texts])
                names, score = np.full(len(texts), "und", object), np.zeros(len(texts))
                if ok.any():
                    s = m.scores([t for t, o in zip(texts, ok) if o])
                    best = s.argmax(axis=1)
                    names[ok] = np.array(m.labels, object)[best]
                    e = np.exp(3 * (s - s.max(axis=1, keepdims=True)))
                    score[ok] = 1 / e.sum(axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(names.tolist(), pa.string()), pa.array(score)], names=schema.names)

    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col)).mapInArrow(run, schema)
