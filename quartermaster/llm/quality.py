"""Quality classifier: logistic regression over hashed word n-grams, trained
with follow-the-regularised-leader (FTRL-proximal) updates.

A text is cut into words (runs of letters, digits and bytes beyond ASCII)
and marks (runs of other printable characters). Its n-grams are single words
and pairs of words, and pairs and triples of word *shapes* (capitals, digits,
rough length, the marks themselves, "same word again"), all lower-cased where
the words themselves count, hashed into ``2 ** BITS`` features. A feature's
value is its share of the text's n-grams, times ``SCALE``; the score is the
sigmoid of the sparse dot product with the weights, plus a bias.

Training is online, ``EPOCHS`` passes in hash order, over a bounded sample of the
labelled rows (``SAMPLE``, the rows with the smallest hash of their id), in
one task; its memory is one text and the weights. The weights (2 ** BITS
floats, 1 MiB) are all that goes to the driver and out to the scoring tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.common import binary_column, byte_chunks, free_name, ids_and_texts, map_batches, read

#: at most so many labelled rows are trained on
SAMPLE = 8192
BITS = 18
SCALE = 16.0
#: FTRL-proximal: learning rate, smoothing, L1 and L2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
EPOCHS = 2
THRESHOLD = 0.3
FOLDS = 5
#: longer texts are taken in pieces of about this many bytes, cut between words
_PIECE = 1 << 18
#: words before a piece that its n-grams look back to: two, and two more for "same word again" of the first
_BACK = 4
_CUT = re.compile(rb"[\x00-\x20\x7f]|(?<=[0-9A-Za-z\x80-\xff])(?=[!-/:-@\[-`{-~])|(?<=[!-/:-@\[-`{-~])(?=[0-9A-Za-z\x80-\xff])")


# ----------------------------------------------------------------- features

@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each byte (0 white space and controls, 1 word, 2 mark), its
    hash after lower-casing, and powers of an odd multiplier."""
    kind = np.full(256, 1, np.uint8)
    kind[:33] = 0
    kind[127] = 0
    for b in range(33, 127):
        kind[b] = 1 if chr(b).isalnum() else 2
    lower = np.arange(256)
    lower[65:91] += 32
    mixed = (lower.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed[kind[np.arange(256)] == 0] = 0
    power = np.cumprod(np.full(256, np.uint64(0x100000001B3)), dtype=np.uint64)
    return kind, mixed, power


def _hash(*parts: np.ndarray) -> np.ndarray:
    """A feature number from hashes."""
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def ngrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(row, feature)``: every n-gram of every text, repeats included."""
    return _ngrams(texts)[:2]


def _ngrams(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """``(row, feature, last, starts)``: also where the last word of each
    n-gram starts, and where all words start, in the joined texts."""
    kind, mixed, power = _tables()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum(sizes + 1)
    of = kind[buf]
    change = np.empty(len(of), bool)
    change[0] = True
    np.not_equal(of[1:], of[:-1], out=change[1:])
    start = np.flatnonzero(change)
    length = np.diff(np.append(start, len(of)))
    rel = np.arange(len(of)) - np.repeat(start, length)
    word = np.add.reduceat(mixed[buf] * power[rel & 255], start)
    upper = np.add.reduceat(((buf >= 65) & (buf <= 90)).astype(np.int32), start)
    digit = np.add.reduceat(((buf >= 48) & (buf <= 57)).astype(np.int32), start)
    first_upper = (buf[start] >= 65) & (buf[start] <= 90)
    keep = of[start] > 0
    start, length, word, upper, digit, first_upper = (x[keep] for x in (start, length, word, upper, digit, first_upper))
    mark = of[start] == 2
    row = np.searchsorted(ends, start, side="right")
    if not len(row):
        return row, row, row, row
    # shapes: marks stand for themselves
    rough = np.digitize(length, (2, 4, 7, 11, 16))
    shape = (rough + 8 * (upper > 1) + 16 * first_upper + 32 * (digit > 0)).astype(np.uint64)
    shape = np.where(mark, word | np.uint64(1 << 63), shape)
    # the word before, skipping nothing
    ab = row[1:] == row[:-1]
    abc = ab[1:] & ab[:-1]
    # "same word again" looks past one mark
    again = np.zeros(len(row), bool)
    again[1:] |= ab & (word[1:] == word[:-1])
    again[2:] |= abc & (word[2:] == word[:-2]) & mark[1:-1]
    shape = np.where(again & ~mark, np.uint64(1 << 40), shape)
    one, two, three, four = (np.uint64(i) for i in (11, 22, 33, 44))
    full = lambda x, n: np.full(n, x, np.uint64)
    rows = [row, row[1:][ab], row[1:][ab], row[2:][abc]]
    feats = [_hash(full(one, len(row)), word),
             _hash(full(two, int(ab.sum())), word[:-1][ab], word[1:][ab]),
             _hash(full(three, int(ab.sum())), shape[:-1][ab], shape[1:][ab]),
             _hash(full(four, int(abc.sum())), shape[:-2][abc], shape[1:-1][abc], shape[2:][abc])]
    last = [start, start[1:][ab], start[1:][ab], start[2:][abc]]
    return np.concatenate(rows), np.concatenate(feats), np.concatenate(last), start


def _features_of(text: bytes) -> Iterator[np.ndarray]:
    """All n-grams of one text of any length, a part at a time: a long text is
    read in pieces cut between words, each with the last words before it."""
    a = back = 0
    while True:
        cut = _CUT.search(text, a + _PIECE) if len(text) - a > _PIECE else None
        b = cut.start() if cut else len(text)
        _, found, last, starts = _ngrams([text[back:b]])
        yield found[last >= a - back]  # the others were in the piece before
        if not cut:
            return
        a, back = b, back + int(starts[-_BACK]) if len(starts) >= _BACK else back


def _sums(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """The dot product of each text's features with ``weights``."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for a, b in byte_chunks(texts, _PIECE):
        if b - a == 1:
            for f in _features_of(texts[a]):
                total[a] += weights[f].sum(dtype=np.float64)
                count[a] += len(f)
            continue
        row, f = ngrams(texts[a:b])
        total[a:b] += np.bincount(row, weights[f], minlength=b - a)
        count[a:b] += np.bincount(row, minlength=b - a)
    return SCALE * total / np.maximum(count, 1)


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


# ----------------------------------------------------------------- training

class Ftrl:
    """FTRL-proximal for logistic loss; the last weight is the bias."""

    def __init__(self, size: int):
        self.z = np.zeros(size + 1)
        self.n = np.zeros(size + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = (_sigmoid(w @ value) - label) * value
        s = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - s * w
        self.n[at] += g * g


def _features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of one text and their values, the bias last."""
    found = np.concatenate(list(_features_of(text)))
    at, n = np.unique(found, return_counts=True)
    return np.append(at, 1 << BITS), np.append(SCALE * n / max(1, len(found)), 1.0)


def _train_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = Ftrl(1 << BITS)
    for batch in batches:
        for text, label in zip(binary_column(batch, "text"), batch.column(1).to_pylist()):
            model.learn(*_features(text), label)
    w = model.weights(slice(None)).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary())], names=["weights"])


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept for testing (NULL id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> np.ndarray:
    """The weights (float32, bias last) learned from at most ``most`` labelled
    rows that are not held out. Rows without label or document are left out;
    of several labels of one document the largest counts."""
    known = (labels.select(labels["doc_id"].alias("id"), labels[label].cast("double").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("id"), "id").limit(most))
    d = ids_and_texts(docs)
    rows = (d.join(F.broadcast(known), d["doc_id"] == known["id"])  # ``most`` rows at most
            .select("text", "label", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))).alias("epoch"), "id"))
    order = ["epoch", F.xxhash64("epoch", "id"), "text"]
    sample = rows.repartition(1).sortWithinPartitions(*order).select("text", "label")
    found = map_batches(sample, _train_batches, "weights binary").first()
    return np.frombuffer(found["weights"], np.float32) if found else np.zeros((1 << BITS) + 1, np.float32)


# ------------------------------------------------------------------ scoring

def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``(doc_id, score)`` for every row; the score of a text without any
    n-gram (NULL, empty, white space only) is that of the bias."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    d = ids_and_texts(docs)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in it:
            s = _sigmoid(_sums(binary_column(batch, "text"), w) + w[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return map_batches(d, batches, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``.

    Rows that repeat get the same score; NULL texts count as empty; a NULL
    doc_id is kept and is not held out; an empty ``docs`` gives an empty
    result, and without any usable label every score is 0.5.
    """
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all their columns) that the classifier accepts."""
    weights = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    names = docs.columns
    mark = free_name(docs, "__accepted")
    schema = T.StructType([*docs.schema.fields, T.StructField(mark, T.BooleanType())])
    at = names.index("text")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in it:
            col = batch.column(at)
            kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
            texts = [t or b"" for t in col.cast(kind).to_pylist()]
            good = _sigmoid(_sums(texts, w) + w[-1]) >= threshold
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(good)], names=[*names, mark])

    return map_batches(docs, batches, schema).filter(F.col(mark)).drop(mark)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
