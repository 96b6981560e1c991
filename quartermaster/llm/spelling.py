"""Spelling variants: words one edit apart, found in k-d trees over letter
counts.

A word of a length is a point: how often each letter occurs in it. Replacing
a letter takes one from one count and adds one to another (L1 distance two),
inserting one adds one (distance one). So the words near to a word are looked
for in two trees: that of its own length, where a point may lack at most one
of the word's letters and have at most one more, and that of the next length,
where a point has one more and lacks none. A subtree is left out when its box
alone needs more than that. The letters' order then decides.

*Distribution*: for each length the upper part of the tree is fitted on a
sample of at most about ``SAMPLE`` words; its leaves are cells of the whole
table. A word goes into its own cell and, as a search, to all cells that its
box search reaches. A task builds the lower part of a cell's tree and answers
the cell's searches in batches. A cell of more than ``PART`` words (fewer when
they are long) is cut by a hash of the word into parts, and every search of
the cell goes to each part.

Tasks return counts and the best near word instead of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import ids_and_texts, map_batches, materialize, read, stage

LEAST_CHARS, LEAST_COUNT = 5, 3
#: a form occurs this many times as often as its variant, or more
RATIO = 2
LETTERS = "A-Za-zÀ-ÿ"
#: words that the upper trees are fitted on (expected; a bound whatever the table's size)
SAMPLE = 1 << 16
#: words of a cell that are aimed at, and words and letters of a part at most
CELL, PART, PART_CHARS = 1 << 14, 1 << 16, 1 << 25
#: words of a leaf of a lower tree, pairs compared at once, letters of them
LEAF, PAIRS, PAIR_CHARS = 16, 1 << 18, 1 << 22
_DIMS = 26 + 64
_BROADCAST_ROWS = 1 << 16


# -------------------------------------------------------------------- words

def count_words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, spoil: int = 0) -> DataFrame:
    """``(word, n)``: maximal runs of Latin letters, A-Z as a-z, of at least
    ``least_chars`` characters that occur ``least_count`` times or more.

    With ``spoil`` one in about that many occurrences loses a letter first:
    those whose ``crc32("<doc_id>:<run>")`` it divides (a missing doc_id is
    the empty text), at the place that the same number picks.
    """
    capital, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    run = F.col("run")
    words = ids_and_texts(docs).select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))).alias("run"))
    # lower() changes no other letters where all are ASCII, and is much faster
    words = words.select("doc_id", F.when(F.octet_length(run) == F.length(run), F.lower(run))
                         .otherwise(F.translate(run, capital, small)).alias("word"))
    if spoil:
        words = words.withColumn("h", F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))))
        words = words.select(F.when(F.col("h") % spoil != 0, F.col("word")).otherwise(F.expr(
            "concat(left(word, cast(h % length(word) as int)), substring(word, cast(h % length(word) as int) + 2))")).alias("word"))
        words = words.filter(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    n = len(words[0])
    try:
        return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(-1, n)
    except UnicodeEncodeError:
        return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(-1, n)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    """Points: a-z and U+00C0 to U+00FF have a count each, other letters share
    these (which can only bring points nearer)."""
    code = rows.astype(np.int64)
    at = np.where((code >= 97) & (code <= 122), code - 97, 26 + code % 64)
    at += np.arange(len(rows))[:, None] * _DIMS
    return np.bincount(at.ravel(), minlength=len(rows) * _DIMS).reshape(-1, _DIMS).astype(np.int32)


# --------------------------------------------------------------------- trees

class Tree:
    """A k-d tree: nodes split a count at the value that halves them best."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.axis, self.value, self.low, self.high, self.child = [], [], [], [], []
        self.first, self.last = [], []
        self.order = np.arange(len(points))
        stack = [(self._node(0, len(points)), np.zeros(_DIMS, np.int64), np.full(_DIMS, 1 << 30))]
        while stack:
            node, low, high = stack.pop()
            a, b = self.first[node], self.last[node]
            split = self._split(points[self.order[a:b]]) if b - a > leaf else None
            if not split:
                continue
            axis, value = split
            own = self.order[a:b]
            left = points[own, axis] <= value
            self.order[a:b] = np.concatenate((own[left], own[~left]))
            middle = a + int(left.sum())
            x, y = self._node(a, middle), self._node(middle, b)
            self.axis[node], self.value[node], self.child[node] = axis, value, x
            self.low[node], self.high[node] = int(low[axis]), int(high[axis])
            upper, lower = high.copy(), low.copy()
            upper[axis], lower[axis] = value, value + 1
            stack += [(x, low, upper), (y, lower, high)]

    def _node(self, first: int, last: int) -> int:
        for x in (self.axis, self.value, self.low, self.high):
            x.append(0)
        self.child.append(-1)
        self.first.append(first)
        self.last.append(last)
        return len(self.child) - 1

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int] | None:
        best, found = len(points), None
        low, high = points.min(axis=0), points.max(axis=0)
        wide = np.flatnonzero(high > low)
        middle = np.median(points[:, wide], axis=0).astype(np.int64)
        for value in (middle, middle - 1):  # halving at the median or right below it
            n = (points[:, wide] <= value).sum(axis=0)
            off = np.where((n == 0) | (n == len(points)), len(points) * 2, np.abs(2 * n - len(points)))
            i = int(off.argmin()) if len(off) else 0
            if len(off) and off[i] < best:
                best, found = int(off[i]), (int(wide[i]), int(value[i]))
        return found

    def reach(self, points: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(leaf, points)``: for each leaf the points whose search reaches
        it, that is whose distance from its box takes at most ``more`` added
        and ``less`` removed letters."""
        none = np.zeros(len(points), np.int32)
        stack = [(0, np.arange(len(points)), none, none)]
        while stack:
            node, own, plus, minus = stack.pop()
            if self.child[node] < 0:
                yield node, own
                continue
            x = points[own, self.axis[node]]
            value, low, high = self.value[node], self.low[node], self.high[node]
            removed = minus + np.maximum(x - value, 0) - np.maximum(x - high, 0)
            added = plus + np.maximum(value + 1 - x, 0) - np.maximum(low - x, 0)
            left, right = np.flatnonzero(removed <= less), np.flatnonzero(added <= more)
            if len(left):
                stack.append((self.child[node], own[left], plus[left], removed[left]))
            if len(right):
                stack.append((self.child[node] + 1, own[right], added[right], minus[right]))


# ------------------------------------------------------------------ searches

def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows where ``b`` is ``a`` with one more letter: the letters that agree
    from the left and from the right make up all of ``a``."""
    n = a.shape[1]
    front, back = a != b[:, :-1], (a != b[:, 1:])[:, ::-1]
    left = np.where(front.any(axis=1), front.argmax(axis=1), n)
    right = np.where(back.any(axis=1), back.argmax(axis=1), n)
    return left + right >= n


def near_pairs(tree: Tree, data: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(word, data row)`` of all pairs that are one edit apart; ``words``
    are as long as the data or one letter shorter."""
    same = words.shape[1] == data.shape[1]
    agree = one_replaced if same else one_inserted
    most = max(1, min(PAIRS, PAIR_CHARS // data.shape[1]))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def settle() -> None:
        i, j = (np.concatenate(x) for x in zip(*pending))
        pending.clear()
        for a in range(0, len(i), most):
            x, y = i[a:a + most], j[a:a + most]
            hit = agree(words[x], data[y])
            out.append((x[hit], y[hit]))

    for leaf, own in tree.reach(letter_counts(words), 1, int(same)):
        there = tree.order[tree.first[leaf]:tree.last[leaf]]
        step = max(1, most // len(there))
        for a in range(0, len(own), step):
            x = own[a:a + step]
            pending.append((np.repeat(x, len(there)), np.tile(there, len(x))))
            size += len(x) * len(there)
            if size >= most:
                settle()
                size = 0
    if pending:
        settle()
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _best(of: np.ndarray, near: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each different ``of``: how many, and the ``near`` of largest ``n``
    (the smallest of equals)."""
    order = np.lexsort((near, -n, of))
    of, near = of[order], near[order]
    start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.empty(0, np.int64)
    return of[start], near[start], np.diff(np.append(start, len(of)))


_FOUND = "word string, n_near long, form string, form_n long"


def _found(words: list[str], near: list[str], near_n: np.ndarray, of: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
    of, to, many = _best(of, to, near_n[to])
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in of.tolist()], pa.string()), pa.array(many, pa.int64()),
         pa.array([near[i] for i in to.tolist()], pa.string()), pa.array(near_n[to], pa.int64())],
        names=["word", "n_near", "form", "form_n"])


class _Cell:
    """The words of one part of a cell and their tree, made when the first
    search comes. Words come in their order, so that row numbers compare like
    words."""

    def __init__(self):
        self.words, self.n, self.tree = [], [], None

    def search(self, words: list[str], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not self.words:
            return
        if self.tree is None:
            self.rows, self.n = letters(self.words), np.array(self.n, np.int64)
            self.tree = Tree(letter_counts(self.rows), LEAF)
        size = np.fromiter(map(len, words), np.int64, len(words))
        long = self.rows.shape[1]
        for length in (long - 1, long):
            at = np.flatnonzero(size == length)
            for a in range(0, len(at), 4096):
                some = [words[i] for i in at[a:a + 4096].tolist()]
                some_n = n[at[a:a + 4096]]
                x, y = near_pairs(self.tree, self.rows, letters(some))
                if len(x):
                    yield _found(some, self.words, self.n, x, y)
                    if length < long:
                        yield _found(self.words, some, some_n, y, x)


def _search_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(cell, part, search, word, n)`` sorted by the first four."""
    at, cell = None, _Cell()
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
        words, n = batch.column(3).to_pylist(), batch.column(4).to_numpy()
        new = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        ends = np.append(new, len(words)) if len(words) else new
        a = 0
        for b in ends.tolist():
            where = tuple(keys[:2, a].tolist())
            if where != at:
                at, cell = where, _Cell()
            if keys[2, a]:
                yield from cell.search(words[a:b], n[a:b])
            else:
                cell.words += words[a:b]
                cell.n += n[a:b].tolist()
            a = b


class Cells:
    """Upper trees by length; their leaves are numbered from 0. A length
    without a tree is one cell, numbered ``-length``."""

    def __init__(self, sample: list[str], total: int):
        leaf = max(16, round(CELL * len(sample) / max(total, 1)))
        by_length: dict[int, list[str]] = {}
        for w in sample:
            by_length.setdefault(len(w), []).append(w)
        self.trees, made = {}, 0
        for length, words in sorted(by_length.items()):
            if len(words) > leaf:
                tree = Tree(letter_counts(letters(words)), leaf)
                tree.order = None
                self.trees[length] = tree, made
                made += len(tree.child)

    def reach(self, words: list[str], length: int, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """``(cell, words)`` for words searched among those of ``length``."""
        if length not in self.trees:
            yield -length, np.arange(len(words))
            return
        tree, first = self.trees[length]
        for leaf, own in tree.reach(letter_counts(letters(words)), more, less):
            yield first + leaf, own

    def places(self, words: list[str], search: bool) -> Iterator[tuple[bool, int, np.ndarray]]:
        """``(is a search, cell, words)`` for words of any lengths."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        for length in np.unique(size).tolist():
            at = np.flatnonzero(size == length)
            some = [words[i] for i in at.tolist()]
            for cell, own in self.reach(some, length, 0, 0):
                yield False, cell, at[own]
            if search:
                for cell, own in self.reach(some, length, 1, 1):
                    yield True, cell, at[own]
                for cell, own in self.reach(some, length + 1, 1, 0):
                    yield True, cell, at[own]


def _route(cells: Cells, search: bool):
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            words, n = batch.column(0), batch.column(1)
            for a in range(0, len(words), 4096):
                for is_search, cell, own in cells.places(words[a:a + 4096].to_pylist(), search):
                    at = pa.array(own + a)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), cell, np.int64)), pa.array(np.full(len(own), is_search)), words.take(at), n.take(at)],
                        names=["cell", "search", "word", "n"])
    return batches


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, form, form_n)`` for the words of ``(word, n)`` that
    have near ones: how many, and the one of largest n (the smallest in code
    point order of equals). ``words`` is read four times and holds each word
    once."""
    spark = words.sparkSession
    total = words.count()
    top = -(1 << 63) + int((1 << 64) * min(1.0, SAMPLE / max(total, 1))) - 1
    sample = sorted(r[0] for r in words.filter(F.xxhash64("word") <= top).select("word").collect())
    cells = Cells(sample, total)
    places = "cell long, search boolean, word string, n long"
    own = map_batches(words, _route(cells, False), places)
    room = F.least(F.lit(PART), F.greatest(F.lit(1), F.floor(F.lit(PART_CHARS) / F.col("chars"))))
    hot = materialize(own.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max(F.length("word")).alias("chars"))
                      .filter(F.col("rows") > room).select("cell", F.ceil(F.col("rows") / room).cast("int").alias("parts")))
    hot_cells = hot.count()
    if hot_cells <= _BROADCAST_ROWS:  # measured; two numbers a row
        hot = F.broadcast(hot)
    placed = map_batches(words, _route(cells, True), places)
    if hot_cells:
        placed = placed.join(hot, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        part = F.when(F.col("search"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
            F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
        placed = placed.select("cell", F.explode(part).alias("part"), "search", "word", "n")
    else:
        placed = placed.select("cell", F.lit(0).alias("part"), "search", "word", "n")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(n, "cell", "part").sortWithinPartitions("cell", "part", "search", "word")
    found = map_batches(dealt, _search_batches, _FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for each ``(word, form)``: forms are followed to the
    last one, twice as far in every round. Counts at least double from word to
    form, so there is no ring and chains are short."""
    now = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = materialize(now.join(ahead, now["root"] == ahead["at"], "left")
                          .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not now.filter("moved").take(1):
            return now.drop("moved")
        now = now.drop("moved")


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for a table ``(word, n)`` that
    holds each word once. Near words differ by one inserted, deleted or
    replaced code point; a word's ``form`` is its near word of largest n (the
    smallest in code point order of equals) if that n is at least ``ratio``
    (two or more) times its own; ``root`` follows forms to the last, the word
    itself if it has none.

    Words may be of any letters and of any length; an empty table gives an
    empty result. Rows without a word go.
    """
    words = stage(words.select("word", F.col("n").cast("long").alias("n")).filter(F.col("word").isNotNull() & (F.col("word") != "")))
    near = near_words(words).withColumnRenamed("word", "of")
    d = words.join(near, words["word"] == near["of"], "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    d = stage(d.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                       F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")))
    root = _roots(d.filter("form is not null")).withColumnRenamed("word", "of")
    return d.join(root, d["word"] == root["of"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(count_words(read(spark, sf_dir, "documents"), spoil=97))
