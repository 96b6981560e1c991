"""Enveloped documents (A1, A2): ``{"data": {"items": [{...}, {...}]}}``.

A file is one JSON value, however large; its list is read by many tasks. The
text source cuts files into byte ranges and records at every ``}``, in or out
of a string. Where a record stands (inside a string? at what depth? in which
list?) depends on everything before it, so the file is read twice:

1. each byte range gives a summary of what it does to that state, once for a
   start outside a string and once for a start inside one: how many levels it
   closes below its start, how many it leaves open, and under which keys the
   first few of these were opened. The summaries (a few bytes per byte range,
   like the list of ranges that the driver holds anyway) are chained in file
   order and give the state at every start;
2. each byte range cuts out its elements of the list. An element that crosses
   borders leaves a piece in each range; the pieces, a few per range, are put
   together by the element's number.

The elements are written to the shared checkpoint folder as the JSON text they
are and numbered from the counts per range.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from quartermaster.session import ensure_checkpoint_dir
from quartermaster.workers import map_batches

_TOKEN = re.compile(r'"((?:[^"\\]|\\.)*)("?)|[{}\[\]]', re.S)
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
_KEY_OF = re.compile(r"\s*:\s*")
_BETWEEN = re.compile(r"[\s,]*")

#: rows of the second pass: a whole element, its beginning, its end, its middle
WHOLE, BEGIN, END, MIDDLE = range(4)


class Lexer:
    """Walks records and keeps the state: whether the next character is in a
    string, how many levels below the start were closed (``low``), how many
    are open above that (``height``), and of these the first ``base`` as
    ``(bracket, key)``; a key that began in an earlier record is ``None``."""

    def __init__(self, base: int, in_string: bool = False, frames: Sequence[tuple] = (), height: int = 0):
        self.base, self.in_string = base, in_string
        self.low, self.height, self.frames = 0, height, list(frames)

    def feed(self, text: str) -> Iterator[tuple[str, int]]:
        """``(bracket, end)`` of the brackets outside strings, each after it
        has changed the state."""
        at = 0
        if self.in_string:
            m = _STRING_END.match(text)
            if not m:
                return
            self.in_string, at = False, m.end()
        key, key_end = None, -1
        for m in _TOKEN.finditer(text, at):
            c = text[m.start()]
            if c == '"':
                if not m.group(2):
                    self.in_string = True
                    return
                key, key_end = m.group(1), m.end()
                continue
            if c in "{[":
                if self.height < self.base:
                    named = key_end >= 0 and _KEY_OF.fullmatch(text, key_end, m.start())
                    self.frames.append((c, key if named else None))
                self.height += 1
            elif self.height:
                self.height -= 1
                del self.frames[self.height:]
            else:
                self.low += 1
            yield c, m.end()

    def run(self, text: str) -> None:
        for _ in self.feed(text):
            pass


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], Iterator[str]]]:
    """``((file, start), records)`` for each byte range of a task, in order;
    the records of one must be used up before the next is asked for."""
    rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(3))))
    row = next(rows, None)

    def records() -> Iterator[str]:
        nonlocal row
        here = row[:2]
        while row is not None and row[:2] == here:
            text, row = row[2], next(rows, None)
            yield text + "}"

    while row is not None:
        yield row[:2], records()


def _summaries(base: int):
    kind = pa.struct([("in_string", pa.bool_()), ("low", pa.int64()), ("height", pa.int64()),
                      ("brackets", pa.list_(pa.string())), ("keys", pa.list_(pa.string()))])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), records in _by_range(it):
            both = [Lexer(base), Lexer(base, True)]
            for text in records:
                for lexer in both:
                    lexer.run(text)
            ends = [{"in_string": x.in_string, "low": x.low, "height": x.height, "brackets": [f[0] for f in x.frames],
                     "keys": [f[1] for f in x.frames]} for x in both]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([start]), *[pa.array([e], kind) for e in ends]], names=["file", "start", "outside", "inside"])
    return batches


_END = "struct<in_string:boolean,low:bigint,height:bigint,brackets:array<string>,keys:array<string>>"


def _states(summaries: list, base: int) -> dict[tuple[int, int], tuple[bool, tuple, int]]:
    """The state at the start of each byte range: in a string, the first
    frames, the depth. Fails where a file ends before its brackets do."""
    out, last = {}, None
    in_string, frames, depth = False, (), 0

    def check_end() -> None:
        # a last record that no bracket ends (white space, or a closing "]") got one all the same
        if last is not None and (in_string or depth not in ((-1,) if base == 1 else (0, -1))):
            raise ValueError(f"a document ends too early, or has brackets too many (file {last['file']})")

    for r in sorted(summaries, key=lambda r: (r["file"], r["start"])):
        if last is None or r["file"] != last["file"]:
            check_end()
            in_string, frames, depth = False, (), 0
        out[r["file"], r["start"]] = in_string, frames, depth
        end = r["inside"] if in_string else r["outside"]
        kept = depth - end["low"]
        in_string, depth = end["in_string"], kept + end["height"]
        if kept < base:
            frames = (frames[:max(kept, 0)] + tuple(zip(end["brackets"], end["keys"])))[:base]
        last = r
    check_end()
    return out


def _elements(path: tuple[str, ...], states: dict):
    """The second pass over the records."""
    frames_of_list = tuple(zip("{" * len(path) + "[", (None, *path)))
    base = len(frames_of_list)

    def pieces(state, records: Iterator[str]) -> Iterator[tuple[int, str]]:
        in_string, frames, depth = state
        lexer = Lexer(base, in_string, frames, depth)
        at_list = lambda: lexer.height == base and tuple(lexer.frames) == frames_of_list
        inside = depth > base and tuple(frames) == frames_of_list  # in an element that began earlier
        parts, began, listed = [], False, at_list()
        for text in records:
            at = 0  # where the element goes on, or the text between elements begins
            for c, end in lexer.feed(text):
                if inside:
                    if lexer.height > base:
                        continue
                    parts.append(text[at:end])
                    yield (WHOLE if began else END), "".join(parts)
                    parts, inside, at = [], False, end
                elif listed:
                    if c == "[" or not _BETWEEN.fullmatch(text, at, end - 1):
                        raise ValueError(f"the list holds something that is no object: {text[at:end][:80]!r}")
                    if c == "{":
                        inside, began, at = True, True, end - 1
                listed = not inside and at_list()
                if listed and c == "[":
                    at = end
            if inside:
                parts.append(text[at:])
        if inside and parts:
            yield (BEGIN if began else MIDDLE), "".join(parts)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), records in _by_range(it):
            rows, size, n = [], 0, 0
            for kind, text in pieces(states[file, start], records):
                rows.append((file, start, n, kind, text))
                n += kind in (WHOLE, BEGIN)
                size += len(text)
                if size > 1 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
            yield _batch(rows)

    def _batch(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["file", "start", "n", "kind", "text"])

    return batches


def enveloped_texts(spark: SparkSession, files: str, path: Sequence[str]) -> DataFrame:
    """``(file, pos, text)``: the elements of the list under the keys ``path``
    as JSON text, numbered within their file (``file`` is a hash of its name).

    A file may hold other members and lists beside that list, or several
    documents one after the other (numbered through). An element that is no
    object, or a file that ends inside its list, fails the job.
    """
    path = tuple(path)
    scan = spark.read.option("lineSep", "}").text(files)
    scan = scan.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    found = map_batches(scan, _summaries(len(path) + 1),
                        f"file bigint, start bigint, outside {_END}, inside {_END}").collect()
    states = _states(found, len(path) + 1)
    cut = map_batches(scan, _elements(path, states), "file bigint, start bigint, n bigint, kind int, text string")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/enveloped-{uuid.uuid4().hex}"
    cut.write.parquet(folder)
    cut = spark.read.schema(cut.schema).parquet(folder)
    counts = cut.groupBy("file", "start").agg(F.count_if(F.col("kind").isin(WHOLE, BEGIN)).alias("begun"))
    before = F.sum("begun").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("file", "start", F.coalesce(before, F.lit(0)).alias("before"))
    # an element that goes on here is the last one begun before
    pos = F.col("before") + F.when(F.col("kind").isin(WHOLE, BEGIN), F.col("n")).otherwise(-1)
    placed = cut.join(offsets, ["file", "start"]).withColumn("pos", pos)
    piece = F.struct("start", "text")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), "")
    crossing = placed.filter(F.col("kind") != WHOLE).groupBy("file", "pos").agg(joined.alias("text"))
    return placed.filter(F.col("kind") == WHOLE).select("file", "pos", "text").unionByName(crossing)
