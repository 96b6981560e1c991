"""Document fingerprints by winnowing.

The grams of a text are its runs of ``GRAM`` consecutive words (all words
when there are fewer); a word is a run without ASCII white space, in lower
case. Where white space does not part words, characters do: each character of
a script written without spaces (``UNSPACED``) is a word. A word is read as
its overlapping runs of ``SPAN`` characters, one from each character on (the
word itself when it is no longer), so that a word of any length (an address,
minified code, encoded data) changes in few units when it changes in few
characters. The hashes of consecutive grams form windows of ``WINDOW``; of each
window the smallest hash is kept, the rightmost one of equals, with its
position. Two texts that share ``GRAM + WINDOW - 1`` consecutive units
therefore share a kept hash (the winnowing guarantee), and nothing shorter
than ``GRAM`` units matches; inside one long word these are ``GRAM + WINDOW +
SPAN - 2`` (17) characters.

Everything is built-in array functions: a gram's 32-bit hash and the reversed
position are packed into one long, so that ``least`` over a window finds the
smallest hash and, among equals, the rightmost position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermaster.llm.common import materialize, read, row_key
from quartermaster.operators.index import contiguous_number

GRAM, WINDOW = 5, 4
WORD = r"[^\x20\x09-\x0D]+"
#: scripts written without spaces between words (ranges, which are tested much faster than script names):
#: Thai to Myanmar, Khmer, Tai, Balinese, Han, kana, Bopomofo, Yi, Javanese, Myanmar, Tai Viet
UNSPACED = (r"[\x{E00}-\x{3FFFF}&&[\x{E01}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{19FF}\x{1A20}-\x{1AAF}\x{1B00}-\x{1B7F}"
            r"\x{2E80}-\x{2FDF}\x{3005}-\x{3007}\x{3021}-\x{312F}\x{31A0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{A4CF}"
            r"\x{A980}-\x{A9FF}\x{AA60}-\x{AADF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}]]")
WORD_UNSPACED = rf"{UNSPACED}|(?:(?!{UNSPACED})[^\x20\x09-\x0D])++"
#: characters of the overlapping runs that words are read as
SPAN = 10
_POS = (1 << 31) - 1


def _words(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    wide = (F.octet_length(low) > F.length(low)) & low.rlike(UNSPACED)  # ASCII texts are not searched
    return F.when(wide, F.regexp_extract_all(low, F.lit(WORD_UNSPACED), F.lit(0))).otherwise(
        F.regexp_extract_all(low, F.lit(WORD), F.lit(0)))


def _units(words: Column) -> Column:
    """Hashes of the runs of ``SPAN`` characters of an array's words."""
    cut = lambda x: F.transform(F.regexp_extract_all(x, F.lit(rf"(?s)(?=(.{{{SPAN}}}))."), F.lit(1)), lambda y: F.xxhash64(y))
    long = lambda x: F.length(x) > SPAN
    return F.when(F.exists(words, long), F.flatten(F.transform(
        words, lambda x: F.when(long(x), cut(x)).otherwise(F.array(F.xxhash64(x)))))).otherwise(
        F.transform(words, lambda x: F.xxhash64(x)))


def winnow(df: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add column ``out``: array<struct<hash int, pos int>>, the kept hashes
    of string column ``text`` in the order of their positions (numbers of
    words before the gram). NULL and texts without words: an empty array."""
    kept = _let(_let(_words(F.col(text)), _units), lambda units: _let(_packed(units, gram), lambda p: _smallest(p, window)))
    return df.withColumn(out, F.transform(kept, lambda x: F.struct(
        _signed(F.shiftright(x, 31)).alias("hash"), (F.lit(_POS) - x.bitwiseAND(F.lit(_POS))).cast("int").alias("pos"))))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is named
    and wherever the optimizer moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _packed(units: Column, gram: int) -> Column:
    """Hash and reversed position of each gram; fewer units than a gram make
    one gram of all (xxhash64 skips the missing)."""
    last = F.greatest(F.size(units) - gram, F.lit(0))
    return F.when(F.size(units) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.shiftleft(
        F.xxhash64(*(F.get(units, i + k) for k in range(gram))).bitwiseAND(F.lit(0xFFFFFFFF)), 31)
        .bitwiseOR(F.lit(_POS) - i.cast("long")))).otherwise(F.array().cast("array<bigint>"))


def _smallest(packed: Column, window: int) -> Column:
    """The smallest of each window (``get`` is NULL past the end and ``least`` skips NULLs)."""
    last = F.greatest(F.size(packed) - window, F.lit(0))
    return F.when(F.size(packed) > 0, F.array_distinct(F.transform(
        F.sequence(F.lit(0), last), lambda i: F.least(*(F.get(packed, i + k) for k in range(window)))))
    ).otherwise(F.array().cast("array<bigint>"))


def _signed(x: Column) -> Column:
    """An unsigned 32-bit value as an int."""
    return F.when(x > _POS, x - (1 << 32)).otherwise(x).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of kept hashes (1 when both are empty)."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both.cast("double") / union)


def digest(kept: Column) -> Column:
    """A fingerprint as one string: SHA-256 of ``hash:pos`` pairs."""
    return F.sha2(F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["hash"].cast("string"), x["pos"].cast("string"))), ","), 256)


def following(docs: DataFrame) -> DataFrame:
    """``(key, id, times, to, to_id, need)``: for each distinct row (``key``) of
    ``docs`` the row before it in descending doc_id (the last one before the
    first) and a third of that row's characters. Rows with one doc_id follow
    each other by their hashes, NULL ids come last."""
    rows = docs.select(docs["doc_id"].alias("id"), row_key(docs).alias("key"),
                       F.length(F.coalesce(docs["text"], F.lit(""))).alias("n")).groupBy("id", "key", "n").agg(F.count(F.lit(1)).alias("times"))
    order = [F.col("id").isNull().cast("int"), F.col("id").desc(), F.col("key")]
    rows = materialize(contiguous_number(rows, order, "rn"))
    n = rows.count()
    before = rows.select(F.col("key").alias("to"), F.col("id").alias("to_id"), F.floor(F.col("n") / 3).cast("int").alias("need"),
                         (F.col("rn") % max(n, 1) + 1).alias("rn"))
    return rows.select("key", "id", "times", "rn").join(before, "rn").drop("rn")


def edited_pairs(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """For every row of ``docs``: ``(doc_id, n_chars, edited, kept,
    edited_kept, next_hashes)``, where ``edited`` is its text with the last
    third replaced by the beginning of the next document in descending
    doc_id (after the last: the first), ``kept`` are fingerprints
    (array<struct<hash, pos>>) and ``next_hashes`` the next document's hashes.

    NULL texts are empty; exactly repeated rows are one document in the order
    and each get its result; a single document follows itself; an empty table
    gives an empty result; other columns are not looked at.
    """
    d = docs.select(docs["doc_id"].alias("doc_id"), row_key(docs).alias("key"),
                    F.coalesce(docs["text"], F.lit("")).alias("text"))
    after = materialize(following(docs))
    # joined by the same two columns both times, so that the texts are dealt
    # out once and both joins read the same shuffle
    sent = d.join(after, (d["key"] == after["key"]) & d["doc_id"].eqNullSafe(after["id"]))
    sent = winnow(sent.select("text", "to", "to_id", "need"), "text", "kept", gram, window)
    sent = sent.select("to", "to_id", F.expr("left(text, need)").alias("beginning"), F.col("kept.hash").alias("next_hashes"))
    if after.filter("times > 1").take(1):
        sent = sent.dropDuplicates(["to", "to_id"])
    out = d.join(sent, (d["key"] == sent["to"]) & d["doc_id"].eqNullSafe(sent["to_id"])).withColumn("n", F.length("text"))
    out = out.withColumn("edited", F.concat(F.expr("left(text, n - n div 3)"), "beginning"))
    out = winnow(winnow(out, "text", "kept", gram, window), "edited", "edited_kept", gram, window)
    return out.select("doc_id", F.col("n").cast("long").alias("n_chars"), "edited", "kept", "edited_kept", "next_hashes")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = edited_pairs(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    digest(F.col("kept")).alias("fingerprint"), digest(F.col("edited_kept")).alias("edited_fingerprint"),
                    likeness(F.col("kept.hash"), F.col("edited_kept.hash")).alias("near_edited"),
                    likeness(F.col("kept.hash"), F.col("next_hashes")).alias("near_next"))
