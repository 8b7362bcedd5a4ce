"""Rules on the quality of texts: counts, and divergence from the language's profile.

Method: each document has a histogram of character classes and one of common
words. The profile of a language is the mean of the histograms of all its
documents that pass the base rules and are long enough, so a long document
weighs no more than another. A document is refused if the Jensen-Shannon
distance (base 2, from 0 to 1) of either histogram to its language's profile is
above a threshold, or both are above lower ones: lists of words without grammar
are a little odd in both. Short documents have histograms of chance and pass: the
guards ask for ``min_chars`` code points and ``min_words`` words.

Base rules: under 20 words, or over 30 % of the words in repeated windows of
eight words (compared by 64 bits of hash).

Profiles are sums combined before the shuffle, some hundred numbers for each
language; a language with a third of all rows is no burden. They are joined by
broadcast only if their written table is small enough for Spark's threshold.

Defined results: a NULL text has no words and fails the base rules. A NULL
language is a language of its own. A language of which no document is long
enough has no profile and refuses none. NULL ids and repeated rows are judged
like any other row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm import arrays
from tramline.session import scratch_dir

REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
GUARD_CHARS = 200
GUARD_WORDS = 40
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45
MAX_BOTH = (0.19, 0.25)

# Frequent function words of the languages.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on with as be at by this from or are an not",
    "fr": "de la le et les des en un une du que qui dans pour par sur est pas au avec ce il ne",
    "de": "der die und das von zu den mit ist des im ein nicht dem eine auf als auch für sich es an",
    "es": "de la que el en y los se del las por un para con no una su al lo como más pero sus",
}
# Classes of characters; other ASCII is a class, non-ASCII is another.
CLASSES = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\v\f\r", ".,;:?'\"()-", "!", "|")
SYMBOLS = b"#*$%&|<>"

FEATURES = (
    "doc_id long, lang string, version long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_chars long, chars array<double>, words array<double>"
)


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.int64)
    for i, members in enumerate(CLASSES):
        table[list(members.encode())] = i
    table[0xC0:] = len(CLASSES) + 1
    table[0x80:0xC0] = len(CLASSES) + 2  # bytes inside a character
    return table


def _common() -> list[bytes]:
    return sorted({w.encode() for words in COMMON_WORDS.values() for w in words.split()})


def _word_table() -> tuple[np.ndarray, np.ndarray]:
    common = _common()
    data = np.frombuffer(b"".join(common), np.uint8)
    ends = np.cumsum([len(w) for w in common])
    hashes = arrays.word_hashes(data, ends - [len(w) for w in common], ends)
    order = np.argsort(hashes)
    return hashes[order], order


def repeat_words(hashes: np.ndarray, words: np.ndarray, window: int) -> np.ndarray:
    """For each text, its words in windows that it holds twice or more."""
    count = np.maximum(np.diff(words) - window + 1, 0)
    at = arrays.ranges(words[:-1], count)
    text = np.repeat(np.arange(len(count)), count)
    grams = arrays.gram_hashes(hashes, window)[at]
    order = np.lexsort((grams, text))
    same = np.zeros(len(at) + 1, dtype=bool)
    same[1:-1] = (grams[order][1:] == grams[order][:-1]) & (text[order][1:] == text[order][:-1])
    again = at[order[same[:-1] | same[1:]]]
    step = np.zeros(words[-1] + 1, np.int64)
    np.add.at(step, again, 1)
    np.add.at(step, again + window, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
    return covered[words[1:]] - covered[words[:-1]]


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    classes, (known, place) = _class_table(), _word_table()
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    n_classes, n_common = len(CLASSES) + 2, len(known) + 1

    def per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks)])
        return total[offsets[1:]] - total[offsets[:-1]]

    def shares(row: np.ndarray, what: np.ndarray, n: int, width: int) -> pa.ListArray:
        counts = np.bincount(row * width + what, minlength=n * width).reshape(n, width).astype(float)
        counts /= np.maximum(counts.sum(axis=1, keepdims=True), 1)
        return pa.ListArray.from_arrays(np.arange(0, n * width + 1, width, dtype=np.int32), counts.ravel())

    for batch in batches:
        for rows, data, offsets in arrays.blocks(batch, "text"):
            n, raw = rows.stop - rows.start, data.tobytes()
            starts, ends, words = arrays.find_words(data, offsets)
            hashes = arrays.word_hashes(data, starts, ends)
            head = (data & 0xC0) != 0x80
            chars = per_text(head, offsets)
            kind = classes[data]
            folded = arrays.word_hashes(lower[data], starts, ends)
            at = np.minimum(np.searchsorted(known, folded), len(known) - 1)
            word = np.where(known[at] == folded, place[at], n_common - 1)
            columns = [
                batch.column("doc_id").slice(rows.start, n),
                batch.column("lang").slice(rows.start, n),
                batch.column("version").slice(rows.start, n),
                pa.array(np.diff(words)),
                pa.array(chars - per_text(arrays.SEPARATOR[data], offsets)),
                pa.array(per_text(symbol[data], offsets)),
                pa.array([duplicate_lines(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.int64()),
                pa.array(repeat_words(hashes, words, REPEAT_WINDOW)),
                pa.array(chars),
                shares(arrays.row_of(offsets)[head], kind[head], n, n_classes),
                shares(arrays.row_of(words), word, n, n_common),
            ]
            yield pa.record_batch(columns, names=[f.split()[0] for f in FEATURES.split(", ")])


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""

    def half(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: half(a, b) + half(b, a))
    total = F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)) / 2)


def _profile(features: DataFrame, column: str) -> DataFrame:
    """The mean of all histograms of a language, as ``lang_key`` and an array."""
    means = (
        features.select("lang", F.posexplode(column).alias("place", "share"))
        .groupBy("lang", "place")
        .agg(F.round(F.avg("share"), 9).alias("share"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("place", "share")))
    return means.groupBy("lang").agg(F.transform(ordered, lambda x: x.share).alias(f"{column}_profile"))


def judge(
    docs: DataFrame,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    max_both: tuple[float, float] = MAX_BOTH,
    guard_chars: int = GUARD_CHARS,
    guard_words: int = GUARD_WORDS,
) -> DataFrame:
    """Counts, distances and verdict of each row of ``docs(doc_id, text, lang)``.

    ``version`` is the XXH64 of the text, to tell rows of one id apart. ``char_distance`` and ``word_distance`` are NULL where the guards hold or
    the language has no profile.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "features")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    docs = docs.withColumn("version", F.xxhash64("text"))
    # Written: the texts are read once; profiles and verdicts work on the histograms.
    docs.mapInArrow(_features, FEATURES).write.parquet(path)
    features = spark.read.schema(FEATURES).parquet(path)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    long_enough = (F.col("n_chars") >= guard_chars) & (F.col("n_words") >= guard_words)
    features = features.withColumn("base_failed", failed).withColumn("judged", long_enough)
    sample = features.where("judged AND NOT base_failed")
    chars, words = _profile(sample, "chars"), _profile(sample, "words")
    same = chars["lang"].eqNullSafe(words["lang"])
    profiles = chars.join(words, same).select(chars["lang"].alias("profile_lang"), "chars_profile", "words_profile")
    home = scratch_dir(spark, "profiles")
    profiles.write.parquet(home)
    profiles = spark.read.parquet(home)
    found = features.join(profiles, F.col("lang").eqNullSafe(F.col("profile_lang")), "left")
    char_distance = F.when(F.col("judged"), distance(F.col("chars"), F.col("chars_profile")))
    word_distance = F.when(F.col("judged"), distance(F.col("words"), F.col("words_profile")))
    far = (
        (F.col("char_distance") > max_char_distance)
        | (F.col("word_distance") > max_word_distance)
        | ((F.col("char_distance") > max_both[0]) & (F.col("word_distance") > max_both[1]))
    )
    far = F.coalesce(far, F.lit(False))
    return (
        found.withColumn("char_distance", char_distance)
        .withColumn("word_distance", word_distance)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & ~far).alias("kept"),
            "char_distance",
            "word_distance",
            "lang",
            "version",
        )
    )
