"""Spelling variants: words of a corpus that are one edit apart, and the common form of each.

Two words that differ by one edit agree in the first or in the last half of the shorter one.  So
every word is filed under its halves, forward and reversed, and only words of one file are
compared.  A file is a sorted list: the rows of the banded edit matrix are kept by depth and
reused over the prefix that a word shares with the one before it, and where a row has no cell
within one edit, all words with that prefix are skipped.  Files that grow too large are filed
again by halves of what is still free, until few code points are; no pair is lost by that.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, partitions

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a file that one task compares; larger files are filed again.
FILE_ROWS = 4096


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 7, least_n: int = 2, every: int = 31) -> DataFrame:
    """``word, n`` of all texts: runs of letters, A-Z in lower case, with the dropped code points of the contract.

    A run of document d whose crc32 of ``d:run`` is a multiple of ``every`` loses one code point;
    a null id has no crc32 and changes nothing.  Null and empty texts have no words.  Words of
    fewer than ``least_chars`` code points or ``least_n`` occurrences are left out.  Counts are
    added up before the shuffle, so a very frequent word is one row a task.
    """
    low = F.translate(F.col(f"`{text_col}`").cast("string"), UPPER, LOWER)
    runs = docs.select(F.col(f"`{id_col}`").cast("string").alias("_id"), F.explode(F.regexp_extract_all(low, F.lit("([A-Za-z\\u00C0-\\u00FF]+)"), F.lit(1))).alias("_run"))
    long_enough = runs.where(F.length("_run") >= least_chars)
    h = F.crc32(F.concat(F.col("_id"), F.lit(":"), F.col("_run")).cast("binary"))
    at = (h % F.length("_run")).cast("int")
    cut = F.concat(F.substring(F.col("_run"), F.lit(1), at), F.substring(F.col("_run"), at + 2, F.length("_run")))
    edited = long_enough.select(F.when(F.coalesce(h % every == 0, F.lit(False)), cut).otherwise(F.col("_run")).alias("word"))
    return edited.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


def near_in_list(query: str, listed: list[str], start: int = 0) -> Iterator[int]:
    """Places in the sorted list, from ``start``, of the words exactly one edit from ``query``.

    ``row[d]`` holds the cells of depth d on the three diagonals around the main one: the edits
    from the query's first d-1, d and d+1 code points to the word's first d; more than one is two.
    """
    width = len(query)
    rows: list[tuple[int, int, int]] = [(2, 0, 1)]
    k, before, kept = start, "", 0
    while k < len(listed):
        word = listed[k]
        d, most = 0, min(kept, len(word))
        while d < most and before[d] == word[d]:
            d += 1
        del rows[d + 1 :]
        while d < len(word):
            left, same, right = rows[d]
            c = word[d]
            # The cells of depth d + 1 against the query's first d, d + 1 and d + 2 code points.
            a = min(left + (0 if 0 < d <= width and query[d - 1] == c else 1), same + 1, 2) if d <= width else 2
            b = min(same + (0 if query[d] == c else 1), right + 1, a + 1, 2) if d < width else 2
            e = min(right + (0 if query[d + 1] == c else 1), b + 1, 2) if d + 1 < width else 2
            d += 1
            rows.append((a, b, e))
            if a > 1 and b > 1 and e > 1:
                break
        before, kept = word, d
        a, b, e = rows[d]
        if a > 1 and b > 1 and e > 1:
            k = bisect_left(listed, word[:d] + "\U0010ffff", k)
            continue
        if d == len(word):
            off = width - d
            if -1 <= off <= 1 and rows[d][off + 1] == 1:
                yield k
        k += 1


def _halves(length: Column, fixed_left: Column, fixed_right: Column, word: Column, m: Column) -> Column:
    """The two ways to file a word once more: half of the free part on the left, or the rest on the right."""
    free = m - fixed_left - fixed_right
    half = F.floor((free + 1) / 2).cast("int")
    both = [(fixed_left + half, fixed_right), (fixed_left, fixed_right + free - half)]
    return F.array(
        *[
            F.struct(
                left.cast("int").alias("left"), right.cast("int").alias("right"),
                F.concat(F.substring(word, F.lit(1), left), F.lit("\u0000"), F.substring(word, length - right + 1, right)).alias("file"),
            )
            for left, right in both
        ]
    )


def filed(vocabulary: DataFrame, most: int = FILE_ROWS) -> DataFrame:
    """``m, left, right, file, word``: words under the parts that they have in common with their file.

    ``m`` is the length of a pair's shorter word, so a word stands in files of its own length and
    of the length before.  ``left`` and ``right`` code points at the ends are given by the file.
    One edit leaves one of the two halves of what is free untouched.  Files of over ``most`` rows
    are filed again while at least two code points are free: a file of one free code point holds
    at most the alphabet, and twice its place.
    """
    spark = vocabulary.sparkSession
    size = F.length("word")
    start = vocabulary.select("word", F.explode(F.array(size, size - 1)).alias("m")).where("m >= 0").select("word", "m", F.explode(_halves(size, F.lit(0), F.lit(0), F.col("word"), F.col("m"))).alias("f"))
    now = materialize(start.select("m", "f.left", "f.right", "f.file", "word"), "filed")
    key = ["m", "left", "right", "file"]
    done = []
    while True:
        large = now.groupBy(*key).agg(F.count("*").alias("_n")).where((F.col("_n") > most) & (F.col("m") - F.col("left") - F.col("right") >= 2))
        large = materialize(large.select(*key), "large")
        if large.isEmpty():
            discard(large)
            return _united([*done, now])
        done.append(materialize(now.join(large, key, "left_anti"), "filed-done"))
        again = now.join(large, key, "left_semi").select(
            "m", "word", F.explode(_halves(size, F.col("left"), F.col("right"), F.col("word"), F.col("m"))).alias("f")
        )
        after = materialize(again.select("m", "f.left", "f.right", "f.file", "word").distinct(), "filed")
        discard(now, large)
        now = after


def _united(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    out._parts = frames
    return out


def near_pairs(vocabulary: DataFrame, most: int = FILE_ROWS) -> DataFrame:
    """``a, b``: each pair of words one edit apart, once; ``a`` is the shorter, or the smaller of two as long.

    Files are streamed, sorted; a task holds one file.  A pair that meets in several files is
    kept by the distinct at the end, which adds up before its shuffle.
    """
    files = filed(vocabulary, most)
    spread = files.repartition(partitions(vocabulary.sparkSession), "m", "left", "right", "file").sortWithinPartitions("m", "left", "right", "file", "word")

    def pairs(m: int, left: int, right: int, found: list[str]) -> Iterator[tuple[str, str]]:
        # What is free of each word: read from the side that isn't given, so that the list's words part early.
        free = lambda w: w[left : len(w) - right]
        turn = (lambda w: free(w)[::-1]) if left == 0 else free
        short = sorted((turn(w), w) for w in found if len(w) == m)
        longer = sorted((turn(w), w) for w in found if len(w) == m + 1)
        keys, long_keys = [x for x, _ in short], [x for x, _ in longer]
        for place, (x, w) in enumerate(short):
            for k in near_in_list(x, keys, place + 1):
                yield min(w, short[k][1]), max(w, short[k][1])
            for k in near_in_list(x, long_keys):
                yield w, longer[k][1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, out = None, [], []
        for b in batches:
            for m, left, right, file, w in zip(*(c.to_pylist() for c in b.columns)):
                if (m, left, right, file) != now:
                    if len(found) > 1:
                        out += pairs(*now[:3], found)
                    now, found = (m, left, right, file), []
                    if len(out) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["a", "b"])
                        out = []
                found.append(w)
        if len(found) > 1:
            out += pairs(*now[:3], found)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["a", "b"])

    out = materialize(spread.mapInArrow(work, "a string, b string").distinct(), "near-words")
    discard(*files._parts)
    return out


def variants(vocabulary: DataFrame, times: int = 10, most: int = FILE_ROWS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``word, n`` (words distinct, no nulls).

    ``form`` is the near word with the largest ``n`` (the smallest word of several) if that is at
    least ``times`` the word's own; ``root`` follows forms to the last.  A form's ``n`` grows
    ``times``-fold at each step, so chains are short; they are followed by doubling.
    """
    known = materialize(vocabulary.select("word", "n"), "words")
    pairs = near_pairs(known, most)
    both = pairs.union(pairs.select("b", "a"))
    other = known.select(F.col("word").alias("b"), F.col("n").alias("_n"))
    # The largest n, then the smallest word: min_by over (-n, word), which is added up before the shuffle.
    best = both.join(other, "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("_n")).alias("minus"), "b")).alias("_best"))
    led = known.join(best, known["word"] == best["a"], "left")
    is_form = -F.col("_best.minus") >= times * F.col("n")
    found = materialize(
        led.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("_best.b")).alias("form"),
            F.when(is_form, -F.col("_best.minus")).alias("form_n"),
        ),
        "forms",
    )
    steps = materialize(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = steps.join(on, "root", "left")
        after = materialize(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        discard(steps)
        steps = after
        if after.where("_moved").isEmpty():
            break
        steps = after.select("word", "root")
        steps._scratch = after._scratch
    out = found.join(steps.select("word", "root"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return variants(words(docs, id_col, text_col))
