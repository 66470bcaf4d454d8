"""Spelling variants: words one edit apart, found by scanning a sorted vocabulary.

For a word, the sorted vocabulary after it is scanned. The rows of the edit matrix (a band of three
cells, as one edit is allowed) belong to prefixes of the listed words, so neighbours in the list
share as many rows as letters; and where a row holds no cell of at most one, all words with that
prefix are skipped at once, up to the next prefix that can follow.

Two words that share their first letters lie close together in the sorted list. Others differ
there, so the rest is equal, and they lie close together in the list of reversed words. Both lists
are cut into blocks of bounded size, and only blocks whose ranges can hold near words are compared.
"""

from __future__ import annotations

import string
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from saleslake.llm.tables import written

MIN_LENGTH = 7
MIN_COUNT = 2
#: A form is at least so many times as frequent as the word.
TIMES = 10
#: One run in so many (by the hash of document and run) loses a letter.
LOSES = 31
#: Words of a block: a power of two, at least this, and so many more that there are at most so many blocks.
BLOCK_BITS = 13
MAX_BLOCKS = 4096
#: Tasks that compare blocks, at most.
MAX_TASKS = 4096
#: Letters of a block's ends that the directory of blocks keeps.
EDGE = 32
#: After every letter that a word can have.
LAST = "\U0010ffff"


# --- Words ------------------------------------------------------------------------


def occurrences(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word`` of every run of letters in ``docs``, some shortened by a letter, of at least ``min_length``.

    A null text has no words; a null id hashes as the empty text. Rows that repeat an id or a
    whole row count each.
    """
    # Runs that are too short from the start are left to the expression; shorter by one they fall below.
    # (A longest run of letters that has enough of them is matched whole.)
    runs = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(f"[A-Za-zÀ-ÿ]{{{max(min_length, 1)},}}"), F.lit(0))
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.explode(runs).alias("run"))
    lowered = found.select(
        F.concat(F.coalesce("doc_id", F.lit("")), F.lit(":")).alias("of"),
        F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"),
    )
    h = F.crc32(F.concat("of", "run"))
    at = F.pmod(h, F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = lowered.select(F.when(h % LOSES == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= min_length)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of every distinct word with enough letters and occurrences."""
    counted = occurrences(docs, min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= min_count)


# --- Near words in sorted lists ------------------------------------------------------


def shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _next_prefix(row: tuple[int, int, int], word: str, d: int, other: str) -> str | None:
    """The least prefix after ``other`` that a near word with the first ``d`` letters of ``other``, whose
    row this is, may have: any next letter while nothing differs, else one of the word's rests."""
    begun, (low, mid, high) = other[:d], row
    if mid == 0:
        return begun + other[d] + LAST
    least = None
    if low < 2 and d and begun + word[d - 1 :] > other:
        least = begun + word[d - 1 :]
    if mid < 2:
        ahead = begun + word[d:]
        if ahead > other and (least is None or ahead < least):
            least = ahead
    if high < 2:
        ahead = begun + word[d + 1 :]
        if ahead > other and (least is None or ahead < least):
            least = ahead
    return least


def near_after(word: str, listed: list[str], lcp: list[int], fixed: int = 0) -> Iterator[str]:
    """The words of a sorted list that come after ``word``, share its first ``fixed`` letters and
    are exactly one edit from it.

    ``lcp[i]`` is the number of letters that ``listed[i]`` shares with ``listed[i - 1]``."""
    i, end = bisect_right(listed, word), len(listed)
    if i == end or len(word) < fixed:
        return
    n = len(word)
    # Row d holds the distances (2 for any above 1) of the first d letters of the word in the list to
    # the first d - 1, d and d + 1 letters of the word; 2 stands outside it, too. At first they are the word's own.
    rows = [(2, 0, 1), *[(1, 0, 1)] * (n - 1), (1, 0, 2)] if n else [(2, 0, 2)]
    shared = shared_prefix(word, listed[i])
    while shared >= fixed:
        other = listed[i]
        del rows[shared + 1 :]
        low, mid, high = rows[-1]
        d = shared
        for letter in other[shared:]:
            # The cells under d, d + 1 and d + 2 letters of the word: the least of replacing, and of
            # leaving out a letter of either. (Comparisons, as min() costs more than all of the rest.)
            first = second = third = 2
            if d <= n:
                first = mid + 1
                if d and low + (word[d - 1] != letter) < first:
                    first = low + (word[d - 1] != letter)
                if d < n:
                    second = mid + (word[d] != letter)
                    if high < second:
                        second = high + 1
                    if first < second:
                        second = first + 1
                    if d + 1 < n:
                        third = high + (word[d + 1] != letter)
                        if second < third:
                            third = second + 1
            if first > 1 and second > 1 and third > 1:
                break
            low, mid, high = first if first < 2 else 2, second if second < 2 else 2, third if third < 2 else 2
            d += 1
            rows.append((low, mid, high))
        else:
            # The distance stands under all letters of the word.
            at = n - d + 1
            if 0 <= at <= 2 and rows[-1][at] == 1:
                yield other
            i += 1
            if i == end:
                return
            shared = lcp[i]
            continue
        # No word with these d + 1 letters is near: on to the next prefix that can be.
        while (ahead := _next_prefix(rows[d], word, d, other)) is None:
            d -= 1
            if d < fixed:
                return
        i = bisect_left(listed, ahead, i + 1)
        if i == end:
            return
        shared = d if listed[i].startswith(other[:d]) else shared_prefix(other[:d], listed[i])


def prefixes(listed: list[str]) -> list[int]:
    return [0, *map(shared_prefix, listed, listed[1:])] if listed else []


def can_be_near(a_first: str, a_last: str, b_first: str, b_last: str, fixed: int) -> bool:
    """Whether a word from the range of one block may be one edit from one of another's, sharing
    its first ``fixed`` letters. Ends are cut to EDGE letters."""
    if a_last[:fixed] < b_first[:fixed] or b_last[:fixed] < a_first[:fixed]:
        return False
    a, b = a_first[: shared_prefix(a_first, a_last)], b_first[: shared_prefix(b_first, b_last)]
    same = shared_prefix(a, b)
    if same == min(len(a), len(b)):
        return True
    if same < fixed:
        return False
    # One edit at the first difference must make the rest equal, as far as both are known.
    rests = (a[same + 1 :], b[same + 1 :]), (a[same + 1 :], b[same:]), (a[same:], b[same + 1 :])
    return any(x.startswith(y) or y.startswith(x) for x, y in rests)


def _compare(fixed: int, reverse: bool, least_shared: int):
    """Of one pair of blocks (or one block with itself), the near words in both directions."""

    def run(table: pa.Table) -> pa.Table:
        sides = [table.filter(pc.equal(table["side"], s)).sort_by("key") for s in (0, 1)]
        listed, counts = [[side[name].to_pylist() for side in sides] for name in ("key", "n")]
        ours, theirs = listed[0], listed[1] or listed[0]
        n_of = dict(zip(theirs, counts[1] or counts[0]))
        lcp = prefixes(theirs)
        words, nears, near_n = [], [], []
        for key, n in zip(ours, counts[0]):
            for other in near_after(key, theirs, lcp, fixed):
                x, y = (key[::-1], other[::-1]) if reverse else (key, other)
                # Pairs that share their first letters are found in the other list.
                if not reverse or x[:least_shared] != y[:least_shared]:
                    words += (x, y)
                    nears += (y, x)
                    near_n += (n_of[other], n)
        return pa.table({"word": pa.array(words, pa.string()), "near": pa.array(nears, pa.string()), "near_n": pa.array(near_n, pa.int64())})

    return run


def _near_in_order(words: DataFrame, total: int, fixed: int, reverse: bool, least_shared: int) -> DataFrame:
    """``word, near, near_n`` of near words that share their first (reversed: last) ``fixed`` letters."""
    bits = max(BLOCK_BITS, (max(total, 1) // MAX_BLOCKS).bit_length())
    key = F.reverse("word") if reverse else F.col("word")
    ordered = words.select(key.alias("key"), "n").repartitionByRange("key").sortWithinPartitions("key")
    # The id counts rows within a partition from a multiple of 2**33: blocks are runs of the sorted list.
    blocks = written(ordered.withColumn("block", F.shiftright(F.monotonically_increasing_id(), bits)), "blocks")
    edge = max(EDGE, fixed)
    ends = blocks.groupBy("block").agg(F.substring(F.min("key"), 1, edge).alias("first"), F.substring(F.max("key"), 1, edge).alias("last"))
    # At most MAX_BLOCKS whole blocks, and one more for each partition, of so many letters a side.
    directory = sorted((r["first"], r["last"], r["block"]) for r in ends.collect())
    firsts = [first[:fixed] for first, _, _ in directory]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for place in batch.column("place").to_pylist():
                first, last, block = directory[place]
                for other in range(place, bisect_left(firsts, last[:fixed] + LAST)):
                    if can_be_near(first, last, directory[other][0], directory[other][1], fixed):
                        a.append(block)
                        b.append(directory[other][2])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    spark = words.sparkSession
    units = written(spark.range(len(directory)).select(F.col("id").alias("place")).mapInArrow(pairs, "a long, b long"), "units")
    ours = units.select("a", "b", F.lit(0).alias("side"), F.col("a").alias("block"))
    theirs = units.filter("a <> b").select("a", "b", F.lit(1).alias("side"), F.col("b").alias("block"))
    members = ours.unionByName(theirs).join(blocks, "block").select("a", "b", "side", "key", "n")
    # Few bytes, but long scans: a task for each pair of blocks, as far as a job of that width goes.
    members = members.repartition(min(max(units.count(), 1), MAX_TASKS), "a", "b")
    return members.groupBy("a", "b").applyInArrow(_compare(fixed, reverse, least_shared), "word string, near string, near_n long")


def near_words(words: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``word, near, near_n``: both directions of every two words of ``words`` (``word, n``, distinct, of
    at least ``min_length`` letters) that differ by one inserted, deleted or replaced letter.

    Of two such words either the first ``(min_length - 1) // 2`` letters are equal, or the edit lies
    among them and at least the last ``min_length - (min_length - 1) // 2`` are."""
    total = words.count()
    head = max((min_length - 1) // 2, 0)
    found = _near_in_order(words, total, head, False, head)
    if head:
        found = found.unionByName(_near_in_order(words, total, min_length - head, True, head))
    return found


# --- Forms and roots -----------------------------------------------------------------


def forms(words: DataFrame, near: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, n, n_near, form_n`` of every word.

    A word's form is its most frequent near word (ties: the least in code-point order), if that is
    ``times`` as frequent. Near words are counted and compared before the shuffle."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    grouped = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    best_n = -F.col("best.less")
    enough = best_n >= times * F.col("n")
    return words.join(grouped, "word", "left").select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, best_n).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """``word, root`` of words that have a form: forms followed to the last.

    A form is more frequent than its word, so there are no rings; each round doubles the steps."""
    up = written(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        jumped = up.join(above, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        jumped = written(jumped, "roots")
        if not jumped.filter("moved").take(1):
            return jumped.select("word", "root")
        up = jumped.select("word", "root")


def spelling_groups(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents.

    Null and empty texts have no words; a table without words gives no rows. Other columns of the
    documents play no part, whatever their names. A run of any length is one word. Ties between
    near words go to the least in code-point order."""
    words = written(vocabulary(docs, min_length, min_count), "words")
    formed = written(forms(words, written(near_words(words, min_length), "near"), times), "forms")
    found = formed.join(roots(formed), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
