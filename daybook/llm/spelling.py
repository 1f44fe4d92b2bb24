"""Spelling variants: words one edit apart, found by an index of variable-length grams.

A dictionary holds the grams of three and four characters that are frequent among
the words, and only while the gram without its last character is held too; it is as
small as ``LISTED`` says, whatever the input. A padded word is cut into the longest
held gram at every place (two characters where none is held), without the grams
that lie inside an earlier one. An edit changes only the grams that end within a few
characters of it; for every place a word's bounds tell which these are, and the same
grams lie outside them in the word that the edit makes. So two words one edit apart
agree on the rarest grams outside: a word is listed once for each choice of the
``SHARED`` rarest that some place leaves, with the distance of each gram from the end
of the word that the edit does not move. What meets in a list is verified.

Defined results: null and repeated words count once, with the sum of their numbers;
words below ``SHORTEST`` code points are returned without near words; a null text
has no words; a null document id reads as an empty text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written

#: Lengths of grams, and the padding at both ends of a word.
LEAST, MOST, PAD = 2, 4, 3
#: Rarest grams that words are listed by, and the length from which on every place leaves two at least.
SHARED, SHORTEST = 3, 7
#: Grams of a length that the dictionary holds at most, and that have a known frequency.
LISTED = 1 << 15
#: Words of a list that are compared with each other; longer lists are split by what an edit leaves.
CROWDED = 256
#: How much more frequent the form of a word is.
RATIO = 10

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[A-Za-zÀ-ÿ]"
_HEAD, _TAIL = "\x02" * PAD, "\x03" * PAD


def _mix(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """64-bit hash of two hashes; equal inputs give equal hashes."""
    with np.errstate(over="ignore"):
        x = (a ^ (np.asarray(b, np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(29))


class _Cut:
    """Padded words end to end, with the grams of every length at every place."""

    def __init__(self, words: list[str]) -> None:
        padded = "".join(f"{_HEAD}{w}{_TAIL}" for w in words)
        code = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.sizes = np.array([len(w) + 2 * PAD for w in words], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.of_place = np.repeat(np.arange(len(words)), self.sizes)
        # Characters from a place to the end of its word.
        self.left = np.repeat(self.starts + self.sizes, self.sizes) - np.arange(len(code))
        self.gram = {1: code}
        for q in range(2, MOST + 1):
            longer = np.zeros_like(code)
            longer[: len(code) - q + 1] = _mix(self.gram[q - 1][: len(code) - q + 1], code[q - 1 :])
            self.gram[q] = longer


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values a sorted table holds."""
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


class Grams:
    """Held grams of each length, and the frequencies of all grams that are not rare."""

    def __init__(self, counts: Iterable[tuple[int, int, int, int]]) -> None:
        """``counts``: length, gram, the gram without its last character, number."""
        rows = sorted((q, np.uint64(gram % 2**64), np.uint64(head % 2**64), n) for q, gram, head, n in counts)
        column = lambda q, k, kind=np.uint64: np.array([x[k] for x in rows if x[0] == q], kind)
        self.known = {q: column(q, 1) for q in range(LEAST, MOST + 1)}
        self.number = {q: column(q, 3, np.int64) for q in self.known}
        self.held = {LEAST + 1: self.known[LEAST + 1]}
        for q in range(LEAST + 2, MOST + 1):
            self.held[q] = self.known[q][_in(column(q, 2), self.held[q - 1])]

    def frequency(self, q: np.ndarray, gram: np.ndarray) -> np.ndarray:
        """How often a gram occurs; 0 for the rare ones the dictionary does not know."""
        out = np.zeros(len(gram), np.int64)
        for length, table in self.known.items():
            mine = np.flatnonzero((q == length) & _in(gram, table))
            out[mine] = self.number[length][np.searchsorted(table, gram[mine])]
        return out

    def cut(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Grams of words, the rarest of each word first: (word, start, end, hash)."""
        c = _Cut(words)
        longest = np.full(len(c.left), LEAST, np.int64)
        for q in range(LEAST + 1, MOST + 1):
            longest[(longest == q - 1) & (c.left >= q) & _in(c.gram[q], self.held[q])] = q
        places = np.flatnonzero(c.left >= LEAST)
        ends = places + longest[places]
        # Kept if it reaches further than all grams before it; those of earlier words end before this one begins.
        kept = ends > np.concatenate(([0], np.maximum.accumulate(ends)[:-1]))
        start, end = places[kept], ends[kept]
        q, word = end - start, c.of_place[start]
        gram = np.choose(q - LEAST, [c.gram[k][start] for k in range(LEAST, MOST + 1)])
        order = np.lexsort((start, gram, self.frequency(q, gram), word))
        first = c.starts[word]
        return word[order], (start - first)[order], (end - first)[order], gram[order]


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of the runs of these sizes."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = _Cut(batch.column(0).to_pylist())
        for q in range(LEAST, MOST + 1):
            at = np.flatnonzero(c.left >= q)
            gram, first, n = np.unique(c.gram[q][at], return_index=True, return_counts=True)
            head = c.gram[q - 1][at[first]]
            yield pa.RecordBatch.from_pydict(
                {"q": np.full(len(gram), q, np.int32), "gram": gram.view(np.int64), "head": head.view(np.int64), "n": n.astype(np.int64)}
            )


def dictionary(words: DataFrame) -> Grams:
    """The frequent grams of the column ``word``: those with a share of 1 in ``LISTED`` of all places or more.

    So many are at most ``LISTED`` of each length, however many words there are.
    """
    places = words.agg(F.sum(F.length("word") + 2 * PAD)).first()[0] or 0
    counts = (
        words.select("word")
        .mapInArrow(_count_grams, "q int, gram long, head long, n long")
        .groupBy("q", "gram")
        .agg(F.max("head").alias("head"), F.sum("n").alias("n"))
        .where(F.col("n") * LISTED >= places)
    )
    return Grams(tuple(r) for r in counts.collect())  # 3 * LISTED rows at most


def _keys(grams: Grams, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, key): each word once under every choice of its rarest grams that an edit leaves."""
    word, start, end, gram = grams.cut(words)
    sizes = np.bincount(word, minlength=len(words))
    first = np.cumsum(sizes) - sizes
    # An edit reaches grams of at most MOST + 1 different ends; so many more cover what it leaves.
    rank = np.arange(MOST + 1 + SHARED)
    there = rank < sizes[:, None]
    at = np.minimum(first[:, None] + rank, len(word) - 1)
    # A word of n characters has n places to replace or delete at and n + 1 to insert at.
    length = np.array([len(w) for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), 2 * length + 1)
    step = _within(2 * length + 1)
    left = PAD + step // 2  # characters before it
    right = PAD + (step + 1) // 2  # where the characters behind it begin
    ends = end[at][owner]
    before, behind = ends < left[:, None], ends >= right[:, None] + MOST
    alive = there[owner] & (before | behind)
    met = np.cumsum(alive, axis=1)
    key = np.zeros(len(owner), np.uint64)
    for k in range(1, SHARED + 1):
        found = met[:, -1] >= k
        pick = (np.arange(len(owner)), (met >= k).argmax(axis=1))
        chosen = at[owner, pick[1]]
        from_left = before[pick]
        offset = np.where(from_left, start[chosen], length[owner] + 2 * PAD - start[chosen])
        key = np.where(found, _mix(_mix(key, gram[chosen]), offset * 2 + from_left), key)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    return owner[new], key[new]


def _postings(grams: Grams) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(key, word, n)"""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                owner, key = _keys(grams, batch.column(0).to_pylist())
                words = [c.take(pa.array(owner)) for c in batch.columns]
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *words], names=["key", "word", "n"])

    return listed


def _kept_by_an_edit(word: Column) -> Column:
    """The word, and the word without each of its characters."""
    without = F.transform(
        F.sequence(F.lit(1), F.length(word)),
        lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))),
    )
    return F.array_distinct(F.concat(F.array(word), without))


def _met(rows: DataFrame, *by: str) -> DataFrame:
    """Pairs of words one edit apart that share ``by``."""
    a, b = rows.alias("a"), rows.alias("b")
    near = (
        reduce(and_, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in by])
        & (F.col("a.word") < F.col("b.word"))
        & (F.abs(F.length("a.word") - F.length("b.word")) <= 1)
        & (F.levenshtein("a.word", "b.word", 1) == 1)
    )
    return a.join(b, near).select(
        F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n), both ways, of all words that one edit makes equal.

    ``words`` holds each ``word`` of ``SHORTEST`` code points or more once, with a
    number ``n``; it is read three times.
    """
    grams = dictionary(words)
    postings = written(words.select("word", "n").mapInArrow(_postings(grams), "key long, word string, n long"), "postings")
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    lists = written(postings.join(sizes, "key"), "lists")
    crowded = lists.where(F.col("size") > CROWDED).withColumn("left_over", F.explode(_kept_by_an_edit(F.col("word"))))
    pairs = _met(lists.where(F.col("size") <= CROWDED), "key").unionByName(_met(crowded, "key", "left_over")).distinct()
    once = written(pairs, "near_words")
    back = once.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return once.unionByName(back)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that follow each other. Each round doubles the steps."""
    links = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(links.join(further, "root", "left").select("word", "root", "further"), "roots")
        links = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further is not null").isEmpty():
            return links


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n).

    The form is the most frequent near word (the least of equally frequent ones) if
    it is ``ratio`` times as frequent as the word; the root ends the chain of forms.
    """
    counted = words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    known = written(counted, "words")
    near = near_words(known.where(F.length("word") >= SHORTEST))
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near"))).alias("best")
    )
    is_form = -F.col("best.m") >= ratio * F.col("n")
    judged = written(
        known.join(best, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("best.m")).alias("form_n"),
        ),
        "judged",
    )
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int = 31, least: int = 2) -> DataFrame:
    """(word, n): lower-cased runs of letters that occur ``least`` times or more.

    One run in ``every``, told by its document and itself, loses a character first, so
    that the corpus holds slips of the pen at a known rate.
    """
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(low, F.lit(f"{RUN}{{{SHORTEST},}}"), 0)).alias("run"),
    )
    hashed = runs.select("run", F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slip = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (
        hashed.select(F.when(F.col("h") % every == 0, slip).otherwise(F.col("run")).alias("word"))
        .where(F.length("word") >= SHORTEST)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least)
    )
