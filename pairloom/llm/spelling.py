"""Spelling variants: words one edit apart, found in a trie of letter-group counts."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import lean, load, pieces, stored, texts_of
from pairloom.session import broadcast_if, fits_broadcast

# Runs of letters, in UTF-8 with A-Z in lower case.
LETTERS = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])+")
GROUPS = 16
RUN = 10_000
WIDE = 48
BLOCK = 2048
FRONTIER = 400_000
PAIRS = 200_000
FLUSH = 400_000
SENDERS = 8

COUNT_SCHEMA = "word string, n long"
RUN_SCHEMA = "run long, low binary, high binary, words array<string>, counts array<long>"
SENT_SCHEMA = "target long, share int, own int, words array<string>, counts array<long>"
NEAR_SCHEMA = "word string, n long, n_near long, best struct<rank: long, form: string>"


def cut_word(word: bytes, place: int) -> bytes:
    """The word without its code point at a place, from 0."""
    letters = word.decode()
    return (letters[:place] + letters[place + 1 :]).encode()


def word_counts(docs: DataFrame, divisor: int | None = None, id_column: str = "doc_id") -> DataFrame:
    """Every distinct run of letters with its number of occurrences.

    If a divisor is given, a run loses a letter wherever the crc32 of `<id>:<run>` is divisible by it. Tasks count
    before the shuffle, and send on what they hold when it grows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            keys = pa.array(list(held), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([keys, pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for piece in pieces(batches):
            for doc_id, text in zip(piece.column(0).to_pylist(), texts_of(piece), strict=True):
                words = LETTERS.findall(text.lower()) if text else []
                if divisor and words:
                    start = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
                    start = zlib.crc32(b":", start)
                    h = np.array([zlib.crc32(w, start) for w in words])
                    for i in np.flatnonzero(h % divisor == 0).tolist():
                        words[i] = cut_word(words[i], int(h[i]) % len(words[i].decode()))
                held.update(words)
            if len(held) > FLUSH:
                yield flush()
                held.clear()
        if held:
            yield flush()

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    found = rows.mapInArrow(lean(count), COUNT_SCHEMA)
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def matrix(words: list[bytes]) -> np.ndarray:
    """Letters of words that have one byte for each, cut to WIDE and filled up with zeros."""
    return np.frombuffer(b"".join(w[:WIDE].ljust(WIDE, b"\0") for w in words), np.uint8).reshape(len(words), WIDE)


def group_counts(words: list[bytes]) -> np.ndarray:
    """How many letters of each group a word has; a letter's group is its number modulo GROUPS.

    Counts above 255 are 255, which can only bring words nearer.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer(b"".join(words), np.uint8) % GROUPS
    code = np.repeat(np.arange(len(words)), sizes) * GROUPS + letters
    found = np.bincount(code, minlength=len(words) * GROUPS)
    return np.minimum(found, 255).astype(np.uint8).reshape(len(words), GROUPS)


def latin(words: list[str]) -> list[bytes]:
    return [w.encode("latin-1") for w in words]


class Trie:
    """Words in order of their group counts; a node of depth d is a distinct sequence of the first d counts.

    Edges are kept level by level as sorted numbers (node, count), whose places are the nodes of the next level.
    """

    def __init__(self, vectors: np.ndarray):
        """`vectors` are the group counts of the words, row by row in ascending order."""
        n = len(vectors)
        self.edges: list[np.ndarray] = []
        node = np.zeros(n, np.int64)
        new = np.zeros(n, bool)
        new[:1] = True
        for level in range(GROUPS):
            column = vectors[:, level].astype(np.int64)
            new[1:] |= column[1:] != column[:-1]
            firsts = np.flatnonzero(new)
            self.edges.append(node[firsts] * 256 + column[firsts])
            node = np.cumsum(new) - 1
        self.starts = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.starts, n))

    def search(self, queries: np.ndarray, block: int = BLOCK, frontier: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, place of a word) whose counts are equal, or first differ by a surplus of the word's.

        Depth first: a set of searches at one depth is taken one level on and laid on the stack again, in two halves if it
        has grown too large, so that memory is bounded. A search may spend a surplus of one, and then a
        deficit of one; the words that first have a deficit find the query when they are asked for themselves.
        """
        stack = []
        for a in range(0, len(queries), block):
            asked = np.arange(a, min(a + block, len(queries)))
            stack.append((0, asked, np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int8)))
        while stack:
            level, asked, node, spent = stack.pop()
            if level == GROUPS:
                for a, b in chunks(self.sizes[node], PAIRS):
                    sizes = self.sizes[node[a:b]]
                    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    yield np.repeat(asked[a:b], sizes), np.repeat(self.starts[node[a:b]], sizes) + inner
                continue
            if len(asked) > frontier:
                half = len(asked) // 2
                stack.append((level, asked[half:], node[half:], spent[half:]))
                stack.append((level, asked[:half], node[:half], spent[:half]))
                continue
            count = queries[asked, level].astype(np.int64)
            more = np.flatnonzero(spent == 0)
            less = np.flatnonzero((spent == 1) & (count > 0))
            who = np.concatenate((np.arange(len(asked)), more, less))
            change = np.repeat([0, 1, -1], [len(asked), len(more), len(less)])
            wanted = count[who] + change
            key = node[who] * 256 + wanted
            at = np.minimum(np.searchsorted(self.edges[level], key), len(self.edges[level]) - 1)
            there = np.flatnonzero((self.edges[level][at] == key) & (wanted <= 255))
            who = who[there]
            stack.append((level + 1, asked[who], at[there], spent[who] + (change[there] != 0).astype(np.int8)))


def chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries with about `most` in total, one entry at least."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) < len(b):
        a, b = b, a
    if a == b or len(a) - len(b) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    return a[i + 1 :] == b[i + (len(a) == len(b)) :]


def verified(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """`one_edit` of many pairs of short words, given as rows of letters and lengths."""
    swap = n_left < n_right
    long = np.where(swap[:, None], right, left)
    short = np.where(swap[:, None], left, right)
    gap = np.abs(n_left - n_right)
    differ = long != short
    replaced = (gap == 0) & (differ.sum(axis=1) == 1)
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), WIDE)
    moved = np.concatenate((long[:, 1:], np.zeros((len(long), 1), np.uint8)), axis=1) != short
    behind = moved & (np.arange(WIDE) >= first[:, None])
    return replaced | ((gap == 1) & ~behind.any(axis=1))


class Words:
    """A run of words as arrays."""

    def __init__(self, words: list[str], counts: list[int]):
        self.text, self.letters = words, latin(words)
        self.counts = np.array(counts, np.int64)
        self.sizes = np.array([len(w) for w in self.letters], np.int64)
        self.matrix = matrix(self.letters)
        self.vectors = group_counts(self.letters)
        order = sorted(range(len(words)), key=self.letters.__getitem__)
        self.rank = np.empty(len(words), np.int64)
        self.rank[order] = np.arange(len(words))


def near_pairs(asked: Words, stock: Words, trie: Trie, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs (asked word, stock word), each once if both are of one run."""
    for left, right in trie.search(asked.vectors):
        good = np.abs(asked.sizes[left] - stock.sizes[right]) <= 1
        if own:
            # words of equal counts find each other, all others only the later the earlier
            same = (asked.vectors[left] == stock.vectors[right]).all(axis=1)
            good &= ~same | (left < right)
        left, right = left[good], right[good]
        short = np.maximum(asked.sizes[left], stock.sizes[right]) <= WIDE
        good = np.zeros(len(left), bool)
        some = np.flatnonzero(short)
        a, b = left[some], right[some]
        good[some] = verified(asked.matrix[a], stock.matrix[b], asked.sizes[a], stock.sizes[b])
        for i in np.flatnonzero(~short).tolist():
            good[i] = one_edit(asked.letters[left[i]], stock.letters[right[i]])
        yield left[good], right[good]


def summary(words: Words, others: Words, mine: np.ndarray, theirs: np.ndarray) -> pa.RecordBatch:
    """For each word met in pairs: how many partners it has here, and the most frequent one, first in order of letters."""
    order = np.lexsort((others.rank[theirs], -others.counts[theirs], mine))
    mine, theirs = mine[order], theirs[order]
    firsts = np.flatnonzero(np.diff(mine, prepend=-1))
    found = np.diff(np.append(firsts, len(mine)))
    at, best = mine[firsts].tolist(), theirs[firsts].tolist()
    return near_batch(
        [words.text[i] for i in at], words.counts[mine[firsts]], found, -others.counts[theirs[firsts]], [others.text[i] for i in best]
    )


def near_batch(words, counts, found, ranks, forms) -> pa.RecordBatch:
    best = pa.StructArray.from_arrays([pa.array(ranks, pa.int64()), pa.array(forms, pa.string())], names=["rank", "form"])
    if found is None:
        best = pa.nulls(len(words), best.type)
        found = np.zeros(len(words), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(found, pa.int64()), best],
        names=["word", "n", "n_near", "best"],
    )


def runs(words: DataFrame, run: int = RUN) -> DataFrame:
    """Subtries: runs of at most `run` words that follow one another in order of their group counts, with their bounds.

    Words are sorted in ranges over the cluster, and a run is cut by number, so that no vector, however many words
    have it, makes a run larger than others.
    """

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = group_counts(latin(batch.column("word").to_pylist()))
            column = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), column], names=["word", "n", "vector"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, held, size = TaskContext.get().partitionId() << 32, [], 0

        def packed(some: pa.Table) -> pa.RecordBatch:
            bounds = np.frombuffer(b"".join(some.column("vector").to_pylist()), np.uint8).reshape(-1, GROUPS)
            values = [[number], [bounds.min(axis=0).tobytes()], [bounds.max(axis=0).tobytes()]]
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
            values += [[some.column("word").to_pylist()], [some.column("n").to_pylist()]]
            names = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= run:
                table = pa.Table.from_batches(held)
                yield packed(table.slice(0, run))
                number += 1
                held, size = table.slice(run).to_batches(), size - run
        if size:
            yield packed(pa.Table.from_batches(held))

    vectored = words.mapInArrow(lean(vectors), "word string, n long, vector binary")
    tasks = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = vectored.repartitionByRange(tasks, "vector", "word").sortWithinPartitions("vector", "word")
    return stored(ordered.mapInArrow(lean(cut), RUN_SCHEMA), "runs")


def sent(parts: DataFrame) -> DataFrame:
    """Every run for itself, and those of its words that may find something in a later run for that one.

    What a word may reach is told by the bounds of the runs: one surplus over all groups and one deficit. The bounds of all
    runs are broadcast: 2 * GROUPS bytes for RUN words. A run that SENDERS others or more send words to is there in as
    many copies, each of which gets the words of some of them.
    """
    rows = sorted((r["run"], bytes(r["low"]), bytes(r["high"])) for r in parts.select("run", "low", "high").collect())
    names = np.array([r[0] for r in rows], np.int64)
    lows, highs = (
        np.frombuffer(b"".join(r[i] for r in rows), np.uint8).reshape(-1, GROUPS).astype(np.int16) for i in (1, 2)
    )
    shipped = parts.sparkSession.sparkContext.broadcast((names, lows, highs))

    def reached(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """Whether a change of one surplus and one deficit leads from somewhere between two bounds to between the others."""
        return (np.maximum(lows - high, 0).sum(axis=-1) <= 1) & (np.maximum(low - highs, 0).sum(axis=-1) <= 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, lows, highs = shipped.value
        columns = [c.split()[0] for c in SENT_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64())]
        known: dict[int, int] = {}

        def copies(i: int) -> int:
            if i not in known:
                known[i] = 1 + int(reached(lows[:i], highs[:i], lows[i], highs[i]).sum()) // SENDERS
            return known[i]

        def row(*values) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=columns)

        for batch in batches:
            for run, words, counts in zip(*(batch.column(c).to_pylist() for c in ("run", "words", "counts")), strict=True):
                here = int(np.searchsorted(names, run))
                vectors = group_counts(latin(words)).astype(np.int16)
                for share in range(copies(here)):
                    yield row(run, share, 1, words, counts)
                near = np.flatnonzero(reached(lows[here], highs[here], lows[here + 1 :], highs[here + 1 :])) + here + 1
                for other in near.tolist():
                    some = np.flatnonzero(reached(vectors, vectors, lows[other], highs[other])).tolist()
                    if some:
                        share = here % copies(other)
                        yield row(names[other], share, 0, [words[i] for i in some], [counts[i] for i in some])

    return parts.mapInArrow(lean(send), SENT_SCHEMA)


def neighbours(words: DataFrame, run: int = RUN) -> DataFrame:
    """Every word (word, n, both not null) with the number of words one edit away and the best of these.

    The best has the largest n, and is the first in order of code points among equals: (rank: -n, form).
    """
    parts = runs(words, run)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stock, trie, here = None, None, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("target", "share", "own", "words", "counts"))
            for target, share, own, texts, counts in zip(*columns, strict=True):
                asked = Words(texts, counts)
                if own:
                    stock, trie, here = asked, Trie(asked.vectors), (target, share)
                    if share:
                        continue
                    yield near_batch(texts, asked.counts, None, [], [])
                if here != (target, share):
                    raise RuntimeError("words came for a run that is not there")
                for left, right in near_pairs(asked, stock, trie, bool(own)):
                    if len(left):
                        yield summary(asked, stock, left, right)
                        yield summary(stock, asked, right, left)

    dealt = sent(parts).repartition("target", "share").sortWithinPartitions("target", "share", F.desc("own"))
    found = dealt.mapInArrow(lean(match), NEAR_SCHEMA)
    return found.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )


def followed(forms: DataFrame) -> DataFrame:
    """Add `root`, the last word on the way from form to form; the word itself if it has none.

    A form is at least twice as frequent as its word, so the way has no circle and no more than 63 steps; every round
    doubles the part of it that is known.
    """
    step = forms.where("form IS NOT NULL").select(F.col("word").alias("via"), F.col("form").alias("onto"))
    step = stored(step, "forms")
    rows, size = step.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("via") + F.octet_length("onto")), F.lit(0))).first()
    while rows:
        fits = fits_broadcast(rows, size)
        longer = step.alias("a").join(broadcast_if(step.alias("b"), fits), F.col("a.onto") == F.col("b.via"), "left")
        moved = F.col("b.onto").isNotNull()
        longer = longer.select("a.via", F.coalesce("b.onto", "a.onto").alias("onto"), moved.alias("moved"))
        longer = stored(longer, "followed")
        step = longer.select("via", "onto")
        if longer.where("moved").isEmpty():
            break
    ends = broadcast_if(step, fits_broadcast(rows, size))
    joined = forms.join(ends, F.col("word") == F.col("via"), "left")
    return joined.withColumn("root", F.coalesce("onto", "word")).drop("via", "onto")


def spelling_variants(words: DataFrame, ratio: int = 2, run: int = RUN) -> DataFrame:
    """Word, its form (the most frequent word one edit away, if `ratio` times as frequent), and the end of that way.

    `words` has distinct words of letters up to U+00FF and their counts; rows without word or count are left out, an
    empty table gives no rows. Ties go to the first word in order of code points. Very long words are compared whole.
    """
    known = words.select("word", F.col("n").cast("long").alias("n")).dropna()
    near = neighbours(known, run)
    frequent = F.coalesce(-F.col("best.rank") >= ratio * F.col("n"), F.lit(False))
    forms = near.select(
        "word",
        F.when(frequent, F.col("best.form")).alias("form"),
        "n",
        "n_near",
        F.when(frequent, -F.col("best.rank")).alias("form_n"),
    )
    return followed(stored(forms, "near")).select("word", "form", "root", "n", "n_near", "form_n")


def corpus_words(docs: DataFrame, least: int = 3, letters: int = 5, divisor: int | None = None) -> DataFrame:
    """Words of `letters` letters or more that occur `least` times or more in all texts, with their counts.

    Null and empty texts have none; repeated rows count one by one; rows without an id hash an empty one.
    """
    found = word_counts(docs, divisor).where((F.col("n") >= least) & (F.char_length("word") >= letters))
    return stored(found, "words")


def op11_frequency_vector_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(corpus_words(load(spark, sf_dir, "documents"), divisor=97))
