"""Lines that recur across documents, found by a log-template tree of fixed depth."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.common import BROADCAST_MAX_ROWS, lean, load, mix64, pieces, stored, texts_of, token_hashes

LEADING = 3
CONSTANT = 0.75
WILD = np.uint64(0x5851F42D4C957F2D)

#: Lines under one block key that one task reads in order; more are keyed by two blocks.
HOT_LINES = 1_000

LINE_SCHEMA = "text_id long, rank long, line int, words int, leaf long, form long, tokens binary"


def line_rows(texts: list[bytes | None]) -> tuple[np.ndarray, ...]:
    """Number of text and line, word count, leaf and masked form of every line that has a word.

    Numbers (words with digits and no letters) are variable fields and hashed alike, unless a line has no other words:
    a template needs a constant. The leaf is the path in the tree: the number of words, then the leading words one
    by one, where all words with a digit take the same branch.
    """
    lines = [line for t in texts for line in (t or b"").split(b"\n")]
    counts = [(t or b"").count(b"\n") + 1 for t in texts]
    text = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(len(lines)) - np.repeat(np.cumsum(counts) - counts, counts)
    hashes, owner = token_hashes(lines)
    sizes = np.bincount(owner, minlength=len(lines))
    if len(hashes):
        digit, number_only = with_digit(lines)
        constant = np.bincount(owner, ~number_only, len(lines)) > 0
        branch = np.where(digit, WILD, hashes)
        hashes = np.where(number_only & constant[owner], WILD, hashes)
    else:
        branch = hashes
    firsts = np.cumsum(sizes) - sizes
    able = np.flatnonzero(sizes > 0)
    leaf = mix64(sizes[able].astype(np.uint64))
    for depth in range(LEADING):
        there = leading(sizes[able]) > depth
        word = np.zeros(len(able), np.uint64)
        word[there] = branch[firsts[able[there]] + depth]
        leaf = mix64(leaf * np.uint64(0x9FB21C651E98DF25) + word)
    place = np.arange(len(hashes)) - firsts[owner] if len(hashes) else np.zeros(0, np.int64)
    mixed = mix64(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
    form = total[firsts[able] + sizes[able]] - total[firsts[able]]
    return text[able], number[able], sizes[able], leaf, mix64(form + leaf), hashes, firsts[able]


def leading(sizes: np.ndarray) -> np.ndarray:
    """Words that lead to a leaf: half of a line, LEADING at most, so that short lines have room for a field."""
    return np.clip(sizes // 2, 1, LEADING)


def with_digit(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word has a digit, and whether it has one and no letter (any byte from 128 on is one)."""
    joined = b"\n".join(lines)
    data = np.frombuffer(joined, np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(np.diff(space.view(np.int8), prepend=1) == -1)
    lower = data | 32
    letter = ((lower >= 97) & (lower <= 122)) | (data >= 128)
    digit = np.add.reduceat(((data >= 48) & (data <= 57)).astype(np.int64), starts) > 0
    return digit, digit & (np.add.reduceat(letter.astype(np.int64), starts) == 0)


def tree_lines(texts: DataFrame, leaves: DataFrame | None = None) -> DataFrame:
    """One narrow row per line; if leaves are given, only lines in them, with their word hashes."""
    keep = leaves is not None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            text, number, words, leaf, form, hashes, firsts = line_rows(texts_of(piece))
            short = hashes.astype(np.uint32)
            ids, ranks = (piece.column(c).to_numpy() for c in range(2))
            tokens = [short[f : f + w].tobytes() for f, w in zip(firsts, words, strict=True)] if keep else [None] * len(text)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[text]),
                    pa.array(ranks[text]),
                    pa.array(number.astype(np.int32)),
                    pa.array(words.astype(np.int32)),
                    pa.array(leaf.view(np.int64)),
                    pa.array(form.view(np.int64)),
                    pa.array(tokens, pa.binary()),
                ],
                names=[c.split()[0] for c in LINE_SCHEMA.split(", ")],
            )

    rows = texts.select("text_id", "rank", "text").mapInArrow(lean(parse), LINE_SCHEMA)
    if leaves is None:
        return rows.drop("tokens")
    some = F.broadcast(leaves) if leaves.count() <= BROADCAST_MAX_ROWS else leaves
    return rows.join(some, "leaf", "left_semi")


def blocks(shared: int):
    """A row for every block of a line: the line's form and rank, and the hash of leaf, block and the block's words.

    The words behind the leading ones (all, where those are too few) are cut into ``shared`` blocks more than may differ,
    so two similar lines share as many. For two shared blocks there is a row for every two blocks of a line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = [np.frombuffer(t, np.uint32) for t in batch.column("tokens").to_pylist()]
            sizes = np.array([len(t) for t in tokens], np.int64)
            n = np.floor((1 - CONSTANT) * sizes).astype(np.int64) + shared
            before = np.where(sizes - leading(sizes) < n, 0, leading(sizes))
            rest = sizes - before
            line = np.repeat(np.arange(len(sizes)), sizes)
            at = np.arange(len(line)) - np.repeat(np.cumsum(sizes) - sizes, sizes) - before[line]
            behind = at >= 0
            line, at = line[behind], at[behind]
            words = np.concatenate(tokens)[behind].astype(np.uint64)
            block = at * n[line] // rest[line]
            starts = np.flatnonzero(np.diff(block, prepend=-1) | np.diff(line, prepend=-1))
            mixed = mix64(words ^ mix64(at.astype(np.uint64) + np.uint64(0x9FB21C651E98DF25)))
            owner = line[starts]
            leaf = batch.column("leaf").to_numpy().view(np.uint64)[owner]
            key = mix64(np.add.reduceat(mixed, starts) ^ mix64(leaf + block[starts].astype(np.uint64)))
            if shared == 2:
                owner, key = in_twos(owner, key, n)
            owner = pa.array(owner)
            columns = [batch.column(c).take(owner) for c in ("form", "rank", "text_id")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(key.view(np.int64))], names=["form", "rank", "text_id", "key"])

    return run


def in_twos(owner: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every two keys of a line as one key; lines have n keys each, in order."""
    firsts, owners, keys = np.cumsum(n) - n, [], []
    for many in np.unique(n):
        a, b = np.triu_indices(many, 1)
        of = np.flatnonzero(n == many)
        one = key[firsts[of][:, None] + a]
        two = key[firsts[of][:, None] + b]
        keys.append(mix64(one + mix64(two ^ np.uint64(0x9E3779B97F4A7C15))).ravel())
        owners.append(np.repeat(owner[firsts[of]], len(a)))
    return np.concatenate(owners), np.concatenate(keys)


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether CONSTANT of the words are equal at their places; places that vary in both rows count for nothing."""
    wild = WILD.astype(np.uint32)
    constant = ((a != wild) | (b != wild)).sum(axis=-1)
    return (a != b).sum(axis=-1) <= (1 - CONSTANT) * constant


def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows with two lines, those whose lines are alike."""
    for batch in batches:
        pairs = zip(batch.column("tokens").to_pylist(), batch.column("others").to_pylist(), strict=True)
        good = [len(a) == len(b) and bool(alike(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32))) for a, b in pairs]
        yield batch.select(["form", "first"]).filter(pa.array(good, pa.bool_()))


def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order of key and rank against the templates of their key; a line that matches none is a new one."""
    key, heads, names = None, np.zeros((0, 0), np.uint32), []
    for batch in batches:
        forms, firsts = [], []
        cols = [batch.column(c).to_pylist() for c in ("key", "form", "rank", "text_id", "tokens")]
        for now, form, rank, text_id, tokens in zip(*cols, strict=True):
            line = np.frombuffer(tokens, np.uint32)
            if now != key or heads.shape[1] != len(line):
                key, heads, names = now, np.zeros((64, len(line)), np.uint32), []
            found = np.flatnonzero(alike(heads[: len(names)], line)) if names else []
            if len(found):
                forms.append(form)
                firsts.append(names[found[0]])
                continue
            if len(names) == len(heads):
                heads = np.concatenate((heads, np.zeros_like(heads)))
            heads[len(names)] = line
            names.append({"rank": rank, "text_id": text_id})
        kind = pa.struct([("rank", pa.int64()), ("text_id", pa.int64())])
        yield pa.RecordBatch.from_arrays([pa.array(forms, pa.int64()), pa.array(firsts, kind)], names=["form", "first"])


LINK_SCHEMA = "form long, first struct<rank: long, text_id: long>"


def generalised(lines: DataFrame, hot_lines: int = HOT_LINES, shared: int = 1) -> DataFrame:
    """Forms that match the template of an earlier one: (form, first), of (form, leaf, rank, text_id, tokens).

    Under every key of a block, all lines are compared with the earliest. Those that match none and are still
    two or more under a key are then read in order and compared with each template found under the key. If more than
    `hot_lines` are left under a key, its lines go through the same steps by two blocks they share.
    """
    placed = stored(lines.mapInArrow(lean(blocks(shared)), "form long, rank long, text_id long, key long"), "blocks")
    order = F.struct("rank", "text_id", "form")
    heads = placed.groupBy("key").agg(F.min(order).alias("head"), F.max(order).alias("end")).where("head <> end")
    heads = stored(heads.select("key", "head"), "heads")
    shared = placed.join(heads, "key").where("form <> head.form")
    pairs = shared.select("form", F.col("head.form").alias("other"), F.struct("head.rank", "head.text_id").alias("first")).distinct()
    tokens = lines.select("form", "tokens")
    pairs = pairs.join(tokens, "form").join(tokens.toDF("other", "others"), "other")
    links = stored(pairs.select("form", "first", "tokens", "others").mapInArrow(lean(similar), LINK_SCHEMA), "links")
    left = shared.join(links.select("form").distinct(), "form", "left_anti").select("key", "form", "rank", "text_id")
    left = stored(left, "left")
    counts = left.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    counts = stored(counts, "counts")
    usual = counts.where(F.col("n") <= hot_lines) if shared == 1 else counts
    hot = counts.where(F.col("n") > hot_lines)
    if shared == 1 and not hot.isEmpty():
        crowded = left.join(hot.select("key"), "key", "left_semi").select("form").distinct()
        again = stored(lines.join(crowded, "form", "left_semi"), "crowded")
        links = links.unionByName(generalised(again, hot_lines, 2))
    left = left.join(usual.select("key"), "key", "left_semi").join(tokens, "form").repartition("key")
    left = left.sortWithinPartitions("key", "rank", "text_id", "form").select("key", "form", "rank", "text_id", "tokens")
    return links.unionByName(left.mapInArrow(lean(matched), LINK_SCHEMA))


def recurring(texts: DataFrame, hot_lines: int = HOT_LINES) -> DataFrame:
    """Lines to drop: (text_id, line), of texts (text_id, rank, text) that are all different.

    1. Lines are parsed into the leaves of the tree; leaves of one text alone are left.
    2. Lines of one masked form in several texts recur.
    3. Forms in one leaf are generalised: a form matches the template of an earlier one if CONSTANT of their words are
       equal at their places, everything else is a variable field. In lines of three words none may differ.
    Of lines with one form or template, those in the text of the lowest rank stay, all others are dropped.
    Forms of more texts than a share of all (so at most BROADCAST_MAX_ROWS of them) are sent to the lines, not the
    lines to them.
    """
    ends = (F.min(F.struct("rank", "text_id")).alias("first"), F.max(F.struct("rank", "text_id")).alias("last"))
    lines = tree_lines(texts)
    leaves = lines.groupBy("leaf").agg(*ends).where("first <> last").select("leaf")
    parsed = stored(tree_lines(texts, stored(leaves, "leaves")), "parsed")
    once = parsed.select("form", "words", "leaf", "rank", "text_id").distinct()
    forms = stored(once.groupBy("form", "words", "leaf").agg(*ends, F.count("*").alias("texts")), "forms")
    exact = forms.where("texts >= 2").select("form", "first", "texts")

    able = F.col("words") * (1 - CONSTANT) >= 1
    heads = forms.where(able).select("form", F.expr("first.text_id AS text_id"), F.expr("first.rank AS rank"))
    lines = parsed.where(able).join(heads, ["form", "text_id", "rank"]).dropDuplicates(["form"])
    general = generalised(stored(lines.select("form", "leaf", "rank", "text_id", "tokens"), "representatives"), hot_lines)
    drops = exact.unionByName(general.withColumn("texts", F.lit(1).cast("long")))
    drops = stored(drops.groupBy("form").agg(F.min("first").alias("first"), F.max("texts").alias("texts")), "forms-dropped")
    least = max(hot_lines, (exact.agg(F.sum("texts")).first()[0] or 0) // BROADCAST_MAX_ROWS)
    crowd = F.broadcast(drops.where(F.col("texts") > least).select("form", F.col("first").alias("_first")))
    at = parsed.select("form", "text_id", "line").join(crowd, "form", "left")
    usual = at.where("_first IS NULL").drop("_first").join(drops.select("form", "first"), "form")
    found = usual.unionByName(at.where("_first IS NOT NULL").withColumnRenamed("_first", "first"))
    return found.where("text_id <> first.text_id").select("text_id", "line")


def without_recurring_lines(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Drop lines whose template recurs across documents; the first document that has it keeps it.

    Returns the columns of `docs` and `n_lines`, `dropped_lines`, `kept_words`, `words`. Blank lines are
    no templates. Copies of a whole text count as one text, named by its smallest id, and are treated alike, so
    that they stay copies. A text that keeps no words becomes empty. Null and empty texts stay as they are; repeated rows are copies; rows
    without an id rank as id 0. Columns of `docs` with a name of the four, and text_id, own and _drops, are left out.
    """
    added = ["n_lines", "dropped_lines", "words", "kept_words"]
    docs = docs.drop(*added, "text_id", "own", "_drops")
    own = F.coalesce(F.col(id_column).cast("long"), F.lit(0))
    marked = docs.withColumn("text_id", F.xxhash64("text", F.length("text"))).withColumn("own", own)
    heads = marked.where("text IS NOT NULL").groupBy("text_id").agg(F.min("own").alias("rank"), F.count("*").alias("n"))
    copied = stored(heads.where("n > 1").select("text_id", "rank"), "copied")
    some = F.broadcast(copied) if copied.count() <= BROADCAST_MAX_ROWS else copied
    texts = marked.join(some, "text_id", "left").withColumn("rank", F.coalesce("rank", "own"))
    texts = texts.where("text IS NOT NULL AND rank = own").select("text_id", "rank", "text")
    drops = stored(recurring(texts).groupBy("text_id").agg(F.collect_set("line").alias("_drops")), "drops")
    some = F.broadcast(drops) if drops.count() <= BROADCAST_MAX_ROWS else drops
    joined = marked.join(some, "text_id", "left")
    others = [c for c in docs.columns if c != "text"]

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            texts, lines, gone, words, left = [], [], [], [], []
            for text, drop in zip(texts_of(piece), piece.column("_drops").to_pylist(), strict=True):
                parts = text.split(b"\n") if text is not None else []
                total = len(text.split()) if text else 0
                kept = total
                if drop:
                    out = set(drop)
                    rest = [x for i, x in enumerate(parts) if i not in out]
                    text = b"\n".join(rest)
                    kept = len(text.split())
                    if not kept:
                        text, out = b"", set(range(len(parts)))
                    drop = out
                texts.append(text)
                lines.append(len(parts))
                gone.append(len(drop or ()))
                words.append(total)
                left.append(kept)
            yield pa.RecordBatch.from_arrays(
                [
                    *[piece.column(c) for c in others],
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(lines, pa.int32()),
                    pa.array(gone, pa.int32()),
                    pa.array(words, pa.int64()),
                    pa.array(left, pa.int64()),
                ],
                names=[*others, "text", *added],
            )

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in others], "text string, n_lines int, dropped_lines int", "words long, kept_words long"])
    result = joined.select(*others, "text", "_drops").mapInArrow(lean(rebuild), schema)
    return result.select(*docs.columns, *added)


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents").select("doc_id", "text")
    return without_recurring_lines(documents)
