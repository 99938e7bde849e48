"""Jaccard links between documents by a grouped prefix join over word n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.llm.common import (
    BROADCAST_MAX_ROWS,
    VECTOR_SCHEMA,
    gathered,
    lean,
    load,
    mix64,
    pieces,
    stored,
    texts_of,
    token_hashes,
    vector_batch,
    vector_rows,
)
from pairloom.llm.components import components
from pairloom.session import fits_broadcast

SKETCH_BITS = 19
CROWDED = 64
CROWDED_ROWS = 1000
NONE = np.empty(0, np.uint64)


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text.

    A text of fewer words has one n-gram, the whole sequence; without words it has none.
    """
    hashes, doc = token_hashes(texts)
    counts = np.bincount(doc, minlength=len(texts))
    firsts = np.cumsum(counts) - counts
    n = len(hashes) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        rolled = mix64(rolled * np.uint64(0x9FB21C651E98DF25) + hashes[k : k + max(n, 0)])
    sets = []
    for first, count in zip(firsts.tolist(), counts.tolist(), strict=True):
        if count >= width:
            sets.append(np.unique(rolled[first : first + count - width + 1]))
        elif count:
            one = np.array([count], np.uint64)
            for h in hashes[first : first + count]:
                one = mix64(one * np.uint64(0x9FB21C651E98DF25) + h)
            sets.append(one)
        else:
            sets.append(NONE)
    return sets


def prefix_size(n: int, percent: int) -> int:
    """How many of n elements, in a common order, hold one of any set that is similar enough."""
    return n - -(-percent * n // 100) + 1


def shingle_loads(docs: DataFrame, width: int) -> np.ndarray:
    """How often each of 2**SKETCH_BITS hash buckets is hit by the n-grams of all documents.

    The vector has a fixed size whatever the corpus, so it may be sent to all executors. It only
    decides the order of n-grams, rare buckets first; any order gives the same links.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(1 << SKETCH_BITS)
        for piece in pieces(batches):
            for found in shingle_sets(texts_of(piece), width):
                np.add.at(load, (found & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), 1)
        if load.any():
            yield vector_batch(vector_rows("load", load))

    found = gathered(docs.select("text").mapInArrow(lean(count), VECTOR_SCHEMA))
    return found.get("load", np.zeros(1 << SKETCH_BITS)).astype(np.uint32)


PREFIX_SCHEMA = "doc_id long, n long, key string, group_key long, light int, prefix array<long>"


def prefixes(docs: DataFrame, loads: np.ndarray, width: int, percent: int) -> DataFrame:
    """Size, identity and prefix of the n-gram set of each document.

    The first `light` n-grams of a prefix are in buckets that are not crowded: they are hit at most CROWDED times as
    often as the mean bucket, or CROWDED_ROWS times.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(loads)
    most = max(CROWDED_ROWS, CROWDED * float(loads.mean()))
    bits = np.uint64((1 << SKETCH_BITS) - 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = shipped.value
        for piece in pieces(batches):
            sizes, keys, groups, lights, parts = [], [], [], [], []
            for found in shingle_sets(texts_of(piece), width):
                sizes.append(len(found))
                if not len(found):
                    keys.append(None)
                    groups.append(0)
                    lights.append(0)
                    parts.append(np.empty(0, np.int64))
                    continue
                other = mix64(found ^ np.uint64(0xD6E8FEB86659FD93))
                keys.append(f"{int(found.sum()):x}-{int(other.sum()):x}-{len(found):x}")
                size = prefix_size(len(found), percent)
                hits = load[(found & bits).astype(np.int64)]
                order = np.lexsort((found, hits))[:size]
                part = found[order]
                lights.append(int((hits[order] <= most).sum()))
                groups.append(int(mix64(part).sum() ^ np.uint64(len(found))) - (1 << 63))
                parts.append(part.view(np.int64))
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else []))
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.string()),
                    pa.array(groups, pa.int64()),
                    pa.array(lights, pa.int32()),
                    lists,
                ],
                names=["doc_id", "n", "key", "group_key", "light", "prefix"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(cut), PREFIX_SCHEMA)


def enough(shared: str, n: str, m: str, percent: int) -> str:
    """SQL: whether sets of n and m elements with so many in common are similar enough."""
    return f"({shared}) * {100 + percent} >= {percent} * ({n} + {m})"


def narrowed(df: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """Rows of the documents on one side of pairs: by a broadcast of their ids if these are few, else by a shuffle."""
    ids = pairs.select(F.col(side).alias("doc_id")).distinct()
    wanted = stored(ids, "wanted")
    some = F.broadcast(wanted) if wanted.count() <= BROADCAST_MAX_ROWS else wanted
    return df.join(some, "doc_id")


def plausible(pairs: DataFrame, table: DataFrame, percent: int) -> DataFrame:
    """Pairs whose prefixes leave enough room.

    Of two prefixes in the common order, the one that ends first has met all it can of the other; so the sets share at
    most what the prefixes share and the rest of one of them. Half of each hash is sent; n-grams of one prefix that have
    this half in common are counted as if all were shared, so no pair is lost.
    """
    pairs = stored(pairs, "candidates")
    halves = F.array_distinct(F.transform("prefix", lambda g: F.shiftright(g, 32).cast("int")))
    table = table.select("doc_id", "n", F.size("prefix").alias("cut"), halves.alias("halves"))
    left = narrowed(table, pairs, "a").toDF("a", "n", "i", "x")
    right = narrowed(table, pairs, "b").toDF("b", "m", "j", "y")
    most = "size(array_intersect(x, y)) + least(i - size(x), j - size(y)) + greatest(n - i, m - j)"
    joined = pairs.join(left, "a").join(right, "b").where(enough(most, "n", "m", percent))
    return joined.select("a", "b").distinct()


def verified(pairs: DataFrame, docs: DataFrame, table: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of documents whose sets are similar enough, compared whole.

    Only the texts of pairs with plausible prefixes move: texts, as they are smaller than their sets of hashes.
    """
    pairs = stored(plausible(pairs, table, percent), "pairs")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text="x"):
            keep = []
            one, two = (shingle_sets(piece.column(c).to_pylist(), width) for c in ("x", "y"))
            for p, q in zip(one, two, strict=True):
                both = np.concatenate([p, q])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(p) + len(q) - shared))
            yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = narrowed(texts, pairs, "a").toDF("a", "x"), narrowed(texts, pairs, "b").toDF("b", "y")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(lean(compare), "a long, b long")


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """Size, class and component of every document: (doc_id, n_shingles, class_id, component_id).

    1. Documents of equal sets are one class, named by the smallest doc_id; copies are never paired.
    2. Classes of equal prefix and size are one group. A group's prefix is posted once.
    3. Groups that share an n-gram of their prefixes, at places that leave room for enough others, are candidates. So
       that a prefix shared by many groups does not pair them all, every group is first compared only with the
       most central one (that has the n-gram first) of each neighbouring size band under the n-gram, and the members
       of a group with its smallest. What these verified links do not yet connect is then paired in
       full, without pairs inside a component, so no link between components is lost.
    4. Pairs of members are filtered by their whole prefixes, and then compared over their whole sets.

    The result's components are those of all links. Documents without words or text (null, empty) have size 0
    and their own doc_id; repeated rows get equal rows; columns besides doc_id and text are not read.
    Rows without doc_id link nothing and have no component.
    """
    docs = docs.select("doc_id", "text")
    table = stored(prefixes(docs, shingle_loads(docs, width), width, percent), "prefixes")
    filled = table.where("n > 0 AND doc_id IS NOT NULL")
    heads = filled.groupBy("key", "n", "group_key").agg(F.min("doc_id").alias("class_id"))
    classes = stored(filled.select("doc_id", "key", "n").join(heads, ["key", "n"]).select("doc_id", "n", "class_id", "group_key"), "classes")
    heads = classes.where("doc_id = class_id").select("doc_id", "n", "group_key").distinct()
    leaders = heads.groupBy("group_key", "n").agg(F.min("doc_id").alias("leader"))
    members = stored(heads.join(leaders, ["group_key", "n"]).select("doc_id", "n", "leader", "group_key"), "members")
    leading = members.where("doc_id = leader").select("doc_id", "group_key")

    inside = members.where("doc_id <> leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    posted = of_leaders(filled, classes, leading)
    light, heavy = (stored(found, "postings") for found in (light_postings(posted, percent), heavy_postings(posted)))
    star = light.select("doc_id", F.explode("near").alias("other"))
    if not heavy.isEmpty():
        star = star.unionByName(heavy_stars(heavy, percent))
    star = star.select(F.least("other", "doc_id").alias("a"), F.greatest("other", "doc_id").alias("b"))
    postings = light.drop("near").unionByName(heavy)
    links = stored(verified(star.unionByName(inside).distinct(), docs, filled, width, percent), "links")

    known = stored(components(links), "known")
    rest = expanded(members, postings, known, percent)
    more = stored(verified(rest, docs, filled, width, percent), "more")
    if not more.isEmpty():  # components and what joins them
        known = components(known.toDF("a", "b").unionByName(more))
    final = known.select(F.col("member").alias("class_id"), "component")
    placed = classes.join(final, "class_id", "left").select(
        "doc_id", "n", "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    empty = table.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return placed.unionByName(empty).withColumnRenamed("n", "n_shingles")


def of_leaders(filled: DataFrame, classes: DataFrame, leading: DataFrame) -> DataFrame:
    """Rows of the leaders. The others are the fewer: prefixes stay where they are if those fit a broadcast."""
    ids = ["doc_id", "group_key"]
    others = stored(classes.select(*ids).distinct().join(leading, ids, "left_anti"), "others")
    if fits_broadcast(others.count(), 0):
        return filled.join(F.broadcast(others), ids, "left_anti")
    return filled.join(leading, ids)


def band_of(percent: int) -> Column:
    """Sizes in the same or the next band can be similar enough, others cannot."""
    return F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")


def light_postings(posted: DataFrame, percent: int) -> DataFrame:
    """Postings of the n-grams that several groups have, with the most central group of the own and the next smaller band.

    Rows (doc_id, n, pos, gram, near); `near` lists those of the two that leave room for enough others. An
    n-gram is dealt to one task, which is safe here: its bucket is not crowded. So a single shuffle tells which
    n-grams are shared and whom to compare first.
    """
    rows = posted.select("doc_id", "n", F.posexplode(F.expr("slice(prefix, 1, light)")).alias("pos", "gram"))
    rows = rows.select("doc_id", "gram", F.expr("shiftleft(n, 32) + pos AS place")).repartition("gram")
    rows = rows.selectExpr("doc_id", "gram", "shiftright(place, 32) AS n", "CAST(place & 4294967295 AS INT) AS pos")
    rows = rows.withColumn("band", band_of(percent))
    in_order = Window.partitionBy("gram").orderBy("band", "pos", "doc_id")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shared = rows.select(
        "*", F.lag("band").over(in_order).alias("before"), F.lead("band").over(in_order).alias("after")
    ).where("before IS NOT NULL OR after IS NOT NULL")
    opens = F.expr("before IS NULL OR before <> band")
    own = F.last(F.when(opens, F.struct("band", "doc_id", "n", "pos")), ignorenulls=True).over(so_far)
    smaller = shared.withColumn("own", own).withColumn("last", F.when(opens, F.lag("own").over(in_order)))
    central = smaller.withColumn("prior", F.last("last", ignorenulls=True).over(so_far))
    room = enough("least(n - pos, t.n - t.pos)", "n", "t.n", percent)
    near = f"filter(array(own, prior), t -> t.doc_id <> doc_id AND t.band >= band - 1 AND {room})"
    return central.select("doc_id", "n", "pos", "gram", F.expr(f"transform({near}, t -> t.doc_id)").alias("near"))


def heavy_postings(posted: DataFrame) -> DataFrame:
    """Postings of the n-grams in crowded buckets, which may be a third of all groups under one n-gram."""
    some = posted.where("light < size(prefix)")
    rest = F.posexplode(F.expr("slice(prefix, light + 1, size(prefix))")).alias("pos", "gram")
    return some.select("doc_id", "n", "light", rest).select("doc_id", "n", F.expr("light + pos AS pos"), "gram")


def heavy_stars(heavy: DataFrame, percent: int) -> DataFrame:
    """The same neighbours as in `light_postings`, by aggregates with partial sums and a join that can be split."""
    rows = heavy.withColumn("band", band_of(percent))
    firsts = rows.groupBy("gram", "band").agg(F.min(F.struct("pos", "doc_id", "n")).alias("first"))
    near = firsts.select("gram", "first", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    near = near.select("gram", "band", F.expr("first.doc_id AS other"), F.expr("first.n AS m"), F.expr("first.pos AS q"))
    room = enough("least(n - pos, m - q)", "n", "m", percent)
    return rows.join(near, ["gram", "band"]).where(f"other <> doc_id AND {room}").select("doc_id", "other")


def expanded(members: DataFrame, postings: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs of members whose components are still apart.

    Pairs of groups are found by their leaders' postings. The smaller set of a pair needs a shared n-gram so
    early that even equal sizes leave room. Pairs are then expanded to the members that differ in component.
    """
    seen = known.select(F.col("member").alias("doc_id"), "component")
    placed = stored(
        members.select("doc_id", "n", "leader")
        .join(seen, "doc_id", "left")
        .select("doc_id", "n", "leader", F.coalesce("component", "doc_id").alias("component")),
        "placed",
    )
    # A gram is open if the members of its groups belong to several components.
    span = placed.groupBy("leader").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    posted = postings.select(F.col("doc_id").alias("leader"), "gram", "n", "pos")
    spans = posted.join(span, "leader")
    opened = spans.groupBy("gram").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high")
    live = stored(spans.join(opened.select("gram"), "gram").select("gram", "leader", "n", "pos", "low", "high"), "live")
    short = live.where(enough("n - pos", "n", "n", percent))
    x = short.toDF("gram", "p", "m", "q", "lo", "hi")
    pairs = (
        live.join(x, "gram")
        .where(f"struct(m, p) < struct(n, leader) AND {enough('least(n - pos, m - q)', 'n', 'm', percent)}")
        .where("NOT (low = high AND lo = hi AND low = lo)")
        .select(F.col("leader").alias("p"), F.col("p").alias("q"))
        .distinct()
    )
    split = span.where("low <> high").select(F.col("leader").alias("p"), F.col("leader").alias("q"))
    pairs = pairs.unionByName(split)
    left = placed.select(F.col("leader").alias("p"), F.col("doc_id").alias("a"), F.col("component").alias("c"))
    right = placed.select(F.col("leader").alias("q"), F.col("doc_id").alias("b"), F.col("component").alias("d"))
    found = pairs.join(left, "p").join(right, "q").where("c <> d")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def op10_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))
