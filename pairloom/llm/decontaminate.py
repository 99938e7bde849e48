"""Benchmark passages in documents, by latent semantic retrieval and sequence checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.llm.common import (
    SPACES,
    VECTOR_SCHEMA,
    gathered,
    lean,
    load,
    pieces,
    stored,
    summed_vectors,
    texts_of,
    vector_batch,
    vector_rows,
    words_of,
)
from pairloom.session import discard

RANK = 160
EXTRA = 16
SAMPLE_DOCS = None  # read by nothing: the latent space is that of all documents; a test sets the name
WINDOW = 32
STRIDE = 16
COSINE = 0.4
COPY = 0.7
PARAPHRASE = 0.5
ANSWER = 0.8
BLOCK = 2_000
STOP = 0.01
ENTRIES = 1_000_000
BAND_ENTRIES = 6_000_000
PUNCTUATION = b".,;:!?\"'()[]{}<>*&#$%|-_=+/\\~^`@"
OUTER = np.zeros(256, dtype=bool)
OUTER[list(PUNCTUATION)] = True

Item = tuple[int, list[bytes], list[bytes]]


def bare_words(text: bytes | None) -> list[bytes]:
    """Lower-case words without outer punctuation; what is nothing but punctuation is left out."""
    return [w for x in words_of(text) if (w := x.strip(PUNCTUATION))]


def benchmark_items(benchmark: DataFrame, block: int) -> Iterator[list[Item]]:
    """Identifier, words and answer words of every item, in blocks; the answer is the last sentence of three words or more.

    Items without an identifier or words are left out; repeated rows count once. The driver holds a block and a
    partition of the benchmark at a time.
    """
    items: list[Item] = []
    rows = benchmark.select("item_id", "text").where("item_id IS NOT NULL").distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        text = (row["text"] or "").encode()
        words = bare_words(text)
        ends = [bare_words(x) for x in text.replace(b"\n", b" ").split(b". ")]
        answer = next((x for x in reversed(ends) if len(x) >= 3), words)
        if words:
            items.append((row["item_id"], words, answer))
        if len(items) == block:
            yield items
            items = []
    if items:
        yield items


def term_ids(texts: list[bytes | None], terms: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Term number and text of every word that is more than punctuation; -1 for words that are no terms.

    Terms have no outer punctuation, so only words that begin or end with it are looked up once more without.
    """
    joined = b"\n".join(t or b"" for t in texts).lower()
    words = joined.split()
    ids = np.fromiter(map(terms.get, words, repeat(-1)), np.int64, len(words))
    data = np.frombuffer(b"\n" + joined + b"\n", np.uint8)
    edges = np.diff(SPACES[data].view(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    outer = np.flatnonzero(OUTER[data[starts + 1]] | OUTER[data[ends]])
    bare = list(map(bytes.strip, map(words.__getitem__, outer.tolist()), repeat(PUNCTUATION)))
    again = np.fromiter(map(terms.get, bare, repeat(-1)), np.int64, len(bare))
    ids[outer] = np.where(np.fromiter(map(len, bare), np.int64, len(bare)) > 0, again, -3)
    offsets = np.cumsum([len(t or b"") + 1 for t in texts])
    doc = np.searchsorted(offsets, starts, side="right")
    real = ids != -3
    return ids[real], doc[real]


def indexed(texts: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """The words of every text as the bytes of their term numbers, `ids`; other columns stay.

    What reads the words more than once reads these, as splitting and looking up texts is the dearest part.
    """
    shipped = texts.sparkSession.sparkContext.broadcast(terms)
    others = [f for f in texts.schema.fields if f.name != "text"]
    kind = id_type(len(terms))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, rows=1024, size=2_000_000):
            ids, doc = term_ids(texts_of(piece), shipped.value)
            ends = np.cumsum(np.bincount(doc, minlength=piece.num_rows)) * kind.itemsize
            buffers = [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(ids.astype(kind))]
            words = pa.Array.from_buffers(pa.large_binary(), piece.num_rows, buffers).cast(pa.binary())
            columns = [piece.column(piece.schema.get_field_index(f.name)) for f in others]
            yield pa.RecordBatch.from_arrays([*columns, words], names=[*[f.name for f in others], "ids"])

    schema = T.StructType([*others, T.StructField("ids", T.BinaryType())])
    return texts.mapInArrow(lean(index), schema)


def id_type(terms: int) -> np.dtype:
    return np.dtype("<i2" if terms < 1 << 15 else "<i4")


def indexed_pieces(
    batches: Iterator[pa.RecordBatch], terms: int, words: int = 400_000, rows: int = 1024
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of `indexed` texts with few words, and what `term_ids` gives for them."""
    kind = id_type(terms)
    for piece in pieces(batches, rows=rows, size=words * kind.itemsize, text="ids"):
        filled = piece.column(piece.schema.get_field_index("ids")).to_pylist()
        ids = np.frombuffer(b"".join(filled), kind).astype(np.int64)
        yield piece, ids, np.repeat(np.arange(len(filled)), [len(x) // kind.itemsize for x in filled])


def document_frequencies(docs: DataFrame, terms: int) -> tuple[np.ndarray, float]:
    """In how many of the indexed documents each benchmark word is, and how many documents there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(terms + 1)
        for piece, ids, doc in indexed_pieces(batches, terms):
            inside = ids >= 0
            pairs = np.unique(doc[inside] * terms + ids[inside])
            found[:-1] += np.bincount(pairs % terms, minlength=terms)
            found[-1] += piece.num_rows
        yield vector_batch(vector_rows("df", found))

    df = gathered(docs.select("ids").mapInArrow(lean(count), VECTOR_SCHEMA)).get("df", np.zeros(terms + 1))
    return df[:-1], float(df[-1])


def term_weights(df: np.ndarray, n: float) -> np.ndarray:
    """Cube of the inverse document frequency, relative to the rarest word; words that come out below STOP have none.

    The cube lets the rare words of an item decide over those that any text of its language has.
    """
    idf = np.log((n + 1) / (df + 1)) + 0.05
    weight = (idf / idf.max()) ** 3
    return np.where(weight < STOP, 0.0, weight)


def weak_items(known: list[list[int]], weights: np.ndarray) -> list[int]:
    """Items that a cosine may miss, as words in a large share of the documents have little weight or none.

    In a copy of such an item PARAPHRASE of its words may all be without weight, or its vector is shorter than that
    of a single rare word and so lost beside one.
    """
    weight = [weights[np.array(k)] for k in known]
    alone = [np.linalg.norm(weights[np.unique(k)]) < 1 for k in known]
    return [i for i, w in enumerate(weight) if alone[i] or np.mean(w == 0) >= PARAPHRASE]


def segment_sums(vectors: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the vectors of segments of `ids` that begin at `at`; the n-th members of all segments are added at once."""
    sizes = np.diff(np.append(at, len(ids)))
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = at[order], sizes[order]
    total = vectors[ids[begins]]
    for k in range(1, int(sizes[0]) if len(sizes) else 0):
        longer = int(np.searchsorted(-sizes, -k, side="left"))
        total[:longer] += vectors[ids[begins[:longer] + k]]
    result = np.empty_like(total)
    result[order] = total
    return result


def passage_rows(ids: np.ndarray, doc: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """TF-IDF entries (passage, term, weight) of disjoint passages, each of length one."""
    at = np.arange(len(ids)) - np.searchsorted(doc, doc)
    passage = doc * (1 << 32) + at // WINDOW
    inside = (ids >= 0) & (idf[ids] > 0)
    code, n = np.unique(passage[inside] * len(idf) + ids[inside], return_counts=True)
    passage, term = np.divmod(code, len(idf))
    row = np.cumsum(np.diff(passage, prepend=passage[:1]) != 0)
    weight = (1 + np.log(n)) * idf[term]
    norm = np.sqrt(np.bincount(row, weight**2))
    return row, term, weight / np.maximum(norm[row], 1e-12)


def spread(row: np.ndarray, term: np.ndarray, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'(A B) for the sparse passage matrix A of the entries."""
    if not len(row):
        return np.zeros_like(basis)
    first = np.flatnonzero(np.diff(row, prepend=-1))
    product = np.add.reduceat(weight[:, None] * basis[term], first, axis=0)
    back = weight[:, None] * product[row]
    order = np.argsort(term, kind="stable")
    found, begins = np.unique(term[order], return_index=True)
    total = np.zeros_like(basis)
    total[found] = np.add.reduceat(back[order], begins, axis=0)
    return total


def add_products(row: np.ndarray, term: np.ndarray, weight: np.ndarray, band: np.ndarray, first: int) -> None:
    """Add the entries of A'A at and above the diagonal to a band of them: rows and columns from the term `first` on.

    The entries of a passage are in order of their terms; each is multiplied with the k-th behind it, for all k at once.
    """
    last, width = first + len(band), band.shape[1]
    flat = band.reshape(-1)
    begins = np.flatnonzero((term >= first) & (term < last))
    k = 0
    while len(begins):
        np.add.at(flat, (term[begins] - first) * width + term[begins + k] - first, weight[begins] * weight[begins + k])
        k += 1
        begins = begins[begins + k < len(row)]
        begins = begins[row[begins + k] == row[begins]]


def bands_of(terms: int, entries: int) -> list[tuple[int, int]]:
    """Runs of terms whose rows in A'A, from the diagonal on, have so many entries at most, or are one row."""
    bands, first = [], 0
    while first < terms:
        last = min(terms, first + max(1, entries // (terms - first)))
        bands.append((first, last))
        first = last
    return bands


def term_products(docs: DataFrame, terms: int, idf: np.ndarray) -> DataFrame:
    """A'A of the passages of all indexed documents, at and above the diagonal, as rows (name, chunk, values).

    A chunk is some rows of a band, which the name tells by its first term and column. A task holds a band at a time, and there
    are no more tasks than cores, so what moves depends on terms and cores, not on the documents. They are read once for
    each band.
    """
    spark = docs.sparkSession
    few = docs.select("ids").coalesce(max(1, spark.sparkContext.defaultParallelism))
    shipped = spark.sparkContext.broadcast(idf)
    found = None
    for first, last in bands_of(terms, BAND_ENTRIES):

        def products(batches: Iterator[pa.RecordBatch], first=first, last=last) -> Iterator[pa.RecordBatch]:
            band = np.zeros((last - first, terms - first))
            for _, ids, doc in indexed_pieces(batches, terms):
                add_products(*passage_rows(ids, doc, shipped.value), band, first)
            rows = band_rows(terms, first)
            for at in range(0, len(band), rows):
                if (some := band[at : at + rows]).any():
                    yield vector_batch([(str(first), at // rows, some.tobytes())])

        some = stored(summed_vectors(few.mapInArrow(lean(products), VECTOR_SCHEMA)), "products")
        found = some if found is None else found.unionByName(some)
    return found


def band_rows(terms: int, first: int) -> int:
    """Rows of a band that are moved together."""
    return max(1, (1 << 16) // (terms - first))


def multiplied(products: DataFrame, basis: np.ndarray) -> np.ndarray:
    """A'A B from the rows of `term_products`; every task sends a matrix of the size of B."""
    shipped = products.sparkSession.sparkContext.broadcast(basis)
    terms = len(basis)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shipped.value
        total = np.zeros_like(now)
        for batch in batches:
            for name, chunk, values in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                first = int(name)
                rows = np.frombuffer(values, np.float64).reshape(-1, terms - first)
                at = first + chunk * band_rows(terms, first)
                total[at : at + len(rows)] += rows @ now[first:]
                total[first:] += np.triu(rows, at - first + 1).T @ now[at : at + len(rows)]
        if total.any():
            yield vector_batch(vector_rows("y", total))

    found = gathered(products.mapInArrow(lean(multiply), VECTOR_SCHEMA)).get("y", np.zeros(basis.size))
    return found.reshape(basis.shape)


def latent_space(
    docs: DataFrame, items: list[Item], terms: dict[bytes, int], idf: np.ndarray, rank: int, rounds: int = 2
) -> np.ndarray:
    """Right singular vectors (term x rank) of the TF-IDF passages, by a distributed randomised SVD.

    The passages are those of the benchmark and of all indexed documents. A random basis is multiplied by A'A in
    rounds, and the driver orthonormalises the result. A'A has a row for each term, so the documents are read for
    it, and not for the rounds.
    """
    rng = np.random.default_rng(5)
    basis = np.linalg.qr(rng.normal(size=(len(terms), min(rank + EXTRA, len(terms)))))[0]
    products = term_products(docs, len(terms), idf)
    known = [np.array([terms[w] for w in words]) for _, words, _ in items]
    own = passage_rows(np.concatenate(known), np.repeat(np.arange(len(items)), [len(k) for k in known]), idf)
    for turn in range(rounds + 1):
        total = multiplied(products, basis) + spread(*own, basis)
        if turn < rounds:
            basis = np.linalg.qr(total)[0]
    values, turned = np.linalg.eigh(basis.T @ total)
    return basis @ turned[:, np.argsort(-values)[:rank]]


def position_masks(item: list[int], terms: int) -> np.ndarray:
    """For every term, and behind them for words that are none, the places of the item where it stands, as bits of 64-bit numbers."""
    masks = np.zeros((terms + 1, -(-len(item) // 64)), np.uint64)
    at = np.arange(len(item))
    np.bitwise_or.at(masks, (np.array(item), at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    return masks


def common_subsequences(masks: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of many windows with their items, all at once.

    `masks` says for (window, step) where the item has the window's word; a row of the usual table is the bits of
    some 64-bit numbers, added with carries.
    """
    n, steps, wide = masks.shape
    every = ~np.uint64(0)
    row = np.full((n, wide), every)
    for t in range(steps):
        carry = np.zeros(n, bool)
        for k in range(wide):
            old, mask = row[:, k], masks[:, t, k]
            met = old & mask
            total = old + met
            over = total < old
            total += carry
            carry = over | (carry & (total == 0))
            row[:, k] = total | (old & ~mask)
    place = np.arange(wide) * 64
    room = np.clip(length[:, None] - place, 0, 64)
    inside = np.where(room == 64, every, (np.uint64(1) << np.minimum(room, 63).astype(np.uint64)) - np.uint64(1))
    return length - np.bitwise_count(row & inside).sum(axis=1).astype(np.int64)


HIT_SCHEMA = (
    "doc_id long, item_id long, start long, cosine double, lcs_share double, answer_share double, kind string"
)


@dataclass
class Searcher:
    """What a task needs to find the items of a block: terms, their latent vectors, and the items by terms."""

    terms: dict[bytes, int]
    vectors: np.ndarray
    weighty: np.ndarray
    targets: np.ndarray
    names: list[int]
    known: list[list[int]]
    answers: list[list[int]]
    weak: list[int]

    def hits(self, ids: np.ndarray, doc: np.ndarray, n: int) -> list[tuple]:
        """(number of the document of n, number of the item, start, cosine, share, answer share, kind), from `term_ids`."""
        if not len(ids):
            return []
        parts = (self.vectors, self.weighty, self.targets, self.known, self.answers, self.weak)
        return matches(ids, doc, n, *parts)


def terms_of(items: list[Item]) -> dict[bytes, int]:
    return {w: i for i, w in enumerate(sorted({w for _, words, _ in items for w in words}))}


def fit_searcher(docs: DataFrame, items: list[Item], rank: int) -> Searcher:
    """Term weights and the latent space for a block of items, from the documents as `indexed` by its terms."""
    terms = terms_of(items)
    df, n = document_frequencies(docs, len(terms))
    idf = term_weights(df, n)
    space = latent_space(docs, items, terms, idf, rank)
    vectors = (space * idf[:, None]).astype(np.float32)
    known = [[terms[w] for w in words] for _, words, _ in items]
    targets = np.stack([vectors[np.array(k)].sum(axis=0) for k in known])
    targets /= np.maximum(np.linalg.norm(targets, axis=1), 1e-12)[:, None]
    answers = [sorted({terms[w] for w in words}) for _, _, words in items]
    return Searcher(terms, vectors, idf > 0, targets, [i for i, _, _ in items], known, answers, weak_items(known, idf))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, rank: int = RANK, id_column: str = "doc_id", block: int = BLOCK
) -> DataFrame:
    """One row per document and benchmark item that it holds: the best window and how it matched.

    1. Every document is read in overlapping windows of words; a window's vector is the sum of its TF-IDF
       weighted benchmark words in the latent space.
    2. Windows whose cosine to an item reaches COSINE are candidates, unless they and their surroundings have too
       few of the item's words to pass step 3. Of items whose words are in so many documents that their vectors are
       weak, every other window is a candidate as well whose surroundings have enough of the item's words.
    3. The longest common subsequence of the words around the window and the item decides: COPY of the
       item's words make a copy; PARAPHRASE of them make a paraphrase if ANSWER of the answer's words
       are there too.

    The benchmark is read in blocks of items, so that what is broadcast is bounded; the documents are read and indexed once
    for each, and what is found is written before the next. Null and empty texts hold nothing, an empty benchmark
    gives no rows; repeated documents give repeated rows; columns besides id and text are not read.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    found = None
    for searcher, indexed_texts, last in searchers(texts, benchmark, rank, block):
        some = block_hits(indexed_texts, searcher)
        if found is not None or not last:
            some = stored(some, "hits")
        found = some if found is None else found.unionByName(some)
    return docs.sparkSession.createDataFrame([], HIT_SCHEMA) if found is None else found


def searchers(texts: DataFrame, benchmark: DataFrame, rank: int, block: int) -> Iterator[tuple[Searcher, DataFrame, bool]]:
    """For each block of items a fitted searcher, the texts as indexed by its terms, and whether it is the last."""
    blocks = benchmark_items(benchmark, block)
    now = next(blocks, None)
    while now is not None:
        after = next(blocks, None)
        docs = stored(indexed(texts, terms_of(now)), "indexed")
        yield fit_searcher(docs, now, rank), docs, after is None
        if after is not None:
            discard(docs)
        now = after


def block_hits(docs: DataFrame, searcher: Searcher) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(vars(searcher))  # plain values: broadcasts are not pickled by value

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Searcher(**shipped.value)
        for piece, ids, doc in indexed_pieces(batches, len(s.terms)):
            who = piece.column(piece.schema.get_field_index("doc_id")).to_pylist()
            cols = list(zip(*s.hits(ids, doc, piece.num_rows), strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([who[d] for d in cols[0]], pa.int64()),
                    pa.array([s.names[i] for i in cols[1]], pa.int64()),
                    pa.array(cols[2], pa.int64()),
                    *[pa.array(c, pa.float64()) for c in cols[3:6]],
                    pa.array(cols[6], pa.string()),
                ],
                names=[c.split()[0] for c in HIT_SCHEMA.split(", ")],
            )

    return docs.mapInArrow(lean(search), HIT_SCHEMA)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, rank: int = RANK, id_column: str = "doc_id", block: int = BLOCK
) -> DataFrame:
    """The rows of the documents that hold no item of the benchmark, with all their columns.

    Each row is decided by its own text, so rows without an id, or with the id of a contaminated one, stay if their
    text is clean. Null and empty texts stay, and so does everything if the benchmark is empty.
    """
    kept = docs
    for searcher, _, last in searchers(docs.select("text"), benchmark, rank, block):
        kept = block_clean(kept, searcher)
        if not last:
            kept = stored(kept, "clean")
    return kept


def block_clean(docs: DataFrame, searcher: Searcher) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast(vars(searcher))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Searcher(**shipped.value)
        for piece in pieces(batches, rows=1024, size=2_000_000):
            clean = np.ones(piece.num_rows, bool)
            clean[[row[0] for row in s.hits(*term_ids(texts_of(piece), s.terms), piece.num_rows)]] = False
            yield piece.filter(pa.array(clean))

    return docs.mapInArrow(lean(keep), docs.schema)


def window_sums(ids, doc, n, vectors, weighty):
    """First word, last word and latent vector of every window that has a weighty word.

    Words are summed by strides, and a window is a run of strides.
    """
    sizes = np.bincount(doc, minlength=n)
    firsts = np.cumsum(sizes) - sizes
    strides = -(-sizes // STRIDE)
    before = np.cumsum(strides) - strides
    stride = before[doc] + (np.arange(len(ids)) - firsts[doc]) // STRIDE
    heavy = np.flatnonzero((ids >= 0) & weighty[ids])
    if not len(heavy):
        return firsts, sizes, np.zeros(0, np.int64), np.zeros((0, vectors.shape[1]), np.float32)
    filled, at = np.unique(stride[heavy], return_index=True)
    sums = segment_sums(vectors, ids[heavy], at)
    span = WINDOW // STRIDE
    starts = np.unique(np.concatenate([filled - k for k in range(span)]))
    owner = np.repeat(np.arange(n), strides)
    starts = starts[starts >= 0]
    place = np.full(len(owner) + span, -1)
    place[filled] = np.arange(len(filled))
    total = np.zeros((len(starts), vectors.shape[1]), np.float32)
    for k in range(span):
        here = place[starts + k]
        same = (here >= 0) & (owner[np.minimum(starts + k, len(owner) - 1)] == owner[starts])
        total[same] += sums[here[same]]
    return firsts, sizes, firsts[owner[starts]] + (starts - before[owner[starts]]) * STRIDE, total


def full_windows(ids, doc, n, known, weak, terms: int) -> Iterator[tuple[np.ndarray, int]]:
    """First words of all windows whose surroundings have the words of PARAPHRASE of the places of a weak item, item by item.

    The places whose words are met are collected as bits by strides. Of documents that have enough of them, those of
    the strides around a window are united, so no window is left out that could pass.
    """
    if not len(weak) or not len(ids):
        return
    sizes = np.bincount(doc, minlength=n)
    firsts = np.cumsum(sizes) - sizes
    strides = -(-sizes // STRIDE)
    before = np.cumsum(strides) - strides
    some = np.zeros(terms + 1, bool)
    some[[x for i in weak for x in known[i]]] = True
    place = np.flatnonzero(some[ids])
    if not len(place):
        return
    owner = doc[place]
    stride = before[owner] + (place - firsts[owner]) // STRIDE
    filled = np.flatnonzero(np.diff(stride, prepend=-1))
    stride, owner = stride[filled], owner[filled]
    by_doc = np.flatnonzero(np.diff(owner, prepend=-1))
    term = ids[place]
    for i in weak:
        masks = position_masks(known[i], terms)
        met = np.stack([np.bitwise_or.reduceat(masks[:, k][term], filled) for k in range(masks.shape[1])])
        whole = np.stack([np.bitwise_or.reduceat(m, by_doc) for m in met])
        enough = np.bitwise_count(whole).sum(axis=0) >= PARAPHRASE * len(known[i])
        if not enough.any():
            continue
        docs = owner[by_doc][enough]
        number, of = spread_out(strides[docs])
        begins = firsts[docs][of] + number * STRIDE
        low = np.cumsum(strides[docs]) - strides[docs]
        full = np.zeros((len(met), len(of)), np.uint64)
        at = np.searchsorted(docs, owner)
        there = docs[np.minimum(at, len(docs) - 1)] == owner
        full[:, low[at[there]] + stride[there] - before[owner[there]]] = met[:, there]
        reach = -(-len(known[i]) // STRIDE)
        united = full.copy()
        for k in range(1, reach + WINDOW // STRIDE):
            ahead = number + k < strides[docs][of]
            united[:, ahead] |= full[:, np.flatnonzero(ahead) + k]
            if k <= reach:
                behind = number >= k
                united[:, behind] |= full[:, np.flatnonzero(behind) - k]
        yield begins[np.bitwise_count(united).sum(axis=0) >= PARAPHRASE * len(known[i])], i


def spread_out(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 inside groups of some sizes, one group behind the other, and the group of each."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes), of


def matches(ids, doc, n, vectors, weighty, targets, known, answers, weak) -> list[tuple]:
    """Best match of every document of a piece with every item."""
    firsts, sizes, starts, total = window_sums(ids, doc, n, vectors, weighty)
    total /= np.maximum(np.linalg.norm(total, axis=1), 1e-12)[:, None]
    found = [(np.zeros(0, np.int64),) * 2]
    for a in range(0, len(starts), 8192):
        near = np.flatnonzero(total[a : a + 8192] @ targets.T >= COSINE)
        found.append((near % len(targets), starts[a + near // len(targets)]))
    for begins, i in full_windows(ids, doc, n, known, weak, len(vectors)):
        found.append((np.full(len(begins), i), begins))
    item, begin = (np.concatenate(x) for x in zip(*found, strict=True))
    item, begin = np.divmod(np.unique(item * (len(ids) + 1) + begin), len(ids) + 1)
    best: dict[tuple[int, int], tuple] = {}
    waiting: dict[int, list[tuple]] = {}

    def settle(wide: int) -> None:
        """Compare the windows that wait with their items, and keep the best of each document and item."""
        parts = waiting.pop(wide, [])
        steps = max((p[0].shape[1] for p in parts), default=0)
        masks = np.concatenate([np.pad(p[0], ((0, 0), (0, steps - p[0].shape[1]), (0, 0))) for p in parts])
        at, low, high, cosine = (np.concatenate([p[k] for p in parts]) for k in range(1, 5))
        which = np.repeat([p[5] for p in parts], [len(p[0]) for p in parts])
        length = np.array([len(known[i]) for i in which], np.int64)
        share = common_subsequences(masks, length) / length
        for k in np.flatnonzero(share >= PARAPHRASE).tolist():
            i, d = int(which[k]), int(doc[at[k]])
            there = set(ids[low[k] : high[k]].tolist())
            answer = sum(x in there for x in answers[i]) / len(answers[i])
            if share[k] < COPY and answer < ANSWER:
                continue
            kind = "copy" if share[k] >= COPY else "paraphrase"
            row = (d, i, int(at[k] - firsts[d]), float(cosine[k]), float(share[k]), answer, kind)
            old = best.get((d, i))
            if old is None or (row[4], row[3], -row[2]) > (old[4], old[3], -old[2]):
                best[d, i] = row

    edges = np.flatnonzero(np.diff(item, prepend=-1, append=-1))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        i = int(item[a])
        masks = position_masks(known[i], len(vectors))
        n_words, wide = len(known[i]), masks.shape[1]
        steps = np.arange(WINDOW + 2 * n_words)
        at_once = max(1, ENTRIES // (len(steps) * wide))
        for first in range(a, b, at_once):
            at = begin[first : min(first + at_once, b)]
            low = np.maximum(at - n_words, firsts[doc[at]])
            high = np.minimum(at + WINDOW + n_words, (firsts + sizes)[doc[at]])
            place = low[:, None] + steps
            met = masks[np.where(place < high[:, None], ids[np.minimum(place, len(ids) - 1)], -1)]
            enough = np.bitwise_count(np.bitwise_or.reduce(met, axis=1)).sum(axis=1) >= PARAPHRASE * n_words
            if not enough.any():
                continue
            at, low, high, met = at[enough], low[enough], high[enough], met[enough]
            window = np.searchsorted(starts, at)
            there = np.append(starts, -1)[window] == at
            cosine = np.zeros(len(at))
            cosine[there] = total[window[there]] @ targets[i]
            waiting.setdefault(wide, []).append((met, at, low, high, cosine, i))
            if sum(p[0].size for p in waiting[wide]) > ENTRIES:
                settle(wide)
    for wide in list(waiting):
        settle(wide)
    return [best[k] for k in sorted(best)]


def op7_latent_semantic_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))
