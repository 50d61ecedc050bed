"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Two sets with overlap o share their k smallest common elements within their first |x| - o + k
elements, in any order of all elements. So sets that may link share k = OVERLAP elements of
their prefixes, or a SHARE-th of the smaller set if that is more. The order puts the n-grams that a bounded sample
shows to be common last, least common first; it sets the cost, never the result.

1. documents with equal sets become one row;
2. the columns of the prefix incidence matrix (n-gram, rows) give candidates: in a short column all
   pairs, whose overlaps are summed over columns, and pairs below k or of too different sizes are
   discarded; a long column, or one of a common n-gram, joins its rows;
3. components of joined rows are families. The whole sets of pairs and of families are
   multiplied block by block, in groups of bounded size, and pairs that can no longer reach the
   size-derived bound are discarded between column blocks;
4. components of the links give the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE, NUMERATOR, DENOMINATOR, OVERLAP, SHARE = 4, 85, 100, 3, 20
#: Rows up to which a column gives pairs; rows and shingles of a block of a family; columns of a product block.
SHORT, BLOCK_ROWS, BLOCK_SHINGLES, COLUMNS = 256, 512, 1_000_000, 2048
#: One document in so many is sampled for the order, so that the columns of rare n-grams have a like length at any
#: size; sampled documents from which an n-gram is common; and common n-grams kept at most, which bounds the broadcast.
SAMPLED, COMMON, MOST_COMMON = 16, 3, 1 << 18


def shingles(raw: bytes | None, hashes: common.WordHashes, width: int) -> np.ndarray:
    """The set, as sorted 64-bit hashes; fewer words than the width make one element, no words none."""
    words = raw.translate(common.LOWER).split() if raw else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return common.mix(common.rolling(hashes(words), len(words)) + np.uint64(len(words)))
    return np.unique(common.rolling(hashes(words), width))


def least_overlap(n: int, num: int, den: int) -> int:
    """The least overlap with which a set of n elements can link to any other."""
    return -(-num * n // den)


def least_shared(n):
    """k for a set of n elements; of two sets the smaller one's holds."""
    return np.maximum(OVERLAP, n // SHARE)


def prefix(s: np.ndarray, common_last: np.ndarray, rank: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The first elements in the common order: the rare ones, and the common ones after them."""
    n = len(s)
    need = least_overlap(n, num, den)
    size = n - need + min(int(least_shared(n)), need)
    if not len(common_last):
        return s[:size], s[:0]
    at = np.minimum(np.searchsorted(common_last, s), len(common_last) - 1)
    hot = common_last[at] == s
    rare = s[~hot][:size]
    return rare, s[hot][np.argsort(rank[at[hot]], kind="stable")][: size - len(rare)]


def common_shingles(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of common n-grams, and their ranks, rarest first, from one row in SAMPLED."""
    part = docs.where(F.pmod(F.xxhash64("_k1", "_k2"), F.lit(SAMPLED)) == 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = common.WordHashes()
        for b in batches:
            for raws in common.chunks(common.binary(b.column(0)), 500):
                sets = [shingles(raw, hashes, width) for raw in raws]
                h, c = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], names=["h", "c"])

    rows = common.mapped(part, run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).where(F.col("c") >= COMMON).orderBy(F.desc("c"), "h").limit(MOST_COMMON).toArrow()
    h, c = rows.column("h").to_numpy().view(np.uint64), rows.column("c").to_numpy()
    by = np.argsort(h)
    rank = np.empty(len(h), np.int64)
    rank[np.lexsort((h, c))] = np.arange(len(h))
    return h[by], rank[by]


def sets_table(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(_k1, _k2, rec, n, sig, prefix, hot) for every row: set size, digest of the whole set, rare and common part of the prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, width))
    rec_type = docs.schema["rec"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        hashes = common.WordHashes()
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                b = whole.slice(at, 2000)
                sizes, digests, prefixes = [], [], []
                for raw in common.binary(b.column(3)):
                    s = shingles(raw, hashes, width)
                    sizes.append(len(s))
                    digests.append(xxh3_128_digest(s.tobytes()) if len(s) else None)
                    prefixes.append(prefix(s, *shared.value, num, den) if len(s) else (s, s))
                flat = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, part)]), pa.int32()), pa.array(np.concatenate(part).view(np.int64))) for part in zip(*prefixes)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), *flat], names=["_k1", "_k2", "rec", "n", "sig", "prefix", "hot"])

    table = common.mapped(docs.select("_k1", "_k2", "rec", "text"), run, f"_k1 long, _k2 long, rec {rec_type}, n long, sig binary, prefix array<long>, hot array<long>")
    return common.saved(table.withColumn("row", F.monotonically_increasing_id()), "sets")


def column_pairs(h: np.ndarray, row: np.ndarray, n: np.ndarray, num: int, den: int) -> tuple[np.ndarray, ...]:
    """Pairs (a, b, m) of rows, m the smaller size, from whole columns that come sorted by h; rows of too different sizes make none."""
    first = np.flatnonzero(np.diff(h, prepend=h[0] ^ 1))
    count = np.diff(np.append(first, len(h)))
    place = np.arange(len(h)) - np.repeat(first, count)
    out = []
    for step in range(1, int(count.max())):
        i = np.flatnonzero(place + step < np.repeat(count, count))
        j = i + step
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        near = (small * den >= large * num) & (row[i] != row[j])
        i, j = i[near], j[near]
        out.append((np.minimum(row[i], row[j]), np.maximum(row[i], row[j]), small[near]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (row[:0], row[:0], n[:0])


def candidates(reps: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of reps(row, n, prefix, hot), and edges (a, b) of families: every linked pair of
    different sets is among the pairs or within a family.

    A common n-gram's column isn't gathered: its rows are joined to a node of its own, a negative id.
    They are few, as common n-grams only fill up prefixes that hold too few others.
    """
    pairs, stars = _columns(reps.select(F.explode("prefix").alias("h"), "row", "n"), num, den)
    hot = reps.select(F.explode("hot").alias("h"), "row").select(F.col("h").bitwiseOR(F.lit(-(1 << 63))).alias("a"), F.col("row").alias("b"))
    return pairs, stars.union(hot)


def _columns(cells: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pairs from the short columns of cells(h, row, n), and edges that join the rows of each long column.

    Columns come sorted, so that a task streams them.
    """
    cells = cells.repartition("h").sortWithinPartitions("h")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("m", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
        hub = None  # (h, row) of a long column that goes on
        for b in _then_none(batches):
            if b is not None:
                kept = [np.concatenate([old, b.column(i).to_numpy()]) for i, old in enumerate(kept)]
            h, row, n = kept
            if not len(h):
                continue
            cut = len(h) if b is None else int(np.searchsorted(h, h[-1]))
            edges = [(row[:0],) * 3]
            if b is not None and len(h) - cut > SHORT:  # the last column is long already: what is there can go
                cut = len(h)
            h, row, n, kept = h[:cut], row[:cut], n[:cut], [c[cut:] for c in kept]
            if not len(h):
                continue
            first = np.flatnonzero(np.diff(h, prepend=h[0] ^ 1))
            count = np.diff(np.append(first, len(h)))
            hubs = row[first]
            goes_on = hub is not None and h[0] == hub[0]
            long = count > SHORT
            if goes_on:
                hubs[0], long[0] = hub[1], True
            is_long = np.repeat(long, count)
            spoke = is_long & (row != np.repeat(hubs, count))
            edges.append((np.repeat(hubs, count)[spoke], row[spoke], np.full(int(spoke.sum()), -1)))
            hub = (h[-1], hubs[-1]) if long[-1] else None
            alone = np.repeat(count == 1, count) | is_long
            if not alone.all():
                edges.append(column_pairs(h[~alone], row[~alone], n[~alone], num, den))
            arrays = [pa.array(np.concatenate(c)) for c in zip(*edges)]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    found = common.mapped(cells, run, "a long, b long, m long").groupBy("a", "b", "m").agg(F.count("*").alias("o"))
    found = common.saved(found.where((F.col("m") < 0) | (F.col("o") >= F.least(F.greatest(F.lit(OVERLAP), F.floor(F.col("m") / SHARE)), F.ceil(F.col("m") * num / den)))), "pairs")
    return found.where("m >= 0").select("a", "b"), found.where("m < 0").select("a", "b")


def _then_none(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def linked(sets: list[np.ndarray], split: int, num: int, den: int) -> list[tuple[int, int]]:
    """Edges that span the links between sets; with split, only those between sets before and after it matter."""
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    rows = slice(0, split) if split else slice(None)
    cols = slice(split, None) if split else slice(None)
    # |x & y| >= bound is the same as den * |x & y| >= num * |x | y|
    bound = -(-num * (sizes[rows][:, None] + sizes[cols][None, :]) // (num + den))
    overlap = np.zeros(bound.shape, np.float32)
    left = np.bincount(owner, minlength=len(sets)).astype(np.int64)
    live = np.ones(len(sets), bool)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        own, place = owner[lo:hi], column[lo:hi] - at
        block = np.zeros((len(sets), min(COLUMNS, width - at)), np.float32)
        block[own, place] = 1
        left -= np.bincount(own, minlength=len(sets))
        a, b = np.flatnonzero(live[rows]), np.flatnonzero(live[cols])
        overlap[np.ix_(a, b)] += block[rows][a] @ block[cols][b].T
        reach = overlap + np.minimum(left[rows][:, None], left[cols][None, :]) >= bound
        if not split:
            np.fill_diagonal(reach, False)
        live[rows] &= reach.any(1)
        live[cols] &= reach.any(0)
        if not live.any():
            break
    found = overlap >= bound
    if not split:
        found = np.triu(found, 1)
    edges, parent = [], list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, j in zip(*np.nonzero(found)):
        i, j = int(i), int(j) + split
        if root(i) != root(j):
            parent[root(i)] = root(j)
            edges.append((i, j))
    return edges


def links(docs: DataFrame, sets: DataFrame, pairs: DataFrame, families: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Edges (a, b) that span the links among pairs(a, b) and within each family of families(row, family)."""
    sizes = families.join(sets.select("row", "n"), "row")
    totals = sizes.groupBy("family").agg(F.count("*").alias("c"), F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts")).where("c > 1")
    # two blocks of a family meet in one group, and each block itself in another; a family of one block is one group
    part = F.pmod(F.xxhash64("row"), F.col("parts"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: F.struct(F.least("part", o).alias("p"), F.greatest("part", o).alias("q")))
    placed = families.join(totals, "family").withColumn("part", part).select("row", "family", "part", F.explode(others).alias("pq")).select("row", "family", "part", "pq.p", "pq.q")
    # a pair goes to the group of its smaller row, which is compared with each of its partners; such parts are negative
    one, two = F.lit(-2).cast("long"), F.lit(-1).cast("long")
    ends = F.array(F.struct(F.col("a").alias("row"), F.col("a").alias("family"), one.alias("part")), F.struct(F.col("b").alias("row"), F.col("a").alias("family"), two.alias("part")))
    stars = pairs.select(F.explode(ends).alias("s")).distinct().select("s.row", "s.family", "s.part", one.alias("p"), two.alias("q"))
    asked = common.saved(placed.unionByName(stars).join(sets.select("_k1", "_k2", "row"), "row"), "asked")
    texts = common.maybe_in(docs.select("_k1", "_k2", "text"), "_k1", common.bloom(asked.select("_k1").distinct()))
    rows = texts.join(asked, ["_k1", "_k2"]).select("row", "text", "family", "part", "p", "q")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        at, hashes = None, common.WordHashes()

        def solve():
            one = [(r, e) for r, (part, e) in held.items() if part == at[1]]
            two = [(r, e) for r, (part, e) in held.items() if part != at[1]]
            every = one + two
            if len(every) > 1 and (two or at[1] == at[2]):
                for i, j in linked([e for _, e in every], len(one) if two else 0, num, den):
                    yield every[i][0], every[j][0]

        found: list[tuple[int, int]] = []
        for b in batches:
            for row, raw, family, part, p, q in zip(b.column(0).to_pylist(), common.binary(b.column(1)), *(b.column(i).to_pylist() for i in range(2, 6))):
                if (family, p, q) != at:
                    if held:
                        found += solve()
                    held, at = {}, (family, p, q)
                if row not in held:  # repeated rows have one key
                    held[row] = (part, shingles(raw, hashes, width))
                if p < 0 and len(held) > BLOCK_ROWS:
                    found += solve()
                    held = {r: x for r, x in held.items() if x[0] == p}
            if found:
                yield common.batch(schema, list(zip(*found)))
                found = []
        if held:
            found += solve()
        if found:
            yield common.batch(schema, list(zip(*found)))

    return common.mapped(rows.repartition("family", "p", "q").sortWithinPartitions("family", "p", "q", "part"), run, "a long, b long")


def _keyed(docs: DataFrame, carry: list[str]) -> DataFrame:
    rows = docs.select(F.struct(*carry).alias("rec"), F.col("text").cast("string").alias("text"))
    return rows.select("rec", "text", F.xxhash64("rec", "text").alias("_k1"), F.hash("text", "rec").cast("long").alias("_k2"))


def join(docs: DataFrame, carry: list[str], doc_id: str = "doc_id", width: int = SHINGLE, num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """For every row of docs: its key, rec (a struct of the columns in carry), n_shingles, component_id,
    and kept: whether it is the one row of its component to keep.

    Sets hold the distinct word n-grams of the lower-cased (A-Z) whole text; two link when
    den * |x & y| >= num * |x | y|. component_id is the smallest id reachable by links, ids that are
    null aside (null if there is no other). Rows with equal sets are linked, repeated rows too. A null
    or empty text has an empty set, links with nothing, keeps its own id and is kept.
    """
    keyed = _keyed(docs, carry)
    mark = common.saved_so_far()
    sets = sets_table(keyed, width, num, den)
    of = common.saved(sets.where("sig IS NOT NULL").groupBy("sig").agg(F.min("row").alias("rep")), "reps")
    # copies are few against all rows: what their filter lets pass needs no join, and its prefixes no shuffle
    copies = common.bloom(sets.select("sig", "row").join(of, "sig").where("row <> rep").select("row"))
    cells = sets.select("row", "n", "prefix", "hot")
    reps = common.surely_not_in(cells, "row", copies).unionByName(common.maybe_in(cells, "row", copies).join(of.select(F.col("rep").alias("row")), "row").select("row", "n", "prefix", "hot"))
    tried = common.saved_so_far()
    pairs, edges = candidates(reps, num, den)
    families = components(edges).where("id >= 0").select(F.col("id").alias("row"), F.col("root").alias("family"))
    spanning = common.saved(links(keyed, sets, pairs, families, width, num, den), "links")
    common.drop_since(docs.sparkSession, tried, spanning)
    found = components(spanning)
    class_of = of.join(found.select(F.col("id").alias("rep"), "root"), "rep", "left").select("sig", "rep", "root")
    # classes without a link are named by their own row, the others by a root; both kinds stay apart
    rows = sets.select("_k1", "_k2", "row", "rec", "n", "sig").join(class_of, "sig", "left")
    rows = common.saved(rows.select("_k1", "_k2", "row", "rec", "n", F.when(F.col("root").isNotNull(), F.col("root")).when(F.col("rep").isNotNull(), F.col("rep")).otherwise(F.col("row")).alias("c"), F.col("root").isNotNull().alias("big")), "classes")
    common.drop_since(docs.sparkSession, mark, rows)
    least = rows.groupBy("c", "big").agg(F.min(f"rec.{doc_id}").alias("component_id"), F.min(F.struct(F.col(f"rec.{doc_id}").isNull().alias("z"), F.col(f"rec.{doc_id}").alias("i"), F.col("row").alias("r"))).alias("best"))
    return rows.join(least, ["c", "big"]).select("_k1", "_k2", "rec", F.col("n").alias("n_shingles"), "component_id", (F.col("best.r") == F.col("row")).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", **how) -> DataFrame:
    """One row of docs for each component: that with the smallest id (null last), with all its columns as they are."""
    kept = join(docs, [doc_id], doc_id, **how).where("kept").select(F.col("_k1").alias("_a"), F.col("_k2").alias("_b"))
    keyed = docs.select(F.struct("*").alias("_row"), F.struct(doc_id).alias("rec"), F.col("text").cast("string").alias("_text"))
    keyed = keyed.select("_row", F.xxhash64("rec", "_text").alias("_k1"), F.hash("_text", "rec").cast("long").alias("_k2"))
    # rows with equal keys are repeats of one row: of those of a kept one, one stays; rows without words all stay
    found = keyed.join(kept.groupBy("_a", "_b").agg(F.count("*").alias("_n")), (F.col("_k1") == F.col("_a")) & (F.col("_k2") == F.col("_b")))
    numbered = found.withColumn("_i", F.row_number().over(Window.partitionBy("_k1", "_k2").orderBy(F.lit(1))))
    return numbered.where("_i <= _n").select("_row.*")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents"), ["doc_id"]).select("rec.doc_id", "n_shingles", "component_id")
