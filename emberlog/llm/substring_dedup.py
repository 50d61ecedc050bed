"""Substring dedup: repeated word windows, found in prefix-partitioned suffix trees.

The suffixes that matter start at anchors. Of the GRAM-word runs in a window, the one with the least
hash is its anchor, so equal windows have equal anchors at equal offsets, and one position in ten is
an anchor. The GRAM words from the anchor on are the prefix that partitions the suffixes:

1. prefixes that occur once are dropped: no window over them repeats;
2. the others are counted; where a prefix has more suffixes than a group may hold, it is lengthened
   until it spans a whole window, one group for each offset of the anchor. Such a group's tree is one
   node deep enough, and all that matters is whether it has two leaves: these are counted, never
   gathered, however many there are;
3. each other group's suffixes are sorted into a suffix tree (the order and the common prefix lengths of
   neighbours). At offset o a window is o words left of the anchor and the rest right of it: two
   leaves below one internal node of that depth, with o equal words on their left, repeat it;
4. the offsets found go back to the anchors, and from there to the words of each document.

Suffixes with equal words around them are sent at most twice by a task, so copies cost no more. On the way
back a document names each of its surroundings once, with all its places, and each has one row of offsets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW, GRAM = 35, 16
#: Suffixes of one prefix up to which its group stays whole, and of the groups that one tree pass takes together.
GROUP = 20_000
#: Distinct surroundings that a task remembers so as not to send them again.
REMEMBERED = 400_000
_POSITION = np.uint64(28)


def anchors(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash, place, least and most offset of every anchor of one document's word hashes."""
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none.astype(np.uint64), none, none, none
    h = common.rolling(hashes, gram)
    # order by hash, ties to the left: the place fills the low bits
    least = ((h >> _POSITION) << _POSITION) | np.arange(len(h), dtype=np.uint64)
    width, span = window - gram + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[: len(least) - span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    at = (least & np.uint64((1 << 28) - 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    place = at[first]
    return h[place], place, place - last, place - first


class SuffixTree:
    """The tree of rows of words below one or several prefixes, as sorted order and common prefix lengths.

    nodes(d) names, for each row, the node at depth d that it is below: rows share it if their group
    and first d words are equal.
    """

    def __init__(self, group: np.ndarray, words: np.ndarray):
        self.order = np.lexsort((*words.T[::-1], group))
        g, w = group[self.order], words[self.order]
        same = np.cumprod(w[1:] == w[:-1], axis=1, dtype=np.int8).sum(1) if len(w) > 1 else np.zeros(0, np.int64)
        self.common = np.where(g[1:] == g[:-1], same, -1)

    def nodes(self, depth: int) -> np.ndarray:
        out = np.zeros(len(self.order), np.int64)
        out[self.order[1:]] = np.cumsum(self.common < depth)
        return out


def repeated_offsets(group: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray, most: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each row the bits o for which its window at offset o has an equal one in another row of its group.

    left holds the words before the anchor, nearest first; right the anchor's word and those after.
    """
    bits = np.zeros(len(group), np.int64)
    deep, back = SuffixTree(group, right), SuffixTree(group, left)
    for o in range(int(least.min()), int(most.max()) + 1):
        rows = np.flatnonzero((least <= o) & (o <= most))
        if len(rows) < 2:
            continue
        key = deep.nodes(window - o)[rows] * np.int64(len(group) + 1) + back.nodes(o)[rows]
        _, at, n = np.unique(key, return_inverse=True, return_counts=True)
        bits[rows[n[at] > 1]] |= np.int64(1) << o
    return bits


def _anchor_rows(docs: DataFrame) -> DataFrame:
    """(h, k1, k2, p) for every anchor: gram hash, row key, and place with offsets packed."""
    source = docs.select("_k1", "_k2", "text")
    schema = pa.schema([("h", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("p", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = common.WordHashes()
        for b in batches:
            k1, k2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            out: list[list[np.ndarray]] = [[], [], [], []]
            for row, raw in enumerate(common.binary(b.column(2))):
                words = raw.split() if raw else ()
                if len(words) < WINDOW:
                    continue
                h, place, least, most = anchors(hashes(words))
                for column, values in zip(out, (h.view(np.int64), np.full(len(h), k1[row]), np.full(len(h), k2[row]), place << 10 | least << 5 | most)):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], schema=schema)

    return common.mapped(source, run, "h long, k1 long, k2 long, p long")


def _surroundings(raw: bytes, found: list[dict]):
    """(place, n, least, most, words before, words from the anchor on) of the anchors listed."""
    words = raw.split()
    for p, n in {(a["p"], a["n"]) for a in found}:
        place, least, most = p >> 10, p >> 5 & 31, p & 31
        yield place, n, least, most, words[place - most : place], words[place : place + WINDOW - least]


def _digest(least: int, before: list[bytes], after: list[bytes]) -> bytes:
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(b"%d %d " % (least, len(before)) + b" ".join(before) + b"  " + b" ".join(after))


def _suffix_rows(texts: DataFrame) -> DataFrame:
    """Rows of three kinds: (k1, k2, places, c) names a document's anchors kept that have the digest c of all words around;
    (g, c, least, most, before, after) is a suffix with these words, to be put into group g;
    (w, c, least) is one below a prefix that spans a whole window, with digest w, at offset least."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("places", pa.list_(pa.int64())), ("g", pa.int64()), ("w", pa.binary()), ("c", pa.binary()), ("least", pa.int32()), ("most", pa.int32()), ("before", pa.binary()), ("after", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        sent: dict[bytes, bool] = {}
        rows: list[tuple] = []
        for b in batches:
            for k1, k2, raw, found in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), common.binary(b.column(2)), b.column(3).to_pylist()):
                own: dict[bytes, list[int]] = {}
                for place, n, least, most, before, after in _surroundings(raw, found):
                    c = _digest(least, before, after)
                    own.setdefault(c, []).append(place)
                    if sent.get(c):
                        continue
                    if len(sent) > REMEMBERED:
                        sent.clear()
                    sent[c] = c in sent
                    if n <= GROUP:
                        g = xxh3_64_intdigest(b" ".join(after[:GRAM]))
                        rows.append((None, None, None, g - (1 << 64) if g >> 63 else g, None, c, least, most, b" ".join(before), b" ".join(after)))
                        continue
                    for o in range(least, most + 1):
                        w = _digest(o, before[len(before) - o :], after[: WINDOW - o])
                        rows.append((None, None, None, None, w, c, o, None, None, None))
                rows += [(k1, k2, sorted(places), None, None, c, None, None, None, None) for c, places in own.items()]
                if len(rows) > 20_000:
                    yield common.batch(schema, list(zip(*rows)))
                    rows = []
        if rows:
            yield common.batch(schema, list(zip(*rows)))

    return common.mapped(texts.select("_k1", "_k2", "text", "anchors"), run, "k1 long, k2 long, places array<long>, g long, w binary, c binary, least int, most int, before binary, after binary")


def _tree_rows(suffixes: DataFrame) -> DataFrame:
    """(c, bits) for every suffix with repeated windows; the groups come sorted, so that a task streams them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(t: pa.Table):
            ids: dict[bytes, int] = {}
            n = t.num_rows
            before, after = (np.empty((n, w), np.int64) for w in (WINDOW - GRAM, WINDOW))
            for side, column, name in ((before, "before", True), (after, "after", False)):
                # words beyond a row's own equal no others
                side[:] = -1 - np.arange(n)[:, None]
                for row, raw in enumerate(t.column(column).to_pylist()):
                    words = raw.split()
                    side[row, : len(words)] = [ids.setdefault(w, len(ids)) for w in (words[::-1] if name else words)]
            bits = repeated_offsets(t.column("g").to_numpy(), before, after, t.column("least").to_numpy(), t.column("most").to_numpy())
            own = np.flatnonzero(bits)
            c, bits = t.column("c").to_pylist(), bits.tolist()
            return pa.RecordBatch.from_arrays([pa.array([c[i] for i in own], pa.binary()), pa.array([bits[i] for i in own], pa.int64())], names=["c", "bits"])

        held: list[pa.Table] = []
        size = 0
        for b in batches:
            t = pa.Table.from_batches([b])
            held.append(t)
            size += t.num_rows
            if size < GROUP:
                continue
            t = pa.concat_tables(held)
            g = t.column("g").to_numpy()
            cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
            if cut:
                yield solve(t.slice(0, cut))
            held, size = [t.slice(cut)], t.num_rows - cut
        if size:
            yield solve(pa.concat_tables(held))

    return common.mapped(suffixes.repartition(F.col("g")).sortWithinPartitions("g"), run, "c binary, bits long")


def remove_repeats(docs: DataFrame, carry: list[str], texts: bool = False) -> DataFrame:
    """For every row of docs: rec (a struct of the columns in carry), n_words, n_removed, kept_sha256 and,
    with texts, kept: the words left joined by one space, or the text as it is where none goes.

    Removed is each word covered by WINDOW consecutive words that start anywhere else as well, judged
    on the input; so all copies go, the first too. A null text has no words (kept: null). Repeated
    rows are separate documents, so their windows repeat; null ids stay. Other columns are ignored.
    """
    rows = docs.select(F.struct(*carry).alias("rec"), F.col("text").cast("string").alias("text"))
    rows = rows.select("rec", "text", F.xxhash64("rec", "text").alias("_k1"), F.hash("text", "rec").cast("long").alias("_k2"))
    found = common.saved(_anchor_rows(rows), "anchors")
    repeated = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    kept = found.join(repeated, "h").groupBy(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).agg(F.collect_set(F.struct("p", "n")).alias("anchors"))
    kept = common.saved(kept, "kept")
    common.drop(found)
    pending = common.maybe_in(rows.select("_k1", "_k2", "text"), "_k1", common.bloom(kept.select("_k1"))).join(kept, ["_k1", "_k2"])
    suffixes = common.saved(_suffix_rows(pending), "suffixes")
    common.drop(kept)
    trees = _tree_rows(suffixes.where("g IS NOT NULL").select("g", "c", "least", "most", "before", "after"))
    whole = suffixes.where("w IS NOT NULL").select("w", "c", "least")
    several = whole.groupBy("w").agg(F.count("*").alias("n")).where("n > 1")
    trees = trees.unionByName(whole.join(several, "w").select("c", F.expr("shiftleft(1L, least)").alias("bits")))
    links = suffixes.where("k1 IS NOT NULL").select("c", F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "places")
    marks = links.join(trees.groupBy("c").agg(F.bit_or("bits").alias("bits")), "c").groupBy("_k1", "_k2").agg(F.collect_set(F.struct("places", "bits")).alias("marks"))
    marks = common.saved(marks, "marks")
    common.drop(suffixes)
    rec_type = rows.schema["rec"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, removed, digests, left = [], [], [], []
            for raw, marks in zip(common.binary(b.column(1)), b.column(2).to_pylist()):
                words = raw.split() if raw else []
                kept = words
                if marks:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for m in marks:
                        places, bits = np.array(m["places"], np.int64), m["bits"]
                        while bits:
                            start = places - (bits & -bits).bit_length() + 1
                            edge[start] += 1
                            edge[start + WINDOW] -= 1
                            bits &= bits - 1
                    kept = [w for w, g in zip(words, (np.cumsum(edge[:-1]) > 0).tolist()) if not g]
                counts.append(len(words))
                removed.append(len(words) - len(kept))
                joined = b" ".join(kept)
                digests.append(hashlib.sha256(joined).hexdigest())
                left.append(joined if removed[-1] else raw)
            arrays = [b.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(left, pa.binary()).cast(pa.string())] * texts, names=["rec", "n_words", "n_removed", "kept_sha256", *["kept"] * texts])

    shared = common.bloom(marks.select("_k1"))
    some = common.maybe_in(rows, "_k1", shared).join(marks, ["_k1", "_k2"], "left").select("rec", "text", "marks")
    none = common.surely_not_in(rows, "_k1", shared).select("rec", "text", F.lit(None).cast(marks.schema["marks"].dataType).alias("marks"))
    return common.mapped(some.unionByName(none), cut, f"rec {rec_type}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.table(spark, sf_dir, "documents"), ["doc_id"]).select("rec.doc_id", "n_words", "n_removed", "kept_sha256")
