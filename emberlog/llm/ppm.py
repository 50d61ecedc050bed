"""LM scoring by prediction by partial matching over bytes."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Longest context in bytes; most grams, and words, that may be broadcast, which sets the cost and never the result;
#: context bytes whose nodes are found in one place; grams scored at once, at least.
ORDER = 5
MOST_GRAMS = 1 << 20
MOST_WORDS = 1 << 18
SHARED = 3
BLOCK = 500_000
_GRAM = (1 << 8 * (ORDER + 1)) - 1
MODULUS = 10
SMOOTH = 0.1
_END = 10


def sequence(words: list[bytes]) -> np.ndarray:
    """What the model predicts: the lower-cased words between single spaces, then the end (a newline)."""
    return np.frombuffer(b"\n" * ORDER + b" ".join(words) + b"\n", np.uint8)


def grams(seq: np.ndarray) -> np.ndarray:
    """For each predicted byte, its ORDER bytes of context and itself, packed with the predicted byte lowest."""
    n = len(seq) - ORDER
    out = np.zeros(n, np.uint64)
    for i in range(ORDER + 1):
        out <<= np.uint64(8)
        out |= seq[i : i + n]
    return out


def count_corpus(docs: DataFrame) -> DataFrame:
    """Rows (w, g, n, m): occurrences of each training word w (the end: an empty w) and each gram g of any row, n in training rows, m in all."""
    source = docs.select(F.col("text").cast("string").alias("text"), common.held_out(F.col("doc_id"), MODULUS).alias("held_out"))
    schema = pa.schema([("w", pa.binary()), ("g", pa.int64()), ("n", pa.int64()), ("m", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, size, waiting, width = Counter(), [], 0, [], 0

        def squeeze():
            keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return [(keys, np.bincount(at, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64))]

        def flush():
            for some in common.chunks(list(words.items()), 50_000):
                yield common.batch(schema, [[w for w, _ in some], pa.nulls(len(some), pa.int64()), [n for _, n in some], [n for _, n in some]])
            for flagged, counts in squeeze() if parts else ():
                keys, at = np.unique(flagged & np.uint64(_GRAM), return_inverse=True)
                n = np.bincount(at, np.where(flagged > _GRAM, 0, counts), len(keys)).astype(np.int64)
                m = np.bincount(at, counts, len(keys)).astype(np.int64)
                for i in range(0, len(keys), 100_000):
                    k = keys[i : i + 100_000].astype(np.int64)
                    yield common.batch(schema, [pa.nulls(len(k), pa.binary()), pa.array(k), pa.array(n[i : i + 100_000]), pa.array(m[i : i + 100_000])])

        for b in batches:
            for raw, held in zip(common.binary(b.column(0)), b.column(1).to_pylist()):
                tokens = (raw or b"").translate(common.LOWER).split()
                if not held:
                    words.update(tokens)
                    words[b""] += 1
                waiting.append(grams(sequence(tokens)) | np.uint64(held * (_GRAM + 1)))  # a flag above the gram
                width += len(waiting[-1])
                if width > 1 << 21:
                    parts.append(np.unique(np.concatenate(waiting), return_counts=True))
                    size += len(parts[-1][0])
                    waiting, width = [], 0
                if size > 3_000_000:
                    parts = squeeze()
                    size = len(parts[0][0])
                if len(words) > 600_000 or size > 1_500_000:
                    yield from flush()
                    words, parts, size = Counter(), [], 0
        if waiting:
            parts.append(np.unique(np.concatenate(waiting), return_counts=True))
        yield from flush()

    return common.mapped(source, run, "w binary, g long, n long, m long").groupBy("w", "g").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


class Trie:
    """The context trie, order by order: nodes (context and symbol) with counts, and what each context needs to predict.

    A context predicts a symbol of its own with (c - 1/2) / (kept + cut): kept is what its q nodes
    count, cut the count of those pruned. The escape gets the rest, (q/2 + cut) of that (method D,
    the pruned mass added). After an escape, the symbols of the context left are excluded below: their number
    and their mass there are subtracted. Below order 0, all bytes not excluded are equally likely.
    """

    def __init__(self, nodes: list[tuple[np.ndarray, np.ndarray]]):
        self.keys = [k for k, _ in nodes]
        self.counts = [c.astype(np.float64) for _, c in nodes]
        self.contexts, self.kept, self.distinct, self.cut, self.excluded = [], [], [], [], []
        for order, (keys, counts) in enumerate(nodes):
            contexts, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            kept = np.bincount(at, counts, len(contexts))
            seen, excluded = kept, np.zeros(len(contexts))
            if order:
                found, place = self._look(self.keys[order - 1], contexts)
                seen = np.where(found, self.counts[order - 1][place], kept)
                below = keys & np.uint64((1 << 8 * order) - 1)
                found, place = self._look(self.keys[order - 1], below)
                excluded = np.bincount(at, np.where(found, self.counts[order - 1][place], 0), len(contexts))
            self.contexts.append(contexts)
            self.kept.append(kept)
            self.distinct.append(np.bincount(at, minlength=len(contexts)).astype(np.float64))
            self.cut.append(np.maximum(0, seen - kept))
            self.excluded.append(excluded)

    @staticmethod
    def _look(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return table[place] == keys, place

    def log_probability(self, g: np.ndarray) -> np.ndarray:
        """log10 of each gram's last byte after the bytes before it."""
        out = np.zeros(len(g))
        mass, number = np.zeros(len(g)), np.zeros(len(g))  # excluded at the next order down
        active = np.arange(len(g))
        for order in range(len(self.keys) - 1, -1, -1):
            if not len(active):
                return out
            here = g[active]
            known, c = self._look(self.contexts[order], (here >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1))
            found, place = self._look(self.keys[order], here & np.uint64((1 << 8 * (order + 1)) - 1))
            if not len(self.contexts[order]):
                continue
            kept = np.maximum(0, self.kept[order][c] - mass[active])
            escape = np.maximum(0, self.distinct[order][c] - number[active]) / 2 + self.cut[order][c]
            total = kept + self.cut[order][c]
            hit = known & found
            out[active[hit]] += np.log10((self.counts[order][place[hit]] - 0.5) / total[hit])
            miss = known & ~found
            left = miss & (escape > 0)
            out[active[left]] += np.log10(escape[left] / total[left])
            mass[active[miss]], number[active[miss]] = self.excluded[order][c[miss]], self.distinct[order][c[miss]]
            active = active[~hit]
        if len(active):
            out[active] -= np.log10(256 - number[active])
        return out


class Known:
    """log10 of the grams that are broadcast; NaN for others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        by = np.argsort(keys)
        self.keys, self.values = keys[by].astype(np.uint64), values[by]

    def log_probability(self, g: np.ndarray) -> np.ndarray:
        found, place = Trie._look(self.keys, g)
        out = np.full(len(g), np.nan)
        out[found] = self.values[place[found]]
        return out


class Scorer:
    """Sums code lengths; a direct-mapped memo keeps those of grams met before and does not change results."""

    def __init__(self, trie: Trie | Known, bits: int = 20):
        self.trie, self.shift = trie, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, ~np.uint64(0)), np.zeros(1 << bits)

    def __call__(self, g: np.ndarray) -> np.ndarray:
        slot = (g * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        slot = slot.astype(np.int64)
        out, miss = self.values[slot], np.flatnonzero(self.keys[slot] != g)
        if len(miss):
            new, at = np.unique(g[miss], return_inverse=True)
            values = self.trie.log_probability(new)
            out[miss] = values[at]
            where = ((new * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
            _, last = np.unique(where[::-1], return_index=True)  # of grams that share a slot, one
            last = len(where) - 1 - last
            self.keys[where[last]], self.values[where[last]] = new[last], values[last]
        return out


def _node(keys: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys & np.uint64((1 << 8 * (order + 1)) - 1), return_inverse=True)
    return keys, np.bincount(at, counts, len(keys))


def gram_scores(counts: DataFrame) -> DataFrame:
    """Rows (g, m, lp): log10 of each gram's last byte after the bytes before it, by the trie of all training grams, none pruned.

    Contexts that end in the same SHARED bytes lie in one partition, next to each other: so all nodes
    of order SHARED and above that a gram needs are there, and a task streams them block by block.
    The nodes of lower orders are broadcast: runs of SHARED bytes, at most 2^24 whatever the corpus.
    """
    spark = counts.sparkSession
    whole = counts.where("g IS NOT NULL").select("g", "n", "m")
    low = whole.where("n > 0").groupBy(F.col("g").bitwiseAND((1 << 8 * SHARED) - 1).alias("g")).agg(F.sum("n").alias("n")).toArrow()
    g, n = low.column("g").to_numpy().astype(np.uint64), low.column("n").to_numpy()
    shared = spark.sparkContext.broadcast([_node(g, n, k) for k in range(SHARED)])

    def score_block(g: np.ndarray, n: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        g = g.astype(np.uint64)
        keys, counts = g[n > 0], n[n > 0]
        trie = Trie([*shared.value, *(_node(keys, counts, k) for k in range(SHARED, ORDER + 1))])
        return pa.RecordBatch.from_arrays([pa.array(g.astype(np.int64)), pa.array(m), pa.array(trie.log_probability(g))], names=["g", "m", "lp"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for b in batches:
            parts.append([b.column(i).to_numpy() for i in range(4)])
            size += b.num_rows
            if size > BLOCK:
                columns = [np.concatenate(c) for c in zip(*parts)]
                cut = int(np.searchsorted(columns[3], columns[3][-1]))  # the last context may go on
                if cut:
                    yield score_block(*(c[:cut] for c in columns[:3]))
                parts, size = [[c[cut:] for c in columns]], len(columns[0]) - cut
        if size:
            yield score_block(*(np.concatenate(c) for c in list(zip(*parts))[:3]))

    end = F.shiftright("g", 8).bitwiseAND((1 << 8 * SHARED) - 1)
    return common.mapped(whole.select("g", "n", "m", end.alias("e")).repartition("e").sortWithinPartitions("e"), run, "g long, m long, lp double")


def frequent_grams(scores: DataFrame, most: int | None = None) -> tuple[DataFrame, pa.Table]:
    """The grams below the least number of occurrences that at most `most` grams reach, and those that reach it."""
    rows = scores.groupBy(F.floor(F.log2("m") * 8).alias("l")).agg(F.count("*").alias("v"), F.min("m").alias("least")).orderBy(F.desc("l")).collect()
    taken, least = 0, 1 << 62
    for r in rows:
        taken += r.v
        if taken > (MOST_GRAMS if most is None else most):
            break
        least = r.least
    return scores.where(F.col("m") < least), scores.where(F.col("m") >= least).select("g", "lp").toArrow()


def frequent_words(counts: DataFrame, most: int = MOST_WORDS) -> tuple[DataFrame, int, int, int]:
    """Words above the least count that at most `most` words reach; that count, N and V."""
    words = counts.where("w IS NOT NULL").select("w", "n")
    level = F.floor(F.log2("n") * 8)
    rows = words.groupBy(level.alias("l")).agg(F.count("*").alias("v"), F.sum("n").alias("n"), F.min("n").alias("least")).orderBy(F.desc("l")).collect()
    total, distinct, taken, least = sum(r.n for r in rows), sum(r.v for r in rows), 0, 1 << 62
    for r in rows:
        taken += r.v
        if taken > most:
            break
        least = r.least
    return words, least, total, distinct


def _built(shared) -> tuple:
    name, grams, values, words, counts = shared.value
    return common.built("grams", name, lambda: (Scorer(Known(grams, values)), dict(zip(words, np.log10(np.asarray(counts, np.float64) + SMOOTH).tolist()))))


def score_documents(docs: DataFrame) -> DataFrame:
    """For every row of docs(doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Base and model are both probabilities of the same thing: the sequence of lower-cased words and
    its end. A null text is empty: just the end. Rows with a null id are training rows or not as
    crc32('') says; repeated rows stay and count each time. Without any training row N = V = 0 and
    every byte is equally likely. Other columns are ignored.
    """
    spark = docs.sparkSession
    counts = common.saved(count_corpus(docs), "ppm-counts")
    rare_scores, scores = frequent_grams(common.saved(gram_scores(counts), "ppm-grams"))
    words, least, total, distinct = frequent_words(counts)
    common_words = words.where(F.col("n") >= least).toArrow()
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, scores.column("g").to_numpy(), scores.column("lp").to_numpy(), common_words.column("w").to_pylist(), common_words.column("n").to_numpy()))
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), common.held_out(F.col("doc_id"), MODULUS).alias("held_out"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    rare_type = pa.list_(pa.struct([("w", pa.binary()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, known = _built(shared)
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                n_tokens, n_known, logs, rare, scores, others, waiting = [], [], [], [], [], [], []

                def settle():
                    values = scorer(np.concatenate(waiting))
                    absent, at = np.isnan(values), 0
                    values[absent] = 0
                    for w in waiting:
                        scores.append(float(values[at : at + len(w)].sum()))
                        others.append(np.unique(w[absent[at : at + len(w)]], return_counts=True))
                        at += len(w)
                    waiting.clear()

                for raw in common.binary(part.column(1)):
                    tokens = (raw or b"").translate(common.LOWER).split()
                    found = list(map(known.get, tokens))
                    unknown = Counter(w for w, v in zip(tokens, found) if v is None) if None in found else {}
                    if b"" not in known:
                        unknown = Counter({**unknown, b"": 1})
                    values = [v for v in [*found, known.get(b"")] if v is not None]
                    n_tokens.append(len(tokens) + 1)
                    n_known.append(len(values))
                    logs.append(math.fsum(values))
                    rare.append([{"w": w, "n": n} for w, n in unknown.items()])
                    waiting.append(grams(sequence(tokens)))
                    if sum(map(len, waiting)) > 1 << 18:
                        settle()
                if waiting:
                    settle()
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate([g for g, _ in others]).astype(np.int64)), pa.array(np.concatenate([k for _, k in others]).astype(np.int32))], names=["g", "k"])
                other = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(g) for g, _ in others)]), pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array(logs, pa.float64()), pa.array(rare, rare_type), other, pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "logs", "rare", "grams", "score"],
                )

    scored = common.mapped(source, run, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, logs double, rare array<struct<w:binary,n:int>>, grams array<struct<g:long,k:int>>, score double")
    scored = common.saved(scored.withColumn("row", F.monotonically_increasing_id()), "ppm-scored")
    rare = (
        scored.select("row", F.explode("rare").alias("r"))
        .select("row", F.col("r.w").alias("w"), F.col("r.n").alias("k"))
        .join(words.where(F.col("n") < least), "w", "left")
        .groupBy("row")
        .agg(F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("rare_logs"), F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("rare_known"))
    )
    other = (
        scored.select("row", F.explode("grams").alias("r"))
        .select("row", F.col("r.g").alias("g"), F.col("r.k").alias("k"))
        .join(rare_scores.select("g", "lp"), "g")
        .groupBy("row")
        .agg(F.sum(F.col("k") * F.col("lp")).alias("other"))
    )
    each = math.log10(total + SMOOTH * (distinct + 1))
    return scored.drop("rare", "grams").join(rare, "row", "left").join(other, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) - F.col("n_tokens") * each).alias("base_score"),
        (F.col("score") + F.coalesce("other", F.lit(0.0))).alias("score"),
    )


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(common.table(spark, sf_dir, "documents"))
