"""Benchmark decontamination by Wu-Manber multi-pattern search."""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased text: ASCII letters and digits, and all else from U+0080.
_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
WINDOW = 10
#: Benchmark text that one block may hold; its tables take about a hundred times as much in each Python worker.
BLOCK_BYTES = 1 << 20


def normal_words(raw: bytes | None) -> list[bytes]:
    return raw.translate(_WORDS).split() if raw else []


class WuManber:
    """Exact search for many byte strings of at least m bytes each.

    The shift table holds, for each block of B bytes in the first m bytes of a pattern, the least
    distance to the end of those m bytes; other blocks let the search skip m - B + 1 positions. At
    shift 0, the bucket of that suffix block selects strings by their first bytes, and a direct
    comparison confirms each.
    """

    def __init__(self, patterns: list[bytes]):
        self.m = m = min(map(len, patterns))
        self.block = size = 2 if m < 8 else 4 if m < 16 else 8
        self.head = min(m, 12)
        self.most = m - size + 1
        shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[bytes]]] = {}
        for p in patterns:
            for end in range(size, m + 1):
                block = p[end - size : end]
                if shift.get(block, self.most) > m - end:
                    shift[block] = m - end
            self.buckets.setdefault(p[m - size : m], {}).setdefault(p[: self.head], []).append(p)
        self.shift = shift

    def search(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        shift, most, size, m, head, n = self.shift.get, self.most, self.block, self.m, self.head, len(text)
        end = m
        while end <= n:
            block = text[end - size : end]
            if skip := shift(block, most):
                end += skip
                continue
            start = end - m
            for p in self.buckets[block].get(text[start : start + head], ()):
                if text.startswith(p, start):
                    yield start, p
            end += 1


class Windows:
    """The windows of a block of benchmark items, and where they occur in documents.

    A window is WINDOW consecutive words of an item; an item of fewer words, but not none, is one.
    Windows are searched as words between single spaces, in classes of similar length, so that a
    short one does not shorten the skips of the others.
    """

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int = WINDOW):
        self.items: dict[bytes, set[str]] = {}
        for item, raw in items:
            words = normal_words(raw)
            for i in range(max(1, len(words) - window + 1) if words else 0):
                self.items.setdefault(b" " + b" ".join(words[i : i + window]) + b" ", set()).update(() if item is None else (item,))
        classes: dict[int, list[bytes]] = {}
        for p in self.items:
            classes.setdefault(min(6, len(p).bit_length()), []).append(p)
        self.matchers = [WuManber(ps) for _, ps in sorted(classes.items())]
        self.width = {p: p.count(b" ") - 1 for p in self.items}

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges [start, end) of all occurrences, in order, and the items they come from."""
        text = b" " + b" ".join(words) + b" "
        found = sorted(hit for m in self.matchers for hit in m.search(text))
        spans, items, at, index = [], set(), 0, 0
        for start, p in found:
            index += text.count(b" ", at, start)
            at = start
            spans.append((index, index + self.width[p]))
            items |= self.items[p]
        return spans, items


def covered(spans: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for start, end in sorted(spans):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def _windows(shared, window: int) -> Windows:
    name, items = shared.value
    return common.built("windows", f"{name} {window}", lambda: Windows(items, window))


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator:
    """Broadcasts of a name and (item_id as text, text) lists, of about block_bytes of text each at most."""
    bench = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("binary").alias("t"))
    size = bench.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    for k in range(blocks):
        part = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        yield k, k == blocks - 1, bench.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, [(r.i, None if r.t is None else bytes(r.t)) for r in part.collect()]))


def find_benchmark_text(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For every row of docs(doc_id, text): doc_id, n_words, spans (word ranges, flat pairs), items.

    The benchmark is read in blocks of at most about `block_bytes` of text, each broadcast; with
    several blocks, each adds its hits in one more pass within the same stage, without a shuffle.
    A null text has no words; a null or repeated doc_id is kept as it is, one row out for each row
    in; a null item text has no windows; an item with a null id marks words but is not listed, and
    rows with one item_id count as one item. Other columns are ignored.
    """
    out = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = out.schema["doc_id"].dataType.simpleString()
    for k, last, shared in _blocks(benchmark, block_bytes):
        schema = f"doc_id {id_type}, {'n_words long' if last else 'text string'}, spans array<int>, items array<string>"

        def find(batches: Iterator[pa.RecordBatch], shared=shared, first=k == 0, last=last) -> Iterator[pa.RecordBatch]:
            windows = None
            for b in batches:
                windows = windows or _windows(shared, window)
                n_words, spans, items = [], [], []
                for row, raw in enumerate(common.binary(b.column(1))):
                    words = normal_words(raw)
                    found, whose = windows.hits(words) if words and windows.matchers else ([], set())
                    flat = [x for s in found for x in s]
                    n_words.append(len(words))
                    spans.append(flat if first else b.column(2)[row].as_py() + flat)
                    items.append(sorted(whose if first else whose | set(b.column(3)[row].as_py())))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(n_words, pa.int64()) if last else b.column(1), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    names=["doc_id", "n_words" if last else "text", "spans", "items"],
                )

        out = common.mapped(out, find, schema)
    return out


def summary(found: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated for each row of find_benchmark_text()."""
    id_type = found.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = [covered(list(zip(s[::2], s[1::2]))) if s else 0 for s in b.column("spans").to_pylist()]
            items = b.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("n_words"), pa.array(hit, pa.int64()), pa.array(list(map(len, items)), pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]), pa.array([h > 0 for h in hit])],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return common.mapped(found, digest, f"doc_id {id_type}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(find_benchmark_text(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs in which no benchmark window occurs, with all their columns as they are."""
    at, out = docs.columns.index("text"), docs
    for _, _, shared in _blocks(benchmark, block_bytes):

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows = None
            for b in batches:
                windows = windows or _windows(shared, window)
                clean = [not (windows.matchers and (w := normal_words(raw)) and windows.hits(w)[0]) for raw in common.binary(b.column(at))]
                yield b.filter(pa.array(clean, pa.bool_()))

        out = common.mapped(out, keep, docs.schema)
    return out
