"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import threading
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The mapping of A-Z to a-z.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only in local mode, where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="emberlog-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


class _Saved(threading.local):
    """Paths of the tables that a thread's queries have saved."""

    def __init__(self):
        self.paths: list[str] = []


_SAVED = _Saved()


def saved(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it back; this cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/emberlog-{name}-{uuid.uuid4().hex}"
    df.write.options(**options or {}).parquet(path)
    _SAVED.paths.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(*tables: DataFrame) -> None:
    """Deletes saved tables that nothing reads any more."""
    for t in tables:
        remove(t.sparkSession, t.saved_at)
        _SAVED.paths.remove(t.saved_at)


def saved_so_far() -> int:
    return len(_SAVED.paths)


def drop_since(spark: SparkSession, mark: int, *keep: DataFrame) -> None:
    """Deletes the tables saved since saved_so_far() gave mark, but for those to keep; what read them has to be written by then."""
    kept = [t.saved_at for t in keep]
    for path in _SAVED.paths[mark:]:
        if path not in kept:
            remove(spark, path)
    _SAVED.paths[mark:] = kept


def held_out(doc_id: Column, modulus: int) -> Column:
    """Whether crc32(doc_id as text) is divisible by modulus; a null id counts as the text ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == 0


def is_held_out(doc_id, modulus: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == 0


def binary(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


_BUILT: dict[str, tuple[str, object]] = {}
_USED: set[str] = set()


def built(kind: str, name: str, make):
    """What make() gives, made once in a Python worker while the same name is asked for; the last one of each kind is held,
    until a task of `mapped` ends that did not ask for it.

    Names have to be unique to what is broadcast: the address of a value is not, as workers outlive broadcasts.
    """
    _USED.add(kind)
    if _BUILT.get(kind, ("", None))[0] != name:
        _BUILT.pop(kind, None)
        _BUILT[kind] = (name, make())
    return _BUILT[kind][1]


def _begin() -> None:
    """Arrow takes memory from malloc, which can give all of it back."""
    pa.set_memory_pool(pa.system_memory_pool())
    _USED.clear()


def give_back() -> None:
    """Workers go on from task to task and stage to stage: what was freed returns to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _end() -> None:
    for kind in set(_BUILT) - _USED:
        del _BUILT[kind]
    give_back()


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(run, schema), whose workers give their memory back after each task."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin()
        yield from run(batches)
        _end()

    return df.mapInArrow(lean, schema)


def chunks(values: list, size: int) -> Iterator[list]:
    for i in range(0, len(values), size):
        yield values[i : i + size]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit xxhash of words, remembered up to a bounded number of distinct words."""

    def __init__(self, most: int = 150_000):
        from xxhash import xxh64_intdigest

        super().__init__()
        self._digest, self._most = xxh64_intdigest, most

    def __missing__(self, word: bytes) -> int:
        value = self[word] = self._digest(word)
        return value

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self._most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """An order-sensitive 64-bit hash of every run of `width` values (polynomial, then mixed)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # by doubling: P[w] of width w; P[a+b](i) = P[a](i) * M^b + P[b](i+a)
    base, out, have, power, width_left = np.uint64(0x9E3779B97F4A7C15), None, 0, hashes, width
    factor, span = base, 1
    with np.errstate(over="ignore"):
        while width_left:
            if width_left & 1:
                out = power if out is None else out[: len(out) - span] * factor + power[have:]
                have += span
            width_left >>= 1
            if width_left:
                power = power[: len(power) - span] * factor + power[span:]
                factor, span = factor * factor, span * 2
        return mix(out[:n])


#: Bits of a Bloom filter: 8 MB whatever it holds; beyond some ten million keys it lets more and more rows pass.
BLOOM_BITS = 1 << 26


def bloom(keys: DataFrame):
    """A broadcast Bloom filter of the one long column of keys, its bits gathered in table form."""
    k = F.col(keys.columns[0])
    places = F.array(*[F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(BLOOM_BITS)) for seed in (1, 2)])
    bits = keys.select(F.explode(places).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("b")).toArrow()
    words = np.zeros(BLOOM_BITS >> 6, np.int64)
    words[bits.column("w").to_numpy()] = bits.column("b").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(words.tobytes())


def maybe_in(docs: DataFrame, key: str, shared) -> DataFrame:
    """The rows of docs whose long column `key` may be in the filter; none that is in it gets lost."""
    return _passed(docs, key, shared, True)


def surely_not_in(docs: DataFrame, key: str, shared) -> DataFrame:
    return _passed(docs, key, shared, False)


def _passed(docs: DataFrame, key: str, shared, wanted: bool) -> DataFrame:
    places = [F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(BLOOM_BITS)) for seed in (1, 2)]
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(shared.value, np.uint64)
        for b in batches:
            found = np.ones(b.num_rows, bool)
            for p in (b.column(len(columns)), b.column(len(columns) + 1)):
                at = p.to_numpy()
                found &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield b.select(range(len(columns))).filter(pa.array(found == wanted))

    return mapped(docs.select("*", *[p.alias(f"_b{i}") for i, p in enumerate(places)]), run, docs.schema)
