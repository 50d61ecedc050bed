"""URL rules as a sorted, memory-mapped array of 64-bit digests."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common

#: (verdict, host, path) of the rules that the query applies.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Rules, in bytes, that one array may hold; more are dealt over several arrays.
SHARD_BYTES = 256 << 20


def split_url(url: bytes | None) -> tuple[bytes, bytes]:
    """Host (lower-cased A-Z) and path; both empty for null or without ://."""
    _, mark, rest = (url or b"").partition(b"://")
    if not mark:
        return b"", b""
    for stop in (b"#", b"?"):
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition(b"/")
    return host.translate(common.LOWER), slash + path


class DigestArray:
    """Rule strings by sorted 64-bit xxhash key, memory-mapped from one file.

    A probe is a vectorised binary search over the keys; the stored full string then confirms it,
    so that a collision of digests cannot decide. Equal keys of different strings are all compared.
    """

    def __init__(self, path: str):
        head = np.memmap(path, np.uint64, "r", shape=2)
        n, size = map(int, head)
        self.keys = np.memmap(path, np.uint64, "r", 16, (n,)) if n else np.zeros(0, np.uint64)
        self.starts = np.memmap(path, np.int64, "r", 16 + 8 * n, (n + 1,))
        self.blocks = np.memmap(path, np.uint8, "r", 24 + 16 * n, (n,)) if n else np.zeros(0, np.uint8)
        self.text = np.memmap(path, np.uint8, "r", 24 + 17 * n, (size,)) if size else np.zeros(0, np.uint8)

    @staticmethod
    def pack(rules: list[tuple[str, str, str]]) -> bytes:
        """Of two rules with equal host and path, block wins."""
        verdicts: dict[bytes, bool] = {}
        for verdict, host, path in rules:
            whole = (host.lower() + path).encode()
            verdicts[whole] = verdicts.get(whole, False) or verdict == "block"
        order = sorted(verdicts, key=lambda s: (xxh64_intdigest(s), s))
        starts = np.concatenate([[0], np.cumsum([len(s) for s in order])]).astype(np.int64)
        keys = np.array([xxh64_intdigest(s) for s in order], np.uint64)
        return b"".join([np.array([len(order), starts[-1]], np.uint64).tobytes(), keys.tobytes(), starts.tobytes(), bytes(verdicts[s] for s in order), *order])

    def find(self, probes: list[bytes]) -> np.ndarray:
        """The place of each probe among the rules, or -1."""
        out = np.full(len(probes), -1, np.int64)
        if not len(self.keys) or not probes:
            return out
        digests = np.fromiter(map(xxh64_intdigest, probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, digests)
        for i in np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == digests)):
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == digests[i]:
                if self.text[self.starts[k] : self.starts[k + 1]].tobytes() == probes[i]:
                    out[i] = k
                    break
                k += 1
        return out


def _opened(shared) -> DigestArray:
    name, packed = shared.value

    def mapped() -> DigestArray:
        fd, path = tempfile.mkstemp(suffix=".digests")
        with os.fdopen(fd, "wb") as f:
            f.write(packed)
        array = DigestArray(path)
        os.unlink(path)  # the mapping keeps the pages; nothing stays in the folder
        return array

    return common.built("digests", name, mapped)


def judge(pages: DataFrame, rules=RULES, default: str = "allow", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """For every row of pages(page_id, url): page_id, host, path, rule (or null), verdict.

    A rule (verdict, host, path) fits its host and all subdomains if the url's path starts with the
    rule's; the longest rule wins, of equally long ones that with the longer host. Without a rule the
    verdict is `default`. Null or malformed urls have empty host and path. Repeated rows and null ids
    stay. Rule lists beyond `shard_bytes` are dealt over several arrays, probed one after the other
    in the same stage. No shuffle; only page_id and url are read.
    """
    spark = pages.sparkSession
    rules = sorted(rules)
    size = sum(len(h) + len(p) + 17 for _, h, p in rules)
    shards = max(1, -(-size // shard_bytes))
    lengths = sorted({len(p.encode()) for _, _, p in rules}, reverse=True)
    out = pages.select("page_id", F.col("url").cast("string").alias("url"))
    id_type = out.schema["page_id"].dataType.simpleString()
    for k in range(shards):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, DigestArray.pack(rules[k::shards])))
        last = k == shards - 1
        schema = f"page_id {id_type}, " + ("host string, path string, rule string, verdict string" if last else "url string, rule string, verdict string, host_length int")

        def run(batches: Iterator[pa.RecordBatch], shared=shared, first=k == 0, last=last) -> Iterator[pa.RecordBatch]:
            array = None
            for b in batches:
                array = array or _opened(shared)
                probes, owner, host_of, parts = [], [], [], []
                for row, url in enumerate(common.binary(b.column(1))):
                    host, path = split_url(url)
                    parts.append((host, path))
                    suffix = host
                    while suffix:
                        for n in lengths:
                            if n <= len(path):
                                probes.append(suffix + path[:n])
                                owner.append(row)
                                host_of.append(len(suffix))
                        suffix = suffix.partition(b".")[2]
                best: list = [(0, 0, None, default)] * b.num_rows
                if not first:
                    best = [(len(r.encode()), h, r, v) if r is not None else (0, 0, None, default) for r, v, h in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
                places = array.find(probes)
                for i in np.flatnonzero(places >= 0):
                    found = (len(probes[i]), host_of[i])
                    if found > best[owner[i]][:2]:
                        best[owner[i]] = (*found, probes[i].decode("utf-8", "replace"), "block" if array.blocks[places[i]] else "allow")
                rule, verdict = pa.array([x[2] for x in best], pa.string()), pa.array([x[3] for x in best], pa.string())
                if last:
                    host, path = (pa.array([p[i].decode("utf-8", "replace") for p in parts], pa.string()) for i in (0, 1))
                    yield pa.RecordBatch.from_arrays([b.column(0), host, path, rule, verdict], names=["page_id", "host", "path", "rule", "verdict"])
                else:
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), rule, verdict, pa.array([x[1] for x in best], pa.int32())], names=["page_id", "url", "rule", "verdict", "host_length"])

        out = common.mapped(out, run, schema)
    return out


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"))


OP9_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw_host, regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u
), h AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM p
), r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
  END AS rule FROM h
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""
