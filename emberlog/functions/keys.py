"""Keys by which events are dealt out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .events import loads


def _bucket(value: Column, buckets: int) -> Column:
    """md5 as a number modulo buckets, folded over four words of 32 bits so that a long holds every step."""
    digest, rest = F.md5(value.cast("binary")), F.lit(0).cast("long")
    shift = pow(2, 32, buckets)
    for i in range(4):
        word = F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long")
        rest = F.pmod(rest * shift + word, F.lit(buckets).cast("long"))
    return rest


def hash_key(value: Column, buckets: int | None) -> Column:
    return F.concat(F.lit("hash-"), _bucket(value, buckets).cast("string")) if buckets else F.md5(value.cast("binary"))


def round_robin_key(value: Column, buckets: int | None = None) -> Column:
    return F.concat(F.lit("bucket-"), _bucket(value, buckets or 100).cast("string"))


def computer_key(value: Column) -> Column:
    """The first of Computer, host, hostname, winlog.computer_name that says something, lower-cased; else hash-0.

    An object in host counts as its Python text; events without any such field share one key.
    """

    def key(text):
        try:
            event = loads(text)
            found = event.get("Computer") or event.get("host") or event.get("hostname") or event.get("winlog", {}).get("computer_name")
            return str(found).lower() if found else "hash-0"
        except Exception:  # noqa: BLE001  whatever is wrong with an event, it gets a key
            return "hash-0"

    return F.udf(key, "string", useArrow=True)(value)


def key_for(strategy: str, value: Column, buckets: int | None) -> Column:
    if strategy == "computer":
        return computer_key(value)
    return round_robin_key(value, buckets) if strategy == "round_robin" else hash_key(value, buckets)


def bucket_count(parallelism: int, key_groups: int, autoscaler: bool = False, most: int = 24) -> int:
    return (most if autoscaler else parallelism) * key_groups
