"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming UTF-8 decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: States of the determinised machine, dropped and made anew beyond that; pre-tokens whose output is remembered, of which
#: those not met again while as many others came are dropped. Together these take some 500 MB in a Python worker at most.
MOST_STATES = 300_000
MOST_PIECES = 700_000
#: Pairs of tokens known to be neighbours or not: as many for each state as this, at most.
PAIRS = 2
#: Rows that are written together.
ROWS = 200
#: Characters from which on a text goes through in blocks, of a quarter as many pre-tokens.
LONG = 1 << 16


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Transducer:
    """Encodes one pre-token by the merges of `ranks`.

    A token sequence is what the merges give just if each token alone and each pair of neighbours
    does; so the merges compile into a machine that reads bytes, guesses token ends, and checks
    each new token against the one before it. A configuration is (last token, place in the trie of
    tokens, tokens not yet written). A state of the determinised machine is the set of
    configurations alive after a prefix, made when first reached. What all of them agree on is
    written; as no token is longer than the longest in the vocabulary, this waits a bounded number
    of bytes. At the end of a pre-token just one configuration stands at a token's end.
    """

    def __init__(self, ranks: dict[bytes, int], most: int | None = None):
        self.ranks, self.most = ranks, most or MOST_STATES
        self.token = {i: t for t, i in ranks.items()}
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for t, i in ranks.items():
            node = 0
            for byte in t:
                key = node << 8 | byte
                if (to := self.child.get(key)) is None:
                    to = self.child[key] = len(self.ends)
                    self.ends.append(-1)
                node = to
            self.ends[node] = i
        self.inner = {key >> 8 for key in self.child}
        self.pairs: dict[int, bool] = {}
        self._restart()

    def _restart(self) -> None:
        # a state is (place << 20 | last + 1, waiting tokens) for each configuration, flat and sorted
        start = (0, ())
        self.states = {start: 0}
        self.configs = [start]
        self.moves: dict[int, int] = {}  # state << 8 | byte: to << 1 | whether something is written
        self.written: dict[int, tuple[int, ...]] = {}

    def merged(self, raw: bytes) -> list[bytes]:
        """The merges themselves, lowest rank first: what a pair of tokens is checked against."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, last: int, token: int) -> bool:
        key = (last + 1) << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > PAIRS * self.most:
                self.pairs.clear()
            second = self.token[token]
            expected = [second] if last < 0 else [self.token[last], second]
            known = self.pairs[key] = self.merged(b"".join(expected)) == expected
        return known

    def _move(self, key: int) -> int:
        child, inner, ends, after = self.child, self.inner, self.ends, []
        config = self.configs[key >> 8]
        for place, waiting in zip(config[::2], config[1::2]):
            to = child.get((place >> 20) << 8 | key & 255)
            if to is None:
                continue
            if to in inner:
                after.append((to << 20 | place & 0xFFFFF, waiting))
            token = ends[to]
            if token >= 0 and self.may_follow((place & 0xFFFFF) - 1, token):
                after.append((token + 1, (*waiting, token)))
        if not after:
            raise ValueError("the vocabulary cannot encode these bytes")
        first, shared = after[0][1], 0
        if first and all(c[1] for c in after):
            least = min(len(c[1]) for c in after)
            while shared < least and all(c[1][shared] == first[shared] for c in after):
                shared += 1
        after.sort()
        new = tuple(x for place, waiting in after for x in (place, waiting[shared:]))
        to = self.states.get(new)
        if to is None:
            to = self.states[new] = len(self.configs)
            self.configs.append(new)
        move = self.moves[key] = to << 1 | (shared > 0)
        if shared:
            self.written[key] = first[:shared]
        return move

    def encode(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(self.configs) > self.most:
            self._restart()
        state, out, moves = 0, [], self.moves
        for byte in piece:
            key = state << 8 | byte
            move = moves.get(key)
            if move is None:
                move = self._move(key)
            if move & 1:
                out += self.written[key]
            state = move >> 1
        config = self.configs[state]
        for place, waiting in zip(config[::2], config[1::2]):
            if not place >> 20:
                return out + list(waiting)
        raise ValueError("the vocabulary cannot encode these bytes")


class _Pieces(dict):
    """Pre-token to its ids, as decimal text joined by spaces."""

    def __init__(self, machine: Transducer, most: int | None = None):
        super().__init__()
        self.machine, self.most = machine, most or MOST_PIECES
        self.before: dict[str, str] = {}

    def __missing__(self, piece: str) -> str:
        ids = self.before.get(piece)
        if ids is None:
            ids = " ".join(map(str, self.machine.encode(piece.encode())))
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()
        if len(piece) < 64:
            self[piece] = ids
        return ids


class Encoder:
    def __init__(self, path: str, pattern: str, states: int | None = None, pieces: int | None = None):
        import regex

        ranks = load_ranks(path)
        self.find = regex.compile(pattern)
        self.pieces = _Pieces(Transducer(ranks, states), pieces)
        self.bytes_of = {str(i): t for t, i in ranks.items()}

    def encode(self, text: str) -> Iterator[str]:
        """Blocks of decimal ids joined by spaces; a block never ends inside a pre-token."""
        if len(text) < LONG:
            if found := self.find.findall(text):
                yield " ".join(map(self.pieces.__getitem__, found))
            return
        matches = (m.group() for m in self.find.finditer(text))
        while block := list(islice(matches, LONG >> 2)):
            yield " ".join(map(self.pieces.__getitem__, block))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(" ")))


class Utf8Stream:
    """Decodes UTF-8 that arrives in arbitrary cuts.

    The state is the bytes of a character begun but not ended. For each block a small state machine
    runs over the last three bytes to find where such a character starts; all before it is decoded
    at once. Malformed bytes become U+FFFD.
    """

    def __init__(self):
        self.begun = b""

    def feed(self, block: bytes) -> str:
        raw = self.begun + block
        cut = len(raw)
        for back in range(1, min(3, len(raw)) + 1):
            byte = raw[-back]
            if byte & 0xC0 == 0x80:  # a continuation: its lead byte stands before it
                continue
            needs = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            if needs > back:
                cut -= back
            break
        self.begun = raw[cut:]
        return raw[:cut].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", "replace")


def encode_row(machine: Encoder, raw: bytes | None, ids: bool = False, text: bool = False) -> tuple[int, str, str, np.ndarray, str]:
    """Number of tokens, digest of the ids and of what the UTF-8 stream gives for them, and on request the ids and that text."""
    count, id_hash, text_hash, all_ids, all_text, stream = 0, hashlib.sha256(), hashlib.sha256(), [], [], Utf8Stream()
    for block in machine.encode(raw.decode("utf-8", "replace")) if raw else ():
        id_hash.update((" " + block if count else block).encode())
        count += block.count(" ") + 1
        decoded = stream.feed(machine.decode(block))
        text_hash.update(decoded.encode())
        if ids:
            all_ids.append(np.fromstring(block, np.int32, sep=" "))
        if text:
            all_text.append(decoded)
    rest = stream.close()
    text_hash.update(rest.encode())
    return count, id_hash.hexdigest(), text_hash.hexdigest(), np.concatenate([np.zeros(0, np.int32), *all_ids]), "".join([*all_text, rest]) if text else ""


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(*what) -> Encoder:
    """One for each Python worker; the vocabulary file has to be at that path on every machine."""
    if what not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[what] = Encoder(*what)
    return _ENCODERS[what]


def encode_documents(docs: DataFrame, path: str, pattern: str, ids: bool = False, text: bool = False, states: int = MOST_STATES, pieces: int = MOST_PIECES, keep: bool = True) -> DataFrame:
    """For every row of docs(doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256; on request
    also ids (array of int) and decoded (the text decoded from them).

    One row out for each row in, in one pass without a shuffle. A null text counts as empty: no
    tokens, digests of nothing. A null or repeated doc_id is kept. Bytes that are not UTF-8 are
    read as U+FFFD. Long texts go through in blocks. Other columns are ignored. states and pieces bound
    what a Python worker remembers, from task to task with keep; they trade memory for time and don't change results.
    """
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids + ", decoded string" * text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(path, pattern, states, pieces)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                rows: list[list] = [[], [], [], [], []]
                for raw in common.binary(part.column(1)):
                    for column, value in zip(rows, encode_row(machine, raw, ids, text)):
                        column.append(value)
                arrays = [part.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
                if ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows[3])]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *rows[3]]))))
                arrays += [pa.array(rows[4], pa.string())] * text
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids, *["decoded"] * text])
        if not keep:
            del machine
            _ENCODERS.clear()

    return common.mapped(source, run, schema)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(common.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
