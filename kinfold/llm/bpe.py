"""Byte-level BPE encoding and decoding in two tiers.

Tier one: a minimal perfect hash over the vocabulary resolves pre-tokens that are tokens
themselves. Tier two, for the misses: the merges run over a linked list of the bytes,
the next one taken from a heap ordered by rank and place. The rank file is read on the
driver and broadcast; its size is fixed by the vocabulary and checked.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable
from heapq import heapify, heappop, heappush
from itertools import accumulate, chain, pairwise

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest as xxh

from kinfold.llm.common import slices, table

#: Vocabularies above this many tokens are refused: what is broadcast stays small.
MAX_VOCABULARY = 1_000_000
#: Remembered pieces of a worker, in two halves; only speed and memory depend on it.
MEMO = 300_000


_MASK = (1 << 64) - 1


def _slot(h: int, d: int, n: int) -> int:
    # every displacement scatters anew; a mere step of d could miss the free slots for ever
    return (((h ^ d * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & _MASK) >> 32) % n


class PerfectHash:
    """Minimal perfect hash by displacement: n keys in n slots, one number per bucket.

    A bucket holds some two keys; its displacement sends all of them to free slots. The
    many buckets of one key name their slot directly, as ``-slot - 1``, and are filled last.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = max(1, len(keys))
        m = self.m = n // 2 + 1
        buckets: list[list[int]] = [[] for _ in range(m)]
        hashes = [xxh(k) for k in keys]
        for i, h in enumerate(hashes):
            buckets[h % m].append(i)
        self.shift, self.keys, self.values = [0] * m, [None] * n, [0] * n
        free = bytearray(b"\1") * n
        single = []
        for b in sorted(range(m), key=lambda b: -len(buckets[b])):
            mine = buckets[b]
            if len(mine) < 2:
                single += [b] if mine else []
                continue
            d = 0
            while True:
                slots = [_slot(hashes[i], d, n) for i in mine]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
                d += 1
            self.shift[b] = d
            for i, s in zip(mine, slots, strict=True):
                free[s], self.keys[s], self.values[s] = 0, keys[i], i
        rest = (s for s in range(n) if free[s])
        for b in single:
            (i,) = buckets[b]
            s = next(rest)
            self.shift[b], self.keys[s], self.values[s] = -s - 1, keys[i], i

    def find(self, key: bytes) -> int:
        """The key's place in the list it was built from, or -1."""
        h = xxh(key)
        d = self.shift[h % self.m]
        s = -d - 1 if d < 0 else _slot(h, d, self.n)
        return self.values[s] if self.keys[s] == key else -1


#: Where a text may be cut before it is split: at one blank between other characters.
#: There a pre-token always ends, so each piece can be split, and remembered, by itself.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_TWO_BLANKS = re.compile(r"\s\s").search


class Codec:
    """Encoder and decoder over one rank file's tokens."""

    def __init__(self, tokens: list[bytes], ids: list[int], pattern: str, perfect: PerfectHash):
        self.ids, self.perfect = ids, perfect
        self.bytes_of = dict(zip(ids, tokens, strict=True))
        self.decimal = {i: str(i) for i in ids}
        self.split = regex.compile(pattern).findall
        rank = dict(zip(tokens, ids, strict=True))
        self.byte_id = [rank[bytes([b])] for b in range(256)]
        #: by a token's id: the look-up of the rank of what it forms with the token that follows
        follow: dict[int, dict[int, int]] = {}
        for t, i in rank.items():
            for k in range(1, len(t)):
                if t[:k] in rank and t[k:] in rank:
                    follow.setdefault(rank[t[:k]], {})[rank[t[k:]]] = i
        none: dict[int, int] = {}
        self.pairs = [follow.get(i, none).get for i in range(max(ids) + 1)]
        self.memo = _Memo(self)

    def piece(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token."""
        at = self.perfect.find(piece)
        return (self.ids[at],) if at >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Merges the lowest rank first, the leftmost of equal ones, over a linked list.

        A heap entry is the rank, then the place in as many bits as the piece needs; it is
        stale, and skipped, unless the pair that now starts at the place still has that rank.
        """
        pairs, n = self.pairs, len(piece)
        bits = n.bit_length()
        places = (1 << bits) - 1
        part = [self.byte_id[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        found = [pairs[a](b) for a, b in pairwise(part)]
        heap = [r << bits | i for i, r in enumerate(found) if r is not None]
        heapify(heap)
        part.append(-1)  # nothing follows the last one
        while heap:
            top = heappop(heap)
            i = top & places
            a, j = part[i], after[i]
            if a < 0 or pairs[a](part[j]) != (r := top >> bits):
                continue
            part[i], part[j] = r, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := pairs[r](part[k])) is not None:
                    heappush(heap, x << bits | i)
            p = before[i]
            if p >= 0 and (x := pairs[part[p]](r)) is not None:
                heappush(heap, x << bits | p)
        return tuple([x for x in part if x >= 0])

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a piece of text that stands between two cuts."""
        out: tuple[int, ...] = ()
        for t in self.split(text):
            out += self.piece(t.encode("utf-8", "surrogatepass"))
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; null is empty."""
        if not text:
            return []
        if text[0] == " " or text[-1] == " " or _TWO_BLANKS(text):
            first, *rest = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
        ids = list(self.chunk(first))
        ids.extend(chain.from_iterable(map(self.memo.__getitem__, rest)))
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes that the ids stand for; an id outside the vocabulary is an error."""
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Memo(dict):
    """Ids of pieces that follow a blank.

    A full half becomes the older one, and the pieces used again move over from it; so
    frequent words stay, and even one endless text leaves no more than ``MEMO`` entries.
    """

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.older = codec, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        codec = self.codec
        if len(self) >= MEMO // 2:
            self.older = dict(self)
            self.clear()
        if (got := self.older.get(piece)) is not None:
            pass
        elif piece.isalpha():
            got = codec.piece((" " + piece).encode())
        else:
            first, *rest = codec.split(" " + piece)
            word = first[1:]
            # a word with marks after it shares the word's own entry
            got = self[word] if rest and word.isalpha() else codec.piece(first.encode("utf-8", "surrogatepass"))
            for t in rest:
                got += codec.piece(t.encode("utf-8", "surrogatepass"))
        self[piece] = got
        return got


_codecs: dict = {}


class Vocabulary:
    """A rank file's content, to be sent to executors; each builds its codec once per process."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        if len(rows) > MAX_VOCABULARY:
            raise ValueError(f"{len(rows)} tokens; at most {MAX_VOCABULARY} are broadcast")
        self.tokens = [base64.b64decode(t) for t, _ in rows]
        self.ids, self.pattern = [int(i) for _, i in rows], pattern
        self.perfect = PerfectHash(self.tokens)
        self.key = hashlib.sha256(repr((self.tokens, self.ids, pattern)).encode()).hexdigest()

    def codec(self) -> Codec:
        if self.key not in _codecs:
            _codecs.clear()
            _codecs[self.key] = Codec(self.tokens, self.ids, self.pattern, self.perfect)
        return _codecs[self.key]


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) per row; no shuffle. Awkward rows as in ``digests``."""
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        codec = sent.value.codec()
        for whole in batches:
            for b in slices(whole, 1):
                ids = [codec.encode(t) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes binary) per row; a null list is empty."""
    import pyarrow as pa

    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        codec = sent.value.codec()
        for b in batches:
            out = [codec.decode(ids or ()) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, bytes binary")


def digests(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
            with_ids: bool = False) -> DataFrame:
    """Encodes and decodes each text and returns counts and digests of both directions.

    doc_id, n_tokens, ids_sha256 (decimal ids, comma-joined), decoded_sha256, and the ids
    themselves if asked for. Null and empty texts have no tokens; repeated rows give
    repeated rows; an empty table gives none; other columns are not read. A text of any
    length is encoded as a whole within one task, a pre-token of any length in time that
    grows a little faster than its length.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches):
        codec, sha = sent.value.codec(), hashlib.sha256
        for whole in batches:
            for b in slices(whole, 1):
                n, coded, back, listed = [], [], [], []
                for t in b.column(1).to_pylist():
                    ids = codec.encode(t)
                    n.append(len(ids))
                    if with_ids:
                        listed.append(pa.array(ids, pa.int32()))
                    coded.append(sha(",".join(map(codec.decimal.__getitem__, ids)).encode()).hexdigest())
                    back.append(sha(codec.decode(ids)).hexdigest())
                cols = [b.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())]
                if with_ids:
                    ends = pa.array([0, *accumulate(n)], pa.int32())
                    cols.append(pa.ListArray.from_arrays(ends, pa.concat_arrays([*listed, pa.array([], pa.int32())])))
                yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` encoded and decoded."""
    return digests(table(spark, sf_dir, "documents"), default_vocabulary())
