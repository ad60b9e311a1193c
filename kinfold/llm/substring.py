"""Substring dedup: suffix automata and matching statistics over routed reference shards.

A window of 50 words goes when an earlier document has it too. Broadcasting automata of
all reference shards to all documents makes work grow with the square of the input (figures
in the README), so shards are routed instead: windows are grouped by their minimizer (the
least hash of their 12-word runs), which equal windows share wherever they stand. A run of
windows with one minimizer is a chunk. Chunks with equal text (128 bits of BLAKE2 over the
words) need no more than their least document; chunks of one minimizer with different texts
meet in one shard, whose automaton takes the chunks of earlier documents and gives the
matching statistics of later ones. Shards are bounded: a minimizer with more different
texts than a shard takes has its windows dealt again by their least 31-word run, then, if
need be, by the whole window.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import discard, join_dealt, materialize, slices, table, text_key

SIZE = 50
#: Words of the runs by which windows are dealt, the first time and again while a minimizer is crowded.
GRAMS = (12, 31, SIZE)
#: Different chunks of a minimizer that one automaton takes; beyond it they are dealt again.
SHARD = 120
#: What tells rows apart: the id and 128 bits of the text.
KEY = ["doc", "t1", "t2"]
_SLICE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 31) - 1)


def _inverse(x: np.uint64) -> np.uint64:
    return np.uint64(pow(int(x), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_tables: dict = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 ... base**n modulo 2**64."""
    have = _tables.get(int(base))
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 2 * _SLICE:  # what one endless text needs is not kept
            _tables[int(base)] = have
    return have


class Rolling:
    """Hashes of any run of a sequence, equal for equal runs wherever they stand."""

    def __init__(self, values: np.ndarray, base: np.uint64):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * _powers(base, n)[:n], dtype=np.uint64, out=self.sums[1:])
        self.back = _powers(_inverse(base), n)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        run = (self.sums[end] - self.sums[start]) * self.back[start]
        return _mix(run + (end - start).astype(np.uint64) * _B)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte of each word of the texts, the byte after it, and each text's first word's place."""
    n = len(data)
    solid = np.zeros(n + 1, bool)
    solid[:n] = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:]
    at = np.flatnonzero(start)
    stop = solid.copy()
    stop[:-1] &= ~solid[1:] | cut[1:]
    return at, np.flatnonzero(stop) + 1, np.searchsorted(at, offsets)


def run_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of bytes in ascending order, some bytes at a time: memory does not grow with the text."""
    out, i = np.empty(len(begin), np.uint64), 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + _SLICE // 2, "right")))
        values = data[begin[i] : end[j - 1]].astype(np.uint64) + np.uint64(1)
        out[i:j] = Rolling(values, _B).of(begin[i:j] - begin[i], end[i:j] - begin[i])
        i = j
    return out


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number) of each word of the texts, and each text's first word's place."""
    at, end, first = word_bounds(data, offsets)
    return run_hashes(data, at, end), np.repeat(np.arange(len(offsets) - 1), np.diff(first)), first


def chunks_in(texts: list[bytes], gram: int) -> tuple[dict[str, np.ndarray], list[bytes]]:
    """Per chunk: text number, first window's place in its text, number of windows, minimizer; and its words.

    Words of the texts are parted by single blanks. Only the minimizer comes from a hash of
    the words: where it collides, texts with nothing in common meet, which does no harm.
    """
    whole = b"".join(texts)
    data = np.frombuffer(whole, np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    begin, end, first = word_bounds(data, offsets)
    n, span = len(begin), SIZE - gram + 1
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    starts = np.flatnonzero(text[: n - SIZE + 1] == text[SIZE - 1 :]) if n >= SIZE else np.zeros(0, np.int64)
    if not len(starts):
        return {k: np.zeros(0, np.int64) for k in ("text", "at", "n", "h")}, []
    words = run_hashes(data, begin, end)
    grams = np.arange(n - gram + 1)
    hashes = Rolling(words, _C).of(grams, grams + gram)
    low = (hashes & ~_PLACE) | grams.astype(np.uint64)
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    least = (low[starts] & _PLACE).astype(np.int64)
    edge = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (text[starts[1:]] != text[starts[:-1]]))))
    s0, s1 = starts[edge], starts[np.append(edge[1:], len(starts)) - 1]
    found = {"text": text[s0], "at": s0 - first[text[s0]], "n": s1 - s0 + 1, "h": hashes[least[edge]].view(np.int64)}
    return found, [whole[a:b] for a, b in zip(begin[s0].tolist(), end[s1 + SIZE - 1].tolist(), strict=True)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, t1, t2 and text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc"), *text_key(text), text.alias("text"))


def _same_row(a: DataFrame, b: DataFrame):
    return a["doc"].eqNullSafe(b["doc"]) & (a["t1"] == b["t1"]) & (a["t2"] == b["t2"])


def chunk_table(rows: DataFrame, gram: int, words: bool = False) -> DataFrame:
    """(doc, t1, t2, at, n, h, c1, c2) of every chunk of every text, and the chunk's words if asked for.

    ``rows``: doc, t1, t2, text and, where the text is itself a chunk, its place ``at``.
    """
    import pyarrow as pa

    placed = "at" in rows.columns

    def run(batches):
        for b in batches:
            texts = b.column(3).cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            i = 0
            while i < b.num_rows:
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + _SLICE, "right")) - 1)
                j = min(j, b.num_rows)
                got, chunks = chunks_in([b" ".join(t.as_py().split()) for t in texts[i:j]], gram)
                of, at = pa.array(got["text"] + i), got["at"]
                if placed:
                    at = at + b.column(4).to_numpy()[got["text"] + i]
                digests = b"".join([hashlib.blake2b(c, digest_size=16).digest() for c in chunks])
                c = np.frombuffer(digests, np.int64).reshape(-1, 2)
                cols = [*(b.column(k).take(of) for k in range(3)), pa.array(at.astype(np.int32)), pa.array(got["n"].astype(np.int32)), pa.array(got["h"])]
                cols += [pa.array(np.ascontiguousarray(c[:, k])) for k in (0, 1)] + [pa.array(chunks, pa.binary())] * words
                yield pa.RecordBatch.from_arrays(cols, names)
                i = j

    names = [*KEY, "at", "n", "h", "c1", "c2"] + ["words"] * words
    kind = rows.schema["doc"].dataType.simpleString()
    out = f"doc {kind}, t1 long, t2 long, at int, n int, h long, c1 long, c2 long" + ", words binary" * words
    return rows.select(*KEY, "text", *["at"] * placed).mapInArrow(run, out)


class Automaton:
    """Suffix automaton of several word sequences, built online."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _clone(self, p: int, q: int, w) -> int:
        c = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = c
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = c
            p = self.link[p]
        return c

    def _extend(self, p: int, w) -> int:
        q = self.next[p].get(w)
        if q is not None:  # the run is known already: its state, or a split of it
            return q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        new = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[p] + 1)
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return new

    def statistics(self, words: list) -> list[int]:
        """Per place the length of the longest run that ends there and is in the automaton."""
        out, v, n, nxt, link, length = [], 0, 0, self.next, self.link, self.length
        for w in words:
            t = nxt[v].get(w)
            while t is None and v:
                v = link[v]
                n = length[v]
                t = nxt[v].get(w)
            if t is not None:
                v, n = t, n + 1
            out.append(n)
        return out


def _matched(shard: list[tuple], size: int = SIZE) -> list[tuple]:
    """(doc, t1, t2, start, end) of the windows of a shard's chunks that chunks of earlier documents have.

    Rows are (doc, t1, t2, at, words) in the order of their documents.
    """
    known, out, waiting, now = Automaton(), [], [], object()
    for doc, t1, t2, at, text in shard:
        words = text.split(b" ")
        if doc != now:
            for w in waiting:
                known.add(w)
            waiting, now = [], doc
        ends = [k + 1 for k, n in enumerate(known.statistics(words)) if n >= size]
        if len(ends) < len(words) - size + 1:
            waiting.append(words)
        start = None
        for e in ends:
            if start is None:
                start, end = e - size, e
            elif e == end + 1:
                end = e
            else:
                out.append((doc, t1, t2, at + start, at + end))
                start, end = e - size, e
        if start is not None:
            out.append((doc, t1, t2, at + start, at + end))
    return out


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, t1, t2, at, h, crowded, words) of the wanted chunks: each text is cut where it stands."""
    import pyarrow as pa

    parts = wanted.groupBy(*KEY).agg(F.collect_set(F.struct("at", "n", "h", "crowded")).alias("parts"))
    names = [*KEY, "at", "h", "crowded", "words"]

    def run(batches):
        for b in (piece for whole in batches for piece in slices(whole, 3)):
            of, got = [], []
            for i, (text, parts) in enumerate(zip(b.column(3), b.column(4), strict=True)):
                words = text.as_py().encode("utf-8", "surrogatepass").split()
                for p in parts.as_py():
                    of.append(i)
                    got.append((p["at"], p["h"], p["crowded"], b" ".join(words[p["at"] : p["at"] + p["n"] + SIZE - 1])))
            cols = list(zip(*got, strict=True)) or [()] * 4
            kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
            own = [b.column(k).take(pa.array(of, pa.int64())) for k in range(3)]
            yield pa.RecordBatch.from_arrays(own + [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    kind = rows.schema["doc"].dataType.simpleString()
    joined = rows.join(parts, _same_row(rows, parts)).select(*[rows[k] for k in KEY], rows["text"], parts["parts"])
    return joined.mapInArrow(run, f"doc {kind}, t1 long, t2 long, at int, h long, crowded boolean, words binary")


def _by_automata(texts: DataFrame) -> DataFrame:
    """(doc, t1, t2, start, end) from shards, each of one minimizer and at most ``SHARD`` different texts."""
    import pyarrow as pa

    dealt = texts.select("h", *KEY, "at", "words").repartition("h").sortWithinPartitions("h", F.col("doc").asc_nulls_last(), "t1", "t2", "at")
    names = [*KEY, "start", "end"]

    def run(batches):
        shard, key, kind = [], None, None

        def flush():
            cols = list(zip(*_matched(shard), strict=True)) or [()] * 5
            kinds = [kind, pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for b in batches:
            kind = b.column(1).type
            for h, *row in zip(*[b.column(k).to_pylist() for k in range(6)], strict=True):
                if h != key and shard:
                    yield flush()
                    shard = []
                key = h
                if not shard or shard[-1] != row:  # rows that repeat as a whole
                    shard.append(row)
        if shard:
            yield flush()

    return dealt.mapInArrow(run, f"doc {texts.schema['doc'].dataType.simpleString()}, t1 long, t2 long, start int, end int")


def _settled(found: DataFrame, shard: int) -> tuple[DataFrame, DataFrame]:
    """Spans of the chunks that an earlier document has as a whole; and the chunks that automata have to compare.

    The latter come with ``crowded``: whether their minimizer has more texts than a shard
    takes. A text, or a minimizer, that very many rows share makes no task large: rows are
    summed up before the shuffle, and joined by ``join_dealt``.
    """
    same = found.groupBy("h", "c1", "c2").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("copies"))
    same = materialize(same, "contents")
    many = same.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    # chunks that occur again, or whose minimizer has other texts; all others are settled
    seen = join_dealt(same, many, ["h"], "texts")
    alone = same.where("copies > 1").join(many.select("h"), "h", "left_anti").withColumn("texts", F.lit(1).cast("long"))
    seen = materialize(seen.unionByName(alone), "seen")
    flagged = materialize(join_dealt(found, seen, ["h", "c1", "c2"], "copies"), "flagged")
    discard(found, same, seen)
    later = F.col("least").isNotNull() & (F.col("doc").isNull() | (F.col("least") < F.col("doc")))
    whole = flagged.where(later).select(*KEY, F.col("at").alias("start"), (F.col("at") + F.col("n") + SIZE - 1).alias("end"))
    rest = flagged.where(~later & (F.col("texts") > 1))
    # the flag travels with each chunk: no join on minimizers, of which one may have very many chunks
    return whole, rest.withColumn("crowded", F.col("texts") > shard).drop("c1", "c2", "least", "copies", "texts")


def spans(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """(doc, t1, t2, start, end): word spans to remove, each made of windows of an earlier document."""
    out, texts = [], None
    for gram in GRAMS:
        again = texts is not None
        source = texts.select(*KEY, "at", F.col("words").cast("string").alias("text")) if again else rows
        whole, rest = _settled(materialize(chunk_table(source, gram, words=again), "chunks"), shard)
        out.append(whole)
        if gram == SIZE:
            break  # a chunk is one window here: those with different texts have nothing in common
        texts = rest if again else materialize(_texts(rows, rest), "texts")
        out.append(_by_automata(texts.where("not crowded")))
        texts = texts.where("crowded")
        if texts.isEmpty():
            break
    return reduce(DataFrame.unionByName, out)


def _kept(text: str, gone) -> tuple[int, list[bytes]]:
    """How many words a text has, and those outside the spans."""
    words = text.encode("utf-8", "surrogatepass").split()
    out, at = [], 0
    for start, end in sorted((g["start"], g["end"]) for g in gone or ()):
        if start > at:
            out += words[at:start]
        at = max(at, end)
    return len(words), out + words[at:]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the other words joined by one blank) per row.

    Ids may be of any type that sorts. Null and empty texts have no words. Among rows with
    one id nothing is removed for the others' sake; a null id comes after all others.
    Repeated rows are treated alike; an empty table gives no rows. Texts of any length are
    hashed as a whole, within one task. No other column is read.
    """
    import pyarrow as pa

    rows = _keyed(docs, id_col, text_col)
    gone = _gone(rows, shard)

    def run(batches):
        for b in (piece for whole in batches for piece in slices(whole, 1)):
            n, removed, kept = [], [], []
            for text, gone in zip(b.column(1), b.column(2), strict=True):
                total, out = _kept(text.as_py(), gone.as_py())
                n.append(total)
                removed.append(total - len(out))
                kept.append(b" ".join(out))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    joined = rows.join(gone, _same_row(rows, gone), "left").select(rows["doc"], rows["text"], gone["gone"])
    return joined.mapInArrow(run, f"doc_id {rows.schema['doc'].dataType.simpleString()}, n_words long, n_removed long, kept string")


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", shard: int = SHARD) -> DataFrame:
    """``docs`` with repeated windows cut out of the text, and the count of its characters renewed.

    Texts that lose nothing stay as they are; all other columns do, too. Nulls, repeats,
    long texts and empty tables as in ``remove_repeats``.
    """
    import pyarrow as pa

    gone = _gone(_keyed(docs, id_col, text_col), shard)
    names, at = docs.columns, docs.columns.index(text_col)
    chars = names.index(chars_col) if chars_col in names else None
    key = [docs[id_col].alias("doc"), *text_key(docs[text_col])]
    flat = docs.select(*key, *[docs[c].alias(f"c{k}") for k, c in enumerate(names)])
    joined = flat.join(gone, _same_row(flat, gone), "left").select(gone["gone"], *[flat[f"c{k}"] for k in range(len(names))])

    def run(batches):
        for b in (piece for whole in batches for piece in slices(whole, at + 1)):
            cols = list(b.columns[1:])
            texts, gone = cols[at].to_pylist(), b.column(0).to_pylist()
            texts = [b" ".join(_kept(t, g)[1]).decode("utf-8", "surrogatepass") if g else t for t, g in zip(texts, gone, strict=True)]
            cols[at] = pa.array(texts, cols[at].type)
            if chars is not None:
                n = zip(cols[chars].to_pylist(), texts, gone, strict=True)
                cols[chars] = pa.array([len(t) if g else k for k, t, g in n], cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(run, docs.schema)


def _gone(rows: DataFrame, shard: int) -> DataFrame:
    return spans(rows, shard).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("gone"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the 50-word windows of earlier ones."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS x FROM w, unnest(generate_series(1, len(w) - 49)) AS s(i)),
f AS (SELECT x, min(doc_id) AS d FROM g GROUP BY x),
hit AS (SELECT DISTINCT doc_id, p FROM g JOIN f USING (x), unnest(generate_series(i, i + 49)) AS u(p) WHERE d < doc_id),
pos AS (SELECT doc_id, p, w[p] AS word FROM w, unnest(generate_series(1, len(w))) AS s(p)),
k AS (
  SELECT pos.doc_id, string_agg(word, ' ' ORDER BY pos.p) AS kept, count(*) AS n
  FROM pos ANTI JOIN hit ON pos.doc_id = hit.doc_id AND pos.p = hit.p GROUP BY pos.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
