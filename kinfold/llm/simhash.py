"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are 64 majority bits over hashed shingles. Two within the radius agree on at
least ``blocks - radius`` of the blocks that the bits are cut into, so rows are dealt by
each such choice of blocks and compared only under an equal key. There, bit planes are
stored vertically: one word of a plane holds the same bit of 64 fingerprints, and a
carry-save counter of a few words adds up 64 distances at a time. Words whose lanes all
exceed the radius are abandoned early. A key's links are reduced to a spanning forest
where they are found, then joined to components by star contractions.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import discard, join_dealt, materialize, table, text_key
from kinfold.llm.graph import components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Fingerprints under one key that one task compares; more are dealt to tasks by pairs of parts.
PART = 20_000
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_TO_LOWER = bytes.maketrans(_UPPER, _LOWER)


def fingerprint(text: str | None) -> int:
    """64 bits, each set if it is in over half of the shingles' hashes; no word: 0."""
    from xxhash import xxh64_intdigest as h

    if not text:
        return 0
    # bytes.split() cuts at exactly the six ASCII white-space characters
    words = text.encode("utf-8", "surrogatepass").translate(_TO_LOWER).split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return h(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - SHINGLE + 1
    pairs = zip(starts[:n].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
    hashes = np.fromiter([h(line[a:b], SEED) for a, b in pairs], np.uint64, n)
    return _majority(hashes)


def _majority(hashes: np.ndarray) -> int:
    n, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        raw = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        # sums of rows of bits, eight lanes of a word at a time
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    bits = np.flatnonzero(2 * ones > n)
    return int(sum(1 << int(b) for b in bits))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, t1, t2) per row; fp holds the 64 bits as a signed long. Null and empty: 0."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t.as_py()) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), b.column(2), b.column(3)], ["doc_id", "fp", "t1", "t2"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *text_key(F.col(text_col)))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long, t1 long, t2 long")


def plan_blocks(n: int, radius: int = RADIUS) -> tuple[int, int]:
    """(blocks, kept) for n fingerprints: keys are made long enough to keep them small.

    Any choice is lossless; ``radius`` changed bits leave ``blocks - radius`` untouched.
    """
    for blocks in range(radius + 1, 2 * radius + 1):
        kept = blocks - radius
        if n >> (64 * kept // blocks) < 64:
            break
    return blocks, kept


def near(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (places a, b) of the links between fingerprints of equal group.

    ``group`` must be sorted. Row r is compared with the 64 lanes of each word from the
    first of its group to its own; all rows at once, bit plane by bit plane.
    """
    n = len(fps)
    words = -(-n // 64)
    padded = np.zeros(words * 64, np.uint64)
    padded[:n] = fps
    planes = np.empty((64, words), np.uint64)
    lanes = padded.reshape(words, 64)
    for b in range(64):
        bits = ((lanes >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        planes[b] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    begins = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    first = np.repeat(begins, np.diff(np.append(begins, n)))
    root = np.arange(n)
    out_a, out_b = [], []
    row = np.arange(n)
    low, high = first // 64, row // 64
    active, offset = row[first < row], 0
    while len(active):
        for part in np.array_split(active, max(1, len(active) // 16384)):
            w = high[part] - offset
            hit = _within(planes, fps[part], w, radius)
            # lanes of the own group, before the own place
            lo = np.clip(first[part] - w * 64, 0, 63).astype(np.uint64)
            hit &= ~np.uint64(0) << lo
            if offset == 0:
                hit &= (np.uint64(1) << (part & 63).astype(np.uint64)) - np.uint64(1)
            got = np.flatnonzero(hit)
            if len(got):
                bits = np.unpackbits(hit[got].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                i, lane = np.nonzero(bits)
                a, b = part[got[i]], w[got[i]] * 64 + lane
                _join(root, a, b, out_a, out_b)
        offset += 1
        active = active[high[active] - offset >= low[active]]
    return np.array(out_a, np.int64), np.array(out_b, np.int64)


def _within(planes: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int) -> np.ndarray:
    """Per query and word a mask of the lanes within the radius.

    The counter is bit-sliced: ``c0`` holds the ones of all 64 distances, ``c1`` the twos
    and so on; ``over`` collects carries out of the top. After every 16 planes, queries
    whose 64 lanes all exceed the radius are dropped.
    """
    width = radius.bit_length()
    live = np.arange(len(query))
    counter = [np.zeros(len(query), np.uint64) for _ in range(width)]
    over = np.zeros(len(query), np.uint64)
    result = np.zeros(len(query), np.uint64)
    q, w = query, word
    for b in range(64):
        carry = planes[b][w] ^ (np.uint64(0) - ((q >> np.uint64(b)) & np.uint64(1)))
        for k in range(width):
            both = counter[k] & carry
            counter[k] = counter[k] ^ carry
            carry = both
        over |= carry
        if b % 16 == 15:
            # lanes above the radius for certain: more than it already
            out = over | _above(counter, radius)
            if b == 63:
                result[live] = ~out
            else:
                keep = np.flatnonzero(~out)
                if len(keep) < len(live):
                    live, q, w, over = live[keep], q[keep], w[keep], over[keep]
                    counter = [c[keep] for c in counter]
    return result


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter exceeds the radius, compared from the top bit down."""
    above, equal = np.zeros_like(counter[0]), ~np.zeros_like(counter[0])
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray, out_a: list, out_b: list) -> None:
    """Unites the ends of links; keeps only links that unite two trees. root is flat before and after."""
    while True:
        ra, rb = root[a], root[b]
        new = ra != rb
        if not new.any():
            return
        a, b, ra, rb = a[new], b[new], ra[new], rb[new]
        high, low = np.maximum(ra, rb), np.minimum(ra, rb)
        # one link per upper tree: it hangs that tree below another one
        _, pick = np.unique(high, return_index=True)
        root[high[pick]] = low[pick]
        out_a += a[pick].tolist()
        out_b += b[pick].tolist()
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _dealt(dealt: DataFrame, part: int) -> DataFrame:
    """(k, key, pair, fp): the rows under a key, those of a crowded key once for every pair of parts they belong to.

    A key with more than ``part`` rows is cut into parts by the fingerprint's hash, and each
    two parts meet in a group of their own, so no task holds a whole dense cluster.
    """
    crowd = dealt.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part)
    crowd = materialize(crowd.withColumn("parts", F.expr(f"cast(n div {part} + 1 as int)")), "crowded")
    if crowd.isEmpty():
        return dealt.withColumn("pair", F.lit(0).cast("long"))
    few = dealt.join(crowd.select("k", "key"), ["k", "key"], "left_anti").withColumn("pair", F.lit(0).cast("long"))
    many = join_dealt(dealt, crowd, ["k", "key"], "n").withColumn("own", F.pmod(F.xxhash64("fp", F.lit(5)), F.col("parts")))
    pair = lambda o: F.least(F.col("own"), o) * F.col("parts") + F.greatest(F.col("own"), o)
    many = many.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: pair(o.cast("long")))))
    return few.unionByName(many.select("k", "key", "fp", "pair"))


def links(prints: DataFrame, radius: int = RADIUS, blocks: tuple[int, int] | None = None, part: int = PART) -> DataFrame:
    """(u, v) of distinct fingerprints: a forest per key whose union has all components."""
    import pyarrow as pa

    distinct = materialize(prints.select("fp").distinct(), "fingerprints")
    count, kept = blocks or plan_blocks(distinct.count(), radius)
    cuts = [64 * k // count for k in range(count + 1)]
    keys = []
    for k, chosen in enumerate(combinations(range(count), kept)):
        mask = sum(((1 << (cuts[c + 1] - cuts[c])) - 1) << cuts[c] for c in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(signed).cast("long")).alias("key")))
    dealt = distinct.select("fp", F.explode(F.array(*keys)).alias("x")).select("x.k", "x.key", "fp")
    dealt = _dealt(dealt, part).select("k", "key", "pair", "fp")
    dealt = dealt.repartition("k", "key", "pair").sortWithinPartitions("k", "key", "pair", "fp")

    def run(batches):
        held: list[np.ndarray] = []

        def flush(rows: np.ndarray):
            change = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            group = np.concatenate(([0], np.cumsum(change)))
            a, b = near(rows[:, 3].view(np.uint64), group, radius)
            return pa.RecordBatch.from_arrays([pa.array(rows[a, 3]), pa.array(rows[b, 3])], ["u", "v"])

        for batch in batches:
            rows = np.column_stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)])
            if held and (rows[-1, :3] == held[0][-1, :3]).all():
                held.append(rows)  # still one key: nothing is copied until it ends
                continue
            rows = np.concatenate([*held, rows])
            # the last key may go on in the next batch
            ends = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
            cut = ends[-1] + 1 if len(ends) else 0
            held = [rows[cut:]]
            if cut:
                yield flush(np.ascontiguousarray(rows[:cut]))
        if held and len(held[0]):
            yield flush(np.ascontiguousarray(np.concatenate(held)))

    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text",
                    blocks: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, fingerprint (hex), component_id (the least doc_id reachable over links), root, t1, t2.

    Fingerprint links at ``radius`` or fewer differing bits. Texts without words share the
    fingerprint zero and are linked; repeated rows repeat; an empty table gives no rows. A
    null doc_id is a document of its own rows' component but never its least id, unless
    the component has no other. A very long text is hashed as a whole in one task; other
    columns are not read.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "prints")
    roots = components(links(prints, radius, blocks))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    least = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", "copies", F.coalesce("root", "fp").alias("root")
    )
    least = materialize(least, "classes")
    # one large component, or one fingerprint of very many rows, makes no task large
    names = materialize(least.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "names")
    named = join_dealt(least.drop("least"), names, ["root"], "n").select("fp", "component_id", "root", "copies")
    named = materialize(named, "named")
    discard(least, names)
    out = join_dealt(prints, named, ["fp"], "copies")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root", "t1", "t2")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: fingerprints and components."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("root", "t1", "t2")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, the one with the least id; all columns as they were.

    Ids that tie go by the text's hash, then by the other columns that can be ordered, in
    their order; so what stays depends on neither files nor tasks. A null id comes last.
    Awkward rows otherwise as in ``near_duplicates``.
    """
    found = materialize(near_duplicates(docs, id_col=id_col, text_col=text_col), "components")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "t1", "t2")
    best = found.groupBy("root").agg(F.min(order).alias("x")).select(F.col("x.doc_id").alias("_id"), F.col("x.t1").alias("_t1"), F.col("x.t2").alias("_t2"))
    best = materialize(best, "best")
    t1, t2 = text_key(docs[text_col])
    out = docs.join(best, docs[id_col].eqNullSafe(best["_id"]) & (t1 == best["_t1"]) & (t2 == best["_t2"]), "left_semi")
    ties = found.groupBy("doc_id", "t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not ties.isEmpty():  # rows with one id and text
        whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if _orderable(docs.schema[c].dataType)]).alias("_order")
        out = out.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), whole)
        key = lambda c: F.col(f"_row.`{c}`")
        out = out.groupBy(key(id_col), F.coalesce(key(text_col), F.lit(""))).agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")
    return out


def _orderable(kind) -> bool:
    return kind.typeName() not in ("map", "variant")
