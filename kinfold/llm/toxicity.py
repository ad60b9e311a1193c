"""Toxicity scores behind a noisy-channel deobfuscation.

Writers hide words by look-alike characters (``1d10t``), spacing (``i d i o t``) and
repetition (``idiooot``). Every word with a look-alike or a repeated letter, and every
run of single letters, becomes a lattice of characters that may
have been meant, the written ones among them; Viterbi decoding under a character trigram
model, counted over all documents, picks the likeliest reading. The restored text is then scored by a logistic
model over words, beginnings of words and how many different words share a beginning.
Stretches without such marks have a lattice of one path, so they are left as they are.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.common import held_out, labelled_sample, materialize, table

#: At most this many labelled rows are collected to fit the weights.
TRAIN_LIMIT = 20_000
CUT = 0.7
#: What a character may stand for, with the channel's cost of writing it so.
LOOKS = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "+": "t", "|": "il"}
SWAP_COST, DROP_COST, BREAK_COST = 1.0, 0.5, 1.0
#: A look-alike may stand for itself, and one of two equal letters may be too many; both are unlikely in a disguise.
#: Signs without any letter are likelier a number than a word.
KEEP_COST, DOUBLE_COST, NUMBER_COST = 8.0, 6.0, 10.0
#: Symbols of the character model: 0 for anything that is no letter, 1-26, 27 beyond ASCII.
ALPHABET = 28
_CODE = np.zeros(256, np.int32)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = 27
_SIGNS = re.escape("".join(LOOKS))
#: What a word in disguise is made of: letters of any script and look-alikes.
_CHAR = rf"[A-Za-z\u0080-\U0010ffff{_SIGNS}]"
_SUSPECT = re.compile(
    # single letters or look-alikes, one or more separators between each
    rf"(?<![^\W_])(?:{_CHAR}[ .\-_*]+){{2,}}{_CHAR}(?![^\W_])"
    # whole words with a look-alike or a repeated letter, whatever stands round them
    rf"|(?<!{_CHAR})(?=[A-Za-z\u0080-\U0010ffff]*?(?:[{_SIGNS}]|(?i:([A-Za-z\u0080-\U0010ffff])\1))){_CHAR}{{2,}}"
)
_SPACED = re.compile(rf"(?:{_CHAR}[ .\-_*]+)+{_CHAR}")
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words are chosen by their first so many bytes; a shorter word is its own stem.
_STEM = 4


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigrams of letters over all texts. Each batch sends at most 28**3 counts, summed before the driver."""
    import pyarrow as pa

    def run(batches):
        total = np.zeros(ALPHABET**3, np.int64)
        for b in batches:
            texts = b.column(0).cast(pa.large_binary())
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for at in range(0, len(data), 4_000_000):
                c = _CODE[data[max(0, at - 2) : at + 4_000_000]]
                if len(c) > 2:
                    total += np.bincount((c[:-2] * ALPHABET + c[1:-1]) * ALPHABET + c[2:], minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(total[k])], ["code", "n"])

    rows = docs.select(F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n")).alias("text"))
    out = np.zeros(ALPHABET**3, np.int64)
    for r in rows.mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect():
        out[r["code"]] = r["n"]
    return out


class Channel:
    """Costs of character trigrams, and the decoder over them."""

    def __init__(self, counts: np.ndarray):
        c = counts.reshape(ALPHABET, ALPHABET, ALPHABET).astype(float) + 0.1
        self.cost = -np.log(c / c.sum(axis=2, keepdims=True))
        self.known: dict[str, str] = {}

    def lattice(self, text: str) -> list[list[tuple[str | None, float]]]:
        """Per place the readings and their costs: None drops a character that repeats a letter, '' a gap."""
        low = [c.lower() if len(c.lower()) == 1 else c for c in text]
        spaced = _SPACED.fullmatch(text) is not None
        gaps = [len(g) for g in re.findall(r"[ .\-_*]+", text)] if spaced else []
        narrow = min(gaps, default=0)
        units = [c for c in low if c not in " .-_*"] if spaced else low
        means = [LOOKS.get(c, c) for c in units]
        # how many characters of one meaning stand together, and the place in their run
        alike = [i > 0 and bool({*means[i]} & {*means[i - 1]}) for i in range(len(units))]
        place, length = [1] * len(units), [1] * len(units)
        for i in range(1, len(units)):
            place[i] = place[i - 1] + 1 if alike[i] else 1
        for i in reversed(range(len(units))):
            length[i] = length[i + 1] if i + 1 < len(units) and alike[i + 1] else place[i]
        last = max((i for i, c in enumerate(units) if c.isalnum()), default=-1)
        letters = [i for i, c in enumerate(units) if c.isalpha()]
        first, final = (letters[0], letters[-1]) if letters else (len(units), -1)
        out: list[list[tuple[str | None, float]]] = []
        for i, ch in enumerate(units):
            if spaced and i:
                wide = gaps[i - 1] > narrow  # a wider gap than the others ends a word
                out.append([("", BREAK_COST), (" ", 0.0)] if wide else [("", 0.0), (" ", BREAK_COST)])
            drop = [(None, DROP_COST if length[i] > 2 else DOUBLE_COST)] if place[i] > 1 else []
            if i > last and ch == "!":
                out.append([(ch, 0.0)])
            elif ch in LOOKS:
                # numbers, and rows of marks behind a word, stay for nothing; between letters none stays
                free = not letters or (i > last and length[i] > 2)
                keep = [(ch, 0.0 if free else KEEP_COST)] if not first < i < final else []
                swap = SWAP_COST + (0.0 if letters else NUMBER_COST)
                out.append([(x, swap) for x in LOOKS[ch]] + keep + drop)
            else:
                out.append([(ch, 0.0), *drop])
        return out

    def decode(self, text: str) -> str:
        """The likeliest reading of a stretch, by Viterbi over the last two characters."""
        got = self.known.get(text)
        if got is None:
            # per last two characters the cost and the way there: (way, character) pairs
            states: dict = {(0, 0): (0.0, None)}
            for readings in self.lattice(text):
                after: dict = {}
                for (a, b), (cost, way) in states.items():
                    for x, extra in readings:
                        if x is None and not b:  # signs that stay are not dropped
                            continue
                        key, total = (a, b), cost + extra
                        for c in (x or "").encode("utf-8", "surrogatepass"):  # the model counts bytes
                            at = int(_CODE[c])
                            key, total = (key[1], at), total + float(self.cost[key[0], key[1], at])
                        if key not in after or total < after[key][0]:
                            after[key] = (total, (way, x) if x else way)
                states = after
            way, back = min(((cost + float(self.cost[a, b, 0]), (a, b), way) for (a, b), (cost, way) in states.items()), key=lambda s: s[:2])[2], []
            while way:
                way, x = way
                back.append(x)
            got = "".join(reversed(back))
            got = text if got == text.lower() else got
            if len(self.known) > 100_000:
                self.known.clear()
            if len(text) < 100:
                self.known[text] = got
        return got

    def restore(self, text: str) -> str:
        """The text with each suspicious stretch replaced by its reading."""
        return _SUSPECT.sub(lambda m: self.decode(m[0]), text)

    def words(self, text: str | None) -> set[bytes]:
        """Lower-case words of the restored text."""
        return set(self.restore(text).encode("utf-8", "surrogatepass").translate(_PLAIN).split()) if text else set()


def _marks(words: list[bytes]) -> set[bytes]:
    """Features of words: themselves, their beginnings, and beginnings that two or more share."""
    out, shared = set(), Counter()
    for w in words:
        out.add(w + b"$")
        for k in range(_STEM, min(len(w), 10) + 1):
            out.add(w[:k])
            shared[w[:k]] += 1
    return out | {p + b"#2" for p, n in shared.items() if n > 1}


class Lexicon:
    """Weights of the features that tell toxic texts, by logistic regression."""

    def __init__(self, channel: Channel):
        self.channel, self.weights, self.bias = channel, {}, 0.0
        self.stems: frozenset = frozenset()

    def fit(self, words: list[list[bytes]], y: np.ndarray, stems: frozenset, share: float) -> Lexicon:
        """From each text's words with one of the stems, the labels, and the toxic texts' share.

        Without texts of both labels every score is that share.
        """
        self.bias, self.stems = float(np.log(share / (1 - share))), stems
        bad = int(y.sum())
        good = len(y) - bad
        if not bad or not good:
            return self
        ratio = lambda k, a, b: (a[k] + 0.5) / (bad + 1) / ((b[k] + 0.5) / (good + 1))
        marks = [_marks(w) for w in words]
        up, down = Counter(), Counter()
        for m, label in zip(marks, y, strict=True):
            (up if label else down).update(m)
        # both kinds: marks of toxic texts, and words that clear the same beginnings
        value = {k: abs(np.log(ratio(k, up, down))) * np.sqrt(up[k] + down[k]) for k in {*up, *down} if up[k] + down[k] >= 3}
        chosen = sorted(value, key=lambda k: (-value[k], k))
        place = {k: i for i, k in enumerate(chosen)}
        row, col = [], []
        for i, m in enumerate(marks):
            mine = sorted(place[k] for k in m if k in place)  # sums do not depend on the order of a set
            row += [i] * len(mine)
            col += mine
        row, col = np.array(row, int), np.array(col, int)
        w, bias = np.zeros(len(chosen)), self.bias
        m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
        for t in range(1, 601):
            f = bias + np.bincount(row, w[col], len(y))
            g = 1 / (1 + np.exp(-np.clip(f, -30, 30))) - y
            grad = np.append(np.bincount(col, g[row], len(w)) + 0.5 * w, g.sum())
            m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
            step = 0.05 * m1 / (1 - 0.9**t) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
            w, bias = w - step[:-1], bias - step[-1]
        self.weights, self.bias = dict(zip(chosen, w.tolist(), strict=True)), float(bias)
        return self

    def score(self, text: str | None) -> float:
        stems = self.stems
        mine = [w for w in self.channel.words(text) if w[:_STEM] in stems]
        f = self.bias
        if mine:
            get = self.weights.get
            f += sum(sorted(get(k, 0.0) for k in _marks(mine)))
        return float(1 / (1 + np.exp(-max(-500.0, min(500.0, f)))))


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", limit: int = TRAIN_LIMIT) -> Lexicon:
    """The channel from all texts, the weights from a bounded sample of rows that are not held out.

    Stems that are more frequent among toxic texts are counted on the executors; only the
    sampled texts' words with such a stem come to the driver. Without labelled rows of both
    kinds the score is their share; null texts have no words, repeated rows of an id count once.
    """
    import pyarrow as pa

    channel = Channel(trigram_counts(docs))
    sent = docs.sparkSession.sparkContext.broadcast(channel)

    def run(batches):
        for b in batches:
            words = [sorted(sent.value.words(t.as_py())) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(words, pa.list_(pa.binary()))], ["label", "words"])

    sample = labelled_sample(docs.select("doc_id", "text"), labels, column, limit).select("text", "label")
    sample = materialize(sample.mapInArrow(run, "label int, words array<binary>"), "words")
    n, bad = sample.agg(F.count("label"), F.sum("label")).first()
    n, bad = n or 0, bad or 0
    stem = F.array_distinct(F.transform("words", lambda w: F.substring(w, 1, _STEM)))
    counts = sample.select("label", F.explode(stem).alias("stem")).groupBy("stem").agg(
        F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")
    )
    often = (F.col("bad") + 0.5) / (bad + 1) > 1.5 * (F.col("good") + 0.5) / (n - bad + 1)
    stems = frozenset(bytes(r["stem"]) for r in counts.where((F.col("bad") >= 3) & often).collect())
    mine = F.filter("words", lambda w: F.substring(w, 1, _STEM).isin([F.lit(x) for x in sorted(stems)]))
    rows = sample.select("label", (mine if stems else F.array()).alias("words")).collect()  # at most ``limit`` rows
    rows = sorted((r["label"], sorted(bytes(w) for w in r["words"])) for r in rows)
    y = np.array([label for label, _ in rows], float)
    return Lexicon(channel).fit([w for _, w in rows], y, stems, (bad + 0.5) / (n + 1.0))


def score(docs: DataFrame, model: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted per row. Null and empty texts get the score of no words; rows repeat as they come.

    A very long text is restored and scored as a whole in one task, in linear time; an
    empty table gives no rows; other columns are not read.
    """
    import pyarrow as pa

    sent = docs.sparkSession.sparkContext.broadcast(model)  # 28**3 costs, and weights from at most ``TRAIN_LIMIT`` rows

    def run(batches):
        for b in batches:
            s = np.array([sent.value.score(t.as_py()) for t in b.column(1)], float)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array((s >= CUT).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` scored by a model fitted on the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    out = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
