"""Language identification by averaged hashed subword embeddings (operator 9).

A document is the average of the embeddings of its words' subwords (the word in angle brackets, and its letter
n-grams of ``NGRAMS``), hashed to ``BUCKETS`` rows; a linear softmax over it gives the languages.  Embeddings and
weights are trained together by stochastic gradient descent in numpy, in the tasks, on every labelled document: its whole
text and two windows of words, so that short texts are met too.  The documents are dealt by hashes to shards of about
``SHARD_ROWS``; each shard goes through its documents in the order of a hash, and what it has learned, its scores of a
bucket, is averaged over the shards by how often each met the bucket.  The sums are of whole numbers, so the same rows
give the same model however they are stored.  Shards with fewer than ``LEARNED_PIECES`` texts and windows are gone
through up to ``EPOCHS`` times.

Rejection goes by the score and by familiarity, the share of a text's subwords that fell into buckets met while learning (more often than by
chance, where much was learned): the softmax has to choose one of the languages and may be sure of a wrong one, but a language never seen has other subwords.  Both
are calibrated by length, as a short text of a known language may do worse than a long one of none: ``BANDS`` are
the least words of each band.  The shards belong to two halves, dealt by text; every labelled document is scored by the
model of the half that did not learn from it, whole, in its band, and by a window of the least words of every band below.
The temperature of the softmax is the one of least loss over all of them.  The thresholds of a band are such that one in
``REJECTS_ONE_IN`` of its rightly named pieces lies below (none, where there are fewer), counted in cells of equal
width; a band with fewer than ``LEAST_SCORES`` of them rejects nothing.

As embedding and weights are linear, prediction needs the scores of a subword only (BUCKETS rows, one column a
language).  Subwords are hashed in bulk from the code points of a text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected; ties go to the language
first in alphabetical order; rows with a null language or a null id are not learned from; without any labelled row every text is ``und``;
repeated rows are predicted each; very long texts are read whole; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trailcheck.llm.common import documents, fields, map_batches, shuffles_dropped, stored, texts

BUCKETS = 1 << 16
NGRAMS = (2, 3, 4)
DIMENSIONS = 16
SHARD_ROWS = 4_000
LEARNED_PIECES = 24_000
FAMILIAR_ONE_IN = 1 << 23
WINDOWS = (6, 25)
EPOCHS = 5
RATE, LEAST_RATE = 2.0, 0.1
#: Beyond these squares of lengths of a document and of what pulls at it, steps are shortened.  In samples of sf0.1 the first stayed under 20.
STEADY_SIZE, STEADY_PULL = 64.0, 400.0
LARGEST_WEIGHT, LARGEST_SCORE = 32.0, 32_768.0
BANDS = (1, 3, 8, 25)
REJECTS_ONE_IN = 4_000
LEAST_SCORES = 300
TEMPERATURES = tuple(float(t) for t in np.geomspace(0.2, 20, 24))
SCORE_CELLS, FAMILIARITY_CELLS = 1_000, 10_000
BLOCK = 1 << 20
FACTOR = 0x01000193
SORTED_BUCKETS = 8_000  # up to so many are counted by sorting them
SUMMED_BUCKETS = 1 << 14
FOLDS, HELD_OUT_FOLD = 4, 2
FIXED_POINT = 1 << 12

_LETTERS = re.compile(r"[^\W\d_]+")


def fold(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """By code point: whether words are made of it, and whether it is a letter in the strict sense."""
    every = "".join(map(chr, range(0x110000)))
    runs, strict = np.zeros(len(every), bool), np.fromiter(map(str.isalpha, every), bool, len(every))
    for m in _LETTERS.finditer(every):
        runs[m.start() : m.end()] = True
    return runs, strict


def _buckets(x: np.ndarray) -> np.ndarray:
    """Buckets of 32-bit numbers (wrapping arithmetic, in place)."""
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(12)
    x *= np.uint32(0x297A2D39)
    x >>= np.uint32(32 - BUCKETS.bit_length() + 1)
    return x


@lru_cache(maxsize=8)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2^bits powers of ``FACTOR``, which is odd, and of its inverse, both modulo 2^32."""
    out = tuple(np.full(1 << bits, f, np.uint32) for f in (FACTOR, pow(FACTOR, -1, 1 << 32)))
    for x in out:
        x[0] = 1
        np.multiply.accumulate(x, out=x)
    return out


def _hashed(codes: np.ndarray, inside: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, list[int], list[np.ndarray]]:
    """Buckets of the words' subwords: of the whole words, then for each of ``NGRAMS`` those of all words in their order;
    where each of these parts begins; and for each of ``NGRAMS`` at which places of the text one begins.  ``codes`` are the characters of a text, with a place without a letter to both sides,
    ``inside`` tells the letters and ``edges`` has the place before each word and its last one in turn.

    The place before a word is its opening bracket and the one after it the closing one, so the text is hashed as it lies.
    """
    n, before, last = len(codes), edges[::2], edges[1::2]
    first, other = np.where(inside, codes, np.uint32(ord("<"))), np.where(inside, codes, np.uint32(ord(">")))
    up, down = _powers(max(16, n.bit_length()))
    sums = np.zeros(n + 1, np.uint32)
    np.cumsum(first * up[:n], dtype=np.uint32, out=sums[1:])
    words = sums[last + 1] - sums[before]
    words *= down[before]
    words += np.uint32(ord(">")) * up[last + 1 - before]
    parts, bases, places, factor = [words], [0], [], np.uint32(FACTOR)
    gram, within = first, None  # letters alone between the two ends
    for k in range(2, max(NGRAMS) + 1):
        gram = gram[:-1] * factor
        gram += other[k - 1 :]
        if k in NGRAMS:
            valid = inside[: n - k + 1] | inside[k - 1 :]  # from bracket to bracket is no n-gram but the whole word
            if within is not None:
                valid &= within
            bases.append(bases[-1] + len(parts[-1]))
            places.append(valid)
            parts.append(gram[valid])
            parts[-1] += np.uint32(k << 24)
        within = inside[1 : n - k + 1] if within is None else within[:-1] & inside[k - 1 : n - 1]
        within = within[: max(0, n - k)]
    return _buckets(np.concatenate(parts)), bases, places


class Words:
    """The words of a text, runs of letters in lower case (none if it has no letter), and the buckets of their subwords."""

    def __init__(self, text: str) -> None:
        runs, strict = _characters()
        text = f" {text.lower()} "  # with a place without a letter to both sides
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.inside = runs[self.codes]
        edges = np.flatnonzero(self.inside[1:] != self.inside[:-1])
        if len(edges) and not strict[self.codes[edges[0] + 1]] and not strict[self.codes[self.inside]].any():
            edges = edges[:0]
        self.edges = edges  # the place before each word and its last one in turn
        self.sizes = edges[1::2] - edges[::2]
        self.small = len(self.codes) <= BLOCK  # hashed once, windows are cut out
        self.whole, self.bases, self.places = _hashed(self.codes, self.inside, edges) if self.small and len(self) else (None, [], [])

    def __len__(self) -> int:
        return len(self.sizes)

    def _window(self, first: int, last: int) -> np.ndarray:
        """Buckets of the words from ``first`` to ``last``, cut out of those of the whole text."""
        begin, end = int(self.edges[2 * first]), int(self.edges[2 * last - 1]) + 1
        parts = [self.whole[first:last]]
        for base, places in zip(self.bases[1:], self.places):
            base += int(np.count_nonzero(places[:begin]))
            parts.append(self.whole[base : base + int(np.count_nonzero(places[begin:end]))])
        return np.concatenate(parts)

    def buckets(self, first: int = 0, size: int | None = None) -> Iterator[np.ndarray]:
        """Buckets of ``size`` words from ``first`` on (all), in parts of bounded size."""
        last = len(self) if size is None else first + size
        if self.small:
            yield self.whole if (first, last) == (0, len(self)) else self._window(first, last)
            return
        while first < last:
            begin = int(self.edges[2 * first])
            until = max(first + 1, min(last, int(np.searchsorted(self.edges[1::2], begin + BLOCK, "right"))))
            part = slice(begin, int(self.edges[2 * until - 1]) + 2)
            yield _hashed(self.codes[part], self.inside[part], self.edges[2 * first : 2 * until] - begin)[0]
            first = until

    def counted(self, first: int = 0, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The distinct buckets of those words and how often each occurs."""
        parts = self.buckets(first, size)
        if self.small:
            part = next(parts)
            if len(part) < SORTED_BUCKETS:
                part, new = np.sort(part), np.ones(len(part) + 1, bool)
                np.not_equal(part[1:], part[:-1], out=new[1:-1])
                at = np.flatnonzero(new)
                return part[at[:-1]].astype(np.intp), at[1:] - at[:-1]
            total = np.bincount(part, minlength=BUCKETS)
        else:
            total = np.zeros(BUCKETS, np.int64)
            for part in parts:
                total += np.bincount(part, minlength=BUCKETS)
        at = np.flatnonzero(total != 0)
        return at, total[at]


@dataclass(frozen=True)
class Model:
    """Scores of each bucket by language, which buckets were met, the bias, the temperature and the least score and
    familiarity of each band."""

    languages: tuple[str, ...]
    scores: np.ndarray
    met: np.ndarray
    bias: np.ndarray
    temperature: float
    thresholds: tuple[tuple[float, float], ...]


def _labelled(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """id, lang, text and half of the labelled documents outside the held-out fold; equal texts are of one half."""
    rows = df.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & (fold(F.col("id")) != HELD_OUT_FOLD))
    return rows.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "text"), F.lit(2)).cast("int"))


def _sizes(labelled: DataFrame) -> dict[str, int]:
    return {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language


def _familiar(times: np.ndarray) -> np.ndarray:
    """The buckets met: in much text every bucket is hit by chance, so one in ``FAMILIAR_ONE_IN`` subwords has to fall there."""
    return times >= max(1, times.sum() / FAMILIAR_ONE_IN)


class _Shard:
    """Gradient descent over the documents of one shard; languages not met yet take no part in a step."""

    def __init__(self, half: int, languages: int, rows: float, epochs: int) -> None:
        draw = np.random.default_rng(0)
        self.half, self.rows, self.epochs, self.step = half, rows, epochs, 0
        self.embedding = (draw.standard_normal((BUCKETS, DIMENSIONS)) / DIMENSIONS).astype(np.float32)
        self.whole_rows = self.embedding.view(f"V{self.embedding.itemsize * DIMENSIONS}")[:, 0]  # each copied as one item
        self.weights, self.bias = np.zeros((DIMENSIONS, languages), np.float32), np.full(languages, -np.inf, np.float32)
        self.rows_at_hand = np.empty((2, SORTED_BUCKETS, DIMENSIONS), np.float32)
        self.times, self.seen, self.pieces = np.zeros(BUCKETS, np.int64), np.zeros(languages, bool), 0
        self.kept: list[tuple] = []

    def learn(self, buckets: np.ndarray, share: np.ndarray, lang: int) -> None:
        steps = self.epochs * self.rows * (1 + len(WINDOWS))
        rate, self.step = max(LEAST_RATE, RATE * (1 - self.step / steps)), self.step + 1
        n = len(buckets)
        rows, pulls = self.rows_at_hand[:, :n] if n <= SORTED_BUCKETS else np.empty((2, n, DIMENSIONS), np.float32)
        self.embedding.take(buckets, 0, out=rows, mode="clip")  # no copy is made in this mode; all are in range
        hidden = share.dot(rows)
        p = hidden.dot(self.weights)
        p += self.bias
        p -= np.maximum.reduce(p)
        np.exp(p, out=p)
        p /= np.add.reduce(p)
        p[lang] -= 1
        back = self.weights.dot(p)
        # one text in very many copies and languages would drive its words and the weights up in turn, without end
        size, pull = float(hidden.dot(hidden)), float(back.dot(back))
        if pull > STEADY_PULL:
            back *= np.float32((STEADY_PULL / pull) ** 0.5)
        self.weights -= (rate * min(1.0, STEADY_SIZE / max(size, 1e-9)) * hidden)[:, None] * p
        np.minimum(self.weights, np.float32(LARGEST_WEIGHT), out=self.weights)
        np.maximum(self.weights, np.float32(-LARGEST_WEIGHT), out=self.weights)
        self.bias -= np.float32(0.1 * rate) * p
        np.dot((np.float32(rate * n**0.5) * share)[:, None], back[None, :], out=pulls)
        rows -= pulls
        np.put(self.whole_rows, buckets, rows.view(self.whole_rows.dtype)[:, 0])

    def add(self, i: object, lang: int, words: Words) -> None:
        draw, count = np.random.default_rng(zlib.crc32(str(i).encode())), len(words)
        if not self.seen[lang]:
            self.seen[lang], self.bias[lang] = True, 0
        for size in (count, *WINDOWS):
            at = int(draw.integers(0, count - size + 1)) if size < count else 0
            buckets, times = words.counted(at, min(size, count))
            self.times[buckets] += times
            self.pieces += 1
            share = (times / times.sum()).astype(np.float32)
            self.learn(buckets, share, lang)
            if self.epochs > 1:  # a small table
                self.kept.append((buckets.astype(np.uint16), share, lang))

    def result(self) -> dict:
        """What it learned, as weighted whole numbers: a row a bucket met and language, the bias in bucket -1."""
        draw = np.random.default_rng(1)
        for _ in range(1, self.epochs):
            for k in draw.permutation(len(self.kept)):
                buckets, share, lang = self.kept[k]
                self.learn(buckets.astype(np.intp), share, lang)
        met, langs = np.flatnonzero(self.times), np.flatnonzero(self.seen)
        times = np.append(self.times[met], self.pieces)
        found = np.concatenate([self.embedding[met] @ self.weights[:, langs], self.bias[None, langs]]).astype(np.float64)
        np.clip(found, -LARGEST_SCORE, LARGEST_SCORE, out=found)
        weighted = np.rint(found * times[:, None] * FIXED_POINT).astype(np.int64)
        n = found.size
        return {"half": np.full(n, self.half, np.int32), "bucket": np.repeat(np.append(met, -1), len(langs)).astype(np.int32),
                "lang": np.tile(langs, len(times)).astype(np.int32), "weighted": weighted.ravel(), "times": np.repeat(times, len(langs))}


def _learned(labelled: DataFrame, languages: tuple[str, ...], rows: int) -> tuple[Model, list[Model]]:
    """The model of all labelled documents and that of each half."""
    a_half = max(1, rows // (2 * SHARD_ROWS))  # shards
    each_has = rows / (2 * a_half)
    epochs = max(1, min(EPOCHS, int(LEARNED_PIECES / (each_has * (1 + len(WINDOWS))))))
    shard = (2 * F.pmod(F.xxhash64(F.lit("shard"), "id", "text"), F.lit(a_half)) + F.col("half")).cast("int")
    dealt = (labelled.withColumn("shard", shard).withColumn("draw", F.xxhash64(F.lit("order"), "id", "text")).repartitionById(2 * a_half, "shard")
             .sortWithinPartitions("shard", "draw", "id", "lang", "text").select("shard", "id", "lang", "text"))
    index = {k: i for i, k in enumerate(languages)}

    def make():
        now: list = [None, None]  # the shard at hand and its number

        def done():
            if now[0] is not None and now[0].pieces:
                yield now[0].result()

        def each(batch: pa.RecordBatch):
            for k, i, lang, text in zip(*(batch.column(c).to_pylist() for c in range(3)), texts(batch.column(3))):
                if k != now[1]:
                    yield from done()
                    now[:] = _Shard(k % 2, len(languages), each_has, epochs), k
                words = Words(text)
                if len(words):
                    now[0].add(i, index[lang], words)

        each.end = done
        return each

    found = map_batches(dealt, "half int, bucket int, lang int, weighted long, times long", make)
    sums = found.groupBy("half", "bucket", "lang").agg(F.sum("weighted").alias("w"), F.sum("times").alias("t"))
    weighted, times = np.zeros((2, BUCKETS + 1, len(languages))), np.zeros((2, BUCKETS + 1, len(languages)))
    with shuffles_dropped(labelled.sparkSession):
        table = sums.toArrow()  # the model: at most two rows a bucket and language
    for batch in table.to_batches():
        half, bucket, lang, w, t = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        weighted[half, bucket, lang], times[half, bucket, lang] = w / FIXED_POINT, t

    def model(w: np.ndarray, t: np.ndarray) -> Model:
        averages = w / np.maximum(t, 1)
        bias = np.where(t[-1] > 0, averages[-1], -np.inf)
        return Model(languages, averages[:-1].astype(np.float32), _familiar(t[:-1].max(1)), bias, 1.0, ((0.0, 0.0),) * len(BANDS))

    return model(weighted.sum(0), times.sum(0)), [model(w, t) for w, t in zip(weighted, times)]


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit the model on all labelled documents; the same rows give the same model."""
    labelled = _labelled(df, id_col, text_col, lang_col)
    sizes = _sizes(labelled)
    languages = tuple(sorted(sizes))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(BUCKETS, bool), np.zeros(0), 1.0, ((0.0, 0.0),) * len(BANDS))
    model, halves = _learned(labelled, languages, sum(sizes.values()))
    taught = np.isfinite(model.bias)  # a language without any word teaches nothing
    temperature, thresholds = _calibrated(labelled, languages, halves)
    return replace(model, languages=tuple(k for k, x in zip(languages, taught) if x), scores=model.scores[:, taught], bias=model.bias[taught],
                   temperature=temperature, thresholds=thresholds)


class Scorer:
    """Logits and familiarity of words; best language, score and familiarity of a text."""

    def __init__(self, model: Model) -> None:
        self.model = model
        # row by row: a table in another order, such as one of chosen columns, would be copied whole by each look-up
        self.table = np.ascontiguousarray(np.column_stack([model.scores, model.met]), np.float64)
        self.rows, self.ones = np.empty((SUMMED_BUCKETS, self.table.shape[1])), np.ones(SUMMED_BUCKETS)

    def logits(self, words: Words, first: int = 0, size: int | None = None) -> tuple[np.ndarray, float]:
        total, count = np.zeros(self.table.shape[1]), 0
        for buckets in words.buckets(first, size):
            for k in range(0, len(buckets), SUMMED_BUCKETS):
                some = buckets[k : k + SUMMED_BUCKETS]
                total += self.ones[: len(some)].dot(self.table.take(some, 0, out=self.rows[: len(some)], mode="clip"))
            count += len(buckets)
        return total[:-1] / count + self.model.bias, float(total[-1] / count)

    def several(self, words: Words, spans: list[tuple[int, int]]) -> list[tuple[np.ndarray, float]]:
        """``logits`` of several spans of words, (first, size) each; those of short spans are looked up together."""
        if not words.small:
            return [self.logits(words, *span) for span in spans]
        parts = [next(words.buckets(*span)) for span in spans]
        ends = list(accumulate(map(len, parts)))
        if ends[-1] > SUMMED_BUCKETS:
            return [self.logits(words, *span) for span in spans]
        rows = self.table.take(np.concatenate(parts), 0, out=self.rows[: ends[-1]], mode="clip")
        totals = [self.ones[: b - a].dot(rows[a:b]) / (b - a) for a, b in zip([0, *ends], ends)]
        return [(x[:-1] + self.model.bias, float(x[-1])) for x in totals]

    def __call__(self, words: Words) -> tuple[str, float, float]:
        z, familiarity = self.logits(words)
        p = np.exp((z - z.max()) / self.model.temperature)
        p /= p.sum()
        best = int(p.argmax())
        return self.model.languages[best], float(p[best]), familiarity


def band_of(words: int) -> int:
    """The band of a text of so many words (at least one)."""
    return bisect_right(BANDS, words) - 1


def _calibrated(labelled: DataFrame, languages: tuple[str, ...], halves: list[Model]) -> tuple[float, tuple[tuple[float, float], ...]]:
    """The temperature and the thresholds of each band, from all labelled documents, each scored by the half that did not
    learn from it.  The tasks count the scores at every temperature of ``TEMPERATURES`` and the familiarities in cells."""
    held = labelled.sparkSession.sparkContext.broadcast([replace(m, met=m.met.copy()) for m in halves])
    index, heat = {k: i for i, k in enumerate(languages)}, np.array(TEMPERATURES)

    def make():
        scorers = [Scorer(m) for m in held.value]

        def each(batch: pa.RecordBatch):
            found: list[tuple] = []  # band, logits, familiarity, language
            for i, lang, half, text in zip(*(batch.column(c).to_pylist() for c in range(3)), texts(batch.column(3))):
                words, scorer, lang = Words(text), scorers[1 - half], index[lang]
                if len(words) and np.isfinite(scorer.model.bias[lang]):
                    draw, count = np.random.default_rng(zlib.crc32(f"band {i}".encode())), len(words)
                    sizes = [k for k in BANDS if k <= count]
                    spans = [(int(draw.integers(0, count - k + 1)) if k < count else 0, k) for k in sizes]
                    found.append((band_of(count), *scorer.logits(words), lang))
                    found += [(band_of(k), *z, lang) for k, z in zip(sizes, scorer.several(words, spans))]
            for k in range(0, len(found), 4_096):
                yield counted(found[k : k + 4_096])

        def counted(found: list[tuple]) -> dict:
            bands, z, familiar, gold = (np.array(x) for x in zip(*found))
            p = np.exp((z - z.max(1, keepdims=True)) / heat[:, None, None])  # temperature, piece, language
            p /= p.sum(2, keepdims=True)
            rows, right = np.arange(len(gold)), z.argmax(1) == gold
            loss = -np.log(np.maximum(p[:, rows, gold], 1e-12)).sum(1)
            cells = np.minimum((p.max(2)[:, right] * SCORE_CELLS).astype(np.int64), SCORE_CELLS - 1)
            keys = [np.stack([np.repeat(np.arange(len(heat)), int(right.sum())), np.tile(bands[right], len(heat)), cells.ravel()]),
                    np.stack([np.full(int(right.sum()), -1), bands[right], np.minimum((familiar[right] * FAMILIARITY_CELLS).astype(np.int64), FAMILIARITY_CELLS - 1)])]
            at, n = np.unique(np.concatenate(keys, 1), axis=1, return_counts=True)
            kinds = [np.append(x, y).astype(np.int32) for x, y in zip(at, (np.arange(len(heat)), np.full(len(heat), -1), np.full(len(heat), -1)))]
            return {"heat": kinds[0], "band": kinds[1], "cell": kinds[2], "n": np.append(n, np.rint(loss * FIXED_POINT)).astype(np.int64)}

        return each

    counts = map_batches(labelled.select("id", "lang", "half", "text"), "heat int, band int, cell int, n long", make)
    counts = stored(counts.groupBy("heat", "band", "cell").agg(F.sum("n").alias("n")), "language-calibration")
    losses = {r["heat"]: r["n"] for r in counts.where("band = -1").collect()}  # one row a temperature
    heat = min(losses, key=lambda k: (losses[k], k)) if losses else int(np.abs(np.log(TEMPERATURES)).argmin())
    least: dict[tuple[int, bool], list] = {}
    for r in sorted(counts.where((F.col("band") >= 0) & F.col("heat").isin(heat, -1)).collect(), key=lambda r: r["cell"]):  # a row a cell
        least.setdefault((r["band"], r["heat"] < 0), []).append((r["cell"], r["n"]))

    def threshold(band: int, familiarity: bool) -> float:
        cells = least.get((band, familiarity), [])
        below, pieces = 0, sum(n for _, n in cells)
        for cell, n in cells if pieces >= LEAST_SCORES else ():
            if (below := below + n) > pieces // REJECTS_ONE_IN:
                return cell / (FAMILIARITY_CELLS if familiarity else SCORE_CELLS)
        return 0.0

    return TEMPERATURES[heat], tuple((threshold(k, False), threshold(k, True)) for k in range(len(BANDS)))


def predict(df: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with lang_pred, score, familiarity and rejected for every row."""
    held = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows, one column a language
    once = text_col in keep and isinstance(df.schema[text_col].dataType, StringType)  # the text travels once
    kept = df.select(*keep, *([] if once else [F.col(text_col).cast("string").alias("__text")]))
    where = keep.index(text_col) if once else len(keep)

    def make():
        scorer, model = Scorer(held.value), held.value

        def each(batch: pa.RecordBatch):
            out = {"lang_pred": [], "score": [], "familiarity": [], "rejected": []}
            for text in texts(batch.column(where)):
                words = Words(text if model.languages else "")
                lang, score, familiarity = scorer(words) if len(words) else ("und", 0.0, 0.0)
                least = model.thresholds[band_of(len(words))] if len(words) else (1.0, 1.0)
                for k, v in zip(out, (lang, score, familiarity, not len(words) or score < least[0] or familiarity < least[1])):
                    out[k].append(v)
            yield {**{k: batch.column(i) for i, k in enumerate(keep)}, **out}

        return each

    return map_batches(kept, fields(df, keep, "lang_pred string, score double, familiarity double, rejected boolean"), make)


def accepted_documents(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that the model does not reject, with its columns and no others."""
    others = [c for c in df.columns if c != text_col]
    rows = df.select(*([F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest")] if others else []), F.col(f"`{text_col}`").alias("text"))
    left = predict(rows, model, rows.columns, "text").where(~F.col("rejected"))
    return left.select(*(F.col("text").alias(c) if c == text_col else F.col("rest").getField(c).alias(c) for c in df.columns))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = predict(docs, train(docs), ["doc_id"])
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT_FOLD, F.lit(False)).alias("held_out"), "lang_pred", "score", "familiarity", "rejected")
