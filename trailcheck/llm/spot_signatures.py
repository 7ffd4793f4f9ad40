"""Document fingerprints from spot signatures (operator 2).

A signature starts at an anchor, one of the corpus' ``ANCHORS`` most frequent short words, and is the anchor with the
chain of the ``CHAIN`` content words (words that are no anchors) that follow it, or of as many as the text still has.
A content word without an anchor among the ``REACH`` words before it is a signature by itself, so that tables and
lists have signatures too; what is a signature depends on the words near it alone, and a change elsewhere in the text
leaves it as it is.  Words are cut after every ``WORD_LETTERS`` letters.  A fingerprint is the set of a document's
signatures, written as sorted eight-digit hexadecimal hashes.

The likeness of two fingerprints is the Jaccard similarity of their sets; where a least likeness is asked, pairs whose
set lengths alone rule it out are passed over, and the merge of the sorted hashes stops once it can no longer be reached.
``similar_pairs`` finds all pairs of a least likeness: equal fingerprints collapse to a class; classes are partitioned
by set length, so that a partner lies in the same partition or the next; there a class is looked up by its rarest signatures,
as many as one of them must be shared; pairs that meet are settled by the pruned merge.

To set each document beside the next one, rows are dealt by ranges of their id whose bounds are taken once from the
ids alone.  The first row of each range travels a second time, as a guest of the range before it, so that no
range needs a look at another and the texts are shuffled once.

Defined cases: a null or empty text has the empty fingerprint, and two empty ones have likeness 1; a text without
words has the hash of the whole text as its signature; rows with equal ids are
ordered by text; a null id comes last; a single row is its own next; repeated rows have a row each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.common import documents, map_batches, shared_dir, stored, texts

ANCHORS = 48
ANCHOR_LETTERS = 4
CHAIN = 2
REACH = 16
WORD_LETTERS = 32
LEAST = 0.75
#: Cells that signatures are counted in to tell rare ones from common ones; the order they give is right with any counts.
CELLS = 1 << 16
RANGE_ROWS = 2_000
MOST_RANGES = 20_000
CACHED_WORDS = 300_000

_WORDS = re.compile(r"\w+")
_PIECES = re.compile(rf"\w{{1,{WORD_LETTERS}}}")


def frequent_words(df: DataFrame, text_col: str = "text", n: int = ANCHORS, letters: int = ANCHOR_LETTERS) -> list[str]:
    """The ``n`` words of at most so many letters that occur most often in all whole texts; ties in alphabetical order."""

    def make():
        def each(batch: pa.RecordBatch):
            counts: Counter = Counter()
            for text in texts(batch.column(0)):
                counts.update(w for w in _WORDS.findall(text.lower()) if len(w) <= letters)
            yield {"word": list(counts), "n": list(counts.values())}

        return each

    counted = map_batches(df.select(F.col(text_col).cast("string")), "word string, n long", make)
    top = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(n)
    return [r["word"] for r in top.collect()]


class SpotSigner:
    """Signatures of texts, as sorted distinct 32-bit hashes."""

    def __init__(self, anchors: list[str], chain: int = CHAIN):
        self.anchors, self.chain = frozenset(anchors), chain
        self.place: dict[str, int] = {}
        self.hashes = np.zeros(CACHED_WORDS, np.uint64)
        self.content = np.zeros(CACHED_WORDS, bool)

    def _learn(self, words: set[str]) -> None:
        for w in words:
            self.place[w] = at = len(self.place)
            self.hashes[at] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
            self.content[at] = w not in self.anchors

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word and whether it is a content word."""
        hashes, content = [], []
        for at in range(0, len(words), CACHED_WORDS // 2):
            some = words[at : at + CACHED_WORDS // 2]
            new = set(some).difference(self.place)
            if len(self.place) + len(new) > CACHED_WORDS:
                self.place.clear()
                new = set(some)
            self._learn(new)
            rows = np.fromiter(map(self.place.__getitem__, some), np.int64, len(some))
            hashes.append(self.hashes[rows])
            content.append(self.content[rows])
        return np.concatenate(hashes), np.concatenate(content)

    def signatures(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        words = _PIECES.findall(text.lower())
        if not words:
            return np.frombuffer(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=4).digest(), "<u4")
        hashes, content = self._coded(words)
        at, starts = np.flatnonzero(content), np.flatnonzero(~content)
        first = np.searchsorted(at, starts)  # the first content word after each anchor
        mixed = hashes[starts]
        for k in range(self.chain):
            here = first + k < len(at)
            more = np.zeros(len(starts), np.uint64)
            more[here] = hashes[at[first[here] + k]]
            mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ (more + (mixed >> np.uint64(29)))
        mixed ^= mixed >> np.uint64(32)
        chains = mixed * np.uint64(0xD6E8FEB86659FD93)
        before = np.searchsorted(starts, at)  # anchors before each content word
        alone = before == 0
        alone[~alone] = at[~alone] - starts[before[~alone] - 1] > REACH
        return np.unique((np.concatenate([chains, hashes[at[alone]]]) >> np.uint64(32)).astype(np.uint32))


def written(signatures: np.ndarray) -> str:
    return signatures.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted signature sets; 0 where it cannot reach ``least``."""
    if not len(a) and not len(b):
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    both, step = 0, 256 if least > 0 else max(len(short), 1)
    for at in range(0, len(short), step):
        some = short[at : at + step]
        place = np.searchsorted(long, some)
        place[place == len(long)] = 0
        both += int(np.count_nonzero(long[place] == some))
        most = both + max(len(short) - at - step, 0)
        if most < least * (len(a) + len(b) - most):
            return 0.0
    found = both / (len(a) + len(b) - both)
    return found if found >= least else 0.0


def fingerprints(df: DataFrame, anchors: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_signatures, fingerprint) of every whole text."""

    def make():
        signer = SpotSigner(anchors)

        def each(batch: pa.RecordBatch):
            found = [signer.signatures(t) for t in texts(batch.column(1))]
            yield {"doc_id": batch.column(0), "n_signatures": [len(s) for s in found], "fingerprint": [written(s) for s in found]}

        return each

    return map_batches(df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), "doc_id long, n_signatures long, fingerprint string", make)


def length_partition(n: int, least: float) -> int:
    """Number of the set-length partition of ``n``; each ends before the first length that its shortest set cannot be
    like, so a set and a longer one of at least that likeness lie in one partition or in two that follow each other."""
    number, first = 0, 1
    while True:
        following = int(first / least + 1e-9) + 1
        if n < following:
            return number
        number, first = number + 1, following


def classes(found: DataFrame) -> DataFrame:
    """(key, doc_id, n_signatures, fingerprint): one row per different fingerprint, with its smallest doc_id; ``key`` is its SHA-256."""
    return (found.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.first("n_signatures").alias("n_signatures"))
            .select(F.sha2("fingerprint", 256).alias("key"), "doc_id", "n_signatures", "fingerprint"))


def _cell(signatures: np.ndarray) -> np.ndarray:
    return (signatures.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(11)) % np.uint64(CELLS)


def _cell_counts(held: DataFrame) -> np.ndarray:
    """Signatures of all classes by cell: a table of fixed size."""

    def make():
        counts = np.zeros(CELLS, np.int64)

        def each(batch: pa.RecordBatch):
            for fingerprint in texts(batch.column(0)):
                np.add.at(counts, _cell(read(fingerprint)).astype(np.int64), 1)
            return ()

        def end():
            cells = np.flatnonzero(counts)
            yield {"cell": cells, "n": counts[cells]}

        each.end = end
        return each

    total = np.zeros(CELLS, np.int64)
    for r in map_batches(held.select("fingerprint"), "cell long, n long", make).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[r["cell"]] = r["n"]
    return total


def similar_pairs(found: DataFrame, least: float = LEAST) -> DataFrame:
    """(first_key, second_key, first_id, second_id, likeness): all pairs of different fingerprints with at least that likeness.

    ``found`` is what ``fingerprints`` returns; ``classes`` gives the members of a key.  The first of a pair has the
    shorter set, or the smaller key of two equally long.  Empty fingerprints form one class without partners.  Rows of one
    signature meet only within one length partition, and only at places that leave room for the likeness behind them.
    """
    if not 0 < least <= 1:
        raise ValueError("the least likeness lies above 0 and not above 1")
    at = shared_dir(found.sparkSession, "spot-signatures")
    held = stored(classes(found), "classes", at)
    counts = _cell_counts(held)

    def make():
        def each(batch: pa.RecordBatch):
            for key, fingerprint in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                signatures = read(fingerprint)
                n = len(signatures)
                if not n:
                    continue
                rarest = signatures[np.lexsort((signatures, counts[_cell(signatures).astype(np.int64)]))]
                probes = rarest[: n - max(int(np.ceil(least * n - 1e-9)), 1) + 1].astype(np.int64)
                m, part = len(probes), length_partition(n, least)
                yield {"part": [part] * m + [part + 1] * m, "signature": np.concatenate([probes, probes]), "key": [key] * (2 * m), "n": [n] * (2 * m),
                       "room": np.tile(n - np.arange(m), 2), "guest": [False] * m + [True] * m}

        return each

    probes = map_batches(held.select("key", "fingerprint"), "part long, signature long, key string, n long, room long, guest boolean", make)
    a, b = probes.alias("a"), probes.where("not guest").alias("b")
    earlier = F.col("a.guest") | (F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.key") < F.col("b.key")))
    room = F.least("a.room", "b.room")  # signatures that two sets first meeting here can share at most
    can = (F.col("a.n") >= least * F.col("b.n") - 1e-6) & (room >= least * (F.col("a.n") + F.col("b.n") - room) - 1e-6)
    met = (a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.signature") == F.col("b.signature")) & earlier & can)
           .select(F.col("a.key").alias("first_key"), F.col("b.key").alias("second_key")).distinct())
    sides = [held.select(F.col("key").alias(f"{s}_key"), F.col("doc_id").alias(f"{s}_id"), F.col("fingerprint").alias(s)) for s in ("first", "second")]
    both = met.join(sides[0], "first_key").join(sides[1], "second_key").select("first_key", "second_key", "first_id", "second_id", "first", "second")

    def settle():
        def each(batch: pa.RecordBatch):
            shares = np.array([likeness(read(x), read(y), least) for x, y in zip(texts(batch.column(4)), texts(batch.column(5)))])
            rows = batch.take(pa.array(np.flatnonzero(shares > 0)))
            yield {**{c: rows.column(k) for k, c in enumerate(("first_key", "second_key", "first_id", "second_id"))}, "likeness": shares[shares > 0]}

        return each

    return map_batches(both, "first_key string, second_key string, first_id long, second_id long, likeness double", settle)


def beside_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, guest, id, text): rows by ranges of descending id, each range closed by a guest, the row that follows it."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ids = rows.select("id").where("id is not null")
    # only the ids are read for the bounds; their number is at most MOST_RANGES
    n = rows.count()
    wanted = max(1, min(MOST_RANGES, n // RANGE_ROWS))
    cuts = ids.agg(F.percentile_approx("id", [k / wanted for k in range(1, wanted)], 10 * wanted).alias("c")).first()["c"] if wanted > 1 else []
    bounds = np.unique(np.array([x for x in cuts or [] if x is not None], np.int64))
    number = _range_number(bounds)
    firsts = {r["range"]: r["id"] for r in map_batches(ids, "range long, id long", number).groupBy("range").agg(F.max("id").alias("id")).collect()}
    holders = sorted(firsts, reverse=True)
    if not holders:
        holders, firsts = [0], {0: None}
    # the largest id of a range follows the last row of the range above; the largest of all follows the last row of all
    guest_of = {firsts[below]: above for above, below in zip(holders, holders[1:])}
    guest_of[firsts[holders[0]]] = holders[-1]
    last = holders[-1]

    def make():
        def each(batch: pa.RecordBatch):
            ids = batch.column(0).to_pylist()
            own = [last if i is None else int(np.searchsorted(bounds, i, "left")) for i in ids]
            yield {"range": own, "guest": [False] * len(ids), "id": batch.column(0), "text": batch.column(1)}
            also = [k for k, i in enumerate(ids) if i in guest_of]
            if also:
                part = batch.take(pa.array(also))
                yield {"range": [guest_of[ids[k]] for k in also], "guest": [True] * len(also), "id": part.column(0), "text": part.column(1)}

        return each

    return map_batches(rows, "range long, guest boolean, id long, text string", make)


def _range_number(bounds: np.ndarray):
    def make():
        def each(batch: pa.RecordBatch):
            yield {"range": np.searchsorted(bounds, batch.column(0).to_numpy(zero_copy_only=False), "left"), "id": batch.column(0)}

        return each

    return make


def edited_likeness(df: DataFrame, anchors: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with its edited text's fingerprint and the likeness to it and to the next document.

    The edited text has the last third of the code points (rounded down) replaced by the first as many of the next
    document by descending id; the last document is followed by the first.
    """
    dealt = beside_next(df, id_col, text_col).repartition("range").sortWithinPartitions("range", "guest", F.desc_nulls_last("id"), F.desc("text"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    names = [x.split()[0] for x in schema.split(", ")]

    def make():
        signer, held = SpotSigner(anchors), None

        def settled(row: tuple, nxt: tuple) -> tuple:
            _, doc_id, text, own = row
            n = len(text)
            cut = n // 3
            edited = text[: n - cut] + nxt[2][:cut]
            other = signer.signatures(edited)
            return (doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(own), written(other), likeness(own, other), likeness(own, nxt[3]))

        def each(batch: pa.RecordBatch):
            nonlocal held
            for at in range(0, batch.num_rows, 200):
                part, done = batch.slice(at, 200), []
                for rng, guest, doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), texts(part.column(3))):
                    row = (rng, doc_id, text, signer.signatures(text))
                    if held is not None and held[0] == rng:
                        done.append(settled(held, row))
                    held = None if guest else row
                yield dict(zip(names, map(list, zip(*done)))) if done else {k: [] for k in names}

        return each

    return map_batches(dealt, schema, make)


def op2_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return edited_likeness(docs, frequent_words(docs))
