"""N-gram Jaccard self-join by vertical partitioning, as components of linked documents (operator 8).

A document is the set of its distinct five-word shingles, as 64-bit hashes; the order of the hashes is the global
order of the n-grams.  That order is cut into fragments, and every step counts overlaps fragment by fragment and
sums them per document or pair, so that no task holds whole sets of many documents.

1. Documents with equal sets are one class, told by a 128-bit digest; from here on only numbered classes are compared,
   one set each, whatever the ids and copies of their rows.
2. *Which classes can link at all.*  A link needs three quarters of either set, so a class with more than a quarter
   of shingles that no other class has is out.  They are counted per fragment from packed hashes, of which a batch
   of documents sends two a shingle at most, however hot; long sets take part with those hashes under
   ``SHARE`` of the order, the same ones in every set, and may miss a quarter of the whole set.
3. *Cheap links.*  Candidates that share one of ``KEYS`` minima of the set under random permutations are checked against
   the first of them, so a group of any size costs a few pairs a member.  Links found form components.
4. *The rest, exactly.*  Two candidates of different components share only shingles met in several components.
   Candidates with too few of these are done.  The others are ordered by frequency, and pairs across components
   that share a shingle are checked if its places leave room for the overlap that their sizes ask for.
   Members of the commonest component of a shingle are not paired with one another.

A pair is checked by joining both sets' segments on the fragment, counting each overlap and adding up the counts.

Defined cases: a null or empty text, or one without words, has the empty set and is linked with nothing; fewer than
five words are one shingle; repeated rows are in one class; texts under one id are compared, and kept or dropped, each by
itself; a component is named by the smallest id of its rows, ties of which all stay, and by null if no id is known there;
a null id is larger than any other; an empty table gives an empty result; very long texts are whole, other columns ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from trailcheck.llm.common import delete, documents, map_batches, maybe_among, shared_dir, stored, texts
from trailcheck.llm.components import components

WORDS = 5
#: A link: LEAST[1] * intersection >= LEAST[0] * union.
LEAST = (75, 100)
SHARE = 0.375
LONG_SET = 200
KEYS = 8
SEGMENTS = 8
BAND = 1.04
FRAGMENT_DOCS = 4_000
FRAGMENTS = (64, 1 << 20)
CACHED_WORDS = 300_000
_HIGH = np.uint64(24)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self):
        import xxhash

        hashed = xxhash.xxh64_intdigest

        class Words(dict):
            def __missing__(self, word: bytes) -> int:
                if len(self) >= CACHED_WORDS:
                    self.clear()
                self[word] = found = hashed(word)
                return found

        self.words = Words()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
        if not words:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, len(words))
        size = min(WORDS, len(h))
        mixed = h[: len(h) - size + 1] + np.uint64(size)
        for k in range(1, size):
            mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ (h[k : len(h) - size + 1 + k] + (mixed >> np.uint64(29)))
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(33)
        return np.unique(mixed)


def _digest(s: np.ndarray) -> tuple[int, int]:
    """The digest of a set, as two longs."""
    return tuple(np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), "<i8").tolist())


def emitted_below(n: int) -> float:
    """Share of the order whose hashes a set of n shingles shows in step 2."""
    return 1.0 if n < LONG_SET else SHARE


def needed(n: Column) -> Column:
    """Least overlap that a link asks of a set of n shingles."""
    return F.ceil(n * LEAST[0] / LEAST[1])


def _row(id_col: str, text_col: str) -> list[Column]:
    """Id, hash of the text, and a hash of both: copies of a row are alike in them."""
    known, told = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col).cast("string"))
    return [known.alias("id"), told.alias("told"), F.xxhash64(known, told).alias("key")]


def shingle_classes(df: DataFrame, id_col: str, text_col: str, at: str) -> tuple[DataFrame, DataFrame]:
    """(id, told, key, n, d1, d2) of every row, and the packed hashes of step 2 by fragment."""
    docs = df.select(*_row(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    fragments = int(min(max(docs.count() // FRAGMENT_DOCS, FRAGMENTS[0]), FRAGMENTS[1]))
    schema = "fragment int, id long, told long, key long, n int, d1 long, d2 long, classes binary, sizes binary, hashes binary"

    def make():
        shingles = Shingler()

        def each(batch: pa.RecordBatch):
            for start in range(0, batch.num_rows, 2_000):
                part = batch.slice(start, 2_000)
                rows: dict[str, list] = {"n": [], "d1": [], "d2": []}
                packs: dict[int, np.ndarray] = {}
                for text in texts(part.column(3)):
                    s = shingles(text)
                    d1, d2 = _digest(s)
                    for k, v in zip(rows, (len(s), d1, d2)):
                        rows[k].append(v)
                    if len(s) and d1 not in packs:
                        packs[d1] = s[s >> _HIGH < np.uint64(int(emitted_below(len(s)) * (1 << 40)))]
                none = [None] * part.num_rows
                yield {"fragment": [-1] * part.num_rows, "id": part.column(0), "told": part.column(1), "key": part.column(2), **rows, "classes": none, "sizes": none, "hashes": none}
                if packs:
                    classes = np.array(list(packs), "<i8")
                    value, owner = np.concatenate(list(packs.values())), np.repeat(np.arange(len(packs)), [len(x) for x in packs.values()])
                    order = np.argsort(value, kind="stable")
                    value, owner = value[order], owner[order]
                    # two classes of a shingle tell as much as all of them: a hot one sends two entries a batch
                    two = np.ones(len(value), bool)
                    two[2:] = value[2:] != value[:-2]
                    value, owner = value[two], owner[two]
                    where = (value % np.uint64(fragments)).astype(np.int64)
                    order = np.lexsort((owner, where))
                    met, cuts = np.unique(where[order], return_index=True)
                    for f, some in zip(met.tolist(), np.split(order, cuts[1:])):
                        who, sizes = np.unique(owner[some], return_counts=True)
                        high = (value[some] >> _HIGH).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
                        yield {"fragment": [f], "id": [None], "told": [None], "key": [None], "n": [None], "d1": [None], "d2": [None], "classes": [classes[who].tobytes()],
                               "sizes": [sizes.astype("<u4").tobytes()], "hashes": [high.tobytes()]}

        return each

    out = stored(map_batches(docs, schema, make), "shingles", at)
    return out.where("fragment < 0").select("id", "told", "key", "n", "d1", "d2"), out.where("fragment >= 0").select("fragment", "classes", "sizes", "hashes")


def missing_counts(packed: DataFrame) -> DataFrame:
    """(d1, missing, missing_low): shown hashes of each class that no other class has, all of them and those under ``SHARE``.

    40 bits of a hash and its fragment tell hashes apart here; a false match only lets a class through to the exact steps.
    """

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        who = np.concatenate([np.repeat(np.frombuffer(c, "<i8"), np.frombuffer(s, "<u4")) for c, s in zip(pdf["classes"], pdf["sizes"])])
        five = np.concatenate([np.frombuffer(h, np.uint8).reshape(-1, 5) for h in pdf["hashes"]])
        wide = np.zeros((len(five), 8), np.uint8)
        wide[:, :5] = five
        value = wide.view("<u8").ravel()
        order = np.lexsort((who, value))
        value, who = value[order], who[order]
        new = np.concatenate([[True], value[1:] != value[:-1]])
        first, last = who[new], who[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(who) - 1]])]
        alone, value = first == last, value[new]
        classes, who = np.unique(first[alone], return_inverse=True)
        low = value[alone] < np.uint64(int(SHARE * (1 << 40)))
        return pd.DataFrame({"d1": classes, "missing": np.bincount(who, minlength=len(classes)), "missing_low": np.bincount(who[low], minlength=len(classes))})

    parts = packed.groupBy("fragment").applyInPandas(count, "d1 long, missing long, missing_low long")
    return parts.groupBy("d1").agg(F.sum("missing").alias("missing"), F.sum("missing_low").alias("missing_low"))


def candidate_sets(df: DataFrame, id_col: str, text_col: str, classes: DataFrame, counts: DataFrame, at: str) -> tuple[DataFrame, DataFrame]:
    """(id, n, hashes): number and sorted full set, once, of every class that can link; (d1, d2, least, id) tells the classes."""
    n = F.col("n")
    whole = F.floor(n * LEAST[1] / LEAST[0]) + 1 < LONG_SET  # every possible partner shows its whole set
    missing = F.coalesce(F.when(whole, F.col("missing")).otherwise(F.col("missing_low")), F.lit(0))
    able = classes.join(counts, "d1", "left").where(missing <= n - needed(n)).select("d1", "d2", "n", "least", "key")
    # numbered in the order of their ids, as the first text of a group is near the others more often than one of its copies
    able = stored(able, "able-classes", at).orderBy(F.col("least").asc_nulls_last(), "d1", "d2")
    able = stored(able.withColumn("id", F.monotonically_increasing_id()), "able", at)
    rows = maybe_among(df.select(*_row(id_col, text_col), F.col(text_col).cast("string").alias("text")), "key", able.select("key")).where("__maybe")

    def make():
        shingles, seen = Shingler(), set()

        def each(batch: pa.RecordBatch):
            for start in range(0, batch.num_rows, 1_000):
                part, out = batch.slice(start, 1_000), {"d1": [], "d2": [], "hashes": []}
                for key, text in zip(part.column(0).to_pylist(), texts(part.column(1))):
                    if key in seen:  # a copy of a row
                        continue
                    if len(seen) >= CACHED_WORDS:
                        seen.clear()
                    seen.add(key)
                    s = shingles(text)
                    for name, v in zip(out, (*_digest(s), s.astype("<u8").tobytes())):
                        out[name].append(v)
                yield out

        return each

    sets = map_batches(rows.select("key", "text"), "d1 long, d2 long, hashes binary", make)
    # rows of one class that pass the bitmap meet here, and one of them stays
    met = sets.join(able.select("d1", "d2", "id", "n"), ["d1", "d2"]).dropDuplicates(["d1", "d2"])
    return stored(met.select("id", "n", "hashes"), "sets", at), able.select("d1", "d2", "least", "id")


def _segments(sets: DataFrame) -> DataFrame:
    """(id, n, segment, part): the set cut at ``SEGMENTS`` equal parts of the order."""
    cuts = np.array([(k << 64) // SEGMENTS for k in range(1, SEGMENTS)], np.uint64)

    def make():
        def each(batch: pa.RecordBatch):
            for start in range(0, batch.num_rows, 1_000):
                out = {"id": [], "n": [], "segment": [], "part": []}
                piece = batch.slice(start, 1_000)
                for i, n, raw in zip(*(piece.column(k).to_pylist() for k in range(3))):
                    s = np.frombuffer(raw, "<u8")
                    for k, seg in enumerate(np.split(s, np.searchsorted(s, cuts))):
                        for name, v in zip(out, (i, n, k, seg.tobytes())):
                            out[name].append(v)
                yield out

        return each

    return map_batches(sets.select("id", "n", "hashes"), "id long, n int, segment int, part binary", make)


def linked(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets link: partial overlaps by segment, summed per pair."""
    near = pairs.join(segments.select(F.col("id").alias("a"), F.col("n").alias("na"), "segment", F.col("part").alias("pa")), "a")
    near = near.join(segments.select(F.col("id").alias("b"), F.col("n").alias("nb"), "segment", F.col("part").alias("pb")), ["b", "segment"])
    near = near.where((F.col("na") * LEAST[1] >= F.col("nb") * LEAST[0]) & (F.col("nb") * LEAST[1] >= F.col("na") * LEAST[0]))

    def make():
        def each(batch: pa.RecordBatch):
            found = [len(np.intersect1d(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), assume_unique=True)) for x, y in zip(batch.column(4), batch.column(5))]
            yield {"a": batch.column(0), "b": batch.column(1), "na": batch.column(2), "nb": batch.column(3), "both": found}

        return each

    partial = map_batches(near.select("a", "b", "na", "nb", "pa", "pb"), "a long, b long, na int, nb int, both long", make)
    total = partial.groupBy("a", "b").agg(F.sum("both").alias("both"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return total.where(F.col("both") * LEAST[1] >= (F.col("na") + F.col("nb") - F.col("both")) * LEAST[0]).select("a", "b")


def _minimum_pairs(sets: DataFrame) -> DataFrame:
    """(a, b): every candidate with the first of those that share a minimum under one of ``KEYS`` permutations."""

    def make():
        draw = np.random.default_rng(0)
        factors = draw.integers(0, 1 << 63, KEYS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

        def each(batch: pa.RecordBatch):
            for start in range(0, batch.num_rows, 1_000):
                part, out = batch.slice(start, 1_000), {"id": [], "slot": [], "key": []}
                for i, raw in zip(*(part.column(k).to_pylist() for k in range(2))):
                    s = np.frombuffer(raw, "<u8")
                    for k, f in enumerate(factors):
                        mixed = s * f
                        mixed ^= mixed >> np.uint64(32)
                        for name, v in zip(out, (i, k, int((mixed * f).min().view(np.int64)))):
                            out[name].append(v)
                yield out

        return each

    keys = map_batches(sets.select("id", "hashes"), "id long, slot int, key long", make)
    first = keys.groupBy("slot", "key").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a != z").drop("z")
    return keys.join(first, ["slot", "key"]).where("a != id").select("a", F.col("id").alias("b")).distinct()


def _unsettled(sets: DataFrame, parts: DataFrame, at: str) -> DataFrame:
    """(id, component, n, h, df) of candidates that may still link beyond their component, with the shingles that they share there."""
    place = parts.withColumnRenamed("component", "known")
    held = sets.join(place, "id", "left").select("id", F.coalesce("known", "id").alias("component"), "n", "hashes")

    def make():
        def each(batch: pa.RecordBatch):
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                arrays = [np.frombuffer(x.as_py(), "<i8") for x in part.column(3)]
                sizes = [len(x) for x in arrays]
                repeat = lambda c: np.repeat(c.to_numpy(zero_copy_only=False), sizes)
                yield {"id": repeat(part.column(0)), "component": repeat(part.column(1)), "n": repeat(part.column(2)), "h": np.concatenate(arrays)}

        return each

    rows = map_batches(held, "id long, component long, n int, h long", make)
    for k in range(2):  # what the first pass settles no longer counts in the second
        several = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
        met = stored(rows.select("id", "component", "n", "h").join(several.select("h", "df"), "h"), f"met-{k}", at)
        open_ = met.groupBy("id").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("nn")).where(F.col("m") >= needed(F.col("nn"))).select("id")
        rows = met.join(open_, "id", "left_semi")
    return stored(rows, "open", at)


def _prefix_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): all pairs across components that share a shingle of both frequency-ordered prefixes.

    A shingle at ``place`` of ``m`` leaves room for an overlap of m - place + 1, so it can be the first that two sets
    share only if their sizes add up to little enough: ``limit`` is the largest partner that it allows a set.  The larger set of a
    pair looks for partners from three quarters of its size up to that limit, by bands of sizes, so sets that share a hot shingle but
    not enough else never meet.
    """
    own = Window.partitionBy("id").orderBy("df", "h")
    m = F.count(F.lit(1)).over(Window.partitionBy("id"))
    # shingles met in one component only come first in the order and take their places in the prefix
    prefix = rows.withColumn("place", F.row_number().over(own)).withColumn("m", m).where(F.col("place") <= F.col("m") - needed(F.col("n")) + 1)
    room = F.floor((F.col("m") - F.col("place") + 1) * sum(LEAST) / LEAST[0]).cast("int")
    prefix = prefix.withColumn("limit", room - F.col("n"))
    sizes = prefix.groupBy("h", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("h").agg(F.max_by("component", F.struct("size", "component")).alias("largest"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    marked = prefix.join(largest, "h").select("h", "id", "component", "n", "m", "place", "limit", (F.col("component") == F.col("largest")).alias("common"))
    band = lambda n: F.floor(F.log(n.cast("double")) / math.log(BAND)).cast("int")
    asking = marked.withColumn("most", F.least("n", "limit")).where(F.col("most") >= needed(F.col("n")))
    asking = asking.select("*", F.explode(F.sequence(band(needed(F.col("n"))), band(F.col("most")))).alias("band")).drop("most")
    asked = marked.where("limit >= n").select("h", band(F.col("n")).alias("band"), *(F.col(c).alias(f"{c}_x") for c in ("id", "component", "n", "m", "place", "limit", "common")))
    # members of the commonest component of a shingle are not set beside one another
    met = asking.where("not common").join(asked, ["h", "band"]).unionByName(asking.where("common").join(asked.where("not common_x"), ["h", "band"]))
    # the overlap that both sizes ask for; shared shingles lie before the place, at it, or after it in either set
    least = F.ceil((F.col("n") + F.col("n_x")) * LEAST[0] / sum(LEAST))
    most = F.least("place", "place_x") + F.least(F.col("m") - F.col("place"), F.col("m_x") - F.col("place_x"))
    pairs = met.where((F.col("component_x") != F.col("component")) & (F.col("n_x") <= F.col("n")) & (F.col("n_x") <= F.col("limit")) & (F.col("n") <= F.col("limit_x")) & (most >= least))
    return pairs.select(F.least("id_x", "id").alias("a"), F.greatest("id_x", "id").alias("b")).distinct()


def _linked_rows(df: DataFrame, id_col: str, text_col: str, at: str) -> DataFrame:
    """(id, told, key, n_shingles, component_id) of every row; ``at`` takes the tables it is read from."""
    rows, packed = shingle_classes(df, id_col, text_col, at)
    classes = rows.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("least"), F.min("key").alias("key"), F.first("n").alias("n"))
    sets, able = candidate_sets(df, id_col, text_col, classes, missing_counts(packed), at)
    segments = stored(_segments(sets), "segments", at)
    found = stored(linked(_minimum_pairs(sets), segments), "links", at)
    parts = stored(components(found, at, "cheap"), "components", at)
    unsettled = _unsettled(sets, parts, at)
    parts = components(found.unionByName(stored(linked(_prefix_pairs(unsettled), segments), "links-exact", at)), at, "exact")
    placed = stored(able.join(parts, "id").select("d1", "d2", "least", "component"), "placed", at)
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "component").select("d1", "d2", "component_id")
    named = classes.join(named, ["d1", "d2"], "left").select("d1", "d2", F.coalesce("component_id", "least").alias("component_id"))
    held = rows.select("id", "told", "key", F.col("n").cast("long").alias("n_shingles"), "d1", "d2")
    one = held.where("n_shingles > 0").join(named, ["d1", "d2"]).drop("d1", "d2")
    return one.unionByName(held.where("n_shingles = 0").drop("d1", "d2").withColumn("component_id", F.col("id")))


def linked_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    return _linked_rows(df, id_col, text_col, shared_dir(df.sparkSession, "shingle-join")).select("id", "n_shingles", "component_id")


def first_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose id is the smallest of their text's component, with its columns and no others."""
    at = shared_dir(df.sparkSession, "shingle-join")
    found = _linked_rows(df, id_col, text_col, at)
    gone = stored(found.where(~F.col("id").eqNullSafe(F.col("component_id"))).select("id", "told", "key").distinct(), "linked")
    delete(df.sparkSession, at)  # the rows that go are all that is read on
    flagged = maybe_among(df.select(F.struct("*").alias("row"), *_row(id_col, text_col)), "key", gone.select("key"))
    there = gone.select(F.col("id").alias("gone_id"), F.col("told").alias("gone_told"))
    left = flagged.where("__maybe").join(there, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("told") == F.col("gone_told")), "left_anti")
    return flagged.where("not __maybe").select("row.*").unionByName(left.select("row.*"))


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_components(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")
