"""Token ids in binary files of independent zstandard frames (operator 4).

Documents are dealt by ranges of ``doc_id`` and sorted in each range, so every
task writes one file and the files in order hold the corpus in ascending
``doc_id``.  A file is a run of zstandard frames and a seek table:

* data frames: ids as little-endian uint32, whole documents up to ``FRAME_IDS`` ids a frame (a longer
  document has a frame of its own);
* an index frame: for each document its doc_id (int64), a null flag (uint8) and its number of ids (uint64);
* the seek table in a skippable frame: for each frame its compressed size, its size and the low 32 bits of the
  xxh64 of its content, then the number of frames, a descriptor byte and the closing magic number.

A reader takes the table from the file's end, then the index, then only the
frames of the documents asked for, and checks each frame it opens.

Files are written under names of their own attempt; the manifest, which Spark
writes from the successful attempts, says which count, so a lost executor or a
repeated task leaves at most an unused file.  Global offsets come from the
manifest: one row a file.

Defined cases: a null or empty text has only the end id; rows that share a
doc_id are ordered by text and each kept; a null doc_id comes first; an empty
table writes no file; very long documents are whole; other columns are ignored.
"""

from __future__ import annotations

import gc
import os
import string
import struct
import unicodedata
import uuid
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.bpe import byte_letters, vocabulary_path
from trailcheck.llm.common import documents, map_batches, shared_dir, ship, stored, texts

END_ID = 1
FRAME_IDS = 1 << 16
CACHED_WORDS = 700_000
LATIN_END = "\u0250"  # lower-case letters before it are the same in every form and version of Unicode
#: Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC, SEEK_MAGIC, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80


class WordwiseEncoder:
    """Ids by the ``tokenizers`` library for vocabularies that drop white space, each distinct word encoded once.

    A token of such a vocabulary never spans ASCII white space, so a text's ids are those of its words in a row;
    letters followed by ASCII punctuation are two pre-tokens and are looked up apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.byte_letters = self.tokenizer.model, byte_letters()
        vocab = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocab.values()) + 1, bool)
        self.word_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        pieces, known = self.pieces, self.words
        cores: dict[str, str] = {}
        for w in words:
            core = w.rstrip(string.punctuation)
            if core.isalpha():
                if core.isascii():
                    core = core.lower()
                elif not core.lower().isalpha() or not unicodedata.is_normalized("NFC", core):
                    core = w
            else:
                core = w
            cores[w] = core
        tails = {w[len(core):] for w, core in cores.items() if len(core) != len(w)}
        new = [p for p in tails.union(cores.values()) if p not in pieces]
        self._learn_letters([p for p in new if p.isalpha() and p.lower().isalpha()])
        other = [p for p in new if p not in pieces]
        for p, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
            pieces[p] = np.array(e.ids, "<u4").tobytes()
        for w, core in cores.items():
            n = len(core)
            known[w] = pieces[core] if len(w) == n else pieces[core] + pieces[w[n:]]

    def _learn_letters(self, words: list[str]) -> None:
        """Words of letters are one pre-token each.  Where the normaliser leaves them as they are, the library's model takes
        them at once, in the letters of their bytes; of the others many go through one call, as the last id alone is a word end."""
        pieces, tokenize, letters = self.pieces, self.model.tokenize, self.byte_letters
        others = []
        for w in words:
            if w.isascii() and w.islower():
                spelled = w
            elif w == w.lower() and max(w) < LATIN_END:
                spelled = "".join([letters[b] for b in w.encode()])
            else:
                others.append(w)
                continue
            pieces[w] = array("I", [t.id for t in tokenize(spelled)]).tobytes()
        for at in range(0, len(others), 2000):
            some = others[at : at + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) == len(some):
                for w, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist()):
                    pieces[w] = ids[a:b].tobytes()

    def encode_all(self, batch: list[str]) -> list[bytes]:
        # the vocabulary's normaliser lower-cases; doing so at once where it is plain leaves fewer distinct words
        batch = [t.lower() if t.isascii() and "<|" not in t else t for t in batch]
        split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in batch]
        for held in (self.words, self.pieces):
            if len(held) > CACHED_WORDS:
                held.clear()
        if new := set().union(*split).difference(self.words):
            self._learn(new)
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in split]


def _encoder(path: str) -> WordwiseEncoder:
    held = _encoder.__dict__.setdefault("held", {})
    if path not in held:
        held[path] = WordwiseEncoder(path)
        gc.freeze()
        gc.set_threshold(100_000, 50, 50)  # the caches are large and hold no cycles
    return held[path]


class FrameWriter:
    """Writes documents in order into one file of frames."""

    def __init__(self, sink):
        import xxhash
        import zstandard

        self.sink, self.hash = sink, xxhash.xxh64_intdigest
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.table: list[tuple[int, int, int]] = []
        self.waiting: list[bytes] = []
        self.size = 0
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > 4 * FRAME_IDS:
            self._flush()
        self.waiting.append(ids)
        self.size += len(ids)
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        if self.size >= 4 * FRAME_IDS:
            self._flush()

    def _frame(self, content: bytes) -> None:
        packed = self.compressor.compress(content)
        self.sink.write(packed)
        self.table.append((len(packed), len(content), self.hash(content) & 0xFFFFFFFF))

    def _flush(self) -> None:
        if self.waiting:
            self._frame(b"".join(self.waiting))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        self._flush()
        known = np.array([i if i is not None else 0 for i in self.ids], "<i8")
        nulls = np.array([i is None for i in self.ids], "u1")
        self._frame(known.tobytes() + nulls.tobytes() + np.array(self.counts, "<u8").tobytes())
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), WITH_CHECKSUMS, SEEK_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.sink.close()


class FrameReader:
    """Reads documents of one file, opening only the frames that hold them."""

    def __init__(self, source, length: int):
        import xxhash
        import zstandard

        self.source, self.hash = source, xxhash.xxh64_intdigest
        self.decompressor = zstandard.ZstdDecompressor()
        source.seek(length - 9)
        n, _, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError("the file has no seek table")
        source.seek(length - 9 - 12 * n)
        self.table = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        index = self.frame(n - 1)
        m = len(index) // 17
        self.doc_ids = np.frombuffer(index[: 8 * m], "<i8")
        self.nulls = np.frombuffer(index[8 * m : 9 * m], "u1").astype(bool)
        self.counts = np.frombuffer(index[9 * m :], "<u8").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.frame_starts = np.concatenate([[0], np.cumsum(self.table[: n - 1, 1])]) // 4
        self.opened = (-1, b"")

    def frame(self, k: int) -> bytes:
        size, content, check = (int(x) for x in self.table[k])
        self.source.seek(int(self.at[k]))
        out = self.decompressor.decompress(self.source.read(size), max_output_size=content)
        if len(out) != content or self.hash(out) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} does not match its checksum")
        return out

    def document(self, i: int) -> bytes:
        """Ids of the i-th document of the file."""
        k = int(np.searchsorted(self.frame_starts, self.starts[i], "right")) - 1
        if self.opened[0] != k:
            self.opened = (k, self.frame(k))
        at = 4 * int(self.starts[i] - self.frame_starts[k])
        return self.opened[1][at : at + 4 * int(self.counts[i])]

    def __iter__(self) -> Iterator[tuple[int | None, int, bytes]]:
        for i in range(len(self.counts)):
            yield (None if self.nulls[i] else int(self.doc_ids[i])), int(self.starts[i]), self.document(i)


def write_token_files(df: DataFrame, path: str, to: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, append the end id, write one file a range of ``doc_id`` into the folder ``to``; return the stored manifest.

    Manifest: part (order of the files), file, n_docs, n_ids.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([END_ID], "<u4").tobytes()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        encoder, writer, part = _encoder(path), None, TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                piece = batch.slice(at, 500)
                for doc_id, ids in zip(piece.column(0).to_pylist(), encoder.encode_all(list(texts(piece.column(1))))):
                    if writer is None:
                        where, base = fs.FileSystem.from_uri(to)
                        where.create_dir(base, recursive=True)
                        name = f"{part:06d}-{uuid.uuid4().hex}.zst"
                        writer = FrameWriter(where.open_output_stream(f"{base}/{name}", compression=None))
                    writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "file": [name], "n_docs": pa.array([len(writer.counts)], pa.int64()),
                                              "n_ids": pa.array([sum(writer.counts)], pa.int64())})

    ship(df.sparkSession)
    dealt = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stored(dealt.mapInArrow(write, "part long, file string, n_docs long, n_ids long"), "manifest", to)


def read_token_files(manifest: DataFrame, at: str) -> DataFrame:
    """(doc_id, start, ids) of every document, from the files that the manifest names."""
    spark = manifest.sparkSession
    files = sorted(manifest.collect(), key=lambda r: r["part"])  # one row a file
    base, rows = 0, []
    for r in files:
        rows.append((r["file"], base))
        base += r["n_ids"]
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, ids binary")
    listed = spark.createDataFrame(rows, "file string, base long").repartition(len(rows))

    def make():
        from pyarrow import fs

        where, folder = fs.FileSystem.from_uri(at)

        def each(batch: pa.RecordBatch):
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                info = where.get_file_info(f"{folder}/{name}")
                with where.open_input_file(info.path) as source:
                    ids, starts, found = [], [], []
                    for doc_id, start, content in FrameReader(source, info.size):
                        ids.append(doc_id), starts.append(base + start), found.append(content)
                        if len(ids) == 500:
                            yield {"doc_id": ids, "start": starts, "ids": found}
                            ids, starts, found = [], [], []
                    if ids:
                        yield {"doc_id": ids, "start": starts, "ids": found}

        return each

    return map_batches(listed, "doc_id long, start long, ids binary", make)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = shared_dir(spark, "tokens")
    manifest = write_token_files(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"), to)
    return read_token_files(manifest, to).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
