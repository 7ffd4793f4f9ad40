"""Byte-level BPE encoding and decoding by a contiguous rank array (operator 3).

A short word is held as three parallel lists: the part boundaries, the token id
of each part and the merge rank of each adjacent pair.  The smallest rank is
found by a scan, the boundary between its two parts is deleted and the ranks of
the two neighbouring pairs are refreshed, until no pair has a rank.  Words
longer than ``SHORT_WORD`` bytes, for which the scans would be quadratic, take
the same merges in the same order from a heap.

Every text is split by the public pre-tokenizer pattern; each worker remembers
the ids of the words it has seen in a dictionary of bounded size.

Defined cases: a null text counts as empty and gives no ids; the strings of
added tokens become their ids; very long words and texts are encoded whole;
repeated rows are encoded each; an empty table gives an empty result; other
columns are dropped, so their names cannot clash.
"""

from __future__ import annotations

import heapq
import json
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailcheck.llm.common import documents, fields, map_batches, texts

#: Fixed value: the published pre-tokenizer pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SHORT_WORD = 256
CACHED_WORDS = 600_000
NO_RANK = 1 << 30


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next letter from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in set(printable))
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Tokens(dict):
    """Ids (bytes of little-endian uint32) by pre-token."""

    def __init__(self, codec: "RankArrayBPE"):
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.codec.encode_word(word.encode("utf-8", "surrogatepass"))).tobytes()
        if len(word) <= 64:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


class RankArrayBPE:
    """Encoder and decoder for a byte-level BPE vocabulary in the ``tokenizers`` JSON layout."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        back = {c: b for b, c in letters.items()}
        self.pieces = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.merged: list[int] = []
        self.ranks: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[left], vocab[right]] = rank
            self.merged.append(vocab[left + right])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces |= {i: t.encode() for t, i in self.added.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.pattern = regex.compile(PATTERN)
        self.tokens = _Tokens(self)

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        if len(word) > SHORT_WORD:
            return self._encode_long(word)
        rank = self.ranks.get
        ids = [self.byte_ids[b] for b in word]
        bounds = list(range(len(word) + 1))
        ranks = [rank(pair, NO_RANK) for pair in zip(ids, ids[1:])]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            at = ranks.index(least)
            ids[at] = self.merged[least]
            del ids[at + 1], bounds[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank((ids[at - 1], ids[at]), NO_RANK)
            if at < len(ranks):
                ranks[at] = rank((ids[at], ids[at + 1]), NO_RANK)
        return ids

    def _encode_long(self, word: bytes) -> list[int]:
        ids: list[int | None] = [self.byte_ids[b] for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(r, i) for i, pair in enumerate(zip(ids, ids[1:])) if (r := self.ranks.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            nxt = after[at]
            if ids[at] is None or nxt >= len(ids) or self.ranks.get((ids[at], ids[nxt])) != rank:
                continue  # an earlier merge took one of the two parts
            ids[at], ids[nxt] = self.merged[rank], None
            after[at] = after[nxt]
            if after[at] < len(ids):
                before[after[at]] = at
                if (r := self.ranks.get((ids[at], ids[after[at]]))) is not None:
                    heapq.heappush(heap, (r, at))
            if before[at] >= 0 and (r := self.ranks.get((ids[before[at]], ids[at]))) is not None:
                heapq.heappush(heap, (r, before[at]))
        return [i for i in ids if i is not None]

    def encode_piece(self, text: str) -> bytes:
        """Ids of a text without added tokens, through the pre-tokenizer pattern."""
        tokens = self.tokens
        return b"".join([tokens[word] for word in self.pattern.findall(text)])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if self.cut is None or not any(t in text for t in self.added):
            return self.encode_piece(text)
        parts = self.cut.split(text)
        return b"".join(array("I", [self.added[p]]).tobytes() if i % 2 else self.encode_piece(p) for i, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        """Text of the ids; bytes that are not UTF-8 become replacement characters."""
        return b"".join(map(self.pieces.__getitem__, array("I", ids))).decode("utf-8", "replace")


def _codec(path: str) -> RankArrayBPE:
    """One codec a worker process and vocabulary."""
    held = _codec.__dict__.setdefault("held", {})
    if path not in held:
        held[path] = RankArrayBPE(path)
    return held[path]


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids of every whole text as little-endian uint32 bytes."""

    def make():
        codec = _codec(path)

        def each(batch: pa.RecordBatch):
            ids = [codec.encode(t) for t in texts(batch.column(1))]
            yield {"doc_id": batch.column(0), "n_tokens": [len(x) // 4 for x in ids], "ids": ids}

        return each

    return map_batches(df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), "doc_id long, n_tokens long, ids binary", make)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of the rows that ``encode_documents`` returns."""

    def make():
        codec = _codec(path)

        def each(batch: pa.RecordBatch):
            yield {"doc_id": batch.column(0), "text": [codec.decode(x.as_py() or b"") for x in batch.column(1)]}

        return each

    return map_batches(encoded.select("doc_id", "ids"), "doc_id long, text string", make)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): ``encode_documents`` and ``decode_documents`` in one pass over the texts."""

    def make():
        codec = _codec(path)

        def each(batch: pa.RecordBatch):
            step = 500  # bounds what a worker holds beside the batch
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = [codec.encode(t) for t in texts(part.column(1))]
                yield {"doc_id": part.column(0), "n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [codec.decode(x) for x in ids]}

        return each

    return map_batches(df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), "doc_id long, n_tokens long, ids binary, decoded string", make)


def count_tokens(df: DataFrame, path: str, keep: list[str], text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    """The columns ``keep`` and the encoded length of every whole text; the texts stay in the task."""
    kept = df.select(*keep, F.col(text_col).cast("string").alias("__text"))

    def make():
        codec = _codec(path)

        def each(batch: pa.RecordBatch):
            lengths = [len(codec.encode(t)) // 4 for t in texts(batch.column(len(keep)))]
            yield {**{k: batch.column(i) for i, k in enumerate(keep)}, out: lengths}

        return each

    return map_batches(kept, fields(df, keep, f"`{out}` long"), make)


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = round_trip(documents(spark, sf_dir), vocabulary_path())
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
