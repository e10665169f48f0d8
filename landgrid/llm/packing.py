"""Packing tokenised documents into fixed windows by best-fit decreasing.

1. Every document is tokenised whole, in Arrow batches, and cut into full
   windows and a rest; a piece's ids stay with its document, only their number
   and checksum travel on.
2. Best-fit decreasing needs the pieces' lengths alone. There are at most
   ``window`` different ones, so the packing is computed on their histogram: a
   segment tree indexed by remaining capacity finds the tightest open window, and
   equal pieces are placed run by run. The plan's size depends on the number of
   lengths, not on the number of documents.
3. Each piece gets its rank among the pieces of its length (salted, so that a
   length that a third of all pieces have is dealt over many tasks) and looks its
   place up in the plan.

Defined results: null text counts as empty, an empty document is its end id
alone; repeated rows are packed each on their own; an empty table gives no
rows; sequence ids are dense from 0 and the same on each run.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrid.llm.common import written

WINDOW = 4096
END_ID = 2
#: Chunks of a worker's memo (chunk -> ids), over two generations; the younger one's words come on top.
MEMO = 600_000
#: Bytes of text that are split at a time.
SPLIT_BYTES = 1 << 20
#: Rows of one length that one task may rank.
RANKED = 1 << 20
#: A length is dealt over this many tasks at least.
SALTS = 64

PIECE_FIELDS = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]


#: A line of Latin letters, perhaps with punctuation at the end (two units of the word pattern, apart by definition), or any other.
_LINE = re.compile("^(?:([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)|.+)$", re.M)
WORD_END = "</w>"
#: Words put into one call of the tokenizer.
CALL = 1024
#: Every letter of ``_LINE`` in lower case: what ``_bare`` is tried on.
_PROBE = "abcdefghijklmnopqrstuvwxyz word packing " + " ".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))


def _bare(tokenizer):
    """The tokenizer's model behind a split at white space, for lower-case words of letters alone: no normalising, no pattern.

    The tokenizer itself where the two differ on such words.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(tokenizer.model)
    bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    same = bare.encode(_PROBE, add_special_tokens=False).ids == tokenizer.encode(_PROBE, add_special_tokens=False).ids
    return bare if same else tokenizer


class Encoder:
    """ids of whole texts as bytes of little-endian unsigned 32-bit numbers.

    With ``chunked``, texts are cut at ASCII white space and each different chunk
    is encoded once: right for tokenizers that drop white space and never join
    what it separates. Chunks of letters and closing punctuation are put together
    from their two parts; new words are encoded in one call and told apart by the
    ids that end a word. A memo of two generations keeps what texts still use:
    when the younger is full it becomes the elder, whose chunks come back as they
    are met. What is kept never changes the ids.
    """

    def __init__(self, path: str, chunked: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.chunked = Tokenizer.from_file(path), chunked
        self.bare = _bare(self.tokenizer)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.memo: dict[bytes, bytes] = {}
        self.elder: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _encode(self, texts: list[str], by=None) -> list[bytes]:
        by = by or self.tokenizer
        return [np.array(e.ids, "<u4").tobytes() for e in getattr(by, "encode_batch_fast", by.encode_batch)(texts, add_special_tokens=False)]

    def _words(self, new: list[str]) -> dict[str, bytes]:
        """Words of letters alone: each ends with the one id that ends a word."""
        found = {}
        for a in range(0, len(new), CALL):
            part = new[a : a + CALL]
            flat = self._encode([" ".join(part)], self.bare)[0]
            cuts = 4 * (np.flatnonzero(self.ends[np.frombuffer(flat, "<u4")]) + 1)
            if len(cuts) != len(part) or cuts[-1] != len(flat):
                found.update(zip(part, self._encode(part)))
                continue
            ends = cuts.tolist()
            found.update(zip(part, [flat[i:j] for i, j in zip([0, *ends], ends)]))
        return found

    def _learn(self, new: list[bytes]) -> None:
        parts = [(w.lower(), t) for w, t in _LINE.findall(b"\n".join(new).decode())]
        words = self.words
        words.update(self._words(list({w for w, _ in parts if w}.difference(words))))
        tails = list({t for _, t in parts})
        tail = dict(zip(tails, self._encode(tails)))
        self.memo.update(zip(new, [words[w] + tail[t] if w else b"" for w, t in parts]))
        other = [c for c, (w, _) in zip(new, parts) if not w]
        self.memo.update(zip(other, self._encode([c.decode() for c in other])))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.chunked:
            return self._encode([t.decode() for t in texts])
        split = [t.split() for t in texts]
        if len(self.memo) > MEMO // 2:
            self.memo, self.elder, self.words = {}, self.memo, {}
        new: set[bytes] = set()
        for chunks in split:
            new.update(chunks)
        new.difference_update(self.memo)
        known = [c for c in new if c in self.elder]
        if known:
            self.memo.update(zip(known, map(self.elder.__getitem__, known)))
            new.difference_update(known)
        if new:
            self._learn(list(new))
        get = self.memo.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]


@lru_cache(maxsize=1)
def encoder(path: str, chunked: bool) -> Encoder:
    """The encoder that a worker keeps from task to task."""
    return Encoder(path, chunked)


def _by_size(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    at = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= SPLIT_BYTES:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def pieces(docs: DataFrame, text_col: str, tokenizer: str, window: int = WINDOW, end_id: int = END_ID, chunked: bool = True) -> DataFrame:
    """One row per piece: the other columns of docs, start, length, ids_crc32, doc_tokens."""
    keep = [c for c in docs.columns if c != text_col and c not in dict(PIECE_FIELDS)]
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, chunked)
        for batch in batches:
            texts = [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
            rows, starts, lengths, sums, totals = [], [], [], [], []
            for a, b in _by_size(texts):
                for i, ids in enumerate(encode(texts[a:b]), a):
                    ids += end
                    n = len(ids) // 4
                    for at in range(0, n, window):
                        part = ids[4 * at : 4 * (at + window)]
                        rows.append(i)
                        starts.append(at)
                        lengths.append(len(part) // 4)
                        sums.append(zlib.crc32(part))
                        totals.append(n)
            taken = pa.Table.from_batches([batch.select(range(len(keep)))]).take(pa.array(rows, pa.int64())) if keep else None
            columns = [taken.column(c).combine_chunks() for c in range(len(keep))] if keep else []
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(v, pa.int64()) for v in (starts, lengths, sums, totals))], names=[*keep, *dict(PIECE_FIELDS)])

    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.LongType()) for n, _ in PIECE_FIELDS])
    return docs.select(*keep, text_col).mapInArrow(run, schema)


class CapacityTree:
    """Segment tree over remaining capacity: how many open windows each has; finds the tightest that fits."""

    def __init__(self, window: int):
        self.size = 1 << (window + 1).bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += n
            i //= 2

    def tightest(self, length: int) -> int:
        """The smallest capacity of at least length with an open window, or -1."""
        i = length + self.size
        if self.count[i]:
            return length
        while i > 1:
            if i % 2 == 0 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return -1


def best_fit_plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths.

    Returns runs (length, first rank, pieces a window, first sequence, offset): the
    piece of rank r in a run lies in sequence first + (r - rank) // k at
    offset + (r - rank) % k * length. Runs are sorted by length and rank.
    """
    tree, open_runs = CapacityTree(window), {}
    plan: list[tuple[int, int, int, int, int]] = []
    next_sequence = 0

    def leave(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            open_runs.setdefault(capacity, []).append((first, n))
            tree.add(capacity, n)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity < 0:
                capacity, first, n = window, next_sequence, -(-left // (window // length))
                next_sequence += n
            else:
                first, n = open_runs[capacity].pop()
                tree.add(capacity, -n)
            k = min(capacity // length, left)
            used = min(n, left // k)
            plan.append((length, rank, k, first, window - capacity))
            leave(capacity - k * length, first, used)
            leave(capacity, first + used, n - used)
            rank, left = rank + used * k, left - used * k
    return sorted(plan)


def pack(found: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add sequence_id and offset to a table of pieces."""
    spark = found.sparkSession
    histogram = {r[0]: r[1] for r in found.groupBy("length").count().collect()}  # at most window rows
    plan = best_fit_plan(histogram, window)
    salts = max(SALTS, -(-max(histogram.values(), default=0) // RANKED))
    order = [c for c in found.columns if c not in ("length", "_salt")]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    before = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = before.select("length", "_salt", (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)).cast("long") - 1
    ranked = salted.withColumn("_own", own).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_own") + F.col("_before")).select(*found.columns, "_rank")
    keys = [(p[0], p[1]) for p in plan]
    table = np.array([p[2:] for p in plan], np.int64).reshape(-1, 3)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.fromiter((bisect_right(keys, key) - 1 for key in zip(lengths.tolist(), ranks.tolist())), np.int64, len(ranks))
            k, first, offset = table[at].T if len(at) else np.zeros((3, 0), np.int64)
            inside = ranks - np.fromiter((keys[i][1] for i in at), np.int64, len(at))
            got = [pa.array(first + inside // np.maximum(k, 1)), pa.array(offset + inside % np.maximum(k, 1) * lengths)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *got], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType([*found.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and offset."""
    return pack(written(pieces(docs.select(id_col, text_col), text_col, tokenizer, window), "pieces"), window)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece of every row of ``documents`` with its place."""
    from landgrid.llm.common import table

    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
