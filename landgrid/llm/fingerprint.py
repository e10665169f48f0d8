"""Document fingerprints by consistent weighted sampling.

A text's terms are its five-word shingles, a term's weight is how often it
occurs. For each of ``samples`` positions every weighted term draws, from
Gamma(2,1), Gamma(2,1) and uniform variates that depend on the term alone, a
quantised weight and a hash value; the term with the least value is the sample.
Two texts agree in a position with probability equal to the generalised Jaccard
similarity (sum of least weights over sum of greatest weights) of their terms.

The three variates of a term come from three independent tables, each indexed by
other bits of the term's 64-bit hash, so that nothing is drawn per document.

Defined results: null counts as empty; a text with fewer words than a shingle is
one term; a text without words has the fingerprint "" and likeness 1 to another
such text, 0 to any other. Repeated ids are put in order by their text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHINGLE = 5
SAMPLES = 128
#: Rows of each table of variates; three tables, so as many terms as their product.
TABLE_ROWS = 4096
SEED = 20240131
#: Terms that are sampled at a time.
BLOCK = 1024
#: Entries of a worker's memo of word -> hash.
MEMO = 200_000
#: Text that one task puts in order.
BUCKET_BYTES = 16 << 20
#: Buckets at most; beyond, each is larger (a task reads its bucket in order and holds two texts).
MOST_BUCKETS = 4096
#: Characters of a text that tell buckets apart where ids repeat.
TIE = 64

_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    h = (h ^ (h >> _S33)) * _MIX1
    h = (h ^ (h >> _S33)) * _MIX2
    return h ^ (h >> _S33)


class WordHashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self):
        import xxhash

        self.hash, self.memo = xxhash.xxh64_intdigest, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = self.hash(w)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hash of each window of k words; of all words where there are fewer."""
    n = len(hashes)
    k = min(k, n)
    if not n:
        return hashes
    out = np.zeros(n - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * _MIX1 + hashes[i : n - k + 1 + i]
        return mixed(out + np.uint64(k))


class Sampler:
    """Consistent weighted samples of weighted terms."""

    def __init__(self, samples: int = SAMPLES, seed: int = SEED):
        rng = np.random.RandomState(seed)
        shape = (TABLE_ROWS, samples)
        self.samples = samples
        self.r = rng.gamma(2.0, 1.0, shape).astype("f4")
        self.log_c = np.log(rng.gamma(2.0, 1.0, shape)).astype("f4")
        self.beta = rng.uniform(0.0, 1.0, shape).astype("f4")

    def __call__(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """16 bits of each position's sample; terms must be distinct and not empty."""
        least = np.full(self.samples, np.inf, "f4")
        chosen, level = np.zeros(self.samples, np.int64), np.zeros(self.samples, "f4")
        position = np.arange(self.samples)
        for a in range(0, len(terms), BLOCK):
            part, w = terms[a : a + BLOCK], weights[a : a + BLOCK]
            r = self.r[(part & np.uint64(0xFFF)).astype(np.int64)]
            beta = self.beta[((part >> np.uint64(12)) & np.uint64(0xFFF)).astype(np.int64)]
            value = self.log_c[((part >> np.uint64(24)) & np.uint64(0xFFF)).astype(np.int64)]
            many = np.flatnonzero(w > 1)
            t = np.floor(np.log(w[many].astype("f4"))[:, None] / r[many] + beta[many])
            beta -= 1
            beta[many] -= t
            value += r * beta
            at = value.argmin(0)
            low = value[at, position]
            better = low < least
            least[better] = low[better]
            chosen[better] = a + at[better]
            where = np.full(len(part), -1)
            where[many] = np.arange(len(many))
            row = where[at]
            level[better] = np.where(row >= 0, t[row, position] if len(many) else 0.0, 0.0)[better]
        with np.errstate(over="ignore"):
            out = mixed(terms[chosen] + level.astype(np.int64).astype(np.uint64) * _MIX2)
        return (out >> np.uint64(48)).astype(np.uint16)


class Fingerprinter:
    """Samples of a text, and their form as text."""

    def __init__(self, samples: int = SAMPLES, shingle: int = SHINGLE):
        self.hashes, self.sampler, self.shingle = WordHashes(), Sampler(samples), shingle

    def __call__(self, text: bytes) -> np.ndarray:
        terms = shingles(self.hashes(text.lower().split()), self.shingle)
        if not len(terms):
            return np.zeros(0, np.uint16)
        return self.sampler(*np.unique(terms, return_counts=True))


def as_text(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of positions that agree: the estimate of generalised Jaccard similarity."""
    if len(a) != len(b):
        return 0.0
    return float((a == b).mean()) if len(a) else 1.0


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", samples: int = SAMPLES, shingle: int = SHINGLE) -> DataFrame:
    """Add the fingerprint of each text; a map, without any shuffle."""

    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        make = Fingerprinter(samples, shingle)
        for batch in texts:
            yield pa.array([as_text(make((t or "").encode())) for t in batch.to_pylist()], pa.string())

    of = F.arrow_udf(of, T.StringType())
    return docs.withColumn(out, of(F.coalesce(F.col(text_col), F.lit(""))))


def _in_order(docs: DataFrame, bucket_bytes: int) -> DataFrame:
    """Rows (doc_id, text, _bucket, _helper) dealt by ranges of doc_id, and of text where ids repeat, and sorted.

    Each bucket ends with a helper row, a copy of the next bucket's first row (the
    first row of all in the last), so each task sees every row's successor. Only
    the buckets' first keys (an id and TIE characters of MOST_BUCKETS buckets at most)
    pass the driver; text is shuffled once.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    tie = F.substring(F.coalesce("text", F.lit("")), 1, TIE)
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"]
    n = min(MOST_BUCKETS, max(1, -(-int(size or 0) // bucket_bytes)))

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            if len(batch):
                k, t = batch.column(0).to_numpy(), batch.column(1)
                at = np.flatnonzero(k == k.min())
                own = (int(k[at[0]]), min(t.take(pa.array(at)).to_pylist()).encode())
                found = own if found is None else min(found, own)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([found[0]], pa.int64()), pa.array([found[1].decode()])], names=["k", "t"])

    light = docs.select(key.alias("k"), tie.alias("t"))
    firsts = light.repartitionByRange(n, "k", "t").mapInArrow(least, "k long, t string").collect()
    first, *bounds = sorted((r["k"], r["t"].encode()) for r in firsts) or [None]
    last = len(bounds)

    def places(ids: pa.Array, ties: pa.Array) -> pa.Array:
        """Its bucket, and for a first row the bucket that it closes."""
        out = []
        for own in zip(ids.to_pylist(), (t.encode() for t in ties.to_pylist())):
            b = bisect_right(bounds, own)
            out.append([b, b - 1] if b and bounds[b - 1] == own else [b, last] if own == first else [b])
        return pa.array(out, pa.list_(pa.int32()))

    placed = F.arrow_udf(places, T.ArrayType(T.IntegerType()))
    rows = docs.select("doc_id", "text", F.posexplode(placed(key, tie)).alias("_pos", "_bucket"))
    rows = rows.select("doc_id", "text", "_bucket", (F.col("_pos") == 1).alias("_helper"))
    return rows.repartitionById(last + 1, "_bucket").sortWithinPartitions("_bucket", "_helper", F.col("doc_id").asc_nulls_first(), "text")


def edited_fingerprints(docs: DataFrame, samples: int = SAMPLES, shingle: int = SHINGLE, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """For columns doc_id and text: fingerprints of each text and of its edited form, and their likeness.

    The edited text has its last half replaced by the start of the next document
    in order of doc_id (null first, ties by text; after the last comes the first).
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter(samples, shingle)
        before = None
        for batch in batches:
            out = []
            for doc_id, text, _, helper in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                now = make(text.encode()) if before is not None or not helper else None
                if before is not None:
                    old_id, old, own = before
                    cut = len(old) // 2
                    edited = (old[: len(old) - cut] + text[:cut]).encode()
                    other = make(edited)
                    out.append((old_id, len(old), hashlib.sha256(edited).hexdigest(), as_text(own), as_text(other), likeness(own, other), likeness(own, now)))
                before = None if helper else (doc_id, text, now)
            columns = list(zip(*out)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in schema.split(", ")])

    return _in_order(docs.select("doc_id", "text"), bucket_bytes).mapInArrow(run, schema)


def op10_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every row of ``documents`` and of its edited text."""
    from landgrid.llm.common import table

    return edited_fingerprints(table(spark, sf_dir, "documents"))
