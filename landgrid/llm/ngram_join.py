"""Exact Jaccard self-join over word n-grams by partitioned universes and pigeonholes.

1. A text's set is its distinct word n-grams, hashed to 64 bits. Equal sets are one
   node from then on, so exact copies cost nothing more.
2. Sets fall into bands of size. For a band, H bounds the symmetric difference of
   two sets that qualify; the universe of n-grams is hashed into m > H segments,
   and a set's subset of one segment is one index key. Two sets within H agree in
   at least m - H segments. Empty subsets are no keys; a set with more of them
   than m - H - 1 can spare (cost-based allocation: only such a set) also gives the
   one-deletion neighbourhoods of its segments, and where its n-grams crowd into so
   few segments that even these don't suffice, every n-gram as a key.
3. The nodes that share a key are a unit of work (the same nodes only once, however
   many keys they share); large ones are cut into chunks. In a chunk, parity
   sketches (their Hamming distance never exceeds the symmetric difference) leave
   the pairs that may qualify, and of these the least spanning forest goes to exact
   verification; components follow by contraction.
4. A second pass looks at all pairs of different components that share a unit,
   chunk against chunk. The nodes of pairs that may still qualify meet with their
   whole sets, units that overlap as one family, each pair of chunks in a task of its
   own. They are verified there, and only links that join two components leave: at
   most one less than the nodes. So no link between components is lost, and neither
   pairs within a component nor pairs that fail are ever listed.

Keys that many texts have are found in a sample and dealt by salt besides; the sample
decides how work is dealt, never what is compared.

Defined results: a text with fewer words than n has its whole sequence as one
n-gram; null text or one without words has no set and links with nothing;
repeated rows and equal texts share a component; a null id counts as greater than
any other. An empty table gives no rows. Texts are read whole, whatever their
length; only the id and the text column are read, and ``keep_one`` passes the others
through, so their names don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landgrid.llm.common import release, scratch_mark, table, written
from landgrid.llm.fingerprint import WordHashes, mixed, shingles

#: Ratio of a band's bounds.
BAND = 1.3
#: Nodes of one key that are compared in one piece, by sketches.
UNIT = 2048
#: Nodes, and bytes of their sets, that are verified in one piece.
MEET, MEET_BYTES = 1024, 16 << 20
#: Texts of the sample that tells which keys are dealt by salt besides, how often such a key occurs there, and the salts.
SAMPLE, OFTEN, SALTS = 4000, 40, 64
#: Bits of a parity sketch for each element that two sets may differ by.
SKETCH_BITS = 8
#: So many times finer are the sketches that are made where whole sets meet.
FINER = 4
#: Units that a task remembers, to give each different one once.
REMEMBERED = 1 << 20
#: Ids that are sent to all executors at once; beyond, texts meet them by a shuffle.
BROADCAST_ROWS = 2_000_000
_U = np.uint64


@dataclass(frozen=True)
class Scheme:
    """n-grams of ``n`` words, similarity of ``percent`` or more; the bands and their segments."""

    n: int = 5
    percent: int = 80

    def differ(self, total):
        """The greatest symmetric difference of two qualifying sets whose sizes add up to total."""
        return total - 2 * -(-self.percent * total // (100 + self.percent))

    def most(self, size: int) -> int:
        """The greatest symmetric difference of two qualifying sets of at most this size (it depends on the sum's parity)."""
        return max(int(self.differ(2 * size)), int(self.differ(2 * size - 1)))

    @cached_property
    def bounds(self) -> np.ndarray:
        """The greatest size of each band; band 0 holds the sizes at which only equal sets qualify."""
        u = 1
        while self.most(u + 1) == 0:
            u += 1
        out = [u]
        while out[-1] < 1 << 34:
            out.append(max(out[-1] + 1, int(out[-1] * BAND)))
        return np.array(out)

    def bands(self, size: int) -> range:
        """The bands in which a set of this size meets others: its own and those of larger partners."""
        own = int(np.searchsorted(self.bounds, size))
        last = int(np.searchsorted(self.bounds, size * 100 // self.percent))
        return range(max(own, 1), last + 1)

    @cached_property
    def _segments(self) -> dict[int, tuple[int, int]]:
        return {}

    def segments(self, band: int) -> tuple[int, int]:
        """H and m of a band; m has the least expected number of keys.

        More segments make more keys; fewer leave less room for empty ones and make
        more sets give their one-deletion neighbourhoods (size + m keys more).
        """
        if band not in self._segments:
            top = int(self.bounds[band])
            h = self.most(top)
            low = max(1, (int(self.bounds[band - 1]) + 1) * self.percent // 100)
            sizes = [low, int((low * top) ** 0.5), top]

            def cost(m: int) -> float:
                total = 0.0
                for size in sizes:
                    empty = math.exp(size * math.log1p(-1 / m))
                    z = (m - h - 0.5 - m * empty) / math.sqrt(2 * max(m * empty * (1 - empty), 1e-9))
                    total += m * (1 - empty) + 0.5 * math.erfc(z) * (size + m)
                return total

            step = max(1, h // 64)
            self._segments[band] = h, min(range(h + 2, 2 * h + 8, step), key=cost)
        return self._segments[band]

    def sketch_bits(self, band: int) -> int:
        return 64 * max(1, -(-SKETCH_BITS * self.segments(band)[0] // 64))


def _key(value, band: int, kind: int, segment) -> np.ndarray:
    """A 64-bit key whose last byte is the band."""
    with np.errstate(over="ignore"):
        h = mixed(value + mixed(np.asarray(segment, np.int64).astype(_U) * _U(8) + _U(kind)))
    return (h & ~_U(0xFF)) | _U(band)


def keys(grams: np.ndarray, scheme: Scheme) -> np.ndarray:
    """The index keys of a set of distinct n-gram hashes."""
    size, out = len(grams), []
    place, value = mixed(grams ^ _U(0x9E3779B97F4A7C15)) >> _U(32), mixed(grams + _U(0x632BE59BD9B4E019))
    for band in scheme.bands(size):
        h, m = scheme.segments(band)
        segment = ((place * _U(m)) >> _U(32)).astype(np.int64)
        sums = np.zeros(m, _U)
        np.add.at(sums, segment, value)
        counts = np.bincount(segment, minlength=m)
        held = np.flatnonzero(counts)
        out.append(_key(sums[held], band, 0, held))
        if m - len(held) > m - h - 1:
            out.append(_key(sums[held], band, 1, held))
            with np.errstate(over="ignore"):
                one_less = sums[segment] - value
            out.append(_key(one_less, band, 1, segment)[counts[segment] > 1])
            if np.sort(counts)[::-1][: h // 2].sum() >= size - h:
                out.append(_key(value, band, 2, 0))
    return np.concatenate(out) if out else np.zeros(0, _U)


def sketch(grams: np.ndarray, bits: int) -> bytes:
    """The parity of how many n-grams fall on each bit."""
    at = (mixed(grams + _U(0xD6E8FEB86659FD93)) % _U(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


class Sets:
    """Distinct n-gram hashes of a text, and its node."""

    def __init__(self, scheme: Scheme):
        self.hashes, self.n = WordHashes(), scheme.n

    def __call__(self, text: bytes) -> np.ndarray:
        return np.unique(shingles(self.hashes(text.lower().split()), self.n))

    @staticmethod
    def node(grams: np.ndarray) -> int:
        with np.errstate(over="ignore"):
            total = mixed(np.sum(mixed(grams + _U(0x2545F4914F6CDD1D)), dtype=_U) + _U(len(grams)))
        return int(total.astype(np.int64))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]


def described(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, n_shingles, node (null for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(scheme)
        for batch in batches:
            found = [sets(t) for t in _texts(batch)]
            nodes = [sets.node(g) if len(g) else None for g in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, found), pa.int64()), pa.array(nodes, pa.int64())], names=["doc_id", "n_shingles", "node"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long")


def indexed(docs: DataFrame, scheme: Scheme, often: np.ndarray | None = None) -> DataFrame:
    """(key, salt, node) of each different set, once a partition; salt is 0 but for the keys in ``often``."""
    often = np.sort(np.zeros(0, np.int64) if often is None else often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, seen = Sets(scheme), set()
        for batch in batches:
            found, nodes, counts = [], [], []
            for t in _texts(batch):
                grams = sets(t)
                if not len(grams) or (node := sets.node(grams)) in seen:
                    continue
                seen.add(node)
                found.append(keys(grams, scheme))
                nodes.append(node)
                counts.append(len(found[-1]))
            flat = np.concatenate([*found, np.zeros(0, _U)]).astype(np.int64)
            node = np.repeat(np.array(nodes, np.int64), counts)
            salt = np.zeros(len(flat), np.int32)
            if len(often):
                hot = often[np.minimum(np.searchsorted(often, flat), len(often) - 1)] == flat
                salt[hot] = 1 + (mixed(node[hot].astype(_U)) % _U(SALTS)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(salt), pa.array(node)], names=["key", "salt", "node"])

    return docs.mapInArrow(run, "key long, salt int, node long")


def frequent(docs: DataFrame, scheme: Scheme, rows: int) -> np.ndarray:
    """Keys that occur OFTEN in a sample of SAMPLE texts; at most the sample's keys / OFTEN."""
    if rows <= SAMPLE:
        return np.zeros(0, np.int64)
    few = indexed(docs.sample(SAMPLE / rows, seed=5), scheme).groupBy("key").agg(F.count("*").alias("n"))
    return np.array([r[0] for r in few.where(F.col("n") >= OFTEN).select("key").collect()], np.int64)


def shared(index: DataFrame, unit: int = UNIT) -> DataFrame:
    """(key, large, node), each once, of keys that two nodes or more have.

    Small units are named by their nodes and band, so keys that the same nodes share
    are one. Nodes of large ones, and of keys with salt, pass by and are never held.
    """

    def batch(key: np.ndarray, large: bool, node: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(key), large)), pa.array(node)], names=["key", "large", "node"])

    def first_of(key: np.ndarray, node: np.ndarray, last: tuple) -> np.ndarray:
        new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])] if len(key) else np.zeros(0, bool)
        if len(key) and (key[0], node[0]) == last:
            new[0] = False
        return new

    def whole(key: np.ndarray, node: np.ndarray, seen: set[int]) -> Iterator[pa.RecordBatch]:
        if not len(key):
            return
        first = first_of(key, node, ())
        key, node = key[first], node[first]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        with np.errstate(over="ignore"):
            name = mixed(np.add.reduceat(mixed(node.astype(_U)), start))
        name = ((name & ~_U(0xFF)) | (key[start].astype(_U) & _U(0xFF))).astype(np.int64)
        new = (size > 1) & (size <= unit)
        for i in np.flatnonzero(new).tolist():
            if (n := int(name[i])) in seen:
                new[i] = False
            elif len(seen) < REMEMBERED:
                seen.add(n)
        small, big = np.repeat(new, size), np.repeat(size > unit, size)
        yield batch(np.repeat(name, size)[small], False, node[small])
        if big.any():
            yield batch(key[big], True, node[big])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        seen: set[int] = set()
        last_hot = last_open = ()
        open_key = None
        for b in batches:
            key, salt, node = (b.column(c).to_numpy() for c in ("key", "salt", "node"))
            hot = salt > 0
            if hot.any():
                k, n = key[hot], node[hot]
                new = first_of(k, n, last_hot)
                last_hot = (k[-1], n[-1])
                yield batch(k[new], True, n[new])
                key, node = key[~hot], node[~hot]
            if not len(key):
                continue
            if open_key is not None:
                end = int(np.searchsorted(key, open_key, "right")) if key[0] == open_key else 0
                k, n = key[:end], node[:end]
                new = first_of(k, n, last_open)
                yield batch(k[new], True, n[new])
                if end:
                    last_open = (k[-1], n[-1])
                key, node = key[end:], node[end:]
                if not len(key):
                    continue
                open_key = None
            if held and held[-1][0][-1] != key[0]:
                yield from whole(*map(np.concatenate, zip(*held)), seen)
                held = []
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield from whole(*map(np.concatenate, zip(*held, (key[:cut], node[:cut]))), seen)
                held = []
            held.append((key[cut:], node[cut:]))
            if sum(len(k) for k, _ in held) > 4 * unit:
                k, n = map(np.concatenate, zip(*held))
                new, held = first_of(k, n, ()), []
                if new.sum() > unit:
                    yield batch(k[new], True, n[new])
                    open_key, last_open = k[-1], (k[-1], n[-1])
                else:
                    held = [(k[new], n[new])]
        if held:
            yield from whole(*map(np.concatenate, zip(*held)), seen)
        yield batch(none, False, none)

    dealt = index.repartition("key", "salt").sortWithinPartitions("salt", "key", "node")
    return dealt.mapInArrow(run, "key long, large boolean, node long").distinct()


def chunked(keyed: DataFrame, unit: int = UNIT) -> DataFrame:
    """(unit, band, chunks, chunk, node): small units as they are, large ones with their number of chunks and each node's chunk.

    Large keys that hold the same nodes are one unit; a key with salt may turn out to have a single node.
    """
    band = F.col("key").bitwiseAND(0xFF).cast("int").alias("band")
    small = keyed.where("not large").select(F.col("key").alias("unit"), band, F.lit(1).alias("chunks"), F.lit(0).alias("chunk"), "node")
    large = keyed.where("large")
    name = F.sum(F.xxhash64("node").cast("decimal(20,0)")).cast("string")
    sizes = large.groupBy("key").agg(F.count("*").alias("n"), name.alias("name")).where("n > 1")
    sizes = sizes.groupBy("n", "name", band).agg(F.min("key").alias("key"))
    sizes = sizes.select("key", F.when(F.col("n") <= unit, 1).otherwise(F.ceil(2 * F.col("n") / unit)).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64(F.lit(3), "node"), F.col("chunks")).cast("int").alias("chunk")
    return small.unionByName(large.join(sizes, "key").select(F.col("key").alias("unit"), band, "chunks", chunk, "node"))


def profiles(docs: DataFrame, about: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """node, size, sketches by band and the set itself, for the given nodes; one document of each is read."""
    ids = written(about.join(nodes, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "shared_ids")
    wanted = ids.select(F.col("doc_id").alias("_id")).distinct()
    few = ids.count() <= BROADCAST_ROWS
    own = docs.join(F.broadcast(wanted) if few else wanted, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = Sets(scheme)
        for batch in batches:
            rows = []
            for t in _texts(batch):
                grams = sets(t)
                if len(grams):
                    marks = [(band, sketch(grams, scheme.sketch_bits(band))) for band in scheme.bands(len(grams))]
                    rows.append((sets.node(grams), len(grams), marks, grams.tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.map_(pa.int32(), pa.binary()), pa.binary()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["node", "size", "sketches", "grams"])

    found = own.mapInArrow(run, "node long, size long, sketches map<int,binary>, grams binary").join(ids.select("node"), "node", "left_semi")
    return written(found.dropDuplicates(["node"]), "profiles")


class Unit:
    """Nodes that may have links among themselves, with their sketches; rows of the matrix of pairs are made when asked for."""

    def __init__(self, scheme: Scheme, node: np.ndarray, size: np.ndarray, marks: list[bytes], side: np.ndarray):
        self.scheme, self.node, self.size, self.side = scheme, node, size, side
        self.bits = np.frombuffer(b"".join(marks), _U).reshape(len(node), -1)

    def row(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The sketch distances to node i, and which nodes may qualify with it. Nodes of one side (but 0) don't meet."""
        gap = np.bitwise_count(self.bits ^ self.bits[i]).sum(1, dtype=np.int64)
        own = self.size[i]
        ok = (gap <= self.scheme.differ(self.size + own)) & (100 * np.minimum(self.size, own) >= self.scheme.percent * np.maximum(self.size, own))
        ok &= (self.side != self.side[i]) | (self.side == 0)
        ok[i] = False
        return gap, ok


def spanning(unit: Unit) -> list[tuple[int, int]]:
    """Edges of the least spanning forest of the pairs that may qualify, by sketch distance."""
    n = len(unit.node)
    if n == 2:
        return [(0, 1)] if unit.row(0)[1][1] else []
    out, free, best, parent = [], np.ones(n, bool), np.full(n, np.inf), np.zeros(n, int)
    for _ in range(n):
        i = int(np.argmin(np.where(free, best, np.inf)))
        if not free[i] or best[i] == np.inf:
            i = int(np.argmax(free))
        else:
            out.append((int(parent[i]), i))
        free[i] = False
        gap, ok = unit.row(i)
        closer = free & ok & (gap < best)
        best[closer], parent[closer] = gap[closer], i
    return out


def _by_unit(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list | None]:
    """The rows of each unit (the batches' first ``columns`` name it), as lists of the rest; None after each batch."""
    held: list = []
    unit = None
    for batch in batches:
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            if unit != values[:columns]:
                if len(held) > 1:
                    yield held
                held, unit = [], values[:columns]
            held.append(values)
        yield None
    if len(held) > 1:
        yield held


def candidates(units: DataFrame, scheme: Scheme) -> DataFrame:
    """Different pairs (a, b) that may qualify: the least spanning forest of each chunk of a unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        out: list[tuple[int, int]] = []

        def flush() -> pa.RecordBatch:
            a, b = zip(*out) if out else ((), ())
            out.clear()
            if len(seen) > 1 << 20:
                seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for rows in _by_unit(batches, 2):
            if rows is None:
                yield flush()
                continue
            _, _, node, size, marks = zip(*rows)
            found = Unit(scheme, np.array(node), np.array(size), marks, np.zeros(len(node), np.int8))
            for i, j in spanning(found):
                pair = (min(node[i], node[j]), max(node[i], node[j]))
                if pair not in seen:
                    seen.add(pair)
                    out.append(pair)
        yield flush()

    dealt = units.select("unit", "chunk", "node", "size", "sketch").repartition("unit", "chunk").sortWithinPartitions("unit", "chunk", "node")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def against(rows: DataFrame, *by: str) -> DataFrame:
    """Rows with chunk and chunks, once for each pair of chunks (ci, cj) that they take part in; side 1 or 2 where two chunks meet."""
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("_o")
    out = rows.select("*", other)
    ci, cj = F.least("chunk", "_o"), F.greatest("chunk", "_o")
    side = F.when(F.col("chunk") == F.col("_o"), 0).when(F.col("chunk") < F.col("_o"), 1).otherwise(2)
    return out.withColumns({"ci": ci, "cj": cj, "side": side}).drop("_o", "chunk", "chunks").repartition(*by, "ci", "cj").sortWithinPartitions(*by, "ci", "cj", "node")


def open_nodes(units: DataFrame, scheme: Scheme) -> DataFrame:
    """(unit, band, node): of each piece of a unit the nodes that may qualify with one of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_unit(batches, 3):
            if rows is None:
                continue
            unit, ci, cj, node, size, marks, comp, side, band = zip(*rows)
            comp = np.array(comp)
            if (comp == comp[0]).all():
                continue
            found = Unit(scheme, np.array(node), np.array(size), marks, np.array(side))
            wanted = np.zeros(len(node), bool)
            for i in range(len(node)):
                wanted[i] = bool((found.row(i)[1] & (comp != comp[i])).any())
            if wanted.any():
                n = int(wanted.sum())
                name = hash((unit[0], ci[0], cj[0]))  # of integers: alike in every process
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, name)), pa.array(np.full(n, band[0], np.int32)), pa.array(found.node[wanted])], names=["unit", "band", "node"])

    dealt = against(units.select("unit", "chunks", "chunk", "node", "size", "sketch", "comp", "band"), "unit")
    return dealt.select("unit", "ci", "cj", "node", "size", "sketch", "comp", "side", "band").mapInArrow(run, "unit long, band int, node long")


def families(needs: DataFrame) -> DataFrame:
    """(work, band, node) from (unit, band, node): units that overlap become one where that makes no more pairs than they hold by themselves."""
    each = written(needs.groupBy("unit").agg(F.min("node").alias("hub"), F.max("band").alias("band"), F.count("*").alias("n")), "open_units")
    star = needs.join(each.select("unit", "hub"), "unit").where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    kin = components(written(star, "kin"))
    size = kin.groupBy("comp").agg(F.count("*").alias("_f"))
    each = each.join(kin.withColumnRenamed("node", "hub"), "hub")
    total = each.groupBy("comp").agg(F.sum((F.col("n") * F.col("n")).cast("double")).alias("_s"), F.max("band").alias("_band")).join(size, "comp")
    total = written(total.select("comp", "_band", (F.col("_f").cast("double") * F.col("_f") <= F.col("_s")).alias("_one")), "families")
    one = kin.join(total.where("_one"), "comp").select(F.col("comp").alias("work"), F.lit(1).alias("kind"), F.col("_band").alias("band"), "node")
    apart = each.join(total.where("not _one"), "comp").select("unit")
    single = needs.join(apart, "unit").select(F.col("unit").alias("work"), F.lit(0).alias("kind"), "band", "node")
    return one.unionByName(single)


def meeting(needs: DataFrame, sets: DataFrame, comps: DataFrame, scheme: Scheme) -> DataFrame:
    """(a, b): links between different components among the nodes of a work, verified by whole sets; at most one less than the nodes of a piece."""
    work = written(families(needs), "work")
    by = ["work", "kind"]
    light = work.join(sets.select("node", "size"), "node")
    volume = light.groupBy(by).agg(F.count("*").alias("_n"), F.sum("size").alias("_g"))
    pieces = F.greatest(F.ceil(F.col("_n") / MEET), F.ceil(F.col("_g") * 8 / MEET_BYTES))
    volume = volume.select(*by, F.when(pieces <= 1, 1).otherwise(2 * pieces).cast("int").alias("chunks"))
    rows = work.join(volume, by).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(F.lit(4), "node"), F.col("chunks")).cast("int"))
    dealt = against(rows.join(sets.select("node", "grams"), "node"), *by).select(*by, "ci", "cj", "node", "comp", "side", "band", "grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_unit(batches, 4):
            if rows is None:
                continue
            *_, node, comp, side, band, grams = zip(*rows)
            if len(set(comp)) < 2:
                continue
            grams = [np.frombuffer(g, _U) for g in grams]
            bits = FINER * scheme.sketch_bits(band[0])
            found = Unit(scheme, np.array(node), np.array([len(g) for g in grams]), [sketch(g, bits) for g in grams], np.array(side))
            labels, own = np.unique(np.array(comp), return_inverse=True)
            out: list[tuple[int, int]] = []
            left = len(labels) - 1
            for i in range(len(node)):
                ok = found.row(i)[1] & (own != own[i])
                ok[:i] = False
                for j in np.flatnonzero(ok).tolist():
                    if own[j] == own[i]:
                        continue
                    both = len(np.intersect1d(grams[i], grams[j], assume_unique=True))
                    if 100 * both >= scheme.percent * (len(grams[i]) + len(grams[j]) - both):
                        own[own == own[j]] = own[i]
                        out.append((min(node[i], node[j]), max(node[i], node[j])))
                        left -= 1
                if not left:
                    break
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs that qualify, by their whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("ga").to_pylist(), batch.column("gb").to_pylist()):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= scheme.percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    b = sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ga", "gb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node with a link: each round nodes move to their least neighbour and links are contracted."""
    edges, maps = links, []
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "hooks")
        maps.append(step)
        to = lambda c: step.select(F.col("a").alias(c), F.col("up").alias(f"_{c}"))
        edges = edges.join(to("a"), "a").join(to("b"), "b").where("_a <> _b")
        edges = written(edges.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "contracted")
        if not edges.limit(1).count():
            break
    found = maps.pop().select(F.col("a").alias("node"), F.col("up").alias("comp"))
    while maps:
        far = found.select(F.col("node").alias("up"), F.col("comp").alias("_far"))
        found = maps.pop().join(far, "up", "left").select(F.col("a").alias("node"), F.coalesce("_far", "up").alias("comp"))
    return written(found, "components")


def joined(comps: DataFrame, more: DataFrame) -> DataFrame:
    """The components after more links: only the components that these touch are looked at."""
    of = lambda c: comps.select(F.col("node").alias(c), F.col("comp").alias(f"_{c}"))
    edges = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("_a", "a").alias("x"), F.coalesce("_b", "b").alias("y"))
    edges = edges.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    new = components(written(edges, "component_links"))
    far = new.select(F.col("node").alias("comp"), F.col("comp").alias("_far"))
    known = comps.join(far, "comp", "left").select("node", F.coalesce("_far", "comp").alias("comp"))
    return written(known.unionByName(new.join(comps, "node", "left_anti")), "components")


def join_ngrams(docs: DataFrame, scheme: Scheme = Scheme(), unit: int = UNIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest id that links reach."""
    return placed(docs, scheme, unit, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def placed(docs: DataFrame, scheme: Scheme = Scheme(), unit: int = UNIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, node, comp of each row; node and its component's least node are null for an empty set."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    mark = scratch_mark()
    about = written(described(docs, scheme), "sets")
    keyed = written(shared(indexed(docs, scheme, frequent(docs, scheme, about.count())), unit), "units")
    sets = profiles(docs, about, keyed.select("node").distinct(), scheme)
    light = sets.select("node", "size", "sketches")
    units = chunked(keyed, unit).join(light, "node").withColumn("sketch", F.element_at("sketches", F.col("band"))).drop("sketches")
    links = written(verified(written(candidates(units, scheme), "pairs"), sets, scheme), "links")
    comps = components(links)
    labelled = units.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    needs = written(open_nodes(labelled, scheme), "open")
    if needs.limit(1).count():
        more = written(meeting(needs, sets, comps, scheme), "more_links")
        if more.limit(1).count():
            comps = joined(comps, more)
    release(docs.sparkSession, mark, (about, comps))  # all that is still to be read
    first = about.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("_first"))
    first = first.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = first.groupBy("comp").agg(F.min("_first").alias("component_id"))
    by_node = first.join(least, "comp").select("node", "component_id", "comp")
    linked = about.where("node is not null").join(by_node, "node").select("doc_id", "n_shingles", "component_id", "node", "comp")
    none = F.lit(None).cast("long")
    return linked.unionByName(about.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), none.alias("node"), none.alias("comp")))


def _node_of(scheme: Scheme):
    """The node of a text, as a function of Columns."""

    def node(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sets = Sets(scheme)
        for batch in texts:
            found = (sets(t.encode() if t else b"") for t in batch.to_pylist())
            yield pa.array([sets.node(g) if len(g) else None for g in found], pa.int64())

    return F.arrow_udf(node, "long")


def keep_one(docs: DataFrame, scheme: Scheme = Scheme()) -> DataFrame:
    """Of each component the row with the smallest id, with all its columns; rows without an id stay.

    Those that go are told to the rows by id: sent to all where they are few, else by a shuffle. Rows whose id
    repeats are told apart by their sets, and by their texts where those are empty; equal ones are one row.
    """
    found = written(placed(docs, scheme), "duplicates")
    gone = written(found.where("component_id <> doc_id").select(F.col("doc_id").alias("id")).distinct(), "gone")
    few = gone.count() <= BROADCAST_ROWS
    same = F.col("d.doc_id") == F.col("o.id")
    kept = docs.alias("d").join((F.broadcast(gone) if few else gone).alias("o"), same, "left_anti")
    often = written(found.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("id")), "repeated")
    if not often.limit(1).count():
        return kept
    first = found.alias("d").where("component_id = doc_id and node is not null").join(often.alias("o"), same, "left_semi").groupBy("comp", "doc_id").agg(F.min("node").alias("first"))
    first = written(first.select(F.col("doc_id").alias("id"), "first"), "first")
    row = F.struct(*[F.col(f"d.`{c}`") for c in docs.columns]).alias("row")
    rows = docs.alias("d").join(often.alias("o"), same, "left_semi").select(row, "doc_id", "text", _node_of(scheme)("text").alias("node"))
    chosen = rows.alias("d").join(first.alias("o"), same & (F.col("d.node") == F.col("o.first")), "left_semi").dropDuplicates(["doc_id", "node"])
    empty = rows.where("node is null").dropDuplicates(["doc_id", "text"])
    return kept.join(often.alias("o"), same, "left_anti").unionByName(chosen.select("row.*")).unionByName(empty.select("row.*"))


ORACLE = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents
), sets as (
  select distinct doc_id, hash(w[i : i + 2]) g from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) i from d where len(w) > 0)
), sizes as (
  select doc_id, count(g) n from d left join sets using (doc_id) group by doc_id
), pairs as (
  select a.doc_id a, b.doc_id b, count(*) n from sets a join sets b using (g) where a.doc_id < b.doc_id group by all
), links as (
  select a, b from pairs p join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * p.n >= 90 * (x.n + y.n - p.n)
), both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id a, doc_id b from d union select r.a, l.b from reach r join both_ways l on r.b = l.a
), least as (select a doc_id, min(b) component_id from reach group by a)
select doc_id, n::bigint n_shingles, component_id from sizes join least using (doc_id)
"""


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Components of ``documents`` over three-word shingles at a Jaccard similarity of 0.9."""
    return join_ngrams(table(spark, sf_dir, "documents"), Scheme(3, 90))
