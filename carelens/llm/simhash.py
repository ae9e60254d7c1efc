"""SimHash near-duplicates by bit-sliced comparison.

Fingerprint: bit b is set if more than half of the hashes of a document's
4-word shingles (repeats included) have it set.  Two fingerprints link when at
most ``RADIUS`` bits differ.

Only different fingerprints are compared.  Their 64 bits are cut into m bands;
two that differ in at most 4 bits agree in at least m - 4 bands, so they meet
under one of the C(m, 4) choices of m - 4 bands.  m is the smallest for which
chance alone fills a bucket with at most ``FILL`` fingerprints (m = 5 up to two
million, 8 from billions on).  Every choice finds all links, so m is a matter of cost only.

Buckets are streamed, sorted, through tasks, many at a time: their
fingerprints stand one below the other, larger buckets first, and plane b
holds bit b of all of them in 64-bit words.  For distance o = 1, 2, ... in
that order the planes are XORed with themselves shifted by o bits, which
compares 64 pairs per word; a carry-save adder counts the differing planes in
bit-sliced counters, and words whose pairs have all exceeded the radius are
abandoned.  As o grows, only buckets with more than o members remain at the
front.  Links within a component already known to the task are not written,
so a dense group leaves as many links as it has members.

A bucket above ``SEGMENT`` is dealt out to segments by hash before it reaches
any task; each is compared with itself as above, and the packed segments of a
bucket (8 bytes a fingerprint) meet pairwise: the one's planes against all
rotations of the other's.  That is exact for any bucket.

Defined results: every row is answered; a NULL text counts as empty; texts
without words have fingerprint 0, linked like any other; a row without id
links like others, and its component is the smallest id that there is (NULL
if there is none); an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import materialize, ship_package
from carelens.llm.components import connected_components

SHINGLE = 4
SEED = 42
RADIUS = 4
FILL = 256  # fingerprints that chance alone puts in a bucket, at most
SEGMENT = 16_384
BATCH = 1 << 16  # fingerprints compared in one go
GROUP = 8  # planes between two looks at what can be abandoned
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes) -> int:
    """Fingerprint of UTF-8 bytes."""
    words = text.lower().split()  # bytes: A-Z only, and the white space 09-0D and 20
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
    ends = (ends - 1)[min(SHINGLE, len(words)) - 1 :].tolist()
    set_in = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, BATCH):
        h = np.array([hashed(line[s:e], SEED) for s, e in zip(starts[at : at + BATCH], ends[at : at + BATCH], strict=True)], "<u8")
        set_in += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view("<u8")[0])


def _fingerprints(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        out = np.array([fingerprint(t or b"") for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["id", "fp"])


def _csa(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save adder: bitwise sum and carry of three words."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def within(x: np.ndarray, y: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Words whose bits tell which of the pairs differ in at most ``radius``
    (at most 7) planes; x and y are (64, words)."""
    size = x.shape[1]
    alive = np.arange(size)
    zero = np.zeros(size, np.uint64)
    ones, twos, fours, over = zero, zero, zero, zero
    out = np.zeros(size, np.uint64)
    for g in range(0, 64, GROUP):
        part = slice(g, g + GROUP)
        p = x[part] ^ y[part] if len(alive) == size else x[part, alive] ^ y[part, alive]
        ones, t1 = _csa(ones, p[0], p[1])
        ones, t2 = _csa(ones, p[2], p[3])
        twos, f1 = _csa(twos, t1, t2)
        ones, t1 = _csa(ones, p[4], p[5])
        ones, t2 = _csa(ones, p[6], p[7])
        twos, f2 = _csa(twos, t1, t2)
        fours, eights = _csa(fours, f1, f2)
        over = over | eights
        # Counters stand at ones + 2 twos + 4 fours, 8 and more are in over.
        beyond, level = over, ONES
        for bit, counter in ((4, fours), (2, twos), (1, ones)):
            if radius & bit:
                level = level & counter
            else:
                beyond = beyond | (level & counter)
        left = np.flatnonzero(beyond != ONES)
        if not len(left):
            return out
        if 4 * len(left) < 3 * len(alive):
            alive, beyond = alive[left], beyond[left]
            ones, twos, fours, over = ones[left], twos[left], fours[left], over[left]
    out[alive] = ~beyond
    return out


def planes(fp: np.ndarray, spare: int = 1) -> np.ndarray:
    """Bit planes (64, words) of fingerprints, with spare words of zeros."""
    words = -(-len(fp) // 64) + spare
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[: len(fp)] = np.unpackbits(np.ascontiguousarray(fp, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _shifted(p: np.ndarray, by: int, words: int) -> np.ndarray:
    """The planes from position ``by`` on."""
    q, r = divmod(by, 64)
    low = p[..., q : q + words]
    if r == 0:
        return low
    return (low >> np.uint64(r)) | (p[..., q + 1 : q + words + 1] << np.uint64(64 - r))


def _places(found: np.ndarray) -> np.ndarray:
    """Positions of the set bits."""
    at = np.flatnonzero(found)
    if not len(at):
        return at
    bits = np.unpackbits(found[at].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, bit = np.nonzero(bits)
    return at[row] * 64 + bit


class Links:
    """The links of a batch that join components."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.a: list[int] = []
        self.b: list[int] = []

    def _find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        apart = self.up[i] != self.up[j]
        if not apart.any():
            return
        for x, y in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
            p, q = self._find(x), self._find(y)
            if p != q:
                self.up[max(p, q)] = min(p, q)
                self.a.append(x)
                self.b.append(y)
        while True:
            again = self.up[self.up]
            if (again == self.up).all():
                break
            self.up = again


def compare_buckets(fp: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as pairs of positions) among the members of each bucket; buckets
    follow one another in ``fp``, by falling size."""
    links = Links(len(fp))
    p = planes(fp, 2)
    starts = np.cumsum(sizes) - sizes
    end = np.repeat(starts + sizes, sizes)
    for o in range(1, int(sizes[0]) if len(sizes) else 0):
        buckets = int(np.searchsorted(-sizes, -o, side="left"))  # those of more than o members
        upto = int(starts[buckets - 1] + sizes[buckets - 1])
        words = -(-(upto - o) // 64)
        # Positions shared by two copies of the planes: the second is read o later.
        padded = p if p.shape[1] > words + o // 64 + 1 else np.pad(p, ((0, 0), (0, words + o // 64 + 2 - p.shape[1])))
        i = _places(within(padded[:, :words], _shifted(padded, o, words)))
        i = i[i < upto - o]
        i = i[i + o < end[i]]
        links.add(i, i + o)
    return np.array(links.a, np.int64), np.array(links.b, np.int64)


def compare_segments(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between two lists of fingerprints, as positions in each: a's
    planes against every rotation of b's."""
    if len(a) > len(b):
        j, i = compare_segments(b, a)
        return i, j
    links = Links(len(a) + len(b))
    x, y = planes(a, 0), planes(np.concatenate([b, b]), 2)
    for o in range(len(b)):
        i = _places(within(x, _shifted(y, o, x.shape[1])))
        i = i[i < len(a)]
        links.add(i, len(a) + (i + o) % len(b))
    return np.array(links.a, np.int64), np.array(links.b, np.int64) - len(a)


def bands(n: int) -> list[tuple[int, list[int]]]:
    """(table, masks of its bands): the choices of m - RADIUS bands of m."""
    for m in range(RADIUS + 1, 2 * RADIUS + 1):
        cuts = [64 * i // m for i in range(m + 1)]
        least = sum(sorted(b - a for a, b in zip(cuts, cuts[1:], strict=False))[: m - RADIUS])
        if n <= FILL << least:
            break
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [(t, list(chosen)) for t, chosen in enumerate(combinations(masks, m - RADIUS))]


def _bucket_links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within buckets; rows (bucket, key, segment, fp) come sorted."""
    held_fp: list[np.ndarray] = []
    held_size: list[np.ndarray] = []
    rest = None

    def flush() -> pa.RecordBatch:
        fp, sizes = np.concatenate(held_fp), np.concatenate(held_size)
        many = sizes > 1
        order = np.argsort(-sizes[many], kind="stable")
        starts = (np.cumsum(sizes) - sizes)[many][order]
        sizes = sizes[many][order]
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        chosen = fp[at]
        a, b = compare_buckets(chosen, sizes)
        held_fp.clear()
        held_size.clear()
        return pa.RecordBatch.from_arrays([pa.array(chosen[a].view(np.int64)), pa.array(chosen[b].view(np.int64))], names=["a", "b"])

    for batch in it:
        cols = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        if rest is not None:
            cols = np.concatenate([rest, cols], 1)
        if not cols.shape[1]:
            continue
        new = np.flatnonzero(np.r_[True, (np.diff(cols[:3], axis=1) != 0).any(0)])
        # The last bucket may go on in the next batch.
        rest = cols[:, new[-1] :]
        if len(new) > 1:
            held_fp.append(cols[3, : new[-1]].view(np.uint64))
            held_size.append(np.diff(new))
        if sum(map(len, held_fp)) >= BATCH:
            yield flush()
    if rest is not None and rest.shape[1]:
        held_fp.append(rest[3].copy().view(np.uint64))
        held_size.append(np.array([rest.shape[1]]))
    if held_fp:
        yield flush()


def _segment_links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            i, j = compare_segments(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a[i].view(np.int64)), pa.array(b[j].view(np.int64))], names=["a", "b"])


def _packed(key: tuple, rows: pa.Table) -> pa.Table:
    """A segment's fingerprints as one row of bytes."""
    fp = np.sort(rows.column("fp").to_numpy()).astype("<i8").tobytes()
    return pa.table({"t": pa.array([key[0].as_py()], pa.int32()), "key": [key[1].as_py()], "segment": pa.array([key[2].as_py()], pa.int32()), "fps": [fp]})


def links(spark: SparkSession, fps: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(a, b): links between different fingerprints (column fp, distinct),
    enough of them to connect all that are connected."""
    ship_package(spark)
    # A table's key is the value of its bands' bits, all others cleared.
    tables = [F.struct(F.lit(t).cast("int").alias("t"),
                       F.col("fp").bitwiseAND(F.lit(_signed(sum(masks))).cast("long")).alias("key")) for t, masks in bands(fps.count())]
    rows = fps.select("fp", F.explode(F.array(*tables)).alias("at")).select("at.t", "at.key", "fp")
    hot = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > segment).select(
        "t", "key", F.ceil(F.col("n") / segment).cast("int").alias("segments"))
    hot = materialize(spark, hot, "hot-buckets")
    dealt = rows.join(hot, ["t", "key"], "left").select(
        "t", "key", F.when(F.col("segments").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), F.col("segments"))).cast("int").alias("segment"),
        "fp", F.col("segments").isNotNull().alias("hot"))
    inside = dealt.select("t", "key", "segment", "fp").repartition("t", "key", "segment").sortWithinPartitions(
        "t", "key", "segment").mapInArrow(_bucket_links, "a long, b long")
    if hot.isEmpty():
        return inside
    packed = dealt.where("hot").groupBy("t", "key", "segment").applyInArrow(_packed, "t int, key long, segment int, fps binary")
    packed = materialize(spark, packed, "hot-segments")
    other = packed.select("t", "key", F.col("segment").alias("next"), F.col("fps").alias("others"))
    between = packed.join(other, ["t", "key"]).where("segment < next").select("fps", "others").repartition(
        spark.sparkContext.defaultParallelism).mapInArrow(_segment_links, "a long, b long")
    return inside.unionByName(between)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def simhash_components(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       segment: int = SEGMENT) -> DataFrame:
    """(id, fingerprint, component_id) of every document."""
    ship_package(spark)
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").cast("binary").alias("t"))
    prints = materialize(spark, read.mapInArrow(_fingerprints, "id long, fp long"), "fingerprints")
    # One row per fingerprint: a group of copies shrinks to one in the tasks.
    distinct = materialize(spark, prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    edges = materialize(spark, links(spark, distinct.select("fp"), segment), "fingerprint-links")
    nodes = connected_components(spark, edges)
    grouped = distinct.join(nodes, distinct["fp"] == nodes["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = grouped.join(least, "component").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
