"""N-gram Jaccard join on prefix trees, down to connected components.

Texts become sets of 5-word shingles (64-bit hashes).  Two sets link when their
Jaccard similarity reaches 3/4; the result is every document's component.

1. *Shared shingles.*  Shingles are dealt out by hash; a shingle that only one
   set holds cannot be part of an overlap and is dropped.  The others go back
   to their sets.  A set can only link if at least 3/4 of its shingles are
   shared, so a text that merely quotes a common passage ends here.
2. *Blocks.*  In a global order (rarest shingle first) linked sets share a
   shingle among their first n - ceil(3n/4) + 1.  Sets that share one are in
   the same block; blocks are the components of that relation.  Passages that
   many texts have in common are last in the order and tie no blocks together.
   How many sets hold a shingle is summed from counts per chunk of sets, and
   told to every chunk once, so a frequent shingle costs a row per chunk.
3. *Prefix trees.*  In a block the sets, ordered by the block's most common
   shingles first, are stored in a path-compressed trie.  Each set walks the
   trie of the sets before it: overlaps of shared paths are counted once, a
   subtree is left when the overlap so far plus what can remain (in the
   subtree or the set) cannot reach the threshold of its shortest set, or
   when all of it is already in the set's component.
4. *Components* of the links by alternating star contractions.

Groups of sets that link do not grow with their square; a block of many sets
of which most do not link does, as its strays meet all of its segments, and the
sets that hold one prefix shingle are one task's.  Equal sets are one node (collapsed
inside tasks before any shuffle, by digest afterwards).  Shingles travel
packed, and one that several sets of a pack hold is sent to its bucket once.  Blocks larger than ``SEGMENT`` sets are cut
into segments joined on their own together with the block's pivot set; sets
that are then not in the block's main component are joined with all other
segments, and pairs inside it need no comparing.

Defined results: texts without words have n_shingles 0 and are a component of
their own; texts of fewer than 5 words are one shingle; rows are documents of
their own (rows of equal id and different text are not linked by the id), a
component's id is the smallest id in it, NULL ids count as none; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import materialize, ship_package, text_or_empty
from carelens.llm.components import connected_components

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100
BUCKET_TOKENS = 2_000_000  # shingles aimed at per packed bucket
FLUSH_TOKENS = 2_000_000  # shingles a task packs at a time
PART_TOKENS = 250_000  # of them, those that go out in one Arrow batch
TEXTS = 256  # texts a task holds outside Arrow
SEGMENT = 1024
PIECE_BYTES = 1 << 20

_U = np.uint64
_RNG = np.random.default_rng(5)
_LETTER = _RNG.integers(1, 2**64, 256, dtype=_U)
_LETTER[65:91] = _LETTER[97:123]  # A-Z as a-z
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = _RNG.integers(0, 2**63, SHINGLE, dtype=_U) * _U(2) + _U(1)
_LENGTH = _RNG.integers(1, 2**64, SHINGLE, dtype=_U)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of every word: runs of non-blanks, A-Z as a-z.

    A word's hash is a polynomial in its bytes, taken from running sums; the
    text is handled in pieces cut at blanks, so memory stays bounded."""
    raw = np.frombuffer(data, np.uint8)
    firsts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(at + PIECE_BYTES, len(raw))
        while end < len(raw) and not _BLANK[raw[end - 1]]:
            more = np.flatnonzero(_BLANK[raw[end : end + PIECE_BYTES]])
            end = end + int(more[0]) + 1 if len(more) else min(end + PIECE_BYTES, len(raw))
        piece = raw[at:end]
        word = np.concatenate([[False], ~_BLANK[piece], [False]])
        edge = np.flatnonzero(word[1:] != word[:-1])
        first, last = edge[::2], edge[1::2]
        if len(first):
            power = np.empty(len(piece), _U)
            power[0] = 1
            power[1:] = _BASE
            np.multiply.accumulate(power, out=power)
            sums = np.concatenate([np.zeros(1, _U), np.add.accumulate(_LETTER[piece] * power)])
            back = np.empty(len(piece), _U)
            back[0] = 1
            back[1:] = _BASE_INVERSE
            np.multiply.accumulate(back, out=back)
            firsts.append(first + at)
            hashes.append(_mix((sums[last] - sums[first]) * back[first] + (last - first).astype(_U)))
        at = end
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(firsts), np.concatenate(hashes)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    first, words = word_hashes(b"\n".join(texts) + b"\n")
    bounds = np.searchsorted(first, offsets)
    if len(words) >= SHINGLE:
        n = len(words) - SHINGLE + 1
        rolled = np.zeros(n, _U)
        for k in range(SHINGLE):
            rolled += words[k : k + n] * _PLACE[k]
        rolled = _mix(rolled)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= SHINGLE:
            yield np.unique(rolled[a : b - SHINGLE + 1])
        elif b > a:
            total = _LENGTH[b - a]
            for k in range(b - a):
                total = total + words[a + k] * _PLACE[k]
            yield _mix(np.array([total], _U))
        else:
            yield np.zeros(0, _U)


def _node(hashes: np.ndarray) -> int:
    """64-bit digest of a set: its identity."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray]:
    """Sets of a batch, a bounded amount of text at a time."""
    part: list[bytes] = []
    size = 0
    texts = batch.column(column)
    for at in range(0, len(texts), TEXTS):
        for x in texts.slice(at, TEXTS).cast(pa.binary()).to_pylist():
            part.append(x)
            size += len(x)
            if size >= 4 * PIECE_BYTES:
                yield from shingle_sets(part)
                part, size = [], 0
    if part:
        yield from shingle_sets(part)


def _describe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in it:
            n, node = [], []
            for s in _sets(batch, 1):
                n.append(len(s))
                node.append(_node(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.int64())], names=["_id", "n_shingles", "node"])


# Packed shingles: a row holds, for one bucket, sets (ids, sizes, how many of
# their shingles follow) and the shingles, set after set.
PACKED = "bucket long, nodes binary, sizes binary, counts binary, hashes binary"
_PACKED = pa.schema([("bucket", pa.int64()), ("nodes", pa.binary()), ("sizes", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])


def _pack(bucket: np.ndarray, n_buckets: int, node: np.ndarray, size: np.ndarray, hashes: np.ndarray) -> list[tuple]:
    """Rows of PACKED from one entry per shingle."""
    if not len(bucket):
        return []
    order = np.argsort(bucket.astype(np.uint16) if n_buckets <= 65536 else bucket, kind="stable")
    bucket, node, hashes = bucket[order], node[order], hashes[order]
    new = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (node[1:] != node[:-1])])
    size = size[order[new]]  # one of each run
    counts = np.diff(np.r_[new, len(bucket)]).astype("<u4")
    starts = np.flatnonzero(np.r_[True, np.diff(bucket[new]) != 0])
    ends = np.r_[starts[1:], len(new)]
    out = []
    for a, b in zip(starts, ends, strict=True):
        runs = new[a:b]
        stop = new[b] if b < len(new) else len(bucket)
        out.append((int(bucket[runs[0]]), node[runs].astype("<i8").tobytes(), size[a:b].astype("<u4").tobytes(),
                    counts[a:b].tobytes(), hashes[runs[0] : stop].astype("<u8").tobytes()))
    return out


def _unpack(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, set size, hash) of every packed shingle."""
    counts = np.frombuffer(b"".join(rows["counts"]), "<u4")
    node = np.repeat(np.frombuffer(b"".join(rows["nodes"]), "<i8"), counts)
    size = np.repeat(np.frombuffer(b"".join(rows["sizes"]), "<u4"), counts)
    return node, size, np.frombuffer(b"".join(rows["hashes"]), "<u8")


def _bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((hashes >> _U(33)) % _U(n_buckets)).astype(np.int64)


DEALT = f"direct boolean, {PACKED}"
_DEALT = pa.schema([("direct", pa.bool_()), *_PACKED])


def _by_node(node: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((node.view(_U) >> _U(33)) % _U(n_buckets)).astype(np.int64)


def _packed_parts(direct: bool, bucket_of: Callable[[np.ndarray | slice], np.ndarray], chosen: np.ndarray, owner: np.ndarray,
                  names: np.ndarray, sizes: np.ndarray, h: np.ndarray, n_buckets: int) -> Iterator[pa.RecordBatch]:
    """Batches of DEALT: the chosen shingles, a range of buckets in each."""
    small = np.uint16 if n_buckets <= 65536 else np.uint32
    bucket = np.empty(len(h), small)
    for at in range(0, len(h), PART_TOKENS):
        bucket[at : at + PART_TOKENS] = bucket_of(slice(at, at + PART_TOKENS))
    parts = min(n_buckets, -(-int(np.count_nonzero(chosen)) // PART_TOKENS))
    for part in range(parts):
        low, high = part * n_buckets // parts, (part + 1) * n_buckets // parts
        at = np.flatnonzero(chosen & (bucket >= low) & (bucket < high))
        rows = [(direct, *r) for r in _pack(bucket[at], n_buckets, names[owner[at]], sizes[owner[at]], h[at])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _DEALT.types, strict=True)], schema=_DEALT)


def _deal(n_buckets: int):
    """Shingles of a task's distinct sets, packed by bucket.

    A shingle that several sets of a pack hold is shared for certain: it goes
    straight to the sets' buckets (``direct``), and to its own bucket only
    once, to confirm it to sets elsewhere."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        sets: list[np.ndarray] = []
        nodes: list[int] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            sizes, names = np.array([len(s) for s in sets], np.uint32), np.array(nodes, np.int64)
            h = np.concatenate(sets)
            sets.clear()
            nodes.clear()
            order = np.argsort(h, kind="stable")
            same = h[order[1:]] == h[order[:-1]]
            once, sure = np.ones(len(h), bool), np.zeros(len(h), bool)
            once[order[1:][same]] = False
            sure[order[1:][same]] = sure[order[:-1][same]] = True
            del order, same
            owner = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
            # A range of buckets at a time, so that what is copied stays small.
            yield from _packed_parts(False, lambda at: _bucket(h[at], n_buckets), once, owner, names, sizes, h, n_buckets)
            yield from _packed_parts(True, lambda at: _by_node(names[owner[at]], n_buckets), sure, owner, names, sizes, h, n_buckets)

        with np.errstate(over="ignore"):
            for batch in it:
                for s in _sets(batch, 0):
                    if not len(s):
                        continue
                    node = _node(s)
                    if node in seen:
                        continue
                    seen.add(node)
                    sets.append(s)
                    nodes.append(node)
                    held += len(s)
                    if held >= FLUSH_TOKENS:
                        yield from flush()
                        held = 0
            if sets:
                yield from flush()

    return run


def _shared(n_buckets: int):
    """Keep the shingles that at least two sets hold; deal them out by set."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if key[0]:
            return rows[["bucket", "nodes", "sizes", "counts", "hashes"]]
        h = np.frombuffer(b"".join(rows["hashes"]), "<u8")
        # Shared shingles first, so that of the others nothing more is copied.
        order = np.argsort(h, kind="stable")
        same = h[order[1:]] == h[order[:-1]]
        at = order[np.r_[False, same] | np.r_[same, False]] if len(h) else order
        del order, same
        ends = np.cumsum(np.frombuffer(b"".join(rows["counts"]), "<u4"), dtype=np.int64)
        own = np.searchsorted(ends, at, side="right")
        node = np.frombuffer(b"".join(rows["nodes"]), "<i8")[own]
        size = np.frombuffer(b"".join(rows["sizes"]), "<u4")[own]
        h = h[at]
        del at, own
        # A set that came from several tasks holds a shingle once.
        order = np.lexsort((node, h))
        h, node, size = h[order], node[order], size[order]
        if len(h):
            fresh = np.r_[True, (h[1:] != h[:-1]) | (node[1:] != node[:-1])]
            h, node, size = h[fresh], node[fresh], size[fresh]
            same = h[1:] == h[:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            h, node, size = h[keep], node[keep], size[keep]
        order = np.argsort(node, kind="stable")
        h, node, size = h[order], node[order], size[order]
        out = _pack(_by_node(node, n_buckets), n_buckets, node, size, h)
        return pd.DataFrame(out, columns=["bucket", "nodes", "sizes", "counts", "hashes"])

    return run


def _able(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sets of which enough shingles are shared: node, n, shared hashes; the
    bucket they are in is their chunk."""
    node, size, h = _unpack(rows)
    order = np.lexsort((h, node))
    node, h = node[order], h[order]
    fresh = np.r_[True, (node[1:] != node[:-1]) | (h[1:] != h[:-1])][: len(node)]
    node, order, h = node[fresh], order[fresh], h[fresh]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[starts, len(node)])
    size = size[order[starts]].astype(np.int64)  # one of each set
    ok = counts * DENOMINATOR >= NUMERATOR * size
    return pd.DataFrame({
        "chunk": np.full(int(ok.sum()), key[0], np.int64), "node": node[starts][ok], "n": size[ok],
        "hashes": [h[a : a + c].tobytes() for a, c in zip(starts[ok], counts[ok], strict=True)]})


# Counts of shingles by chunk, and the answers: hashes and how many sets hold each.
COUNTED = "bucket long, chunk long, hashes binary, counts binary"


def _count_chunk(n_buckets: int):
    """How many sets of a chunk hold each shingle, dealt out by shingle."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        h, c = np.unique(np.frombuffer(b"".join(rows["hashes"]), "<u8"), return_counts=True)
        bucket = _bucket(h, n_buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        out = [(int(bucket[part[0]]), key[0], h[part].astype("<u8").tobytes(), c[part].astype("<u4").tobytes())
               for part in np.split(order, cuts) if len(part)]
        return pd.DataFrame(out, columns=["bucket", "chunk", "hashes", "counts"])

    return run


def _sum_counts(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Each chunk's shingles with their counts over all chunks."""
    sizes = [len(x) // 8 for x in rows["hashes"]]
    h, number = np.unique(np.frombuffer(b"".join(rows["hashes"]), "<u8"), return_inverse=True)
    total = np.bincount(number, np.frombuffer(b"".join(rows["counts"]), "<u4"), len(h)).astype("<u4")
    out, at = [], 0
    for chunk, raw, n in zip(rows["chunk"], rows["hashes"], sizes, strict=True):
        out.append((key[0], chunk, raw, np.minimum(total[number[at : at + n]], 2**32 - 1).tobytes()))
        at += n
    return pd.DataFrame(out, columns=["bucket", "chunk", "hashes", "counts"])


def prefix_length(n: int, shared: int) -> int:
    """How many of a set's shared shingles its prefix holds; the unshared
    ones come first in the order."""
    least = -(-NUMERATOR * n // DENOMINATOR)
    return n - least + 1 - (n - shared)


def _prefixes(n_buckets: int):
    """Prefix shingles of a chunk's sets, packed by bucket."""

    def run(_key: tuple, sets: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        known = np.frombuffer(b"".join(answers["hashes"]), "<u8")
        order = np.argsort(known, kind="stable")
        known, held = known[order], np.frombuffer(b"".join(answers["counts"]), "<u4")[order]
        nodes, hashes = [], []
        for node, n, raw in zip(sets["node"], sets["n"], sets["hashes"], strict=True):
            h = np.frombuffer(raw, "<u8")
            count = held[np.searchsorted(known, h)]
            first = np.lexsort((h, count))[: prefix_length(n, len(h))]
            first = first[count[first] > 1]  # held by no other set that can link
            nodes.append(np.full(len(first), node, np.int64))
            hashes.append(h[first])
        out = []
        if nodes:
            node, every = np.concatenate(nodes), np.concatenate(hashes)
            out = _pack(_bucket(every, n_buckets), n_buckets, node, np.zeros(len(node), np.int64), every)
        return pd.DataFrame(out, columns=["bucket", "nodes", "sizes", "counts", "hashes"])

    return run


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _forest(rows: pd.DataFrame) -> pd.DataFrame:
    """Sets of a bucket that share a prefix shingle, as a spanning forest."""
    node, _, h = _unpack(rows)
    names, number = np.unique(node, return_inverse=True)
    order = np.argsort(h, kind="stable")
    h, number = h[order], number[order]
    union, out = _Union(len(names)), []
    for i in np.flatnonzero(h[1:] == h[:-1]):
        if union.join(int(number[i]), int(number[i + 1])):
            out.append((names[number[i]], names[number[i + 1]]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


class _Branch:
    """Trie node: the shingles on the way to it, what lies below, and its
    component while all sets below share one (else -1)."""

    __slots__ = ("below", "ends", "least", "most", "path", "root")

    def __init__(self, path: np.ndarray):
        self.path, self.below, self.ends = path, {}, []
        self.least, self.most, self.root = 1 << 60, 0, -1


class PrefixTrie:
    """Sets of ranks (ascending) under one global order."""

    def __init__(self, universe: int, union: _Union):
        self.top = _Branch(np.zeros(0, np.int64))
        self.mask = np.zeros(universe, bool)
        self.union = union

    def insert(self, s: np.ndarray, number: int, n: int) -> None:
        branch, at, root, fresh = self.top, 0, self.union.find(number), True
        while True:
            empty = branch.least == 1 << 60
            branch.least, branch.most = min(branch.least, n), max(branch.most, len(s) - at)
            if empty:
                branch.root = root
            elif branch.root >= 0 and self.union.find(branch.root) != root:
                branch.root = -1
            if at == len(s):
                branch.ends.append((number, n))
                return
            child = branch.below.get(int(s[at]))
            if child is None:
                child = branch.below[int(s[at])] = _Branch(s[at:])
            m = min(len(child.path), len(s) - at)
            differ = np.flatnonzero(child.path[:m] != s[at : at + m])
            m = int(differ[0]) if len(differ) else m
            if m < len(child.path):  # the paths part here
                upper = _Branch(child.path[:m])
                upper.least, upper.most, upper.root = child.least, child.most + len(child.path) - m, child.root
                upper.below[int(child.path[m])] = child
                branch.below[int(s[at])] = upper
                child.path = child.path[m:]
                child = upper
            branch, at = child, at + m

    def links(self, s: np.ndarray, number: int, n: int) -> list[int]:
        """Sets that link with this one, one per component it was apart from."""
        self.mask[s] = True
        out: list[int] = []
        self._walk(self.top, s, number, n, 0, out)
        self.mask[s] = False
        return out

    def _walk(self, branch: _Branch, s: np.ndarray, number: int, n: int, overlap: int, out: list[int]) -> None:
        stack = [(branch, overlap, len(s))]
        while stack:
            branch, overlap, left = stack.pop()
            if branch.root >= 0 and self.union.find(branch.root) == self.union.find(number):
                continue
            path = branch.path
            if len(path):
                overlap += int(np.count_nonzero(self.mask[path]))
                left = len(s) - int(np.searchsorted(s, path[-1], side="right"))
            least = -(-NUMERATOR * (n + branch.least) // (NUMERATOR + DENOMINATOR))
            if overlap + min(branch.most, left) < least:
                continue
            for other, size in branch.ends:
                if (DENOMINATOR + NUMERATOR) * overlap >= NUMERATOR * (n + size) and self.union.join(number, other):
                    out.append(other)
            stack += [(c, overlap, left) for c in branch.below.values()]


def _ranks(raw: list[bytes]) -> tuple[list[np.ndarray], int]:
    """Sets as ascending ranks: most common shingle first; shingles of one
    set only are left out."""
    sets = [np.frombuffer(r, "<u8") for r in raw]
    if not sets:
        return [], 0
    every, number, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((every, -counts))
    rank = np.empty(len(every), np.int64)
    rank[order] = np.arange(len(every))
    universe = int((counts > 1).sum())
    out, at = [], 0
    for s in sets:
        r = np.sort(rank[number[at : at + len(s)]])
        out.append(r[: np.searchsorted(r, universe)])
        at += len(s)
    return out, universe


def _join_segment(rows: pd.DataFrame) -> pd.DataFrame:
    """Links inside a segment, enough of them for its components; sets of one
    ``known`` component start joined."""
    rows = rows.drop_duplicates("node").sort_values(["n", "node"], ignore_index=True)
    sets, universe = _ranks(rows["hashes"].tolist())
    nodes, sizes = rows["node"].to_numpy(), rows["n"].tolist()
    union, out = _Union(len(rows)), []
    # Known components start joined.
    first: dict[int, int] = {}
    for i, c in enumerate(rows["known"]):
        if not pd.isna(c):
            union.join(i, first.setdefault(int(c), i))
    trie = PrefixTrie(universe, union)
    for i, s in enumerate(sets):
        out += [(nodes[i], nodes[j]) for j in trie.links(s, i, sizes[i])]
        trie.insert(s, i, sizes[i])
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _buckets(total: int, per: int = BUCKET_TOKENS) -> int:
    return max(1, -(-int(total or 0) // per))


def set_links(spark: SparkSession, texts: DataFrame, total_shingles: int) -> DataFrame:
    """(a, b) between set ids: enough links for all components.  ``texts`` has
    one column, the text."""
    n = max(_buckets(total_shingles), spark.sparkContext.defaultParallelism)
    dealt = texts.mapInArrow(_deal(n), DEALT)
    back = dealt.groupBy("direct", "bucket").applyInPandas(_shared(n), PACKED)
    able = materialize(spark, back.groupBy("bucket").applyInPandas(_able, "chunk long, node long, n long, hashes binary"), "join-sets")

    counted = able.select("chunk", "hashes").groupBy("chunk").applyInPandas(_count_chunk(n), COUNTED)
    answers = counted.groupBy("bucket").applyInPandas(_sum_counts, COUNTED)
    prefixes = able.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_prefixes(n), PACKED)
    near = prefixes.groupBy("bucket").applyInPandas(_forest, "a long, b long")
    blocks = connected_components(spark, near).select("node", F.col("component").alias("block"))
    placed = able.join(blocks, "node")
    sizes = blocks.groupBy("block").agg(F.count("*").alias("members"), F.min("node").alias("pivot"))
    segments = sizes.withColumn("segments", F.ceil(F.col("members") / SEGMENT).cast("long"))
    member = placed.join(segments, "block").withColumn("segment", F.pmod(F.xxhash64("node"), F.col("segments")))
    member = materialize(spark, member.select(
        "node", "n", "hashes", "block", "segment", "segments", (F.col("node") == F.col("pivot")).alias("is_pivot")), "join-members")

    none = F.lit(None).cast("long")
    fields = ["block", "segment", "node", "n", "hashes"]
    # Large blocks: their pivot visits every segment.
    pivots = member.where(F.col("is_pivot") & (F.col("segments") > 1)).select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("segments") - 1)).alias("segment"), "node", "n", "hashes")
    first = member.select(*fields).unionByName(pivots).withColumn("known", none)
    links = materialize(spark, first.groupBy("block", "segment").applyInPandas(_join_segment, "a long, b long"), "join-links")

    large = member.where(F.col("segments") > 1)
    if large.isEmpty():
        return links
    found = connected_components(spark, links)
    known = materialize(spark, large.select("block", "node", "segments", "segment").join(found, "node", "left").select(
        "block", "node", "segments", "segment", F.coalesce("component", "node").alias("known")), "join-known")
    main = known.groupBy("block", "known").agg(F.count("*").alias("c")).groupBy("block").agg(
        F.max(F.struct("c", "known")).alias("m")).select("block", F.col("m.known").alias("main"))
    stray = known.join(main, "block").where(F.col("known") != F.col("main"))
    if stray.isEmpty():
        return links
    # Strays in chunks of their own meet every segment of their block.
    chunks = stray.groupBy("block").agg(F.ceil(F.count("*") / SEGMENT).cast("long").alias("chunks"))
    zero = F.lit(0).cast("long")
    a = stray.join(chunks, "block").select(
        "block", "node", "known", F.pmod(F.xxhash64("node", F.lit(1)), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(zero, F.col("segments") - 1)).alias("segment"))
    b = known.join(chunks, "block").select(
        "block", "node", "known", F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("chunk"), "segment")
    both = a.unionByName(b).join(member.select("node", "n", "hashes"), "node")
    more = both.select(*fields, "chunk", "known").groupBy("block", "segment", "chunk").applyInPandas(_join_segment, "a long, b long")
    return links.unionByName(materialize(spark, more, "join-stray-links"))


def jaccard_components(spark: SparkSession, docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """id, n_shingles, component_id of every document.  Ids may be of any type
    that has an order."""
    ship_package(spark)
    d = docs.select(F.col(id_column).alias("_id"), text_or_empty(text).alias("text"))
    described = materialize(spark, d.mapInArrow(
        _describe, f"_id {d.schema[0].dataType.simpleString()}, n_shingles long, node long"), "join-documents")
    total = described.agg(F.sum("n_shingles")).first()[0]
    links = set_links(spark, d.select("text"), total or 0)
    found = connected_components(spark, links)
    # Smallest id per set, then per component, then back.  The small side of
    # either join is written, so that a hot set or component on the other side
    # can be split.
    nodes = described.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("_id").alias("least"))
    nodes = materialize(spark, nodes.join(found, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("class")), "join-nodes")
    smallest = materialize(spark, nodes.groupBy("class").agg(F.min("least").alias("component_id")), "join-classes")
    classes = materialize(spark, nodes.join(smallest, "class").select("node", "component_id"), "join-classes")
    out = described.where(F.col("node").isNotNull()).join(classes, "node").select("_id", "n_shingles", "component_id").unionByName(
        described.where(F.col("node").isNull()).select("_id", "n_shingles", F.col("_id").alias("component_id")))
    return out.withColumnRenamed("_id", id_column)
