"""Cost-balanced packing of documents into training sequences.

A document is its token ids and an end id.  Every whole ``capacity`` of a
document is a sequence of its own; what remains of the documents is packed:
a piece of n tokens costs ``linear * n + quadratic * n^2`` (attention stays
inside a piece), and pieces are assigned, longest first, to the sequence of
lowest cost so far that has room.  The few pieces that fit nowhere whole are
cut to fill the room that is left, cheapest sequence first.

There are exactly as many full sequences as the tokens fill, and the rest
(less than one sequence) goes to sequences whose sizes are powers of two, one
per binary digit, so that nothing is padded at all.

Work is a map over partitions: a task tokenizes its documents and packs them
in groups of ``group_tokens`` tokens.  As every group is packed without any
padding, a wider view could not save a token; no token is ever shuffled and a
task's memory is bounded by a group (or its longest document).  A lost task is
simply run again.

Defined results: NULL text is the empty text and gives one piece, the end id;
NULL or repeated ids and repeated rows are packed row by row; an empty table
gives no piece; other columns are ignored.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.llm.common import ship_package, text_or_empty
from carelens.llm.tokens import TextEncoder

SCHEMA = ("start long, length long, token_ids binary, doc_tokens long, sequence_id long, "
          "offset long, cost double")
GROUP_TOKENS = 4_000_000
KEEP_WORDS = 750_000  # distinct words and pieces a worker remembers, about 200 bytes each


def assign(lengths: list[int], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in piece, length, sequence, offset) of every part;
    ``lengths`` are below ``capacity`` and positive."""
    total = sum(lengths)
    full, rest = divmod(total, capacity)
    room = [capacity] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    used = [0] * len(room)
    cost = [0.0] * len(room)
    out: list[tuple[int, int, int, int, int]] = []

    def put(piece: int, start: int, n: int, s: int) -> None:
        out.append((piece, start, n, s, used[s]))
        used[s] += n
        room[s] -= n
        cost[s] += linear * n + quadratic * n * n

    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    least = lengths[order[-1]] if order else 0
    heap = [(0.0, s) for s in range(full)]
    # Sequences without room for a piece, by their room: as pieces get shorter,
    # each is looked at again only once a piece fits.
    waiting: list[list[tuple[float, int]]] = [[] for _ in range(capacity)]
    looked = capacity
    cut: list[int] = []
    for piece in order:
        n = lengths[piece]
        while looked > n:
            looked -= 1
            for entry in waiting[looked]:
                heapq.heappush(heap, entry)
            waiting[looked] = []
        while heap and room[heap[0][1]] < n:
            entry = heapq.heappop(heap)
            waiting[room[entry[1]]].append(entry)
        if heap:
            chosen = heapq.heappop(heap)[1]
            put(piece, 0, n, chosen)
            if room[chosen] >= least:  # else no later piece fits whole
                heapq.heappush(heap, (cost[chosen], chosen))
        else:
            cut.append(piece)
    open_ = sorted((s for s in range(len(room)) if room[s]), key=lambda s: (s >= full, cost[s], s), reverse=True)
    for piece in cut:
        start = 0
        while start < lengths[piece]:
            s = open_[-1]
            n = min(room[s], lengths[piece] - start)
            put(piece, start, n, s)
            start += n
            if not room[s]:
                open_.pop()
    return out


def _pack_partition(path: str, end_id: int, capacity: int, group_tokens: int, linear: float, quadratic: float, id_type):
    end = struct.pack("<I", end_id)
    schema = pa.schema([("id", id_type), ("start", pa.int64()), ("length", pa.int64()), ("token_ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("cost", pa.float64())])

    def pack(group: list[tuple[object, bytes]], first: int) -> tuple[list[tuple], int]:
        rows, rest, made = [], [], first
        for doc, (_, ids) in enumerate(group):
            n = len(ids) // 4
            whole = n - n % capacity
            for start in range(0, whole, capacity):
                rows.append((doc, start, capacity, made, 0))
                made += 1
            if whole < n:
                rest.append((doc, whole, n - whole))
        parts = assign([r[2] for r in rest], capacity, linear, quadratic)
        rows += [(rest[p][0], rest[p][1] + start, n, made + s, offset) for p, start, n, s, offset in parts]
        return rows, made + 1 + max((s for _, _, _, s, _ in parts), default=-1)

    def batches(group: list[tuple[object, bytes]], rows: list[tuple], base: int) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(rows), 2000):
            part = rows[k : k + 2000]
            yield pa.RecordBatch.from_arrays([
                pa.array([group[d][0] for d, *_ in part], id_type),
                pa.array([r[1] for r in part], pa.int64()),
                pa.array([r[2] for r in part], pa.int64()),
                pa.array([group[d][1][4 * s : 4 * (s + n)] for d, s, n, _, _ in part], pa.binary()),
                pa.array([len(group[d][1]) // 4 for d, *_ in part], pa.int64()),
                pa.array([base + r[3] for r in part], pa.int64()),
                pa.array([r[4] for r in part], pa.int64()),
                pa.array([linear * r[2] + quadratic * r[2] * r[2] for r in part], pa.float64()),
            ], schema=schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(path, KEEP_WORDS)
        base = TaskContext.get().partitionId() << 32
        group: list[tuple[object, bytes]] = []
        size = made = 0
        for batch in it:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.encode(text.as_py()) + end
                group.append((doc_id, ids))
                size += len(ids) // 4
                if size >= group_tokens:
                    rows, made = pack(group, made)
                    yield from batches(group, rows, base)
                    group, size = [], 0
        rows, made = pack(group, made)
        yield from batches(group, rows, base)

    return run


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, text: str = "text", id_column: str = "doc_id",
                   end_id: int = 1, capacity: int = 2048, linear: float = 1.0, quadratic: float = 1.0 / 1024,
                   group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per piece: the id, ``start`` (tokens of its document before
    it), ``length``, ``token_ids`` (little-endian unsigned 32-bit), the
    document's ``doc_tokens``, ``sequence_id``, ``offset`` in the sequence and
    the piece's ``cost``.  ``tokenizer_path`` must exist on every executor."""
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(spark)
    d = docs.select(F.col(id_column), text_or_empty(text))
    kind = d.schema[0].dataType
    return d.mapInArrow(
        _pack_partition(tokenizer_path, end_id, capacity, group_tokens, linear, quadratic, to_arrow_type(kind)),
        f"`{id_column}` {kind.simpleString()}, {SCHEMA}")
