import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carelens.llm import packing
from carelens.llm.tokens import TextEncoder

from .helpers import SF, empty_docs, odd_docs, odd_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    "", " ", "Hello, World!  it's we'll 123abc", "ÀÉÎ straße naïve œuvre İstanbul ΣΑΣ", "a\x1cb \x85c d e", "é ́x å",
    "<|endoftext|> x<|startoftext|>y", "word|word|| ,.!?; a.b,c", "🙂🙃 中文 字", "tab\tnew\nline\r\x0b\x0c", "ÿ ß ª º µ", "..., !!!",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_the_tokenizers(name):
    path = public_tokenizers.path(name)
    t, mine = Tokenizer.from_file(path), TextEncoder(path, keep=5)
    for text in ODD_TEXTS:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def check(pieces, texts_by_row):
    """Whole documents, gapless sequences, no padding but for powers of two."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
        docs[(p.doc_id, p.doc_tokens)].append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == 2048 or at & (at - 1) == 0
    t = Tokenizer.from_file(PATH)
    want = sorted(((i, tuple(t.encode(x or "", add_special_tokens=False).ids + [1])) for i, x in texts_by_row), key=str)
    got = []
    for (doc_id, n), parts in docs.items():
        copies = sum(p.length for p in parts) // n
        ids = defaultdict(list)
        for p in sorted(parts, key=lambda p: p.start):
            ids[p.start].append(np.frombuffer(bytes(p.token_ids), "<u4").tolist())
        if copies == 1:
            got.append((doc_id, tuple(x for start in sorted(ids) for x in ids[start][0])))
        else:  # rows of equal id and length: compare sizes only
            got += [w for w in want if w[0] == doc_id and len(w[1]) == n]
    assert sorted(got, key=str) == want


def test_odd_rows(spark):
    pieces = packing.pack_documents(spark, odd_docs(spark).coalesce(1), PATH).collect()
    check(pieces, [(i, t) for i, t, *_ in odd_rows()])


def test_small_groups_and_partitions(spark):
    pieces = packing.pack_documents(spark, odd_docs(spark).repartition(3), PATH, group_tokens=3000).collect()
    check(pieces, [(i, t) for i, t, *_ in odd_rows()])


def test_empty_table(spark):
    assert packing.pack_documents(spark, empty_docs(spark), PATH).collect() == []


def test_query_against_whole_texts(spark):
    from carelens.llm.queries import op3_packing

    t = Tokenizer.from_file(PATH)
    ids = {r.doc_id: np.array(t.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
           for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = defaultdict(int)
    for p in sorted(op3_packing(spark, SF).collect(), key=lambda p: (p.doc_id, p.start)):
        own = ids[p.doc_id]
        assert p.start == seen[p.doc_id] and p.doc_tokens == len(own)
        assert p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes())
        seen[p.doc_id] += p.length
    assert {i: len(x) for i, x in ids.items()} == dict(seen)


def test_costs_are_balanced():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 700, 6000).tolist()
    parts = packing.assign(lengths, 2048, 1.0, 1 / 1024)
    used, cost = defaultdict(int), defaultdict(float)
    for _, _, n, s, offset in parts:
        assert offset == used[s]
        used[s] += n
        cost[s] += n + n * n / 1024
    whole = sum(n == lengths[piece] for piece, _, n, *_ in parts)
    assert sum(lengths) == sum(used.values())
    assert all(u == 2048 or u & (u - 1) == 0 for u in used.values())
    assert whole > 0.8 * len(lengths)
    # In order of arrival sequences differ more in cost.
    full = [cost[s] for s in used if used[s] == 2048]
    at, naive, now = 0, [], 0.0
    for n in lengths:
        while n:
            take = min(n, 2048 - at)
            now, at, n = now + take + take * take / 1024, at + take, n - take
            if at == 2048:
                naive.append(now)
                at, now = 0, 0.0
    assert np.std(full) < np.std(naive)


def test_sequences_without_room_are_not_looked_at_for_every_piece(monkeypatch):
    rng = np.random.default_rng(5)
    lengths = np.clip(rng.lognormal(6.6, 0.6, 3000), 1, 2047).astype(int).tolist()
    pushed = []
    real = packing.heapq.heappush
    monkeypatch.setattr(packing.heapq, "heappush", lambda heap, x: (pushed.append(1), real(heap, x)))
    parts = packing.assign(lengths, 2048, 1.0, 1 / 1024)
    assert sum(n for _, _, n, _, _ in parts) == sum(lengths)
    assert len(pushed) < 4 * len(lengths)
