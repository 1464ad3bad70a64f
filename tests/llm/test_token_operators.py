"""Token files, packing and counts against the tokenizers themselves."""

import gc
import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from partflow.llm import elias_fano, packing, token_counts, token_file
from partflow.llm.common import kept_by_worker
from partflow.llm.tokens import ChunkEncoder, chunk_encoder, default_path, tokenizer_json

WORD, BYTE = default_path("word_bpe_49k.json"), default_path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_chunks_give_the_tokenizer_s_ids_and_spans(path, texts):
    rng = random.Random(3)
    odd = ["".join(rng.choice(" \t\n aA1.é'́s!\x1c​ 　\u0085") for _ in range(40)) for _ in range(800)]
    json = tokenizer_json(path)
    tokenizer, encoder = Tokenizer.from_str(json), ChunkEncoder(json, spans=True)
    for some in (odd, texts, []):
        ids, begin, end, starts = encoder.encode_spans(pa.array(some, pa.string()))
        assert encoder.encode(pa.array(some, pa.string()))[0].tolist() == ids.tolist()
        for k, text in enumerate(some):
            got = tokenizer.encode(text or "", add_special_tokens=False)
            at = slice(starts[k], starts[k + 1])
            assert ids[at].tolist() == got.ids, text
            assert list(zip(begin[at].tolist(), end[at].tolist())) == got.offsets, text


def encoded(path, text, end_id):
    return np.array(Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + [end_id], "<u4")


def test_elias_fano():
    rng = np.random.default_rng(1)
    for values in ([0], [7, 7, 7], np.cumsum(rng.integers(0, 3, 1000)), np.cumsum(rng.integers(0, 5000, 3000)), []):
        values = np.asarray(values, np.int64)
        data = elias_fano.encode(values)
        read = elias_fano.Reader(data)
        assert read.size == len(data) and read.all().tolist() == values.tolist()
        assert [read.select(k) for k in range(len(values))] == values.tolist()
    assert len(data) < 100 or len(data) * 8 < 16 * len(values)


def test_token_shards(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_file, "SHARD_BYTES", 2000)
    path = str(tmp_path / "shards")
    token_file.write_token_shards(docs, path, WORD, end_id=1)
    found = token_file.read_token_shards(spark.read.parquet(path)).orderBy("start").collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(found) == len(rows)
    start = 0
    for r, (doc, text) in zip(found, rows):
        ids = encoded(WORD, text, 1)
        assert (r["doc_id"], r["start"], r["n_tokens"], bytes(r["ids"])) == (doc, start, len(ids), ids.tobytes())
        start += len(ids)


def test_token_shards_empty(spark, empty, tmp_path):
    token_file.write_token_shards(empty, str(tmp_path / "none"), WORD, end_id=1)
    assert token_file.read_token_shards(spark.read.parquet(str(tmp_path / "none"))).collect() == []


def test_difference_is_near_equal_and_complete():
    rng = random.Random(5)
    for k in (1, 2, 7, 40):
        sizes = [rng.randrange(1, 257) for _ in range(8 * k)]
        parts = packing.difference(sizes, k)
        assert sorted(i for p in parts for i in p) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in p) for p in parts]
        assert len(parts) == k and max(sums) - min(sums) <= 64
    assert packing.split_group([5, 5, 5], 7) == [[2], [0], [1]] or len(packing.split_group([5, 5, 5], 7)) == 3
    assert packing.split_group([], 7) == []


@pytest.mark.parametrize("capacity", [1024, 16, 1])
def test_packing(docs, capacity):
    rows = docs.filter("text is null or length(text) < 5000") if capacity == 1 else docs
    pieces = packing.pack(rows, BYTE, end_id=0, capacity=capacity).collect()
    want = Counter()
    for r in rows.collect():
        want[r["doc_id"], encoded(BYTE, r["text"], 0).tobytes()] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc, some in by_doc.items():
        copies = {ids: n for (i, ids), n in want.items() if i == doc}
        assert sum(len(p["ids"]) for p in some) == sum(len(ids) * n for ids, n in copies.items())
        for p in some:
            assert p["length"] * 4 == len(p["ids"])
            assert any(ids[4 * p["start"] : 4 * (p["start"] + p["length"])] == bytes(p["ids"]) and len(ids) == 4 * p["doc_tokens"] for ids in copies)
    assert set(by_doc) == {i for i, _ in want}
    for some in by_sequence.values():
        at = 0
        for p in sorted(some, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity


def test_packing_empty(empty):
    assert packing.pack(empty, BYTE, end_id=0).collect() == []


def brute_sections(text, offsets):
    lines = text.split("\n")
    bounds = [0]
    for k, line in enumerate(lines):
        bounds.append(bounds[-1] + len(line) + (k < len(lines) - 1))
    if bounds[-1] == bounds[-2]:
        bounds.pop()
    count, crossing = [0] * (len(bounds) - 1), [0] * (len(bounds) - 1)
    for a, b in offsets:
        shares = [max(0, min(b, hi) - max(a, lo)) for lo, hi in zip(bounds, bounds[1:])]
        best = shares.index(max(shares))
        count[best] += 1
        crossing[best] += sum(s > 0 for s in shares) > 1
    return [(bounds[k], bounds[k + 1], count[k], crossing[k]) for k in range(len(bounds) - 1)]


def test_sections(spark):
    texts = ["one line", "a\nb\n\n\nc  \n\n  d", "\n\n\n", "end\n", "  \n \n x\ny", "é\n　\n𝒳", "", None, "word " * 5000 + "\n" + "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "a\n\nb"), (0, "one line")], "doc_id long, text string")
    tokenizer = Tokenizer.from_file(BYTE)
    want = Counter()
    for r in docs.collect():
        if r["text"]:
            offsets = tokenizer.encode(r["text"], add_special_tokens=False).offsets
            want.update((r["doc_id"], k, *s) for k, s in enumerate(brute_sections(r["text"], offsets)))
    found = token_counts.section_tokens(docs, BYTE).collect()
    assert Counter(tuple(r) for r in found) == want
    assert any(r["n_crossing"] for r in found)


def test_sections_empty(empty):
    assert token_counts.section_tokens(empty, BYTE).collect() == []


def test_crc_of_read_ids(spark, docs, tmp_path):
    path = str(tmp_path / "crc")
    token_file.write_token_shards(docs.filter("doc_id = 3"), path, WORD, end_id=1)
    row = token_file.read_token_shards(spark.read.parquet(path)).selectExpr("crc32(ids) as c", "ids").first()
    assert row["c"] == zlib.crc32(bytes(row["ids"]))


def test_worker_keeps_one_large_thing():
    """An encoder goes when an index is opened, and the other way round."""
    json = tokenizer_json(BYTE)
    first = weakref.ref(chunk_encoder(json))
    assert chunk_encoder(json) is first()
    assert kept_by_worker(("index", 1), lambda: [1]) is kept_by_worker(("index", 1), lambda: [2])
    gc.collect()
    assert first() is None and kept_by_worker(("index", 2), lambda: [3]) == [3]
