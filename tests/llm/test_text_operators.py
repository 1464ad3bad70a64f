"""Near-dedup, substring dedup, decontamination and WARC against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from partflow.llm import common, decontaminate, near_dedup, substring_dedup, warc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(rows):
    """Smallest reachable id per id, by comparing all pairs."""
    sets = defaultdict(set)
    for i, t in rows:
        if i is not None:
            sets[i].add(shingles(t))
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                hit = any(x and y and 100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b])
                if hit and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_near_duplicates(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    label = components(rows)
    found = near_dedup.near_duplicates(docs).collect()
    want = Counter((i, len(shingles(t)), label.get(i), i is None or label[i] == i) for i, t in rows)
    assert Counter(tuple(r) for r in found) == want
    assert any(i is not None and label[i] != i for i, _ in rows)


def test_near_duplicates_in_chains_and_crowds(spark):
    """Chains whose ends are not alike, and a crowd around one passage that is not."""
    base = [f"t{i}" for i in range(200)]
    chain = [" ".join(base[:k] + [f"n{k}"] * k + base[k:]) for k in range(0, 24, 2)]
    passage = " ".join(f"p{i}" for i in range(30))
    crowd = [f"{passage} " + " ".join(f"c{k}_{i}" for i in range(30)) for k in range(40)]
    copies = [" ".join(base[:100] + [f"v{k}"] + base[101:]) for k in range(60)]
    rows = list(enumerate(chain + crowd + copies))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == components(rows)


def test_near_duplicates_empty(empty):
    assert near_dedup.near_duplicates(empty).collect() == []


def kept_words(rows, size):
    seen = Counter(tuple(w[i : i + size]) for w in rows for i in range(len(w) - size + 1))
    for w in rows:
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        yield [x for x, g in zip(w, gone) if not g]


def test_repeats_for_every_number_of_rounds(docs):
    rows = [(r["doc_id"], words(r["text"])) for r in docs.collect()]
    for window, rounds in ((35, 6), (35, 0), (5, 3), (2, 9)):
        want = Counter((i, len(w), len(w) - len(k), " ".join(k)) for (i, w), k in zip(rows, kept_words([w for _, w in rows], window)))
        out = substring_dedup.remove_repeats(docs, window=window, rounds=rounds)
        assert set(out.columns) == {*docs.columns, "n_words", "n_removed", "kept_text"}
        found = Counter(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_text").collect())
        assert found == want, (window, rounds)


def test_repeats_empty(empty):
    assert substring_dedup.remove_repeats(empty).collect() == []


def bench_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute_contamination(rows, items, size=10):
    held = defaultdict(set)
    for item, text in items:
        w = bench_words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            held[tuple(w[i : i + n])].add(str(item))
    for i, text in rows:
        w, hit, ids = bench_words(text), set(), set()
        for n in {len(k) for k in held}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in held:
                    hit |= set(range(at, at + n))
                    ids |= held[tuple(w[at : at + n])]
        yield i, len(w), len(hit), tuple(sorted(ids)), bool(hit)


def test_contamination(spark, docs, texts, monkeypatch):
    items = [(1, texts[8]), (20, texts[8][30:160]), (3, "one two three four"), (4, "Ärger ärger"), (5, None), (6, ""), (None, "one"), (7, "of no document at all and none"), (3, "egg")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = Counter(brute_contamination(rows, items))
    assert any(r[4] for r in want) and not all(r[4] for r in want)
    for block in (20_000, 6):
        monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
        out = decontaminate.contamination(docs, bench)
        found = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"]), r["contaminated"]) for r in out.collect())
        assert found == want
    plan = out._jdf.queryExecution().executedPlan().toString().replace("Exchange RoundRobinPartitioning", "")
    assert "Python" not in plan and "InArrow" not in plan and "Exchange" not in plan


def test_contamination_empty(spark, docs, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, bench).filter("contaminated").count() == 0
    assert decontaminate.contamination(empty, bench.union(docs.select("doc_id", "text"))).collect() == []


def brute_warc(rows):
    last = defaultdict(lambda: None)
    facts = []
    for page, html in rows:
        body = (html or "").encode()
        digest = hashlib.sha1(body).hexdigest()
        facts.append((page, len(body), digest))
        if len(body) >= 1000 and page is not None:
            last[digest] = page if last[digest] is None else max(page, last[digest])
    for page, n, digest in facts:
        top = last[digest] if n >= 1000 else None
        refers = top if top is not None and (page is None or page < top) else None
        yield page, n, digest, "response" if refers is None else "revisit", refers


def test_warc_round_trip(spark, tmp_path, docs):
    big = "é" * 700
    nested = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = [None, "", "short", "short", big, big, big, nested, nested * 30, nested * 30, "x\r\n\r\n", "WARC/1.0\r\n", f"{big}\r\n\r\n{nested}", "a" * 1_000_000]
    rows = [(i, f"http://a/{i}\r\nX: y" if i % 3 else None, h, "x", "y") for i, h in enumerate(html)] + [(None, "u", big, "x", "y"), (6, "u", big, "x", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, size string")
    for records in (4, 1000):
        path = str(tmp_path / f"warc{records}")
        warc.write_archives(pages, path, records)
        out = warc.read_archives(spark, path, payloads=True)
        found = out.collect()
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert Counter(tuple(r[n] for n in names) for r in found) == Counter(brute_warc([(r[0], r[2]) for r in rows]))
        assert all(r["intact"] for r in found)
        bodies = Counter(bytes(r["payload"]) for r in found if r["record_type"] == "response")
        assert bodies[(nested * 30).encode()] == 1 and bodies[big.encode()] == 2
        # Version lines inside payloads are found, and rejected.
        assert warc.findings(spark, path).filter(F.col("page_id") == 999).count() > 0


def test_warc_empty(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).collect() == []


@pytest.mark.parametrize("table", [near_dedup.sketches, near_dedup.full_sets])
def test_near_dedup_makes_room(monkeypatch, table):
    """What a worker kept for an earlier stage is gone before the first text is read."""
    monkeypatch.setattr(common, "_kept", {"index": 1})
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1], pa.int64()), "text": ["a b c d e f"]})

    class Docs:
        def mapInArrow(self, function, ddl):
            return [b.num_rows for b in function(iter([batch]))], dict(common._kept)

    assert table(Docs(), 5, 36) == ([1], {})
