"""Benchmark decontamination in DataFrame functions only.

The benchmark's windows (n words, or all words of a shorter item) are few: a
hash set of them travels in the plan. Every document's window hashes are made by
doubling (hashes of 1, 2, 4, 8 words joined), looked up in the set, and each hit
is verified by its words. There is no join and no shuffle: a document's row
stays where it is. Benchmarks of more than ``BLOCK_WINDOWS`` windows are taken
in blocks by window hash, one after the other, so the set in a plan is bounded
and no window is left out.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
BLOCK_WINDOWS = 20_000
#: Hash buckets of the verification table.
BUCKETS = 1 << 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, _BETWEEN), ""), F.array().cast("array<string>"))


def _pairs(left: Column, right: Column, shift: int) -> Column:
    """Hashes of left[i] with right[i + shift]."""
    n = F.greatest(F.size(right) - shift, F.lit(0))
    return F.zip_with(F.slice(left, 1, n), F.slice(right, F.lit(shift + 1), n), lambda a, b: F.xxhash64(a, b))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, wherever the optimizer puts the expression."""
    return F.transform(F.array(value), body)[0]


def window_hashes(w: Column, sizes: list[int]) -> Column:
    """A struct of window hashes of ``w``, field ``h<size>`` for every size."""

    def of_size(size: int, powers: dict[int, Column]) -> Column:
        parts = [p for p in powers if size & p]
        out, done = powers[parts[0]], parts[0]
        for p in parts[1:]:
            out, done = _pairs(out, powers[p], done), done + p
        return out.alias(f"h{size}")

    def doubled(power: int, powers: dict[int, Column]) -> Column:
        if 2 * power > max(sizes):
            return F.struct(*[of_size(size, powers) for size in sizes])
        half = powers[power]
        return _let(_pairs(half, half, power), lambda h: doubled(2 * power, {**powers, 2 * power: h}))

    return _let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: doubled(1, {1: h}))


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(size, hash, window, items): every distinct window with the items that hold it.

    Items without words, and null item ids, have none.
    """
    it = items.select(F.col("item_id").cast("string").alias("item"), words("text").alias("w")).filter("item is not null and size(w) > 0")
    size = F.least(F.size("w"), F.lit(window))
    start = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    text = F.array_join(F.slice("w", F.col("at"), F.col("size")), " ")
    rows = it.select("item", "w", size.alias("size"), start.alias("at")).select("item", "size", text.alias("window"), F.slice("w", F.col("at"), F.col("size")).alias("w"))
    return rows.groupBy("size", "window").agg(F.first("w").alias("w"), F.array_sort(F.collect_set("item")).alias("items"))


def _blocks(windows: DataFrame) -> list[list]:
    """The windows on the driver, in blocks of bounded size."""
    total = windows.count()
    blocks = max(1, -(-total // (BLOCK_WINDOWS // 2)))
    if blocks == 1:
        return [windows.collect()]
    return [windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b).collect() for b in range(blocks)]


def _lookup_table(rows: list) -> Column:
    """BUCKETS lists of (window, items), constant in the plan."""
    buckets: list[list] = [[] for _ in range(BUCKETS)]
    for r in rows:
        buckets[r["hash"] % BUCKETS].append({"w": r["window"], "i": r["items"]})
    return F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<w:string,i:array<string>>>>")


def _found(w: Column, hashes: Column, size: int, keys: list[int], table: Column) -> Column:
    """The hits of one size: places whose hash is in the set, verified by their words."""
    places = F.filter(F.transform(hashes, lambda h, i: F.when(h.isin(keys), i)), lambda i: i.isNotNull())

    def verified(i: Column) -> Column:
        said = F.array_join(F.slice(w, i + 1, F.lit(size)), " ")
        bucket = F.element_at(table, F.pmod(F.element_at(hashes, i + 1), F.lit(BUCKETS)).cast("int") + 1)
        same = F.filter(bucket, lambda x: x["w"] == said)
        return F.struct(i.alias("start"), F.lit(size).alias("size"), F.flatten(F.transform(same, lambda x: x["i"])).alias("items"))

    return F.filter(F.transform(places, verified), lambda h: F.size(h["items"]) > 0)


def mark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text", words_column: str = "_words", hits_column: str = "_hits") -> DataFrame:
    """``docs`` with its words and ``hits``: (start, size, items) of every benchmark window.

    ``start`` counts words from 0. A null or empty text has no words and no hits.
    Rows are not merged; all other columns pass through, and columns that are
    called like the two new ones are replaced.
    """
    docs = docs.withColumn(words_column, words(text))
    found = benchmark_windows(items, window)
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())
    none = F.array().cast("array<struct<start:int,size:int,items:array<string>>>")
    if not sizes:
        return docs.withColumn(hits_column, none)
    by_size = F.coalesce(*[F.when(F.col("size") == n, window_hashes(F.col("w"), [n])[f"h{n}"][0]) for n in sizes])
    blocks = [(_lookup_table(rows), rows) for rows in _blocks(found.select("size", by_size.alias("hash"), "window", "items"))]

    def hits(w: Column) -> Column:
        def of(hashes: Column) -> Column:
            every = [none]
            for table, rows in blocks:
                for size in sizes:
                    keys = [r["hash"] for r in rows if r["size"] == size]
                    if keys:
                        every.append(_found(w, hashes[f"h{size}"], size, keys, table))
            return F.concat(*every)

        return _let(window_hashes(w, sizes), of)

    return docs.withColumn(hits_column, _let(F.col(words_column), hits))


def words_hit(hits: str) -> Column:
    """How many words lie inside any hit."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, h: Column) -> Column:
        end = F.greatest(acc["end"], h["start"] + h["size"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], F.least(h["start"], end))).alias("n"))

    in_order = F.array_sort(F.transform(hits, lambda h: F.struct(h["start"].alias("start"), h["size"].alias("size"))))
    return F.aggregate(in_order, start, add)["n"].cast("long")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted strings) and contaminated."""
    marked = mark_hits(docs, items, window, text)
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["items"]))))
    return marked.withColumns(
        {"n_words": F.size("_words").cast("long"), "n_hit": words_hit("_hits"), "item_ids": ids, "contaminated": F.size("_hits") > 0}
    ).drop("_words", "_hits")
