"""Language of a text by rank-order n-gram profiles.

A language's profile ranks its most frequent n-grams of 1 to 3 characters over
all training texts. A text is compared by the out-of-place distance: for each of
its own most frequent n-grams, how far its rank is from the rank in the profile,
or the full penalty if the profile has it not.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from partflow.llm.common import slices, with_fields
from partflow.session import materialize

PROFILE, TEXT_PROFILE = 400, 300
#: Languages that are compared with at a time, which bounds what a worker holds; further ones take further passes.
LANGUAGES = 200
UNKNOWN = "und"
_BITS = 21
_SALTS = 128


class Profiles(NamedTuple):
    """``ranks[i, j]``: rank of n-gram ``grams[i]`` in ``languages[j]``, PROFILE if it has none.

    ``rest`` is a table (lang, top) of the languages behind these by name, None if there are none.
    """

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray
    rest: DataFrame | None = None


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every character: itself if it is a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], np.int64)


def grams(text: str | None) -> np.ndarray:
    """All 1- to 3-grams of the lower-cased letters, runs of others as one blank."""
    codes = np.frombuffer(f" {text or ''} ".lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters()[codes]
    codes = codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))]
    two = codes[:-1] | codes[1:] << _BITS
    three = two[:-1] | codes[2:] << 2 * _BITS
    return np.concatenate([codes[codes != 32], two, three])


def _ranked(text: str, most: int) -> np.ndarray:
    """The text's most frequent n-grams, ties by value."""
    found, counts = np.unique(grams(text), return_counts=True)
    return found[np.argsort(-counts, kind="stable")[:most]]


def learn(texts: DataFrame, text: str = "text", lang: str = "lang", profile: int = PROFILE, languages: int = LANGUAGES) -> Profiles:
    """Profiles of every non-null language of ``texts``, counted over all their n-grams.

    Null texts add nothing; repeated rows count each time. The model holds the
    first ``languages`` by name, and the rest as a table that ``predict`` reads on.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            langs = batch.column("lang").to_pylist()
            bodies = batch.column("text").to_pylist()
            for one in sorted(set(langs)):
                keys, n = np.unique(np.concatenate([grams(t) for t, x in zip(bodies, langs) if x == one]), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([one] * len(keys), pa.string()), "gram": pa.array(keys), "n": pa.array(n, pa.int64())})

    rows = texts.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null and text is not null")
    totals = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A profile's n-grams are among the first of their salt: few rows per language go on.
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(_SALTS))).orderBy(F.desc("n"), "gram")
    first = totals.withColumn("at", F.row_number().over(salted)).filter(F.col("at") <= profile)
    top = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "gram"))), 1, profile)
    return _block(materialize(first.groupBy("lang").agg(top.alias("top")), "language-profiles"), profile, languages)


def _block(table: DataFrame, profile: int, most: int) -> Profiles:
    """The profiles of the first ``most`` languages of (lang, top) by name."""
    found = table.orderBy("lang").limit(most + 1).collect()
    more, found = len(found) > most, found[:most]
    languages = [r["lang"] for r in found]
    of = [[x["gram"] for x in r["top"]] for r in found]
    keys = np.unique(np.array([g for one in of for g in one], np.int64))
    ranks = np.full((len(keys), len(languages)), profile, np.int32)
    for j, one in enumerate(of):
        ranks[np.searchsorted(keys, one), j] = np.arange(len(one))
    return Profiles(languages, keys, ranks, table.filter(F.col("lang") > languages[-1]) if more else None)


def distances(ranked: np.ndarray, model: Profiles, profile: int = PROFILE) -> np.ndarray:
    """Out-of-place distance to every language, as a share of the largest possible."""
    at = np.minimum(np.searchsorted(model.grams, ranked), len(model.grams) - 1)
    known = model.grams[at] == ranked
    own = np.arange(len(ranked))
    apart = np.abs(model.ranks[at[known]] - own[known, None])
    apart = np.where(model.ranks[at[known]] == profile, profile, np.minimum(apart, profile))
    return (apart.sum(0) + profile * int((~known).sum())) / (profile * max(1, len(ranked)))


def predict(docs: DataFrame, model: Profiles, text: str = "text", most: int = TEXT_PROFILE, profile: int = PROFILE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (1 less the distance, 0 to 1).

    The nearest language wins, the first by name of those equally near. A text
    that is null or has no letter is ``und`` with score 0, and so is every text
    if no language was learned. Rows are kept one by one, other columns pass
    through; columns called like the new ones are replaced.
    """
    docs = docs.drop("lang_pred", "score", FAR)
    columns = docs.columns
    docs = docs.mapInArrow(_nearest(model, text, most, profile), with_fields(docs.schema, NEW))
    while model.rest is not None:
        model = _block(model.rest, profile, len(model.languages))
        docs = materialize(docs, "language-pass")
        docs = docs.mapInArrow(_nearest(model, text, most, profile, better=True), docs.schema)
    return docs.select(*[F.col(f"`{c}`") for c in columns], "lang_pred", "score")


FAR = "_language_far"
NEW = f"lang_pred string, score double, {FAR} double"


def _nearest(model: Profiles, text: str, most: int, profile: int, better: bool = False):
    """A pass that appends the nearest of the model's languages, or puts it in place of a farther one."""
    held = model._replace(rest=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 2 << 20):
            kept = batch.columns[:-3] if better else batch.columns
            before = [c.to_pylist() for c in batch.columns[-3:]] if better else None
            new: tuple[list, list, list] = [], [], []
            for i, body in enumerate(batch.column(batch.schema.get_field_index(text)).to_pylist()):
                ranked = _ranked(body, most) if body else np.zeros(0, np.int64)
                row = tuple(c[i] for c in before) if before else (UNKNOWN, 0.0, None)
                # A text without a letter has one n-gram at most, the blank.
                if len(ranked) >= 2 and len(held.grams):
                    far = distances(ranked, held, profile)
                    best = int(np.argmin(far))
                    if row[2] is None or far[best] < row[2]:
                        row = (held.languages[best], float(1 - far[best]), float(far[best]))
                for column, x in zip(new, row):
                    column.append(x)
            names = [*batch.schema.names[: len(kept)], "lang_pred", "score", FAR]
            arrays = [pa.array(new[0], pa.string()), pa.array(new[1], pa.float64()), pa.array(new[2], pa.float64())]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], names=names)

    return run
