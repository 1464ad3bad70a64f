"""Tokens of a document's sections, by the characters each token covers.

Every whole text is encoded once. A text's sections are its lines, with the
line end as their last character; token spans are joined to section intervals
by position. A token that covers characters of several sections counts for the
one that holds most of its characters, the earliest of those that hold equally
many; a token that covers none (an empty span) counts for the section it stands
in, the last one at the end of the text. So the sections' tokens add up to the
text's tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from partflow.llm.common import slices
from partflow.llm.tokens import chunk_encoder, tokenizer_json


def line_starts(text: str) -> np.ndarray:
    """Where each line begins; a text has as many lines as it has begun."""
    found, at = [0] if text else [], text.find("\n")
    while 0 <= at < len(text) - 1:
        found.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(found, np.int64)


def attribute(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Each token's section, and whether its span crosses a boundary."""
    first = np.searchsorted(starts, begin, side="right") - 1
    last = np.maximum(np.searchsorted(starts, np.maximum(end - 1, begin), side="right") - 1, first)
    section = first.copy()
    bounds = np.append(starts, length)
    for t in np.flatnonzero(last > first):
        edges = np.clip(bounds[first[t] : last[t] + 2], begin[t], end[t])
        section[t] = first[t] + int(np.argmax(np.diff(edges)))
    return section, last > first


def section_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per section: doc_id, section (from 0), its character interval, tokens.

    ``n_tokens`` counts the tokens allocated to the section, ``n_crossing`` those
    of them that cross a boundary. Null and empty texts have no section and no
    row. Repeated rows give their sections each time. Other columns take no part.
    """
    json = tokenizer_json(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = chunk_encoder(json, spans=True)
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            _, begin, end, at = encoder.encode_spans(batch.column("text"))
            out = []
            for k, body in enumerate(texts):
                starts = line_starts(body)
                if not len(starts):
                    continue
                a, b = begin[at[k] : at[k + 1]], end[at[k] : at[k + 1]]
                section, crossing = attribute(a, b, starts, len(body))
                n = len(starts)
                out.append(
                    (np.full(n, k), np.arange(n), starts, np.append(starts[1:], len(body)), np.bincount(section, minlength=n), np.bincount(section[crossing], minlength=n))
                )
            if out:
                doc, *rest = (np.concatenate(x).astype(np.int64) for x in zip(*out))
                names = ("section", "start_char", "end_char", "n_tokens", "n_crossing")
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(doc)), *map(pa.array, rest)], names=["doc_id", *names])

    rows = docs.selectExpr(f"cast(`{id_column}` as long) as id", f"`{text}` as text")
    return rows.mapInArrow(run, "doc_id long, section long, start_char long, end_char long, n_tokens long, n_crossing long")
