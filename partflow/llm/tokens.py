"""Public tokenizers over whole texts, each distinct chunk encoded once per worker.

The tokenizers used here never join what stands on the two sides of the start
of a run of white space, so a text can be cut before any white space that
follows another character, and its ids are the chunks' ids one after another.
Chunks repeat; a worker keeps the ids of those it has met, under 128 bits of hash.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from partflow.llm.common import kept_by_worker
from partflow.llm.words import NOT_SPACE, Words, hash_words, text_bytes

#: Ids and chunks a worker keeps before it starts anew; a bound of memory only.
KEPT_IDS, KEPT_CHUNKS = 1 << 24, 1 << 22
_BLANKS = " \t\n\x0b\x0c\r"
#: White space of two and three bytes in UTF-8, as last bytes: U+0085 and U+00A0; the rest of White_Space.
_TWO = (0xC285, 0xC2A0)
_THREE = (0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080)


def tokenizer_json(path: str) -> str:
    """The tokenizer file's content, read on the driver to travel with the tasks."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def default_path(name: str) -> str:
    return public_tokenizers.path(name)


def chunks(texts: pa.Array) -> Words:
    """The texts cut before every ASCII white space that no white space stands before."""
    data, offsets = text_bytes(texts)
    n = len(data)
    cut = np.zeros(n, bool)
    if n:
        solid = NOT_SPACE[data]
        cut[1:] = ~solid[1:] & solid[:-1]
        # A cut behind Unicode white space would part a run of it.
        at = np.flatnonzero(cut[1:] & (data[:-1] >= 0x80)) + 1
        wide = data.astype(np.int64)
        two = (wide[at - 2] << 8) + wide[at - 1]
        three = (wide[np.maximum(at - 3, 0)] << 16) + two
        cut[at[np.isin(two, _TWO) | np.isin(three, _THREE)]] = False
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(cut)
    doc = np.searchsorted(offsets, start, side="right") - 1
    return Words(data, start, np.diff(start, append=n), doc, len(texts))


class ChunkEncoder:
    """Ids of whole texts, and where in its chunk each token begins and ends."""

    def __init__(self, json: str, spans: bool = False):
        self.tokenizer = Tokenizer.from_str(json)
        self.spans = spans
        self._clear()

    def _clear(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.ids, self.begin, self.end = (np.zeros(0, np.uint32) for _ in range(3))

    def _add(self, texts: list[str], keys: np.ndarray, checks: np.ndarray) -> None:
        """Encode new chunks: those that begin with a blank as one text, the rest one by one."""
        ids, spans, sizes = [], [], np.zeros(len(texts), np.int64)
        joined = np.array([t[0] in _BLANKS and not t[-1].isspace() for t in texts])
        order = np.concatenate([np.flatnonzero(joined), np.flatnonzero(~joined)])
        many = int(joined.sum())
        groups = [order[k : min(k + 4096, many)] for k in range(0, many, 4096)] + [order[k : k + 1] for k in range(many, len(order))]
        for group in groups:
            some = [texts[i] for i in group]
            got = self.tokenizer.encode("".join(some), add_special_tokens=False)
            ends = np.cumsum([len(t) for t in some])
            at = np.array(got.offsets, np.int64).reshape(-1, 2)
            owner = np.searchsorted(ends, at[:, 0], side="right")
            sizes[group] = np.bincount(owner, minlength=len(some))
            ids.append(np.array(got.ids, np.uint32))
            if self.spans:
                spans.append(at - (ends - np.diff(ends, prepend=0))[owner][:, None])
        known = len(self.first) - 1
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes[order])])
        self.ids = np.concatenate([self.ids, *ids])
        if self.spans:
            every = np.concatenate(spans).astype(np.uint32)
            self.begin, self.end = np.concatenate([self.begin, every[:, 0]]), np.concatenate([self.end, every[:, 1]])
        self.keys = np.concatenate([self.keys, keys[order]])
        self.checks = np.concatenate([self.checks, checks[order]])
        self.place = np.concatenate([self.place, np.arange(known, known + len(order))])
        rank = np.argsort(self.keys, kind="stable")
        self.keys, self.checks, self.place = self.keys[rank], self.checks[rank], self.place[rank]

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the chunks of these hashes are kept, and which are not."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.ones(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        if (self.checks[at] != checks)[known].any():
            raise ValueError("two chunks of one hash")
        return self.place[at], ~known

    def _tokens(self, cut: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places in the pool of all chunks' tokens, and how many each chunk has."""
        if not len(cut.start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.ids) > KEPT_IDS or len(self.keys) > KEPT_CHUNKS:
            self._clear()
        keys, one, which = np.unique(hash_words(cut), return_index=True, return_inverse=True)
        checks = hash_words(Words(cut.data, cut.start[one], cut.length[one], cut.doc[one], cut.docs), 1)
        place, missing = self._find(keys, checks)
        if missing.any():
            body = cut.data.tobytes()
            new = np.flatnonzero(missing)
            texts = [body[s : s + n].decode() for s, n in zip(cut.start[one[new]].tolist(), cut.length[one[new]].tolist())]
            self._add(texts, keys[new], checks[new])
            place, _ = self._find(keys, checks)
        place = place[which]
        size = self.first[place + 1] - self.first[place]
        ends = np.cumsum(size)
        return np.arange(ends[-1]) + np.repeat(self.first[place] - (ends - size), size), size

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where each text's begin."""
        cut = chunks(texts)
        at, size = self._tokens(cut)
        return self.ids[at], _text_starts(size, cut)

    def encode_spans(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``, with every token's character span in its text."""
        cut = chunks(texts)
        at, size = self._tokens(cut)
        starts = _text_starts(size, cut)
        chars = np.concatenate([[0], np.cumsum((cut.data & 0xC0) != 0x80)])
        if not len(at):
            return self.ids[at], at, at, starts
        of_text = chars[cut.start[cut.first()[cut.doc]]]
        shift = np.repeat(chars[cut.start] - of_text, size)
        return self.ids[at], self.begin[at] + shift, self.end[at] + shift, starts


def chunk_encoder(json: str, spans: bool = False) -> ChunkEncoder:
    """The worker's encoder: the next task of the same worker goes on with its chunks."""
    return kept_by_worker(("encoder", json, spans), lambda: ChunkEncoder(json, spans))


def _text_starts(size: np.ndarray, cut: Words) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size)])[cut.first()]
