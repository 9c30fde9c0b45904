"""Operator 5: packing documents into sequences by order-preserving dynamic programming.

Documents keep their order within an input partition.  Each is tokenised and ended
by ``end_id``; the ids form one stream that is cut into windows of at most ``window``
ids.  Cuts may stand at document ends (free), at sentence ends (``sentence_cost``
ids) and, where a sentence alone exceeds a window, inside it (``forced_cost``).  The
cuts minimise padding plus these penalties: with padding ``window - (x - y)`` for a
window from y to x, the best y for each x is the minimum of cost(y) + y over the
positions within reach, kept in a monotone queue; windows whose length is a power of
two need no padding and are tried besides.

The stream is solved in blocks; the windows of a block's last ``TAIL`` ids are not
settled but solved again with the next block, so that only a partition's last window
is short for want of text.  Memory is one block plus the longest document.

Edge cases: null and empty texts are the end id alone; a document longer than a
window is cut into several pieces; repeated rows are packed once each; an empty table
gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import slices

#: Ids of a block, and of its end that is solved again with what follows.
BLOCK, TAIL = 1 << 18, 1 << 13
#: The split before merges that goes with the vocabulary's byte-level pre-tokenizer (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of texts by the tokenizer file.

    Byte-level BPE whose ids are merge ranks is run by a faster library that gives the
    same ids; texts that hold a special token's string, and files of any other kind,
    go through the file's own library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec.get("added_tokens", ())]
        vocab = spec["model"]["vocab"]
        size = self.own.get_vocab_size()
        strings = [self.own.id_to_token(i) or "" for i in range(size)]
        self.sentence_end = np.array([s[-1:] in (".", "!", "?", "Ċ") for s in strings])
        self.fast = self._ranks(spec, vocab)

    def _ranks(self, spec, vocab):
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            return None
        import tiktoken

        # the printable stand-ins of byte-level vocabularies: printable bytes are themselves, the rest follow from 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        table = {chr(b): b for b in plain}
        table.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
        ranks = {bytes(table[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        probe = "It's 2,048 words.\n\n  Größe und  naïve\tçé 漢字 #1!"
        same = fast.encode_ordinary(probe) == self.own.encode(probe, add_special_tokens=False).ids
        return fast if same else None

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is None or any(s in text for s in self.special):
            return np.array(self.own.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)


def cuts(ends: np.ndarray, sentences: np.ndarray, window: int, sentence_cost: float, forced_cost: float) -> list[int]:
    """The best cut positions of a stream, its end included.

    ``ends``: positions of document ends, the last one the stream's; ``sentences``:
    positions after sentence ends.
    """
    kinds = {int(p): forced_cost for p in _forced(np.union1d(ends, sentences), window)}
    kinds.update((int(p), sentence_cost) for p in sentences)
    kinds.update((int(p), 0.0) for p in ends)
    at = [0, *sorted(p for p in kinds if p > 0)]
    cost, back, index = [0.0], [0], {0: 0}
    queue = deque([0])
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    for j in range(1, len(at)):
        x = at[j]
        while at[queue[0]] < x - window:
            queue.popleft()
        i = queue[0]
        best = cost[i] + window - (x - at[i])
        for p in powers:
            k = index.get(x - p)
            if k is not None and cost[k] < best:
                best, i = cost[k], k
        best += kinds[x]
        cost.append(best)
        back.append(i)
        index[x] = j
        key = best + x
        while queue and cost[queue[-1]] + at[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    out, j = [], len(at) - 1
    while j:
        out.append(at[j])
        j = back[j]
    return out[::-1]


def _forced(marks: np.ndarray, window: int) -> list[int]:
    """Positions that leave no gap over ``window`` between allowed cuts."""
    marks = np.concatenate([[0], marks])
    wide = np.nonzero(np.diff(marks) > window)[0]
    return [p for k in wide for p in range(int(marks[k]) + window, int(marks[k + 1]), window)]


class _Stream:
    """The ids of the documents that are not yet in settled windows."""

    def __init__(self, encode: Encoder, window: int, end_id: int, sentence_cost: float, forced_cost: float):
        self.encode, self.window, self.end_id = encode, window, end_id
        self.costs = (sentence_cost, forced_cost)
        self.docs: deque = deque()  # [doc, ids, ids already placed]
        self.size = 0

    def add(self, doc, text: str) -> None:
        ids = np.append(self.encode(text or ""), np.uint32(self.end_id))
        self.docs.append([doc, ids, 0])
        self.size += len(ids)

    def windows(self, last: bool):
        """Lists of pieces (doc, start, ids, doc_tokens), one list per settled window."""
        if not self.size:
            return
        lengths = np.array([len(ids) - at for _, ids, at in self.docs])
        ends = np.cumsum(lengths)
        stream = np.concatenate([ids[at:] for _, ids, at in self.docs])
        marks = np.nonzero(self.encode.sentence_end[np.minimum(stream, len(self.encode.sentence_end) - 1)])[0] + 1
        settled = self.size if last else self.size - TAIL
        begin = 0
        for end in cuts(ends, marks, self.window, *self.costs):
            if end > settled:
                break
            yield self._take(end - begin)
            begin = end

    def _take(self, n: int):
        pieces = []
        while n:
            doc, ids, at = self.docs[0]
            k = min(n, len(ids) - at)
            pieces.append((doc, at, ids[at:at + k], len(ids)))
            self.size -= k
            n -= k
            if at + k == len(ids):
                self.docs.popleft()
            else:
                self.docs[0][2] = at + k
        return pieces


_NAMES = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text", sentence_cost: float = 4.0, forced_cost: float = 64.0, with_ids: bool = False) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids``, if asked for).  Sequences are numbered within their input partition, and
    the partition's number stands above bit 33, so no step waits for another."""

    def run(batches):
        encode = Encoder(tokenizer)
        stream = _Stream(encode, window, end_id, sentence_cost, forced_cost)
        number = TaskContext.get().partitionId() << 33
        ids_of: list = []
        rows: dict[str, list] = {}
        kind = None

        def flush():
            arrays = [pa.array(rows.pop("id"), kind), *[pa.array(rows.pop(c), pa.int64()) for c in _NAMES]]
            names = ["id", *_NAMES]
            if with_ids:
                arrays.append(pa.array(ids_of, pa.list_(pa.int64())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def settle(last):
            nonlocal number, ids_of
            ids_of = []
            rows.update({c: [] for c in ("id", *_NAMES)})
            for pieces in stream.windows(last):
                offset = 0
                for doc, start, ids, total in pieces:
                    for c, v in zip(("id", *_NAMES), (doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                                                      total, number, offset)):
                        rows[c].append(v)
                    if with_ids:
                        ids_of.append(ids.tolist())
                    offset += len(ids)
                number += 1
            return flush()

        for part in slices(batches, 64):
            kind = part.column(0).type
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                stream.add(doc, text)
                if stream.size >= BLOCK:
                    yield settle(False)
        if kind is not None:
            yield settle(True)

    kind = dict(docs.select(id_col).dtypes)[id_col]
    out = f"`{id_col}` {kind}, " + ", ".join(f"{c} long" for c in _NAMES) + (", ids array<long>" if with_ids else "")
    return docs.select(id_col, text_col).mapInArrow(run, out)
