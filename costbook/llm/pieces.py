"""Operator 12: SentencePiece encoding and decoding that keeps source offsets.

A text is normalised by longest-prefix matches in the model's compiled character map; what
each normalised byte came from is recorded, so every piece of the encoding is projected
to a span of bytes of the original text.  White space, the dummy prefix and the
replacement of spaces follow the model's normaliser settings.  Encoding merges
neighbouring pieces, best score first and leftmost on ties, and falls back to byte pieces
for unknown ones.  Merges never pass a pair of characters that no piece holds side by
side, so a text is encoded in such segments.  Where the model's scores rule out ties, the
merges of ordinary segments are run by a faster library of equal ids; runs of spaces and
long segments, and models that it can't serve, are merged here.

Byte pieces each cover their own byte.  Where several source characters became one
normalised character, or one became several, each of its pieces covers the whole source.

Edge cases: null and empty texts have no pieces and decode to the empty text; whole texts
are encoded, however long (a segment of n characters takes n log n steps); repeated rows
are encoded each; an empty table gives no rows; other columns are ignored.  Only BPE
models without white space as a suffix are taken, others raise.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices

SPACE = "▁"
#: Segments that a task keeps the encoding of, and the longest one kept.
KEPT, KEPT_LENGTH = 1 << 19, 64
_NORMAL, _UNKNOWN, _CONTROL, _OWN, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


# --- the model file -----------------------------------------------------------------
def _fields(data: bytes):
    """(number, value) of a protocol buffer message's fields."""
    at, end = 0, len(data)

    def number():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < end:
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at:at + size]
        at += size


def character_map(blob: bytes) -> dict[bytes, bytes]:
    """The entries of a compiled character map: a double-array trie, then its replacements."""
    if not blob:
        return {}
    (size,) = struct.unpack_from("<I", blob)
    units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
    texts = blob[4 + size:]
    out: dict[bytes, bytes] = {}
    base = lambda unit: (unit >> 10) << ((unit & 512) >> 6)
    labels = np.arange(1, 256)
    walk = [(b"", int(base(units[0])))]
    while walk:
        key, node = walk.pop()
        at = node ^ labels
        at = np.where(at < len(units), at, 0)
        for byte in labels[(units[at] & 0x800000FF) == labels].tolist():
            unit = int(units[node ^ byte])
            below = node ^ byte ^ base(unit)
            if unit >> 8 & 1:
                start = int(units[below]) & 0x7FFFFFFF
                out[key + bytes([byte])] = texts[start:texts.index(b"\0", start)]
            walk.append((key + bytes([byte]), below))
    return out


class Model:
    """A SentencePiece BPE model read from its file."""

    def __init__(self, data: bytes):
        pieces, normal, trainer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f.get(1, b""), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, _NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normal = dict(_fields(value))
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or any(kind in (_OWN, _UNUSED) for _, _, kind in pieces):
            raise ValueError("only BPE models without own or unused pieces and without white space as a suffix")
        self.kinds = [k for _, _, k in pieces]
        self.names = [p for p, _, _ in pieces]
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == _UNKNOWN), 0)
        self.unknown_surface = trainer.get(44, " ⁇ ".encode()).decode()
        self.prefix, self.trims, self.escapes = (bool(normal.get(k, 1)) for k in (3, 4, 5))
        self.map = {k.decode(): v for k, v in character_map(normal.get(2, b"")).items()}
        self._hits = re.compile("[" + re.escape("".join(sorted({k[0] for k in self.map}))) + "]") if self.map else None
        self._longest = max(map(len, self.map), default=0)
        self.space = SPACE if self.escapes else " "
        # merges: the text of a piece, its place among scores, its id
        words = {p.decode(): i for i, (p, _, k) in enumerate(pieces) if k == _NORMAL}
        self.ids = words
        order = {score: k for k, score in enumerate(sorted({pieces[i][1] for i in words.values()}, reverse=True))}
        self.rank = {w: order[pieces[i][1]] for w, i in words.items()}
        self.beside = {w[k:k + 2] for w in words for k in range(len(w) - 1)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == _BYTE} if trainer.get(35, 0) else {}
        self._kept: dict[str, tuple[int, ...]] = {}
        self._fast = False  # not known yet
        # a run of spaces and what follows, if no piece holds a space after another character
        whole = any(b == self.space and a != b for a, b in self.beside)
        self._cuts = None if whole else re.compile(f"{self.space}*[^{self.space}]+|{self.space}+", re.S)
        self.surface = [b"" if k == _CONTROL else self.unknown_surface.encode() if k == _UNKNOWN else
                        bytes([int(p[3:5], 16)]) if k == _BYTE else p.replace(SPACE.encode(), b" ")
                        for p, k in zip(self.names, self.kinds)]
        self.size = np.array([1 if k == _BYTE else len(p) for p, k in zip(self.names, self.kinds)], dtype=np.int64)
        self.byte_ids = np.array([k == _BYTE for k in self.kinds])
        self.digits = [str(i) for i in range(len(pieces))]

    # --- normalisation ---
    def _mapped(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes before white space is treated, and where each came from."""
        whole = text.encode("utf-8", "replace")
        if self._hits is None or not self._hits.search(text):
            return whole, np.arange(len(whole) + 1)
        out, froms, at, byte = [], [], 0, 0

        def copied(to):
            nonlocal at, byte
            if to > at:
                same = text[at:to].encode("utf-8", "replace")
                out.append(same)
                froms.append(np.arange(byte, byte + len(same)))
                at, byte = to, byte + len(same)

        for hit in self._hits.finditer(text):
            if hit.start() < at:
                continue
            for end in range(min(len(text), hit.start() + self._longest), hit.start(), -1):
                new = self.map.get(text[hit.start():end])
                if new is not None:
                    copied(hit.start())
                    out.append(new)
                    froms.append(np.full(len(new), byte))
                    byte += len(text[at:end].encode("utf-8", "replace"))
                    at = end
                    break
        copied(len(text))
        return b"".join(out), np.concatenate([*froms, [byte]])

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the place in the source's bytes."""
        data, place = self._mapped(text)
        if self.trims and data:  # one space of a run, none at the start; those at the end go last
            x = np.frombuffer(data, np.uint8) == 32
            keep = np.nonzero(~(x & np.concatenate([[True], x[:-1]])))[0]
            data, place = np.frombuffer(data, np.uint8)[keep].tobytes(), np.append(place[keep], place[-1])
        if not data:
            return "", place[-1:]
        if self.escapes:
            x = np.frombuffer(data, np.uint8) == 32
            place = np.append(np.repeat(place[:-1], np.where(x, 3, 1)), place[-1])
            data = data.replace(b" ", SPACE.encode())
        space = self.space.encode()
        if self.prefix:
            data = space + data
            place = np.concatenate([np.full(len(space), place[0]), place])
        if self.trims:
            while data.endswith(space):
                data = data[:-len(space)]
        return data.decode("utf-8", "replace"), place[:len(data) + 1]

    # --- merging ---
    def _merged(self, text: str) -> list[int]:
        """The ids of a segment: the best neighbouring pair is merged until none is a piece."""
        parts: list = list(text)
        n = len(parts)
        rank = self.rank
        if n < 96:  # few pairs: the least of a list is quicker than a heap
            get, none = rank.get, len(rank)
            ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
            while ranks:
                best = min(ranks)
                if best == none:
                    break
                i = ranks.index(best)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get(parts[i - 1] + parts[i], none)
                if i < len(ranks):
                    ranks[i] = get(parts[i] + parts[i + 1], none)
        else:
            left, right = list(range(-1, n - 1)), list(range(1, n + 1))
            heap = [(r, i, i + 1, 2) for i in range(n - 1) if (r := rank.get(parts[i] + parts[i + 1])) is not None]
            heapify(heap)
            while heap:
                _, i, j, size = heappop(heap)
                if parts[i] is None or parts[j] is None or right[i] != j or len(parts[i]) + len(parts[j]) != size:
                    continue
                parts[i] += parts[j]
                parts[j] = None
                right[i] = k = right[j]
                if k < n:
                    left[k] = i
                for a, b in ((left[i], i), (i, k)):
                    if a >= 0 and b < n:
                        r = rank.get(parts[a] + parts[b])
                        if r is not None:
                            heappush(heap, (r, a, b, len(parts[a]) + len(parts[b])))
            parts = [p for p in parts if p is not None]
        out = []
        for p in parts:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in p.encode()]
            else:
                out.append(self.unknown)
        return out

    def _segment(self, text: str) -> tuple[int, ...]:
        """The ids of a segment, cut where no piece reaches across."""
        found = self._kept.get(text)
        if found is None:
            beside = self.beside
            cuts = [k for k, pair in enumerate(map(add, text, text[1:]), 1) if pair not in beside]
            if cuts:  # parts of it stand in other segments, too
                found = tuple(i for a, b in zip([0, *cuts], [*cuts, len(text)]) for i in self._segment(text[a:b]))
            else:
                found = tuple(self._merged(text))
            if len(text) <= KEPT_LENGTH:
                if len(self._kept) >= KEPT:
                    self._kept.clear()
                self._kept[text] = found
        return found

    def _ranked(self):
        """(library, ids by rank): the merges run by a faster library, for segments in which no
        two merges tie and that are short; None where its results could differ.

        Bytes come first, then what joins them to characters, then the pieces by score: so
        characters are whole before any other merge, as they are here.
        """
        if self._cuts is None or not self.bytes:
            return None
        import tiktoken

        ranks = {bytes([b]): b for b in range(256)}
        for c in sorted({c for w in self.ids for c in w}):
            data = c.encode()
            for k in range(2, len(data) + 1):
                ranks.setdefault(data[:k], len(ranks))
        tied = {w for w in self.ids if len(w) > 1 and not w.strip(self.space)}
        for w in sorted((w for w in self.ids if len(w) > 1 and w not in tied), key=self.rank.__getitem__):
            ranks[w.encode()] = len(ranks)
        places = [self.rank[w] for w in self.ids if len(w) > 1 and w not in tied]
        if len(set(places)) != len(places) or any(self._merged(w) != [i] for w, i in self.ids.items() if w not in tied):
            return None  # ties, or pieces that merging never reaches (the library takes them at once)
        names = {w.encode(): i for w, i in self.ids.items()}
        each = [[names[data]] if data in names else [self.bytes[b] for b in data] for data in ranks]
        library = tiktoken.Encoding("pieces", pat_str=self._cuts.pattern, mergeable_ranks=ranks, special_tokens={})
        odd = re.compile(f"{self.space}{{2,}}[^{self.space}]*|{self.space}?[^{self.space}]{{{KEPT_LENGTH},}}", re.S)
        one = np.array([e[0] for e in each])
        return library, each, one, np.array([len(e) > 1 for e in each]), odd

    def encode_normalised(self, text: str) -> list[int]:
        if self._fast is False:
            self._fast = self._ranked()
        out: list[int] = []
        if self._fast is None:
            for s in self._cuts.findall(text) if self._cuts else [text]:
                out += self._segment(s)
            return out
        library, each, one, several, odd = self._fast
        at = 0

        def plain(some: str):
            ranks = np.array(library.encode_ordinary(some), dtype=np.int64)
            if several[ranks].any():
                return [i for r in ranks.tolist() for i in each[r]]
            return one[ranks].tolist()

        for hit in odd.finditer(text):
            if hit.start() > at:
                out += plain(text[at:hit.start()])
            out += self._segment(hit.group())
            at = hit.end()
        if at < len(text):
            out += plain(text[at:])
        return out

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(ids, begins, ends): the pieces and the source bytes that each covers."""
        normal, place = self.normalise(text)
        if not normal:
            return [], np.empty(0, np.int64), np.empty(0, np.int64)
        ids = self.encode_normalised(normal)
        sizes = self.size[ids]
        if not self.bytes:  # an unknown piece is as long as its own text, which only the merges know
            sizes = self._unknown_sizes(normal, ids, sizes)
        ends = np.cumsum(sizes)
        begins, stops = place[ends - sizes], place[ends]
        # a piece that ends inside a replacement covers the whole source of it; the dummy prefix covers nothing
        inside = (stops == place[ends - 1]) & (ends > (len(self.space.encode()) if self.prefix else 0))
        if inside.any():
            steps = np.nonzero(np.diff(place))[0] + 1
            to = np.searchsorted(steps, ends - 1, side="right")
            stops = np.where(inside, place[steps[np.minimum(to, len(steps) - 1)]], stops) if len(steps) else stops
        return ids, begins, stops

    def _unknown_sizes(self, normal: str, ids: list[int], sizes: np.ndarray) -> np.ndarray:
        data, at, out = normal.encode(), 0, sizes.copy()
        for k, i in enumerate(ids):
            if i == self.unknown:  # unknown pieces are single characters
                b = data[at]
                out[k] = 1 if b < 128 else 2 if b < 224 else 3 if b < 240 else 4
            at += int(out[k])
        return out

    # --- decoding ---
    def decode(self, ids) -> str:
        """The text of ids: byte pieces are read as UTF-8, U+FFFD for each byte that isn't."""
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        if self.prefix or self.trims:
            gone = 0
            for i in ids:
                if self.kinds[i] == _CONTROL:
                    continue
                if self.kinds[i] != _NORMAL or not self.names[i].startswith(SPACE.encode()):
                    break
                gone += 1
                if not self.trims or surface[i] != b" ":
                    break
            data = data[gone:]
        try:
            return data.decode()
        except UnicodeDecodeError:
            return _replaced(data)


def _replaced(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(data[at:at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


# --- on Spark -----------------------------------------------------------------------
_models: dict[str, Model] = {}


def load(path: str) -> Model:
    with open(path, "rb") as f:
        return Model(f.read())


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ids, begins, ends (spans of bytes of the source text)."""

    def run(batches):
        m = load(model)
        for part in slices(batches, 64):
            found = [m.encode(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 *[pa.array([f[k] for f in found], pa.list_(pa.int64())) for k in (1, 2)]], names=["id", "ids", "begins", "ends"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, begins array<long>, ends array<long>")


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: the id and the text of its ids."""

    def run(batches):
        m = load(model)
        for part in slices(batches, 64):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([m.decode(ids or ()) for ids in part.column(1).to_pylist()], pa.string())], names=["id", "text"])

    kind = dict(encoded.select(id_col).dtypes)[id_col]
    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")


def digests(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, n_tokens, ids_sha256, decoded_sha256 and spans_crc32 (of the begins, then
    the ends, as little-endian 32-bit numbers), without the pieces themselves."""

    def run(batches):
        m = load(model)
        for part in slices(batches, 64):
            rows = []
            for text in part.column(1).to_pylist():
                ids, begins, ends = m.encode(text or "")
                spans = zlib.crc32(ends.astype("<u4").tobytes(), zlib.crc32(begins.astype("<u4").tobytes()))
                listed = ",".join([m.digits[i] for i in ids])
                rows.append((len(ids), hashlib.sha256(listed.encode()).hexdigest(),
                             hashlib.sha256(m.decode(ids).encode()).hexdigest(), spans))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string()),
                 pa.array(cols[3], pa.int64())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_crc32"])

    kind = dict(docs.select(id_col).dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long")
