"""SentencePiece encoding by sampling, and decoding.

A text's lattice has an edge for every vocabulary piece at every place, and edges
of byte pieces for characters that no piece holds.  A piece of rank r weighs
(r + 2)^-alpha (a merge vocabulary has ranks, not probabilities).  Forward filtering
sums the weights of all segmentations of every prefix; backward sampling then
draws the pieces from the end, each in proportion to its share.  A draw depends on
the row's key and the place only, so a row is segmented alike in every run and in
every batch.

The lattice falls apart where no piece can cross: before white space that
follows other text, and around control characters.  Each different part of a
batch is filtered once, in groups of bounded size, and all occurrences of a group's parts are sampled at once.
A part of over ``LONG`` bytes (text without white space) is filtered alone: it keeps a sum a byte and finds its
edges again where it is sampled.

Space becomes the piece sign and one is put in front, as the vocabulary expects; a
piece sign in the text itself is kept as bytes.  So decoding gives back every text,
the empty one as no pieces.  Nulls: a null text has null pieces and decodes to
null; a null key is a key.  Repeated rows are segmented alike.  An empty table
gives none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import process_cache, release_memory, slices

MODEL = "piece_bpe_32k.model"
ALPHA = 1.0              # 0: all segmentations alike; larger: frequent pieces and fewer of them
SEED = 7
SLICE = 1 << 19          # bytes of text segmented together
RESCALE = 16             # bytes after which the sums are brought back into range
GROUP = 1 << 17          # bytes of different parts filtered together
LONG = 512               # bytes of a part that is filtered alone
SIGN = "▁"
#: Parts that no piece crosses: spaces with what follows, or one control character.
PART = re.compile(rb" +[^ \x00-\x1f]*|[^ \x00-\x1f]+|[\x00-\x1f]")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Codec:
    """Vocabulary, its trie over reversed bytes, and the two directions."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        vocab = sentencepiece.SentencePieceProcessor(model_file=path)
        size = vocab.get_piece_size()
        self.bytes_of: list[bytes] = []          # by id, with the piece sign as a space
        self.byte_id = np.zeros(256, np.int32)
        self.likely = np.zeros(size)
        pieces, rank = {}, 0
        for i in range(size):
            piece = vocab.id_to_piece(i)
            if vocab.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes_of.append(bytes([value]))
            elif vocab.is_control(i) or vocab.is_unknown(i) or vocab.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.likely[i] = (rank + 2.0) ** -alpha
                rank += 1
                self.bytes_of.append(piece.replace(SIGN, " ").encode())
                pieces[self.bytes_of[-1]] = i
        self.likely[self.byte_id] = (rank + 2.0) ** -alpha
        self.longest = max(map(len, pieces))
        self._build({b: i for b, i in pieces.items() if not re.search(rb"[\x00-\x1f]", b)})

    def _build(self, pieces: dict[bytes, int]) -> None:
        nodes: list[dict[int, int]] = [{}]
        ends = [-1]
        for piece, i in pieces.items():
            at = 0
            for b in reversed(piece):
                to = nodes[at].get(b)
                if to is None:
                    to = nodes[at][b] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = to
            ends[at] = i
        inner = [n for n, to in enumerate(nodes) if to]                # leaves need no row
        number = np.full(len(nodes), -1, np.int64)
        number[inner] = np.arange(len(inner))
        number[[n for n, to in enumerate(nodes) if not to]] = np.arange(len(inner), len(nodes))
        self.inner = len(inner)
        self.step = np.zeros((len(inner), 256), np.int32)              # 0: no such node (the root is nobody's child)
        for n in inner:
            for b, to in nodes[n].items():
                self.step[number[n], b] = number[to]
        self.piece = np.empty(len(nodes), np.int32)
        self.piece[number] = ends

    # ---- forward filtering -----------------------------------------------------------

    def _covered(self, data: np.ndarray) -> np.ndarray:
        """For each byte: whether its character is a piece."""
        lead = (data & 0xC0) != 0x80
        starts = np.flatnonzero(lead)
        ends = np.append(starts[1:], len(data))
        node = np.zeros(len(starts), np.int32)
        open_ = np.ones(len(starts), bool)
        for back in range(1, 5):
            at = ends - back
            here = open_ & (at >= starts)
            ok = here & (node < self.inner)
            to = np.zeros(len(starts), np.int32)
            to[ok] = self.step[node[ok], data[at[ok]]]
            node = np.where(here, to, node)
            open_ &= ~here | (to > 0)
        found = open_ & (node > 0) & (self.piece[node] >= 0)
        return np.repeat(found, ends - starts)

    def _filter(self, parts: list[bytes]):
        """Edges of all parts by their end, the shortest first: (first edge and last edge of each
        end, piece, length, share of the shorter edges of the same end).  Longest parts first.
        """
        data = np.frombuffer(b"".join(parts), np.uint8)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.cumsum(sizes) - sizes
        covered = self._covered(data)
        # the sum over all segmentations of each prefix; prefix b of part k is at starts[k] + k + b
        ground = starts + np.arange(len(parts))
        total = np.zeros(len(data) + len(parts))
        total[ground] = 1.0
        count = np.zeros(len(data), np.int32)
        got: list[tuple[np.ndarray, ...]] = []
        for depth in range(1, int(sizes[0]) + 1):
            n = int(np.searchsorted(-sizes, -depth, "right"))          # parts at least so long: a prefix
            end = starts[:n] + (depth - 1)
            bound = ground[:n] + depth
            local: list[tuple[np.ndarray, np.ndarray, int, np.ndarray]] = []
            plain = np.flatnonzero(~covered[end])
            if len(plain):
                piece = self.byte_id[data[end[plain]]]
                local.append((plain, piece, 1, total[bound[plain] - 1] * self.likely[piece]))
            node = self.step[0, data[end]]
            which = np.flatnonzero(node)
            node = node[which]
            for back in range(1, depth + 1):
                piece = self.piece[node]
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    w, piece = which[hit], piece[hit]
                    local.append((w, piece, back, total[bound[w] - back] * self.likely[piece]))
                if back == depth:
                    break
                more = np.flatnonzero(node < self.inner)
                which = which[more]
                node = self.step[node[more], data[end[which] - back]]
                more = np.flatnonzero(node)
                which, node = which[more], node[more]
                if not len(which):
                    break
            sums = np.zeros(n)
            for w, piece, back, value in local:                        # a part is in each list once
                got.append((end[w], piece, back, sums[w]))
                sums[w] += value
            for e in range(len(got) - len(local), len(got)):
                at, piece, back, before = got[e]
                w = local[e - len(got)][0]
                got[e] = (at, count[at], piece.astype(np.uint16), back, (before / sums[w]).astype(np.float32))
                count[at] += 1
            total[bound] = sums
            if depth % RESCALE == 0:                                   # only ratios matter: keep them in range
                reach = min(depth, self.longest)
                scale = total[bound].copy()                            # a sum inside a character is 0, the greatest is not
                for back in range(1, reach + 1):
                    np.maximum(scale, total[bound - back], out=scale)
                for back in range(reach + 1):
                    total[bound - back] /= scale
        stop = np.cumsum(count, dtype=np.int64)
        offset = stop - count
        piece, back = np.empty(stop[-1], np.uint16), np.empty(stop[-1], np.uint8)
        before = np.empty(stop[-1], np.float32)
        for at, nth, p, length, share in got:
            to = offset[at] + nth
            piece[to], back[to], before[to] = p, length, share
        return starts, sizes, stop - 1, piece, back, before

    def _views(self) -> None:
        """The tables as flat views, which Python reads faster one by one."""
        if not hasattr(self, "_step"):
            self._step, self._piece = memoryview(self.step.reshape(-1)), memoryview(self.piece)
            self._likely, self._byte_id = self.likely.tolist(), self.byte_id.tolist()

    def _edges(self, part: bytes, end: int, sums: memoryview, power: memoryview, now: int, covered: bytes) -> list[tuple[int, int, float]]:
        """(piece, length, weight in units of 2^now) of the edges to ``end``, the shortest first."""
        out, likely, step, piece_at = [], self._likely, self._step, self._piece
        if not covered[end - 1]:
            piece = self._byte_id[part[end - 1]]
            out.append((piece, 1, sums[end - 1] * 2.0 ** (power[end - 1] - now) * likely[piece]))
        node, at = 0, end
        while at and node < self.inner:
            at -= 1
            node = step[node << 8 | part[at]]
            if not node:
                break
            piece = piece_at[node]
            if piece >= 0:
                out.append((piece, end - at, sums[at] * 2.0 ** (power[at] - now) * likely[piece]))
        return out

    def _sample_long(self, part: bytes, bases: np.ndarray) -> list[np.ndarray]:
        """Pieces of each occurrence (by its base) of one long part: 13 bytes a byte are held."""
        self._views()
        covered = self._covered(np.frombuffer(part, np.uint8)).tobytes()
        sums, power = memoryview(np.zeros(len(part) + 1)), memoryview(np.zeros(len(part) + 1, np.int32))
        sums[0], now = 1.0, 0                                          # a sum is sums[k] * 2^power[k]
        for end in range(1, len(part) + 1):
            value = sum([w for _, _, w in self._edges(part, end, sums, power, now, covered)])
            if 0.0 < value < 2.0 ** -64:
                now -= 64
                value *= 2.0 ** 64
            sums[end], power[end] = value, now
        out = []
        for base in bases:
            drawn, at = [], len(part)
            while at:
                turns = np.arange(len(drawn), len(drawn) + 1024).astype(np.uint64) * np.uint64(TURN)
                for u in _share(base + turns).tolist():
                    edges = self._edges(part, at, sums, power, power[at], covered)
                    value, before = sum([w for _, _, w in edges]), 0.0
                    for k, (_, _, w) in enumerate(edges):              # the last edge whose shorter ones have no more than u
                        if u < before / value:
                            k -= 1
                            break
                        before += w
                    drawn.append(edges[k][0])
                    at -= edges[k][1]
                    if not at:
                        break
            out.append(np.array(drawn[::-1], np.uint16))
        return out

    # ---- backward sampling ------------------------------------------------------------

    def encode(self, texts: list[str], keys: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
        """(pieces of all texts, end of each text's); ``keys``: a long for each text."""
        parts: list[bytes] = []
        sizes = np.empty(len(texts), np.int64)
        for k, text in enumerate(texts):
            own = PART.findall(b" " + text.encode()) if text else []
            sizes[k] = len(own)
            parts += own
        if not parts:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        code, known = pd.factorize(np.array(parts, dtype=object))
        lengths = np.fromiter(map(len, known), np.int64, len(known))
        order = np.argsort(-lengths, kind="stable")                    # the longest first
        rank = np.empty(len(known), np.int64)
        rank[order] = np.arange(len(known))
        text = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(parts)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        base = _mix(_mix(keys.view(np.uint64) + np.uint64(seed))[text] + place.astype(np.uint64))
        del parts, place
        by_part = np.argsort(rank[code], kind="stable")                # occurrences, those of a part together
        ends_of = np.cumsum(np.bincount(rank[code], minlength=len(known)))
        steps = np.zeros(len(code), np.int64)
        drawn: list[tuple[np.ndarray, np.ndarray]] = []                # (occurrences, their pieces one after the other)
        held = np.cumsum(lengths[order])
        at = 0
        while at < len(known):
            if lengths[order[at]] > LONG:
                end = at + 1
            else:
                end = max(at + 1, int(np.searchsorted(held, held[at] - lengths[order[at]] + GROUP, "right")))
            who = by_part[ends_of[at - 1] if at else 0:ends_of[end - 1]]
            group = [known[i] for i in order[at:end]]
            if lengths[order[at]] > LONG:
                found = self._sample_long(group[0], base[who])
                steps[who] = [len(x) for x in found]
                drawn.append((who, np.concatenate(found)))
            else:
                own, steps[who] = self._sample(group, rank[code[who]] - at, base[who])
                drawn.append((who, own))
            at = end
        ends = np.cumsum(steps)
        out = np.empty(int(ends[-1]), np.int32)
        for who, own in drawn:
            n = steps[who]
            start = np.cumsum(n) - n
            out[np.repeat(ends[who] - n - start, n) + np.arange(len(own))] = own
        totals = np.bincount(text, weights=steps, minlength=len(texts)).astype(np.int64)
        return out, np.cumsum(totals)

    def _sample(self, parts: list[bytes], code: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, number of pieces) of the occurrences of ``parts`` (longest first), one after the other."""
        low, size, last, piece, back, before = self._filter(parts)
        low = low[code]
        at = low + size[code] - 1                                      # last byte still to be segmented
        who = np.arange(len(code))
        turns: list[tuple[np.ndarray, np.ndarray]] = []
        steps = np.zeros(len(code), np.int64)
        while len(who):
            u = _share(base[who] + np.uint64(len(turns) * TURN % (1 << 64)))
            edge = last[at]
            open_ = np.flatnonzero(u < before[edge])                   # the longest edge is not the one: shorter ones
            while len(open_):
                edge[open_] -= 1
                open_ = open_[u[open_] < before[edge[open_]]]
            turns.append((who, piece[edge]))
            steps[who] += 1
            at = at - back[edge]
            more = np.flatnonzero(at >= low[who])
            who, at = who[more], at[more]
        ends = np.cumsum(steps)
        out = np.empty(int(ends[-1]), np.uint16)
        for turn, (who, p) in enumerate(turns):                        # drawn from the end
            out[ends[who] - 1 - turn] = p
        return out, steps

    def decode(self, ids: list[int]) -> str:
        """The text of a text's pieces: the space in front goes."""
        table = self.bytes_of
        return b"".join([table[i] for i in ids])[1:].decode("utf-8", "replace")


TURN = 0x9E3779B97F4A7C15


def _share(x: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each long."""
    return (_mix(x) >> np.uint64(40)) * np.float32(2.0 ** -24)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def codec(path: str, alpha: float) -> Codec:
    cache = process_cache()
    key = f"codec {path} {alpha}"
    if key not in cache:
        cache[key] = Codec(path, alpha)
    return cache[key]


# ---- Spark ---------------------------------------------------------------------

def encode(docs: DataFrame, path: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """(doc_id, pieces, lossless): sampled segmentation of every row, keyed by its doc_id, and
    whether decoding it gave back the text."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, alpha)
        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").to_pylist()
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            pieces, ends = own.encode([t or "" for t in texts], keys, seed)
            starts = np.concatenate(([0], ends)).astype(np.int32)
            null = np.array([t is None for t in texts], bool)
            same = [own.decode(pieces[a:b].tolist()) == (t or "") for t, a, b in zip(texts, starts, starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.ListArray.from_arrays(pa.array(starts, mask=np.append(null, False)), pa.array(pieces.astype(np.int32))),
                 pa.array(same)], names=["doc_id", "pieces", "lossless"])
        release_memory()

    kind = dict(docs.dtypes)["doc_id"]
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key"))
    return keyed.mapInArrow(run, f"doc_id {kind}, pieces array<int>, lossless boolean")


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, pieces)."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, ALPHA)
        for batch in batches:
            texts = [None if p is None else own.decode(p) for p in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.select("doc_id", "pieces").mapInArrow(run, f"doc_id {kind}, text string")
