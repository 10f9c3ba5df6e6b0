"""Cross-tokenizer alignment: which tokens of two vocabularies end together, and how often.

A is a byte-level vocabulary that encodes a space and the text, B a piece vocabulary that puts
the space in front itself.  Both spell the same bytes; the byte offsets where a token of A and
one of B both end cut the tokens into groups, and the two tokens that end there are linked.

Equal texts are worked on once: texts are shuffled whole (counted before the shuffle, so a text
that many rows share travels once per task), each different text is tokenised and aligned, its
pair counts weigh as often as it occurs, and the measures are joined to the doc_ids by the text's
SHA-256.  A text falls apart into units before a space that follows something that is not
white space: no token of either vocabulary crosses such a place (which is checked for B's pieces),
so each different unit is aligned once in a worker, which remembers the first ones it meets.

Corpus-wide counts of pairs are summed in the tasks before they are shuffled.  The most frequent
pairs (``MOST_PAIRS`` at most) are broadcast and looked up in the tasks; links of all others
are joined with their counts over a shuffle, in which no key is hot, as those pairs are rare.

Null and empty texts have no tokens, and neither has a text whose tokens of either vocabulary
spell other bytes: counts are 0 and the groups' digest is ''.  Repeated rows each give a row and
count as often; a null doc_id is an id like any other.  An empty table gives none.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, documents, forget, join_spread, process_cache, slices, written

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
SIGN = "▁"
SLICE = 2 << 20              # bytes of text aligned together
KNOWN = 250_000              # units that a worker remembers (the first ones it meets hold the frequent ones) ...
KNOWN_CHARS = 64             # ... if they have at most so many characters
ENCODED = 1 << 14            # different units encoded in one call
MOST_PAIRS = 1 << 20         # pairs whose counts are broadcast
HELD_PAIRS = 1 << 21         # different pairs that a task sums before it passes them on
LINKS = 1 << 21              # links looked up or summed together
#: Units: white space as the byte-level pattern has it (Python's, without the four separators).
UNIT = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+(?:(?! )[^\S\x1c-\x1f]+[\S\x1c-\x1f]+)*(?:(?! )[^\S\x1c-\x1f]+\Z)?"
                  r"|[^\S\x1c-\x1f]+")


def model_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_of_sign() -> dict[str, int]:
    """Byte of each character by which byte-level vocabularies spell bytes: printable ones stand for
    themselves, the others take the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Both vocabularies, and what a worker has learnt about units."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark has the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True                # their strings in a text are plain text
        self.a.no_truncation()
        self.a.no_padding()
        sign = byte_of_sign()
        words = {i: w for w, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(sign[c] for c in words[i]) if i in words and all(c in sign for c in words[i])
                        else words.get(i, "").encode() for i in range(max(words) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.size_b = self.b.get_piece_size()
        self.bytes_b = []
        for i in range(self.size_b):
            piece = self.b.id_to_piece(i)
            if re.search(f"[^{SIGN}]{SIGN}", piece):
                raise ValueError(f"a piece crosses the start of a unit: {piece!r}")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SIGN, " ").encode())
        self.size_a = len(self.bytes_a)
        self.wide = self.size_a * self.size_b >= 1 << 32               # a link takes 8 bytes, not 4
        self.names = [str(i) for i in range(max(self.size_a, self.size_b))]
        self.lengths_a, self.lengths_b = list(map(len, self.bytes_a)), list(map(len, self.bytes_b))
        self.number: dict[str, int] = {}                   # of each known unit, into the lists below
        self.tokens_a: list[int] = []                      # how many
        self.tokens_b: list[int] = []
        self.groups: list[bytes] = []
        self.links: list[bytes] = []
        self.wrong: set[int] = set()                       # units whose tokens spell other bytes

    def tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Tokens of texts that begin with a space, by A and by B."""
        return ([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)],
                self.b.encode([t[1:] for t in texts], num_threads=1))

    def align(self, a: list[int], b: list[int]) -> tuple[bytes, bytes]:
        """(groups as text, links) of the tokens of one text, cut wherever a token of either side ends; the bytes are equal."""
        names, lengths_a, lengths_b, size_b = self.names, self.lengths_a, self.lengths_b, self.size_b
        groups, links = [], []
        j = from_a = from_b = ahead = 0                    # bytes that A has spelt beyond B
        for i, x in enumerate(a, 1):
            ahead += lengths_a[x]
            while ahead > 0:
                ahead -= lengths_b[b[j]]
                j += 1
            if not ahead:
                y = b[j - 1]
                links.append(x * size_b + y)
                if i - from_a == 1 and j - from_b == 1:
                    groups.append(names[x] + "|" + names[y])
                else:
                    groups.append(",".join([names[k] for k in a[from_a:i]]) + "|" + ",".join([names[k] for k in b[from_b:j]]))
                from_a, from_b = i, j
        return ";".join(groups).encode(), array("Q" if self.wide else "I", links).tobytes()

    def _learn(self, units: list[str]) -> None:
        """Append the units' alignments to the lists, and name them."""
        bytes_a, bytes_b = self.bytes_a, self.bytes_b
        for at in range(0, len(units), ENCODED):
            some = units[at:at + ENCODED]
            for unit, a, b in zip(some, *self.tokens(some)):
                data, no = unit.encode(), len(self.groups)
                groups = links = b""
                if b"".join([bytes_a[i] for i in a]) == data == b"".join([bytes_b[i] for i in b]):
                    groups, links = self.align(a, b)
                else:
                    self.wrong.add(no)
                self.number[unit] = no
                self.tokens_a.append(len(a))
                self.tokens_b.append(len(b))
                self.groups.append(groups)
                self.links.append(links)

    def texts(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """(tokens of A, of B, groups, digest of the groups, links) of each text."""
        units = [UNIT.findall(" " + t) if t else [] for t in texts]
        new = set().union(*units).difference(self.number)
        short = sorted(u for u in new if len(u) <= KNOWN_CHARS)
        stay = max(0, KNOWN - len(self.number))
        passing = [*short[stay:], *(u for u in new if len(u) > KNOWN_CHARS)]
        self._learn(short[:stay])
        known = len(self.groups)
        self._learn(passing)
        tokens = np.array([self.tokens_a, self.tokens_b], np.int64)
        number, groups, links = self.number, self.groups, self.links
        out = []
        for text, own in zip(texts, units):
            at = [number[u] for u in own]
            if not at:
                out.append((0, 0, 0, "", b""))
            elif self.wrong and not self.wrong.isdisjoint(at):
                out.append(self._whole(" " + text))
            else:
                n_a, n_b = tokens[:, at].sum(axis=1).tolist()
                held = b"".join([links[i] for i in at])
                digest = hashlib.sha256(b";".join([groups[i] for i in at])).hexdigest()
                out.append((n_a, n_b, len(held) >> (3 if self.wide else 2), digest, held))
        for unit in passing:                               # these are forgotten
            del number[unit]
        for values in (self.tokens_a, self.tokens_b, groups, links):
            del values[known:]
        self.wrong = {no for no in self.wrong if no < known}
        return out

    def _whole(self, text: str) -> tuple[int, int, int, str, bytes]:
        """A text with units that are spelt wrong: as one piece, if that is spelt right."""
        (a,), (b,) = self.tokens([text])
        data = text.encode()
        if b"".join([self.bytes_a[i] for i in a]) != data or b"".join([self.bytes_b[i] for i in b]) != data:
            return 0, 0, 0, "", b""
        groups, links = self.align(a, b)
        return len(a), len(b), len(links) >> (3 if self.wide else 2), hashlib.sha256(groups).hexdigest(), links


def aligner(path_a: str, path_b: str) -> Aligner:
    cache = process_cache()
    key = f"aligner {path_a} {path_b}"
    if key not in cache:
        cache[key] = Aligner(path_a, path_b)
    return cache[key]


def sum_pairs(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs, ascending, and the sum of ``times`` of each."""
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.empty(0, np.int64)
    return pairs[first], np.add.reduceat(times, first) if len(first) else times


# ---- Spark ---------------------------------------------------------------------

ALIGNED = "sha binary, times long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"


def align_texts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``ALIGNED``: a row for each different text, with how many rows have it and its links in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").to_pylist()
            found = own.texts(texts)
            shas = [hashlib.sha256(t.encode()).digest() for t in texts]
            n_a, n_b, n, groups, links = zip(*found)
            columns = [pa.array(shas, pa.binary()), batch.column("times"), *(pa.array(c, pa.int64()) for c in (n_a, n_b, n)),
                       pa.array(groups, pa.string()), pa.array(links, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])

    texts = documents(docs).groupBy("text").agg(F.count(F.lit(1)).alias("times"))
    return texts.mapInArrow(run, ALIGNED)


def count_pairs(aligned: DataFrame, link: type) -> DataFrame:
    """(pair, n): how many links of the corpus hold each pair of ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n = np.empty(0, np.int64), np.empty(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

        for batch in slices(batches, "links", LINKS * 4):
            own = [np.frombuffer(x, link) for x in batch.column("links").to_pylist()]
            times = np.repeat(batch.column("times").to_numpy(zero_copy_only=False), list(map(len, own)))
            new = sum_pairs(np.concatenate(own).astype(np.int64), times)
            pairs, n = sum_pairs(np.concatenate((pairs, new[0])), np.concatenate((n, new[1])))
            if len(pairs) > HELD_PAIRS:
                yield rows()
                pairs, n = pairs[:0], n[:0]
        yield rows()

    return (aligned.select("times", "links").mapInArrow(run, "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def frequent_from(pairs: DataFrame, most: int = MOST_PAIRS) -> int:
    """The least power of two so that at most ``most`` pairs have that count or more."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = {r[0]: r[1] for r in pairs.groupBy(level.alias("level")).count().collect()}      # 64 rows at most
    total, least = 0, 64
    while least and total + sizes.get(least - 1, 0) <= most:
        least -= 1
        total += sizes.get(least, 0)
    return 1 << least


def measures(aligned: DataFrame, pairs: DataFrame, size_b: int, link: type, most: int = MOST_PAIRS) -> DataFrame:
    """(sha, n_best, count_sum) of each different text."""
    spark = aligned.sparkSession
    best = pairs.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("best"))     # a row per id of B
    least = frequent_from(pairs, most)
    known = pairs.filter(F.col("n") >= least).toArrow()
    order = np.argsort(known.column("pair").to_numpy())
    table = best.toArrow()
    highest = np.zeros(size_b, np.int64)
    highest[table.column("b").to_numpy()] = table.column("best").to_numpy()
    held = spark.sparkContext.broadcast((known.column("pair").to_numpy()[order], known.column("n").to_numpy()[order], highest))

    def look_up(links: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(pairs, their counts: 0 for the rare ones)."""
        codes, counts, _ = held.value
        own = np.frombuffer(links, link).astype(np.int64)
        if not len(codes):
            return own, np.zeros(len(own), np.int64)
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        return own, np.where(codes[at] == own, counts[at], 0)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own_best, sums = [], []
            for links in batch.column("links"):
                own, n = look_up(links.as_py())
                own_best.append(int(((n > 0) & (n == held.value[2][own % size_b])).sum()))
                sums.append(int(n.sum()))
            yield pa.RecordBatch.from_arrays([batch.column("sha"), pa.array(own_best, pa.int64()), pa.array(sums, pa.int64())],
                                             names=["sha", "n_best", "count_sum"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sha, links in zip(batch.column("sha"), batch.column("links")):
                own, n = look_up(links.as_py())
                codes, times = np.unique(own[n == 0], return_counts=True)
                if len(codes):
                    yield pa.RecordBatch.from_arrays([pa.array([sha.as_py()] * len(codes), pa.binary()), pa.array(codes), pa.array(times)],
                                                     names=["sha", "pair", "times"])

    found = aligned.select("sha", "links").mapInArrow(frequent, "sha binary, n_best long, count_sum long")
    others = pairs.filter(F.col("n") < least)
    if others.isEmpty():
        return found
    rest = (aligned.select("sha", "links").mapInArrow(rare, "sha binary, pair long, times long").join(others, "pair")
            .join(F.broadcast(best), F.col("pair") % size_b == F.col("b"))
            .select("sha", F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
                    (F.col("n") * F.col("times")).alias("count_sum")))
    return found.unionByName(rest).groupBy("sha").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most: int = MOST_PAIRS) -> DataFrame:
    """One row per document row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    path_a, path_b = path_a or model_path(MODEL_A), path_b or model_path(MODEL_B)
    vocabularies = aligner(path_a, path_b)
    size_b, link = vocabularies.size_b, np.uint64 if vocabularies.wide else np.uint32
    aligned = written(align_texts(docs, path_a, path_b), "aligned")
    pairs = written(count_pairs(aligned, link), "pairs")
    found = aligned.select("sha", "times", "n_a", "n_b", "n_groups", "groups_sha256").join(
        measures(aligned, pairs, size_b, link, most), "sha")
    found = written(found, "measures")
    forget(aligned)
    forget(pairs)
    total = found.agg(F.sum("times")).first()[0] or 0
    hot = found.filter(F.col("times") * HOT_SHARE > total).select("sha")
    rows = documents(docs).select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"))
    return join_spread(rows, found, "sha", hot).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
