"""Token counts: what the library's tokenizer gives for whole texts, lengths only.

Texts go through in slices of equal bytes.  A text is cut where the tokenizer's own
splitting pattern always starts anew: after a character that is not white space and
before one that is.  (No token of a byte-level vocabulary crosses such a place, and
no added token holds white space, which is checked.)  So long texts are worked on
in windows, and each different piece of a slice is encoded once, in batches;
a worker remembers the lengths of pieces it has met.  Scanning is one pass with
no shuffle; only the lengths leave the worker.

Null and empty texts have 0 bytes and 0 tokens.  Repeated rows each give a row.
An empty table gives none.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, process_cache, slices

MODEL = "byte_bpe_50k.json"
LIMIT = 512
SLICE = 4 << 20              # bytes of text in one go
WINDOW = 1 << 20             # characters of a long text in one go
BATCH = 1 << 18              # characters encoded in one call
KNOWN = 500_000              # pieces whose lengths a worker remembers ...
KNOWN_LENGTH = 64            # ... if they have at most so many characters
#: White space as the tokenizers' pattern has it: Python's, without the four separators.
PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
CUT = re.compile(r"[\S\x1c-\x1f](?=[^\S\x1c-\x1f])")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark has the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        for token in self.tokenizer.get_added_tokens_decoder().values():
            if token.lstrip or token.rstrip or PIECE.fullmatch(token.content) is None or token.content[0].isspace():
                raise ValueError(f"an added token may cross white space: {token.content!r}")
        self.known: dict[str, int] = {}

    def _encode(self, pieces: list[str]) -> dict[str, int]:
        out: dict[str, int] = {}
        start = held = 0
        for k, piece in enumerate(pieces):                 # batches of equal size
            held += len(piece)
            if held >= BATCH or k + 1 == len(pieces):
                batch = pieces[start:k + 1]
                found = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
                out.update(zip(batch, map(len, found)))
                start, held = k + 1, 0
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            at = 0
            while len(text) - at > WINDOW:
                cut = CUT.search(text, at + WINDOW)
                end = cut.end() if cut else len(text)
                out[k] += self._count([text[at:end]])[0]
                at = end
            texts[k] = text[at:] if at else text
        return out + self._count(texts)

    def _count(self, texts: list[str]) -> np.ndarray:
        pieces = [PIECE.findall(t) for t in texts]
        new = self._encode(list(set().union(*pieces).difference(self.known)))
        known = self.known
        if len(known) < KNOWN:                             # the first pieces met hold the frequent ones
            known.update((p, n) for p, n in new.items() if len(p) <= KNOWN_LENGTH)
        out = np.empty(len(texts), np.int64)
        for k, own in enumerate(pieces):
            out[k] = sum([known[p] if p in known else new[p] for p in own])
        return out


def counter(path: str) -> Counter:
    cache = process_cache()
    key = f"tokens {path}"
    if key not in cache:
        cache[key] = Counter(path)
    return cache[key]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_tokens, over_limit."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in slices(batches, "text", SLICE):
            tokens = own.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens)],
                                             names=["doc_id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    return (documents(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
            .mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
