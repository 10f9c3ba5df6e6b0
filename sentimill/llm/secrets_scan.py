"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings.

Patterns (each leftmost and non-overlapping, over the whole text): a named
assignment whose value has 6 or more characters, an access key of 20 or more, a hex
run of 24 or more.  Beside them, candidate strings of each character class are
scanned with a window whose character counts are updated by the one that enters and
the one that leaves; windows whose entropy reaches the class's threshold
are joined to spans.  An allow-list drops candidates (never spans of the patterns):
identifiers and digests that are named as such, and by the candidate alone, whatever stands
beside it, UUIDs, paths, documentation samples and alphabets.  What a pattern has found already isn't given again.

Texts are scanned whole, each in one place, so memory is bounded by the longest
text; there is no shuffle.  Offsets are code points, ends exclusive.  Null texts count
as empty: no spans, and the digest of the empty list.  Repeated rows each give a row.
An empty table gives none.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, slices

# --- Fixed values: the patterns of the contract. --------------------------------------
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")          # runs are taken whole, so short ones needn't match at all
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "entropy")
# ----------------------------------------------------------------------------------------


class CharacterClass(NamedTuple):
    runs: re.Pattern        # candidate strings
    needs: tuple[re.Pattern, ...]     # what a candidate must hold somewhere
    window: int
    bits: float             # entropy per character from which on a window counts


DIGIT, LOWER, UPPER, LETTER = map(re.compile, ("[0-9]", "[a-z]", "[A-Z]", "[A-Za-z]"))
ALNUM, JOINED = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]{20,}"), re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
#: Fewer characters to choose from make less entropy, so runs of one case have a lower threshold; without
#: digits it is higher, as names of several words have both cases.  Letters of one case alone may be plain words.
CLASSES = (
    CharacterClass(re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{24,}"), (DIGIT, re.compile("[A-Fa-f]")), 24, 3.0),
    CharacterClass(re.compile(r"(?<![A-Za-z0-9])[a-z0-9]{20,}+(?![A-Z])"), (DIGIT, LOWER), 20, 3.3),
    CharacterClass(re.compile(r"(?<![A-Za-z0-9])[A-Z0-9]{20,}+(?![a-z])"), (DIGIT, UPPER), 20, 3.3),
    CharacterClass(ALNUM, (DIGIT, LETTER), 20, 3.6),
    CharacterClass(ALNUM, (LOWER, UPPER), 20, 3.9),
    CharacterClass(JOINED, (DIGIT, LETTER), 20, 3.8),
    CharacterClass(JOINED, (LOWER, UPPER), 20, 4.0),
)

#: What stands before an identifier or a digest that is named as such.
NAMED = re.compile(r"(?:sha-?\d*|md5|uuid|guid|commit|digest|checksum|etag)[\"']?\s*[:=]?\s*[\"']?$", re.IGNORECASE)
#: Candidates that are no secrets whatever their entropy: as a whole an identifier or a path ...
WHOLE = (
    re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"(?:/[a-z0-9_-]+){3,}"),
)
#: ... or with such letters in them.  A word that is set off from the rest of a candidate is its neighbour, as one after a blank is.
WORDS = "example|sample|placeholder|changeme|dummy"
ALONE = re.compile(rf"(?<![A-Za-z0-9])(?:{WORDS})s?(?![A-Za-z0-9])", re.IGNORECASE)
INSIDE = re.compile(rf"{WORDS}|abcdefghij|0123456789|qwertyuiop", re.IGNORECASE)


def high_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Joined spans of all windows of ``text`` with at least ``bits`` of entropy per character."""
    if len(text) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts = Counter(text[:window])
    held = sum(term[c] for c in counts.values())            # entropy = log2(window) - held / window
    least = window * (math.log2(window) - bits) + 1e-9
    spans: list[tuple[int, int]] = []
    for start in range(len(text) - window + 1):
        if start:
            out, new = text[start - 1], text[start + window - 1]
            if out != new:
                a, b = counts[out], counts[new]
                held += term[a - 1] - term[a] + term[b + 1] - term[b]
                counts[out], counts[new] = a - 1, b + 1
        if held <= least:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], start + window)
            else:
                spans.append((start, start + window))
    return spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return in_order(found)


def in_order(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def allowed(text: str, start: int, end: int) -> bool:
    """Whether the candidate from ``start`` to ``end`` is no secret: by itself, or as what stands before it names it."""
    if NAMED.search(text, max(0, start - 24), start):
        return True
    run = text[start:end]
    return any(p.fullmatch(run) for p in WHOLE) or bool(INSIDE.search(ALONE.sub(" ", run)))


def entropy_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    spans = set()
    for runs, needs, window, bits in CLASSES:
        for m in runs.finditer(text):
            run = m.group()
            if all(p.search(run) for p in needs) and not allowed(text, *m.span()):
                spans |= {(m.start() + a, m.start() + b) for a, b in high_windows(run, window, bits)}
    out: list[tuple[int, int, str]] = []
    reach, known = 0, 0                       # how far the patterns' spans that start before this one go
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        while known < len(base) and base[known][0] <= a:
            reach = max(reach, base[known][1])
            known += 1
        inside = b <= reach or (out and b <= out[-1][1])
        if not inside:
            out.append((a, b, "entropy"))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(spans of the patterns, all spans)."""
    base = base_spans(text)
    return base, in_order(base + entropy_spans(text, base))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for text in batch.column("text").to_pylist():
                base, spans = scan(text)
                kinds = Counter(kind for _, _, kind in spans)
                rows.append((kinds["assign"], kinds["access"], kinds["hex"],
                             hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), kinds["entropy"]))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]),
                 *(pa.array(c, pa.string()) for c in columns[3:5]), pa.array(columns[5], pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"])

    kind = dict(docs.dtypes)["doc_id"]
    return documents(docs).mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long")
