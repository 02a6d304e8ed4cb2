"""Secret scans: known forms, and random strings that a tokenizer's vocabulary cannot shorten.

*Known forms* (``FORMS``) are matched leftmost and non-overlapping per kind; a match that is too short is dropped.

*Random strings.* A vocabulary learnt from text spends one token on several characters of anything text-like, and
hardly more than one character a token on a random string. Every run of ``[A-Za-z0-9+/_-]``, ``=`` at its end included, of
at least ``MIN_CHARS`` characters is tokenised under a tiktoken vocabulary; with fewer than ``RATIO`` characters a token it is reported as
kind ``random``. Of a run that passes, its parts between ``/`` are tested too. Before the test these are excluded:

* digests in hexadecimal of the usual lengths, also after the name of their algorithm, and the strings in ``known``;
* identifiers: numbers (no letter), UUIDs, and runs whose parts between ``/ _ + -`` are all short: up to ``PART`` characters of
  a word or a number, a word's last four may be digits, or up to ``MIXED`` of any kind.

A random string that overlaps a known form is not reported again. Places are code points, the end exclusive.

Null and empty texts have no spans. Repeated rows are scanned as often as they come, no rows give no rows. Extra columns are
not read. Whole texts are scanned, in stretches of about a megabyte of rows; a longer text takes about eight times its bytes.
Spans of one start come in the order of the kinds; two spans of one kind never overlap.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelode.llm.words import LOWER, chunks, split

#: The kinds of spans in the order in which they are listed.
KINDS = ("assign", "access", "hex", "random")
#: Least characters of an assigned value, an access key and a hexadecimal run.
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
#: On lower-cased text: group 1 is the value.
ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")

#: A run of so many characters is tested; it is random with fewer than so many characters a token.
MIN_CHARS, RATIO = 20, 1.8
#: Parts of an identifier have at most so many characters, if letters and digits mix freely at most so many.
PART, MIXED = 11, 5
#: A run is tokenised in stretches of so many characters.
STRETCH = 1024

#: Lengths of hexadecimal digests: MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512.
_DIGEST = re.compile(r"(?:(?:md5|sha-?(?:1|224|256|384|512))[-/_+])?(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.I)
_UUID = re.compile(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", re.I)
_SEPARATORS = re.compile(r"[/_+-]+")
_LETTER = re.compile(r"[A-Za-z]")
_WORD = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+)[0-9]{0,4}|[0-9]+")


def _outside(inside: bytes) -> np.ndarray:
    out = np.ones(256, bool)
    out[list(inside)] = False
    return out


_DIGITS, _UPPER, _LOW = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_NOT_HEX, _NOT_ACCESS, _NOT_RUN = _outside(b"0123456789abcdef"), _outside(_UPPER + _DIGITS), _outside(_DIGITS + _UPPER + _LOW + b"+/_-")


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=1)
def _encoding(path: str):
    """One per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("secret_scan", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def chars_per_token(run: str, path: str) -> float:
    """Characters a token of an ASCII run, counted over all of it."""
    encoding = _encoding(path)
    return len(run) / sum(len(encoding.encode_ordinary(run[i : i + STRETCH])) for i in range(0, len(run), STRETCH))


def excluded(run: str, known: frozenset[str] = frozenset()) -> bool:
    """Known strings, digests and identifiers."""
    bare = run.rstrip("=")
    if run in known or bare in known or not _LETTER.search(bare) or _DIGEST.fullmatch(bare) or _UUID.fullmatch(bare):
        return True
    return all(len(part) <= MIXED or len(part) <= PART and _WORD.fullmatch(part) for part in _SEPARATORS.split(bare))


def random_spans(run: str, path: str, least: int, ratio: float, known: frozenset[str]) -> Iterator[tuple[int, int]]:
    """Places in a run that hold random strings: all of it, or parts between slashes."""
    low, high = len(run) - len(run.lstrip("/_+-")), len(run.rstrip("/_+-"))
    if high - low < least or excluded(run[low:high], known):
        return
    if chars_per_token(run[low:high], path) < ratio:
        yield low, high
        return
    if "/" in run[low:high]:
        for part in re.finditer(r"[^/]+", run[low:high]):
            if len(part[0]) >= least and not excluded(part[0], known) and chars_per_token(part[0], path) < ratio:
                yield low + part.start(), low + part.end()


def _long(data: np.ndarray, offsets: np.ndarray, outside: np.ndarray, least: int) -> tuple[list[int], list[int]]:
    """Starts and ends of runs of at least ``least`` bytes."""
    starts, ends, _ = split(data, offsets, outside)
    long = ends - starts >= least
    return starts[long].tolist(), ends[long].tolist()


def _spans(data: np.ndarray, offsets: np.ndarray, path: str, least: int, ratio: float, known: frozenset[str]) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of ``data``, in order of start, then kind."""
    raw, low = data.tobytes(), LOWER[data].tobytes()
    base = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(low, a, b) if m.end(1) - m.start(1) >= LEAST_VALUE]
    for a, b in zip(*_long(data, offsets, _NOT_ACCESS, LEAST_ACCESS)):
        at = raw.find(b"AKIA", a, b)
        if at >= 0 and b - at >= LEAST_ACCESS:
            base.append((at, 1, b))
    base += [(a, 2, b) for a, b in zip(*_long(data, offsets, _NOT_HEX, LEAST_HEX))]
    base.sort()
    taken = np.array([(a, b) for a, _, b in base], np.int64).reshape(-1, 2)
    upto = np.maximum.accumulate(taken[:, 1]) if len(taken) else taken[:, 1]
    more = []
    ends = offsets[1:].tolist()
    row = np.searchsorted(offsets, np.array((found := _long(data, offsets, _NOT_RUN, least - 2))[0], np.int64), side="right") - 1
    for a, b, i in zip(*found, row.tolist()):
        pad = b
        while pad < min(b + 2, ends[i]) and raw[pad] == 0x3D:
            pad += 1
        for x, y in random_spans(raw[a:pad].decode("ascii"), path, least, ratio, known):
            before = int(np.searchsorted(taken[:, 0], a + y)) - 1  # the last known form that starts before its end
            if before < 0 or upto[before] <= a + x:
                more.append((a + x, 3, a + y))
    return sorted(base + more)


def _code_points(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Characters before each of the sorted byte places."""
    first = (data & 0xC0) != 0x80
    cuts = np.concatenate([[0], places])
    return np.cumsum([int(np.count_nonzero(first[a:b])) for a, b in zip(cuts[:-1], cuts[1:])], dtype=np.int64)


def scan(
    docs: DataFrame, path: str | None = None, least: int = MIN_CHARS, ratio: float = RATIO, known: frozenset[str] = frozenset()
) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end) in order of start, then kind; one row per row of ``docs``."""
    vocabulary = path or vocabulary_path()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for i, _, offsets, data in chunks(batch.column("text")):
                spans = _spans(data, offsets, vocabulary, least, ratio, known)
                if not spans:
                    continue
                places, back = np.unique(np.array([(a, b) for a, _, b in spans], np.int64).ravel(), return_inverse=True)
                rows = np.searchsorted(offsets, [a for a, _, _ in spans], side="right") - 1
                every = np.union1d(places, offsets[rows])
                points = _code_points(data, every)
                own = points[np.searchsorted(every, places)][back].reshape(-1, 2) - points[np.searchsorted(every, offsets[rows])][:, None]
                for row, (_, k, _), (a, b) in zip(rows.tolist(), spans, own.tolist()):
                    found[i + row].append({"kind": KINDS[k], "start": a, "end": b})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, end long>>")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def known_forms(spans: str = "spans") -> Column:
    return F.filter(spans, lambda s: s["kind"] != "random")


def count(kind: str, spans: str = "spans") -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
