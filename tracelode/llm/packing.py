"""Packing token sequences by concatenate and cut.

First pass: every document is tokenised once, its ids are stored with their place inside their scan
partition. The partitions' token totals, one number each, are summed up to global offsets. Second pass:
each document's stretch of the global token line is cut at multiples of the sequence length. The last
sequence is the only one that can be short, so padding is less than one sequence in all.

A null or empty text has the end id alone. Repeated rows are packed as often as they come; no rows give no pieces.
A document longer than a sequence becomes several pieces (boundary records).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.tables import stored
from tracelode.llm.words import SPACE, text_buffers

SEQUENCE = 4096
END_ID = 2
#: Distinct words whose ids a Python worker keeps, about 200 MB; the store starts anew beyond it.
CACHE_WORDS = 700_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_chars() -> dict[int, int]:
    """Byte-level tokenizers write bytes as characters: printable ones as they are, the others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


_BYTE_CHARS = _byte_chars()
_TAIL = re.compile(r"[!-&(-/:-@\[-`{-~]*\Z")


def _as_byte_chars(text: str) -> str:
    return text.encode().decode("latin-1").translate(_BYTE_CHARS)


#: Marks that are pieces of their own between an ASCII letter and white space.
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = True


def _simpler(text: bytes) -> bytes:
    """A text of the same ids with fewer distinct words: ASCII in lower case, marks set off by a space.

    Not with special tokens, which are found in the raw text, nor with combining marks, for which
    composition and lower case do not commute.
    """
    if b"<|" in text or b"\xcc" in text or b"\xcd" in text:
        return text
    data = np.frombuffer(text.lower(), np.uint8)
    if len(data) < 2:
        return data.tobytes()
    mark = _MARK[data]
    mark[0] = False
    mark[1:] &= _LETTER[data[:-1]]
    mark[:-1] &= SPACE[data[1:]]
    return np.insert(data, np.flatnonzero(mark), 0x20).tobytes()


class WordTokens:
    """Ids of whole texts, made of the ids of their words.

    For tokenizers that drop white space and never join across it: each word between ASCII white
    space is tokenised once by the library and remembered. Punctuation at a word's end is its own token there, so
    it is cut off first if the composed word ends in a Latin letter.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        probe = "straße"  # the model alone gives the same ids for a word of letters
        self.letters = [t.id for t in self.model.tokenize(_as_byte_chars(probe))] == self.tokenizer.encode(probe, add_special_tokens=False).ids
        self.limit = limit
        self._clear()

    def _clear(self) -> None:
        self.places: dict[bytes, int] = {}
        self.starts, self.sizes = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.filled = np.zeros(1 << 18, np.uint32), 0
        self.stems: dict[str, list[int]] = {}

    def _ids(self, word: bytes) -> list[int]:
        """Ids of a word."""
        if self.letters and word.isalpha() and word.islower():  # ASCII letters: as they are, one piece to the tokenizer
            return [t.id for t in self.model.tokenize(word.decode())]
        text = word.decode("utf-8")
        tail = _TAIL.search(text).start()
        stem, rest = text[:tail], text[tail:]
        if not (rest and stem and self._ends_in_latin(stem)) or "<|" in text:
            return self._part(text)
        return self._part(stem) + self._part(rest)

    @staticmethod
    def _ends_in_latin(stem: str) -> bool:
        """Whether the tokenizer sees a Latin letter at the end. Other letters may be taken apart by composition, and a mark that is left joins the tail."""
        last = stem[-1]
        if not last.isascii():  # nothing is composed into an ASCII letter from before
            last = normalize("NFC", stem).lower()[-1]
        return last < "\u0250" and last.isalpha()

    def _part(self, part: str) -> list[int]:
        if part not in self.stems:
            ids = None
            if self.letters and max(part) < "\u0250":  # Latin: normalised here, a word of letters is one piece
                low = normalize("NFC", part).lower()
                if low.isalpha() and max(low) < "\u0250":
                    ids = [t.id for t in self.model.tokenize(_as_byte_chars(low))]
            self.stems[part] = self.tokenizer.encode(part, add_special_tokens=False).ids if ids is None else ids
        return self.stems[part]

    def _add(self, word: bytes) -> int:
        ids, at = self._ids(word), len(self.places)
        if at == len(self.starts):
            self.starts, self.sizes = np.resize(self.starts, 2 * at), np.resize(self.sizes, 2 * at)
        while self.filled + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.starts[at], self.sizes[at] = self.filled, len(ids)
        self.filled += len(ids)
        self.places[word] = at
        return at

    def __call__(self, text: bytes) -> np.ndarray:
        if len(self.places) > self.limit:
            self._clear()
        words = _simpler(text).split()  # at the six ASCII white space bytes
        for w in set(words).difference(self.places):
            self._add(w)
        at = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        sizes = self.sizes[at]
        before = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        return self.flat[np.arange(total) + np.repeat(self.starts[at] - before, sizes)]


@lru_cache(maxsize=1)
def _word_tokens(path: str) -> WordTokens:
    """One per Python worker: later tasks find the words of earlier ones."""
    return WordTokens(path)


def tokenised(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, part, before (ids of this part before the document), n, ids (binary, little-endian)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _word_tokens(path)
        kind = "<u4" if ids_of.wide else "<u2"
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            ids, size = [], []
            for a, b in zip(offsets[:-1], offsets[1:]):
                own = np.append(ids_of(data[a:b].tobytes()), np.uint32(end_id))
                size.append(len(own))
                ids.append(own.astype(kind).tobytes())
            upto = before + np.cumsum(size, dtype=np.int64)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(n, part, np.int32)), pa.array(upto - np.array(size, np.int64)),
                 pa.array(size, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "before", "n", "ids"],
            )
            before = int(upto[-1]) if n else before

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, part int, before long, n long, ids binary"
    )


def packed(
    docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; ``with_ids``: and its ids.

    Documents follow each other as the scan of ``docs`` brings them.
    """
    pieces = stored(tokenised(docs, path or tokenizer_path(), end_id), "tokens")
    totals = sorted(pieces.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one row per partition of the scan
    base = dict(zip((r["part"] for r in totals), accumulate((r["n"] for r in totals), initial=0)))
    shared = docs.sparkSession.sparkContext.broadcast(base)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "part", "before", "n"))
            for doc, part, before, n, ids in zip(*columns, batch.column("ids")):
                ids = np.frombuffer(ids.as_buffer(), f"<u{len(ids.as_buffer()) // n}")
                first = base[part] + before
                start = 0
                while start < n:
                    seq, offset = divmod(first + start, sequence)
                    size = min(n - start, sequence - offset)
                    own = ids[start : start + size].astype("<u4")
                    out.append((doc, start, size, zlib.crc32(own.tobytes()), n, seq, offset) + ((own,) if with_ids else ()))
                    start += size
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int64())] * with_ids
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    schema = ", ".join(f"{c} long" for c in names[:7]) + ", ids array<long>" * with_ids
    return pieces.mapInArrow(run, schema)
