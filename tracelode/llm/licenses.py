"""License scans: exact phrases, and short notices with a bounded number of edits.

A notice that may differ in k characters is split into k + 1 pieces; whatever lies within k edits of it
contains one piece unchanged. One automaton finds the pieces of all notices; around each hit the
regex library's bounded-error matching verifies the edits and reports the span.

* A notice begins and ends at word borders, and one after a negation (``NEGATIONS``) does not count.
* Words marked with ``*`` tell a notice from others (which licence, which act). They must stand there unchanged, with borders of
  their own; only what lies between them may be edited.

Work on a text grows with its length: words are numbered once by the places of their blanks, and each place is verified
once for each notice, after a look whether the marked words are near. Whole texts are scanned; a text takes some ten times its
bytes. Null and empty texts have no words, places or labels, and score 0. Repeated rows are scanned as often as they come, no
rows give no rows. Extra columns are not read. Of matches of one notice at one place the one with the fewest edits counts, and
places come in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.words import text_buffers

#: Phrases whose words stand consecutively, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices as lower-case words, and their labels, as licences and their appendices word them.
NOTICES = {
    "*released under the *mit license": "mit",
    "*licensed under the *mit license": "mit",
    "*distributed under the *mit license": "mit",
    "*permission is hereby *granted free of *charge to any person obtaining a *copy of this software and associated documentation files": "mit",
    "*licensed under the *apache license version *2 0": "apache",
    "you may not use this file except in *compliance with the *license you may obtain a copy of the license at": "apache",
    "*licensed under the *gnu *general public license": "gpl",
    "redistribute it and or *modify it under the *terms of the *gnu *general *public license": "gpl",
    "redistribute it and or *modify it under the *terms of the *gnu *lesser *general *public license": "lgpl",
    "redistribute it and or *modify it under the *terms of the *gnu *affero *general *public license": "agpl",
    "*licensed under the *gnu *lesser *general public license": "lgpl",
    "*licensed under the *gnu *affero *general public license": "agpl",
    "*permission is granted to copy distribute and or modify this *document under the terms of the *gnu *free *documentation license": "gfdl",
    "*licensed under *cc *by *4 0": "cc-by",
    "*licensed under *cc *by *sa *4 0": "cc-by-sa",
    "*licensed under *cc *by *nc *4 0": "cc-by-nc",
    "*licensed under *cc *by *nd *4 0": "cc-by-nd",
    "*licensed under *cc *by *nc *sa *4 0": "cc-by-nc-sa",
    "*licensed under *cc *by *nc *nd *4 0": "cc-by-nc-nd",
    "*licensed under a *creative *commons *attribution *4 0 international license": "cc-by",
    "*licensed under a *creative *commons *attribution *3 0 unported license": "cc-by",
    "*licensed under a *creative *commons *attribution *sharealike *4 0 international license": "cc-by-sa",
    "*licensed under a *creative *commons *attribution *sharealike *3 0 unported license": "cc-by-sa",
    "*licensed under a *creative *commons *attribution *noncommercial *4 0 international license": "cc-by-nc",
    "*licensed under a *creative *commons *attribution *noderivatives *4 0 international license": "cc-by-nd",
    "*licensed under a *creative *commons *attribution *noncommercial *sharealike *4 0 international license": "cc-by-nc-sa",
    "*licensed under a *creative *commons *attribution *noncommercial *noderivatives *4 0 international license": "cc-by-nc-nd",
    "the person who associated a work with this deed has *dedicated the work to the *public *domain": "cc0",
    "*cc0 1 0 *universal *public domain *dedication": "cc0",
    "this is *free and *unencumbered software released into the *public *domain": "unlicense",
    "*licensed under the *bsd *2 clause license": "bsd",
    "*licensed under the *bsd *3 clause license": "bsd",
    "*redistribution and use in *source and *binary forms with or without modification are *permitted provided that the following conditions are met": "bsd",
    "*subject to the terms of the *mozilla *public license": "mpl",
    "*licensed under the *mozilla *public license": "mpl",
    "*permission to use copy modify and or distribute this software for any purpose with or without *fee is hereby *granted": "isc",
    "*licensed under the *isc license": "isc",
    "*distributed under the *boost *software license version 1 0": "bsl",
    "this software is provided *as is without any *express or implied *warranty in no event will the *authors be held liable": "zlib",
    "*available under the terms of the *eclipse *public license": "epl",
    "*licensed under the *eupl version *1 2": "eupl",
    "*subject to the terms of the *common *development and *distribution license": "cddl",
    "*licensed under the *sil *open *font license version 1 1": "ofl",
    "made available under the *open *database license": "odbl",
    "*licensed under the *artistic license *2 0": "artistic",
    "*licensed under the *python software foundation license": "psf",
    "*all *rights *reserved": "reserved",
}

#: A notice right after one of these words says the opposite.
NEGATIONS = ("not", "never", "no", "nor", "non", "un", "longer")

#: One edit is allowed for so many characters of a notice.
CHARS_PER_EDIT = 12

#: Bytes of words stay, A-Z become a-z, all others become a space.
_WORDS = np.array(
    [b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)], np.uint8
)


def plain(notice: str) -> str:
    """A notice without its marks."""
    return notice.replace("*", "")


def allowed(notice: str, per_edit: int = CHARS_PER_EDIT) -> int:
    return max(1, len(plain(notice)) // per_edit)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits`` + 1 neighbouring pieces of nearly equal length, with their places."""
    cuts = [i * len(notice) // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def _pattern(notice: str, edits: int) -> str:
    """Marked words as they are, what lies between two of them within ``edits`` edits, borders at both ends."""
    parts: list[str] = []
    loose: list[str] = []

    def between() -> None:
        if loose:
            parts.append(f"(?:{' '.join(loose)}){{e<={edits}}}")
            loose.clear()

    for word in notice.split():
        if word.startswith("*"):
            between()
            parts.append(word[1:])
        else:
            loose.append(word)
    between()
    return f"(?b)(?<= ){' '.join(parts)}(?= )"


class Scanner:
    """The automaton of phrases and pieces, and the compiled notices."""

    def __init__(self, phrases: tuple[tuple[str, str], ...], notices: tuple[tuple[str, str], ...], per_edit: int):
        import ahocorasick
        import regex

        entries: dict[str, list[tuple[int, int, str]]] = {}
        for phrase, label in phrases:
            entries.setdefault(f" {phrase} ", []).append((-1, 0, label))
        #: Words as they are, length, edits, label, marked words, pattern.
        self.notices = []
        for notice, label in notices:
            words, edits = plain(notice), allowed(notice, per_edit)
            for at, piece in pieces(words, edits):
                entries.setdefault(piece, []).append((len(self.notices), at, label))
            marked = [f" {w[1:]} " for w in notice.split() if w.startswith("*")]
            # The rarest looking first: most places are left after one look.
            marked.sort(key=len, reverse=True)
            self.notices.append((words, edits, label, marked, regex.compile(_pattern(notice, edits))))
        self.automaton = ahocorasick.Automaton()
        for key, found in entries.items():
            self.automaton.add_word(key, (len(key), found))
        self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, str, int, float]]]:
        data = _WORDS[np.frombuffer(text, np.uint8)]
        blank = data == 0x20
        keep = ~blank
        keep[1:] |= blank[1:] & ~blank[:-1]  # one blank between two words
        line = f" {data[keep].tobytes().decode('utf-8', 'replace').strip(' ')} "
        if line == "  ":
            return 0, [], []
        size = line.count(" ") - 1
        places: list[tuple[int, str]] = []
        tried: set[tuple[int, int]] = set()
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for end, (length, entries) in self.automaton.iter(line):
            at = end - length + 1
            for number, offset, label in entries:
                if number < 0:
                    places.append((at, label))
                    continue
                words, edits, _, marked, pattern = self.notices[number]
                first = max(0, at - offset - edits - 1)
                if (number, first) in tried:
                    continue
                tried.add((number, first))
                last = first + len(words) + 3 * edits + 2
                if any(line.find(w, first, last) < 0 for w in marked):
                    continue
                hit = pattern.search(line, first, last)
                if hit is None or (wrong := sum(hit.fuzzy_counts)) > edits:
                    continue
                spot = (number, hit.start())
                if spot not in best or wrong < best[spot][1]:
                    best[spot] = (hit.end(), wrong)
        if not places and not best:
            return size, [], []
        blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), "<u4") == 0x20)

        def word(at: list[int]) -> list[int]:
            """Number of the word that begins at a place, or after a blank there."""
            return (np.searchsorted(blanks, at, side="right") - 1).tolist()

        numbers = word([at for at, _ in places])
        firsts = word([at for _, at in best])
        ends = word([end for end, _ in best.values()])
        found = []
        for (number, at), (_, wrong), first, end in zip(best, best.values(), firsts, ends):
            words, _, label, _, _ = self.notices[number]
            if not line.endswith(_NEGATED, 0, at):
                found.append((first, end, label, wrong, 1 - wrong / len(words)))
        return size, list(zip(numbers, (label for _, label in places))), sorted(found)


_NEGATED = tuple(f" {w} " for w in NEGATIONS)


@cache
def _scanner(phrases: tuple[tuple[str, str], ...], notices: tuple[tuple[str, str], ...], per_edit: int) -> Scanner:
    """One per Python worker."""
    return Scanner(phrases, notices, per_edit)


def scan_text(text: bytes, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, per_edit: int = CHARS_PER_EDIT):
    """Number of words, start word and label of each phrase, and the notices found: start word, end word, label, edits, likeness."""
    return _scanner(tuple(phrases.items()), tuple(notices.items()), per_edit).scan(text)


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """doc_id, n_words, places (word, label), notices (first, end, label, edits, likeness)."""
    place = pa.struct([("word", pa.int64()), ("label", pa.string())])
    notice = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("edits", pa.int64()), ("likeness", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column("text"))
            out = [scan_text(data[a:b].tobytes(), phrases, notices, per_edit) for a, b in zip(offsets[:-1], offsets[1:])]
            found = [[dict(zip(("word", "label"), x)) for x in row[1]] for row in out]
            near = [[dict(zip(("first", "end", "label", "edits", "likeness"), x)) for x in row[2]] for row in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([row[0] for row in out], pa.int64()), pa.array(found, pa.list_(place)), pa.array(near, pa.list_(notice))],
                names=["doc_id", "n_words", "places", "notices"],
            )

    schema = (
        "doc_id long, n_words long, places array<struct<word long, label string>>, "
        "notices array<struct<first long, end long, label string, edits long, likeness double>>"
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
