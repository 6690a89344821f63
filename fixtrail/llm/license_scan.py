"""License scans (2) through a positional index of rare words.

The index covers a fixed list of notices: for the word of each notice's key phrases that occurs in the fewest notices
(highest inverse document frequency) it holds (notice, position). In a file, each such word is looked up; file position
minus notice position is where the notice would start. A candidate counts when all its key phrases are there, word by
word, further ones at most some words from where they stand in the notice. How much of the other words is in place makes
the score and decides nothing. The index is a few kB and travels with the function; nothing is shuffled, and the lookups take time in
proportion to the occurrences of rare words.

Defined results: a null, empty or blank text has no words, no places, empty labels and score 0; repeated rows
give repeated results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import byte_sliced, id_and_text

SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, notices string, n_notices bigint"
)

# Words by which the distance of two key phrases may differ from the notice's: "either version 3" stands eight words later
# where the public licence is named "as published by the free software foundation".
SLACK = 10

# Bytes of UTF-8: a word is a run of digits, small letters and characters beyond ASCII.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class Notice:
    """A text to look for; ``key`` phrases must be found whole."""

    name: str
    label: str
    text: str
    key: tuple[str, ...]
    base: bool = False


# The base phrases and common licence notices.
NOTICES = (
    Notice("base-cc-by", "cc-by", "cc by", ("cc by",), True),
    Notice("base-gpl", "gpl", "general public license", ("general public license",), True),
    Notice("base-reserved", "reserved", "all rights reserved", ("all rights reserved",), True),
    Notice("cc-by-nc-line", "cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Notice("cc-by-sa-line", "cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Notice("cc-by-long", "cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
           ("creative commons attribution",)),
    Notice("gpl3-line", "gpl-3", "this work is licensed under the gnu general public license version 3",
           ("gnu general public license", "version 3")),
    Notice("gpl2-line", "gpl-2", "licensed under the gnu general public license version 2",
           ("gnu general public license", "version 2")),
    Notice("gpl-warranty", "gpl", "this program is distributed in the hope that it will be useful but without any "
           "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the "
           "gnu general public license for more details", ("in the hope that it will be useful",
                                                          "gnu general public license")),
    Notice("lgpl-line", "lgpl", "licensed under the gnu lesser general public license",
           ("gnu lesser general public license",)),
    Notice("agpl-line", "agpl", "licensed under the gnu affero general public license",
           ("gnu affero general public license",)),
    Notice("mit-line", "mit", "released under the mit license", ("mit license",)),
    Notice("mit-grant", "mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
           "software and associated documentation files to deal in the software without restriction",
           ("permission is hereby granted", "free of charge")),
    Notice("apache2-line", "apache-2", "licensed under the apache license version 2 0", ("apache license", "version 2")),
    Notice("bsd-grant", "bsd", "redistribution and use in source and binary forms with or without modification are "
           "permitted provided that the following conditions are met",
           ("redistribution and use in source and binary forms",)),
    Notice("mpl2-line", "mpl-2", "subject to the terms of the mozilla public license v 2 0",
           ("mozilla public license",)),
    Notice("isc-grant", "isc", "permission to use copy modify and or distribute this software for any purpose with or "
           "without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    Notice("unlicense-line", "unlicense", "this is free and unencumbered software released into the public domain",
           ("unencumbered software",)),
)


class RareWordIndex:
    """Posting of the rarest word of each notice's key phrases."""

    def __init__(self, notices: Sequence[Notice] = NOTICES):
        self.notices = list(notices)
        self.words = [n.text.encode().split() for n in self.notices]
        in_notices = Counter(w for words in self.words for w in set(words))
        self.idf = {w: math.log((1 + len(self.notices)) / n) for w, n in in_notices.items()}
        self.weight = [sum(self.idf[w] for w in words) for words in self.words]
        # Where in the notice each mandatory phrase stands; the one with the rarest word comes first.
        self.keys = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for n, (notice, words) in enumerate(zip(self.notices, self.words)):
            found = []
            for phrase in (p.encode().split() for p in notice.key):
                at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
                rarest = min(range(at, at + len(phrase)), key=lambda i: (-self.idf[words[i]], i))
                found.append((-self.idf[words[rarest]], rarest, at, phrase))
            found.sort()
            self.postings[found[0][3][found[0][1] - found[0][2]]].append((n, found[0][1]))
            self.keys.append([(at, phrase) for _, _, at, phrase in found])
        self.postings = dict(self.postings)

    def starts(self, words: list[bytes], notice: int, start: int) -> list[int] | None:
        """Where the notice would start by each of its key phrases; none unless all are there.

        The first phrase stands where ``start`` says, the others at most ``SLACK`` words from there.
        """
        (at, phrase), *others = self.keys[notice]
        if start + at < 0 or words[start + at:start + at + len(phrase)] != phrase:
            return None
        found = [start]
        for at, phrase in others:
            near = next((s for s in sorted(range(start - SLACK, start + SLACK + 1), key=lambda s: abs(s - start))
                         if s + at >= 0 and words[s + at:s + at + len(phrase)] == phrase), None)
            if near is None:
                return None
            found.append(near)
        return found

    def places(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(notice, start, share of its weight found in place) of each verified candidate; a start may be below 0."""
        rare = self.postings.keys() & set(words)
        if not rare:
            return []
        found = []
        for i, word in enumerate(words):
            if word not in rare:
                continue
            for notice, position in self.postings[word]:
                starts = self.starts(words, notice, i - position)
                if starts is None:
                    continue
                there = sum(self.idf[w] for k, w in enumerate(self.words[notice])
                            if any(0 <= s + k < len(words) and words[s + k] == w for s in starts))
                found.append((notice, i - position, there / self.weight[notice]))
        return found

    def scan(self, text: str) -> tuple:
        """The result row of a text without its id."""
        words = _WORD.findall(text.encode().lower())
        found = self.places(words)
        base = [start for n, start, _ in found if self.notices[n].base]
        joined = lambda names: ",".join(sorted(set(names)))
        return (
            len(words), len(base), min(base, default=None), max(base, default=None),
            joined(self.notices[n].label for n, _, _ in found if self.notices[n].base),
            joined(self.notices[n].label for n, _, _ in found), min(1.0, max((s for _, _, s in found), default=0.0)),
            joined(self.notices[n].name for n, _, _ in found if not self.notices[n].base),
            sum(not self.notices[n].base for n, _, _ in found))


def scan_documents(docs: DataFrame, notices: Sequence[Notice] = NOTICES,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document.

    ``n_base``, ``first_word`` and ``last_word`` tell of places of base phrases; ``labels`` has base labels
    and those of notices, ``notices`` names them, ``score`` is the largest share of a notice's word weight in place.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RareWordIndex(notices)
        for batch in byte_sliced(batches, "text", 4 << 20):
            rows = [index.scan(text) for text in batch.column("text").to_pylist()]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.int64()]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(scan, SCHEMA)
