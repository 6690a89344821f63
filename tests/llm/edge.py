"""Documents with everything that may go wrong, and plain versions of what operators do."""

from __future__ import annotations

import random
import re
from collections import defaultdict

# Extra columns have names that operators use themselves.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, digest string, n int, "
    "grp bigint, label int, class_id bigint, component string, _id int, block string"
)


def documents(spark, rows):
    """A table of ``(doc_id, text, source)`` with extra columns."""
    return spark.createDataFrame(
        [(i, t, None, s, len(t or ""), -1, "d", 7, 3, None, None, "c", 1, "b") for i, t, s in rows], SCHEMA)


def odd_rows():
    prose = " ".join(random.Random(5).choice("the of cat dog house and runs blue is green".split()) for _ in range(400))
    return [
        (0, "a b  c", "s1"), (1, "a b c", None), (2, "a\tb c", "s2"), (3, None, "s1"), (4, "", "s1"), (5, " \n ", "s2"),
        (6, prose, "s1"), (7, prose + " tail", "s1"), (8, prose, "s3"), (9, "the the the", "s3"), (9, "the the the", "s3"),
        (10, "long " * 60_000, "s2"), (11, "x" * 50_000, None), (12, "é ß   ž 漢字 \U0001f600 don't <|endoftext|> z", "s2"),
        (13, "All rights reserved. Licensed under CC BY-NC 4.0, all rights reserved", "s1"), (None, "no id here", "s1"),
        (None, None, None), (14, "\x00 \x1c nul", "s2"),
    ]


def shingle_set(text, k):
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[j:j + k]) for j in range(len(words) - k + 1))


def brute_components(rows, k, percent):
    """{(id, text): (set size, least reachable id)} by comparing all sets that share a shingle."""
    sets = {(i, t): shingle_set(t, k) for i, t in rows if i is not None}
    having, above = defaultdict(list), {i: i for i, _ in sets}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for key in sorted(sets, key=repr):
        common = defaultdict(int)
        for shingle in sets[key]:
            for other in having[shingle]:
                common[other] += 1
            having[shingle].append(key)
        for other, n in common.items():
            if 100 * n >= percent * (len(sets[key]) + len(sets[other]) - n):
                a, b = root(key[0]), root(other[0])
                above[max(a, b)] = min(a, b)
    return {(i, t): (len(s), root(i) if s else i) for (i, t), s in sets.items()}
