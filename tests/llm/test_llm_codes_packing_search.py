"""Vector codes, packing and ranked search: against plain versions."""

import hashlib
import itertools
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from edge import documents, odd_rows
from fixtrail.llm import queries, ranked_search, square_packing, vector_codes
from fixtrail.llm.queries import vocabulary

SF_DIR = "/root/testdata/sf0.001"


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


# Vector codes.

def plain_codes(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label) in the order of ids."""
    vectors = [[math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in rows]
    width = len(vectors[0]) // parts
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in vectors]
    books = [[cut[n][p] for n in range(min(entries, len(rows)))] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest():
        return [[min(range(len(books[p])), key=lambda e: (away(v[p], books[p][e]), e)) for p in range(parts)] for v in cut]

    for _ in range(rounds):
        codes = nearest()
        for p in range(parts):
            members = defaultdict(list)
            for v, code in zip(cut, codes):
                members[code[p]].append(v[p])
            for e, found in members.items():
                books[p][e] = [sum(x) // len(found) for x in zip(*found)]
    codes = nearest()
    errors = [sum(away(v[p], books[p][c[p]]) for p in range(parts)) for v, c in zip(cut, codes)]
    label_errors = Counter()
    for (_, _, label), error in zip(rows, errors):
        label_errors[label] += error
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [(i, "".join(f"{x:02x}" for x in c), e, label_errors[label], digest)
            for (i, _, label), c, e in zip(rows, codes, errors)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 1, b"") for i, v, label in rows],
                                 "vec_id bigint, embedding array<float>, label int, code string, part int, places binary")


def test_codes_equal_plain_ones(spark, monkeypatch):
    given = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    rows = sorted((r.vec_id, r.embedding, r.label) for r in given)
    want = plain_codes(rows, 16, 64, 2)
    assert ordered(queries.op11_vector_codes(spark, SF_DIR).collect()) == ordered(want)
    monkeypatch.setattr(vector_codes, "ROOM", 500)
    small = vector_codes.vector_codes(vectors(spark, rows), parts=4, entries=5, rounds=3).collect()
    assert ordered(small) == ordered(plain_codes(rows, 4, 5, 3))


def test_codes_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(n, [float(np.float32(x)) for x in rng.normal(size=8) * 3], [1, None, 2][n % 3]) for n in range(200)]
    # Copies, ties between entries, and one label with most rows.
    rows += [(200 + n, rows[0][1], None) for n in range(300)]
    usable = sorted(rows, key=lambda r: r[0])
    dropped = [(1000, None, 1), (1001, [float("nan")] * 8, 1), (1002, [float("inf")] + [0.0] * 7, 1), (1003, [None] + [0.0] * 7, 1)]
    other = [(1004, [], 1), (1005, [1.0] * 4, 1), (1006, [1.0] * 9, None)]
    got = vector_codes.vector_codes(vectors(spark, rows + dropped + other), parts=4, entries=16)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = plain_codes(usable, 4, 16, 2)
    coded = [r for r in got.collect() if r.code is not None]
    assert ordered(coded) == ordered(want)
    assert {(r.vec_id, r.error) for r in got.collect() if r.code is None} == {(1004, None), (1005, None), (1006, None)}
    # Fewer vectors than entries; a null id is coded and gives no entry; rows of one id are coded each.
    few = [(5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (None, [0.5, -2.0], 1)]
    got = vector_codes.vector_codes(vectors(spark, few), parts=2, entries=64).collect()
    assert len(got) == 3 and {r.vec_id for r in got} == {5, None} and all(len(r.code) == 4 for r in got)
    assert vector_codes.vector_codes(vectors(spark, [])).collect() == []
    assert vector_codes.vector_codes(vectors(spark, dropped)).collect() == []
    with pytest.raises(Exception, match="too large"):
        vector_codes.vector_codes(vectors(spark, [(1, [1e30] * 16, 1)])).collect()


@pytest.mark.parametrize("dimensions", [1, 2, 3, 4])
def test_the_curve_steps_to_neighbours(dimensions):
    points = np.array(list(itertools.product(range(256 if dimensions == 1 else 4), repeat=dimensions)))
    # Stretched to the whole box, so that one cell is one point.
    order = vector_codes.hilbert_order(points * (1 if dimensions == 1 else 85))
    steps = np.abs(np.diff(points[order], axis=0)).sum(axis=1)
    assert sorted(order.tolist()) == list(range(len(points)))
    assert (steps == 1).all()


def test_shortlists_hold_all_that_may_be_nearest():
    rng = np.random.default_rng(7)
    values = rng.integers(-40, 40, (640, 3))
    values = values[vector_codes.hilbert_order(values)]
    entries = np.concatenate([rng.integers(-40, 40, (30, 3)), values[:3], values[:3]])
    starts = np.arange(0, 640, vector_codes.BLOCK)
    listed = vector_codes.shortlists(np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts), entries)
    assert listed.sum(axis=1).mean() < len(entries) / 2
    away = ((values[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (vector_codes.nearest(values, listed, entries) == away.argmin(axis=1)).all()
    # An odd number of values, and coordinates that need 64 bits.
    far = values[:100] * 60_000
    everything = np.ones((-(-100 // vector_codes.BLOCK), len(entries)), bool)
    away = ((far[:, None] - entries[None] * 60_000) ** 2).sum(axis=2)
    assert (vector_codes.nearest(far, everything, entries * 60_000) == away.argmin(axis=1)).all()


# Packing.

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return lambda name: Tokenizer.from_file(vocabulary(name))


def plain_pieces(rows, tokenizer, capacity):
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for n, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start:start + capacity]
            yield doc_id, n, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))


def fills(rows, capacity):
    """Checks that sequences have no gap and no overlap; their fill levels."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for found in by_sequence.values():
        place = 0
        for offset, length in sorted(found):
            assert offset == place
            place += length
        assert place <= capacity
    return [sum(n for _, n in found) for found in by_sequence.values()]


@pytest.mark.parametrize("name,capacity,batch_bytes", [
    ("word_bpe_49k.json", 4096, 1 << 22), ("word_bpe_49k.json", 50, 300), ("byte_bpe_50k.json", 50, 300)])
def test_pieces_are_the_library_s(spark, tokenizer, name, capacity, batch_bytes):
    square_packing._WORDS.clear()
    more = [(20, "ab." * 3000 + " Ünï̈ ́x isn't we'll'd 12ab <|endoftext|>y<|startoftext|> ..", "s"),
            (21, " ".join(f"w{n % 7}ord{'.' * (n % 3)}" for n in range(3000)), "s")]
    for docs in (documents(spark, odd_rows() + more), spark.read.parquet(f"{SF_DIR}/documents.parquet")):
        got = square_packing.pieces(docs, vocabulary(name), capacity, batch_bytes=batch_bytes)
        want = plain_pieces([(r.doc_id, r.text) for r in docs.collect()], tokenizer(name), capacity)
        assert ordered(got.collect()) == ordered(want)
    square_packing._WORDS.clear()


def test_the_table_of_words_is_bounded(tokenizer):
    words = square_packing.WordIds(vocabulary("word_bpe_49k.json"), most=10)
    whole = tokenizer("word_bpe_49k.json")
    for n in range(5):
        texts = [f"alpha{chr(97 + n)} Beta{chr(97 + k)}, gamma" for k in range(20)]
        import pyarrow as pa

        ids, ends = words(pa.array(texts))
        assert ids.tolist() == [i for t in texts for i in whole.encode(t, add_special_tokens=False).ids]
        assert len(words.known) < 60 and len(ends) == 20


def test_sequences_are_full_and_whole(spark, tokenizer):
    rows = queries.op12_square_packing(spark, SF_DIR).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert ordered(r[:5] for r in rows) == ordered(plain_pieces(docs, tokenizer("word_bpe_49k.json"), 4096))
    assert len(fills(rows, 4096)) <= math.ceil(sum(r.length for r in rows) / 4096) * 1.02 + 1
    rng = np.random.default_rng(1)
    lengths = [int(x) for x in np.minimum(4096, rng.lognormal(6.4, 0.9, 30_000) + 1)]
    table = spark.createDataFrame([(n, 0, 0, x, 7) for n, x in enumerate(lengths)], square_packing.PIECES)
    for shard in (1 << 14, 2_000):
        rows = square_packing.packed(table, shard=shard).collect()
        assert ordered((r.doc_id, r.length) for r in rows) == ordered(enumerate(lengths))
        assert len(fills(rows, 4096)) <= sum(lengths) / 4096 * (1.001 if shard > 2_000 else 1.01) + 1


def test_packing_of_odd_tables(spark):
    assert square_packing.pack_documents(documents(spark, []), vocabulary("word_bpe_49k.json")).collect() == []
    rows = square_packing.pack_documents(documents(spark, odd_rows()), vocabulary("word_bpe_49k.json")).collect()
    fills(rows, 4096)
    assert len([r for r in rows if r.doc_id is None]) == 2 and len([r for r in rows if r.doc_id == 9]) == 2
    # One size only, and pieces of a whole sequence.
    table = spark.createDataFrame([(1, n, 0, 4096 if n % 2 else 1024, 7) for n in range(400)], square_packing.PIECES)
    assert sorted(fills(square_packing.packed(table).collect(), 4096)) == [4096] * 250


def test_squares_decide_the_place():
    # Gaps after 60, 60, 70: 40 twice, 30 once. A 10 turns a 40 into a 30 (1 + 4) or the 30 into a 20 (4 + 1): the
    # smaller gap wins the tie; a new one would leave 4 + 1 + 1.
    sequences, offsets = square_packing.place_by_squares([60, 60, 70, 10], 100, 4)
    assert (sequences, offsets) == ([0, 1, 2, 2], [0, 0, 0, 70])
    # Behind the tail's start no new sequence is opened where one has room.
    assert square_packing.place_by_squares([60, 90, 30], 100, 3)[0] == [0, 1, 2]
    assert square_packing.place_by_squares([60, 90, 30], 100, 2)[0] == [0, 1, 0]


# Ranked search.

def plain_search(docs, items, k):
    found = lambda text: re.findall(
        "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    bags = [(i, Counter(found(t)), len(found(t))) for i, t in docs if found(t)]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    holding = Counter(t for _, bag, _ in bags for t in bag)
    rows = []
    for item_id, text in items:
        wanted, scored = Counter(found(text)), []
        for doc_id, bag, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                        * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m)) for t, r in wanted.items() if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return rows


def test_search_equals_plain_search(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    want = plain_search([(r.doc_id, r.text) for r in read("documents").collect()],
                        [(r.item_id, r.text) for r in read("benchmark").collect()], 10)
    assert ordered(queries.op13_ranked_search(spark, SF_DIR).collect()) == ordered(want)


@pytest.mark.parametrize("items,room,k", [(2_000, 1 << 21, 10), (2, 5, 3)])
def test_search_of_odd_tables(spark, monkeypatch, items, room, k):
    monkeypatch.setattr(ranked_search, "ITEMS", items)
    monkeypatch.setattr(ranked_search, "ROOM", room)
    copies = [(100 + n, "the cat runs over the house", "s") for n in range(60)]
    docs = odd_rows() + copies + [(500, "cat", "s"), (499, "cat", "s"), (498, "CAT!", "s"), (None, "cat", "s")]
    asked = [(1, "cat the the House"), (1, "dog and blue"), (None, "漢字 DON t"), (3, None), (4, "!!"), (5, "unknown"),
             (6, "rights reserved " * 3)]
    table = spark.createDataFrame([(i, t, 1, 2) for i, t in asked], "item_id bigint, text string, doc_id int, rank int")
    got = ranked_search.search(documents(spark, docs), table, k)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert ordered(got.collect()) == ordered(plain_search([(i, t) for i, t, _ in docs], asked, k))
    for empty_docs, empty_items in ((True, False), (False, True)):
        found = ranked_search.search(documents(spark, [] if empty_docs else docs), table.where("false") if empty_items else table)
        assert found.collect() == []


def test_large_scores_are_added_exactly():
    part = np.array([1 << 60, 3], np.int64)
    got = ranked_search._scores(part, np.array([1, 1]), np.array([0, 1]), 0, np.array([2]), np.array([0, 0]), np.array([1, 1]),
                                np.array([0, 1, 2]), 1, False)
    assert got.tolist() == [[(1 << 60) + 3]]
