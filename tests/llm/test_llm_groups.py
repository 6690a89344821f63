"""Deduplication, joins, components, mixing: against brute force and SQL."""

import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from edge import brute_components, documents, odd_rows, shingle_set
from fixtrail.llm import fair_mix, grouped_prefix_join, queries, stream_dedup
from fixtrail.llm.components import components
from fixtrail.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    problem, _ = compare(spark, connect(SF_DIR), queries.QUERIES[name], queries.ORACLES[name], SF_DIR)
    assert problem is None


def texts_with_families(seed=1):
    """Families of edited copies around a base, with a passage that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(30)]
    rows = []
    for family in range(8):
        base = [word() for _ in range(rng.choice([6, 40, 120]))] + (passage if family % 2 else [])
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 60)])
def test_components_against_all_pairs(spark, words, percent):
    for rows in (texts_with_families(), [(i, t) for i, t, _ in odd_rows() if i != 10]):
        docs = documents(spark, [(i, t, "s") for i, t in rows]).repartition(4)
        got = grouped_prefix_join.join_components(docs, words, percent).collect()
        want = brute_components(rows, words, percent)
        by_id = defaultdict(set)
        for (i, _), value in want.items():
            by_id[i].add(value)
        assert len(got) == len(rows)
        for row in got:
            if row.doc_id is None:
                assert row.component_id is None
            else:
                assert (row.n_shingles, row.component_id) in by_id[row.doc_id]


def test_group_pairs_are_filtered_without_loss(spark, monkeypatch):
    """Few buckets make most shingles common, so that bounds and hot ones decide."""
    monkeypatch.setattr(grouped_prefix_join, "BUCKETS", 1 << 8)
    rows = texts_with_families(3)
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in grouped_prefix_join.join_components(docs, 4, 85).collect()}
    assert got == {i: v for (i, _), v in brute_components(rows, 4, 85).items()}


def test_long_lists_are_cut_into_blocks(spark, monkeypatch):
    """Lists of more than three classes go by pairs of blocks, and no bitmap lets a pair of the first turn pass."""
    monkeypatch.setattr(grouped_prefix_join, "LIST", 3)
    monkeypatch.setattr(grouped_prefix_join, "may_link", lambda *_: F.lit(False))
    rows = texts_with_families(5)
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in grouped_prefix_join.join_components(docs, 4, 85).collect()}
    assert got == {i: v for (i, _), v in brute_components(rows, 4, 85).items()}


@pytest.mark.parametrize("seed", range(5))
def test_few_edges_connect_what_a_table_links(seed):
    rng = np.random.default_rng(seed)
    link = rng.random((40, 30)) < 0.04
    left, right = np.arange(40), np.arange(100, 130)
    edges = grouped_prefix_join.connected(link, left, right)
    i, j = np.nonzero(link)
    all_edges = list(zip(left[i].tolist(), right[j].tolist()))
    assert set(edges) <= set(all_edges) and len(edges) <= 70
    roots = lambda es: {x: min(c) for c in _parts(es) for x in c}
    assert roots(edges) == roots(all_edges)
    assert roots(grouped_prefix_join.joined_up(left[i], right[j])) == roots(all_edges)


def _parts(edges):
    parts = []
    for a, b in edges:
        near = [p for p in parts if a in p or b in p]
        parts = [p for p in parts if p not in near] + [set().union({a, b}, *near)]
    return parts


def brute_links(rows, words, percent):
    """{(id, text): set}, and the pairs of different rows that link."""
    sets = [(i, t, shingle_set(t, words)) for i, t in rows if i is not None]
    links = {(a, b) for a in range(len(sets)) for b in range(a) if (common := len(sets[a][2] & sets[b][2]))
             and 100 * common >= percent * (len(sets[a][2]) + len(sets[b][2]) - common)}
    return sets, links


@pytest.mark.parametrize("block, words, percent", [(1 << 19, 4, 85), (1 << 13, 2, 60)])
def test_all_links_against_all_pairs(spark, monkeypatch, block, words, percent):
    """Small blocks spread each family over many pairs of blocks."""
    monkeypatch.setattr(grouped_prefix_join, "BLOCK", block)
    twice = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen " * 3
    odd = [(i, t) for i, t, _ in odd_rows() if i != 10] + [(90, twice), (90, twice + "and")]
    for rows in ([(100 + i, t) for i, t in texts_with_families()] + odd,):
        docs = documents(spark, [(i, t, "s") for i, t in rows]).repartition(4)
        sets, links = brute_links(rows, words, percent)
        degree = Counter(x for pair in links for x in pair)
        got = grouped_prefix_join.join_components(docs, words, percent).collect()
        assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in got if r.doc_id is not None) == Counter(
            (i, len(s), degree[x]) for x, (i, _, s) in enumerate(sets))
        assert all(r.n_links is None for r in got if r.doc_id is None)
        members, pairs = grouped_prefix_join.join_links(docs, words, percent)
        first = {}
        for i, _, s in sorted(sets, key=lambda x: x[0]):
            first.setdefault(s, i)
        assert Counter(map(tuple, members.collect())) == Counter((i, first[s]) for i, _, s in sets if s)
        want = {frozenset((sets[a][2], sets[b][2])) for a, b in links if sets[a][2] != sets[b][2]}
        assert Counter(map(tuple, pairs.collect())) == Counter(tuple(sorted(first[s] for s in p)) for p in want)


def test_shingle_sets_have_the_right_size():
    shingler = grouped_prefix_join.Shingler(4)
    for _, text in texts_with_families() + [(0, ""), (1, "a"), (2, "A b"), (3, "a a a a a a")]:
        assert len(shingler(text)) == len(shingle_set(text, 4))


def test_one_of_each_component_stays(spark):
    rows = texts_with_families()
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    kept = grouped_prefix_join.keep_one(docs)
    assert kept.columns == docs.columns
    want = {c for _, c in brute_components(rows, 5, 80).values()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_empty_tables(spark):
    docs = documents(spark, odd_rows()).where(F.lit(False))
    assert grouped_prefix_join.join_components(docs).count() == 0
    assert stream_dedup.dedup_documents(docs).count() == 0
    assert fair_mix.mix_documents(docs).count() == 0
    assert fair_mix.mixed_rows(docs).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(3, 3), (60, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 61)}


def normalised(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def dedup_wanted(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normalised(t)].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, least[normalised(t)], len(groups[normalised(t)])) for i, t in rows)


@pytest.mark.parametrize("digits", [64, 1, 0])
def test_dedup_with_colliding_digests(spark, digits):
    rows = [(i, t) for i, t, _ in odd_rows()]
    docs = documents(spark, odd_rows())
    digest = lambda c: F.substring(stream_dedup.sha256_of(c), 1, digits)
    got = stream_dedup.dedup(docs, digest).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == dedup_wanted(rows)


def test_state_continues_with_the_next_delivery(spark):
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "state")
    first, second = [(5, "a"), (6, "b")], [(2, "a"), (7, "c")]
    for rows in (first, second):
        stream_dedup.land(documents(spark, [(i, t, "s") for i, t in rows]), landed)
        state = stream_dedup.dedup_state(spark, landed, checkpoint)
    got = {(r.keep_id, r.group_size) for r in state.collect()}
    assert got == {(2, 2), (6, 1), (7, 1)}
    assert state.where("locator IS NULL").count() == 0


def test_first_of_equal_texts_stays(spark):
    docs = documents(spark, odd_rows())
    kept = stream_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, normalised(r.text)) for r in kept.collect())
    want = {(i, t) for i, t in ((i, normalised(t)) for i, t, _ in odd_rows())
            if i == min((j for j, u, _ in odd_rows() if normalised(u) == t and j is not None), default=None)}
    assert got == Counter({x: 1 for x in want})


def test_mix_keeps_to_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(30))), rng.choice("aaaaaabbc")) for i in range(600)]
    rows += [(700, None, "a"), (701, "w w", None), (701, "w w", None), (None, "w", "b")]
    docs = documents(spark, rows)
    got = fair_mix.mix_documents(docs).collect()
    assert len(got) == len(rows)
    total = sum(r.size for r in got)
    by_source = defaultdict(list)
    for row in got:
        assert row.taken == row.passes * row.size and 0 <= row.passes <= 3
        by_source[row.source].append(row)
    assert sum(r.taken for r in got) <= total
    for found in by_source.values():
        target, size = found[0].target, sum(r.size for r in found)
        assert found[0].source_size == size and target <= 3 * size
        assert abs(sum(r.taken for r in found) - target) <= 2 * max(r.size for r in found)
    assert sum(v[0].target for v in by_source.values()) == pytest.approx(total)
    again = fair_mix.mix_documents(docs.repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    copies = Counter((r.doc_id, r.source) for r in fair_mix.mixed_rows(docs).collect())
    want = Counter()
    for row in got:
        want[(row.doc_id, row.source)] += row.passes
    assert copies == +want and fair_mix.mixed_rows(docs).columns == docs.columns


def test_mix_runs_without_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = fair_mix.mix_documents(docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


class Lists:
    """Stands for the DataFrame that ``near_lists`` reads; gives its function."""

    def select(self, *columns):
        return self

    repartition = sortWithinPartitions = select

    def mapInArrow(self, function, schema):
        return function


def listed(token, first, second, block, component, n, m):
    """A sorted batch of rows of ``near_lists``, as if all prefixes reached the common shingles."""
    rows = len(token)
    order = np.lexsort((second, first, token))
    column = lambda x, kind: pa.array(np.asarray(x)[order], kind)
    return pa.RecordBatch.from_arrays(
        [column(token, pa.int64()), column(np.zeros(rows, bool), pa.bool_()), column(first, pa.int64()),
         column(second, pa.int64()), column(block, pa.int64()), column(component, pa.int64()), column(n, pa.int32()),
         column(m, pa.int32()), column(np.ones(rows, bool), pa.bool_()), column(m, pa.int32()),
         column(np.zeros(rows), pa.int32()), column(np.zeros(rows), pa.int64())],
        ["token", "own", "first", "second", "block", "component", *grouped_prefix_join.KNOWN[1:]])


def test_edges_of_a_long_list_stay_few():
    rows, zero = 1500, np.zeros(1500, np.int64)
    batch = listed(zero, zero, zero, zero, np.random.default_rng(1).permutation(rows), zero + 400, zero + 390)
    tracemalloc.start()
    found = [x for x in grouped_prefix_join.near_lists(Lists(), 85)(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    edges = [(u, v) for x in found for u, v in zip(*(c.to_pylist() for c in x.columns))]
    assert len(edges) == rows - 1 and len(grouped_prefix_join.joined_up(*np.array(edges).T)) == rows - 1
    # An edge per pair would take more than 100 MB.
    assert peak < 16 << 20


def test_edges_between_blocks_of_a_list_stay_few():
    """Two blocks of a list that is cut, with the pipeline's share."""
    rows, zero = 1500, np.zeros(1500, np.int64)
    batch = listed(zero, zero, zero + 1, np.arange(rows) // 750, np.arange(rows), zero + 390, zero + 370)
    tracemalloc.start()
    found = [x for x in grouped_prefix_join.near_lists(Lists(), 80)(iter([batch]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(x.num_rows for x in found) == rows - 1 and peak < 16 << 20


@pytest.mark.parametrize("seed", range(6))
def test_lists_join_what_all_pairs_join(seed):
    rng = np.random.default_rng(seed)
    rows = 700
    token = rng.choice([3, 5, 6, 8, 9], rows, p=[0.6, 0.25, 0.1, 0.04, 0.01])
    n = rng.choice([20, 22, 26, 60, 200, 204], rows) + rng.integers(0, 4, rows)
    m = (n * rng.uniform(0.75, 1, rows)).astype(int)
    second = np.where(token == 5, 1, 0)
    block = np.where(token == 5, rng.integers(0, 2, rows), 0)
    component = rng.integers(0, 500, rows)
    batch = listed(token, np.zeros(rows, int), second, block, component, n, m)
    parts = [batch.slice(k, 150) for k in range(0, rows, 150)]
    found = [e for x in grouped_prefix_join.near_lists(Lists(), 85)(iter(parts)) for e in zip(*(c.to_pylist() for c in x.columns))]
    bound = np.minimum(m[:, None], m[None, :]) * 185
    wanted = np.triu((token[:, None] == token[None, :]) & (bound >= 85 * (n[:, None] + n[None, :])), 1)
    wanted &= (second == 0)[:, None] | (block[:, None] != block[None, :])
    i, j = np.nonzero(wanted & (component[:, None] != component[None, :]))

    def roots(edges):
        above = grouped_prefix_join.least_of(np.arange(500), [(int(a), int(b)) for a, b in edges])
        return above.tolist()

    assert roots(found) == roots(zip(component[i], component[j]))
    assert len(found) <= rows
