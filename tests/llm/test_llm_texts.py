"""Fingerprints, licence scans, token counts, encoding: against plain versions."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge import documents, odd_rows
from fixtrail.llm import bpe_words, license_scan, spotsigs, token_counts
from fixtrail.llm.queries import vocabulary

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return lambda name: Tokenizer.from_file(vocabulary(name))


def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("batch_bytes", [1, 1 << 20])
def test_token_counts_are_the_library_s(spark, tokenizer, batch_bytes):
    whole = tokenizer("word_bpe_49k.json")
    for docs in (documents(spark, odd_rows()), given(spark)):
        got = token_counts.count_tokens(docs, vocabulary("word_bpe_49k.json"), limit=50, batch_bytes=batch_bytes,
                                        remembered=3 if batch_bytes == 1 else 300_000).collect()
        want = []
        for row in docs.select("doc_id", "text").collect():
            n = len(whole.encode(row.text or "", add_special_tokens=False).ids)
            want.append((row.doc_id, len((row.text or "").encode()), n, n > 50))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_token_counts_of_a_piece_model(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    docs = documents(spark, odd_rows())
    got = token_counts.count_tokens(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "n_tokens").collect()
    want = [(r.doc_id, len(model.encode(r.text or ""))) for r in docs.collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("block_bytes", [20, 1 << 25])
def test_encoding_and_decoding_are_the_library_s(spark, tokenizer, block_bytes):
    whole = tokenizer("byte_bpe_50k.json")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    tables = [documents(spark, odd_rows())] + ([given(spark)] if block_bytes > 20 else [])
    for docs in tables:
        got = bpe_words.encode_decode(docs, vocabulary("byte_bpe_50k.json"), block_bytes).collect()
        want = []
        for row in docs.collect():
            ids = whole.encode(row.text or "", add_special_tokens=False).ids
            want.append((row.doc_id, len(ids), sha(",".join(map(str, ids))),
                         sha(whole.decode(ids, skip_special_tokens=False))))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_encoding_joins_words_not_texts(spark):
    plan = bpe_words.encode_decode(given(spark), vocabulary("byte_bpe_50k.json"))._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") == 3
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical


def brute_signatures(text):
    words = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found = set()
    for i, word in enumerate(words):
        if word in spotsigs.ANCHORS:
            chain = [w for w in words[i + 1:] if w not in spotsigs.ANCHORS][:spotsigs.CHAIN]
            if chain:
                found.add((word, *chain))
    return found or ({tuple(words) if words else text} if text else set())


def test_fingerprints_and_edits(spark):
    for rows in ([(r.doc_id, r.text) for r in given(spark).collect()],
                 [(i, t) for i, t, _ in odd_rows() if i is not None and i not in (9, 10)]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
        got = {r.doc_id: r for r in spotsigs.with_edits(docs).collect()}
        rows = sorted((i, t or "") for i, t in rows)
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        assert len(got) == len(rows)
        for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
            cut = len(text) // 4
            edited = text[:len(text) - cut] + after[:cut]
            own = brute_signatures(text)
            row = got[i]
            assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (row.n_signatures, len(row.fingerprint)) == (len(own), 10 * len(own))
            assert row.near_edited == pytest.approx(like(own, brute_signatures(edited)))
            assert row.near_next == pytest.approx(like(own, brute_signatures(after)))
        by_text = {}
        for i, text in rows:
            assert by_text.setdefault(text, got[i].fingerprint) == got[i].fingerprint


def test_likeness_falls_with_the_edit_in_texts_without_common_words():
    codes = spotsigs.WordCodes()
    signed = lambda words: spotsigs.signatures(" ".join(words), codes, by_content=True)
    for size in (12, 37, 94, 2000):
        words = [f"слово{n * n % 10007}" for n in range(size)]
        own = signed(words)
        assert size / 6 < len(own) < size and len(signed(words + ["the"])) > size / 6
        for at in range(0, size, max(1, size // 20)):
            for new in ("другое", "the"):
                edited = signed(words[:at] + [new] + words[at + 1:])
                # An edit reaches the windows that hold the word and the chains before it.
                assert len(np.intersect1d(own, edited)) >= len(own) - 8
                if size > 30:
                    assert spotsigs.likeness(own, edited) > 0.4
        assert spotsigs.likeness(own, signed([f"x{n}" for n in range(size)])) == 0


def test_near_columns_of_texts_without_common_words(spark):
    words = [f"слово{n * n % 10007}" for n in range(80)]
    docs = documents(spark, [(1, " ".join(words), "s"), (2, " ".join(words[:40] + ["другое"] + words[41:]), "s")])
    first = spotsigs.with_edits(docs).orderBy("doc_id").first()
    assert first.near_next == 0 and first.near_next_by_content > 0.6 and first.near_edited_by_content > 0.6


def test_fingerprints_of_odd_tables(spark):
    docs = documents(spark, odd_rows())
    assert spotsigs.with_edits(docs).count() == docs.count()
    assert spotsigs.with_edits(docs.limit(0)).count() == 0
    alone = spotsigs.with_edits(documents(spark, [(5, "abcdefgh", "s")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_near_pairs_against_all_pairs(spark, threshold):
    docs = given(spark)
    sets = spotsigs.signature_sets(docs)
    members, pairs = spotsigs.near_pairs(sets, threshold)
    known = {r.doc_id: frozenset(r.signatures) for r in sets.collect()}
    first = {}
    for i in sorted(known):
        first.setdefault(known[i], i)
    assert {r.doc_id: r.class_id for r in members.collect()} == {i: first[s] for i, s in known.items()}
    classes = [(i, s) for s, i in first.items() if s]
    want = {(min(a, b), max(a, b)) for n, (a, s) in enumerate(classes) for b, t in classes[:n]
            if len(s & t) >= threshold * len(s | t)}
    assert {(r.left_id, r.right_id) for r in pairs.collect()} == want


def test_license_scan_against_all_places(spark):
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for docs in (documents(spark, odd_rows()), given(spark)):
        want = []
        for row in docs.collect():
            text = re.sub("[A-Z]", lambda m: m[0].lower(), row.text or "")
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
            places = [(i, label) for phrase, label in phrases.items() for i in range(len(words))
                      if words[i:i + len(phrase.split())] == phrase.split()]
            starts = [i for i, _ in places]
            want.append((row.doc_id, len(words), len(starts), min(starts, default=None), max(starts, default=None),
                         ",".join(sorted({x for _, x in places}))))
        got = license_scan.scan_documents(docs)
        assert sorted(map(tuple, got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
                          .collect()), key=repr) == sorted(want, key=repr)
        assert got.where("score < 0 OR score > 1 OR (n_base > 0 AND score < 1)").count() == 0


def test_license_notices(spark):
    notice = next(n for n in license_scan.NOTICES if n.name == "bsd-grant").text
    changed = notice.replace("source and binary", "source or binary")
    some = notice.replace("conditions", "terms")
    docs = documents(spark, [(1, f"x y {notice} z", "s"), (2, changed, "s"), (3, some.upper(), "s"),
                             (4, "Released under the MIT License.", "s"), (5, "GNU Lesser General Public License", "s")])
    got = {r.doc_id: r for r in license_scan.scan_documents(docs).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4)] == ["bsd", "", "bsd", "mit"]
    assert got[1].score == pytest.approx(1.0) and 0.7 <= got[3].score < 1
    assert (got[5].base_labels, got[5].labels) == ("gpl", "gpl,lgpl")


def test_key_phrases_decide_the_label(spark):
    texts = {
        "Licensed under the MIT License": "mit", "Distributed under the MIT License": "mit", "The MIT License (MIT)": "mit",
        "GNU General Public License version 3": "gpl,gpl-3",
        "Released under the GNU General Public License version 3": "gpl,gpl-3",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License": "gpl,gpl-3",
        "Licensed under the well known Apache License, in its Version 2.0": "apache-2",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee": "isc",
        "GNU General Public License " + "x " * 20 + "version 3": "gpl", "Apache License, Version 1": "",
    }
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in license_scan.scan_documents(docs).collect()}
    assert [got[i].labels for i in range(len(texts))] == list(texts.values())
    assert 0 < got[2].score < 0.7


def test_empty_tables(spark):
    docs = documents(spark, odd_rows()).where(F.lit(False))
    assert license_scan.scan_documents(docs).count() == 0
    assert token_counts.count_tokens(docs, vocabulary("word_bpe_49k.json")).count() == 0
    assert bpe_words.encode_decode(docs, vocabulary("byte_bpe_50k.json")).count() == 0
