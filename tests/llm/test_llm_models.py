"""Classifiers on held-out rows, WARC round trip, the pipeline's stages."""

import re
import zlib
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from edge import documents, odd_rows
from fixtrail.llm import ordinal_toxicity, quality_neighbours, queries, warc_derivatives
from fixtrail.session import scratch_path

SF_DIR = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def test_quality_of_held_out_rows(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op10_quality_neighbours"](spark, SF_DIR).collect()}
    assert len(got) == table(spark, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[r.doc_id].predicted, r.quality) for r in table(spark, "labels").collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.92 * len(held)
    assert all(a for a, b in held if b)


def test_toxicity_of_held_out_rows(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    held = queries.fold(F.col("doc_id")) == 0
    model = ordinal_toxicity.fit(docs, labels.where(~held))
    assert model.thresholds[0] < model.thresholds[1]
    graded = ordinal_toxicity.grade(docs, model)
    assert graded.where("p_severe > p_toxic OR severity < 0 OR severity > 2").count() == 0
    rows = graded.join(labels.where(held), "doc_id").select("rejected", "toxic").collect()
    assert sum(r.rejected for r in rows if not r.toxic) <= 0.02 * len(rows)
    assert sum(r.rejected for r in rows if r.toxic) >= 0.5 * sum(r.toxic for r in rows)
    # The same decision in the row.
    assert {r.doc_id for r in ordinal_toxicity.drop_toxic(docs, model).collect()} == \
        {r.doc_id for r in graded.where("NOT rejected").collect()}


def test_severity_is_the_plain_cumulative_link(spark):
    """All rows against the model's formula, a word at a time."""
    import math

    import xxhash

    docs = table(spark, "documents").select("doc_id", "text")
    model = ordinal_toxicity.fit(docs, table(spark, "labels"))
    buckets = len(model.weights)
    got = {r.doc_id: r for r in ordinal_toxicity.grade(docs, model).collect()}
    for row in docs.collect():
        words = re.findall(r"\w+", (row.text or "").lower())
        marks = {w for w in words} | {f"{w[:n]}-" for w in words for n in (4, 5, 6, 7) if n < len(w)}
        places = {xxhash.xxh3_64_intdigest(m) % buckets for m in marks}
        pull = math.fsum(model.weights[p] for p in places)
        above = [1 / (1 + math.exp(threshold - pull)) for threshold in model.thresholds]
        one = got[row.doc_id]
        assert (one.p_toxic, one.p_severe, one.severity) == pytest.approx((above[0], above[1], sum(above)), abs=1e-9)
        if abs(sum(above) - ordinal_toxicity.REJECT_FROM) > 1e-9:
            assert one.rejected == (bool(places) and sum(above) >= ordinal_toxicity.REJECT_FROM)


def test_votes_are_those_of_a_plain_neighbour_search(spark):
    """All rows against a search that sorts every voter by its cosine, one document at a time."""
    import numpy as np

    docs = table(spark, "documents").select("doc_id", "text")
    model = quality_neighbours.fit(docs, table(spark, "labels").where(queries.fold(F.col("doc_id")) != 0))
    got = {r.doc_id: r.score for r in quality_neighbours.score_documents(docs, model).collect()}
    vectorizer = quality_neighbours.Vectorizer()
    for row in docs.collect():
        place = model.latent(vectorizer([row.text or ""]))[0]
        near = sorted((float(np.dot(place, v)), i) for i, v in enumerate(model.vectors))[::-1]
        # Voters as near as the last neighbour vote too, up to rounding.
        last = near[model.neighbours - 1][0]
        sums = []
        for slack in (-1e-5, 1e-5):
            chosen = [(max(c, 0.0) ** 4 * model.weights[i], model.votes[i]) for c, i in near if c >= last + slack]
            total = sum(w for w, _ in chosen)
            sums.append(sum(w * v for w, v in chosen) / total if total else model.prior)
        want = sums if place.any() else [model.prior] * 2
        assert min(want) - 1e-3 <= got[row.doc_id] <= max(want) + 1e-3


@pytest.mark.parametrize("labels", [[], [(0, 0, 1), (None, 1, 0), (999, 1, 1)]])
def test_models_of_odd_tables(spark, labels):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality_neighbours.fit(docs, labels)
    scored = quality_neighbours.score_documents(docs, model)
    assert scored.where("score BETWEEN 0 AND 1").count() == docs.count()
    toxicity = ordinal_toxicity.fit(docs, labels)
    assert ordinal_toxicity.grade(docs, toxicity).where("NOT rejected").count() == docs.count()
    kept = ordinal_toxicity.drop_toxic(docs, toxicity)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    none = docs.where(F.lit(False))
    assert ordinal_toxicity.grade(none, toxicity).count() == 0
    assert quality_neighbours.score_documents(none, model).count() == 0


def test_warc_files_give_their_records_back(spark):
    rows = [(1, "http://a/", "<html lang=\"de\"><head><title>T &amp; u</title></head><p>x &lt;b&gt;<p>y</html>"),
            (2, None, None), (3, "http://c/", "<script>no</script>é &amp;lt; <!-- <p> -->z"), (3, "http://c/", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    records = warc_derivatives.derivatives(warc_derivatives.responses(pages))
    blocks = {(r.page_id, r.record_type, r.content_length): r for r in records.collect()}
    assert len(blocks) == 8
    text = {r.page_id: r.block for r in blocks.values() if r.record_type == "conversion" and r.content_length}
    assert text == {1: "x <b>\ny", 3: "é &lt; z"}
    path = scratch_path(spark, "warc")
    warc_derivatives.write_warc(records, path)
    got = warc_derivatives.read_warc(spark, path).collect()
    assert sorted((r.headers["WARC-Type"], r.headers["WARC-Refers-To"], bytes(r.block).decode()) for r in got) == \
        sorted((r.record_type, f"<{r.refers_to}>", r.block) for r in records.collect())
    assert all(r.headers["WARC-Block-Digest"] == "sha256:" + __import__("hashlib").sha256(bytes(r.block)).hexdigest()
               for r in got)
    assert warc_derivatives.derivatives(warc_derivatives.responses(pages.limit(0))).count() == 0


def test_stages_keep_what_they_should(spark):
    docs = table(spark, "documents").where("doc_id < 300")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF_DIR)
        path = scratch_path(spark, name)
        kept.write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        assert kept.join(before, "doc_id", "left_anti").count() == 0
    encoded = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR)
    assert encoded.count() == kept.count()


def test_stages_take_odd_tables(spark):
    docs = documents(spark, odd_rows())
    for rows in (docs, docs.where(F.lit(False))):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF_DIR).count() <= 3 * rows.count()


def test_queries_are_registered():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


class _PlainText(HTMLParser):
    """The visible text as a parser sees it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "head")
        self.parts += ["\n"] * (tag in ("p", "div", "br", "li", "h1"))

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "head")
        self.parts += ["\n"] * (tag in ("p", "div", "li", "h1"))

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data.replace("\xa0", " "))


def test_plain_text_is_what_a_parser_sees(spark):
    page = ("<html lang=\"fr\"><head><title>Caf&eacute;\n &mdash; menu</title><style>p {}</style></head><body><!-- <p>no</p> -->"
            "<h1>Caf&eacute; &mdash; &#8217;x&#x27;</h1><p>a &hellip;&nbsp; b &amp;lt; 3 &lt; 4</p><script>if (a<b) {}</script>"
            "<div>  long   \t line </div><li>end&copy;</li></body></html>")
    pages = [page, "no marks & none", "", None, "<p>" + "word &amp; " * 200_000 + "</p>"]
    table = spark.createDataFrame(
        [(n, "http://x/\r\nWARC-Type: forged", p, "b", "c", 3) for n, p in enumerate(pages)],
        "page_id bigint, url string, html string, block string, record_id string, links int")
    records = warc_derivatives.derivatives(warc_derivatives.responses(table))
    got = {r.page_id: r.block for r in records.where("record_type = 'conversion'").collect()}
    for n, whole in enumerate(pages):
        parser = _PlainText()
        parser.feed(whole or "")
        parser.close()
        want = "\n".join(x for x in (" ".join(line.split()) for line in "".join(parser.parts).split("\n")) if x)
        assert got[n] == want
    assert "Café — ’x'" in got[0] and "&lt; 3 < 4" in got[0]
    fields = records.where("record_type = 'metadata' AND page_id = 0").first().block
    assert fields.startswith("title: Café — menu\r\n")
    header = warc_derivatives.serialised(records.where("page_id = 0")).first().value
    assert "\r\nWARC-Type: forged" not in header and "%0D%0AWARC-Type" in header
