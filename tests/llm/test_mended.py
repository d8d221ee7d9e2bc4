"""Cases that earlier versions got wrong: unlabelled ids, comments and notices of pages, bounds of a fit."""

import hashlib
import random
import re

import numpy as np
import zstandard
from pyspark.sql import functions as F

from canvass.llm import decontaminate, fingerprints, language, pages, quality, toxicity

ENGLISH, GERMAN = "the house stands near a small river and people walk along it every morning to the old market".split(), "das haus steht nahe am kleinen fluss und leute gehen jeden morgen daran entlang zum alten markt".split()


def texts(words, n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(8, 40))) for _ in range(n)]


def test_every_language_is_learned_from_rows_without_ids(spark):
    rows = [(None, t, "en") for t in texts(ENGLISH, 6000, 1)] + [(None, t, "de") for t in texts(GERMAN, 300, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    once, again = language.dictionaries(df.repartition(7)), language.dictionaries(df.repartition(3))
    assert set(once) == {"de", "en"} and once == again
    got = df.select("lang", language.predicted(F.col("text"), once)["lang"].alias("p")).where("lang = p").count()
    assert got > 0.98 * len(rows)


def test_repeated_ids_and_dirty_languages_are_bounded(spark):
    rows = [(7, t, "en") for t in texts(ENGLISH, 3000, 3)] + [(i, "word number " + str(i), f"x{i}") for i in range(200)]
    found = language.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_documents=50, languages=5)
    assert len(found) == 5 and "en" in found and len(found["en"]) <= 100 * 201


def test_sizes_and_margins_against_plain_compression(spark):
    learned = spark.createDataFrame([(i, t, lang) for lang, words in (("en", ENGLISH), ("de", GERMAN)) for i, t in enumerate(texts(words, 200, 5))], "doc_id long, text string, lang string")
    dicts = language.dictionaries(learned)
    rows = texts(ENGLISH, 30, 6) + texts(GERMAN, 30, 7) + texts(ENGLISH[:3] + GERMAN[:3], 30, 8) + ["haus house", " ".join(texts(GERMAN, 2000, 9)), "12 34", ""]
    settings = zstandard.ZstdCompressionParameters(write_content_size=0, write_checksum=0, write_dict_id=0, **language.SETTINGS)

    def plain(text):
        raw = " ".join(re.findall("[a-z]+", text.lower())).encode()
        if not raw:
            return "und", 0.0, True
        sizes = []
        for lang in sorted(dicts):
            c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dicts[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings)
            sizes.append((sum(len(c.compress(raw[i : i + language.BLOCK])) for i in range(0, len(raw), language.BLOCK)), lang))
        sizes.sort()
        margin = (sizes[1][0] - sizes[0][0]) / sizes[0][0]
        return sizes[0][1], margin, margin < language.NARROW

    df = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    got = df.select("i", language.predicted(F.col("text"), dicts).alias("p")).orderBy("i").select("p.*").collect()
    for text, r in zip(rows, got, strict=True):
        lang, margin, rejected = plain(text)
        assert (r["lang"], r["rejected"]) == (lang, rejected) and abs(r["margin"] - margin) < 1e-12


LONG = "<p>A paragraph of the article that says a good deal about its matter and goes on for a while.</p>"
PLAIN = "A paragraph of the article that says a good deal about its matter and goes on for a while."


def test_comment_articles_are_comments():
    comment = '<article class="comment" id="comment-1"><p>A reader who disagrees at length with all of this, twice and three times over, and more.</p></article>'
    for html in (f"<main>{LONG}{comment}</main>", f"<article>{LONG}</article>{comment}{comment}", f"<article class=post>{LONG}<div>{comment}</div></article>", f'<main>{LONG}</main><article id="comment-7">{LONG}</article>'):
        assert pages.main_text(html) == PLAIN


def test_notices_are_judged_before_density():
    notice = '<div class="cookie-notice"><p>We and our many partners use cookies and like technologies to store and read data on your device, for a better site, all the time.</p></div>'
    assert pages.main_text(f"<body>{notice}<div><h1>Title</h1><p>Short text of it.</p></div></body>") == "Title\nShort text of it."
    assert pages.main_text(f"<body><div>{LONG}{LONG}</div><div>Copyright 2024 by the owners. All rights reserved.</div></body>") == f"{PLAIN}\n{PLAIN}"


def test_comments_that_never_end_are_no_text():
    assert pages.main_text(f"<article>{LONG}<!-- hidden <b>and</b> more") == PLAIN
    assert pages.main_text(f"<article>{LONG}<!-- hidden") == PLAIN
    assert pages.main_text(f"<article>{LONG}<!-- closed --> a < b") == f"{PLAIN}\na < b"


def test_a_fit_has_a_row_an_id(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)] + [(5, f"again {i}") for i in range(3000)] + [(None, "none")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)] + [(5, 1, 0)] * 50, "doc_id long, quality int, toxic int")
    got = toxicity.training_rows(docs, labels, "quality", 4, 2, 100).collect()
    assert len(got) == len({r["doc_id"] for r in got}) <= 100
    assert {r["text"] for r in got if r["doc_id"] == 5} <= {"again 0"}


def test_passages_of_a_fit_are_bounded_and_even():
    x = np.arange(10_000.0).reshape(-1, 1)
    own = quality._even(x)
    assert len(own) == quality.FIT_PASSAGES and own[0] == 0 and own[-1] == 9_999 and np.ptp(np.diff(own[:, 0])) <= 1
    assert quality._even(x[:100]) is not x and len(quality._even(x[:100])) == 100


def test_rows_of_a_hot_id_spread_and_keep_their_successors(spark):
    rows = [(7, f"hot text {i % 900} of many words, number {i % 900}") for i in range(1500)] + [(i, f"text {i}") for i in (1, 2, 9, 12)] + [(None, f"none {i}") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    placed = fingerprints._in_order(docs, 50)
    sizes = [r["count"] for r in placed.where("not tail").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 15 and max(sizes) < 400
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()
    order = sorted(hashed, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["h"] if r["doc_id"] in (7, None) else 0, r["text"]))
    want = sorted((r["doc_id"] or -1, hashlib.sha256(fingerprints.edited(r["text"], order[(i + 1) % len(order)]["text"]).encode()).hexdigest()) for i, r in enumerate(order))
    got = sorted((r["doc_id"] or -1, r["edited_sha256"]) for r in fingerprints.report(docs, bucket_rows=50).collect())
    assert got == want


def test_spans_are_cut_from_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a One two, three b", "x"), (3, "a One two, three b", "x"), (None, "one two three", None), (4, "one two three four", "x"), (5, "w " * 50_000 + "one two three", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(1, "one two three"), (None, "two three four"), (3, None), (4, " ")], "item_id long, text string")
    got = decontaminate.remove_spans(docs, bench)
    assert got.columns == docs.columns
    want = [(1, None, "x"), (2, "", "x"), (3, "a  b", "x"), (3, "a  b", "x"), (None, "", None), (4, "", "x"), (5, "w " * 50_000, "x")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert sorted(map(tuple, decontaminate.remove_spans(docs, bench.limit(0)).collect()), key=repr) == sorted(rows, key=repr)
    assert decontaminate.remove_spans(docs.limit(0), bench).collect() == []
