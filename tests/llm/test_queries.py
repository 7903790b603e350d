"""Registered queries against their SQL; scoring, pages and licences on fixtures and odd rows."""

import importlib.util
import math
import time
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tidemark.llm import html_text, licenses, lm
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES, op1_pseudo_likelihood, op3_html_main_text

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, license string, hit string"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = QUERIES[name](spark, SF)
    want = db.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(want.columns)
    got = Counter(tuple(row) for row in frame.select(*want.columns).collect())
    assert got and got == Counter(want.fetchall())


def test_every_operator_has_one_query():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))


def test_pages_query(spark):
    for row in op3_html_main_text(spark, SF).collect():
        assert row["text"] and row["n_chars"] == len(row["text"])


PAGES = {
    "<p>Just one short line.</p>": "Just one short line.",
    "": "",
    "plain &amp; simple &#233; &hearts;": "plain & simple é ♥",
    "<nav><a href=/>Home</a></nav>": "",
    "<html><body><header>Site <a href=x>name</a></header><main><h1>Title</h1><p>Short.<p>Also\n\n short&nbsp;one <b>bold<br>break</p>"
    "<aside>Read more of this and that and the other</aside><form>Your mail <input name=q><button>Send</button></form></main>"
    "<div id='comments'><p>What a long and thoughtful comment by a reader of the page, who liked it.</p></div><footer>&copy; 2024</footer>":
    "Title\n\nShort.\n\nAlso short one bold break",
    "<article><p>One</p><div class='cookie-notice'>We use cookies</div><script>var a='</p><p>no</p>';</script><p>Two</p></article><div class=sidebar>x</div>":
    "One\n\nTwo",
    "<article><p>Unclosed <i>tags <p>and more": "Unclosed tags\n\nand more",
    "<div class=ad>Buy now<article><p>In the end it is here.</p></article>": "In the end it is here.",
    "<article><style>p{}</style><p hidden>no</p><p>a < b and c > d</p><!-- <p>x</p> --></article>": "a < b and c > d",
}


ENGLISH = "It was in the middle of the night that all of them had to be there, and what they said was not for us to know, but it is on this page. " * 2
RUSSIAN = "В начале было слово, и слово было очень длинным, потому что никто не хотел его прерывать ни на минуту. " * 4
JAPANESE = "これは日本語の長い文章です。記事の本文として扱われるべきものです。" * 4
CODE = "def f(x): return [y*2 for y in x if y > 3]; print(f(range(100000000)), sep=';', end='')"


def test_text_that_must_stay():
    text = lambda page: html_text.main_text(page).split("\n\n")
    assert text("<article><p title=it's>One of the many.</p><p>We don't know what it's for.</p></article>") == ["One of the many.", "We don't know what it's for."]
    assert text('<article><p title="a > b">One</p><img alt="5 > 4" src=x><p data-x="y>Two</p></article>') == ["One", "Two"]
    assert text(f"<div><a href=x>Меню</a></div><p>{RUSSIAN}</p><p>{RUSSIAN}</p>") == [RUSSIAN.strip()] * 2
    assert text(f"<div><a href=x>メニュー</a></div><p>{JAPANESE}</p><p>short</p><p>{JAPANESE}</p>") == [JAPANESE, "short", JAPANESE]
    assert text(f"<p>{ENGLISH}</p><pre>{CODE}</pre><p>{ENGLISH}</p>") == [ENGLISH.strip(), CODE, ENGLISH.strip()]
    assert text(f"<article><p>{ENGLISH}</p><pre>{CODE}</pre></article>") == [ENGLISH.strip(), CODE]
    named = "".join(f"<p {name}>It fell by a third.</p>" for name in ("class='share-price'", "class='related-work'", "id='notice-period'", "class='comment-free'"))
    assert text(f"<article>{named}</article>") == ["It fell by a third."] * 4
    assert text("<article><p>So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>") == ["So x=2 holds."]


def test_furniture_inside_an_article_goes():
    for name in ("class='related-posts'", "id='comment-12'", "class='x share-buttons'", "class=newsletterSignup", "class='reader-comments list'", "class=ad"):
        assert html_text.main_text(f"<article><p>One.</p><div {name}>You may also like the other</div><p>Two.</p></article>") == "One.\n\nTwo."


def test_density_decides_inside_an_article():
    """Of two blocks full of links that one stays which reads as prose."""
    prose = "<p>" + " ".join(f"<a href={i}>it is what was said of them</a> and so" for i in range(9)) + "</p>"
    links = "<p>" + " ".join(f"<a href={i}>Red Car Shop {i}</a>" for i in range(9)) + "</p>"
    text = html_text.main_text(f"<article><p>{ENGLISH}</p>{prose}{links}<p>{ENGLISH}</p></article>")
    assert "said of them" in text and "Red Car" not in text


@pytest.mark.parametrize("make", [
    lambda n: "<p title=\"x " * n + "'", lambda n: "<div>" * n + "x", lambda n: "<div>" * n + "</p>x" * n, lambda n: "<p a='x>" * n + '"y>',
    lambda n: "<!" * n, lambda n: "<a href='" * n, lambda n: "<p>a b c" * n, lambda n: "<article><body>x" * n,
])
def test_parsing_is_linear(make):
    html_text.main_text(make(100))
    seconds = []
    for n in (4000, 16000):
        start = time.perf_counter()
        html_text.main_text(make(n))
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < 8 * seconds[0] + 0.3


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert html_text.main_text(page) == PAGES[page]


def test_blocks_without_article():
    prose = "It was in the middle of the night that all of them had to be there, and what they said was not for us to know, but it is on this page. " * 2
    page = f"<div><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><h2>Head</h2><p>{prose}</p><p>Yes.</p><p>{prose}</p><div><a href=c>All rights of the shop and more</a></div><p>Tel 123</p>"
    text = html_text.main_text(page).split("\n\n")
    assert text == ["Head", prose.strip(), "Yes.", prose.strip()]


def test_page_odd_rows(spark):
    long = "<article>" + "<p>word and word</p>" * 5000
    rows = [(1, None, "u", "t", 1), (2, "", None, "t", 1), (2, "", None, "t", 1), (None, "<p>x", "u", None, None), (3, long, "u", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, text string, n_chars int")
    got = html_text.extract_main_text(pages)
    assert sorted(got.columns) == ["n_chars", "page_id", "text", "url"]
    texts = {(r["page_id"], r["text"][:20]) for r in got.collect()}
    assert texts == {(1, ""), (2, ""), (None, "x"), (3, "word and word\n\nword ")}
    assert html_text.extract_main_text(pages.limit(0)).collect() == []


def licensed(spark, texts):
    frame = spark.createDataFrame([(i, t, "l", "h") for i, t in enumerate(texts)], DOCS)
    return {r["doc_id"]: (r["license"], r["n_notices"], r["notices"]) for r in licenses.license_scan(frame).collect()}


def test_known_texts_hold_an_anchor():
    import re

    known = [t for group in (licenses.NOTICES, licenses.TEXTS) for texts in group.values() for t in texts]
    assert all(re.search(licenses.ANCHOR, text.lower()) for text in known)


def test_license_forms(spark):
    mit, bsd = licenses.TEXTS["MIT"][1], licenses.TEXTS["BSD-3-Clause"][0]
    got = licensed(spark, [
        mit, mit.upper(), "Copyright (c) 2020 Some One\n" + mit.replace("License", "Licence"), mit.replace("\n\n", "\n").replace('"', "“"),
        mit + " And more.", "  * " + bsd.replace("\n\n", "\n\n  * ").replace("copyright holder", "copyright owner").replace("1.", "1)"),
        "Some text.\nreleased under the MIT LICENCE\nThe end", "Released under the MIT License.\nLicensed under the Apache License - version 2.0\nReleased under the MIT License.",
        None, "", "license", "x\n" * 9000 + "Released under the MIT License.",
    ])
    assert got == {
        0: ("MIT", 0, ""), 1: ("MIT", 0, ""), 2: ("MIT", 0, ""), 3: ("MIT", 0, ""), 4: (None, 0, ""), 5: ("BSD-3-Clause", 0, ""),
        6: (None, 1, "MIT"), 7: (None, 3, "Apache-2.0,MIT"), 8: (None, 0, ""), 9: (None, 0, ""), 10: (None, 0, ""), 11: (None, 1, "MIT"),
    }


def test_creative_commons_notices(spark):
    """Notices written out here, and the one that the given tables hold."""
    want = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under CC BY-ND 4.0": "CC-BY-ND-4.0",
        "This work is licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
        "Licensed under CC-BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND-4.0",
        "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International Public License.": "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported License.": "CC-BY-NC-ND-3.0",
        "licensed under the creative commons attribution 4.0 international licence": "CC-BY-4.0",
        "Released under CC0 1.0.": "CC0-1.0",
        "This work is licensed under the Creative Commons CC0 1.0 Universal Public Domain Dedication.": "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.": "CC0-1.0",
        "She gave a licence to CC BY-NC 4.0.": "",
    }
    got = licensed(spark, [f"Some prose.\n{line}\nMore prose." for line in want])
    assert [got[i][2] for i in range(len(want))] == list(want.values())
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = docs.filter("array_contains(split(text, '\\n'), 'Licensed under CC BY-NC 4.0.')")
    assert held.count() == licenses.license_scan(docs).filter("array_contains(split(notices, ','), 'CC-BY-NC-4.0')").count() > 0


def test_known_texts_at_any_width(spark):
    """Wrapped anywhere, also with copyright lines of several kinds before it, a known text stays known."""
    import re
    import textwrap

    isc = """The ISC License

Copyright (c) Isaac Z. Schlueter and Contributors

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR
IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
    wanted, texts = ["ISC"], [isc]
    heads = ["", "Copyright (c) 2020 Some One\n", "Copyright 2020 Some One\n", "Copyright by Some One\n", "Copyright Some One\nAll rights reserved.\n", "© Nobody\n",
             "Copyright: Ökonomie AG\n", "(c) 2020 Some One\n", "Copyright Noticeable Holdersons\n"]
    for name, known in licenses.TEXTS.items():
        for number, width in enumerate((9, 20, 31, 44, 57, 66, 72, 79, 100)):
            keep = lambda part: re.search(r"(?mi)^ *copyright (\(c\)|\[)", part)
            parts = [part if keep(part) else textwrap.fill(part, width, break_long_words=False, break_on_hyphens=False) for part in known[-1].split("\n\n")]
            wanted.append(name)
            texts.append(heads[number] + "\n\n".join(parts))
    got = licensed(spark, texts)
    assert [(i, got[i][0]) for i in range(len(texts))] == list(enumerate(wanted))


def test_license_odd_rows(spark):
    frame = spark.createDataFrame([(None, "Released under the MIT License.", "", ""), (1, "x", "", ""), (1, "x", "", "")], DOCS)
    got = sorted(tuple(r) for r in licenses.license_scan(frame).collect() if r["doc_id"])
    assert got == [(1, None, 0, "")] * 2
    assert licenses.license_scan(frame).filter("doc_id IS NULL").collect()[0]["notices"] == "MIT"
    assert licenses.license_scan(frame.limit(0)).collect() == []


def test_license_plan_is_native(spark):
    plan = QUERIES["op10_license_digests"](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def model_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashed = lm.hashed_words(docs)
    vocabulary = lm.Vocabulary(lm.entry_counts(hashed))
    return docs, vocabulary, lm.train(lm.deal(hashed, 1), vocabulary)


def entry_bytes(texts):
    return [found.astype("<i4").tobytes() for found in lm.entries(texts)]


def test_vocabulary_shares_add_up():
    counts = np.random.default_rng(0).integers(0, 9, 1 << lm.BITS)
    vocabulary = lm.Vocabulary(counts)
    cell = vocabulary.classes.astype(int) * lm.GROUPS + vocabulary.groups
    used = np.unique(cell)
    assert np.allclose(np.bincount(cell, np.exp(vocabulary.share))[used], 1)
    assert len(used) == lm.OWN + lm.SHARED * lm.GROUPS and vocabulary.codes.max() == vocabulary.codes[-1] == lm.PAD


def test_pseudo_likelihood_against_plain_sums(spark):
    texts = ["the cat sat on the mat", "The dog sat on the log", "a", "", "cat the mat sat"] * 20
    docs, vocabulary, flat = model_of(spark, texts)
    w = {k: v.astype(float) for k, v in lm.Network.of(flat).weights.items()}
    soft = lambda logits, i: logits[i] - math.log(sum(math.exp(x) for x in logits))
    for row in lm.pseudo_likelihood(docs).collect():
        found = [int(entry) for entry in lm.entries([texts[row["doc_id"]]])[0]]
        total = 0.0
        for i, entry in enumerate(found):
            sides = [vocabulary.codes[found[j]] if 0 <= j < len(found) else lm.PAD for j in range(i - lm.SIDE, i + lm.SIDE + 1) if j != i]
            hidden = [math.tanh(w["hidden"][k] + sum(w["inputs"][s][c][k] for s, c in enumerate(sides))) for k in range(lm.WIDTH)]
            own, group = int(vocabulary.classes[entry]), int(vocabulary.groups[entry])
            total += soft([w["bias"][c] + sum(hidden[k] * w["outputs"][k][c] for k in range(lm.WIDTH)) for c in range(lm.CLASSES)], own)
            if own >= lm.OWN:
                shared = own - lm.OWN
                total += soft([w["group_bias"][shared][g] + sum(hidden[k] * w["group_outputs"][shared][k][g] for k in range(lm.WIDTH)) for g in range(lm.GROUPS)], group)
            total += vocabulary.share[entry]
        assert row["n_words"] == len(found)
        assert row["pll"] == pytest.approx(total, rel=1e-3, abs=1e-5)
        assert row["pll_per_word"] is None if not found else row["pll_per_word"] == pytest.approx(total / len(found), rel=1e-3)


def test_training_lowers_the_loss(spark):
    """After training, order matters: documents score higher than their shuffled selves, words of shared classes too."""
    draw = np.random.default_rng(1)
    cycle = [f"w{i}" for i in range(60)]  # more words than classes of their own
    texts = [" ".join(cycle[(s + i) % 60] for i in range(60)) for s in draw.integers(0, 60, 3000)]
    _, vocabulary, flat = model_of(spark, texts)
    network, start = lm.Network.of(flat), lm.Network.initial(vocabulary)
    found = entry_bytes(texts[:20])
    mixed = [draw.permutation(np.frombuffer(words, "<i4")).tobytes() for words in found]
    score = lambda net, docs: sum(lm.scores(net, vocabulary, docs))
    assert score(network, found) > score(start, found) + 1000
    assert score(network, found) > score(network, mixed) + 1000
    own = np.frombuffer(b"".join(found), "<i4")
    rare = vocabulary.classes[own] >= lm.OWN
    line, words, _ = lm._laid_out(found)
    sides = lm.neighbours(vocabulary.codes[line], words[rare])
    logs = [net.predict(sides, vocabulary.classes[own[rare]], vocabulary.groups[own[rare]]).mean() for net in (start, network)]
    assert logs[1] > logs[0] + 0.5


def test_training_predicts_every_position_and_ignores_partitions(spark):
    texts = [" ".join(f"w{(i * j) % 31}" for j in range(i % 50)) for i in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashed = lm.hashed_words(docs)
    vocabulary = lm.Vocabulary(lm.entry_counts(hashed))
    flat = lm.Network.initial(vocabulary).flat()
    held, seen = entry_bytes(texts), []
    for round_ in range(lm.ROUNDS):
        shard = lm._Shard(flat, np.full(len(flat), 1e-8, np.float32), vocabulary, round_)
        shard.add(held)
        shard.flush()
        seen.append(shard.seen)
    assert sum(seen) == sum(len(own) // 4 for own in held) and min(seen) > 0
    for shards in (1, 3):
        one, many = (lm.train(lm.deal(lm.hashed_words(docs.repartition(n)), shards), vocabulary) for n in (1, 7))
        assert np.allclose(one, many, atol=1e-3)


def test_gradient_against_differences():
    """A step lowers the loss, and its direction is that of finite differences."""
    draw = np.random.default_rng(3)
    vocabulary = lm.Vocabulary(draw.integers(0, 50, 1 << lm.BITS))
    sides = draw.integers(0, lm.PAD + 1, (2 * lm.SIDE, 50)).astype(np.int16)
    classes, groups = draw.integers(0, lm.CLASSES, 50).astype(np.uint8), draw.integers(0, lm.GROUPS, 50).astype(np.uint8)
    network = lm.Network.initial(vocabulary)
    before = network.flat().astype(np.float64)
    loss = lambda flat: -lm.Network.of(flat).predict(sides, classes, groups).mean(dtype=np.float64)
    large = lm.Network.of(np.full(len(before), 1e6, np.float32))  # so that a step follows the gradient
    network.step(sides, classes, groups, large)
    slope = (before - network.flat()) * np.sqrt(1e6) / lm.RATE
    moved = np.argsort(-np.abs(slope))[:20]
    for at in moved:
        ahead, behind = before.copy(), before.copy()
        ahead[at] += 0.05
        behind[at] -= 0.05
        assert slope[at] == pytest.approx((loss(ahead) - loss(behind)) / 0.1, rel=0.15, abs=2e-3)


def test_scoring_query_and_odd_rows(spark):
    rows = op1_pseudo_likelihood(spark, SF).collect()
    assert len(rows) == 200 and all(r["pll"] < 0 and r["n_words"] > 0 for r in rows)
    frame = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (3, "x " * 20000, "", ""), (3, "x", "", ""), (None, "y", "", "")], DOCS)
    got = {(r["doc_id"], r["n_words"]): r["pll"] for r in lm.pseudo_likelihood(frame).collect()}
    assert got[1, 0] == got[2, 0] == 0 and got[3, 20000] < 0 and len(got) == 5
    assert lm.pseudo_likelihood(frame.limit(0)).collect() == []


def load_pipeline():
    path = Path(__file__).resolve().parents[2] / "corpus_pipeline.py"
    spec = importlib.util.spec_from_file_location("corpus_pipeline", path)
    pipeline = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(pipeline)
    return pipeline


def test_pipeline_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows, clashing and missing columns in every stage."""
    pipeline = load_pipeline()
    good = " ".join(f"word{i} lies by {i * 7}" for i in range(300))
    rows = [
        (1, good, "en", "a", None, "x", 0.5), (2, good, "en", "a", 7, "x", 0.5), (2, good, "en", "a", 7, "x", 0.5), (3, None, None, None, None, None, None),
        (4, "", "en", "b", 0, "", 0.0), (None, good + " more", "en", "b", 3, "y", None), (5, "long " + " ".join(f"w{i}" for i in range(60_000)), "en", "b", 1, "z", 1.0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, __text string, __score double")
    spark.createDataFrame([(1, 0), (9, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = {}
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path)).collect()
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        kept[name] = Counter(row["doc_id"] for row in after)
    assert kept["quality_rules"] == Counter({1: 1, 2: 2, 5: 1, None: 1})
    assert kept["secret_scan"] == Counter(row[0] for row in rows)
    assert kept["minhash_dedup"][1] == 1 and not kept["minhash_dedup"][2] and kept["minhash_dedup"][3] == kept["minhash_dedup"][4] == 1
    short = docs.drop("n_chars")
    assert sorted(pipeline.secret_scan(spark, short, str(tmp_path)).columns) == sorted(short.columns)
    packed = pipeline.best_fit_packing(spark, docs, str(tmp_path)).collect()
    assert Counter(row["doc_id"] for row in packed if row["piece"] == 0) == Counter(row[0] for row in rows)


def test_pipeline(spark):
    pipeline = load_pipeline()
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = pipeline.materialize(stage(spark, docs, sf), name)
        assert docs.columns == columns
        ids = [r["doc_id"] for r in docs.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= kept
        assert len(ids) < len(kept) or name in ("secret_scan", "toxicity")
        kept = set(ids)
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert not any(labels[i]["quality"] == 0 for i in kept if i in labels)
    rows = pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in rows} == kept
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, sf).collect() == []
