"""HTML extraction and the corpus pipeline."""

import random
import re
import time
import zlib
from collections import Counter
from html import unescape

import brute
import corpus_pipeline
import pytest
from conftest import SF_MID, SF_SMALL
from columns_of import word_column
from odd_rows import empty, odd, own_columns_are_kept  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

from cardlens.llm import html_text, quality_classifier, quality_rules
from cardlens.llm.html_text import main_text
from cardlens.session import write_shared

PROSE = [f"Paragraph {w} has a good number of plain words in it, as main text does, and it ends with a full stop." for w in
         ("one", "two", "three", "four", "five")]
CHROME = ('<header><a href="/">Site</a> name</header><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>',
          '<aside class="x">Read also <a href=q>this</a></aside><form><input name=q><button>Go</button></form>'
          '<div id="comments"><p>I do not agree with a single word of this, and I will say so at some length here.</p></div>'
          '<div class="cookie-notice">We use cookies</div><footer>&copy; 2024 All rights reserved</footer>')


def page(body, chrome=CHROME):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style><script>if(a<b)'</p>'</script></head><body>{chrome[0]}{body}{chrome[1]}</body></html>"


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("body", [
    "<article><h1>Head</h1>{}</article>",
    "<div class=story><h1>Head</h1>{}</div>",
    "<main><div><h1>Head</h1></div><div><!-- no --><div>{}</div></div></main>",
    "<div><article><header><h1>Head</h1></header>{}<footer>by someone</footer></article><div class=related><a href=z>more</a></div></div>",
])
def test_chrome_goes_and_the_article_stays_whole(body):
    assert main_text(page(body.format(paragraphs(PROSE)))) == "\n\n".join(["Head", *PROSE])


@pytest.mark.parametrize("wrapper", ["class='content has-sidebar'", "class=no-sidebar", "class='sticky-header x'", "class=with-header",
                                     "class=side-by-side", "id=search-results", "class=comments-open", "class=cookie-consent-accepted",
                                     "class=sidebar", "class=promo", "role=form"])
@pytest.mark.parametrize("inner", ["<article>{}</article>", "<div class=story>{}</div>"])
def test_a_wrapper_of_the_main_text_stays(wrapper, inner):
    text = "\n\n".join(PROSE)
    inner = inner.format(paragraphs(PROSE))
    assert main_text(page(f"<div {wrapper}>{inner}</div>")) == text
    assert main_text(page(f"<body {wrapper}><div>{inner}</div>")) == text


def test_a_page_in_one_form():
    inner = paragraphs(PROSE)
    for body in (f"<form id=aspnetForm method=post><input type=hidden name=s>{{}}<div class=sidebar><p>{PROSE[0][:60]}</div></form>", "<form>{}"):
        assert main_text(page(body.format(f"<article>{inner}</article>"))) == "\n\n".join(PROSE)
        assert main_text(page(body.format(f"<div>{inner}</div>"))) == "\n\n".join(PROSE)


def test_parts_named_as_no_main_text():
    side = "".join(f"<div class={c}><p>{PROSE[0][:70]}</div>" for c in ("comments-area", "cookie-notice", "ad"))
    assert main_text(page(f"<div class=story>{paragraphs(PROSE)}</div>{side}")) == "\n\n".join(PROSE)
    many = f"<div id=comments>{''.join(f'<article class=comment>{paragraphs(PROSE)}</article>' for _ in range(4))}</div>"
    assert main_text(page(f"<article>{paragraphs(PROSE[:2])}</article>{many}")) == "\n\n".join(PROSE[:2])
    halves = "".join(f"<div class=widget>{paragraphs(p)}</div>" for p in (PROSE[:2], PROSE[2:]))
    assert PROSE[4] in main_text(f"<body>{halves}<p>x</p></body>")


def test_two_dense_parts_without_an_article():
    body = f"<div id=w><div>{paragraphs(PROSE[:3])}</div><div><a href=1>a b</a> <a href=2>c d</a> <a href=3>e f</a></div><div>{paragraphs(PROSE[3:])}</div></div>"
    assert main_text(page(body)) == "\n\n".join(PROSE)


def test_unclosed_tags_references_and_white_space():
    body = "<article><p><b>Bold &amp; open<br>next<p>a\n \t b&nbsp;c &#x41;&eacute; &lt;p&gt;<ul><li>one<li>two <i>x</i></ul><table><tr><td>1<td>2</table>tail</article>"
    assert main_text(page(body)) == "\n\n".join(["Bold & open next", "a b c Aé <p>", "one", "two x", "1", "2", "tail"])


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain &amp; simple", "plain & simple"), ("<nav>only a menu</nav>", ""),
    ("<p>unclosed <b", "unclosed <b"), ("<!-- never closed <p>x</p>", ""), ("<script>never closed", ""), ("</p></div>x", "x"),
    ("<p title=it's>Don't lose this</p>", "Don't lose this"), ("<p a=b\"c d='>' e=\"<\" f>Keep \"this\"</p>", 'Keep "this"'),
    ("<a href=/x/>link</a> after", "link after"), ("<p =x =\"y>z</p>", "z"),
    ("<div hidden>no</div><p>yes</p>", "yes"), ("<p title='a > b' class=\"c>d\">x</p>", "x"),
])
def test_odd_pages(source, text):
    assert main_text(source) == text


def test_long_and_deep_pages():
    assert len(main_text("<article>" + paragraphs(["word " * 50] * 5000) + "</article>").split("\n\n")) == 5000
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<a " * 20_000 + "x").endswith("x") and main_text("<" * 50_000) == "<" * 50_000


def test_time_grows_with_depth_not_with_its_square():
    def seconds(n):
        start = time.perf_counter()
        assert main_text("<div>" * n + "deep" + "</div>" * n) == "deep"
        main_text("<i>" * n + "x" + "<p>y" * n + "</b></div>" * n)
        return time.perf_counter() - start

    seconds(500)
    assert seconds(20_000) < 3 * seconds(10_000)


def test_given_pages_equal_their_articles(spark):
    rows = html_text.extract_main_text(spark.read.parquet(f"{SF_MID}/pages.parquet").withColumn("html2", F.col("html"))).collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html2, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b)


def test_pages_table_edges(spark):
    pages = spark.createDataFrame([(1, None, "own"), (1, None, "own"), (None, "<p>x", "own")], "page_id long, html string, text string")
    rows = html_text.extract_main_text(pages).collect()
    assert sorted(r["_text"] for r in rows) == ["", "", "x"] and all(r.text == "own" for r in rows)
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


def _built(r, depth):
    words = lambda n: " ".join(r.choice(["a", "plain", "text", "runs", "here,", "longer"]) for _ in range(n)) + r.choice([" ", ". ", ""])
    kids = []
    for _ in range(r.randrange(1, 5)):
        kind = r.random()
        if depth and kind < 0.5:
            kids.append(_built(r, depth - 1))
        elif kind < 0.65:
            kids.append(("a", [("#", words(r.randrange(1, 4)))]))
        elif not kids or kids[-1][0] != "#":
            kids.append(("#", words(r.choice((0, 1, 3, 20, 60)))))
    return (r.choice(["div", "div", "section", "span", "b"]), [k for k in kids if k[0] != "#" or k[1]])


def _source(node):
    return node[1] if node[0] == "#" else f"<{node[0]}>{''.join(map(_source, node[1]))}</{node[0]}>"


def test_densities_equal_brute_force():
    r = random.Random(12)
    filled = 0
    for _ in range(400):
        body = ("body", [_built(r, 3) for _ in range(r.randrange(1, 5))])
        want = brute.Densities(body).text()
        assert main_text(f"<html>{_source(body)}</html>") == want, _source(body)
        filled += bool(want)
    assert filled > 350


# ---- pipeline --------------------------------------------------------------

def test_stages_equal_brute_force(spark):
    """Each stage is judged on what it got: rows are whole, what must go goes, what must stay stays."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "source_mixing"]
    got = [docs]
    for name, stage in corpus_pipeline.STAGES:
        got.append(write_shared(stage(spark, got[-1], SF_MID), name))
    for after in got[1:-1]:
        assert after.columns == docs.columns
    rows = [{r.doc_id: r for r in d.collect()} for d in got[:-1]]
    for before, after in zip(rows, rows[1:]):
        assert all(before[d] == r for d, r in after.items()) and after
    start, ruled, classed, single, clean = rows
    measured = quality_rules.measure(docs.select("doc_id", "lang", "text")).collect()
    assert set(ruled) == {r.doc_id for r, k in zip(measured, brute.rules_kept([(r.lang, r.measures) for r in measured])) if k}
    assert all(brute.quality_counts(r.text)[0] >= 20 for r in ruled.values())
    model = quality_classifier.fit(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"))
    scores = {d: brute.classifier_score(model, r.text, word_column) for d, r in ruled.items()}
    assert {d for d, s in scores.items() if s >= 0.5 + 1e-6} <= set(classed) <= {d for d, s in scores.items() if s >= 0.5 - 1e-6}
    ids = sorted(classed)
    root = brute.groups([brute.fingerprint(classed[d].text) for d in ids])
    assert set(single) == {ids[g] for g in root}
    leaked = {d for d, _ in brute.leaks([(d, r.text) for d, r in single.items()], items)}
    assert leaked and set(clean) == set(single) - leaked
    mixed = got[-1].collect()
    assert set(mixed[0].asDict()) == {*docs.columns, "copy"}
    times = Counter(r.doc_id for r in mixed)
    assert sorted((r.doc_id, r.copy) for r in mixed) == sorted((d, c) for d, n in times.items() for c in range(1, n + 1)) and max(times.values()) <= 3
    assert all(r.text == clean[r.doc_id].text for r in mixed)
    size = lambda rs: sum(len(brute.space_words(r.text)) for r in rs)
    assert size(mixed) == pytest.approx(size(clean.values()), rel=0.05)


def test_rows_without_or_with_a_repeated_id(spark):
    """Only leaking rows and near-duplicates go; a row that shares its id, or has none, is judged by its own text."""
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").filter("text is not null").orderBy("item_id").first().text
    clean = [" ".join(f"{w}{i}" for i in range(60)) for w in ("ape", "bee", "cat", "dog", "elk", "fox")]
    rows = [(None, clean[0]), (None, clean[0]), (None, f"before {item} after"), (None, clean[1]),
            (4, clean[1]), (5, clean[2]), (5, clean[3]), (5, f"some {item} words"), (7, clean[3]), (5, clean[2]), (3, clean[2]), (8, clean[4]), (8, clean[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stages = dict(corpus_pipeline.STAGES)
    single = sorted(map(tuple, stages["simhash_near_dedup"](spark, docs, SF_SMALL).collect()), key=str)
    want = [(None, clean[0]), (4, clean[1]), (3, clean[2]), (5, clean[3]), (8, clean[4]), (8, clean[5])]
    assert sorted((r for r in single if item not in r[1]), key=str) == sorted(want, key=str)
    left = map(tuple, stages["benchmark_decontamination"](spark, docs, SF_SMALL).collect())
    assert sorted(left, key=str) == sorted((r for r in rows if item not in r[1]), key=str)


def test_run_and_odd_rows(spark, odd, empty):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 50
    plain, nothing = odd, empty
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF_SMALL).count() == 0, name
        out = stage(spark, plain, SF_SMALL)
        assert set(plain.columns) <= set(out.columns) and 0 < out.count() <= 3 * plain.count() or name.startswith("quality"), name


def test_held_out_rows_follow_the_checksum(spark):
    ids = [0, 1, 2, -7, 12345678901, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", quality_classifier.held_out().alias("out")).collect()
    assert all(r.out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 3 == 1) for r in rows)
