"""HTML extraction and the whole pipeline."""

import html
import re
from collections import Counter

import corpus_pipeline
from metroflux.llm import op1_language, op4_minhash, op5_quality, op8_pii, op9_html, queries
from metroflux.llm.common import read_table
from tests.conftest import SMOKE
from tests.llm.helpers import odd_documents
from tests.llm.test_dedup_operators import brute_near
from tests.llm.test_text_operators import brute_quality

PAGE = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><div id="cookie-banner">Accept</div>
<nav><a href=x>Menu</a></nav><div class="wrap"><div class="main-col post-{n}"><h2>Title {n}</h2><div class="par">One <b>bold</b>text
&lt;ok&gt; &amp; more {n}.</div><div class=par>Two<br>three</div><ul><li>a<li>b</ul><div class="comments"><p>nice</p></div></div>
<aside>side</aside></div><form>Search</form><footer>foot</footer><script>var a="<p>no</p>"</script></body></html>"""


def test_main_text_of_a_template(spark):
    rows = [(k, f"https://h.example.com/{k}", PAGE.replace("{n}", str(k))) for k in range(6)]
    rows += [(10, None, None), (11, "odd url", ""), (12, "http://x.example.com/", "plain text"), (12, "http://x.example.com/", "plain text"),
             (13, "http://h.example.com/odd", "<p>un<b>closed <i"), (None, "http://y.example.com", "<article><p>A&nbsp;&eacute;</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", op9_html.F.lit(1))
    got = Counter((r.page_id, r.text, r.n_chars) for r in op9_html.main_text(df).collect())
    text = lambda k: f"Title {k} One boldtext <ok> & more {k}. Two three a b"
    want = [(k, text(k)) for k in range(6)] + [(10, ""), (11, ""), (12, "plain text"), (12, "plain text"), (13, "unclosed"), (None, "A é")]
    assert got == Counter((i, t, len(t)) for i, t in want)
    assert op9_html.main_text(df.where("false")).count() == 0


def test_main_text_equals_the_articles(spark):
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.text for r in op9_html.main_text(pages).collect()}
    for r in pages.collect():
        article = re.sub(r"<[^>]*$", "", r.html.split("<article>", 1)[1].split("</article>", 1)[0])
        assert got[r.page_id] == " ".join(html.unescape(re.sub(r"</?[a-zA-Z][^>]*>", " ", article)).split())


def test_host_votes_outweigh_one_page(spark):
    body = "<body><div class='story'><p>{t}</p></div><div class='extra'><p>{x}</p></div></body>"
    rows = [(k, "http://a.example.com/", body.replace("{t}", "main words here " * 30).replace("{x}", "short")) for k in range(5)]
    rows.append((9, "http://a.example.com/", body.replace("{t}", "brief story").replace("{x}", "long other text " * 30)))
    got = {r.page_id: r.text for r in op9_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "brief story"


def test_whole_articles_of_nested_and_minority_templates(spark):
    body, lead = "body words follow here " * 40, "lead words "
    nested = f"<article><h1>Title</h1><div class=lead><p>{lead}</p></div><div class=body><p>{body}</p></div></article>"
    plain = f"<div class=page><h1>Title</h1><div class=lead><p>{lead}</p></div><div class=body><p>{body}</p></div></div>"
    whole = " ".join(f"Title {lead} {body}".split())
    major = f"<body><div class=story><p>{body}</p></div><div class=extra><p>{lead * 3}</p></div></body>"
    minor = f"<body><div class=story><p>teaser</p></div><div class=long><h1>Title</h1><p>{lead}</p><p>{body}</p></div></body>"
    pages = {"a": [f"<body>{nested}</body>"] * 3, "b": [f"<body>{plain}</body>"] * 3,
             "c": [major] * 5 + [minor], "d": [f"<body><div class='layout has-sidebar'>{nested}<div class=sidebar><p>no</p></div></div></body>"],
             "e": [f"<body><div id='content-side'><p>{body}</p></div><div class=comment-list><p>no</p></div></body>"],
             "f": [f"<body>{nested}<div class=comment-list><p>{body * 4}</p></div></body>"]}
    rows = [(f"{h}{k}", f"http://{h}.example.com/{k}", p) for h, ps in pages.items() for k, p in enumerate(ps)]
    got = {r.page_id: r.text for r in op9_html.main_text(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert {got[k] for k in ("a0", "a2", "b0", "b1", "d0", "f0")} == {whole}
    assert got["c0"] == got["e0"] == body.strip() and whole in got["c5"]


def test_deep_and_long_pages(spark):
    deep = {0: "<b>" * 1100 + "text", 1: "<blockquote>" * 10_000 + "<p>quoted</p>", 2: "<div class=x>" * 10_000 + "<p>inner words</p>",
            3: "<i>" * 8000 + "<p>one</p><h2>two</h2>" * 50 + "</i>" * 8000, 4: "<p>word</p>" * 40_000}
    df = spark.createDataFrame([(k, f"http://d{k}.example.com/", f"<body>{p}</body>") for k, p in deep.items()], "page_id int, url string, html string")
    got = {r.page_id: r.text for r in op9_html.main_text(df).collect()}
    assert (got[0], got[1], got[2]) == ("text", "quoted", "inner words") and got[3] == "one two " * 49 + "one two" and got[4].count("word") == 40_000


def test_words_of_boilerplate_inside_articles_are_put_to_the_host(spark):
    body = "body words follow here " * 20
    page = "<body><article><h1>T</h1><p>{body}</p>{more}{always}</article></body>"
    always = "<div class=share><a href=x>tweet</a> this</div><div class=comments><p>reader says</p></div>"
    extra = {0: "<section id='share'><p>The share price rose.</p></section>", 1: "<div class='side effects'><p>Mild ones.</p></div>",
             2: "<div id='social'><p>Social life.</p></div>"}
    rows = [(k, "http://many.example.com/", page.format(body=body, more=extra.get(k, ""), always=always)) for k in range(30)]
    rows += [(100, "http://one.example.com/", page.format(body=body, more="", always=always))]
    got = {r.page_id: r.text for r in op9_html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    plain = f"T {body}".strip()
    assert got[0] == f"{plain} The share price rose." and got[1] == f"{plain} Mild ones." and got[2] == f"{plain} Social life."
    assert all(got[k] == plain for k in (3, 17, 29, 100))


def test_small_path_tables_are_sent_to_the_pages(spark):
    df = op9_html.main_text(read_table(spark, SMOKE, "pages"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_queries_are_registered_once_per_operator():
    names = list(queries.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))


def test_pipeline_equals_its_parts(spark):
    """Brute-force base rule and near-duplicates around the learned and compressed decisions."""
    docs = read_table(spark, SMOKE, "documents").unionByName(odd_documents(spark))
    good = corpus_pipeline.quality_rules(spark, docs, SMOKE)
    rows = [r for r in docs.collect()]
    assert all(not brute_quality(r.text)[5] for r in good.collect())
    kept = op5_quality.quality(docs).where("kept").count()
    assert good.count() == kept and good.columns == docs.columns and kept > 0.7 * sum(not brute_quality(r.text)[5] for r in rows)
    spoken = corpus_pipeline.language_id(spark, good, SMOKE)
    pred = op1_language.predict(good, op1_language.fit(good)).where(f"lang_pred <> 'und' and score >= {op1_language.LEAST_SCORE}")
    assert spoken.count() == pred.count() and spoken.columns == docs.columns
    left = [(r.doc_id, r.text) for r in spoken.collect()]
    single = corpus_pipeline.near_dedup(spark, spoken, SMOKE)
    want = {i for (i, _, _, ok) in brute_near(left, op4_minhash.STAGE_PERCENT) if ok and i is not None}
    assert {r.doc_id for r in single.where("doc_id is not null").collect()} == want and single.columns == docs.columns
    clean = corpus_pipeline.pii(spark, single, SMOKE)
    assert clean.count() == single.count() and clean.columns == docs.columns
    assert clean.where("n_chars <> length(text)").count() == single.where("n_chars <> length(text)").count()


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SMOKE)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "language ID", "MinHash near-dedup", "PII", "best-fit packing"]
    assert op4_minhash.PERCENT == 85 and op8_pii.KEY
