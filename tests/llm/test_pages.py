from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from sluiceway.llm import pages, queries
from sluiceway.llm.arrow import table


def extracted(spark, rows, **options):
    df = spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, text string")
    return {r.page_id: r for r in pages.main_text(df, **options).collect()}


def test_markup(spark):
    page = (
        '<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><header>top</header><nav><ul><li>a<li>b</ul></nav>'
        '<div class="cookie-notice">we use</div><!-- x > y --><article><h1>Head&amp;er</h1><p>one<br>two <b>th</b>ree<p>caf&eacute;&nbsp; 1 &lt; 2'
        '<div class="ad">buy</div><aside>side</aside><form>mail<input></form><ul><li>x</li><li>y</ul></article>'
        '<section id="comments"><article>nice</article></section><footer>&copy; end</footer></body></html>'
    )
    got = extracted(spark, [("https://a.example/1", page), (None, None), ("x", ""), ("x", "<p>just  text\n<p>here"), ("https://a.example/2", "a <b")])
    assert got[0].text == "Head&er one two three café 1 < 2 x y" and got[0].n_chars == len(got[0].text)
    assert got[1].text == "" and got[2].text == "" and got[3].text == "just text here" and got[4].n_chars == 4


def kinds(page):
    return [(("main", "chrome", "open")[k], text) for k, text in pages.blocks(page)]


def test_names_do_not_take_the_article_away():
    for page in (
        '<article class="post category-search hentry"><h1>a</h1><p>b</article>', '<main class="no-sidebar"><p>a<p>b</main>', '<main id="search"><p>a<p>b</main>',
        '<div id="page" class="site no-sidebar"><article><p>a<p>b</article></div>', '<div class="search"><div class="hidden"><main><p>a<p>b</main></div></div>',
        '<article class="social"><p>a</article><div class="wide"><article class="share"><p>b</article></div>',
        '<main><div class="sidebar content"><article><p>a<p>b</article></div></main>',
    ):
        assert kinds(page) == [("main", "a"), ("main", "b")], page
    for page in (
        '<article>a</article><div class="related"><article>x</article></div>', '<article>a<div class="comments"><article class="comment">x</article></div></article>',
        '<main>a</main><div class="site-sidebar"><article>x</article></div>', '<article>a<div class="cookie-notice">x</div></article>', '<article>a<div id="ad_slot-3">x</div></article>',
        '<div class="site sidebar"><article>a</article></div><aside><article>x</article></aside>', '<article>a<div class="share-buttons wide">x</div></article>',
    ):
        assert kinds(page) == [("main", "a"), ("chrome", "x")], page
    assert kinds('<div class="no-sidebar">a</div><div class="sidebar">x</div>') == [("open", "a"), ("chrome", "x")]


def test_names_on_loose_elements():
    for page in (
        '<article><p>a<p class="advert">x<p>b</article>', '<article><ul><li>a<li class="share"><b>x</b><li>b</ul></article>', '<article><p>a <span class="ad">x</span> b</article>',
        '<article><table><tr><td>a<td class="sidebar">x<tr><td>b</table></article>', '<article>a <span class="ad"><span>x</span></span> b</article>',
        '<article>a<div><a class="promo">x</div>b</article>', '<article><p>a <i class="ad">x<p>b</article>', '<article>a<p class="notice">x<div>b</div></article>',
    ):
        assert kinds(page) == [("main", "a"), ("chrome", "x"), ("main", "b")], page
    assert kinds('<article><pre>a <span class="comment">b</span></pre><table><tr><td class="header">c</table></article>') == [("main", "a b"), ("main", "c")]


def test_boilerplate_inside_articles(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    bar = " ".join(word() for _ in range(9))
    bodies = [" ".join(word() for _ in range(30)) for _ in range(20)]
    rows = [("https://one.example/p", f"<nav>{bar}</nav><article><p>{b}</p><p>{bar}</p></article>") for b in bodies]
    rows += [("https://two.example/p", f"<article><p>{b}</p><p>{bar}</p></article>") for b in bodies[:5]]  # too few to tell
    copies = [f"{bodies[0]} {bar} {i}" for i in range(30)]
    rows += [("https://three.example/p", f"<article>{c}</article>") for c in copies]
    got = extracted(spark, rows)
    assert [got[i].text for i in range(20)] == bodies
    assert [got[i].text for i in range(20, 25)] == [f"{b} {bar}" for b in bodies[:5]]
    assert [got[i].text for i in range(25, 55)] == copies


def test_host_repeats_go_and_unique_runs_stay(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    bar, end = " ".join(word() for _ in range(12)), " ".join(word() for _ in range(9))
    bodies = [" ".join(word() for _ in range(20)) for _ in range(30)]
    rows = [("https://one.example/p", f"<p>{bar}</p><p>{b}</p><div>{end}</div>") for b in bodies]
    rows += [("https://two.example/p", f"<p>{bar}</p><p>{bodies[0]}</p>")] * 2  # copies of a page, and another host
    rows += [("https://one.example/a", f"<article>{bar}</article>")]
    for options in ({}, {"length": 4}):
        got = extracted(spark, rows, **options)
        assert [got[i].text for i in range(30)] == bodies
        assert got[30].text == got[31].text == f"{bar} {bodies[0]}" and got[32].text == bar


def test_counted_windows_agree_with_shards(spark):
    rng = random.Random(6)
    rows = [(f"h{i % 2}.example", "<p>" + " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))) for i in range(40)]
    rows = [(f"https://{h}/", p) for h, p in rows]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    streams = {}
    for u, h in rows:
        s = pages.read_page(u, h)["stream"]
        streams.setdefault(tuple(s), len(streams))
    table_ = spark.createDataFrame([(p, list(s)) for s, p in streams.items()], "page long, stream array<long>")
    seen = {}
    for s, p in streams.items():
        for i in range(len(s) - 3):
            seen.setdefault(s[i : i + 4], set()).add(p)
    want = {p: [i for i in range(len(s) - 3) if len(seen[s[i : i + 4]]) > 1] for s, p in streams.items()}
    want = {p: at for p, at in want.items() if at}
    for limit in (4096, 1):
        got = pages.boilerplate(table_, 4, shard_tokens=30, group_limit=limit)
        assert {r.page: r.starts for r in got.collect()} == want
    assert df.count() == 40


def test_suffix_ranks():
    tokens = np.array([3, 1, 3, 1, 2, 3, 1, 2])
    ranks = pages.suffix_ranks(tokens, 2)
    for i in range(8):
        for j in range(8):
            assert (tuple(tokens[i : i + 2]) < tuple(tokens[j : j + 2])) == (ranks[i] < ranks[j])


def test_query(spark, sf):
    rows = table(spark, sf, "pages").collect()
    got = {r.page_id: r for r in queries.QUERIES["op3_host_suffix_text"](spark, sf).collect()}
    assert set(got) == {r.page_id for r in rows}
    for r in rows:
        inside = r.html.split("<article>")[1].split("</article>")[0]
        assert got[r.page_id].text.split(" ")[0] in inside and got[r.page_id].n_chars > 0
        assert "track(" not in got[r.page_id].text and "©" not in got[r.page_id].text


def test_empty_table(spark):
    assert extracted(spark, []) == {}


@pytest.mark.parametrize("piece", ["<script ", "<a ", "<!-- ", "<p \"", "<", "</", "<a href='", "<b <i \"x\" "])
@pytest.mark.parametrize("end", ["", ">", "\">", "-->"])
def test_a_bad_megabyte_takes_a_moment(piece, end):
    page = "<article><p>Good words.</p>" + piece * (1_000_000 // len(piece)) + end
    start = time.perf_counter()
    found = pages.blocks(page)
    assert time.perf_counter() - start < 10 and found[0] == (pages.ARTICLE, "Good words.")


def test_markup_that_is_never_ended():
    texts = lambda page: [t for _, t in pages.blocks(page)]
    assert texts("<p>a</p><script>var b = 1; // <i>c</i> <d") == ["a"]
    assert texts("<p>a</p><!-- b <i>c</i> <d") == ["a"]
    assert texts("<p>a</p> 1 < 2 <!-- b") == ["a", "1 < 2"]
    assert texts("<p>a</p> b <script c") == ["a", "b <script c"]
    assert texts("<p>a</p><script>b</script>c <d") == ["a", "c <d"]


@pytest.mark.parametrize("least", [2, 14])
def test_an_anchor_stays_whole_when_joins_change_while_running(spark, least):
    """Where a join is only found small while it runs, its sides are no longer dealt by anchor."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    hosts = [i % 3 for i in range(300)]
    seen = {}
    for i, (h, t) in enumerate(zip(hosts, texts)):
        words = t.split(" ")
        for k in range(len(words) - 7):
            seen.setdefault((h, *words[k : k + 8]), set()).add(i % 64 if least > 2 else i)
    want = {i: [k for k in range(len(t.split(" ")) - 7) if len(seen[h, *t.split(" ")[k : k + 8]]) >= least] for i, (h, t) in enumerate(zip(hosts, texts))}
    df = spark.createDataFrame(list(zip(range(300), hosts, texts)), "page long, host long, text string").repartition(4)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = {r.page: r.starts for r in pages.boilerplate(df, least=least, gram=2).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {i: at for i, at in want.items() if at} and got


def test_no_text_is_shuffled(spark, sf):
    """What goes with the texts is brought to them: the last step reads the written pages and has no exchange."""
    out = queries.QUERIES["op3_host_suffix_text"](spark, sf)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_the_filter_keeps_every_frequent_anchor():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(list("abcdefghijklm"), 40)) for _ in range(200)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([7] * 200, pa.int64()), pa.array(texts)], names=["page", "host", "text"])
    packed = pa.Table.from_batches(pages._packed_anchors(8, 4)([batch]))
    often = []
    for group in set(packed["bucket"].to_pylist()):
        found = pages._frequent(3)(packed.filter(pa.compute.equal(packed["bucket"], group)))
        often += [(r["bucket"], r["bits"]) for r in found.to_pylist()]
    values, begin = pages._streams(pa.array(texts), np.full(200, 7, np.uint64))
    anchors, starts, _ = pages.stream_runs(values, begin, 8, 4)
    on = {}
    for a, i in zip(anchors.tolist(), (np.searchsorted(begin, starts, "right") - 1).tolist()):
        on.setdefault(a, set()).add(i % 64)
    frequent = np.array([len(on[a]) >= 3 for a in anchors.tolist()])
    kept = pages.may_be_frequent(pages.anchor_filter(often), anchors)
    assert frequent.any() and kept[frequent].all() and not kept.all()
    assert not pages.may_be_frequent(pages.anchor_filter([]), anchors).any()
