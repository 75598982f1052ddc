"""Literal pages and keyword states."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tallyshelf.operators import aggregates as A
from tallyshelf.operators import keywords as K
from tallyshelf.operators import pages as P
from tallyshelf.operators.gates import GateError

TABLE = ('<table><tr><td>Example Desktop</td><td><a href="/nescen-n039/product/productdetail/A0123456">Detail</a></td>'
         "<td>฿ 12,345</td></tr></table>")
CARD = ('<div class="card"><a href="/nescen-n039/product/productdetail/A0654321" aria-label="Card Desktop">Product</a>'
        "<span>High performance desktop computer</span><span>฿ 9,999</span></div>")
UNKNOWN = "<html><body>Unavailable</body></html>"
BASE = "https://shop.example/a/b?x=1"


def pages(spark, *htmls):
    return spark.createDataFrame([(i, BASE, h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string")


def test_table_page(spark):
    rows = P.extract_price_table(pages(spark, TABLE)).collect()
    assert [(r.external_product_id, r.product_name, r.price, r.currency) for r in rows] == [
        ("A0123456", "Example Desktop", 12345.0, "THB")]
    assert rows[0].product_url == "https://shop.example/nescen-n039/product/productdetail/A0123456"


def test_card_page(spark):
    rows = P.extract_price_cards(pages(spark, CARD)).collect()
    assert [(r.external_product_id, r.product_name, r.price) for r in rows] == [("A0654321", "Card Desktop", 9999.0)]


def test_unknown_page_has_zero_counters(spark):
    row = P.extract_pages(pages(spark, UNKNOWN)).first()
    assert (row.products, row.table_rows, row.card_links, row.mode) == ([], 0, 0, "structured_card")


def test_hidden_text_and_unclosed_tags(spark):
    html = ('<table><tr><td>Box<script>฿ 1</script></td><td><a href="/productdetail/A1">go</a><td>฿ 2.50<tr><td>no link</td>'
            '<td>฿ 3</td></tr><tr><td><a href="/productdetail/a7">x</a></td><td>฿ ,</td></tr></table>')
    row = P.extract_pages(pages(spark, html)).first()
    # Without its end tag the first row also holds the second, so it shows two prices.
    assert row.products == [] and row.table_rows == 3


def test_large_pages_take_time_in_proportion(spark):
    card = '<div class="card"><a href="/productdetail/A%d">p</a><span>sold out now, come back later please</span>%s</div>'
    filler = "<p>" + "words " * 60 + "</p>"
    html = "<main>" + "".join(card % (i, filler) for i in range(5000)) + card % (7, "<b>฿ 9</b>") * 2 + "</main>"
    assert len(html) > 2_000_000
    unclosed = "<table>" + "".join(f'<tr><td><a href="/productdetail/A{i}">p</a><td>฿ 5' for i in range(5000))
    began = time.time()
    first, second = P.extract_pages(pages(spark, html, unclosed)).orderBy("page_id").collect()
    assert time.time() - began < 60
    assert (first.card_links, first.card_no_valid_container, first.found, len(first.products)) == (5002, 5000, 2, 1)
    # Only the innermost row holds one product, in one open cell.
    assert (second.table_rows, second.table_no_single_id, second.table_insufficient_cells) == (5000, 4999, 1)


def test_conflicting_prices_on_one_page(spark):
    two = TABLE + TABLE.replace("12,345", "99")
    found = A.conflicting_prices(P.extract_price_table(pages(spark, two, TABLE + TABLE)), ["page_id", "external_product_id"])
    assert [(r.page_id, r.min_price, r.max_price) for r in found.collect()] == [(0, 99.0, 12345.0)]


def test_links_are_absolute_and_distinct(spark):
    html = "".join(f'<a class=x href="{h}">l</a>' for h in
                   ["/p?a=1&amp;b=2", "c", "../up", "./same", "//cdn.example/x", "https://o.example/item/1", "#top", "?q=2", "c"])
    links = {r.link: r.product_like for r in P.extract_links(pages(spark, html)).collect()}
    assert links == {
        "https://shop.example/p?a=1&b=2": False, "https://shop.example/a/c": False, "https://shop.example/up": False,
        "https://shop.example/a/same": False, "https://cdn.example/x": False, "https://o.example/item/1": True,
        "https://shop.example/a/b?x=1#top": False, "https://shop.example/a/b?q=2": False}


def test_classes_and_sanitizing(spark):
    blocked = "<title>Just a moment</title>" + TABLE
    shell = "<div id='app'></div>"
    kinds = [r.classification for r in P.classify_page(pages(spark, blocked, TABLE, shell, UNKNOWN)).orderBy("page_id").collect()]
    assert kinds == ["access_or_bot_protection", "server_rendered_product_listing",
                     "javascript_shell_or_client_rendered_page", "other_or_unrecognized_html"]
    clean = P.sanitize_html(pages(spark, "<SCRIPT>a</script><input value='x'><b data-csrf-x=\"1\">t</b>")).first().html
    assert clean == '<!-- script removed --><!-- input removed --><b data-redacted="true">t</b>'


def test_visible_text_and_price_context(spark):
    html = "<p>one</p><style>x</style><p>two</p><p>three</p><p>four</p><p>฿ 5 &amp; up</p><p>six</p><!-- no --><p>seven</p>"
    assert P.visible_text(pages(spark, html)).first().text == "one two three four ฿ 5 & up six seven"
    row = P.price_context_window(pages(spark, html, UNKNOWN)).collect()
    assert [(r.page_id, r.position, r.context) for r in row] == [(0, 4, "two three four ฿ 5 & up six seven")]


def test_jsonld(spark):
    block = '<script type="application/ld+json">%s</script>'
    html = block % json.dumps({"@type": "ItemList", "name": "n", "itemListElement": [1, 2]}) + block % "{oops" + block % json.dumps(
        [{"@type": "A", "@graph": [{"@type": "P"}, {"@type": "Q"}]}])
    rows = P.extract_jsonld(pages(spark, html)).orderBy("block").collect()
    assert [(r.parse_failed, r.type, r.item_list_count, r.graph_types) for r in rows] == [
        (False, "ItemList", 2, None), (True, None, None, None), (False, "A", None, "P,Q")]
    assert rows[0]["keys"] == "@type,itemListElement,name"


def test_redirect_ids_do_not_match_longer_ids(spark):
    html = "<a href='/r/redirect?id=123'>x</a> ฿ 5 <a href='https://www.priceza.com/r/redirect?id=12'>y</a> 1,000 บาท"
    rows = {r.redirect_id: r for r in P.redirect_price_candidates(pages(spark, html)).collect()}
    assert rows["123"].position == 9 and rows["12"].position == html.index("https")
    assert rows["12"].nearby_prices == ["฿ 5", "1,000 บาท"]


def plan(spark):
    return spark.createDataFrame([("one", 0), ("two", 1), ("three", 2)], "keyword string, plan_no int")


def work(spark, state, persisted, max_pages, limit):
    s = spark.createDataFrame(state, "keyword string, state string, last_page int")
    p = spark.createDataFrame(persisted, "keyword string, page int")
    return [tuple(r) for r in K.select_work(plan(spark), s, p, max_pages, limit).collect()]


def test_select_work(spark):
    assert work(spark, [("one", "completed", 1)], [("one", 1)], 1, 10) == [("two", 1), ("three", 1)]
    assert work(spark, [("one", "partial", 1)], [("one", 1), ("one", 1)], 3, 1) == [("one", 2)]
    assert work(spark, [("one", "partial", 3)], [("two", 1)], 3, 9) == [("two", 2), ("two", 3), ("three", 1), ("three", 2), ("three", 3)]


def test_keywords(spark):
    texts = spark.createDataFrame([(1, "ｶﾒﾗ, 靴\n"), (2, " 靴 ,ソファ,,x")], "doc_id int, text string")
    words = K.keyword_normalize(texts, ["doc_id"])
    assert {r.keyword for r in words.collect()} == {"カメラ", "靴", "ソファ", "x"}
    groups = {r.keyword: r.category for r in K.keyword_classify(words).collect()}
    assert groups == {"カメラ": "家電", "靴": "ファッション", "ソファ": "家具", "x": "生活用品"}
    assert {r.keyword for r in K.keyword_priority(words, high=2).filter("priority = 'high'").collect()} == {"カメラ", "靴"}
    refined = K.keyword_cross_refine(words, ["q", "r"], size=9).orderBy("refinement", "place").collect()
    assert [r.keyword for r in refined[4:]] == ["カメラ q", "靴 q", "ソファ q", "x q", "カメラ r"]
    assert K.keyword_cross_refine(words, ["q"], size=2).count() == 4
    with pytest.raises(GateError):
        K.keyword_cross_refine(words, ["q"], size=9)


def test_words_are_cut_before_they_are_normalized(spark):
    texts = spark.createDataFrame([(1, "靴，バッグ,帽子,\u3000,ｶﾒﾗ\u3000,カメラ"), (2, None), (3, "")], "doc_id int, text string")
    words = {r.keyword: r.first_seen.position for r in K.keyword_normalize(texts, ["doc_id"]).collect()}
    assert words == {"靴,バッグ": 0, "帽子": 1, "カメラ": 3}


def listed(words, qualifiers):
    """The list as it grows: each qualifier refines everything so far."""
    out = list(words)
    for q in qualifiers:
        for w in list(out):
            if f"{w} {q}" not in out:
                out.append(f"{w} {q}")
    return out


@pytest.mark.parametrize("base, qualifiers", [(["a", "b"], ["x", "y"]), (["a", "a x", "b y", "a x y"], ["x", "y", "z"]), (["a"], [])])
def test_refinements_in_list_order(spark, base, qualifiers):
    words = spark.createDataFrame([(w, n) for n, w in enumerate(base)], "keyword string, first_seen int")
    got = K.keyword_cross_refine(words, qualifiers).orderBy("refinement", "place").collect()
    assert [r.keyword for r in got] == listed(base, qualifiers)


def test_newest_state_counts(spark):
    p = spark.createDataFrame([("a", 0), ("b", 1)], "keyword string, plan_no int")
    s = spark.createDataFrame([("a", "partial", 1, 5), ("a", "completed", 2, 3), ("b", "partial", 9, 1), ("b", "completed", 1, 2)],
                              "keyword string, state string, last_page int, at int")
    none = spark.createDataFrame([], "keyword string, page int")
    assert [tuple(r) for r in K.select_work(p, s, none, 3, 9, "at").collect()] == [("a", 2), ("a", 3)]


def test_references_and_unquoted_links(spark):
    html = "<p>&#3647; 5 &#x0E3F;6&nbsp;&eacute;&amp;lt; &unknown; &#0; &#xD800; &#9999999; &copy;</p><a class=x href=/b>t</a><A HREF = c/d >"
    row = P.visible_text(pages(spark, html)).first().text
    assert row == "฿ 5 ฿6 é&lt; &unknown; &#0; &#xD800; &#9999999; © t"
    assert {r.link for r in P.extract_links(pages(spark, html)).collect()} == {"https://shop.example/b", "https://shop.example/a/c/d"}


def test_reconcile_keeps_rows_without_state(spark):
    p = spark.createDataFrame([("a", "pending", 0, None), ("b", "pending", 0, None), ("c", "pending", 0, None)],
                              "keyword string, status string, last_page int, last_run_at string")
    s = spark.createDataFrame([("a", "completed", 3, "t"), ("b", "failed", 2, "t"), ("c", "partial", 1, None)],
                              "keyword string, state string, last_page int, completed_at string")
    rows = K.keyword_reconcile(p, s, F.lit("u")).orderBy("keyword").collect()
    assert [tuple(r) for r in rows] == [("a", "completed", 3, "t"), ("b", "pending", 0, None), ("c", "partial", 1, "u")]
