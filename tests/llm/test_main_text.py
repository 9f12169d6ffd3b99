"""Main text: the pages table against its markup, hand-made pages, broken markup."""

import html
import re
import time

from freqscope.llm import main_text as mt

SF_SMALL = "/root/testdata/sf0.001"
PROSE = "A sentence of the article, with commas, and with enough words to count as a paragraph. "


def page(body, head="<title>Site title</title><script>var a = '<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_pages_table(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in mt.op4_main_text(spark, SF_SMALL).collect()}
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside))).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)
        assert got[r["page_id"]]["url"] == r["url"]


def test_frame_is_left_out():
    article = f"<div class='content'><h1>Title</h1><p>{PROSE}</p><p>{PROSE * 2}</p><blockquote>{PROSE}</blockquote></div>"
    frame = (f"<header><h2>Site</h2>{PROSE}</header>", f"<nav><ul><li><a href='/'>Home</a></li></ul>{PROSE}</nav>",
             f"<div id='cookie-notice'>{PROSE}</div>", f"<div class='ad'>{PROSE}</div>", f"<aside>{PROSE}</aside>",
             f"<div class='sidebar-right'><p>{PROSE}</p></div>", f"<form><p>{PROSE}</p><input></form>",
             f"<section id='comments'><p>{PROSE * 5}</p></section>", f"<div role='navigation'>{PROSE}</div>",
             f"<div hidden>{PROSE}</div>", f"<footer>{PROSE}</footer>", f"<style>p {{}}</style><noscript>{PROSE}</noscript>",
             f"<article class='comment'><p>{PROSE}</p></article>", f"<!-- <p>{PROSE}</p> -->")
    want = " ".join(["Title", PROSE.strip(), (PROSE * 2).strip(), PROSE.strip()])
    assert mt.main_text(page("".join(frame[:5]) + article + "".join(frame[5:]))) == want
    for part in frame:
        assert mt.main_text(page(part + article)) == want, part
        assert mt.main_text(page(article + part)) == want, part


def test_words_in_names_are_whole_words():
    for name in ("headline", "shadow", "reading", "download", "commentary-text", "content has-sidebar", "no-comments"):
        assert mt.main_text(page(f"<div class='{name}'><p>{PROSE}</p></div>")) == PROSE.strip()


def test_sections_of_an_article_stay_together():
    body = f"<article><section><p>{PROSE}</p></section><section><p>{PROSE * 9}</p></section><p>Short end.</p></article>"
    assert mt.main_text(page(body + "<div><a href='x'>More links</a></div>")).endswith("Short end.")
    assert mt.main_text(page(body)).startswith(PROSE.strip())


def test_blocks_beside_the_best_container_stay():
    parts = ("<h1>Title</h1>", f"<div class=body><p>{PROSE * 3}</p></div>", "<h2>Next</h2>", "<ul><li>One</li><li>Two</li></ul>",
             "<blockquote>Said so.</blockquote>", "<pre>x = 1</pre>", "<figure><figcaption>A view</figcaption></figure>", "<p>Short.</p>",
             f"<section><p>{PROSE * 20}</p></section>", f"<section><p>{PROSE}</p></section>", "Own text.")
    links = "<div><a href='/a'>Another page</a> <a href='/b'>One more page</a></div>"
    want = " ".join(re.sub("<[^>]*>", " ", " ".join(parts)).split())
    for wrap in ("<main>{}</main>", "{}", "<div><div>{}</div></div>"):
        got = mt.main_text(page(links + wrap.format("".join(parts) + links) + "<footer>Foot</footer><a href='/c'>Last link</a>"))
        assert got == want, wrap
    two = f"<section><p>{PROSE * 9}</p><p>{PROSE * 9}</p></section><section><p>{PROSE}</p></section>"
    assert mt.main_text(page(f"<main>{two}</main>")) == " ".join(re.sub("<[^>]*>", " ", two).split())


def test_names_inside_the_article_need_the_score_to_agree():
    parts = (f"<section id='related-work'><h2>Related work</h2><p>{PROSE}</p></section>", f"<section id='social-impact'><p>{PROSE}</p></section>",
             "<h2 id='sharing-data'>Sharing data</h2>", f"<p id='notice-3'>{PROSE}</p>", f"<div id='comment-on-results'><h3>Results</h3><p>{PROSE}</p></div>",
             f"<div class='social-history'><p>{PROSE * 9}</p></div>")
    frame = ("<div class='share-buttons'><p>Share this page with all of your friends</p></div>", f"<div class='sidebar'><p>{PROSE * 9}</p></div>",
             f"<div class='related-posts'><p><a href='/a'>{PROSE * 5}</a></p></div>", f"<section id='comments'><p>{PROSE}</p></section>")
    want = " ".join(re.sub("<[^>]*>", " ", f"{PROSE * 4} {' '.join(parts)}").split())
    inside = f"<p>{PROSE * 4}</p>{''.join(parts)}{''.join(frame)}"
    assert mt.main_text(page(f"<article>{inside}</article>")) == want
    assert mt.main_text(page(f"<div class='content'>{inside}</div>")) == want
    only = f"<article>{''.join(parts[:2])}</article>"
    assert mt.main_text(page(only)) == " ".join(re.sub("<[^>]*>", " ", " ".join(parts[:2])).split())


def test_the_head_of_a_name_outweighs_prose():
    body = f"<p>{PROSE * 4}</p>"
    gone = ("section class='reader-comments'", "div class='user-comments'", "div class='newsletter-box'", "div class='comment-list-wrapper'",
            "section id='reader-comments'", "div id='cookieNotice2'", "div class='story promo_box'")
    for start in gone:
        part = f"<{start}><h2>Reader comments</h2><p>{PROSE * 9}</p></{start.split()[0]}>"
        assert mt.main_text(page(f"<article>{body}{part}</article>")) == (PROSE * 4).strip(), start
    stay = ("div class='comments-on-method'", "div class='notice-of-intent'", "div class='no-comments'", "section id='lunch-menu'",
            "div class='menu-design'", "section id='related-work'")
    for start in stay:
        part = f"<{start}><h2>The lunch menu</h2><p>{PROSE * 9}</p></{start.split()[0]}>"
        want = f"{PROSE * 4}The lunch menu {PROSE * 9}".strip()
        assert mt.main_text(page(f"<article>{body}{part}</article>")) == want, start
    form = f"<div class='comment-on-this'><p>{PROSE * 9}</p><form><input></form></div>"
    assert mt.main_text(page(f"<article>{body}{form}</article>")) == (PROSE * 4).strip()
    assert mt.main_text(page(f"<article>{body}<section id='lunch-menu'><p>{PROSE}</p></section></article>")) == (PROSE * 4).strip()


def test_labels_are_inline_unless_of_a_control():
    assert mt.main_text(page(f"<article><p>{PROSE}</p><p>The <label>word</label> here</p></article>")).endswith("The word here")
    assert mt.main_text(page(f"<article><p>{PROSE}</p><label for='nav'>Menu</label></article>")) == PROSE.strip()


def test_deep_blocks_with_text_take_linear_time():
    # in the last, each named element holds too few points of its own to stay
    for start, end, stays in (("<div>", "", True), ("<blockquote><a href=x>y</a>", "</p>", True),
                              ("<div class='menu-design'><section>", "</section>", False)):
        begin = time.time()
        got = mt.main_text((start + PROSE) * 50_000 + end * 50_000)
        assert time.time() - begin < 20 and (PROSE.strip() in got) == stays


def test_link_lists_in_the_article_go():
    links = "".join(f"<li><a href='/{k}'>Another page {k}</a></li>" for k in range(5))
    assert mt.main_text(page(f"<article><p>{PROSE * 3}</p><ul>{links}</ul></article>")) == (PROSE * 3).strip()
    items = "<ul><li>One thing, said plainly</li><li>Two <a href='x'>things</a></li></ul>"
    assert mt.main_text(page(f"<article><p>{PROSE * 3}</p>{items}</article>")).endswith("One thing, said plainly Two things")


def test_white_space_and_references():
    body = f"<article><p>{PROSE}</p><p>a<b>b</b>\n\t c<br>d &lt;e&gt; &eacute;&#233;&#x41;&nbsp;f &amp;amp; g</p></article>"
    assert mt.main_text(page(body)) == PROSE.strip() + " ab c d <e> ééA f &amp; g"


def test_broken_markup():
    for text, want in (("", ""), ("<", "<"), ("<p", ""), ("a < b & c", "a < b & c"), ("<p>Hi", "Hi"), ("<script>x", ""),
                       ("<!-- x", ""), ("<nav>menu</nav>", ""), ("no markup at all, just this.", "no markup at all, just this."),
                       ("</p></div>x</td>y", "xy"), ("<p>one<p>two<div>three", "one two three"),
                       ("<ul><li>a<li>b</ul>c", "a b c"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
                       ('<p title="a > b">x</p>', "x"), ("<p title='>x</p>", "x")):
        assert mt.main_text(text) == want, text


def test_long_pages_take_linear_time():
    begin = time.time()
    for text in ("<div>" * 30_000 + "x", "<p>word, word " * 60_000, '<a href="' * 30_000, "<b><i>" * 40_000, "&" * 200_000,
                 "<" * 200_000, "<p>" + PROSE * 20_000):
        mt.main_text(text)
    assert time.time() - begin < 60


def test_edge_rows(spark, tmp_path):
    rows = [(1, "u", None), (2, None, ""), (None, "u", page(f"<p>{PROSE}</p>")), (3, "u", "<p>é</p>"), (3, "u", "<p>é</p>")]
    df = spark.createDataFrame([(a, b, c, "t", 1) for a, b, c in rows], "page_id long, url string, html string, text string, n_chars int")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted((tuple(r) for r in mt.op4_main_text(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "u", PROSE.strip(), len(PROSE.strip())), (3, "u", "é", 1), (3, "u", "é", 1)], key=str)
    assert mt.extract(df.limit(0)).count() == 0
