import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vaultshift.llm import chat, html_extract


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "-", "", "x]y", None]), st.text(alphabet="<>[]\\/s INST-ok é\n</image 1>", max_size=30)), max_size=5))
@settings(max_examples=150, deadline=None)
def test_round_trip(turns):
    out = "".join(chat.format_turn(r, t)[0] for r, t in turns)
    assert list(chat.read_turns(out)) == turns


def test_parts_visitor():
    out, att, tokens = chat.format_turn("user", [{"type": "text", "text": "see <image 1> "}, {"type": "image", "ref": "a.png", "width": 600, "height": 10},
                                                 {"type": "audio", "ref": "b.wav", "seconds": 1.5}, {"type": "document", "ref": "c.pdf", "pages": 2}], first=4)
    assert out == "<s>[user] see \\<image 1> <image 4><audio 5><document 6> </s>"
    assert [(a["n"], a["kind"], a["ref"], a["tokens"]) for a in att] == [(4, "image", "a.png", 512), (5, "audio", "b.wav", 38), (6, "document", "c.pdf", 2048)]
    assert tokens == 3 + 512 + 38 + 2048
    assert list(chat.read_turns(out)) == [("user", "see <image 1> ")]
    with pytest.raises(ValueError):
        chat.parse_parts([{"type": "video"}])


def test_conversations(spark):
    rows = [(1, 2, "assistant", "b </s>"), (1, 1, "user", None), (2, 1, "assistant", "x"), (2, 1, "assistant", "x"), (None, None, None, "lost"), (3, 1, "user", "y" * 100_000)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as n_turns", "'q' as formatted")
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(conv)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].loss_chars, got[1].loss_sha256) == (2, sha("user\n\nassistant\nb </s>\n"), 6, sha("b </s>"))
    assert got[2].n_turns == 2 and got[2].loss_chars == 2 and got[None].turns_sha256 == sha("\nlost\n") and got[3].loss_chars == 0
    assert chat.digests(chat.format_conversations(conv.limit(0))).count() == 0
    parts = spark.createDataFrame([(1, 1, "user", None, json.dumps([{"type": "image", "ref": "r"}])), (1, 2, "user", None, json.dumps([{"type": "image", "ref": "q"}]))],
                                  "conv_id long, turn long, role string, text string, p string")
    assert [r.formatted for r in chat.format_conversations(parts, "p").collect()] == ["<s>[user] <image 1> </s>", "<s>[user] <image 2> </s>"]


W = html_extract.DEFAULT_WEIGHTS
BODY = "The quick brown fox jumps over the lazy dog and runs away into the deep dark wood. " * 3


@pytest.mark.parametrize("page", [
    "<nav><a href=x>Home</a></nav><article><h1>T</h1><p>{b}</article><footer>f f f</footer>",
    "<html><body><div class='cookie-notice'>We use cookies a lot here</div><main><h1>T</h1><div class=ad>Buy now</div><p>{b}</p></main></body>",
    "<header>Site name</header><div id=content><h1>T</h1><p>{b}</p></div><div id='comments'><p>{b} a reader said</p></div>",
    "<script>var a='<p>no</p>';</script><style>p{{}}</style><article><h1>T</h1><!-- <p>no --><p>{b}</p><form><input><p>mail</form></article><aside>{b}</aside>",
    "<article><header><h1>T</h1></header><p>{b}<aside>{b}</aside></article>",
    "<div class='sidebar'><p>{b}<article><h1>T</h1><p>{b}</article>",
])
def test_extract(page):
    assert html_extract.extract(page.format(b=BODY), W) == ("T " + BODY).strip()


@pytest.mark.parametrize("attrs", ['style="overflow:hidden"', 'aria-hidden="false"', 'title="hidden gems"', "class='page has-sidebar'", "class=no-sidebar",
                                   "class='overflow-hidden'", 'class="article-header"', 'data-class="ad"', "title=\"a class='ad'\"", "data-hidden"])
def test_attributes_that_mark_nothing(attrs):
    for page in ("<article><h1>T</h1><div {a}><p>{b}</p></div></article>", "<div {a}><article><h1>T</h1><p>{b}</p></article></div>"):
        assert html_extract.extract(page.format(a=attrs, b=BODY), W) == ("T " + BODY).strip()


def test_marks_around_the_article_and_in_code():
    for wrap in ("<div class=sidebar>{}</div>", "<form>{}</form>", "<div hidden>{}</div>"):
        assert html_extract.extract(wrap.format(f"<article><h1>T</h1><p>{BODY}</p></article>"), W) == ("T " + BODY).strip()
    assert html_extract.extract(f"<article><p>{BODY}</p><pre><span class=comment># note</span> x</pre></article>", W) == BODY + "# note x"
    for mark in ("hidden", "HIDDEN=''", "class='x ad'", "id=cookie_notice", "role='navigation'", "aria-label='Related'"):
        assert html_extract.extract(f"<article><p>{BODY}</p><div {mark}>gone</div></article>", W) == BODY.strip()


def test_extract_text_rules():
    page = "<article><p>a&amp;b &lt;c&gt;\n\n  d<b>e</b>f<br>g</p><p></p>" + f"<p>{BODY}</p></article>"
    assert html_extract.extract(page, W) == ("a&b <c> def g " + BODY).strip()
    for empty in (None, "", "<p></p>", "<!-- x", "<", "<script>x"):
        assert html_extract.extract(empty, W) in ("", "<")
    assert len(html_extract.extract("<article><p>" + "w " * 300_000, W).split()) == 300_000


def test_best_region_is_maximal():
    import random
    rng = random.Random(3)
    for _ in range(200):
        tokens = [("#text", "w " * rng.randint(0, 4), False) if rng.random() < 0.5 else (rng.choice(["p", "li", "div"]), "", False) for _ in range(12)]
        score = [k * W.get(f, W["#other"]) for f, k in html_extract.features(tokens)]
        a, b = html_extract.best_region(tokens, W)
        assert sum(score[a:b]) == pytest.approx(max([0.0] + [sum(score[i:j]) for i in range(12) for j in range(i, 13)]))


def test_pages_query(spark):
    pages = spark.createDataFrame([(1, "u", f"<article><p>{BODY}</p></article>"), (2, None, None), (2, None, None), (None, "v", "")], "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' as text", "1 as n_chars")
    w = html_extract.fit(pages)
    got = sorted(((r.page_id or -1), r.text, r.n_chars) for r in html_extract.extract_pages(pages, w).collect())
    assert got == [(-1, "", 0), (1, BODY.strip(), len(BODY.strip())), (2, "", 0), (2, "", 0)]
    assert html_extract.fit(pages.limit(0)) == W and html_extract.extract_pages(pages.limit(0), w).count() == 0


def _paragraphs(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("comments", [
    "<section id=comments><h2>Comments</h2>{c}</section>", "<div class='comment-list'>{c}</div>", "<ol class=comments-area>{c}</ol>", "{c}",
    "<div class=comment-thread><div>{c}</div></div>"])
@pytest.mark.parametrize("one", ["<article class=comment>{}</article>", "<article class='comment-body'>{}</article>", "<article>{}</article>"])
def test_reader_comments_as_articles(comments, one):
    shown = comments.format(c="".join(one.format(_paragraphs("I think " + BODY * 3)) for _ in range(3)))
    inside = f"<article><h1>T</h1>{_paragraphs(BODY)}{shown}</article>"
    assert html_extract.extract(inside, W) == ("T " + BODY).strip()
    if comments != "{c}" or "class" in one:
        after = f"<article><h1>T</h1>{_paragraphs(BODY)}</article>{shown}"
        assert html_extract.extract(after, W) == ("T " + BODY).strip()


def test_a_comment_mark_around_everything_means_something_else():
    page = f"<div class=comment><article><h1>T</h1>{_paragraphs(BODY)}</article></div>"
    assert html_extract.extract(page, W) == ("T " + BODY).strip()
    assert html_extract.extract(f"<article class=comment><h1>T</h1>{_paragraphs(BODY)}</article>", W) == ("T " + BODY).strip()


def test_heads_math_parts_and_compound_marks():
    kept = ("T " + BODY).strip()
    assert html_extract.extract(f'<article><div class="header"><h1>T</h1></div>{_paragraphs(BODY)}</article>', W) == kept
    assert html_extract.extract(f'<div class="header">Site name</div><article><h1>T</h1>{_paragraphs(BODY)}</article>', W) == kept
    for mark in ("ad-slot", "cookie-banner-wrapper", "newsletter-box", "share-buttons", "related-links"):
        assert html_extract.extract(f"<article><h1>T</h1>{_paragraphs(BODY)}<div class={mark}><p>gone</div></article>", W) == kept
    for mark in ("box", "section", "main-list", "ad-hoc", "header-image"):
        assert html_extract.extract(f"<article><h1>T</h1><div class={mark}>{_paragraphs(BODY)}</div></article>", W) == kept
    maths = "<math><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow></math>"
    assert html_extract.extract(f"<article><p>{BODY}when {maths} holds</p></article>", W) == (BODY + "when x=1 holds").strip()
    two = f"<article><h1>T</h1>{_paragraphs(BODY)}</article>\n<article>{_paragraphs('second ' + BODY)}</article>"
    assert html_extract.extract(f"<main>{two}</main>", W) == html_extract.extract(two, W) == " ".join(f"T {BODY} second {BODY}".split())
    bare = f"<article><article><h1>T</h1>{_paragraphs(BODY)}</article></article>"
    assert html_extract.extract(bare, W) == kept
    assert html_extract.extract("<article><article class=comment><p>" * 2000 + BODY, W).split()[:1] in ([], BODY.split()[:1])
