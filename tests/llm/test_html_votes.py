"""Names vote, the tree decides: articles survive ordinary class names, boilerplate by joined names goes."""

import time

import pytest

from roadrisk.llm.html_text import main_text, name_vote, name_words

BODY = [f"Paragraph {i} of the story, with a clause, and one more that makes it long enough to count." for i in range(6)]
STORY = "".join(f"<p>{p}</p>" for p in BODY)
TEXT = " ".join(BODY)
LINKS = "".join(f"<li><a href=/{i}>Another story that may interest you {i}</a></li>" for i in range(6))
TALK = "".join(f"<p>I, a reader, think that part {i} is wrong, and I say so at length, again and again.</p>" for i in range(20))
NAV = "<nav><ul><li><a href=/>Home</a></li></ul></nav>"


@pytest.mark.parametrize("page", [
    f'<div class="content no-sidebar">{STORY}</div>',
    f'<div class="layout has-sidebar"><article>{STORY}</article><div class="sidebar"><ul>{LINKS}</ul></div></div>',
    f'<div class="page with-comments" id="withSidebar">{STORY}</div>',
    f'<div class="content sidebar-left">{STORY}</div>',
    f'<div id="sidebar-layout"><main>{STORY}</main></div>',
    f'<form id="aspnetForm"><div class="wrapper">{STORY}</div></form>',
    f'<div class="banner-page">{STORY}</div>',
    f'<div class="widget-area">{STORY}</div>',
    f'<article>{STORY}<form><input><p>Your name, please, and your address as well</p></form></article>',
    f'<article>{STORY}<ol class="commentlist">{TALK}</ol></article>',
    f'<article>{STORY}</article><ol class="commentlist">{TALK}</ol>',
    f'<article>{STORY}<div class="userComments">{TALK}</div></article>',
    f'<article>{STORY}<div class="responses">{TALK}</div></article>',
    f'<article>{STORY}</article><section id="comments"><article class="comment">{TALK}</article></section>',
    f'<div id="post">{STORY}</div><div class="reader-comments">{TALK}</div>',
    f'<article>{STORY}<div class="related-posts"><ul>{LINKS}</ul></div></article>',
    f'<article>{STORY}<div class="socialShare">Share this story, with anyone you know, today</div></article>',
    f'<article>{STORY}<div class="ad-container"><p>Buy these shoes now, they are cheap, and they last</p></div></article>',
    f'<main><article>{STORY}</article>' + "".join(f'<article class=card><h3><a href=/{i}>Teaser {i} of a story</a></h3><p>Some words, and more of them.</p></article>'
                                                    for i in range(4)) + "</main>",
    f'<article>{STORY}</article><article class=card><a href=/1>Read the next story, it is long, and it is good</a></article>',
])
@pytest.mark.parametrize("frame", ["<html><body>{}</body></html>", "<body>" + NAV + "<div>{}</div><footer>Imprint</footer></body>"])
def test_the_article_and_nothing_else(page, frame):
    assert main_text(frame.format(page)) == TEXT


@pytest.mark.parametrize("tag,name", [("section", "related-work"), ("p", "social-science"), ("div", "noticeOfCopyrightLaw"),
                                      ("div", "survey-responses"), ("div", "recommended-dosage")])
def test_words_beside_others_stay_in_the_article(tag, name):
    extra = "This part of the article, named as it is, belongs to it and has to stay."
    inner = extra if tag == "p" else f"<p>{extra}</p>"
    for attribute in ("id", "class"):
        page = f"<body><article>{STORY}<{tag} {attribute}={name}>{inner}</{tag}></article></body>"
        assert main_text(page) == f"{TEXT} {extra}", name
    # a list of links under such a name goes
    if tag != "p":
        assert main_text(f"<body><article>{STORY}<div class={name}><ul>{LINKS}</ul></div></article></body>") == TEXT


def test_parts_of_one_article_stay():
    page = f"<main><article><p>{BODY[0]}</p><p>{BODY[1]}</p></article><article><p>{BODY[2]}</p><p>{BODY[3]}</p></article></main>"
    assert main_text(page) == " ".join(BODY[:4])


def test_references_are_not_decoded_across_tags():
    assert main_text(f"<article>{STORY}<p>AT&<b>amp;</b>T &amp; co, a company of which one hears, now and then.</p></article>") == \
        f"{TEXT} AT&amp;T & co, a company of which one hears, now and then."


def test_what_goes_parts_the_texts_around_it():
    assert main_text(f"<article>{STORY}<div>before<div class=advert>buy</div>after</div></article>") == f"{TEXT} before after"
    assert main_text(f"<article>{STORY}<div>before<aside>see</aside>after</div></article>") == f"{TEXT} before after"


def test_words_of_names():
    assert name_words("userComments-list") == ["user", "comments", "list"]
    assert name_words("commentlist") == ["comment"]
    assert name_words("HTMLSidebar2") == ["html", "sidebar"]
    assert name_vote("noCommentary") == 0 and name_vote("commentary") == 0 and name_vote("adapter") == 0


def test_many_votes_stay_linear():
    page = "<div class=related-work>" * 20000 + STORY + "</div>" * 20000 + "<div class=ad><p>x</p></div>" * 20000
    began = time.process_time()
    assert main_text(page) == TEXT
    assert time.process_time() - began < 10
