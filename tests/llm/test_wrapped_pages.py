"""Pages with wrappers of telling names, and articles in several parts."""

import pytest

from tillworks.llm import html_text

LINES = [f"Paragraph {k} of the article has this many words, and a few more to be long." for k in range(10)]
TEXT = "\n".join(LINES)
BODY = "".join(f"<p>{line}</p>" for line in LINES)
COMMENTS = "<p>A reader has something to say here, and goes on about it for long.</p>" * 30


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="layout has-sidebar"><div class="entry">{BODY}</div></div>',
        f'<div class="layout has-sidebar"><div>{BODY}</div><div class="sidebar"><p>side</p></div></div>',
        f'<article class="post has-comments">{BODY}</article>',
        f'<div id="social"><article>{BODY}</article><div class="comments">{COMMENTS}</div></div>',
        f'<article class="post has-comments">{BODY}</article><p class="ad">buy</p>',
        f'<div class="widget"><main class="share">{BODY}</main></div>',
        f'<article>{BODY}</article><div id="comments">{COMMENTS}</div>',
        f'<article>{BODY}<ol class="comment-list"><li><article class="comment">{COMMENTS}</article></ol></article>',
        f'<article><div class="entry with-share">{BODY}</div></article>',
    ],
)
def test_names_do_not_decide_alone(page):
    assert html_text.main_text(f"<html><body><nav>menu</nav>{page}<footer>f</footer></body></html>") == TEXT


@pytest.mark.parametrize("around", ["{}", "<div>{}</div>", "<main>{}</main>", "<div><div>{}</div></div>"])
@pytest.mark.parametrize("part", ["<article>{}</article>", "<div><article>{}</article></div>"])
def test_articles_in_several_parts(around, part):
    parts = "".join(part.format(BODY.replace("article", f"part {k}")) for k in range(3))
    links = '<article><p><a href="/x">Another page of this site, with a long title to read</a></p></article>'
    page = f"<body><nav>menu</nav>{around.format(parts)}<footer>f</footer></body>"
    want = "\n".join(TEXT.replace("article", f"part {k}") for k in range(3))
    assert html_text.main_text(page) == want
    alone = f"<body><div><article>{BODY}</article>{links * 3}<div><p>{'Other text. ' * 40}</p></div></div></body>"
    assert html_text.main_text(alone) == TEXT


FIELDS = '<label>Your mail address</label><input name="m"><button>Send</button>'


@pytest.mark.parametrize(
    "page",
    [
        f'<form id="page" action="/">{BODY}</form>',
        f'<form action="/"><main>{BODY}</main></form>',
        f"<form><div><article>{BODY}</article></div><div>{FIELDS}</div></form>",
        f"<form><nav>menu</nav><div>{BODY}</div><form><p>Subscribe</p>{FIELDS}</form></form>",
        f"<article>{BODY}<form><p>Tell us what you think of this</p>{FIELDS}</form></article>",
        f"<div>{BODY}</div><form class='signup'><p>Subscribe to our letter</p>{FIELDS}</form>",
        f"<article>{BODY}</article><form>{COMMENTS}{FIELDS}</form>",
        f"<fieldset>{BODY}</fieldset>",
        f"<form><fieldset><div>{BODY}</div></fieldset></form>",
    ],
)
def test_forms_around_the_article_and_in_it(page):
    assert html_text.main_text(f"<html><body><nav>menu</nav>{page}<footer>f</footer></body></html>") == TEXT
