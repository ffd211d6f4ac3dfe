"""op3: reader comments, notices and adverts go at any size; the article stays (pure Python, no Spark)."""

from shelfcast.llm import html_text
from shelfcast.llm.html_text import main_text

ARTICLE = (
    "<h1>River levels rise after storm</h1>"
    "<p>The river rose two metres overnight as the storm moved east across the valley towns.</p>"
    "<p>Officials opened the flood gates early in the morning and asked residents to stay inside.</p>"
)
COMMENTS = "".join(f"<div class='comment'><p>Reader {i} wrote a long reply about the weather and other things today.</p></div>" for i in range(30))
NOTICE = "<p>" + "We use cookies to improve your experience and to measure traffic on this site. " * 12 + "</p>"


def _has_article(text: str) -> bool:
    return "River levels rise after storm" in text and "flood gates early" in text


def test_content_div_beside_longer_comments():
    text = main_text(f"<body><div class='content'>{ARTICLE}</div><div class='comments'>{COMMENTS}</div></body>")
    assert _has_article(text) and "Reader" not in text


def test_long_cookie_banner():
    text = main_text(f"<body><div class='content'>{ARTICLE}</div><div class='cookie-banner'>{NOTICE}</div></body>")
    assert _has_article(text) and "cookies" not in text


def test_comment_list_inside_main():
    text = main_text(f"<body><main>{ARTICLE}<div class='comment-list'>{COMMENTS}</div></main></body>")
    assert _has_article(text) and "Reader" not in text


def test_article_beside_many_comments():
    text = main_text(f"<body><article>{ARTICLE}</article><section class='comments'>{COMMENTS}</section></body>")
    assert _has_article(text) and "Reader" not in text


def test_comments_section_inside_article():
    text = main_text(f"<body><article>{ARTICLE}<section class='comments'>{COMMENTS}</section></article></body>")
    assert _has_article(text) and "Reader" not in text


def test_commentlist_id_inside_main():
    items = COMMENTS.replace("div class='comment'", "li").replace("</div>", "</li>")
    text = main_text(f"<body><main>{ARTICLE}<ol id='commentlist'>{items}</ol></main></body>")
    assert _has_article(text) and "Reader" not in text


def test_page_of_only_comments_keeps_them():
    """If nothing but comments is left, they are kept rather than giving an empty text."""
    assert "Reader 3 wrote" in main_text(f"<body><div class='comments'>{COMMENTS}</div></body>")


def test_layout_names_and_forms_still_kept_when_they_hold_the_article():
    assert _has_article(main_text(f"<body><form id='aspnetForm'>{ARTICLE}</form></body>"))
    assert _has_article(main_text(f"<body><div class='content has-sidebar'>{ARTICLE}</div></body>"))


def test_whole_tokens_only():
    # 'no-comments' and 'related-story' are not boilerplate: 'no' and 'story' are no neutral words
    assert _has_article(main_text(f"<body><div class='no-comments'>{ARTICLE}</div></body>"))
    assert _has_article(main_text(f"<body><div class='related-story'>{ARTICLE}</div></body>"))


def test_a_name_of_header_alone_is_a_layout_name():
    """It goes by the size rule outside an article and stays inside one."""
    assert html_text._names_boilerplate("site-header", False) == {"header"}
    assert html_text._names_boilerplate("site-header", True) == frozenset()
    assert html_text.is_boilerplate("div", " class='site-header'", False) == (False, True, False)
    assert html_text._names_boilerplate("subheaders", False) == frozenset()
