"""Main text of page templates: wrappers inside the article, attributes and names of layout wrappers."""

from pathlattice.llm import html_extract as H


def extracted(spark, *pages):
    rows = [(k, f"http://h.example/{k}", p) for k, p in enumerate(pages)]
    got = H.extract(spark, spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


BODY = "".join(f"<p>{'long text of the story goes on and on ' * 10} {k}</p>" for k in range(8))
MENU = "<div class=teasers>" + "<p><a href=x>read also this other story of ours</a></p>" * 12 + "</div>"


def test_heading_and_lead_beside_the_body_stay(llm_spark):
    parts = f"<h1>The heading</h1><div class=lead><p>The lead of it.</p></div><div class=body>{BODY}</div>"
    for page in (f"<body><div class=page><div class=article>{parts}</div>{MENU}</div></body>",
                 f"<body><article><div class=content>{parts}</div></article>{MENU}</body>",
                 f"<body><article><h1>The heading</h1><div class=lead><p>The lead of it.</p></div><div class=content>"
                 f"<div class=body>{BODY}</div></div></article>{MENU}</body>"):
        for text in extracted(llm_spark, page, page):
            assert text.startswith("The heading\nThe lead of it.\nlong text") and text.endswith(" 7")
            assert "read also" not in text


def test_attributes_are_whole_pairs():
    assert H.attributes(' style="overflow:hidden" data-id=menu data-class="sidebar" title="id=ads class=nav"') == {}
    assert H.attributes(""" CLASS='a b' id=x hidden aria-hidden="true" class=second""") == {
        "class": "a b", "id": "x", "hidden": "", "aria-hidden": "true"}


def test_layout_wrappers_do_not_empty_a_page():
    story = f"<h1>The heading</h1>{BODY}"
    side = "<div class=sidebar><p>words of the sidebar</p></div><div class=comments><p>words of a reader</p></div>"

    def text(page):
        return "\n".join(b for b, _, _ in H.page_blocks(page))

    for attrs in ('style="overflow:hidden"', 'data-role="navigation"', 'class="content has-sidebar"', 'class="elementor-widget"',
                  'class="side-by-side" id="page-header"', 'class="widget"'):
        assert text(f"<body><div {attrs}>{story}{side}</div></body>") == text(f"<body><div>{story}</div></body>"), attrs
    # hidden elements, and long comments beside a text, still go
    assert text(f"<body><div hidden>{story}</div><p>x</p></body>") == "x"
    assert text(f"<body><p>short story</p><div class=comments>{BODY}</div></body>") == "short story"


def test_names_that_are_parts_only_lower_the_vote(llm_spark):
    column = "<div class=column>" + "<p>words of another column beside the story, of some length and not linked</p>" * 8 + "</div>"
    story = "".join(f"<p>{'long text of the story goes on and on ' * 3} {k}</p>" for k in range(6))
    for name in ("content has-sidebar", "related-news-page", "with-menu", "page-with-comments-layout"):
        page = f"<body><div class='{name}'>{story}</div>{column}</body>"
        blocks = [b for b, _, _ in H.page_blocks(page)]
        assert sum(b.startswith("long text") for b in blocks) == 6, name
    # compound names go, as whole names do, in the article too
    for name in ("post-comments", "comments-section", "sidebar-left", "site-footer", "ad-slot", "share-buttons", "related-posts", "cookie-banner",
                 "main-nav", "newsletter-signup"):
        page = f"<body><article><h1>The heading</h1>{BODY}<div class={name}><p>words that are not the story</p></div></article></body>"
        text, = extracted(llm_spark, page) if name == "post-comments" else ["\n".join(b for b, _, _ in H.page_blocks(page))]
        assert "not the story" not in text and text.startswith("The heading"), name


def test_the_header_of_an_article_is_the_article_s(llm_spark):
    page = (f"<body><header><h1>Site name</h1></header><article><header class=entry-header><h1>The heading</h1><nav>menu</nav></header>{BODY}"
            f"<footer>about the author</footer></article><header>late banner</header></body>")
    text, = extracted(llm_spark, page)
    assert text.startswith("The heading\nlong text") and text.endswith(" 7")
    hidden = f"<body><article><header hidden><h1>Gone</h1></header>{BODY}</article></body>"
    assert extracted(llm_spark, hidden)[0].startswith("long text")


def test_deep_nesting_is_read_in_one_pass():
    import time

    deep = 3000
    page = "<body>" + "<div class='sidebar'><p>some words here</p>" * deep + "</div>" * deep + f"<div>{BODY}</div></body>"
    t = time.perf_counter()
    blocks = H.page_blocks(page)
    assert [b for b, _, _ in blocks][-1].endswith(" 7") and len(blocks) == 8
    plain = "<body>" + "<div><p>words</p>" * deep + "</div>" * deep + "</body>"
    assert len(H.page_blocks(plain)) == deep
    spared = "<body>" + "<div class='page-header'><p>some words here</p>" * 400 + "</div>" * 400 + "</body>"
    assert H.page_blocks(spared)
    assert time.perf_counter() - t < 20
