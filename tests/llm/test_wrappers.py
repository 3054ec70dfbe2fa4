"""Main texts of pages in several layouts."""

import pytest

from cartlens.llm import wrappers
from tests.llm.cases import prose


def page(layout: str, i: int) -> tuple[str, str]:
    """A page and its main text."""
    title, one, two = f"Title {prose(i, 4)}", prose(i + 1000, 40), prose(i + 2000, 30)
    menu = "<ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul>"
    if layout == "article":
        html = (
            f"<html><head><title>{title}</title><style>p{{}}</style><script>var a='<p>x</p>';</script></head><body><nav>{menu}</nav>"
            f"<!-- ad --><div class='ad'>Buy {prose(i, 3)}</div><article><h1>{title}</h1><p>{one} &amp; <b>{two}</b><br>more"
            f"<p>{two}</article><aside>{prose(i, 9)}</aside><section id=comments><p>{prose(i, 8)}</section><footer>&copy; x</footer>"
        )
        return html, f"{title} {one} & {two} more {two}"
    if layout == "plain":
        html = (
            f"<body><div><a href=/>Home</a> <a href=/x>All</a></div><div><h2>{title}</h2><p>{one}</p>\n<p>{two}&nbsp;&eacute;</p></div>"
            f"<div>Terms and conditions of the site apply to all pages here</div></body>"
        )
        return html, f"{title} {one} {two} é"
    optional = f"<div class=share>Share {i}</div>" if i % 2 else ""
    note = "<p>Sign up for our newsletter today</p>" * (i % 3 == 0)
    html = (
        f"<div role=banner>Site</div><main><header><h1>{title}</h1></header>{optional}<div class=body>{note and ''}<p>{one}</p><ul><li>{two}</ul></div>"
        f"<form><input><p>Search</p></form><div class='cookie-notice'>We use cookies</div></main>"
    )
    return html, f"{title} {one} {two}"


@pytest.mark.parametrize("layout", ["article", "plain", "main"])
def test_main_text(spark, layout):
    made = [page(layout, i) for i in range(40)]
    rows = [(i, f"https://{layout}.example.org/{i}", h) for i, (h, _) in enumerate(made)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    found = {r.page_id: r for r in wrappers.extract(pages).collect()}
    assert {i: found[i].text for i in found} == {i: t for i, (_, t) in enumerate(made)}
    assert all(r.n_chars == len(r.text) for r in found.values())


def test_template_text_inside_an_article_is_left_out():
    forms = [wrappers.page_form(f"<article><div>Read this first</div><p>{prose(i, 20)}</p></article>") for i in range(5)]
    whole = forms[0][0]
    for form, _ in forms[1:]:
        whole = wrappers.align(whole, form)
    own, blocks = wrappers.page_form(f"<article><div>Read this first</div><p>{prose(9, 20)}</p></article>")
    assert [blocks[i] for i in wrappers.Wrapper(whole).blocks(own)] == [prose(9, 20)]


def test_alignment_makes_optional_and_repeated_groups():
    one, _ = wrappers.page_form("<div><p>a</p><p>b</p><ul><li>x</ul></div>")
    two, _ = wrappers.page_form("<div><h1>t</h1><p>c</p></div>")
    div = wrappers.align(one, two).kids[0]
    assert [(k.label, k.many, k.optional) for k in div.kids] == [("h1", False, True), ("p", True, False), ("ul", False, True)]
    again = wrappers.Node.load(div.dump())
    assert again.dump() == div.dump()


def test_edge_cases(spark):
    deep = "<div>" * 3_000 + "deep text" + "</div>" * 3_000
    wide = "".join(f"<p>x{i}</p><h2>y</h2>" for i in range(800))
    rows = [
        (1, None, None),
        (2, "http://h/x", None),
        (3, "http://h/y", ""),
        (4, "nothing", "<"),
        (5, "http://h/z", "just text &lt;b&gt; &#233; &bogus;"),
        (6, "http://d/", deep),
        (7, "http://w/", wide),
        (7, "http://w/", wide),
        (8, "http://s/", "<p>a<script>never closed <p>b"),
        (9, "http://s/", "</div></p>< 3 and <b>bo</b>ld" + "word " * 50_000),
    ]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, _host string")
    found = {r.page_id: r for r in wrappers.extract(pages).collect()}
    assert wrappers.extract(pages).count() == len(rows)
    assert found[1].text == found[2].text == found[3].text == ""
    assert found[5].text == "just text <b> é &bogus;"
    assert found[6].text == "deep text"
    assert found[7].text.split()[:3] == ["x0", "y", "x1"]
    assert found[8].text == "a" and found[9].text.startswith("< 3 and bold")
    assert wrappers.extract(pages.limit(0)).collect() == []


def main_texts(pages: list[str]) -> list[str]:
    """Main texts of the pages of one host, without Spark."""
    whole = wrappers.page_form(pages[0])[0]
    for other in pages[1:]:
        whole = wrappers.align(whole, wrappers.page_form(other)[0])
    wrapper = wrappers.Wrapper(wrappers.Node.load(whole.dump()))
    return [" ".join(blocks[i] for i in wrapper.blocks(own)) for own, blocks in map(wrappers.page_form, pages)]


@pytest.mark.parametrize(
    "around",
    [
        "<div class='site has-sidebar'>{}</div>",
        "<div class='content with-comments'>{}</div>",
        "<div id='header-and-main'>{}</div>",
        "<div class='message-body'>{}</div>",
        "<form method=post action='./page.aspx'>{}</form>",
        "<form><div class=message>{}</div></form>",
    ],
)
@pytest.mark.parametrize("main", ["article", "div"])
def test_containers_of_the_main_text_are_not_left_out(around, main):
    rest = "<nav><a href=/>Home</a></nav>{}<ol class=comment-list><li><article>{}</article></ol><footer>x</footer>"
    texts = [f"{prose(i, 5)} {prose(i + 100, 30)}" for i in range(6)]
    head = "h1" if main == "article" else "p"
    whole = [f"<{main}><{head}>{prose(i, 5)}</{head}><p>{prose(i + 100, 30)}</p></{main}>" for i in range(6)]
    pages = [around.format(rest.format(w, prose(i + 200, 9))) for i, w in enumerate(whole)]
    assert main_texts(pages) == texts
    # the container on some pages only
    mixed = [p if i % 2 else rest.format(w, "<p>no") for i, (p, w) in enumerate(zip(pages, whole))]
    if main == "article":
        assert main_texts(mixed) == texts
    side = "<form><input><p>{}</p></form><div class='site-footer'>{}</div><article>{}</article>"
    assert main_texts([side.format(prose(i, 9), prose(i, 8), t) for i, t in enumerate(texts)]) == texts


def test_copies_of_one_article_do_not_make_template_text():
    extra = "<blockquote>Quoted here only</blockquote><table><tr><td>cell</table><pre>code</pre><h2>Part</h2><ul><li>point</ul>"
    copies = [f"<article><h1>{prose(0, 5)}</h1><p>{prose(1, 40)} {i}</p>{extra}</article>" for i in range(3)]
    others = [f"<article><h1>{prose(i, 5)}</h1><p>{prose(i + 100, 40)}</p></article>" for i in range(20)]
    found = main_texts([*others[:9], *copies, *others[9:]])
    assert [t for t in found if "Quoted" in t] == [f"{prose(0, 5)} {prose(1, 40)} {i} Quoted here only cell code Part point" for i in range(3)]
    assert main_texts(copies) == [f"{prose(0, 5)} {prose(1, 40)} {i} Quoted here only cell code Part point" for i in range(3)]
    # a text of all pages is still left out, beside pages without text too
    same = "<article><div>Read this first</div><p>{}</p></article>"
    assert main_texts(["", *(same.format(prose(i, 20)) for i in range(5)), "<div></div>"]) == ["", *(prose(i, 20) for i in range(5)), ""]


@pytest.mark.parametrize(
    "long",
    ["<p>{}</p>", "<ul><li>{}</ul>", "<table><tr><td>{}</table>", "<pre>{}</pre>", "<blockquote><p>{}</blockquote>", "<p><a href=/x>{}</a></p>"],
)
def test_main_text_without_main_elements_is_whole(long):
    menu = "<div><a href=/a>All {}</a> <a href=/b>News {}</a></div>"
    body = "<h1>{}</h1>{}<ul><li>{}<li>{}</ul>"
    for around in ("<body>{}<div>{}</div><div>Terms of the site</div>", "<body><table><tr><td>{}<td>{}</table>Terms of the site"):
        pages, texts = [], []
        for i in range(6):
            parts = [prose(i, 4), prose(i + 100, 60), prose(i + 200, 3), prose(i + 300, 2)]
            pages.append(around.format(menu.format(i, i), body.format(parts[0], long.format(parts[1]), *parts[2:])))
            texts.append(" ".join(parts))
        assert main_texts(pages) == texts


def test_main_text_in_two_sections_is_whole():
    pages = [
        f"<body><div><a href=/>Home {i}</a></div><div><section><h2>{prose(i, 3)}</h2><p>{prose(i + 100, 80)}</section>"
        f"<section class=more><p>{prose(i + 200, 20)}</section></div>"
        for i in range(6)
    ]
    assert main_texts(pages) == [f"{prose(i, 3)} {prose(i + 100, 80)} {prose(i + 200, 20)}" for i in range(6)]


@pytest.mark.parametrize("nest", ["div", "blockquote"])
def test_text_after_a_deep_nest_stays_in_its_article(nest):
    deep = f"<{nest}>" * 3_000 + "deep {}<nav>menu <div>{}</div></nav> text {}" + f"</{nest}>" * 3_000
    pages = [
        f"<body><div><article><h1>{prose(i, 3)}</h1>{deep.format(i, i, i)}<p>{prose(i + 100, 30)}</p></article></div><div>{prose(i, 9)}</div>"
        for i in range(5)
    ]
    assert main_texts(pages) == [f"{prose(i, 3)} deep {i} text {i} {prose(i + 100, 30)}" for i in range(5)]
    # never closed
    open_ = [f"<{nest}>" * 500 + f"<article><p>{prose(i, 30)}</p><section class=comments><p>{prose(i, 9)}</section></article>" for i in range(5)]
    assert main_texts(open_) == [prose(i, 30) for i in range(5)]


def test_pages_of_one_host_with_and_without_articles(spark):
    """No page goes empty because others of its host have a main element."""
    made = []
    for i in range(24):
        title, body = f"{prose(i, 4)}", prose(i + 100, 40)
        inner = f"<h1>{title}</h1><p>{body}</p>"
        around = ("<article>{}</article>", "<div class=content>{}</div>", "<article></article><div class=content>{}</div>")[i % 3]
        made.append((f"<body><nav><a href=/>Home</a></nav>{around.format(inner)}<footer>x</footer>", f"{title} {body}"))
    rows = [(i, f"https://mixed.example.org/{i}", h) for i, (h, _) in enumerate(made)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 6):
        found = {r.page_id: r.text for r in wrappers.extract(pages.repartition(parts)).collect()}
        assert found == {i: t for i, (_, t) in enumerate(made)}
    few = wrappers.extract(pages.where("page_id < 2")).collect()
    assert {r.page_id: r.text for r in few} == {i: made[i][1] for i in range(2)}


@pytest.mark.parametrize("name", ["byline", "message", "copyright", "modal", "related", "teaser"])
def test_article_parts_that_are_no_menu_stay(name):
    texts = [[prose(i, 5), prose(i + 100, 30), prose(i + 200, 12)] for i in range(6)]
    whole = "<article><h1>{}</h1><p>{}</p><div class={}><p>{}</p></div></article>"
    assert main_texts([whole.format(*t[:2], name, t[2]) for t in texts]) == [" ".join(t) for t in texts]


@pytest.mark.parametrize("name", ["related", "recommended", "teaser"])
def test_lists_of_other_articles_are_left_out(name):
    texts = [[prose(i, 5), prose(i + 100, 30), prose(i + 200, 12)] for i in range(6)]
    inside = "<article><h1>{}</h1><p>{}</p><div class={}><a href=/x>{}</a></div></article>"
    beside = "<article><h1>{}</h1><p>{}</p></article><div class={}><article>{}</article></div>"
    for whole in (inside, beside):
        assert main_texts([whole.format(*t[:2], name, t[2]) for t in texts]) == [" ".join(t[:2]) for t in texts]
