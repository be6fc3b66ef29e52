import itertools
import math
import random

import pytest

from colsieve.llm import html_crf as H

PAGES = "page_id long, url string, html string"


def plain(source):
    return [b.text for b in H.blocks_of(source)]


@pytest.mark.parametrize("source, want", [
    ("<p>a <b>b</b>c<br>d", ["a bc d"]),
    ("<p>one<p>two</p>three", ["one", "two", "three"]),
    ("x &amp; y&lt;z &#233; &unknown;", ["x & y<z é &unknown;"]),
    ("<script>var t='</p><p>no';</script><style>p{}</style>yes<!-- <p>no --> more", ["yes more"]),
    ("<div><p>open<div>inner", ["open", "inner"]),
    ("a < b <p title='x>y' class=\"q\">c", ["a < b", "c"]),
    ("<p>cut <a href='u", ["cut"]),
    ("<p>no end <!-- never", ["no end"]),
    ("<script>alert(1)", []),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]),
    ("", []), ("   \n\t", []), ("</p></div>", []), ("<>", ["<>"]),
])
def test_blocks(source, want):
    assert plain(source) == want


def test_broken_attributes_take_linear_time():
    source = "<p " + "a=\"'" * 50_000 + "<b>" * 50_000
    assert isinstance(H.blocks_of(source), list)


def test_ancestors_names_and_labels():
    block = H.blocks_of("<div class='Post Body-1' id=main><p data-main=1>x")[0]
    assert block.tags == ("div", "p") and block.names == {"post", "body", "main"} and block.label == 1


@pytest.fixture(scope="module")
def trained(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return pages, H.fit(pages)


def test_viterbi_is_the_best_of_all_paths(trained):
    _, model = trained
    rng = random.Random(2)
    for _ in range(20):
        blocks = [H.Block(f"t{k} " * rng.randint(1, 40), (rng.choice(("p", "li", "div")),), frozenset({rng.choice(("ad", "post"))}),
                          None, 0, rng.randint(0, 2)) for k in range(rng.randint(1, 9))]
        emit = model.emissions(H.features(blocks))

        def value(path, blocks=blocks, emit=emit):
            return sum(y * e for y, e in zip(path, emit, strict=True)) + sum(
                model.steps[blocks[k].path != blocks[k - 1].path][path[k - 1]][path[k]] for k in range(1, len(path)))

        best = max(itertools.product((0, 1), repeat=len(blocks)), key=value)
        assert math.isclose(value(best), value(tuple(model.decode(blocks))))


def test_pages_equal_their_articles(trained):
    pages, model = trained
    out = {r.page_id: r for r in H.extract(pages, model).collect()}
    for r in pages.collect():
        blocks = H.blocks_of(r.html)
        want = " ".join(b.text for b, y in zip(blocks, H.by_semantic_tags(blocks), strict=True) if y)
        assert out[r.page_id].text == want and out[r.page_id].n_chars == len(want) and out[r.page_id].url == r.url


def test_unseen_layouts(trained):
    pages, model = trained
    draw, total, wrong = random.Random(77), 0, 0
    for r in pages.collect()[::5]:
        blocks = H.blocks_of(r.html)
        labels = H.by_semantic_tags(blocks)
        texts = [[b.text for b, y in zip(blocks, labels, strict=True) if y == k] for k in (1, 0)]
        new = [b for b in H.blocks_of(H._laid_out(*texts, draw)) if b.label is not None]
        total += len(new)
        wrong += sum(b.label != y for b, y in zip(new, model.decode(new), strict=True))
    assert wrong / total < 0.06


def test_awkward_rows(spark, trained):
    _, model = trained
    long = "<html><body><article>" + "".join(f"<p>Sentence number {k} is here.</p>" for k in range(20_000)) + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, None, "<p>"), (3, "u", long), (3, "u", long), (4, "u", "<nav>menu</nav>")]
    frame = spark.createDataFrame([(*r, 1.5) for r in rows], PAGES + ", text double")
    out = H.extract(frame, model).collect()
    assert len(out) == 6 and sorted(r.n_chars for r in out)[:3] == [0, 0, 0]
    assert all(r.text.endswith("number 19999 is here.") for r in out if r.page_id == 3)
    assert H.extract(spark.createDataFrame([], PAGES)).count() == 0
    assert H.extract(frame).count() == 6  # trained on these few alone


@pytest.mark.parametrize("inside", ["<div>" * 250 + "deep" + "</div>" * 250, "<b>" * 250 + "deep<div>x</div>"])
def test_elements_of_any_depth_are_seen(inside):
    blocks = H.blocks_of(f"<div><article class=story>{inside}<p>later</article><footer>out")
    assert [H.by_semantic_tags([b])[0] for b in blocks if b.text in ("deep", "later", "out")] == [1, 1, 0]
    nested = H.blocks_of("<article>" + "<div>" * 300 + "<nav class=menu data-main=0>links</nav>rest")
    assert [(H.by_semantic_tags([b])[0], "menu" in b.names, b.label) for b in nested] == [(0, True, 0), (1, False, None)]


def test_deep_pages_take_linear_time():
    source = "<b>" * 50_000 + "<h1>x</h1></i>" * 50_000 + "<div>y" * 20_000
    blocks = H.blocks_of(source)
    assert len(blocks) == 70_000 and blocks[-1].tags == ("b", "div")


def test_digits_and_links_count_over_the_whole_block():
    block = H.blocks_of("<p>" + "a" * 400 + "1" * 400 + "<a href=x><b><i><u><em>link text</em></u></i></b></a>")[0]
    assert block.links == len("link text")
    assert "digits3" in H.features([block])[0]


BODY = "<p>The council met on Monday and agreed on a plan for the old harbour.</p><p>Work will start in spring, the mayor said after the vote.</p>"
WORDS = "The council met on Monday and agreed on a plan for the old harbour. Work will start in spring, the mayor said after the vote."
CARD = "<h3>Ten more stories</h3><p>You may like this one about boats and bridges as well.</p>"


@pytest.mark.parametrize("page", [
    f"<main><article>{BODY}</article><section class='comments'><article class='comment'>Reader says: I don't agree with any of this at all.</article></section></main>",
    f"<article>{BODY}<aside><article>{CARD}</article></aside></article>",
    f"<article>{BODY}<section class='comments'><article>A long comment by a reader, who was there as well.</article></section></article>",
    f"<main>{BODY}<div class='related'><article>{CARD}</article></div></main>",
    f"<aside><article>{CARD}</article></aside><article>{BODY}</article>",
    f"<article><script src='a'/>var x = 1;</script>{BODY}<svg/></article>",
    f"<body><nav><a href='/'>Home</a></nav><main><article>{BODY}</article></main><footer>All rights reserved.</footer></body>",
])
def test_hand_written_pages(spark, field_on_pages, page):
    assert field_on_pages.text(page) == WORDS


@pytest.fixture(scope="module")
def field_on_pages(spark):
    return H.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))
