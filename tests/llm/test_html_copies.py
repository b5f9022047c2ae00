"""What templates leave of a page: copies, edited copies, nested slots, names inside articles."""

from collections import Counter, defaultdict

import pytest

from pricewatch.llm import html_text

PAGE = "<html><body><nav><p>Home</p></nav><p>{top}</p><article><h1>Title {a}</h1><p>First of {a}</p><p>Second of {a}</p></article></body></html>"


def test_copies_are_one_vote(spark):
    pages = [(i, f"http://copies.example/{i}", PAGE.format(top=i, a="same")) for i in range(9)]  # one article on 9 of 21 urls
    pages += [(20 + i, f"http://copies.example/other/{i}", PAGE.format(top="t", a=i)) for i in range(8)]
    pages += [(40, *pages[0][1:])] * 5 + [(41 + i, *pages[9][1:]) for i in range(4)]  # captured again
    pages += [(60 + i, f"http://few.example/{i}", PAGE.format(top=i, a="few")) for i in range(4)]
    pages += [(70 + i, f"http://few.example/{i + 4}", PAGE.format(top="t", a=f"few{i}")) for i in range(4)]
    want = {}
    for page_id, _, html in pages:
        a = html.split("Title ")[1].split("<")[0]
        want[page_id] = f"Title {a}\nFirst of {a}\nSecond of {a}"
    got = html_text.extracted(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)).collect()
    assert len(got) == len(pages)
    assert {r.page_id: r.text for r in got} == want


def texts(spark, pages):
    got = html_text.extracted(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()
    return {r.page_id: r.text for r in got}


def test_edited_copies_stay_whole(spark):
    page = "<body><article><h1>Title</h1><p>One paragraph</p><p>Another paragraph</p><p>Edit {i}</p></article></body>"
    pages = [(i, f"http://edits.example/{i}", page.format(i=i)) for i in range(10)]
    assert texts(spark, pages) == {i: f"Title\nOne paragraph\nAnother paragraph\nEdit {i}" for i in range(10)}


@pytest.mark.parametrize("n", [1, 3, 20])
def test_an_article_does_not_depend_on_the_size_of_its_host(spark, n):
    page = "<body><article><p>Text {i}</p><p>Ships free today</p></article></body>"
    assert texts(spark, [(i, f"http://h.example/{i}", page.format(i=i)) for i in range(n)]) == {i: f"Text {i}\nShips free today" for i in range(n)}


def test_parts_of_a_slot_belong_together(spark):
    page = (
        "<body><div class='top'>Our site {i}</div><div class='post'><h1>Title {i}</h1><div class='intro'>Intro of {i} in a few words</div>"
        "<div class='text'><p>Long text {i} with many more words than the rest</p><p>Read more below</p></div></div><div class='end'>All rights</div></body>"
    )
    pages = [(i, f"http://post.example/{i}", page.format(i=i)) for i in range(12)]
    want = "Title {i}\nIntro of {i} in a few words\nLong text {i} with many more words than the rest"
    assert texts(spark, pages) == {i: want.format(i=i) for i in range(12)}


def test_names_inside_an_article(spark):
    page = (
        "<body><article><p>Text</p><div class='related-work'>Earlier studies</div><div class='notice-board'>Board</div><label>Figure 1</label>"
        "<div class='related'>See also</div><div class='ad'>Buy</div><form><label>Name</label></form></article><div class='cookie-bar'>Ok</div></body>"
    )
    assert texts(spark, [(1, "http://a.example/", page)]) == {1: "Text\nEarlier studies\nBoard\nFigure 1"}


def test_long_page_and_crowded_host(spark):
    long = "<body><article>" + "".join(f"<p>Paragraph {i}</p>" for i in range(20_000)) + "</article></body>"
    plain = "<body><div class='nav'>Menu</div><div class='story'><p>Story {i} tells of things</p></div><div class='foot'>Imprint here</div></body>"
    pages = [(i, f"http://crowd.example/{i}", plain.format(i=i)) for i in range(300)] + [(1000, "http://crowd.example/long", long)]
    got = texts(spark, pages)
    assert got.pop(1000) == "\n".join(f"Paragraph {i}" for i in range(20_000))
    assert got == {i: f"Story {i} tells of things" for i in range(300)}


def deduced(pages):
    """Digests of template blocks and main slot by host, from whole occurrence vectors."""
    out = {}
    chosen = defaultdict(dict)
    for url, html in pages:
        page = html_text.parsed(html)
        article = any(b[2] for b in page.blocks)
        content = frozenset(t for _, t, a, o in page.blocks if not o and (a or not article))
        chosen[url.split("/")[2]].setdefault(content, page)
    hosts = {h: list(p.values()) for h, p in chosen.items() if len(p) >= html_text.LEAST_PAGES}
    for host, found in hosts.items():
        vectors, words, total = defaultdict(lambda: [0] * len(found)), Counter(), 0
        for k, page in enumerate(found):
            for place, n in page.places.items():
                vectors["<" + place][k] = n
            for place, text, _, hidden in page.blocks:
                vectors["=" + text][k] += 1
                if not hidden:
                    n = len(text.split(" "))
                    total += n
                    words["=" + text] += n
                    parts = place.split("/")
                    for m in range(2, len(parts) + 1):
                        words["<" + "/".join(parts[:m])] += n
        common = {t: tuple(v) for t, v in vectors.items() if 2 * sum(x > 0 for x in v) >= len(found)}
        size = Counter(common.values())
        valid = [t for t, v in common.items() if size[v] >= 2]
        fixed = [t for t in valid if t[0] == "="]
        fill = total - sum(words[t] for t in fixed)
        slots = [t for t in valid if t[0] == "<" and words[t] >= html_text.MAIN_SHARE * fill]
        main = max(slots, key=lambda t: (t.count("/"), words[t]), default=None)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        out[host] = (
            {signed(html_text._digest(t)) for t in fixed},
            signed(html_text._digest(main)) if main else None,
        )
    return out


def test_templates_against_whole_vectors(spark):
    pages = []
    for h in range(4):
        for i in range(6 + 3 * h):
            rows = "".join(f"<li>Item {k}</li>" for k in range(i % 3))
            pages.append((
                f"http://h{h}.example/{i}",
                f"<body><div class='bar'><p>Welcome</p><p>Offers</p></div><ul>{rows}</ul><div class='box'><div class='inner'><p>Tale {h} {i} goes on for a while</p>"
                + ("<p>Often here</p>" if i % 2 else "") + "</div></div><div class='low'>Contact us</div></body>",
            ))
    table = spark.createDataFrame(pages, "url string, html string").repartition(5)
    got = {r.host: (set(r.blocks), r.main) for r in html_text.templates(table).collect() if r.host != html_text.POOLED}
    assert got == deduced(pages) and len(got) == 3
