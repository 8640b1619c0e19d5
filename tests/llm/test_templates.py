"""Main text of pages: given elements, deduced templates, and odd markup."""

from __future__ import annotations

import random

import pytest

from meterline.llm import templates
from meterline.llm.html_tokens import Distinct, read
from meterline.llm.queries import QUERIES

WORDS = [f"{a}{b}{c}" for a in "bdfklm" for b in ("a", "ei", "o") for c in ("n", "rt", "sk", "ll")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n)).capitalize() + "."


def texts(html):
    return [b.text for b in read(html, Distinct())]


@pytest.fixture()
def extract(spark, folder):
    def run(rows, partitions=3):
        schema = "page_id long, url string, html string, host string, text string, seq long, template string"
        full = [(i, u, h, "h", "t", 1, "x") for i, u, h in rows]
        spark.createDataFrame(full, schema).repartition(partitions).write.parquet(f"{folder}/pages.parquet")
        found = QUERIES["op13_main_text"](spark, folder).collect()
        assert all(r["n_chars"] == len(r["text"]) for r in found)
        return sorted(((r["page_id"], r["url"], r["text"]) for r in found), key=lambda r: (r[0] is not None, r[0] or 0))

    return run


@pytest.mark.parametrize(
    "html,expected",
    [
        ("<p>one <b>two</b>\n three<p>four", ["one two three", "four"]),
        ("<p>a<br>b<br/>c</p>", ["a", "b", "c"]),
        ("x &amp; y &lt;b&gt; &eacute; &#8364; &am &copy 1", ["x & y <b> é € &am © 1"]),
        ("a<!-- <p>hidden --></p>b<!-->c", ["a", "bc"]),
        ("<script>var x = '<p>no</p>';</script><style>p{}</style><p>yes</p>", ["yes"]),
        ("<SCRIPT>no</Script ><P CLASS=x>yes", ["yes"]),
        ("<title>t</title><textarea><p>no</p></textarea>yes", ["yes"]),
        ("<ul><li>one<li>two<ul><li>three</ul></ul>four", ["one", "two", "three", "four"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>d", ["a", "b", "c", "d"]),
        ("<div class='Comment-list'>no</div><div class=with-comments>yes</div>", ["yes"]),
        ("<div role=navigation>no</div><div hidden>no</div><p style='display: none'>no</p><p>yes</p>", ["yes"]),
        ("<form><p>no</p></form><aside>no</aside><footer>no</footer><header>no</header>yes", ["yes"]),
        ("<article><header><h1>Head</h1></header><p>yes</p><section class=comments><article>no</article></section></article>", ["Head", "yes"]),
        ("1 < 2 <3 and <a href='>'>link</a>", ["1 < 2 <3 and link"]),
        ("<p title=\"unclosed>text</p><p>more</p>", ["text", "more"]),
        ("<p>text<span", ["text<span"]),
        ("<div><span class=ad>no</span>yes</div></p></nothing>more", ["yes", "more"]),
        ("<!-- never closed <p>no</p>", []),
        ("<script>never closed", []),
        ("", []),
        ("  \n", []),
    ],
)
def test_blocks(html, expected):
    assert texts(html) == expected


def site(i, rng, host="plain.example.org"):
    """A page without telling elements: menu, headline, text and closing lines are plain divs."""
    links = "".join(f"<span><a href='/{w}'>{w}</a></span> " for w in rng.sample(WORDS, 4))
    head, body = prose(rng, 6), [prose(rng, rng.randrange(3, 60)) for _ in range(rng.randrange(1, 6))]
    html = (
        f"<html><body><div id=a1>Our daily page of {host} brings news</div><div id=a2>{links}</div>"
        f"<div id=a3><h1>{head}</h1></div><div id=a4>{''.join(f'<div>{b}</div>' for b in body)}</div>"
        f"<div id=a5>Contact us by mail<div>All rights reserved forever</div> page {i}</div></body></html>"
    )
    return f"https://{host}/{i}", html, "\n".join([head, *body])


def test_a_template_without_telling_elements(extract):
    rng = random.Random(5)
    pages = [site(i, rng) for i in range(12)]
    found = extract([(i, u, h) for i, (u, h, _) in enumerate(pages)])
    assert found == [(i, u, t) for i, (u, _, t) in enumerate(pages)]


def test_classes_are_nested(spark):
    rng = random.Random(6)
    rows = [(i, *site(i, rng)[:2]) for i in range(9)]
    found = templates.templates(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r["host"], r["pages"], r["texts"]) for r in found] == [("plain.example.org", 9, 9)]
    classes = {c["number"]: c for c in found[0]["classes"]}
    root = max(classes.values(), key=lambda c: len(c["tokens"]))
    assert root["parent"] == -1 and root["support"] == 9
    # The menu's entries repeat, in one slot of the root.
    assert [c["parent"] for c in classes.values() if c is not root] == [root["number"]] * (len(classes) - 1)
    assert len(classes) == 2 and all(len(c["tokens"]) >= 3 for c in classes.values())


def test_repeated_words_in_articles(extract):
    rng = random.Random(7)
    rows, expected = [], []
    for host, n in (("many.example.org", 10), ("few.example.org", 2)):
        for i in range(n):
            text = prose(rng, 30)
            html = f"<nav>{prose(rng, 3)}</nav><article><p>{text}</p><p>Tell your friends about this story today</p></article>"
            rows.append((len(rows), f"http://{host}/{i}", html))
            expected.append(text if n > 2 else text + "\nTell your friends about this story today")
    assert [t for _, _, t in extract(rows)] == expected


def test_copies_are_no_template(extract):
    text = prose(random.Random(8), 50)
    html = "<html><body><nav>a b</nav><article><h1>Same</h1><p>{}</p></article></body></html>"
    rows = [(i, f"http://copies.example.org/{i}", html.format(text)) for i in range(40)]
    rows += [(40 + i, f"http://copies.example.org/x{i}", html.format(prose(random.Random(i), 20))) for i in range(6)]
    found = extract(rows)
    assert [t for _, _, t in found[:40]] == [f"Same\n{text}"] * 40
    assert [t for _, _, t in found[40:]] == ["Same\n" + prose(random.Random(i), 20) for i in range(6)]


def test_edge_rows(extract):
    page = "<article>text</article>"
    rows = [
        (1, None, page), (2, "no host", page), (3, "http://x.example.org/a", None), (4, "http://x.example.org/b", ""),
        (None, "http://x.example.org/c", page), (5, "http://x.example.org/c", page), (5, "http://x.example.org/c", page),
        (6, "HTTP://X.example.org?q", "<p>" + "long " * 60_000), (7, "", "<nav>only a menu</nav>"),
    ]
    expected = {1: "text", 2: "text", 3: "", 4: "", None: "text", 5: "text", 6: ("long " * 60_000).strip(), 7: ""}
    found = extract(rows)
    assert len(found) == len(rows)
    assert all(t == expected[i] for i, _, t in found)


def test_empty_table(extract):
    assert extract([]) == []


def test_joined_without_broadcast(extract, monkeypatch):
    monkeypatch.setattr(templates, "BROADCAST", -1)
    monkeypatch.setattr(templates, "CHUNK", 2)
    rng = random.Random(9)
    pages = [site(i, rng, f"s{i % 2}.example.org") for i in range(16)]
    found = extract([(i, u, h) for i, (u, h, _) in enumerate(pages)])
    assert [t for _, _, t in found] == [t for _, _, t in pages]


def test_crossing_classes_are_no_template():
    classes = [{"pages": 9, "members": [0, 1, 2]}, {"pages": 5, "members": [3, 4, 5]}]
    member, sizes = {k: c for c, x in enumerate(classes) for k in x["members"]}, [3, 3]
    facts = []
    for kind, a, b, c, x, y, order in templates.facts_of_page([0, 3, 1, 4, 2, 5], member, sizes):
        facts.append({"kind": kind, "a": a, "b": b, "c": c, "x": x, "y": y, "least": order, "most": order})
    assert [c["number"] for c in templates.nested(classes, facts)] == [0]


def test_tags_that_pages_repeat_are_read_once(monkeypatch):
    from meterline.llm import html_tokens as H

    page = '<body class="once"><nav id="x1"><a href="/a">one</a></nav><article><p class="y">two<p>three</article>'
    one, two, asked, told = H.Distinct(), H.Distinct(), [], H.told
    blocks = H.read(page, one)
    monkeypatch.setattr(H, "told", lambda *a: asked.append(a) or told(*a))
    assert H.read(page.replace('"/a"', '"/b"'), two) == blocks
    assert (two.tags, two.words) == (one.tags, one.words)
    assert not asked
    # However many there are, and however long, few are kept.
    monkeypatch.setattr(H, "MOST", len(H._STARTED) + 3)
    for k in range(20):
        H.read(f'<div class="{chr(97 + k)}"><div class="{"z" * H.LONG}">', H.Distinct())
        assert len(H._STARTED) <= H.MOST and all(len(tag) <= H.LONG for tag, _ in H._STARTED)
    again = H.Distinct()
    assert H.read(page, again) == blocks and (again.tags, again.words) == (one.tags, one.words)
