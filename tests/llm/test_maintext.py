"""Blocks of pages, the random field against enumeration, and what it finds on pages of many layouts."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantlens.llm import crf, maintext
from grantlens.llm.html_blocks import leaf_blocks
from grantlens.llm.labelled_pages import labelled_pages


def texts(page):
    return [block.text for block in leaf_blocks(page)]


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("", []),
        ("plain  text\n only", ["plain text only"]),
        ("<p>one<p>two<br>three</p>four", ["one", "two three", "four"]),
        ("<p><b>bold<p>next</b> more", ["bold", "next more"]),
        ("<ul><li>a<li>b <ul><li>c</ul> d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("<p>a &amp; b &am c &#65;&nbsp;&lt;p&gt; &amp;amp; &copy 1</p>", ["a & b &am c A <p> &amp; © 1"]),
        ("<script>var t='</p>';</script><STYLE>p{}</STYLE>x<!-- <p>no</p> -->y<!DOCTYPE z>", ["xy"]),
        ("<title>t</title><textarea>no <p></textarea>a<noscript>no</noscript><select><option>no</select>b", ["a", "b"]),
        ("<button>no</button><p>yes <button>no</button> still</p>", ["yes", "still"]),
        ("a < b and 3 <4 <p title='x>y' class=\"p>q\">c", ["a < b and 3 <4", "c"]),
        ('<a href="never closed>a</a><p>b', ["a", "b"]),
        ("kept <p unfinished", ["kept"]),
        ("kept <!-- unfinished <p>gone", ["kept"]),
        ("x<script>swallowed", ["x"]),
        ("</p></div>a</section></li>b", ["a", "b"]),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, ["deep"]),
    ],
)
def test_blocks(page, expected):
    assert texts(page) == expected


def test_what_blocks_know():
    page = '<div id="siteHeader" class="top-nav"><a href="/">a b</a> c</div><article><aside hidden><p role=note>x</article><p>y'
    first, second, third = leaf_blocks(page)
    assert {"in:div", "word:site", "word:header", "word:top", "word:nav"} == first.names and 0.5 < first.linked < 1
    assert {"in:article", "in:aside", "in:p", "word:hidden", "word:note"} == second.names and not second.linked
    assert third.names == {"in:p"} and third.parent == 0
    assert leaf_blocks(page, frozenset({"in:p"}))[1].names == {"in:p"}


def some_sequences(seed=0, count=6):
    draw = np.random.default_rng(seed)
    names = ["a", "b", "c", "d"]
    return [
        (
            [{name for name in names if draw.random() < 0.5} for _ in range(n)],
            draw.integers(0, crf.KINDS, n).tolist(),
            draw.integers(0, 2, n).tolist(),
        )
        for n in draw.integers(1, 6, count)
    ]


def path_score(scores, kinds, labels, chain):
    total = chain.first[labels[0]] + scores[0] * labels[0]
    for k in range(1, len(labels)):
        total += chain.steps[kinds[k]][labels[k - 1], labels[k]] + scores[k] * labels[k]
    return total


def chain_of(parameters, names):
    width = len(names)
    return crf.Chain(dict(zip(names, parameters[:width], strict=True)), parameters[width:-2].reshape(crf.KINDS, 2, 2), parameters[-2:])


def test_likelihood_and_gradient():
    sequences = some_sequences()
    found, names = crf.gathered(sequences)
    parameters = np.random.default_rng(1).normal(size=len(names) + 4 * crf.KINDS + 2)
    value, slope = crf.likelihood(found, len(names), parameters)
    chain = chain_of(parameters, names)
    expected = 0.0
    for features, kinds, labels in sequences:
        scores = [sum(chain.weights[name] for name in place) for place in features]
        every = [path_score(scores, kinds, path, chain) for path in itertools.product((0, 1), repeat=len(labels))]
        expected += path_score(scores, kinds, labels, chain) - np.logaddexp.reduce(every)
    assert value == pytest.approx(expected / len(sequences))
    for k in range(len(parameters)):
        step = np.zeros_like(parameters)
        step[k] = 1e-5
        change = crf.likelihood(found, len(names), parameters + step)[0] - crf.likelihood(found, len(names), parameters - step)[0]
        assert slope[k] == pytest.approx(change / 2e-5, abs=1e-7)


def test_viterbi_equals_enumeration():
    draw = np.random.default_rng(2)
    for _ in range(300):
        n = int(draw.integers(1, 8))
        chain = crf.Chain({}, draw.normal(size=(crf.KINDS, 2, 2)), draw.normal(size=2))
        scores, kinds = draw.normal(size=n).tolist(), draw.integers(0, crf.KINDS, n).tolist()
        best = max(itertools.product((0, 1), repeat=n), key=lambda path: path_score(scores, kinds, path, chain))
        assert crf.decode(scores, kinds, chain) == list(best)
    assert crf.decode([], [], chain) == []


def test_labelled_pages_held_out():
    """Pages that the field was not fitted on: 98 of 100 blocks are told right."""
    chain = maintext.fitted()
    wrong = total = 0
    for page in labelled_pages(200, seed=9):
        features, kinds, labels = maintext.labelled(page)
        found = crf.decode([sum(chain.weights.get(name, 0.0) for name in sorted(place)) for place in features], kinds, chain)
        wrong, total = wrong + sum(a != b for a, b in zip(found, labels, strict=True)), total + len(labels)
    assert total > 4000 and wrong < 0.02 * total


LONG = "This is a sentence of an article, which says something at some length. It goes on for a while, as articles do."
LAYOUTS = [
    (
        f"<nav><a href=/>Home</a></nav><div class=ad>Buy this now.</div><article><h1>Title</h1><p>{LONG}<p>Ti.</article><footer>&copy; x.example &middot; Words here.</footer>",
        ["Title", LONG, "Ti."],
    ),
    (
        f"<div id=header><a href=/>Site</a></div><div id=menu><ul><li><a href=a>A</a><li><a href=b>B</a></ul></div><div id=content><h1>T</h1><p>{LONG}</p>"
        f"<div class='ads'><p>{LONG}</p></div><p>{LONG}</p></div><div id=sidebar><h3>Popular</h3><ul><li><a href=c>C</a></ul></div><div id=footer>Copyright 2020 Site</div>",
        ["T", LONG, LONG],
    ),
    (
        f"<main><h2>T</h2><p>{LONG}</p><ul><li>{LONG}</li></ul></main><section class=comments><h3>2 comments</h3><div class=comment><p>{LONG}</p></div>"
        f"<div class=comment><p>{LONG}</p></div></section><form><label>Name</label><p>Your address stays private.</p></form>",
        ["T", LONG, LONG],
    ),
    (f"<div class='cookie-notice'><p>We use cookies to make this site work.</p></div><div class=post><p>{LONG}</p><p>{LONG}</p></div>", [LONG, LONG]),
]


def test_layouts():
    reader = maintext.Reader(maintext.fitted())
    for page, expected in LAYOUTS:
        assert [block.text for block in reader.main_blocks(page)] == expected


def test_extract(spark):
    long = "<article><h1>T</h1>" + f"<p>{LONG}</p>" * 30_000 + "</article>"
    rows = [(1, "u", LAYOUTS[0][0]), (1, "u", LAYOUTS[0][0]), (2, None, None), (None, "v", ""), (3, "w", long), (4, "x", "<nav><a href=/>Home</a></nav>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("old"), "n_chars": F.lit(0), "names": F.lit("n")})
    found = maintext.extract(frame)
    assert found.columns == ["page_id", "url", "names", "text", "n_chars"]
    got = sorted(found.collect(), key=lambda row: (row["page_id"] is None, row["page_id"]))
    first = "\n\n".join(LAYOUTS[0][1])
    assert [row["text"] for row in got] == [first, first, "", "\n\n".join(["T"] + [LONG] * 30_000), "", ""]
    assert all(row["n_chars"] == len(row["text"]) for row in got)
    assert maintext.extract(frame.limit(0)).count() == 0
