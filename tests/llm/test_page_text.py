"""Rendering next to a plain walk over trees that the tests make themselves."""

import random
import time

import pytest

from tallyhouse.llm.page_text import render


@pytest.mark.parametrize(
    "piece",
    ["<ul><li>a", "<blockquote>a", "<table><tr><td>a", '<a "', '<a x="', "<b><li></li>", "<dl><dt>x<dd>y",
     "<td colspan=1000 rowspan=9>x", "<tr><td><td>x", "<i><tr>", "<!--", "<p>", "<svg>", "<option>x"],
)
def test_a_megabyte_takes_seconds(piece):
    began = time.time()
    text = render(piece * (1_000_000 // len(piece)))
    assert time.time() - began < 5 and len(text) < 20_000_000


def test_a_wide_cell_does_not_pad_all_rows():
    text = render("<table><tr><td>" + "w " * 200_000 + "<tr><td><td>x" * 20_000)
    assert len(text) < 3_000_000 and text.count("x") == 20_000


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<select><option>o1<option>o2</select>", "o1\no2"),
        ("<textarea> t1\n <b>t2</textarea>", " t1\n <b>t2"),
        ("<math><mi>x</mi><annotation>no</annotation></math>", "x"),
        ("<svg><title>no</title><text>in svg</text></svg>", "in svg"),
        ("<div style='visibility:hidden'>no<i style='visibility: visible'>yes</i>no</div>", "yes"),
        ("<div style='display:none'>no<i style='visibility: visible'>no</i></div>yes", "yes"),
        ("<input value=v><input type=hidden value=no><input placeholder=p>", "vp"),
        ("<p>a <b>b<p>c</b>d", "a b\n\ncd"),
        ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
        ("<table><tr><td colspan=2>wide cell<tr><td>x<td>y</table>", "wide cell\nx  y"),
        ("<table><tr><td>a<td>b<td>c<tr><td colspan=2>x<td>y</table>", "a  b  c\nx     y"),
        ('<a title="x" ">text</a> <a href=\'>\'>more</a>', "text more"),
        ("1 < 2 <3 </ x>&lt;b>", "1 < 2 <3 <b>"),
        ("<ul><li><ul><li>a<li>b</ul><li>c</ul>", "- - a\n  - b\n- c"),
        ("<ol><li>one<ul><li>in<p>par</ul><li>two</ol>end", "1. one\n   - in\n\n     par\n2. two\n\nend"),
        ("<ul><li></li><li>x</ul>", "- x"),
        ("seen <a href='no end of the tag", "seen"),
    ],
)
def test_layout(source, text):
    assert render(source) == text


HIDDEN = ["<script>{}</script>", "<style>{}</style>", "<span hidden>{}</span>", "<!-- {} -->",
          "<p style='display:none'>{}</p>", "<template><b>{}</b></template>", "<datalist><option>{}</datalist>"]
INLINE, BLOCK = ["b", "i", "span", "a"], ["div", "section", "blockquote", "article", "h2"]


def grow(draw, depth, words):
    """Source of a random tree; its visible words are added to ``words`` in order."""
    parts = []
    for _ in range(draw.randint(1, 4)):
        kind = draw.random()
        word = f"w{len(words)}x{draw.randrange(10**6)}"
        if depth == 0 or kind < 0.35:
            words.append(word)
            parts.append(f" {word} ")
        elif kind < 0.45:
            parts.append(draw.choice(HIDDEN).format(word))
        elif kind < 0.6:
            tag = draw.choice(INLINE)
            parts.append(f"<{tag} class='a > b'>{grow(draw, depth - 1, words)}</{tag.upper()}>")
        elif kind < 0.75:
            tag = draw.choice(BLOCK)
            parts.append(f"<{tag}>{grow(draw, depth - 1, words)}</{tag}>")
        elif kind < 0.87:  # items and paragraphs without their end tags
            tag = draw.choice(["ul", "ol"])
            items = "".join(f"<li>{grow(draw, depth - 1, words)}" for _ in range(draw.randint(1, 3)))
            parts.append(f"<{tag}>{items}</{tag}>")
        else:
            rows = "".join(
                "<tr>" + "".join(f"<td>{grow(draw, 0, words)}" for _ in range(draw.randint(1, 3)))
                for _ in range(draw.randint(1, 3))
            )
            parts.append(f"<table>{rows}</table>")
    return "".join(parts)


@pytest.mark.parametrize("seed", range(40))
def test_all_visible_words_and_no_others(seed):
    draw, words = random.Random(seed), []
    source = grow(draw, 5, words)
    found = [w for w in render(source).split() if w[0] == "w"]
    if "<table>" in source:  # rows are read across, so cells of several lines interleave
        assert sorted(found) == sorted(words)
    else:
        assert found == words
