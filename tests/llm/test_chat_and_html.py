"""Chat formatting and HTML extraction."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import chat, html_text as H, queries
from lakestrata.llm.common import table

SF = "/root/testdata/sf0.01"
PIECES = st.sampled_from([*chat.CONTROL, "\\", " ", "\n", "x", "<", ">", "s>", "[", "]", "é", "🙂", *chat.PROBES])
TURNS = st.lists(st.tuples(
    st.sampled_from(["user", "assistant", "system", "tool", "", "a>>b", "r\\"]), st.lists(PIECES, max_size=6).map("".join)
), max_size=6)


@settings(max_examples=300, deadline=None)
@given(TURNS)
def test_round_trip_and_places(turns):
    output, spans, rewritten = chat.render(turns, chat.inst_template)
    assert rewritten is None and chat.read_back(output) == turns
    for (_, text), (start, end, low, high) in zip(turns, spans):
        assert start <= low <= high <= end and chat.unescaped(output[low:high]) == text
    assert [s[0] for s in spans[1:]] == [s[1] for s in spans[:-1]]
    for _, text in turns:
        assert not any(c in chat.escaped(text) for c in chat.CONTROL)


def only_last_answer(turns):
    last = max((k for k, (r, _) in enumerate(turns) if r == "assistant"), default=-1)
    return "".join(f"[{r}:{t if r != 'assistant' or k == last else ''}]" for k, (r, t) in enumerate(turns))


def test_templates_that_rewrite_history_are_detected():
    turns = [("user", "a"), ("assistant", "bcd"), ("user", "e"), ("assistant", "fg")]
    output, spans, rewritten = chat.render(turns, only_last_answer)
    assert rewritten == 3
    assert [output[s[2] : s[3]] for s in spans] == ["a", "", "e", "fg"]
    ends = lambda ts: "".join(t for _, t in ts) + "<end>"
    assert chat.render(turns, ends)[2] == 1  # the first turn's end mark has moved
    assert [ends(turns)[s[2] : s[3]] for s in chat.render(turns, ends)[1]] == ["a", "bcd", "e", "fg"]


def test_query_reads_back_every_conversation(spark):
    turns = defaultdict(list)
    for r in table(spark, SF, "conversations").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(t, role, text) for _, t, role, text in queries.CONTROL_CONVERSATION]
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rows = queries.op7_chat_formatting(spark, SF).collect()
    assert len(rows) == len(turns)
    for r in rows:
        own = sorted(turns[r["conv_id"]])
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), sha(said))
        assert (r["loss_chars"], r["loss_sha256"], r["rewritten_at"]) == (len(loss), sha(loss), None)


def test_odd_conversations(spark):
    rows = [(None, 0, "user", "x"), (None, 1, "assistant", None), (1, None, None, "n"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "assistant", "y" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert chat.read_back(out[None]["formatted"]) == [("user", "x"), ("assistant", "")]
    assert chat.read_back(out[1]["formatted"]) == [("", "n"), ("user", "a"), ("user", "a")]
    assert len(chat.loss_text(out[2]["formatted"], out[2]["roles"], out[2]["spans"])) == 200_000
    assert chat.format_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("html,text", [
    ("<p>a<p>b <b>c</b>d", "a\n\nb cd"),
    ("a<div>b</div>c<br>d", "a\nb\nc\nd"),
    ("<ul><li>x<li>y<ol start=3><li>q<li value=9>r</ol></ul>z", "- x\n- y\n  3. q\n  9. r\n\nz"),
    ("<table><tr><th>n<th>long name<tr><td>12<td>z<tr><td colspan=2>wide</table>", "n   long name\n12  z\nwide"),
    ("<table><caption>top</caption><tr><td>a<br>b<td>c</table>", "top\na  c\nb"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
    ("<pre>  a\n   b</pre>", "  a\n   b"),
    ("<head><title>t</title></head><body>x<script>if (a<b) '</p>'</script><style>p{}</style>y", "xy"),
    ("<p hidden>no</p><p style='DISPLAY : none'>no</p><div style='visibility:hidden'>no <p>no</div>yes", "yes"),
    ("<details><summary>s</summary>hid<p>hid</details><details open><summary>t</summary>seen</details>", "s\nt\nseen"),
    ("<dl><dt>term<dd>meaning<dt>two<dd>more</dl>", "term\n  meaning\ntwo\n  more"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("&lt;b&gt; &amp; &eacute; &#x41;", "<b> & é A"),
    ("a  \n\t b<!-- c --> <i> d</i>", "a b d"),
    ("</p></div><td>cell</td></table></li>x", "cell\n\nx"),
    ("", ""), ("   ", ""), ("<p", ""), ("<a href='x>y", ""),
    ("<table><tr><td>界<td>x<tr><td>ab<td>y</table>", "界  x\nab  y"),
])
def test_layout(html, text):
    assert H.page_text(html) == text


def test_deep_nesting_and_long_pages():
    assert H.page_text("<div>" * 30_000 + "deep") == "deep"
    assert H.page_text("<ul><li>" * 300 + "x").endswith("x")
    assert len(H.page_text("<p>word " * 20_000).split()) == 20_000


def visible_words(rng, depth=0):
    """A random page and its visible words, both from one description."""
    html, words = "", []
    for _ in range(rng.randint(1, 4)):
        roll = rng.random()
        if roll < 0.4 or depth > 4:
            word = f"w{rng.randrange(10**6)}"
            html += f" {word} "
            words.append(word)
        elif roll < 0.5:
            html += f"<{(t := rng.choice(['script', 'style']))}>gone{rng.randrange(99)}</{t}>"
        else:
            inner, own = visible_words(rng, depth + 1)
            tag = rng.choice(["div", "p", "span", "ul><li", "section", "b", "blockquote", "table><tr><td"])
            names = tag.split("><")
            # A block inside a paragraph ends it, and what is open in it.
            hidden = names[0] not in ("p", "b", "span") and rng.random() < 0.15
            html += f"<{names[0]}{' hidden' if hidden else ''}>" + "".join(f"<{n}>" for n in names[1:]) + inner
            html += "".join(f"</{n}>" for n in reversed(names))
            words += [] if hidden else own
    return html, words


def test_all_visible_words_in_order():
    rng = random.Random(3)
    for _ in range(400):
        html, words = visible_words(rng)
        found = [w.lstrip("-") for w in H.page_text(html).split() if w != "-"]
        assert found == words, html


def test_odd_pages(spark):
    rows = [(1, None, "u"), (2, "", "u"), (None, "<p>x", "u"), (3, "<b>y", "u"), (3, "<b>y", "u")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = H.extract(df)
    assert out.columns == ["page_id", "text"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([(1, ""), (2, ""), (None, "x"), (3, "y"), (3, "y")], key=repr)
    assert H.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("html, text", [
    ("Let <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math>, so", "Let E = m c 2, so"),
    ("<math><semantics><mi>x</mi><annotation>x_tex</annotation></semantics></math>", "x"),
    ("a<svg><title>no</title><style>no</style><path d='M0'/>no<defs><text>no</text></defs><text x=1>Sales <tspan>2024</tspan></text><text>Costs</text></svg>b", "a Sales 2024 Costs b"),
    ("<svg><foreignObject><p>inner</p></foreignObject></svg><svg/>after", "inner\n\nafter"),
    ("<svg style='display:none'><text>no</text></svg><svg><text/>no</svg>yes", "yes"),
    ("<input type=submit value='Send it'><input type=hidden value=no><input type=password value=no><input value=typed>", "Send it typed"),
    ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes<i>too</i></b> no<br>no</div>end", "yestoo\nend"),
    ("<div style='display:none'><b style='visibility:visible'>no</b></div><p style='backface-visibility:hidden'>yes", "yes"),
])
def test_formulas_drawings_fields_and_visible_descendants(html, text):
    assert H.page_text(html) == text
