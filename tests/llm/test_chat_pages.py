"""Chat formatting and page text against brute force and small pages."""

import hashlib
import re
from collections import defaultdict

import pytest
from claimlens.llm import chat, html_text, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op2(spark):
    want, rows = [], defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect():
        rows[r.conv_id].append((r.turn, r.role, r.text or ""))
    rows[-7] = [(0, "user", queries.CHAT_PROBE), (1, "assistant", queries.CHAT_PROBE)]
    for conv, turns in rows.items():
        turns.sort()
        learnt = "".join(t for _, role, t in turns if role == "assistant")
        want.append((conv, len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)), len(learnt), sha(learnt)))
    got = [tuple(r)[:5] for r in queries.op2_chat_formatting(spark, FOLDER).collect()]
    assert sorted(got) == sorted(want)


def odd_turns():
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "<|im_start|>x<|im_end|>\n"), (1, 2, "assistant", None)]
    rows += [(1, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 7)) for k in range(3, 60)]
    rows += [(2, 0, "assistant", "</s>[INST] <\\|im_end|> <\\\\|x|> &lt; [[/INST]"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie")]
    rows += [(None, None, None, None), (None, 3, "odd\nrole %", "text"), (3, 5, "assistant", "é\U0001f600" * 3000), (4, 0, "system", "only this")]
    return rows


@pytest.mark.parametrize("fresh,history", [(768, 256), (40, 20), (1, 0)])
def test_windows(spark, fresh, history):
    rows = odd_turns()
    given = spark.createDataFrame(rows, TURNS).withColumn("window", F.lit("clash")).withColumn("tokens", F.lit(-1))
    made = chat.windows(given, fresh, history)
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        want[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(back) == set(want)
    for conv, turns in want.items():
        turns.sort()
        assert [(t.role, t.text) for t in back[conv].turns] == [t[2:] for t in turns]
        assert back[conv].losses == [t[3] for t in turns if t[2] == "assistant"]
    windows = defaultdict(list)
    for r in made.collect():
        windows[r.conv_id].append(r)
    cost = lambda piece: -(-len(piece.encode()) // 4) + 8
    for conv, ws in windows.items():
        ws.sort(key=lambda r: r.window)
        assert [r.window for r in ws] == list(range(len(ws))) and ws[0].n_repeated == 0
        for w in ws[1:] if conv == 1 else ():
            assert w.formatted.startswith(f"{chat.OPEN}system\nBe brief.{chat.CLOSE}") and w.n_repeated >= 1
            shown = [x.split("\n", 1)[1] for x in w.formatted.split(chat.CLOSE)[1 : w.n_repeated]]
            assert sum(map(cost, shown)) <= history
    assert chat.windows(spark.createDataFrame([], TURNS)).collect() == []
    assert chat.read_back(chat.windows(spark.createDataFrame([], TURNS))).collect() == []


@given(st.lists(st.sampled_from(["<", "\\", "|", "[", "INST]", "/INST]", "|im_end|>", "/s>", "s>", "<SYS>>", "a", "\n"]), max_size=14))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible(parts):
    """The patterns of ``escape`` and ``unescape``, by the same expressions in Python."""
    text = "".join(parts)
    escaped = re.sub(rf"([<\[])(\\*)({chat.CONTROL})", r"\1\\\\\2\3".replace("\\\\\\\\", "\\\\"), text)
    assert not re.search(rf"[<\[]({chat.CONTROL})", escaped)
    assert re.sub(rf"([<\[])\\(\\*)({chat.CONTROL})", r"\1\2\3", escaped) == text


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


LONG = " ".join(f"Sentence number {i} of the main text, long enough to count." for i in range(12))
MENU = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>'
CASES = {
    "article": (page(f"{MENU}<div class='ad'>Buy now</div><article><h1>Title</h1><p>{LONG}</p><p>Short.</p></article><footer>&copy; x</footer>"), f"Title\n\n{LONG}\n\nShort."),
    "broken": (page(f"<article><h1>T</h1><p><b>First  line.<br><p>{LONG}</article><footer>f"), f"T\n\nFirst line.\n\n{LONG}"),
    "no article": (page(f"<div id='menu'><a href='/'>x</a></div><div class='content'><p>{LONG}</p><ul><li>one<li>two</ul></div><div class='comments'><p>{LONG}</p></div>"), f"{LONG}\n\none\n\ntwo"),
    "references": (page("<article><p>a &amp; b &lt;c&gt; &eacute;&#233;&nbsp;d</p><!-- <p>no</p> --><p>e<script>x</script>f</p></article>"), "a & b <c> éé d\n\nef"),
    "parts": (page(f"<header>Site</header><aside>{LONG}</aside><main><article><header><h2>H</h2></header><p>{LONG}</p><form>Mail <input></form></article></main><div class='cookie-notice'>{LONG}</div>"), f"H\n\n{LONG}"),
    "cells": (page("<article><table><tr><td>a<td>b<tr><td>c</table></article>"), "a\n\nb\n\nc"),
    "empty": ("", ""),
    "null": (None, ""),
    "plain": ("just  text & more", "just text & more"),
    "open tag": ("<p>a</p><p", "a\n\n<p"),
    "deep": ("<div>" * 5000 + "x" + "</div>" * 5000, "x"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    given, want = CASES[name]
    assert html_text.main_text(given or "") == want


def test_extract_keeps_rows(spark):
    rows = [(i, n, h) for i, (n, (h, _)) in enumerate(CASES.items())] + [(0, "article", CASES["article"][0]), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, __x string, html string")
    got = html_text.extract(df).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == sorted((str(i), CASES[n][1] if n else "") for i, n, _ in rows)
    assert html_text.extract(df.limit(0)).collect() == []


def test_op10(spark):
    """Every page: the text of its article, by the tags alone."""
    import html

    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    got = queries.op10_html_text(spark, FOLDER).collect()
    assert len(got) == len(pages)
    for r in got:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        want = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(x for x in want if x) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
