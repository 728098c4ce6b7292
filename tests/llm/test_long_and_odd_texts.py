"""Very long blanks, spaced letters, odd letters, and class names that only look like hidden ones."""

import time

import numpy as np
import pytest

from gazette.llm import html_extract, packing, toxicity


@pytest.mark.parametrize("n", [1_000_000, 5_000_000])
def test_runs_of_blanks_have_the_tokenizers_ids(n):
    text = "a " + " " * n + "b"
    ids = packing.token_ids(text)
    assert ids[-1] == 1 and packing._tokenizer("byte_bpe_50k").decode(ids[:-1].tolist()) == text
    short = " " * 5_000 + "x"
    assert packing.token_ids(short)[:-1].tolist() == packing._tokenizer("byte_bpe_50k").encode(short, add_special_tokens=False).ids


def test_packing_of_a_long_blank_text(spark):
    df = spark.createDataFrame([(1, " " * 1_200_000), (2, "word " * 10), (3, None)], "doc_id long, text string")
    got = packing.pack(df).collect()
    assert {r.doc_id for r in got} == {1, 2, 3}
    for i in (1, 2, 3):
        mine = sorted((r.start, r.length) for r in got if r.doc_id == i)
        assert sum(n for _, n in mine) == next(r.doc_tokens for r in got if r.doc_id == i)


@pytest.fixture(scope="module")
def channel():
    text = "the moron said that you are an idiot and the house of light is a small as an ass moron stupid trash or gone north " * 20
    return toxicity.Channel(dict(zip(*(x.tolist() for x in np.unique(toxicity.trigram_codes(text), return_counts=True)), strict=True)))


def test_long_spaced_runs_take_linear_time(channel):
    began = time.time()
    channel.words("a b " * 4_000)
    first = time.time() - began
    began = time.time()
    channel.words("a b " * 50_000)  # 100,000 letters
    assert time.time() - began < max(4.0, 40 * first)


@pytest.mark.parametrize("written", ["id10t", "1d10t", "idіot", "ídìôt", "ｉｄｉｏｔ", "i d i o t", "!di0t"])
def test_odd_letters_are_restored(channel, written):
    assert "idiot" in channel.words(f"the {written} said")


def test_short_tokens_are_decoded(channel):
    assert "as" in channel.words("@$ light")
    assert channel.words("") == set() and channel.words(None) == set()


@pytest.mark.parametrize("start, end", [
    ('<body class="overflow-x-hidden"><article>', "</article></body>"), ('<main class="relative overflow-hidden">', "</main>"),
    ('<body><div class="not-hidden"><article>', "</article></div></body>"), ('<article class="hidden-sm" id="hidden-part">', "</article>"), ('<article style="overflow:hidden">', "</article>"),
])
def test_class_names_do_not_hide_a_page(spark, start, end):
    page = f"<html>{start}<h1>Head</h1><p>One two three four five.</p><p>Six seven eight nine ten.</p>{end}</html>"
    unseen = "".join(f"<p {x}>Not shown.</p>" for x in ("hidden", 'aria-hidden="true"', 'style="display: none"'))
    df = spark.createDataFrame([(1, "u", page), (2, "u", page.replace("<p>Six", unseen + "<p>Six"))], "page_id long, url string, html string")
    assert {r.text for r in html_extract.extract(df).collect()} == {"Head One two three four five. Six seven eight nine ten."}


def test_share_of_main_text_at_the_edges_of_its_meaning():
    """Where the likeliest text is at 0.02 or 0.5 a probability is itself; between, it is that given that the page has some."""
    tree = html_extract.Tree("<div><p>Text here.</p></div>")
    model = html_extract.Model({})
    seen = html_extract.observed(tree)
    plain, _ = model.passed(tree, seen)
    texts = [x for x, t in zip(plain, tree.tag, strict=True) if t == "#"]
    out = [x for x, t in zip(model.marginals(tree), tree.tag, strict=True) if t == "#"]
    assert (out == texts) == (not 0.02 < max(texts) < 0.5) and all(0 <= a <= b <= 1 for a, b in zip(texts, out, strict=True))
