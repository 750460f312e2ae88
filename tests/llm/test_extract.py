import html
import itertools
import re

import numpy as np
import pytest

from marketflow.llm import dom, extract
from marketflow.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return extract.train(labelled_pages())


def test_messages_give_the_exact_marginals():
    rng = np.random.default_rng(3)
    page = dom.parse("<body><nav><a href=x>l</a></nav><article><p>t <b>u</b></p></article></body>")
    f = extract.forest([page])
    any_model = extract.Model(rng.normal(size=extract.FEATURES), rng.normal(size=(extract.CHILD_KINDS, 2, 2)))
    n = len(f.parent)
    weights = {}
    for labels in itertools.product((0, 1), repeat=n):
        score = sum(f.x[k] @ any_model.node for k in range(n) if labels[k])
        score += sum(any_model.edge[f.kind[k], labels[f.parent[k]], labels[k]] for k in range(1, n))
        weights[labels] = np.exp(score)
    total = sum(weights.values())
    want = [sum(w for labels, w in weights.items() if labels[k]) / total for k in range(n)]
    assert np.allclose(any_model.content(f), want)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site"><a href="/">Press</a></header><div class="cookie-banner">We use cookies, please accept them all.</div>
<!-- <p>comment</p> --><article><h1>T &amp; U</h1><p>One  <i>two</i>
three&nbsp;four.<form><p>Sign up for letters</p><input></form><div class="advertisement"><p>Buy it now, it is cheap and good.</p></div>
<p>Five &lt; six.</article><section class="comments"><p>First! Nice text, thanks a lot.</p></section><aside>side</aside><footer>f</footer></body>"""


def test_a_page(model):
    assert extract.texts([PAGE], model) == ["T & U\nOne two three four.\nFive < six."]


def test_null_empty_cut_and_odd_pages(model):
    odd = [None, "", "plain", "<", "<article><p>Cut off in the mid", "<article><p>a</p", "</p></div>", "<article><p>x" + "<div>" * 100_000 + "deep</article>"]
    got = extract.texts(odd, model)
    assert got[:2] == ["", ""] and got[4] == "Cut off in the mid" and got[5] == "a" and len(got) == len(odd)


def test_held_out_pages(model):
    """Trained on some layouts, read on the others."""
    pages = labelled_pages()
    part = extract.train(pages[0::2])
    right = total = 0
    for page in pages[1::2]:
        parsed = dom.parse(page, "data-label")
        guess = part.content(extract.forest([parsed])) > 0.5
        labels = extract.labels_of(parsed) == 1
        right, total = right + int((guess == labels).sum()), total + len(labels)
    assert right / total > 0.9


def between(page):
    body = page[page.index("<article>") + 9 :]
    body = body[: body.index("</article>")]
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(line for line in lines if line)


def test_all_pages_of_the_table(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    raw = {r["page_id"]: r["html"] for r in pages.collect()}
    found = extract.main_text(pages.withColumn("text", pages["url"]), model).collect()
    assert len(found) == len(raw)
    for r in found:
        assert r["text"] == between(raw[r["page_id"]]) and r["n_chars"] == len(r["text"])
    assert extract.main_text(pages.limit(0), model).count() == 0


def pieces_of(page):
    return " ".join("".join(t for _, _, t in dom.parse(page).pieces).split())


def test_only_scripts_styles_and_forms_are_hidden(model):
    text = "The river carried the boats past the old mill, and the miller waved to the people on them until they were gone."
    for page in (
        f"<head><title>T</title><article><p>{text}</p></article>", f"<html><head><title>T</title><style>p{{}}</style><p>{text}",
        f"<head><meta charset=utf-8><noscript><link rel=x></noscript>{text}", f"<head><title>T</title></head><body>{text}",
        f"<article><form><select><option>a</form><p>{text}</p></article>", f"<article><select><option>a<option>b<p>{text}</p></article>",
        f"<article><svg><path d=x><p>{text}</p></article>", f"<article><canvas><p>{text}</p></article>", f"<article><noscript><p>{text}</p></noscript></article>",
        f"<article><object data=x><p>{text}</p></article>", f"<article><p>{text}</p><script>var a</script><textarea>b</textarea></article>",
    ):
        assert pieces_of(page) == text, page
    assert pieces_of("<p>so <math><mi>a</mi></math> is") == "so a is"
    page = f"<head><title>T</title><article><p>{text}</p><p>{text}</p></article>"
    assert extract.texts([page], model)[0].split() == (text + " " + text).split()
