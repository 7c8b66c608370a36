"""Pages without an article element: what the cut keeps, against the words that the page was made of."""

import random

import pytest

from ledgerloom.llm import html

P = "A paragraph of some seventy-five characters that ends as sentences do here."
LINKS = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(3)) + "</ul>"
ONE = "<ul><li><a href=/x>More about it</a></li></ul>"


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<body>{LINKS}" + f"<p>{P}</p>" * 3, [P] * 3),
        (f"<body><p>{P}</p>{ONE}", [P]),
        (f"<body>" + f"<p>{P}</p>{ONE}" * 5, [P] * 5),
        (f"<body>" + f"<p>{P}</p>{ONE}" * 2000, [P] * 2000),
        (f"<body><div id=nav>Home News</div><div>{P}</div><div class=footer>Imprint</div>", [P]),
        ("<body><form action=x.aspx>" + f"<p>{P}</p>" * 8 + "</form>", [P] * 8),
        (f"<body><p>{P}</p><p>{P}</p><form><label>Your name</label><input><button>Send</button></form>", [P] * 2),
        (f"<body><p>{P}</p><p>{P}</p><div class='reader-comments'><p>{P} I agree.</p></div><div class='col-sidebar'><p>{P}</p></div>", [P] * 2),
        (f"<body><div class='has-sidebar'><p>{P}</p><p>Yes.</p><p>{P}</p></div><div class='article-comments'><p>{P}</p></div>", [P, "Yes.", P]),
        (f"<article><p>{P}</p>{ONE}</article><p>{P}</p>", [P, "More about it"]),
    ],
)
def test_pages_measured_before(page, want):
    assert html.main_text(page).split("\n") == want


def made(rng):
    """A page of sections in random wrappers, and its article's blocks."""
    words = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split()) for _ in range(n))
    text, parts = [], []
    links = lambda n: "<ul>" + "".join(f"<li><a href=/{i}>{words(rng.randrange(1, 4))}</a></li>" for i in range(n)) + "</ul>"
    parts.append(rng.choice([f"<nav>{links(6)}</nav>", f"<div class=top-menu>{links(5)}</div>", links(7), ""]))
    body = []
    for _ in range(rng.randrange(3, 15)):
        t = words(rng.randrange(12, 60)).capitalize() + "."
        text.append(t)
        body.append(f"<p>{t}</p>")
        if rng.random() < 0.3:
            body.append(rng.choice([links(rng.randrange(1, 4)), f"<div class=ad-box>{words(8)}</div>", f"<p>{words(1)}</p>" if False else ""]))
    wrap = rng.choice(["<div>{}</div>", "<div class=page><div>{}</div></div>", "<section>{}</section>", "<form action=d.aspx>{}</form>" if len(text) > 6 else "{}", "{}"])
    parts.append(wrap.format("".join(body)))
    parts.append(rng.choice([f"<div class=user-comments><p>{words(20)}.</p></div>", f"<div id=post-comments><p>{words(30)}.</p></div>", ""]))
    parts.append(rng.choice([f"<footer><p>{words(6)}</p></footer>", f"<div class=site-footer>{words(9)}</div>", f"<form>{words(3)}<input></form>"]))
    return f"<html><body>{''.join(parts)}</body></html>", text


def overlap(got, want):
    from collections import Counter

    a, b = Counter(got.split()), Counter(" ".join(want).split())
    return sum((a & b).values()), sum(a.values()), sum(b.values())


def test_made_pages_keep_their_words():
    rng = random.Random(11)
    hit = kept = true = 0
    differs = {"texts alone": 0, "tags alone": 0}
    for _ in range(400):
        page, text = made(rng)
        got = html.main_text(page)
        h, k, t = overlap(got, text)
        hit, kept, true = hit + h, kept + k, true + t
        elements, blocks = html.blocks_of(page)
        differs["texts alone"] += got != "\n".join(b.text for b in blocks if html.log_odds(b, elements[b.element].tag) > 0)

        def bad(e):
            while e:
                if elements[e].says == -1.0:
                    return True
                e = elements[e].parent
            return False

        differs["tags alone"] += got != "\n".join(b.text for b in blocks if not bad(b.element))
    assert hit / true > 0.95 and hit / kept > 0.95
    assert min(differs.values()) > 40
