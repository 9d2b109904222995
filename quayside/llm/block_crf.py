"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

Every block has ancestor-tag and text features; the model weighs them and the
change of label from block to block. It is trained on labelled pages by
gradient steps on the exact likelihood (forward-backward in numpy, all pages at
once) and decoded by Viterbi in each task.

Two kinds of labelled pages are used. The first are laid out here, in the ways
pages commonly mark menus, notices, adverts, forms and reader comments. The
second are pages of the table itself that name their article, as many as
``SAMPLE``: blocks inside the article are main text, all others are not.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import hash_bound
from quayside.llm.page_blocks import Block, Place, blocks

#: Pages of the table that are looked at for training, and the longest of them in characters.
SAMPLE = 200
LONGEST = 20_000
LAYOUTS = 240
STEPS = 150
PENALTY = 0.02

_ROLES = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs toc pagination pager tabs",
    "top": "header masthead topbar banner logo branding skip",
    "bottom": "footer foot copyright colophon legal",
    "side": "sidebar aside side rail widget widgets related recommended trending popular more",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay subscribe newsletter paywall promo",
    "advert": "ad ads advert advertisement sponsor sponsored dfp adsense banner",
    "form": "form search login signup signin register input",
    "comment": "comment comments reply replies respond disqus discussion feedback reviews",
    "share": "share social sharing follow",
    "main": "article post content main body entry story text prose markdown hentry",
}
_ROLE_OF = {word: role for role, words in _ROLES.items() for word in words.split()}
_ROLE_TAGS = {"nav": "menu", "footer": "bottom", "aside": "side", "form": "form", "button": "form", "dialog": "notice",
              "title": "head", "menu": "menu", "search": "form", "label": "form", "fieldset": "form"}


_SURROUNDINGS: dict[tuple, list[str]] = {}


def surroundings(place: Place) -> list[str]:
    """Features of a place in the page: its ancestors and their roles."""
    key = place.tag, place.inside, place.named
    if key not in _SURROUNDINGS:
        if len(_SURROUNDINGS) > 10_000:
            _SURROUNDINGS.clear()
        _SURROUNDINGS[key] = _surroundings(place)
    return _SURROUNDINGS[key]


def _surroundings(place: Place) -> list[str]:
    tags = place.inside
    roles = {_ROLE_OF[name] for name in place.named if name in _ROLE_OF}
    roles |= {_ROLE_TAGS[tag] for tag in tags if tag in _ROLE_TAGS}
    found = ["bias", f"tag={place.tag}"]
    found += [f"in={tag}" for tag in sorted(tags) if tag not in ("html", "body")]
    found += [f"role={role}" for role in sorted(roles)]
    # The words of classes, ids and roles themselves: a page tells the model names that no list holds.
    found += [f"named={name}" for name in sorted(place.named)]
    apart = roles - {"main"}
    if "article" in tags or "main" in tags or "main" in roles:
        found.append("marked-and-apart" if apart else "marked")
    if apart:
        found.append("apart")
    if "header" in tags:
        found.append("header-of-article" if "article" in tags or "main" in tags else "header-of-page")
    return found


def features(block: Block, at: int, n: int) -> list[str]:
    """Names of what holds for a block: its place, and its text."""
    text = block.text
    words = text.count(" ") + 1
    share = block.link_chars / len(text)
    found = [
        *surroundings(block.place),
        f"words={min(words.bit_length(), 6)}",
        "linked=" + ("none" if not share else "some" if share < 0.5 else "most"),
        "ends=" + ("stop" if text[-1] in ".!?…。\"')" else "open"),
    ]
    if "©" in text or "(c)" in text or "(C)" in text:
        found.append("copyright")
    if at == 0 or at == n - 1:
        found.append("first" if at == 0 else "last")
    return found


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _expected(scores: np.ndarray, change: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the labels and of the pairs of labels, by forward and backward sums."""
    pages, longest, _ = scores.shape
    forward, backward = np.zeros_like(scores), np.zeros_like(scores)
    forward[:, 0] = scores[:, 0]
    for j in range(1, longest):
        moved = _log_sum(forward[:, j - 1, :, None] + change, 1) + scores[:, j]
        forward[:, j] = np.where(there[:, j, None], moved, forward[:, j - 1])
    for j in range(longest - 2, -1, -1):
        moved = _log_sum(change + (scores[:, j + 1] + backward[:, j + 1])[:, None, :], 2)
        backward[:, j] = np.where(there[:, j + 1, None], moved, 0)
    total = _log_sum(forward[:, -1], 1)
    single = np.exp(forward + backward - total[:, None, None]) * there[:, :, None]
    pairs = np.exp(
        forward[:, :-1, :, None] + change + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]
    ) * there[:, 1:, None, None]
    return single, pairs.sum(axis=(0, 1))


class Model:
    """Weights of the features for main text, and of the changes of label."""

    def __init__(self, weights: dict[str, float], change: list[list[float]]):
        self.weights, self.change = weights, change

    def labels(self, page: list[list[str]]) -> list[bool]:
        """The likeliest labels of a page's blocks (Viterbi)."""
        weights, change = self.weights, self.change
        best, back = [0.0, 0.0], []
        for j, names in enumerate(page):
            score = sum(weights.get(name, 0.0) for name in names)
            if j:
                came = [max((0, 1), key=lambda a, b=b: best[a] + change[a][b]) for b in (0, 1)]
                best = [best[came[b]] + change[came[b]][b] for b in (0, 1)]
                back.append(came)
            best[1] += score
        label = int(best[1] > best[0]) if page else 0
        found = [label] if page else []
        for came in reversed(back):
            label = came[label]
            found.append(label)
        return [bool(x) for x in reversed(found)]


def fitted(pages: list[tuple[list[list[str]], list[bool]]], steps: int = STEPS) -> Model:
    """Maximise the likelihood of the labels, less a penalty on large weights (Adam on the whole set)."""
    pages = [page for page in pages if page[0]]
    index = {name: i for i, name in enumerate(sorted({n for page, _ in pages for names in page for n in names}))}
    there = np.zeros((len(pages), max(len(labels) for _, labels in pages)), dtype=bool)
    y = np.zeros(there.shape, dtype=bool)
    block, feature = [], []
    for i, (page, labels) in enumerate(pages):
        there[i, : len(labels)] = True
        y[i, : len(labels)] = labels
        for j, names in enumerate(page):
            block += [i * there.shape[1] + j] * len(names)
            feature += [index[name] for name in names]
    block, feature = np.array(block), np.array(feature)
    both = there[:, 1:]
    seen = np.array([[(both & (y[:, :-1] == a) & (y[:, 1:] == b)).sum() for b in (False, True)] for a in (False, True)])
    weights, change = np.zeros(len(index)), np.zeros((2, 2))
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(change), np.zeros_like(change)]
    for step in range(1, steps + 1):
        scores = np.zeros((*there.shape, 2))
        scores[:, :, 1] = np.bincount(block, weights[feature], there.size).reshape(there.shape)
        single, pairs = _expected(scores, change, there)
        left = (y - single[:, :, 1]).ravel()
        by_weight = np.bincount(feature, left[block], len(index)) - PENALTY * len(pages) * weights
        by_change = seen - pairs - PENALTY * len(pages) * change
        for value, by, m, v in ((weights, by_weight, *moments[:2]), (change, by_change, *moments[2:])):
            m += 0.1 * (by - m)
            v += 0.01 * (by * by - v)
            value += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model({name: float(weights[i]) for name, i in index.items()}, change.tolist())


def _sentence(words: random.Random, least: int, most: int) -> str:
    found = ["".join(words.choice("aeioulnrstdm") for _ in range(words.randint(2, 9))) for _ in range(words.randint(least, most))]
    return " ".join(found).capitalize() + words.choice((".", ".", ".", "!", "?"))


def _laid_out(words: random.Random) -> tuple[str, str]:
    """A page in one of many layouts, and the texts of its main blocks, one a line."""

    def short() -> str:
        return _sentence(words, 1, 3)[:-1]

    def prose() -> str:
        return " ".join(_sentence(words, 3, 14) for _ in range(words.randint(1, 5)))

    def items(n: int, linked: bool = True) -> str:
        return "".join(f"<li><a href='/x'>{short()}</a></li>" if linked else f"<li>{short()}</li>" for _ in range(n))

    main: list[str] = []

    def told(open_: str, text: str, close: str) -> str:
        main.append(text)
        return f"{open_}{text}{close}"

    def body() -> str:
        out = [told("<h1>", short(), "</h1>")]
        for _ in range(words.randint(1, 9)):
            kind = words.random()
            if kind < 0.62:
                out.append(told(words.choice(("<p>", "<p>", "<p class='text'>", "<div>")), prose(), words.choice(("</p>", ""))).replace("<div>", "<p>"))
            elif kind < 0.72:
                out.append(told("<h2>", short(), "</h2>"))
            elif kind < 0.80:
                out.append("<ul>" + "".join(told("<li>", _sentence(words, 2, 9), "</li>") for _ in range(3)) + "</ul>")
            elif kind < 0.86:
                out.append(told("<blockquote><p>", prose(), "</p></blockquote>"))
            elif kind < 0.90:
                out.append("<table><tr>" + told("<td>", short(), "</td>") + told("<td>", short(), "</td>") + "</tr></table>")
            elif kind < 0.94:
                out.append(told("<pre>", _sentence(words, 3, 9), "</pre>"))
            else:
                out.append(f"<div class='{words.choice(('ad', 'advert', 'sponsored', 'share', 'related', 'newsletter'))}'>{prose()}</div>")
        return "".join(out)

    menu = words.choice((
        f"<nav><ul>{items(5)}</ul></nav>", f"<div class='menu'><ul>{items(4)}</ul></div>",
        f"<ul id='navbar'>{items(6)}</ul>", f"<div class='breadcrumb'><a href='/'>{short()}</a> / {short()}</div>", "",
    ))
    top = words.choice((
        f"<header><div class='logo'>{short()}</div><p>{_sentence(words, 2, 8)}</p></header>",
        f"<div id='header'><h1>{short()}</h1><p>{_sentence(words, 3, 9)}</p></div>", f"<header>{menu}</header>", "",
    ))
    notice = words.choice((
        f"<div class='cookie-notice'><p>{prose()}</p><button>{short()}</button></div>",
        f"<div role='alert' class='notice'>{prose()}</div>", f"<div id='consent'><p>{prose()}</p></div>", "", "",
    ))
    advert = words.choice((
        f"<div class='ad'>{prose()}</div>", f"<div class='advertisement'><p>{prose()}</p></div>",
        f"<section id='sponsored'><p>{prose()}</p></section>", f"<aside class='promo'><p>{prose()}</p></aside>", "",
    ))
    side = words.choice((
        f"<aside><h3>{short()}</h3><p>{prose()}</p></aside>", f"<div class='sidebar'><ul>{items(5)}</ul><p>{prose()}</p></div>",
        f"<div id='related'><h3>{short()}</h3><ul>{items(3)}</ul></div>", "",
    ))
    form = words.choice((
        f"<form><label>{short()}</label><input name='q'><button>{short()}</button><p>{_sentence(words, 3, 9)}</p></form>",
        f"<div class='newsletter'><p>{prose()}</p><form><input></form></div>", f"<div class='login-form'><p>{_sentence(words, 3, 8)}</p></div>", "", "",
    ))
    remarks = "".join(f"<div class='comment'><b>{short()}</b><p>{prose()}</p></div>" for _ in range(words.randint(1, 4)))
    comments = words.choice((
        f"<section id='comments'><h3>{short()}</h3>{remarks}</section>", f"<div class='comments'>{remarks}</div>",
        f"<ol class='replies'><li><p>{prose()}</p></li><li><p>{prose()}</p></li></ol>", "", "",
    ))
    bottom = words.choice((
        f"<footer>&copy; {short()} &middot; {_sentence(words, 3, 9)}</footer>", f"<div id='footer'><p>{prose()}</p></div>",
        f"<footer><ul>{items(4)}</ul><p>{_sentence(words, 3, 9)}</p></footer>", "",
    ))
    opened, closed = words.choice((
        ("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"),
        ("<div class='post-content'>", "</div>"), ("<div id='content'>", "</div>"), ("<div class='entry'>", "</div>"),
        ("<section class='story'>", "</section>"), ("<div>", "</div>"),
    ))
    inner = words.choice(("", "", advert, form, comments))
    around = [top, menu, notice, advert if inner is not advert else ""]
    words.shuffle(around)
    after = [side, form if inner is not form else "", comments if inner is not comments else "", bottom]
    page = f"<html><head><title>{short()}</title></head><body>{''.join(around)}{opened}{body()}{inner}{closed}{''.join(after)}"
    return page + words.choice(("</body></html>", "")), "\n".join(main)


def laid_out_pages(n: int = LAYOUTS, seed: int = 5) -> list[tuple[str, str]]:
    words = random.Random(seed)
    return [_laid_out(words) for _ in range(n)]


def described(html: str | None) -> tuple[list[str], list[list[str]]]:
    found = blocks(html)
    return [b.text for b in found], [features(b, at, len(found)) for at, b in enumerate(found)]


def _labelled(html: str, main: str) -> tuple[list[list[str]], list[bool]]:
    """Label the blocks whose texts are the main texts, in their order."""
    texts, page = described(html)
    left, labels = main.split("\n"), []
    for text in texts:
        labels.append(bool(left) and text == left[0])
        if labels[-1]:
            left.pop(0)
    return page, labels


def _self_labelled(html: str) -> tuple[list[list[str]], list[bool]] | None:
    """Labels of a page that names its article; none if it doesn't."""
    found = blocks(html)
    inside = [bool({"article", "main"} & b.place.inside) for b in found]
    if not any(inside):
        return None
    page = [features(b, at, len(found)) for at, b in enumerate(found)]
    return page, [x and "apart" not in names for x, names in zip(inside, page, strict=True)]


def learned(pages: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of the laid-out pages and about ``sample`` pages of the table, chosen by a hash of the whole row.

    What comes to the driver is bounded by ``sample`` and ``LONGEST``. Null and
    empty pages teach nothing; copies of a page are one.
    """
    known = pages.select(F.col("html").alias("html")).where(F.char_length("html").between(1, LONGEST))
    chosen = known.where(F.xxhash64("html") <= F.lit(hash_bound(sample, known.count())))
    taught = [_labelled(html, main) for html, main in laid_out_pages()]
    own = sorted({row["html"] for row in chosen.distinct().limit(4 * sample).collect()})
    taught += [x for x in map(_self_labelled, own) if x]
    return fitted(taught)


def extracted(spark: SparkSession, pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars, n_blocks, n_main)`` of every page.

    Null and empty pages, and pages without main text, have the empty text.
    Rows that repeat are extracted one by one.
    """
    held = spark.sparkContext.broadcast((lambda m: (m.weights, m.change))(model or learned(pages)))

    def main_text(htmls: pa.Array) -> pa.Array:
        known = Model(*held.value)
        texts, n_blocks, n_main = [], [], []
        for html in htmls.to_pylist():
            parts, page = described(html)
            main = [text for text, label in zip(parts, known.labels(page), strict=True) if label]
            texts.append("\n".join(main))
            n_blocks.append(len(parts))
            n_main.append(len(main))
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.string()), pa.array(n_blocks, pa.int64()), pa.array(n_main, pa.int64())],
            names=["text", "n_blocks", "n_main"],
        )

    take = F.arrow_udf(main_text, "text string, n_blocks long, n_main long").asNondeterministic()
    return pages.select(
        F.col("page_id").alias("page_id"), F.col("url").alias("url"), take(F.col("html")).alias("m")
    ).select(
        "page_id", "url", F.col("m.text").alias("text"), F.char_length("m.text").cast("long").alias("n_chars"),
        F.col("m.n_blocks").alias("n_blocks"), F.col("m.n_main").alias("n_main"),
    )
