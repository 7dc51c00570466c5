"""Main text of pages by boosted trees over DOM nodes, decoded along the hierarchy.

Every block node gets a score from its features. A node can only be kept if its
parent is: of all such choices the one with the greatest total score is taken, so
an article isn't kept inside a dropped container nor a menu dropped with an item
kept. A kept node's own text is written, in page order.

The trees are fitted on a bounded sample of the table's own different pages that name
their main text (text in an article or main element). Each such page also appears in other
layouts: its blocks of main text, marked, among menus, notices, adverts, forms,
comments and the like, in elements with other names. So the trees learn what
nodes are like, not one template.
"""

import html
import pickle
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import boosting, dom


@dataclass(frozen=True)
class Settings:
    """``pages``: most pages fitted on, of at most ``page_bytes`` each; ``layouts``
    more of each are made, and ``altered`` copies with other text in them."""

    pages: int = 150
    page_bytes: int = 65_536
    layouts: int = 2
    altered: int = 3
    seed: int = 7
    trees: boosting.Settings = field(default_factory=boosting.Settings)


MAIN = {dom.TAG_ID["article"], dom.TAG_ID["main"]}
BOILERPLATE = sum(1 << b for b in range(1, len(dom.GROUPS) - 1))


def named_main_text(page: dom.Page) -> list[int] | None:
    """Labels by node for a page with an article or main element, else None."""
    labels, found = [0] * len(page.tag), False
    for k in range(1, len(page.tag)):
        up = page.parent[k]
        inside = labels[up] or page.tag[k] in MAIN
        labels[k] = int(bool(inside) and not page.own[k] & BOILERPLATE)
        found |= page.tag[k] in MAIN
    return _with_ancestors(page, labels) if found else None


def _with_ancestors(page: dom.Page, labels: list[int]) -> list[int]:
    for k in range(len(labels) - 1, 0, -1):
        if labels[k]:
            labels[page.parent[k]] = 1
    return labels


def _wrap(tag: str, names: list[str], inner: str, rng: random.Random, mark: bool = False) -> str:
    name = rng.choice(names) if names else ""
    attribute = f' {rng.choice(("class", "id"))}="{name}"' if name else ""
    return f"<{tag}{attribute}{' data-keep=1' if mark else ''}>{inner}</{tag}>"


def layout(texts: list[str], others: list[str], rng: random.Random) -> str:
    """A page with ``texts`` as its marked main text and ``others`` around it."""

    def words(low, high):
        chosen = rng.choice(others).split() or ["x"]
        start = rng.randrange(len(chosen))
        return html.escape(" ".join(chosen[start : start + rng.randint(low, high)]))

    def link(low=1, high=3):
        return f'<a href="/{rng.random()}">{words(low, high)}</a>'

    def items(count):
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(count)) + "</ul>"

    def paragraph(low, high):
        return f"<p>{words(low, high)}</p>"

    def menu():
        tag, names = rng.choice((("nav", []), ("nav", ["main-nav"]), ("div", ["menu", "nav", "navbar", "top-menu", "breadcrumb"]), ("ul", ["menu"])))
        return _wrap(tag, names, items(rng.randint(3, 9)), rng)

    def head():
        tag, names = rng.choice((("header", []), ("div", ["header", "masthead", "site-header", "top"])))
        return _wrap(tag, names, f"<div>{link()}</div>" + rng.choice(("", paragraph(3, 12), menu())), rng)

    def side():
        tag, names = rng.choice((("aside", []), ("aside", ["sidebar"]), ("div", ["sidebar", "related", "widget", "side", "popular-posts"])))
        inner = f"<h3>{words(1, 3)}</h3>" + rng.choice((items(rng.randint(3, 7)), paragraph(8, 40), paragraph(8, 30) * 2))
        return _wrap(tag, names, inner, rng)

    def notice():
        return _wrap("div", ["cookie-notice", "notice", "cookies", "consent", "alert", "gdpr", "popup", "modal", "disclaimer"],
                     rng.choice((paragraph(6, 40), words(6, 30) + link())), rng)

    def advert():
        return _wrap(rng.choice(("div", "div", "section", "p")), ["ad", "ads", "advert", "advertisement", "sponsored", "promo"],
                     rng.choice((words(3, 40), paragraph(5, 40), link(2, 6))), rng)

    def blank():
        return f"<form><p>{words(2, 8)}</p><input name=q></form>" if rng.random() < 0.6 else _wrap(
            "div", ["newsletter", "search", "login", "subscribe", "signup"], paragraph(3, 20), rng
        )

    def comments():
        one = [
            _wrap(rng.choice(("div", "li", "article", "p")), ["comment", "reply", "comment-body"], rng.choice((paragraph(5, 90), words(5, 60))), rng)
            for _ in range(rng.randint(1, 5))
        ]
        return _wrap(rng.choice(("section", "div", "ol")), ["comments", "comment-list", "replies", "discussion", "reader-comments"],
                     f"<h3>{words(1, 3)}</h3>" + "".join(one), rng)

    def foot():
        tag, names = rng.choice((("footer", []), ("div", ["footer", "site-footer", "copyright", "legal"])))
        return _wrap(tag, names, rng.choice((f"&copy; {words(1, 4)}", paragraph(3, 25) + items(4), f"<p>&copy; {words(2, 10)}</p>")), rng)

    def share():
        return _wrap("div", ["share", "social", "share-buttons", "tags"], items(rng.randint(2, 4)), rng)

    body = []
    for k, text in enumerate(texts):
        text = html.escape(text)
        if k == 0 and rng.random() < 0.8:
            body.append(_wrap(rng.choice(("h1", "h1", "h2")), rng.choice(([], ["title", "headline"])), text, rng, True))
            continue
        kind = rng.random()
        if kind < 0.74:
            split = text.split(" ")
            if len(split) > 12 and rng.random() < 0.3:
                at = rng.randrange(len(split) - 3)
                split[at] = f'<a href="/x">{split[at]}'
                split[at + 2] += "</a>"
            body.append(_wrap("p", [], " ".join(split), rng, True))
        elif kind < 0.80:
            body.append(f"<ul data-keep=1><li>{text}</li></ul>")
        elif kind < 0.84:
            body.append(f"<blockquote data-keep=1><p>{text}</p></blockquote>")
        elif kind < 0.88:
            body.append(_wrap(rng.choice(("h2", "h3")), [], text, rng, True))
        elif kind < 0.92:
            body.append(f"<table data-keep=1><tr><td>{text}</td><td>{words(1, 3)}</td></tr></table>")
        else:
            body.append(_wrap("div", [], text, rng, True))
        if rng.random() < 0.06:
            body.append(rng.choice((advert, side, share, notice, blank))())
    tag, names = rng.choice((
        ("article", []), ("main", []), ("div", ["content", "post", "entry-content", "article-body", "story", "page-content"]),
        ("div", []), ("section", ["content", "story"]), ("div", ["wrapper"]),
    ))
    ending = [f() for f in (share, comments, side, blank) if rng.random() < 0.35]
    inside = rng.random() < 0.4
    main = _wrap(tag, names, "".join(body) + ("".join(ending) if inside else ""), rng)
    if rng.random() < 0.4:
        main = _wrap("div", rng.choice(([], ["container"], ["wrap"])), main, rng)
    before = [f() for f in (notice, head, menu, advert, side, blank) if rng.random() < 0.5]
    rng.shuffle(before)
    after = ([] if inside else ending) + [f() for f in (comments, advert, side, notice, foot) if rng.random() < 0.5]
    return "<html><head><title>x</title></head><body>" + "".join([*before, main, *after]) + "</body></html>"


def altered(source: str, rng: random.Random) -> str:
    """The same page with other text: short, of one repeated word, or cut off."""
    kind = rng.randrange(3)
    if kind == 2:
        return source[: rng.randint(len(source) // 3, len(source))]

    def text(found):
        words = found[1].split() or ["x"]
        if kind == 0:
            return f">{' '.join(words[: rng.randint(1, 4)])}<"
        return f">{' '.join([rng.choice(words)] * rng.randint(1, 60))}<"

    return re.sub(r">([^<>]{2,})<", text, source)


def fit_trees(sources: list[str], settings: Settings) -> boosting.Trees | None:
    """None if no page names its main text."""
    rng = random.Random(settings.seed)
    pages, labels, texts, others = [], [], [], []
    for source in sources:
        for k in range(1 + settings.altered):
            page = dom.parse(altered(source, rng) if k else source)
            named = named_main_text(page)
            if named is None:
                continue
            pages.append(page)
            labels.extend(named)
            main = [text for node, text, _ in page.blocks if named[node]]
            if k < 2:
                texts.append(main)
                others.extend(text for node, text, _ in page.blocks if not named[node])
                others.extend(main[-2:])
    if not any(texts):
        return None
    for main in texts:
        for _ in range(settings.layouts if main else 0):
            page = dom.parse(layout(main, others, rng))
            pages.append(page)
            labels.extend(_with_ancestors(page, list(page.marked)))
    return boosting.fit(dom.features(pages), np.array(labels, float), settings.trees)


def kept_nodes(page: dom.Page, scores: list[float]) -> list[bool]:
    """The nodes of greatest total score, each with its parent."""
    best = list(scores)
    for k in range(len(best) - 1, 0, -1):
        if best[k] > 0:
            best[page.parent[k]] += best[k]
    kept = [best[0] > 0] * len(best)
    for k in range(1, len(best)):
        kept[k] = best[k] > 0 and kept[page.parent[k]]
    return kept


def _names_main_text(sources: pa.Array) -> pa.Array:
    """Whether each page has a block of text labelled as main text."""
    found = []
    for source in sources.to_pylist():
        page = dom.parse(source)
        labels = named_main_text(page)
        found.append(labels is not None and any(labels[node] for node, _, _ in page.blocks))
    return pa.array(found, pa.bool_())


def fit(pages: DataFrame, settings: Settings = Settings()) -> boosting.Trees | None:
    """Fit on a bounded sample of column ``html``: of the pages that name their main
    text, copies counted once, those with the least hashes.

    The sample goes to one task, which returns the trees; None if no page of at most
    ``page_bytes`` names its main text.
    """
    size = F.octet_length("html")
    spread = F.xxhash64("html", F.lit(settings.seed)).alias("spread")
    rows = pages.where(F.col("html").isNotNull() & (size <= settings.page_bytes)).select("html", spread)
    rows = rows.where(F.col("html").rlike("(?i)<(article|main)[\\s/>]"))
    names = F.arrow_udf(_names_main_text, "boolean")
    # Only hashes are shuffled; the pages are read again for those of the sample.
    least = rows.where(names(F.col("html"))).select("spread").distinct().orderBy("spread").limit(settings.pages)
    sample = rows.join(least, "spread", "left_semi").distinct().orderBy("spread", "html").limit(settings.pages).select("html")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources = [t for b in batches for t in b["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_trees(sources, settings))])], names=["trees"])

    row = sample.repartition(1).mapInArrow(train, "trees binary").first()
    return pickle.loads(row["trees"]) if row else None


def extract(spark: SparkSession, trees: boosting.Trees | None, column: str | Column = "html") -> Column:
    """The main text of each page; empty for null and empty pages and where nothing
    is kept. Without trees every block outside named boilerplate is kept."""
    shared = spark.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            pages = [dom.parse(t or "") for t in batch.to_pylist()]
            if model is None:
                flat = [1.0 - 2.0 * bool(o & BOILERPLATE) for p in pages for o in p.own]
            else:
                flat = model.score(dom.features(pages)).tolist()
            texts, at = [], 0
            for page in pages:
                kept = kept_nodes(page, flat[at : at + len(page.tag)])
                at += len(page.tag)
                texts.append("\n".join(text for node, text, _ in page.blocks if kept[node]))
            yield pa.array(texts, pa.string())

    source = F.col(column) if isinstance(column, str) else column
    return F.arrow_udf(run, "string").asNondeterministic()(source)
