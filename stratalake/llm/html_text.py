"""Main text of web pages by a tree-structured graphical model.

Nodes of the page's tree carry a hidden state: boilerplate, content, or mixed (a
wrapper around both; text runs are never mixed). Each node has a potential from
what it looks like, each parent-child pair one from their states. As the graph is
a tree, one upward and one downward pass of sum-product messages give the exact
marginals; text runs that are more likely content than not are the text.

No feature decides alone. An element is seen by its tag, each name in class, id
and role (the word itself, the end or the start of a compound), its share of link
text, its share of the page's text how many sentences it holds and what its longest run says, if short; a run of text by its
parent, link share, length, end mark, telling phrases and place in the page.
Potentials are smoothed log frequencies over labelled pages, that is pages whose
elements carry ``data-label="content"`` or ``data-label="boiler"``. Each feature's
exponent is fitted: gradient ascent on the likelihood of the states of labelled pages
that were not counted, with the marginals as expectations, in the partitions of
those pages, whose exponents are averaged.

:func:`labelled_pages` writes such pages by rule, with the usual parts under
varying tags and names, inside and outside the article. Names conflict there:
articles are called ``ad-free`` or ``search-history``, articles quote what
notices say, and footers, menus, notices and forms come without a name.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import slices
from stratalake.llm.dom import NAMES, Tree, parse

BOILER, CONTENT, MIXED = 0, 1, 2
STATES = (BOILER, CONTENT, MIXED)
N_LABELLED = 2400
SMOOTHING = 0.2
#: Steps, and length of a step, of the fit of the exponents.
FIT_STEPS = 15
FIT_RATE = 0.2
#: Partitions of the fit: with too few pages in each, the mean of their exponents is poor.
FIT_PARTS = 2
ROOT = (0.1, 0.1, 0.8)

_SIZES = (1, 20, 60, 150, 400, 1500)
_SHARES = (0.0, 0.05, 0.2, 0.5, 0.8)
_PLACES = (0.05, 0.2, 0.8, 0.95)
_TAGS = set(
    "nav header footer aside form article main section p ul ol li h1 h2 h3 h4 h5 h6 table tr td th dl dt dd blockquote pre figure "
    "figcaption body html head button select option fieldset details summary label menu dialog noscript address".split()
)
_HOLDERS = set("html head body div nav header footer aside form article main section select button dialog menu noscript".split())
#: Features of elements and of runs of text, in the order of :func:`looks`.
#: Holders are elements with a name, or that can hold a part of the page; the other elements are plain.
FEATURES = {"holder": ("tag", "names", "links", "share", "prose", "phrase"), "plain": ("tag", "links", "share", "prose"), "text": ("parent", "links", "length", "end", "phrase", "place")}

# What short runs of text in the parts around an article often say.
PHRASES = {
    "foot": r"©|\(c\) \d{4}|copyright|all rights reserved|powered by|privacy policy|terms of (?:use|service)",
    "notice": r"cookies?\b|\bconsent\b|accept all|enable javascript",
    "form": r"sign up|subscribe|newsletter|log ?in\b|e-?mail address|\bsearch\b",
    "ad": r"advertisement|sponsored|buy now|special offer",
    "social": r"share this|follow us|\btweet\b",
    "side": r"related (?:posts|stories|articles)|read (?:more|next)|most read|you may also like",
    "comment": r"\d+ comments?\b|leave a (?:reply|comment)|\breply\b|comments\b",
    "menu": r"\bhome\b|skip to|next page|previous page",
}
_PHRASE = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PHRASES.items()), re.I)
_ENDS = tuple(".!?…:;。！？\"”’)»")


def looks(tree: Tree) -> list[tuple]:
    """The observed features of every node, ``(kind, one value per feature, crowd)``; names are a tuple of values.

    What stands side by side looks alike, so ``crowd`` runs of text or plain
    elements of one place count as one observation together; a holder counts whole.
    """
    tags, names, texts, sizes, links, parents = tree.tag, tree.names, tree.text, tree.size, tree.links, tree.parent
    count, whole = len(tags), sizes[0] or 1
    prose, out, before = [0] * count, [()] * count, 0
    says = [""] * count
    kids, crowd = [0] * count, [1] * count
    for n in range(1, count):
        kids[parents[n]] += 1
    for n in range(1, count):
        if not (names[n] or tags[n] in _HOLDERS):
            crowd[n] = min(16, crowd[parents[n]] * kids[parents[n]])
    crowd = [1 << (c.bit_length() - 1) for c in crowd]
    for n in range(count):
        if tags[n] != "#text":
            continue
        text, size, parent = texts[n], sizes[n], tags[parents[n]]
        ended = text.endswith(_ENDS)
        prose[n] = ended and size >= 20
        says[n] = phrase = m.lastgroup if size <= 200 and (m := _PHRASE.search(text)) else ""
        place = sum((before + size / 2) / whole >= x for x in _PLACES)
        before += size
        out[n] = ("text", parent if parent in _TAGS else "div", min(3, 4 * links[n] // size), sum(size >= s for s in _SIZES), ended, phrase, place, crowd[n])
    for n in range(count - 1, 0, -1):
        prose[parents[n]] += prose[n]
        if says[n] and sizes[parents[n]] <= min(200, 2 * sizes[n]):
            says[parents[n]] = says[n]
    for n, tag in enumerate(tags):
        if tag != "#text":
            size = sizes[n]
            share = min(3, 4 * links[n] // size) if size else 4
            seen = share, sum(size / whole > x for x in _SHARES), min(prose[n], 4)
            tag = tag if tag in _TAGS else "div"
            out[n] = ("holder", tag, names[n] or ("none",), *seen, says[n], 1) if names[n] or tag in _HOLDERS or not n else ("plain", tag, *seen, crowd[n])
    return out


def values_of(look: tuple) -> Iterator[tuple[str, str]]:
    """``(feature, value)`` of a node; names give one pair each."""
    for feature, value in zip(FEATURES[look[0]], look[1:]):
        for one in value if isinstance(value, tuple) else (value,):
            yield f"{look[0]}.{feature}", str(one)


def true_states(tree: Tree) -> list[int]:
    """States from the labels of the nearest labelled ancestors: text first, then what elements hold."""
    count = len(tree.tag)
    given, held = [BOILER] * count, [0] * count
    for n in range(1, count):
        label = tree.label[n]
        given[n] = CONTENT if label == "content" else BOILER if label == "boiler" else given[tree.parent[n]]
    states = list(given)
    for n in range(count - 1, 0, -1):
        if tree.tag[n] == "#text":
            held[n] = 2 if given[n] == CONTENT else 1
        elif held[n]:
            states[n] = (BOILER, CONTENT, MIXED)[held[n] - 1]
        held[tree.parent[n]] |= held[n]
    states[0] = MIXED if held[0] == 3 else given[0] if not held[0] else held[0] - 1
    return states


def page_counts(html: str) -> Counter:
    """What one labelled page adds to the counts: ``(kind, value, state)``."""
    tree, counts = parse(html), Counter()
    states = true_states(tree)
    for n, look in enumerate(looks(tree)):
        for feature, value in values_of(look):
            counts[feature, value, states[n]] += 1
        if n:
            counts[f"{look[0]}.edge", str(states[tree.parent[n]]), states[n]] += 1
    return counts


def count_looks(labelled: DataFrame) -> dict:
    """Potentials from the ``html`` column of labelled pages; the counts are few whatever the number of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            counts = Counter()
            for html in batch.column("html").to_pylist():
                counts.update(page_counts(html or ""))
            rows = [(*k, v) for k, v in counts.items()]
            if rows:
                yield pa.record_batch([pa.array(list(c)) for c in zip(*rows)], ["kind", "value", "state", "n"])

    counted = labelled.select("html").mapInArrow(run, "kind string, value string, state long, n long")
    found = counted.groupBy("kind", "value", "state").agg(F.sum("n").alias("n")).collect()
    n_of = {(r.kind, r.value, r.state): r.n for r in found}
    values: dict[str, set[str]] = {}
    for kind, value, _ in n_of:
        values.setdefault(kind, set()).add(value)
    model: dict = {"look": {}, "edge": {}, "weights": {f"{k}.{f}": 0.5 for k, features in FEATURES.items() for f in features}}
    for kind, seen in values.items():
        states = (BOILER, CONTENT) if kind.startswith("text") else STATES
        if kind.endswith(".edge"):
            for parent in STATES:
                row = [n_of.get((kind, str(parent), s), 0) + SMOOTHING for s in states]
                model["edge"][kind.split(".")[0], parent] = tuple(x / sum(row) for x in row)
        else:
            whole = {s: sum(n_of.get((kind, v, s), 0) for v in seen) + SMOOTHING * (len(seen) + 1) for s in states}
            for value in sorted(seen):
                model["look"][kind, value] = tuple(math.log((n_of.get((kind, value, s), 0) + SMOOTHING) / whole[s]) for s in states)
    return model


def gradient(judge: Marginals, pages: list[tuple]) -> Counter:
    """How the log-likelihood of the true states grows with each exponent, summed over ``(tree, looks, states)``."""
    out, table = Counter(), judge.model["look"]
    for tree, seen, states in pages:
        for look, state, marginal in zip(seen, states, judge.marginals(tree, seen)):
            if marginal[state] > 0.999:
                continue
            for feature, value in values_of(look):
                if logs := table.get((feature, value)):
                    out[feature] += (logs[state] - sum(p * x for p, x in zip(marginal, logs))) / look[-1]
    return out


def fit(labelled: DataFrame, model: dict, steps: int = FIT_STEPS) -> dict:
    """The model with exponents fitted to labelled pages: RMSprop within each partition, then the mean over partitions.

    Exponents stay at 0 or more, so a feature can be ignored but not turned round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = sorted(html or "" for batch in batches for html in batch.column("html").to_pylist())
        trees = [parse(html) for html in pages]
        pages = [(tree, looks(tree), true_states(tree)) for tree in trees]
        if not pages:
            return
        weights, scale = dict(model["weights"]), dict.fromkeys(model["weights"], 0.0)
        for step in range(steps):
            slope = gradient(Marginals({**model, "weights": weights}), pages)
            for name in weights:
                g = slope[name] / len(pages) - 0.002 * weights[name]
                scale[name] = 0.8 * scale[name] + 0.2 * g * g
                weights[name] = max(0.0, weights[name] + FIT_RATE * 0.85**step * g / (math.sqrt(scale[name]) + 1e-6))
        names = sorted(weights)
        yield pa.record_batch([pa.array(names), pa.array([weights[n] for n in names]), pa.array([len(pages)] * len(names), pa.int64())], ["name", "weight", "n"])

    found = labelled.select("html").repartition(FIT_PARTS, "html").mapInArrow(run, "name string, weight double, n long").groupBy("name")
    means = found.agg((F.sum(F.col("weight") * F.col("n")) / F.sum("n")).alias("weight")).collect()
    return {**model, "weights": {**model["weights"], **{r.name: r.weight for r in means}}}


def train(labelled: DataFrame, steps: int = FIT_STEPS) -> dict:
    """Potentials from seven eighths of the labelled pages, exponents from the rest; a page's digest says which."""
    apart = F.pmod(F.xxhash64("html"), F.lit(8)) == 0
    return fit(labelled.filter(apart), count_looks(labelled.filter(~apart)), steps)


class Marginals:
    """Sum-product on trees with the potentials of a model."""

    def __init__(self, model: dict):
        self.model, self.known = model, {}
        self.edges = {kind: [model["edge"][kind, p] for p in STATES] for kind in FEATURES}

    def potential(self, look: tuple) -> tuple:
        """Product of the features' potentials, scaled to at most 1."""
        found = self.known.get(look)
        if found is None:
            table, weights = self.model["look"], self.model["weights"]
            sums = [0.0] * (2 if look[0] == "text" else 3)
            for feature, value in values_of(look):  # a value no labelled page has says nothing
                for state, x in enumerate(table.get((feature, value), ())):
                    sums[state] += weights[feature] * x / look[-1]
            own = tuple(math.exp(s - max(sums)) for s in sums)
            rows = self.edges[look[0]]
            up = tuple(sum(r * o for r, o in zip(row, own)) for row in rows)
            found = self.known[look] = (own, tuple(u / max(up) for u in up))
        return found

    def content(self, tree: Tree) -> list[float]:
        """Probability of content for every text run, -1 for other nodes."""
        return [p[1] if tag == "#text" else -1.0 for tag, p in zip(tree.tag, self.marginals(tree, looks(tree)))]

    def marginals(self, tree: Tree, seen: list[tuple]) -> list[tuple]:
        """Probability of every state of every node, given the looks of all."""
        parents = tree.parent
        count = len(seen)
        own, up = [None] * count, [None] * count
        boiler, inside, mixed = [1.0] * count, [1.0] * count, [1.0] * count  # products of the children's messages
        for n in range(count - 1, -1, -1):
            if seen[n][0] == "text":
                own[n], message = self.potential(seen[n])
            else:
                own[n] = self.potential(seen[n])[0]
                b, c, m = own[n][0] * boiler[n], own[n][1] * inside[n], own[n][2] * mixed[n]
                r0, r1, r2 = self.edges[seen[n][0]]
                u0, u1, u2 = r0[0] * b + r0[1] * c + r0[2] * m, r1[0] * b + r1[1] * c + r1[2] * m, r2[0] * b + r2[1] * c + r2[2] * m
                top = max(u0, u1, u2) or 1.0
                message = (u0 / top, u1 / top, u2 / top)
            up[n] = message
            if n:
                p = parents[n]
                b, c, m = boiler[p] * message[0], inside[p] * message[1], mixed[p] * message[2]
                if b < 1e-100 and c < 1e-100 and m < 1e-100:
                    top = max(b, c, m) or 1.0
                    b, c, m = b / top, c / top, m / top
                boiler[p], inside[p], mixed[p] = max(b, 1e-250), max(c, 1e-250), max(m, 1e-250)
        out: list[tuple] = [()] * count
        down = [None] * count
        down[0] = ROOT  # the document itself
        for n in range(count):
            if n:
                p = parents[n]
                (d0, d1, d2), (u0, u1, u2), (o0, o1, o2) = down[p], up[n], own[p]
                b, c, m = d0 * o0 * boiler[p] / max(u0, 1e-250), d1 * o1 * inside[p] / max(u1, 1e-250), d2 * o2 * mixed[p] / max(u2, 1e-250)
                total = (b + c + m) or 1.0
                b, c, m = b / total, c / total, m / total
                r0, r1, r2 = self.edges[seen[n][0]]
                if seen[n][0] == "text":
                    no, yes = (b * r0[0] + c * r1[0] + m * r2[0]) * own[n][0], (b * r0[1] + c * r1[1] + m * r2[1]) * own[n][1]
                    total = (no + yes) or 1.0
                    out[n] = (no / total, yes / total)
                    continue
                down[n] = tuple(b * r0[s] + c * r1[s] + m * r2[s] for s in STATES)
            (d0, d1, d2), (o0, o1, o2) = down[n], own[n]
            b, c, m = d0 * o0 * boiler[n], d1 * o1 * inside[n], d2 * o2 * mixed[n]
            total = (b + c + m) or 1.0
            out[n] = (b / total, c / total, m / total)
        return out


def main_text(html: str, model: Marginals) -> str:
    """Blocks that are more likely content than not, in page order, one per line."""
    tree = parse(html)
    return "\n".join(tree.text[n] for n, p in enumerate(model.content(tree)) if p >= 0.5)


_SYLLABLES = "ka lo mi ren tas vor el dun shi pa gro nit ul sem ba".split()
_PARTS = {
    "menu": [("nav", ""), ("nav", "main-nav"), ("div", "menu"), ("div", "navbar"), ("ul", "breadcrumbs"), ("div", "pagination"), ("menu", "")],
    "head": [("header", ""), ("header", "site-header"), ("div", "header"), ("div", "topbar"), ("div", "masthead")],
    "foot": [("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("div", "bottom")],
    "side": [("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "related-posts"), ("div", "widget"), ("section", "recommended")],
    "ad": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "sponsored"), ("aside", "promo"), ("section", "banner"), ("p", "advertisement"), ("div", "ad-slot")],
    "notice": [("div", "cookie-notice"), ("div", "notice"), ("div", "alert"), ("section", "consent"), ("p", "notice"), ("dialog", ""), ("div", "popup"), ("div", "cookie-bar")],
    "form": [("form", ""), ("form", "search"), ("div", "newsletter"), ("div", "subscribe"), ("section", "login"), ("div", "search-box")],
    "comment": [("div", "comments"), ("section", "comments"), ("ol", "comment-list"), ("div", "comment"), ("article", "comment"), ("div", "respond"), ("li", "comment"), ("section", "discussion"), ("div", "comments-area")],
    "social": [("div", "share"), ("ul", "social"), ("div", "tags"), ("div", "follow-us"), ("div", "share-buttons")],
}
_ARTICLES = [("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "entry-content"), ("section", "story"), ("div", "main"), ("div", "")]
#: What parts without a name say, and what some paragraphs of articles quote.
_SAYINGS = {
    "foot": ["Copyright 2020 All rights reserved", "© 2019 {} Inc.", "Powered by {}. Privacy policy", "Terms of use · {}", "(c) 2021 {}. All rights reserved."],
    "notice": ["We use cookies to make this site better.", "This site uses cookies. Accept all", "Please enable JavaScript to {}"],
    "form": ["Sign up for our newsletter", "Subscribe to {}", "Log in", "Search {}", "Your e-mail address"],
    "ad": ["Advertisement", "Sponsored by {}", "Buy now: {}", "Special offer! {}"],
    "social": ["Share this", "Follow us on {}", "Tweet"],
    "side": ["Related articles", "Read more: {}", "Most read", "You may also like {}"],
    "comment": ["3 comments", "Leave a reply", "12 Comments on {}", "Reply"],
    "menu": ["Home", "Skip to content", "Next page"],
}
_OTHER = "history free tracing work series list item area section box unit block wide large".split()
_WRAPS = [("div", ""), ("div", "wrap"), ("div", "container"), ("div", "page"), ("section", ""), ("main", ""), ("div", "row")]


def labelled_pages(n: int = N_LABELLED, seed: int = 7) -> list[str]:
    """Pages by rule with ``data-label`` on what is content and what is not."""
    rng = random.Random(seed)

    known = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 3))) for _ in range(2000)]

    def words(low, high):
        return " ".join(rng.choices(known, k=rng.randint(low, high)))

    def sentence(low=1, high=30):
        return words(low, high).capitalize() + "."

    def prose():
        return " ".join(sentence() for _ in range(rng.choice([1, 1, 2, 3, 6])))

    def element(tag, name, inner, label=""):
        key = rng.choice(["class", "class", "class", "id"])
        return f"<{tag}" + (f' {key}="{name}"' if name else "") + (f' data-label="{label}"' if label else "") + f">{inner}</{tag}>"

    def links(n):
        return "".join(element("li", "", f'<a href="/x">{words(1, 3)}</a>') for _ in range(n))

    def saying(kind):
        return rng.choice(_SAYINGS[kind]).format(words(1, 3).capitalize())

    def code():
        return "".join(rng.choice("abcdefghjkmnpqrstuvwxyz") for _ in range(2)) + str(rng.randint(1, 99))

    def renamed(kind, name, nameless):
        """A part's name as given, at the end of a longer one, or (where what it says gives it away) none at all."""
        draw = rng.random()
        if draw < 0.1:
            return f"{rng.choice([*NAMES['content'], *_OTHER])}-{rng.choice(NAMES[kind])}"
        if draw < 0.3 and nameless and kind in ("foot", "notice", "form", "menu", "social"):
            return code() if rng.random() < 0.7 else ""
        return name

    def article_name(name):
        """An article's name as given, or one that holds a word of other parts."""
        kind = rng.choice([k for k in NAMES if k not in ("content", "comment")])
        word, own = rng.choice(NAMES[kind]), rng.choice(NAMES["content"])
        draw = rng.random()
        if draw < 0.6:
            return name
        return rng.choice([f"{own} {word}-{rng.choice(_OTHER)}", f"{word}-{rng.choice(_OTHER)}", f"{word}-{own}", f"{own} {word}", f"{own}-{rng.choice(_OTHER)}", code()])

    def part(kind, nameless=True):
        tag, name = rng.choice(_PARTS[kind])
        name = renamed(kind, name, nameless)
        if kind in _SAYINGS and (name[-1:].isdigit() or (tag in ("div", "section", "p") and not name) or rng.random() < 0.25):
            inner = saying(kind) + ("" if rng.random() < 0.5 else f' <a href="/s">{words(1, 2)}</a>')
            return element("div" if tag in ("ul", "ol", "menu") else tag, name, inner if rng.random() < 0.5 or tag == "p" else f"<p>{inner}</p>", "boiler")
        if kind in ("menu", "social"):
            inner = links(rng.randint(1, 8))
            inner = inner if tag in ("ul", "menu") else f"<ul>{inner}</ul>" if rng.random() < 0.7 else f'<a href="/">{words(1, 2)}</a> <a href="/y">{words(1, 2)}</a>'
        elif kind == "head":
            inner = rng.choice([f"<h1>{words(1, 4)}</h1>", f'<a href="/">{words(1, 3)}</a>', f"<p>{words(2, 8)}</p>", words(1, 5)])
        elif kind == "side":
            inner = f"<h3>{words(1, 3)}</h3>" + rng.choice([f"<ul>{links(rng.randint(2, 6))}</ul>", f"<p>{prose()}</p>", prose()])
        elif kind == "form":
            inner = rng.choice([f"<label>{words(1, 3)}</label><input name='q'>", f"<p>{sentence()}</p>", words(1, 6)]) + f"<button>{words(1, 2)}</button>"
        elif kind == "comment":
            one = lambda: rng.choice([f"<p>{prose()}</p>", f"<p>{words(1, 2)}</p><p>{prose()}</p>", prose()])
            inner = one() if tag in ("li", "article") else f"<h2>{words(1, 2)}</h2>" * rng.randint(0, 1) + "".join(rng.choice([one(), element("div", "comment", one()), element("li", "", one())]) for _ in range(rng.randint(1, 4)))
        else:
            inner = rng.choice([prose(), sentence(), f"<p>{prose()}</p>", f'{sentence()} <a href="/z">{words(1, 2)}</a>'])
            inner = inner if tag != "p" else sentence()
        return element(tag, name, inner, "boiler")

    def body():
        blocks = [f"<h1>{words(2, 9)}</h1>"] * rng.randint(0, 1)
        for _ in range(rng.randint(1, 12)):
            blocks.append(rng.choice([
                *[f"<p>{prose()}</p>"] * 8, f"<h2>{words(1, 6)}</h2>", f"<ul>{''.join(f'<li>{rng.choice([sentence(), words(1, 10)])}</li>' for _ in range(rng.randint(1, 5)))}</ul>",
                f"<blockquote>{element('p', '', prose())}</blockquote>", f"<p>{words(1, 2).capitalize()}.</p>", f'<p>{sentence()} <a href="/k">{words(1, 4)}</a> {sentence()}</p>',
                f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr></table>", f"<pre>{words(3, 20)}</pre>", f"<div>{prose()}</div>", f"<div><p>{prose()}</p><p>{prose()}</p></div>",
                f"<p>{saying(rng.choice([*_SAYINGS]))}</p>", f"<p>{sentence()} {saying(rng.choice([*_SAYINGS]))} {sentence()}</p>",
            ]))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            blocks.insert(rng.randint(0, len(blocks)), part(rng.choice(["ad", "side", "notice", "form", "social", "comment", "menu", "foot", "head"]), nameless=False))
        tag, name = rng.choice(_ARTICLES)
        return element(tag, article_name(name) if tag in ("article", "main") else name, "".join(blocks), "content")

    pages = []
    for _ in range(n):
        bare = rng.random() < 0.15  # a page of the article alone
        parts = [part(k) for k in ("notice", "head", "menu", "ad") if rng.random() < 0.6 and not bare]
        rng.shuffle(parts)
        middle = [body()] + [part(k) for k in ("side", "ad", "comment", "form", "social") if rng.random() < 0.4 and not bare]
        if rng.random() < 0.3 and not bare:
            middle.insert(0, part(rng.choice(["side", "menu", "ad"])))
        inner = "".join(middle)
        for _ in range(rng.choice([0, 0, 1, 2])):
            inner = element(*rng.choice(_WRAPS), inner)
        end = [part(k) for k in ("foot", "notice", "ad") if rng.random() < 0.5 and not bare]
        pages.append(f"<html><head><title>{words(2, 5)}</title></head><body>{''.join(parts)}{inner}{''.join(end)}</body></html>")
    return pages


def trained(spark: SparkSession, n_labelled: int = N_LABELLED) -> dict:
    """The model of ``n_labelled`` pages that :func:`labelled_pages` writes, a seed for every hundred of them, in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seed in batch.column("id").to_pylist():
                yield pa.record_batch([pa.array(labelled_pages(min(100, n_labelled - 100 * seed), seed))], ["html"])

    seeds = spark.range(0, -(-n_labelled // 100), 1, 8)
    return train(seeds.mapInArrow(run, "html string"))


def extract(pages: DataFrame, model: dict) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row per row of ``pages``.

    White space inside a block is one blank, blocks follow in page order, one per
    line; ``text`` is empty if there is none, as for a null or empty html.
    ``n_chars`` counts code points. Broken markup is repaired, a very long page
    is read whole, repeated rows and null ids are kept, other columns ignored.
    An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Marginals(model)
        for batch in slices(batches, "html", 4 << 20):
            if len(judge.known) > 100_000:
                judge.known.clear()
            texts = [main_text(html or "", judge) for html in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    picked = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return picked.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
