"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is read into leaf blocks (text between block-level tags) with their ancestors. Features of
ancestor tags, of class and id names and of the text go to a two-label chain that is trained by
gradient ascent on labelled pages and decoded by Viterbi. The labelled pages are drawn from a seeded
page writer (`labelled_pages`), as no table holds labels; more can be given.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

# Tag names of the HTML standard.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br img".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript textarea title head svg math iframe object select option button canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
PARAGRAPH_ENDS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

# A quote opens an attribute's value only after an equals sign, so a stray apostrophe ends no tag late.
_TOKEN = regex.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<![^>]*>|<\?[^>]*>|</?[A-Za-z](?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+>|[^<]+|<", regex.S)
_RAW_END = {name: regex.compile(rf"</{name}(?=[\s/>])[^>]*>?", regex.I) for name in RAW}
#: Where a raw element without an end tag is taken to end: at the next tag that no script writes bare.
_NEXT_BLOCK = regex.compile(rf"</?(?:head|body|html|{'|'.join(sorted(PARAGRAPH_ENDS))})(?=[\s/>])(?![^<>]*['\"]\s*[;+)])", regex.I)
_NAME = regex.compile(r"</?([A-Za-z][^\s/>]*)")
_NAMED = regex.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", regex.I)
_WORDS = regex.compile(r"[a-z]+")
_WHITE = regex.compile(r"\s+")
#: Pages on which a feature must stand to get a weight.
LEAST_PAGES = 3


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, str], ...]  # (tag, class and id names) from the root down
    linked: int  # characters inside links


def blocks(html: str) -> list[Block]:
    """The leaf blocks with text, in page order. Unclosed and stray tags are allowed."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked, links, hidden, at = 0, 0, 0, 0

    def close() -> None:
        nonlocal linked
        text = _WHITE.sub(" ", unescape("".join(parts))).strip()
        if text:
            out.append(Block(text, tuple(stack), min(linked, len(text))))
        parts.clear()
        linked = 0

    def leave(depth: int) -> None:
        nonlocal hidden
        while len(stack) > depth:
            hidden -= stack.pop()[0] in HIDDEN

    while m := _TOKEN.match(html, at):
        token, at = m[0], m.end()
        if token[0] != "<" or len(token) == 1:
            if not hidden:
                parts.append(token)
                linked += links > 0 and len(token)
            continue
        name_match = _NAME.match(token)
        if name_match is None:
            continue
        name = name_match[1].lower()
        if token[1] == "/":
            if name == "a":
                links = max(0, links - 1)
            if name in INLINE:
                continue
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            close()
            if depth is not None:
                leave(depth)
                links = 0
            continue
        if name == "br":
            parts.append(" ")
        if name == "a":
            links += 1
        if name in INLINE:
            continue
        close()
        links = 0
        if stack and (name in CLOSED_BY.get(stack[-1][0], ()) or stack[-1][0] == "p" and name in PARAGRAPH_ENDS):
            leave(len(stack) - 1)
        if name in VOID or token.endswith("/>") and name not in RAW:
            continue
        names = " ".join(x[2].strip("\"'").lower() for x in _NAMED.finditer(token)) if len(token) > len(name) + 2 else ""
        stack.append((name, names))
        hidden += name in HIDDEN
        if name in RAW:  # holds no tags: only its own end tag counts, wherever it stands
            end = _RAW_END[name].search(html, at)
            after = None if end else _NEXT_BLOCK.search(html, at)
            at = end.end() if end else after.start() if after else len(html)
            leave(len(stack) - 1)
    close()
    return out


def features(page: list[Block]) -> list[list[str]]:
    out = []
    for i, b in enumerate(page):
        tags = [t for t, _ in b.path]
        own = {f"in:{t}" for t in tags} | {f"tag:{tags[-1]}" if tags else "tag:"} | {f"tag2:{'/'.join(tags[-2:])}"}
        near: list[str] = []
        for tag, names in b.path:
            if names and tag not in ("html", "body"):  # those name the kind of page, not a part of it
                near = _WORDS.findall(names)
                own |= {f"name:{w}" for w in near}
        own |= {f"near:{w}" for w in near}  # the innermost names
        size = len(b.text)
        words = b.text.count(" ") + 1
        own |= {f"size:{min(8, int(np.log2(size)))}", f"words:{min(7, int(np.log2(words)))}", f"links:{int(4 * b.linked / size)}", f"stops:{min(3, sum(b.text.count(c) for c in '.!?'))}"}
        own |= {f"short:{words < 4}|link:{2 * b.linked >= size}", f"first:{i == 0}", f"last:{i == len(page) - 1}", f"mark:{b.text[0] in '©|»•'}", "bias"}
        out.append(sorted(own))
    return out


@dataclass
class Chain:
    """weight: feature -> score of being main text; moves[a, b], begin, finish: scores of labels 0 and 1."""

    weight: dict[str, float]
    moves: np.ndarray
    begin: np.ndarray
    finish: np.ndarray

    def decode(self, page: list[Block]) -> np.ndarray:
        """The most likely labels, by Viterbi; ties go to boilerplate."""
        if not page:
            return np.zeros(0, int)
        unary = [sum(self.weight.get(f, 0.0) for f in own) for own in features(page)]
        m = self.moves
        s0, s1 = self.begin[0], self.begin[1] + unary[0]
        back = []
        for u in unary[1:]:
            a, b = s0 + m[0, 0], s1 + m[1, 0]
            c, d = s0 + m[0, 1], s1 + m[1, 1]
            back.append((int(b > a), int(d > c)))
            s0, s1 = max(a, b), max(c, d) + u
        label = int(s1 + self.finish[1] > s0 + self.finish[0])
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return np.array(out[::-1])


def train(pages: list[tuple[list[Block], list[int]]], rounds: int = 100, rate: float = 0.3, l2: float = 0.02) -> Chain:
    """Maximum likelihood by Adagrad; features on fewer than LEAST_PAGES pages are left out; forward and backward run over all pages at once, place by place."""
    rows = [(features(p), y) for p, y in pages if p]
    pages_with = Counter(f for x, _ in rows for f in {f for own in x for f in own})
    names = sorted(f for f, n in pages_with.items() if n >= LEAST_PAGES)
    number = {f: i for i, f in enumerate(names)}
    longest = max(len(y) for _, y in rows)
    n = len(rows)
    gold, real = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    cell, feature = [], []
    for i, (x, y) in enumerate(rows):
        gold[i, : len(y)], real[i, : len(y)] = y, True
        for t, own in enumerate(x):
            cell += [i * longest + t] * sum(f in number for f in own)
            feature += [number[f] for f in own if f in number]
    cell, feature = np.array(cell), np.array(feature)
    size = real.sum(1)
    last = np.arange(n), size - 1
    parameters = [np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2), np.zeros(2)]
    squares = [np.full(p.shape, 1e-8) for p in parameters]
    pair_gold = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pair_gold[a, b] = (real[:, 1:] & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum()
    for _ in range(rounds):
        w, moves, begin, finish = parameters
        unary = np.zeros((n, longest, 2))
        unary[:, :, 1] = np.bincount(cell, w[feature], n * longest).reshape(n, longest)
        unary[:, 0] += begin
        unary[last] += finish
        alpha, beta = np.zeros_like(unary), np.zeros_like(unary)
        alpha[:, 0] = unary[:, 0]
        for t in range(1, longest):
            alpha[:, t] = np.logaddexp(alpha[:, t - 1, :1] + moves[0], alpha[:, t - 1, 1:] + moves[1]) + unary[:, t]
        for t in range(longest - 2, -1, -1):
            ahead = beta[:, t + 1] + unary[:, t + 1]
            step = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
            beta[:, t] = np.where(real[:, t + 1, None], step, 0)
        z = np.logaddexp(*alpha[last].T)
        p = np.exp(alpha + beta - z[:, None, None]) * real[:, :, None]
        pair = np.exp(alpha[:, :-1, :, None] + moves + (beta + unary)[:, 1:, None, :] - z[:, None, None, None]) * real[:, 1:, None, None]
        gap = (gold * real - p[:, :, 1]).ravel()
        grads = [
            np.bincount(feature, gap[cell], len(names)) / n - l2 * w / n,
            (pair_gold - pair.sum((0, 1))) / n - l2 * moves / n,
            (np.eye(2)[gold[:, 0]] - p[:, 0]).mean(0),
            (np.eye(2)[gold[last]] - p[last]).mean(0),
        ]
        for q, s, g in zip(parameters, squares, grads, strict=True):
            s += g * g
            q += rate * g / np.sqrt(s)
    w, moves, begin, finish = parameters
    return Chain(dict(zip(names, w.tolist(), strict=True)), moves, begin, finish)


# ---- labelled pages ----

_MAIN, _OTHER = "\ue000", "\ue001"  # private characters before each text: main text, other text

# What stands around an article: (tags, class and id names, what it holds).
_FURNITURE = (
    ("nav ul div", "nav navbar navigation menu mainmenu topnav links tabs", "links"),
    ("header div", "header masthead branding logo site-title tagline top", "label"),
    ("aside div section", "sidebar aside side column rail widget widgets", "box"),
    ("div section aside", "ad ads advert advertisement adslot sponsor sponsored promo promotion banner", "pitch"),
    ("div section", "cookie cookies consent gdpr privacy notice alert warning message announcement", "pitch"),
    ("form div", "search searchbox subscribe newsletter signup register login contact", "form"),
    ("div ul p", "share sharing social follow breadcrumb breadcrumbs crumbs tags categories pagination pager", "links"),
    ("div p span", "meta byline author dateline date posted published", "label"),
    ("div section aside", "related recommended popular trending teaser teasers readmore recirculation", "links"),
    ("div section ol ul", "comments comment-list responses replies discussion respond thread", "comments"),
    ("footer div", "footer foot colophon copyright legal bottom", "footer"),
)
_CONTENT = "article post entry story content article-body post-content entry-content main-text body-text prose page-content text"


def labelled_pages(count: int = 400, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Pages of many layouts with the truth about each block, written by rule from a seed.

    A page draws a skeleton (semantic tags, named divisions, bare divisions or a layout table), puts
    the article into it, and furniture before, after, beside and now and then inside the article.
    """
    rnd = random.Random(seed)
    pick = rnd.choice

    def word() -> str:
        return "".join(pick("bcdfghklmnprstvw") + pick("aeiou") + pick(["", "", "n", "r", "s", "l"]) for _ in range(rnd.choice([1, 1, 2, 2, 3])))

    def phrase(most: int) -> str:
        return " ".join(word() for _ in range(rnd.randint(1, most)))

    def sentences(most: int) -> str:
        return " ".join(phrase(20).capitalize() + pick([".", ".", ".", ".", "?", "!", ":", ""]) for _ in range(rnd.randint(1, most)))

    def inline(text: str) -> str:
        """Some words of a text as a link, emphasised or broken by a line end."""
        words = text.split(" ")
        for _ in range(rnd.choice([0, 0, 0, 1, 2])):
            k, tag = rnd.randrange(len(words)), pick(["a", "em", "strong", "code", "i", "span"])
            words[k] = f"<{tag}{' href=/' + word() if tag == 'a' else ''}>{words[k]}</{tag}>"
        if rnd.random() < 0.1:
            words[rnd.randrange(len(words))] += pick(["<br>", "<br/>"])
        return " ".join(words)

    def attributes(names: str) -> str:
        own = pick(names.split())
        more = pick(["", "", f" {word()}", f" {word()}-{word()}", f" {own}--{word()}"])
        return pick([f' class="{own}{more}"', f" class='{own}{more}'", f' id="{own}"', f" id={own}", f' id="{word()}" class="{own}"', f' class="{word()} {word()}-{own}"', f' role="{own}"'])

    def element(tag: str, inner: str, names: str = "") -> str:
        end = "" if tag in ("p", "li", "td", "tr") and rnd.random() < 0.2 else f"</{tag}>"
        return f"<{tag}{attributes(names) if names else ''}>{inner}{end}"

    def links(tag: str) -> str:
        if tag not in ("ul", "ol") and rnd.random() < 0.25:
            return pick([" ", " | ", "<br>", " &middot; "]).join(f'<a href="/{word()}">{_OTHER}{phrase(3)}</a>' for _ in range(rnd.randint(1, 6)))
        inner = pick(["li", "li", "span", "p", "div"]) if tag not in ("ul", "ol") else "li"
        each = [element(inner, f'<a href="/{word()}">{_OTHER}{phrase(4)}</a>') for _ in range(rnd.randint(1, 10))]
        return "".join(each) if inner != "li" or tag in ("ul", "ol") else f"<ul>{''.join(each)}</ul>"

    def furniture(which: int | None = None) -> str:
        tags, names, holds = _FURNITURE[rnd.randrange(len(_FURNITURE) - 1) if which is None else which]
        tag = pick(tags.split())
        named = names if tag in ("div", "section", "ul", "ol", "p", "span") or rnd.random() < 0.5 else ""
        wrap = lambda text: text if rnd.random() < 0.4 else element(pick(["p", "div", "h3", "h4", "span"]), text)
        if holds == "links":
            inner = (element(pick(["h2", "h3", "h4", "div"]), _OTHER + phrase(4)) if tag not in ("ul", "ol", "p") and rnd.random() < 0.4 else "") + (links(tag) if tag != "p" else links("span").replace("<div", "<span").replace("</div", "</span"))
        elif holds == "label":
            inner = wrap(_OTHER + phrase(7)) + (wrap(_OTHER + sentences(1)) if tag in ("header", "div") and rnd.random() < 0.3 else "")
        elif holds == "box":
            inner = element(pick(["h2", "h3", "h4"]), _OTHER + phrase(4)) + pick([links("div"), element("p", _OTHER + sentences(4)), element("p", _OTHER + sentences(2)) + links("div")])
        elif holds == "pitch":
            inner = pick(["", element("h3", _OTHER + phrase(5))]) + wrap(_OTHER + sentences(pick([1, 2, 6]))) + pick(["", f"<button>{phrase(2)}</button>", element("p", f"<a href=/{word()}>{_OTHER}{phrase(3)}</a>")])
        elif holds == "form":
            inner = pick(["", element(pick(["h3", "p"]), _OTHER + sentences(1))]) + f"<label>{_OTHER}{phrase(2)}</label><input name={word()}>" + pick(["", f"<select><option>{word()}<option>{word()}</select>", f"<textarea>{phrase(4)}</textarea>"])
        elif holds == "comments":
            inside = "li" if tag in ("ol", "ul") else pick(["div", "article", "section", "p"])
            one = lambda: element(inside, pick(["", f"<cite>{phrase(2)}</cite> "]) * (inside != "p") + (_OTHER + sentences(4) if inside == "p" else element("p", _OTHER + sentences(4)) + pick(["", element("p", _OTHER + sentences(2)), element("div", f"<a href=#>{_OTHER}{word()}</a>")])), "comment reply response" if rnd.random() < 0.7 else "")
            heading = "" if tag in ("ol", "ul") else pick(["", element(pick(["h2", "h3"]), _OTHER + phrase(4))])
            inner = heading + "".join(one() for _ in range(rnd.randint(1, 6)))
        else:
            text = _OTHER + pick(["&copy; ", "\u00a9 ", "", "(c) "]) + phrase(6) + pick(["", " &middot; " + phrase(4), ". " + sentences(2)])
            inner = pick([text, element("p", text), element("p", text) + links("div"), element("div", links("div")) + element("small", text)])
        return element(tag, inner, named)

    def block() -> str:
        kind = rnd.random()
        if kind < 0.55:
            return element(pick(["p", "p", "p", "p", "p", "div"]), _MAIN + inline(sentences(pick([1, 2, 4, 9, 25]))))
        if kind < 0.64:
            return element(pick(["h2", "h2", "h3", "h4"]), _MAIN + inline(phrase(9)))
        if kind < 0.71:
            tag = pick(["ul", "ol"])
            return element(tag, "".join(element("li", _MAIN + inline(pick([phrase(4), sentences(2)]))) for _ in range(rnd.randint(1, 7))))
        if kind < 0.76:
            return element("blockquote", pick([_MAIN + sentences(3), element("p", _MAIN + sentences(3)) + element("footer", _MAIN + phrase(3))]))
        if kind < 0.8:
            return element("pre", _MAIN + "\n".join(phrase(6) for _ in range(rnd.randint(1, 6))))
        if kind < 0.84:
            cells = lambda t: element("tr", "".join(element(t, _MAIN + phrase(4)) for _ in range(3)))
            return element("table", cells("th") + "".join(cells("td") for _ in range(rnd.randint(1, 4))))
        if kind < 0.87:
            return element("figure", f"<img src={word()}.png>" + element("figcaption", _MAIN + phrase(12)))
        return furniture(rnd.randrange(len(_FURNITURE) - 2)) if rnd.random() < 0.85 else f"<script>if(a<b&&c>d){{{word()}('<p>{word()}</p>')}}</script>"

    def article() -> str:
        heading = pick(["", element("h1", _MAIN + inline(phrase(12))), element("h1", _MAIN + sentences(2)), element("header", element("h1", _MAIN + phrase(9)))])
        return heading + "".join(block() for _ in range(rnd.choice([0, 1, 1, 2, 3, 4, 6, 9, 15, 30])))

    def page() -> str:
        before, after = "".join(furniture() for _ in range(rnd.randint(0, 5))), "".join(furniture() for _ in range(rnd.randint(0, 3)))
        foot = furniture(len(_FURNITURE) - 1) if rnd.random() < 0.9 else ""
        skeleton, text = rnd.random(), article()
        if skeleton < 0.45:
            core = element("article", text, _CONTENT if rnd.random() < 0.5 else "")
            core = pick([core, core, f"<main>{core}</main>", f"<main>{furniture()}{core}{furniture()}</main>"])
        elif skeleton < 0.6:
            core = element("main", pick([text, element("section", text), element("div", text, _CONTENT)]))
        elif skeleton < 0.9:
            core = element("div", pick([text, element("div", text)]), _CONTENT)
        else:
            core = f"<table><tr><td{attributes('left nav menu')}>{pick([links('ul'), links('td')])}<td{attributes(_CONTENT)}>{text}</table>"
        if rnd.random() < 0.4:
            core = f"<div{attributes('wrapper container page wrap layout row')}>{before}{core}{after}</div>"
            before = after = ""
        head = f"<head><title>{phrase(8)}</title>{pick(['', f'<style>.{word()}{{color:red}}</style>'])}</head>"
        return f"<html>{head}<body>{before}{core}{after}{foot}</body></html>"

    out = []
    for _ in range(count):
        found = blocks(page())
        # A text is main text if that is what its first mark says; one without any mark (the name of a comment's author) is not.
        labels = [int(next((c for c in b.text if c in _MAIN + _OTHER), _OTHER) == _MAIN) for b in found]
        for b in found:
            size = len(b.text)
            b.text = b.text.replace(_MAIN, "").replace(_OTHER, "")
            b.linked = max(0, min(b.linked - (size - len(b.text)), len(b.text)))
        out.append(([b for b in found if b.text], [y for b, y in zip(found, labels, strict=True) if b.text]))
    return out


@lru_cache(maxsize=1)
def default_chain() -> Chain:
    return train(labelled_pages())


def extract(html: str, chain: Chain) -> str:
    page = blocks(html)
    return "\n\n".join(b.text for b, keep in zip(page, chain.decode(page), strict=True) if keep)


def extract_pages(pages: DataFrame, chain: Chain | None = None) -> DataFrame:
    """The main text of each page: its blocks in page order, joined by two newlines.

    One row per input row, repeated rows included. A null or empty html, and a page without main
    text, give the empty string; a null page_id or url stays null; of equally likely labels a block's
    is other text. A very long page is held by one worker with its blocks; an empty table gives an
    empty one. Only page_id, url and html are read, so other columns can't clash. No shuffle; the
    chain has some hundred weights.
    """
    spark = common.prepare(pages.sparkSession)
    held = spark.sparkContext.broadcast(chain or default_chain())
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "html"):
            texts = [extract(h or "", held.value) for h in batch.column(2).to_pylist()]
            yield common.batch_of(schema, batch.column(0), batch.column(1), texts, [len(t) for t in texts])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
