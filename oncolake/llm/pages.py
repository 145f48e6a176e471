"""Main text of web pages: boosted trees over block nodes, decoded from the top of the tree."""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncolake.llm import boosting
from oncolake.llm.shipping import ship_package, small_batches
from oncolake.llm.textbytes import pieces

#: Pages the trees are fitted on at most, picked by a hash of their id; layouts made of each.
SAMPLE_PAGES, LAYOUTS = 400, 4
#: With fewer pages that label themselves in the sample, pages without a landmark are fitted on too.
LEAST_LANDMARKS = 20
#: What a split of a subtree into kept and dropped children costs, in units of log odds.
SPLIT_COST = 1.5

#: What may be markup: a comment, a tag without ``<`` or ``>`` in its attributes, or the start of another.
_TOKEN = re.compile(
    r"<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>\"']*+(?:(?:\"[^\"<>]*+\"|'[^'<>]*+')[^<>\"']*+)*+)>|<[!?/a-zA-Z]"
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)")
_QUOTE_OR_END = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without readable text.
_SILENT = frozenset(
    "script style noscript template svg math canvas iframe object audio video select option "
    "textarea button head title".split()
)
_RAW = frozenset("script style textarea title iframe noscript".split())
#: A start tag of the key ends open elements of the value, up to a container.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "thead": {"caption"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_CONTAINERS = frozenset("ul ol dl table html body article section main aside nav div form".split())

_KINDS = (
    {"article", "main"}, {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl"}, {"li", "dt", "dd"},
    {"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset"},
    {"table", "tbody", "thead", "tr", "td", "th"}, {"div", "section"}, {"blockquote", "pre", "figure"},
)
_TOKENS = (
    frozenset("ad ads advert advertisement adsense sponsor sponsored promo promotion banner".split()),
    frozenset("nav navigation menu menubar breadcrumb breadcrumbs navbar toolbar pagination pager".split()),
    frozenset("side sidebar aside rail widget related recommended teaser complementary".split()),
    frozenset("comment comments reply replies respond disqus discussion".split()),
    frozenset("footer foot copyright legal header masthead contentinfo".split()),
    frozenset("cookie cookies consent notice alert popup modal overlay gdpr privacy dialog".split()),
    frozenset("share social follow subscribe newsletter signup login search form".split()),
    frozenset("article content post main entry story body text page".split()),
)
FEATURES = (
    [f"kind_{i}" for i in range(len(_KINDS))]
    + [f"token_{i}" for i in range(len(_TOKENS))]
    + [f"above_{i}" for i in range(len(_TOKENS))]
    + "depth chars own share links commas stops paragraphs place siblings alike child_chars in_article "
      "in_nav in_foot in_aside in_form heads words_before".split()
)


@dataclass
class Tree:
    """Block nodes of a page in document order; inline elements belong to the block around them."""

    tag: list[str] = field(default_factory=lambda: ["#"])
    parent: list[int] = field(default_factory=lambda: [-1])
    tokens: list[frozenset[str]] = field(default_factory=lambda: [frozenset()])
    #: Pieces of text in order: (node, text, is in a link); text None is a break.
    flow: list[tuple[int, str | None, bool]] = field(default_factory=list)


class Markup:
    """Comments and tags of a page, in time that grows with its length, however badly it is formed.

    A tag ends at the first ``>`` outside of quotes, or, where its quotes never close, at the first
    ``>``, and is then no element. A tag without any ``>`` behind it is text. A comment that does
    not end goes on to the end of the page.
    """

    def __init__(self, source: str):
        self.source = source
        self.last_end = source.rfind(">")
        self._marks: list[int] | None = None
        self._tag_ends: list[int] = []

    def next(self, position: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, is an end tag, name, attributes) of the first token from a position on."""
        match = _TOKEN.search(self.source, position)
        if match is None:
            return None
        start = match.start()
        if match[2] is not None:
            return start, match.end(), bool(match[1]), match[2].lower(), match[3]
        if match[0] != "<!--" and start > self.last_end:
            start = self.source.find("<!--", start)  # without a ">" only a comment can follow
            if start < 0:
                return None
        if self.source.startswith("<!--", start):
            end = self.source.find("-->", start + 4)
            return start, end + 3 if end >= 0 else len(self.source), False, None, ""
        tag = _TAG.match(self.source, start)
        end = self._tag_end(tag.end()) if tag else -1
        if end < 0:
            return start, self.source.index(">", start) + 1, False, None, ""
        return start, end + 1, bool(tag[1]), tag[2].lower(), self.source[tag.end() : end]

    def _tag_end(self, position: int) -> int:
        """The first ``>`` outside of quotes from a position outside of quotes, or -1.

        Read once from the end of the page: where a tag ends, seen from each quote or ``>``, if that
        is outside of quotes, in double or in single ones.
        """
        if self._marks is None:
            self._marks = [m.start() for m in _QUOTE_OR_END.finditer(self.source)]
            self._tag_ends = [-1] * len(self._marks)
            plain = double = single = -1
            for i in range(len(self._marks) - 1, -1, -1):
                sign = self.source[self._marks[i]]
                if sign == ">":
                    plain = self._marks[i]
                elif sign == '"':
                    plain, double = double, plain
                else:
                    plain, single = single, plain
                self._tag_ends[i] = plain
        at = bisect_left(self._marks, position)
        return self._tag_ends[at] if at < len(self._marks) else -1


class _Open:
    """Open elements of a page and where each name was opened last, so that no tag walks over them."""

    def __init__(self):
        self.names, self.holders = ["#"], [0]  # each element and the block that holds its text
        self.where: dict[str, list[int]] = {}
        self.blocks, self.containers, self.silent = [0], [0], 0

    def push(self, name: str, holder: int) -> None:
        at = len(self.names)
        self.names.append(name)
        self.holders.append(holder)
        self.where.setdefault(name, []).append(at)
        if name not in _INLINE:
            self.blocks.append(at)
        if name in _CONTAINERS:
            self.containers.append(at)
        self.silent += name in _SILENT

    def end(self, depth: int) -> None:
        """Close the elements from a depth on."""
        while len(self.names) > depth:
            name = self.names.pop()
            self.holders.pop()
            self.where[name].pop()
            if name not in _INLINE:
                self.blocks.pop()
            if name in _CONTAINERS:
                self.containers.pop()
            self.silent -= name in _SILENT

    def last(self, name: str) -> int:
        """The depth at which a name was opened last; 0 if it is not open."""
        where = self.where.get(name)
        return where[-1] if where else 0


def parse(source: str) -> Tree:
    """The block tree of a page, however badly it is formed. Silent elements leave nothing."""
    tree, markup, stack = Tree(), Markup(source), _Open()
    at, links, position = 0, 0, 0
    while True:
        token = markup.next(position)
        end = token[0] if token else len(source)
        if end > position and not stack.silent:
            tree.flow.append((at, html.unescape(source[position:end]), links > 0))
        if not token:
            return tree
        _, position, closes, name, attributes = token
        if name is None:
            continue
        if closes:
            depth = stack.last(name)
            if depth and not (name in _INLINE and stack.blocks[-1] > depth):
                stack.end(depth)  # but an inline end tag does not end blocks
        else:
            if name not in _INLINE and name not in _VOID and stack.names[stack.blocks[-1]] == "p":
                stack.end(stack.blocks[-1])
            if name in _ENDS:
                depth = max(map(stack.last, _ENDS[name]))
                if depth > stack.containers[-1]:
                    stack.end(depth)
            if name in _VOID:
                if name in ("br", "hr"):
                    tree.flow.append((at, " ", False))
                continue
            if name in _RAW:
                close = re.compile(rf"</{name}\s*>", re.I).search(source, position)
                position = close.end() if close else len(source)
                continue
            if name in _INLINE or name in _SILENT:
                stack.push(name, stack.holders[-1])
            else:
                words = " ".join(a or b or c for a, b, c in _ATTRIBUTE.findall(attributes)) if attributes else ""
                tree.tag.append(name)
                tree.parent.append(stack.holders[-1])
                tree.tokens.append(frozenset(_WORD.findall(words.lower())))
                stack.push(name, len(tree.tag) - 1)
        if stack.holders[-1] != at or (name not in _INLINE and name not in _SILENT):
            tree.flow.append((stack.holders[-1], None, False))
        at = stack.holders[-1]
        links = len(stack.where.get("a", ())) if name == "a" or closes else links


def node_features(tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``FEATURES`` per node, and the characters of each node's own text."""
    count = len(tree.tag)
    own, linked, commas, stops = (np.zeros(count) for _ in range(4))
    first = np.full(count, -1.0)
    seen = 0
    for node, text, link in tree.flow:
        if text is None:
            continue
        size = len(text) - text.count(" ") if not text.isspace() else 0
        if not size:
            continue
        if first[node] < 0:
            first[node] = seen
        seen += size
        own[node] += size
        linked[node] += size if link else 0
        commas[node] += text.count(",")
        stops[node] += text.count(".") + text.count("!") + text.count("?")
    parent = tree.parent
    total, links, comma, stop = own.copy(), linked.copy(), commas.copy(), stops.copy()
    children, paragraphs, heads = np.zeros(count), np.zeros(count), np.zeros(count)
    alike: dict[tuple[int, str], int] = {}
    for node in range(count - 1, 0, -1):
        up = parent[node]
        total[up] += total[node]
        links[up] += links[node]
        comma[up] += comma[node]
        stop[up] += stop[node]
        children[up] += 1
        paragraphs[up] += paragraphs[node] + (tree.tag[node] == "p")
        heads[up] += heads[node] + (tree.tag[node] in _KINDS[2])
        if 0 <= first[node] and (first[up] < 0 or first[node] < first[up]):
            first[up] = first[node]
        alike[up, tree.tag[node]] = alike.get((up, tree.tag[node]), 0) + 1
    # Sets of kinds, attribute words and zones are bits; those above a node come from its parent.
    kind, words, above, inside, depth = ([0] * count for _ in range(5))
    zones = (_KINDS[0], _KINDS[5], _KINDS[7], _KINDS[8], _KINDS[9])
    known: dict[str, tuple[int, int]] = {}
    for node in range(count):
        tag, mine, up = tree.tag[node], tree.tokens[node], parent[node]
        if tag not in known:
            known[tag] = _bits(tag in k for k in _KINDS), _bits(tag in z for z in zones)
        kind[node] = known[tag][0]
        if mine:
            words[node] = _bits(not mine.isdisjoint(names) for names in _TOKENS)
        if up >= 0:
            depth[node] = depth[up] + 1
            above[node] = above[up] | words[up]
            inside[node] = inside[up] | known[tree.tag[up]][1]
    up = np.maximum(np.array(parent), 0)
    same = np.array([alike.get((parent[node], tree.tag[node]), 1) for node in range(count)], float)
    siblings, size = children[up], np.maximum(total, 1)
    siblings[0] = 1
    place, everything = np.maximum(first, 0), max(seen, 1)
    out = np.column_stack(
        [
            _columns(kind, len(_KINDS)), _columns(words, len(_TOKENS)), _columns(above, len(_TOKENS)),
            np.array(depth, float), np.log1p(total), np.log1p(own), total / everything, links / size,
            100 * comma / size, 100 * stop / size, paragraphs, place / everything, siblings,
            same / np.maximum(siblings, 1), np.log1p(total / (children + 1)), _columns(inside, len(zones)),
            heads, np.log1p(place),
        ]
    )
    return out, own


def _bits(flags: Iterable[bool]) -> int:
    return sum(1 << i for i, flag in enumerate(flags) if flag)


def _columns(bits: list[int], count: int) -> np.ndarray:
    """A column of 0 and 1 per bit."""
    return (np.array(bits)[:, None] >> np.arange(count) & 1).astype(float)


def decode(tree: Tree, own: np.ndarray, chance: np.ndarray, cost: float = SPLIT_COST) -> np.ndarray:
    """Which nodes' own texts are kept.

    A subtree is kept whole, dropped whole, or split, where each child decides for itself and the
    split costs ``cost``. The choice of greatest total log odds wins, so no descendant contradicts
    an ancestor that was kept or dropped whole.
    """
    count = len(own)
    chance = np.clip(chance, 1e-4, 1 - 1e-4)
    weight = np.where(own > 0, 1 + np.log1p(own), 0.0)
    odds = weight * np.log(chance / (1 - chance))
    whole = odds.copy()  # gain of keeping all over dropping all
    parts = np.maximum(odds, 0)  # best gain of the node's own text and its children apart
    best = np.zeros(count)
    for node in range(count - 1, -1, -1):
        best[node] = max(whole[node], 0.0, parts[node] - cost)
        up = tree.parent[node]
        if up >= 0:
            whole[up] += whole[node]
            parts[up] += best[node]
    keep, fate = np.zeros(count, bool), np.zeros(count, np.int8)  # fate: 1 kept, -1 dropped, 0 split
    for node in range(count):
        up = tree.parent[node]
        if up >= 0 and fate[up]:
            fate[node] = fate[up]
        elif best[node] == 0.0 or whole[node] == best[node]:
            fate[node] = 1 if whole[node] > 0 and whole[node] == best[node] else -1
        keep[node] = fate[node] > 0 or (fate[node] == 0 and odds[node] > 0)
    return keep


def flow_text(tree: Tree, keep: np.ndarray) -> str:
    """The kept texts in page order; white space becomes one space, and so does a break."""
    return " ".join("".join(" " if t is None else t for n, t, _ in tree.flow if t is None or keep[n]).split())


def _landmarks(tree: Tree) -> np.ndarray | None:
    """1 for nodes of the article, 0 for others, by the landmarks that a page has; None without any."""
    main = [tag in ("article", "main") for tag in tree.tag]
    if not any(main):
        return None
    label = np.zeros(len(tree.tag))
    for node in range(1, len(tree.tag)):
        up = tree.parent[node]
        outside = tree.tag[node] in ("nav", "footer", "aside", "form") or any(
            not tree.tokens[node].isdisjoint(names) for names in _TOKENS[:7]
        )
        label[node] = (main[node] or label[up] == 1) and not outside
    return label


def _guessed(tree: Tree) -> np.ndarray | None:
    """Labels of a page without landmarks, by attribute words, links and text; None without any text.

    Blocks of running text count for the block around them and half for the one around that. The
    block of most text is the article, without navigation, notices and the like.
    """
    _, own = node_features(tree)
    if not own.any():
        return None
    links = np.zeros(len(own))
    for node, text, link in tree.flow:
        if link and text is not None and not text.isspace():
            links[node] += len(text) - text.count(" ")
    outside, score, top = np.zeros(len(own), bool), np.zeros(len(own)), np.zeros(len(own), bool)
    for node in range(1, len(own)):
        top[node] = top[tree.parent[node]] or tree.tag[node] == "header"  # does not choose the block
        outside[node] = outside[tree.parent[node]] or tree.tag[node] in ("nav", "footer", "aside", "form", "menu") or any(
            not tree.tokens[node].isdisjoint(names) for names in _TOKENS[:7]
        )
    plain = np.where(outside | top | (links > 0.3 * own), 0.0, own)
    for least in (25, 0):
        text = np.where(own >= least, plain, 0.0)
        for node in range(len(own)):
            up = tree.parent[node]
            # Texts of paragraphs count for their container; those of containers for themselves.
            holder = up if up >= 0 and tree.tag[node] not in _CONTAINERS else node
            score[holder] += text[node]
            if tree.parent[holder] >= 0:
                score[tree.parent[holder]] += text[node] / 2
        if score.any():
            break
    if not score.any():
        return (own > 0).astype(float)
    label = np.zeros(len(own))
    best = int(score.argmax())
    label[best] = 1
    for node in range(best + 1, len(own)):
        label[node] = label[tree.parent[node]] == 1 and not outside[node]
    return label


def _layouts(tree: Tree, label: np.ndarray, seed: int, count: int) -> list[str]:
    """Training pages of the texts of a page: other containers, sidebars, notices, forms, comments.

    Blocks of the article carry the mark ``data-main``, which no feature sees.
    """
    rng = np.random.default_rng(seed)
    texts: dict[int, list[str]] = {}
    for node, text, _ in tree.flow:
        if text is not None and text.strip():
            texts.setdefault(node, []).append(html.escape(" ".join(text.split())))
    blocks = [(tree.tag[n] if tree.tag[n] in ("h1", "h2", "p") else "p", " ".join(t))
              for n, t in texts.items() if label[n] == 1]
    words = " ".join(t for n, ts in texts.items() if label[n] != 1 for t in ts).split() or ["more"]
    if not blocks:
        return []
    body = " ".join(t for _, t in blocks).split()

    def pick(items):
        return items[rng.integers(len(items))]

    def phrase(low, high):
        begin = int(rng.integers(len(words)))
        return " ".join((words + words)[begin : begin + int(rng.integers(low, high))])

    def sentence():
        begin = int(rng.integers(len(body)))
        return " ".join(body[begin : begin + int(rng.integers(6, 40))])

    def linked(tag, attribute, low=3, high=9):
        items = "".join(f'<li><a href="#">{phrase(1, 4)}</a></li>' for _ in range(int(rng.integers(low, high))))
        return f"<{tag}{attribute}><ul>{items}</ul></{tag}>"

    out = []
    for _ in range(count):
        before = [linked("nav", "") if rng.random() < 0.6 else linked("div", pick([' class="menu"', ' id="navbar"', ""]))]
        if rng.random() < 0.5:
            before.append(f"<header><h1>{phrase(1, 4)}</h1><p>{phrase(3, 9)}</p></header>")
        if rng.random() < 0.4:
            name = pick(["cookie-notice", "notice", "alert", "consent"])
            before.append(f'<div class="{name}"><p>{sentence()}</p></div>')
        advert = f'<div class="{pick(["ad", "ads", "advert", "sponsored", "promo"])}">{pick([phrase(6, 25), sentence()])}</div>'
        if rng.random() < 0.7:
            before.append(advert)
        inner = []
        for tag, text in blocks:
            if tag == "p" and rng.random() < 0.12:
                tag = pick(["blockquote", "li", "h2", "pre", "td"])
            start = f"<{tag} data-main>"
            text = f"{start}{text}</{tag}>"
            if tag == "li":
                text = f"<ul>{text}</ul>"
            if tag == "td":
                text = f"<table><tr>{text}</tr></table>"
            inner.append(text)
            if rng.random() < 0.04:
                inner.append(pick([advert, linked("aside", ""), f'<div class="share">{phrase(2, 5)}</div>']))
        tag, attribute = pick([("article", ""), ("main", ""), ("article", ""), ("div", ' id="content"'),
                               ("div", ' class="post"'), ("section", ' class="entry"'), ("div", ""),
                               ("div", ' role="main"')])
        after = []
        if rng.random() < 0.5:
            side = f"<h3>{phrase(1, 4)}</h3><p>{pick([phrase(5, 20), sentence()])}</p>" + linked("div", "", 2, 6)
            after.append(pick([f"<aside>{side}</aside>", f'<div class="sidebar">{side}</div>']))
        if rng.random() < 0.5:
            item = pick(["li", "p", "div"])
            notes = "".join(f"<{item}>{sentence()}</{item}>" for _ in range(int(rng.integers(1, 6))))
            name = pick(['class="comments"', 'id="comments"', 'class="comment-list"'])
            after.append(pick([f"<section {name}><h2>{phrase(1, 3)}</h2>{notes}</section>",
                               f"<div {name}>{notes}</div>"]))
        if rng.random() < 0.4:
            after.append(f"<form><p>{phrase(3, 9)}</p><input name=q><button>{phrase(1, 2)}</button></form>")
        rng.shuffle(after)
        if rng.random() < 0.3:
            inner.append(after.pop() if after else advert)
        foot = f"{phrase(4, 18)} &copy; {phrase(1, 3)}"
        after.append(pick([f"<footer>{foot}</footer>", f'<div class="footer">{foot}</div>']))
        middle = f"<{tag}{attribute}>{''.join(inner)}</{tag}>"
        out.append(f"<html><body>{''.join(before)}{middle}{''.join(after)}</body></html>")
    return out


def _marked(source: str, tree: Tree) -> np.ndarray:
    """Labels of a training page: nodes with the mark and what is below them."""
    marked, markup, position = [False], Markup(source), 0
    while token := markup.next(position):
        _, position, closes, name, attributes = token
        if name is not None and not closes and name not in _INLINE | _VOID | _SILENT:
            marked.append("data-main" in attributes)
    label = np.array(marked, float)
    for node in range(1, len(label)):
        label[node] = max(label[node], label[tree.parent[node]])
    return label


def _training_rows(source: str, seed: int, layouts: int, guess: bool = False) -> tuple[np.ndarray, np.ndarray]:
    tables, labels = [], []

    def add(tree: Tree, label: np.ndarray) -> None:
        table, own = node_features(tree)
        # A node without text of its own has the label of its subtree, if that has one.
        total, main = own.copy(), own * label
        for node in range(len(own) - 1, 0, -1):
            total[tree.parent[node]] += total[node]
            main[tree.parent[node]] += main[node]
        share = main / np.maximum(total, 1)
        clear = (total > 0) & ((own > 0) | (share == 0) | (share == 1))
        tables.append(table[clear])
        labels.append(np.where(own > 0, label, share)[clear])

    tree = parse(source)
    label = _landmarks(tree)
    if label is not None and not any(label[n] == 1 and t and t.strip() for n, t, _ in tree.flow):
        label = None  # a landmark without text
    if label is None and guess:
        label = _guessed(tree)
    if label is not None:
        add(tree, label)
        for page in _layouts(tree, label, seed, layouts):
            made = parse(page)
            add(made, _marked(page, made))
    if not tables:
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    return np.concatenate(tables), np.concatenate(labels)


_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|textarea|title|iframe|noscript)\b.*?(?:</\1\s*>|\z)"
_LANDMARK = r"(?i)<(?:article|main)[\s/>]"


def fit_pages(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, layouts: int = LAYOUTS) -> boosting.Trees:
    """Fit the trees on the nodes of at most ``sample_pages`` pages and of ``layouts`` made of each.

    Pages with a landmark (article, main) label themselves, and the sample is taken among them; the
    layouts put their texts into other containers, with sidebars, notices, adverts, forms and
    comments, so that the trees do not lean on the landmark alone. Where fewer than
    ``LEAST_LANDMARKS`` pages of the sample have one with text, as many pages of any kind are added,
    labelled by ``_guessed`` if they have none. Without any text to fit on, all text is kept.
    """
    source = F.col("html")
    shown = F.regexp_replace(source, _HIDDEN, " ")
    marked = F.when(source.rlike(_LANDMARK), shown.rlike(_LANDMARK)).otherwise(False)
    worded = F.regexp_replace(shown, "<[^>]*>", " ").rlike(r"\S")
    ship_package(pages.sparkSession)
    table, label, first = _measured(pages, marked, sample_pages, layouts, False)
    if first.sum() < LEAST_LANDMARKS:
        more = _measured(pages, worded, sample_pages, layouts, True)
        table, label = np.concatenate([table, more[0]]), np.concatenate([label, more[1]])
    if not len(label):
        table, label = np.zeros((1, len(FEATURES))), np.ones(1)
    return boosting.fit(table, label, trees=40, depth=4, rate=0.25)


def _measured(
    pages: DataFrame, wanted: Column, sample_pages: int, layouts: int, guess: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and whether a row is its page's first, of a sample of the pages ``wanted``."""
    rows = pages.select("page_id", "html").filter("page_id is not null").filter(wanted)
    ids = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    # One row per id, so that a repeated page neither outweighs the others nor goes to the driver whole.
    rows = rows.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table, label = _training_rows(source or "", zlib.crc32(str(page).encode()), layouts, guess)
                columns = [pa.array(label), *[pa.array(c) for c in table.T], pa.array(np.arange(len(label)) == 0)]
                yield pa.RecordBatch.from_arrays(columns, names=["label", *FEATURES, "first"])

    schema = "label double, " + ", ".join(f"{name} double" for name in FEATURES) + ", first boolean"
    found = rows.mapInArrow(measure, schema).toArrow()
    table = np.stack([found.column(name).to_numpy() for name in FEATURES], axis=1)
    return table, found.column("label").to_numpy(), found.column("first").to_numpy()


def extract_text(source: str, model: boosting.Trees) -> str:
    """The main text of one page."""
    tree = parse(source)
    table, own = node_features(tree)
    return flow_text(tree, decode(tree, own, model.predict(table)))


def extract_pages(pages: DataFrame, model: boosting.Trees, source: str = "html", name: str = "text") -> DataFrame:
    """The rows with ``name``: the main text of the whole page, empty if there is none.

    One narrow pass. Other columns pass through, an existing column ``name`` is replaced. Null and
    empty pages have an empty text. Nodes of many pages are scored together.
    """
    kept = [c for c in pages.columns if c != name]
    rows = pages.select(*kept)
    ship_package(pages.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, source, 1 << 20):
                sources = piece.column(piece.schema.get_field_index(source)).to_pylist()
                trees = [parse(s or "") for s in sources]
                tables, owns = zip(*map(node_features, trees))
                chance = np.split(model.predict(np.concatenate(tables)), np.cumsum([len(o) for o in owns])[:-1])
                texts = [flow_text(t, decode(t, o, c)) for t, o, c in zip(trees, owns, chance)]
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(texts, pa.string())], names=[*kept, name])

    return rows.mapInArrow(extract, rows.select("*", F.lit("").alias(name)).schema)


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text and its length."""
    small_batches(spark)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract_pages(pages, fit_pages(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
