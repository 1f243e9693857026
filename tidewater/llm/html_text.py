"""HTML extraction by wrapper induction.

Every distinct page becomes its blocks of text outside labelled boilerplate (menus,
headers, footers, sidebars, notices, adverts, forms, reader comments), each with the
path of labels above it.  Classes and ids that fewer than ``NAME_SHARE`` of a host's
pages have are left out of paths.  Pages of a host whose text is held by the same
element are a layout.  The most frequent tree of labels of a layout is its skeleton;
simple tree matching aligns the tree of every page with it (equal tags, equal names
preferred, order and descent kept), and a page's nodes take the paths of the skeleton
nodes that they are aligned with.  For each host and layout the pages of every (path,
text) and of every node are counted, near copies once for texts (by what is left of a
page without the blocks that are common on the layout, or near copies of such).
Constant texts, on ``SHARE`` of the pages, two at least, are template; the slots that
vary are content.  The root is the deepest node with nearly all varying text, or an
article or main element.  Only hashes, counts and skeletons leave the tasks.  Wrappers
go to all pages of their host: by broadcast while they are small together, else by a join.

Of a page, the text below its own article or main element is kept, or below the root
if that lies deeper or the page has none, without boilerplate and template texts; a
page of no known layout falls back to its article or main element, then to its body.
Inside an article only the labels of what has to go count (``GOES``); outside, further
ones do (``BESIDE``).  Of compound names the first or last part counts (``PART_FIRST``,
``PART_LAST``).  Inside a page's own article a constant text goes only if ``MANY`` groups
have it, before the first or after the last other block, in a node without varying text
that is no heading, or all in links: headings between paragraphs and sentences that
articles share stay.

Defined cases: a null or empty page has the empty text; a null url is host ''; a
layout with one distinct page has no wrapper and its page falls back; repeated rows
give equal texts; an empty table gives an empty one; markup cut off at the end is
dropped, text is kept; references that are not complete by the HTML rules stay as they
are; ``br`` is white space; paths name the first ``DEPTH`` levels, what lies deeper
counts as part of the last, and no level of nesting fails; a very long page costs
memory of its own length times a constant; a column named like the output is replaced,
other columns pass through.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import annotate, materialise, texts_of
from tidewater.llm.jaccard_join import Shingler

SHARE = 0.8  # of the pages of a layout: a text is template, a node can be the root
NAME_SHARE = 0.1  # of the pages of a host: a class or id is no mark of a single page
COMMON = 0.5  # of the pages of a layout: a block tells nothing of near copies
OFTEN = 0.02  # of the pages of a layout: a group of near copies counts as one page
MANY = 3  # groups: what fewer have in common inside their own articles is article text
SKETCH = 4  # near-copy keys of a block
MIX = np.random.default_rng(7).integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BROADCAST_CHARS = 16 << 20  # wrappers of all hosts together

# fixed values: HTML element classes
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
CONTROLS = frozenset("select button textarea option datalist".split())  # parts of forms, also outside of one
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mo mn ms mtext mrow msub msup mfrac msqrt munder mover semantics annotation svg g object noscript select button textarea option datalist template iframe".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOILER_TAGS = frozenset("head nav header footer aside form dialog menu".split()) | CONTROLS
GOES = frozenset(
    "ad ads advert adverts advertisement advertising sponsored nav navbar navigation breadcrumb breadcrumbs sidebar footer header masthead "
    "cookie cookies consent notice notices newsletter subscribe signup login comment comments respond replies disqus".split()
)
BESIDE = frozenset("alert banner menu popup modal search form side sponsor promo promotion subscription reply share sharing social related recommended widget toolbar pagination pager skip".split())
PART_FIRST = frozenset("comment comments cookie cookies".split())  # compound names: comment-list, cookie_notice
PART_LAST = frozenset("footer comments".split())  # site-footer, reader-comments
PART_LAST_BESIDE = frozenset("sidebar nav navigation notice ads".split())  # outside of an article only
NEVER_MAIN = frozenset("comment comments respond reply replies disqus related recommended cookie cookies consent".split())
DEPTH = 64  # levels that a path names
NESTED = 16  # labelled elements within each other that are told apart
LABELLED_SHARE = 0.75  # of a page's text outside links: a labelled element with it is no boilerplate if the page has no article
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
MAIN_TAGS = ("article", "main")
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption".split())

_TAG = re.compile(r"<(?:!--.*?(?:-->|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z)|[a-zA-Z][^>]*(?:>|\Z))", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_SPACE = re.compile(r"[ \t\n\x0b\x0c\r]+")
_PARTS = re.compile(r"[-_]+")
_HEADING = re.compile(r"h[1-6]\Z")
_NUMBER = re.compile(r"[-_]?\d+\Z")
_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}


def _label(tag: str, attrs: str, memo: dict = {}) -> tuple[str, bool, bool, bool]:  # noqa: B006  a bounded memo
    """An element's name with its classes, whether it is labelled boilerplate in an article, and outside of one, and whether by a label that no main text has."""
    key = (tag, attrs)
    if key not in memo:
        if len(memo) > 20_000:
            memo.clear()
        found = {}
        for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
            found.setdefault(name.lower(), (a or b or c).lower().replace("/", "|"))  # a slash parts the labels of a path
        names = f"{found.get('class', '')} {found.get('id', '')}"
        boiler = tag in BOILER_TAGS or found.get("role", "") in BOILER_ROLES
        words = {_NUMBER.sub("", w) for w in names.split()}
        parts = [x for x in (_PARTS.split(w) for w in words) if len(x) > 1]
        readers = any(x[0] in PART_FIRST or x[-1] == "comments" for x in parts)
        beside = boiler
        if tag not in ("html", "body", "article", "main"):
            boiler = boiler or readers or not GOES.isdisjoint(words) or any(x[-1] in PART_LAST for x in parts)
            beside = boiler or not BESIDE.isdisjoint(words) or any(x[-1] in PART_LAST_BESIDE for x in parts)
        main = tag in MAIN_TAGS or found.get("role") == "main"
        memo[key] = (("main:" if main else "") + tag + "." + re.sub(r"\d+", "0", " ".join(sorted(names.split()))), boiler, beside, tag == "head" or readers or not NEVER_MAIN.isdisjoint(words))
    return memo[key]


def blocks(page: str) -> list[tuple[str | None, str, bool, bool]]:
    """(path of labels, text, in boilerplate, in a link) for each run of text, block by block.

    A run that begins a new block follows a (None, '', False, False).  Labels do not
    count on the elements around the article or main element with the most text, if
    all such elements are below labels; on a page without any, not on those around
    the smallest labelled element with ``LABELLED_SHARE`` of the text outside links.
    """
    runs = list(_runs(page))
    if not any(r[2] for r in runs):
        return [(path, text, False, link) for path, text, _, link, _ in runs]
    free = _unlabelled(runs)
    return [(path, text, not free.issuperset(labels), link) for path, text, labels, link, _ in runs]


def _unlabelled(runs) -> frozenset:
    """The labelled elements whose labels do not count."""
    mains: dict[tuple, int] = {}
    held: Counter[tuple] = Counter()
    total = 0
    for _, text, labels, link, main in runs:
        size = 0 if link else len(text.strip())
        if main and size:
            if not main[1]:
                return frozenset()
            mains[main] = mains.get(main, 0) + size
        total += size
        for k in range(1, len(labels) + 1 if size else 0):
            held[labels[:k]] += size
    mains = {m: size for m, size in mains.items() if not any(never for _, never in m[1])}
    if mains:
        return frozenset(max(mains, key=lambda m: (mains[m], -m[0]))[1])
    wide = [x for x, size in held.items() if size >= LABELLED_SHARE * total and not any(never for _, never in x)]
    return frozenset(max(wide, key=len, default=()))


def _runs(page: str):
    """(path, text, labelled elements around it, in a link, (number, labelled elements around it) of its article or main)."""
    stack: list[tuple] = [("", "", (), None)]  # tag, path, labelled elements as (number, never main), outermost article or main
    links, at, end = 0, 0, len(page)

    def shut(tags, barrier=()):
        nonlocal links
        for k in range(len(stack) - 1, 0, -1):
            tag = stack[k][0]
            if tag in tags:
                if links:
                    links -= sum(s[0] == "a" for s in stack[k:])
                del stack[k:]
                return
            if tag in barrier:
                return

    while at < end:
        m = _TAG.search(page, at)
        if m is None or m.start() > at:
            piece = page[at : m.start() if m else end]
            top = stack[-1]
            yield top[1], html.unescape(piece) if "&" in piece else piece, top[2], links > 0, top[3]
        if m is None:
            return
        at = m.end()
        name = m[2]
        if not name:
            continue
        tag = name.lower()
        if m[1]:
            if tag not in INLINE:
                yield None, "", (), False, None
            shut((tag,))
            continue
        if tag in RAW:
            if not (m[3] or "").endswith("/"):
                close = _END[tag].search(page, at)
                at = close.end() if close else end
            if tag not in INLINE:
                yield None, "", (), False, None
            continue
        if tag not in INLINE:
            yield None, "", (), False, None
            if tag in CLOSES_P:
                shut(("p",), ("article", "div", "section", "body", "td", "li"))
            if tag in CLOSES:
                shut(CLOSES[tag], ("ul", "ol", "dl", "table", "select"))
        if tag == "br":
            yield stack[-1][1], " ", stack[-1][2], links > 0, stack[-1][3]
        if tag in VOID:
            continue
        label, boiler, beside, never = _label(tag, m[3] or "")
        _, path, inside, main = stack[-1]
        links += tag == "a"
        marked = (boiler if main else beside) and len(inside) < NESTED
        if label.startswith("main:") and main is None:
            main = (at, inside)
        named = tag not in INLINE and (len(stack) <= DEPTH or (label.startswith("main:") and "/main:" not in path))
        stack.append((tag, f"{path}/{label}" if named else path, (*inside, (at, never)) if marked else inside, main))


def single_spaced(text: str) -> str:
    """White space made single spaces; most texts hold nothing else."""
    if "  " in text or "\n" in text or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text:
        text = _SPACE.sub(" ", text)
    return text.strip(" ")


def joined(runs) -> list[tuple[str, str, bool]]:
    """(path, text, all of it in links) of each non-empty block, white space made single."""
    out, held, path, linked = [], [], "", True
    for where, text, _, link in [*runs, (None, "", False, False)]:
        if where is None:
            if held:
                text = single_spaced("".join(held))
                if text:
                    out.append((path, text, linked))
            held, linked = [], True
        else:
            if not held:
                path = where
            held.append(text)
            linked = linked and (link or not text.strip())
    return out


def _main_of(path: str) -> str:
    """The path down to the first article or main element, or ''."""
    if "/main:" not in path:
        return ""
    parts = path.split("/")
    return next(("/".join(parts[: k + 1]) for k, p in enumerate(parts) if p.startswith("main:")), "")


def extract(page: str | None, wrapper: dict | None) -> str:
    """The main text of one page."""
    if not page:
        return ""
    runs = [r for r in blocks(page) if not r[2]]
    found = joined(runs)
    main = next((x for p, *_ in found if (x := _main_of(p))), "")
    root, fixed, short, layout = main, {}, {}, None
    if wrapper:
        names = wrapper["names"]
        short = {p: plain_path(p, names) for p in dict.fromkeys(r[0] for r in runs if r[0] is not None)}
        own = [short[p] for p, *_ in found]
        layout = wrapper["layouts"].get(layout_of(own, [len(t) for _, t, _ in found]))
        if layout:
            aligned = align(tuple(dict.fromkeys(own)), layout["skeleton"])
            short = {p: placed_path(q, aligned) for p, q in short.items()}
            root, fixed = placed_path(plain_path(main, names), aligned), layout["fixed"]
            below = layout["root"] + "/"
            if layout["root"] and (not main or below.startswith(root + "/")) and any((short[p] + "/").startswith(below) for p, *_ in found):
                root = layout["root"]
    kept = [r for r in runs if r[0] is None or not root or (short.get(r[0], r[0]) + "/").startswith(root + "/")]
    held = [(short.get(p, p), t, linked) for p, t, linked in joined(kept)]
    gone = [text_hash(t) in fixed.get(p, ()) for p, t, _ in held]
    if main and layout:
        gone = _edges([x and (linked or p in layout["still"]) and text_hash(t) not in layout["few"] for x, (p, t, linked) in zip(gone, held, strict=True)])
    return "\n".join(t for (_, t, _), x in zip(held, gone, strict=True) if not x)


def _edges(flags: list[bool]) -> list[bool]:
    """Only the flags before the first and after the last unset one; none if all are set."""
    unset = [k for k, x in enumerate(flags) if not x]
    return [x and not unset[0] < k < unset[-1] for k, x in enumerate(flags)] if unset else [False] * len(flags)


# --- wrapper induction -------------------------------------------------------

class Tree:
    """The nodes above the blocks of a page, like-labelled siblings as one, in page order."""

    def __init__(self, paths):
        self.labels, self.children, self.paths, self.levels = [""], [[]], [""], [[0]]
        found = {"": 0}
        for path in paths:
            at, spelt = 0, ""
            for depth, label in enumerate(path.split("/")[1:], 1):
                spelt = f"{spelt}/{label}"
                if spelt not in found:
                    found[spelt] = len(self.labels)
                    self.children[at].append(len(self.labels))
                    self.labels.append(label)
                    self.children.append([])
                    self.paths.append(spelt)
                    if depth == len(self.levels):
                        self.levels.append([])
                    self.levels[depth].append(found[spelt])
                at = found[spelt]
        self.tags = [x.partition(".")[0] for x in self.labels]


class _Forests:
    """Best scores of the children of two nodes; equal lists of subtrees have one number and are compared once."""

    def __init__(self):
        self.ids: dict[tuple, int] = {}
        self.kids: list[tuple] = []  # (label, number of its own children) of each child
        self.full: list[int] = []  # the score of the list with itself
        self.numbers: dict[str, int] = {}
        self.best: dict[tuple[int, int], int] = {}

    def of(self, tree: Tree) -> list[int]:
        """The number of each node's children."""
        own = [0] * len(tree.labels)
        for level in reversed(tree.levels):
            for i in level:
                key = tuple((tree.labels[c], own[c]) for c in tree.children[i])
                if key not in self.ids:
                    self.ids[key] = len(self.kids)
                    self.kids.append(key)
                    self.full.append(sum(2 + self.full[f] for _, f in key))
                own[i] = self.ids[key]
        return own

    def number(self, word: str) -> int:
        return self.numbers.setdefault(word, len(self.numbers))

    def value(self, f: int, g: int) -> int:
        if f == g:
            return self.full[f]
        if not self.kids[f] or not self.kids[g]:
            return 0
        if (f, g) not in self.best:
            self.best[f, g] = self.table(f, g)[0]
        return self.best[f, g]

    def table(self, f: int, g: int, keep: bool = False) -> tuple[int, int, int, list]:
        """The best score, how many first and last subtrees are equal, and (if ``keep``) where a cell is as the one above and before it.

        Equal subtrees at either end are always matched: no other partner scores more.
        Between them a row of the table is made at once; only bits of rows are held.
        """
        xs, ys = self.kids[f], self.kids[g]
        most = min(len(xs), len(ys))
        head = next((k for k in range(most) if xs[k] != ys[k]), most)
        tail = next((k for k in range(most - head) if xs[-1 - k] != ys[-1 - k]), most - head)
        sure = sum(2 + self.full[h] for _, h in (*xs[:head], *xs[len(xs) - tail :]))
        mine, other = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
        above, bits, gains = np.zeros(len(other) + 1, np.int64), [], {}
        labels = np.array([self.number(label) for label, _ in other], np.int64)
        lists = np.array([h for _, h in other], np.int64)
        tags = np.array([self.number("<" + label.partition(".")[0]) for label, _ in other], np.int64)
        for label, h in mine if other else ():
            tag = self.number("<" + label.partition(".")[0])
            if (tag, h) not in gains:
                if len(gains) > 64:
                    gains.clear()
                gain = (tags == tag).astype(np.int64)
                like = np.flatnonzero(gain)
                kinds, which = np.unique(lists[like], return_inverse=True)
                gain[like] += np.array([self.value(h, k) for k in kinds.tolist()], np.int64)[which]
                gains[tag, h] = gain
            row = np.zeros_like(above)
            row[1:] = np.maximum.accumulate(np.maximum(above[1:], above[:-1] + gains[tag, h] + (labels == self.number(label))))
            if keep:
                bits.append((np.packbits(row == above), np.packbits(np.r_[False, row[1:] == row[:-1]])))
            above = row
        return sure + int(above[-1]), head, tail, bits


def match(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Simple tree matching: pairs of nodes of equal tags that keep order and descent, of the greatest score.

    A pair scores 2 for equal labels and 1 for equal tags alone.  Pairs are read off
    from the roots down.
    """
    held = _Forests()
    of_a, of_b = held.of(a), held.of(b)
    pairs, todo = [], [(0, 0)]
    while todo:
        i, j = todo.pop()
        pairs.append((i, j))
        xs, ys = a.children[i], b.children[j]
        _, head, tail, bits = held.table(of_a[i], of_b[j], keep=True)
        m, n = len(xs) - head - tail, len(ys) - head - tail
        todo += [*zip(xs[:head], ys[:head], strict=True), *zip(xs[len(xs) - tail :], ys[len(ys) - tail :], strict=True)]
        while m and n:
            up, back = (x[n >> 3] >> (7 - (n & 7)) & 1 for x in bits[m - 1])
            if up:
                m -= 1
            elif back:
                n -= 1
            else:
                m, n = m - 1, n - 1
                todo.append((xs[head + m], ys[head + n]))
    return pairs


def align(paths: tuple, skeleton: tuple, memo: dict = {}) -> dict[str, str]:  # noqa: B006  a bounded memo
    """Each node path of a page to the path of the skeleton node it is aligned with; other nodes hang below their aligned parents."""
    key = (paths, skeleton)
    if key not in memo:
        if len(memo) > 2000:
            memo.clear()
        page, other = Tree(paths), Tree(skeleton)
        partner = dict(match(page, other))
        out = {"": ""}
        for level in page.levels[1:]:
            for i in level:
                above = page.paths[i].rpartition("/")[0]
                out[page.paths[i]] = other.paths[partner[i]] if i in partner else f"{out[above]}/{page.labels[i]}"
        memo[key] = out
    return memo[key]


def placed_path(path: str, aligned: dict[str, str]) -> str:
    """The aligned path of a node, which may lie below the aligned ones."""
    above, rest = path, ""
    while above not in aligned:
        above, _, label = above.rpartition("/")
        rest = f"/{label}{rest}"
    return aligned[above] + rest


def names_of(path: str) -> list[str]:
    """The classes and ids in a path of labels."""
    return [w for label in path.split("/") for w in label.partition(".")[2].split()]


def plain_path(path: str, names) -> str:
    """``path`` with only those classes and ids that are in ``names``."""
    cut = (label.partition(".") for label in path.split("/"))
    return "/".join(tag + dot + " ".join(w for w in rest.split() if w in names) for tag, dot, rest in cut)


def layout_of(paths: list[str], sizes: list[int]) -> str:
    """The element that holds most of the page's text: its article or main, else the parent of its text elements."""
    held: Counter[str] = Counter()
    for path, size in zip(paths, sizes, strict=True):
        main = _main_of(path)
        parts = (main or path).split("/")
        while not main and len(parts) > 1 and parts[-1].partition(".")[0] in TEXT_TAGS:
            parts.pop()
        held["/".join(parts)] += size
    return max(held, key=lambda p: (held[p], p), default="")


def block_keys(texts: list[str], shingler: Shingler) -> np.ndarray:
    """SKETCH minima of hashed word pairs of each text: texts that are near copies share some."""
    out = np.empty((len(texts), SKETCH), np.int64)
    split = [t.split() for t in texts]
    long = [i for i, words in enumerate(split) if len(words) >= 4]
    for i in set(range(len(texts))).difference(long):
        out[i] = text_hash(texts[i])
    if long:
        ends = np.cumsum([len(split[i]) for i in long])
        h, _ = shingler.word_hashes([" ".join(split[i]).encode() for i in long], fold=False)
        pairs = h * np.uint64(0x9E3779B97F4A7C15) ^ (np.roll(h, -1) >> np.uint64(7))
        pairs ^= pairs >> np.uint64(31)
        starts, last = np.r_[0, ends[:-1]], ends - 1
        for k, m in enumerate(MIX):
            mixed = pairs * m
            mixed[last] = np.uint64(2**64 - 1)  # pairs end with their text
            out[long, k] = np.minimum.reduceat(mixed, starts).view(np.int64)
    return out


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def facts_of(pages: list[str], shingler: Shingler) -> list[tuple[list[str], list[int], list[int], list[int]]]:
    """Paths, text hashes, sizes and near-copy keys of the blocks outside labelled boilerplate, for each page."""
    found = [joined(r for r in blocks(page) if not r[2]) for page in pages]
    keys = block_keys([t for blocks_ in found for _, t, _ in blocks_], shingler).ravel().tolist()
    out, at = [], 0
    for blocks_ in found:
        end = at + SKETCH * len(blocks_)
        out.append(([p for p, *_ in blocks_], [text_hash(t) for _, t, _ in blocks_], [len(t) for _, t, _ in blocks_], keys[at:end]))
        at = end
    return out


def varying_keys(keys, common) -> list[int]:
    """The near-copy keys of what is left of a page without its blocks that are, nearly at least, common on the layout."""
    table = np.array(keys, np.int64).reshape(-1, SKETCH)
    left = table[~np.isin(table, np.array(common, np.int64)).any(axis=1)]
    return left.min(axis=0).tolist() if len(left) else []


def group_of(keys: list[int], often: dict[int, int], mark: int) -> int | None:
    """The group of near copies of a page: its most frequent key, else the page itself; None if nothing of it varies."""
    return max((k for k in keys if k in often), key=lambda k: (often[k], k), default=mark) if keys else None


def assemble(n: int, nodes: list[tuple[str, int, int]], constant: list[tuple[str, int, int, bool, int]], skeleton: list[str]) -> dict:
    """The wrapper of a layout of ``n`` pages from (path, pages, characters) of nodes and (path, text, characters, is template, groups) of constant texts."""
    spent: Counter[str] = Counter()
    for path, _, size, *_ in constant:
        parts = path.split("/")
        for k in range(1, len(parts) + 1):
            spent["/".join(parts[:k])] += size
    weight = {p: size - spent[p] for p, pages, size in nodes if pages >= SHARE * n}
    total = weight.get("", 0)
    mains = sorted((p for p in weight if p and weight[p] > 0 and _main_of(p) == p), key=lambda p: (len(p), p))
    deep = [p for p in weight if p and weight[p] >= 0.95 * total] if total > 0 else []
    root = mains[0] if mains else max(deep, key=lambda p: (p.count("/"), p), default="")
    parts = root.split("/")
    while parts[-1].partition(".")[0] in TEXT_TAGS:  # a heading is beside the paragraphs
        parts.pop()
    root = "/".join(parts)
    lines: dict[str, list[int]] = {}
    few: set[int] = set()
    for path, text, _, template, groups in sorted(constant):
        if template:
            lines.setdefault(path, []).append(text)
            if groups < MANY:
                few.add(text)
    still = [p for p in lines if weight.get(p, 1) <= 0 and not _HEADING.match(p.rpartition("/")[2].partition(".")[0])]
    return {"root": root, "fixed": lines, "still": still, "few": sorted(few), "skeleton": skeleton}


def block_sizes(paths: list[str], texts: list[int], sizes: list[int]) -> Counter[tuple[str, int]]:
    """Characters of each (path, text)."""
    out: Counter[tuple[str, int]] = Counter()
    for path, text, size in zip(paths, texts, sizes, strict=True):
        out[path, text] += size
    return out


def nodes_of(paths: list[str], sizes: list[int]) -> dict[str, int]:
    """Characters below each node."""
    out: Counter[str] = Counter()
    for path, size in zip(paths, sizes, strict=True):
        parts = path.split("/")
        for k in range(1, len(parts) + 1):
            out["/".join(parts[:k])] += size
    return out


def host_of(url: str):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _facts(pages: DataFrame, url: str, page: str) -> DataFrame:
    """Host, mark, and paths, text hashes, sizes and near-copy keys of blocks: one row per distinct page of a host."""

    def start():
        shingler = Shingler(1)

        def run(batch):
            made = facts_of(texts_of(batch, "html"), shingler)
            marks = [xxhash.xxh3_64_intdigest(np.sort(np.array(m[1], np.int64)).tobytes()) - (1 << 63) for m in made]
            return [marks, *([m[k] for m in made] for k in range(4))]

        return run

    own = pages.select(host_of(url).alias("host"), F.col(page).alias("html")).where("html is not null and html != ''")
    fields = [("mark", T.LongType()), ("paths", T.ArrayType(T.StringType())), ("texts", T.ArrayType(T.LongType())), ("sizes", T.ArrayType(T.IntegerType())), ("keys", T.ArrayType(T.LongType()))]
    made = annotate(own, fields, start, "html", ["host"]).where("size(paths) > 0")
    rest = [n for n, _ in fields[1:]]
    once = made.groupBy("host", "mark").agg(F.min(F.struct(*rest)).alias("f"))  # texts may be equal at other paths; the least stays
    return materialise(once.select("host", "mark", *[F.col(f"f.{c}").alias(c) for c in rest]), "facts")


def _names(facts: DataFrame) -> DataFrame:
    """(host, names): the classes and ids that a share of the host's pages have, and two at least."""

    def run(batches):
        for batch in batches:
            names = [sorted({w for p in set(paths) for w in names_of(p)}) for paths in texts_of(batch, "paths")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.list_(pa.string()))], names=["host", "names"])

    used = facts.select("host", "paths").mapInArrow(run, "host string, names array<string>").select("host", F.explode("names").alias("name"))
    often = used.groupBy("host", "name").agg(F.count("*").alias("k")).join(facts.groupBy("host").agg(F.count("*").alias("n")), "host")
    return often.where((F.col("k") >= 2) & (F.col("k") >= NAME_SHARE * F.col("n"))).groupBy("host").agg(F.sort_array(F.collect_list("name")).alias("names"))


def _spread(left: DataFrame, right: DataFrame, small: bool, on: str | list[str]) -> DataFrame:
    return left.join(F.broadcast(right) if small else right, on, "left")


def _placed(facts: DataFrame, names: DataFrame, small: bool) -> DataFrame:
    """Facts with their layout, paths of stable names only, and a hash of the tree of labels."""
    rest = [c for c in facts.columns if c not in ("host", "mark", "paths")]
    held = _spread(facts, names, small, "host").select("host", "mark", "paths", "sizes", "names", *[F.col(c).alias(f"_{c}") for c in rest])

    def run(batches):
        for batch in batches:
            layouts, plain, shapes = [], [], []
            for paths, sizes, known in zip(*(texts_of(batch, c) for c in ("paths", "sizes", "names")), strict=True):
                known = frozenset(known or ())
                short = {p: plain_path(p, known) for p in set(paths)}
                plain.append([short[p] for p in paths])
                layouts.append(layout_of(plain[-1], sizes))
                shapes.append(text_hash("\n".join(dict.fromkeys(plain[-1]))))
            columns = [pa.array(layouts, pa.string()), batch.column(0), batch.column(1), pa.array(plain, pa.list_(pa.string())), pa.array(shapes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(5 + k) for k in range(len(rest)))], names=["layout", "host", "mark", "paths", "shape", *rest])

    kinds = {f.name: f.dataType.simpleString() for f in facts.schema.fields}
    return held.mapInArrow(run, "layout string, host string, mark long, paths array<string>, shape long, " + ", ".join(f"{c} {kinds[c]}" for c in rest))


def _skeletons(placed: DataFrame) -> tuple[DataFrame, bool]:
    """(host, layout, skeleton): the node paths of the most frequent tree of labels; and whether they are small together."""
    shapes = placed.groupBy("host", "layout", "shape").agg(F.count("*").alias("k"), F.min(F.array_distinct("paths")).alias("skeleton"))
    made = materialise(shapes.groupBy("host", "layout").agg(F.max_by("skeleton", F.struct("k", "shape")).alias("skeleton")), "skeletons")
    return made, (made.agg(F.sum(F.length("host") + F.length("layout") + F.length(F.concat_ws("/", "skeleton")))).first()[0] or 0) <= BROADCAST_CHARS


def _per_layout(counted: DataFrame, n: DataFrame, share: float, name: str) -> tuple[DataFrame, bool]:
    """(host, layout, keys, counts) of keys on a share of the pages, at most a fixed number for each block of a page; and whether they are small."""
    rows = counted.groupBy("host", "layout", "key").agg(F.count("*").alias("k")).where("k > 1").join(n, ["host", "layout"]).where(F.col("k") >= share * F.col("n"))
    made = materialise(rows.groupBy("host", "layout").agg(F.collect_list(F.struct("key", "k")).alias(name)), name)
    return made, (made.agg(F.sum(F.length("host") + F.length("layout") + 16 * F.size(name))).first()[0] or 0) <= BROADCAST_CHARS


def _groups(placed: DataFrame, n: DataFrame, skeletons: DataFrame, few: bool) -> DataFrame:
    """host, layout, ``g``, the group of near copies that counts as one page, and the page's distinct blocks and nodes at their aligned paths.

    Blocks that are common on a layout, or near copies of such blocks, tell nothing;
    of the rest, pages that share a frequent key are near copies.  A group on under
    ``OFTEN`` of the pages cannot make a text template, so its pages may count alone.
    Pages without a rest have no group.
    """
    key = ["host", "layout"]
    common, small = _per_layout(placed.select(*key, F.explode(F.array_distinct("keys")).alias("key")), n, COMMON, "common")
    held = _spread(placed.select(*key, "mark", "paths", "texts", "sizes", "keys"), common, small, key)

    def vary(batches):
        for batch in batches:
            common = [[c["key"] for c in x or ()] for x in texts_of(batch, "common")]
            left = [varying_keys(k, c) for k, c in zip(texts_of(batch, "keys"), common, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(6)), pa.array(left, pa.list_(pa.int64()))], names=[*batch.schema.names[:6], "rest"])

    rest = held.mapInArrow(vary, "host string, layout string, mark long, paths array<string>, texts array<long>, sizes array<int>, rest array<long>")
    often, small = _per_layout(rest.select(*key, F.explode(F.array_distinct("rest")).alias("key")), n, OFTEN, "often")
    block = pa.list_(pa.struct([("path", pa.string()), ("text", pa.int64()), ("size", pa.int64())]))
    node = pa.list_(pa.struct([("path", pa.string()), ("size", pa.int64())]))

    def group(batches):
        for batch in batches:
            often = [{c["key"]: c["k"] for c in x or ()} for x in texts_of(batch, "often")]
            made = [group_of(k, o, m) for k, o, m in zip(texts_of(batch, "rest"), often, texts_of(batch, "mark"), strict=True)]
            blocks_, nodes = [], []
            for paths, texts, sizes, skeleton in zip(*(texts_of(batch, c) for c in ("paths", "texts", "sizes", "skeleton")), strict=True):
                aligned = align(tuple(dict.fromkeys(paths)), tuple(skeleton))
                paths = [aligned[p] for p in paths]
                blocks_.append([{"path": p, "text": t, "size": size} for (p, t), size in block_sizes(paths, texts, sizes).items()])
                nodes.append([{"path": p, "size": size} for p, size in nodes_of(paths, sizes).items()])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.int64()), pa.array(blocks_, block), pa.array(nodes, node)], names=["host", "layout", "g", "blocks", "nodes"])

    schema = "host string, layout string, g long, blocks array<struct<path:string,text:long,size:long>>, nodes array<struct<path:string,size:long>>"
    return _spread(_spread(rest, often, small, key), skeletons, few, key).mapInArrow(group, schema)


def learn_wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, wrapper as JSON) for hosts that have a layout with two distinct pages.

    Every page counts; what leaves the tasks are hashes, counts and skeletons.
    """
    facts = _facts(pages, url, page)
    names = materialise(_names(facts), "names")
    small = (names.agg(F.sum(F.length("host") + F.length(F.concat_ws(" ", "names")))).first()[0] or 0) <= BROADCAST_CHARS
    placed = materialise(_placed(facts, names, small), "placed")
    key = ["host", "layout"]
    n = materialise(placed.groupBy(key).agg(F.count("*").alias("n")).where("n > 1"), "layouts")
    skeletons, few = _skeletons(placed)
    groups = materialise(_groups(placed, n, skeletons, few), "groups")
    nodes = groups.select(*key, F.explode("nodes").alias("x")).groupBy(*key, "x.path").agg(F.count("*").alias("k"), F.sum("x.size").alias("chars"))
    nodes = nodes.join(n, key).where(F.col("k") >= SHARE * F.col("n")).select(*key, "n", "path", F.lit(None).cast("long").alias("text"), "k", "chars", F.lit(False).alias("template"))
    units = groups.groupBy(key).agg(F.count_distinct("g").alias("units"))
    block = groups.select(*key, "g", F.explode("blocks").alias("x")).groupBy(*key, "x.path", "x.text", "g").agg(F.count("*").alias("pages"), F.sum("x.size").alias("chars"))
    counted = block.groupBy(*key, "path", "text").agg(F.count("g").alias("k"), F.sum("pages").alias("pages"), F.sum("chars").alias("chars")).where("pages > 1")
    constant = counted.join(n, key).join(units, key).withColumn("template", (F.col("k") > 1) & (F.col("k") >= SHARE * F.col("units"))).where(F.col("template") | (F.col("pages") >= SHARE * F.col("n")))
    constant = constant.select(*key, "n", "path", "text", "k", "chars", "template")

    def per_host(held: pd.DataFrame) -> pd.DataFrame:
        layouts = {}
        for layout, rows in held.groupby("layout"):
            node, line, shape = rows[rows["text"].isna() & (rows["k"] > 0)], rows[~rows["text"].isna()], rows[rows["k"] == 0]
            listed = lambda x, *c: list(zip(*(x[k].tolist() for k in c), strict=True))
            if len(node):
                counted = [(p, int(t), c, bool(x), k) for p, t, c, x, k in listed(line, "path", "text", "chars", "template", "k")]
                layouts[layout] = assemble(int(node["n"].iloc[0]), listed(node, "path", "k", "chars"), counted, shape["path"].iloc[0].split("\n"))
        made = json.dumps({"names": (held["names"].iloc[0] or "").split(), "layouts": layouts})
        return pd.DataFrame([(held["host"].iloc[0], made)] if layouts else [], columns=["host", "wrapper"])

    shapes = n.join(skeletons, key).select(*key, "n", F.concat_ws("\n", "skeleton").alias("path"), F.lit(None).cast("long").alias("text"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("chars"), F.lit(False).alias("template"))
    rows = nodes.unionByName(constant).unionByName(shapes).withColumn("text", F.col("text").cast("string"))  # a hash must not pass through a float
    rows = _spread(rows, names.select("host", F.concat_ws(" ", "names").alias("names")), small, "host")
    return rows.groupBy("host").applyInPandas(per_host, "host string, wrapper string")


def _ready(wrapper: str) -> dict:
    made = json.loads(wrapper)
    made["names"] = frozenset(made["names"])
    for layout in made["layouts"].values():
        layout["fixed"] = {path: frozenset(texts) for path, texts in layout["fixed"].items()}
        layout["still"], layout["few"] = frozenset(layout["still"]), frozenset(layout["few"])
        layout["skeleton"] = tuple(layout["skeleton"])
    return made


def main_text(pages: DataFrame, url: str = "url", page: str = "html", out: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``out``, the main text of each page."""
    keep = pages.columns if keep is None else keep
    wrappers = materialise(learn_wrappers(pages, url, page), "wrappers")
    size = wrappers.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    own = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"), host_of(url).alias("host"), F.coalesce(F.col(page), F.lit("")).alias("__html"))
    joined_ = own.join(F.broadcast(wrappers) if size <= BROADCAST_CHARS else wrappers, "host", "left")

    def start():
        read: dict[str | None, dict | None] = {None: None}

        def run(batch):
            out = []
            for text, wrapper in zip(texts_of(batch, "__html"), texts_of(batch, "wrapper"), strict=True):
                if wrapper not in read:
                    if len(read) > 1000:
                        read.clear()
                        read[None] = None
                    read[wrapper] = _ready(wrapper)
                out.append(extract(text, read[wrapper]))
            return [out]

        return run

    made = annotate(joined_, [("__text", T.StringType())], start, "__html", ["__row", "wrapper"])
    return made.select(*[F.col(f"__row.`{c}`").alias(c) for c in keep if c != out], F.col("__text").alias(out))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    done = main_text(pages.select("page_id", "url", "html"), keep=["page_id", "url"])
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
