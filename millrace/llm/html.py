"""Main text of web pages by gradient-boosted trees over DOM nodes and hierarchical decoding.

A page becomes a tree of elements. Each element has features of its subtree (text, links, tags, punctuation), its tag and
attribute tokens, its depth and its siblings. Boosted regression trees, trained on pages that the operator composes itself from
paragraphs of a bounded sample (so what is article and what is not is known), give every element the log-odds of
holding main text. Decoding takes the best set of elements in which each kept one has kept ancestors, so a page is
never cut into contradictory parts. The text of the kept elements is read off in page order.

Defined results: null and empty html, and pages without elements kept, give the empty text; scripts, styles, form controls, embedded objects
and hidden elements are never text; character references are decoded; white space inside a block, line breaks
included, is one space; blocks are joined by an empty line. Very long pages are one tree each; repeated rows and rows of
equal or null ``page_id`` are pages of their own; an empty table gives no rows. Extra columns pass through, but for ``text`` and ``n_chars``, which are replaced.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
TOKEN = re.compile(r"[a-z]+")

# Element kinds of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
NEVER = frozenset("script style textarea title iframe noembed noframes xmp head select option button object svg template canvas audio video map datalist".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    header hgroup hr html legend li main menu nav ol p pre section summary table caption tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
# an opening tag ends these open ones, up to the given bounds
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
        "option": ({"option"}, {"select"})}
GROUPS = ["article main", "section", "div", "p blockquote pre", "h1 h2 h3 h4 h5 h6", "ul ol menu dl", "li dt dd", "table tbody tr td th", "nav", "header",
          "footer", "aside", "form fieldset label", "a", "b i em strong span u code q cite small sup sub mark", "figure figcaption img"]
GROUP_OF = {t: i for i, g in enumerate(GROUPS) for t in g.split()}
GOOD = frozenset("article content main post entry body story text hentry blog page prose".split())
BAD = frozenset("""nav navbar navigation menu menubar sidebar side aside footer foot header masthead comment comments respond reply replies discussion ad ads advert
    adverts advertisement banner promo promoted sponsor sponsored share sharing social related recommended more cookie cookies consent notice alert newsletter subscribe
    signup login search breadcrumb breadcrumbs pagination pager widget popup modal overlay copyright legal disclaimer toolbar tags meta author byline form dialog""".split())
N_FEATURES = len(GROUPS) + 18


@dataclass
class Page:
    tags: list[str] = field(default_factory=list)
    attrs: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    events: list[tuple[int, str | None]] = field(default_factory=list)   # (element, text), or (element, None) for a block border


def parse(source: str) -> Page:
    page = Page(["#"], [""], [-1])
    tags, attrs, parents, events = page.tags, page.attrs, page.parents, page.events
    stack, at, n, muted = [0], 0, len(source), 0

    def close(k: int) -> None:
        nonlocal muted
        while len(stack) > k:
            e = stack.pop()
            if tags[e][:1] == "!":
                muted -= 1
            if tags[e] in BLOCK:
                events.append((stack[-1], None))

    while at < n:
        m = MARKUP.search(source, at)
        if m is None:
            if not muted:
                events.append((stack[-1], source[at:]))
            break
        if m.start() > at and not muted:
            events.append((stack[-1], source[at: m.start()]))
        at = m.end()
        end, begin = m.group(1), m.group(2)
        if end:
            end = end.lower()
            for k in range(len(stack) - 1, 0, -1):
                if tags[stack[k]].lstrip("!") == end:
                    close(k)
                    break
        elif begin:
            tag, raw = begin.lower(), m.group(3) or ""
            if tag == "br":
                if not muted:
                    events.append((stack[-1], " "))
                continue
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] == "p":
                        close(k)
                        break
                    if tags[stack[k]] in BLOCK:
                        break
            if tag in ENDS:
                mine, bounds = ENDS[tag]
                for k in range(len(stack) - 1, 0, -1):
                    if tags[stack[k]] in bounds:
                        break
                    if tags[stack[k]] in mine:
                        close(k)
                        if tag not in ("tr", "tbody"):
                            break
            names, gone = "", tag in NEVER
            if raw:
                for a in ATTRIBUTE.finditer(raw):
                    name = a.group(1).lower()
                    if name in ("class", "id", "role", "itemprop"):
                        names += " " + (a.group(2) or a.group(3) or a.group(4) or "").lower()
                    elif name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", a.group(2) or a.group(3) or "", re.I):
                        gone = True
            parents.append(stack[-1])
            tags.append("!" + tag if gone else tag)
            attrs.append(names)
            e = len(tags) - 1
            if tag in BLOCK:
                events.append((stack[-1], None))
            if tag in RAW:
                stop = re.compile(rf"</{tag}[^>]*>", re.I).search(source, at)
                at = stop.end() if stop else n
            elif tag not in VOID and not raw.endswith("/"):
                stack.append(e)
                muted += gone
    return page


def features(page: Page) -> np.ndarray:
    """One row for each element; the first is the page itself."""
    n = len(page.tags)
    own, links, stops = [0] * n, [0] * n, [0] * n
    for e, text in page.events:
        if text is not None:
            k = len(text) - text.count(" ") if len(text) < 40 else len(text)
            own[e] += k
            stops[e] += text.count(".") + text.count(",")
    good, bad = [0] * n, [0] * n
    for e, names in enumerate(page.attrs):
        if names:
            tokens = TOKEN.findall(names)
            good[e] = sum(t in GOOD for t in tokens)
            bad[e] = sum(t in BAD for t in tokens)
    parents, tags = page.parents, page.tags
    depth, above_bad, above_good, in_link = [0] * n, [0] * n, [0] * n, [False] * n
    order, siblings, alike = [0] * n, [0] * n, [0] * n
    kinds: dict[tuple[int, str], int] = {}
    for e in range(1, n):
        p = parents[e]
        depth[e] = depth[p] + 1
        above_bad[e] = above_bad[p] + (bad[p] > 0) + (tags[p] in ("nav", "footer", "aside", "form"))
        above_good[e] = above_good[p] + (good[p] > 0) + (tags[p] in ("article", "main"))
        in_link[e] = in_link[p] or tags[e] == "a"
        order[e] = siblings[p]
        siblings[p] += 1
        kinds[p, tags[e]] = kinds.get((p, tags[e]), 0) + 1
    text, size, paragraphs, items, controls, marks = own[:], [1] * n, [t in ("p", "blockquote", "pre") for t in tags], [t == "li" for t in tags], [t in ("!input", "input", "!button", "!select", "!textarea", "label") for t in tags], stops[:]
    links = [own[e] if in_link[e] else 0 for e in range(n)]
    for e in range(n - 1, 0, -1):
        p = parents[e]
        text[p] += text[e]
        links[p] += links[e]
        size[p] += size[e]
        paragraphs[p] += paragraphs[e]
        items[p] += items[e]
        controls[p] += controls[e]
        marks[p] += marks[e]
    x = np.zeros((n, N_FEATURES), np.float32)
    for e, tag in enumerate(tags):
        g = GROUP_OF.get(tag)
        if g is not None:
            x[e, g] = 1
    g = len(GROUPS)
    a = {k: np.array(v, np.float32) for k, v in dict(text=text, links=links, size=size, par=paragraphs, items=items, controls=controls, marks=marks, depth=depth,
                                                      good=good, bad=bad, up_bad=above_bad, up_good=above_good, order=order, own=own).items()}
    up = np.array([max(p, 0) for p in parents])
    several = np.array([siblings[p] for p in up], np.float32)
    same = np.array([kinds.get((p, t), 1) for p, t in zip(up.tolist(), tags)], np.float32)
    total = max(text[0], 1)
    columns = [a["good"], a["bad"], a["up_good"], a["up_bad"], np.log1p(a["text"]), a["links"] / np.maximum(a["text"], 1), np.log1p(a["text"] / a["size"]),
               a["text"] / total, a["marks"] / np.maximum(a["text"], 1), a["par"], a["items"] / a["size"], np.minimum(a["controls"], 5), a["depth"], several,
               same / np.maximum(several, 1), a["order"] / np.maximum(several, 1), a["text"] / np.maximum(a["text"][up], 1), np.log1p(a["own"])]
    for k, c in enumerate(columns):
        x[:, g + k] = c
    return x


@dataclass
class Boosted:
    """Sum of regression trees of one depth, each stored as a full binary tree."""

    base: float
    feature: np.ndarray    # (tree, inner node)
    bar: np.ndarray        # go right above it
    leaf: np.ndarray       # (tree, leaf)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        depth = self.leaf.shape[1].bit_length() - 1
        rows = np.arange(len(x))
        for f, b, leaf in zip(self.feature, self.bar, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > b[node])
            out += leaf[node - (len(leaf) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, penalty: float = 2.0) -> Boosted:
    """Newton boosting of the logistic loss on histograms."""
    n, d = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    code = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(n, base)
    inner, found = (1 << depth) - 1, []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        f, b, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.full(count, 1e-6)
            for j in range(d):
                m = len(edges[j])
                if not m:
                    continue
                key = (node - first) * (m + 1) + code[:, j]
                gs = np.bincount(key, g, count * (m + 1)).reshape(count, m + 1)
                hs = np.bincount(key, h, count * (m + 1)).reshape(count, m + 1)
                gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                gt, ht = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                gain = gl**2 / (hl + penalty) + (gt - gl) ** 2 / (ht - hl + penalty) - gt**2 / (ht + penalty)
                k = gain.argmax(1)
                top = gain[np.arange(count), k]
                win = top > best
                best[win] = top[win]
                f[first: first + count][win] = j
                b[first: first + count][win] = edges[j][k[win]]
            node = 2 * node + 1 + (x[np.arange(n), f[node]] > b[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + penalty)
        score += leaf[at]
        found.append((f, b, leaf))
    return Boosted(base, *(np.stack(v) for v in zip(*found)))


def decode(parents: list[int], score: list[float]) -> list[bool]:
    """The most likely elements such that the parents of kept ones are kept; the page itself is."""
    n = len(parents)
    keep, drop = score[:], [-s for s in score]
    for e in range(n - 1, 0, -1):
        p = parents[e]
        keep[p] += max(keep[e], drop[e])
        drop[p] += drop[e]
    kept = [True] * n
    for e in range(1, n):
        kept[e] = kept[parents[e]] and keep[e] > drop[e]
    return kept


def text_of(page: Page, kept: list[bool]) -> str:
    blocks, run = [], []
    for e, text in page.events:
        if text is None:
            if run:
                blocks.append("".join(run))
                run = []
        elif kept[e]:
            run.append(text)
    if run:
        blocks.append("".join(run))
    return "\n\n".join(b for b in (" ".join(references.unescape(x).split()) for x in blocks) if b)


def compose(paragraphs: list[str], seed: int) -> list[tuple[str, str]]:
    """A page as ``(markup, kind)`` pieces, kind "+" for article, "-" for the rest and "." for containers of both."""
    rng = np.random.default_rng(seed)

    def some(lo: int, hi: int, short: bool = False) -> list[str]:
        out = [paragraphs[k] for k in rng.integers(0, len(paragraphs), rng.integers(lo, hi + 1))]
        return [" ".join(t.split()[: int(rng.integers(1, 7))]) for t in out] if short else out

    def pick(*options: str) -> str:
        return options[rng.integers(len(options))]

    def links(kind: str) -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{t}</a></li>' for t in some(3, 8, True)) + "</ul>" if kind == "ul" else "".join(f'<a href="#">{t}</a> ' for t in some(3, 8, True))

    def wrap(names: str, tags: str, inner: str) -> tuple[str, str]:
        tag = pick(*tags.split())
        name = f' {pick("class", "id")}="{pick(*names.split())}"' if names and rng.random() < 0.85 else ""
        return f"<{tag}{name}>{inner}</{tag}>", "-"

    def paras(lo: int, hi: int) -> str:
        return "".join(f"<p>{t}</p>" for t in some(lo, hi))

    def boilerplate() -> tuple[str, str]:
        return [
            lambda: wrap("menu main-nav navbar topmenu", "nav nav div", links(pick("ul", "flat"))),
            lambda: wrap("header site-header masthead", "header header div", pick("<h1>{}</h1>", "<div>{}</div>", "<b>{}</b>").format(some(1, 1, True)[0].replace("{", "").replace("}", "")) + links("flat")),
            lambda: wrap("sidebar side related widget", "aside aside div", f"<h3>{some(1, 1, True)[0]}</h3>" + links("ul") + (paras(1, 1) if rng.random() < 0.5 else "")),
            lambda: wrap("ad advert ads promo sponsored banner", "div div aside section", pick(f"<p>{some(1, 1)[0]}</p>", some(1, 1)[0], some(1, 1, True)[0])),
            lambda: wrap("cookie-notice notice consent alert", "div div section", paras(1, 1) + "<button>OK</button>"),
            lambda: ("<form action='/s'><label>" + some(1, 1, True)[0] + "</label><input name='q'><p>" + some(1, 1, pick("", "1") == "1")[0] + "</p><button>Go</button></form>", "-"),
            lambda: wrap("comments reader-comments discussion", "section div", f"<h3>{some(1, 1, True)[0]}</h3>" + "".join(
                f'<div class="{pick("comment", "reply", "comment-body")}"><b>{some(1, 1, True)[0]}</b>{paras(1, 2)}</div>' for _ in range(rng.integers(1, 5)))),
            lambda: wrap("share social tags breadcrumb pagination", "div ul p", links("flat")),
            lambda: wrap("newsletter subscribe signup", "div section", paras(1, 1) + "<input><button>Go</button>"),
            lambda: wrap("footer copyright legal", "footer footer div", pick(some(1, 1)[0], "&copy; " + some(1, 1, True)[0], links("flat"))),
        ][rng.integers(10)]()

    def block() -> tuple[str, str]:
        t = some(1, 1)[0]
        return pick(*[f"<p>{t}</p>"] * 7, f"<p><b>{t}</b></p>", f"<p><b>{t}<br><p>{t}</p>", f"<h2>{' '.join(t.split()[:int(rng.integers(1, 8))])}</h2>", f"<blockquote><p>{t}</p></blockquote>",
                    "<ul>" + "".join(f"<li>{x}</li>" for x in some(2, 5)) + "</ul>", f"<p>{t} <a href='/y'>{' '.join(t.split()[:3])}</a> {t}</p>",
                    f"<table><tr><td>{t}</td><td>{t}</td></tr></table>", f"<figure><img><figcaption>{t}</figcaption></figure>", f"<div>{t}</div>", f"<pre>{t}</pre>"), "+"

    out: list[tuple[str, str]] = [("<html><head><title>t</title><style>p{}</style></head><body>", ".")]
    out += [boilerplate() for _ in range(rng.integers(0, 5))]
    tag = pick("article", "article", "main", "div", "section")
    name = f' {pick("class", "id")}="{pick("article", "content", "post-body", "entry-content", "main-text", "story")}"' if tag in ("div", "section") and rng.random() < 0.8 else ""
    wrapped = rng.random() < 0.3
    out.append(((f'<div class="{pick("wrapper", "container", "page", "row")}">' if wrapped else "") + f"<{tag}{name}>", "."))
    if rng.random() < 0.8:
        out.append((f"<h1>{' '.join(some(1, 1)[0].split()[:int(rng.integers(1, 12))])}</h1>", "+"))
    for _ in range(rng.integers(1, 14)):
        out.append(block())
        if rng.random() < 0.1:
            out.append(boilerplate())
    out.append((f"</{tag}>", "."))
    if wrapped:
        out += [boilerplate() for _ in range(rng.integers(0, 2))] + [("</div>", ".")]
    out += [boilerplate() for _ in range(rng.integers(0, 5))] + [("</body></html>", ".")]
    return out


def train(paragraphs: list[str], n_pages: int = 700) -> Boosted:
    """Trees from composed pages; an element is positive if it holds article text."""
    xs, ys = [], []
    for k in range(n_pages):
        pieces = compose(paragraphs, k)
        # every text run of the article carries a mark while labels are taken
        marked = parse("".join(re.sub(r">([^<])", ">\x01\\1", s) if kind == "+" else s for s, kind in pieces))
        page = parse("".join(s for s, _ in pieces))
        label = [0] * len(marked.tags)
        for e, text in marked.events:
            if text and "\x01" in text:
                label[e] = 1
        for e in range(len(label) - 1, 0, -1):
            label[marked.parents[e]] |= label[e]
        xs.append(features(page))
        ys.append(label)
    return boost(np.concatenate(xs), np.concatenate(ys).astype(float))


def sample_paragraphs(pages: DataFrame, sample_pages: int) -> list[str]:
    """Text runs of a bounded sample of pages, and a few plain ones where there are none."""
    step = max(1, pages.count() // sample_pages)
    rows = pages.where(F.col("html").isNotNull()).where(F.pmod(F.xxhash64("page_id"), F.lit(step)) == 0).select(F.substring("html", 1, 20_000)).limit(2 * sample_pages)
    out = [t for r in rows.toLocalIterator() for t in re.findall(r"<p>([^<]{3,2000})", r[0])]
    return sorted(set(out))[:20_000] or ["A plain sentence, with a comma and an end.", "Another one that is a little longer than the first one was."]


def main_text(pages: DataFrame, sample_pages: int = 200) -> DataFrame:
    """All columns of ``pages`` but html, with ``text`` and ``n_chars``. The trees are trained on at most ``2 * sample_pages`` pages."""
    model = train(sample_paragraphs(pages, sample_pages))
    kept_columns = [f for f in pages.schema.fields if f.name not in ("html", "text", "n_chars")]
    names = [f.name for f in kept_columns]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            held: list[Page] = []
            parts: list[np.ndarray] = []
            for source in [*batch.column("html").to_pylist(), None]:
                if source:
                    held.append(parse(source))
                    parts.append(features(held[-1]))
                else:
                    held.append(Page(["#"], [""], [-1]))
                    parts.append(np.zeros((1, N_FEATURES), np.float32))
                if sum(map(len, parts)) > 20_000 or len(held) + len(texts) > batch.num_rows:
                    score = model.scores(np.concatenate(parts)).tolist()
                    at = 0
                    for page in held:
                        texts.append(text_of(page, decode(page.parents, score[at: at + len(page.tags)])))
                        at += len(page.tags)
                    held, parts = [], []
            texts = texts[: batch.num_rows]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*names, "text", "n_chars"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept_columns)
    return pages.select(*names, "html").mapInArrow(task, f"{kinds}{', ' if kinds else ''}text string, n_chars long")
