"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags. Each block is a vector of its tag path (tags,
classes and ids on the way down, hashed), its words (hashed) and a few densities. A bidirectional LSTM in numpy reads
the blocks of the whole page and gives each the probability that it belongs to the article.

The labeller is trained on the driver on ``TRAIN_PAGES`` pages drawn from random layouts (:func:`layout_page`) whose
blocks are labelled by construction; words are random, so that what it learns is structure. The seed is fixed and
the weights (about 100 KB) go to the tasks with the function.

Edge cases: NULL and empty html, and pages without a block labelled as article, give an empty text; broken markup
(unclosed or stray tags, bare ``<``) never fails, and an element without text (``head``, ``select``, ``svg`` and the
like) left open ends where a block starts that cannot stand inside it; repeated rows, NULL ids and urls are carried through; an empty
table gives an empty result. Only the id, url and html columns are read.
"""

from __future__ import annotations

import functools
import html
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from mercato.llm.common import map_texts

PATH_DIM, WORD_DIM, STATS = 128, 16, 8
DIM = PATH_DIM + WORD_DIM + STATS
HIDDEN = 16
TRAIN_PAGES = 480
EPOCHS = 14
#: Block vectors held at once while scoring.
MAX_CELLS = 20_000

# Elements of HTML that end a block, that hold no text, and that are closed by the next of their kind.
BLOCK_TAGS = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html iframe label legend li main menu nav
 ol option p pre section select summary table tbody td tfoot th thead tr ul""".split())
SILENT_TAGS = frozenset("head script style noscript template svg math iframe object textarea select title".split())
RAW_TAGS = frozenset("script style textarea title".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_NEXT = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
                  "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: What may stand in ``head``; any other element or text ends it. Inside the second set it goes on.
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
HEAD_INNER = frozenset("noframes noscript template".split())
#: Elements that end a ``select`` left open are the block elements but these; for svg and math, those outside HTML parts.
SELECT_TAGS = frozenset("option hr legend button".split())
HTML_PARTS = frozenset("foreignobject desc annotation-xml".split())
#: Silent elements that can hold any block: without an end tag they are not taken as open.
NEEDS_END = frozenset("noscript iframe object template".split())
CLOSES_P = BLOCK_TAGS - {"br", "button", "label", "option", "legend"}

#: Deeper elements become the next ones of their parent, as in browsers; this bounds the paths of a page, not its text.
MAX_DEPTH = 512

_START = re.compile(r"<!--|<(/?)([a-zA-Z][^\s/>]*)|<[!?]")
_QUOTE_OR_END = re.compile("[>\"']")
_RAW_ENDS = {t: re.compile(f"</{t}", re.I) for t in RAW_TAGS}
_ENDS = {t: re.compile(rf"<(/?){t}(?=[\s/>])", re.I) for t in NEEDS_END}
_DIGIT = re.compile(r"[0-9]")
_ATTR = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class Block:
    __slots__ = ("path", "text", "link_chars")

    def __init__(self, path: tuple[str, ...], text: str, link_chars: int) -> None:
        self.path, self.text, self.link_chars = path, text, link_chars


def _ends_silent(name: str, inner: set[str], tag: str) -> bool:
    """Whether the start of ``tag`` ends the silent element ``name`` left open, with ``inner`` open inside it."""
    if name == "head":
        return tag == "body" or (tag not in HEAD_TAGS and not inner & HEAD_INNER)
    if name == "select":
        return tag in BLOCK_TAGS and tag not in SELECT_TAGS
    return name in ("svg", "math") and tag in BLOCK_TAGS and not inner & HTML_PARTS


class _TagEnds:
    """Where the tags of a page end, in time linear in the page.

    A tag ends at the first > outside quotes. Where a quote is left open, it ends at the next >; the places between
    quotes from which a scan has found no end are kept, so that no later tag goes the same way again."""

    def __init__(self, page: str) -> None:
        self.page, self.open_ended = page, set()

    def end(self, at: int) -> int:
        """The index behind the tag whose name ends at ``at``, or -1 if no > follows."""
        page, seen, place = self.page, [], at
        while place not in self.open_ended:
            seen.append(place)
            m = _QUOTE_OR_END.search(page, place)
            if m is None:
                break
            if m[0] == ">":
                return m.end()
            place = page.find(m[0], m.end()) + 1
            if not place:
                break
        self.open_ended.update(seen)
        return page.find(">", at) + 1 or -1


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks in page order: white space collapsed, character references decoded, empty ones left out."""
    page = page or ""
    stack: list[tuple[str, str]] = []
    out: list[Block] = []
    parts: list[tuple[str, bool]] = []
    silent = links = at = 0
    path: tuple[str, ...] = ()
    last_end: dict[str, int] = {}

    def is_closed(tag: str) -> bool:
        """Whether the element that starts before ``at`` has an end tag: noscript and iframe do not nest, so theirs
        comes before the next start; for the others any later end tag will do."""
        if tag in ("noscript", "iframe"):
            near = _ENDS[tag].search(page, at)
            return near is not None and near[1] == "/"
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in _ENDS[tag].finditer(page) if m[1]), default=-1)
        return last_end[tag] >= at

    def end_block() -> None:
        text = " ".join("".join([t for t, _ in parts]).split())
        if text:
            out.append(Block(path, text, sum(len(t.strip()) for t, linked in parts if linked)))
        parts.clear()

    def pop(to: int) -> None:
        nonlocal silent, links
        while len(stack) > to:
            tag = stack.pop()[0]
            silent -= tag in SILENT_TAGS
            links -= tag == "a"

    def add(raw: str) -> None:
        nonlocal path
        if silent and stack[-1][0] == "head" and raw.strip():
            pop(len(stack) - 1)
        if raw and not silent:
            text = html.unescape(raw) if "&" in raw else raw
            if not parts:
                path = tuple(x for _, x in stack)
            parts.append((text, links > 0))

    tag_ends, more = _TagEnds(page), True
    while at < len(page):
        m = _START.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        if m[0] == "<!--":
            at = page.find("-->", m.end()) + 3
            if at == 2:
                break
            continue
        at = (tag_ends.end(m.end()) if m[2] else page.find(">", m.end()) + 1 or -1) if more else -1
        if at < 0:  # no tag ends from here on: text
            more = False
            add(m[0])
            at = m.end()
            continue
        if m[2] is None:
            continue
        tag, attrs = m[2].lower(), page[m.end():at - 1]
        if parts and tag in BLOCK_TAGS:
            end_block()
        if m[1]:
            own = len(stack) - 1 if stack and stack[-1][0] == tag else \
                next((i for i in range(len(stack) - 2, -1, -1) if stack[i][0] == tag), None)
            if own is not None:
                pop(own)
            continue
        if silent:
            for i, (name, _) in enumerate(stack):
                if name in SILENT_TAGS and _ends_silent(name, {x for x, _ in stack[i + 1:]}, tag):
                    pop(i)
                    break
        if tag in CLOSES_P or tag in CLOSED_BY_NEXT:
            ends = CLOSED_BY_NEXT.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    pop(i)
                    break
                if stack[i][0] in BLOCK_TAGS:
                    break
        if tag in VOID_TAGS or attrs.endswith("/"):
            continue
        if tag in RAW_TAGS:
            close = _RAW_ENDS[tag].search(page, at)
            at = page.find(">", close.end()) + 1 if close else 0
            if not at:
                break
            continue
        if tag in NEEDS_END and not is_closed(tag):
            continue
        names = attrs and " ".join(next(filter(None, x[1:]), "") for x in _ATTR.findall(attrs)).lower()
        if len(stack) >= MAX_DEPTH:
            pop(MAX_DEPTH - 1)
        stack.append((tag, f"{tag} {names}" if names else tag))
        silent += tag in SILENT_TAGS
        links += tag == "a"
    if parts:
        end_block()
    return out


@functools.lru_cache(maxsize=20_000)
def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Hashed tags and name parts on the path; the last three elements count double."""
    v = np.zeros(PATH_DIM, dtype=np.float32)
    for depth, element in enumerate(reversed(path)):
        for k, name in enumerate(x for x in re.split(r"[^a-z0-9]+", element) if x):
            h = zlib.crc32(f"{'t' if k == 0 else 'n'}:{name}".encode())
            v[h % PATH_DIM] += (1.0 if h >> 16 & 1 else -1.0) * (1.0 if depth < 3 else 0.5)
    return v


def block_vector(block: Block, at: int, n: int, out: np.ndarray) -> None:
    out[:PATH_DIM] = path_vector(block.path)
    text = block.text
    all_words = text.lower().encode().split(b" ")
    words = len(all_words)
    seen = np.bincount([zlib.crc32(w) % WORD_DIM for w in all_words], minlength=WORD_DIM) / words
    size = len(text)
    out[PATH_DIM:] = (
        *seen,
        math.log1p(size) / 6, math.log1p(words) / 4, min(block.link_chars / size, 1.0),
        (text.count(".") + text.count(",")) / (words + 1), text[-1] in ".!?:;", at / n, math.log1p(n) / 5,
        _DIGIT.search(text) is not None)


def page_matrix(blocks: list[Block]) -> np.ndarray:
    x = np.zeros((len(blocks), DIM), dtype=np.float32)
    for i, b in enumerate(blocks):
        block_vector(b, i, len(blocks), x[i])
    return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLSTM:
    """Two LSTMs over padded sequences (time, page, feature) and a logistic output on both states."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.w = weights

    @classmethod
    def fresh(cls, seed: int) -> "BiLSTM":
        rng = np.random.default_rng(seed)
        w = {}
        for d in "fb":
            w[f"x{d}"] = rng.normal(0, 1 / math.sqrt(DIM), (DIM, 4 * HIDDEN))
            w[f"h{d}"] = rng.normal(0, 1 / math.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            w[f"b{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        w["v"], w["c"] = rng.normal(0, 1 / math.sqrt(2 * HIDDEN), 2 * HIDDEN), np.zeros(1)
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        steps, pages, _ = x.shape
        h = np.zeros((pages, HIDDEN), dtype=np.float32)
        c, out = h, np.zeros((steps, pages, HIDDEN), dtype=np.float32)
        gates = x.reshape(-1, DIM) @ self.w[f"x{d}"] + self.w[f"b{d}"]
        gates = gates.reshape(steps, pages, 4 * HIDDEN)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = gates[t] + h @ self.w[f"h{d}"]
            s = _sigmoid(g[:, :3 * HIDDEN])
            i, f, o, z = s[:, :HIDDEN], s[:, HIDDEN:2 * HIDDEN], s[:, 2 * HIDDEN:], np.tanh(g[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            c_new = f * c + i * z
            tc = np.tanh(c_new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, z, tc))
            h, c = np.where(m, o * tc, h), np.where(m, c_new, c)
            out[t] = h
        return out

    def __call__(self, x: np.ndarray, mask: np.ndarray, keep: tuple[list, list] | None = None) -> np.ndarray:
        """Probabilities (time, page)."""
        h = np.concatenate([self._run(x, mask, d, keep and keep[k]) for k, d in enumerate("fb")], axis=2)
        if keep is not None:
            keep[0].append(h)
        return _sigmoid(h @ self.w["v"] + self.w["c"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over the real blocks."""
        keep: tuple[list, list] = ([], [])
        p = self(x, mask, keep)
        h_all = keep[0].pop()
        dlogit = np.where(mask, p - y, 0).astype(np.float32) / max(mask.sum(), 1)
        grad = {"v": np.einsum("tb,tbh->h", dlogit, h_all), "c": dlogit.sum(keepdims=True).reshape(1)}
        for k, d in enumerate("fb"):
            dx, wh = np.zeros_like(x[..., :1]).repeat(4 * HIDDEN, axis=2), self.w[f"h{d}"]
            gh = np.zeros_like(wh)
            dh = np.zeros((x.shape[1], HIDDEN), dtype=np.float32)
            dc = np.zeros_like(dh)
            own_v = self.w["v"][k * HIDDEN:(k + 1) * HIDDEN]
            for t, h0, c0, i, f, o, z, tc in reversed(keep[k]):
                m = mask[t][:, None]
                dh = dh + dlogit[t][:, None] * own_v
                dho = np.where(m, dh, 0)
                dcn = np.where(m, dc, 0) + dho * o * (1 - tc * tc)
                dg = np.concatenate([dcn * z * i * (1 - i), dcn * c0 * f * (1 - f), dho * tc * o * (1 - o),
                                     dcn * i * (1 - z * z)], axis=1)
                dx[t] = dg
                gh += h0.T @ dg
                dh = np.where(m, 0, dh) + dg @ wh.T
                dc = np.where(m, dcn * f, dc)
            flat = dx.reshape(-1, 4 * HIDDEN)
            grad[f"x{d}"], grad[f"h{d}"], grad[f"b{d}"] = x.reshape(-1, DIM).T @ flat, gh, flat.sum(axis=0)
        return grad


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(p) for p in pages)
    x, mask = np.zeros((steps, len(pages), DIM), dtype=np.float32), np.zeros((steps, len(pages)), dtype=bool)
    for k, p in enumerate(pages):
        x[:len(p), k], mask[:len(p), k] = p, True
    return x, mask


# Names that sites commonly give to the parts of a page.
ARTICLE_NAMES = ("content", "post", "entry", "article", "article-body", "main", "main-content", "story", "text", "body",
                 "post-content", "entry-content", "page-content", "")
OTHER_NAMES = {
    "menu": ("nav", "menu", "navbar", "top-nav", "breadcrumbs", "breadcrumb", "main-menu", "navigation", "toc", "tabs"),
    "head": ("header", "site-header", "masthead", "top", "logo", "branding", "tagline"),
    "foot": ("footer", "site-footer", "copyright", "legal", "bottom", "colophon"),
    "side": ("sidebar", "aside", "related", "widget", "recommended", "popular", "tags", "more", "rail", "promo-links"),
    "note": ("cookie", "cookie-banner", "notice", "consent", "alert", "banner", "subscribe", "newsletter", "popup",
             "modal", "gdpr", "warning"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "adsense", "ad-slot", "teaser"),
    "form": ("search", "login", "signup", "contact-form", "search-form", "subscribe-form"),
    "comment": ("comments", "comment", "comment-list", "replies", "disqus", "discussion", "comment-body", "respond"),
    "share": ("share", "social", "share-buttons", "byline-links", "follow", "toolbar"),
}
_SYLLABLES = ("an", "er", "th", "in", "on", "re", "st", "en", "ed", "ou", "la", "de", "ci", "mo", "ar", "zu", "ge", "el",
              "ñi", "ué", "ch", "ver", "ti", "ha", "le", "es")


def _words(rng: np.random.Generator, low: int, high: int) -> str:
    n = int(rng.integers(low, high + 1))
    out = ["".join(rng.choice(_SYLLABLES, int(rng.integers(1, 4)))) for _ in range(n)]
    out[0] = out[0].capitalize()
    style = rng.random()
    if style < 0.15:
        out[int(rng.integers(n))] = f"{rng.integers(10 ** int(rng.integers(1, 6)))}{rng.choice(['', '.0', '%', '-4'])}"
    elif style < 0.19:
        out = [w.upper() + "!!" for w in out]
    elif style < 0.23:
        out = [w + str(rng.choice(["***", "%%%", "$$$", " |"])) for w in out]
    ends = [w + str(rng.choice(["", "", "", "", "", ",", "."])) for w in out]
    return " ".join(ends) + str(rng.choice([".", ".", ".", ""]))


def layout_page(rng: np.random.Generator) -> tuple[str, list[int]]:
    """A page of a random layout and the label of each of its blocks (1: article)."""
    out: list[str] = []
    labels: list[int] = []

    def block(tag: str, text: str, label: int, attr: str = "") -> str:
        labels.append(label)
        inner = text
        if rng.random() < 0.15:
            inner = f"<{'b' if rng.random() < .5 else 'em'}>{text}" + ("</b>" if rng.random() < 0.5 else "")
        close = "" if tag == "p" and rng.random() < 0.1 else f"</{tag}>"
        return f"<{tag}{attr}>{inner}{close}"

    def links(n: int) -> str:
        rows = []
        for _ in range(n):
            labels.append(0)
            rows.append(f'<li><a href="/{rng.integers(999)}">{_words(rng, 1, 3).rstrip(".")}</a></li>')
        return f"<ul>{''.join(rows)}</ul>"

    def named(kind: str, tag: str | None = None) -> tuple[str, str]:
        names = OTHER_NAMES[kind]
        tag = tag or "div"
        how = rng.random()
        attr = "" if tag != "div" and how < 0.6 else f' {"class" if how < 0.85 else "id"}="{rng.choice(names)}"'
        return f"<{tag}{attr}>", f"</{tag}>"

    def part(kind: str) -> str:
        tag = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind)
        a, b = named(kind, tag if tag and rng.random() < 0.6 else ("section" if rng.random() < 0.1 else None))
        if kind == "menu":
            return a + links(int(rng.integers(3, 9))) + b
        if kind == "share":
            return a + links(int(rng.integers(2, 5))) + b
        if kind == "head":
            extra = block("h1" if rng.random() < 0.3 else "p", _words(rng, 1, 5), 0) if rng.random() < 0.7 else ""
            return a + (extra + (links(3) if rng.random() < 0.5 or not extra else "")) + b
        if kind == "foot":
            if rng.random() < 0.5:
                labels.append(0)
                return a + f"&copy; {_words(rng, 2, 14)}" + b
            return a + block("p", f"&copy; {rng.integers(1990, 2030)} " + _words(rng, 2, 14), 0) \
                + (links(3) if rng.random() < 0.4 else "") + b
        if kind == "side":
            title = block("h3", _words(rng, 1, 4), 0) if rng.random() < 0.7 else ""
            tail = links(int(rng.integers(2, 6))) if rng.random() < 0.6 else block("p", _words(rng, 5, 40), 0)
            return a + title + tail + b
        if kind == "form":
            labels.extend([0, 0])
            return a + f'<label>{_words(rng, 1, 3)}</label><input name="q"><button>{_words(rng, 1, 2)}</button>' + b
        if kind == "comment":
            rows = block("h3", _words(rng, 1, 3), 0) if rng.random() < 0.6 else ""
            for _ in range(int(rng.integers(1, 5))):
                one = block("p", _words(rng, 4, 50), 0)
                rows += f'<div class="{rng.choice(OTHER_NAMES["comment"])}">{one}</div>' if rng.random() < 0.5 else one
            return a + rows + b
        if rng.random() < 0.5:
            labels.append(0)
            return a + _words(rng, 3, 30) + b
        return a + block("p", _words(rng, 3, 30), 0) + b

    def paragraphs() -> str:
        rows = []
        for _ in range(int(rng.integers(0, 14))):
            kind = rng.random()
            if kind < 0.08:
                rows.append(block("h2" if rng.random() < 0.6 else "h3", _words(rng, 1, 8), 1))
            elif kind < 0.13:
                rows.append("<ul>" + "".join(block("li", _words(rng, 2, 14), 1) for _ in range(3)) + "</ul>")
            elif kind < 0.16:
                rows.append(block("blockquote", _words(rng, 6, 40), 1))
            elif kind < 0.20:
                labels.append(1)
                rows.append(f'<p>{_words(rng, 3, 20)} <a href="/x">{_words(rng, 1, 4)}</a> {_words(rng, 1, 20)}</p>')
            elif kind < 0.26:
                labels.extend([1])
                rows.append(f"<p><b>{_words(rng, 1, 10)}<br>")
            elif kind < 0.30:
                rows.append(part(str(rng.choice(["ad", "share", "note", "side"]))))
            elif kind < 0.32:
                rows.append(f"<pre>{_words(rng, 4, 20)}</pre>")
                labels.append(1)
            elif kind < 0.34:
                cells = "".join(block("td", _words(rng, 1, 4), 1) for _ in range(4))
                rows.append(f"<table><tr>{cells}</tr></table>")
            else:
                rows.append(block("p", _words(rng, 1, int(rng.choice([6, 30, 120]))), 1))
        return "".join(rows)

    for kind, chance in (("note", .25), ("head", .5), ("menu", .75), ("form", .25), ("ad", .4), ("side", .2)):
        if rng.random() < chance:
            out.append(part(kind))
    tag = str(rng.choice(["article", "article", "main", "div", "div", "section"]))
    name = str(rng.choice(ARTICLE_NAMES[:-1] if tag in ("div", "section") else ARTICLE_NAMES))
    wrap = "main" if tag == "article" and rng.random() < 0.3 else ""
    out.append(f"<{wrap}>" * bool(wrap) + (f'<{tag} class="{name}">' if name else f"<{tag}>"))
    if rng.random() < 0.85:
        out.append(block("h1", _words(rng, 1, 12), 1))
    out.append(paragraphs())
    if rng.random() < 0.15:
        out.append(part("comment"))
    out.append(f"</{tag}>" + f"</{wrap}>" * bool(wrap))
    for kind, chance in (("share", .2), ("ad", .3), ("comment", .4), ("side", .35), ("form", .2), ("foot", .8),
                         ("note", .15)):
        if rng.random() < chance:
            out.append(part(kind))
    return f"<html><head><title>{_words(rng, 2, 6)}</title></head><body>{''.join(out)}</body></html>", labels


@functools.lru_cache(maxsize=2)
def trained(seed: int = 7, pages: int = TRAIN_PAGES, epochs: int = EPOCHS) -> BiLSTM:
    """The labeller, trained with Adam on random layouts; the same weights for the same arguments."""
    rng = np.random.default_rng(seed)
    data = []
    while len(data) < pages:
        page, labels = layout_page(rng)
        found = blocks_of(page)
        if found and len(found) == len(labels):
            data.append((page_matrix(found), np.array(labels, dtype=np.float32)))
    net = BiLSTM.fresh(seed)
    m = {k: np.zeros_like(v) for k, v in net.w.items()}
    s = {k: np.zeros_like(v) for k, v in net.w.items()}
    step = 0
    for epoch in range(epochs):
        order = sorted(rng.permutation(pages), key=lambda i: len(data[i][1]) // 8)
        batches = [order[i:i + 16] for i in range(0, pages, 16)]
        for k in rng.permutation(len(batches)):
            x, mask = padded([data[i][0] for i in batches[k]])
            y = np.zeros(mask.shape, dtype=np.float32)
            for c, i in enumerate(batches[k]):
                y[:len(data[i][1]), c] = data[i][1]
            step += 1
            for name, g in net.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                m[name] = 0.9 * m[name] + 0.1 * g
                s[name] = 0.99 * s[name] + 0.01 * g * g
                rate = 0.02 * (1 - epoch / epochs) + 0.002
                net.w[name] = (net.w[name] - rate * (m[name] / (1 - 0.9 ** step))
                               / (np.sqrt(s[name] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def main_texts(pages: list[str | None], net: BiLSTM) -> list[str]:
    """The main text of each page. Pages of like length are labelled together; very long pages go alone."""
    found = [blocks_of(p) for p in pages]
    out = [""] * len(pages)
    todo = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    while todo:
        group, longest = [], 0
        while todo and (not group or max(longest, len(found[todo[0]])) * (len(group) + 1) <= MAX_CELLS) \
                and len(group) < 512:
            i = todo.pop(0)
            longest = max(longest, len(found[i]))
            group.append(i)
        x, mask = padded([page_matrix(found[i]) for i in group])
        p = net(x, mask)
        for c, i in enumerate(group):
            out[i] = "\n".join(b.text for b, q in zip(found[i], p[:, c]) if q >= 0.5)
    return out


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row."""
    net = trained()

    def start():
        def work(texts: list[str | None]) -> Iterator[dict]:
            for at in range(0, len(texts), 512):
                yield from ({"text": t, "n_chars": len(t)} for t in main_texts(texts[at:at + 512], net))
        return work

    return map_texts(pages, html_col, [id_col, url_col], start, {"text": "string", "n_chars": "long"})
