"""Flat text blocks of an HTML page and their shallow features."""

from __future__ import annotations

import re
from html import unescape

import numpy as np

# Elements that begin and end a text block.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
section summary table tbody td tfoot th thead tr ul""".split())
# Elements whose content is no text of the page.
RAW_TAGS = frozenset("""script style title noscript template textarea select button iframe object svg canvas audio video
datalist annotation annotation-xml""".split())
# Block elements that may hold other blocks and so give them context.
CONTAINERS = BLOCK_TAGS - frozenset("p h1 h2 h3 h4 h5 h6 hr li dt dd td th tr caption legend summary pre".split())

_TAG_CONTEXT = {"nav": -1, "footer": -1, "aside": -1, "form": -1, "menu": -1, "dialog": -1, "article": 1, "main": 1}
_ROLE_CONTEXT = {"navigation": -1, "banner": -1, "complementary": -1, "contentinfo": -1, "search": -1, "form": -1,
                 "dialog": -1, "alertdialog": -1, "alert": -1, "menu": -1, "menubar": -1, "main": 1, "article": 1}
# Words in class and id names.
_BOILER = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo
promotion promoted banner nav navigation navbar menu menus breadcrumb breadcrumbs footer foot sidebar side aside
widget widgets cookie cookies consent gdpr notice notices alert popup modal overlay comment comments commentlist
reply replies respond discussion disqus share sharing social related recommended teaser teasers newsletter subscribe
subscription signup login register search searchbox form pagination pager paging toolbar masthead copyright legal
disclaimer rail outbrain taboola""".split())
_HARD = frozenset("comment comments reply ad ads advert advertisement sponsored teaser related promo".split())
_GOOD = frozenset("article content post entry story main body text articlebody maincontent".split())
_HEAD = frozenset("header head top".split())
# Words that leave the meaning of a name as it is ("comment-list", "site-footer").
_GENERIC = frozenset("""list lists box container wrapper wrap block area section inner outer bottom left right center item
items row col column bar panel link links button buttons icon icons title titles label group holder module component site page
global primary secondary posts articles stories news thread author meta info details message slot unit zone""".split())

# Possessive repeats: linear time on broken markup. Without a closing '>' the
# rest of the page is an unfinished tag.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?:>|\Z)|[^>]*+(?:>|\Z))", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/>]|$)""", re.I)
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PLAIN = _BOILER | _GOOD | _HEAD | _GENERIC
_LINK_END = re.compile(r"</a[\s/>]", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def furniture(name: str) -> tuple[bool, bool]:
    """Whether all of a class or id name says furniture, and whether a part
    of it does: "share-buttons" does, "share-price" only in part."""
    parts = {x for x in map(str.lower, _NAME_PART.findall(name)) if len(x) > 1}
    return bool(parts & _BOILER) and parts <= _PLAIN, bool(parts & _BOILER)


def context_of(tag: str, attrs: str, above: tuple[int, int]) -> tuple[int, int]:
    """``(context, doubt)``. Context: 1 in an article, -1 in furniture, 0
    unknown; the innermost sign holds. Doubt: 1 where a name says furniture in
    part, which decides nothing by itself."""
    context, doubt = above
    found = _TAG_CONTEXT.get(tag, 0)
    if tag == "header" and context < 1:
        found = -1
    if "=" not in attrs and "hidden" not in attrs.lower():
        return found or context, doubt
    parts: set[str] = set()
    whole = hard = False
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "role":
            found = _ROLE_CONTEXT.get(value.lower().strip(), found)
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return -1, doubt
        elif key in ("class", "id") and tag not in ("html", "body"):
            for name in value.split():
                said, partly = furniture(name)
                mine = {x.lower() for x in _NAME_PART.findall(name)}
                whole, hard = whole or said, hard or said and bool(mine & _HARD)
                doubt = doubt or int(partly and not said)
                parts |= mine
    if tag in ("html", "body"):
        return above
    if hard or found < 1 and whole:
        return -1, doubt
    if found:
        return found, doubt
    if parts & _GOOD:
        return context if context < 0 and not parts & {"article", "articlebody", "maincontent"} else 1, doubt
    return -1 if parts & _HEAD and parts <= _PLAIN and context < 1 else context, doubt


class Block:
    __slots__ = ("tag", "context", "parts", "link_parts", "inked")

    def __init__(self, tag: str, context: tuple[int, int]):
        self.tag, self.context, self.parts, self.link_parts, self.inked = tag, context, [], [], False


def blocks(html: str) -> list[tuple[str, str, int, str, int]]:
    """``(text, tag, context, linked text, doubt)`` of each block that has
    text, in page order. A link that is opened around blocks covers them up to
    its end, at most to the end of the element that holds it; one opened after
    text of its block ends with the block."""
    out: list[tuple[str, str, int, str, int]] = []
    stack: list[tuple[str, tuple[int, int]]] = [("", (0, 0))]
    block, links, at, n = Block("", (0, 0)), 0, 0, len(html)
    link_depth, link_end = 0, 0  # where the open link began; the next </a> (n: none)

    def close(tag: str) -> Block:
        if block.parts:
            text = " ".join("".join(block.parts).split())
            if text:
                linked = " ".join("".join(block.link_parts).split())
                out.append((text, block.tag, block.context[0], linked, block.context[1]))
        return Block(tag, stack[-1][1])

    while at < n:
        m = _TOKEN.search(html, at)
        text = html[at:m.start() if m else n]
        if text:
            text = unescape(text) if "&" in text else text
            block.parts.append(text)
            block.inked = block.inked or not text.isspace()
            if links:
                links = 2 if not text.isspace() and links == 1 else links
                block.link_parts.append(text)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(m[1])
        if tag == "noscript" and (closing or block.inked):  # a part of the running text
            block.parts.append(" ")
        elif tag in RAW_TAGS:
            if not closing and not m[3].endswith("/>"):
                end = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at)
                if tag in ("select", "button", "noscript", "object", "audio", "video", "svg", "datalist",
                           "annotation", "annotation-xml") and not end:
                    continue
                at = html.find(">", end.start()) + 1 or n if end else n
            block.parts.append(" ")
        elif tag == "a":
            links, link_depth = int(not closing and "href" in m[3].lower()), len(stack)
            if links and link_end < at:
                end = _LINK_END.search(html, at)
                link_end = end.start() if end else n
        elif tag == "br":
            block.parts.append(" ")
            block.link_parts.append(" ")
        elif tag in BLOCK_TAGS:
            # 1: nothing linked yet, 2: text linked in its own block, 3: around blocks
            links = 3 if links == 3 or links == 1 and not closing and at <= link_end < n else 0
            if tag in CONTAINERS:
                if closing:
                    depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
                    if depth:
                        del stack[depth:]
                        links = links if len(stack) >= link_depth else 0
                    block = close(stack[-1][0])
                    continue
                stack.append((tag, context_of(tag, m[3], stack[-1][1])))
                block = close(tag)
            else:
                block = close(stack[-1][0] if closing else tag)
                if not closing and ("=" in m[3] or "hidden" in m[3]):
                    block.context = context_of(tag, m[3], stack[-1][1])
    close("")
    return out


FEATURES = 14


def features(found: list[tuple[str, str, int, str, int]]) -> np.ndarray:
    """One row per block: word count and link density of the block and of its
    neighbours, share of long blocks nearby, its tag, context and doubt."""
    n = len(found)
    x = np.zeros((n, FEATURES))
    if not n:
        return x
    count = np.array([b[0].count(" ") + 1 for b in found], float)
    linked = np.array([b[3].count(" ") + 1 if b[3] else 0 for b in found], float)
    density = np.minimum(linked / count, 1.0)
    pad = lambda v, edge: np.concatenate([[edge], v, [edge]])
    c, d = pad(count, 0.0), pad(density, 1.0)
    x[:, 0], x[:, 1], x[:, 2] = c[1:-1], c[:-2], c[2:]
    x[:, 3], x[:, 4], x[:, 5] = d[1:-1], d[:-2], d[2:]
    x[:, 6] = [b[2] for b in found]
    x[:, 7] = [b[1] in ("h1", "h2", "h3", "h4", "h5", "h6") for b in found]
    x[:, 8] = [b[1] == "li" for b in found]
    x[:, 9] = [b[0][-1] in ".!?…”\"'" for b in found]
    x[:, 10] = any(b[2] > 0 for b in found)
    long = pad((count * (1 - density) >= 15).astype(float), 0.0)
    x[:, 11] = long[:-2] + long[2:]
    x[:, 12] = [b[1] == "p" for b in found]
    x[:, 13] = [b[4] for b in found]
    return x
