"""Main text of HTML pages: flat text blocks with the word counts and link
densities of the block and its neighbours, kept or dropped by a decision
tree that is trained on the small labelled table below.

Each page is one row of a map; there is no shuffle and no state.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import trees
from .common import prepare
from .html_blocks import blocks, features

_LONG = "the rain had stopped before noon and people came out into the square to see what was left of the market"

# Labelled pages. A block whose text starts with § belongs to the main text.
# LONG stands for a sentence of 20 words.
LABELLED = [
    """<title>T</title><nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav><div class="ad">Buy now. Great
    shoes.</div><article><h1>§ The market</h1><p>§ LONG LONG.<p>§ Yes.<p>§ LONG.</p><p>§ LONG LONG LONG.</p></article><footer>(c) Paper,
    all rights</footer>""",
    """<header><div>Daily Paper</div><a href=/>Home</a></header><main><h1>§ Title here</h1><p>§ LONG.</p><ul><li>§ first point</li><li>§
    second point</li></ul><p>§ See <a href=x>the other report</a> LONG.</p><h2>§ After</h2><p>§ No.</p></main><aside><h3>Most
    read</h3><ul><li><a href=1>One story</a></li><li><a href=2>Two story</a></li></ul><p>LONG</p></aside><footer><p>LONG</p></footer>""",
    """<div id="header">My site</div><div id="menu"><a href=1>One</a> <a href=2>Two</a></div><div id="content"><h1>§ A day</h1><p>§
    LONG LONG.</p><p>§ Short one.</p><p>§ LONG.</p><div class="share"><a href=f>Tell a friend</a></div></div><div id="comments"><h3>2
    comments</h3><p>I agree. LONG.</p><p>LONG LONG</p></div><div class="sidebar"><p>LONG</p></div><div id="footer">Imprint</div>""",
    """<div><a href=1>Home</a> <a href=2>Blog</a> <a href=3>Contact</a></div><div><h1>§ Without names</h1><p>§ LONG LONG.</p><p>§
    LONG.</p><p>§ LONG LONG.</p></div><div><a href=4>Older post</a> <a href=5>Newer post</a></div><div>Copyright 2020</div>""",
    """<div class="cookie-notice"><p>We use cookies. LONG.</p><button>OK</button></div><article class="post"><header><h1>§ Head</h1><p>§
    By A. Writer</p></header><p>§ LONG.</p><blockquote>§ LONG</blockquote><div class="advert"><p>LONG. Buy.</p></div><p>§ LONG
    LONG.</p><section class="related"><ul><li><a href=1>LONG</a></li></ul></section></article><section class="comments"><article
    class="comment"><p>LONG</p></article></section><form><p>Write to us. LONG</p><label>Name</label></form>""",
    """<table><tr><td><a href=1>Start</a></td><td><a href=2>Links</a></td></tr></table><p>§ LONG LONG.</p><p>§ LONG.</p><p>§ Fine
    words.</p><p>§ LONG LONG.</p><hr><p><a href=3>Back to top</a></p><p>Last change: May</p>""",
    """<div>Welcome</div><div><a href=1>Archive</a></div><p>§ LONG.</p><p>§ LONG.</p><p>§ So it was.</p><p>§ LONG.</p><div>Powered by
    hand</div>""",
    """<nav><a href=1>LONG</a></nav><article><p>§ One.</p></article><footer><p>LONG LONG.</p></footer>""",
    """<nav>Menu</nav><div class="notice"><p>LONG.</p></div><main><p>§ Two words</p><p>§ LONG</p></main><div class="newsletter"><p>LONG
    LONG.</p></div><footer>LONG</footer>""",
    """<div class="top"><p>LONG.</p></div><div class="entry"><h2>§ Note</h2><p>§ It is.</p><p>§ <a href=x>A linked line</a></p><p>§
    LONG.</p></div><div class="comment-list"><p>LONG LONG.</p><p>Nice.</p></div>""",
    """<p>§ LONG LONG LONG.</p>""",
    """<div>§ LONG LONG.</div>""",
    """<body>§ LONG LONG LONG.<br>LONG.</body>""",
    """<div><a href=1>One</a></div><div><a href=2>Two</a></div><p>Short note</p><div><a href=3>Three</a></div>""",
    """<article><h1>§ H</h1><p>§ <a href=1>LONG</a></p><p>§ A b c</p><div>§ plain part</div><table><tr><td>§ 1</td><td>§
    2</td></tr></table></article><div class="promo"><p>LONG LONG</p></div><div><p>Imprint</p></div>""",
    """<article><h1>§ Last words</h1><p>§ LONG.</p><p>§ End</p></article>""",
    """<article><p>§ Yes</p></article>""",
    """<main><h2>§ List</h2><ul><li>§ one</li><li>§ two</li></ul></main>""",
    """<div class="menu"><a href=1>Start</a></div><article><p>§ It rained</p><p>§ We left</p><p>§ LONG LONG.</p><p>§ Then home</p></article><p><a
    href=2>Next</a></p><p>Contact</p>""",
    """<article><h1>§ With links inside</h1><p>§ LONG LONG.</p><p>§ LONG.</p><ul><li><a href=1>One more story</a></li><li><a href=2>And
    another story</a></li><li><a href=3>The third</a></li></ul></article><footer>Imprint</footer>""",
    """<main><div><a href=1>Home</a> <a href=2>Culture</a></div><h1>§ Crumbs above</h1><p>§ LONG.</p><p>§ <a href=3>One source</a></p><p>§
    LONG.</p><div><a href=4>Previous</a> <a href=5>Next</a></div></main>""",
    """<div>All rights reserved.</div><div>Site name. Since 1990.</div><p>§ LONG LONG.</p><p>§ LONG LONG</p><p>§ He said no.</p><p>§
    LONG LONG.</p><div>Buy now. Great shoes.</div><div>Imprint. Contact.</div>""",
    """<div><a href=1>LONG</a></div><div><a href=2>LONG.</a></div><div>§ LONG LONG</div><div>§ LONG. LONG</div><div>§ Nothing more</div><div>§
    LONG LONG</div><div><a href=3>LONG</a></div><div>A small site. Thank you.</div>""",
    """<table><tr><td>Log in.</td></tr><tr><td>§ LONG LONG.</td></tr><tr><td>§ LONG</td></tr></table><div>Hits: 12.</div><div><a
    href=1>Mail us.</a></div>""",
    """<div>Site name</div><article><p>§ Short text</p><ul><li>§ a</li><li>§ b c</li></ul><p>§ The end</p></article><div>Imprint</div>""",
    """<nav><a href=1>Home</a></nav><article><h1>§ Prices</h1><p class="share-price">§ LONG.</p><p class="menu-of-the-day">§ Soup.</p><div
    class="related-work"><h2>§ Earlier work</h2><p>§ LONG LONG.</p></div><p>§ LONG.</p></article><div class="share-links">Tell us</div>""",
    """<div><a href=1>Home</a></div><div class="legal-basis"><p>§ LONG LONG.</p><p>§ It holds.</p></div><div class="ad-free-notes"><p>§
    LONG.</p></div><div class="ad-box"><p>LONG.</p></div><div>Imprint</div>""",
    """<div><p>§ He came back.</p><p>§ She was there and said yes.</p></div>""",
    """<div><p>§ We won.</p><p>§ Nobody in the town had said so before.</p></div>""",
    """<article><p>§ LONG</p><p>§ LONG</p><p>§ LONG.</p></article>""",
    """<article><p>§ LONG.</p><p>§ LONG.</p><p>§ LONG</p></article>""",
    """<div><a href=1>Start</a></div><div><p>§ It rained.</p><p>§ They stayed in all day.</p></div><div>Imprint</div>""",
    """<article><h1>§ Around blocks</h1><p>§ LONG LONG.</p><p>§ LONG.</p><a href=1><div>One more story</div></a><a href=2><div><h3>And another
    story</h3><p>LONG.</p></div></a></article><footer>Imprint</footer>""",
    """<article><h1>§ Cards between</h1><p>§ LONG.</p><a href=1><div>Read on about the town</div></a><p>§ LONG.</p><p>§ LONG.</p></article>""",
]


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled pages' blocks."""
    xs, ys = [], []
    for page in LABELLED:
        found = blocks(page.replace("LONG", _LONG))
        ys += [b[0].startswith("§") for b in found]
        xs.append(features([(b[0].lstrip("§ ") or "§", *b[1:]) for b in found]))
    return np.vstack(xs), np.array(ys, float)


@lru_cache(maxsize=1)
def block_tree() -> trees.Tree:
    """The decision tree: least-squares splits on 0/1 labels, grown until pure."""
    x, y = labelled_table()
    cuts = [(np.unique(c)[1:] + np.unique(c)[:-1]) / 2 for c in x.T]
    return trees.grow(x, y, np.ones(len(y)), cuts, depth=10, min_rows=1, ridge=1e-9)


def main_text(html: str | None, tree: trees.Tree) -> str:
    found = blocks(html) if html else []
    if not found:
        return ""
    keep = tree.predict(features(found)) >= 0.5
    return "\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row. A null or empty html,
    or a page without main text, gives an empty text; null ids and urls stay
    null; repeated rows stay; other columns are left out."""
    prepare(pages.sparkSession)
    tree = block_tree()
    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.col("html").cast("string").alias("html"))
    schema = T.StructType.fromDDL("page_id long, url string, text string, n_chars long")

    def run(batches):
        for b in batches:
            texts = [main_text(h, tree) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=schema.names)

    return narrow.mapInArrow(run, schema)
