"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags, whatever the nesting.  A block is told by
its own, the previous and the next block's word count and link density, by the kind of
its innermost marked container (boilerplate, main text or neither), and by being a
heading or list item.  Tags, roles and names made of boilerplate words only mark a container.  A
name that mixes them with other words is a hint: it counts at its first or last word, and not
on a page where the containers of that name hold most of the unlinked words.  A decision tree trained on the small labelled table below
decides which blocks are main text; its splits become one column expression over a
page's array of blocks, so a page stays one row and nothing is shuffled.

Defined results: a null, empty or textless html gives the empty text; broken markup is
read as far as it goes; repeated rows get equal results; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import takewhile

import pandas as pd
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import prepare, table

BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = BLOCK_TAGS - frozenset("p hr h1 h2 h3 h4 h5 h6 body html li dt dd td th tr".split())
DROPPED = frozenset("script style noscript template head title svg annotation annotation-xml iframe object button select textarea option datalist audio video canvas".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SPACED = frozenset("br img td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = frozenset("li dt dd".split())
# Containers by tag, role and the words of class and id.
BOILER_TAGS = frozenset("nav header footer aside form menu dialog dir fieldset".split())
MAIN_TAGS = frozenset("article main".split())
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs byline comment comments consent "
    "cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu menus meta modal nav navbar navigation newsletter notice "
    "notices overlay pager pagination popup promo promos promotion related replies reply respond share sharing sidebar sidebars signup skip social "
    "sponsor sponsored sponsors subscribe tags toolbar topbar widget widgets".split()
)
MAIN_WORDS = frozenset("article articlebody body content entry main post story text".split())
QUALIFIERS = frozenset("has no with without".split())  # what follows in a name tells of the page, not of the container
STATES = frozenset("active aware disabled enabled free less off on optional ready removed required supported".split())  # so does what comes before
PARTS = frozenset(  # words that name a container's shape or place
    "area areas article articles author avatar bar block blocks body bottom box boxes btn button buttons card cards cell col column container "
    "content cta entry form full group head heading icon icons img image inner item items js label left link links list logo main module outer "
    "page panel post posts primary right row section secondary site slot small stories story text thread title top unit wrap wrapper zone".split()
)
MOST = 0.5  # share of a page's unlinked words from which a mixed name is no boilerplate
SPLIT_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+").findall
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden").search

FEATURES = ["n_words", "link_density", "prev_words", "prev_links", "next_words", "next_links", "zone", "heading", "item"]
BLOCKS = "array<struct<text:string," + ",".join(f"{f}:double" for f in FEATURES) + ">>"


class Blocks(HTMLParser):
    """Collects (text, words, words in links, zone, heading, list item) of each block."""

    def __init__(self, cleared: frozenset[str] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.cleared = cleared  # mixed names that are no boilerplate on this page
        self.hinted: list[tuple[int, int, set[str]]] = []  # of each block: unlinked words, zone without hints, mixed names around it
        self.blocks: list[tuple] = []
        self.text: list[str] = []
        self.linked: list[str] = []
        # containers: tag, zone (-1 boilerplate, 0 as outside, 1 main, 2 hidden), zone without hints, mixed names
        self.open: list[tuple[str, int, int, tuple[str, ...]]] = []
        self.dropped: list[str] = []  # an open dropped tag, then the dropped tags and containers within it
        self.in_link = 0
        self.block_tag = ""

    def zone(self) -> int:
        return next((c[1] for c in reversed(self.open) if c[1]), 0)

    def cut(self) -> None:
        text = " ".join("".join(self.text).split())
        zone = self.zone()
        if text and zone != 2:
            words = len(text.split())
            linked = min(words, len("".join(self.linked).split()))
            self.blocks.append((text, words, linked, zone, self.block_tag in HEADINGS, self.block_tag in ITEMS))
            names = {n for c in self.open for n in c[3]}
            self.hinted.append((words - linked, next((c[2] for c in reversed(self.open) if c[2]), 0), names))
        self.text, self.linked = [], []

    def mark(self, tag: str, attrs: dict) -> tuple[int, int, tuple[str, ...]]:
        """A container's zone, its zone without hints, and its mixed names."""
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN(attrs.get("style") or ""):
            return 2, 2, ()
        plain, mixed, words = set(), [], set()
        for name in (n for k in ("class", "id") for n in (attrs.get(k) or "").split()):
            own = [w.lower() for w in SPLIT_WORDS(name)]
            if STATES & set(own[1:]):
                continue
            own = list(takewhile(lambda w: w not in QUALIFIERS, own))
            words |= set(own)
            if not BOILER_WORDS & set(own):
                continue
            if all(w in BOILER_WORDS or w in PARTS or len(w) == 1 for w in own):
                plain |= BOILER_WORDS & set(own)
            elif {own[0], own[-1]} & BOILER_WORDS:
                mixed.append((name.lower(), BOILER_WORDS & set(own)))
        kept = [w for n, w in mixed if n not in self.cleared]
        with_hints = self.zone_of(tag, attrs, plain.union(*kept), words)
        return with_hints, self.zone_of(tag, attrs, plain, words), tuple(n for n, _ in mixed)

    def zone_of(self, tag: str, attrs: dict, boiler: set[str], words: set[str]) -> int:
        role = (attrs.get("role") or "").lower()
        if tag == "header" and self.zone() == 1 and not boiler - {"header"}:
            return 0  # an article's own heading
        if tag in MAIN_TAGS or role in ("main", "article"):
            inner = self.zone() != 0 and tag != "main" and role != "main"  # a comment, say
            return -1 if inner and boiler else 1
        if tag in BOILER_TAGS or role in BOILER_ROLES or boiler:
            return -1
        return 1 if words & MAIN_WORDS else 0

    def handle_starttag(self, tag, attrs):
        if self.dropped and (self.dropped[0] == "head" and tag == "body" or self.dropped == ["head"] and tag in BLOCK_TAGS):
            self.dropped = []  # the end tag of head may be left out
        if tag in DROPPED:
            self.dropped.append(tag)
            return
        if self.dropped:
            if tag in CONTAINERS:
                self.dropped.append(tag)
            return
        if tag in SPACED:
            self.text.append(" ")
        if tag == "a":
            self.in_link += 1
        if tag in BLOCK_TAGS:
            self.cut()
            self.in_link = 0 if tag not in ("li", "p") else self.in_link
            self.block_tag = tag
            if tag in CONTAINERS or tag == "p" and attrs:
                if tag == "p":  # ends where the next block starts
                    self.open = [c for c in self.open if c[0] != "p"]
                self.open.append((tag, *self.mark(tag, dict(attrs))))
            elif self.open and self.open[-1][0] == "p":
                self.open.pop()

    def handle_startendtag(self, tag, attrs):
        if tag in VOID or tag in DROPPED:
            if tag in BLOCK_TAGS and not self.dropped:
                self.cut()
            elif not self.dropped:
                self.text.append(" ")
        else:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.dropped:
            if tag in self.dropped:
                while self.dropped.pop() != tag:
                    pass
                return
            if tag not in ("body", "html") and not any(c[0] == tag for c in self.open):
                return
            self.dropped = []  # never closed: it ends with the container around it
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if tag in BLOCK_TAGS:
            self.cut()
            self.in_link = 0
            self.block_tag = ""
            if any(c[0] == tag for c in self.open):
                while self.open.pop()[0] != tag:
                    pass

    def handle_data(self, data):
        if not self.dropped:
            self.text.append(data)
            if self.in_link:
                self.linked.append(data + " ")


def parsed(html: str, cleared: frozenset[str] = frozenset()) -> Blocks:
    parser = Blocks(cleared)
    parser.feed(html)
    parser.close()
    parser.cut()
    return parser


def blocks_of(html: str | None) -> list[dict]:
    """A page's text blocks with their features, in order."""
    parser = parsed(html or "")
    held: dict[str, int] = {}
    total = 0
    for words, zone, names in parser.hinted:
        if zone >= 0:
            total += words
            for n in names:
                held[n] = held.get(n, 0) + words
    cleared = frozenset(n for n, words in held.items() if words > MOST * total)
    own = (parsed(html, cleared) if cleared else parser).blocks
    size = [(float(b[1]), b[2] / b[1]) for b in own]
    none = (0.0, 0.0)
    return [
        dict(zip(["text", *FEATURES], (
            b[0], *size[i], *(size[i - 1] if i else none), *(size[i + 1] if i + 1 < len(own) else none),
            float(b[3]), float(b[4]), float(b[5]),
        )))
        for i, b in enumerate(own)
    ]


S = "The council agreed on Tuesday to widen the old bridge, which carries most of the traffic between the two districts and the port."
T = "Work will begin in spring and is expected to last two years."
L = S + " " + T + " Residents had asked for a second lane for cyclists, and the plan now includes one on either side of the road."
#: The labelled table: pages as fragments of one block each, and whether the block is main text.
LABELLED = [
    [('<nav><ul><li><a href="/">Home</a></li>', 0), ('<li><a href="/n">News</a></li>', 0), ('<li><a href="/s">Sport</a></li></ul></nav>', 0),
     ("<article><h1>Council agrees on bridge</h1>", 1), (f"<p>{S}</p>", 1), (f"<p>{T}</p>", 1), ("<p>Yes.</p></article>", 1),
     ('<footer>&copy; 2024 Example News. All rights reserved.</footer>', 0)],
    [('<div class="ad">Buy the best tyres in town today.</div>', 0), ("<article><h1>A short note</h1>", 1), ("<p>Closed.</p>", 1),
     (f"<p>{L}</p></article>", 1), (f'<div class="ad">{S}</div>', 0), ("<footer>Contact us</footer>", 0)],
    [('<header><div class="logo">Example</div>', 0), ('<p>News from the region every day of the week</p></header>', 0),
     ('<main><h2>Bridge</h2>', 1), (f"<p>{S}</p>", 1), ("<ul><li>Two lanes</li>", 1), ("<li>One path for cyclists</li></ul>", 1), (f"<p>{T}</p></main>", 1),
     ('<aside><h3>Related</h3>', 0), ('<ul><li><a href="/1">Bridge closed again</a></li>', 0), (f'<li><a href="/2">{T}</a></li></ul></aside>', 0)],
    [("<div>Example Daily</div>", 0), ('<div><a href="/a">Home</a> <a href="/b">About</a> <a href="/c">Contact</a></div>', 0),
     ("<h1>Bridge will be widened this year</h1>", 1), (f"<div>{L}</div>", 1), (f"<div>{S}</div>", 1), (f"<p>{L}</p>", 1),
     ('<div><a href="/t">Terms</a> <a href="/p">Privacy</a></div>', 0), ("<div>Copyright 2024 Example Daily</div>", 0)],
    [('<div class="cookie-notice">We use cookies to give you the best experience on our site. By going on you accept them.</div>', 0),
     ('<div id="content"><h1>Harbour opens</h1>', 1), (f"<p>{S}</p>", 1), ("<p>Boats welcome.</p>", 1), (f"<p>{L}</p></div>", 1),
     (f'<div class="comments"><p>Anna: {T}</p>', 0), (f"<p>Ben: {S}</p></div>", 0), ("<form><label>Your name</label></form>", 0)],
    [('<table><tr><td><a href="/x">Start</a></td></tr></table>', 0), (f"<p>{L}</p>", 1), (f"<p>{S}</p>", 1), (f"<p>{L}</p>", 1),
     ('<p><a href="/m">More on this</a></p>', 0), ('<ul><li><a href="/q">First link to another story</a></li>', 0),
     ('<li><a href="/r">Second link to another story</a></li></ul>', 0), ("<div>Imprint</div>", 0)],
    [('<div class="breadcrumbs"><a href="/">Start</a> / News</div>', 0), ('<article><header><h1>Rain ahead</h1></header>', 1), (f"<p>{T}</p>", 1),
     (f'<p>See <a href="/b">the plan of the bridge</a> for more. {S}</p>', 1), ('<div class="share">Share this article with your friends</div>', 0),
     (f"<p>{S}</p></article>", 1), (f'<section id="comments"><p>{L}</p></section>', 0), (f"<aside><p>{L}</p></aside>", 0)],
    [('<div role="navigation"><a href="/1">One</a></div>', 0), ('<div role="main"><p>Brief.</p>', 1), ('<p><a href="/full">Read the report</a></p></div>', 1),
     (f'<div class="sidebar"><p>{S}</p></div>', 0), (f"<footer><p>{L}</p></footer>", 0), (f"<nav><p>{S}</p></nav>", 0)],
    [("<article><h1>List of works</h1>", 1), ("<ul><li>North pier</li>", 1), ('<li><a href="/w">West gate</a></li></ul>', 1), ("<p>End.</p></article>", 1),
     ('<form><p>Subscribe to our newsletter and get the news of the day every morning at six.</p></form>', 0), (f"<footer>{T}</footer>", 0)],
    [(f"<article><p>{T}</p></article>", 1)],
    [("<article><h1>Note</h1>", 1), ("<p>Short.</p></article>", 1)],
    [(f"<p>{L}</p>", 1), (f"<p>{S}</p>", 1)],
    [(f"<div>{S}</div>", 1)],
    [('<nav><a href="/">Home</a></nav>', 0), ("<article><p>Brief words here.</p></article>", 1)],
    [("<article><p>One.</p>", 1), ('<p><a href="/f">Full text of the plan</a></p></article>', 1)],
    [('<div><a href="/">Home</a></div>', 0), ("<h1>Bridge to be closed</h1>", 1), (f"<p>{L}</p>", 1), (f"<p>{T}</p>", 1)],
    [(f"<article><p>{S}</p>", 1), ("<p>Yes.</p></article>", 1)],
    [(f"<main><p>{L}</p>", 1), ("<p>Done now.</p></main>", 1)],
    [("<article><h1>Bridge news today</h1></article>", 1), ('<nav><a href="/">Home</a></nav>', 0)],
    [("<article><p>Two lanes.</p></article>", 1), ('<div><a href="/n">Next</a></div>', 0)],
    [(f"<p>{L}</p>", 1), ("<h2>Costs</h2>", 1), (f"<p>{L}</p>", 1), (f"<p>{T}</p>", 1), (f"<p>{S}</p>", 1), ("<div>Page 2</div>", 0)],
]


def labelled_blocks() -> pd.DataFrame:
    """The labelled table with features: a row per block of its pages."""
    rows = []
    for page in LABELLED:
        found = blocks_of("<body>" + "".join(f for f, _ in page) + "</body>")
        if len(found) != len(page):
            raise ValueError("each fragment of the labelled table must be one block")
        rows += [{**{f: b[f] for f in FEATURES}, "label": float(y)} for b, (_, y) in zip(found, page)]
    return pd.DataFrame(rows)


def train_tree(spark: SparkSession, labelled: pd.DataFrame | None = None, depth: int = 6):
    """Decision tree over the features of labelled blocks."""
    rows = spark.createDataFrame(labelled_blocks() if labelled is None else labelled).coalesce(1)
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    return DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=1).fit(data)


def tree_condition(model, block: Column) -> Column:
    """The tree's decision as a column expression over a block's features."""
    lines = [x.strip() for x in model.toDebugString.splitlines()[1:] if x.strip()]
    at = 0

    def node() -> Column:
        nonlocal at
        line, at = lines[at], at + 1
        if line.startswith("Predict:"):
            return F.lit(float(line.split(":")[1]) == 1.0)
        feature, limit = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        below = node()
        at += 1  # the Else line
        return F.when(block[FEATURES[int(feature)]] <= float(limit), below).otherwise(node())

    return node()


def blocks_column(html: Column) -> Column:
    """Array of a page's blocks with their features."""

    @F.pandas_udf(BLOCKS)
    def blocks(pages: pd.Series) -> pd.Series:
        return pd.Series([blocks_of(p) for p in pages])

    return blocks(html)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model=None) -> DataFrame:
    """Rows (id, url, text): the blocks that the tree takes for main text, joined by line ends."""
    spark = prepare(pages.sparkSession)
    tree = model or train_tree(spark)
    held = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), blocks_column(F.col(html_col)).alias("blocks"))
    main = F.filter("blocks", lambda b: tree_condition(tree, b))
    return held.select("id", "url", F.array_join(F.transform(main, lambda b: b["text"]), "\n").alias("text"))


def op1_html_main_text(spark, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
