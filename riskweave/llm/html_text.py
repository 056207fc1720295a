"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing and threshold regions."""

import collections
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# nothing inside these is article text
OUTSIDE = frozenset("nav aside footer form menu dialog search button select textarea input".split())
SILENT = frozenset("script style noscript template head title iframe object svg math canvas audio video".split())
# class, id or role words that mark furniture
FURNITURE = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "cookie cookies consent disqus footer form header masthead menu menubar modal nav navbar navigation newsletter "
    "notice notification pagination popup promo promotion related replies responses share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget complementary contentinfo search".split())
ARTICLE = frozenset("article main".split())
READERS = frozenset("comment comments reply replies".split())
WHITE = re.compile(r"\s+")
HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = 100  # characters a tag from which a block counts as long, however long it is
FEED = 1 << 16


class Lines(HTMLParser):
    """Turns events into lines: text of one block, tags seen in it, furniture or not, article number or 0. `around`
    has the open block elements of every line from the outermost on, `links` its links if they make most of its text.

    Text inside silent or furniture elements gives lines that are marked as such. End tags close
    the nearest open element of their name; a missing end tag is closed by its parent.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.lines, self.parts = [], [], []
        self.tags = self.silent = self.outside = self.article = self.articles = 0
        self.inside, self.blocks, self.around, self.links = [], [], [], []
        self.opened = self.anchors = self.seen = self.linked = 0

    def flush(self):
        text = WHITE.sub(" ", "".join(self.parts)).strip()
        if text or self.tags:
            self.lines.append((text, self.tags, self.outside > 0, self.inside[-1] if self.inside else 0))
            self.around.append(tuple(i for i, _ in self.blocks))
            head = bool(self.blocks) and self.blocks[-1][1] in HEADS
            self.links.append(self.seen if 2 * self.linked > len(text) and not head else 0)
        self.parts, self.tags, self.linked, self.seen = [], 0, 0, int(self.anchors > 0)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
            if tag == "p" or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                self.close_open(tag)
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        named = self.marks(attrs)
        silent = tag in SILENT
        outside = tag in OUTSIDE or (tag == "header" and not self.inside) or bool(
            tag not in ("html", "body") and named & (READERS if tag in ARTICLE else FURNITURE))
        article = not outside and (tag in ARTICLE or "main" in named and tag in ("div", "section"))
        if article:
            self.articles += 1
            self.inside.append(self.articles)
        if tag in BLOCKS:
            self.opened += 1
            self.blocks.append((self.opened, tag))
        self.anchors += tag == "a"
        self.seen += tag == "a"
        self.silent += silent
        self.outside += outside
        self.stack.append((tag, silent, outside, article))

    @staticmethod
    def marks(attrs):
        words = set()
        for name, value in attrs:
            if value and name in ("class", "id", "role"):
                words.update(w for w in re.split(r"[^a-z0-9]+", value.lower()) if w)
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                words.add("popup")
        return words

    def pop(self):
        tag, silent, outside, article = self.stack.pop()
        if tag in BLOCKS:
            self.blocks.pop()
        self.anchors -= tag == "a"
        self.silent -= silent
        self.outside -= outside
        if article:
            self.inside.pop()

    def close_open(self, tag):
        """A new item ends an open item of its kind, unless a list or table lies between."""
        for i in range(len(self.stack) - 1, -1, -1):
            name = self.stack[i][0]
            if name == tag:
                while len(self.stack) > i:
                    self.pop()
                return
            if name in BLOCKS:
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self.pop()
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.anchors:
                self.linked += len(data.strip())


def parsed(html):
    parser = Lines()
    for i in range(0, len(html), FEED):
        parser.feed(html[i:i + FEED])
    parser.close()
    parser.flush()
    return parser


def lines_of(html):
    return parsed(html).lines


def smoothed(values, radius):
    """Gaussian smoothing with standard deviation `radius`, weights renormalised at the ends."""
    reach = int(2 * radius) + 1
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / radius) ** 2)
    total = np.convolve(values, weights)[reach:reach + len(values)]
    return total / np.convolve(np.ones(len(values)), weights)[reach:reach + len(values)]


def two_means(values, rounds=20):
    """Threshold between the two clusters of one-dimensional values."""
    low, high = values.min(), values.max()
    for _ in range(rounds):
        cut = (low + high) / 2
        below, above = values[values <= cut], values[values > cut]
        if not len(above):
            return low / 2
        low, high = below.mean(), above.mean()
    return (low + high) / 2


def menus(links, usable):
    """Lines in a row of lines of link text with two links or more."""
    found, run = np.zeros(len(links), dtype=bool), []
    for i in np.flatnonzero(usable).tolist() + [None]:
        if i is not None and links[i]:
            run.append(i)
            continue
        if sum(links[j] for j in run) > 1:
            found[run] = True
        run = []
    return found


def grown(core, usable, around):
    """The core's lines and all usable ones in the elements around its blocks: in the parent of each, or, where that has no
    other usable line, in the nearest element that has."""
    held = collections.Counter(i for line in np.flatnonzero(usable) for i in around[line])
    homes = {next((i for i in reversed(around[line][:-1]) if held[i] > 1), 0) for line in np.flatnonzero(core)}
    return core | usable & np.array([0 in homes or not homes.isdisjoint(a) for a in around])


def main_text(html, radius=1.0):
    """The article's blocks joined by newlines, and the share of lines chosen by their ratio alone."""
    page = parsed(html or "")
    lines = page.lines
    if not lines:
        return ""
    ratio = np.array([0.0 if out else len(text) / max(tags, 1) for text, tags, out, _ in lines])
    if not ratio.any():
        return ""
    smooth = smoothed(ratio, radius)
    core = (smooth > two_means(smooth)) & (ratio > 0)
    inside = np.array([a for *_, a in lines])
    usable = np.array([bool(text) and not out for text, _, out, _ in lines])
    hit = set(inside[core & usable & (inside > 0)].tolist()) or set(inside[usable & (inside > 0)].tolist())
    if hit:  # a region that meets an article grows to the whole of it
        keep = usable & np.isin(inside, list(hit))
    else:  # otherwise from the first to the last line around those above a threshold that no single block can lift
        scale = smoothed(np.log1p(np.minimum(ratio, PROSE)), radius)
        text = usable & ~menus(page.links, usable)
        core = (scale > two_means(scale)) & usable
        found = np.flatnonzero(grown(core & text if (core & text).any() else core, text, page.around))
        keep = usable.copy()
        keep[:found[0]] = False
        keep[found[-1] + 1:] = False
    return "\n".join(lines[i][0] for i in np.flatnonzero(keep))


def extract_main_text(df, key="page_id", url="url", html="html"):
    """(key, url, text, n_chars) of every page, one row out for one row in.

    Pages stream through the standard-library parser in pieces. Lines are blocks; their text-to-tag ratio
    is smoothed and cut in two clusters; regions above the cut are kept, whole articles where one
    is met. Pages without article are cut by the logarithm of the ratio, above PROSE all alike, and a region grows
    over the other blocks of its parent but rows of links. Furniture (menus, page headers, footers, sidebars, notices, adverts, forms, reader comments)
    has ratio 0 and never stays. White space in a block becomes one space; `br` counts as a space.

    A null or empty page, or one without text, gives an empty text with n_chars 0. Null keys and urls pass
    through. Other columns are not read. No shuffle; each page needs the memory of its own text.
    """
    picked = df.select(F.col(key).alias("_k"), F.col(url).alias("_u"), F.col(html).alias("_h"))
    fields = {f.name: f.dataType for f in picked.schema}
    schema = T.StructType([
        T.StructField(key, fields["_k"]), T.StructField(url, fields["_u"]), T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[key, url, "text", "n_chars"])

    return picked.mapInArrow(run, schema)
