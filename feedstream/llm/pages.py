"""Main text of web pages, as the part of a page with the largest sum of scores.

A page is a sequence of words and tags. Words score positive and tags negative; one pass finds the
contiguous run with the largest sum (a maximum-scoring subsequence), and the blocks in it are the
text. Elements that are never part of an article, by their name or by what their class calls them,
are taken out of the sequence first, so that they can lie in the middle of it.
"""

import re

from pyspark.sql import functions as F

SAMPLE = 5_000  # labelled pages that weights are counted on, at most about
SMOOTH = 20.0  # sightings that the prior of a weight stands for
LEAST, MOST = 0.05, 3.0  # weights of words
LIGHT, HEAVY = -0.01, -4.0  # weights of tags

# Names of HTML elements.
RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr"}
NEVER = {
    "head", "script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes", "noscript", "template", "nav", "footer",
    "aside", "form", "button", "select", "option", "datalist", "dialog", "menu", "svg", "canvas", "object", "audio", "video", "map"}
UNSEEN = {"script", "style", "noscript", "template"}  # they do not even part what is around them
DECLARED = {"article", "main"}  # elements that say of themselves that they hold the content
P_ENDS = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p",
    "pre", "section", "table", "ul"}
# An opening tag ends open elements of these names, up to an element of the others.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"})}
# Words of a class or id that name what surrounds an article: alone, or as the beginning of a word.
NAMES = {
    "ad", "ads", "adbox", "adslot", "adv", "alert", "banner", "bar", "breadcrumb", "breadcrumbs", "consent", "copyright", "dfp",
    "disclaimer", "discussion", "disqus", "foot", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "notice",
    "notification", "outbrain", "overlay", "pager", "pagination", "paywall", "popup", "promo", "promotion", "recommended",
    "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "subscribe",
    "taboola", "teaser", "toolbar", "topbar", "widget"}
STARTS = ("advert", "comment", "cookie", "footer", "navbar", "navi", "newsletter", "sidebar", "sponsor", "subscri", "recommend")
HEADERS = {"header", "head", "top"}  # only of a page, not of an article
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
CONTENT = {"article", "body", "content", "entry", "main", "post", "story", "text"}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^\"'>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[\"'=])*+)(?:>|(\Z))|<[!?/][^>]*(?:>|\Z)",
    re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?<![^\s\"'])(hidden)(?![^\s/])")
PIECE = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


def surrounds(name, attributes, inside):
    """Whether an element is known not to be text of an article; inside: an element that declares itself."""
    if name in NEVER:
        return True
    if name == "header" and not inside:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes) if m[1]}
    if given.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "")):
        return True
    if any(m[5] for m in ATTRIBUTE.finditer(attributes)):
        return True
    if given.get("role", "").lower() in ROLES:
        return True
    for value in (given.get("class", ""), given.get("id", "")):
        for part in value.split():
            words = [w.lower() for w in PIECE.findall(part)]
            if words and words[0] in ("has", "with", "no", "without", "is"):
                continue
            if "with" in words:
                words = words[:words.index("with")]
            if name == "article" and not any(w.startswith("comment") for w in words):
                continue
            if any(w in NAMES or w.startswith(STARTS) for w in words):
                return True
            if not inside and HEADERS & set(words) and not CONTENT & set(words):
                return True
    return False


def parsed(html):
    """The sequence of a page: [(kind, text, block, links)] with kind a tag name ("/" before a closing one,
    "-" for an element that was taken out) or "" for text; block numbers the blocks; links says whether a
    text is that of a link."""
    out, open_ = [], []  # open elements: (name, taken out before it, was taken out itself)
    block = at = gone = links = inside = 0

    def end(k):
        """Close the open elements from the k-th on."""
        nonlocal gone, links, inside
        while len(open_) > k:
            name, _, away = open_.pop()
            gone -= away
            links -= name == "a"
            inside -= name in DECLARED

    def above(names, stops):
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] in names:
                return k
            if open_[k][0] in stops:
                return None
        return None

    def text(upto):
        if not gone and at < upto:
            out.append(("", html[at:upto], block, links > 0))

    for m in iter(lambda: TOKEN.search(html, at), None):
        text(m.start())
        at = m.end()
        name = (m[2] or "").lower()
        if not name or m[4] is not None:
            continue
        if name not in INLINE and name not in UNSEEN:
            block += 1
        if m[1]:
            k = above({name}, set())
            if k is not None:
                if not open_[k][2] and not gone:
                    out.append(("/" + name, "", block, False))
                end(k)
            continue
        if name in P_ENDS and (k := above({"p"}, {"table", "td", "th", "li", "article", "button", "object"})) is not None:
            end(k)
        if name in ENDS and (k := above(*ENDS[name])) is not None:
            end(k)
        if name != "head" and open_ and open_[-1][0] == "head" and name not in RAW | VOID | {"noscript", "template"}:
            end(len(open_) - 1)
        away = surrounds(name, m[3], inside)
        if not gone and name not in UNSEEN:
            out.append(("-" if away else name, "", block, False))
        if name in RAW:
            stop = RAW_ENDS[name].search(html, at)
            at = html.find(">", stop.start()) + 1 if stop else len(html)
            at = at or len(html)
        elif name == "br":
            if not gone:
                out.append(("", " ", block, links > 0))
        elif name not in VOID:
            open_.append((name, gone, away))
            gone += away
            links += name == "a"
            inside += name in DECLARED
    text(len(html))
    return out


def blocks_of(sequence):
    """The sequence with each block's text as one item: ("", text, words in links, words), tags as (kind,)."""
    from html import unescape

    out, parts, own = [], [], None

    def close():
        if parts:
            whole = " ".join(unescape("".join(t for t, _ in parts)).split())
            if whole:
                linked = sum(len(unescape(t).split()) for t, link in parts if link)
                words = whole.count(" ") + 1
                out.append(("", whole, min(linked, words), words))
            parts.clear()

    for kind, text, block, link in sequence:
        if block != own:
            close()
            own = block
        if kind:
            out.append((kind,))
        else:
            parts.append((text, link))
    close()
    return out


def word_kinds(block):
    """(kind, number) of the words of a block, by its length and whether they are links."""
    _, _, linked, words = block
    length = "short" if words < 5 else "middle" if words < 15 else "long"
    return (f"word {length}", words - linked), ("word link", linked)


def sightings(html):
    """{kind: [inside, outside]} of a page whose markup declares one element as its content, else {}."""
    items = blocks_of(parsed(html))
    depth, seen, best = 0, {}, 0
    for item in items:
        if item[0] in DECLARED:
            depth += 1
        elif item[0].lstrip("/") in DECLARED:
            depth -= 1
        elif item[0]:
            seen.setdefault(item[0], [0, 0])[depth <= 0] += 1
        else:
            best += item[3] if depth > 0 else 0
            for kind, n in word_kinds(item):
                seen.setdefault(kind, [0, 0])[depth <= 0] += n
    return seen if best else {}


PRIOR = {"word short": 0.5, "word middle": 1.0, "word long": 1.5, "word link": 0.3, "a": -0.3, "/a": LIGHT, "-": -0.5}
TAG = -0.05  # prior of other tags


def weights_of(counts):
    """{kind: weight} of (kind, inside, outside): the log odds of a kind to lie inside, drawn to its prior."""
    from math import exp, log

    weights = dict(PRIOR)
    for kind, inside, outside in counts:
        share = 1 / (1 + exp(-PRIOR.get(kind, TAG)))
        odds = log((inside + SMOOTH * share) / (outside + SMOOTH * (1 - share)))
        weights[kind] = min(max(odds, LEAST), MOST) if kind.startswith("word") else min(max(odds, HEAVY), LIGHT)
    return weights


def content(html, weights):
    """The texts of the blocks in the run of the page's sequence with the largest sum of weights. The
    borders of an element that declares itself as the content outweigh all words, so no run crosses
    them. Of equal runs the longest of the first ends counts."""
    items = blocks_of(parsed(html))
    best, span, sum_, start = 0.0, (0, 0), 0.0, 0
    for k, item in enumerate(items):
        if not item[0]:
            sum_ += sum(weights[kind] * n for kind, n in word_kinds(item))
        elif item[0].lstrip("/") in DECLARED:
            sum_ = -1.0
        else:
            sum_ += weights.get(item[0], TAG)
        if sum_ > best:
            best, span = sum_, (start, k + 1)
        if sum_ < 0:
            sum_, start = 0.0, k + 1
    return [item[1] for item in items[span[0]:span[1]] if not item[0]]


def fit_weights(pages, sample=SAMPLE, html_col="html"):
    """{kind: weight} from the pages that label themselves: those whose markup declares an article.
    Counted on at most about `sample` of the rows, chosen by hash; without any the priors hold."""
    n = pages.count()
    chosen = pages.where(F.col(html_col).isNotNull())
    if n > sample:
        chosen = chosen.where(F.pmod(F.xxhash64(html_col), F.lit(n)) < sample)

    def run(batches):
        import pyarrow as pa

        total = {}
        for batch in batches:
            for html in batch.column(0):
                for kind, (a, b) in sightings(html.as_py()).items():
                    own = total.setdefault(kind, [0, 0])
                    own[0] += a
                    own[1] += b
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total)), *[pa.array([x[k] for x in total.values()], pa.int64()) for k in (0, 1)]],
                ["kind", "inside", "outside"])

    # Names of tags are what pages call them, so only the frequent ones, at most a few hundred, are taken.
    counts = chosen.select(F.col(html_col).cast("string")).mapInArrow(run, "kind string, inside long, outside long")
    rows = counts.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return weights_of([tuple(r) for r in rows.orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(300).collect()])


def main_text(pages, weights, html_col="html", out_col="text"):
    """pages without html_col and with out_col, the blocks of the main text joined by empty lines.

    Character references are decoded, white space in a block becomes one space. A null or empty page,
    or one without words, has an empty text. An existing column named out_col is replaced. Rows are
    independent, so repeated rows, ties and empty tables need no rule; a page may be of any length.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    rest = [c for c in pages.columns if c not in (html_col, out_col)]

    def run(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = ["\n\n".join(content(h.as_py() or "", shared.value)) for h in batch.column(len(rest))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(texts, pa.string())], [*rest, out_col])

    source = pages.select(*rest, F.col(html_col).cast("string").alias("_".join(["_html", *rest])))
    return source.mapInArrow(run, pages.select(*rest).schema.add(out_col, "string"))


def op11(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return main_text(pages, fit_weights(pages)).withColumn("n_chars", F.char_length("text").cast("long"))
