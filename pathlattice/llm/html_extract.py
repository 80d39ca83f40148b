"""HTML main text by consensus of host paths.

Pass 1 cuts every page into blocks of text, each with the path of its containers, and scores the containers: a block gives its
code points, less those inside links, to its nearest containers. A container's path is generalised to
``tag.class`` steps (ids, digits and all but the first class are dropped), so pages made from one template agree. Per host the
votes for each path are summed in Spark; the path with most votes wins. Pass 2 reads each page again and takes the blocks
under the winning path of its host; a page without that path (or without a host) uses its own best container. Either is
widened to the parents that add text of the article (``climb``), so a heading or lead beside the body's wrapper stays.

Never part of the text: script, style, template and form content, navigation, header, footer and aside elements, and
containers whose class, id or role names them as menu, sidebar, notice, advert or reader comments (unless the page's text is
in them, see ``page_blocks``).

Text: character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in
page order by one line end. Block elements end a block; ``br`` is white space.

Cases: null or empty html, or html without text, gives an empty text; a null url has no host; broken or unclosed markup is
closed by the next fitting end tag or by the end of the page; html without any article-like container uses the body; a
repeated row votes and is returned as often as it is there; other columns are ignored; an empty table gives an empty result.

Scale: votes leave a task once per (host, path) of a batch and are summed with map-side partials, so a hot host sends few
rows; winners are one row per host, and join back to the pages by broadcast only when their counted size allows, else by a
shuffle join with the host salted.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathlattice.llm.common import BROADCAST_BYTES, map_arrow, stage

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript textarea iframe svg math title head object".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre search "
                   "section select summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article main section div td body html".split())
BOILERPLATE = frozenset("nav header footer aside form button select menu dialog label option fieldset search".split())
P_ENDERS = BLOCKS - {"body", "html"}
SIBLING_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
NAMES = (
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side|footer|header|masthead|ads?|advert\w*|adverts|banner|sponsor\w*|promo\w*|"
    r"cookies?|consent|notice|gdpr|popup|modal|newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|"
    r"comments?|disqus|replies|pagination|pager|toolbar|widget|complementary|contentinfo")
# What may stand behind such a name in a compound (comments-section), and what before it only says how a wrapper looks (has-sidebar).
TAILS = (r"section|list|block|box|area|wrap|wrapper|container|panel|links?|buttons?|icons?|bar|slot|unit|left|right|top|bottom|inner|items?|"
         r"form|thread|feed|posts?|articles?|stories|news")
LOOKS = r"has|with|without|no|is|show|hide"
NAMED_WHOLE = re.compile(rf"(?:^|\s)(?:{NAMES})(?=$|\s)", re.I)
NAMED_COMPOUND = re.compile(rf"(?:^|\s)(?!(?:{LOOKS})[_-])(?:[^\s_-]+[_-]+)*?(?:{NAMES})(?:[_-]+(?:{NAMES}|{TAILS}|\d+))*(?=$|\s)", re.I)
NAMED_PART = re.compile(rf"(?:^|[\s_.-])(?:{NAMES})(?:$|[\s_-])", re.I)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")  # of any name, so values are passed over
READ = frozenset("class id role hidden aria-hidden".split())
WHITE = re.compile(r"\s+")
SALTS = 16
# Elements nested deeper belong to the container at this depth, as in browsers; their text stays.
MAX_DEPTH = 512


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text) if text.strip(" /") else ():
        if name.lower() in READ:
            out.setdefault(name.lower(), "".join(values))  # the first of a name counts
    return out


def step(tag: str, attrs: dict[str, str]) -> str:
    """Generalised path step: the tag and its first class, without digits."""
    first = attrs.get("class", "").split()
    name = re.sub(r"[\d]+", "", first[0]).strip("-_") if first else ""
    return f"{tag}.{name.lower()}" if name else tag


def is_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    if tag in ("html", "body", "main", "article"):
        return False
    return tag in BOILERPLATE or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true"


def is_named(tag: str, attrs: dict[str, str], pattern: re.Pattern = NAMED_COMPOUND) -> bool:
    """Whether class, id or role name an element as something beside the text."""
    return tag not in ("html", "body", "main", "article") and any(pattern.search(attrs.get(k, "")) for k in ("class", "id", "role"))


def page_blocks(page: str) -> list[tuple[str, int, tuple[str, ...]]]:
    """Blocks outside boilerplate: text, code points in links, and the paths of its containers, outermost first.

    A name is no proof. An element with a whole name (``sidebar``) stays for the vote only when nothing else has text that is not linked. One
    with a compound name (``page-header``, ``elementor-widget``) stays too when it holds over three quarters of that text, or a
    quarter with the page's heading, an ``article`` or a ``main`` in it. What is boilerplate inside it still goes. A name that is only
    a part of another word group (``related-news-page``) takes nothing out; it halves the container's votes."""
    blocks, whole, heads = parse_blocks(page)
    if not whole:
        return [x[:3] for x in blocks]
    # blocks by the outermost named element around them that does not stay
    under: dict[int, list[int]] = {}
    sizes: dict[int, int] = {}
    worth = [max(0, len(text) - linked) for text, linked, *_ in blocks]
    level = [0] * len(blocks)

    def put(i: int) -> None:
        chain = blocks[i][3]
        k = chain[level[i]] if level[i] < len(chain) else -1
        under.setdefault(k, []).append(i)
        sizes[k] = sizes.get(k, 0) + worth[i]

    for i in range(len(blocks)):
        put(i)
    total = sum(worth)
    tried: set[int] = set()
    while True:
        k = max((k for k in sizes if k >= 0 and k not in tried), key=lambda k: (sizes[k], -k), default=None)
        if k is None or not sizes[k]:
            break
        size = sizes[k]
        if not (sizes.get(-1, 0) == 0 if whole[k] else 4 * size > 3 * total or (k in heads and 4 * size >= total)):
            tried.add(k)
            continue
        del sizes[k]
        for i in under.pop(k):
            level[i] += 1
            put(i)
    return [blocks[i][:3] for i in sorted(under.get(-1, []))]


def parse_blocks(page: str) -> tuple[list[tuple[str, int, tuple[str, ...], tuple[int, ...]]], dict[int, bool], set[int]]:
    """In one pass: the blocks outside boilerplate elements, each with the positions of the elements around it that their names make
    boilerplate, outermost first; whether each such name is a whole one; and those with a heading, ``article`` or ``main`` in them."""
    out: list[tuple[str, int, tuple[str, ...], tuple[int, ...]]] = []
    # tag, path, boilerplate at or above it, named at or above it, paths of the containers down to it
    stack: list[tuple[str, str, bool, tuple[int, ...], tuple[str, ...]]] = []
    whole: dict[int, bool] = {}
    heads: set[int] = set()
    text: list[str] = []
    linked = at = links = articles = 0

    def flush():
        nonlocal linked
        if text:
            block = WHITE.sub(" ", entities.unescape("".join(text))).strip()
            if block:
                out.append((block, linked, (stack[-1][4] if stack else ()) or ("",), stack[-1][3] if stack else ()))
            text.clear()
        linked = 0

    def cut(i: int) -> None:
        nonlocal articles
        flush()
        articles -= sum(x[0] == "article" for x in stack[i:])
        del stack[i:]

    def close(tags) -> None:
        """Close the innermost open element of ``tags`` and all inside it, not reaching out of its container."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                cut(i)
                return
            if stack[i][0] in CONTAINERS or stack[i][0] in ("ul", "ol", "table", "dl"):
                return

    def take(piece: str) -> None:
        nonlocal linked
        if piece and not (stack and stack[-1][2]):
            text.append(piece)
            if links:
                linked += len(piece.strip())

    while True:
        m = TOKEN.search(page, at)
        if m is None:
            take(page[at:])
            break
        take(page[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in BLOCKS:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        cut(i)
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if end is None and tag in ("head", "title", "noscript", "object", "svg", "math"):
                continue  # unclosed: its content is read as markup
            at = end.end() if end else len(page)
            take(" ")
            continue
        if tag == "a":
            links += 1
        elif tag == "br":
            take(" ")
        elif tag in BLOCKS:
            if tag in P_ENDERS:
                close(("p",))
            if tag in SIBLING_ENDS:
                close(SIBLING_ENDS[tag])
            flush()
            if tag not in VOID:
                attrs = attributes(m[3])
                path, out_of_text, named, containers = stack[-1][1:] if stack else ("", False, (), ())
                deep = len(stack) >= MAX_DEPTH
                # the header of an article is the article's
                of_article = tag == "header" and articles > 0
                if is_boilerplate(tag, attrs) and not (of_article and is_boilerplate("div", attrs) is False):
                    out_of_text = True
                elif not (out_of_text or of_article or deep) and is_named(tag, attrs):
                    named += (at,)
                    whole[at] = is_named(tag, attrs, NAMED_WHOLE)
                if tag in ("h1", "article", "main") and not out_of_text:
                    heads.update(named)
                articles += tag == "article"
                if not deep:
                    path = f"{path}/{step(tag, attrs)}"
                    containers = (*containers, path) if tag in CONTAINERS else containers
                stack.append((tag, path, out_of_text, named, containers))
                links = 0
    flush()
    return out, whole, heads


@lru_cache(maxsize=4096)
def doubtful(path: str) -> bool:
    """Whether a part of the name of the path's last step speaks of something beside the text."""
    last = path.rsplit("/", 1)[-1]
    return "." in last and NAMED_PART.search(last[last.index("."):]) is not None


def container_scores(blocks) -> dict[str, float]:
    """Score of each container path of a page. A block gives its unlinked code points to its nearest container in
    full and to each one further out by half; ``article`` and ``main`` count double, as their name says what they are."""
    scores: dict[str, float] = {}
    for block, linked, paths in blocks:
        worth = float(max(0, len(block) - 2 * linked))
        for path in reversed(paths):
            last = path.rsplit("/", 1)[-1].split(".")[0]
            scores[path] = scores.get(path, 0.0) + worth * (2 if last in ("article", "main") else 1) / (1 + doubtful(path))
            worth /= 2
    return scores


def text_under(blocks, path: str) -> str:
    return "\n".join(b for b, _, paths in blocks if path in paths)


def climb(blocks, path: str) -> str:
    """The outermost container around ``path`` whose further text is the article's: a parent is taken while what it adds is hardly
    linked. Never out of an ``article`` or ``main``, and never to the whole body, which holds what is around an article too."""
    while path.rsplit("/", 1)[-1].split(".")[0] not in ("article", "main"):
        # containers of one path may have parents of one path only
        chain = next(paths for _, _, paths in blocks if path in paths)
        place = chain.index(path)
        parent = chain[place - 1] if place else ""
        if parent.rsplit("/", 1)[-1].split(".")[0] in ("", "body", "html"):
            break
        added = [(len(b), linked) for b, linked, paths in blocks if parent in paths and path not in paths]
        if 4 * sum(k for _, k in added) > sum(n for n, _ in added):
            break
        path = parent
    return path


def host(url="url"):
    return F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def winning_paths(pages: DataFrame) -> DataFrame:
    """``host, path``: per host the path with most votes (the first by name among equals). A page's vote for a path is
    its share of the page's best score, so a long page has no more say than a short one."""
    def vote(batches):
        for batch in batches:
            votes: dict[tuple[str, str], float] = {}
            for h, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                scores = container_scores(page_blocks(page))
                top = max(scores.values(), default=0.0)
                if top > 0:
                    for path, s in scores.items():
                        votes[h, path] = votes.get((h, path), 0.0) + s / top
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in votes], pa.string()), pa.array([p for _, p in votes], pa.string()),
                 pa.array(list(votes.values()), pa.float64())], names=["host", "path", "votes"])

    able = pages.select(host().alias("host"), "html").filter("host <> '' AND html IS NOT NULL AND html <> ''")
    votes = map_arrow(able, vote, "host string, path string, votes double")
    # sums are rounded, so that the order of partial sums cannot change a winner
    sums = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 4).alias("votes"))
    return sums.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), F.col("path"))).alias("path"))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, path`` for every row of ``pages (page_id, url, html)``."""
    winners = stage(spark, winning_paths(pages), "host-paths")
    side = pages.select("page_id", "url", "html", host().alias("_host"))
    widest = winners.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("host") + F.length("path")).alias("w")).first()
    if widest["n"] * ((widest["w"] or 0) + 64) <= BROADCAST_BYTES:
        joined = side.join(F.broadcast(winners), side._host == winners.host, "left")
    else:  # a hot host's pages go to SALTS tasks
        salted = winners.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        side = side.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        joined = side.join(salted, (side._host == salted.host) & (side._salt == salted._salt), "left").drop("_salt")
    id_type = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                rows = batch.slice(lo, 500)
                texts, used = [], []
                for page, path in zip(rows.column("html").to_pylist(), rows.column("path").to_pylist()):
                    blocks = page_blocks(page or "")
                    text = text_under(blocks, path) if path is not None else ""
                    if not text and blocks:
                        scores = container_scores(blocks)
                        path = min(scores, key=lambda p: (-scores[p], p))
                        text = text_under(blocks, path)
                    if text and path:
                        path = climb(blocks, path)
                        text = text_under(blocks, path)
                    texts.append(text)
                    used.append(path if text else None)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()),
                     pa.array(np.array([len(t) for t in texts], np.int64)), pa.array(used, pa.string())],
                    names=["page_id", "url", "text", "n_chars", "path"])

    return map_arrow(joined.select("page_id", "url", "html", "path"), run,
                     f"page_id {id_type}, url string, text string, n_chars bigint, path string")
