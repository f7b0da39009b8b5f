"""Main text of pages, with each site's template removed.

A page becomes a tree of elements. What its markup names as no part of the article (menus,
headers, footers, sidebars, notices, adverts, forms, comments) goes by name. Inside an article a
class or an id must name such a part as a whole ("search-box", not "search-algorithms"), or end in a
word that means nothing else ("user-comments"); an id, and a name that only begins with such a word,
count for nothing on a block with most of the article's text, and an id on no heading. For the rest,
every block element's subtree is hashed, tags, classes and text; Spark counts in how many
different pages of its host each subtree stands, copies of one page once, and the subtrees that
recur across many pages of the host are the template and go too; on a large host a fixed count of
pages is enough. Inside an article a subtree must stand in most of the host's pages to be template,
so a passage that documents share stays. An article is what <main>, role=main or <article> holds (the
outermost of them, so a headline beside an <article> in <main> stays), and where these hold less than
most of a page's text, the innermost block that does. Of a header inside it the headings and the
paragraphs stay, of the page's header nothing.

Counting combines on the map side by (host, subtree), so a host of any size is spread over the
tasks. Templates are shipped to the tasks when there are at most `broadcast_most` of them;
beyond that each page gets its own by a join on the page, and the result is the same.

Cases. Null and empty html give an empty text. A URL without a host counts as the host "". Repeated
rows are one page to the counts and a row each in the result. Unclosed, crossed and stray tags are
read as far as they go; a document may be nested to any depth. An empty table gives an empty
result. Other columns are kept; those named like a result are replaced.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.llm import common

#: A subtree outside the article is template on this many pages and this share of the host's, or on
#: ENOUGH pages of any host; inside it, on this many and this share.
OUTSIDE, INSIDE, ENOUGH = (3, 0.1), (5, 0.5), 10
#: Templates that are broadcast, eight bytes each.
BROADCAST_MOST = 2_000_000

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template noembed noframes".split())
NOISE = frozenset(
    "head script style textarea title noscript iframe template noembed noframes nav footer aside form button select option dialog menu svg canvas object audio video map input".split()
)
#: Words of a class or an id that name a part which is no article.
NAMED = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead topbar footer sidebar sidenav ad ads adv advert adverts advertisement advertising adsense "
    "banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "share sharing social related recommended recommendations comment comments commentlist disqus reply replies respond login signin search searchbox toolbar pagination "
    "pager widget widgets copyright paywall skip".split()
)
#: Those of them that mean nothing else, so that a name need not be all of such words.
PLAIN = frozenset(
    "comment comments commentlist disqus cookie cookies consent gdpr newsletter sidebar sidenav advert adverts advertisement advertising adsense sponsored "
    "navbar breadcrumb breadcrumbs pagination paywall popup".split()
)
BESIDE = frozenset("has with without no".split())
#: Words that may stand beside those of NAMED in a name that as a whole names such a part.
AROUND = frozenset(
    "site page main global top bottom left right header post article entry content blog primary secondary inline sticky floating mobile desktop js wp "
    "box bar wrapper wrap container inner outer block area section panel pane group list item items row column col button buttons btn icon icons link links "
    "form input field toggle slot unit placeholder posts articles stories thread message count counter title heading".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that may be the block that holds most of a page's text; a paragraph or a list is not.
HOLDERS = frozenset("html body main article section div center table tbody tr td".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul li dt dd".split()
)
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
NEVER = frozenset(("html", "body", "main", "article"))

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*+(?:\"[^\"]*\"[^>\"']*+|'[^']*'[^>\"']*+)*+)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """`noise` goes wherever it stands; `hint` is a word of a name, `by_id` an id that names a part
    and `loose` a class that begins with a plain word: these are judged by the place. `size` and `own` are characters below, `own` without what
    an id names. `article` says that what stands below is inside an article, `stated` that the
    markup says so, `most` that the block holds most of the page's text."""

    __slots__ = ("tag", "name", "noise", "hint", "by_id", "loose", "kids", "key", "size", "own", "article", "stated", "most")

    def __init__(self, tag: str, name: str = "", noise: bool = False, hint: bool = False, by_id: bool = False, loose: bool = False):
        self.tag, self.name, self.noise, self.hint, self.by_id, self.loose, self.kids, self.key, self.size, self.own = tag, name, noise, hint, by_id, loose, [], 0, 0, 0
        self.article = self.stated = tag in ("article", "main")
        self.most = False


def names_noise(value: str) -> bool:
    """Whether a word of a class or an id names a part that is no article; "has-sidebar" names one beside it."""
    for name in value.split():
        before = ""
        for w in WORD.findall(name):
            w = w.lower()
            if w in NAMED and before not in BESIDE:
                return True
            before = w
    return False


def names_part(value: str) -> tuple[bool, bool]:
    """Whether a class or an id names a part that is no article, as a whole ("search-box", not
    "search-algorithms") or by its last word ("user-comments"); and whether only its first word does."""
    begins = False
    for name in value.split():
        found = [w.lower() for w in WORD.findall(name)]
        while len(found) > 1 and (found[-1].isdigit() or found[-1] == "v"):
            found.pop()
        if any(w in NAMED for w in found) and all(w in NAMED or w in AROUND or w.isdigit() for w in found):
            return True, False
        if found and found[-1] in PLAIN and not BESIDE.intersection(found):
            return True, False
        begins = begins or bool(found) and found[0] in PLAIN
    return False, begins


def opened(tag: str, attributes: str) -> Node:
    noise, name, hint, by_id, loose, main = tag in NOISE, "", False, False, False, False
    if attributes and not attributes.isspace():
        for m in ATTRIBUTE.finditer(attributes):
            what, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if what in ("class", "id"):
                name += f" {value}"
                if (what == "class" or tag not in HEADINGS) and names_noise(value):
                    (part, begins), hint = names_part(value), True
                    by_id = by_id or (part and what == "id")
                    loose = loose or begins
                    noise = noise or (part and what == "class")
            elif what == "role":
                noise, main = noise or value.lower() in ROLES, value.lower() == "main"
            elif what == "style":
                noise = noise or bool(HIDDEN.search(value))
            elif what == "hidden" or value.lower() == "true":
                noise = True
    node = Node(tag, name, *(x and tag not in NEVER for x in (noise, hint, by_id, loose)))
    node.article = node.stated = node.article or main
    return node


def parse(page: str) -> Node:
    """The tree of a page: nodes and strings in page order."""
    root = Node("")
    stack, at = [root], 0
    for m in TAG.finditer(page, 0, page.rfind(">") + 1 if "<!--" not in page else len(page)):
        if m.start() < at:  # inside what a raw element held
            continue
        if m.start() > at:
            stack[-1].kids.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k].tag not in INLINE:
                    break
            continue
        if tag in CLOSES_P or tag in SIBLINGS:
            close(stack, tag)
        node = opened(tag, m[3])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.kids.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].endswith("/"):
            stack.append(node)
    if at < len(page):
        stack[-1].kids.append(page[at:])
    return root


def close(stack: list[Node], tag: str) -> None:
    """End what the start of `tag` ends: an open paragraph, or the sibling before."""
    ends, until = SIBLINGS.get(tag, ()), LISTS.get(tag, ())
    for k in range(len(stack) - 1, 0, -1):
        t = stack[k].tag
        if t in ends or (t == "p" and tag in CLOSES_P):
            del stack[k:]
            return
        if t in until or (t not in INLINE and t != "p" and not ends):
            return


def judge(root: Node) -> None:
    """Find the articles, and take names for noise by the place they stand in.

    Outside an article a word of a name is enough, save on a block that holds most of the page's
    text; inside it an id must name a part, and not stand on most of the article's text."""
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        order.append(n)
        todo.extend(k for k in n.kids if type(k) is Node and not k.noise)
    for n in reversed(order):
        for k in n.kids:
            if type(k) is str:
                long = len(k.strip())
                n.size += long
                n.own += long
            elif not k.noise:
                n.size += k.size
                n.own += 0 if k.by_id else k.own
    for n in order:
        n.most = 2 * n.own > root.own
    held, todo = 0, [root]
    while todo:
        n = todo.pop()
        if n.article:
            held += n.own  # the outermost ones
        elif not (n.by_id or (n.hint and not n.most)):
            todo.extend(k for k in n.kids if type(k) is Node and not k.noise)
    if 2 * held < root.own:
        holder(root).article = True
    todo = [(root, None)]
    while todo:
        n, within = todo.pop()
        if n.hint:
            if within is not None:
                n.noise = (n.by_id or n.loose) and 2 * n.size <= within.size
            else:
                n.noise = n.by_id or not n.most
        if not n.noise:
            here = n if n.article else within
            todo.extend((k, here) for k in n.kids if type(k) is Node and not k.noise)


def holder(root: Node) -> Node:
    """The innermost block that holds most of the page's text; one without a name and without blocks is a passage."""
    n = root
    while True:
        inner = next((k for k in n.kids if type(k) is Node and k.most and not (k.noise or k.by_id) and (k.tag in HOLDERS or "-" in k.tag)), None)
        if inner is None or not (inner.name or any(type(k) is Node and k.tag not in INLINE and k.tag not in VOID for k in inner.kids)):
            return n
        n = inner


def marked(root: Node, host: str) -> tuple[list[int], list[int], int]:
    """Keys of the block subtrees outside and inside an article, and one of the whole kept content.

    Each node gets its key. The walk keeps its own stack, so depth costs nothing but memory."""
    judge(root)
    outside, inside = [], []
    salt = blake2b(host.encode("utf-8", "replace"), digest_size=32).digest()
    todo = [(root, False, False)]
    while todo:
        node, article, done = todo.pop()
        if node.noise:
            continue
        here = article or node.article
        if not done:
            todo.append((node, article, True))
            todo.extend((k, here, False) for k in node.kids if type(k) is Node)
            continue
        parts = [" ".join(k.split()) if type(k) is str else "" if k.noise else f"<{k.key:x}>" for k in node.kids]
        text = f"{node.tag}{node.name}\x00{'\x00'.join(p for p in parts if p)}"
        node.key = int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8, key=salt).digest(), "little", signed=True)
        if node.tag and node.tag not in INLINE and node.tag not in NEVER and node.tag not in VOID and any(parts):
            (inside if article or node.article or node.most else outside).append(node.key)
    return outside, inside, root.key


def weight(node: Node, template) -> int:
    """Characters of the text that would be kept below a node."""
    total, todo = 0, [node]
    while todo:
        n = todo.pop()
        if type(n) is str:
            total += len(n.strip())
        elif not n.noise and n.key not in template:
            todo.extend(n.kids)
    return total


def main_text(page: str | None, host: str, template=frozenset()) -> str:
    """The page's text without what is named as noise and without subtrees of the template."""
    if not page:
        return ""
    root = parse(page)
    marked(root, host)
    articles, todo = [], [root]
    while todo:
        n = todo.pop()
        if n.noise or n.key in template:
            continue
        if n.stated:
            articles.append(n)  # the outermost ones
        else:
            todo.extend(k for k in reversed(n.kids) if type(k) is Node)
    # articles stand for the page when they hold most of it
    tops = articles if articles and 2 * sum(weight(a, template) for a in articles) >= weight(root, template) else [root]
    out: list[str] = []
    todo = [*reversed(tops)]
    within = tops is articles
    while todo:
        n = todo.pop()
        if type(n) is str:
            out.append(n)
        elif n.noise or n.key in template:
            out.append(" ")
        elif n.tag == "header":  # of an article its headings and paragraphs are kept, of a page nothing
            out.append(" ")
            todo.extend([" ", *(h for h in reversed(headings(n)) if within)])
        elif n.tag in INLINE:
            todo.extend(reversed(n.kids))
        else:
            out.append(" ")
            todo.append(" ")
            todo.extend(reversed(n.kids))
    return " ".join(entities.unescape("".join(out)).split())


def headings(node: Node) -> list[Node]:
    found, todo = [], [node]
    while todo:
        n = todo.pop()
        if type(n) is Node and not n.noise:
            if n.tag in HEADINGS or n.tag == "p":
                found.append(n)
            else:
                todo.extend(reversed(n.kids))
    return found


def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, flags, whole = [], [], []
        for page, host in zip(common.strings(b, "html"), common.strings(b, "host")):
            outside, inside, key = marked(parse(page), host)
            own = dict.fromkeys(outside, False) | dict.fromkeys(inside, True)
            keys.append(list(own))
            flags.append(list(own.values()))
            whole.append(key)
        yield pa.RecordBatch.from_arrays(
            [b.column("host"), b.column("page"), pa.array(whole, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(flags, pa.list_(pa.bool_()))], names=["host", "page", "whole", "keys", "inside"]
        )


def templates(found: DataFrame) -> DataFrame:
    """key of each template subtree. Keys are salted with the host, so they name it too."""
    pages = common.settle(found.groupBy("host", "whole").agg(F.first("keys").alias("keys"), F.first("inside").alias("inside")), "contents")
    totals = pages.groupBy("host").agg(F.count("*").alias("total"))
    each = pages.select("host", F.explode(F.arrays_zip("keys", "inside")).alias("s")).groupBy("host", F.col("s.keys").alias("key")).agg(F.count("*").alias("n"), F.max("s.inside").alias("inside"))
    each = each.where(F.col("n") >= min(OUTSIDE[0], INSIDE[0])).join(totals, "host")
    rule = lambda least, share: (F.col("n") >= least) & (F.col("n") >= share * F.col("total"))
    return each.where(F.when(F.col("inside"), rule(*INSIDE)).otherwise(rule(*OUTSIDE) | (F.col("n") >= ENOUGH))).select("key")


def texts_of(shared, html_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = None if shared is None else frozenset(shared.value.tolist())
        for b in batches:
            own = b.column("__keys").to_pylist() if everywhere is None else None
            out = [
                main_text(page, host, everywhere if own is None else frozenset(own[i] or ()))
                for i, (page, host) in enumerate(zip(common.strings(b, html_col), common.strings(b, "__host")))
            ]
            yield common.with_columns(b, [("text", pa.string(), out), ("n_chars", pa.int64(), [len(t) for t in out])], drop=("text", "n_chars", "__host", "__keys", "__page"))

    return run


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", broadcast_most: int = BROADCAST_MOST) -> DataFrame:
    """`pages` with text and n_chars."""
    spark = common.ready(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    page = F.concat(F.hex(F.xxhash64(url_col, html_col)), F.hex(F.xxhash64(F.lit(7), url_col, html_col)))
    marked_pages = pages.withColumn("__host", host)
    narrow = marked_pages.select(F.col("__host").alias("host"), page.alias("page"), F.col(html_col).alias("html"))
    found = common.settle(narrow.mapInArrow(subtrees, "host string, page string, whole long, keys array<long>, inside array<boolean>"), "subtrees")
    template = common.settle(templates(found), "templates")
    fields = [f for f in pages.schema.fields if f.name not in ("text", "n_chars")]
    schema = T.StructType(fields + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    if template.limit(broadcast_most + 1).count() <= broadcast_most:
        keys = np.array([r["key"] for r in template.toLocalIterator()], np.int64)
        return marked_pages.mapInArrow(texts_of(spark.sparkContext.broadcast(keys), html_col), schema)
    per_page = found.select("page", F.explode("keys").alias("key")).distinct().join(template, "key").groupBy("page").agg(F.collect_list("key").alias("__keys"))
    joined = marked_pages.withColumn("__page", page).join(per_page.withColumnRenamed("page", "__page"), "__page", "left")
    return joined.mapInArrow(texts_of(None, html_col), schema)
