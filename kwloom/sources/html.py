"""Records from HTML: a small tree built by the standard parser, extractors for each kind of page, in Arrow batches.

The tree part is Python, since no expression parses HTML; what can be said of the extracted values (which previews count, which
comments are too deep) is left to expressions.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text

# Elements that have no end tag, and those of the page formats.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
POST, COMMENT, FLAIR, OLD_POST = "shreddit-post", "shreddit-comment", "shreddit-post-flair", "thing"


class Node:
    """An element with its attributes and children; strings are text."""

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator["Node"]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def find_all(self, tag: str | None = None, test: Callable[["Node"], bool] = lambda n: True) -> list["Node"]:
        return [n for n in self.walk() if n is not self and (tag is None or n.tag == tag) and test(n)]

    def find(self, tag: str | None = None, test: Callable[["Node"], bool] = lambda n: True) -> "Node | None":
        return next((n for n in self.walk() if n is not self and (tag is None or n.tag == tag) and test(n)), None)

    def get(self, name: str) -> str:
        return self.attrs.get(name) or ""

    def classes(self) -> list[str]:
        return self.get("class").split()

    def strings(self) -> Iterator[tuple[str, str]]:
        """The element's texts in order, each with the name of the element that it stands in."""
        stack: list[tuple[str, Node | str]] = [(self.tag, self)]
        while stack:
            tag, n = stack.pop()
            if isinstance(n, str):
                yield tag, n.strip()
            else:
                stack += [(n.tag, c) for c in reversed(n.children)]

    def text(self, sep: str = " ") -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    out.append(n.strip())
            elif n.tag not in ("script", "style"):
                stack += reversed(n.children)
        return sep.join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def updatepos(self, i, j):
        """Nobody asks for lines and columns, so they aren't counted."""
        return j


def parse(html: str | None) -> Node:
    """The tree of a page; broken markup gives what can be read."""
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def extracted(pages: DataFrame, make: Callable[[Node], list[dict]], schema: str, html: str = "html") -> DataFrame:
    """The pages' own columns (without the html), a place `pos` and the fields that `make` finds; a page without any has no row."""
    own = T.StructType([f for f in pages.schema.fields if f.name != html])
    found = T.StructType.fromDDL(schema)
    full = T.StructType([*own.fields, T.StructField("pos", T.IntegerType()), *found.fields])
    names = [f.name for f in found.fields]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(found)
        for b in batches:
            pages_of, at, rows = [], [], []
            for i, page in enumerate(b.column(html).to_pylist()):
                for k, r in enumerate(make(parse(page))):
                    pages_of.append(i)
                    at.append(k)
                    rows.append({n: r.get(n) for n in names})
            if rows:
                which, made = pa.array(pages_of, pa.int64()), pa.RecordBatch.from_pylist(rows, schema=fields)
                yield pa.RecordBatch.from_arrays([*[b.column(f.name).take(which) for f in own.fields], pa.array(at, pa.int32()), *made.columns], [f.name for f in full.fields])

    return pages.mapInArrow(run, full)


# --- listings of communities ---------------------------------------------------------------------------------------------------


def _communities(root: Node) -> list[dict]:
    out = []
    for d in root.find_all("div", lambda n: "data-community-id" in n.attrs):
        link, shown = d.find("a", lambda n: "href" in n.attrs), d.find("h6")
        out.append({"community_id": d.get("data-community-id"), "name": d.get("data-prefixed-name"), "subscribers_text": d.get("data-subscribers-count"), "displayed_count": shown.text() if shown else "", "description": d.get("data-public-description-text"), "icon_url": d.get("data-icon-url"), "url": link.get("href") if link else ""})
    return out


def communities(pages: DataFrame, page: str = "page", per_page: int = 50) -> DataFrame:
    """Communities of listing pages(page, html), ranked by page and place."""
    raw = extracted(pages, _communities, "community_id string, name string, subscribers_text string, displayed_count string, description string, icon_url string, url string")
    return raw.withColumn("rank", ((F.col(page) - 1) * per_page + F.col("pos") + 1).cast("int")).withColumn("subscribers_count", F.coalesce(F.col("subscribers_text").try_cast("bigint"), F.lit(0).cast("bigint"))).drop("subscribers_text", "pos")


# --- posts -------------------------------------------------------------------------------------------------------------------


def _posts(root: Node) -> list[dict]:
    out = []
    for p in root.find_all(POST):
        title = p.get("post-title")
        if not title:
            body = p.find(None, lambda n: n.get("data-click-id") == "body") or p.find("a")
            title = body.text("") if body else ""
        candidates = [n.text("") for test in (lambda n: n.get("slot") == "text-body", lambda n: n.tag == "div" and "text" in n.get("class"), lambda n: n.tag == "p") for n in p.find_all(None, test)]
        flair = p.find(FLAIR)
        image = p.find("img", lambda n: n.get("src") != "")
        out.append({"title": title, "permalink": p.get("permalink"), "score_text": p.get("score"), "comments_text": p.get("comment-count"), "post_id": p.get("id"), "post_type": p.get("post-type"), "domain": p.get("domain"), "author": p.get("author"), "created_ts": p.get("created-timestamp"), "content_href": p.get("content-href"), "candidates": candidates, "flair": [n.text() for n in flair.find_all("div", lambda n: "flair-content" in n.get("class")) if n.text()] if flair else [], "thumbnail_url": image.get("src") if image else "", "is_promoted": "promoted" in p.attrs or any("promoted" in c.lower() for c in p.classes())})
    if out:
        return out
    for p in root.find_all("div", lambda n: OLD_POST in n.classes()):  # the older layout
        a, c = p.find("a", lambda n: "title" in n.classes()), p.find("a", lambda n: "comment" in n.text())
        number = re.search(r"\d+", c.text()) if c else None
        out.append({"title": a.text("") if a else "", "permalink": a.get("href") if a else "", "score_text": p.get("data-score"), "comments_text": number[0] if number else "", "candidates": [], "flair": [], "is_promoted": "promoted" in p.classes()})
    return out


def preview_counts(t: Column, href: Column) -> Column:
    """Whether a text may be a post's preview: long enough, no name of a community or user, no address."""
    low = F.lower(t)
    return (F.length(t) > 20) & ~low.rlike("^(r/|u/|general discussion)") & ~F.substring(low, 1, 50).contains("http") & (t != F.coalesce(href, F.lit("")))


def posts(pages: DataFrame, site: str = "") -> DataFrame:
    """Posts of front pages(..., html); relative links get the site before them."""
    raw = extracted(pages, _posts, "title string, permalink string, score_text string, comments_text string, post_id string, post_type string, domain string, author string, created_ts string, content_href string, candidates array<string>, flair array<string>, thumbnail_url string, is_promoted boolean")
    link = F.when(F.col("permalink").startswith("/"), F.concat(F.lit(site), "permalink")).otherwise(F.col("permalink"))
    preview = F.coalesce(F.get(F.filter("candidates", lambda t: preview_counts(t, F.col("content_href"))), F.lit(0)), F.lit(""))
    return raw.withColumn("permalink", link).withColumn("content_preview", preview).withColumn("score", text.count_text(F.col("score_text"))).withColumn("comments", text.count_text(F.col("comments_text"))).drop("candidates", "score_text", "comments_text")


# Elements whose own text is no part of a widget's, markers in texts, and titles of widgets that are read elsewhere.
NO_BODY, MARKERS, READ_ELSEWHERE = {"script", "style", "button", "a", "h2", "h3", "span"}, ("SC_OFF", "SC_ON"), {"rules", "moderators"}


def _link_text(link: Node) -> str:
    """What a link shows: its first translatable span that isn't there for hovering only, else the first; else its text, once where it says it twice."""
    spans = link.find_all("span", lambda n: "i18n-translatable-text" in n.get("class"))
    shown = [n for n in spans if not {"hidden", "group-hover:block"} & set(n.classes())]
    for n in (shown[:1] or []) + spans[:1]:
        if n.text(""):
            return n.text("")
    whole = link.text("")
    words = whole.split()
    return " ".join(words[: len(words) // 3]) if len(words) >= 3 and words[0] == words[len(words) // 2] else whole


def _widgets(root: Node) -> list[dict]:
    """The sidebar's widgets: those of two links or more as links, the others as text."""
    side, out = root.find(None, lambda n: n.get("id") == "right-sidebar-contents"), []
    boxes = [c for d in (side.find_all("div", lambda n: "py-md" in n.classes()) if side else []) for c in d.children if isinstance(c, Node) and c.tag == "div" and "px-md" in c.classes()]
    for box in boxes:
        head = box.find(None, lambda n: n.tag in ("h2", "h3", "span") and re.search("font-bold|text-12", n.get("class"), re.I) is not None)
        if head is None:
            continue
        title, links = head.text(""), box.find_all("a", lambda n: "href" in n.attrs)
        if len(links) >= 2:
            found = [{"text": _link_text(a), "url": a.get("href")} for a in links]
            found = [x for x in found if x["text"] and x["url"]]
            if found:
                out.append({"title": title, "content": None, "links": found})
            continue
        body = ""
        if "community info" in title.lower():
            div = box.find("div", lambda n: re.search("i18n-translatable-text.*overflow-hidden", n.get("class")) is not None)
            body = "\n\n".join(x for x in (p.text() for p in (div.find_all("p") if div else [])) if x)
        if not body:
            body = " ".join(t for tag, t in box.strings() if tag not in NO_BODY and len(t) > 2 and t != title and not any(m in t for m in MARKERS))
        if title and body and title.lower() not in READ_ELSEWHERE:
            out.append({"title": title, "content": body, "links": []})
    return out


def _metadata(root: Node) -> list[dict]:
    title, header = root.find("title"), root.find(None, lambda n: n.tag.endswith("subreddit-header") or "data-subscribers" in n.attrs)
    rules = [{"title": n.text(), "description": n.get("data-description")} for n in root.find_all(None, lambda n: "data-rule" in n.attrs or "rule-title" in n.classes())]
    description = root.find("meta", lambda n: n.get("name") == "description")
    get = header.get if header else lambda _: ""
    h1 = root.find("h1")
    return [{"title": title.text() if title else "", "description": get("description") or (description.get("content") if description else ""), "subscribers_text": get("subscribers") or get("data-subscribers"), "online_text": get("active") or get("data-active"), "rules": rules, "title_old": h1.text() if h1 else "", "sidebar_widgets": _widgets(root)}]


def metadata(pages: DataFrame) -> DataFrame:
    """A row a page: title, description, subscriber and online counts, rules, sidebar widgets."""
    raw = extracted(pages, _metadata, "title string, description string, subscribers_text string, online_text string, rules array<struct<title:string,description:string>>, title_old string, sidebar_widgets array<struct<title:string,content:string,links:array<struct<text:string,url:string>>>>")
    return raw.withColumn("subscribers", text.count_text(F.col("subscribers_text"))).withColumn("online_users", text.count_text(F.col("online_text"))).drop("pos", "subscribers_text", "online_text")


def _comments(root: Node) -> list[dict]:
    out = []
    for c in root.find_all(COMMENT):
        ident = c.get("thingid") or c.get("id")
        below = [n for n in c.walk() if n is not c]
        divs, spans = [n for n in below if n.tag == "div"], [(n, n.get("class")) for n in below if n.tag == "span"]
        body = next((n for n in divs if ident != "" and _is_body(n.get("id"), ident)), None) or next((n for n in divs if "md" in n.get("class") or "scalable-text" in n.get("class")), None)
        time = next((n for n in below if n.tag == "time" and "datetime" in n.attrs), None)
        named = lambda word: [n.text("") for n, kind in spans if word in kind]
        awards = [{"id": n.get("data-award-id"), "count": n.get("data-count"), "name": n.text("")} for n, _ in spans if "data-award-id" in n.attrs]
        out.append({"id": ident, "parent_id": c.get("parentid") or None, "depth_text": c.get("depth"), "author": c.get("author"), "score_text": c.get("score"), "award_text": c.get("award-count"), "awards": awards, "flair": named("flair"), "badges": named("badge"), "content_type": c.get("content-type"), "created_ts": time.get("datetime") if time else None, "text": body.text() if body else ""})
    return out


def _is_body(name: str, ident: str) -> bool:
    """Whether an element's id is the comment's, what may be in a line, and the ending of bodies; without an expression to compile for each comment."""
    return name.startswith(ident) and "-post-rtjson-content" in name[len(ident) :].partition("\n")[0]


def comments(pages: DataFrame, max_depth: int | None = None, most: int = 1000) -> DataFrame:
    """Comments of post pages(..., html) that aren't too deep; of each page the first so many."""
    raw = extracted(pages, _comments, "id string, parent_id string, depth_text string, author string, score_text string, award_text string, awards array<struct<id:string,count:string,name:string>>, flair array<string>, badges array<string>, content_type string, created_ts string, text string")
    out = raw.withColumn("depth", text.count_text(F.col("depth_text")).cast("int")).withColumn("score", text.count_text(F.col("score_text"))).withColumn("award_count", text.count_text(F.col("award_text")).cast("int")).drop("depth_text", "score_text", "award_text")
    if max_depth is not None:
        out = out.filter(F.col("depth") <= max_depth)
    return out.filter(F.col("pos") < most)


def _details(root: Node) -> list[dict]:
    p = root.find(POST)
    if not p:
        return []
    media = {"images": ("img", "src"), "videos": ("video", "src"), "embeds": ("iframe", "src")}
    body = p.find(None, lambda n: n.get("slot") == "text-body")
    bar = p.find("div", lambda n: "awards-bar" in n.get("class"))
    awards = []
    for a in bar.find_all("span", lambda n: "award" in n.get("class")) if bar else []:
        icon = a.find("img", lambda n: n.get("src") != "")
        awards.append({"id": a.get("data-award-id"), "count": a.get("data-count"), "name": a.text(""), "icon": icon.get("src") if icon else None})
    named = lambda word: [n.text("") for n in p.find_all("span", lambda n: word in n.get("class"))]
    return [{"awards": awards, "flair": named("flair"), "badges": named("badge"), "post_title": p.get("post-title"), "text_body": body.text() if body else "", "attrs": {k.replace("-", "_"): v for k, v in p.attrs.items()}} | {f"media_{k}": [n.get(a) for n in p.find_all(t) if n.get(a)] for k, (t, a) in media.items()}]


def post_details(pages: DataFrame) -> DataFrame:
    """A row a post page: title, body, all attributes as a map, media links without repeats, awards, flair and badges."""
    raw = extracted(pages, _details, "post_title string, text_body string, attrs map<string,string>, media_images array<string>, media_videos array<string>, media_embeds array<string>, awards array<struct<id:string,count:string,name:string,icon:string>>, flair array<string>, badges array<string>")
    return raw.drop("pos").withColumns({c: F.array_distinct(c) for c in ("media_images", "media_videos", "media_embeds")})


def _state(root: Node) -> list[dict]:
    """Communities in JSON embedded in scripts, wherever a key `communities` has a list."""
    out = []
    for s in root.find_all("script"):
        raw = "".join(c for c in s.children if isinstance(c, str))
        a, b = raw.find("{"), raw.rfind("}")
        if a < 0 or b < a:
            continue
        try:
            stack = [json.loads(raw[a : b + 1])]
        except ValueError:
            continue
        while stack:
            v = stack.pop()
            if isinstance(v, dict):
                if isinstance(v.get("communities"), list):
                    out += [{"community_id": str(c.get("id", "")), "name": f"r/{c.get('name', '')}", "subscribers_count": int(c.get("subscribers") or 0), "description": str(c.get("description") or "")} for c in v["communities"] if isinstance(c, dict)]
                stack += [x for k, x in v.items() if k != "communities"]
            elif isinstance(v, list):
                stack += v
    return out


def embedded_communities(pages: DataFrame) -> DataFrame:
    return extracted(pages, _state, "community_id string, name string, subscribers_count bigint, description string")


# --- any page ------------------------------------------------------------------------------------------------------------------


def page_parts(pages: DataFrame) -> DataFrame:
    """page_id, title, heading, links and body length of pages(page_id, html)."""

    def make(root: Node) -> list[dict]:
        title, h1, article = root.find("title"), root.find("h1"), root.find("article") or root.find("body") or root
        return [{"title": title.text() if title else "", "heading": h1.text() if h1 else "", "links": len(root.find_all("a", lambda n: "href" in n.attrs)), "body_chars": len(article.text())}]

    return extracted(pages.select("page_id", "html"), make, "title string, heading string, links int, body_chars int").drop("pos")


def selector_survey(pages: DataFrame, tags: list[str]) -> DataFrame:
    """Per element name: on how many pages it occurs, how often, and how often with text or with an address as its text."""

    def make(root: Node) -> list[dict]:
        out = []
        for t in tags:
            found = [n.text() for n in root.find_all(t)]
            if found:
                out.append({"tag": t, "hits": len(found), "with_text": sum(bool(x) and not x.startswith("http") for x in found), "with_url": sum(x.startswith("http") for x in found)})
        return out

    raw = extracted(pages.select("page_id", "html"), make, "tag string, hits int, with_text int, with_url int")
    return raw.groupBy("tag").agg(F.count("*").alias("pages"), *[F.sum(c).alias(c) for c in ("hits", "with_text", "with_url")])
