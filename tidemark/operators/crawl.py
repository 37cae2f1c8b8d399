"""Replay of a best-first site crawl over stored pages, and bounded expansion of a category tree."""

from __future__ import annotations

import heapq
import re
import urllib.parse
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged

DEPRIORITIZED = 90

# An encyclopedia's categories ---------------------------------------------------------------------
SUBCATEGORY = "祭|まつり|行事|芸能|民俗|神楽|踊|囃子|山車|神輿|花火"
NAMESPACES = "^(?:Category|Template|Portal|Wikipedia):"
ARTICLES = "https://ja.wikipedia.org/wiki/"


def replay(pages: DataFrame, edges: DataFrame, site: str, budget: int = 40, depth: int = 3, most_queue: int = 1_200) -> DataFrame:
    """(site, seq, url, depth): the order in which a crawl of each site visits its stored pages.

    pages: (site, url, seed); edges: (site, url, to, priority). A page's links queue by (priority, depth, arrival);
    a full queue drops its worst entry. One site is one group: crawling is sequential within a site only.
    """
    left = pages.groupBy(site).agg(F.sort_array(F.collect_list(F.struct("url", "seed"))).alias("pages"))
    right = edges.groupBy(site).agg(F.sort_array(F.collect_list(F.struct("url", "to", "priority"))).alias("edges"))
    both = left.join(right, site, "left")
    schema = f"{site} {dict(pages.dtypes)[site]}, seq int, url string, depth int"

    def run(frames):
        for frame in frames:
            rows = []
            for name, listed, linked in zip(frame[site], frame["pages"], frame["edges"], strict=True):
                rows += [(name, *x) for x in visit(listed, linked if linked is not None else [], budget, depth, most_queue)]
            yield pd.DataFrame(rows, columns=[site, "seq", "url", "depth"])

    return both.mapInPandas(run, schema)


def visit(pages, edges, budget: int, depth: int, most_queue: int) -> list[tuple[int, str, int]]:
    stored = {p["url"] for p in pages}
    out_of: dict[str, list[tuple[int, str]]] = {}
    for e in edges:
        out_of.setdefault(e["url"], []).append((e["priority"], e["to"]))
    queue = [(0, 0, i, p["url"]) for i, p in enumerate(p for p in pages if p["seed"])]
    heapq.heapify(queue)
    arrived, seen, order = len(queue), {q[3] for q in queue}, []
    while queue and len(order) < budget:
        _, level, _, url = heapq.heappop(queue)
        if url not in stored:
            continue
        order.append((len(order) + 1, url, level))
        if level == depth:
            continue
        for priority, to in out_of.get(url, []):
            if to in seen:
                continue
            seen.add(to)
            arrived += 1
            heapq.heappush(queue, (priority, level + 1, arrived, to))
            if len(queue) > most_queue:
                queue.remove(max(queue))
                heapq.heapify(queue)
    return order


@dataclass
class Stored:
    """What is stored of one address: where it led, whether it is a feed or sitemap, and its outward links in order."""

    final_url: str = ""
    feed: bool = False
    links: list[tuple[str, int, int | None]] = field(default_factory=list)  # address, priority, cultural rank
    feeds: list[str] = field(default_factory=list)


@dataclass
class Frontier:
    """The bounded queue of a site's crawl: a full queue drops its worst entry."""

    most: int
    heap: list[tuple[int, int, int, str, str]] = field(default_factory=list)
    arrived: int = 0

    def push(self, url: str, depth: int, kind: str, priority: int) -> None:
        self.arrived += 1
        heapq.heappush(self.heap, (priority, depth, self.arrived, url, kind))
        if len(self.heap) > self.most:
            self.heap.remove(max(self.heap))
            heapq.heapify(self.heap)

    def pop(self) -> tuple[int, str, str]:
        _, depth, _, url, kind = heapq.heappop(self.heap)
        return depth, url, kind


def discover(
    stored: dict[str, Stored], seeds: list[str], budget: int = 40, depth: int = 3, cultural: int = 0, scope: str = "", most_queue: int = 1_200, most_children: int = 200, skip: str = r"(?i)\.(pdf|zip|docx?|xlsx?|jpe?g|png|gif|mp4)$",
) -> list[tuple[int, str, str, str, int]]:
    """(seq, url, fetch_url, kind, depth): the crawl of one site over stored pages, in the order of its visits.

    Best first by (priority, depth, arrival). Seeds and their sitemaps come first; a seed that leads to another host
    makes that host part of the site; feeds and sitemaps give their first `most_children` addresses. scope: only
    addresses below it count, one leading path segment more being allowed. A second stage takes up to `cultural`
    pages with a cultural rank from what the queue still holds, two levels deeper; it changes nothing of the first.
    """
    hosts = {urllib.parse.urlsplit(s).netloc for s in seeds if s}
    below = re.compile("^(?:/[^/]+)?" + re.escape(urllib.parse.urlsplit(scope).path)) if scope else None
    queue, visited, out = Frontier(most_queue), set(), []

    def wanted(url: str) -> bool:
        parts = urllib.parse.urlsplit(url)
        return url not in visited and parts.netloc in hosts and (below is None or below.match(parts.path) is not None) and not re.search(skip, parts.path)

    def visit(url: str, kind: str, level: int) -> Stored | None:
        visited.add(url)
        page = stored.get(url)
        if page:
            out.append((len(out) + 1, page.final_url or url, url, kind, level))
        return page

    for seed in filter(None, seeds):
        queue.push(seed, 0, "seed", -1)
        if not scope:
            queue.push(urllib.parse.urljoin(seed, "/sitemap.xml"), 0, "sitemap", -1)
    while queue.heap and len(out) < budget:
        level, url, kind = queue.pop()
        page = visit(url, kind, level) if wanted(url) else None
        if page is None:
            continue
        if kind == "seed" and page.final_url:
            hosts.add(urllib.parse.urlsplit(page.final_url).netloc)
        if level >= depth:
            continue
        kind_below = ("sitemap" if kind == "sitemap" else "feed") if page.feed else "index"
        for feed in page.feeds if level == 0 and not page.feed else ():
            if wanted(feed):
                queue.push(feed, level + 1, "feed", 0)
        for child, priority, _ in page.links[:most_children] if page.feed else page.links:
            if wanted(child):
                queue.push(child, level + 1, kind_below, priority)
    ranks = {child: rank for page in stored.values() for child, _, rank in page.links if rank is not None}
    taken = 0
    while queue.heap and taken < cultural:
        level, url, _ = queue.pop()
        if url not in ranks or not wanted(url):
            continue
        page = visit(url, "cultural", level)
        if page is None:
            continue
        taken += 1
        for child, _, rank in page.links if level < depth + 2 and not page.feed else ():
            if rank is not None and wanted(child):
                queue.push(child, level + 1, "cultural", rank)
    return out


def discover_sites(pages: DataFrame, edges: DataFrame, site: str, **options) -> DataFrame:
    """(site, seq, url, fetch_url, kind, depth) of every site's crawl over stored pages.

    pages: (site, url, final_url, feed, seed, scope); edges: (site, url, to, ord, priority, rank, feed_link). One site
    is one group: a crawl is sequential within its site, and its queue holds most_queue entries.
    """
    listed = F.array_sort(F.collect_list(F.struct("url", "final_url", "feed", "seed", "scope")))
    linked = F.array_sort(F.collect_list(F.struct("url", "ord", "to", "priority", "rank", "feed_link")))
    both = pages.groupBy(site).agg(listed.alias("pages")).join(edges.groupBy(site).agg(linked.alias("edges")), site, "left")
    schema = f"{site} {dict(pages.dtypes)[site]}, seq int, url string, fetch_url string, kind string, depth int"

    def run(frames):
        for frame in frames:
            rows = []
            for name, own, links in zip(frame[site], frame["pages"], frame["edges"], strict=True):
                stored = {p["url"]: Stored(p["final_url"] or "", bool(p["feed"])) for p in own}
                for e in links if links is not None else ():
                    page = stored.get(e["url"])
                    if page and e["feed_link"]:
                        page.feeds.append(e["to"])
                    elif page:
                        page.links.append((e["to"], int(e["priority"]), None if pd.isna(e["rank"]) else int(e["rank"])))
                seeds = [p["url"] for p in own if p["seed"]]
                scope = next((p["scope"] for p in own if p["seed"] and p["scope"]), "")
                rows += [(name, *x) for x in discover(stored, seeds, scope=scope, **options)]
            yield pd.DataFrame(rows, columns=[site, "seq", "url", "fetch_url", "kind", "depth"])

    return both.mapInPandas(run, schema)


def expand(edges: DataFrame, roots: DataFrame, parent: str, child: str, most_depth: int = 2, follow: str | None = None) -> DataFrame:
    """(node, depth): everything within most_depth steps of the roots, each at its least depth. A bounded number of joins.

    follow: only nodes whose name this pattern finds are walked into (the roots always are).
    """
    reached = roots.select(F.col(roots.columns[0]).alias("node"), F.lit(0).alias("depth"))
    frontier = reached
    for step in range(1, most_depth + 1):
        open_nodes = frontier if follow is None or step == 1 else frontier.filter(F.col("node").rlike(follow))
        frontier = open_nodes.select(F.col("node").alias(parent)).join(edges, parent).select(F.col(child).alias("node"), F.lit(step).alias("depth")).distinct()
        reached = reached.unionByName(frontier)
    return reached.groupBy("node").agg(F.min("depth").alias("depth"))


_PATHS = """
WITH RECURSIVE walk(prefecture, category, depth, path) AS (
  SELECT prefecture, category, 0, lpad(CAST(ord AS STRING), 9, '0') FROM {roots}
  UNION ALL
  SELECT w.prefecture, e.child, w.depth + 1, concat(w.path, '/', lpad(CAST(e.ord AS STRING), 9, '0')) FROM walk w JOIN {edges} e ON e.parent = w.category WHERE w.depth < {depth}
) SELECT * FROM walk
"""


def visited_categories(edges: DataFrame, roots: DataFrame, most_depth: int = 2, follow: str = SUBCATEGORY) -> DataFrame:
    """(prefecture, category, depth, path): the categories that a depth-first walk of each prefecture's roots visits.

    edges: (parent, child, ord); roots: (prefecture, category, ord). A category is visited once for a prefecture, on the
    first path in the order of ords that comes to it; below most_depth, and into children whose name `follow` doesn't
    find, nobody goes. A path counts only if every category on it was first visited there, so a category that is met
    early at the last depth is not walked into later either.

    A recursive query lists the paths, of which there are at most (children)^most_depth a root; which of them are visited
    depends on earlier paths only, and rounds of "first of its category among the paths that still count" go on until they agree.
    """
    spark = edges.sparkSession
    followed = edges.filter(F.col("child").rlike(follow)).select("parent", "child", "ord").distinct()
    paths = staged(spark.sql(_PATHS, edges=followed, roots=roots, depth=most_depth), "category-paths")
    alive, last = paths, None
    while True:
        first = staged(alive.groupBy("prefecture", "category").agg(F.min_by(F.struct("depth", "path"), "path").alias("f")).select("prefecture", "category", "f.depth", "f.path"), "category-visits")
        # Distinct paths with their category: a sum of hashes tells two rounds apart.
        now = first.agg(F.count("*"), F.sum(F.xxhash64("prefecture", "category", "path").cast("decimal(38,0)"))).first()
        if now == last:
            return first
        last, alive = now, paths
        for step in range(1, most_depth + 1):
            alive = _on_visited(alive, first, step)


def _on_visited(alive: DataFrame, first: DataFrame, step: int) -> DataFrame:
    """Paths of `step` steps or more whose category after that many was first visited there, and all shorter ones."""
    above = F.when(F.col("depth") >= step, F.substring_index("path", "/", step))
    seen = first.select(F.col("prefecture").alias("__p"), F.col("path").alias("__path"), F.lit(True).alias("__seen"))
    marked = alive.withColumn("__above", above)
    joined = marked.join(seen, (F.col("prefecture") == F.col("__p")) & (F.col("__above") == F.col("__path")), "left")
    return joined.filter(F.col("__above").isNull() | F.col("__seen")).select(*alive.columns)


def gazetteer(members: DataFrame, edges: DataFrame, roots: DataFrame, most_depth: int = 2, follow: str = SUBCATEGORY, base: str = ARTICLES) -> DataFrame:
    """(prefecture, name, category, url): every article of the visited categories, once for a prefecture, with the category that it was first seen in.

    members: (category, title, ord); edges and roots as in visited_categories. Titles with a namespace are left out. A
    category's own articles come before those of its subcategories.
    """
    visits = visited_categories(edges, roots, most_depth, follow)
    rows = visits.join(members.filter(~F.col("title").rlike(NAMESPACES)), "category")
    first = rows.groupBy("prefecture", F.col("title").alias("name")).agg(F.min_by("category", F.struct("path", "ord")).alias("category"))
    return first.select("prefecture", "name", F.replace("category", F.lit("Category:"), F.lit("")).alias("category"), F.concat(F.lit(base), quoted_path(F.replace("name", F.lit(" "), F.lit("_")))).alias("url"))


def quoted_path(text: Column) -> Column:
    """Percent-encoding as addresses' paths have it: slashes and -._~ stay."""
    out = F.url_encode(text)
    for java, path in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(java), F.lit(path))
    return out
