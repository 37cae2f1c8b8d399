"""How pages are fetched: who may be asked, when, over which connection; harvests that page through a form.

Fetching itself is an ingestion job; here are its rules as functions and plans, with the transport as a parameter.
"""

from __future__ import annotations

import re
import ssl
import urllib.robotparser
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AGENT = "tidemark"
#: Seconds between two requests to one host; requests to a host in one run.
DELAY, MOST_REQUESTS = 1.0, 1_000


def tls_context() -> ssl.SSLContext:
    """A context that also talks to old servers (short keys), and still verifies names and certificates."""
    context = ssl.create_default_context()
    context.set_ciphers("DEFAULT:@SECLEVEL=1")
    context.minimum_version = ssl.TLSVersion.TLSv1_2
    return context


def may_fetch(robots: str | None, url: str, agent: str = AGENT) -> bool:
    """Whether a host's robots.txt lets the agent ask for an address; a host without one lets everything."""
    if robots is None:
        return True
    rules = urllib.robotparser.RobotFileParser()
    rules.parse(robots.splitlines())
    return rules.can_fetch(agent, url)


def fetch_plan(requests: DataFrame, host: str, order: str, cached: str, allowed: str, delay: float = DELAY, most: int = MOST_REQUESTS) -> DataFrame:
    """requests with action and start_second: from the cache, denied by robots, over the host's cap, or fetched serially.

    Within a host, fetches start `delay` seconds apart in the given order; hosts run side by side.
    """
    free = F.when(F.col(cached), "cache").when(~F.col(allowed), "denied")
    rows = requests.withColumn("__free", free)
    w = Window.partitionBy(host).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turn = F.sum(F.when(F.col("__free").isNull(), 1).otherwise(0)).over(w)
    action = F.when(F.col("__free").isNotNull(), F.col("__free")).when(turn > most, "capped").otherwise("fetch")
    out = rows.withColumn("action", action)
    return out.withColumn("start_second", F.when(F.col("action") == "fetch", (turn - 1) * F.lit(delay))).drop("__free")


def harvest(post: Callable[[dict[str, str]], tuple[int, str]], token: Callable[[], str], parse: Callable[[str], dict[str, str]], most_pages: int = 40) -> dict[str, str]:
    """All rows of a search that pages through a form with a session token: until a page brings nothing new.

    post: sends the fields and gives (status, page); a refused token (403) is renewed once a page. parse: rows of a page.
    """
    found: dict[str, str] = {}
    session = token()
    for number in range(1, most_pages + 1):
        status, page = post({"token": session, "page": str(number)})
        if status == 403:
            session = token()
            status, page = post({"token": session, "page": str(number)})
        rows = parse(page) if status == 200 else {}
        if not rows.keys() - found.keys():
            break
        found |= rows
    return found


def stored_once(fetch: Callable[[str], bytes], cache: dict[str, bytes], urls: list[str], force: bool = False) -> Iterator[tuple[str, bytes]]:
    """(address, body) of a few single requests, each asked for only if the cache has no body or with force."""
    for url in urls:
        if force or url not in cache:
            cache[url] = fetch(url)
        yield url, cache[url]


def session_token(page: str) -> str:
    """The hidden token of a search form; '' without one."""
    found = re.search(r'<input[^>]+name="_?(?:csrf_?token|token)"[^>]+value="([^"]*)"', page, re.I)
    return found[1] if found else ""
