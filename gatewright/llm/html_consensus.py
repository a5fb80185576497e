"""Main text of pages by the path that a host's pages agree on.

Each page scores its containers by the text they hold (links count against it,
outer containers get a share of what inner ones hold) and votes for the best
with their generalised paths: tags and classes from the root, numbers left out.
Spark sums per host and path the votes, the pages that have text there, and the
votes their rivals got on just these pages: the body and the page as a whole are
the rivals of any container below them, and the other way round. A host agrees
on a path that several pages have and that beats its rivals. Every page is then
read again and its text taken from the agreed path it has that won the largest
share of a vote per page, so a rare template is not outvoted by what it shares
with common ones; the body and the whole page come last. A page without an
agreed path keeps its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are known by their tags, roles and the names in their classes
and ids. A form that holds most of a page's text is a wrapper of it, and a name
that may as well be a subject's (``share-price``) marks only links; headings in a header inside the container stay. A line break element
is white space, a block element ends a block.

Defined cases: a null html is an empty page with empty text. Pages without a
host take no part in the vote and use their own best container. Pages cut off
anywhere, even in a tag, are read as far as they go. Rows with equal ids vote
and are extracted one by one. Of paths with equal shares the first in the
alphabet counts, of containers with equal scores the outer one. A long page is
read in linear time. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import staged
from gatewright.llm.html_blocks import CONTAINERS, Block, Element, parse

OUTER_SHARE = 0.7
#: Tags of the body and of the element that stands for the whole page.
OUTER = frozenset(["", "body"])
VOTES_PER_PAGE = 3
#: The fewest pages that can agree on a path.
LEAST_PAGES = 2
#: Paths of all hosts together that go to every task as they are; beyond that a host's pages are dealt to ``HOST_PARTS`` parts.
BROADCAST_BYTES = 32 << 20
HOST_PARTS = 64


def host_of(url: Column) -> Column:
    """The host in lower case, null where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def container_scores(elements: list[Element], blocks: list[Block]) -> dict[int, float]:
    """Score per container element that holds text; 0 is the page as a whole."""
    scores: dict[int, float] = {}
    for block in blocks:
        worth = float(len(block.text) - 2 * block.link_chars)
        at, share = block.owner, 1.0
        while at >= 0:
            if elements[at].tag in CONTAINERS or at == 0:
                scores[at] = scores.get(at, 0.0) + worth * share
                share *= OUTER_SHARE
            at = elements[at].parent
    return scores


def ranked(elements: list[Element], blocks: list[Block]) -> list[tuple[int, float]]:
    """Containers by descending score, the outer one of equals first."""
    return sorted(container_scores(elements, blocks).items(), key=lambda s: (-s[1], s[0]))


def text_in(elements: list[Element], blocks: list[Block], chosen: set[int]) -> str:
    """Text of the blocks below the chosen elements. Of what a header holds, only headings count."""
    inside = [False] * len(elements)
    for k, element in enumerate(elements):
        inside[k] = k in chosen or element.parent >= 0 and inside[element.parent]
    return "\n\n".join(b.text for b in blocks if inside[b.owner] and (b.heading or not elements[b.owner].in_header))


def extract(page: str, paths: list[str]) -> str:
    """Text below the first of ``paths`` that holds any on this page, else below the page's own best container."""
    elements, blocks = parse(page)
    if not blocks:
        return ""
    for path in paths:
        found = text_in(elements, blocks, {k for k, e in enumerate(elements) if e.path == path and (e.tag in CONTAINERS or k == 0)})
        if found:
            return found
    for best, _ in ranked(elements, blocks):
        found = text_in(elements, blocks, {best})
        if found:
            return found
    return ""


def page_votes(pages: DataFrame) -> DataFrame:
    """``host, path, outer, vote, rival, pages`` of all containers with text, summed per batch.

    A page's best containers share at most one vote. ``rival`` is the best vote on the same page of the body or the
    whole page (``outer``) for other containers, and of other containers for these two.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            summed: dict[tuple[str, str, bool], list[float]] = {}
            for host, page in zip(*[c.to_pylist() for c in batch.columns]):
                elements, blocks = parse(page)
                scored = ranked(elements, blocks)
                best = [(k, s) for k, s in scored[:VOTES_PER_PAGE] if s > 0]
                total = sum(s * s for _, s in best)
                votes = {(elements[k].path, elements[k].tag in OUTER): 0.0 for k, _ in scored}
                for k, s in best:
                    votes[elements[k].path, elements[k].tag in OUTER] += s * s / total
                rival = {side: max((v for (_, o), v in votes.items() if o != side), default=0.0) for side in (False, True)}
                for (path, outer), v in votes.items():
                    row = summed.setdefault((host, path, outer), [0.0, 0.0, 0])
                    row[0] += v
                    row[1] += rival[outer]
                    row[2] += 1
            rows = [(*key, *row) for key, row in summed.items()]
            yield pa.RecordBatch.from_pylist([dict(zip(names.names, r)) for r in rows], schema=names)

    names = pa.schema([("host", pa.string()), ("path", pa.string()), ("outer", pa.bool_()), ("vote", pa.float64()), ("rival", pa.float64()), ("pages", pa.int64())])
    rows = pages.select(host_of(F.col("url")).alias("host"), F.col("html")).dropna()
    return rows.mapInArrow(vote, "host STRING, path STRING, outer BOOLEAN, vote DOUBLE, rival DOUBLE, pages BIGINT")


def path_shares(pages: DataFrame) -> DataFrame:
    """``host, path, outer, share, agreed`` of every path that got a vote.

    Sums are rounded so that their order of addition cannot matter. One page is added to those that share the votes,
    so that a path of very few pages does not beat one that many pages agree on.
    """
    votes = page_votes(pages).groupBy("host", "path", "outer").agg(
        F.round(F.sum("vote"), 6).alias("votes"), F.round(F.sum("rival"), 6).alias("rivals"), F.sum("pages").alias("pages")
    )
    agreed = (F.col("pages") >= LEAST_PAGES) & (F.col("votes") > F.col("rivals"))
    share = F.round(F.col("votes") / (F.col("pages") + 1), 6)
    return votes.filter("votes > 0").select("host", "path", "outer", share.alias("share"), agreed.alias("agreed"))


def host_paths(pages: DataFrame, agreed_only: bool = False) -> DataFrame:
    """``agreed_host, paths``: the paths of each host that got votes, agreed ones first, of these the body and the whole page last, then by share."""
    shares = path_shares(pages)
    if agreed_only:
        shares = shares.filter("agreed")
    last = F.when(F.col("agreed"), F.col("outer").cast("int")).otherwise(2)
    listed = F.array_sort(F.collect_list(F.struct(last.alias("last"), (-F.col("share")).alias("order"), "path")))
    return shares.groupBy(F.col("host").alias("agreed_host")).agg(F.transform(listed, lambda s: s["path"]).alias("paths"))


def with_paths(rows: DataFrame, agreed: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` with the ``paths`` of their ``own_host``, null if it has none.

    ``agreed`` is a written table. Its size is measured: a small one goes to every
    task and no page moves. With a larger one pages are dealt by host and a part
    of it, and the hosts' rows to all parts, so that no host is one task's work.
    """
    size = agreed.agg(F.sum(F.length("agreed_host") + F.aggregate("paths", F.lit(64), lambda n, p: n + F.length(p) + 32)).alias("size")).head().size or 0
    if size <= most:
        return rows.join(F.broadcast(agreed), F.col("own_host") == F.col("agreed_host"), "left")
    part = F.pmod(F.xxhash64("page_id", "url"), F.lit(HOST_PARTS)).cast("int")
    spread = agreed.withColumn("agreed_part", F.explode(F.sequence(F.lit(0), F.lit(HOST_PARTS - 1))))
    return rows.withColumn("own_part", part).join(spread, (F.col("own_host") == F.col("agreed_host")) & (F.col("own_part") == F.col("agreed_part")), "left")


def main_text(pages: DataFrame) -> DataFrame:
    """Per row: ``page_id, url, text, n_chars``."""
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html"), host_of(F.col("url")).alias("own_host"))
    joined = with_paths(rows, staged(host_paths(pages, agreed_only=True), "host-paths")).select("page_id", "url", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, paths or []) for page, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, "page_id BIGINT, url STRING, text STRING, n_chars BIGINT")
