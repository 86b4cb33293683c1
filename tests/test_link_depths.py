"""Depths of pages over the links in their HTML, against a plain breadth-first search."""

import random
from urllib.parse import urljoin

from sievework.plans.catalogue import QUERIES


def test_bfs_depth_walks_the_links(spark, tmp_path):
    r = random.Random(3)
    chain = [(f"http://a.example.com/p/{i}", [f"../p/{i + 1}"]) for i in range(14)]
    loop = [(f"http://b.example.com/{i}", [f"/{(i + 1) % 5}", "mailto:x@example.com"]) for i in range(5)]
    web = [(f"http://c{i % 3}.example.com/x/{i}", [f"http://c{j % 3}.example.com/x/{j}#top" if r.random() < 0.7 else f"./y{j}" for j in r.sample(range(40), 3)]) for i in range(40)]
    pages = [(n, u, "".join(f'<a href="{x}">t</a>' for x in links)) for n, (u, links) in enumerate([*chain, *loop, *web])]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")

    out = {u: {urljoin(u, x).split("#")[0] for x in links if not x.startswith("mailto:")} for u, links in [*chain, *loop, *web]}
    linked = {x for u in out for x in out[u] if x != u}
    first = {}
    for u in out:
        first.setdefault(u.split("/")[2], u)
    depth = dict.fromkeys([*first.values(), *(u for u in out if u not in linked)], 0)
    frontier = list(depth)
    for k in range(1, 11):
        frontier = sorted({x for u in frontier for x in out.get(u, ())} - depth.keys())
        depth |= dict.fromkeys(frontier, k)
    got = QUERIES["bfs_depth"](spark, str(tmp_path)).collect()
    assert {x["url"]: x["depth"] for x in got} == depth and len(got) == len(depth)
    assert depth["http://a.example.com/p/10"] == 10 and "http://a.example.com/p/11" not in depth and depth["http://b.example.com/4"] == 4
