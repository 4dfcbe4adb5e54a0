"""The path-template tree against brute force: wildcards, merged subtrees, verdicts; odd rows."""

import math
import random
from collections import defaultdict

import pytest

pytest.importorskip("folioforge.llm")
from folioforge.llm import url_templates as T  # noqa: E402


def brute_templates(pages, most, share):
    """(host, raw) -> segments of its template."""
    count = defaultdict(int)
    for host, raw in pages:
        count[host, raw] += 1
    out = {k: () for k in count}
    segs = {k: k[1].split("/")[1:] for k in count}
    for d in range(max(map(len, segs.values()), default=0)):
        children = defaultdict(lambda: defaultdict(int))
        for k, n in count.items():
            if len(segs[k]) > d:
                children[k[0], out[k]][segs[k][d]] += n
        step = {}
        for node, kids in children.items():
            rare = {c for c, n in kids.items() if n < share * sum(kids.values())} if len(kids) > most else set()
            step[node] = rare if len(rare) > most else set()
        out = {k: t if len(segs[k]) <= d else (*t, T.WILD if segs[k][d] in step[k[0], t] else segs[k][d]) for k, t in out.items()}
    return out


def brute_rejected(pages, labels, prior, least, z, most, share):
    """pages: (id, host, raw); labels: (id, good)."""
    good = {}
    for i, g in labels:
        if i is not None:
            good[i] = min(g, good.get(i, 1))
    template = brute_templates([(h, r) for _, h, r in pages], most, share)
    seen, fine = defaultdict(int), defaultdict(float)
    for i, h, r in pages:
        if i in good:
            way = template[h, r]
            for d in range(-1, len(way)):
                seen[h, way[: d + 1]] += 1
                fine[h, way[: d + 1]] += good[i]
    labelled = [good[i] for i, _, _ in pages if i in good]
    if not labelled:
        return set()
    whole = sum(labelled) / len(labelled)
    branch = {}
    for (h, r), way in template.items():
        at = (h, ())
        for d in range(len(way)):
            node = (h, way[: d + 1])
            if seen[node]:
                rate = fine[at] / seen[at]
                if abs(fine[node] / seen[node] - rate) > z * math.sqrt(max(rate * (1 - rate), 1e-6) / seen[node]):
                    at = node
        branch[h, r] = at
    s, g = defaultdict(int), defaultdict(float)
    for i, h, r in pages:
        if i in good:
            s[branch[h, r]] += 1
            g[branch[h, r]] += good[i]
    return {k for k, b in branch.items() if (g[b] + prior * whole) / (s[b] + prior) < least}


@pytest.mark.parametrize("seed", range(3))
def test_rejected_against_brute_force(spark, seed):
    rng = random.Random(seed)
    pages, labels = [], []
    for i in range(600):
        host = rng.choice(["a", "a", "b", ""])
        way = [rng.choice("pqr")] + [rng.choice([f"v{rng.randrange(40)}", "x", "y"]) for _ in range(rng.randrange(4))]
        raw = rng.choice(["/" + "/".join(way)] * 8 + ["", "/"])
        pages.append((rng.choice([i, i, i, i // 2, None]), host, raw))
        bad = way[0] == "p" and (len(way) < 2 or way[1] != "x")
        if rng.random() < 0.5:
            labels.append((i, int(rng.random() > (0.9 if bad else 0.15))))
    pages.append((10_000, "a", "/deep" * 300))
    labels += labels[:20] + [(labels[0][0], 1 - labels[0][1]), (None, 0)]
    p = spark.createDataFrame(pages, "page_id long, host string, raw string")
    tree = {(r["host"], r["raw"]): r["template"] for r in T.templates(p, 6, 0.05).collect()}
    want = brute_templates([(h, r) for _, h, r in pages], 6, 0.05)
    assert tree == {k: "".join(f"/{x}" for x in v) for k, v in want.items()}
    assert any(T.WILD in t for t in tree.values())
    made = T.templates
    T.templates = lambda q: made(q, 6, 0.05)
    try:
        got = {(r["host"], r["raw"]) for r in T.rejected_templates(p, spark.createDataFrame(labels, "page_id long, good int"), 4.0).collect()}
    finally:
        T.templates = made
    expected = brute_rejected(pages, labels, 4.0, 0.5, 1.96, 6, 0.05)
    assert got == expected and 0 < len(got) < len(want)


def test_subtrees_join_their_branch(spark):
    """Directories under one bad node, each too thin to tell by itself, fall with it; a good one among them stays."""
    pages = [(i, "h", f"/bad/d{i % 40:02d}/x") for i in range(200)] + [(1000 + i, "h", "/bad/kept/x") for i in range(60)] + [(2000 + i, "h", f"/fine/d{i % 40:02d}/x") for i in range(200)]
    labels = [(i, 0) for i in range(0, 200, 2)] + [(1000 + i, 1) for i in range(60)] + [(2000 + i, 1) for i in range(0, 200, 2)]
    got = T.rejected_templates(spark.createDataFrame(pages, "page_id long, host string, raw string"), spark.createDataFrame(labels, "page_id long, good int"))
    paths = {r["raw"] for r in got.collect()}
    assert paths == {f"/bad/d{i:02d}/x" for i in range(40)}


def test_odd_labels_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://h/a", "k"), (1, "http://h/a", "k"), (None, None, "k"), (2, "no scheme", "k"), (3, "http://h" + "/s" * 3000, "k")], "page_id long, url string, branch string")
    odd = spark.createDataFrame([(1, 0), (1, 1), (None, 0), (99, 1)], "page_id long, good int")
    got = T.filter_urls(pages, odd).collect()
    assert len(got) == 5 and got[0].asDict().keys() == {"page_id", "host", "path", "rule", "verdict"}
    assert T.filter_urls(pages, odd.limit(0)).filter("verdict = 'block'").count() == 0
    assert T.filter_urls(pages.limit(0), odd).count() == 0
